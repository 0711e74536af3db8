"""Pieces that the training-data operators share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word: a run of characters other than space, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a session of one process (local mode) that names none gets a
    temporary one; on a cluster each executor would write to a disk of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="quorumtext-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Account:
    """What a run has written on the way. As a context it deletes all of that at its end, so results that still read it must be
    written inside. Accounts nest: what an inner one keeps is the outer one's."""

    def __init__(self) -> None:
        self.written: list[tuple[SparkSession, str, str | None]] = []

    def add(self, spark: SparkSession, path: str, table: str | None = None) -> None:
        self.written.append((spark, path, table))

    def release(self, *results: DataFrame) -> None:
        """Delete what none of the results reads."""
        read = {name for r in results for name in _sources(r)}
        kept = [x for x in self.written if x[1].rsplit("/", 1)[-1] in read]
        for spark, path, table in self.written:
            if (spark, path, table) not in kept:
                _delete(spark, path, table)
        self.written = kept

    def __enter__(self) -> Account:
        self._token = _account.set(self)
        return self

    def __exit__(self, *_: object) -> None:
        _account.reset(self._token)
        self.release()


#: Holds what no other account does, until the driver ends.
_rest = Account()
_account: ContextVar[Account] = ContextVar("account", default=_rest)


def tidy(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator that has deleted, when it returns, all it wrote on the way but what its result reads."""

    @wraps(f)
    def run(*args, **named) -> DataFrame:
        outer, own = _account.get(), Account()
        token = _account.set(own)
        try:
            result = f(*args, **named)
            own.release(result)
        except BaseException:
            own.release()
            raise
        finally:
            _account.reset(token)
        outer.written += own.written
        return result

    return run


def release(*results: DataFrame) -> None:
    """Within a tidy operator: delete what it has written so far but what the results read."""
    if (account := _account.get()) is not _rest:
        account.release(*results)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends at files that outlive any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quorumtext/{name}-{uuid.uuid4().hex}"
    _account.get().add(spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, column: str, name: str = "table") -> DataFrame:
    """Write df to the shared folder as a table bucketed by column: later joins on that column don't shuffle it again. The table
    goes when its account releases it."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"quorumtext_{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/quorumtext/{table}"
    _account.get().add(spark, path, table)
    df.repartition(n, column).write.bucketBy(n, column).sortBy(column).option("path", path).saveAsTable(table)
    return spark.table(table)


def _sources(df: DataFrame) -> list[str]:
    """Names of the folders that a plan reads."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    leaves = [leaves.apply(i) for i in range(leaves.size())]
    roots = [x.relation().location().rootPaths() for x in leaves if x.getClass().getSimpleName() == "LogicalRelation"]
    return [r.apply(i).getName() for r in roots for i in range(r.size())]


def _delete(spark: SparkSession, path: str, table: str | None = None) -> None:
    if table:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    try:
        _rest.release()
    except Exception:  # the session is gone, and with it the gateway
        return


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(column: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo modulus."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


#: Texts turned into Python objects at a time; Arrow batches hold more.
FRAME_ROWS = 256


def map_frames(df: DataFrame, run, schema: str, rows: int = FRAME_ROWS) -> DataFrame:
    """mapInPandas over small frames, so that a worker never holds a whole batch of texts twice; integers stay integers beside nulls."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def mapped(batches):
        import pandas as pd

        kinds = {pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}
        frames = (b.slice(at, rows).to_pandas(types_mapper=kinds.get) for b in batches for at in range(0, b.num_rows, rows))
        for out in run(frames):
            yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)

    return df.mapInArrow(mapped, schema)


def whole_groups(batches, keys: list[str]):
    """Arrow batches of a partition sorted by keys -> pandas frames that each hold whole groups. At most one group and one
    batch are held, so groups must be of bounded size."""
    import pandas as pd

    rest = None
    for batch in batches:
        if not len(batch):
            continue
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        last = (batch[keys] == batch[keys].iloc[-1]).all(axis=1).to_numpy()
        at = len(batch) - int(last[::-1].argmin()) if not last.all() else 0
        if at:
            yield batch.iloc[:at].reset_index(drop=True)
        rest = batch.iloc[at:].reset_index(drop=True)
    if rest is not None:
        yield rest
