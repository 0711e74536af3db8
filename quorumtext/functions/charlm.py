"""Character n-gram model as two tables: counts of n-grams and of their contexts, additive smoothing.

The tables are bounded by the alphabet. Texts are counted, and scored where the tables count few rows, as arrays of code points in Arrow
batches, some at a time; a larger model is joined to the texts' n-grams.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorumtext.plans.session import cut_lineage

#: Longest n-grams of a model that is still broadcast, some 100 MB.
BROADCAST_ROWS = 1_000_000
#: Bytes of text that a worker spells out at a time (one text at least), n-grams that it sums up before it passes them on, and codes up to
#: which it keeps an array by code.
PART_BYTES, HELD_GRAMS, DENSE = 1 << 20, 1 << 20, 1 << 22
_POINTS = 0x110000


@dataclass
class CharLM:
    ngrams: DataFrame  # n, gram, cnt
    contexts: DataFrame  # n, gram (without its last character), cnt
    order: int
    alpha: float
    symbols: int


def load(spark: SparkSession, path: str) -> CharLM:
    """A model file: {order, alpha, vocab, ngram_counts: {n: {gram: count}}, context_counts: {n: {gram: count}}}."""
    if "://" in path:
        model = json.loads("".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
    else:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
    rows = lambda key: [(int(n), g, int(c)) for n, grams in model[key].items() for g, c in grams.items()]
    table = lambda key: spark.createDataFrame(rows(key), "n int, gram string, cnt bigint")
    return CharLM(table("ngram_counts"), table("context_counts"), int(model["order"]), float(model["alpha"]), len(model["vocab"]))


def grams(text: Column, n: int) -> Column:
    """All substrings of n characters. The text is split once; cutting it at every place would be quadratic."""
    spelled = lambda chars: F.transform(chars, lambda c, i: F.concat(c, *[F.get(chars, i + d) for d in range(1, n)]))
    found = F.element_at(F.transform(F.array(F.filter(F.split(text, "", -1), lambda c: c != "")), spelled), 1)
    return F.array_compact(found)  # past the end a character is null, and the whole with it


def _parts(texts: pa.Array) -> Iterator[tuple[int, int, str, np.ndarray, np.ndarray]]:
    """Some texts at a time: the rows from and to, the texts joined, their code points, and how long each is (null: 0)."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype("int64"))
    bounds = [0, *(np.flatnonzero(np.diff(sizes // PART_BYTES)) + 1).tolist(), len(texts)]
    for a, z in zip(bounds, bounds[1:]):
        each = [t or "" for t in texts[a:z].to_pylist()]
        joined = "".join(each)
        yield a, z, joined, np.frombuffer(joined.encode("utf-32-le"), "<u4"), np.fromiter(map(len, each), "int64", len(each))


def _whole(n: int, count: int, ends: np.ndarray) -> np.ndarray:
    """Of count places those at which n characters stand before the text ends."""
    whole = np.ones(count, bool)
    for d in range(1, n):
        whole[ends[ends >= d] - d] = False
    return whole


def _codes(ids: np.ndarray, n: int, symbols: int) -> np.ndarray:
    """At each place the next n ids as one number; past the end they count as 0."""
    codes = ids.astype("int64")
    for d in range(1, n):
        codes *= symbols
        codes[: max(len(ids) - d, 0)] += ids[d:]
    return codes


def _counted(joined: str, points: np.ndarray, lengths: np.ndarray, order: int) -> Iterator[tuple[tuple[int, str], int]]:
    """(n, n-gram), count for all n up to order."""
    alphabet = np.flatnonzero(np.bincount(points, minlength=_POINTS))
    place = np.zeros(_POINTS, "int64")
    place[alphabet] = np.arange(len(alphabet))
    ids, size, codes, ends = place[points], len(alphabet), None, np.cumsum(lengths)
    for n in range(1, order + 1):
        if n == 1:
            codes = ids
        else:
            if size > 2**62 // len(alphabet):
                known, codes = np.unique(codes, return_inverse=True)
                size = len(known)
            codes = codes * len(alphabet)
            codes[: max(len(ids) - n + 1, 0)] += ids[n - 1 :]
            size *= len(alphabet)
        at = np.flatnonzero(_whole(n, len(ids), ends))
        if size <= DENSE:
            counts, last = np.bincount(codes[at], minlength=size), np.zeros(size, "int64")
            last[codes[at]] = at
            found = np.flatnonzero(counts)
            places, counts = last[found], counts[found]
        else:
            _, first, counts = np.unique(codes[at], return_index=True, return_counts=True)
            places = at[first]
        yield from (((n, joined[p : p + n]), c) for p, c in zip(places.tolist(), counts.tolist()))


def train(texts: DataFrame, order: int = 3, alpha: float = 0.1) -> CharLM:
    """Counts over all rows' text, which is read once and summed in the workers before the shuffle."""

    def passed_on(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([n for n, _ in held], pa.int32()), pa.array([g for _, g in held], pa.string()), pa.array(held.values(), pa.int64())], ["n", "gram", "cnt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter()
        for batch in batches:
            for _, _, joined, points, lengths in _parts(batch.column(0)):
                for gram, count in _counted(joined, points, lengths, order) if joined else ():
                    held[gram] += count
                if len(held) > HELD_GRAMS:
                    yield passed_on(held)
                    held = Counter()
        yield passed_on(held)

    counted = texts.select("text").mapInArrow(run, "n int, gram string, cnt bigint")
    # few rows, which each step after this one reads again
    ngrams = cut_lineage(counted.groupBy("n", "gram").agg(F.sum("cnt").alias("cnt")))
    contexts = ngrams.where("n > 1").groupBy("n", F.expr("substring(gram, 1, n - 1)").alias("gram")).agg(F.sum("cnt").alias("cnt"))
    return CharLM(ngrams, contexts, order, alpha, ngrams.where("n = 1").count())


class _Logs:
    """ln(count + more) of strings of n characters by code; ln(more) of those that aren't listed."""

    def __init__(self, rows: pa.Table, n: int, more: float, place: np.ndarray, symbols: int) -> None:
        listed = [(g, c) for g, c in zip(*(rows.column(k).to_pylist() for k in ("gram", "cnt"))) if len(g) == n]
        points = np.frombuffer("".join(g for g, _ in listed).encode("utf-32-le"), "<u4").reshape(len(listed), n)
        codes = np.zeros(len(listed), "int64")
        for d in range(n):
            codes = codes * symbols + place[points[:, d]]
        by_code = np.argsort(codes)
        self.codes, self.logs = codes[by_code], np.log(np.array([c for _, c in listed], "float64")[by_code] + more)
        self.size, self.other, self.dense = symbols**n, np.log(more), None

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        if self.size <= DENSE:
            if self.dense is None:
                self.dense = np.full(self.size, self.other)
                self.dense[self.codes] = self.logs
            return self.dense[codes]
        if not len(self.codes):
            return np.full(len(codes), self.other)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.logs[at], self.other)


def _losses(texts: DataFrame, model: CharLM, keys: list[str], top: pa.Table, under: pa.Table, alphabet: np.ndarray) -> DataFrame:
    """keys, n_grams, loss of each text that has n-grams: their number, and the sum of their losses."""
    order, symbols = model.order, len(alphabet) + 1
    place = np.zeros(_POINTS, "int64")
    place[alphabet] = np.arange(1, symbols)
    tables = _Logs(top, order, model.alpha, place, symbols), _Logs(under, order - 1, model.alpha * model.symbols, place, symbols)
    shared = texts.sparkSession.sparkContext.broadcast((alphabet, *tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, seen, context = shared.value
        place = np.zeros(_POINTS, "int64")
        place[alphabet] = np.arange(1, symbols)
        for batch in batches:
            for a, z, joined, points, lengths in _parts(batch.column(len(keys))):
                ids, ends = place[points], np.cumsum(lengths)
                loss = context(_codes(ids, order - 1, symbols)) - seen(_codes(ids, order, symbols))
                loss[~_whole(order, len(ids), ends)] = 0.0
                rows = np.flatnonzero(lengths >= order)
                # a text's sum runs on over shorter ones after it, whose losses are 0
                sums = np.add.reduceat(loss, (ends - lengths)[rows]) if len(rows) else np.zeros(0)
                kept = batch.slice(a, z - a).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*kept.columns[: len(keys)], pa.array(lengths[rows] - order + 1), pa.array(sums)], [*keys, "n_grams", "loss"])

    rows = texts.select(*keys, "text")
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[: len(keys)], T.StructField("n_grams", T.LongType()), T.StructField("loss", T.DoubleType())]))


def perplexity(texts: DataFrame, model: CharLM, keys: list[str]) -> DataFrame:
    """keys, n_grams, perplexity: exp of the mean of -ln((c + alpha) / (context + alpha * symbols)); null for texts under order characters."""
    top = model.ngrams.where(F.col("n") == model.order).select("gram", "cnt")
    under = model.contexts.where(F.col("n") == model.order).select("gram", "cnt")
    alphabet = np.zeros(0)
    if few := model.order > 1 and model.alpha > 0 and top.count() <= BROADCAST_ROWS and under.count() <= BROADCAST_ROWS:
        listed = top.toArrow(), under.toArrow()
        alphabet = np.array(sorted({ord(c) for rows in listed for g in rows.column("gram").to_pylist() for c in g}), "int64")
    if few and (len(alphabet) + 1) ** model.order < 2**63:
        losses = _losses(texts, model, keys, *listed, alphabet)
    else:
        losses = _joined_losses(texts, model, keys, top, under)
    scored = losses.groupBy(*keys).agg(F.sum("n_grams").alias("n_grams"), F.exp(F.sum("loss") / F.sum("n_grams")).alias("perplexity"))
    return texts.select(*keys).join(scored, keys, "left").withColumn("n_grams", F.coalesce("n_grams", F.lit(0)))


def _joined_losses(texts: DataFrame, model: CharLM, keys: list[str], top: DataFrame, under: DataFrame) -> DataFrame:
    """keys, n_grams, loss for each n-gram of a text; equal ones meet before the join."""
    each = texts.select(*keys, F.explode(grams(F.col("text"), model.order)).alias("gram")).groupBy(*keys, "gram").agg(F.count(F.lit(1)).alias("n_grams"))
    top, under = top.withColumnRenamed("cnt", "c"), under.select(F.col("gram").alias("context"), F.col("cnt").alias("k"))
    joined = each.withColumn("context", F.substring("gram", 1, model.order - 1)).join(top, "gram", "left").join(under, "context", "left")
    loss = -F.log((F.coalesce("c", F.lit(0)) + model.alpha) / (F.coalesce("k", F.lit(0)) + model.alpha * model.symbols))
    return joined.select(*keys, "n_grams", (F.col("n_grams") * loss).alias("loss"))
