"""Line sources: what recognition engines return, as tables, and the registry that names them.

Recognition itself is a plug-in: a function from pages (page_id, angle, variant, image) to lines. Everything after it is relational. The
parsers turn each engine's own result shape, kept as a nested column, into lines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumtext.functions.geometry import polygon_box, scaled_box, union_box
from quorumtext.functions.text import strip

LineSource = Callable[[DataFrame], DataFrame]
_registry: dict[str, LineSource] = {}
DEFAULT_ENGINES = ("paddle", "doctr", "mmocr", "kraken")


def register(name: str, source: LineSource) -> None:
    _registry[name] = source


def registered() -> list[str]:
    return list(_registry)


@contextmanager
def registering(**sources: LineSource) -> Iterator[None]:
    """Sources that are registered, and the only ones, within a block."""
    before = dict(_registry)
    _registry.clear()
    _registry.update(sources)
    try:
        yield
    finally:
        _registry.clear()
        _registry.update(before)


def enabled(names: list[str] | None) -> list[str]:
    """The engines to run, in the order given; unknown names are passed over, none means all."""
    return [n for n in (names or DEFAULT_ENGINES) if n in _registry or n in DEFAULT_ENGINES]


def read_lines(pages: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Lines of all enabled engines over pages, with engine and engine_ord; lines of other pages are dropped, once for all engines.

    Sources may end in shuffles by page. A union then claims to be partitioned by page, too, and seems to lose that when adaptive
    execution changes one of its children while the query runs, though joins above it were planned to rely on it. So each part hands on its
    page ids as an expression, of which no partitioning is known, and what needs the union by page shuffles it.
    """
    opaque = F.bitwise_not(F.bitwise_not(F.col("page_id").cast("long")))
    parts = [_registry[n](pages).withColumns({"page_id": opaque, "engine": F.lit(n), "engine_ord": F.lit(k)}) for k, n in enumerate(enabled(names)) if n in _registry]
    if not parts:
        raise ValueError("no line source is registered under the enabled names")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.join(pages.select(F.col("page_id").cast("long").alias("page_id")).distinct(), "page_id", "left_semi")


def loaded(names: list[str] | None, pages: DataFrame) -> tuple[list[str], dict[str, str]]:
    """The engines that start, and the messages of those that don't; an engine that fails to start is out for all pages and angles."""
    ready, failed = [], {}
    for n in enabled(names):
        if n not in _registry:
            failed[n] = "no line source is registered"
            continue
        try:
            _registry[n](pages.limit(0)).schema
            ready.append(n)
        except Exception as wrong:  # a plug-in may raise anything
            failed[n] = str(wrong)
    return ready, failed


def failure_rows(pages: DataFrame, failed: dict[str, str], angles: tuple[int, ...]) -> DataFrame:
    """(page_id, angle_ord, angle, engine, error) for every page and angle, as input of the error map."""
    rows = [(k, a, n, e) for k, a in enumerate(angles) for n, e in failed.items()]
    items = F.array(*[F.struct(F.lit(k).alias("angle_ord"), F.lit(a).alias("angle"), F.lit(n).alias("engine"), F.lit(e).alias("error")) for k, a, n, e in rows])
    if not rows:
        items = F.array().cast("array<struct<angle_ord:int,angle:int,engine:string,error:string>>")
    return pages.select("page_id", F.inline(items))


def recorded(lines: DataFrame) -> LineSource:
    """A source that replays recorded lines, whatever the pages: read_lines() keeps those asked for."""
    return lambda pages: lines


def _lines(df: DataFrame, keys: list[str], items: Column) -> DataFrame:
    """An array of (text, bbox, raw_confidence) to rows; blank texts are no lines."""
    rows = df.select(*keys, F.posexplode(items).alias("line_no", "x")).select(*keys, "line_no", strip(F.col("x.text")).alias("text"), F.col("x.bbox").alias("bbox"), F.col("x.raw_confidence").alias("raw_confidence"))
    return rows.where("text <> ''")


def _item(text: Column, bbox: Column, confidence: Column) -> Column:
    return F.struct(text.cast("string").alias("text"), bbox.alias("bbox"), confidence.cast("double").alias("raw_confidence"))


def paddle_lines(df: DataFrame, keys: list[str], result: str = "result") -> DataFrame:
    """result: array<struct<polygon: array<array<double>>, text: string, confidence: string>>; a confidence that is no number is missing."""
    return _lines(df, keys, F.transform(result, lambda x: _item(x["text"], polygon_box(x["polygon"]), x["confidence"].try_cast("double"))))


def mmocr_lines(df: DataFrame, keys: list[str], texts: str = "texts", scores: str = "scores", polygons: str = "polygons") -> DataFrame:
    """Parallel arrays; what is missing at the end of one is null, and so are scores or polygons that are missing altogether."""
    given = lambda c: F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType))
    zipped = F.arrays_zip(F.col(texts).alias("t"), given(scores).alias("s"), given(polygons).alias("p"))
    usable = F.slice(zipped, F.lit(1), F.greatest(F.size(F.col(texts)), F.lit(0)))
    return _lines(df, keys, F.transform(usable, lambda x: _item(x["t"], polygon_box(x["p"]), x["s"])))


def mmocr_fields(prediction: Column) -> dict[str, Column]:
    """The first of an engine's field names that holds something."""
    first = lambda *names: F.coalesce(*[F.when(F.size(prediction[n]) > 0, prediction[n]) for n in names])
    return {"texts": first("rec_texts", "texts"), "scores": first("rec_scores", "scores"), "polygons": first("det_polygons", "polygons", "bboxes")}


def kraken_lines(df: DataFrame, keys: list[str], result: str = "result") -> DataFrame:
    """result: array<struct<prediction, bbox, confidence>>, the box as it is."""
    return _lines(df, keys, F.transform(result, lambda x: _item(x["prediction"], x["bbox"], x["confidence"])))


def doctr_lines(df: DataFrame, keys: list[str], result: str = "result") -> DataFrame:
    """result: array (blocks) of array (lines) of struct<geometry, words: array<struct<value, geometry, confidence>>>, with page_width and
    page_height. A line's confidence sums as many of the last confidences read so far on the page as it has words, by words; its
    box is its own or that around its words."""
    width, height = F.col("page_width"), F.col("page_height")
    words = lambda line: F.filter(line["words"], lambda w: F.length(strip(w["value"])) > 0)
    lines = F.flatten(result)

    def step(state: Column, line: Column) -> Column:
        found = words(line)
        seen = F.concat(state["seen"], F.filter(F.transform(found, lambda w: w["confidence"].cast("double")), lambda c: c.isNotNull()))
        n = F.size(found)
        last = F.slice(seen, F.greatest(F.size(seen) - n + 1, F.lit(1)), F.greatest(n, F.lit(1)))
        total = F.aggregate(F.when(F.size(seen) > 0, last).otherwise(seen), F.lit(0.0), lambda a, c: a + c)
        around = union_box(F.transform(found, lambda w: scaled_box(w["geometry"], width, height)))
        item = _item(F.array_join(F.transform(found, lambda w: strip(w["value"])), " "), F.coalesce(scaled_box(line["geometry"], width, height), around), total / n)
        return F.struct(F.when(n > 0, F.concat(state["out"], F.array(item))).otherwise(state["out"]).alias("out"), seen.alias("seen"))

    from quorumtext.schema import BOX

    start = F.struct(F.array().cast(f"array<struct<text:string,bbox:{BOX},raw_confidence:double>>").alias("out"), F.array().cast("array<double>").alias("seen"))
    return _lines(df, keys, F.aggregate(lines, start, step)["out"])
