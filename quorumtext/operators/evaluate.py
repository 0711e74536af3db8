"""Character and word error rates against gold text, and the tables of evaluation runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumtext.functions.text import SPACE, squeeze

#: One character per distinct word of a pair of texts: the private use area and, beyond it, ideographs and syllables.
_LETTERS = "".join(map(chr, [*range(0xE000, 0xF900), *range(0x3400, 0xD7A4)]))


def cer(read: Column, gold: Column) -> Column:
    """Edit distance by gold length, uncapped; null for empty gold."""
    return F.when(F.length(gold) > 0, F.levenshtein(read, gold) / F.length(gold))


def accuracy(error: Column) -> Column:
    return F.greatest(F.lit(0.0), (F.lit(1.0) - error) * 100.0)


def _words(text: Column) -> Column:
    return F.filter(F.split(squeeze(text), SPACE), lambda w: w != "")


def wer(read: Column, gold: Column) -> Column:
    """Edit distance in words by gold words; null for empty gold, or if the two texts hold more distinct words than there are letters."""
    letters = F.split(F.lit(_LETTERS), "")
    spelled = lambda words, kinds: F.array_join(F.transform(words, lambda w: F.get(letters, F.array_position(kinds, w).cast("int") - 1)), "")

    def distance(t: Column) -> Column:
        a, b, kinds = t["a"], t["b"], t["kinds"]
        return F.when((F.size(b) > 0) & (F.size(kinds) <= len(_LETTERS)), F.levenshtein(spelled(a, kinds), spelled(b, kinds)) / F.size(b))

    # each list of words is made once a row: inside a lambda an expression is computed for every element
    pair = F.transform(F.array(F.struct(_words(read).alias("a"), _words(gold).alias("b"))), lambda t: t.withField("kinds", F.array_union(t["a"], t["b"])))
    return F.element_at(F.transform(pair, distance), 1)


def evaluate(read: DataFrame, gold: DataFrame, keys: Sequence[str] = ("pdf_name", "page")) -> DataFrame:
    """read (keys, engine, text), gold (keys, gold_text) -> keys, engine, cer, accuracy, wer, ocr_len, gold_len."""
    joined = read.join(gold, list(keys))
    error = cer(F.col("text"), F.col("gold_text"))
    return joined.select(*keys, "engine", error.alias("cer"), accuracy(error).alias("accuracy"), wer(F.col("text"), F.col("gold_text")).alias("wer"), F.length("text").alias("ocr_len"), F.length("gold_text").alias("gold_len"))


def unevaluated(pages: DataFrame, results: DataFrame, keys: Sequence[str]) -> DataFrame:
    return pages.join(results, list(keys), "left_anti")


def long_form(wide: DataFrame, keys: Sequence[str], engines: Sequence[str], metrics: Sequence[str] = ("cer", "wer")) -> DataFrame:
    """Columns <engine>_<metric> to rows of engine and metrics."""
    rows = F.array(*[F.struct(F.lit(e).alias("engine"), *[F.col(f"{e}_{m}").alias(m) for m in metrics]) for e in engines])
    return wide.select(*keys, F.inline(rows))


def fusion_wins(results: DataFrame, keys: Sequence[str], fusion: str = "fusion") -> DataFrame:
    """(keys, engine, cer) -> keys, fusion_cer, best_engine, best_cer (of the others, first by name on ties), fusion_wins."""
    rivals = F.when(F.col("engine") != fusion, F.struct("cer", "engine"))
    grouped = results.where("cer IS NOT NULL").groupBy(*keys).agg(F.min(F.when(F.col("engine") == fusion, F.col("cer"))).alias("fusion_cer"), F.min(rivals).alias("best"))
    return grouped.select(*keys, "fusion_cer", F.coalesce("best.engine", F.lit("none")).alias("best_engine"), F.col("best.cer").alias("best_cer"), F.when(F.col("fusion_cer") <= F.coalesce("best.cer", "fusion_cer"), "yes").otherwise("no").alias("fusion_wins"))
