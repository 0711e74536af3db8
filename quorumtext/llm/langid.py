"""Language identification: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased, every run of characters that aren't letters is one blank, and the n-grams of 1 to `longest` characters
are hashed into `buckets`. The model is a matrix of log-probabilities, languages by buckets, broadcast to the workers
(languages * buckets * 4 bytes, whatever the corpus); the n-grams of a batch of texts are one sparse matrix, multiplied by the model in numpy.

Training reads at most about `training_rows` labelled rows, chosen by the hash of the id (a row's choice depends on nothing
but its id and the number of rows), and sums their counts in Spark.

Defined cases: text that is null or has no letter is `und` with score 0; rows without lang never train; with no training row
every prediction is `und`; ties go to the language first in code-point order; repeated rows are predicted each; whole texts
of any length count; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumtext.llm.common import map_frames

UNKNOWN = "und"
TRAINING_ROWS, BUCKETS, LONGEST = 20_000, 1 << 15, 4
#: Characters hashed at a time, so that a very long text takes no more memory than that.
BLOCK = 1 << 16
#: The most characters of an n-gram.
MOST_CHARS = 15


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point -> code point of the lower-case letter, 0 for what isn't a letter."""
    table = np.zeros(0x110000, "uint32")
    for c in range(0x110000):
        if (x := chr(c)).isalpha():
            table[c] = ord(low) if len(low := x.lower()) == 1 else c
    return table


def letters(text: str) -> np.ndarray:
    """Lower-case letters, with 0 for each run of others, also before and after."""
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    codes = np.concatenate(([0], codes, [0])).astype("uint32")
    return codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]


def pieces(texts: Sequence[str | None]) -> Iterator[tuple[int, np.ndarray, int]]:
    """(text's number, letters, how many of them begin n-grams of this piece); long texts are several pieces."""
    for i, text in enumerate(texts):
        codes = letters(text or "")
        if codes.any():
            for at in range(0, len(codes), BLOCK):
                yield i, codes[at : at + BLOCK + MOST_CHARS], min(BLOCK, len(codes) - at)


def hashed(texts: Sequence[str | None], longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The n-grams of all texts as a sparse matrix in parts: (text's number, bucket) of each, about BLOCK letters at a time."""
    held: list[tuple[int, np.ndarray, int]] = []

    def part() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sizes = np.array([len(c) for _, c, _ in held])
        codes, ends = np.concatenate([c for _, c, _ in held]), np.cumsum(sizes)
        of = np.repeat(np.array([i for i, _, _ in held]), sizes)
        room = np.repeat(ends, sizes) - np.arange(len(codes))  # characters from each on to the end of its piece
        first = np.arange(len(codes)) - np.repeat(ends - sizes, sizes) < np.repeat(np.array([n for _, _, n in held]), sizes)
        h = np.zeros(len(codes), "uint32")
        for n in range(1, min(longest, len(codes)) + 1):
            h = (h[: len(codes) - n + 1] ^ codes[n - 1 :]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            whole = (first & (room >= n))[: len(h)]
            yield of[: len(h)][whole], (h[whole] + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) % np.uint32(buckets)

    total = 0
    for piece in pieces(texts):
        held.append(piece)
        total += len(piece[1])
        if total >= BLOCK:
            yield from part()
            held, total = [], 0
    if held:
        yield from part()


def train(labelled: DataFrame, training_rows: int = TRAINING_ROWS, buckets: int = BUCKETS, longest: int = LONGEST) -> tuple[list[str], np.ndarray]:
    """labelled (id, text, lang) -> languages in code-point order, log-probabilities (languages, buckets)."""
    if not 1 <= longest <= MOST_CHARS:
        raise ValueError(f"longest must be from 1 to {MOST_CHARS}")
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    share = min(1.0, training_rows / max(1, labelled.select("lang").count()))
    chosen = labelled.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("text", "lang")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, some in batch.groupby("lang").text:
                have = totals.setdefault(lang, np.zeros(buckets, "int64"))
                for _, h in hashed(some.tolist(), longest, buckets):
                    have += np.bincount(h, minlength=buckets)
        for lang, n in totals.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})

    summed = chosen.repartition(8).mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = summed.toPandas()  # languages * buckets rows at most
    langs = sorted(counts.lang.unique(), key=lambda x: x.encode())
    matrix = np.ones((len(langs), buckets))
    np.add.at(matrix, (counts.lang.map({x: i for i, x in enumerate(langs)}).to_numpy("int64"), counts.bucket.to_numpy("int64")), counts.n.to_numpy("float64"))
    return langs, np.log(matrix / matrix.sum(axis=1, keepdims=True)).astype("float32")


def score(texts: Sequence[str | None], langs: list[str], matrix: np.ndarray, longest: int) -> tuple[list[str], list[float]]:
    """matrix: log-probabilities (languages, buckets). The sparse matrix of a batch's n-grams times the model; scores are
    posteriors with equal priors."""
    total, seen = np.zeros((len(langs), len(texts))), np.zeros(len(texts), bool)
    for of, h in hashed(texts, longest, matrix.shape[1]) if langs else ():
        seen[of] = True
        for k in range(len(langs)):
            total[k] += np.bincount(of, matrix[k, h], len(texts))
    if not langs:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    best = total.argmax(axis=0)
    sure = np.where(seen, 1 / np.exp(total - total.max(axis=0)).sum(axis=0), 0.0)
    return [langs[k] if s else UNKNOWN for k, s in zip(best, seen)], sure.tolist()


def identify(docs: DataFrame, learn: Column, id_column: str = "doc_id", training_rows: int = TRAINING_ROWS, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """id_column, lang_pred, score for every row; trained on the rows of docs where learn holds and lang isn't null."""
    langs, matrix = train(docs.where(learn).select(F.col(id_column).alias("id"), "text", "lang"), training_rows, buckets, longest)
    model = docs.sparkSession.sparkContext.broadcast((langs, matrix))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, sure = score(batch.text.tolist(), *model.value, longest)
            yield pd.DataFrame({"id": batch["id"], "lang_pred": found, "score": sure})

    out = map_frames(docs.select(F.col(id_column).cast("string").alias("id"), "text"), run, "id string, lang_pred string, score double")
    return out.withColumn("id", F.col("id").cast(docs.schema[id_column].dataType)).withColumnRenamed("id", id_column)
