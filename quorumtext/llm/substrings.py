"""Substring dedup by sliding sentence spans.

A sentence ends at a word that ends in one of .!?… (quotes and brackets after it aside) or at a line end. A sentence of more than WINDOW
words is cut after the least word hash of every WINDOW words, so that a passage in text without punctuation, or one that begins
and ends inside longer sentences, holds whole sentences, too; no sentence is longer than twice that. The cuts depend on nearby words alone, so
a passage is cut alike wherever it stands, but for its first and last few words: in 50 words of any text at least one span of 15 is.

A span is a run of at least two sentences and `least_words` words. Of all spans those are hashed that hold no smaller one: from each
sentence on, and back from each sentence. That is enough: the sentences of any repeated run lie in such a span within the run,
which repeats with it. Two independent 64-bit hashes (word hashes summed with powers of odd numbers, so that all spans of a text come from
running sums) are joined over the whole corpus, and every sentence that lies in a repeated span other than the
span's first place (smallest id, then sentence number) is removed.

Counting one hash first keeps the joins narrow: only hashes, id and number are shuffled, and a passage that a third of the
documents share is summed before the shuffle and then met by a plain join that Spark can split.

Defined cases: null stays null and has no sentences; empty text stays empty; repeated rows (same id and text) are one document, as
are rows that share an id where their spans are the same; very long texts go whole; other columns stay as they are; a text
whose sentences all go is empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.llm.common import map_frames, materialize, release, tidy

KEPT_WORDS, CHUNK = 150_000, 1 << 16
POWERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
ENDS, CLOSING = frozenset(".!?…。！？"), "\"'”’»)]}"
WINDOW = 10
_token = re.compile(r"[^\x20\x09-\x0D]+")


class Words(dict):
    """word -> its place in tables of two 64-bit hashes and whether a sentence ends with it, for a bounded number of words."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes, self.ends, self.size = np.empty((2, KEPT_WORDS + CHUNK), "uint64"), np.empty(KEPT_WORDS + CHUNK, bool), 0

    def __missing__(self, word: str) -> int:
        at, h = self.size, xxhash.xxh3_128_intdigest(word.encode("utf-8", "surrogatepass"))
        self.hashes[0, at], self.hashes[1, at] = h & 0xFFFFFFFFFFFFFFFF, h >> 64
        self.ends[at] = word.rstrip(CLOSING)[-1:] in ENDS
        self.size += 1
        if len(word) <= 64:
            self[word] = at
        return at

    def read(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The two hashes of each word (2, n), and whether it ends a sentence."""
        hashes, ends = np.empty((2, len(words)), "uint64"), np.empty(len(words), bool)
        for k in range(0, len(words), CHUNK):
            if self.size > KEPT_WORDS:
                self.clear()
                self.size = 0
            part = words[k : k + CHUNK]
            at = np.fromiter(map(self.__getitem__, part), "int64", len(part))
            hashes[:, k : k + CHUNK], ends[k : k + CHUNK] = self.hashes[:, at], self.ends[at]
        return hashes, ends


class Powers:
    """Powers of an odd number modulo 2**64, as many as asked for."""

    def __init__(self, base: int):
        self.base, self.known = np.uint64(base), np.ones(1, "uint64")

    def __call__(self, n: int) -> np.ndarray:
        if n > len(self.known):
            steps = np.full(max(n, 4096), self.base)
            steps[0] = 1
            self.known = np.cumprod(steps, dtype="uint64")
        return self.known[:n]


class Spans:
    def __init__(self, least_words: int):
        self.least, self.words = least_words, Words()
        self.up, self.down = [Powers(p) for p in POWERS], [Powers(pow(p, -1, 1 << 64)) for p in POWERS]

    def sentences(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Where sentences start, in words, and the end; the words' hashes."""
        words, line_ends = [], []
        for line in (text or "").split("\n"):
            words += _token.findall(line)
            line_ends.append(len(words))
        v, end = self.words.read(words)
        if not (n := len(words)):
            return np.zeros(1, "int64"), v
        end[np.array(line_ends, "int64")[np.array(line_ends) > 0] - 1] = True
        if n >= WINDOW:
            ends = np.concatenate(([0], np.cumsum(end)))
            at = np.flatnonzero(ends[WINDOW - 1 : -1] == ends[: n - WINDOW + 1])  # windows within one sentence
            if len(at):
                within = np.lib.stride_tricks.sliding_window_view(v[0], WINDOW)[at, ::-1]
                end[at + WINDOW - 1 - within.argmin(axis=1)] = True
        end[-1] = True
        return np.concatenate(([0], np.flatnonzero(end) + 1)), v

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sentence starts (in words, with the end), and of the least spans, in order: first sentence, sentence after, hashes (2, n)."""
        starts, v = self.sentences(text)
        k = len(starts) - 1
        after = np.maximum(np.arange(k) + 2, np.searchsorted(starts, starts[:-1] + self.least))
        from_ = np.minimum(np.arange(1, k + 1) - 2, np.searchsorted(starts, starts[1:] - self.least, "right") - 1)
        ahead, back = np.flatnonzero(after <= k), np.flatnonzero(from_ >= 0)
        spans = np.unique(np.concatenate((ahead * (k + 1) + after[ahead], from_[back] * (k + 1) + back + 1)))
        first, last = spans // (k + 1), spans % (k + 1)
        a, b = starts[first], starts[last]
        hashes = np.empty((2, len(spans)), "uint64")
        for i in range(2):
            sums = np.concatenate((np.zeros(1, "uint64"), np.cumsum(v[i] * self.up[i](v.shape[1]), dtype="uint64")))
            h = (sums[b] - sums[a]) * self.down[i](v.shape[1] + 1)[a] + (b - a).astype("uint64")
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            hashes[i] = h ^ (h >> np.uint64(32))
        return starts, first, last, hashes


def spans(docs: DataFrame, least_words: int) -> DataFrame:
    """(doc_id, number, hash, check): a row for each span."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Spans(least_words)
        for batch in batches:
            hashes = [of(t)[3] for t in batch.text]
            sizes = np.array([h.shape[1] for h in hashes], "int64")
            ids = np.repeat(batch.doc_id.to_numpy("int64"), sizes)
            numbers = np.concatenate([np.arange(n) for n in sizes] or [np.empty(0)])
            both = np.concatenate(hashes, axis=1).view("int64") if hashes else np.empty((2, 0), "int64")
            for at in range(0, len(ids), 100_000):
                part = slice(at, at + 100_000)
                yield pd.DataFrame({"doc_id": ids[part], "number": numbers[part].astype("int32"), "hash": both[0, part], "check": both[1, part]})

    return map_frames(docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL"), run, "doc_id long, number int, hash long, check long")


@tidy
def removals(docs: DataFrame, least_words: int) -> DataFrame:
    """(doc_id, gone): for each document that loses sentences, its spans (number, hash, check) that stand elsewhere first."""
    found = materialize(spans(docs, least_words), "spans")
    # written first, so that both joins below are plain ones whose hot keys Spark can split
    repeated = materialize(found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "repeated")
    places = materialize(found.join(repeated, "hash").select("hash", "check", "doc_id", "number"), "places")
    release(places)
    first = materialize(places.groupBy("hash", "check").agg(F.min(F.struct("doc_id", "number")).alias("first")), "first")
    later = places.join(first, ["hash", "check"]).where(F.struct("doc_id", "number") > F.col("first"))
    return materialize(later.groupBy("doc_id").agg(F.collect_list(F.struct("number", "hash", "check")).alias("gone")), "gone")


@tidy
def dedup_substrings(docs: DataFrame, least_words: int = 15) -> DataFrame:
    """docs' columns with text cleaned, and n_removed (sentences; a column of docs by this name comes first)."""
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.col("doc_id").alias("_id"), F.struct(*rest).alias("_row"), F.col("text").alias("_text"))
    gone = removals(docs, least_words)
    gone = gone.select(F.col("doc_id").alias("_gone_id"), *[F.col(f"gone.{c}").alias(f"_{c}s") for c in ("number", "hash", "check")])
    packed = rows.join(gone, F.col("_id") == F.col("_gone_id"), "left").select("_row", "_text", "_numbers", "_hashs", "_checks")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Spans(least_words)
        for batch in batches:
            texts, removed = [], []
            for text, *found in zip(batch._text, batch._numbers, batch._hashs, batch._checks):
                if found[0] is None:
                    texts.append(text)
                    removed.append(0)
                    continue
                starts, first, last, hashes = of(text)
                dropped = np.zeros(len(starts) - 1, bool)
                for number, *known in zip(*found):  # a row that shares the id may have another text
                    if number < len(first) and hashes[:, number].view("int64").tolist() == known:
                        dropped[first[number] : last[number]] = True
                if dropped.any():
                    at = [m.start() for m in _token.finditer(text)]
                    edges = [0, *(at[s] for s in starts[1:-1]), len(text)]
                    text = "".join(text[a:b] for a, b, d in zip(edges, edges[1:], dropped) if not d).strip()
                texts.append(text)
                removed.append(int(dropped.sum()))
            yield pd.DataFrame({"_row": batch._row, "text": pd.Series(texts, dtype=object), "n_removed": removed})

    kind = packed.schema["_row"].dataType.simpleString()
    out = map_frames(packed, run, f"_row {kind}, text string, n_removed int")
    return out.select(*[F.col("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns], "n_removed")
