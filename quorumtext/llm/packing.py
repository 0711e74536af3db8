"""Packing documents into fixed-length token sequences: shortest-pack-first over the length histogram.

A document's ids, with a separator after them, are cut at every `room` tokens; whole pieces fill a sequence each and the
rest, shorter than that, is packed. The histogram of rests has at most `room` bins whatever the corpus, so it is packed on
the driver: lengths longest first, each onto the packs with the most room, as counts of equal packs (patterns), never pack by
pack. Each length splits at most one pattern and opens two, so there are at most 3 * room patterns. A piece finds its
place by its rank among the pieces of its length; ranks come from (length, bucket) totals, so one common length is spread
over many groups.

Defined cases: null text is empty, an empty document is its separator alone; repeated rows are documents each; an empty table
has no sequences; very long documents are many pieces; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumtext.llm.common import map_frames, materialize, tidy

#: Pieces for which a length is spread over 1024 buckets; more pieces, more buckets.
BUCKETED = 1 << 27
#: Pre-tokenization pattern of byte-level BPE: fixed value of the public format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level BPE writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(2)
def encoder(file: bytes):
    """text list -> id lists of the tokenizer that a file holds.

    The merge engine of tiktoken gives the same ids several times as fast; texts that hold an added token or letters
    beyond Latin, where the two libraries' Unicode tables might differ, go to tokenizers itself.
    """
    spec = json.loads(file)
    before = spec["pre_tokenizer"] or {}
    usual = spec["model"]["type"] == "BPE" and not spec["normalizer"] and before.get("type") == "ByteLevel" and not before["add_prefix_space"]
    added = [t["content"] for t in spec["added_tokens"]]
    if not usual:
        return lambda texts: [e.ids for e in _exact(file).encode_batch_fast(texts, add_special_tokens=False)]
    import tiktoken

    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
    fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = re.compile("|".join([*map(re.escape, added), "[^\\x00-ɏ‐-‧€]"]))
    return lambda texts: [_exact(file).encode(t, add_special_tokens=False).ids if odd.search(t) else fast.encode_ordinary(t) for t in texts]


@lru_cache(2)
def _exact(file: bytes):
    from tokenizers import Tokenizer

    return Tokenizer.from_buffer(file)


def cut(docs: DataFrame, vocabulary: str, room: int = 1024, separator: int = 0, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece (0, 1, ..), start, length, ids_crc32, doc_tokens, with keep_ids also ids. Only the driver
    opens the vocabulary's file."""
    if room < 1:
        raise ValueError("room must be 1 or more")
    with open(vocabulary, "rb") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(file.value)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.doc_id, batch.text):
                ids = np.array([*encode([text or ""])[0], separator], "<u4")
                for k, at in enumerate(range(0, len(ids), room)):
                    part = ids[at : at + room]
                    rows.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes()), len(ids), *([part.astype("i4")] if keep_ids else [])))
            yield pd.DataFrame(rows, columns=names)

    schema = "doc_id long, piece long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    names = [x.split()[0] for x in schema.split(", ")]
    return map_frames(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), pieces, schema)


def shortest_pack_first(histogram: dict[int, int], room: int) -> list[tuple[int, list[int]]]:
    """Patterns (how many sequences, lengths in them) for a histogram of lengths from 1 to room.

    Longest lengths first; each goes onto the shortest packs, all packs of a pattern at once. Where it fits on none, new
    packs hold as many of it as go in.
    """
    packs: list[tuple[int, int, int, list[int]]] = []  # length so far, order of making, how many, parts; shortest on top
    made = 0

    def push(used: int, count: int, parts: list[int]) -> None:
        nonlocal made
        made += 1
        heapq.heappush(packs, (used, made, count, parts))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 1 <= length <= room:
            raise ValueError(f"length {length} is not from 1 to {room}")
        while left and packs and packs[0][0] + length <= room:
            used, _, count, parts = heapq.heappop(packs)
            fit = min(count, left)
            if fit < count:
                push(used, count - fit, parts)
            push(used + length, fit, [*parts, length])
            left -= fit
        each = room // length
        for count, of in ((left // each, each), (1 if left % each else 0, left % each)):
            if count:
                push(of * length, count, [length] * of)
    return [(count, parts) for _, _, count, parts in sorted(packs)]


def slots(patterns: list[tuple[int, list[int]]]) -> pd.DataFrame:
    """Where the pieces of each length go, by rank: length, first (rank), sequence (of that rank), offset; sorted."""
    rows, taken, sequence = [], {}, 0
    for count, parts in patterns:
        offset = 0
        for length in parts:
            first = taken.get(length, 0)
            rows.append((length, first, sequence, offset))
            taken[length] = first + count
            offset += length
        sequence += count
    return pd.DataFrame(rows, columns=["length", "first", "sequence", "offset"], dtype="int64").sort_values(["length", "first"], ignore_index=True)


@tidy
def pack(docs: DataFrame, vocabulary: str, room: int = 1024, separator: int = 0, keep_ids: bool = False) -> DataFrame:
    """One row per piece, with sequence_id and offset; rows of a sequence are gapless from 0 and add up to room at most."""
    parts = materialize(cut(docs, vocabulary, room, separator, keep_ids), "pieces")
    buckets = 1024 * (parts.count() // BUCKETED + 1)
    parts = parts.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "ids_crc32", "piece"), F.lit(buckets)))
    totals = materialize(parts.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r.length: r.n for r in totals.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # room rows at most
    whole = histogram.pop(room, 0)
    table = slots(([(whole, [room])] if whole else []) + shortest_pack_first(histogram, room))
    columns = {c: table[c].to_numpy() for c in table}
    # pieces of a length ahead of a bucket, in two steps, so that a length with many pieces is no large window
    before = lambda *keys: F.coalesce(F.sum("n").over(Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.withColumn("shelf", (F.col("bucket") / 32).cast("int"))
    shelves = totals.groupBy("length", "shelf").agg(F.sum("n").alias("n")).select("length", "shelf", before("length", "shelf").alias("below"))
    offsets = totals.withColumn("beside", before("length", "shelf", "bucket")).join(shelves, ["length", "shelf"])
    offsets = materialize(offsets.select("length", "bucket", (F.col("below") + F.col("beside")).alias("ahead")), "offsets")
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "ids_crc32", "start")
    ranked = parts.join(offsets, ["length", "bucket"]).withColumn("rank", F.col("ahead") + F.row_number().over(within) - 1).drop("bucket", "ahead")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        edges = np.searchsorted(columns["length"], np.arange(room + 2))
        for batch in batches:
            length, rank = batch["length"].to_numpy("int64"), batch["rank"].to_numpy("int64")
            at = np.empty(len(batch), "int64")
            for n in np.unique(length):
                at[mine] = edges[n] + np.searchsorted(columns["first"][edges[n] : edges[n + 1]], rank[mine := length == n], "right") - 1
            yield batch.drop(columns="rank").assign(sequence_id=columns["sequence"][at] + rank - columns["first"][at], offset=columns["offset"][at])

    schema = ", ".join(f"{c} {t}" for c, t in ranked.dtypes if c != "rank") + ", sequence_id bigint, offset bigint"
    return map_frames(ranked, place, schema, rows=8192)
