"""Near-duplicate documents: a chosen-path similarity join on word shingles.

1. Each text becomes its set of hashed five-word shingles; the set becomes minwise tokens: PATHS of 32 bits for the tree and SKETCH of
   8 bits for comparison. Equal sets are one class from here on, so exact copies cost nothing.
2. Independent trees branch the classes: a node picks one or two of the path tokens (1 / threshold on average, so that a pair at the
   threshold is expected to stay together on one path), and sends each class to the child for its token there. A child with one class
   ends; one of at most LEAF is a leaf; a larger one branches again, up to LEVELS times, or DEEP times while it holds more than CROWD. A node's size
   comes from a count, so a large node is never gathered. Nodes that are large after that are crowded: they are cut into
   blocks by hash, and the smallest class of each block meets those of the others, in rounds, which holds near copies together; what that leaves
   apart is met in step 5.
3. In a leaf or block all pairs are compared by their sketches. Of the pairs that may reach the threshold (3.5 standard errors below it)
   it hands on a spanning forest, likeliest first: fewer pairs than classes. They are confirmed on the full sets, and the links make
   components.
4. An edge of a forest that fails may leave classes apart that another pair would link. The members of such groups
   that lie in different components meet once more with their full sets, group by group; no pair leaves the group but a link.
5. A crowded node whose classes do not all lie in one component by then is compared whole: its classes, in the order of
   their components, are cut into tiles, and every pair of tiles that holds two components meets, by sketches first and on full sets
   where those may reach the threshold. Near copies are one component and cost nothing here; the work is quadratic in classes that
   share most of a text without being near copies.

Recall: a pair at similarity 0.75 shares a path of three levels in one tree with a chance of about 0.6, in one of `trees` = 8 with
0.999, and its sketch passes with 0.9998; more similar pairs, more surely. In a node that takes all DEEP levels the first of these is
about 0.98.

Defined cases: null, empty and blank text has an empty set and links with nothing; repeated rows and equal sets link; rows that
share an id count as one document; a text of one to four words is one shingle; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.llm.common import bucketed, map_frames, materialize, release, tidy, whole_groups
from quorumtext.llm.components import components

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
PATHS, SKETCH, TREES, LEVELS, DEEP, LEAF, CROWD, BLOCK, TILE = 48, 256, 8, 3, 5, 16, 8192, 128, 256
KEPT_WORDS = 150_000
_RNG = np.random.default_rng(20240229)
MULTIPLIERS = _RNG.integers(1 << 31, size=PATHS + SKETCH, dtype="uint32") * np.uint32(2) + np.uint32(1)
MASKS = _RNG.integers(1 << 32, size=PATHS + SKETCH, dtype="uint32")


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words(dict):
    """word -> 64-bit hash, kept for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = h
        return h


def shingles(text: str | None, words: Words, width: int = 5) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not found:
        return np.empty(0, "uint64")
    h = np.fromiter(map(words.__getitem__, found), "uint64", len(found))
    width = min(width, len(h))
    n = len(h) - width + 1
    out = h[:n].copy()
    for k in range(1, width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
        out ^= out >> np.uint64(29)
    return np.unique(mixed(out + np.uint64(width)))


def minwise(hashes: np.ndarray) -> tuple[bytes, bytes]:
    """Path tokens and sketch of a set."""
    best = np.full(PATHS + SKETCH, np.iinfo("uint32").max, "uint32")
    short = (hashes >> np.uint64(32)).astype("uint32")
    for at in range(0, len(short), 1024):
        h = short[None, at : at + 1024] ^ MASKS[:, None]
        h *= MULTIPLIERS[:, None]
        h ^= h >> np.uint32(15)
        np.minimum(best, h.min(axis=1), out=best)
    return best[:PATHS].tobytes(), (mixed(best[PATHS:].astype("uint64")) >> np.uint64(56)).astype("uint8").tobytes()


def signed(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, key (of the set), path, sketch; the last three null if the set is empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.id, batch.text):
                s = shingles(text, words, width)
                rows.append((doc_id, len(s), *((hashlib.blake2b(s.tobytes(), digest_size=16).digest(), *minwise(s)) if len(s) else (None,) * 3)))
            yield pd.DataFrame(rows, columns=["id", "n_shingles", "key", "path", "sketch"])

    rows = map_frames(docs.select(F.col("doc_id").cast("string").alias("id"), "text"), run, "id string, n_shingles long, key binary, path binary, sketch binary")
    return rows.select(F.col("id").cast("long").alias("doc_id"), "n_shingles", "key", "path", "sketch")


def branched(rows: DataFrame, threshold: float) -> DataFrame:
    """(rep, nodes, path) -> (rep, node) of the children of each node."""
    odd = int((1 / threshold - 1) * 1000)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch.nodes.map(len).to_numpy()
            node = np.concatenate([*batch.nodes, np.empty(0, "int64")]).astype("int64").view("uint64")
            row = np.repeat(np.arange(len(batch)), sizes)
            path = np.frombuffer(b"".join(batch.path), "uint32").reshape(-1, PATHS)
            made, rep = [], batch.rep.to_numpy()
            for k in range(2):
                pick = mixed(node + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
                at = ((pick >> np.uint64(20)) % np.uint64(PATHS)).astype("int64")
                use = np.flatnonzero((pick % np.uint64(1000) < odd) & (at != first)) if k else np.arange(len(node))
                first, at = at, at[use]
                child = mixed(node[use] ^ mixed((path[row[use], at].astype("uint64") << np.uint64(8)) + at.astype("uint64") + np.uint64(1)))
                made.append(pd.DataFrame({"rep": rep[row[use]], "node": child.view("int64")}))
            yield pd.concat(made, ignore_index=True)

    return rows.select("rep", "nodes", "path").mapInPandas(run, "rep long, node long")


def forest(a: np.ndarray, b: np.ndarray, likeness: np.ndarray, sure: float) -> tuple[list[int], set[int]]:
    """Of the candidate pairs of a group: a spanning forest, likeliest first, and the members that its unsure edges may leave
    apart though another pair would link them."""
    parent = {int(v): int(v) for v in np.concatenate((a, b))}
    kept, parts = [], len(parent)
    order = np.lexsort((b, a, -likeness))
    split = int((likeness[order] >= sure).sum())

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(edges: np.ndarray) -> None:
        nonlocal parts
        for i in edges:
            if parts == 1:
                return
            x, y = find(int(a[i])), find(int(b[i]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                kept.append(int(i))
                parts -= 1

    join(order[:split])
    if parts == 1 or split == len(order):
        return kept, set()
    solid = {v: find(v) for v in parent}
    join(order[split:])
    chosen, open_ends = set(kept), set()
    for i in order[split:]:
        if int(i) not in chosen and solid[x := int(a[i])] != solid[y := int(b[i])]:
            open_ends |= {x, y}
    return kept, open_ends


def compared(rows: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Groups (keys, rep, n_shingles, sketch) of bounded size -> forest edges (a < b, group null) and members left open
    (a, b null, group)."""
    error = (threshold * (1 - threshold) / SKETCH) ** 0.5
    low, sure = threshold - 3.5 * error, threshold + 3 * error

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in whole_groups(batches, keys):
            rep, n = chunk.rep.to_numpy(), chunk.n_shingles.to_numpy()
            sketch = np.frombuffer(b"".join(chunk.sketch), "uint8").reshape(-1, SKETCH)
            group = chunk.groupby(keys, sort=False).ngroup().to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
            names = [f"{x}" for x in zip(*(chunk[k].to_numpy()[starts[:-1]].tolist() for k in keys))]
            found: list[tuple[np.ndarray, ...]] = []
            # each row against the one d places on, for all groups at once
            last = starts[1:][group] - 1
            for d in range(1, int(np.diff(starts).max(initial=1))):
                i = np.flatnonzero(np.arange(len(rep)) + d <= last)
                i = i[np.minimum(n[i], n[i + d]) >= threshold * np.maximum(n[i], n[i + d])]
                for at in range(0, len(i), 8192):
                    x = i[at : at + 8192]
                    like = ((sketch[x] == sketch[x + d]).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
                    ok = (like >= low) & (rep[x] != rep[x + d])
                    found.append((x[ok], x[ok] + d, like[ok]))
            if not found:
                continue
            x, y, like = (np.concatenate(z) for z in zip(*found))
            order = np.argsort(group[x], kind="stable")
            a, b, like, of = np.minimum(rep[x], rep[y])[order], np.maximum(rep[x], rep[y])[order], like[order], group[x][order]
            edges = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1], [True]))) if len(of) else []
            out: list[tuple] = []
            for at, to in zip(edges, edges[1:]):
                kept, left = forest(a[at:to], b[at:to], like[at:to], sure)
                out += [(int(a[at + k]), int(b[at + k]), None) for k in kept] + [(v, None, names[of[at]]) for v in sorted(left)]
            yield pd.DataFrame({"a": [r[0] for r in out], "b": pd.array([r[1] for r in out], "Int64"), "group": pd.Series([r[2] for r in out], dtype=object)})

    grouped = rows.repartition(*keys).sortWithinPartitions(*keys, "rep")
    return grouped.mapInPandas(run, "a long, b long, group string")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    # whether the wanted ids happen to be few must not change how texts move from one size to the next
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.distinct().hint("merge"), "doc_id", "left_semi")


def reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common) > 0


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold; where rows share an id, any of theirs."""
    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("doc_id")).join(texts, "doc_id").select("a", "b", "doc_id", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, last = Words(), (None, None, None)  # the set of a pair's first document stays for the next pair
        rows = (r for batch in batches for r in zip(batch.a, batch.b, batch.doc_id, batch.text))
        for _, some in groupby(enumerate(groupby(rows, key=lambda r: r[:2])), key=lambda x: x[0] // 1000):
            out = []
            for _, ((a, b), members) in some:
                sets: dict[int, list[np.ndarray]] = {a: [], b: []}
                for _, _, doc_id, text in members:
                    if doc_id != last[0] or text != last[1]:
                        found = shingles(text, words, width)
                        last = (a, text, found) if doc_id == a else last
                    else:
                        found = last[2]
                    sets[doc_id].append(found)
                if any(reaches(x, y, percent) for x in sets[a] for y in sets[b]):
                    out.append((a, b))
            yield pd.DataFrame(out, columns=["a", "b"])

    return ends.repartition("a", "b").sortWithinPartitions("a", "b", "doc_id").mapInPandas(run, "a long, b long")


def met(members: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Groups (group, a, component) of bounded size -> the links between different components, as a spanning forest."""
    rows = members.join(texts, F.col("a") == F.col("doc_id")).select("group", "a", "component", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        single = (r for batch in batches for r in zip(batch.group, batch.a, batch.component, batch.text))
        for _, some in groupby(single, key=lambda r: r[0]):
            ids, parts, sets = [], [], []
            for _, a, part, text in some:
                ids.append(a)
                parts.append(part)
                sets.append(shingles(text, words, width))
            sizes = np.array([len(s) for s in sets])
            values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            more = np.concatenate((values[1:] == values[:-1], [False]))
            more[1:] |= values[1:] == values[:-1]  # hashes of one set alone join nothing
            values, owner = values[more], owner[more]
            column = np.cumsum(np.concatenate(([0], values[1:] != values[:-1]))) if len(values) else np.empty(0, "int64")
            common = np.zeros((len(sets), len(sets)))
            for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
                has = np.zeros((len(sets), 4096), "float32")
                part = slice(*np.searchsorted(column, [at, at + 4096]))
                has[owner[part], column[part] - at] = 1
                common += has @ has.T
            linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
            root = {p: p for p in parts}
            out = []
            for i, j in zip(*np.nonzero(np.triu(linked, 1))):
                x, y = parts[i], parts[j]
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    return rows.repartition("group").sortWithinPartitions("group", "a").mapInPandas(run, "a long, b long")


def candidates(classes: DataFrame, threshold: float, trees: int) -> tuple[DataFrame, DataFrame | None]:
    """classes (rep, n_shingles, path, sketch; bucketed by rep) -> forest edges and open members of all leaves and blocks, and the
    members (node, rep) of the crowded nodes, if there are any."""
    roots = F.transform(F.sequence(F.lit(1), F.lit(trees)), lambda t: F.xxhash64(t))
    nodes, groups, crowded, most = classes.select("rep", roots.alias("nodes"), "path"), [], None, 0
    for level in range(1, DEEP + 1):
        children = materialize(branched(nodes, threshold), "nodes")
        sizes = materialize(children.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
        children = materialize(children.join(sizes, "node"), "nodes")
        largest = sizes.agg(F.max("size")).first()[0] or 0
        groups.append(children.where(F.col("size") <= LEAF).select(F.lit(level).alias("at"), "node", F.lit(0).cast("long").alias("block"), "rep"))
        stay = LEAF if level < LEVELS else max(LEAF, CROWD) if level < DEEP else largest
        if stay > LEAF and largest > LEAF:
            some = children.where(F.col("size").between(LEAF + 1, stay)).select("node", "rep", "size")
            crowded, most = some if crowded is None else crowded.unionByName(some), max(most, min(stay, largest))
        if largest <= stay:
            break
        nodes = children.where(F.col("size") > stay).select("rep", F.array("node").alias("nodes")).join(classes.select("rep", "path"), "rep")
    # blocks of a crowded node, then their smallest classes as members of the next round, until one block holds a node
    turned, turn = crowded, 0
    while most:
        cut = turned.withColumn("block", F.pmod(F.xxhash64("node", "rep", F.lit(turn)), F.ceil(F.col("size") / BLOCK)))
        groups.append(cut.select(F.lit(-1 - turn).alias("at"), "node", "block", "rep"))
        heads = cut.where(F.col("size") > BLOCK).groupBy("node", "block").agg(F.min("rep").alias("rep"), F.first("size").alias("size"))
        most, turn = -(-most // BLOCK) if most > BLOCK else 0, turn + 1
        if most:
            turned = materialize(heads.select("node", "rep", F.ceil(F.col("size") / BLOCK).alias("size")), "heads")
    met_in = groups[0]
    for g in groups[1:]:
        met_in = met_in.unionByName(g)
    rows = met_in.join(classes.select("rep", "n_shingles", "sketch"), "rep")
    return materialize(compared(rows, ["at", "node", "block"], threshold), "pairs"), crowded if crowded is None else crowded.select("node", "rep")


def apart_in_tiles(crowded: DataFrame, classes: DataFrame, named: DataFrame, threshold: float) -> DataFrame:
    """Members (node, rep) of large nodes -> groups (group, a, component) of bounded size that hold every pair of a node's classes in
    different components whose sketches may reach the threshold."""
    low = threshold - 3.5 * (threshold * (1 - threshold) / SKETCH) ** 0.5
    members = crowded.join(named.withColumnRenamed("v", "rep"), "rep", "left").select("node", "rep", F.coalesce("component", "rep").alias("component"))
    members = materialize(members, "members")
    spread = members.groupBy("node").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most").select("node")
    rows = members.join(materialize(spread, "apart"), "node").join(classes.select("rep", "n_shingles", "sketch"), "rep")

    def tiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in whole_groups(batches, ["node", "band"]):
            for (node, _), some in chunk.groupby(["node", "band"], sort=False):
                for at in range(0, len(some), TILE):
                    t = some.iloc[at : at + TILE]
                    yield pd.DataFrame({"node": [node], "tile": [int(t.rep.iloc[0])], "low": [t.component.min()], "high": [t.component.max()], "reps": [t.rep.to_numpy()], "parts": [t.component.to_numpy()], "sizes": [t.n_shingles.to_numpy()], "sketches": [b"".join(t.sketch)]})

    # a partition holds some neighbours of a node's order, in bands that are not more rows than a batch or two
    ordered = rows.repartitionByRange("node", "component", "rep").sortWithinPartitions("node", "component", "rep")
    banded = ordered.withColumn("band", F.floor(F.monotonically_increasing_id() / (4 * TILE)))
    payload = "reps array<long>, parts array<long>, sizes array<long>, sketches binary"
    tiles = materialize(banded.select("node", "band", "rep", "component", "n_shingles", "sketch").mapInPandas(tiled, f"node long, tile long, low long, high long, {payload}"), "tiles")
    a, b = (tiles.select("node", *[F.col(c).alias(f"{c}_{x}") for c in ("tile", "low", "high")]) for x in "ab")
    pairs = a.join(b, "node").where("tile_a <= tile_b AND least(low_a, low_b) < greatest(high_a, high_b)").select("node", "tile_a", "tile_b")
    for x in "ab":
        side = tiles.select("node", *[F.col(c).alias(f"{c}_{x}") for c in ("tile", "reps", "parts", "sizes", "sketches")])
        pairs = pairs.join(side, ["node", f"tile_{x}"])

    def met_by_sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                x, y = (np.frombuffer(s, "uint8").reshape(-1, SKETCH) for s in (r.sketches_a, r.sketches_b))
                near = np.zeros((len(x), len(y)), bool)
                for i in range(len(x)):
                    j = np.flatnonzero((r.parts_b != r.parts_a[i]) & (np.minimum(r.sizes_b, r.sizes_a[i]) >= threshold * np.maximum(r.sizes_b, r.sizes_a[i])))
                    near[i, j] = ((y[j] == x[i]).mean(axis=1) - 1 / 256) / (1 - 1 / 256) >= low
                one = {int(v): int(p) for v, p in zip(r.reps_a[near.any(axis=1)], r.parts_a[near.any(axis=1)])}
                one |= {int(v): int(p) for v, p in zip(r.reps_b[near.any(axis=0)], r.parts_b[near.any(axis=0)])}
                if one:
                    yield pd.DataFrame({"group": f"{r.node}/{r.tile_a}/{r.tile_b}", "a": list(one), "component": list(one.values())})

    return pairs.mapInPandas(met_by_sketch, "group string, a long, component long")


@tidy
def near_duplicates(docs: DataFrame, threshold: float = 0.75, width: int = 5, trees: int = TREES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id linked to it, over any number of links), kept."""
    percent = round(threshold * 100)
    sets = materialize(signed(docs, width), "sets")
    firsts = [F.first(c).alias(c) for c in ("n_shingles", "path", "sketch")]
    classes = sets.where("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"), *firsts)
    classes = bucketed(classes.drop("key"), "rep", "classes")
    found, crowded = candidates(classes, threshold, trees)
    release(*[x for x in (sets, classes, found, crowded) if x is not None])
    pairs = materialize(found.where("b IS NOT NULL").select("a", "b").distinct(), "pairs")
    links = materialize(confirmed(pairs, texts_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))), percent, width).distinct(), "links")
    named = components(links.toDF("u", "v"))
    left = found.where("b IS NULL").select("group", "a")
    members = left.join(named.select(F.col("v").alias("a"), "component"), "a", "left").select("group", "a", F.coalesce("component", "a").alias("component"))
    members = materialize(members, "members")
    apart = members.groupBy("group").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most").select("group")
    open_groups = members.join(materialize(apart, "apart"), "group")
    if crowded is not None:
        open_groups = open_groups.unionByName(apart_in_tiles(crowded, classes, named, threshold))
    open_groups = materialize(open_groups, "open")
    if not open_groups.isEmpty():
        more = materialize(met(open_groups, texts_of(docs, open_groups.select(F.col("a").alias("doc_id"))), percent, width).distinct(), "links")
        if not more.isEmpty():
            named = components(links.unionByName(more).toDF("u", "v"))
    reps = sets.where("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"))
    reps = materialize(reps.join(named.withColumnRenamed("v", "rep"), "rep", "left").select("key", F.coalesce("component", "rep").alias("component")), "names")
    out = sets.select("doc_id", "n_shingles", "key").join(reps, "key", "left")
    component = F.coalesce("component", "doc_id")
    return materialize(out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")), "components")


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')] ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
r AS (SELECT doc_id AS v, doc_id AS c FROM w UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.v)
SELECT r.v AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id, min(c) = r.v AS kept FROM r LEFT JOIN n ON n.doc_id = r.v GROUP BY r.v
"""
