import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumtext.llm import common, components, embeddings, htmltext, langid, mixing, neardup, packing, substrings, syncmers, tokens, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, langs=None, sources=None, ids=None):
    n = len(texts)
    rows = list(zip(ids or range(n), texts, langs or ["en"] * n, sources or ["s"] * n, [len(t or "") for t in texts]))
    return spark.createDataFrame(rows, DOCS)


def words(r, n, kinds=400):
    return " ".join(f"w{r.randint(0, kinds)}" for _ in range(n))


ODD = [None, "", " \n\t", "a", "one two three", "x" * 30_000, "long " * 20_000, "same text here with some words", "same text here with some words", "ünïcödé 漢字 😀 é", "a\x00b"]


def odd(spark):
    """Nulls, empties, very long texts, ties, repeated rows (id and all), a null id, and columns with names that operators use themselves."""
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 2 else "s", None) for i, t in enumerate(ODD)] + [(7, ODD[7], "en", "s", 5), (None, "no id", "en", "s", 5)]
    named = {c: F.lit(1) for c in ("id", "row", "key", "rank", "size", "copies", "position", "group", "n", "component", "gone", "_row", "_text", "hash", "bucket", "order", "sequence_id", "target", "before", "_id", "_gone")}
    return spark.createDataFrame(rows, DOCS).withColumns(named)


# Components


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + k) for k in range(1, 80)] + [(r.randint(2000, 2200), r.randint(2000, 2200)) for _ in range(150)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {v: find(v) for v in parent if find(v) != v}
    got = {x.v: x.component for x in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# 1. Mixing


def plain_targets(sizes, weights, total):
    """Resharing the excess until no source is above its cap."""
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    rest = total
    while open_:
        whole = sum(weights[s] for s in open_)
        over = {s for s in open_ if rest * weights[s] / whole > 2 * sizes[s]}
        if not over:
            return target | {s: rest * weights[s] / whole for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        open_ -= over
    return target


def test_mix_against_plain_resharing(spark):
    r = random.Random(4)
    texts, sources = [words(r, r.randint(0, 60)) for _ in range(300)], [r.choice(["a", "b", "b", "c", "d", None]) for _ in range(300)]
    rows = mixing.mix(docs(spark, texts, sources=sources)).collect()
    sizes = defaultdict(int)
    for t, s in zip(texts, sources):
        sizes[s] += len(t.split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = plain_targets(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    taken = defaultdict(int)
    for x in rows:
        taken[x.source] += x.taken
        assert x.size == len(texts[x.doc_id].split()) and 0 <= x.taken <= 2 * x.size and x.source_size == sizes[x.source] and x.target == pytest.approx(want[x.source])
    assert {s: abs(taken[s] - want[s]) <= 0.5 for s in sizes} == dict.fromkeys(sizes, True)
    again = mixing.mix(docs(spark, texts, sources=sources).repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_positions_invert_the_schedule(spark):
    schedule = ((0.0, 3.0), (0.5, 1.0), (1.0, 4.0))
    got = spark.range(101).withColumn("rank", F.lit(0)).select((F.col("id") / 100).alias("q"), mixing._position(F.col("id") / 100, [schedule]).alias("t")).collect()
    grid = np.linspace(0, 1, 20_001)
    weight = np.interp(grid, *zip(*schedule))
    used = np.concatenate(([0], np.cumsum((weight[1:] + weight[:-1]) / 2 * np.diff(grid))))
    for x in got:
        assert x.t == pytest.approx(np.interp(x.q, used / used[-1], grid), abs=1e-3)
    with pytest.raises(ValueError):
        mixing.integrate(((0.0, 1.0), (0.0, 1.0)))


def test_training_order_repeats_whole_documents(spark):
    r = random.Random(1)
    d = docs(spark, [words(r, 20) for _ in range(200)], sources=[r.choice("ab") for _ in range(200)])
    plan = {x.doc_id: x.copies for x in mixing.mix(d).collect()}
    rows = mixing.training_order(d).collect()
    assert Counter(x.doc_id for x in rows) == Counter({k: v for k, v in plan.items() if v}) and rows[0].asDict().keys() == set(d.columns)


@pytest.mark.parametrize("parts", [1, 7])
def test_rows_without_or_with_shared_ids_have_their_own_place(spark, parts):
    import hashlib

    r = random.Random(5)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, words(r, r.randint(1, 40)), "en", r.choice(["a", "b", None]), i) for i in range(300)]
    d = spark.createDataFrame(rows, DOCS).repartition(parts)
    ties = {x.n_chars: x for x in mixing._sized(d, "n_chars").collect()}
    streams, size = defaultdict(list), defaultdict(int)
    for x in rows:
        t = ties[x[4]]
        assert x[0] is None or t.order == hashlib.md5(str(x[0]).encode()).hexdigest()
        streams[x[3]].append(((t.order, x[0] or 0, t.size, t.tie), len(x[1].split()), x[4]))
        size[x[3]] += len(x[1].split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    target = plain_targets(size, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(size.values()))
    grid, want = np.linspace(0, 1, 20_001), {}
    for k, source in enumerate(order):
        weight = np.interp(grid, *zip(*mixing.SCHEDULES[k % 3]))
        used = np.concatenate(([0], np.cumsum((weight[1:] + weight[:-1]) / 2 * np.diff(grid))))
        at = 0
        for turn in range(2):
            for _, n, row in sorted(streams[source]):
                if at + n / 2 < np.floor(target[source] + 0.5):
                    want[row, turn] = np.interp(min(1, (at + n / 2) / target[source]), used / used[-1], grid)
                at += n
    got = [x.n_chars for x in mixing.training_order(d).collect()]
    assert Counter(got) == Counter(row for row, _ in want)
    turn: Counter = Counter()
    places = []
    for row in got:
        places.append(want[row, turn[row]])
        turn[row] += 1
    assert all(b >= a - 2e-4 for a, b in zip(places, places[1:])) and places[-1] - places[0] > 0.9


# 2. Token counts


def test_counts_are_those_of_the_tokenizer(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = tokens.load_pieces(public.path("piece_bpe_32k.model"))
    r = random.Random(6)
    texts = ["", " ", "  a", "a  b ", "\n", "漢字 かな", "😀😀 a", "<unk> <s></s> <0x41>", "▁a ▁", "a" * 300] + ["".join(r.choice("ab ▁<>0xéß漢\n. th") for _ in range(r.randint(0, 40))) for _ in range(300)]
    for fallback in (True, False):
        exact = Tokenizer(models.Unigram(pieces, 0, fallback))
        exact.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
        counter = tokens.Counter(pieces, fallback)
        assert [counter.total(t) for t in texts] == [len(exact.encode(t, add_special_tokens=False).ids) for t in texts]
    ties = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("▁ab", -3.0), ("ba", -2.0)]
    exact = Tokenizer(models.Unigram(ties, 0, False))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    small = ["".join(r.choice("ab c") for _ in range(r.randint(0, 12))) for _ in range(300)]
    counter = tokens.Counter(ties, False)
    assert [counter.total(t) for t in small] == [len(exact.encode(t, add_special_tokens=False).ids) for t in small]
    out = {x.doc_id: x.n_tokens for x in tokens.count_tokens(docs(spark, [None, "ab a"]), ties, False).collect()}
    assert out == {0: 0, 1: counter.total("ab a")}


# 3. Packing


def test_patterns_hold_the_histogram():
    r = random.Random(3)
    for n in (0, 1, 30, 3000):
        h = Counter(r.choice([r.randint(1, 1023), r.randint(1, 200), 77]) for _ in range(n))
        patterns = packing.shortest_pack_first(h, 1024)
        got = Counter()
        for count, parts in patterns:
            assert sum(parts) <= 1024
            got.update({x: 0 for x in parts})
            for x in parts:
                got[x] += count
        assert got == h and len(patterns) <= 3 * 1024
    assert sum(k * v for k, v in h.items()) / (sum(c for c, _ in patterns) * 1024) > 0.98


def test_pack_round_trip(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    file = public.path("byte_bpe_50k.json")
    exact = Tokenizer.from_file(file)
    r = random.Random(8)
    texts = [words(r, r.randint(0, 900)) for _ in range(60)] + ["<|endoftext|> a", "漢字 naïve ‘x’", None, "", "", "x" * 5000]
    rows = packing.pack(docs(spark, texts), file, 1024, keep_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for x in rows:
        by_doc[x.doc_id].append(x)
        by_sequence[x.sequence_id].append(x)
    for i, t in enumerate(texts):
        parts = sorted(by_doc[i], key=lambda x: x.start)
        ids = [*exact.encode(t or "", add_special_tokens=False).ids, 0]
        assert [k for x in parts for k in x.ids] == ids and [x.start for x in parts] == list(np.cumsum([0] + [x.length for x in parts[:-1]]))
        assert all(x.ids_crc32 == zlib.crc32(np.array(x.ids, "<u4").tobytes()) and x.doc_tokens == len(ids) for x in parts)
    for parts in by_sequence.values():
        parts.sort(key=lambda x: x.offset)
        assert [x.offset for x in parts] == list(np.cumsum([0] + [x.length for x in parts[:-1]])) and sum(x.length for x in parts) <= 1024
    assert sorted(by_sequence) == list(range(len(by_sequence)))


# 4. Near duplicates


def plain_components(texts):
    sets = []
    for t in texts:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)})
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [find(i) for i in range(len(sets))]


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(11)
    texts = [None, "", " ", "a b c", "A b C", "a b"]
    for _ in range(40):
        base = words(r, r.randint(5, 200), 5000).split()
        for _ in range(r.randint(1, 6)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 30))):
                w[r.randrange(len(w))] = "edit"
            texts.append(" ".join(w))
    base = words(r, 150, 5000).split()  # a group larger than a leaf and a block, near the threshold
    for _ in range(300):
        w = list(base)
        for _ in range(r.randint(1, 4)):
            w[r.randrange(len(w))] = f"e{r.randint(0, 10**6)}"
        texts.append(" ".join(w))
    sizes, want = plain_components(texts)
    rows = sorted(neardup.near_duplicates(docs(spark, texts)).collect(), key=lambda x: x.doc_id)
    assert [x.n_shingles for x in rows] == sizes and [x.component_id for x in rows] == want and [x.kept for x in rows] == [c == i for i, c in enumerate(want)]


def test_forest_keeps_what_an_unsure_edge_may_part():
    a, b = np.array([1, 1, 2]), np.array([2, 3, 3])
    kept, left = neardup.forest(a, b, np.array([0.9, 0.8, 0.7]), 0.85)
    assert kept == [0, 1] and left == {2, 3}
    assert neardup.forest(a, b, np.array([0.9, 0.9, 0.9]), 0.85) == ([0, 1], set())


@pytest.mark.parametrize("crowd", [8192, 64])
def test_large_family_of_a_template_is_compared_whole(spark, monkeypatch, crowd):
    # strangers share 0.72 of their shingles, each text and its one partner about 0.8; blocks far smaller than the family
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "TILE", 32)
    monkeypatch.setattr(neardup, "CROWD", crowd)
    template = [f"t{k}" for k in range(364)]
    own = lambda i, n: [f"o{i}x{k}" for k in range(n)]
    texts = [" ".join(template + own(f"p{i // 2}", 22) + own(i, 48)) for i in range(500)]
    sets = [set(neardup.shingles(t, neardup.Words()).tolist()) for t in texts[:3]]
    like = lambda x, y: len(x & y) / len(x | y)
    assert like(sets[0], sets[1]) > 0.78 and 0.7 < like(sets[0], sets[2]) < 0.74
    got = {x.doc_id: x.component_id for x in neardup.near_duplicates(docs(spark, texts)).collect()}
    assert all(c in (i, i - i % 2) for i, c in got.items())
    assert sum(got[i] == i - 1 for i in range(1, 500, 2)) >= 0.99 * 250


# 5. Embeddings


def plain_vectors(rows, threshold=0.98):
    """rows: vec_id -> (vector, label) -> (links, smallest id reached, kept), by all pairs."""
    good = {i: np.array(v, "float64") for i, (v, label) in rows.items() if label is not None and v and None not in v and np.isfinite(np.array(v, "float64")).all() and any(v)}
    n, parent = Counter(), {i: i for i in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in good:
        for j in good:
            if i < j and rows[i][1] == rows[j][1] and len(good[i]) == len(good[j]) and good[i] @ good[j] / np.linalg.norm(good[i]) / np.linalg.norm(good[j]) >= threshold:
                n[i] += 1
                n[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (n[i], find(i), find(i) == i) for i in rows}


def vectors_of_many_lengths(r):
    rows = []
    for k in range(60):
        base = r.normal(size=(16, 16, 3, 5, 1)[k % 5])
        rows += [(base + r.normal(size=len(base)) * 0.05 * r.random(), int(k % 2)) for _ in range(int(r.integers(1, 8)))]
    rows = [([float(x) for x in v], label) for v, label in rows]
    rows += [(rows[0][0], 0)] * 3 + [([2 * x for x in rows[0][0]], 0), (None, 0), ([0.0] * 16, 0), ([float("nan")] * 16, 0), ([float("inf")] * 16, 0), (rows[0][0], None), ([None] * 16, 0), ([1.0], 0), ([], 1)]
    return rows + [([0.5, -0.0], 1), ([0.5, 0.0], 1), ([1.0, 0.1], 1), ([1e30, 1e29], 1)]


@pytest.mark.parametrize("kind, tile, axes", [("float", 1024, 1 << 22), ("double", 4, 1 << 22), ("float", 7, 20)])
def test_near_vectors_against_all_pairs(spark, monkeypatch, kind, tile, axes):
    monkeypatch.setattr(embeddings, "TILE", tile)
    monkeypatch.setattr(embeddings, "AXES", axes)
    rows = vectors_of_many_lengths(np.random.default_rng(5))
    df = spark.createDataFrame([(i, v, label) for i, (v, label) in enumerate(rows)], f"vec_id long, embedding array<{kind}>, label int").withColumn("key", F.lit(1))
    want = plain_vectors({x.vec_id: (x.embedding, x.label) for x in df.collect()})
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in embeddings.near_vectors(df).collect()}
    assert got == want and sum(x[0] for x in want.values()) > 200
    assert embeddings.near_vectors(df.where("vec_id < 0")).count() == 0


def test_only_near_tiles_meet(spark):
    """Of all pairs of tiles, few are left to compare."""
    r, width = np.random.default_rng(8), (2 - 2 * 0.98) ** 0.5

    def pairs(clusters):
        centers = r.normal(size=(clusters, 8))
        rows = [(int(k * 32 + i), (centers[k] + r.normal(size=8) * 0.02).astype("float32").tobytes()) for k in range(clusters) for i in range(32)]
        classes = spark.createDataFrame(rows, "rep long, v binary").selectExpr("0 AS label", "8 AS size", "rep", "1L AS copies", "v")
        axes = spark.sparkContext.broadcast(embeddings.principal_axes(classes, "float32"))
        tiles = embeddings.tiles_of(classes, axes, "float32", width)
        return tiles.count(), embeddings.tile_pairs(tiles, width).count()

    with pytest.MonkeyPatch.context() as m:
        m.setattr(embeddings, "TILE", 32)
        tiles, met = pairs(320)
    assert tiles >= 320 and tiles < met < 0.1 * tiles * (tiles + 1) / 2


def test_tiles_drop_no_pair():
    r = np.random.default_rng(1)
    x = r.normal(size=(200, 40))
    x[100:] = x[:100] + r.normal(size=(100, 40)) * 0.12
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = embeddings.compare_tiles(x, x, 0.98, True)
    exact = {(a, b) for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.98, 1)))}
    assert exact <= set(zip(i, j)) and len(exact) > 20


# 6. Language


def test_language(spark):
    r = random.Random(3)
    make = {"en": "the of and to in that with", "de": "der die und nicht auf für über", "fr": "le la et que dans être é"}
    texts, langs = [], []
    for _ in range(120):
        lang = r.choice(list(make))
        texts.append(" ".join(r.choice(make[lang].split()) for _ in range(r.randint(3, 30))))
        langs.append(lang)
    texts += [None, "", "123 !?"]
    langs += ["en", None, "de"]
    d = docs(spark, texts, langs)
    held_out = common.fold("doc_id", 5) == 0
    got = {x.doc_id: x for x in langid.identify(d, ~held_out).collect()}
    assert sum(got[i].lang_pred == langs[i] for i in range(120)) >= 118 and all(0 <= x.score <= 1 for x in got.values())
    assert [got[i].lang_pred for i in (120, 121, 122)] == ["und"] * 3
    assert {x.lang_pred for x in langid.identify(d, F.lit(False)).collect()} == {"und"}
    # labels of held-out rows are no input
    other = d.withColumn("lang", F.when(held_out, "xx").otherwise(F.col("lang")))
    assert {x.doc_id: x.lang_pred for x in langid.identify(other, ~held_out).collect()} == {i: x.lang_pred for i, x in got.items()}


def plain_grams(text, longest, buckets):
    letters = "".join(c.lower() if c.isalpha() else " " for c in text or "")
    codes = [0 if c == " " else ord(c) for c in " " + " ".join(letters.split()) + " "]
    for at in range(len(codes)):
        h = 0
        for n in range(1, min(longest, len(codes) - at) + 1):
            h = (h ^ codes[at + n - 1]) * 0x9E3779B1 & 0xFFFFFFFF
            h ^= h >> 15
            yield ((h + n * 0x85EBCA6B) & 0xFFFFFFFF) % buckets


@pytest.mark.parametrize("block", [64, 1 << 16])
def test_language_against_plain_bayes(spark, monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    r, buckets, longest = random.Random(31), 512, 3
    texts = ["".join(r.choice("abcdé Éß. \n漢") for _ in range(r.randint(0, 60))) for _ in range(150)] + [None, "", "...", "a", "ab " * 500]
    langs = [r.choice(["x", "y", "z", None]) for _ in texts]
    d = docs(spark, texts, langs)
    held_out = common.fold("doc_id", 5) == 0
    got = {x.doc_id: x for x in langid.identify(d, ~held_out, buckets=buckets, longest=longest).collect()}
    counts = {k: np.ones(buckets) for k in "xyz"}
    for i, (t, lang) in enumerate(zip(texts, langs)):
        if lang and zlib.crc32(str(i).encode()) % 5 and any(c.isalpha() for c in t or ""):
            for g in plain_grams(t, longest, buckets):
                counts[lang][g] += 1
    logs = {k: np.log(c / c.sum()).astype("float32").astype("float64") for k, c in counts.items()}
    for i, t in enumerate(texts):
        if not any(c.isalpha() for c in t or ""):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        total = {k: sum(logs[k][g] for g in plain_grams(t, longest, buckets)) for k in "xyz"}
        best = max(sorted(total), key=total.get)
        assert got[i].lang_pred == best and got[i].score == pytest.approx(1 / sum(np.exp(v - total[best]) for v in total.values()), rel=1e-6)


# 7. Substrings


def plain_sentences(text):
    """Lists of words, by reading word after word; long sentences are cut after the least hash of each window."""
    import xxhash

    out = []
    for line in (text or "").split("\n"):
        now = []
        for w in re.findall(r"[^\x20\x09-\x0D]+", line):
            now.append(w)
            if re.search(r"""[.!?…。！？]["'”’»)\]}]*$""", w):
                out.append(now)
                now = []
        out += [now] if now else []
    cut = []
    for sentence in out:
        h = [xxhash.xxh3_128_intdigest(w.encode()) % (1 << 64) for w in sentence]
        ends = {len(sentence) - 1} | {max(range(at, at + 10), key=lambda i: (-h[i], i)) for at in range(len(h) - 9)}
        for i, w in enumerate(sentence):
            if i == 0 or i - 1 in ends:
                cut.append([])
            cut[-1].append(w)
    return cut


def plain_substrings(texts, least):
    """Every run of two or more sentences and least words: what lies in one that stands before, in this text or another, goes."""
    first, all_runs, out = {}, [], []
    for i, t in enumerate(texts):
        sents = plain_sentences(t)
        runs = [(a, b, tuple(w for s in sents[a:b] for w in s)) for a in range(len(sents)) for b in range(a + 2, len(sents) + 1)]
        all_runs.append((sents, [x for x in runs if len(x[2]) >= least]))
        for a, b, key in all_runs[-1][1]:
            first[key] = min(first.get(key, (i, a)), (i, a))
    for i, (sents, runs) in enumerate(all_runs):
        drop = [False] * len(sents)
        for a, b, key in runs:
            if first[key] != (i, a):
                drop[a:b] = [True] * (b - a)
        out.append(([w for s, d in zip(sents, drop) if not d for w in s], sum(drop)))
    return out


def test_substrings_against_every_run(spark):
    r = random.Random(9)
    sentence = lambda: words(r, r.randint(1, 9), 10_000) + r.choice([".", "!", "?", "\n", ",", '."', "?)", ""])
    passages = [" ".join(sentence() for _ in range(r.randint(3, 12))) for _ in range(8)] + [words(r, 60, 10_000)]
    texts = [None, "", "one", passages[0]] + [" ".join([sentence(), sentence(), r.choice(passages), sentence()] if r.random() < 0.6 else [sentence() for _ in range(9)]) for _ in range(80)]
    texts += [texts[20], passages[1] + " " + passages[1], "漢字。 かな！ " * 12, "same word " * 30, "x"]
    rows = sorted(substrings.dedup_substrings(docs(spark, texts), 15).collect(), key=lambda x: x.doc_id)
    want = plain_substrings(texts, 15)
    assert [((x.text or "").split(), x.n_removed) for x in rows] == want and rows[0].text is None
    assert all(x.text == t for x, t, (_, n) in zip(rows, texts, want) if not n) and sum(n for _, n in want) > 100


def test_passages_without_punctuation_always_lose_a_span(spark):
    r = random.Random(19)
    passages = [words(r, 51, 100_000) for _ in range(100)]
    host = lambda p: f"{words(r, r.randint(5, 40), 100_000)} {p} {words(r, r.randint(5, 40), 100_000)}"
    texts = [host(p) for p in passages] + [host(p) for p in passages]
    rows = sorted(substrings.dedup_substrings(docs(spark, texts)).collect(), key=lambda x: x.doc_id)
    lost = [len(t.split()) - len(x.text.split()) for t, x in zip(texts, rows)]
    assert not any(lost[:100]) and min(lost[100:]) >= 15 and sum(lost[100:]) > 30 * 100


# 8. HTML


def test_main_text():
    extract = htmltext.trained()
    page = """<html><head><title>no</title><script>var t="</p>";</script></head><body><header class="site-header"><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li><li><a href=/b>News</a></li></ul></nav>
    <div class="cookie-notice"><p>We use cookies on this site.</p><button>OK</button></div><article><h1>A title &amp; more</h1><p>First   paragraph
    of the <b>story</b> goes on for a while.<br>It continues here.<p>Second one, unclosed, also with words.</p><div class="ad">Buy now!</div><p>Third paragraph ends it.</p></article>
    <aside class="sidebar"><h3>Related</h3><ul><li><a href=/x>Other story</a></li></ul></aside><section class="comments"><h2>Comments</h2><div class="comment"><p>I disagree with this.</p></div></section>
    <form><label>Mail</label><input><button>Send</button></form><footer>&copy; Site</footer></body></html>"""
    assert extract(page) == "A title & more\nFirst paragraph of the story goes on for a while. It continues here.\nSecond one, unclosed, also with words.\nThird paragraph ends it."
    assert extract(None) == extract("") == "" and isinstance(extract("<p>a<div" * 50), str)


def plain_blocks(page):
    """Texts of the leaf blocks by the standard library's parser, which must agree where pages are well-formed."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        out, text, raw = [], "", 0

        def flush(self):
            self.out, self.text = self.out + [" ".join(self.text.split())] * bool(self.text.split()), ""

        def handle_starttag(self, tag, _):
            self.raw += tag in htmltext.RAW - {"head"}
            if tag in htmltext.BLOCKS:
                self.flush()
            self.text += " " * (tag == "br")

        def handle_endtag(self, tag):
            self.raw -= tag in htmltext.RAW - {"head"}
            if tag in htmltext.BLOCKS:
                self.flush()

        def handle_data(self, data):
            self.text += data * (not self.raw)

    reader = Reader()
    reader.feed(page)
    reader.close()
    reader.flush()
    return reader.out


def test_blocks_against_plain_reader():
    more = ["<!-- a <p>comment</p> --><p class='x > y' id=\"a'b\">One &lt;b&gt; <b>two</b>&nbsp;three&#65;&#x42;</p><script>if (a < b) '</p>'</script><style>p{}</style><div>four<br>five<p>six<table><tr><td>seven<td>eight</table>nine</div>", "no tags & none &amp; more", "<p>a</p>b<i>c</i> d<p>"]
    for page in [*(page for page, _ in htmltext.labelled_pages(150, seed=5)), *more]:
        assert [b.text for b in htmltext.blocks(page)] == plain_blocks(page)


@pytest.mark.parametrize("page", ["<a" * 100_000, '<a b="' * 160_000, "<a b='>" * 140_000, "</b>" * 250_000, "<i>" * 100_000 + "</b>" * 100_000, "<b><td>" + "<i>" * 100_000 + "</b>" * 100_000, "<!--" * 250_000, "<" * 1_000_000, "<script>" + "</script" * 120_000,
                                  "&#" + "9" * 1_000_000 + ";", "&#" + "0" * 1_000_000 + "65;", "".join(f"<div class={chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}>t" for i in range(17_000))])
def test_malformed_pages_take_linear_time(page):
    import time

    extract, began = htmltext.trained(), time.process_time()
    extract(page)
    assert time.process_time() - began < 4  # about 1 on a free machine


def test_long_character_references():
    assert htmltext.unescape("&#0000000065;&#x0000000041&#99999999;&#xFFFFFFFFF;&amp;&#65") == "AA\ufffd\ufffd&A"


def test_labels_on_held_out_pages():
    extract, right, n = htmltext.trained(), 0, 0
    for page, _ in htmltext.labelled_pages(80, seed=123):
        found = htmltext.blocks(page)
        gold = ["~" in b.text for b in found]
        for b in found:
            b.text = b.text.replace("~", "").replace("^", "") or "-"
        labels = extract.chain.decode(extract.rows(found)) if found else []
        right += sum(bool(a) == b for a, b in zip(labels, gold))
        n += len(found)
    assert right / n > 0.98


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(2)
    for _ in range(20):
        chain = htmltext.Chain(6)
        chain.emit, chain.move, chain.start = r.normal(size=(6, 2)), r.normal(size=(2, 2)), r.normal(size=2)
        rows = [list(r.integers(0, 6, 2)) for _ in range(6)]
        e = chain.scores(rows)
        value = lambda p: chain.start[p[0]] + sum(e[i, x] for i, x in enumerate(p)) + sum(chain.move[a, b] for a, b in zip(p, p[1:]))
        assert value(chain.decode(rows)) == pytest.approx(max(value([(k >> i) & 1 for i in range(6)]) for k in range(64)))


# 9. Syncmers


def plain_anchors(t, k=32, s=8):
    """(place, hash) of the closed syncmers, k-mer by k-mer."""
    import struct

    import xxhash

    signed = lambda v: (v & (1 << 64) - 1) - (1 << 64 if v >> 63 & 1 else 0)
    chain = lambda seed, v: xxhash.xxh64_intdigest(struct.pack("<q", v), seed=seed)

    def smer(m):
        out = 0
        for i, c in enumerate(m):
            out ^= xxhash.xxh64_intdigest(c.encode(), seed=42) << (len(m) - 1 - i)
        return signed(out)

    found = []
    for at in range(len(t) - k + 1):
        h = [smer(t[at + i : at + i + s]) for i in range(k - s + 1)]
        if min(h[0], h[-1]) <= min(h):
            a = 42
            for i in range(0, k, s):
                a = chain(a, h[i])
            found.append((at, a & 0x7FFFF))
    return found or [(0, xxhash.xxh64_intdigest(t.encode(), seed=42) & 0x7FFFF)] * bool(t)


def plain_fingerprint(t):
    """The fingerprint and its pairs of neighbours."""
    found = plain_anchors(t)
    places = [-1] + [p for p, _ in found]
    pairs = {(x, y, q - p) for (p, x), (q, y) in zip(found, found[1:])} if len(found) > 1 else {x for _, x in found}
    return "".join(f"{h << 5 | p - q - 1:06x}" for (p, h), q in zip(found, places)), pairs


@pytest.mark.parametrize("block", [32, 8192])
def test_edit_study_against_plain(spark, monkeypatch, block):
    import hashlib

    monkeypatch.setattr(syncmers, "BLOCK", block)
    r = random.Random(7)
    texts = ["", "a b", "x" * 150, "ÄÖ é 漢字 a b c", "a😀" * 40, "y" * 32, "z" * 63, "w" * 64] + [words(r, r.randint(0, 200)) for _ in range(40)] + ["".join(r.choice("漢字仮名交") for _ in range(r.randint(0, 300))) for _ in range(20)] + ["same words in a text"] * 2 + ["".join(r.choice("abc ") for _ in range(n)) for n in range(25, 75)]
    ids = r.sample(range(10_000), len(texts))
    d = docs(spark, texts, ids=ids)
    order = sorted(range(len(ids)), key=lambda k: ids[k])
    like = lambda a, b: 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0
    got = {x.doc_id: x for x in syncmers.edit_study(d).collect()}
    assert len(got) == len(texts)
    for k, nxt in zip(order, order[1:] + order[:1]):
        t, m = texts[k], len(texts[k]) // 2
        edited = t[: len(t) - m] + texts[nxt][:m]
        x, (own, a), (changed, b), (_, c) = got[ids[k]], plain_fingerprint(t), plain_fingerprint(edited), plain_fingerprint(texts[nxt])
        assert (x.n_chars, x.edited_sha256, x.fingerprint, x.edited_fingerprint) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), own, changed)
        assert x.near_edited == pytest.approx(like(a, b)) and x.near_next == pytest.approx(like(a, c))


def test_an_inserted_character_changes_anchors_near_it_alone(spark):
    r = random.Random(3)
    text = "".join(r.choice("漢字仮名交文章長短") for _ in range(2000))
    rows = spark.createDataFrame([(0, text), (1, text[:5] + "新" + text[5:])], "id long, text string")
    a, b = (x.p for x in rows.select("id", syncmers.pairs(syncmers.codes(syncmers.anchors(F.col("text"), F.length("text")))).alias("p")).orderBy("id").collect())
    assert len(set(a) & set(b)) > 0.94 * len(a) and 110 < len(a) < 250


def test_ranges_of_many_ids_plan_in_seconds(spark):
    import time

    began = time.time()
    bounds = list(range(0, 65_536 * 610, 610))
    found = spark.range(1).select(syncmers._place(F.lit(39_000_000), bounds).alias("at"), syncmers._place(F.lit(-1), bounds).alias("low")).first()
    assert found["at"] == 39_000_000 // 610 + 1 and found["low"] == 0 and time.time() - began < 30
    ids = spark.range(200_000).withColumnRenamed("id", "doc_id")
    cut = syncmers.quantiles(ids, 200_000, 100)
    sizes = np.diff([0, *cut, 200_000])
    assert len(cut) == 99 and sizes.max() < 3 * 2000


@pytest.mark.parametrize("range_rows", [1, 3, 10, 1000])
def test_next_over_ranges(spark, range_rows):
    ids = random.Random(1).sample(range(500), 60) + [10**15, -5]
    df = spark.createDataFrame([(i, i) for i in ids], "doc_id long, _tie long")
    got = {x.doc_id: x.next_doc_id for x in syncmers.with_next(df, ["doc_id"], range_rows).collect()}
    order = sorted(ids)
    assert got == dict(zip(order, order[1:] + order[:1]))


def test_place_is_a_search(spark):
    bounds = sorted(random.Random(2).sample(range(10_000), 300))
    got = spark.range(10_050).select("id", syncmers._place(F.col("id"), bounds).alias("at")).collect()
    assert all(x["at"] == sum(b <= x.id for b in bounds) for x in got[::37])


# 10. Toxicity


@pytest.fixture(scope="module")
def char_model():
    known = "idiot moron loser stupid trash worthless pathetic the of and with that there number street again another".split()
    return toxicity.CharModel({w: 3.0 for w in known} | {f"{a}{b}er": 1.0 for a in "bdfglmnprst" for b in ("and", "ing", "ous")})


@pytest.mark.parametrize("written, word", [("1d10t", "idiot"), ("l0ser", "loser"), ("stuuuupid", "stupid"), ("tr@sh", "trash"), ("p4th3t1c", "pathetic"), ("idiot!!", "idiot"), ("i-d-i-o-t", "idiot"), ("m.o.r.o.n", "moron"), ("the***", "the"), ("2023", "2023"), ("wörter", "wörter"), ("other", "other")])
def test_restores(char_model, written, word):
    assert toxicity.Restorer(char_model)[written][0] == word


@pytest.mark.parametrize("written, word", [("1053r", "loser"), ("1d107", "idiot"), ("id" + "i" * 45 + "ot", "idiot"), ("m.oron", "moron"), ("id-iot", "idiot"), ("iidiot", "idiot"), ("lloser", "loser"), ("$100", "100"), ("12-34", "12-34")])
def test_restores_what_is_mostly_signs(char_model, written, word):
    assert toxicity.Restorer(char_model)[written][0].lstrip("$") == word


@pytest.mark.parametrize("text", ["you i  d  i  o  t", "you i\td\ti\to\tt", "m o r o n  i d i o t"])
def test_words_spelled_out_with_any_white_space(char_model, text):
    assert "idiot" in toxicity.Restorer(char_model).marks(text)


def test_wanted_marks_are_those_of_all(char_model):
    r, wanted = random.Random(4), {"idiot", "moro~", "lose~", "loser~", "trash", "of", "aa~", "e"}
    known = [w for w in "1d10t l0s3r5 m0r0nic tr@sh tra-sh of 0f aaa 3 e3 losers moron mo-ron-ic".split()]
    texts = known + ["".join(r.choice("idotlsermna1305$@-. ") for _ in range(r.randint(1, 30))) for _ in range(3000)]
    some, every = toxicity.Restorer(char_model, wanted), toxicity.Restorer(char_model)
    assert [some.marks(t) for t in texts] == [every.marks(t) & wanted for t in texts] and sum(map(len, map(some.marks, texts))) > 20


def test_long_words_decode_in_linear_time(char_model):
    assert len(toxicity.decode("1d10t.x" * 2000, char_model)) >= 10_000


def test_viterbi_over_lattices_is_the_best_path(char_model):
    import itertools

    keep = char_model.order - 1
    for word in ("1d10t", "l0ss3r", "5tuupid"):
        options = list(toxicity.lattice(word))

        def value(path):
            at, s = "^" * keep, 0.0
            for letters, chance in path:
                s += chance
                for c in letters:
                    s += char_model.log(at + c)
                    at = (at + c)[-keep:]
            return s + char_model.log(at + "$")

        best = max(itertools.product(*options), key=value)
        found = toxicity.decode(word, char_model)
        assert value(best) == pytest.approx(max(value(p) for p in itertools.product(*options) if "".join(x for x, _ in p) == found))


def test_score_against_plain_search(char_model):
    import itertools
    import math

    keep = char_model.order - 1

    def plain_word(word):
        """The best of all paths through the lattice, at equal value the smaller text."""
        def value(path):
            at, s = "^" * keep, 0.0
            for letters, chance in path:
                s += chance
                for c in letters:
                    s += char_model.log(at + c)
                    at = (at + c)[-keep:]
            return s + char_model.log(at + "$")

        paths = list(itertools.product(*toxicity.lattice(word)))
        best = max(map(value, paths))
        return min("".join(x for x, _ in p) for p in paths if value(p) == pytest.approx(best, abs=1e-12))

    weights, alone = {"idiot": 2.0, "idio~": 0.5, "lose~": 1.0, "trash": -0.3}, {"moron": 0.9}
    score = toxicity.Classifier(char_model, weights, -2.0, alone).scorer()
    for text in ("you 1d10t", "a l0ser and tr@sh", "plain words", "m0ron here", "idiot idiot losers", ""):
        marks = {plain_word(w) if not w.isalpha() else w for w in text.split()}
        marks |= {w[:n] + "~" for w in marks if len(w) > 4 for n in (4, 5)}
        together = 1 / (1 + math.exp(2.0 - sum(weights.get(m, 0.0) for m in marks)))
        assert score(text) == pytest.approx(max([together, *(alone[m] for m in marks if m in alone)]))


def test_toxicity_on_disguised_words(spark):
    r = random.Random(5)
    bad = ["idiot", "moron", "loser", "stupid"]
    leet = str.maketrans("io", "10")
    rows = []
    for i in range(900):
        w = words(r, r.randint(5, 60), 200).split()
        toxic = int(r.random() < 0.2)
        for _ in range(3 * toxic):
            w.insert(r.randrange(len(w)), r.choice(bad))
        rows.append((i, " ".join(w), toxic))
    model = toxicity.train(spark.createDataFrame(rows, "id long, text string, toxic int"))
    score = model.scorer()
    assert score("w1 w2 you idiot w3") > 0.7 > score("w1 w2 w3") and score("w1 1d10t and l0ser w2".translate(leet)) > 0.7 and score("w1 i d i o t w2") > 0.7
    assert 0 <= score("") <= 1 and score(None) == score("")
    one = toxicity.train(spark.createDataFrame([(1, "a", 0)], "id long, text string, toxic int"))
    assert 0 < one.scorer()("x") < 0.5
    d = docs(spark, ["you idiot moron", "w1 w2", None])
    assert sorted(x.doc_id for x in toxicity.without_toxic(d, model).collect()) == [1, 2]
    assert {x.doc_id for x in toxicity.score(d, model).collect()} == {0, 1, 2}


def test_language_model_counts_words_outside_the_training_rows(spark):
    rows = [(i, "plain words here" if i % 2 else "you moron", i % 2 ^ 1) for i in range(40)]
    corpus = spark.createDataFrame([(t,) for _, t, _ in rows] + [("the zugzwang",)], "text string")
    model = toxicity.train(spark.createDataFrame(rows, "id long, text string, toxic int"), corpus=corpus).model
    assert toxicity.Restorer(model)["zugzw4ng"][0] == "zugzwang"
    plain = toxicity.CharModel({"plain": 20**0.5, "words": 20**0.5, "here": 20**0.5, "you": 20**0.5, "moron": 20**0.5, "the": 1.0, "zugzwang": 1.0})
    assert model.alphabet == plain.alphabet and model.log("zwan") == pytest.approx(plain.log("zwan"), abs=1e-3)


# Odd rows, extra columns and empty tables


def operators(spark):
    public = pytest.importorskip("public_tokenizers")
    flat = toxicity.Classifier(toxicity.CharModel({}), {}, -1.0)
    return {
        "mix": lambda d: mixing.mix(d), "order": lambda d: mixing.training_order(d), "tokens": lambda d: tokens.count_tokens(d, [("<unk>", 0.0), ("a", -1.0)]), "pack": lambda d: packing.pack(d, public.path("byte_bpe_50k.json")),
        "near": neardup.near_duplicates, "language": lambda d: langid.identify(d, F.col("doc_id") > 2), "substrings": substrings.dedup_substrings, "fingerprints": syncmers.edit_study, "score": lambda d: toxicity.score(d, flat), "filter": lambda d: toxicity.without_toxic(d, flat),
    }


@pytest.mark.parametrize("name", ["mix", "order", "tokens", "pack", "near", "language", "substrings", "fingerprints", "score", "filter"])
def test_odd_rows(spark, name):
    run, d = operators(spark)[name], odd(spark)
    rows = run(d).collect()
    if name == "pack":
        assert Counter(x.doc_id for x in rows if x.start == 0) == Counter(x.doc_id for x in d.collect())
    elif name == "order":  # whole rows, each as often as it is taken
        stored = Counter(map(str, d.collect()))
        assert rows and run(d).columns == d.columns and all(n <= 2 * stored[x] for x, n in Counter(map(str, rows)).items())
    else:
        assert Counter(x.doc_id for x in rows) == Counter(x.doc_id for x in d.collect())
    texts = {x.doc_id: x.text for x in d.collect()}
    for x in rows:
        empty = not (texts[x.doc_id] or "").strip()
        if name == "near":
            assert (x.n_shingles == 0) == empty and (x.kept == (x.doc_id == x.component_id) or x.doc_id is None)
        if name == "mix":
            assert (x.size == 0) == empty and x.taken <= 2 * x.size
        if name == "tokens" and not texts[x.doc_id]:
            assert x.n_tokens == 0
        if name == "pack" and not texts[x.doc_id]:
            assert (x.length, x.doc_tokens, x.ids_crc32) == (1, 1, zlib.crc32(bytes(4)))
        if name == "substrings":
            assert (x.text is None) == (texts[x.doc_id] is None)
        if name == "fingerprints":
            assert (x.fingerprint == "") == (not texts[x.doc_id])
        if name == "language":
            assert 0 <= x.score <= 1 and (x.lang_pred != "und" or x.score == 0)
    assert run(d.limit(0)).count() == 0


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (2, None, "<p>" + "word " * 50_000), (None, "u", "<article><p>Some words of a story.</p></article>"), (4, "u", "no tags at all"), (5, "u", "<" * 3000)], "page_id long, url string, html string").withColumn("id", F.lit(3))
    rows = htmltext.main_text(pages).collect()
    assert Counter(x.page_id for x in rows) == Counter([1, 2, 2, None, 4, 5]) and all(x.n_chars == len(x.text) for x in rows)
    assert htmltext.main_text(pages.limit(0)).count() == 0
