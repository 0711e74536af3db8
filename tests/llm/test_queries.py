"""The registered queries op1 to op10 on small tables with odd rows: columns, kinds, rows, held-out rows, and the same rows on every run."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from quorumtext.llm import common, neardup, queries
from tests.llm.test_operators import plain_components, plain_vectors, vectors_of_many_lengths

COLUMNS = {
    "op1_mix_sources": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op2_token_counts": "doc_id bigint, n_chars bigint, n_tokens bigint",
    "op3_pack": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op4_near_duplicates": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op5_near_vectors": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op6_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op7_substrings": "doc_id bigint, n_removed int, text string",
    "op8_main_text": "page_id bigint, url string, text string, n_chars bigint",
    "op9_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op10_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
}


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    r, folder = random.Random(12), tmp_path_factory.mktemp("tables")
    rows, labels = [], []
    for i in range(260):
        toxic = int(r.random() < 0.25)
        w = [f"w{r.randint(0, 900)}" for _ in range(r.randint(1, 90))]
        for _ in range(3 * toxic):
            w.insert(r.randrange(len(w)), r.choice(["idiot", "moron", "l0ser", "loser"]))
        text = " ".join(w) + "."
        rows.append([i, rows[i - 7][1] if i > 20 and r.random() < 0.1 else text, r.choice(["en", "de", None]), r.choice(["a", "b", None]), len(text)])
        if r.random() < 0.8:
            labels.append((i, 1, toxic))
    rows += [[300, None, None, None, None], [301, "", "en", "a", 0], [302, " \n\t", "en", "c", 3], [303, "word " * 30_000, "en", "a", 150_000], [304, "漢字 😀 é", "de", None, 6], [305, "...", "en", "b", 3]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    vectors = [(i, v, label) for i, (v, label) in enumerate(vectors_of_many_lengths(np.random.default_rng(2)))]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    pages = [(1, "u", None), (2, None, ""), (3, "u", "<html><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>Title</h1><p>Some &amp; text that goes on.</p></article></body>"), (4, "u", "<p>" + "word " * 20_000), (5, "u", "<a" * 20_000)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return str(folder)


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, sf, name):
    with common.Account():
        found = queries.QUERIES[name](spark, sf)
        assert ", ".join(f"{c} {t}" for c, t in found.dtypes).startswith(COLUMNS[name])
        rows = found.collect()
        again = queries.QUERIES[name](spark, sf).collect() if name in ("op3_pack", "op4_near_duplicates", "op6_language", "op7_substrings", "op10_toxicity") else rows
    assert Counter(map(str, again)) == Counter(map(str, rows))
    table, key = {"op5_near_vectors": ("embeddings", "vec_id"), "op8_main_text": ("pages", "page_id")}.get(name, ("documents", "doc_id"))
    stored = {x[key]: x for x in spark.read.parquet(f"{sf}/{table}.parquet").collect()}
    firsts = [x for x in rows if name != "op3_pack" or x.start == 0]
    assert Counter(x[key] for x in firsts) == Counter(list(stored))
    for x in rows:
        y = stored[x[key]]
        if name in ("op6_language", "op10_toxicity"):
            modulus, held = (5, 0) if name == "op6_language" else (3, 1)
            assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % modulus == held) and 0 <= x.score <= 1
        if name == "op6_language":
            assert x.lang_pred in {"en", "de", "und"} and (x.lang_pred == "und") == (not any(c.isalpha() for c in y.text or ""))
        if name == "op10_toxicity":
            assert x.predicted == int(x.score >= 0.7)
        if name == "op7_substrings":
            assert (x.text is None) == (y.text is None) and (x.n_removed or x.text == y.text)
        if name in ("op2_token_counts", "op9_fingerprints"):
            assert x.n_chars == len(y.text or "")
        if name == "op9_fingerprints":
            assert 0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 and bool(x.fingerprint) == bool(y.text)
        if name == "op8_main_text":
            assert x.n_chars == len(x.text) and x.url == y.url
        if name == "op1_mix_sources":
            assert x.size == len((y.text or "").split()) and 0 <= x.taken <= 2 * x.size
    by_id = {x[key]: x for x in firsts}
    if name == "op4_near_duplicates":
        ids = sorted(stored)
        sizes, parents = plain_components([stored[i].text for i in ids])
        assert [(by_id[i].n_shingles, by_id[i].component_id, by_id[i].kept) for i in ids] == [(n, ids[p], ids[p] == i) for i, n, p in zip(ids, sizes, parents)]
    if name == "op5_near_vectors":
        assert {i: (x.n_links, x.component_id, x.kept) for i, x in by_id.items()} == plain_vectors({i: (x.embedding, x.label) for i, x in stored.items()})
    if name == "op8_main_text":
        assert by_id[3].text == "Title\nSome & text that goes on." and by_id[1].text == by_id[2].text == ""
    if name == "op10_toxicity":
        bad = {x.doc_id for x in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()}
        found = [by_id[i].predicted for i in bad if by_id[i].held_out]
        assert sum(found) >= 0.9 * len(found) and sum(x.predicted for i, x in by_id.items() if stored[i].text and not any(w in stored[i].text for w in ("idiot", "moron", "loser", "l0ser"))) <= 3


# Files and tables that runs leave


def left(spark):
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{common.shared_dir(spark)}/quorumtext")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    files = {x.getPath().getName() for x in fs.listStatus(root)} if fs.exists(root) else set()
    return files | {t.name for t in spark.catalog.listTables() if t.name.startswith("quorumtext")}


@pytest.mark.parametrize("name", ["op1_mix_sources", "op3_pack", "op4_near_duplicates", "op5_near_vectors", "op7_substrings", "op10_toxicity"])
def test_nothing_is_left_once_a_result_is_written(spark, sf, tmp_path, name):
    before = left(spark)
    with common.Account():
        found = queries.QUERIES[name](spark, sf)
        assert len(left(spark) - before) <= 3 and not any(x.startswith("quorumtext") for x in left(spark) - before)  # what the result reads
        found.write.parquet(str(tmp_path / "out"))
    assert left(spark) == before and spark.read.parquet(str(tmp_path / "out")).count()


def test_two_pipelines_built_before_either_is_read(spark, sf):
    before = left(spark)
    with common.Account():
        first, second = corpus_pipeline.run(spark, sf), corpus_pipeline.run(spark, sf)
        a, b = ({(x.doc_id, x.start, x.sequence_id, x.offset) for x in d.collect()} for d in (first, second))
        assert a == b and a
    assert left(spark) == before


def test_no_local_folder_on_a_cluster():
    class Fake:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: None)})
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_dir(Fake)


def test_failed_operator_leaves_nothing(spark, sf, monkeypatch):
    before = left(spark)
    monkeypatch.setattr(neardup, "confirmed", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        queries.op4_near_duplicates(spark, sf)
    assert left(spark) == before
