import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quorumtext.llm import neardup, queries, toxicity


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    r = random.Random(1)
    folder = tmp_path_factory.mktemp("sf")
    rows, labels = [], []
    for i in range(400):
        w = [f"w{r.randint(0, 3000)}" for _ in range(r.randint(5, 120))]
        toxic = int(r.random() < 0.2)
        for _ in range(3 * toxic):
            w.insert(r.randrange(len(w)), r.choice(["idiot", "moron", "loser"]))
        rows.append([i, " ".join(w) + ".", "en", r.choice(["a", "b", None]), 0])
        if r.random() < 0.8:
            labels.append((i, 1, toxic))
    rows += [[400 + k, rows[k][1], "en", "a", 0] for k in range(30)] + [[500, None, None, None, None], [501, "", "en", "a", 0]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages_in_a_row(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    clean = corpus_pipeline.toxic(spark, docs, sf)
    score = queries.toxicity_model(docs, spark.read.parquet(f"{sf}/labels.parquet")).scorer()
    texts = {x.doc_id: x.text for x in docs.collect()}
    kept = {x.doc_id for x in clean.collect()}
    assert kept == {i for i, t in texts.items() if score(t) < 0.7} and clean.columns == columns and 200 < len(kept) < len(texts)
    alone = corpus_pipeline.near_duplicates(spark, clean, sf)
    want = {x.doc_id for x in neardup.near_duplicates(clean).where("kept").collect()}
    assert {x.doc_id for x in alone.collect()} == want and alone.columns == columns and not any(400 <= i < 430 and i - 400 in kept for i in want)
    cleaned = corpus_pipeline.repeated_passages(spark, alone, sf)
    assert cleaned.columns == columns and {x.doc_id for x in cleaned.collect()} == want
    assert all(x.n_chars is None if x.text is None else x.n_chars == len(x.text) for x in cleaned.collect())
    mixed = corpus_pipeline.mix(spark, cleaned, sf)
    assert mixed.columns == columns and {x.doc_id for x in mixed.collect()} <= want
    packed = corpus_pipeline.pack(spark, mixed, sf)
    assert {x.doc_id for x in packed.collect()} == {x.doc_id for x in mixed.collect()}


def test_run(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and max(x.length for x in rows) <= 1024


def test_repeated_ids_and_null_ids(spark):
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (None, "x", "en", "s", 1), (2, "A b c d e f", "en", "s", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [x.doc_id for x in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(got, key=str) == [1, None]


def test_mix_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet/*.parquet')")
    want = con.sql(queries.ORACLE_SQL["op1_mix_sources"]).df().sort_values("doc_id", ignore_index=True)
    got = queries.op1_mix_sources(spark, sf).toPandas().sort_values("doc_id", ignore_index=True)[list(want.columns)]
    assert got.equals(want) or ((got == want) | (got.isna() & want.isna())).all().all()
