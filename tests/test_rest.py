import csv
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumtext.functions import charlm
from quorumtext.functions import geometry as G
from quorumtext.operators import detect, evaluate, guard, images, manifest, pairing
from quorumtext.plans import extract, options
from quorumtext.sources import engines, sinks, tables
from quorumtext.streaming import pages as streaming


def test_manifest(spark):
    gold = spark.createDataFrame([("a.pdf", "1-3"), ("a.pdf", "5"), ("b.pdf", "3-1"), ("c.pdf", "x"), ("", "3"), ("d.pdf", " 7 "), ("e.pdf", "-5"), ("f.pdf", None)], "`PDF LINK` string, PAGE string")
    files = spark.createDataFrame([("a.pdf",), ("b.pdf",)], "pdf_path string")
    rows = lambda *a: sorted(map(tuple, manifest.build_manifest(gold, files, *a).collect()))
    assert rows(True) == [("a.pdf", 1), ("a.pdf", 2), ("a.pdf", 3), ("a.pdf", 5), ("b.pdf", 1), ("b.pdf", 2), ("b.pdf", 3), ("d.pdf", 7)]
    assert rows(False) == [("a.pdf", 5), ("d.pdf", 7), ("e.pdf", -5)]
    assert rows(True, True) == [r for r in rows(True) if r[0] in ("a.pdf", "b.pdf")]
    assert manifest.missing_report(gold, files, 2).splitlines() == ["3 missing", "  c.pdf", "  d.pdf", "  ... and 1 more"]
    with pytest.raises(FileNotFoundError, match="c.pdf"):
        manifest.check_strict(gold, files)
    assert manifest.pick_column(["x", "Page", "PDF"], manifest.PDF_COLUMNS) == "PDF"
    with pytest.raises(ValueError):
        manifest.pick_column(["x"], manifest.PAGE_COLUMNS)


def test_rates(spark):
    t = spark.range(1).select(evaluate.cer(F.lit("abc"), F.lit("abd")), evaluate.wer(F.lit("a b c d"), F.lit("a x c")), evaluate.cer(F.lit("a"), F.lit("")), evaluate.accuracy(F.lit(4.5))).first()
    assert t[0] == pytest.approx(1 / 3) and t[1] == pytest.approx(2 / 3) and t[2] is None and t[3] == 0.0


def test_boxes(spark):
    pts = lambda x: F.lit(json.dumps(x))
    arr = lambda x: F.from_json(pts(x), "array<array<double>>")
    row = spark.range(1).select(
        G.polygon_box(arr([[3, 1], [5, 9], [2, 4]])).alias("a"), G.polygon_box(arr([[3], [5, 9]])).alias("b"), G.polygon_box(arr([])).alias("c"),
        G.scaled_box(arr([[0.5, 0.1], [0.2, 0.9]]), F.lit(100.0), F.lit(10.0)).alias("d"), G.scaled_box(arr([[0.5, 0.1], [0.2, 0.9], [0.3, 0.3]]), F.lit(100.0), F.lit(10.0)).alias("e"),
        G.rotated_box(G.box(*map(F.lit, (10.0, 20.0, 30.0, 40.0))), F.lit(90), F.lit(100.0), F.lit(200.0)).alias("f"),
    ).first()
    assert tuple(row.a) == (2, 1, 5, 9) and row.b is None and row.c is None
    assert tuple(row.d) == (50, 1, 20, 9) and tuple(row.e) == (20, 1, 50, 9) and tuple(row.f) == (20, 70, 40, 90)


def test_engine_results(spark):
    df = spark.createDataFrame([(1, [([[0.0, 0.0], [4.0, 2.0]], "ab", "0.5"), ([[0.0, 0.0], [4.0, 2.0]], " ", "0.9"), (None, "cd", "?")])], "page_id long, result array<struct<polygon:array<array<double>>,text:string,confidence:string>>")
    rows = engines.paddle_lines(df, ["page_id"]).orderBy("line_no").collect()
    assert [(r.text, r.raw_confidence, r.bbox and tuple(r.bbox)) for r in rows] == [("ab", 0.5, (0, 0, 4, 2)), ("cd", None, None)]
    df = spark.createDataFrame([(1, ["a", "b"], [0.5], [[[1.0, 2.0], [3.0, 4.0]]])], "page_id long, texts array<string>, scores array<double>, polygons array<array<array<double>>>")
    rows = engines.mmocr_lines(df, ["page_id"]).orderBy("line_no").collect()
    assert [(r.text, r.raw_confidence) for r in rows] == [("a", 0.5), ("b", None)]
    word = "struct<value:string,geometry:array<array<double>>,confidence:double>"
    df = spark.createDataFrame([(1, 100.0, 10.0, [[(None, [("x", [[0.1, 0.1], [0.2, 0.2]], 0.8), ("y", [[0.3, 0.1], [0.4, 0.3]], 0.6)])], [(None, [("z", None, None)])]])], f"page_id long, page_width double, page_height double, result array<array<struct<geometry:array<array<double>>,words:array<{word}>>>>")
    rows = engines.doctr_lines(df, ["page_id"]).orderBy("line_no").collect()
    assert [(r.text, round(r.raw_confidence, 6)) for r in rows] == [("x y", 0.7), ("z", 0.6)]
    assert tuple(rows[0].bbox) == pytest.approx((10, 1, 40, 3)) and rows[1].bbox is None


def test_detection(spark):
    pages = spark.createDataFrame([(1, "This page is English prose only.\nNothing else is written here."), (2, "sa-ra-am i-na-an e-li-su DUMU\nplain trailing text"), (3, "Bu sayfa Türkçe yazılmış bir metindir.\nÜç örnek şöyle kaydedilmektedir:"), (4, "")], "page_id long, text string")
    assert {r.page_id: r.has_akkadian for r in detect.detect(pages, ["page_id"]).collect()} == {1: False, 2: True, 3: False, 4: False}


def test_detection_with_perplexity(spark):
    line = "ša-ra-am i-na-an e-li-su the x1 x2 x3 x4 x5 x6"  # share 0.3, less 0.1 for a function word
    pages = spark.createDataFrame([(1, line)], "page_id long, text string")
    model = charlm.train(pages.select("text"))
    flagged = lambda m: detect.detect(pages, ["page_id"], model=m).first().has_akkadian
    assert not flagged(None) and flagged(model)


def test_boosted_score_that_meets_the_threshold(spark):
    from quorumtext.plans.queries import TIED

    # 7 of 20 tokens, boost 0.3, penalty 0.15: 0.5 in decimals, less in floating point when summed in that order
    row = spark.createDataFrame([(20, 7, 0, 0, 3, 10.0)], "n_tokens int, n_syllabic int, n_diacritics int, n_markers int, n_negative int, perplexity double")
    assert detect.qualify(row, TIED).first().qualifies


def test_char_model(spark, tmp_path):
    texts = spark.createDataFrame([("abab",), ("abc",), ("a",)], "text string")
    model = charlm.train(texts)
    assert {(r.n, r.gram): r.cnt for r in model.ngrams.collect() if r.n == 3} == {(3, "aba"): 1, (3, "bab"): 1, (3, "abc"): 1}
    got = charlm.perplexity(spark.createDataFrame([(1, "abx"), (2, "a")], "id long, text string"), model, ["id"]).orderBy("id").collect()
    assert got[0].perplexity == pytest.approx((2 + 0.1 * 3) / 0.1) and got[1].perplexity is None
    path = tmp_path / "lm.json"
    path.write_text(json.dumps({"order": 2, "alpha": 0.1, "vocab": ["a"], "ngram_counts": {"2": {"ab": 3}}, "context_counts": {"2": {"a": 3}}}))
    assert charlm.load(spark, str(path)).ngrams.first().cnt == 3


def test_char_model_counts_and_reads_texts_once(spark):
    texts = ["", "a", "ab", "abc", "aab šé\U0001f600x", "abcabc\n", None]
    want = {}
    for t in texts:
        for n in (1, 2, 3):
            for i in range(len(t or "") - n + 1):
                want[n, t[i : i + n]] = want.get((n, t[i : i + n]), 0) + 1
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    model = charlm.train(df)
    assert {(r.n, r.gram): r.cnt for r in model.ngrams.collect()} == want
    assert model.ngrams.dtypes == [("n", "int"), ("gram", "string"), ("cnt", "bigint")]
    assert "Generate" not in plan_of(model.contexts) and model.symbols == len({g for n, g in want if n == 1})  # the texts aren't read again


def test_perplexity_with_a_model_too_large_to_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a-na a-na a-na"), (2, "qi-bi-ma"), (3, "")], "id long, text string")
    model = charlm.train(df.where("id < 2"))
    small = {r.id: r for r in charlm.perplexity(df, model, ["id"]).collect()}
    monkeypatch.setattr(charlm, "BROADCAST_ROWS", 0)
    large = {r.id: r for r in charlm.perplexity(df, model, ["id"]).collect()}
    for k in (1, 2, 3):
        assert small[k].n_grams == large[k].n_grams and small[k].perplexity == pytest.approx(large[k].perplexity)


def test_perplexity_of_all_documents(spark, tmp_path):
    from quorumtext.plans.queries import QUERIES

    spark.createDataFrame([(1, "a-na a-na a-na"), (2, "qi-bi-ma"), (3, "")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["char_lm_perplexity_documents"](spark, str(tmp_path)).collect()}
    assert {k: r.n_grams for k, r in got.items()} == {1: 12, 2: 6, 3: 0}
    assert got[1].perplexity < got[2].perplexity and got[3].perplexity is None


def test_texts_are_not_spelled_out_as_rows(spark):
    df = spark.createDataFrame([(1, "a-na a-na a-na"), (1, "a-na"), (2, "a"), (3, None), (None, "qi-bi")], "id long, text string").repartition(2)
    model = charlm.train(df)
    scored = charlm.perplexity(df, model, ["id"])
    assert "Generate" not in plan_of(scored) and "MapInArrow" in plan_of(scored)
    tables = [t.where("n = 3").select("gram", "cnt") for t in (model.ngrams, model.contexts)]
    losses = charlm._joined_losses(df, model, ["id"], *tables).where("id = 1").collect()
    got = scored.collect()
    assert sorted((r.id or 0, r.n_grams) for r in got) == [(0, 0), (1, 14), (1, 14), (2, 0), (3, 0)]  # rows that share a key are one text
    assert [r.perplexity for r in got if r.id == 1] == pytest.approx([np.exp(sum(r.loss for r in losses) / 14)] * 2)


@pytest.mark.parametrize("dense, part", [(1 << 22, 1 << 20), (0, 1 << 20), (50, 9)])
def test_n_grams_by_code(monkeypatch, dense, part):
    import random
    from collections import Counter

    import pyarrow as pa

    monkeypatch.setattr(charlm, "DENSE", dense)
    monkeypatch.setattr(charlm, "PART_BYTES", part)
    r = random.Random(7)
    texts = [None if r.random() < 0.1 else "".join(r.choice("ab é\U0001f600") for _ in range(r.choice((0, 1, 2, 3, 40)))) for _ in range(60)]
    want, got = Counter((n, t[i : i + n]) for t in texts if t for n in range(1, 6) for i in range(len(t) - n + 1)), Counter()
    for _, _, joined, points, lengths in charlm._parts(pa.array(texts)):
        for gram, count in charlm._counted(joined, points, lengths, 5) if joined else ():
            got[gram] += count
    assert got == want
    place = np.zeros(charlm._POINTS, "int64")
    place[[ord(c) for c in "abc"]] = 1, 2, 3
    logs = charlm._Logs(pa.table({"gram": ["ab", "ca", "abc"], "cnt": [5, 2, 9]}), 2, 0.5, place, 4)
    assert logs(charlm._codes(np.array([1, 2, 0, 3, 1]), 2, 4)) == pytest.approx(np.log([5.5, 0.5, 0.5, 2.5, 0.5]))


def test_guard(spark):
    rows = spark.createDataFrame([("šarrum a", "šarrum b", False), ("šarrum a", "sarrum a", False), ("a\nb", "a b", False), ("abcdefgh", "abcdefgX", True)], "before string, after string, is_akkadian boolean")
    assert [r.accepted for r in guard.accept(rows).collect()] == [True, False, False, False]


def test_quality_filter(spark):
    box = lambda h: (0.0, 0.0, 9.0, float(h))
    lines = spark.createDataFrame([(1, 0.9, box(9)), (2, 0.5, box(9)), (3, None, box(7)), (4, None, None)], "line_no int, raw_confidence double, bbox struct<x0:double,y0:double,x1:double,y1:double>")
    assert [r.line_no for r in guard.quality_filter(lines).collect()] == [1, 4]


def test_votes_and_roles(spark):
    rows = spark.createDataFrame([(1, 0, "the evideuce is"), (1, 1, "the evidence is"), (1, 2, "tbe evidence 1s clear")], "page_id long, engine_ord int, text string")
    assert guard.word_votes(rows, ["page_id"]).first().text == "the evidence is clear"
    roles = spark.createDataFrame([("[12] Smith",), ("Fig. 3 a seal",), ("AKT 1, 1990",), ("um-ma a-na",)], "t string").select(guard.block_role(F.col("t"))).collect()
    assert [r[0] for r in roles] == ["reference", "figure", "header", "body"]


def test_pairing(spark):
    scored = spark.createDataFrame([(1, 1, 10, 0.9, "high", True), (1, 1, 11, 0.8, "high", True), (1, 2, 10, 0.85, "high", True)], "page_id long, source_id long, target_id long, score double, tier string, interlinear boolean")
    assert [(r.source_id, r.target_id) for r in pairing.greedy(scored).collect()] == [(1, 10)]
    assert sorted((r.source_id, r.target_id) for r in pairing.optimal(scored).collect()) == [(1, 11), (2, 10)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_pairs(spark, pages):
    """Scored pairs of pages of up to 5 by 5 blocks, and a plain list of each page's."""
    import random

    r = random.Random(5)
    each = {p: [(s, 10 + t, r.choice((0.41, 0.5, 0.9, r.random()))) for s in range(r.randint(1, 5)) for t in range(r.randint(1, 5)) if r.random() < 0.7] for p in range(pages)}
    rows = [(p, s, t, x, "low", True) for p, pairs in each.items() for s, t, x in pairs]
    return spark.createDataFrame(rows, "page_id long, source_id long, target_id long, score double, tier string, interlinear boolean").repartition(5), each


def batches_of(spark, rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def test_optimal_pairs_of_pages_across_batches(spark):
    df, each = random_pairs(spark, 60)

    def best(pairs, used=frozenset()):  # the greatest total, by trying all
        return max((x + best(pairs[k + 1 :], used | {("s", s), ("t", t)}) for k, (s, t, x) in enumerate(pairs) if not {("s", s), ("t", t)} & used), default=0.0)

    try:
        batches_of(spark, 7)  # pages begin in one batch and end in another
        got = pairing.optimal(df).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for p, pairs in each.items():
        mine = [r for r in got if r.page_id == p]
        assert len({r.source_id for r in mine}) == len({r.target_id for r in mine}) == len(mine)
        assert {(r.source_id, r.target_id, r.score) for r in mine} <= set(pairs) and sum(r.score for r in mine) == pytest.approx(best(pairs))
    assert "MapInArrow" in plan_of(pairing.optimal(df))  # no data frame for each page


def test_greedy_pairs_in_one_pass(spark):
    df, each = random_pairs(spark, 60)
    want = []
    for p, pairs in each.items():
        used = set()
        for s, t, x in sorted(pairs, key=lambda r: (-r[2], r[0], r[1])):
            if not {("s", s), ("t", t)} & used:
                used |= {("s", s), ("t", t)}
                want.append((p, s, t, x))
    try:
        batches_of(spark, 7)
        assert sorted((r.page_id, r.source_id, r.target_id, r.score) for r in pairing.greedy(df).collect()) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plan = plan_of(pairing.greedy(df))
    assert "MapInArrow" in plan and plan.count("Exchange hashpartitioning") == 1 and "ExistingRDD" not in plan.split("MapInArrow")[0]


def test_first_of_rows_that_share_a_block(spark, tmp_path):
    from quorumtext.plans.queries import QUERIES

    names = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string"
    side = lambda n, q: [(p, 5, n, q, 0.1, 0.05, "A") for p in range(300)]
    files = {"a": side(1, 1.0) + side(2, 1.0), "b": side(1, 20.0) + side(2, 9.0) * 5}  # the larger file is read first
    for name, rows in files.items():
        spark.createDataFrame(rows, names).coalesce(1).write.parquet(str(tmp_path / name))
        os.makedirs(tmp_path / "t/lineitem.parquet", exist_ok=True)
        part = next(f for f in os.listdir(tmp_path / name) if f.startswith("part"))
        os.rename(tmp_path / name / part, tmp_path / f"t/lineitem.parquet/{name}.parquet")
    for q in ("pairing_scores", "pairing_greedy", "pairing_optimal", "pairing_greedy_two_blocks", "pairing_optimal_two_blocks"):
        rows = QUERIES[q](spark, str(tmp_path / "t")).collect()
        assert len(rows) == 300 and {r.score for r in rows} == {0.7}  # both first rows are at the same height


@pytest.mark.parametrize("name", ["pairing_greedy_two_blocks", "pairing_optimal_two_blocks"])
def test_two_blocks_move_only_first_and_second_lines_once(spark, tmp_path, name):
    from quorumtext.plans.queries import QUERIES

    names = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string"
    spark.createDataFrame([(1, 5, 1, 1.0, 0.1, 0.05, "A"), (1, 5, 2, 1.0, 0.1, 0.05, "A")], names).write.parquet(str(tmp_path / "lineitem.parquet"))
    plan = plan_of(QUERIES[name](spark, str(tmp_path)))
    assert plan.count("Exchange hashpartitioning(page_id") == 2 and "ExistingRDD" not in plan  # a side each, nothing checkpointed
    for side in plan.split("Exchange hashpartitioning(page_id")[1:]:
        assert "l_linenumber" in side.split("Filter", 1)[1].split("\n")[0]  # filtered before it moves


@pytest.mark.parametrize("name", ["pairing_scores", "pairing_greedy_two_blocks", "pairing_optimal_two_blocks"])
def test_rows_without_a_block_id_pair_as_in_sql(spark, tmp_path, name):
    import duckdb

    from quorumtext.plans.queries import ORACLE, QUERIES

    line = lambda page, part, n: (page, part, n, 1.0, 0.1, 0.05, "A")
    rows = [line(1, None, 1), line(1, 5, 1), line(1, 6, 2), line(1, None, 2)]  # known blocks come before unknown ones
    rows += [line(2, None, 1), line(2, None, 2), line(3, 7, None), line(3, None, 1), line(3, 8, 2), line(4, None, 1), line(4, 9, 2)]  # unknown ones are one block
    names = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string"
    spark.createDataFrame(rows, names).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    db = duckdb.connect()
    db.execute("SET threads = 1")
    db.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    want = db.execute(ORACLE[name]).fetchall()
    assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect()), key=repr) == sorted(want, key=repr) and len(want) >= 2


def test_optimal_pairs_of_odd_scores_and_ids(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, 10, nan), (2, None, 10, 0.9), (2, 2, 10, 0.8), (2, None, None, 0.5), (3, 1, 10, inf), (3, 1, 11, 0.9), (3, 2, 10, 0.9), (3, 2, 11, 0.5), (4, 1, 10, -inf), (4, 2, 10, 0.5)]
    assert pairing._best_total([(1, 10, nan)]) == [0]
    df = spark.createDataFrame([(*r, "low", True) for r in rows], "page_id long, source_id long, target_id long, score double, tier string, interlinear boolean")
    got = {(r.page_id, r.source_id, r.target_id) for r in pairing.optimal(df).collect()}
    assert got == {(1, 1, 10), (2, 2, 10), (2, None, None), (3, 1, 10), (3, 2, 11), (4, 2, 10)}


def test_images(spark):
    rgb = np.arange(4 * 6 * 3, dtype="uint8").reshape(4, 6, 3) * 3
    made = images.made(rgb, images.VARIANTS)
    assert tuple(made) == images.VARIANTS and all(x.shape == rgb.shape and x.dtype == np.uint8 for x in made.values())
    assert set(np.unique(made["binary"])) <= {0, 255} and set(np.unique(made["morphology"])) <= {0, 255} and images.autocontrast(images.grayscale(rgb)).max() >= 254
    assert images.rotated(rgb, 360) is rgb and images.rotated(rgb, 90).shape == (6, 4, 3)
    df = spark.createDataFrame([(1, 6, 4, bytearray(rgb.tobytes()))], "page_id long, width int, height int, rgb binary")
    rows = images.variants(df, ("original", "binary"), (0, 90)).collect()
    assert {(r.angle, r.variant, r.width, r.height) for r in rows} == {(a, v, *((6, 4) if a == 0 else (4, 6))) for a in (0, 90) for v in ("original", "binary")}
    assert images.rendered(spark.createDataFrame([("a", 1, 1), ("a", 9, 2)], "pdf_path string, page int, page_id long"), lambda path, page, scale: rgb if page == 1 else None).count() == 1


def test_options(tmp_path):
    o = options.PipelineOptions.resolve({"paths": {"input_dir": "in"}, "output": {"output_directory": ""}, "ocr": {"engine": "PaddleOCR", "force_ocr_on_text_layer": True}})
    assert (o.inputs, o.output_root, o.ocr_fallback, o.force_ocr) == ("in", "reports/output", "paddle", True)
    assert options.PipelineOptions.resolve({}).ocr_fallback == "ensemble" and "ocr_fallback: paddle" in o.explain()
    with pytest.raises(ValueError, match="fallback"):
        options.PipelineOptions.resolve({}, engine="tesseract", force_ocr=True)
    with pytest.raises(FileNotFoundError):
        options.PipelineOptions.resolve({}, input_file=str(tmp_path / "none.pdf"))
    assert len(options.validate(str(tmp_path / "c.json"), str(tmp_path / "d"))) == 2
    assert options.EnsembleProfile.load(None).angles == (0, 90, 180, 270)
    assert engines.enabled(["kraken", "nosuch", "paddle"]) == ["kraken", "paddle"] and engines.enabled(None) == list(engines.DEFAULT_ENGINES)


def test_files(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("pdf_path\tpage_no\n# a comment\na, b.pdf\t3\na, b.pdf\t3\n")
    assert [tuple(r) for r in tables.manifest(spark, str(tmp_path / "m.tsv")).collect()] == [("a, b.pdf", 3)] * 2
    (tmp_path / "gold.csv").write_text('﻿PDF LINK,PAGE\n"x, y.pdf",1-3\n', encoding="utf-8")
    assert tables.gold_csv(spark, str(tmp_path / "gold.csv")).columns == ["PDF LINK", "PAGE"]
    for n in ("a.pdf", "b.PDF", "c.txt"):
        (tmp_path / n).write_bytes(b"x")
    assert sorted(os.path.basename(r.pdf_path) for r in tables.pdf_files(spark, str(tmp_path)).collect()) == ["a.pdf", "b.PDF"]
    pages = spark.createDataFrame([("a.pdf", 1, 'x\n"y"', True)], "pdf_name string, page int, page_text string, has_akkadian boolean")
    assert sinks.write_page_text(pages, str(tmp_path / "out.csv")) == 1
    raw = (tmp_path / "out.csv").read_bytes()
    assert raw.startswith(b"\xef\xbb\xbf") and raw.endswith(b"true\r\n") and b"x\\n" in raw
    assert next(csv.DictReader(open(tmp_path / "out.csv", encoding="utf-8-sig")))["page_text"] == 'x\\n"y"'
    assert tables.page_output(spark, str(tmp_path / "out.csv")).first().page_text == 'x\n"y"'


def test_plan_skips_recognition_where_the_layer_is_sound(spark):
    pages = spark.createDataFrame([(1, "a.pdf", 1, 520.0, "layer text", True), (2, "a.pdf", 2, 520.0, "", False)], "page_id long, pdf_name string, page int, page_width double, layer_text string, layer_ok boolean")
    line = "page_id long, angle int, angle_ord int, variant string, variant_ord int, line_no int, text string, bbox struct<x0:double,y0:double,x1:double,y1:double>, raw_confidence double"
    lines = spark.createDataFrame([(p, 0, 0, "original", 0, 0, "sa-ra-am i-na-an e-li-su DUMU", None, 0.9) for p in (1, 2)], line)
    with engines.registering(paddle=engines.recorded(lines)):
        got = {r.page: r for r in extract.page_text(pages, options.PipelineOptions()).collect()}
        assert (got[1].page_text, got[1].used_text_layer, got[1].has_akkadian) == ("layer text", True, False)
        assert (got[2].page_text, got[2].method, got[2].has_akkadian) == ("sa-ra-am i-na-an e-li-su DUMU", "ocr_ensemble", True)
        _, failed = engines.loaded(["paddle", "kraken"], pages)
        assert list(failed) == ["kraken"] and {r.page_id: len(r.errors) for r in extract.recognize(pages, options.EnsembleProfile()).collect()} == {1: 12, 2: 12}
        forced = {r.page: r for r in extract.page_text(pages, options.PipelineOptions(force_ocr=True)).collect()}
        assert forced[1].page_text.startswith("sa-ra-am") and not forced[1].used_text_layer
    assert not engines.registered()


def page_lines(spark, n, texts):
    """Pages without a layer, and recorded lines of each engine that say its own text; lines of other pages among them."""
    pages = spark.createDataFrame([(p, "a.pdf", p, 520.0, "", False) for p in range(n)], "page_id long, pdf_name string, page int, page_width double, layer_text string, layer_ok boolean")
    line = "page_id long, angle int, angle_ord int, variant string, variant_ord int, line_no int, text string, bbox struct<x0:double,y0:double,x1:double,y1:double>, raw_confidence double"
    rows = {e: spark.createDataFrame([(p, 0, 0, "original", 0, k, f"{t} line {k} of page {p}", None, 0.9) for p in range(n + 3) for k in range(2)], line) for e, t in texts.items()}
    return pages, rows


@pytest.mark.parametrize("shuffled", [False, True])
@pytest.mark.parametrize("count", [1, 2, 4])
def test_plan_with_several_engines(spark, count, shuffled):
    # sources may end in a join or a shuffle by page, which a union then claims to keep
    names = list(engines.DEFAULT_ENGINES[:count])
    pages, lines = page_lines(spark, 40, dict.fromkeys(names, "the same"))
    own = lambda df: lambda p: df.join(p.select("page_id").distinct(), "page_id", "left_semi").repartition(7, "page_id")
    for _ in range(3):
        with engines.registering(**{n: own(df) if shuffled else engines.recorded(df) for n, df in lines.items()}):
            found = extract.page_text(pages, options.PipelineOptions())
            got = {r.page: (r.page_text, r.method) for r in found.collect()}
        assert got == {p: (f"the same line 0 of page {p}\nthe same line 1 of page {p}", "ocr_ensemble") for p in range(40)}


def test_named_engine_reads_alone(spark):
    pages, lines = page_lines(spark, 2, {"paddle": "read by paddle", "doctr": "read by doctr, with more words and marks: šé"})
    with engines.registering(**{n: engines.recorded(df) for n, df in lines.items()}):
        alone = extract.page_text(pages, options.PipelineOptions.resolve({}, engine="PaddleOCR")).collect()
        both = extract.page_text(pages, options.PipelineOptions.resolve({})).collect()
        none = extract.page_text(pages, options.PipelineOptions.resolve({}, engine="tesseract")).collect()
    assert all(r.page_text.startswith("read by paddle") and r.method == "ocr_paddle" for r in alone)
    assert all(r.page_text.startswith("read by doctr") and r.method == "ocr_ensemble" for r in both) and all(r.page_text == "" for r in none)


def test_columns_resolve_as_a_run_does(spark):
    rows = [(a, b, e, f, g) for a in ("", None, "out") for b in ("", None, "conf") for e in ("", None, "PaddleOCR", "multi", "other") for f in (True, False) for g in (True, False, None)]
    df = spark.createDataFrame(rows, "a string, b string, e string, f boolean, g boolean")
    got = df.select("*", *[v.alias(k) for k, v in options.resolve_columns(*map(F.col, "abefg")).items()]).collect()
    for r in got:
        if (r.f or r.g) and r.ocr_fallback is None:
            continue  # a run refuses that
        o = options.PipelineOptions.resolve({"output": {"output_directory": r.b}, "ocr": {"force_ocr_on_text_layer": r.g}}, output_dir=r.a, engine=r.e, force_ocr=r.f)
        assert (o.output_root, o.ocr_fallback, o.force_ocr) == (r.output_root, r.ocr_fallback, r.force_ocr)


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([("a.pdf", 1, "sa-ra-am i-na-an e-li-su DUMU", True, 5), ("a.pdf", 2, "prose", False, 7)], "pdf_name string, page int, text string, used_text_layer boolean, ms long").withColumn("landed_at", F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    rows.write.parquet(str(tmp_path / "in"))
    streaming.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out/page_text"))
    assert {r.page: r.has_akkadian for r in out.collect()} == {1: True, 2: False}
    assert spark.read.parquet(str(tmp_path / "out/progress")).agg(F.sum("ms")).first()[0] == 12


def test_order_of_rows_does_not_matter(spark):
    from quorumtext.plans import queries as q

    import tempfile

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no driver tables here")
    shuffled = tempfile.mkdtemp()
    for name in ("documents", "conversations"):
        spark.read.parquet(f"{sf}/{name}.parquet").orderBy(F.rand(7)).repartition(3).write.parquet(f"{shuffled}/{name}.parquet")
    for f in (q.page_output, q.layout_columns, q.orientation_single):
        assert sorted(map(str, f(spark, sf).collect())) == sorted(map(str, f(spark, shuffled).collect()))
