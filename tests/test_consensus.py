import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from quorumtext.functions.similarity import ratio
from quorumtext.operators import fusion as U
from quorumtext.operators.candidates import best_variant, readings
from quorumtext.operators.layout import reading_order

CANDIDATE = "page_id long, angle int, angle_ord int, engine string, engine_ord int, text string, confidence double, variant string, line_count int"


def candidates(spark, rows):
    return spark.createDataFrame([(p, a, o, e, k, t, c, "v", n) for p, a, o, e, k, t, c, n in rows], CANDIDATE)


DIACRITICS = [(1, 0, 0, "paddle", 0, "sarrum und uber", 0.80, None), (1, 0, 0, "doctr", 1, "šarrum und über", 0.78, None), (1, 0, 0, "mmocr", 2, "šarrum und über", 0.77, None)]
OUTLIER = [(2, 0, 0, "paddle", 0, "The evidence is clear.", 0.81, None), (2, 0, 0, "doctr", 1, "The evidence is clear.", 0.79, None), (2, 0, 0, "mmocr", 2, "The evideuce 1s clear.", 0.65, None)]


def test_line_consensus(spark):
    df = candidates(spark, DIACRITICS + OUTLIER)
    got = {r.page_id: r for r in U.fuse(df).collect()}
    assert (got[1].engine, got[1].text, got[1].method) == ("ensemble", "šarrum und über", "line_consensus")
    assert got[2].text == "The evidence is clear." and got[2].sources == ["paddle", "doctr", "mmocr"] and got[2].winner is None
    scores = {r.page_id: [x.score for x in r.options[0]] for r in U.line_scores(U.gathered(df)).collect()}
    assert scores[1] == pytest.approx([1.43, 1.488, 1.487]) and scores[2] == pytest.approx([1.34009, 1.33809, 1.32409], abs=1e-5)


def test_branches(spark):
    df = candidates(spark, [(1, 0, 0, "a", 0, "alone", 0.5, None), (2, 0, 0, "a", 0, "one\ntwo", 0.5, 2), (2, 0, 0, "b", 1, "one two", 0.6, 1), (3, 0, 0, "a", 0, " ", 0.9, None), (4, 0, 0, "a", 0, "x", 0.5, None), (4, 0, 0, "b", 1, "x", 0.5, None)])
    got = {r.page_id: r for r in U.fuse(df).collect()}
    assert 3 not in got and (got[1].engine, got[1].method) == ("a", None)
    assert (got[2].method, got[2].winner, got[2].confidence) == ("whole_text_consensus", "b", 0.6)
    assert got[4].text == "x"  # equal options: the first engine


def test_orientation(spark):
    df = candidates(spark, [(1, 0, 0, "a", 0, "x", 0.05, None), (1, 90, 1, "a", 0, "Recovered upright text", 0.95, None)])
    best = U.best_orientation(U.orientation_scores(U.fuse(df, keep_candidates=True))).first()
    assert best.rotation_angle == 90 and best.orientation_scores == {"0": 0.4775, "90": 1.3361} and best.winner == "ensemble"
    pages = spark.createDataFrame([(1,), (2,)], "page_id long")
    assert {r.page_id: r.text for r in U.extract_pages(pages, df).collect()} == {1: "Recovered upright text", 2: ""}


def plain_scores(cs, weights):
    """Whole-text scores from the formula, over (engine, text, confidence, line_count)."""
    from tests.test_text import plain_key, plain_richness

    out = []
    for e, t, c, n in cs:
        sims = [SequenceMatcher(None, plain_key(t), plain_key(o[1])).ratio() for o in cs if o[0] != e]
        out.append(weights.get(e, 1.0) * 0.35 + (sum(sims) / len(sims) if sims else 0) + plain_richness(t) * 0.4 + min(len(t.strip()) / 300, 1) * 0.1 + max(c, 0) * 0.15 + min((n or 0) / 12, 1) * 0.12)
    return out


def test_whole_scores_on_random_pages(spark):
    r = random.Random(3)
    pages, rows = {}, []
    for p in range(40):
        base = "".join(r.choice("abc šéü\n") for _ in range(r.randint(1, 400))) + "x"
        pages[p] = [(e, "".join(ch if r.random() > 0.1 else r.choice("xyz") for ch in base), r.random(), r.choice([None, 5, 20])) for e in "abcd"[: r.randint(1, 4)]]
        rows += [(p, 0, 0, e, k, t, c, n) for k, (e, t, c, n) in enumerate(pages[p])]
    got = U.whole_scores(U.gathered(candidates(spark, rows)), {"b": 1.3}).collect()
    for row in got:
        viable = [c for c in pages[row.page_id] if c[1].strip()]
        assert row.whole == pytest.approx(plain_scores(viable, {"b": 1.3}))


def test_similarity_is_that_of_difflib():
    r = random.Random(1)
    for _ in range(200):
        a, b = ("".join(r.choice("ab c") for _ in range(r.choice((0, 3, 50, 250)))) for _ in range(2))
        assert ratio(a, b) == SequenceMatcher(None, a, b).ratio()
    long = "abcdefghij" * 40
    assert ratio(long, long[:200] + "x" + long[200:]) < 0.6  # popular characters are left out


def test_similarity_of_popular_and_repeated_characters():
    r = random.Random(4)
    for n in range(600):
        signs = r.choice(("ab", "ab c", "abcdefgh ij", "abcdefghijklmnopqrstuvwxyzéšß\U0001f600"))
        a = "".join(r.choice(signs) for _ in range(r.choice((1, 20, 99, 199, 200, 300))))
        b = "".join(c if r.random() > 0.1 else r.choice(signs + "#") for c in a)[r.randint(0, 5) :] if n % 2 else "".join(r.choice(signs) for _ in range(r.choice((1, 50, 199, 200, 201))))
        assert ratio(a, b) == SequenceMatcher(None, a, b).ratio()


def test_matching_does_not_search_again_for_what_a_range_cannot_hold():
    class Searched(str):
        times = 0

        def find(self, *args):
            Searched.times += 1
            return super().find(*args)

    shared = [chr(0x400 + k) for k in range(95)]
    a, b = "".join(c + "1" for c in shared), "".join(c + "2" for c in shared)  # blocks of one character each
    assert ratio(a, Searched(b)) == SequenceMatcher(None, a, b).ratio() and Searched.times < 400


def test_line_scores_on_pages_of_several_lines(spark):
    from tests.test_text import plain_key, plain_richness

    r = random.Random(6)
    pages, rows = {}, []
    for p in range(30):
        lines = ["x" + "".join(r.choice("ab šé") for _ in range(r.randint(1, 30))) + "x" for _ in range(r.choice((1, 1, 2, 7)))]
        pages[p] = [[x if r.random() < 0.4 else x.replace("a", r.choice("aáu")) for x in lines] for _ in range(r.randint(2, 4))]
        rows += [(p, 0, 0, e, k, " \n".join(x), 0.5, None) for k, (e, x) in enumerate(zip("abcd", pages[p]))]
    for row in U.line_scores(U.gathered(candidates(spark, rows))).collect():
        for n, options in enumerate(row.options):
            read = [c[n] for c in pages[row.page_id]]
            for x, option in zip(read, options):
                sims = [SequenceMatcher(None, plain_key(x), plain_key(y)).ratio() for y in read if y != x]
                assert option.line == x and option.score == pytest.approx(0.35 + (sum(sims) / len(sims) if sims else 0) + plain_richness(x) * 0.45 + 0.05)


def test_one_worker_compares_and_only_what_differs(spark, monkeypatch):
    df = candidates(spark, DIACRITICS + OUTLIER)
    scored = U.orientation_scores(U.fuse(df, keep_candidates=True))
    assert scored._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    sent = F.udf(lambda a, b: [str((x, y)) for x, y in zip(a, b)], "array<string>")
    monkeypatch.setattr(U, "similarities", lambda a, b: F.transform(sent(a, b), lambda x: F.lit(0.5) + F.assert_true(x == "(None, None)").cast("double")))
    alike = candidates(spark, [(1, 0, 0, e, k, "šarrum\nund", 0.5, None) for k, e in enumerate("abcd")])
    assert U.fuse(alike, keep_candidates=True).first().text == "šarrum\nund"  # nothing but nulls was sent


LINE = "page_id long, line_no int, text string, bbox struct<x0:double,y0:double,x1:double,y1:double>, page_width double"


def order(spark, lines, width=520.0):
    df = spark.createDataFrame([(1, i, t, b, width) for i, (t, b) in enumerate(lines)], LINE)
    return [r.text for r in reading_order(df, ["page_id"]).orderBy("position").collect()]


COLUMNS = [("Right top", (310.0, 40.0, 470.0, 60.0)), ("Left top", (40.0, 45.0, 200.0, 65.0)), ("Right bottom", (312.0, 90.0, 475.0, 110.0)), ("Left bottom", (42.0, 92.0, 205.0, 112.0))]


def test_two_columns(spark):
    assert order(spark, COLUMNS) == ["Left top", "Left bottom", "Right top", "Right bottom"]
    assert order(spark, [("no box", None), *COLUMNS])[-1] == "no box"
    assert order(spark, COLUMNS[:3]) == ["Right top", "Left top", "Right bottom"]  # too few for columns
    assert order(spark, [(" ", None), ("a", None)]) == ["a"]


def test_wide_page_has_one_column(spark):
    assert order(spark, COLUMNS, 5000.0) == ["Right top", "Left top", "Right bottom", "Left bottom"]


def test_best_variant_is_the_first_of_equals(spark):
    lines = [(1, 0, 0, "paddle", 0, v, k, 0, t, None, c, 520.0) for k, (v, t, c) in enumerate([("adaptive", "abc", None), ("original", "abc", 0.0), ("binary", "abcd", None)])]
    df = spark.createDataFrame(lines, "page_id long, angle int, angle_ord int, engine string, engine_ord int, variant string, variant_ord int, line_no int, text string, bbox struct<x0:double,y0:double,x1:double,y1:double>, raw_confidence double, page_width double")
    assert best_variant(readings(df)).first().variant == "binary"
    assert best_variant(readings(df.where("variant <> 'binary'"))).first().variant == "adaptive"


@pytest.mark.parametrize("ok, ocr, force, want", [(True, "o", False, ("layer", True, "text_layer")), (False, "šar-ru-um", False, ("šar-ru-um", False, "ocr_ensemble")), (True, "ocr text", True, ("ocr text", False, "ocr_ensemble")), (True, "", True, ("layer", True, "text_layer"))])
def test_text_source(spark, ok, ocr, force, want):
    df = spark.createDataFrame([("layer" if ok else "", ok, ocr)], "layer_text string, layer_ok boolean, ocr_text string")
    r = U.choose_text(df, force).first()
    assert (r.page_text, r.used_text_layer, r.method) == want
