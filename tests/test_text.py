import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from quorumtext.functions import text as T


def plain_key(t):
    bare = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", bare.casefold()).strip()


def plain_richness(t):
    score = 0
    for c in t:
        if unicodedata.combining(c) or (ord(c) > 127 and c.isalpha()):
            score += 1
        elif "ARABIC" in unicodedata.name(c, ""):
            score += 2
    return score / max(len(t), 1)


def plain_normal(t):
    return "\n".join(x for x in (re.sub(r"\s+", " ", line).strip() for line in t.splitlines()) if x)


@pytest.fixture(scope="module")
def samples():
    r = random.Random(5)
    blocks = ((32, 0x250), (0x300, 0x36F), (0x370, 0x4FF), (0x600, 0x6FF), (0x1D00, 0x20FF), (0xAC00, 0xAC80), (0xFB00, 0xFDFF))
    pool = [chr(p) for a, b in blocks for p in range(a, b)] + list("\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85  　 \xa0") * 20
    return ["".join(r.choice(pool) for _ in range(r.randint(0, 30))) for _ in range(800)] + ["ᵈUTU", "ﬁ", "İ", "ß", "ı", "٣", "،", "", "ΣΑΣ", "ẞ", "한글"]


def test_against_python(spark, samples):
    c = F.col("t")
    df = spark.createDataFrame(list(enumerate(samples)), "i int, t string")
    rows = df.select("i", T.comparison_key(c).alias("k"), T.diacritic_richness(c).alias("r"), T.normalize_whitespace(c).alias("n"), T.split_lines(c).alias("l"), T.alnum_ratio(c).alias("a"), T.contains_arabic(c).alias("ar")).collect()
    for x in rows:
        t = samples[x.i]
        assert x.k == plain_key(t)
        assert x.r == pytest.approx(plain_richness(t))
        assert x.n == plain_normal(t)
        assert x.l == ([s.strip() for s in t.splitlines() if s.strip()] or [t.strip()])
        assert x.a == pytest.approx(sum(ch.isalnum() for ch in t) / max(len(t), 1))
        assert x.ar == any(a <= ord(ch) <= z for ch in t for a, z in T.ARABIC_BLOCKS)


@pytest.mark.parametrize("given, key", [("ᵈUTU", "dutu"), ("ﬁ", "fi"), ("İ", "i"), ("ß", "ss"), ("ı", "ı")])
def test_keys(spark, given, key):
    assert spark.range(1).select(T.comparison_key(F.lit(given))).first()[0] == key


@pytest.mark.parametrize("given, richness", [("ᵈUTU", 0.25), ("٣", 2.0), ("،", 2.0), ("", 0.0)])
def test_richness(spark, given, richness):
    assert spark.range(1).select(T.diacritic_richness(F.lit(given))).first()[0] == richness


def test_names(spark):
    got = spark.range(1).select(T.page_file_name(F.lit("Alp, spasiya and x.PDF"), F.lit(2)), T.engine_at_angle(F.lit("paddle"), F.lit(90)), T.escape_newlines(F.lit("a\nb"))).first()
    assert tuple(got) == ("Alp_spasiya_and_x_page_2.pdf", "paddle@90", "a\\nb")


def test_keys_lower_a_text_once(spark):
    plan = spark.range(1).select(T.comparison_key(F.concat(F.col("id").cast("string"), F.lit("É"))).alias("k"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1
