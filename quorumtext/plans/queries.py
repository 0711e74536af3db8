"""The registered queries, each over whole tables, with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorumtext.functions import charlm, geometry, text
from quorumtext.operators import candidates as readings
from quorumtext.operators import detect, evaluate, fusion, guard, layout, manifest, pairing, pairs
from quorumtext.plans import extract
from quorumtext.plans.options import PipelineOptions, dispatch_column, resolve_columns
from quorumtext.schema import BOX
from quorumtext.sources import derived, engines, sinks

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# SQL for derived inputs -------------------------------------------------------------------------------------------------

LINES = """lines AS (SELECT doc_id, source, lang, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line
  FROM (SELECT *, string_split(text, chr(10)) AS l FROM documents)), full_lines AS (SELECT * FROM lines WHERE trim(line) <> '')"""
BOXES = LINES + """, boxed AS (SELECT doc_id, line_no, line AS text, line_no % 11 <> 10 AS has_box,
    CASE WHEN line_no % 11 <> 10 THEN 40.0 + 270.0 * (CASE WHEN doc_id % 2 = 0 THEN line_no % 2 ELSE 0 END) END::DOUBLE AS x0,
    CASE WHEN line_no % 11 <> 10 THEN 40.0 + 22.0 * (line_no // 2) END::DOUBLE AS y0 FROM full_lines)"""
CENTERS = BOXES + """, centers AS (SELECT *, CASE WHEN has_box THEN (x0 + x0 + 200.0) / 2 END AS center FROM boxed),
  gaps AS (SELECT *, lead(center) OVER (PARTITION BY doc_id ORDER BY center NULLS LAST, line_no) - center AS gap FROM centers)"""
TURNS = "turns AS (SELECT conv_id * 1000 + turn AS page_id, coalesce(text, '') AS text FROM conversations)"
KEY = "trim(regexp_replace(replace(lower(strip_accents({0})), 'ß', 'ss'), '\\s+', ' ', 'g'))"
CANDIDATES = TURNS + """, readings AS (
    SELECT page_id, text AS page_text, 'paddle' AS engine, 0 AS engine_ord, strip_accents(text) AS text, 0.80::DOUBLE AS confidence FROM turns
    UNION ALL SELECT page_id, text, 'doctr', 1, text, 0.78 FROM turns
    UNION ALL SELECT page_id, text, 'mmocr', 2, translate(text, 'nl', 'u1'), 0.65 FROM turns
    UNION ALL SELECT page_id, text, 'kraken', 3, CASE WHEN page_id % 3 = 0 THEN text || chr(10) || 'x' ELSE text END, 0.77 FROM turns),
  candidates AS (SELECT page_id, 0 AS angle, 0 AS angle_ord, engine, engine_ord, text, confidence FROM readings
    UNION ALL SELECT page_id, 180, 1, engine, engine_ord, reverse(text), 0.05 FROM readings)"""
RICHNESS = "(length({0}) - length(regexp_replace({0}, '[^\\x00-\\x7F\\P{{L}}]', '', 'g')))::DOUBLE / greatest(length({0}), 1)"


# Text -------------------------------------------------------------------------------------------------------------------


@query("""SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS normal_text FROM documents""")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.table(spark, sf_dir, "documents").select("doc_id", text.normalize_whitespace(F.col("text")).alias("normal_text"))


@query(f"SELECT doc_id, {KEY.format('text')} AS text_key FROM documents")
def comparison_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.table(spark, sf_dir, "documents").select("doc_id", text.comparison_key(F.col("text")).alias("text_key"))


@query(f"SELECT doc_id, round({RICHNESS.format('text')}, 6) AS richness FROM documents")
def diacritic_richness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.table(spark, sf_dir, "documents").select("doc_id", F.round(text.diacritic_richness(F.col("text")), 6).alias("richness"))


@query("""SELECT doc_id, regexp_matches(text, '[\\x{0600}-\\x{06FF}\\x{0750}-\\x{077F}\\x{08A0}-\\x{08FF}\\x{FB50}-\\x{FDFF}\\x{FE70}-\\x{FEFF}]') AS arabic,
  round(length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g'))::DOUBLE / greatest(length(text), 1), 6) AS alnum_ratio,
  round(least(length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) / 300.0::DOUBLE, 1.0), 6) AS completeness FROM documents""")
def script_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return derived.table(spark, sf_dir, "documents").select("doc_id", text.contains_arabic(t).alias("arabic"), F.round(text.alnum_ratio(t), 6).alias("alnum_ratio"), F.round(text.completeness(t), 6).alias("completeness"))


@query(f"WITH {LINES} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(length(line) AS INTEGER) AS line_chars FROM full_lines")
def line_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.doc_lines(spark, sf_dir).select("doc_id", "line_no", F.length("line").alias("line_chars"))


@query("""SELECT doc_id, replace(replace(source, ',', ''), ' ', '_') || '_page_' || (doc_id % 50 + 1) || '.pdf' AS output_file FROM documents""")
def output_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.table(spark, sf_dir, "documents").select("doc_id", text.page_file_name(F.concat("source", F.lit(".PDF")), F.col("doc_id") % 50 + 1).alias("output_file"))


# Manifests and options --------------------------------------------------------------------------------------------------

GOLD = """gold AS (SELECT 'c' || o_custkey || '.pdf' AS pdf, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 9 || '-' || (o_orderkey % 5 + 2) WHEN 1 THEN ' ' || o_orderkey % 30 || ' ' WHEN 2 THEN 'n/a' ELSE '' END AS page,
    o_orderkey % 9 AS a, o_orderkey % 5 + 2 AS b, o_orderkey FROM orders), files AS (SELECT 'c' || c_custkey || '.pdf' AS pdf FROM customer WHERE c_acctbal > 0)"""
EXPANDED = """SELECT pdf AS pdf_path, unnest(generate_series(least(a, b), greatest(a, b))) AS page FROM gold WHERE o_orderkey % 4 = 0
  UNION ALL SELECT pdf, o_orderkey % 30 FROM gold WHERE o_orderkey % 4 = 1"""


def _gold(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("o_orderkey")
    page = F.when(k % 4 == 0, F.concat_ws("-", k % 9, k % 5 + 2)).when(k % 4 == 1, F.concat(F.lit(" "), (k % 30).cast("string"), F.lit(" "))).when(k % 4 == 2, "n/a").otherwise("")
    gold = derived.table(spark, sf_dir, "orders").select(F.concat(F.lit("c"), "o_custkey", F.lit(".pdf")).alias("PDF LINK"), page.alias("PAGE"))
    files = derived.table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.concat(F.lit("c"), "c_custkey", F.lit(".pdf")).alias("pdf_path"))
    return gold, files


@query(f"WITH {GOLD}, m AS ({EXPANDED}) SELECT pdf_path, CAST(page AS INTEGER) AS page FROM m")
def manifest_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.build_manifest(*_gold(spark, sf_dir), expand_ranges=True)


@query(f"WITH {GOLD} SELECT pdf AS pdf_path, CAST(o_orderkey % 30 AS INTEGER) AS page FROM gold WHERE o_orderkey % 4 = 1")
def manifest_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.build_manifest(*_gold(spark, sf_dir))


@query(f"WITH {GOLD}, m AS ({EXPANDED}) SELECT pdf_path, CAST(page AS INTEGER) AS page FROM m WHERE pdf_path IN (SELECT pdf FROM files)")
def manifest_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.build_manifest(*_gold(spark, sf_dir), expand_ranges=True, strict=True)


@query(f"WITH {GOLD} SELECT DISTINCT pdf AS pdf_path FROM gold WHERE page <> '' AND pdf NOT IN (SELECT pdf FROM files)")
def manifest_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.missing_files(*_gold(spark, sf_dir))


@query("SELECT c_custkey, CAST(unnest(generate_series(1, greatest(c_custkey % 6, 1))) AS INTEGER) AS page FROM customer")
def single_pdf_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pdfs = derived.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pdf_path"), F.when(F.col("c_custkey") % 6 > 0, (F.col("c_custkey") % 6).cast("int")).alias("page_count"))
    return manifest.single_pdf(pdfs).withColumnRenamed("pdf_path", "c_custkey")


ENGINES = ["PaddleOCR", "ensemble", "Multi-engine", "tesseract", ""]


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'paddle' WHEN 1 THEN 'ensemble' WHEN 2 THEN 'ensemble' END AS fallback FROM events""")
def engine_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.get(F.array(*map(F.lit, ENGINES)), (F.col("event_id") % 5).cast("int"))
    return derived.table(spark, sf_dir, "events").select("event_id", dispatch_column(name).alias("fallback"))


@query("""SELECT event_id, coalesce(nullif(CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END, ''), nullif(props, ''), 'reports/output') AS output_root,
  CASE event_id % 5 WHEN 0 THEN 'paddle' WHEN 3 THEN NULL ELSE 'ensemble' END AS ocr_fallback, event_id % 7 = 0 OR event_type = 'error' AS force_ocr FROM events""")
def option_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs' arguments and configuration; an engine that isn't named is the ensemble."""
    given = F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type"))
    engine = F.get(F.array(*map(F.lit, ENGINES)), (F.col("event_id") % 5).cast("int"))
    found = resolve_columns(given, F.col("props"), engine, F.col("event_id") % 7 == 0, F.col("event_type") == "error")
    return derived.table(spark, sf_dir, "events").select("event_id", *[v.alias(k) for k, v in found.items()])


# Layout and geometry ----------------------------------------------------------------------------------------------------


@query(f"WITH {CENTERS} SELECT doc_id, round(max(gap), 6) AS widest_gap, count(center) AS boxed FROM gaps GROUP BY doc_id")
def layout_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = layout.column_gap(derived.boxed_lines(spark, sf_dir), ["doc_id"])
    return found.groupBy("doc_id").agg(F.round(F.max("gap"), 6).alias("widest_gap"), F.count("center").alias("boxed"))


@query(f"""WITH {BOXES} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY y0 NULLS LAST, x0 NULLS LAST, line_no) AS INTEGER) AS position FROM boxed""")
def layout_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = layout.reading_order(derived.boxed_lines(spark, sf_dir), ["doc_id"], layout.Layout(detect_multi_column=False))
    return ordered.select("doc_id", "line_no", "position")


@query(f"""WITH {CENTERS}, page AS (SELECT doc_id, count(center) AS n, max(gap) AS gap, sum((x0 < 200)::INT) AS left_n, sum((x0 > 200)::INT) AS right_n FROM gaps GROUP BY doc_id),
  j AS (SELECT g.*, n >= 4 AND p.gap >= 72.8 AND left_n >= 2 AND right_n >= 2 AS two FROM gaps g JOIN page p USING (doc_id))
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CASE WHEN coalesce(two, false) THEN 2 ELSE 1 END AS columns,
  CAST(row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN x0 IS NULL THEN NULL WHEN coalesce(two, false) THEN (x0 > 200)::INT ELSE 0 END NULLS LAST, y0 NULLS LAST, x0 NULLS LAST, line_no) AS INTEGER) AS position FROM j""")
def layout_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.reading_order(derived.boxed_lines(spark, sf_dir), ["doc_id"]).select("doc_id", "line_no", "columns", "position")


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS v FROM embeddings)
SELECT vec_id, round(list_min(list_transform(generate_series(1, 63, 2), lambda i: v[i])), 6) AS x0, round(list_min(list_transform(generate_series(2, 64, 2), lambda i: v[i])), 6) AS y0,
  round(list_max(list_transform(generate_series(1, 63, 2), lambda i: v[i])), 6) AS x1, round(list_max(list_transform(generate_series(2, 64, 2), lambda i: v[i])), 6) AS y1 FROM e""")
def bbox_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.slice(F.col("embedding").cast("array<double>"), i * 2 + 1, F.lit(2)))
    found = derived.table(spark, sf_dir, "embeddings").select("vec_id", geometry.polygon_box(points).alias("b"))
    return found.select("vec_id", *[F.round(f"b.{c}", 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS v FROM embeddings)
SELECT vec_id, round(v[1] * 520.0, 6) AS x0, round(v[2] * 720.0, 6) AS y0, round(v[3] * 520.0, 6) AS x1, round(v[4] * 720.0, 6) AS y1, round((v[1] * 520.0 + v[3] * 520.0) / 2.0, 6) AS center FROM e""")
def bbox_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    b = geometry.scaled_box(F.array(F.slice(v, 1, 2), F.slice(v, 3, 2)), F.lit(520.0), F.lit(720.0))
    found = derived.table(spark, sf_dir, "embeddings").select("vec_id", b.alias("b"))
    return found.select("vec_id", *[F.round(f"b.{c}", 6).alias(c) for c in ("x0", "y0", "x1", "y1")], F.round(geometry.x_center(F.col("b")), 6).alias("center"))


# Candidates and fusion --------------------------------------------------------------------------------------------------


def _read_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxed lines as two variants of one engine's reading, with some confidences missing."""
    lines = derived.boxed_lines(spark, sf_dir).withColumnRenamed("doc_id", "page_id")
    sure = F.when(F.col("line_no") % 5 != 0, (F.col("line_no") % 10) / 10.0)
    variants = F.array(F.struct(F.lit("adaptive").alias("variant"), F.lit(0).alias("variant_ord"), sure.alias("raw_confidence")), F.struct(F.lit("original").alias("variant"), F.lit(1).alias("variant_ord"), (sure + (F.col("page_id") % 3) / 100.0).alias("raw_confidence")))
    fixed = {"angle": F.lit(0), "angle_ord": F.lit(0), "engine": F.lit("paddle"), "engine_ord": F.lit(0)}
    return lines.withColumns(fixed).select("*", F.inline(variants))


@query(f"""WITH {BOXES}, c AS (SELECT doc_id AS page_id, line_no, CASE WHEN line_no % 5 <> 0 THEN line_no % 10 / 10.0::DOUBLE END AS sure FROM boxed)
SELECT page_id, 'adaptive' AS variant, round(coalesce(avg(sure), 0), 6) AS confidence, CAST(count(*) AS INTEGER) AS line_count FROM c GROUP BY page_id
UNION ALL SELECT page_id, 'original', round(coalesce(avg(sure + page_id % 3 / 100.0::DOUBLE), 0), 6), CAST(count(*) AS INTEGER) FROM c GROUP BY page_id""")
def candidate_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.readings(_read_lines(spark, sf_dir)).select("page_id", "variant", F.round("confidence", 6).alias("confidence"), "line_count")


@query(f"""WITH {BOXES}, c AS (SELECT doc_id AS page_id, bool_or(line_no % 5 <> 0) AS any_sure FROM boxed GROUP BY doc_id)
SELECT page_id, CASE WHEN any_sure AND page_id % 3 > 0 THEN 'original' ELSE 'adaptive' END AS variant FROM c""")
def candidate_best_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.best_variant(readings.readings(_read_lines(spark, sf_dir))).select("page_id", "variant")


@query(f"WITH {CANDIDATES} SELECT a.page_id, a.angle, a.engine AS engine_a, b.engine AS engine_b FROM candidates a JOIN candidates b USING (page_id, angle) WHERE a.engine <> b.engine")
def pair_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.candidate_pairs(derived.candidates(spark, sf_dir)).select("page_id", "angle", "engine_a", "engine_b")


@query(f"WITH {CANDIDATES} SELECT a.page_id, a.angle, a.engine AS engine_a, b.engine AS engine_b FROM candidates a JOIN candidates b USING (page_id, angle) WHERE a.engine_ord < b.engine_ord")
def pair_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.unordered_pairs(derived.candidates(spark, sf_dir)).select("page_id", "angle", "engine_a", "engine_b")


@query(f"""WITH {CANDIDATES}, s AS (SELECT *, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS f FROM candidates),
  l AS (SELECT page_id, angle, engine, generate_subscripts(k, 1) - 1 AS line_no, unnest(k) AS line FROM (SELECT *, CASE WHEN len(f) > 0 THEN f ELSE [trim(text)] END AS k FROM s))
SELECT a.page_id, a.angle, CAST(line_no AS INTEGER) AS line_no, a.engine AS engine_a, b.engine AS engine_b FROM l a JOIN l b USING (page_id, angle, line_no) WHERE a.line <> b.line""")
def pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.line_pairs(derived.candidates(spark, sf_dir)).select("page_id", "angle", "line_no", "engine_a", "engine_b")


@query(f"""WITH {CANDIDATES} SELECT page_id, angle, engine, round(CASE engine WHEN 'paddle' THEN 0.9 WHEN 'doctr' THEN 1.2 ELSE 1.0 END, 3)::DOUBLE AS weight FROM candidates""")
def engine_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = spark.createDataFrame([("paddle", 0.9), ("doctr", 1.2)], "engine string, weight double")
    return pairs.weighted(derived.candidates(spark, sf_dir), weights).select("page_id", "angle", "engine", "weight")


@query()
def whole_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fusion.whole_scores(fusion.gathered(derived.candidates(spark, sf_dir)), {"doctr": 1.1})
    return scored.select("page_id", "angle", F.inline(F.arrays_zip(F.transform("c", lambda x: x["engine"]).alias("engine"), F.transform("whole", lambda s: F.round(s, 6)).alias("score"))))


@query()
def fuse_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    fused = fusion.fuse(derived.candidates(spark, sf_dir))
    return fused.select("page_id", "angle", "engine", "text", F.round("confidence", 6).alias("confidence"), "method", "winner", F.array_join("engines_used", ",").alias("engines_used"))


@query()
def orientation_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fusion.best_orientation(fusion.orientation_scores(fusion.fuse(derived.candidates(spark, sf_dir), keep_candidates=True)))
    return found.select("page_id", "rotation_angle", "winner", "text", F.map_values("orientation_scores")[0].alias("first_score"))


#: Readings whose comparison keys are equal: with marks and without, in capitals, and with every blank a line end, so that similarities are 1.
EQUAL = TURNS + """, readings AS (SELECT page_id, 'paddle' AS engine, 0 AS engine_ord, strip_accents(text) AS text, 0.80::DOUBLE AS confidence, 3 AS line_count FROM turns
    UNION ALL SELECT page_id, 'doctr', 1, text, 0.78, 24 FROM turns UNION ALL SELECT page_id, 'kraken', 2, replace(text, ' ', chr(10)), -0.5, NULL FROM turns),
  sized AS (SELECT *, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS n_lines FROM readings WHERE regexp_replace(text, '\\s+', '', 'g') <> '')"""
COMPLETENESS = "least(length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) / 300.0::DOUBLE, 1.0)"


def _equal_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = derived.turns(spark, sf_dir)
    rows = [("paddle", text.strip_diacritics(F.col("text")), 0.80, 3), ("doctr", F.col("text"), 0.78, 24), ("kraken", F.replace("text", F.lit(" "), F.lit("\n")), -0.5, None)]
    made = F.array(*[F.struct(F.lit(e).alias("engine"), F.lit(k).alias("engine_ord"), x.alias("text"), F.lit(c).alias("confidence"), F.lit(n).cast("int").alias("line_count")) for k, (e, x, c, n) in enumerate(rows)])
    return t.select("page_id", F.lit(0).alias("angle"), F.lit(0).alias("angle_ord"), F.inline(made), F.lit("original").alias("variant"))


@query(f"""WITH {EQUAL} SELECT page_id, engine, round(CASE engine WHEN 'doctr' THEN 1.1 ELSE 1.0 END * 0.35 + 1.0 + {RICHNESS.format('text')} * 0.4 + {COMPLETENESS} * 0.1
    + greatest(confidence, 0.0) * 0.15 + least(coalesce(line_count, 0) / 12.0::DOUBLE, 1.0) * 0.12, 6) AS score FROM sized""")
def whole_scores_equal_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """whole_scores where all readings agree but for marks and white space."""
    scored = fusion.whole_scores(fusion.gathered(_equal_keys(spark, sf_dir)), {"doctr": 1.1})
    return scored.select("page_id", F.inline(F.arrays_zip(F.transform("c", lambda x: x["engine"]).alias("engine"), F.transform("whole", lambda s: F.round(s, 6)).alias("score"))))


@query(f"""WITH {EQUAL}, s AS (SELECT *, 0.35 + 1.0 + {RICHNESS.format('text')} * 0.4 + {COMPLETENESS} * 0.1 + greatest(confidence, 0.0) * 0.15 + least(coalesce(line_count, 0) / 12.0::DOUBLE, 1.0) * 0.12 AS score FROM sized),
  g AS (SELECT page_id, min(n_lines) = max(n_lines) AS same, arg_max(engine, (round(score, 9), -engine_ord)) AS best, arg_max(confidence, (round(score, 9), -engine_ord)) AS sure, avg(confidence) AS mean FROM s GROUP BY page_id)
SELECT page_id, CASE WHEN same THEN 'line_consensus' ELSE 'whole_text_consensus' END AS method, CASE WHEN NOT same THEN best END AS winner, round(CASE WHEN same THEN mean ELSE sure END, 6) AS confidence FROM g""")
def fuse_equal_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which way pages are fused, and by whom, where all readings agree but for marks and white space."""
    return fusion.fuse(_equal_keys(spark, sf_dir)).select("page_id", "method", "winner", F.round("confidence", 6).alias("confidence"))


@query(f"""WITH {TURNS} SELECT 'c.pdf' AS pdf_name, CAST(page_id AS INTEGER) AS page, CASE WHEN page_id % 3 = 0 THEN text ELSE
    array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) END AS page_text,
    page_id % 3 = 0 AS used_text_layer, CASE WHEN page_id % 3 = 0 THEN 'text_layer' ELSE 'ocr_ensemble' END AS method FROM turns""")
def page_text_engines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole page plan with four recorded engines that read alike, surely and less so."""
    t = derived.turns(spark, sf_dir)
    pages = t.select("page_id", F.lit("c.pdf").alias("pdf_name"), F.col("page_id").cast("int").alias("page"), F.lit(520.0).alias("page_width"), F.col("text").alias("layer_text"), (F.col("page_id") % 3 == 0).alias("layer_ok"))
    fixed = {"angle": F.lit(0), "angle_ord": F.lit(0), "variant": F.lit("original"), "variant_ord": F.lit(0), "bbox": F.lit(None).cast(BOX)}
    lines = t.select("page_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text")).withColumns(fixed)
    sources = {n: engines.recorded(lines.withColumn("raw_confidence", F.lit(0.9 - k / 10))) for k, n in enumerate(engines.DEFAULT_ENGINES)}
    with engines.registering(**sources):
        found = extract.page_text(pages, PipelineOptions())
    return found.select("pdf_name", "page", "page_text", "used_text_layer", "method")


@query(f"""WITH {TURNS}, l AS (SELECT page_id, generate_subscripts(x, 1) - 1 AS line_no, unnest(x) AS raw FROM (SELECT page_id, string_split(text, chr(10)) AS x FROM turns)),
  k AS (SELECT page_id, line_no, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS text FROM l)
SELECT page_id, CAST(line_no AS INTEGER) AS line_no, 'paddle' AS engine, text, CASE WHEN line_no % 3 > 0 THEN line_no / 8.0::DOUBLE END AS raw_confidence, line_no::DOUBLE AS x0, line_no * 2.0::DOUBLE AS y0, line_no + 10.0::DOUBLE AS x1, line_no * 2.0 + 5.0::DOUBLE AS y1 FROM k WHERE text <> ''
UNION ALL SELECT page_id, CAST(line_no AS INTEGER), 'mmocr', text, CASE WHEN line_no < 2 THEN line_no / 8.0::DOUBLE END, NULL, NULL, NULL, NULL FROM k WHERE text <> ''
UNION ALL SELECT page_id, CAST(line_no AS INTEGER), 'kraken', text, 0.5::DOUBLE, 1.0, 2.0, 3.0, 4.0 FROM k WHERE text <> ''""")
def engine_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three engines' own result shapes to lines."""
    at = lambda f: F.transform("x", lambda line, k: f(line, k))
    t = derived.turns(spark, sf_dir).withColumn("x", F.split("text", "\n", -1))
    point = lambda x, y: F.array(x.cast("double"), y.cast("double"))
    corners = lambda k: F.array(point(k, k * 2), point(k + 10, k * 2 + 5))
    sure = lambda k: F.when(k % 3 > 0, (k / 8.0).cast("string")).otherwise("n/a")
    paddle = t.withColumn("result", at(lambda x, k: F.struct(corners(k).alias("polygon"), x.alias("text"), sure(k).alias("confidence"))))
    mmocr = t.withColumns({"texts": F.col("x"), "scores": F.slice(at(lambda x, k: k / 8.0), 1, 2), "polygons": F.lit(None).cast("array<array<array<double>>>")})
    box = F.struct(*[F.lit(float(i + 1)).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))])
    kraken = t.withColumn("result", at(lambda x, k: F.struct(x.alias("prediction"), box.alias("bbox"), F.lit(0.5).alias("confidence"))))
    parts = [engines.paddle_lines(paddle, ["page_id"]), engines.mmocr_lines(mmocr, ["page_id"]), engines.kraken_lines(kraken, ["page_id"])]
    rows = [p.select("page_id", "line_no", F.lit(n).alias("engine"), "text", "raw_confidence", *[F.col(f"bbox.{c}").alias(c) for c in ("x0", "y0", "x1", "y1")]) for n, p in zip(("paddle", "mmocr", "kraken"), parts)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(f"""WITH {CANDIDATES}, one AS (SELECT page_id, angle, angle_ord, text, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t, confidence FROM candidates WHERE engine = 'doctr'),
  s AS (SELECT *, length(t) / 120.0::DOUBLE + confidence * 0.8 + 0.0 + length(regexp_replace(t, '[^\\p{{L}}\\p{{N}}]', '', 'g'))::DOUBLE / greatest(length(t), 1) * 0.4 + {RICHNESS.format('text')} * 2.0
    + least(greatest(len(list_filter(string_split(t, chr(10)), lambda x: trim(x) <> '')), 1) / 12.0::DOUBLE, 1.0) * 0.35 AS score FROM one WHERE t <> '')
SELECT page_id, arg_max(angle, (score, -angle_ord)) AS rotation_angle, round(max(score), 4) AS score FROM s GROUP BY page_id""")
def orientation_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    alone = derived.candidates(spark, sf_dir).where("engine = 'doctr'")
    scored = fusion.orientation_scores(fusion.fuse(alone, keep_candidates=True))
    return scored.groupBy("page_id").agg(F.max_by("angle", F.struct("score", -F.col("angle_ord"))).alias("rotation_angle"), F.round(F.max("score"), 4).alias("score"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN 'text_layer' ELSE 'ocr_ensemble' END AS plain_method, CASE WHEN doc_id % 3 > 0 AND doc_id % 5 = 0 THEN 'text_layer' ELSE 'ocr_ensemble' END AS forced_method,
  doc_id % 3 > 0 AS plain_layer, length(CASE WHEN doc_id % 3 > 0 THEN text WHEN doc_id % 5 = 0 THEN '' ELSE text || '!' END) AS plain_chars FROM documents""")
def text_source_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = derived.table(spark, sf_dir, "documents")
    pages = docs.select("doc_id", F.col("text").alias("layer_text"), (F.col("doc_id") % 3 > 0).alias("layer_ok"), F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.concat("text", F.lit("!"))).alias("ocr_text"))
    plain = fusion.choose_text(pages).select("*", F.col("method").alias("plain_method"), F.col("used_text_layer").alias("plain_layer"), F.length("page_text").cast("long").alias("plain_chars")).drop("page_text", "used_text_layer", "method")
    return fusion.choose_text(plain, force_ocr=True).select("doc_id", "plain_method", F.col("method").alias("forced_method"), "plain_layer", "plain_chars")


@query("""WITH e AS (SELECT user_id AS page_id, event_type || '@' || (event_id % 4) * 90 AS name, event_id % 4 AS angle_ord, min(props) AS error FROM events GROUP BY ALL)
SELECT page_id, string_agg(name || '=' || error, ';' ORDER BY name) AS errors FROM e GROUP BY page_id""")
def error_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("event_id") % 4
    errors = derived.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("page_id"), turn.alias("angle_ord"), (turn * 90).alias("angle"), F.col("event_type").alias("engine")).agg(F.min("props").alias("error"))
    shown = F.transform(F.array_sort(F.map_entries("errors")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return fusion.error_map(errors).select("page_id", F.array_join(shown, ";").alias("errors"))


# Detection --------------------------------------------------------------------------------------------------------------

#: Signs of the driver tables' languages in the place of transliteration's, so that the flags aren't all false.
LOCAL = detect.DetectionProfile(
    diacritics="éèêçñóíüöäß", markers=("Les", "Der", "Los"), min_syllabic_tokens=3, min_syllabic_ratio=0.2, threshold=0.2, negative_lexicon=("the", "of", "and"), syllabic_pattern=r"^\p{L}{1,5}$"
)
TOKENS = LINES + """, tok AS (SELECT doc_id, line_no, line, list_filter(regexp_split_to_array(line, '\\s+'), lambda t: t <> '') AS tokens FROM full_lines),
  bare AS (SELECT *, list_transform(tokens, lambda t: regexp_replace(regexp_replace(t, '^[^\\p{L}\\p{N}]+', ''), '[^\\p{L}\\p{N}]+$', '')) AS bare FROM tok),
  f AS (SELECT doc_id, line_no, len(tokens) AS n_tokens, len(list_filter(bare, lambda t: regexp_matches(t, '^\\p{L}{1,5}$'))) AS n_syllabic,
    length(line) - length(regexp_replace(line, '[éèêçñóíüöäß]', '', 'g')) AS n_diacritics, len(list_filter(bare, lambda t: t IN ('Les', 'Der', 'Los'))) AS n_markers,
    len(list_filter(bare, lambda t: lower(t) IN ('the', 'of', 'and'))) AS n_negative FROM bare),
  q AS (SELECT *, (n_diacritics >= 1 OR n_markers > 0) AND n_syllabic >= 3 AND n_syllabic::DOUBLE / greatest(n_tokens, 1) >= 0.2
    AND n_syllabic::DOUBLE / greatest(n_tokens, 1) + 0.0 - least(0.15, n_negative::DOUBLE / greatest(n_tokens, 1)) >= 0.2 AS qualifies FROM f)"""


def _qualified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.qualify(detect.line_features(derived.doc_lines(spark, sf_dir), LOCAL), LOCAL)


@query(f"""WITH {TOKENS} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(n_tokens AS INTEGER) AS n_tokens, CAST(n_syllabic AS INTEGER) AS n_syllabic, CAST(n_diacritics AS INTEGER) AS n_diacritics,
  CAST(n_markers AS INTEGER) AS n_markers, CAST(n_negative AS INTEGER) AS n_negative, qualifies FROM q""")
def detect_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _qualified(spark, sf_dir).select("doc_id", "line_no", "n_tokens", "n_syllabic", "n_diacritics", "n_markers", "n_negative", "qualifies")


@query(f"""WITH {TOKENS} SELECT doc_id, count(*) AS n_lines, CAST(sum(qualifies::INT) AS BIGINT) AS qualifying_lines, sum(qualifies::INT) >= 3 OR sum(qualifies::INT)::DOUBLE / count(*) >= 0.25 AS has_akkadian FROM q GROUP BY doc_id""")
def detect_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.flag_pages(_qualified(spark, sf_dir), ["doc_id"], LOCAL)


#: Hyphenated groups of any words, for lines whose words are tied in threes.
TIED = detect.DetectionProfile(diacritics=LOCAL.diacritics, markers=LOCAL.markers, min_syllabic_tokens=1, min_syllabic_ratio=0.1, threshold=0.5, negative_lexicon=("the",), group_length=12, require_diacritic_or_marker=False)


@query(f"""WITH {LINES}, t AS (SELECT doc_id, line_no, regexp_replace(regexp_replace(line, '^\\s+|\\s+$', '', 'g'), '([^ ]+) ([^ ]+) ([^ ]+)', '\\1-\\2-\\3', 'g') AS line FROM full_lines),
  tok AS (SELECT *, list_transform(list_filter(regexp_split_to_array(line, '\\s+'), lambda t: t <> ''), lambda t: regexp_replace(regexp_replace(t, '^[^\\p{{L}}\\p{{N}}]+', ''), '[^\\p{{L}}\\p{{N}}]+$', '')) AS bare FROM t),
  f AS (SELECT doc_id, line_no, len(bare) AS n, len(list_filter(bare, lambda t: regexp_matches(t, '^\\p{{L}}{{1,12}}(-\\p{{L}}{{1,12}}){{2,}}$'))) AS n_syllabic, len(list_filter(bare, lambda t: lower(t) = 'the')) AS n_negative, (line_no * 7) % 60 AS p FROM tok),
  s AS (SELECT *, n_syllabic::DOUBLE / greatest(n, 1) AS share, CASE WHEN p < 20 THEN 0.3 WHEN p < 40 THEN 0.1 ELSE 0.0 END::DOUBLE - least(0.15, n_negative::DOUBLE / greatest(n, 1)) AS more FROM f)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(n_syllabic AS INTEGER) AS n_syllabic, round(share + more, 6) AS score, n_syllabic >= 1 AND share >= 0.1 AND round(share + more, 9) >= 0.5 AS qualifies FROM s""")
def detect_tied_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hyphenated tokens and boosts of low perplexity, of a given number, on lines whose words are tied in threes."""
    tied = F.regexp_replace(text.strip(F.col("line")), "([^ ]+) ([^ ]+) ([^ ]+)", "$1-$2-$3")
    lines = derived.doc_lines(spark, sf_dir).withColumns({"line": tied, "perplexity": (F.col("line_no") * 7 % 60).cast("double")})
    found = detect.qualify(detect.line_features(lines, TIED), TIED)
    return found.select("doc_id", "line_no", "n_syllabic", F.round("score", 6).alias("score"), "qualifies")


@query("""WITH g AS (SELECT n, substr(text, i, n) AS gram FROM (SELECT text, unnest(generate_series(1, length(text))) AS i FROM documents), (VALUES (1), (2), (3)) v(n) WHERE i + n - 1 <= length(text))
SELECT CAST(n AS INTEGER) AS n, gram, count(*) AS cnt FROM g GROUP BY n, gram""")
def char_lm_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charlm.train(derived.table(spark, sf_dir, "documents").select("text")).ngrams


@query("""WITH d AS (SELECT item_id, text, unnest(generate_series(1, length(text))) AS i FROM benchmark),
  t AS (SELECT item_id, substr(text, i, 3) AS g FROM d WHERE i + 2 <= length(text)),
  c3 AS (SELECT g, count(*) AS n FROM t GROUP BY g), c2 AS (SELECT substr(g, 1, 2) AS k, sum(n) AS n FROM c3 GROUP BY ALL), s AS (SELECT count(DISTINCT substr(text, i, 1)) AS v FROM d)
SELECT item_id, count(*) AS n_grams, round(exp(avg(-ln((c3.n + 0.1) / (c2.n + 0.1 * v)))), 4) AS perplexity FROM t JOIN c3 USING (g) JOIN c2 ON k = substr(g, 1, 2), s GROUP BY item_id""")
def char_lm_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derived.table(spark, sf_dir, "benchmark")
    return charlm.perplexity(items, charlm.train(items.select("text")), ["item_id"]).select("item_id", "n_grams", F.round("perplexity", 4).alias("perplexity"))


@query()
def char_lm_perplexity_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """char_lm_perplexity over all documents, which train the model, too; no SQL is given."""
    docs = derived.table(spark, sf_dir, "documents").select("doc_id", "text")
    return charlm.perplexity(docs, charlm.train(docs.select("text")), ["doc_id"]).select("doc_id", "n_grams", F.round("perplexity", 4).alias("perplexity"))


WORDS = {"de": ["der", "die", "und", "in"], "en": ["the", "of", "and", "to"], "es": ["el", "de", "que", "y"], "fr": ["le", "de", "et", "que"]}


@query(f"""WITH {LINES}, w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(line), '[^\\p{{L}}]+')) AS word FROM full_lines),
  s AS (SELECT doc_id, {", ".join(f"avg((word IN ({', '.join(repr(x) for x in v)}))::INT) AS {k}" for k, v in WORDS.items())} FROM w WHERE word <> '' GROUP BY doc_id), b AS (SELECT *, greatest(de, en, es, fr) AS share FROM s)
SELECT doc_id, CASE WHEN share = 0 THEN NULL WHEN de = share THEN 'de' WHEN en = share THEN 'en' WHEN es = share THEN 'es' ELSE 'fr' END AS language, round(share, 6) AS share FROM b""")
def function_word_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect.function_word_language(derived.doc_lines(spark, sf_dir), ["doc_id"], WORDS)
    return found.select("doc_id", "language", F.round("share", 6).alias("share"))


# Evaluation, guard, pairing ---------------------------------------------------------------------------------------------

READ = f"""{TURNS}, ascii_turns AS (SELECT page_id, regexp_replace({KEY.format('text')}, '[^\\x00-\\x7F]', '', 'g') AS gold FROM turns)"""


def _ascii_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.regexp_replace(text.comparison_key(F.col("text")), r"[^\x00-\x7F]", "")
    return derived.turns(spark, sf_dir).select("page_id", key.alias("gold"), F.translate(key, "nl", "u1").alias("read"))


@query(f"""WITH {READ}, e AS (SELECT page_id, levenshtein(translate(gold, 'nl', 'u1'), gold)::DOUBLE / length(gold) AS cer FROM ascii_turns WHERE length(gold) > 0)
SELECT page_id, round(cer, 6) AS cer, round(greatest(0.0, (1.0 - cer) * 100.0), 6) AS accuracy FROM e""")
def cer_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ascii_turns(spark, sf_dir).where(F.length("gold") > 0).withColumn("cer", evaluate.cer(F.col("read"), F.col("gold")))
    return rows.select("page_id", F.round("cer", 6).alias("cer"), F.round(evaluate.accuracy(F.col("cer")), 6).alias("accuracy"))


@query()
def wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ascii_turns(spark, sf_dir).select("page_id", F.round(evaluate.wer(F.col("read"), F.col("gold")), 6).alias("wer"))


@query("""WITH e AS (SELECT event_id, event_type AS gold, event_type || CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN ' x' WHEN 2 THEN 's' ELSE 's  y' END AS read FROM events),
  w AS (SELECT *, list_filter(regexp_split_to_array(read, '\\s+'), lambda t: t <> '') AS words FROM e) SELECT event_id, (len(words) - list_contains(words, gold)::INT)::DOUBLE AS wer FROM w""")
def wer_one_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    """wer against gold texts of one word: as many words as are read, less one where it is among them."""
    more = F.element_at(F.array(*map(F.lit, ("", " x", "s", "s  y"))), (F.col("event_id") % 4 + 1).cast("int"))
    return derived.table(spark, sf_dir, "events").select("event_id", evaluate.wer(F.concat("event_type", more), F.col("event_type")).alias("wer"))


WIDE = """wide AS (SELECT o_orderkey AS page, o_totalprice % 97 / 100 AS fusion_cer, o_totalprice % 89 / 100 AS paddle_cer, o_totalprice % 83 / 100 AS easyocr_cer FROM orders)"""


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("o_totalprice")
    return derived.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page"), (p % 97 / 100).alias("fusion_cer"), (p % 89 / 100).alias("paddle_cer"), (p % 83 / 100).alias("easyocr_cer"))


@query(f"""WITH {WIDE} SELECT page, 'fusion' AS engine, round(fusion_cer, 6) AS cer FROM wide UNION ALL SELECT page, 'paddle', round(paddle_cer, 6) FROM wide UNION ALL SELECT page, 'easyocr', round(easyocr_cer, 6) FROM wide""")
def eval_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.long_form(_wide(spark, sf_dir), ["page"], ["fusion", "paddle", "easyocr"], ["cer"]).withColumn("cer", F.round("cer", 6))


@query(f"""WITH {WIDE} SELECT page, round(fusion_cer, 6) AS fusion_cer, CASE WHEN easyocr_cer <= paddle_cer THEN 'easyocr' ELSE 'paddle' END AS best_engine, round(least(easyocr_cer, paddle_cer), 6) AS best_cer,
  CASE WHEN fusion_cer <= least(easyocr_cer, paddle_cer) THEN 'yes' ELSE 'no' END AS fusion_wins FROM wide""")
def fusion_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = evaluate.long_form(_wide(spark, sf_dir), ["page"], ["fusion", "paddle", "easyocr"], ["cer"])
    return evaluate.fusion_wins(long, ["page"]).withColumns({c: F.round(c, 6) for c in ("fusion_cer", "best_cer")})


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unevaluated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.unevaluated(derived.table(spark, sf_dir, "documents").select("doc_id"), derived.table(spark, sf_dir, "labels"), ["doc_id"])


@query(f"""WITH {READ}, e AS (SELECT page_id, gold, replace(translate(gold, 'l', '1'), 'the ', '') AS fixed FROM ascii_turns)
SELECT page_id, round(levenshtein(gold, fixed)::DOUBLE / greatest(length(gold), 1), 6) AS edit_share, levenshtein(gold, fixed)::DOUBLE / greatest(length(gold), 1) <= CASE WHEN page_id % 2 = 0 THEN 0.03 ELSE 0.15 END
  AND len(list_distinct(list_filter(string_split(fixed, ' '), lambda w: w <> ''))) <= 1.6 * greatest(len(list_distinct(list_filter(string_split(gold, ' '), lambda w: w <> ''))), 1) AS accepted FROM e""")
def guardrail_edit_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = F.replace(F.translate("gold", "l", "1"), F.lit("the "), F.lit(""))
    rows = _ascii_turns(spark, sf_dir).select("page_id", F.col("gold").alias("before"), fixed.alias("after"), (F.col("page_id") % 2 == 0).alias("is_akkadian"))
    return guard.accept(rows).select("page_id", F.round("edit_share", 6).alias("edit_share"), "accepted")


def _lines_as_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as blocks of a page: place from quantity, side from line number. Dealt by page, the only shuffle of what follows."""
    lines = derived.placed(spark, sf_dir, "lineitem")
    block = F.col("l_linenumber").cast("long")
    blocks = lines.select(F.col("l_orderkey").alias("page_id"), (block * 1000 + F.col("l_partkey") % 1000).alias("block_id"), (F.col("l_quantity") * 14).alias("y"), (block % 3).alias("column"), block.alias("ord"), (F.col("l_discount") * 10).alias("lang_conf"), (F.col("l_tax") > 0.04).alias("has_marker"), (F.col("l_returnflag") == "R").alias("is_commentary"), F.lit(720.0).alias("page_height"), (block % 2 == 1).alias("source_side"), "place")
    return blocks.repartition("page_id")


def _side(lines: DataFrame, side: Column, keys: list[str], *order: Column | str) -> DataFrame:
    """A side's rows, of each key the first in an order that no other row shares. Rows without a block id are one block of their page, on
    the side of the first of them that has one, so those of either side stay until it is found; all others are filtered before they are sorted."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return lines.where(side | (F.col("block_id").isNull() & F.col("ord").isNotNull())).withColumn("nth", nth).where("nth = 1").where(side).drop("nth", "place")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a page's blocks; of rows that share a page and block, the one that stands first in the table."""
    lines = _lines_as_blocks(spark, sf_dir)
    return pairing.scores(*(_side(lines, side, ["page_id", "block_id"], "place") for side in (F.col("source_side"), ~F.col("source_side"))))


@query()
def pairing_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairing.greedy(_scored(spark, sf_dir)).select("page_id", "source_id", "target_id", F.round("score", 6).alias("score"), "tier")


@query()
def pairing_optimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairing.optimal(_scored(spark, sf_dir)).select("page_id", "source_id", "target_id", F.round("score", 6).alias("score"), "tier")


def _two_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores where each page has one source and one target at most: the least block of its first lines, and of its second."""
    lines = _lines_as_blocks(spark, sf_dir)
    return pairing.scores(*(_side(lines, F.col("ord") == k, ["page_id"], F.col("block_id").asc_nulls_last(), "place") for k in (1, 2)))


TWO_BLOCKS = """SELECT page_id, source_id, target_id, round(score, 6) AS score, CASE WHEN score >= 0.48 THEN 'high' WHEN score >= 0.44 THEN 'medium' ELSE 'low' END AS tier FROM (
  WITH b AS (SELECT DISTINCT ON (page_id, block_id) * FROM (SELECT l_orderkey AS page_id, l_linenumber * 1000 + l_partkey % 1000 AS block_id, l_quantity * 14 AS y, l_linenumber % 3 AS col, l_linenumber AS ord, l_discount * 10 AS conf, l_tax > 0.04 AS mark, l_returnflag = 'R' AS comm FROM lineitem)),
    f AS (SELECT * FROM b WHERE ord < 3 QUALIFY row_number() OVER (PARTITION BY page_id, ord ORDER BY block_id) = 1)
  SELECT s.page_id, s.block_id AS source_id, t.block_id AS target_id, exp(-(abs(s.y - t.y) / 720.0) / 0.35) * 0.30 + (s.col = t.col)::INT * 0.30 + least(s.conf, t.conf) * 0.15 + (s.mark OR t.mark)::INT * 0.15 + (t.ord > s.ord)::INT * 0.10 - CASE WHEN t.comm THEN 0.35 ELSE 0 END AS score,
    abs(s.y - t.y) / 720.0 AS far FROM f s JOIN f t USING (page_id) WHERE s.ord = 1 AND t.ord = 2) WHERE far <= 0.5 AND score >= 0.40"""


@query(TWO_BLOCKS)
def pairing_greedy_two_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairing.greedy(_two_blocks(spark, sf_dir)).select("page_id", "source_id", "target_id", F.round("score", 6).alias("score"), "tier")


@query(TWO_BLOCKS)
def pairing_optimal_two_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairing.optimal(_two_blocks(spark, sf_dir)).select("page_id", "source_id", "target_id", F.round("score", 6).alias("score"), "tier")


@query("""SELECT page_id, source_id, target_id, round(score, 6) AS score FROM (
  WITH b AS (SELECT DISTINCT ON (page_id, block_id) * FROM (SELECT l_orderkey AS page_id, l_linenumber * 1000 + l_partkey % 1000 AS block_id, l_quantity * 14 AS y, l_linenumber % 3 AS col, l_linenumber AS ord, l_discount * 10 AS conf, l_tax > 0.04 AS mark, l_returnflag = 'R' AS comm FROM lineitem))
  SELECT s.page_id, s.block_id AS source_id, t.block_id AS target_id, exp(-(abs(s.y - t.y) / 720.0) / 0.35) * 0.30 + (s.col = t.col)::INT * 0.30 + least(s.conf, t.conf) * 0.15 + (s.mark OR t.mark)::INT * 0.15 + (t.ord > s.ord)::INT * 0.10 - CASE WHEN t.comm THEN 0.35 ELSE 0 END AS score,
    abs(s.y - t.y) / 720.0 AS far FROM b s JOIN b t USING (page_id) WHERE s.ord % 2 = 1 AND t.ord % 2 = 0) WHERE far <= 0.5 AND score >= 0.40""")
def pairing_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("page_id", "source_id", "target_id", F.round("score", 6).alias("score"))


# Output -----------------------------------------------------------------------------------------------------------------


@query(f"""WITH {TOKENS}, flags AS (SELECT doc_id, line_no // 12 AS p, sum(qualifies::INT) >= 3 OR sum(qualifies::INT)::DOUBLE / count(*) >= 0.25 AS has_akkadian FROM q GROUP BY ALL),
  pages_ AS (SELECT doc_id, line_no // 12 AS p, any_value(source) AS pdf_name, string_agg(line, chr(10) ORDER BY line_no) AS text FROM full_lines GROUP BY ALL)
SELECT doc_id, pdf_name, CAST(p + 1 AS INTEGER) AS page, replace(text, chr(10), '\\n') AS page_text, has_akkadian::VARCHAR AS has_akkadian FROM pages_ JOIN flags USING (doc_id, p)""")
def page_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: pages of documents, flagged and in the shape of the deliverable."""
    flagged = detect.detect(derived.pages(spark, sf_dir), ["doc_id", "page"], LOCAL).withColumnRenamed("text", "page_text")
    rows = flagged.select("doc_id", "pdf_name", "page", text.escape_newlines(F.col("page_text")).alias("page_text"), F.col("has_akkadian").cast("string").alias("has_akkadian"))
    return rows


@query("""SELECT event_type AS pdf_name, CAST(event_id AS INTEGER) AS page, CAST(floor(value * 10) AS BIGINT) AS ms, CASE WHEN user_id % 2 = 0 THEN 'True' ELSE 'False' END AS used_text_layer, CASE WHEN user_id % 7 = 0 THEN 'True' ELSE 'False' END AS has_akkadian,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp FROM events""")
def progress_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = derived.table(spark, sf_dir, "events")
    return sinks.progress_rows(events.select(F.col("event_type").alias("pdf_name"), F.col("event_id").alias("page"), F.floor(F.col("value") * 10).alias("ms"), (F.col("user_id") % 2 == 0).alias("used_text_layer"), (F.col("user_id") % 7 == 0).alias("has_akkadian"), F.col("ts").alias("timestamp")))
