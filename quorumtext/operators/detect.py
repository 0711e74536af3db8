"""Which pages hold transliterated Akkadian (or, with another profile, whatever its signs describe).

A line qualifies if it has a diacritic or a marker, enough hyphenated syllabic tokens, both in number and share, and a score at the
threshold: share of syllabic tokens, plus a boost for low perplexity, less a capped penalty for function words of other languages. A page
is flagged by a number of qualifying lines or their share. How the parts combine is this engine's decision.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumtext.functions import charlm
from quorumtext.functions.text import LINE_BREAK, SPACE, strip

# Function words of German, Turkish and English.
NEGATIVE_LEXICON = (
    "der die das und den des dem im vom zum zur für mit nach bei über auf aus nicht auch nur sich "
    "ve ile için bu bir veya de da olarak gibi ki mi "
    "the and of to in a is was are were been being have has had do does did will would should could may might must can"
).split()
# Logograms that mark transliterated text.
MARKERS = "DUMU LUGAL KÙ.BABBAR GÍN MA.NA TÚG URU É IGI KIŠIB ITU DINGIR AN.NA SIG5 ANŠE".split()


@dataclass(frozen=True)
class DetectionProfile:
    threshold: float = 0.25
    require_diacritic_or_marker: bool = True
    diacritics: str = "šṣṭḫāēīūŠṢṬḪĀĒĪŪᵈᵐᶠ"
    min_diacritics_per_line: int = 1
    min_syllabic_tokens: int = 3
    min_syllabic_ratio: float = 0.25
    markers: tuple[str, ...] = tuple(MARKERS)
    boosts: tuple[tuple[float, float], ...] = ((20.0, 0.30), (40.0, 0.10))
    negative_lexicon: tuple[str, ...] = tuple(NEGATIVE_LEXICON)
    negative_cap: float = 0.15
    group_length: int = 4
    min_groups: int = 3
    qualifying_lines: int = 3
    qualifying_ratio: float = 0.25
    syllabic_pattern: str | None = None

    @classmethod
    def from_json(cls, path: str) -> DetectionProfile:
        """The akkadian_detection section of a profile file; what it doesn't say stays at the default."""
        with open(path, encoding="utf-8") as f:
            section = json.load(f).get("akkadian_detection", {})
        names = {"aggregation_qual_lines_min": "qualifying_lines", "aggregation_qual_ratio_min": "qualifying_ratio", "neg_penalty_cap": "negative_cap"}
        known = {f.name for f in fields(cls)}
        values = {names.get(k, k): v for k, v in section.items() if names.get(k, k) in known}
        if "negative_lexicon" in values:
            values["negative_lexicon"] = tuple(values["negative_lexicon"])
        if "ppl_boosts" in section:
            values["boosts"] = tuple(sorted((float(k.removeprefix("lt")), float(v)) for k, v in section["ppl_boosts"].items()))
        hyphen = section.get("hyphen_token", {})
        return cls(**values, group_length=hyphen.get("max_len", 4), min_groups=hyphen.get("min_groups", 3))

    @property
    def token_pattern(self) -> str:
        group = rf"\p{{L}}{{1,{self.group_length}}}"
        return self.syllabic_pattern or rf"^{group}(-{group}){{{self.min_groups - 1},}}$"


def page_lines(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, line_no, line: the lines of each page that hold anything."""
    lines = pages.select(*keys, F.posexplode(F.split(F.col(text), LINE_BREAK, -1)).alias("line_no", "line"))
    return lines.withColumn("line", strip(F.col("line"))).where("line <> ''")


def _among(words: Column, wanted: tuple[str, ...]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(list(wanted)))) if wanted else F.lit(0)


def line_features(lines: DataFrame, profile: DetectionProfile = DetectionProfile()) -> DataFrame:
    """Adds n_tokens, n_syllabic, n_diacritics, n_markers, n_negative."""
    tokens = F.filter(F.split("line", SPACE + "+"), lambda t: t != "")
    bare = F.transform("tokens", lambda t: F.regexp_replace(t, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    signs = f"[{''.join(map(re.escape, profile.diacritics))}]"
    return (
        lines.withColumn("tokens", tokens).withColumn("bare", bare)
        .withColumns({
            "n_tokens": F.size("tokens"),
            "n_syllabic": F.size(F.filter("bare", lambda t: t.rlike(profile.token_pattern))),
            "n_diacritics": F.length("line") - F.length(F.regexp_replace("line", signs, "")),
            "n_markers": _among(F.col("bare"), profile.markers),
            "n_negative": _among(F.transform("bare", F.lower), profile.negative_lexicon),
        }).drop("tokens", "bare")
    )


def qualify(features: DataFrame, profile: DetectionProfile = DetectionProfile()) -> DataFrame:
    """Adds score and qualifies; a column perplexity is used if there."""
    boost = F.lit(0.0)
    if "perplexity" in features.columns:
        for limit, gain in sorted(profile.boosts, reverse=True):
            boost = F.when(F.col("perplexity") < limit, gain).otherwise(boost)
    n = F.greatest("n_tokens", F.lit(1))
    share = F.col("n_syllabic") / n
    score = share + (boost - F.least(F.lit(profile.negative_cap), F.col("n_negative") / n))
    # boosts and thresholds are decimals: a sum of them that meets the threshold may fall short of it in its last bits
    reached = F.round("score", 9) if "perplexity" in features.columns else F.col("score")
    gate = (F.col("n_diacritics") >= profile.min_diacritics_per_line) | (F.col("n_markers") > 0) if profile.require_diacritic_or_marker else F.lit(True)
    enough = (F.col("n_syllabic") >= profile.min_syllabic_tokens) & (share >= profile.min_syllabic_ratio)
    return features.withColumn("score", score).withColumn("qualifies", gate & enough & (reached >= profile.threshold))


def flag_pages(lines: DataFrame, keys: list[str], profile: DetectionProfile = DetectionProfile()) -> DataFrame:
    """Qualified lines to keys, n_lines, qualifying_lines, has_akkadian."""
    counted = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("qualifies").cast("int")).alias("qualifying_lines"))
    flag = (F.col("qualifying_lines") >= profile.qualifying_lines) | (F.col("qualifying_lines") / F.col("n_lines") >= profile.qualifying_ratio)
    return counted.withColumn("has_akkadian", flag)


def with_perplexity(lines: DataFrame, keys: list[str], model: charlm.CharLM) -> DataFrame:
    """Lines (keys, line_no, line) with the model's perplexity of each; null for lines shorter than its order."""
    scores = charlm.perplexity(lines.select(*keys, "line_no", F.col("line").alias("text")), model, [*keys, "line_no"])
    return lines.join(scores.drop("n_grams"), [*keys, "line_no"], "left")


def detect(pages: DataFrame, keys: list[str], profile: DetectionProfile = DetectionProfile(), text: str = "text", model: charlm.CharLM | None = None) -> DataFrame:
    """pages with has_akkadian; pages without lines are false. Without a model no line has the boost for low perplexity."""
    lines = page_lines(pages, keys, text)
    lines = lines if model is None else with_perplexity(lines, keys, model)
    flags = flag_pages(qualify(line_features(lines, profile), profile), keys, profile)
    return pages.join(flags.select(*keys, "has_akkadian"), keys, "left").withColumn("has_akkadian", F.coalesce("has_akkadian", F.lit(False)))


def function_word_language(lines: DataFrame, keys: list[str], lexicons: dict[str, list[str]]) -> DataFrame:
    """keys, language, share: the lexicon that covers most of a page's words (first by name on ties), null if none covers any."""
    words = lines.select(*keys, F.explode(F.split(F.lower("line"), r"[^\p{L}]+")).alias("word")).where("word <> ''")
    counts = [F.avg(F.col("word").isin(list(lexicons[name])).cast("double")).alias(name) for name in sorted(lexicons)]
    shares = words.groupBy(*keys).agg(*counts)
    best = F.array_max(F.array(*[F.struct(F.col(n).alias("share"), F.lit(-i).alias("place"), F.lit(n).alias("language")) for i, n in enumerate(sorted(lexicons))]))
    return shares.withColumn("best", best).select(*keys, F.when(F.col("best.share") > 0, F.col("best.language")).alias("language"), F.col("best.share").alias("share"))
