"""Text functions as column expressions: normal form, comparison keys, diacritics and scripts.

Character classes follow Python's Unicode tables, from which they are generated, because Java's and RE2's named classes differ from them
(combining class against category M, script against name). Everything stays inside Spark's own operators.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where Python's splitlines() ends a line, and what its \s matches. Printable ASCII is ruled out first: a class of many parts is slow to match.
LINE_BREAK = r"(?![ -~])(?:\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}])"
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
SPACE = r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_SPACE = f"[[^!-~]&&{SPACE}]"

# The blocks that count as Arabic script.
ARABIC_BLOCKS = ((0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))


def char_class(points: Iterable[int], negated: bool = False) -> str:
    """A Java character class of the given code points, as ranges."""
    spans: list[list[int]] = []
    for p in sorted(set(points)):
        if spans and spans[-1][1] == p - 1:
            spans[-1][1] = p
        else:
            spans.append([p, p])
    inside = "".join(f"\\x{{{a:X}}}" + (f"-\\x{{{b:X}}}" if b > a else "") for a, b in spans)
    return f"[{'^' * negated}{inside}]"


@lru_cache(1)
def _tables() -> dict[str, object]:
    """Generated from unicodedata: combining marks, Arabic signs that aren't letters, and what NFKD without marks, then case folding makes of
    a character: one other (source and target strings), nothing, or several."""
    marks, arabic, one, gone, several, folds = [], [], {}, [], {}, {}
    for p in range(0x80, sys.maxunicode + 1):
        c = chr(p)
        kind = unicodedata.category(c)
        if kind in ("Cn", "Cs", "Co"):
            continue
        if unicodedata.combining(c):
            marks.append(p)
        elif not c.isalpha() and "ARABIC" in unicodedata.name(c, ""):
            arabic.append(p)
        if 0xAC00 <= p <= 0xD7A3:  # Hangul syllables decompose by arithmetic; see strip_diacritics
            continue
        base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if not base:
            gone.append(c)
        elif base != c:
            (one if len(base) == 1 else several)[c] = base
        elif len(f := c.casefold()) == 1 and f != c.lower():
            folds[c.lower()] = f
    return {"marks": marks, "arabic": arabic, "one": one, "gone": gone, "several": several, "folds": folds}


def marks_class() -> str:
    return char_class(_tables()["marks"])


def named(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use has it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def goes_beyond_ascii(text: Column) -> Column:
    return F.octet_length(text) > F.length(text)


def squeeze(text: Column) -> Column:
    """Runs of white space to one blank, none at the ends. Single blanks stay as they are."""
    return F.btrim(F.regexp_replace(text, F.lit(rf" {_SPACE}+|[[^ -~]&&{SPACE}]{_SPACE}*"), F.lit(" ")))


def strip(text: Column) -> Column:
    """Python's strip(): Unicode white space off both ends."""
    return F.btrim(text, F.lit(WHITE))


def split_lines(text: Column) -> Column:
    """Stripped lines that aren't empty; the stripped text alone if there is none, so never an empty array."""
    lines = F.filter(F.transform(F.split(text, LINE_BREAK, -1), strip), lambda x: x != "")
    return named(lines, lambda found: F.when(F.size(found) > 0, found).otherwise(F.array(strip(text))))


def normalize_whitespace(text: Column) -> Column:
    return F.array_join(F.filter(F.transform(F.split(text, LINE_BREAK, -1), squeeze), lambda x: x != ""), "\n")


# Fixed values of the Unicode standard: Hangul syllables are numbered by lead, vowel and tail.
HANGUL, LEAD, VOWEL, TAIL, VOWELS, TAILS = 0xAC00, 0x1100, 0x1161, 0x11A7, 21, 28


def _spelled_out(text: Column) -> Column:
    """Each character that decomposes to several, by a map, and Hangul syllables by their numbering."""
    several = _tables()["several"]
    names = F.str_to_map(F.lit("\uE000".join(f"{c}\uE001{b}" for c, b in several.items())), F.lit("\uE000"), F.lit("\uE001"))
    jamo = lambda first, n: F.array(*[F.lit(chr(first + i) if i or first != TAIL else "") for i in range(n)])

    def one(c: Column) -> Column:
        at = F.ascii(c) - HANGUL
        pick = lambda array, i: F.get(array, F.floor(i).cast("int"))
        hangul = F.concat(pick(jamo(LEAD, 19), at / (VOWELS * TAILS)), pick(jamo(VOWEL, VOWELS), (at % (VOWELS * TAILS)) / TAILS), pick(jamo(TAIL, TAILS), at % TAILS))
        return F.when(c.between("\uAC00", "\uD7A3"), hangul).otherwise(F.coalesce(F.element_at(names, c), c))

    return F.array_join(F.transform(F.split(text, "", -1), one), "")


def strip_diacritics(text: Column) -> Column:
    """Compatibility decomposition without combining marks: one translation for characters that become one other or none; the few texts
    with characters that become several (ligatures, fractions, Hangul) are first spelled out."""
    t = _tables()
    several = char_class([*map(ord, t["several"]), *range(HANGUL, 0xD7A4)])
    expanded = F.when(beyond_ascii(text).rlike(several), _spelled_out(text)).otherwise(text)
    one = t["one"]
    return F.when(goes_beyond_ascii(text), F.translate(expanded, "".join(one) + "".join(t["gone"]), "".join(one.values()))).otherwise(text)


def fold_case(text: Column) -> Column:
    """Case folding after strip_diacritics. Only texts that go beyond ASCII need more than lower case."""
    folds = _tables()["folds"]
    folded = lambda lower: F.translate(F.replace(lower, F.lit("ß"), F.lit("ss")), "".join(folds), "".join(folds.values()))
    return named(F.lower(text), lambda lower: F.when(goes_beyond_ascii(lower), folded(lower)).otherwise(lower))


def comparison_key(text: Column) -> Column:
    """Without marks, case-folded, white space folded: what texts are compared by."""
    return squeeze(fold_case(strip_diacritics(text)))


def beyond_ascii(text: Column) -> Column:
    """What is left of a text without ASCII: large character classes are slow to match, so they are matched against this alone."""
    return F.regexp_replace(text, F.lit(r"[\x00-\x7F]+"), F.lit(""))


def _hits(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, F.lit(pattern), F.lit("")))


def contains_arabic(text: Column) -> Column:
    return text.rlike(char_class(p for a, z in ARABIC_BLOCKS for p in range(a, z + 1)))


def diacritic_richness(text: Column) -> Column:
    """Per character: 1 for a combining mark or a letter beyond ASCII, 2 for an Arabic sign that isn't a letter. Not normalized first."""
    marks, arabic = char_class(_tables()["marks"]), char_class(_tables()["arabic"])
    score = lambda rest: _hits(rest, f"[\\p{{L}}{marks}]") + F.when(rest.rlike(r"[\u0600-\uFEFF\x{10000}-\x{10FFFF}]"), 2 * _hits(rest, f"[{arabic}&&[^{marks[1:-1]}]]")).otherwise(0)
    return F.when(goes_beyond_ascii(text), named(beyond_ascii(text), score) / F.greatest(F.length(text), F.lit(1))).otherwise(F.lit(0.0))


def alnum_ratio(text: Column) -> Column:
    return _hits(text, r"[\p{L}\p{N}]") / F.greatest(F.length(text), F.lit(1))


def completeness(text: Column) -> Column:
    return F.least(F.length(strip(text)) / F.lit(300.0), F.lit(1.0))


def escape_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit("\\n"))


def page_file_name(source: Column, page: Column) -> Column:
    """Stem without commas, blanks as _, then the page."""
    stem = F.regexp_replace(source, r"(?i)\.pdf$", "")
    return F.concat(F.translate(stem, " ,", "_"), F.lit("_page_"), page.cast("string"), F.lit(".pdf"))


def engine_at_angle(engine: Column, angle: Column) -> Column:
    return F.concat_ws("@", engine, angle.cast("string"))
