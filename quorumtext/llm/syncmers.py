"""Document fingerprints from closed syncmers, in DataFrame operations only.

Of the runs of K characters of a text (k-mers) those are anchors whose least hash of an inner run of S characters (s-mer) lies at the first
or last place. Whether a k-mer is chosen depends on its own characters alone, so two texts that share a passage choose the same anchors in it,
wherever it stands and in any script, and two anchors follow one another by K - S characters at most. The fingerprint is all anchors in order: six
hex digits each, 19 bits of the anchor's hash and 5 of its distance from the anchor before (less one; for the first, its place).

Texts are matched by position: a match is a pair of neighbouring anchors that both texts hold at the same distance, 43 bits in all. The likeness
of two fingerprints is 2 |A and B| / (|A| + |B|) over their distinct pairs. A text with one anchor has that alone.

An edited text need not be read anew: it is a prefix of the text and a prefix of the next, and as anchors know no context, its anchors are
those of the two that lie within them and those of the few characters around the seam.

Texts are read in blocks of BLOCK characters, so that a very long one takes no more memory than its anchors. The edit study pairs every document
with the next by id without a global window: ids are cut into ranges at quantiles of a sample of them, the first row of each range is copied
into the range before (that of the whole table into the last), and a window runs within each range. Texts are shuffled once.

Defined cases: null text is empty; an empty text has an empty fingerprint, and two empty ones are alike (1.0), an empty and another
not (0.0); a text without an anchor (of fewer than K characters, or up to 2 K - S - 2) has one of its whole; with one document the next is itself; rows that share an id follow in order of
the text's hash; null ids come first; very long texts go whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S, BLOCK = 32, 8, 8192
#: Bits of an anchor's hash and of a distance that its fingerprint keeps.
BITS, FAR = 19, 5
#: Rows of a range of ids, sampled ids of a range, the fan-out of its search, and the most ranges.
RANGE_ROWS, SAMPLED, FAN, MOST_RANGES = 500, 64, 64, 65_536


def _let(value: Column, body) -> Column:
    """body(value) with value computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _packed(place: Column, hash: Column) -> Column:
    return F.shiftleft(place.cast("long"), BITS).bitwiseOR(hash.bitwiseAND(F.lit((1 << BITS) - 1)))


def place(anchor: Column) -> Column:
    return F.shiftright(anchor, BITS)


def _doubled(values: Column, to: int, join, body, width: int = 1) -> Column:
    """body(array) of join(one, other, how many each stands for) over each run of `to` (a power of two) neighbours; what runs past
    the end joins fewer, or is null."""
    if width == to:
        return body(values)
    return _let(F.zip_with(values, F.slice(values, width + 1, F.size(values)), lambda a, b: join(a, b, width)), lambda v: _doubled(v, to, join, body, 2 * width))


def _in_block(text: Column, offset: Column) -> Column:
    """The anchors of a text of at least K characters, as places (from offset on) and hashes in one number each."""
    width = K - S
    half = 1 << (width - 1).bit_length() - 1  # two runs of so many s-mers cover what lies between the edges
    after = lambda v, n: F.slice(v, n + 1, F.size(v))
    least = lambda a, b: F.least(a, b)

    def chosen(h: Column, low: Column) -> Column:
        """low: the least of `half` s-mers from each on."""
        edges = F.slice(F.zip_with(h, after(h, width), least), 1, F.size(h) - K + 1)
        inner = F.zip_with(after(low, 1), after(low, width - half), least)
        whole = lambda i: F.xxhash64(*[F.get(h, i + d) for d in range(0, width + 1, S)])  # noqa: E731  disjoint s-mers make up the k-mer
        return _let(inner, lambda m: F.array_compact(F.transform(edges, lambda e, i: F.when(e <= F.get(m, i), _packed(i + offset, whole(i))))))

    # an s-mer's hash: the characters' hashes, shifted by place, in one
    letters = F.transform(F.split(text, ""), lambda c: F.xxhash64(c))
    smers = lambda body: _let(letters, lambda v: _doubled(v, S, lambda a, b, n: F.shiftleft(a, n).bitwiseXOR(b), body))
    return smers(lambda h: _doubled(h, half, lambda a, b, _: least(a, b), lambda low: chosen(h, low)))


def anchors(text: Column, n: Column) -> Column:
    """The anchors of a text of n characters, in order."""
    blocks = F.sequence(F.lit(0), F.greatest(F.lit(0), n - K).cast("int"), F.lit(BLOCK))
    found = F.flatten(F.transform(blocks, lambda at: _in_block(F.substring(text, at + 1, F.lit(BLOCK + K - 1)), at)))
    return F.when(n >= K, found).otherwise(F.array().cast("array<bigint>"))


def or_whole(anchors: Column, text: Column) -> Column:
    """The anchors, or where there are none, one of the whole text."""
    whole = F.when(F.length(text) > 0, F.array(_packed(F.lit(0), F.xxhash64(text)))).otherwise(F.array().cast("array<bigint>"))
    return _let(anchors, lambda a: F.when(F.size(a) > 0, a).otherwise(whole))


def codes(anchors: Column) -> Column:
    """Of each anchor BITS bits of its hash and FAR of its distance from the one before."""
    before = F.concat(F.array(F.lit(-1 << BITS)), anchors)
    code = lambda x, y: F.shiftleft(x.bitwiseAND(F.lit((1 << BITS) - 1)), FAR).bitwiseOR(place(x) - place(y) - 1)
    return F.zip_with(anchors, F.slice(before, 1, F.size(anchors)), code)


def fingerprint(codes: Column) -> Column:
    """Six hex digits for each code."""
    return F.lower(F.array_join(F.transform(codes, lambda x: F.substring(F.hex(x + (1 << BITS + FAR)), 2, 6)), ""))


def pairs(codes: Column) -> Column:
    """The distinct neighbouring anchors with their distances; of a single anchor, that alone."""
    one = lambda x: F.shiftright(x, FAR)
    two = F.zip_with(F.slice(codes, 1, F.greatest(F.size(codes) - 1, F.lit(0))), F.slice(codes, 2, F.size(codes)), lambda a, b: F.shiftleft(one(a), BITS + FAR).bitwiseOR(b))
    return F.array_distinct(F.when(F.size(codes) > 1, two).otherwise(F.transform(codes, one)))


def likeness(a: Column, b: Column) -> Column:
    """Of two lists of pairs."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(2.0 * shared / (F.size(a) + F.size(b)))


def _numbers(values, kind: str) -> Column:
    """An array constant of any size as one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>") if len(values) else F.array().cast(f"array<{kind}>")


def _place(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at or below value: a search by FAN at each level."""
    below = lambda array: F.size(F.filter(array, lambda b: b <= value))
    step = 1
    while len(bounds) > step * FAN:
        step *= FAN
    at = below(_numbers(bounds[step - 1 :: step], "bigint")) * step
    while step > 1:
        step //= FAN
        at = at + below(F.slice(_numbers(bounds[step - 1 :: step], "bigint"), (at / step).cast("int") + 1, FAN)) * step
    return at


def quantiles(ids: DataFrame, n: int, wanted: int) -> list[int]:
    """Up to wanted - 1 ids that cut n ids into parts of about one size, from a sample of SAMPLED for each part, chosen by hash."""
    share = min(1.0, SAMPLED * wanted / max(1, n))
    sample = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    shares = _numbers([i / wanted for i in range(1, wanted)], "double")
    return sorted(set(sample.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * wanted))).first()[0] or [])) if wanted > 1 else []


def with_next(docs: DataFrame, columns: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """docs (doc_id long, and columns, of which "_tie" orders rows with one id) with next_<column> of the next document by id."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    n, low = ids.agg(F.count(F.lit(1)), F.min("doc_id")).first()
    bounds = [b for b in quantiles(ids, n, min(MOST_RANGES, n // range_rows + 1)) if b != low]
    at = F.coalesce(_place(F.col("doc_id"), bounds), F.lit(0))
    starts = F.when(F.get(_numbers(bounds, "bigint"), F.col("_at") - 1) == F.col("doc_id"), F.col("_at") - 1)
    first = F.col("doc_id").eqNullSafe(F.lit(low)) if not ids.where("doc_id IS NULL").head(1) else F.col("doc_id").isNull()
    copies = F.filter(F.array(F.struct(F.col("_at").alias("range"), F.lit(False).alias("copy")), F.struct(starts.alias("range"), F.lit(True).alias("copy"))), lambda x: x["range"].isNotNull())
    last = F.filter(F.array(F.struct(F.when(first, F.lit(len(bounds))).alias("range"), F.lit(True).alias("copy"))), lambda x: x["range"].isNotNull())
    spread = docs.withColumn("_at", at).select("*", F.explode(F.concat(F.transform(copies, lambda c: F.struct(c["range"].alias("range"), F.when(c["copy"], F.lit(1)).otherwise(F.lit(0)).alias("turn"))), F.transform(last, lambda c: F.struct(c["range"].alias("range"), F.lit(2).alias("turn"))))).alias("_in"))
    order = Window.partitionBy("_in.range").orderBy("_in.turn", F.col("doc_id").asc_nulls_first(), "_tie")
    return spread.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).where("_in.turn = 0").drop("_at", "_in")


def edit_study(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last floor(n / 2) characters give way to as many from the start
    of the next document's text, with the likeness of the text to its edited text and to the next text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("n_chars", F.length("text")).select("*", F.xxhash64("text").alias("_tie"), anchors(F.col("text"), F.col("n_chars")).alias("anchors"))
    paired = with_next(rows, ["text", "n_chars", "anchors"])
    kept = F.col("n_chars") - F.floor(F.col("n_chars") / 2).cast("int")
    paired = paired.withColumn("kept", kept).withColumn("added", F.least(F.col("n_chars") - kept, "next_n_chars"))
    head, tail = F.substring("text", F.lit(1), F.col("kept")), F.substring("next_text", F.lit(1), F.col("added"))
    paired = paired.withColumn("edited", F.concat(head, tail))
    size = F.col("kept") + F.col("added")
    # k-mers of the head, those that hold characters of both, those of the tail
    first = F.greatest(F.lit(0), F.col("kept") - K + 1)
    seam = F.substring("edited", first + 1, F.least(F.col("kept"), F.lit(K - 1)) + F.least(F.col("added"), F.lit(K - 1)))
    of_head = F.filter("anchors", lambda x: place(x) < first)
    of_seam = F.when(F.length(seam) >= K, _in_block(seam, first)).otherwise(F.array().cast("array<bigint>"))
    of_tail = F.transform(F.filter("next_anchors", lambda x: place(x) <= F.col("added") - K), lambda x: x + F.shiftleft(F.col("kept").cast("long"), BITS))
    edited = F.when(size >= K, F.concat(of_head, of_seam, of_tail)).otherwise(F.array().cast("array<bigint>"))
    done = paired.withColumn("edited_anchors", edited)
    for name, of in (("", "text"), ("next_", "next_text"), ("edited_", "edited")):
        done = done.withColumn(f"{name}codes", codes(or_whole(F.col(f"{name}anchors"), F.col(of))))
    for name in ("", "next_", "edited_"):
        done = done.withColumn(f"{name}pairs", pairs(F.col(f"{name}codes")))
    return done.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("codes")).alias("fingerprint"), fingerprint(F.col("edited_codes")).alias("edited_fingerprint"),
        likeness(F.col("pairs"), F.col("edited_pairs")).alias("near_edited"), likeness(F.col("pairs"), F.col("next_pairs")).alias("near_next"),
    )
