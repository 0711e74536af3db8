"""Sequence similarity of comparison keys, as Python's difflib defines it: matching blocks, popularity heuristic included.

No Spark expression has this measure (edit distance is another), so it is the one kind of Arrow UDF of the engine: by value here, over arrays in fusion. Equal keys have ratio 1 and empty
ones 0 against others without matching, and repeated pairs in a batch are matched once.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Stand for popular characters of the first and the second text: lone surrogates, which no text holds, and which differ.
_MASKS = "\ud800", "\ud801"


def _same_until(a: str, i: int, a1: int, b: str, j: int, b1: int) -> int:
    """The end in a of what a from i and b from j share."""
    end = min(a1, i + b1 - j)
    while i + 16 <= end and a[i : i + 16] == b[j : j + 16]:
        i, j = i + 16, j + 16
    while i < end and a[i] == b[j]:
        i, j = i + 1, j + 1
    return i


def _same_from(a: str, i: int, a0: int, b: str, j: int, b0: int) -> int:
    """The start in a of what a up to i and b up to j share."""
    start = max(a0, i - j + b0)
    while i - 16 >= start and a[i - 16 : i] == b[j - 16 : j]:
        i, j = i - 16, j - 16
    while i > start and a[i - 1] == b[j - 1]:
        i, j = i - 1, j - 1
    return i


def _matched(a: str, b: str) -> int:
    """How many characters difflib's matching blocks hold. Its longest match starts from characters of b that aren't popular; here those of
    them that a has are looked up by str.find, longer each time, which finds the same block: the first in a, then in b. No range holds a longer
    one than the range it was cut from, so its search ends with the first of that size."""
    counts, n = Counter(b), len(b)
    popular = {c for c, k in counts.items() if k > n // 100 + 1} if n >= 200 else ()
    rare_a, rare_b = (t.translate(dict.fromkeys(map(ord, popular), mask)) if popular else t for t, mask in zip((a, b), _MASKS))
    spots = [i for i, c in enumerate(rare_a) if c in counts and c not in popular]
    total, ranges = 0, [(0, len(a), 0, n, n)]
    while ranges:
        a0, a1, b0, b1, most = ranges.pop()
        i, j, size = a0, b0, 0
        for k in range(bisect_left(spots, a0), len(spots)):
            at = spots[k]
            end = at + size + 1
            if end > a1 or size == most:
                break
            found = rare_b.find(rare_a[at:end], b0, b1)
            while found >= 0:
                i, j = at, found
                while end < a1 and found + end - at < b1 and rare_a[end] == rare_b[found + end - at]:
                    end += 1
                size = end - at
                end += 1
                found = rare_b.find(rare_a[at:end], found + 1, b1) if end <= a1 and size < most else -1
        most = size
        if not size and (a0 or b0):  # ranges start where a match ended, but for the first
            continue
        end = i + size
        if popular or not size:  # else the block can't grow
            start, end = _same_from(a, i, a0, b, j, b0), _same_until(a, end, a1, b, j + size, b1)
            i, j, size = start, j - i + start, end - start
        if size:
            total += size
            if a0 < i and b0 < j:
                ranges.append((a0, i, b0, j, most))
            if end < a1 and j + size < b1:
                ranges.append((end, a1, j + size, b1, most))
    return total


def ratio(a: str, b: str) -> float:
    """SequenceMatcher(None, a, b).ratio(). The order of the arguments matters: popular characters are left out of the second from 200
    characters on."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    return 2.0 * _matched(a, b) / (len(a) + len(b))


class Ratios(dict):
    """(a, b) -> ratio, matched when first asked for."""

    def __missing__(self, pair: tuple[str, str]) -> float:
        self[pair] = found = ratio(*pair)
        return found


@F.pandas_udf(T.DoubleType())
def similarity(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        known = Ratios()
        yield pd.Series([None if None in pair else known[pair] for pair in zip(a, b)], dtype="float64")
