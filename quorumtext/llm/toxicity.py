"""Toxicity of texts that may be written to slip past a filter: noisy-channel deobfuscation, then a classifier.

A word that mixes letters with look-alikes (1, 0, $, @, ..) or other signs, repeats a letter, or is spelled out with
separators or white space becomes a lattice, whatever its length: each place offers the letters it may stand for, at a cost. Numbers stay. A character language model
(interpolated n-grams over the words of all texts, summed in Spark) scores the paths, and Viterbi picks the best word. Other words
stay as they are, so most text is never decoded, and decoded words are kept per worker.

The classifier is a logistic regression on the presence of the words and beginnings of words that most surely mark label 1, or the surest of them alone.
Its training reads at most about `training_rows` labelled rows, chosen by the hash of the id (a choice that depends on the id and
the number of labelled rows alone). The language model counts every text; only its sums of n-grams come to the driver.

Defined cases: null and empty text have no words and score the intercept; with one class or no rows to learn from, the score is the
smoothed share of label 1; rows without a label never train; repeated rows are scored each; whole texts count; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby
from os.path import commonprefix

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.llm.common import Account, map_frames, materialize

TRAINING_ROWS, FEATURES, ORDER = 20_000, 512, 4
KEPT_WORDS = 150_000

# Letters that a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "*": "aeiou", "#": "aeiou", "€": "e", "£": "l",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s",
}
#: Natural log of the chance that a writer puts a look-alike, stretches a letter, doubles a single one, or adds a stray sign.
SWAPPED, STRETCHED, DOUBLED, STRAY = -1.0, -0.5, -2.0, -3.0

_signs = "".join(map(re.escape, LOOKALIKES))
_edges = re.compile(r"^[^\w@$!|+(<*#€£]+|[^\w@$!|+(<*#€£]+$")
_tail = re.compile(r"([!*#$|+(<])\1+$|(?<=\w)[!*#|+(<]$")
_plain = re.compile(r"[^\W\d_]+")
_repeated = re.compile(r"(.)\1")
_stretched = re.compile(r"(.)\1\1")
_sign = re.compile(r"[^\w]|_")
_separated = re.compile(r"[^\W_](?:([._\-~*|/·])[^\W_])(?:\1[^\W_]){2,}")
_spaced = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
#: Signs of ASCII that stand for no letter.
_SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "_" and c not in LOOKALIKES)
_invisible = re.compile("[​-‏⁠﻿­̀-ͯ]")


def word_grams(word: str, order: int) -> Iterator[str]:
    """The n-grams up to order that end at each letter of a word and at its end."""
    text = "^" * (order - 1) + word + "$"
    for i in range(order - 1, len(text)):
        for n in range(order):
            yield text[i - n : i + 1]


class CharModel:
    """Interpolated character n-grams of words with boundaries; unseen contexts fall back to shorter ones."""

    def __init__(self, words: dict[str, float], order: int = ORDER):
        sums: Counter = Counter()
        for word, weight in words.items():
            for gram in word_grams(word, order):
                sums[gram] += weight
        self._set(sums, order)

    @classmethod
    def summed(cls, sums: dict[str, float], order: int = ORDER) -> CharModel:
        """From the weights of all n-grams."""
        out = cls.__new__(cls)
        out._set(sums, order)
        return out

    def _set(self, sums: dict[str, float], order: int) -> None:
        self.order, self.alphabet = order, 2
        self.grams: list[Counter] = [Counter() for _ in range(order)]
        self.contexts: list[Counter] = [Counter() for _ in range(order)]
        self.kinds: list[Counter] = [Counter() for _ in range(order)]
        for gram, weight in sums.items():
            n = len(gram) - 1
            self.grams[n][gram] = weight
            self.contexts[n][gram[:-1]] += weight
            self.kinds[n][gram[:-1]] += 1
        self.alphabet += len(self.grams[0].keys() - {"$"})
        self.known: dict[str, float] = {}

    def log(self, gram: str) -> float:
        """log P(last character | those before it)."""
        if gram not in self.known:
            p = 1.0 / self.alphabet
            for n in range(self.order):
                part = gram[len(gram) - 1 - n :]
                if total := self.contexts[n].get(part[:-1], 0.0):
                    kinds = self.kinds[n][part[:-1]]
                    p = (self.grams[n].get(part, 0.0) + kinds * p) / (total + kinds)
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[gram] = math.log(p)
        return self.known[gram]


def lattice(word: str) -> Iterator[list[tuple[str, float]]]:
    """For each run of equal characters, what it may stand for, with log-chances."""
    for c, run in groupby(word):
        n = len(list(run))
        if c in LOOKALIKES:
            options = [(x * k, SWAPPED * n + (STRETCHED if k < n else 0.0)) for x in LOOKALIKES[c] for k in {1, min(n, 2)}]
            options.append(("", STRAY))
            if c.isalnum():
                options.append((c * n, STRAY))
        elif c.isalpha():
            options = [(c, 0.0)] if n == 1 else [(c * 2, 0.0), (c, DOUBLED)] if n == 2 else [(c, STRETCHED), (c * 2, STRETCHED)]
        else:
            options = [("", STRAY * 0.3), (c, STRAY * 2)]
        yield options


def decode(word: str, model: CharModel) -> str:
    """The likeliest word behind an obfuscated one; Viterbi over the last characters as states, ties to the smaller text."""
    keep = model.order - 1
    states, settled = {"^" * keep: (0.0, "")}, ""
    for place, options in enumerate(lattice(word), 1):
        after: dict[str, tuple[float, str]] = {}
        for state, (score, text) in states.items():
            for letters, chance in options:
                s, at = score + chance, state
                for c in letters:
                    s += model.log(at + c)
                    at = (at + c)[-keep:]
                found = (s, text + letters)
                if at not in after or found[0] > after[at][0] or found[0] == after[at][0] and found[1] < after[at][1]:
                    after[at] = found
        states = after
        if place % 64 == 0:  # what all paths share is settled, so that long words take linear time
            shared = commonprefix([text for _, text in states.values()])
            settled += shared
            states = {state: (score, text[len(shared) :]) for state, (score, text) in states.items()}
    return settled + min((-(score + model.log(state + "$")), text) for state, (score, text) in states.items())[1]


class Goals:
    """Which words can a lattice still become, of those that a classifier knows? The others need no decoding."""

    def __init__(self, marks):
        self.words = {m for m in marks if m[-1:] != "~"}
        self.starts = {m[:-1] for m in marks if m[-1:] == "~"}
        self.ways = {g[:n] for g in self.words | self.starts for n in range(len(g) + 1)}

    def reached(self, places: Iterable[list[tuple[str, float]]]) -> bool:
        """Whether any path through a lattice spells a word, or begins as one. Most lattices end at their first places."""
        at = {""}
        for options in places:
            after = set()
            for state in at:
                for letters, _ in options:
                    now = state
                    for c in letters:
                        now += c
                        if now in self.starts:
                            return True
                    if now in self.ways:
                        after.add(now)
            if not after:
                return False
            at = after
        return not at.isdisjoint(self.words)


class Restorer(dict):
    """word as written -> its marks: the restored word and its beginnings, which inflected words share. Of those wanted, where they are given, as
    a classifier needs no others. Kept for a bounded number of words."""

    def __init__(self, model: CharModel, wanted=None):
        super().__init__()
        self.model, self.wanted, self.goals = model, wanted, None if wanted is None else Goals(wanted)

    def __missing__(self, word: str) -> tuple[str, ...]:
        w = self.restored(word)
        out = () if not w else (w,) if len(w) < 5 else (w, w[:4] + "~", w[:5] + "~")
        if out and self.wanted is not None:
            out = tuple([m for m in out if m in self.wanted])
        if len(word) <= 64:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = out
        return out

    def restored(self, word: str) -> str:
        bare = word.strip(_SIGNS)
        if not (bare.isascii() and bare.isalpha()):  # most words are, and need none of this
            bare = _tail.sub("", _invisible.sub("", _edges.sub("", word)))
        if _plain.fullmatch(bare) and bare.isascii() and not _repeated.search(bare):
            return bare
        if _separated.fullmatch(bare):
            bare = re.sub(r"[._\-~*|/·]", "", bare)
        # digits alone, with or without signs, are a number; signs alone may be a word
        if not any(c.isalpha() for c in bare) and (any(c.isdigit() for c in bare) or not any(c in LOOKALIKES for c in bare)):
            return bare
        if not _repeated.search(bare) and not _sign.search(bare) and not any(c in LOOKALIKES for c in bare):
            return bare
        return "" if self.goals and not self.goals.reached(lattice(bare)) else decode(bare, self.model)

    def marks(self, text: str | None) -> set[str]:
        """The marks of a text's distinct words, and of those that it spells out."""
        text = (text or "").lower()
        found = set().union(*filter(None, map(self.__getitem__, set(text.split()))))
        for run in _spaced.finditer(text):
            found.update(self["".join(run[0].split())])
            gaps = set(map(len, re.findall(r"\s+", run[0])))
            if len(gaps) > 1:  # wider gaps between words that are spelled out
                for w in re.split(r"\s{%d,}" % (min(gaps) + 1), run[0]):
                    found.update(self["".join(w.split())])
        return found


def _fit(rows: list[tuple[int, ...]], labels: list[int], width: int, strength: float = 0.02, steps: int = 100) -> tuple[np.ndarray, float]:
    """L2-regularized logistic regression on sets of features, by Newton steps until they settle. Rows with equal features, most of
    all those without any, are one row with counts."""
    seen: dict[tuple[int, ...], list[int]] = {}
    for r, y in zip(rows, labels):
        seen.setdefault(r, [0, 0])[y] += 1
    x = np.zeros((len(seen), width + 1), "float32")
    x[:, width] = 1
    for i, r in enumerate(seen):
        x[i, list(r)] = 1
    counts = np.array(list(seen.values()), "float64")
    n, ones = counts.sum(axis=1), counts[:, 1]
    w = np.zeros(width + 1)
    w[width] = math.log((ones.sum() + 1) / (n.sum() - ones.sum() + 1))
    penalty = np.full(width + 1, strength)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = np.zeros((width + 1, width + 1))
        for at in range(0, len(x), 2048):
            part = x[at : at + 2048].astype("float64")
            curve += part.T @ (part * (n * p * (1 - p))[at : at + 2048, None])
        step = np.linalg.solve(curve + np.diag(penalty), x.T @ (ones - n * p) - penalty * w)
        w += step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w[:width], float(w[width])


def lower_bound(ones: int, n: int, z: float = 4.0) -> float:
    """Wilson's lower bound of a share of n; z is large as the marking words are the best of very many."""
    p, zz = ones / n, z * z / n
    return (p + zz / 2 - z * math.sqrt(p * (1 - p) / n + zz / (4 * n))) / (1 + zz)


class Classifier:
    """The larger of two scores: the regression over all marking words, and the surest single word, as the share of label 1 among the
    training rows that have it, at the lower bound. The regression alone can't tell what one bad word means where rows
    have either none or several."""

    def __init__(self, model: CharModel, weights: dict[str, float], bias: float, alone: dict[str, float] | None = None):
        self.model, self.weights, self.bias, self.alone = model, weights, bias, alone or {}

    def scorer(self):
        restorer = Restorer(self.model, self.weights.keys() | self.alone.keys())

        def score(text: str | None) -> float:
            found = sorted(restorer.marks(text))
            together = 1 / (1 + math.exp(-max(-500.0, min(500.0, self.bias + sum(self.weights.get(w, 0.0) for w in found)))))
            return max([together, *(self.alone.get(w, 0.0) for w in found)])

        return score


def char_model(texts: DataFrame) -> CharModel:
    """The language model over the plain words of all rows' text. A word counts by the square root of its documents, so that common
    words don't drown rare ones; weights are whole thousandths, so that sums don't depend on their order."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.text:
                counts.update(set((text or "").lower().split()))
            if len(counts) > KEPT_WORDS:
                yield told(counts)
                counts.clear()
        yield told(counts)

    def told(counts: Counter) -> pd.DataFrame:
        return pd.DataFrame([(w, n) for w, n in counts.items() if _plain.fullmatch(w) and not _stretched.search(w)], columns=["word", "n"])

    def spelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: Counter = Counter()
        for batch in batches:
            for word, weight in zip(batch.word, batch.weight):
                for gram in word_grams(word, ORDER):
                    sums[gram] += weight
            if len(sums) > KEPT_WORDS:
                yield pd.DataFrame(list(sums.items()), columns=["gram", "weight"])
                sums.clear()
        yield pd.DataFrame(list(sums.items()), columns=["gram", "weight"])

    words = map_frames(texts.select("text"), listed, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    weighed = words.select("word", F.round(1000 * F.sqrt("n")).cast("long").alias("weight"))
    grams = weighed.mapInPandas(spelled, "gram string, weight long").groupBy("gram").agg(F.sum("weight").alias("weight"))
    return CharModel.summed({r.gram: r.weight / 1000 for r in sorted(grams.collect())})  # bounded by the alphabet


def train(labelled: DataFrame, training_rows: int = TRAINING_ROWS, features: int = FEATURES, corpus: DataFrame | None = None) -> Classifier:
    """labelled: id, text, toxic (0 or 1). corpus: the texts of the language model, labelled or not; those of labelled if not given."""
    with Account():
        return _trained(labelled, training_rows, features, labelled if corpus is None else corpus)


def _trained(labelled: DataFrame, training_rows: int, features: int, corpus: DataFrame) -> Classifier:
    labelled = labelled.where("toxic IS NOT NULL")
    share = min(1.0, training_rows / max(1, labelled.select("toxic").count()))
    sample = materialize(labelled.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("id", "text", "toxic"), "labelled")
    sizes = {r.toxic: r.n for r in sample.groupBy((F.col("toxic") == 1).cast("int").alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Classifier(CharModel({}), {}, math.log((bad + 0.5) / (good + 0.5)))

    def counted(restorer_of):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            words_of, counts = restorer_of(), (Counter(), Counter())
            for batch in batches:
                for text, toxic in zip(batch.text, batch.toxic):
                    counts[int(toxic == 1)].update(words_of(text))
            yield pd.DataFrame([(w, counts[0][w], counts[1][w]) for w in counts[0] | counts[1]], columns=["word", "clean", "toxic"])

        return sample.select("text", "toxic").mapInPandas(run, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("clean + toxic >= 3")

    model = char_model(corpus)
    shared = sample.sparkSession.sparkContext.broadcast(model)
    c, t = (F.col(x).cast("double") for x in ("clean", "toxic"))
    odds = F.log((t + 0.5) / (bad - t + 0.5)) - F.log((c + 0.5) / (good - c + 0.5))
    error = F.sqrt(1 / (t + 0.5) + 1 / (bad - t + 0.5) + 1 / (c + 0.5) + 1 / (good - c + 0.5))
    sure = odds - 3 * error  # words that mark label 1; those that only go with long or clean texts would blur it
    chosen = counted(lambda: Restorer(shared.value).marks).withColumn("sure", sure).where("sure > 0.3").orderBy(F.desc("sure"), "word").limit(features)
    found = sorted((r.word, r.toxic, r.clean) for r in chosen.collect())
    names = [w for w, _, _ in found]
    alone = {w: lower_bound(t, t + c) for w, t, c in found if w[-1] != "~"}
    index = {w: i for i, w in enumerate(names)}

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words_of = Restorer(shared.value, index.keys()).marks
        for batch in batches:
            yield pd.DataFrame({"id": batch.id, "toxic": (batch.toxic == 1).astype("int64"), "found": [sorted(index[w] for w in words_of(t)) for t in batch.text]})

    # the bounded sample, a few numbers a row
    rows = sorted(sample.mapInPandas(featured, "id long, toxic long, found array<int>").collect(), key=lambda r: (r.id is None, r.id, r.toxic, r.found))
    w, bias = _fit([tuple(r.found) for r in rows], [r.toxic for r in rows], len(names))
    return Classifier(model, dict(zip(names, map(float, w))), float(bias), alone)


def score(docs: DataFrame, classifier: Classifier, id_column: str = "doc_id") -> DataFrame:
    """id_column, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = shared.value.scorer()
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "score": [of(t) for t in batch.text]})

    out = map_frames(docs.select(F.col(id_column).cast("string").alias("id"), "text"), run, "id string, score double")
    return out.withColumn("id", F.col("id").cast(docs.schema[id_column].dataType)).withColumnRenamed("id", id_column)


def without_toxic(docs: DataFrame, classifier: Classifier, least: float = 0.7) -> DataFrame:
    """docs without the rows whose text scores `least` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = shared.value.scorer()
        for texts in batches:
            yield pd.Series([of(t) for t in texts], dtype="float64")

    return docs.where(scored("text") < least)
