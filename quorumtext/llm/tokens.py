"""Token counts under a unigram vocabulary, without building the tokens.

Text is cut before every space as unigram tokenizers with a word mark do (the mark stands for the space; one is put in front
of a text that doesn't begin with a space). In each such word an Aho-Corasick automaton lists the vocabulary pieces that end
at each character, longest first, and dynamic programming keeps the best score and the number of pieces on the best path.
The tie rules are the tokenizer's: of equal scores the one whose last piece starts first stays; a character without a piece
of its own may be unknown, at the least score less 10; with byte fallback an unknown character counts its bytes, otherwise a
run of unknown characters counts one.

Defined cases: null or empty text has 0 tokens; repeated rows are counted each; very long texts are streamed word by word; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumtext.llm.common import map_frames

MARK = "▁"
#: Counts of words that a worker keeps; beyond it starts anew, which changes no result.
KEPT_WORDS = 400_000


def load_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, by id; its scores are taken as they stand."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size())]


class Counter(dict):
    """word (with its mark) -> number of tokens, computed when first asked for."""

    def __init__(self, pieces: Sequence[tuple[str, float]], byte_fallback: bool = True):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - 10.0
        names = {piece for piece, _ in pieces}
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in names for b in range(256))

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        n = self.count(word)
        if len(word) <= 64:
            self[word] = n
        return n

    def count(self, word: str) -> int:
        ends: list[list[tuple[int, float]]] = [[] for _ in word]
        for end, found in self.automaton.iter(word):
            ends[end].append(found)
        best, pieces, unknown_last = [0.0], [0], [False]
        for i, found in enumerate(ends):
            score, n, unknown, single = None, 0, False, False
            for length, gain in sorted(found, reverse=True):
                start = i + 1 - length
                single |= length == 1
                if score is None or best[start] + gain > score:
                    score, n, unknown = best[start] + gain, pieces[start] + 1, False
            if not single and (score is None or best[i] + self.unknown > score):
                score, unknown = best[i] + self.unknown, True
                n = pieces[i] + (len(word[i].encode()) if self.bytes else 0 if unknown_last[i] else 1)
            best.append(score)
            pieces.append(n)
            unknown_last.append(unknown)
        return pieces[-1]

    def total(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(MARK, " ").split(" ")  # a mark in the text is a space to these tokenizers
        if not words[0]:  # a text that begins with a space has its mark already
            words = words[1:]
        return sum(map(self.__getitem__, [MARK + w for w in words]))


def count_tokens(docs: DataFrame, pieces: Sequence[tuple[str, float]], byte_fallback: bool = True, id_column: str = "doc_id") -> DataFrame:
    """id_column, n_chars (code points), n_tokens. pieces are sent to each worker: a vocabulary, not data."""
    spark: SparkSession = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(list(pieces))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(vocabulary.value, byte_fallback)
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "n_chars": [len(t or "") for t in batch.text], "n_tokens": [counter.total(t) for t in batch.text]})

    out = map_frames(docs.select(F.col(id_column).cast("string").alias("id"), "text"), run, "id string, n_chars long, n_tokens long")
    return out.withColumn("id", F.col("id").cast(docs.schema[id_column].dataType)).withColumnRenamed("id", id_column)
