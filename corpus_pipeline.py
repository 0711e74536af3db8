"""A training corpus from raw documents: toxicity, near duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all the documents that the stage before kept; all but the last return the columns of
documents. Rows whose id is null have no identity to link, so the dedup stage keeps them. What a stage writes on the way it deletes itself, but for what its
result reads; run() deletes that, too, once the next stage's documents are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumtext.llm import mixing, neardup, packing, substrings, toxicity
from quorumtext.llm.common import materialize, read, release, tidy
from quorumtext.llm.queries import toxicity_model, vocabulary


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier marks are rejected."""
    return toxicity.without_toxic(docs, toxicity_model(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays; of rows that share an id, one."""
    kept = neardup.near_duplicates(docs).where("kept").select("doc_id").distinct()
    named = docs.join(kept.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences in repeated spans go, but for the first place of each."""
    cleaned = substrings.dedup_substrings(docs)
    sizes = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return cleaned.select(*docs.columns).withColumns(sizes)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated or left out so that sources meet their targets, in training order."""
    return mixing.training_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), room=1024)


STAGES = [("toxicity", toxic), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("mix", mix), ("pack", pack)]

#: No stage but mixing can be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


@tidy
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again, as the next reads it several times."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = materialize(step(spark, docs, sf_dir), name)
        release(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
