"""The registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumtext.llm import embeddings, htmltext, langid, mixing, neardup, packing, substrings, syncmers, tokens, toxicity
from quorumtext.llm.common import fold, read


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 6).alias("position")).orderBy("position", "doc_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read(spark, sf_dir, "documents"), tokens.load_pieces(vocabulary("piece_bpe_32k.model")))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), room=1024)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    found = langid.identify(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_token_counts, op3_pack, op6_language)}
ORACLE_SQL = {"op1_mix_sources": mixing.ORACLE, "op4_near_duplicates": neardup.ORACLE, "op5_near_vectors": embeddings.ORACLE}


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


QUERIES["op4_near_duplicates"] = op4_near_duplicates


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substrings.dedup_substrings(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_removed", "text")


QUERIES["op7_substrings"] = op7_substrings


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Classifier:
    """Trained on the labelled documents outside the held-out third, with the character model of all documents' words."""
    labelled = docs.select("doc_id", "text").join(labels.where(fold("doc_id", 3) != 1).select("doc_id", "toxic"), "doc_id")
    return toxicity.train(labelled.withColumnRenamed("doc_id", "id"), corpus=docs)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES["op10_toxicity"] = op10_toxicity


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(read(spark, sf_dir, "pages"))


QUERIES["op8_main_text"] = op8_main_text


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edit_study(read(spark, sf_dir, "documents"))


QUERIES["op9_fingerprints"] = op9_fingerprints


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(read(spark, sf_dir, "embeddings"))


QUERIES["op5_near_vectors"] = op5_near_vectors
