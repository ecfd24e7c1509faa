"""The corpus pipeline: documents to packed training sequences.

Each stage works on all that the stage before kept, its output is written as Parquet and read
again, and all but the last return the columns of ``documents`` (others are left out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import jaccard, language, mixing, packing, secrets
from marginalia.llm.common import cut, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what language ID rejects: ``und``, which is a null text or one without a letter, and
    texts whose vector shares nothing with any language (score 0)."""
    docs = docs.select(*COLUMNS)
    labels, protos = language.fit(docs)
    found = language.identify(docs, labels, protos)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") > 0)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component: that with the smallest doc_id (null last). Rows that share an
    id but not the text are judged each by its own text, rows without an id by theirs, and rows
    that are equal in both are one, of which the first in order of the other columns stays.

    A row's key is its doc_id, as in most tables; a further text of an id, and a row without one,
    has a hash of both beyond all ids (2**62) instead.
    """
    docs = docs.select(*COLUMNS)
    texts = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("lo"), F.max(F.xxhash64("text")).alias("hi"))
    several = cut(texts.where("lo <> hi").select("doc_id", "lo"), "several")
    further = F.col("doc_id").isNull() | F.coalesce(F.xxhash64("text") != F.col("lo"), F.lit(False))
    beyond = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2).bitwiseOR(F.lit(1 << 62))
    docs = docs.join(several, "doc_id", "left").withColumn("key", F.when(further, beyond).otherwise(F.col("doc_id"))).select(*COLUMNS, "key")
    linked = jaccard.link(docs, id_col="key").select(F.col("doc_id").alias("key"), "component_id").distinct()
    rank = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "key")
    first = docs.select("key", "doc_id").join(linked, "key").groupBy("component_id").agg(F.min(rank).alias("x"))
    kept = cut(first.select("x.key"), "first")
    chosen = docs.join(kept, "key", "left_semi")
    return chosen.groupBy("key").agg(F.min(F.struct(*COLUMNS)).alias("x")).select("x.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; no document goes."""
    docs = docs.select(*COLUMNS)
    found = secrets.find_secrets(docs, secrets.learn(docs), redact=True)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its rate says."""
    docs = docs.select(*COLUMNS)
    mixed = mixing.mix(docs, table(spark, sf_dir, "labels")).withColumn("copies", mixing.copies())
    taken = mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: SQL cannot express language profiles, inferred automata or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
