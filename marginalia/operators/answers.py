"""Answers of problems: boxes in discussion topics, choices, answer keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import answer_index
from ..functions.text import SPACE, first_boxed, parse_answer

REFUSED = "E_NO_PERMISSION"
KEY_ENTRY = rf"(1[0-5]|[1-9])\.{SPACE}(\d{{3}})"
KEY_PROBLEMS = 15


def topic_answers(posts: DataFrame) -> DataFrame:
    """topic_id, boxed (of the first post in order that has one), refused."""
    found = posts.select("topic_id", "pos", "error_code", first_boxed(F.col("post_canonical")).alias("b"))
    return found.groupBy("topic_id").agg(F.expr("min_by(b, pos) FILTER (WHERE b IS NOT NULL)").alias("boxed"), F.coalesce(F.max(F.col("error_code") == REFUSED), F.lit(False)).alias("refused"))


def answer(rows: DataFrame, posts: DataFrame) -> DataFrame:
    """Adds answer_index and answers to problems of ``assemble.problems``.

    Looked up are single problems of computational types. From the first refused topic of a test
    on, nothing more is found in it. With choices the index is that of the letter or text, -1 if
    none; without, the found text is the only answer and has index 0 even if nothing was found.
    Items of lists have no index, other single problems have -1.
    """
    looked = ~F.col("is_list") & F.coalesce("computational", F.lit(False))
    so_far = Window.partitionBy("test_id").orderBy("pos", "j").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.join(topic_answers(posts), "topic_id", "left").withColumn("looked", looked)
    rows = rows.withColumn("latched", F.max(F.col("looked") & F.coalesce("refused", F.lit(False))).over(so_far))
    rows = rows.withColumn("boxed", F.when(F.col("looked") & ~F.col("latched"), F.col("boxed")))
    none = F.array().cast("array<string>")
    return rows.select(
        "*",
        F.when(F.col("is_list"), F.lit(None).cast("int")).when(~F.col("looked"), -1).when(F.col("has_choices"), answer_index(parse_answer(F.col("boxed")), F.col("choices"))).otherwise(0).cast("int").alias("answer_index"),
        F.when(F.col("looked") & ~F.col("has_choices"), F.array("boxed")).when(F.col("is_list") | F.col("looked"), F.coalesce("choices", none)).otherwise(none).alias("answers"),
    ).drop("looked", "latched", "refused", "boxed")


def answer_keys(items: DataFrame) -> DataFrame:
    """test_id, number, key: entries of a key in the last item of AIME tests, by their printed
    number; of entries with one number the first counts."""
    last = items.groupBy("test_id").agg(F.max_by(F.struct("item_text", F.col("post.post_canonical").alias("text"), "type_now"), "pos").alias("x"))
    keys = last.where("x.type_now = 'AIME' AND lower(x.item_text) = 'answer key'")
    numbers = F.regexp_extract_all("x.text", F.lit(KEY_ENTRY), F.lit(1))
    values = F.regexp_extract_all("x.text", F.lit(KEY_ENTRY), F.lit(2))
    rows = keys.select("test_id", F.posexplode(F.arrays_zip(numbers.alias("number"), values.alias("key"))).alias("i", "e"))
    return rows.groupBy("test_id", F.col("e.number").cast("int").alias("number")).agg(F.min_by("e.key", "i").alias("key"))


def apply_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The first problems of a test get the key with their number as their only answer."""
    order = Window.partitionBy("test_id").orderBy("pos", "j")
    placed = rows.withColumn("number", F.row_number().over(order))
    joined = placed.join(keys, ["test_id", "number"], "left")
    hit = F.col("key").isNotNull() & (F.col("number") <= KEY_PROBLEMS)
    return joined.withColumn("answers", F.when(hit, F.array("key")).otherwise(F.col("answers"))).drop("key", "number")
