"""Chat formatting: cumulative snapshots are collapsed, then maximal conversations are rendered.

A conversation is often logged again after every turn. Each turn carries the hash of the prefix
that it ends: two running sums of hashes of (place, role, text). A conversation whose final hash is
the hash of a proper prefix of another one is dropped by an anti-join; of conversations with the
same turns the smallest conv_id stays. DataFrame functions only.

Defined cases: turns are ordered by turn, role and text, nulls first, and repeated rows are turns
of their own; null roles and texts differ from empty ones but are rendered as empty; rows without a
conv_id belong to no conversation; an empty table gives no rows; further columns are ignored. The
marker ``<|`` within roles and texts is rendered as ``< |``. A rendered conversation is one row,
so a conversation must fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

HASH_RANGE = 1 << 40  # running sums of 2**22 turns stay within a long


def _turn_hash(salt: int) -> Column:
    parts = [F.lit(salt), F.col("pos")]
    for c in ("role", "text"):
        parts += [F.col(c).isNull(), F.coalesce(F.col(c), F.lit(""))]
    return F.pmod(F.xxhash64(*parts), F.lit(HASH_RANGE))


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with its place from 1, its conversation's length n and its prefix hash h1, h2."""
    whole = Window.partitionBy("conv_id")
    order = whole.orderBy("turn", "role", "text")
    running = whole.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", "role", "text").withColumn("pos", F.row_number().over(order))
    return placed.select(
        "conv_id", "pos", "role", "text",
        F.count(F.lit(1)).over(whole).alias("n"),
        F.sum(_turn_hash(1)).over(running).alias("h1"),
        F.sum(_turn_hash(2)).over(running).alias("h2"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, n, n_copies of the conversations that are no proper prefix of another one."""
    hashed = prefixes(turns).select("conv_id", "pos", "n", "h1", "h2")
    finals = hashed.where(F.col("pos") == F.col("n")).groupBy("h1", "h2", "n").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    proper = hashed.where(F.col("pos") < F.col("n")).select("h1", "h2", F.col("pos").cast("long").alias("n")).distinct()
    return finals.join(proper, ["h1", "h2", "n"], "left_anti").select("conv_id", "n", "n_copies")


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies, chat: ChatML of each kept conversation."""
    clean = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))
    line = lambda t: F.concat(F.lit("<|im_start|>"), clean(t["role"]), F.lit("\n"), clean(t["text"]), F.lit("<|im_end|>\n"))
    lists = (
        turns.select("conv_id", "turn", "role", "text").join(kept, "conv_id")
        .groupBy("conv_id", "n", "n_copies")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    )
    by_nulls_first = F.expr(
        "array_sort(turns, (a, b) -> CASE"
        + "".join(
            f" WHEN a.{c} IS NULL AND b.{c} IS NOT NULL THEN -1 WHEN a.{c} IS NOT NULL AND b.{c} IS NULL THEN 1 WHEN a.{c} < b.{c} THEN -1 WHEN a.{c} > b.{c} THEN 1"
            for c in ("turn", "role", "text")
        )
        + " ELSE 0 END)"
    )
    return lists.select("conv_id", F.col("n").alias("n_turns"), "n_copies", F.array_join(F.transform(by_nulls_first, line), "").alias("chat"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All maximal conversations, rendered."""
    turns = table(spark, sf_dir, "conversations")
    return render(turns, maximal(turns))


OP8_SQL = """
WITH t AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, count(*) AS n, list(struct_pack(r := role, x := text) ORDER BY pos) AS turns,
         string_agg('<|im_start|>' || replace(coalesce(role, ''), '<|', '< |') || chr(10)
                    || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS chat
  FROM t GROUP BY conv_id),
d AS (SELECT min(conv_id) AS conv_id, n, turns, min(chat) AS chat, count(*) AS n_copies FROM c GROUP BY n, turns),
p AS (SELECT DISTINCT c.turns[1:k.k] AS turns FROM c, LATERAL (SELECT unnest(range(1, c.n)) AS k) AS k)
SELECT conv_id, n AS n_turns, n_copies, chat FROM d WHERE turns NOT IN (SELECT turns FROM p)
"""
