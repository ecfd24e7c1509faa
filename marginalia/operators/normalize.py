"""The flat tables series, tests and problems, with dense ids in document order.

Ids of problems come from counts of the tests before: only one row for each test is ordered over
all data, problems are numbered within their test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import cut
from ..sources import schemas


BUCKET = 1 << 16


def dense_ids(rows: DataFrame, order: list[Column | str], name: str = "id") -> DataFrame:
    """Adds 0, 1, 2, ... in ``order``: rows are dealt to tasks by range, numbered within each, and
    shifted by the sizes of the ranges before, of which there is one row for each task."""
    dealt = cut(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_size")).select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return dealt.withColumn("_rank", rank).join(shifts, "_range").withColumn(name, (F.col("_shift") + F.col("_rank")).cast("long")).drop("_range", "_rank", "_shift")


def numbered_within(rows: DataFrame, parents: DataFrame, parent: str, order: list[Column | str], name: str = "id") -> DataFrame:
    """Adds dense ids to ``rows``, which follow their parents' order and ``order`` within one.
    Parents have dense ids, so their sizes are added up bucket by bucket."""
    sizes = rows.groupBy(parent).agg(F.count(F.lit(1)).alias("_size"))
    sized = parents.select(parent).join(sizes, parent).withColumn("_bucket", F.floor(F.col(parent) / BUCKET))
    so_far = lambda w: F.coalesce(F.sum("_size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sized.groupBy("_bucket").agg(F.sum("_size").alias("_size")).select("_bucket", so_far(Window.orderBy("_bucket")).alias("_shift"))
    inner = sized.withColumn("_inner", so_far(Window.partitionBy("_bucket").orderBy(parent))).join(shifts, "_bucket")
    offsets = inner.select(parent, (F.col("_inner") + F.col("_shift")).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy(parent).orderBy(*order)) - 1
    return rows.withColumn("_rank", rank).join(offsets, parent).withColumn(name, (F.col("_offset") + F.col("_rank")).cast("long")).drop("_rank", "_offset")


def series_table(names: DataFrame, order: list[Column | str]) -> DataFrame:
    """id, name, is_official of rows with ``name``; other columns stay for joins."""
    return dense_ids(names, order).withColumn("is_official", F.lit(False))


def tests_table(tests: DataFrame, titles: DataFrame, flat: DataFrame, key: str = "test_id") -> DataFrame:
    """A row for each section of a test, one for a test without sections, and one without a section
    for a test that also has problems before its first section.

    ``tests``: series_id, test_id, name, year, computational, path, and ``key``, which names a test
    in all tables (test_id, or another column where a test occurs more than once). ``titles``: key,
    section_no, section. ``flat``: key of tests with problems outside sections. The columns key and
    section_no only serve to join problems.
    """
    have = titles.select(key).distinct().withColumn("has_sections", F.lit(True))
    loose = flat.select(key).distinct().withColumn("has_loose", F.lit(True))
    bare = tests.join(have, key, "left").join(loose, key, "left").where("has_sections IS NULL OR has_loose").drop("has_sections", "has_loose")
    rows = tests.join(titles, key).unionByName(bare.withColumn("section_no", F.lit(None).cast("int")).withColumn("section", F.lit(None).cast("string")))
    rows = dense_ids(rows, ["series_id", "path", F.col("section_no").asc_nulls_first()])
    return rows.select(
        "id", F.col("series_id").alias("series"), F.concat_ws(" + ", "name", "section").alias("name"), "year", F.array().cast("array<string>").alias("links"),
        F.lit(0).alias("quality"), F.lit(0).alias("difficulty"), F.col("test_id").alias("aops_id"), F.col("computational").alias("is_computational"), F.col(key).alias("key"), "section_no",
    )


def problems_table(rows: DataFrame, tests: DataFrame, key: str = "test_id") -> DataFrame:
    """The problems of ``answers.answer`` with ids, joined to ``tests_table`` by test and section."""
    keys = tests.select(F.col("id").alias("test_key"), "key", "section_no", "is_computational")
    joined = rows.withColumnRenamed(key, "row_key").alias("r").join(keys.alias("k"), (F.col("r.row_key") == F.col("k.key")) & F.col("r.section_no").eqNullSafe(F.col("k.section_no")))
    joined = joined.select("k.test_key", "r.pos", "r.j", "r.statement", "r.n", "r.answer_index", "r.answers", "r.topic_id", "k.is_computational")
    out = numbered_within(joined, keys.select("test_key"), "test_key", ["pos", "j"])
    return out.select(
        "id", F.col("test_key").alias("test_id"), "statement", "n", "answer_index", "answers", F.lit(0).alias("difficulty"), F.lit(0).alias("quality"),
        F.lit(False).alias("verified"), F.col("topic_id").alias("aops_id"), F.lit("O").alias("topic"), F.coalesce("is_computational", F.lit(False)).alias("is_computational"),
    )


def from_nested(series: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Series, tests and problems of an array of nested series (see schemas.NESTED_SERIES).

    The k-th array among a test's problems belongs to its k-th section; problems outside arrays
    to the section that they name or, without sections, to the test. A test that occurs twice,
    in one series or in two, is two tests. An answer that is null in the source is -1 and one that
    the source has not is null.
    """
    stored = cut(series.withColumn("at", F.monotonically_increasing_id()), "series")
    top = series_table(stored.select("at", "name"), ["at"])
    each = stored.select("at", F.posexplode("tests").alias("p", "t")).withColumn("key", F.struct("at", "p"))
    tests = each.select("at", F.array("p").alias("path"), "key", F.col("t.id").alias("test_id"), "t.name", "t.year", "t.computational", F.coalesce("t.sections", F.array()).alias("sections"))
    tests = tests.join(top.select(F.col("id").alias("series_id"), "at"), "at").drop("at")
    titles = tests.select("key", F.posexplode("sections").alias("section_no", "section"))
    numbered = F.transform(F.from_json("t.problems", "array<string>"), lambda e, i: F.struct(i.alias("pos"), e.alias("entry")))
    entries = each.select("key", F.coalesce(F.size("t.sections"), F.lit(0)).alias("n_sections"), numbered.alias("entries"))
    listed = lambda x: F.coalesce(x["entry"].startswith("["), F.lit(False))
    arrays = entries.select("key", "n_sections", F.posexplode(F.filter("entries", listed)).alias("section", "x")).select("key", "n_sections", "section", "x.pos", F.posexplode(F.from_json("x.entry", "array<string>")).alias("j", "text"))
    single = entries.select("key", "n_sections", F.explode(F.filter("entries", lambda x: ~listed(x))).alias("x")).select("key", "n_sections", F.lit(None).cast("int").alias("section"), "x.pos", F.lit(0).alias("j"), F.col("x.entry").alias("text"))
    rows = arrays.unionByName(single).withColumn("q", F.from_json("text", schemas.PROBLEM))
    section = F.coalesce("section", "q.section")
    rows = rows.select(
        "key", F.when((section >= 0) & (section < F.col("n_sections")), section).alias("section_no"), "pos", "j", "q.statement", "q.n",
        F.when(F.col("q.answer").isNull() & F.coalesce(F.array_contains(F.json_object_keys("text"), "answer"), F.lit(False)), -1).otherwise(F.col("q.answer")).alias("answer_index"),
        F.coalesce("q.choices", F.array().cast("array<string>")).alias("answers"), "q.topic_id",
    )
    table = tests_table(tests.drop("sections"), titles, rows.where("section_no IS NULL"), "key")
    return top.select("id", "name", "is_official"), table, problems_table(rows, table, "key")
