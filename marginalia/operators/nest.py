"""The nested result of a walk: series, folders and tests as one JSON document for each series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import cut


def _json(**fields: Column) -> Column:
    """A JSON object of values that are JSON already."""
    parts = [F.concat(F.lit(f'"{k}":'), v) for k, v in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _quoted(c: Column) -> Column:
    """A text as JSON, null as null."""
    return F.when(c.isNull(), F.lit("null")).otherwise(F.regexp_extract(F.to_json(F.array(c)), r"(?s)\A\[(.*)\]\z", 1))


def tests_json(tests: DataFrame, titles: DataFrame, problems: DataFrame) -> DataFrame:
    """test_id, count and json of each test.

    ``tests``: test_id, name, year, computational, type. ``titles``: test_id, section_no, section.
    ``problems``: test_id, section_no, pos, j and the columns that make up a problem. Problems of a
    section are an array of their own, those outside come first; a test without problems has an
    empty array. A test is one row and must fit a task.
    """
    fields = [c for c in problems.columns if c not in ("test_id", "section_no", "pos", "j")]
    one = F.to_json(F.struct(*fields, F.col("section_no").alias("section")))
    rows = problems.select("test_id", "section_no", "pos", "j", one.alias("json"))
    gathered = lambda by: rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("pos", "j", "json"))).alias("x"), F.count(F.lit(1)).alias("n"))
    joined = lambda c: F.array_join(F.transform(c, lambda x: x["json"]), ",")
    within = gathered(["test_id", "section_no"]).select("test_id", "section_no", joined(F.col("x")).alias("text"), "n")
    loose = within.where("section_no IS NULL").select("test_id", F.col("text").alias("loose"), F.col("n").alias("n_loose"))
    own = titles.join(within.where("section_no IS NOT NULL"), ["test_id", "section_no"], "left")
    own = own.groupBy("test_id").agg(
        F.array_sort(F.collect_list(F.struct("section_no", F.coalesce("section", F.lit("")).alias("section"), F.coalesce("text", F.lit("")).alias("text")))).alias("s"), F.sum(F.coalesce("n", F.lit(0))).alias("n_own")
    )
    all_ = tests.join(own, "test_id", "left").join(loose, "test_id", "left")
    lists = F.transform(F.coalesce("s", F.array().cast("array<struct<section_no:int,section:string,text:string>>")), lambda x: F.concat(F.lit("["), x["text"], F.lit("]")))
    inside = F.array_join(F.concat(F.when(F.col("loose").isNotNull(), F.array("loose")).otherwise(F.array().cast("array<string>")), lists), ",")
    count = F.coalesce("n_own", F.lit(0)) + F.coalesce("n_loose", F.lit(0))
    sections = F.concat(F.lit("["), F.array_join(F.transform(F.coalesce("s", F.array().cast("array<struct<section_no:int,section:string,text:string>>")), lambda x: _quoted(x["section"])), ","), F.lit("]"))
    json = _json(
        sections=sections, problems=F.concat(F.lit("["), inside, F.lit("]")), id=F.col("test_id").cast("string"), name=_quoted(F.col("name")), year=_quoted(F.col("year")),
        computational=F.coalesce(F.col("computational").cast("string"), F.lit("null")), type=_quoted(F.col("type")), count=count.cast("string"),
    )
    return all_.select("test_id", count.cast("long").alias("count"), json.alias("json"))


def nested_result(nodes: DataFrame, tests: DataFrame, name: str, shown_depth: int) -> DataFrame:
    """One row (json, count): the root with its folders down to ``shown_depth`` nested, deeper
    tests flat in the deepest folder that is shown, all in the order of the walk.

    ``nodes`` come from ``traverse.walk``, ``tests`` from ``tests_json``. Folders without tests stay.
    The document is one row; series of any number are written as one row each.

    The document is cut into pieces: a test, the opening of a folder, its end. They are joined by
    ranges of their place, and the ranges once more: no folder's text is built for itself, so the
    last task holds the ranges, the document and the row, which leaves by a shuffle of its own.
    """
    spark, depth = nodes.sparkSession, max(shown_depth, 0)
    place = F.col("path").cast("array<bigint>").alias("path")
    leaves = nodes.where("item_type = 'view_posts'").select(F.col("item_id").alias("test_id"), place)
    placed = cut(leaves.join(tests, "test_id").select("path", "json", "count"), "placed")
    folders = nodes.where("item_type = 'folder'").where(F.size("path") <= depth).select(place, "name")
    parent = F.slice("path", 1, F.least(F.size("path") - 1, F.lit(depth)))
    prefixes = F.transform(F.sequence(F.lit(0), F.size(parent)), lambda k: F.slice("path", 1, k))
    sums = placed.select("count", F.explode(prefixes).alias("path")).groupBy("path").agg(F.sum("count").alias("n"))
    sized = cut(folders.join(sums, "path", "left").select("path", "name", F.coalesce("n", F.lit(0)).alias("n")), "folders")
    firsts = placed.select("path").unionByName(sized.select("path")).groupBy(parent.alias("parent")).agg(F.min("path").alias("path")).select("path", F.lit("").alias("comma"))
    opening = lambda c: F.concat(F.lit('{"name":'), _quoted(c), F.lit(',"tests":['))
    ending = lambda n: F.concat(F.lit('],"count":'), n.cast("string"), F.lit("}"))
    begun = placed.unionByName(sized.select("path", opening(F.col("name")).alias("json"), F.lit(0).cast("long").alias("count")))
    begun = begun.join(firsts, "path", "left").select("path", F.concat(F.coalesce("comma", F.lit(",")), "json").alias("json"), "count")
    ended = sized.select(F.array_append("path", F.lit(1 << 31).cast("long")).alias("path"), ending(F.col("n")).alias("json"), F.lit(0).cast("long").alias("count"))
    ranges = begun.unionByName(ended).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "path").withColumn("range", F.spark_partition_id())
    in_order = F.array_sort(F.collect_list(F.struct("path", "json")))["json"]
    texts = ranges.groupBy("range").agg(F.min("path").alias("path"), F.concat_ws("", in_order).alias("json"), F.sum("count").alias("count"))
    count = F.coalesce(F.sum("count"), F.lit(0).cast("long"))
    return texts.agg(F.concat_ws("", opening(F.lit(name)), in_order, ending(count)).alias("json"), count.alias("count")).repartition(1)
