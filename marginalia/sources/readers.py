"""Raw records from JSON: pages of categories, topics and forums.

The transport is in ``transport``; here pages lie as JSON files (one response each line) in any folder
that Spark reads, and page numbers replace the cursor of a live scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.normalize import dense_ids
from . import schemas


def category_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CATEGORY_PAGE).json(path)


def raw_categories(pages: DataFrame) -> DataFrame:
    return pages.where("response.category IS NOT NULL").select("category_id", F.col("response.category.category_name").alias("category_name"))


def raw_items(pages: DataFrame) -> DataFrame:
    """All items of all pages, with their place in the whole category from 0. An item's place
    needs the lengths of the pages before it only, so items themselves are not shuffled twice."""
    items = F.coalesce("response.category.items", "response.new_items", F.array())
    before = Window.partitionBy("category_id").orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = pages.withColumn("items", items).withColumn("skip", F.coalesce(F.sum(F.size("items")).over(before), F.lit(0)))
    rows = placed.select("category_id", "skip", F.posexplode("items").alias("at", "item"))
    return rows.select("category_id", (F.col("skip") + F.col("at")).cast("int").alias("pos"), "item.item_id", "item.item_type", "item.item_text", F.col("item.post_data").alias("post"))


def topic_posts(spark: SparkSession, path: str) -> DataFrame:
    """Posts of topics in order; a refused topic is one row with its error code."""
    return posts(spark.read.schema(schemas.TOPIC_PAGE).json(path))


def posts(pages: DataFrame) -> DataFrame:
    rows = pages.select("topic_id", "error_code", F.posexplode_outer("response.topic.posts_data").alias("pos", "p"))
    return rows.select("topic_id", F.coalesce("pos", F.lit(0)).alias("pos"), "p.post_canonical", "error_code")


def forum_topics(spark: SparkSession, path: str) -> DataFrame:
    """The topics of all pages up to the one that says there are no more."""
    return topics(spark.read.schema(schemas.FORUM_PAGE).json(path))


def topics(pages: DataFrame) -> DataFrame:
    """category_id of the forum, page_no and the topics of each page."""
    return pages.where(~F.coalesce("no_more_topics", F.lit(False))).select("category_id", "page_no", F.explode("response.topics").alias("t")).select("category_id", "page_no", "t.*")


def keyset_scan(rows: DataFrame, cursor: str, size: int) -> DataFrame:
    """All rows with their page_no when pages of ``size`` are read by falling cursor. Only a page's
    number depends on the rows before, so this is a ranking by range and no loop."""
    return dense_ids(rows, [F.desc(cursor)], "rank").withColumn("page_no", F.floor(F.col("rank") / size)).drop("rank")


def nested_series(spark: SparkSession, path: str) -> DataFrame:
    """A whole JSON document: an array of series."""
    return spark.read.schema(schemas.NESTED_SERIES).option("multiLine", True).json(path)


def keyset_page(rows: DataFrame, cursor: str, before: int | None, size: int) -> DataFrame:
    """A page of a keyset scan: the ``size`` rows with the largest cursors under ``before``."""
    rows = rows if before is None else rows.where(F.col(cursor) < before)
    return rows.orderBy(F.desc(cursor)).limit(size)


# Parameters of each request.
REQUESTS = {
    "topic": {"a": "fetch_topic"},
    "category": {"a": "fetch_category_data"},
    "items": {"sought_category_ids": "[]", "seek_items": "1", "log_visit": "0", "a": "fetch_items_categories"},
    "forum": {"a": "fetch_topics", "category_type": "forum"},
}
# The parameter that holds the id.
ID_FIELD = {"topic": "topic_id", "category": "category_id", "items": "parent_category_id", "forum": "category_id"}


def payload(kind: str, ident: Column, start: Column | None = None) -> Column:
    """map<string,array<string>> of a request for each row; an unknown kind raises KeyError."""
    fixed = REQUESTS[kind]
    pairs = [(F.lit(k), F.array(F.lit(v))) for k, v in fixed.items()] + [(F.lit(ID_FIELD[kind]), F.array(ident.cast("string")))]
    if kind == "items":
        pairs.append((F.lit("start_num"), F.array((start if start is not None else F.lit(0)).cast("string"))))
    return F.create_map(*[x for pair in pairs for x in pair])


def form_encode(params: Column) -> Column:
    """A map of arrays as an URL-encoded form; keys repeat for each value of their array."""
    pairs = F.flatten(F.transform(F.map_entries(params), lambda e: F.transform(e["value"], lambda v: F.concat(F.url_encode(e["key"]), F.lit("="), F.url_encode(v)))))
    return F.array_join(pairs, "&")
