"""Forum topics to tests by ordered title rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import extract_year


@dataclass(frozen=True)
class Rule:
    """``pattern`` of a title, the group that holds the problem's number (0: no number), and the
    test's name, in which ``{year}`` is the category's year."""

    pattern: str
    group: int
    name: str


def parse_forum(topics: DataFrame, rules: list[Rule]) -> DataFrame:
    """topics with test_name and n by the first rule whose pattern is found; others are dropped."""
    title, year = F.col("topic_title"), F.coalesce(extract_year(F.col("category_name")), F.lit(""))
    name = n = None
    for r in rules:
        hit = title.rlike(r.pattern)
        label = F.trim(F.replace(F.lit(r.name), F.lit("{year}"), year))
        value = F.nullif(F.regexp_extract(title, r.pattern, r.group), F.lit("")) if r.group else F.lit(None).cast("string")
        name = F.when(hit, label) if name is None else name.when(hit, label)
        n = F.when(hit, value) if n is None else n.when(hit, value)
    return topics.withColumn("test_name", name).withColumn("n", n).where("test_name IS NOT NULL")


def group_tests(parsed: DataFrame) -> DataFrame:
    """test_name and its problems (n, topic_id) by number."""
    entry = F.struct(F.col("n").cast("int").alias("n"), "topic_id")
    return parsed.groupBy("test_name").agg(F.array_sort(F.collect_list(entry)).alias("problems"))
