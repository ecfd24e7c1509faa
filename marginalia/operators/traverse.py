"""The category tree: folders level by level, then all leaves at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import infer_type
from ..scratch import cut, drop
from ..sources import registry


def walk(items: DataFrame, categories: DataFrame, root: int, shown_depth: int = 0, ignore: DataFrame | None = None) -> DataFrame:
    """Folders and tests under ``root`` in depth-first order.

    Columns: item_id, item_type, name, path (places from the root, which order the walk), type_key
    (of the first ancestor or self whose name tells a type, for folders), group_path (names of the
    folders that stay nested, by ``shown_depth``). Forums and posts are no nodes, ignored ids
    neither; of several visits the first in path order stays; a folder that lies within itself is
    not entered again.

    Only folders are walked. A folder keeps its first path and is entered again only if a later
    level finds an earlier one; a path through itself is never earlier, so cycles end. Each level
    is a table in the shared folder. Leaves meet their folder in one join at the end.
    """
    spark = items.sparkSession
    ignore = registry.ignored(spark) if ignore is None else ignore
    nodes = items.where(F.col("item_type").isin("folder", "view_posts")).join(ignore, "item_id", "left_anti")
    named = categories.select(F.col("category_id").alias("item_id"), "category_name")
    edges = nodes.join(named, "item_id", "left").select("category_id", "pos", "item_id", "item_type", F.coalesce("category_name", "item_text").alias("name"))
    edges = edges.withColumn("own_type", infer_type(F.col("name")))
    folders = cut(edges.where("item_type = 'folder'").select("category_id", "pos", "item_id", "name", "own_type"), "folders")
    top = categories.where(F.col("category_id") == root).select("category_id", F.array().cast("array<int>"), infer_type(F.col("category_name")), F.array().cast("array<string>"))
    best = cut(top.toDF("item_id", "path", "type_key", "names"), "paths")
    frontier = best
    while True:
        below = frontier.select(F.col("item_id").alias("category_id"), "path", "type_key", "names").join(folders, "category_id")
        step = F.struct(F.array_append("path", F.col("pos")).alias("path"), F.coalesce("type_key", "own_type").alias("type_key"), F.array_append("names", F.col("name")).alias("names"))
        found = below.select("item_id", step.alias("x")).groupBy("item_id").agg(F.min("x").alias("x")).select("item_id", "x.*")
        known = best.select("item_id", F.col("path").alias("known"))
        last = frontier
        frontier = cut(found.join(known, "item_id", "left").where("known IS NULL OR path < known").drop("known"), "frontier")
        if frontier.isEmpty():
            break
        merged = cut(best.join(frontier.select("item_id"), "item_id", "left_anti").unionByName(frontier), "paths")
        drop(best, *([last] if last is not best else []))
        best = merged
    drop(folders, frontier)
    up = best.select(F.col("item_id").alias("category_id"), "path", F.col("type_key").alias("up"), "names")
    leaf = F.struct(F.array_append("path", F.col("pos")).alias("path"), "name", F.coalesce("own_type", "up", F.lit("UNKNOWN")).alias("type_key"), "names")
    leaves = edges.where("item_type = 'view_posts'").join(up, "category_id").groupBy("item_id").agg(F.min(leaf).alias("x")).select("item_id", F.lit("view_posts").alias("item_type"), "x.*")
    inner = best.where(F.size("path") > 0).select("item_id", F.lit("folder").alias("item_type"), "path", F.element_at("names", -1).alias("name"), "type_key", "names")
    both = inner.unionByName(leaves)
    return both.select("item_id", "item_type", "name", "path", "type_key", F.slice("names", 1, max(shown_depth, 0)).alias("group_path"))


def counts(nodes: DataFrame, per_test: DataFrame) -> DataFrame:
    """Problems of each folder, from (item_id, n) of tests: a sum over every prefix of a path."""
    tests = nodes.where("item_type = 'view_posts'").join(per_test, "item_id").select("n", F.explode(F.transform(F.sequence(F.lit(0), F.size("path") - 1), lambda k: F.slice("path", 1, k))).alias("prefix"))
    return tests.groupBy("prefix").agg(F.sum("n").alias("n"))
