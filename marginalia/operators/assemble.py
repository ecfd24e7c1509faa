"""From the items of a test to its problems.

Windows over a test's items find headers, sections and type changes; what depends on itself (the
running number and whether posts are lists) is one ordered fold for each section.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lists import drop_postscript, link_drawings, split_list
from ..functions.text import SPACE, clean_choices, clean_problem, extract_choices, strip_space
from ..sources.registry import NOTICE_POST, REMARK_POSTER

# Patterns of headers.
SAME_AS = r"\Asame as ([a-zA-Z]+ ){1,3}(\d+)\z"
DAY = rf"\A[dD]ay{SPACE}\d+\z"


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def flag_items(items: DataFrame) -> DataFrame:
    """Adds is_header, opens, bumps, is_problem, section_no and type_now.

    ``items``: test_id, pos, item_type, item_text, post (see schemas), type_key, computational (of
    the test's type). In tests of an olympiad type headers are not looked for. Of a run of
    headers only the last one opens a section; ``same as X n`` advances the number by one; ``Day n``
    makes the type AMO from there on; ``Mixer Round`` opens nothing.
    """
    order = Window.partitionBy("test_id").orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    text = F.col("post.post_canonical")
    headers = ~F.col("computational").eqNullSafe(False)
    rows = items.withColumn("described", _true(F.col("post.post_type") == "view_posts_text") | _true(F.col("post.topic_id") == 0))
    rows = rows.withColumn("followed", _true(F.lead("described").over(order)))
    rows = rows.withColumn("is_header", headers & F.col("described"))
    rows = rows.withColumn("bumps", F.col("is_header") & _true(text.rlike(SAME_AS)))
    lone = F.col("is_header") & ~F.col("followed") & ~F.col("bumps")
    rows = rows.withColumn("day", F.max(lone & _true(text.rlike(DAY))).over(so_far))
    rows = rows.withColumn("opens", lone & ~_true(strip_space(text) == "Mixer Round"))
    kept = _true(F.col("post.post_type") == "forum") & ~F.col("item_type").eqNullSafe("post_hidden") & ~F.col("post.post_id").eqNullSafe(NOTICE_POST) & ~F.col("item_text").eqNullSafe("Mixer")
    rows = rows.withColumn("is_problem", ~F.col("is_header") & kept)
    rows = rows.withColumn("section_no", F.sum(F.col("opens").cast("int")).over(so_far) - 1)
    return rows.withColumn("type_now", F.when(F.col("day"), F.lit("AMO")).otherwise(F.col("type_key"))).drop("described", "followed", "day")


def sections(flagged: DataFrame) -> DataFrame:
    """test_id, section_no, section: the title of every section."""
    return flagged.where("opens").select("test_id", F.col("section_no").cast("int").alias("section_no"), strip_space(F.col("post.post_canonical")).alias("section"))


def number(events: Column) -> Column:
    """Folds the ordered events (bump, text) of a section: for each problem the number before it
    and its list items, [] for a single problem. A post may be a list as the first one or once a
    list came before."""
    start = F.struct(F.lit(0).alias("n"), F.lit(False).alias("lists"), F.array().cast("array<struct<at:int,n:int,items:array<string>>>").alias("out"))

    def step(acc: Column, e: Column) -> Column:
        items = F.when((acc["n"] == 0) | acc["lists"], split_list(e["text"], acc["n"] + 1)).otherwise(F.array().cast("array<string>"))
        # bound to a name once: the fold over one element stands for a let
        def put(inner: Column, found: Column) -> Column:
            many = F.size(found) > 1
            entry = F.struct(e["pos"].alias("at"), inner["n"].alias("n"), F.when(many, found).otherwise(F.array().cast("array<string>")).alias("items"))
            return F.struct((inner["n"] + F.when(many, F.size(found)).otherwise(1)).alias("n"), (inner["lists"] | many).alias("lists"), F.array_append(inner["out"], entry).alias("out"))

        bumped = F.struct((acc["n"] + 1).alias("n"), acc["lists"].alias("lists"), acc["out"].alias("out"))
        return F.when(e["bump"], bumped).otherwise(F.aggregate(F.array(items), acc, put))

    return F.aggregate(events, start, step, lambda acc: acc["out"])


def problems(flagged: DataFrame, types: DataFrame) -> DataFrame:
    """test_id, section_no, pos, j, is_list, n, statement, choices, post_id, topic_id, type_now,
    computational, has_choices: one row for each problem, before answers.

    Statements of list items lose their choices for types with choices; single ones are cleaned,
    and split from their choices where the type has any.
    """
    events = flagged.where("is_problem OR bumps").select(
        "test_id", "section_no", "pos", "bumps", "type_now", F.col("post.post_id").alias("post_id"), F.col("post.topic_id").alias("topic_id"), F.col("post.poster_id").alias("poster_id"),
        link_drawings(F.col("post.post_canonical"), F.col("post.post_rendered")).alias("text"),
    )
    packed = F.array_sort(F.collect_list(F.struct("pos", F.col("bumps").alias("bump"), F.coalesce("text", F.lit("")).alias("text"), "type_now", "post_id", "topic_id", "poster_id")))
    folded = events.groupBy("test_id", "section_no").agg(packed.alias("events")).withColumn("out", number(F.col("events")))
    rows = folded.select("test_id", "section_no", F.explode(F.arrays_zip(F.filter("events", lambda e: ~e["bump"]).alias("e"), F.col("out").alias("o"))).alias("x"))
    rows = rows.select("test_id", "section_no", "x.e.*", F.col("x.o.n").alias("n"), F.col("x.o.items").alias("items")).drop("bump")
    is_list = F.size("items") > 0
    items = F.when(F.col("poster_id").eqNullSafe(REMARK_POSTER), drop_postscript(F.col("items"))).otherwise(F.col("items"))
    rows = rows.withColumn("is_list", is_list).select("*", F.posexplode(F.when(is_list, items).otherwise(F.array(clean_problem(F.col("text"))))).alias("j", "raw"))
    kinds = types.select(F.col("key").alias("type_now"), "computational", F.coalesce("choices", F.lit(False)).alias("has_choices"))
    rows = rows.join(F.broadcast(kinds), "type_now", "left")
    return rows.select(
        "test_id", F.col("section_no").cast("int").alias("section_no"), "pos", "j", "is_list",
        F.when(~F.col("is_list"), F.col("n")).alias("n"),
        F.when(F.col("has_choices") & (F.col("is_list") | F.col("computational")), clean_choices(F.col("raw"))).otherwise(F.col("raw")).alias("statement"),
        F.when(F.col("has_choices"), extract_choices(F.col("raw"))).alias("choices"),
        "post_id", "topic_id", "type_now", "computational", "has_choices",
    )


def collapse(rows: DataFrame, titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Problems and sections after a lone section is dissolved: a test's only one, or two of which
    the second holds one problem."""
    per = titles.groupBy("test_id").agg(F.count(F.lit(1)).alias("n_sections"))
    second = rows.where("section_no = 1").groupBy("test_id").agg(F.count(F.lit(1)).alias("n_second"))
    lone = per.join(second, "test_id", "left").where("n_sections = 1 OR (n_sections = 2 AND coalesce(n_second, 0) = 1)").select("test_id", F.lit(True).alias("lone"))
    kept = titles.join(lone, "test_id", "left_anti")
    moved = rows.join(lone, "test_id", "left").withColumn("section_no", F.when(F.col("lone").isNull() & (F.col("section_no") >= 0), F.col("section_no"))).drop("lone")
    return moved, kept
