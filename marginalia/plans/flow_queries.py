"""Queries of the tree walk, assembly, answers, normalisation and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import answers, assemble, forum_rules, normalize, traverse
from ..scratch import place
from ..sources import registry
from ..streaming import ingest
from . import sql
from .text_queries import _text, read

POST = ("post_type", "topic_id", "post_id", "poster_id", "post_canonical", "post_rendered")
LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


def _post(kind: Column, topic: Column, text: Column) -> Column:
    values = (kind, topic.cast("bigint"), topic.cast("bigint"), F.lit(1).cast("bigint"), text, F.lit(None).cast("string"))
    return F.struct(*[v.alias(n) for n, v in zip(POST, values)])


def _typed(rows: DataFrame, key: str, computational: bool | None) -> DataFrame:
    return rows.withColumns({"type_key": F.lit(key), "computational": F.lit(computational).cast("boolean")})


def _tree(spark: SparkSession, sf_dir: str, twice: bool = False) -> DataFrame:
    """Regions, nations and customers as a category tree under 0."""
    region, nation, customer = (read(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    title = F.when(F.col("r_regionkey") % 2 == 0, _text("HMMT ", F.col("r_name"))).otherwise(F.col("r_name"))
    node = lambda parent, pos, item, kind, name: [parent.cast("bigint").alias("category_id"), pos.cast("int").alias("pos"), item.cast("bigint").alias("item_id"), F.lit(kind).alias("item_type"), name.alias("item_text")]
    regions = region.select(*node(F.lit(0), F.col("r_regionkey"), F.col("r_regionkey") + 1000, "folder", title))
    nations = nation.select(*node(F.col("n_regionkey") + 1000, F.col("n_nationkey"), F.col("n_nationkey") + 2000, "folder", F.col("n_name")))
    leaf = lambda key: customer.select(*node(key + 2000, F.col("c_custkey"), F.col("c_custkey") + 100_000, "view_posts", F.col("c_name")))
    items = regions.unionByName(nations).unionByName(leaf(F.col("c_nationkey")))
    items = items.unionByName(leaf((F.col("c_nationkey") + 1) % 25)) if twice else items
    noise = region.select(*node(F.lit(0), F.col("r_regionkey") + 50, F.col("r_regionkey") + 1000, "forum", F.col("r_name")))
    items = items.unionByName(noise)
    names = items.where("item_type <> 'view_posts'").select(F.col("item_id").alias("category_id"), F.col("item_text").alias("category_name")).where("category_id >= 2000")
    root = spark.createDataFrame([(0, "All")], "category_id bigint, category_name string")
    return traverse.walk(items, names.unionByName(root), 0, shown_depth=1)


def _path(c: str = "path") -> Column:
    return F.array_join(F.col(c).cast("array<string>"), "/")


def category_tree(spark, sf_dir):
    return _tree(spark, sf_dir).select("item_id", "item_type", _path().alias("path"), "type_key", F.array_join("group_path", "/").alias("group_path"))


def tree_first_visit(spark, sf_dir):
    return _tree(spark, sf_dir, twice=True).where("item_type = 'view_posts'").select("item_id", _path().alias("path"))


def tree_counts(spark, sf_dir):
    nodes = _tree(spark, sf_dir)
    per = read(spark, sf_dir, "orders").groupBy((F.col("o_custkey") + 100_000).alias("item_id")).agg(F.count(F.lit(1)).alias("n"))
    return traverse.counts(nodes, per).where(F.size("prefix") < 3).select(_path("prefix").alias("path"), "n")


def ignore_anti(spark, sf_dir):
    ignored = registry.ignored(spark).unionByName(read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("item_id")))
    return read(spark, sf_dir, "customer").join(ignored, F.col("c_custkey") == F.col("item_id"), "left_anti").select("c_custkey", "c_name")


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as items of a test; returned lines as headers."""
    line = read(spark, sf_dir, "lineitem")
    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER.split(", ")))
    rows = line.withColumn("pos", pos)
    head = F.col("l_returnflag") == "N"
    post = _post(F.when(head, "view_posts_text").otherwise("forum"), F.when(head, 0).otherwise(F.col("l_partkey") + 1), _text("Round ", F.col("l_linestatus")))
    return rows.select(F.col("l_orderkey").alias("test_id"), "pos", F.lit("post").alias("item_type"), F.lit("x").alias("item_text"), post.alias("post"))


def header_sections(spark, sf_dir):
    flagged = assemble.flag_items(_typed(_line_items(spark, sf_dir), "HMMT", True))
    return flagged.select("test_id", "pos", "opens", "is_problem", F.col("section_no").cast("int").alias("section_no"))


def olympiad_items(spark, sf_dir):
    """In olympiad tests headers are not looked for."""
    flagged = assemble.flag_items(_typed(_line_items(spark, sf_dir), "AMO", False))
    return flagged.groupBy("test_id").agg(F.count_if("opens").alias("n_sections"), F.count_if("is_problem").alias("n_problems"))


def day_latch(spark, sf_dir):
    event = read(spark, sf_dir, "events")
    pos = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    head = F.col("event_type") == "signup"
    post = _post(F.when(head, "view_posts_text").otherwise("forum"), F.when(head, 0).otherwise(F.col("event_id")), F.when(head, "Day 1").otherwise("text"))
    items = event.withColumn("pos", pos).select(F.col("user_id").alias("test_id"), "pos", F.lit("post").alias("item_type"), F.lit("x").alias("item_text"), post.alias("post"))
    return assemble.flag_items(_typed(items, "HMMT", True)).select("test_id", "pos", "type_now")


def section_collapse(spark, sf_dir):
    rank = F.dense_rank().over(Window.partitionBy("l_orderkey").orderBy("l_returnflag")) - 1
    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER.split(", ")))
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("test_id"), pos.alias("pos"), rank.cast("int").alias("section_no"))
    titles = rows.select("test_id", "section_no").distinct().withColumn("section", _text("S", F.col("section_no")))
    moved, _ = assemble.collapse(rows, titles)
    return moved.select("test_id", "pos", "section_no")


def first_answer(spark, sf_dir):
    event = read(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "purchase", _text("so \\boxed{", F.col("event_id"), "}")).otherwise("text")
    pos = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    posts = event.select(F.col("user_id").alias("topic_id"), pos.alias("pos"), text.alias("post_canonical"), F.lit(None).cast("string").alias("error_code"))
    return answers.topic_answers(posts).select("topic_id", "boxed")


def permission_latch(spark, sf_dir):
    event = read(spark, sf_dir, "events")
    pos = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    rows = event.select(
        F.col("user_id").alias("test_id"), pos.alias("pos"), F.lit(0).alias("j"), F.lit(False).alias("is_list"), F.lit(True).alias("computational"),
        F.lit(False).alias("has_choices"), F.lit(None).cast("array<string>").alias("choices"), F.col("event_id").alias("topic_id"),
    )
    refused = F.col("event_type") == "error"
    posts = event.select(F.col("event_id").alias("topic_id"), F.lit(0).alias("pos"), F.when(~refused, _text("\\boxed{", F.col("event_id"), "}")).alias("post_canonical"), F.when(refused, "E_NO_PERMISSION").alias("error_code"))
    return answers.answer(rows, posts).select("test_id", "pos", "answer_index", F.element_at("answers", 1).alias("answer"))


def answer_key(spark, sf_dir):
    key = F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0")
    text = _text("1. ", key, "\n2. 110\n2. 999\n10. ", key)
    items = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("test_id"), F.lit(1).alias("pos"), F.when(F.col("o_orderstatus") == "F", "Answer Key").otherwise("other").alias("item_text"),
        _post(F.lit("forum"), F.col("o_orderkey"), text).alias("post"), F.lit("AIME").alias("type_now"),
    )
    return answers.answer_keys(items)


def _conversation_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as items of a test: system turns and turn 4 as headers, the others as posts, of which
    those in lower case of turns 0 and 5 are lists of two."""
    turn = read(spark, sf_dir, "conversations")
    head = (F.col("role") == "system") | (F.col("turn") == 4)
    listed = F.col("turn").isin(0, 5)
    text = F.when(head, _text(" Section ", F.col("turn"), "\n")).when(listed, _text("1. alpha ", F.col("conv_id"), "\n2. beta\n\n and ", F.col("turn"))).otherwise(F.col("text"))
    topic = F.when(head, 0).otherwise(F.col("conv_id") * 1000 + F.col("turn") + 1)
    items = turn.select(F.col("conv_id").alias("test_id"), F.col("turn").cast("int").alias("pos"), F.lit("post").alias("item_type"), F.lit("x").alias("item_text"), _post(F.when(head, "view_posts_text").otherwise("forum"), topic, text).alias("post"))
    return _typed(items, "HMMT", True)


def assemble_problems(spark, sf_dir):
    """Posts to numbered problems with sections and answers."""
    flagged = assemble.flag_items(_conversation_items(spark, sf_dir))
    rows, _ = assemble.collapse(assemble.problems(flagged, registry.types(spark)), assemble.sections(flagged))
    turn = read(spark, sf_dir, "conversations").where("role = 'assistant'")
    posts = turn.select((F.col("conv_id") * 1000 + F.col("turn") + 1).alias("topic_id"), F.lit(0).alias("pos"), _text("\\boxed{", F.col("turn"), "}").alias("post_canonical"), F.lit(None).cast("string").alias("error_code"))
    return answers.answer(rows, posts).select("test_id", "section_no", "pos", "j", "n", "statement", "answer_index", F.get("answers", F.lit(0)).alias("answer"))


def _normal(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    region, nation, customer = (read(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    series = normalize.series_table(region.select("r_regionkey", F.col("r_name").alias("name")), ["r_regionkey"])
    home = series.select(F.col("id").alias("series_id"), F.col("r_regionkey").alias("n_regionkey"))
    tests = nation.join(home, "n_regionkey").select("series_id", F.col("n_nationkey").cast("bigint").alias("test_id"), F.col("n_name").alias("name"), F.lit("2021").alias("year"), F.lit(True).alias("computational"), F.array("n_nationkey").alias("path"))
    titles = tests.where("test_id % 2 = 0").select("test_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("section_no")).withColumn("section", _text("Round ", F.col("section_no")))
    rows = customer.select(
        F.col("c_nationkey").cast("bigint").alias("test_id"), F.when(F.col("c_nationkey") % 2 == 0, F.when(F.col("c_custkey") % 3 < 2, F.col("c_custkey") % 3)).cast("int").alias("section_no"),
        F.col("c_custkey").alias("pos"), F.lit(0).alias("j"), F.col("c_name").alias("statement"), F.lit(1).alias("n"), F.lit(-1).alias("answer_index"),
        F.array().cast("array<string>").alias("answers"), F.col("c_custkey").alias("topic_id"),
    )
    table = normalize.tests_table(tests, titles, rows.where("section_no IS NULL"))
    return series.select("id", "name", "is_official"), table, normalize.problems_table(rows, table)


def norm_series(spark, sf_dir):
    return _normal(spark, sf_dir)[0]


def norm_tests(spark, sf_dir):
    return _normal(spark, sf_dir)[1].select("id", "series", "name", "year", "aops_id", "is_computational")


def norm_problems(spark, sf_dir):
    return _normal(spark, sf_dir)[2].select("id", "test_id", "statement", "answer_index", "aops_id", "topic", "is_computational")


RULES = [forum_rules.Rule(r"\(ZeMC \d+ P(\d+)\)\z", 1, "{year} ZeMC 10"), forum_rules.Rule(r"\A\(ZIME P(\d+)\)\z", 1, "{year} ZIME")]


def _topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    title = F.when(k == 0, _text("(ZeMC ", F.col("p_size"), " P", F.col("p_partkey"), ")")).when(k == 1, _text("(ZIME P", F.col("p_partkey"), ")")).otherwise(F.col("p_name"))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("topic_id"), title.alias("topic_title"), _text("Mocks of ", 2000 + F.col("p_size")).alias("category_name"))


def forum_rules_parse(spark, sf_dir):
    return forum_rules.parse_forum(_topics(spark, sf_dir), RULES).select("topic_id", "test_name", "n")


def forum_groups(spark, sf_dir):
    grouped = forum_rules.group_tests(forum_rules.parse_forum(_topics(spark, sf_dir), RULES))
    return grouped.select("test_name", F.size("problems").alias("n_problems"), F.col("problems")[0]["topic_id"].alias("first_topic"))


def stream_dedup(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    rows = ingest.stream_files(spark, f"{sf_dir}/events.parquet*", events.select("user_id", "event_type").schema.simpleString()[7:-1].replace(":", " "), "parquet")
    seen = place(spark, "seen")
    ingest.run_once(ingest.first_seen(rows, ["user_id", "event_type"]), seen, f"{seen}-state")
    return spark.read.schema(rows.schema).parquet(seen)


QUERIES = {
    "category_tree": category_tree,
    "tree_first_visit": tree_first_visit,
    "tree_counts": tree_counts,
    "ignore_anti": ignore_anti,
    "header_sections": header_sections,
    "olympiad_items": olympiad_items,
    "day_latch": day_latch,
    "section_collapse": section_collapse,
    "first_answer": first_answer,
    "permission_latch": permission_latch,
    "answer_key": answer_key,
    "assemble_problems": assemble_problems,
    "norm_series": norm_series,
    "norm_tests": norm_tests,
    "norm_problems": norm_problems,
    "forum_rules": forum_rules_parse,
    "forum_groups": forum_groups,
    "stream_dedup": stream_dedup,
}

_EDGES = f"""
r AS (SELECT r_regionkey AS k, CASE WHEN r_regionkey % 2 = 0 THEN 'HMMT ' || r_name ELSE r_name END AS name FROM region),
r2 AS (SELECT *, {sql.infer('name')} AS ty FROM r),
n2 AS (SELECT n_nationkey AS k, n_regionkey AS up, n_name AS name, {sql.infer('n_name')} AS ty FROM nation),
f AS (SELECT n2.k, n2.up, n2.name, r2.name AS top, coalesce(r2.ty, n2.ty) AS ty FROM n2 JOIN r2 ON n2.up = r2.k)"""
_LINES = f"SELECT l_orderkey AS test_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS pos, l_returnflag = 'N' AS head, l_returnflag FROM lineitem"
_EVENTS = "SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id))::INTEGER AS pos FROM events"
_NORMAL = """
t AS (SELECT n_nationkey AS test_id, n_regionkey AS series, n_name AS name FROM nation),
p AS (SELECT c_nationkey AS test_id, CASE WHEN c_nationkey % 2 = 0 AND c_custkey % 3 < 2 THEN c_custkey % 3 END AS s, c_custkey, c_name FROM customer),
x AS (SELECT t.*, s, name || ' + Round ' || s AS full_name FROM t, (VALUES (0), (1)) AS v(s) WHERE test_id % 2 = 0
      UNION ALL SELECT t.*, NULL, name FROM t WHERE test_id % 2 = 1 OR test_id IN (SELECT test_id FROM p WHERE s IS NULL)),
y AS (SELECT *, row_number() OVER (ORDER BY series, test_id, s NULLS FIRST) - 1 AS id FROM x)"""

ORACLE_SQL = {
    "category_tree": f"""WITH {_EDGES}
      SELECT (1000 + k)::BIGINT AS item_id, 'folder' AS item_type, k::VARCHAR AS path, ty AS type_key, name AS group_path FROM r2
      UNION ALL SELECT 2000 + k, 'folder', up || '/' || k, ty, top FROM f
      UNION ALL SELECT 100000 + c_custkey, 'view_posts', up || '/' || k || '/' || c_custkey, coalesce({sql.infer('c_name')}, ty, 'UNKNOWN'), top
      FROM customer JOIN f ON c_nationkey = f.k""",
    "tree_first_visit": f"""WITH {_EDGES},
      e AS (SELECT c_custkey, c_nationkey AS k FROM customer UNION ALL SELECT c_custkey, (c_nationkey + 1) % 25 FROM customer),
      v AS (SELECT c_custkey, f.up || '/' || f.k || '/' || c_custkey AS path, row_number() OVER (PARTITION BY c_custkey ORDER BY f.up, f.k) AS visit FROM e JOIN f ON e.k = f.k)
      SELECT (100000 + c_custkey)::BIGINT AS item_id, path FROM v WHERE visit = 1""",
    "tree_counts": f"""WITH {_EDGES}
      SELECT path, count(*) AS n FROM (SELECT unnest([up::VARCHAR, up || '/' || k]) AS path FROM orders JOIN customer ON o_custkey = c_custkey JOIN f ON c_nationkey = f.k) GROUP BY path
      UNION ALL SELECT '', count(*) FROM orders JOIN customer ON o_custkey = c_custkey""",
    "ignore_anti": "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_custkey)",
    "header_sections": f"""WITH l AS ({_LINES}),
      o AS (SELECT *, head AND NOT coalesce(lead(head) OVER (PARTITION BY test_id ORDER BY pos), false) AS opens FROM l)
      SELECT test_id, pos::INTEGER AS pos, opens, NOT head AS is_problem, (sum(opens::INTEGER) OVER (PARTITION BY test_id ORDER BY pos) - 1)::INTEGER AS section_no FROM o""",
    "olympiad_items": f"WITH l AS ({_LINES}) SELECT test_id, 0::BIGINT AS n_sections, count(*) FILTER (NOT head) AS n_problems FROM l GROUP BY test_id",
    "day_latch": f"""WITH e AS ({_EVENTS}),
      o AS (SELECT *, event_type = 'signup' AND NOT coalesce(lead(event_type = 'signup') OVER (PARTITION BY user_id ORDER BY pos), false) AS lone FROM e)
      SELECT user_id AS test_id, pos, CASE WHEN bool_or(lone) OVER (PARTITION BY user_id ORDER BY pos) THEN 'AMO' ELSE 'HMMT' END AS type_now FROM o""",
    "section_collapse": f"""WITH l AS (SELECT test_id, pos, dense_rank() OVER (PARTITION BY test_id ORDER BY l_returnflag) - 1 AS s FROM ({_LINES})),
      c AS (SELECT test_id, count(DISTINCT s) AS k, count(*) FILTER (s = 1) AS k1 FROM l GROUP BY test_id)
      SELECT l.test_id, pos::INTEGER AS pos, (CASE WHEN k = 1 OR k = 2 AND k1 = 1 THEN NULL ELSE s END)::INTEGER AS section_no FROM l JOIN c USING (test_id)""",
    "first_answer": f"WITH e AS ({_EVENTS}) SELECT user_id AS topic_id, (arg_min(event_id, pos) FILTER (event_type = 'purchase'))::VARCHAR AS boxed FROM e GROUP BY user_id",
    "permission_latch": f"""WITH e AS ({_EVENTS}) SELECT user_id AS test_id, pos, 0 AS answer_index,
      CASE WHEN NOT bool_or(event_type = 'error') OVER (PARTITION BY user_id ORDER BY pos) THEN event_id::VARCHAR END AS answer FROM e""",
    "answer_key": """SELECT o_orderkey AS test_id, v.n AS number, CASE v.n WHEN 2 THEN '110' ELSE lpad((o_orderkey % 1000)::VARCHAR, 3, '0') END AS key
      FROM orders, (VALUES (1), (2), (10)) AS v(n) WHERE o_orderstatus = 'F'""",
    "assemble_problems": f"""WITH i AS (
      SELECT conv_id, turn, role, text, role = 'system' OR turn = 4 AS head FROM conversations),
      o AS (SELECT *, head AND NOT coalesce(lead(head) OVER (PARTITION BY conv_id ORDER BY turn), false) AS opens FROM i),
      s AS (SELECT *, sum(opens::INTEGER) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS sec FROM o),
      q AS (SELECT *, turn IN (0, 5) AS listed, row_number() OVER (PARTITION BY conv_id, sec ORDER BY turn) AS rn,
              first_value(turn IN (0, 5)) OVER (PARTITION BY conv_id, sec ORDER BY turn) AS lists FROM s WHERE NOT head),
      m AS (SELECT *, listed AND rn = 1 AS many, CASE WHEN lists THEN rn ELSE rn - 1 END AS n FROM q),
      rows AS (
        SELECT conv_id, sec, turn, j, NULL::INTEGER AS n, CASE j WHEN 0 THEN 'alpha ' || conv_id ELSE 'beta' || chr(10) || 'and ' || turn END AS statement, NULL::INTEGER AS ai, NULL AS answer
        FROM m, (VALUES (0), (1)) AS v(j) WHERE many
        UNION ALL SELECT conv_id, sec, turn, 0, n::INTEGER, {sql.stripped("CASE WHEN listed THEN '1. alpha ' || conv_id || chr(10) || '2. beta' || chr(10) || chr(10) || ' and ' || turn ELSE text END")}, 0,
          CASE WHEN role = 'assistant' THEN turn::VARCHAR END FROM m WHERE NOT many),
      k AS (SELECT conv_id, max(sec) + 1 AS n_sections FROM s GROUP BY conv_id),
      k1 AS (SELECT conv_id, count(*) FILTER (sec = 1) AS n_second FROM rows GROUP BY conv_id)
      SELECT conv_id AS test_id, (CASE WHEN n_sections = 1 OR n_sections = 2 AND n_second = 1 OR sec < 0 THEN NULL ELSE sec END)::INTEGER AS section_no,
        turn::INTEGER AS pos, j, n, statement, ai AS answer_index, answer FROM rows JOIN k USING (conv_id) JOIN k1 USING (conv_id)""",
    "norm_series": "SELECT row_number() OVER (ORDER BY r_regionkey) - 1 AS id, r_name AS name, false AS is_official FROM region",
    "norm_tests": f"WITH {_NORMAL} SELECT id, series::BIGINT AS series, full_name AS name, '2021' AS year, test_id::BIGINT AS aops_id, true AS is_computational FROM y",
    "norm_problems": f"""WITH {_NORMAL} SELECT row_number() OVER (ORDER BY y.id, c_custkey) - 1 AS id, y.id AS test_id, c_name AS statement, -1 AS answer_index,
      c_custkey AS aops_id, 'O' AS topic, true AS is_computational FROM p JOIN y ON p.test_id = y.test_id AND p.s IS NOT DISTINCT FROM y.s""",
    "forum_rules": """SELECT p_partkey AS topic_id, (2000 + p_size) || CASE p_partkey % 3 WHEN 0 THEN ' ZeMC 10' ELSE ' ZIME' END AS test_name, p_partkey::VARCHAR AS n FROM part WHERE p_partkey % 3 < 2""",
    "forum_groups": """SELECT (2000 + p_size) || CASE p_partkey % 3 WHEN 0 THEN ' ZeMC 10' ELSE ' ZIME' END AS test_name, count(*)::INTEGER AS n_problems, min(p_partkey) AS first_topic
      FROM part WHERE p_partkey % 3 < 2 GROUP BY test_name""",
    "stream_dedup": "SELECT DISTINCT user_id, event_type FROM events",
}
