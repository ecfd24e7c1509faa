"""Queries of readers, sinks, nested results and the rules for single items."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import answers, assemble, nest, normalize
from ..sources import readers, registry, sinks, transport
from . import sql
from .flow_queries import LINE_ORDER, POST, _tree, _typed
from .text_queries import _text, read


def category_pages(spark, sf_dir):
    """Customers of a nation as the items of a category, ten on each page; places run on."""
    customer = read(spark, sf_dir, "customer")
    at = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) - 1
    item = F.struct(F.col("c_custkey").alias("item_id"), F.lit("view_posts").alias("item_type"), F.col("c_name").alias("item_text"))
    pages = customer.select("c_nationkey", F.floor(at / 10).alias("page"), F.struct(at.alias("at"), item.alias("item")).alias("x"))
    pages = pages.groupBy("c_nationkey", "page").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["item"]).alias("items"))
    first = F.struct(F.struct(_text("Nation ", F.col("c_nationkey")).alias("category_name"), F.col("items").alias("items")).alias("category"))
    body = F.when(F.col("page") == 0, F.to_json(F.struct(first.alias("response")))).otherwise(F.to_json(F.struct(F.struct(F.col("items").alias("new_items")).alias("response"))))
    raw = pages.select(F.col("c_nationkey").cast("bigint").alias("id"), F.col("page").cast("int").alias("page_no"), body.alias("body"))
    found = transport.as_category_pages(raw)
    return readers.raw_items(found).join(readers.raw_categories(found), "category_id").select("category_id", "category_name", "pos", "item_id", "item_type", "item_text")


def topic_pages(spark, sf_dir):
    """Turns of a conversation as the posts of a topic; those of every tenth one are refused."""
    turns = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    posts = F.transform("t", lambda t: F.struct(t["text"].alias("post_canonical")))
    body = F.when(F.col("conv_id") % 10 == 0, F.lit('{"error_code":"E_NO_PERMISSION"}')).otherwise(F.to_json(F.struct(F.struct(F.struct(posts.alias("posts_data")).alias("topic")).alias("response"))))
    raw = turns.select(F.col("conv_id").alias("id"), F.lit(0).alias("page_no"), body.alias("body"))
    return readers.posts(transport.as_topic_pages(raw))


def forum_pages(spark, sf_dir):
    """Parts of a size as the topics of a forum on one page, and a last page that says so."""
    topic = F.struct(F.col("p_partkey").alias("topic_id"), F.col("p_name").alias("topic_title"), F.col("p_brand").alias("category_name"), (F.col("p_partkey") * 10).alias("last_post_time"))
    pages = read(spark, sf_dir, "part").groupBy("p_size").agg(F.array_sort(F.collect_list(topic)).alias("topics"))
    full = F.to_json(F.struct(F.lit(False).alias("no_more_topics"), F.struct("topics").alias("response")))
    raw = pages.select(F.col("p_size").cast("bigint").alias("id"), F.explode(F.array(F.struct(F.lit(0).alias("page_no"), full.alias("body")), F.struct(F.lit(1).alias("page_no"), F.lit('{"no_more_topics":true,"response":{"topics":[{"topic_id":1}]}}').alias("body")))).alias("x")).select("id", "x.*")
    return readers.topics(transport.as_forum_pages(raw))


def nested_normalise(spark, sf_dir):
    """Regions as series of nations as tests; each nation is listed twice in its region. Even
    nations have two sections with an array of problems each, odd ones a flat array."""
    region, nation, customer = (read(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    problem = F.struct(F.col("c_name").alias("statement"), F.col("c_custkey").alias("topic_id"), F.lit(1).alias("n"), F.lit(-1).alias("answer"))
    per = customer.select("c_nationkey", (F.col("c_custkey") % 2).cast("int").alias("s"), F.struct("c_custkey", problem.alias("p")).alias("x"))
    lists = per.groupBy("c_nationkey").agg(*[F.to_json(F.transform(F.array_sort(F.collect_list(F.when(c, F.col("x")))), lambda x: x["p"])).alias(k) for k, c in (("even", F.col("s") == 0), ("odd", F.col("s") == 1), ("whole", F.lit(True)))])
    split = F.col("n_nationkey") % 2 == 0
    texts = F.when(split, F.concat(F.lit("["), "even", F.lit(","), "odd", F.lit("]"))).otherwise(F.col("whole"))
    test = F.struct(
        F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"), F.lit("2021").alias("year"), F.when(split, F.array(F.lit("I"), F.lit("II"))).otherwise(F.array().cast("array<string>")).alias("sections"),
        texts.alias("problems"), F.lit(True).alias("computational"), F.lit("HMMT").alias("type"), F.lit(0).alias("count"),
    )
    tests = nation.join(lists, F.col("n_nationkey") == F.col("c_nationkey")).groupBy("n_regionkey").agg(F.array_sort(F.collect_list(test)).alias("tests"))
    series = region.join(tests, F.col("r_regionkey") == F.col("n_regionkey")).select("r_regionkey", F.col("r_name").alias("name"), F.concat("tests", "tests").alias("tests"))
    series = series.coalesce(1).sortWithinPartitions("r_regionkey")
    _, table, problems = normalize.from_nested(series)
    named = table.select(F.col("id").alias("test_id"), F.col("name").alias("test"), F.col("series"))
    return problems.join(named, "test_id").select("id", "test_id", "series", "test", "statement", "answer_index", "aops_id")


def nested_result(spark, sf_dir):
    """The tree of regions, nations and customers as one document, problems being orders."""
    nodes = _tree(spark, sf_dir)
    orders = read(spark, sf_dir, "orders").select((F.col("o_custkey") + 100_000).alias("test_id"), F.lit(None).cast("int").alias("section_no"), F.col("o_orderkey").alias("pos"), F.lit(0).alias("j"), F.col("o_orderstatus").alias("statement"), F.col("o_orderkey").alias("topic_id"))
    leaves = nodes.where("item_type = 'view_posts'")
    tests = leaves.select(F.col("item_id").alias("test_id"), "name", F.lit(None).cast("string").alias("year"), F.lit(True).alias("computational"), F.col("type_key").alias("type"))
    titles = spark.createDataFrame([], "test_id bigint, section_no int, section string")
    return nest.nested_result(nodes, nest.tests_json(tests, titles, orders), "All", 1)


def csv_lines(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    quoted = _text(F.col("p_name"), ', "', F.col("p_brand"), '"')
    rows = part.select("p_partkey", quoted.alias("statement"), F.when(F.col("p_size") % 2 == 0, F.array("p_type", F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>")).alias("answers"), F.when(F.col("p_size") % 3 > 0, F.col("p_size")).alias("n"), (F.col("p_size") > 9).alias("verified"))
    return sinks.csv_lines(rows)


def item_rules(spark, sf_dir):
    """Lines of an order as posts of every kind: same-as headers, a mixer round, hidden posts, a
    mixer item and the copyright notice; the rest by line status."""
    line = read(spark, sf_dir, "lineitem")
    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER.split(", ")))
    k = F.col("l_partkey") % 7
    head = k.isin(1, 3, 6)
    text = F.when(k == 1, "same as General 4").when(k == 3, " Mixer Round\n").when(k == 6, _text("Round ", F.col("l_linestatus"))).otherwise("text")
    values = (F.when(head, "view_posts_text").otherwise("forum"), F.when(head, 0).otherwise(F.col("l_partkey") + 1).cast("bigint"), F.when(k == 4, registry.NOTICE_POST).otherwise(F.col("l_partkey")).cast("bigint"), F.lit(1).cast("bigint"), text, F.lit(None).cast("string"))
    items = line.select(F.col("l_orderkey").alias("test_id"), pos.alias("pos"), F.when(k == 2, "post_hidden").otherwise("post").alias("item_type"), F.when(k == 5, "Mixer").otherwise("x").alias("item_text"), F.struct(*[v.alias(n) for n, v in zip(POST, values)]).alias("post"))
    return assemble.flag_items(_typed(items, "HMMT", True)).select("test_id", "pos", "is_header", "bumps", "opens", "is_problem")


def choice_problems(spark, sf_dir):
    """Parts as multiple-choice problems of a contest, ten to a test; answers are letters or texts.
    The first post of a test is a list of two, by the poster whose closing remark goes."""
    part = read(spark, sf_dir, "part")
    listed = F.col("p_partkey") % 10 == 0
    single = _text("Find ", F.col("p_name"), ". $\\textbf{(A)}\\ ", F.col("p_size"), "\\qquad\\textbf{(B) }\\ ", F.col("p_size") + 1, "$")
    many = _text("1. alpha $\\textbf{(A)}\\ 5$\n2. beta $\\textbf{(A)}\\ 6$\nP.S. You should use hide for answers.")
    values = (F.lit("forum"), F.col("p_partkey") + 1, F.col("p_partkey"), F.when(listed, registry.REMARK_POSTER).otherwise(1).cast("bigint"), F.when(listed, many).otherwise(single), F.lit(None).cast("string"))
    items = part.select(F.floor(F.col("p_partkey") / 10).alias("test_id"), (F.col("p_partkey") % 10).cast("int").alias("pos"), F.lit("post").alias("item_type"), F.lit("x").alias("item_text"), F.struct(*[v.alias(n) for n, v in zip(POST, values)]).alias("post"))
    rows = assemble.problems(assemble.flag_items(_typed(items, "AMC", True)), registry.types(spark))
    k = F.col("p_partkey") % 3
    boxed = F.when(k == 0, "\\boxed{\\textbf{(B)}}").when(k == 1, _text("\\boxed{", F.col("p_size"), "}"))
    posts = part.select((F.col("p_partkey") + 1).alias("topic_id"), F.lit(0).alias("pos"), boxed.alias("post_canonical"), F.lit(None).cast("string").alias("error_code"))
    return answers.answer(rows, posts).select("test_id", "pos", "j", "statement", "answer_index", F.array_join("answers", "|").alias("answers"))


def key_answers(spark, sf_dir):
    """Orders of a customer as problems; every third customer has a key for the first two."""
    order = read(spark, sf_dir, "orders")
    rows = order.select(F.col("o_custkey").alias("test_id"), F.col("o_orderkey").alias("pos"), F.lit(0).alias("j"), F.array("o_orderstatus").alias("answers"))
    numbers = F.explode(F.array(F.lit(1), F.lit(2), F.lit(16)))
    keys = order.where("o_custkey % 3 = 0").select(F.col("o_custkey").alias("test_id")).distinct().select("test_id", numbers.alias("number")).withColumn("key", _text("0", F.col("number")))
    return answers.apply_keys(rows, keys).select("test_id", "pos", F.col("answers")[0].alias("answer"))


QUERIES = {f.__name__: f for f in (category_pages, topic_pages, forum_pages, nested_normalise, nested_result, csv_lines, item_rules, choice_problems, key_answers)}

_NESTED = """
t AS (SELECT r_regionkey, n_nationkey, n_name, v.copy FROM region JOIN nation ON n_regionkey = r_regionkey, (VALUES (0), (1)) AS v(copy)
      WHERE n_nationkey IN (SELECT c_nationkey FROM customer)),
x AS (SELECT t.*, CASE WHEN n_nationkey % 2 = 0 THEN z.k END AS s FROM t, (VALUES (0), (1)) AS z(k) WHERE n_nationkey % 2 = 0 OR z.k = 0),
r AS (SELECT r_regionkey, row_number() OVER (ORDER BY r_regionkey) - 1 AS series FROM (SELECT DISTINCT r_regionkey FROM t)),
y AS (SELECT x.*, series, row_number() OVER (ORDER BY x.r_regionkey, copy, n_nationkey, s) - 1 AS test_id,
        n_name || CASE s WHEN 0 THEN ' + I' WHEN 1 THEN ' + II' ELSE '' END AS test FROM x JOIN r USING (r_regionkey))"""

ORACLE_SQL = {
    "category_pages": """SELECT c_nationkey::BIGINT AS category_id, 'Nation ' || c_nationkey AS category_name, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1)::INTEGER AS pos,
      c_custkey AS item_id, 'view_posts' AS item_type, c_name AS item_text FROM customer""",
    "topic_pages": """SELECT conv_id AS topic_id, turn::INTEGER AS pos, text AS post_canonical, NULL AS error_code FROM conversations WHERE conv_id % 10 <> 0
      UNION ALL SELECT DISTINCT conv_id, 0, NULL, 'E_NO_PERMISSION' FROM conversations WHERE conv_id % 10 = 0""",
    "forum_pages": "SELECT p_size::BIGINT AS category_id, 0 AS page_no, p_partkey AS topic_id, p_name AS topic_title, p_brand AS category_name, p_partkey * 10 AS last_post_time FROM part",
    "nested_normalise": f"""WITH {_NESTED}
      SELECT row_number() OVER (ORDER BY test_id, c_custkey) - 1 AS id, test_id, series, test, c_name AS statement, -1 AS answer_index, c_custkey AS aops_id
      FROM y JOIN customer ON c_nationkey = n_nationkey AND (s IS NULL OR c_custkey % 2 = s)""",
    "csv_lines": f"""SELECT p_partkey || ',"' || p_name || ', ""' || p_brand || '""{sql.quote('"')[1:-1]},' || CASE WHEN p_size % 2 = 0 THEN '"' || p_type || ',"' ELSE '""' END || ',' ||
      CASE WHEN p_size % 3 > 0 THEN p_size::VARCHAR ELSE '' END || ',' || (p_size > 9)::VARCHAR AS line FROM part""",
    "item_rules": f"""WITH l AS (SELECT l_orderkey AS test_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER})::INTEGER AS pos, l_partkey % 7 AS k FROM lineitem),
      n AS (SELECT *, k IN (1, 3, 6) AS head, coalesce(lead(k IN (1, 3, 6)) OVER (PARTITION BY test_id ORDER BY pos), false) AS followed FROM l)
      SELECT test_id, pos, head AS is_header, k = 1 AS bumps, k = 6 AND NOT followed AS opens, k = 0 AS is_problem FROM n""",
    "choice_problems": """SELECT p_partkey // 10 AS test_id, (p_partkey % 10)::INTEGER AS pos, 0 AS j, 'Find ' || p_name || '.' AS statement,
        CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE -1 END AS answer_index, p_size || '|' || (p_size + 1) AS answers FROM part WHERE p_partkey % 10 <> 0
      UNION ALL SELECT p_partkey // 10, 0, v.j, v.s, NULL, v.c FROM part, (VALUES (0, 'alpha', '5'), (1, 'beta', '6')) AS v(j, s, c) WHERE p_partkey % 10 = 0""",
    "key_answers": """SELECT o_custkey AS test_id, o_orderkey AS pos, CASE WHEN o_custkey % 3 = 0 AND row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) < 3
      THEN '0' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) ELSE o_orderstatus END AS answer FROM orders""",
    "nested_result": f"""WITH o AS (SELECT o_custkey, string_agg('{{"statement":"' || o_orderstatus || '","topic_id":' || o_orderkey || '}}', ',' ORDER BY o_orderkey) AS ps, count(*) AS n FROM orders GROUP BY o_custkey),
      f AS (SELECT r_regionkey AS up, n_nationkey AS k, CASE WHEN r_regionkey % 2 = 0 THEN 'HMMT ' || r_name ELSE r_name END AS top, n_name FROM region JOIN nation ON n_regionkey = r_regionkey),
      t AS (SELECT up, k, c_custkey, top, coalesce(n, 0) AS n, '{{"sections":[],"problems":[' || coalesce(ps, '') || '],"id":' || (100000 + c_custkey) || ',"name":"' || c_name || '","year":null,"computational":true,"type":"'
              || coalesce({sql.infer('c_name')}, {sql.infer('top')}, {sql.infer('n_name')}, 'UNKNOWN') || '","count":' || coalesce(n, 0) || '}}' AS j FROM f JOIN customer ON c_nationkey = k LEFT JOIN o ON o_custkey = c_custkey),
      g AS (SELECT up, sum(n) AS n, '{{"name":"' || any_value(top) || '","tests":[' || string_agg(j, ',' ORDER BY k, c_custkey) || '],"count":' || sum(n) || '}}' AS j FROM t GROUP BY up)
      SELECT '{{"name":"All","tests":[' || string_agg(j, ',' ORDER BY up) || '],"count":' || sum(n) || '}}' AS json, sum(n)::BIGINT AS count FROM g""",
}
