"""Queries of the text functions, on texts made from the shared tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, lists, text
from ..sources import readers, registry
from . import sql


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _numbered(spark: SparkSession, sf_dir: str, mark, start: int = 1, styles=lists.STYLES) -> DataFrame:
    """Turns of a conversation as one numbered list, split again."""
    turns = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    whole = F.array_join(F.transform("t", lambda t, i: F.concat(mark((i + start).cast("string")), t["text"])), "\n")
    return turns.select("conv_id", F.posexplode(lists.split_list(whole, start, styles)).alias("k", "item")).withColumn("k", F.col("k") + start)


def _numbered_sql(start: int = 1) -> str:
    return f"""SELECT conv_id, (turn + {start})::INTEGER AS k,
      array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10)) AS item
    FROM conversations WHERE conv_id IN (SELECT conv_id FROM conversations GROUP BY conv_id HAVING count(*) > 1)"""


def list_split(spark, sf_dir):
    return _numbered(spark, sf_dir, lambda k: _text("[b]p", k, ".[/b] "))


def list_split_plain(spark, sf_dir):
    return _numbered(spark, sf_dir, lambda k: _text(k, ". "))


def list_split_start(spark, sf_dir):
    return _numbered(spark, sf_dir, lambda k: _text(k, ". "), 3)


def list_split_tag(spark, sf_dir):
    return _numbered(spark, sf_dir, lambda k: _text("[i]", k, "[/i] "), 1, (lists.tagged("i"),))


def list_postscript(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    items = F.array(F.lit("first P.S. hide for answers"), _text(F.col("p_name"), "\nP.S. You should use hide for answers. ", F.col("p_brand")))
    return part.select("p_partkey", F.array_join(lists.drop_postscript(items), "|").alias("items"))


def entity_latex(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.format_latex(F.col("html")).alias("latex"))


def html_sanitize(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.escape_html(F.col("text")).alias("html"))


def unescape_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.unescape(F.replace("text", F.lit("\n"), F.lit("\\n"))).alias("plain"))


def boxed_answer(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem")
    box = F.when(F.col("l_linenumber") % 3 == 0, "\\boxed{}").when(F.col("l_linenumber") % 3 == 1, _text("so \\boxed{\\frac{", F.col("l_partkey"), "}{", F.col("l_suppkey"), "}}")).otherwise("no box")
    return line.select("l_orderkey", "l_linenumber", text.first_boxed(box).alias("boxed"))


def boxed_too_deep(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", text.first_boxed(_text("\\boxed{a{b{c{d{e}}}}} \\boxed{", F.col("p_partkey"), "}")).alias("boxed"))


def clean_problem(spark, sf_dir):
    post = _text("[b]Problem #", F.col("p_partkey"), ":[/b] ", F.col("p_name"), " [i]Proposed by ", F.col("p_brand"), "[/i] ")
    return read(spark, sf_dir, "part").select("p_partkey", text.clean_problem(post).alias("statement"))


def asy_links(spark, sf_dir):
    post = _text("[ASY]draw(", F.col("page_id"), ");[/ASY] t [asy]x[/asy]")
    page = _text('<p><img class="asy-image" src="//h/', F.col("page_id"), '.png"></p>')
    return read(spark, sf_dir, "pages").select("page_id", lists.link_drawings(post, page).alias("linked"))


def link_extract(spark, sf_dir):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return read(spark, sf_dir, "pages").select("page_id", F.explode(links).alias("href"))


def _choices() -> Column:
    parts: list = ["Find ", F.col("p_name"), ". $"]
    for i, letter in enumerate("ABCDE"):
        parts += ["\\qquad" if i else "", f"\\textbf{{({letter}){' ' if i == 2 else ''}}}\\ ", F.col("p_size") + i]
    return _text(*parts, "$")


def choices_extract(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(text.extract_choices(_choices()), "|").alias("choices"))


def choices_clean(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", text.clean_choices(_choices()).alias("statement"))


def mcq_parse(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.parse_answer(F.col("text")).alias("a")).select("doc_id", "a.type", "a.value")


def answer_index(spark, sf_dir):
    k, size = F.col("p_partkey") % 4, F.col("p_size")
    given = F.when(k == 0, "\\textbf{(C)}").when(k == 1, (size + 1).cast("string")).when(k == 2, "zz")
    choices = F.array(*[(size + i).cast("string") for i in range(3)])
    return read(spark, sf_dir, "part").select("p_partkey", classify.answer_index(text.parse_answer(given), choices).cast("int").alias("answer_index"))


def year_extract(spark, sf_dir):
    title = F.when(F.col("o_orderkey") % 5 == 0, "Contest round").otherwise(_text("Contest ", F.year("o_orderdate"), " round 1899"))
    return read(spark, sf_dir, "orders").select("o_orderkey", text.extract_year(title).alias("year"))


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 6
    made = F.when(k == 0, _text("AMC ", F.col("p_size"))).when(k == 1, _text("PUMaC ", F.col("p_name"))).when(k == 2, "AIME (AIME level)").when(k == 3, _text("OMMC final ", F.col("p_size"))).when(k == 4, "USAJMO").otherwise(_text("ARML ", F.col("p_brand")))
    return registry.registry(spark).select("name").unionAll(read(spark, sf_dir, "part").select(made.alias("name")))


def infer_type(spark, sf_dir):
    return _names(spark, sf_dir).select("name", classify.infer_type(F.col("name")).alias("type_key"), classify.level_label(F.col("name")).alias("label"))


def registry_search(spark, sf_dir):
    return registry.search(spark, " mo ")


def registry_union(spark, sf_dir):
    return registry.contests(spark).select("grp", "name", "id")


def registry_series(spark, sf_dir):
    return registry.series_contests(spark).select("name", "id")


def csv_cell(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.csv_cell(F.col("text")).alias("cell"))


def csv_array(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", text.csv_array(F.array("p_brand", F.lit(None).cast("string"), "p_type")).alias("cell"))


def keyset_scan(spark, sf_dir):
    """Every order, with the page on which a scan by falling key finds it."""
    return readers.keyset_scan(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey", 50)


def form_encode(spark, sf_dir):
    nation = read(spark, sf_dir, "nation")
    return nation.select("n_nationkey", readers.form_encode(readers.payload("items", F.col("n_nationkey"), F.col("n_regionkey"))).alias("body"))


def progress_bar(spark, sf_dir):
    per = read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    return per.select("n_nationkey", text.progress_bar(F.col("n"), F.lit(80)).alias("bar"))


QUERIES = {
    f.__name__: f
    for f in (
        list_split, list_split_plain, list_split_start, list_split_tag, list_postscript, entity_latex, html_sanitize, unescape_text, boxed_answer,
        boxed_too_deep, clean_problem, asy_links, link_extract, choices_extract, choices_clean, mcq_parse, answer_index, year_extract, infer_type,
        registry_search, registry_union, registry_series, csv_cell, csv_array, keyset_scan, form_encode, progress_bar,
    )
}

_CONTESTS = "id IS NOT NULL AND kind IS DISTINCT FROM 'forum' AND grp IN ('MAA', 'CollegeComp', 'Other', 'UserContestSeries', 'UserMocks')"
_NAMES = f"""SELECT name FROM {sql.registry_rows()} UNION ALL
  SELECT CASE p_partkey % 6 WHEN 0 THEN 'AMC ' || p_size WHEN 1 THEN 'PUMaC ' || p_name WHEN 2 THEN 'AIME (AIME level)'
         WHEN 3 THEN 'OMMC final ' || p_size WHEN 4 THEN 'USAJMO' ELSE 'ARML ' || p_brand END FROM part"""
_LETTER = r"upper(regexp_extract(text, '(?i)\b\(?([A-E])\)?[.)]?\b', 1))"

ORACLE_SQL = {
    "list_split": _numbered_sql(),
    "list_split_plain": _numbered_sql(),
    "list_split_start": _numbered_sql(3),
    "list_split_tag": _numbered_sql(),
    "list_postscript": "SELECT p_partkey, 'first P.S. hide for answers|' || p_name AS items FROM part",
    "entity_latex": f"SELECT page_id, {sql.latex('html')} AS latex FROM pages",
    "html_sanitize": f"SELECT doc_id, {sql.replaced('text', text.HTML)} AS html FROM documents",
    "unescape_text": f"SELECT doc_id, {sql.replaced('replace(text, chr(10), ' + sql.quote(chr(92) + 'n') + ')', text.ESCAPES)} AS plain FROM documents",
    "boxed_answer": r"""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN '\frac{' || l_partkey || '}{' || l_suppkey || '}' END AS boxed FROM lineitem""",
    "boxed_too_deep": "SELECT p_partkey, p_partkey::VARCHAR AS boxed FROM part",
    "clean_problem": r"""SELECT p_partkey, trim(regexp_replace(regexp_replace('[b]Problem #' || p_partkey || ':[/b] ' || p_name || ' [i]Proposed by ' || p_brand || '[/i] ',
      '(?i)^\[b\]problem #\d+:\[/b\]\s*', ''), '(?i)\[i\][^\[]*?proposed by [^\[]*?\[/i\]', '', 'g')) AS statement FROM part""",
    "asy_links": "SELECT page_id, '[asy=https://h/' || page_id || '.png]draw(' || page_id || ');[/asy] t [asy]x[/asy]' AS linked FROM pages",
    "link_extract": """SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages""",
    "choices_extract": "SELECT p_partkey, concat_ws('|', p_size, p_size + 1, p_size + 2, p_size + 3, p_size + 4) AS choices FROM part",
    "choices_clean": "SELECT p_partkey, 'Find ' || p_name || '.' AS statement FROM part",
    "mcq_parse": f"""SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN NULL WHEN {_LETTER} <> '' THEN 'letter' ELSE 'text' END AS type,
      CASE WHEN text IS NULL OR text = '' THEN NULL WHEN {_LETTER} <> '' THEN {_LETTER} ELSE {sql.stripped('text')} END AS value FROM documents""",
    "answer_index": "SELECT p_partkey, (CASE p_partkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE -1 END)::INTEGER AS answer_index FROM part",
    "year_extract": r"""SELECT o_orderkey, nullif(regexp_extract(CASE WHEN o_orderkey % 5 = 0 THEN 'Contest round'
      ELSE 'Contest ' || year(o_orderdate) || ' round 1899' END, '\b(?:19|20)\d{2}\b'), '') AS year FROM orders""",
    "infer_type": f"SELECT name, {sql.infer('name')} AS type_key, {sql.level('name')} AS label FROM ({_NAMES})",
    "registry_search": f"""SELECT '[' || name || '] ' || id AS label, id::VARCHAR AS value FROM {sql.registry_rows()}
      WHERE {_CONTESTS} AND (contains(id::VARCHAR, 'mo') OR contains(lower(name), 'mo')) UNION ALL SELECT 'Use custom: mo', 'mo'""",
    "registry_union": f"SELECT grp, name, id FROM {sql.registry_rows()} WHERE {_CONTESTS}",
    "registry_series": f"SELECT name, id FROM {sql.registry_rows()} WHERE grp = 'UserContestSeries' AND id IS NOT NULL",
    "csv_cell": """SELECT doc_id, CASE WHEN regexp_matches(replace(text, chr(13) || chr(10), chr(10)), '[",\\n\\r]')
      THEN '"' || replace(replace(text, chr(13) || chr(10), chr(10)), '"', '""') || '"' ELSE coalesce(replace(text, chr(13) || chr(10), chr(10)), '') END AS cell FROM documents""",
    "csv_array": """SELECT p_partkey, '"' || replace(coalesce(p_brand, '') || ',,' || coalesce(p_type, ''), '"', '""') || '"' AS cell FROM part""",
    "keyset_scan": "SELECT o_orderkey, o_orderdate, (row_number() OVER (ORDER BY o_orderkey DESC) - 1) // 50 AS page_no FROM orders",
    "form_encode": "SELECT n_nationkey, 'sought_category_ids=%5B%5D&seek_items=1&log_visit=0&a=fetch_items_categories&parent_category_id=' || n_nationkey || '&start_num=' || n_regionkey AS body FROM nation",
    "progress_bar": """SELECT c_nationkey AS n_nationkey, repeat('█', f) || repeat('░', 20 - f) AS bar FROM (
      SELECT c_nationkey, floor(20 * least(80, count(*)) / 80 + 0.5)::INTEGER AS f FROM customer GROUP BY c_nationkey)""",
}
