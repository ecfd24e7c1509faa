"""Tree walk, assembly, answers, normalisation, readers, sinks and streams on small tables."""

import json
import time

import pytest
from pyspark.sql import functions as F

from marginalia import scratch
from marginalia.operators import answers, assemble, forum_rules, nest, normalize, traverse
from marginalia.sources import readers, registry, schemas, sinks
from marginalia.streaming import ingest, progress


def post(kind="forum", topic=0, text="", post_id=1, poster=1, html=None):
    return (kind, topic, post_id, poster, text, html)


def items(spark, rows, key="HMMT", computational=True):
    schema = f"test_id bigint, pos int, item_type string, item_text string, post {schemas.POST}, type_key string, computational boolean"
    return spark.createDataFrame([(1, i, "post", t or "x", p, key, computational) for i, (t, p) in enumerate(rows)], schema)


HEAD = "view_posts_text"
WORKED = [
    (None, post(HEAD, 0, "General")),
    (None, post(HEAD, 0, "Guts Round")),
    (None, post(topic=11, text="Find a.")),
    (None, post(HEAD, 0, "same as General 4")),
    (None, post(topic=12, text="Find b.")),
    (None, post(HEAD, 0, "Theme Round")),
    (None, post(topic=13, text="[b]p1.[/b] u\n[b]p2.[/b] v")),
    (None, post(topic=14, text="[b]p3.[/b] w")),
    (None, post(topic=15, text="Find c.")),
]


def test_worked_case(spark):
    posts = spark.createDataFrame([(11, 0, "x", None), (11, 1, "\\boxed{5}", None), (12, 0, "x", None), (14, 0, None, "E_NO_PERMISSION"), (15, 0, "\\boxed{9}", None)], schemas.TOPIC_POSTS)
    flagged = assemble.flag_items(items(spark, WORKED))
    titles = assemble.sections(flagged)
    rows, titles = assemble.collapse(assemble.problems(flagged, registry.types(spark)), titles)
    got = [tuple(r) for r in answers.answer(rows, posts).orderBy("pos", "j").select("section_no", "pos", "n", "statement", "answer_index", "answers").collect()]
    assert [r.section for r in titles.orderBy("section_no").collect()] == ["Guts Round", "Theme Round"]
    assert got == [
        (0, 2, 0, "Find a.", 0, ["5"]),
        (0, 4, 2, "Find b.", 0, [None]),
        (1, 6, None, "u", None, []),
        (1, 6, None, "v", None, []),
        (1, 7, 2, "[b]p3.[/b] w", 0, [None]),
        (1, 8, 3, "Find c.", 0, [None]),
    ]


def test_headers_and_skips(spark):
    rows = [
        (None, post(HEAD, 0, "Day 1")),
        (None, post(topic=1, text="a")),
        (None, post(HEAD, 0, "Mixer Round")),
        (None, post(topic=2, text="b")),
        ("Mixer", post(topic=3, text="c")),
        (None, post(topic=4, text="d", post_id=registry.NOTICE_POST)),
    ]
    got = assemble.problems(assemble.flag_items(items(spark, rows)), registry.types(spark)).orderBy("pos").collect()
    assert [(r.section_no, r.statement, r.type_now) for r in got] == [(0, "a", "AMO"), (0, "b", "AMO")]


def test_olympiad_ignores_headers(spark):
    flagged = assemble.flag_items(items(spark, WORKED, "AMO", False))
    assert not flagged.where("opens").count() and flagged.where("is_problem").count() == 5


def test_remark_goes(spark):
    text = "1. a\n2. b\nP.S. You should use hide for answers."
    got = assemble.problems(assemble.flag_items(items(spark, [(None, post(topic=1, text=text, poster=registry.REMARK_POSTER))])), registry.types(spark)).orderBy("j").collect()
    assert [r.statement for r in got] == ["a", "b"]


def test_choices(spark):
    text = "Find x. $\\textbf{(A)}\\ 5\\qquad\\textbf{(B)}\\ 7$"
    rows = assemble.problems(assemble.flag_items(items(spark, [(None, post(topic=1, text=text)), (None, post(topic=2, text=text))], "AMC")), registry.types(spark))
    posts = spark.createDataFrame([(1, 0, "\\boxed{\\textbf{(B)}}", None), (2, 0, "\\boxed{5}", None)], schemas.TOPIC_POSTS)
    got = answers.answer(rows, posts).orderBy("pos").collect()
    assert [(r.statement, r.answer_index, r.answers) for r in got] == [("Find x.", 1, ["5", "7"]), ("Find x.", 0, ["5", "7"])]


def test_lone_second_section_dissolves(spark):
    rows = [(None, post(HEAD, 0, "One")), (None, post(topic=1, text="a")), (None, post(topic=2, text="b")), (None, post(HEAD, 0, "Two")), (None, post(topic=3, text="c"))]
    flagged = assemble.flag_items(items(spark, rows))
    moved, titles = assemble.collapse(assemble.problems(flagged, registry.types(spark)), assemble.sections(flagged))
    assert not titles.count() and [r.section_no for r in moved.collect()] == [None] * 3


def test_answer_key(spark):
    table = items(spark, [(None, post(topic=1, text="a")), ("Answer Key", post(topic=2, text="1. 025\n2. 110\n10. 999"))], "AIME").withColumn("type_now", F.col("type_key"))
    keys = answers.answer_keys(table)
    assert {(r.number, r.key) for r in keys.collect()} == {(1, "025"), (2, "110"), (10, "999")}
    rows = spark.createDataFrame([(1, 0, 0, ["x"]), (1, 1, 0, None), (1, 2, 0, ["z"])], "test_id bigint, pos int, j int, answers array<string>")
    assert [r.answers for r in answers.apply_keys(rows, keys).orderBy("pos").collect()] == [["025"], ["110"], ["z"]]


def test_walk(spark):
    raw = [(1, 0, 10, "folder", "F"), (1, 1, 20, "view_posts", "T20"), (10, 0, 20, "view_posts", "T20"), (10, 1, 1, "folder", "again"), (10, 2, 10, "folder", "self"), (10, 3, 4479828, "view_posts", "no"), (10, 4, 30, "forum", "f"), (10, 5, 40, "view_posts", "HMMT 2019")]
    table = spark.createDataFrame(raw, "category_id bigint, pos int, item_id bigint, item_type string, item_text string")
    names = spark.createDataFrame([(1, "OMO all"), (10, "Folder")], schemas.RAW_CATEGORIES)
    got = traverse.walk(table, names, 1, shown_depth=1)
    found = {r.item_id: (r.path, r.type_key, r.group_path) for r in got.where("item_type = 'view_posts'").collect()}
    assert found == {20: ([0, 0], "AMO", ["Folder"]), 40: ([0, 5], "HMMT", ["Folder"])}
    counts = traverse.counts(got, spark.createDataFrame([(20, 2), (40, 3)], "item_id bigint, n bigint"))
    assert {tuple(r.prefix): r.n for r in counts.collect()} == {(): 5, (0,): 5}


def test_normalised(spark, tmp_path):
    nested = [
        {"name": "S", "count": 3, "tests": [
            {"id": 7, "name": "A", "year": "2020", "sections": ["I", "II"], "computational": True, "type": "HMMT", "count": 2,
             "problems": [{"statement": "p,1", "n": 0, "answer": 0, "choices": ["5"], "section": 0, "topic_id": 1}, {"statement": 'q"', "section": 1, "topic_id": 2}]},
            {"id": 8, "name": "B", "sections": [], "computational": False, "problems": [{"statement": "r", "n": 0, "answer": -1, "topic_id": 3}]},
        ]},
    ]
    (tmp_path / "raw.json").write_text(json.dumps(nested))
    series, tests, problems = normalize.from_nested(readers.nested_series(spark, str(tmp_path / "raw.json")))
    assert [tuple(r) for r in series.collect()] == [(0, "S", False)]
    assert [(r.id, r.name, r.aops_id) for r in tests.orderBy("id").collect()] == [(0, "A + I", 7), (1, "A + II", 7), (2, "B", 8)]
    assert [(r.id, r.test_id, r.answer_index, r.answers) for r in problems.orderBy("id").collect()] == [(0, 0, 0, ["5"]), (1, 1, None, []), (2, 2, -1, [])]
    sinks.write_normalised(series, tests, problems.coalesce(1), str(tmp_path / "out"))
    lines = "".join(p.read_text() for p in (tmp_path / "out/problems.csv").glob("*.csv")).splitlines()
    assert lines[0].startswith("id,test_id,statement") and '0,0,"p,1",0,0,"5",0,0,false,1,O,true' in lines and '1,1,"q""",,,"",0,0,false,2,O,true' in lines
    assert len(list((tmp_path / "out/problems.json").glob("*.json"))) >= 1


def test_sectioned_and_repeated(spark, tmp_path):
    """Arrays of problems for each section, problems before the first section, an unknown answer
    against none, and a test that two series share."""
    p = lambda t, **more: {"statement": f"s{t}", "topic_id": t, **more}
    test = {"id": 7, "name": "A", "year": None, "sections": ["I", "II"], "computational": True, "problems": [p(0), [p(1, answer=None, n=0), p(2, answer=3)], [p(3)]]}
    plain = {"id": 8, "name": "B", "sections": [], "problems": [p(4, section=0, choices=["x", None])]}
    nested = [{"name": "S", "tests": [test, plain]}, {"name": "T", "tests": [test, {"id": 9, "name": "C", "sections": [], "problems": []}]}]
    (tmp_path / "raw.json").write_text(json.dumps(nested))
    _, tests, problems = normalize.from_nested(readers.nested_series(spark, str(tmp_path / "raw.json")))
    assert [(r.id, r.series, r.name) for r in tests.orderBy("id").collect()] == [(0, 0, "A"), (1, 0, "A + I"), (2, 0, "A + II"), (3, 0, "B"), (4, 1, "A"), (5, 1, "A + I"), (6, 1, "A + II"), (7, 1, "C")]
    got = [(r.id, r.test_id, r.aops_id, r.answer_index, r.answers) for r in problems.orderBy("id").collect()]
    assert got[:5] == [(0, 0, 0, None, []), (1, 1, 1, -1, []), (2, 1, 2, 3, []), (3, 2, 3, None, []), (4, 3, 4, None, ["x", None])]
    assert [(g[0], g[1], g[2]) for g in got[5:]] == [(5, 4, 0), (6, 5, 1), (7, 5, 2), (8, 6, 3)]


def test_arrays_after_an_unknown_entry(spark, tmp_path):
    """An entry that is null leaves the numbers of later sections alone; no problem carries its test's list."""
    test = {"id": 7, "name": "A", "sections": ["I", "II"], "problems": [None, [{"statement": "a", "topic_id": 1}], [{"statement": "b", "topic_id": 2}]]}
    (tmp_path / "raw.json").write_text(json.dumps([{"name": "S", "tests": [test]}]))
    _, tests, problems = normalize.from_nested(readers.nested_series(spark, str(tmp_path / "raw.json")))
    names = {r.id: r.name for r in tests.collect()}
    assert [(names[r.test_id], r.statement, r.aops_id) for r in problems.orderBy("id").collect()] == [("A", None, None), ("A + I", "a", 1), ("A + II", "b", 2)]
    assert " aggregate(" not in problems._jdf.queryExecution().optimizedPlan().toString()


def test_nested_result(spark):
    nodes = spark.createDataFrame(
        [(10, "folder", "F", [0]), (11, "folder", 'G "q"', [0, 1]), (20, "view_posts", "T", [0, 0]), (21, "view_posts", "U", [0, 1, 0]), (30, "folder", "empty", [1]), (22, "view_posts", "V", [2])],
        "item_id bigint, item_type string, name string, path array<int>",
    )
    tests = spark.createDataFrame([(20, "T", "2020", True, "HMMT"), (21, "U", None, None, "UNKNOWN"), (22, "V", None, False, "AMO")], "test_id bigint, name string, year string, computational boolean, type string")
    titles = spark.createDataFrame([(20, 0, "I"), (20, 1, "II")], "test_id bigint, section_no int, section string")
    rows = spark.createDataFrame([(20, None, 0, 0, "a"), (20, 0, 1, 0, "b"), (20, 0, 1, 1, "c"), (22, None, 0, 0, "d")], "test_id bigint, section_no int, pos int, j int, statement string")
    made = nest.tests_json(tests, titles, rows)
    t = {"sections": ["I", "II"], "problems": [{"statement": "a"}, [{"statement": "b", "section": 0}, {"statement": "c", "section": 0}], []], "id": 20, "name": "T", "year": "2020", "computational": True, "type": "HMMT", "count": 3}
    u = {"sections": [], "problems": [], "id": 21, "name": "U", "year": None, "computational": None, "type": "UNKNOWN", "count": 0}
    v = {"sections": [], "problems": [{"statement": "d"}], "id": 22, "name": "V", "year": None, "computational": False, "type": "AMO", "count": 1}
    by = lambda depth: json.loads(nest.nested_result(nodes, made, "root", depth).first().json)
    assert by(0) == {"name": "root", "tests": [t, u, v], "count": 4}
    g = {"name": 'G "q"', "tests": [u], "count": 0}
    assert by(1) == {"name": "root", "tests": [{"name": "F", "tests": [t, u], "count": 3}, {"name": "empty", "tests": [], "count": 0}, v], "count": 4}
    assert by(2) == {"name": "root", "tests": [{"name": "F", "tests": [t, g], "count": 3}, {"name": "empty", "tests": [], "count": 0}, v], "count": 4}
    assert json.loads(nest.nested_result(nodes.limit(0), made, "root", 1).first().json) == {"name": "root", "tests": [], "count": 0}


def test_nested_result_in_pieces(spark):
    """Neither a folder's text nor the document is built twice: one join of ranges, and a shuffle
    that hands on the row alone. Empty folders and deep ones in every place keep their commas."""
    nodes = spark.createDataFrame(
        [(10, "folder", "a", [0]), (11, "folder", "b", [0, 0]), (12, "folder", "c", [0, 1]), (13, "folder", "d", [0, 1, 0]), (14, "folder", "e", [1]), (20, "view_posts", "T", [0, 1, 0, 5]), (21, "view_posts", "U", [0, 2]), (22, "view_posts", "V", [2])],
        "item_id bigint, item_type string, name string, path array<int>",
    )
    made = spark.createDataFrame([(20, 2, '"T"'), (21, 3, '"U"'), (22, 0, '"V"'), (23, 9, '"not in the walk"')], "test_id bigint, count bigint, json string")
    folder = lambda name, count, *tests: {"name": name, "tests": list(tests), "count": count}
    row = nest.nested_result(nodes, made, "root", 3)
    assert row._jdf.queryExecution().optimizedPlan().nodeName() == "Repartition"
    assert json.loads(row.first().json) == folder("root", 5, folder("a", 5, folder("b", 0), folder("c", 2, folder("d", 2, "T")), "U"), folder("e", 0), "V")
    assert json.loads(nest.nested_result(nodes, made, "root", 1).first().json) == folder("root", 5, folder("a", 5, "T", "U"), folder("e", 0), "V")


def test_walk_of_shared_folders(spark):
    """Layers of folders that share all of the next layer: paths double with each layer, folders do
    not; the first path of each counts. A later level may find an earlier path."""
    raw = [(1, 0, 100, "folder", "a"), (1, 1, 101, "folder", "b")]
    for layer in range(1, 25):
        raw += [(100 * layer + k, j, 100 * (layer + 1) + j, "folder", f"{layer}{j}") for k in (0, 1) for j in (0, 1)]
    raw += [(2501, 7, 9, "view_posts", "deep"), (1, 2, 77, "folder", "late"), (101, 5, 77, "folder", "late"), (77, 0, 78, "view_posts", "x")]
    table = spark.createDataFrame(raw, "category_id bigint, pos int, item_id bigint, item_type string, item_text string")
    names = spark.createDataFrame([(1, "root")], schemas.RAW_CATEGORIES)
    found = {r.item_id: r.path for r in traverse.walk(table, names, 1).collect()}
    assert len(found) == 2 + 48 + 3 and found[9] == [0] * 24 + [1, 7] and found[77] == [1, 5] and found[78] == [1, 5, 0]


def test_walk_of_many_leaves(spark):
    leaves = spark.range(1_200_000).select(F.lit(5).cast("bigint").alias("category_id"), F.col("id").cast("int").alias("pos"), (F.col("id") + 10).alias("item_id"), F.lit("view_posts").alias("item_type"), F.lit("t").alias("item_text"))
    top = spark.createDataFrame([(1, 0, 5, "folder", "f")], leaves.schema)
    got = traverse.walk(top.unionByName(leaves), spark.createDataFrame([(1, "root")], schemas.RAW_CATEGORIES), 1)
    assert got.agg(F.count("*"), F.max("path")).first() == (1_200_001, [0, 1_199_999])


def test_keyset_page(spark):
    rows = spark.range(100)
    assert [r.id for r in readers.keyset_page(rows, "id", 50, 3).collect()] == [49, 48, 47]
    assert {r.id: r.page_no for r in readers.keyset_scan(rows, "id", 30).collect()} == {i: (99 - i) // 30 for i in range(100)}


def test_dense_ids_over_ranges(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), (F.col("id") % 7).alias("p")).repartition(5)
    assert {r.id for r in normalize.dense_ids(rows, ["k"]).where("id = k").collect()} == set(range(1000))
    assert normalize.dense_ids(rows.limit(0), ["k"]).count() == 0


def test_pages(spark, tmp_path):
    item = lambda i: {"item_id": i, "item_type": "view_posts", "item_text": f"t{i}"}
    pages = [
        {"category_id": 1, "page_no": 0, "response": {"category": {"category_name": "C", "items": [item(1), item(2)]}}},
        {"category_id": 1, "page_no": 1, "response": {"new_items": [item(3)], "no_more_items": True}},
    ]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, pages)))
    found = readers.category_pages(spark, str(tmp_path / "p.json"))
    assert [(r.pos, r.item_id) for r in readers.raw_items(found).orderBy("pos").collect()] == [(0, 1), (1, 2), (2, 3)]
    assert [tuple(r) for r in readers.raw_categories(found).collect()] == [(1, "C")]
    (tmp_path / "t.json").write_text("\n".join(map(json.dumps, [{"topic_id": 5, "response": {"topic": {"posts_data": [{"post_canonical": "a"}, {"post_canonical": "b"}]}}}, {"topic_id": 6, "error_code": "E_NO_PERMISSION"}])))
    assert {(r.topic_id, r.pos, r.error_code) for r in readers.topic_posts(spark, str(tmp_path / "t.json")).collect()} == {(5, 0, None), (5, 1, None), (6, 0, "E_NO_PERMISSION")}


def test_forms(spark):
    with pytest.raises(KeyError):
        readers.payload("nothing", F.lit(1))
    assert spark.range(1).select(readers.form_encode(readers.payload("topic", F.lit(5))).alias("x")).first().x == "a=fetch_topic&topic_id=5"


def test_rules(spark):
    topics = spark.createDataFrame([(1, "(ZeMC 3 P2)", "Mocks 2021"), (2, "(ZIME P4)", "none"), (3, "else", "2020")], "topic_id bigint, topic_title string, category_name string")
    rules = [forum_rules.Rule(r"\(ZeMC \d+ P(\d+)\)\z", 1, "{year} ZeMC 10"), forum_rules.Rule(r"\A\(ZIME P(\d+)\)\z", 1, "{year} ZIME")]
    assert {(r.topic_id, r.test_name, r.n) for r in forum_rules.parse_forum(topics, rules).collect()} == {(1, "2021 ZeMC 10", "2"), (2, "ZIME", "4")}


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(json.dumps({"item_id": i}) for i in range(k, k + 3)))
    rows = ingest.stream_files(spark, str(tmp_path / "in"), "item_id bigint", files_per_trigger=1)
    ingest.run_once(ingest.first_seen(rows, ["item_id"]), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(r.item_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2, 3, 4]


def test_progress(spark):
    df, seen = progress.counted(spark.range(7))
    df.collect()
    assert seen.get["n"] == 7
    assert progress.bar(5, 10, "x").startswith("x [5 / 10] (50%) [") and progress.bar(99, 10).count("█") == 20
    bars = progress.Bars()
    bars.add("a", 1)
    assert not bars.done()
    bars.count("a")
    assert bars.done() and "a [1 / 1]" in bars.render()


def test_count_and_ticker():
    count, shown = progress.Count("n:"), []
    with progress.Ticker(lambda: shown.append(count.render()), every=0.01):
        for _ in range(20):
            assert not count.done()
            count.add()
            time.sleep(0.005)
    assert count.done() and shown[-1] == "n: 20" and len(shown) > 1
    line = progress.collected(lambda: 7, "3417")
    assert line.startswith("Collected 7 problems in ") and line.endswith("ms from 3417")


def test_shared_folder_is_named_on_clusters():
    class Context:
        master, applicationId = "spark://x", "a"

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})

    with pytest.raises(RuntimeError):
        scratch.shared_dir(Session())


def test_empty_tables(spark):
    none = items(spark, WORKED).limit(0)
    flagged = assemble.flag_items(none)
    rows, titles = assemble.collapse(assemble.problems(flagged, registry.types(spark)), assemble.sections(flagged))
    posts = spark.createDataFrame([], schemas.TOPIC_POSTS)
    assert answers.answer(rows, posts).count() == 0 and titles.count() == 0
