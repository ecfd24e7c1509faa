"""The pipeline and the queries with SQL on the shared tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from marginalia.llm import jaccard, language, mixing, packing, queries, secrets

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(f"{FOLDER}/documents.parquet"), reason="no shared tables")


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_sql(spark, name):
    c = duckdb.connect()
    for t in ("embeddings", "conversations", "documents"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = c.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == sorted(found)


def test_registered():
    names = list(__spark_entry__.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def odd_tables(spark, tmp_path):
    """The documents of the smallest scale with odd rows and a clashing column, as a folder."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    more = spark.createDataFrame([(10_001, None), (10_002, ""), (10_003, "12 34 !!"), (None, "some words of no document here")], "doc_id long, text string")
    more = more.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    docs.unionByName(more).unionByName(docs.limit(3)).withColumn("score", F.lit("x")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_pipeline_by_hand(spark, tmp_path):
    """Each stage's rows are those that its operator decides on, worked out row by row."""
    folder = odd_tables(spark, tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [corpus_pipeline.STAGES[0][1](spark, docs, folder)]
    before = docs.select(*corpus_pipeline.COLUMNS)
    labels, protos = language.fit(before)
    want = [r for r in language.identify(before, labels, protos).collect() if r.lang_pred != "und" and r.score > 0]
    rows = kept[0].collect()
    assert sorted(map(str, (r[:5] for r in rows))) == sorted(str(tuple(r)[:5]) for r in want)
    assert not {10_001, 10_002, 10_003} & {r.doc_id for r in rows} and len(rows) >= 200

    second = corpus_pipeline.STAGES[1][1](spark, kept[0], folder)
    component = {r.doc_id: r.component_id for r in jaccard.link(kept[0]).collect()}
    ids = [r.doc_id for r in second.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({i for i in component if i is not None and component[i] == i}) and ids.count(None) == 1

    third = corpus_pipeline.STAGES[2][1](spark, second, folder).collect()
    model = secrets.learn(second)
    for r in third:
        spans, _ = secrets.base_spans(r.text)
        assert r.n_chars == len(r.text) and not spans
    assert sorted(str(r.doc_id) for r in third) == sorted(map(str, ids)) and len(model["plain"])

    stage3 = spark.createDataFrame(third, docs.select(*corpus_pipeline.COLUMNS).schema)
    mixed = mixing.mix(stage3, spark.read.parquet(f"{folder}/labels.parquet")).withColumn("k", mixing.copies()).collect()
    fourth = corpus_pipeline.STAGES[3][1](spark, stage3, folder)
    assert fourth.columns == corpus_pipeline.COLUMNS
    assert sorted(str(r.doc_id) for r in fourth.collect()) == sorted(str(r.doc_id) for r in mixed for _ in range(r.k))

    pieces = corpus_pipeline.STAGES[4][1](spark, fourth, folder)
    total = packing.pack(fourth).agg(F.sum("length")).first()[0]
    assert pieces.agg(F.sum("length")).first()[0] == total


def test_rows_that_share_an_id(spark):
    """Each text is judged by itself: of one id the copy goes and the other text stays; rows without
    an id are deduplicated, too; rows that repeat are one."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (7, b + " end"), (None, a), (None, c), (None, c), (9, None), (9, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()]
    assert sorted(got, key=str) == sorted([(3, a), (5, b), (None, c), (9, None), (8, "")], key=str)


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.count() > 0 and {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(out.columns)
