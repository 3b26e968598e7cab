"""Registered queries: oracles, contracts and the pipeline on the small tables."""

import glob
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ledgerloom.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"create view {path.rsplit('/', 1)[1][:-8]} as select * from '{path}'")
    return con


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, duck, name):
    got = queries.QUERIES[name](spark, SMALL)
    columns = ", ".join(f'"{c}"' for c in got.columns)
    want = duck.execute(f"select {columns} from ({queries.ORACLES[name]})").fetchall()
    key = lambda row: tuple((v is not None, v) for v in row)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op6_chat_perspectives", "op10_warc", "op12_whitening", "op13_ranked_search", "pipeline"}))
def test_one_row_for_each_document(spark, name):
    got = queries.QUERIES[name](spark, SMALL)
    ids = [r.doc_id for r in got.select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect())


def test_native_query_runs_no_python(spark):
    plan = queries.QUERIES["op9_pii"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "near duplicates", "decontamination", "secrets", "tokens"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, alive = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.durable(stage(spark, docs, SMALL))
        assert docs.count() <= alive, name
        alive = docs.count()
        assert name == "tokens" or docs.columns == columns
    rows = docs.collect()
    assert len({r.doc_id for r in rows}) == len(rows) > 100 and all(r.lossless for r in rows)


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    rows = [(5, "same words here again and again", "en"), (5, "same words here again and again", "en"), (2, "same words here again and again", "de"),
            (9, "other", None), (None, "same words here again and again", "en"), (7, None, "en"), (8, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()
    assert sorted((r.doc_id for r in kept), key=str) == sorted([2, 9, None, 7], key=str)


def test_pipeline_keeps_one_of_each_group_without_ids_too(spark):
    a, b, c = "same words here again and again", "entirely different text about ships and harbours", "a third one, on its own"
    docs = spark.createDataFrame([(None, a), (5, a), (None, a), (None, b), (None, b), (9, c), (None, None), (None, "")], "doc_id bigint, text string")
    stage = dict(corpus_pipeline.STAGES)["near duplicates"]
    kept = [tuple(r) for r in stage(spark, docs, SMALL).collect()]
    assert [r for r in kept if r[1]] and Counter(kept) in (Counter([(5, a), (None, b), (9, c), (None, t)]) for t in (None, ""))


def test_near_duplicate_stage_keeps_one_of_each_group_under_shared_ids(spark):
    a, b = "same words here again and again", "entirely different text about ships and harbours"
    docs = spark.createDataFrame([(5, a), (5, b), (9, b), (5, a), (5, "a third one, on its own"), (6, a)], "doc_id bigint, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()
    assert sorted(tuple(r) for r in kept) == sorted([(5, a), (5, b), (5, "a third one, on its own")])


def test_stages_judge_rows_and_not_ids(spark):
    passage = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    good = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").where("n_chars > 500").join(
        spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1"), "doc_id", "left_semi").orderBy("doc_id").limit(30).collect()]
    ids = [r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").orderBy("doc_id").limit(30).collect()]
    schema = "doc_id bigint, lang string, text string"
    leak = spark.createDataFrame([(None, "en", passage), (None, "en", "clean"), (1, "en", "clean too"), (1, "en", passage)], schema)
    assert sorted(r.text for r in corpus_pipeline.decontaminated(spark, leak, SMALL).collect()) == ["clean", "clean too"]
    junk = "#%$ " * 400
    docs = spark.createDataFrame([*((i, None, t) for i, t in zip(ids, good)), (None, None, junk), (-7, None, junk), (-7, None, good[3])], schema)
    kept = corpus_pipeline.quality(spark, docs, SMALL).collect()
    assert sorted(r.text for r in kept) == sorted([*good, good[3]])


def test_pipeline_on_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.durable(stage(spark, docs, SMALL))
    assert docs.count() == 0


def test_stages_keep_columns_with_the_names_they_use(spark, tmp_path):
    """Own columns called like keys and results pass through, from memory and from files."""
    passage = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    rows = [(1, "en", "web", passage, 5, "a", "b", "c"), (2, "en", "web", "password=abcdefghijkl1 clean words here", 7, "d", "e", "f"),
            (3, None, None, None, None, None, None, None), (3, "de", "web", "", 0, "g", "h", "i")]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, text string, n_chars bigint, __row string, __secrets string, key string")
    docs.write.parquet(f"{tmp_path}/docs")
    for given in (docs, spark.read.parquet(f"{tmp_path}/docs")):
        for name, stage in corpus_pipeline.STAGES[:4]:
            got = stage(spark, given, SMALL)
            assert got.columns == docs.columns, name
            assert {r["__row"] for r in got.collect()} <= {"a", "d", None, "g"}, name
        left = corpus_pipeline.decontaminated(spark, given, SMALL)
        assert sorted(r["__row"] or "" for r in left.collect()) == ["", "d", "g"]
        clean = {r["__secrets"]: (r.text, r.n_chars) for r in corpus_pipeline.without_secrets(spark, given, SMALL).collect()}
        assert clean["e"] == ("<SECRET> clean words here", 25) and clean["h"] == ("", 0) and clean[None] == (None, None)
