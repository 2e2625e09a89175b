"""Registered corpus queries against their SQL, and the pipeline against its stages by hand."""

import compare
import duckdb
import pytest

import corpus_pipeline
from starloom.llm import decontaminate, queries
from test_documents import components_by_hand, hits_by_hand, lines_by_hand

TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def con(folder):
    held = duckdb.connect()
    for name in TABLES:
        held.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return held


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, con, folder, name):
    frame = queries.REGISTRY[name](spark, folder)
    answer = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(frame.columns) == sorted(columns)
    assert compare.rows_of(frame.columns, frame.collect()) == compare.rows_of(columns, answer.fetchall())


def test_every_operator_has_its_query():
    assert [int(n[2:].split("_")[0]) for n in sorted(queries.REGISTRY, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))


def test_pipeline_by_hand(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    steps, frame = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.materialize(stage(spark, frame, folder), name)
        steps[name] = frame
        if name != "best_fit_packing":
            assert frame.columns == docs.columns and frame.dtypes == docs.dtypes
    text = {n: {r.doc_id: r.text for r in f.collect()} for n, f in steps.items() if n != "best_fit_packing"}
    assert len(text["quality_rules"]) > 80
    cleaned = lines_by_hand(list(text["quality_rules"].items()))
    assert text["line_dedup"] == {i: t for i, (t, _, dropped) in cleaned.items() if not dropped or t.strip()}
    reached = components_by_hand(list(text["line_dedup"].items()), 5, 80)
    assert set(text["minhash_near_dedup"]) == {i for i, (_, c) in reached.items() if i == c}
    clean = {i for i, t in text["minhash_near_dedup"].items() if not hits_by_hand(t, bench, 10)[1]}
    assert set(text["decontamination"]) == clean
    assert {r.doc_id for r in steps["best_fit_packing"].collect()} == clean


def test_stages_keep_foreign_columns(spark, folder):
    """Columns named like results pass through every stage unchanged, also on empty tables."""
    row = "doc_id long, text string, kept string, n_words string, spans int, n_dropped string, __own0 int"
    docs = spark.createDataFrame([(1, "a b c " * 30, "k", "n", 3, "d", 5), (2, None, "k", "n", 3, "d", 5)], row)
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[1:-1]:
            got = stage(spark, frame, folder)
            assert got.columns == docs.columns, name
            for r in got.collect():
                assert (r.kept, r.n_words, r.spans, r.n_dropped) == ("k", "n", 3, "d")


def test_empty_benchmark_block():
    assert decontaminate.scan_shard([], decontaminate.phrases_of([], 10)) == []
