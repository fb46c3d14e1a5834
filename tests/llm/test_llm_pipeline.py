"""The corpus pipeline: each stage's decisions on its own input, whole run, edges; and the queries' SQL."""

import duckdb
import pytest
from llm_tables import EDGE_DOCS, write
from test_llm_decontaminate import brute as brute_leaks
from test_llm_ngram import brute as brute_groups

import __spark_entry__
import corpus_pipeline
from tidemark.llm.oracle import ORACLE_SQL
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert set(ORACLE_SQL) <= set(QUERIES) and set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_stages(spark, tmp_dir):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    tables, columns = [docs], docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SMALL).write.parquet(f"{tmp_dir}/{i}")
        tables.append(spark.read.parquet(f"{tmp_dir}/{i}"))
    assert all(t.columns == columns for t in tables[:-1])
    start, clean, single, safe, mixed, tokens = ([tuple(r) for r in t.collect()] for t in tables)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    gone = {r[0] for r in start} - {r[0] for r in clean}
    assert all(labels.get(d, 1) == 1 for d in gone) and set(clean) <= set(start)
    assert {r[0] for r in single} == {c for _, _, c in brute_groups([r[:2] for r in clean], 5, 80, 100)} and set(single) <= set(clean)
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {d for d, *_ in brute_leaks([r[:2] for r in single], items)}
    assert {r[0] for r in safe} == {r[0] for r in single} - leaked
    assert set(mixed) <= set(safe) and max(mixed.count(r) for r in set(mixed)) <= 3
    assert len(tokens) == len(mixed) and [t[0] for t in sorted(tokens, key=lambda t: t[1])] == sorted(r[0] for r in mixed)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and rows.count() > 0


def test_edges(spark, tmp_dir):
    rows = corpus_pipeline.run(spark, write(tmp_dir, EDGE_DOCS, [(1, 1, 0)], benchmark=[(1, "single")])).collect()
    assert {r.doc_id for r in rows} <= {1, 3, 4, 5, 6, 8, None}
    assert corpus_pipeline.run(spark, write(tmp_dir, EDGE_DOCS)).count() > 0
    assert corpus_pipeline.run(spark, write(tmp_dir)).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    result = con.sql(ORACLE_SQL[name])
    df = QUERIES[name](spark, SMALL)
    names = sorted(df.columns)
    assert names == sorted(result.columns)
    order = [result.columns.index(n) for n in names]
    assert sorted(str(tuple(r)) for r in df.select(*names).collect()) == sorted(str(tuple(r[i] for i in order)) for r in result.fetchall())
