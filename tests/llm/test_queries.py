"""The registered queries and the pipeline on the small tables."""

import os

import duckdb
import pytest

import corpus_pipeline
from panelcast.llm import decontaminate, packing, queries
from panelcast.llm import quality_rules as Q
from panelcast.llm.simhash_dedup import near_duplicates
from pyspark.sql import functions as F
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.test_oracle import _rows


OTHER_ROWS = ("op12_", "op13_")  # not one row per document: held by their SQL twins


@pytest.mark.parametrize("name", sorted(n for n in queries.QUERIES if not n.startswith(OTHER_ROWS)))
def test_whole_table(spark, name):
    got = queries.QUERIES[name](spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert "doc_id" in got.columns
    ids = [r.doc_id for r in got.select("doc_id").distinct().collect()]
    if not name.startswith("op2_"):
        assert len(ids) == docs.count()
    else:
        assert ids


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_ORACLE, t)}.parquet')")
    got, want = queries.QUERIES[name](spark, SF_ORACLE).toPandas(), con.execute(queries.ORACLE_SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns) and _rows(got) == _rows(want)


def test_pipeline_stages_take_effect(spark, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "pii", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF_SMALL).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        seen[name] = (before, docs)
        if name != "best_fit_packing":
            assert docs.columns == columns
    ids = {n: [{r.doc_id for r in d.select("doc_id").collect()} for d in pair] for n, pair in seen.items()}
    before, after = seen["quality_rules"]
    failed = {r.doc_id for r in before.where(Q.base_failed(Q.metrics(F.col("text")))).collect()}
    assert failed and not failed & ids["quality_rules"][1]
    groups = near_duplicates(seen["simhash_near_dedup"][0]).collect()
    assert ids["simhash_near_dedup"][1] == {r.component_id for r in groups}
    before, after = seen["benchmark_decontamination"]
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    leaks = {r.doc_id for r in decontaminate.contaminations(before, bench).collect()}
    assert ids["benchmark_decontamination"] == [ids["simhash_near_dedup"][1], ids["simhash_near_dedup"][1] - leaks]
    assert ids["pii"][0] == ids["pii"][1] == ids["best_fit_packing"][1]
    from panelcast.llm import pii

    assert not [r for r in seen["pii"][1].collect() if pii.base_spans(r.text)]
    packed = seen["best_fit_packing"][1].collect()
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)
    assert max(r.offset + r.length for r in packed) <= packing.LENGTH


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(got.columns) and got.count() > 0
