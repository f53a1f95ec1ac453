"""The registered queries of the package, and the pipeline against its parts run plainly."""

from __future__ import annotations

import pytest
import corpus_pipeline
from oracle import connect, difference
from plain import base_spans, jaccard_components

from marquee.llm.queries import QUERIES, SQL


def test_names():
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(SQL) <= set(QUERIES)
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, sf_dir):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name]) is None


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen[name] = (before.collect(), docs.collect())
        assert docs.columns == columns or name == "tokens"
    before, after = seen["near_copies"]
    component = jaccard_components({r.doc_id: r.text for r in before}, 5, 80)
    assert {r.doc_id for r in after} == {i for i, c in component.items() if i == c}
    before, after = seen["leaks"]
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    flat = {r.doc_id: " ".join(r.text.split()).lower() for r in before}
    leaking = {d for d, t in flat.items() if any(" ".join(i.text.split()).lower() in t for i in items)}
    assert {r.doc_id for r in after} == set(flat) - leaking
    before, after = seen["personal_data"]
    assert len(before) == len(after) and not any(base_spans(r.text) for r in after)
    kept = {r.doc_id: r.text for r in after}
    assert all(kept[r.doc_id] == r.text for r in before if not base_spans(r.text) and "<id>" not in kept[r.doc_id])
    assert {r.doc_id for r in seen["tokens"][1]} == set(kept) and all(r.round_trip for r in seen["tokens"][1])
    whole = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert whole == {r.doc_id: r.ids for r in seen["tokens"][1]}
