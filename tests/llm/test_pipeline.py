"""The pipeline's stages one after the other, and the registered queries against SQL."""

import os
from collections import Counter

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from wordloom.llm.common import load, written

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_stages(spark):
    docs = load(spark, FOLDER, "documents")
    columns = docs.columns
    given = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        was = docs.count()
        docs = written(stage(spark, docs, FOLDER))
        if name != "sharding":
            assert docs.columns == columns
            assert {tuple(r) for r in docs.collect()} <= given
        if name in ("language", "near_dedup", "decontamination"):
            assert 0 < docs.count() <= was
    slots = Counter((r.shard, r.slot) for r in docs.collect())
    assert max(slots.values()) == 1 and len(slots) == was


def test_empty_table(spark, tmp_path):
    for t in ("documents", "benchmark"):
        load(spark, FOLDER, t).where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    assert {f"op{i}" for i in range(1, 14)} == {q.split("_")[0] for q in entry_points.queries() if q.startswith("op")}
    assert "pipeline" in entry_points.queries()
