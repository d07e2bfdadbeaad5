import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from galleyproof.llm import line_crf, mixing, packing, queries, simhash

from .test_simhash import brute_print, roots

SF_DIR = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark, tmp_path):
    """Every stage on all rows its predecessor kept, against plain Python where that decides."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, before, SF_DIR)
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        after = spark.read.parquet(path)
        old = [(r.doc_id, r.text or "") for r in before.select("doc_id", "text").collect()]
        if name != "packing":
            assert after.columns == columns
            ids = [r.doc_id for r in after.select("doc_id").collect()]
        if name == "quality":
            labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
            bad = {r.doc_id for r in line_crf.judge(before, labels).collect() if r.predicted == 0}
            assert set(ids) == {i for i, _ in old} - bad
        elif name == "exact_dedup":
            first = {}
            for i, t in sorted(old):
                first.setdefault(re.sub("[\x20\x09-\x0D]+", " ", t), i)
            assert sorted(ids) == sorted(first.values())
        elif name == "near_dedup":
            prints = [brute_print(t) for _, t in old]
            root, first = roots(prints, simhash.DISTANCE), {}
            for (i, _), p in sorted(zip(old, prints, strict=True)):
                first.setdefault(root[p], i)
            assert sorted(ids) == sorted(first.values())
        elif name == "mixing":
            labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
            rated = mixing.mix(before, labels, most=mixing.MOST_COPIES).collect()
            assert sorted(ids) == sorted(r.doc_id for r in rated for _ in range(r.copies))
            clean = {r.doc_id for r in labels.filter("quality = 1 AND toxic = 0").collect()} & {i for i, _ in old}
            # 87 labelled rows can't tell the domains apart well; test_mixing asks for 95 % at sf0.01
            assert len(clean & set(ids)) >= 0.85 * len(clean), (len(clean & set(ids)), len(clean))
        else:
            total = after.agg(F.sum("length")).first()[0]
            assert total == after.filter("start = 0").agg(F.sum("doc_tokens")).first()[0]
            assert after.filter("start = 0").count() == len(old)
        before = after


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF_DIR).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in queries.QUERIES if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, len(names) + 1))
    assert "pipeline" in queries.QUERIES and mixing.DOMAINS and packing.GROUP_PIECES


@pytest.mark.parametrize("stage", [k for k, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, stage):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    assert dict(corpus_pipeline.STAGES)[stage](spark, docs, SF_DIR).count() == 0
