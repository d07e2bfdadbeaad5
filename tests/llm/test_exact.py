import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from galleyproof.llm import exact


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0D]+", " ", t)].append(i)
    out = []
    for body, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is None, i))
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(i, order[0], len(ids), k == 0, sha) for k, i in enumerate(order)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=repr)


def test_groups_equal_brute_force(docs, rows):
    assert rows_of(exact.decide(docs)) == expected(rows)


def test_small_batches_and_clashing_digests(docs, rows):
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 1)
    assert rows_of(exact.decide(docs, digest=weak, trigger_bytes=1)) == expected(rows)


def test_frame_without_files(spark):
    df = spark.createDataFrame([(2, "a  b"), (1, "a b"), (3, None)], "doc_id long, text string")
    assert {(r.doc_id, r.keep_id) for r in exact.decide(df).collect()} == {(1, 1), (2, 1), (3, 3)}


def test_state_goes_on_in_a_later_run(spark, tmp_path):
    folder, arrivals = f"{tmp_path}/work", f"{tmp_path}/arrivals"
    row = "doc_id long, digest string, __file string, __row long"
    spark.createDataFrame([(5, "x", "f", 0), (6, "y", "f", 1)], row).write.parquet(arrivals)
    exact.stream_groups(spark, arrivals, folder, 1 << 20)
    spark.createDataFrame([(4, "x", "g", 0)], row).write.mode("append").parquet(arrivals)
    state = exact.STATE
    (tmp_path / "work" / "last").rename(tmp_path / "before")
    groups = exact.stream_groups(spark, arrivals, folder, 1 << 20)
    assert {(r.digest, r["first"].doc_id, r.copies) for r in groups.collect()} == {("x", 4, 2), ("y", 6, 1)}
    assert all(spark.conf.get(k, None) != v or k not in state for k, v in state.items() if "Provider" in k)


def test_stage_keeps_columns_and_firsts(docs, rows, empty):
    kept = exact.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({re.sub("[\x20\x09-\x0D]+", " ", t) for _, t in rows})
    assert exact.keep_first(empty).count() == 0 and exact.decide(empty).count() == 0
