"""Plans keep the properties that matter at scale."""

import pytest
from pyspark.sql import functions as F

from galleyproof import operators as ops
from galleyproof.plans import changes, reports
from conftest import AS_OF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, desk, tmp_path):
    """Both tables as files, with joins kept from broadcasting as they are at scale."""
    desk.papers({"paper_id": "1"}).write.parquet(f"{tmp_path}/papers")
    desk.iterations({"paper_id": "1"}).write.parquet(f"{tmp_path}/iterations")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark.read.parquet(f"{tmp_path}/papers"), spark.read.parquet(f"{tmp_path}/iterations")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(ops.columns(stored[0], ["paper_id"], ("status", "with_author")))
    assert "EqualTo(status,with_author)" in text
    assert "ReadSchema: struct<paper_id:string,status:string>" in text


def test_latest_rounds_are_pruned_before_the_shuffle(stored):
    for df in (ops.latest_iteration(stored[1]), ops.current_rounds(stored[1])):
        after, before = plan(df).split("Exchange", 1)
        assert "WindowGroupLimit" in after and "WindowGroupLimit" in before


def test_board_joins_only_moving_papers_and_once(stored):
    text = plan(reports.status_board(*stored, AS_OF))
    assert text.count("hashpartitioning") == 2 and text.count("rangepartitioning") == 1


def test_slots_come_from_one_scan(stored):
    assert plan(reports.hours_worked(stored[1])).count("FileScan") == 1
    assert plan(reports.timeline(stored[1])).count("FileScan") == 1
    assert "Exchange" not in plan(reports.hours_worked(stored[1]))


def test_lists_are_sorted_by_ranges(stored):
    assert "rangepartitioning(email" in plan(reports.workload_items(stored[1], stored[0]))


@pytest.fixture
def hot(spark, tmp_path):
    """Rounds of which one paper holds a third, and settings that make small data count as big."""
    spark.range(60000).select(
        F.when(F.col("id") < 20000, "hot").otherwise(F.col("id").cast("string")).alias("paper_id"),
        F.col("id").cast("int").alias("round"), F.md5(F.col("id").cast("string")).alias("paper_slug"),
    ).repartition(8).write.parquet(f"{tmp_path}/rounds")
    rounds = spark.read.parquet(f"{tmp_path}/rounds")
    rounds.select("paper_id").distinct().select("paper_id", F.lit("with_author").alias("status")).write.parquet(
        f"{tmp_path}/papers")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark.read.parquet(f"{tmp_path}/papers"), rounds
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_join_on_a_hot_paper_is_split(hot):
    out = ops.waiting_rounds(*hot)
    assert len(out.collect()) == 60000
    assert "skew=true" in plan(out)


def test_deleting_around_a_hot_paper_is_split(hot):
    ids = hot[0].filter("paper_id < '3'").select("paper_id")
    kept, _ = changes.purge({"rounds": hot[1]}, ids)
    assert len(kept["rounds"].collect()) == hot[1].filter("paper_id >= '3'").count()
    assert "skew=true" in plan(kept["rounds"])


def test_new_rows_of_a_hot_key_are_split(hot):
    out = ops.new_rows(hot[1], hot[0].filter("paper_id < '3'"), "paper_id")
    assert len(out.collect()) == hot[1].filter("paper_id >= '3'").count()
    assert "skew=true" in plan(out)
