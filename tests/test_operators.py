import datetime as dt

import pytest
from pyspark.sql import functions as F

from galleyproof import operators as ops
from galleyproof.plans import ingest
from conftest import by_id


def test_unknown_status_is_an_error(desk):
    with pytest.raises(ValueError):
        ops.by_status(desk.papers({"paper_id": "1"}), "published")


def test_availability_counts_only_yes(spark):
    people = spark.createDataFrame(
        [("a", 1, "Yes"), ("b", 0, "No"), ("c", 2, None)],
        "email string, current_workload int, `can_take_+1_package` string")
    assert by_id(ops.availability(people), "available", key="email") == {"a": True, "b": False, "c": False}
    assert [r.email for r in ops.available(people).collect()] == ["a"]


def test_without_tests_goes_by_the_papers_mark(desk):
    papers = desk.papers({"paper_id": "1", "comments": "[TEST]"}, {"paper_id": "2"},
                         {"paper_id": "3", "comments": "other"})
    rounds = desk.iterations({"paper_id": "1"}, {"paper_id": "2", "comments": "[TEST]"}, {"paper_id": "9"})
    kept, kept_rounds = ops.without_tests(papers, rounds)
    assert sorted(r.paper_id for r in kept.collect()) == ["2", "3"]
    assert sorted(r.paper_id for r in kept_rounds.collect()) == ["2", "9"]


def test_polish_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["can take +1 package", "Email (if applicable)", "paperId", "Paper ID"])
    assert ops.polish_names(df).columns == [
        "can_take_+1_package", "email_(if_applicable)", "paper_id", "paper_id_1"]


def _keys(df):
    return sorted(((r.k, r.j) for r in df.collect()), key=str)


def test_new_rows_and_null_keys(spark):
    schema = "k string, j int"
    batch = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, None), ("c", 3)], schema)
    live = spark.createDataFrame([("a", 1), ("b", None), (None, None), ("a", 1)], schema)
    assert _keys(ops.new_rows(batch, live, ["k", "j"])) == sorted(
        [("b", None), (None, None), ("c", 3)], key=str)
    assert _keys(ops.new_rows(batch, live, ["k", "j"], null_safe=True)) == [("c", 3)]
    # both sides from one frame
    assert ops.new_rows(live, live, ["k", "j"], null_safe=True).count() == 0


def test_append_new_takes_the_latest_of_a_batch(spark):
    schema = "paper_id string, timestamp timestamp_ntz, title string"
    t = lambda h: dt.datetime(2024, 1, 1, h)
    live = spark.createDataFrame([("1", t(0), "held")], schema)
    batch = spark.createDataFrame(
        [("1", t(5), "again"), ("2", t(1), "old"), ("2", t(3), "new"), (None, t(1), "x"), (None, t(2), "y")],
        schema)
    rows = ingest.append_new(live, batch, "paper_id").collect()
    assert sorted((r.paper_id or "-", r.title) for r in rows) == [
        ("-", "x"), ("-", "y"), ("1", "held"), ("2", "new")]
    safe = ingest.append_new(live, batch, "paper_id", null_safe=True).collect()
    assert sorted((r.paper_id or "-", r.title) for r in safe) == [("-", "y"), ("1", "held"), ("2", "new")]


def test_insert_by_name(spark):
    live = spark.createDataFrame([("1", 1, None)], "a string, b int, c date")
    new = spark.createDataFrame([("7", "2")], "b string, a string")
    rows = ops.insert_by_name(live, new)
    assert rows.dtypes == live.dtypes
    assert sorted(map(tuple, rows.collect())) == [("1", 1, None), ("2", 7, None)]
    with pytest.raises(ValueError):
        ops.insert_by_name(live, new.withColumn("z", F.lit(1)))


def test_latest_and_current_rounds(desk):
    rounds = desk.iterations({"paper_id": "1"}, {"paper_id": "1", "round": 3}, {"paper_id": "2", "round": 2},
                             {"paper_id": "2", "round": 2}, {"paper_id": "3", "round": None})
    assert sorted((r.paper_id, r.round) for r in ops.current_rounds(rounds).collect()) == [
        ("1", 3), ("2", 2), ("2", 2)]
    assert by_id(ops.latest_iteration(rounds), "round") == {"1": 3, "2": 2, "3": None}


def test_previous_round_needs_the_number_below(desk):
    rounds = desk.iterations({"paper_id": "1", "replicator1": "a"}, {"paper_id": "1", "round": 2},
                             {"paper_id": "1", "round": 4})
    found = {r.round: r.prev_replicator1 for r in ops.with_previous_round(rounds, ["replicator1"]).collect()}
    assert found == {1: None, 2: "a", 4: None}
    carried = {r.round: r.replicator1 for r in ops.carry_replicators(rounds).collect()}
    assert carried == {1: "a", 2: "a", 4: None}


def test_waiting_rounds_keep_papers_without_rounds(desk):
    papers = desk.papers({"paper_id": "1", "status": "with_author"}, {"paper_id": "2", "status": "new_arrival"},
                         {"paper_id": "3"})
    rounds = desk.iterations({"paper_id": "1"}, {"paper_id": "1", "round": 2}, {"paper_id": "3"})
    rows = ops.waiting_rounds(papers, rounds).select("paper_id", "round").collect()
    assert sorted(((r.paper_id, r.round) for r in rows), key=str) == [("1", 1), ("1", 2), ("2", None)]


def test_reports_with_null_replicator_do_not_differ(desk):
    rounds = desk.iterations(
        {"paper_id": "1", "replicator1": "a", "date_completed_repl": dt.date(2024, 1, 1)},
        {"paper_id": "2", "replicator1": "a", "date_completed_repl": dt.date(2024, 1, 1)},
        {"paper_id": "3", "replicator1": "a"})
    reports = desk.reports({"paper_id": "1"}, {"paper_id": "2", "email_of_replicator_1": "b"},
                           {"paper_id": "3", "email_of_replicator_1": "a"}, {"paper_id": "4"})
    assert sorted(r.paper_id for r in ops.reports_to_process(reports, rounds).collect()) == ["2", "3", "4"]


def test_two_slots_counts_a_person_once(desk):
    rounds = desk.iterations(
        {"paper_id": "1", "replicator1": "a", "replicator2": "a"}, {"paper_id": "2", "replicator2": "b"},
        {"paper_id": "3"})
    assert ops.two_slots(rounds, ["paper_id"]).count() == 3
    once = ops.two_slots(rounds, ["paper_id"], distinct=True).collect()
    assert sorted((r.paper_id, r.slot, r.replicator) for r in once) == [("1", 1, "a"), ("2", 2, "b")]


def test_delete_and_update_leave_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "x string, y int")
    assert ops.delete_where(df, {"x": "a", "y": 1}).count() == 2
    changed = ops.update_where(df, F.col("y") == 1, "x", "z").collect()
    assert sorted(str(r.x) for r in changed) == ["a", "z", "z"]


def test_missing_ids_exists_and_duplicates(spark):
    a = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "k string")
    b = spark.createDataFrame([("2",), ("2",)], "k string")
    assert sorted(str(r.k) for r in ops.missing_ids(a, b, "k").collect()) == ["1", "None"]
    assert by_id(ops.exists_rows(b, a.dropna(), ["k"]), "present", key="k") == {"1": False, "2": True}
    assert {(r.k, r.n_rows) for r in ops.duplicate_keys(a, ["k"]).collect()} == {("1", 2)}


def test_snapshot_choice(spark):
    snaps = spark.createDataFrame(
        [(f"p{i}", f"2024-01-{i:02d}", "papers") for i in range(1, 13)], "path string, snapshot_ts string, kind string")
    assert sorted(r.path for r in ops.expired_snapshots(snaps, 10).collect()) == ["p1", "p2"]
    assert ops.latest_snapshot(snaps, "papers").first().path == "p12"
    assert ops.latest_snapshot(snaps, "none").count() == 0


def test_empty_tables(desk):
    none, rounds = desk.papers(), desk.iterations()
    assert ops.latest_iteration(rounds).count() == 0
    assert ops.update_from_latest(none, rounds).count() == 0
    stats = ops.table_stats({"papers": none}).first()
    assert (stats.n_rows, stats.n_columns) == (0, 34)
    newest = ops.last_modified({"papers": none, "iterations": rounds}).first()
    assert newest.comparison_timestamp is None
