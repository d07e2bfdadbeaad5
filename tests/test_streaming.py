import datetime as dt

from pyspark.sql import functions as F

from galleyproof.plans import reports
from galleyproof.streaming import apply_arrivals, ingest_forms, record_arrivals
from conftest import AS_OF, by_id

FORM = "timestamp timestamp_ntz, paper_id string, title string"


def at(hour, day=1):
    return dt.datetime(2024, 1, day, hour)


def test_forms_land_once_over_restarts(spark, tmp_path):
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))

    def run(rows):
        spark.createDataFrame(rows, FORM).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(FORM).parquet(source)
        ingest_forms(stream, lambda df: df.filter("title IS NOT NULL"), target, state, ["paper_id"]).awaitTermination()
        return sorted((r.paper_id, r.title) for r in spark.read.parquet(target).collect())

    first = run([(at(1), "1", "old"), (at(2), "1", "new"), (at(2), "1", "new"), (at(3), "2", "b"), (at(3), "3", None)])
    assert first == [("1", "new"), ("2", "b")]
    # a key held already stays as it is; a delivery repeated within the delay is dropped
    second = run([(at(4), "1", "later"), (at(3), "2", "b"), (at(5), "4", "d")])
    assert second == [("1", "new"), ("2", "b"), ("4", "d")]
    # what is older than the watermark is late
    assert run([(at(1), "5", "late"), (at(6), "6", "f")]) == [("1", "new"), ("2", "b"), ("4", "d"), ("6", "f")]


def test_a_batch_reads_no_batch_before(spark, tmp_path, monkeypatch):
    """Results are the same if what has landed is out of reach."""
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))

    def run(rows):
        spark.createDataFrame(rows, FORM).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(FORM).parquet(source)
        ingest_forms(stream, lambda df: df, target, state, ["paper_id"]).awaitTermination()

    held = []
    for hour in range(1, 6):
        run([(at(hour), "same", f"{hour}"), (at(hour), str(hour), "own"), (at(hour), None, "no key")])
        held += [(r.paper_id, r.title) for r in spark.read.parquet(target).collect()]
        for part in (tmp_path / "out").iterdir():
            part.rename(tmp_path / f"moved-{hour}-{part.name}")
        (tmp_path / "out").rmdir()
    assert sorted(held, key=repr) == sorted(
        [("same", "1"), *[(str(h), "own") for h in range(1, 6)], *[(None, "no key")] * 5], key=repr)


def test_a_repeated_batch_lands_once(spark, tmp_path):
    """The commit of a batch is lost, so Spark runs it again over the state it left."""
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))

    def run():
        stream = spark.readStream.schema(FORM).parquet(source)
        ingest_forms(stream, lambda df: df, target, state, ["paper_id"]).awaitTermination()
        return sorted((r.paper_id, r.title) for r in spark.read.parquet(target).collect())

    spark.createDataFrame([(at(1), "1", "a"), (at(2), "1", "b")], FORM).write.parquet(source)
    assert run() == [("1", "b")]
    for log in (tmp_path / "state" / "commits").glob("*"):
        log.unlink()
    for part in (tmp_path / "out").glob("*/*"):
        part.unlink()
    assert run() == [("1", "b")]


def test_late_uploads_go_to_the_next_check(spark, desk, tmp_path):
    source, schema = f"{tmp_path}/in", "paper_id string, kind string, file_count long, ts timestamp_ntz"
    papers = desk.papers(*[{"paper_id": p, "status": "with_author"} for p in "123"])
    rounds = desk.iterations(*[{"paper_id": p} for p in "123"])

    def run(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        record_arrivals(stream, papers, f"{tmp_path}/ledger", f"{tmp_path}/state").awaitTermination()

    run(("1", "package", 1, at(1, 9)))
    run(("2", "package", 2, at(1, 2)), ("2", "package", 3, at(2, 2)), ("3", "paper", 1, at(1, 2)), ("1", "package", 1, at(3, 9)))
    run(("2", "package", 1, at(5, 2)), ("3", "package", 1, at(20, 8)))
    late = spark.read.parquet(f"{tmp_path}/ledger-late")
    assert [tuple(r)[:4] for r in late.collect()] == [("2", "package", 3, at(2, 2))]
    ledger = spark.read.parquet(f"{tmp_path}/ledger")
    assert sorted((r.paper_id, r.arrived.day) for r in ledger.collect()) == [("1", 9), ("3", 8)]
    nothing = spark.createDataFrame([], schema)
    check, remind = reports.arrivals_check(papers, rounds, nothing, late)
    assert by_id(check, "package_arrived") == {"1": False, "2": True, "3": False}
    assert [r.paper_id for r in remind.collect()] == ["2"]


def test_arrivals_ledger(spark, desk, tmp_path):
    source = f"{tmp_path}/in"
    spark.createDataFrame(
        [("1", "package", 1, at(1, 3)), ("1", "package", 2, at(5, 2)), ("2", "paper", 1, at(1)),
         ("3", "package", 1, at(1)), ("4", "package", 0, at(1)), ("4", "package", 1, at(9))],
        "paper_id string, kind string, file_count long, ts timestamp_ntz").write.parquet(source)
    papers = desk.papers({"paper_id": "1", "status": "with_author", "round": 2}, {"paper_id": "2", "status": "with_author"},
                         {"paper_id": "3"}, {"paper_id": "4", "status": "with_author"})
    rounds = desk.iterations({"paper_id": "1"}, {"paper_id": "1", "round": 2}, {"paper_id": "2"}, {"paper_id": "3"}, {"paper_id": "4"})
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    record_arrivals(stream, papers, f"{tmp_path}/ledger", f"{tmp_path}/state").awaitTermination()
    ledger = spark.read.parquet(f"{tmp_path}/ledger")
    moved, dated, rejected = apply_arrivals(papers, rounds, ledger, AS_OF)
    assert by_id(moved, "status") == {"1": "author_back_de", "2": "with_author", "3": "author_back_de", "4": "author_back_de"}
    found = {(r.paper_id, r.round): r.date_arrived_from_authors for r in dated.filter(F.col("date_arrived_from_authors").isNotNull()).collect()}
    assert found == {("1", 2): dt.date(2024, 1, 2), ("4", 1): dt.date(2024, 1, 1)}
    assert rejected.count() == 0
