from pathlib import Path
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from galleyproof.plans import recovery, snapshots
from galleyproof.sources import VersionedTables
from galleyproof.sources import files as sources_files
from galleyproof.sources.files import can_copy
from conftest import by_id

LOG = ("operation", "target", "status", "n_rows")


@pytest.fixture
def store(spark, desk, tmp_path):
    store = VersionedTables(spark, f"{tmp_path}/store")
    forms = spark.createDataFrame([("1", None), ("2", "[TEST]"), (None, None)], "paper_id string, comments string")
    store.commit({
        "papers": desk.papers({"paper_id": "1", "github_url": "https://git.example.org/1"}, {"paper_id": "2", "comments": "[TEST]"},
                              {"paper_id": "3", "github_url": ""}),
        "iterations": desk.iterations({"paper_id": "1"}, {"paper_id": "1", "round": 2}, {"paper_id": "3"}),
        "form_arrivals": forms, "reports": desk.reports({"paper_id": "2", "comments": "[TEST]"})}, 0)
    return store


def rows(store, version=None):
    return {n: sorted(str(r.paper_id) for r in t.collect()) for n, t in store.tables(version).items()}


def log(df):
    return [tuple(r[c] for c in LOG) for r in df.collect()]


def test_purge_of_papers(store, desk, tmp_path):
    done = recovery.purge_stored(store, f"{tmp_path}/snaps", "2024-01-01", desk.ids("1", "3", "3", "nowhere"))
    assert log(done) == [
        ("backup", "form_arrivals", "success", 3), ("backup", "iterations", "success", 3),
        ("backup", "papers", "success", 3), ("backup", "reports", "success", 1), ("query", "repos", "success", 1),
        ("delete", "form_arrivals", "success", 1), ("delete", "iterations", "success", 3),
        ("delete", "papers", "success", 2), ("delete", "reports", "success", 0), ("validate", "tables", "success", 4),
        ("validate", "form_arrivals", "success", 2), ("validate", "iterations", "success", 0),
        ("validate", "papers", "success", 1), ("validate", "reports", "success", 1)]
    assert rows(store) == {"papers": ["2"], "iterations": [], "form_arrivals": ["2", "None"], "reports": ["2"]}
    assert store.version() == 2 and rows(store, 1)["papers"] == ["1", "2", "3"]


def test_purge_of_tests(store, tmp_path):
    done = recovery.purge_stored(store, f"{tmp_path}/snaps", "2024-01-01")
    assert rows(store) == {"papers": ["1", "3"], "iterations": ["1", "1", "3"], "form_arrivals": ["1", "None"], "reports": []}
    assert {r.target: r.n_rows for r in done.filter("operation = 'delete'").collect()} == {
        "papers": 1, "iterations": 0, "form_arrivals": 1, "reports": 1}


def test_a_failing_snapshot_leaves_all_tables(store, desk, tmp_path):
    (tmp_path / "taken").write_text("a file where the snapshots should go")
    before = rows(store)
    done = recovery.purge_stored(store, f"{tmp_path}/taken/snaps", "2024-01-01", desk.ids("1"))
    assert log(done) == [("backup", "tables", "error", None)]
    assert rows(store) == before and store.version() == 1


def test_a_snapshot_that_lost_rows_stops_the_purge(store, desk, tmp_path, monkeypatch):
    whole = snapshots.snapshot
    monkeypatch.setattr(snapshots, "snapshot", lambda tables, *a, **k: whole(
        {n: t.limit(1) for n, t in tables.items()}, *a, **k))
    done = recovery.purge_stored(store, f"{tmp_path}/snaps", "2024-01-01", desk.ids("1"))
    assert [r[:3] for r in log(done)] == [("backup", "tables", "error")] and store.version() == 1


def test_an_incomplete_snapshot_stops_the_purge(store, desk, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "write_text_once", lambda *a: False)
    done = recovery.purge_stored(store, f"{tmp_path}/snaps", "2024-01-01", desk.ids("1"))
    assert [r[:3] for r in log(done)] == [("backup", "tables", "error")] and store.version() == 1


def test_another_writer_comes_first(spark, store, desk, tmp_path, monkeypatch):
    plain = recovery.backup

    def slow(tables, *args):
        held = plain(tables, *args)
        store.commit({"reports": store.read("reports")}, store.version())
        return held

    monkeypatch.setattr(recovery, "backup", slow)
    done = recovery.purge_stored(store, f"{tmp_path}/snaps", "2024-01-01", desk.ids("1"))
    assert log(done)[-1][:3] == ("delete", "tables", "error")
    assert rows(store)["papers"] == ["1", "2", "3"]


def test_purged_papers_come_back(spark, store, desk, tmp_path):
    folder = f"{tmp_path}/snaps"
    before = rows(store)
    recovery.purge_stored(store, folder, "2024-01-01", desk.ids("1", "3"))
    papers = store.read("papers").unionByName(desk.papers({"paper_id": "3", "status": "with_author"}))
    store.commit({"papers": papers}, store.version())
    done = recovery.restore_stored(store, folder, desk.ids("1", "3", "9"), "2024-01-02", keep=2)
    found = {(r.table, r.paper_id): (r.action, r.rows) for r in done.collect()}
    assert found["papers", "1"] == ("restored", 1) and found["iterations", "1"] == ("restored", 2)
    assert found["papers", "3"] == ("skip", 1) and found["papers", "9"] == ("skip", 0)
    assert found["papers", None] == ("backup", 2) and found["iterations", None] == ("backup", 0)
    assert rows(store) == before and by_id(store.read("papers"), "status")["3"] == "with_author"
    # a repetition changes nothing; the snapshot it reads is the safety snapshot of the last call
    version = store.version()
    again = recovery.restore_stored(store, folder, desk.ids("1"), "2024-01-03", source_ts="2024-01-01", keep=2)
    assert store.version() == version and {r.action for r in again.collect()} == {"skip", "backup"}
    assert sorted(r.snapshot_ts for r in snapshots.snapshots(spark, folder).collect()) == ["2024-01-02", "2024-01-03"]


def test_restore_needs_a_source_and_a_safety_snapshot(store, desk, tmp_path, monkeypatch):
    with pytest.raises(recovery.BackupFailed):
        recovery.restore_stored(store, f"{tmp_path}/none", desk.ids("1"), "2024-01-02")
    snapshots.snapshot(store.tables(), f"{tmp_path}/snaps", "2024-01-01")
    monkeypatch.setattr(snapshots, "write_text_once", lambda *a: False)
    with pytest.raises(recovery.BackupFailed):
        recovery.restore_stored(store, f"{tmp_path}/snaps", desk.ids("1"), "2024-01-02")
    assert store.version() == 1


def files(df):
    return sorted(Path(unquote(urlparse(f).path)).read_bytes() for f in df.inputFiles())


def test_snapshots_of_stored_tables_are_copies_of_their_files(spark, store, desk, tmp_path):
    store.commit({}, 1, {"papers": desk.papers({"paper_id": "4"}).withColumn("github_url", F.lit("x")).select(store.read("papers").columns)})
    held = recovery.backup(store.tables(), f"{tmp_path}/the snaps", "2024-01-01")
    again = recovery.backup(store.tables(), f"{tmp_path}/the snaps", "2024-01-01")
    assert held == again == {"papers": 4, "iterations": 3, "form_arrivals": 3, "reports": 1}
    found = snapshots.read_tables(spark, f"{tmp_path}/the snaps/snapshot_ts=2024-01-01", list(held))
    for name, table in store.tables().items():
        assert files(found[name]) == files(table) and found[name].schema == table.schema
        assert found[name].exceptAll(table).isEmpty()
    # other frames are written
    snapshots.snapshot({"papers": store.read("papers").filter("paper_id > '1'")}, f"{tmp_path}/the snaps", "2", stored=True)
    assert snapshots.read_tables(spark, f"{tmp_path}/the snaps/snapshot_ts=2", ["papers"])["papers"].count() == 3


def test_what_arrow_cannot_reach_is_written(spark, store, tmp_path, monkeypatch):
    def unknown(path):
        raise pa.ArrowInvalid("Unrecognized filesystem type")

    assert can_copy(spark, store.root)
    monkeypatch.setattr(sources_files, "open_system", unknown)
    assert not can_copy(spark, store.root)
    assert recovery.backup(store.tables(), f"{tmp_path}/snaps", "1") == {"papers": 3, "iterations": 3, "form_arrivals": 3, "reports": 1}


def test_a_copy_that_lost_bytes_is_a_failure(spark, store, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "copy_files", lambda *a: (_ for _ in ()).throw(OSError("a file is short")))
    with pytest.raises(recovery.BackupFailed, match="short"):
        recovery.backup(store.tables(), f"{tmp_path}/snaps", "2024-01-01")


def test_a_restore_writes_only_what_comes_back(store, desk, tmp_path):
    folder = f"{tmp_path}/snaps"
    recovery.purge_stored(store, folder, "2024-01-01", desk.ids("1"))
    live = {n: set(t.inputFiles()) for n, t in store.tables().items()}
    recovery.restore_stored(store, folder, desk.ids("1"), "2024-01-02")
    now = {n: set(t.inputFiles()) for n, t in store.tables().items()}
    assert all(live[n] <= now[n] for n in live) and now["reports"] == live["reports"]
    added = store.spark.read.parquet(*(now["iterations"] - live["iterations"]))
    assert [(r.paper_id, r["round"]) for r in added.orderBy("round").collect()] == [("1", 1), ("1", 2)]
