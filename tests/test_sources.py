import datetime as dt
import hashlib
import json
from urllib.parse import unquote

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from galleyproof import schemas
from galleyproof.plans import packages, snapshots
from galleyproof.session import scratch_folder
from galleyproof.sources import (
    StaleVersion, VersionedTables, append_csv, catalog_listing, catalog_tables, describe, empty, export_csv, file_manifest,
    non_empty, read_articles, read_datasets, read_snapshot, replace_table, table_or_none, write_bucketed,
)
from galleyproof.sources.files import write_text_once


def test_csv_keeps_leading_zeros_and_commas(spark, tmp_path):
    rows = spark.createDataFrame([("007", 'a "b", c', None), ("8", None, dt.date(2024, 1, 2))],
                                 "paper_id string, title string, day date")
    export_csv(rows, f"{tmp_path}/t")
    append_csv(rows.limit(1), f"{tmp_path}/t")
    back = read_snapshot(spark, f"{tmp_path}/t", rows.schema).collect()
    assert sorted(tuple(r) for r in back if r.paper_id == "8") == [("8", None, dt.date(2024, 1, 2))]
    assert [r.title for r in back if r.paper_id == "007"] == ['a "b", c'] * 2


def test_tables(spark, tmp_path):
    assert empty(spark, "iterations").schema == schemas.ITERATIONS
    assert len(schemas.PAPERS) == 34
    replace_table(spark.range(3), str(tmp_path), "numbers")
    assert non_empty(table_or_none(spark, str(tmp_path), "numbers"))
    assert not non_empty(table_or_none(spark, str(tmp_path), "absent"))
    spark.range(2).createOrReplaceTempView("two_rows")
    assert catalog_tables(spark)["two_rows"].count() == 2
    assert describe(spark.range(1)).first().column_type == "bigint"


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    rows = spark.range(1000).withColumn("paper_id", F.col("id").cast("string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bucketed_a", "bucketed_b"):
            write_bucketed(rows, name, 4, ["paper_id"])
        joined = spark.table("bucketed_a").join(spark.table("bucketed_b"), "paper_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000
    finally:
        for name in ("bucketed_a", "bucketed_b"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_versions_change_together(spark, tmp_path):
    store = VersionedTables(spark, f"{tmp_path}/store")
    assert store.tables() == {}
    assert store.commit({"a": spark.range(1), "b": spark.range(2)}, 0) == 1
    # a plan over the present version may replace it
    assert store.commit({"a": store.read("a").union(store.read("b"))}, 1) == 2
    assert {n: t.count() for n, t in store.tables().items()} == {"a": 3, "b": 2}
    assert store.read("a", version=1).count() == 1


def test_of_two_writers_one_fails(spark, tmp_path):
    store, other = (VersionedTables(spark, f"{tmp_path}/store") for _ in range(2))
    store.commit({"a": spark.range(1)}, 0)
    base = store.version()
    ours, theirs = store.read("a"), other.read("a")
    assert store.commit({"a": ours.union(spark.range(5, 6))}, base) == 2
    with pytest.raises(StaleVersion):
        other.commit({"a": theirs.union(spark.range(7, 8))}, base)
    assert {r.id for r in store.read("a").collect()} == {0, 5} and store.read("a", 1).count() == 1
    with pytest.raises(StaleVersion):
        store.commit({"a": spark.range(1)}, 0)


def test_rows_are_added_without_writing_the_table_again(spark, tmp_path):
    store = VersionedTables(spark, f"{tmp_path}/a store")
    store.commit({"a": spark.range(3), "b": spark.range(2)}, 0)
    held = set(store.read("a").inputFiles())
    assert store.commit({"b": spark.range(9)}, 1, {"a": spark.range(7, 9)}) == 2
    assert sorted(r.id for r in store.read("a").collect()) == [0, 1, 2, 7, 8] and store.read("b").count() == 9
    added = [unquote(f) for f in set(store.read("a").inputFiles()) - held]
    assert held < set(store.read("a").inputFiles()) and spark.read.parquet(*added).count() == 2
    assert store.read("a", 1).count() == 3
    for changed, rows in (({}, spark.range(1).toDF("x")), ({"a": spark.range(1)}, spark.range(1))):
        with pytest.raises(ValueError):
            store.commit(changed, 2, {"a": rows})
    assert store.commit({"a": spark.range(1)}, 2) == 3 and store.read("a").count() == 1


def test_manifests_with_one_folder_per_table_are_read(spark, tmp_path):
    store = VersionedTables(spark, f"{tmp_path}/store")
    store.commit({"a": spark.range(3)}, 0)
    told = {n: folders[0] for n, folders in store._folders().items()}
    assert write_text_once(spark, store._manifest(2), json.dumps(told)) and store.read("a").count() == 3
    store.commit({}, 2, {"a": spark.range(1)})
    assert store.tables()["a"].count() == 4


def test_a_taken_number_fails_and_half_a_manifest_is_not_seen(spark, tmp_path):
    store = VersionedTables(spark, f"{tmp_path}/store")
    store.commit({"a": spark.range(1)}, 0)
    # a writer that died before renaming its manifest
    (tmp_path / "store" / "manifests" / "00000002.json.dead.tmp").write_text("{")
    assert store.version() == 1 and store.read("a").count() == 1
    assert write_text_once(spark, store._manifest(2), json.dumps(store._folders()))
    assert not write_text_once(spark, store._manifest(2), "{}")
    assert store.version() == 2 and store.read("a").count() == 1
    assert len(list((tmp_path / "store" / "manifests").glob("*.tmp"))) == 1


def test_repeated_commits_count_up(spark, tmp_path):
    store = VersionedTables(spark, f"{tmp_path}/store")
    row = lambda i: spark.createDataFrame([(i,)], "id int")
    store.commit({"stress": row(0)}, 0)
    for i in range(1, 6):
        store.commit({"stress": store.read("stress").union(row(i))}, i)
        assert store.read("stress").count() == i + 1


def test_snapshots_keep_the_newest(spark, tmp_path):
    base = f"{tmp_path}/snaps"
    for day in range(1, 5):
        gone = snapshots.snapshot({"papers": spark.range(day)}, base, f"2024-01-0{day}", keep=2)
    assert [g.rsplit("=", 1)[1] for g in gone] == ["2024-01-02"]
    held = sorted(r.path for r in snapshots.snapshots(spark, base).collect())
    assert [h.rsplit("=", 1)[1] for h in held] == ["2024-01-03", "2024-01-04"]
    tables = snapshots.read_tables(spark, held[-1], ["papers", "reports"])
    assert list(tables) == ["papers"] and tables["papers"].count() == 4


def test_a_snapshot_cut_short_is_not_listed(spark, tmp_path):
    base = f"{tmp_path}/snaps"
    snapshots.snapshot({"papers": spark.range(3)}, base, "2024-01-01", keep=2)
    spark.range(9).write.parquet(f"{base}/snapshot_ts=2024-01-02/papers")
    assert [r.snapshot_ts for r in snapshots.snapshots(spark, base).collect()] == ["2024-01-01"]
    assert snapshots.snapshot({"papers": spark.range(4)}, base, "2024-01-03", keep=2) == []


def test_scratch_uses_the_shared_folder(tmp_path):
    class Cluster:
        conf = {"spark.checkpoint.dir": f"{tmp_path}/"}

    class Laptop:
        conf = {"spark.master": "local[2]"}

    class Unset:
        conf = {"spark.master": "spark://host:7077"}

    assert scratch_folder(Cluster, "x").startswith(f"{tmp_path}/x-")
    assert scratch_folder(Cluster, "x") != scratch_folder(Cluster, "x")
    assert not scratch_folder(Laptop, "x", local=True).startswith(str(tmp_path))
    for session, local in ((Laptop, False), (Unset, True)):
        with pytest.raises(ValueError):
            scratch_folder(session, "x", local=local)


def test_file_manifest_skips(spark, tmp_path):
    root = tmp_path / "pkg"
    for name in ("a.txt", "top.zip", "sub/inner.zip", "sub/b.txt", "__MACOSX/x", ".git/config", "sub/.h/y"):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(name.encode())
    rows = {r.path: r for r in file_manifest(spark, str(root)).collect()}
    assert sorted(rows) == ["a.txt", "sub/b.txt", "sub/inner.zip"]
    assert rows["sub/b.txt"].md5 == hashlib.md5(b"sub/b.txt").hexdigest()
    assert (rows["sub/b.txt"].basename, rows["a.txt"].size) == ("b.txt", 5)


def test_file_manifest_never_opens_what_it_skips(spark, tmp_path):
    """Skipped entries are links to nowhere, which can't be opened; odd names and sizes are hashed."""
    root = tmp_path / "odd räum%20 +"
    files = {"a.txt": b"a", "empty": b"", "big one.bin": bytes(range(256)) * 40000, "sub/ö #1.txt": b"x" * 30,
             "sub/.hidden": b"h", "_under/_score": b"u", "sub/deep/er/inner.zip": b"z"}
    for name, content in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    for name in ("top.zip", "__MACOSX/x", "sub/.h/deep/y", "s__MACOSX/y"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).symlink_to(tmp_path / "nowhere")
    rows = {r.path: r for r in file_manifest(spark, f"{root}/").collect()}
    assert {p: (r.size, r.md5) for p, r in rows.items()} == {
        p: (len(c), hashlib.md5(c).hexdigest()) for p, c in files.items()}
    assert rows["big one.bin"].basename == "big one.bin"
    (tmp_path / "bare").mkdir()
    assert file_manifest(spark, f"{tmp_path}/bare").count() == 0


def test_large_files_are_hashed_in_pieces(spark, tmp_path, monkeypatch):
    from galleyproof.sources import files

    sizes = []
    whole = files.open_system

    class Spy:
        def __init__(self, stream):
            self.stream = stream

        def read(self, n):
            sizes.append(n)
            return self.stream.read(n)

        def __enter__(self):
            return self

        def __exit__(self, *error):
            self.stream.close()

    class System:
        def __init__(self, system):
            self.system = system

        def open_input_stream(self, path):
            return Spy(self.system.open_input_stream(path))

    monkeypatch.setattr(files, "CHUNK", 100)
    monkeypatch.setattr(files, "open_system", lambda p: (System(whole(p)[0]), whole(p)[1]))
    (tmp_path / "f").write_bytes(b"0123456789" * 55)
    batch = pa.record_batch([pa.array([f"file:{tmp_path}/f"]), pa.array([550])], names=["path", "size"])
    out = list(files._running_md5(iter([batch])))[0]
    assert out.column("md5").to_pylist() == [hashlib.md5(b"0123456789" * 55).hexdigest()]
    assert set(sizes) == {100} and len(sizes) == 7


def test_article_order_over_files_and_splits(spark, tmp_path):
    def record(i):
        author = [{"family": "Doe"}] if i % 5 else []
        return json.dumps({"DOI": f"10.1/{i}", "title": [f"T {i}"], "author": author, "published": {"date-parts": [[2023]]}})

    (tmp_path / "articles").mkdir()
    for part, span in enumerate([range(0, 40), range(40, 41), range(41, 100)]):
        (tmp_path / "articles" / f"page-{part}.json").write_text("\n".join(map(record, span)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = read_articles(spark, f"{tmp_path}/articles", f"{tmp_path}/scratch").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.doi: r.article_index for r in found} == {f"10.1/{i}": i for i in range(100) if i % 5}


def test_catalog_listing(spark, tmp_path):
    spark.range(50).repartition(3).write.parquet(f"{tmp_path}/t")
    spark.read.parquet(f"{tmp_path}/t").createOrReplaceTempView("shelf_stored")
    spark.range(5).selectExpr("id", "id * 2 AS b").createOrReplaceTempView("shelf_view")
    spark.range(7).write.mode("overwrite").saveAsTable("shelf_saved")
    spark.createDataFrame([], "id int, b int").write.parquet(f"{tmp_path}/none")
    spark.read.parquet(f"{tmp_path}/none").createOrReplaceTempView("shelf_empty")
    try:
        rows = {r.table_name: tuple(r)[1:] for r in catalog_listing(spark, "shelf_*").collect()}
    finally:
        spark.sql("DROP TABLE shelf_saved")
    size = sum(p.stat().st_size for p in (tmp_path / "t").glob("*.parquet"))
    assert rows["shelf_stored"] == (50, size, 1, True)
    assert rows["shelf_view"] == (5, None, 2, True) and rows["shelf_empty"][0] == 0
    assert rows["shelf_saved"][0] == 7 and rows["shelf_saved"][1] > 0 and rows["shelf_saved"][3] is False
    assert catalog_listing(spark, "no_such_*").count() == 0


def test_landed_json(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({
        "global_id": "doi:1", "name": "N", "authors": ["Doe, J"], "publicationStatuses": ["Published"],
        "files": [{"dataFile": {"filename": "f", "filesize": 2**21, "md5": "m"}},
                  {"dataFile": {"filename": "g", "md5": "n"}}]}) + "\n" + json.dumps({"global_id": "doi:2"}))
    sets = read_datasets(spark, f"{tmp_path}/d.json")
    assert {(r.filename, r.filesize) for r in packages.dataset_files(sets).collect()} == {("f", 2**21), ("g", None)}
    assert {r.global_id: r.size_mb for r in packages.dataset_sizes(sets).collect()} == {"doi:1": 2.0, "doi:2": 0.0}
    items = [
        {"DOI": "10.1/a", "title": ["A"], "author": [{"family": "Doe"}, {}], "published": {"date-parts": [[2023, 12]]}},
        {"DOI": "10.1/b", "title": ["Front Matter"], "published": {"date-parts": [[2023]]}},
        {"DOI": "10.1/c", "title": ["C"], "author": [{"family": "X"}], "published": {"date-parts": [[None]]}}]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, items)))
    rows = read_articles(spark, f"{tmp_path}/a.json").collect()
    assert [r.article_index for r in rows] == [0]
    assert [(r.doi, r.pub_date, r.authors) for r in rows] == [("10.1/a", dt.date(2023, 12, 1), ["doe", ""])]


def test_reconcile_outcomes(spark):
    local = spark.createDataFrame([("d/a", "1"), ("d/b", "2"), ("d/c", "3"), ("b/copy", "2")], "path string, md5 string")
    remote = spark.createDataFrame([("a", "1"), ("b", "2"), ("x", "9")], "filename string, md5 string")
    rows = {r.md5: (r.outcome, r.local_path) for r in packages.reconcile(local, remote).collect()}
    assert rows == {"1": ("matched", "d/a"), "2": ("name_differs", "b/copy"), "3": ("only_local", "d/c"),
                    "9": ("only_remote", None)}


def test_retention_goes_by_directory(spark):
    files = spark.createDataFrame([("r/preserve-docs/a", 1), ("r/x/my_thirdparty/b/c", 1), ("r/preserve.txt", 1), ("d", 1)],
                                  "path string, size long")
    assert {r.path: r.action for r in packages.retention_plan(files).collect()} == {
        "r/preserve-docs/a": "keep", "r/x/my_thirdparty/b/c": "keep", "r/preserve.txt": "delete", "d": "delete"}
