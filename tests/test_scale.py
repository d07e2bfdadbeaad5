"""What keeps queries linear: views derived once, wide rows that stay in place, many hashing tasks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from galleyproof.operators import is_stored, key_marked, key_rows, reports_to_process, sieve, split_join
from galleyproof.plans import changes, recovery, snapshots
from galleyproof.sources import VersionedTables, file_manifest
from workload import changing, fixtures, landing  # noqa: F401 (registers their queries)
from workload.fixtures import VIEWS, Fixtures
from workload.registry import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def given(spark, tmp_path):
    """Orders and their lines: papers without, with one and with several rounds, and a null key."""
    days = [dt.datetime(2001, 1, 1 + i) for i in range(5)]
    lines = [(key, i, i + 3, 10.0 + i, 0.01, 0.05, 1 + i, "N", "O", days[i])
             for key in (1, 2, 3, 4, 5, 6, 10, 11, None) for i in range((key or 2) % 5)]
    spark.createDataFrame(lines, """l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_tax double,
        l_discount double, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate timestamp""").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, k, "P", days[0]) for k in (1, 2, 3, 4, 5, 6, 7, 10, 11, 12)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp").write.parquet(
        f"{tmp_path}/orders.parquet")
    return Fixtures(spark, str(tmp_path))


def rows(df):
    return sorted(map(str, df.collect()))


def test_views_are_the_same_once_landed(given):
    landed = given.landed("li")
    shared = Fixtures(given.spark, given.sf_dir)
    shared.texts = VIEWS
    for name in ("li", "last_it", "iterations", "papers", "reports"):
        want = rows(getattr(shared, name))
        assert rows(getattr(given, name)) == want and rows(getattr(landed, name)) == want, name
    assert "Window" not in plan(landed.reports) and "Window" not in plan(landed.papers)


@pytest.mark.parametrize("name", ["merge_reports_rounds", "merge_reports_conflicts", "merge_reports_conflicts_rejected"])
def test_lines_are_numbered_once(given, name):
    assert "lineitem" not in plan(QUERIES[name](given))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def table(spark, tmp_path):
    """70,000 rows in two files, so that a file has several bitmaps; null keys, keys that repeat."""
    key = F.when(F.col("id") % 11 > 0, (F.col("id") % 30000).cast("string"))
    spark.range(70000, numPartitions=1).select(key.alias("paper_id"), "id").write.parquet(f"{tmp_path}/t")
    spark.range(9).select(F.col("id").cast("string").alias("paper_id"), "id").write.mode("append").parquet(f"{tmp_path}/t")
    return spark.read.parquet(f"{tmp_path}/t")


@pytest.mark.parametrize("how", ["left_anti", "left_semi"])
def test_rows_by_key_are_those_of_a_join(spark, table, no_broadcast, how):
    keys = spark.range(0, 60000, 7).select(F.col("id").cast("string").alias("paper_id"))
    keys = keys.unionByName(keys).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS paper_id"))
    got = key_rows(table, keys, "paper_id", how)
    want = split_join(table, keys.distinct(), ["paper_id"], how)
    assert got.columns == table.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert key_rows(table.filter("id > 3"), keys, "paper_id", how).count() == want.filter("id > 3").count()
    assert key_rows(table, keys.limit(0), "paper_id", how).count() == (table.count() if how == "left_anti" else 0)


def test_sieve_keeps_every_key_and_few_others(spark, table, no_broadcast):
    keys = spark.range(0, 60000, 7).select(F.col("id").cast("string").alias("paper_id"), F.col("id").alias("id"))
    keys = keys.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS paper_id, NULL AS id"))
    for on in (["paper_id"], ["paper_id", "id"]):
        left, want = sieve(table, keys, on), table.join(keys.select(on), on, "left_semi")
        assert left.columns == table.columns and want.exceptAll(left).isEmpty() and not want.isEmpty()
        assert left.filter("paper_id IS NOT NULL").count() < want.count() + 200
    assert sieve(table, keys.limit(0), ["id"]).isEmpty()


def test_marks_are_those_of_a_join(spark, table, tmp_path, no_broadcast):
    keys = spark.range(0, 60000, 7).select(F.col("id").cast("string").alias("paper_id"), F.col("id").cast("int").alias("id"))
    keys = keys.unionByName(keys).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS paper_id, 0 AS id"))
    plain = table.filter("true").repartition(3)
    assert is_stored(table) and not is_stored(plain)
    for on in (["paper_id"], ["paper_id", "id"]):
        want = key_marked(plain, keys, on, "met")
        assert want.filter("met").exceptAll(table.join(keys, on, "left_semi").selectExpr("*", "true")).isEmpty()
        for folder in (None, f"{tmp_path}/bits{len(on)}"):
            got = key_marked(table, keys, on, "met", folder)
            assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_only_parquet_rows_have_a_place(spark, table, tmp_path):
    table.limit(5).write.csv(f"{tmp_path}/csv")
    table.limit(5).write.json(f"{tmp_path}/json")
    for df in (spark.read.csv(f"{tmp_path}/csv"), spark.read.json(f"{tmp_path}/json"), spark.range(3),
               table.union(spark.createDataFrame([], table.schema))):
        assert not is_stored(df) and key_rows(df, df.limit(1), df.columns[0], "left_semi").columns == df.columns


def _papers_and_rounds(desk):
    """Papers to send back with one and with several rounds, with a round twice, without their round; a paper
    twice; null keys; papers in other states."""
    back = {"status": "replicator_back_de", "title": "wide"}
    papers = desk.papers(
        {"paper_id": "1"} | back, {"paper_id": "2", "round": 2} | back, {"paper_id": "3"} | back,
        {"paper_id": "4", "round": 9} | back, {"paper_id": "5"} | back, {"paper_id": "5", "title": "twice"},
        {"paper_id": None} | back, {"paper_id": "6", "round": None} | back, {"paper_id": "7", "status": "with_author"})
    row = {"repl_comments": "wide", "replicator1": "a", "file_request_id_pkg": "p"}
    rounds = desk.iterations(*[{"paper_id": p, "round": r} | row for p, r in (
        ("1", 1), ("2", 1), ("2", 2), ("2", 3), ("3", 1), ("3", 1), ("5", 1), ("6", None), ("7", 1), (None, 1), ("8", 1))])
    return papers, rounds


@pytest.mark.parametrize("fresh", [False, True])
def test_revising_stored_tables_moves_keys_and_rows_sent_back(spark, desk, tmp_path, no_broadcast, fresh):
    plain = _papers_and_rounds(desk)
    stored = []
    for name, df in zip(("p", "i"), plain):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        stored.append(spark.read.parquet(f"{tmp_path}/{name}"))
    asked = desk.ids("1", "2", "3", "4", "5", "6", "7", "8", "1", None)
    ids = spark.createDataFrame([("1", "fresh"), ("3", None)], "paper_id string, file_request_id_pkg string") if fresh else None
    want, got = (changes.revise(*tables, asked, dt.date(2024, 6, 30), ids) for tables in (plain, stored))
    assert [rows(df) for df in got] == [rows(df) for df in want]
    assert [df.columns for df in got] == [df.columns for df in want]
    assert got[0].filter("status = 'with_author'").count() == 7 and got[1].count() == 11 + 5
    moved = plan(got[1]).split("Exchange hashpartitioning")[1:]
    assert not any("repl_comments" in m for m in moved)
    # of papers only those sent back meet the rounds opened; the others are read beside the bitmaps
    assert plan(got[0].select("*")).count("Union") == 1
    assert not fresh or rows(got[1].filter("file_request_id_pkg = 'fresh'").select("paper_id")) == ["Row(paper_id='1')"]


def test_landed_views_have_files_of_few_rows(given, monkeypatch):
    monkeypatch.setattr(fixtures, "LANDED_ROWS", 3)
    landed = given.landed("li").iterations
    sizes = landed.groupBy(F.input_file_name()).count().collect()
    assert len(sizes) > 2 and max(r["count"] for r in sizes) <= 3 and rows(landed) == rows(given.iterations)


def test_purge_and_restore_shuffle_keys_only(spark, desk, tmp_path, no_broadcast):
    desk.iterations({"paper_id": "1", "repl_comments": "x"}).write.parquet(f"{tmp_path}/i")
    stored, ids = spark.read.parquet(f"{tmp_path}/i"), desk.ids("1", "2")
    kept = changes.purge({"iterations": stored}, ids, stored=True)[0]["iterations"]
    state = snapshots.landed_state({"iterations": stored}, {"iterations": stored}, ids)
    back = snapshots.restored({"iterations": stored}, {"iterations": stored}, state)["iterations"]
    for df in (kept, back):
        moved = df._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")[1:]
        assert moved and not any("repl_comments" in m for m in moved)


def test_purged_ids_are_derived_once(spark, desk, tmp_path, monkeypatch):
    store = VersionedTables(spark, f"{tmp_path}/store")
    store.commit({"papers": desk.papers({"paper_id": "1"}, {"paper_id": "2"})}, 0)
    seen = []
    monkeypatch.setattr(changes, "purge", lambda tables, ids, stored, whole=changes.purge: seen.append(ids) or whole(tables, ids, stored))
    recovery.purge_stored(store, f"{tmp_path}/snaps", "1", desk.ids("1").join(desk.ids("1", "3"), "paper_id"))
    assert "Join" not in plan(seen[0]) and [r.paper_id for r in store.read("papers").collect()] == ["2"]


def test_stored_tables_and_snapshots_are_packed_by_zstd(spark, desk, tmp_path):
    store = VersionedTables(spark, f"{tmp_path}/store")
    store.commit({"papers": desk.papers({"paper_id": "1"})}, 0)
    snapshots.snapshot(store.tables(), f"{tmp_path}/snaps", "1")
    assert list(tmp_path.glob("store/data/*/papers/*.zstd.parquet"))
    assert list(tmp_path.glob("snaps/*/papers/*.zstd.parquet"))


def test_files_are_hashed_by_many_tasks(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "f").write_text(str(i))
    found = file_manifest(spark, str(tmp_path))
    places = found.select("path", F.spark_partition_id().alias("p")).collect()
    assert len(places) == 40 and len({r.p for r in places}) > 3


def test_pages_land_as_a_partitioned_write_lands_them(spark, tmp_path):
    pages = [(2, "b"), (1, "ä\nb"), (None, "x"), (2, "again"), (3, None), (4, "")]
    spark.createDataFrame(pages, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    spark.read.parquet(f"{tmp_path}/pages.parquet").coalesce(1).write.partitionBy("page_id").text(f"{tmp_path}/plain")
    plain = file_manifest(spark, f"{tmp_path}/plain").filter("startswith(basename, 'part-')")
    want = plain.select(F.split_part("path", F.lit("/"), F.lit(1)).alias("folder"), "size", "md5")
    got = QUERIES["file_manifest"](Fixtures(spark, str(tmp_path)))
    assert rows(got) == rows(want) and got.count() == 5


def test_reports_without_round_bypass_the_join(spark, desk, tmp_path, no_broadcast):
    desk.reports({"paper_id": "1"}, {"paper_id": "1", "round": None}, {"paper_id": None}).write.parquet(f"{tmp_path}/r")
    desk.iterations({"paper_id": "1"}, {"paper_id": "1"}).write.parquet(f"{tmp_path}/i")
    found = reports_to_process(spark.read.parquet(f"{tmp_path}/r"), spark.read.parquet(f"{tmp_path}/i"))
    assert plan(found).splitlines()[1].endswith("Union")
    assert sorted((str(r.paper_id), str(r.round)) for r in found.collect()) == [
        ("1", "1"), ("1", "1"), ("1", "None"), ("None", "1")]
