"""Snapshots of tables, retention and restore."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import expired_snapshots, insert_by_name, is_stored, key_rows, sieve, split_join
from ..session import scratch_folder
from ..sources.files import can_copy, copy_files, delete_folder, list_files, list_folders, write_text_once

FOLDER = "snapshot_ts="
COMPLETE = "complete.txt"


def snapshot(
    tables: Mapping[str, DataFrame], path: str, ts: str, keep: int | None = 10, stored: bool = False
) -> list[str]:
    """Write every table under ``path/snapshot_ts=<ts>``, then drop all but the newest ``keep``
    (None: drop none).

    Of ``stored`` tables, whose files all have the table's columns, the files are copied as they
    are, without decoding their rows.

    ``ts`` sorts as text, as in ``2024-05-31_18-00-00``. A marker is written last: a snapshot that
    was cut short has none, isn't listed and doesn't count for ``keep``. Returns the dropped
    snapshots' paths.
    """
    spark = next(iter(tables.values())).sparkSession
    folder = f"{path}/{FOLDER}{ts}"
    delete_folder(spark, f"{folder}/{COMPLETE}")  # of an earlier write under the same time
    for name, df in tables.items():
        files = df.inputFiles() if stored and is_stored(df) else []
        if files and can_copy(spark, files[0], folder):
            delete_folder(spark, f"{folder}/{name}")
            copy_files(spark, files, f"{folder}/{name}")
        else:
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")
    write_text_once(spark, f"{folder}/{COMPLETE}", " ".join(sorted(tables)))
    return [] if keep is None else prune(spark, path, keep)


def prune(spark: SparkSession, path: str, keep: int = 10) -> list[str]:
    """Drop all but the newest ``keep`` complete snapshots and return the dropped ones' paths."""
    gone = [row.path for row in expired_snapshots(snapshots(spark, path), keep).toLocalIterator()]
    for folder in gone:
        delete_folder(spark, folder)
    return gone


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The complete snapshots under a path as (path, snapshot_ts)."""
    rows = [
        (folder, folder.rsplit(FOLDER, 1)[1])
        for folder in list_folders(spark, path)
        if FOLDER in folder and any(f.endswith(f"/{COMPLETE}") for f in list_files(spark, folder))
    ]
    return spark.createDataFrame(rows, "path string, snapshot_ts string")


def read_tables(spark: SparkSession, snapshot_path: str, names: list[str]) -> dict[str, DataFrame]:
    """Tables of one snapshot; those it does not hold are left out."""
    held = {folder.rsplit("/", 1)[1] for folder in list_folders(spark, snapshot_path)}
    return {n: spark.read.parquet(f"{snapshot_path}/{n}") for n in names if n in held}


def restore_state(live: Mapping[str, DataFrame], snap: Mapping[str, DataFrame], ids: DataFrame) -> DataFrame:
    """Rows of each wanted paper in each live table and in the snapshot: table, paper_id, n_live,
    n_snap. All tables are counted by one aggregate, for which they send their keys only; of stored
    tables only those that pass a `sieve`."""
    wanted = ids.select("paper_id").distinct()

    def keys(df: DataFrame) -> DataFrame:
        return sieve(df.select("paper_id"), wanted, ["paper_id"]) if is_stored(df) else df.select("paper_id")

    sides = [
        split_join(keys(df), wanted, ["paper_id"], "left_semi").select(
            F.lit(name).alias("table"), "paper_id", F.lit(one).alias("n_live"), F.lit(1 - one).alias("n_snap"))
        for one, tables in ((1, live), (0, snap)) for name, df in tables.items() if name in live]
    counts = reduce(DataFrame.unionByName, sides).groupBy("table", "paper_id").agg(*[
        F.sum(c).cast("bigint").alias(c) for c in ("n_live", "n_snap")])
    rows = wanted.select(F.explode(F.array(*[F.lit(n) for n in live])).alias("table"), "paper_id")
    return rows.join(counts, ["table", "paper_id"], "left").na.fill(0, ["n_live", "n_snap"])


def landed_state(live: Mapping[str, DataFrame], snap: Mapping[str, DataFrame], ids: DataFrame) -> DataFrame:
    """``restore_state``, written to the scratch folder and read back.

    So are the wanted papers before: Spark then knows how few they are and needn't shuffle the
    tables to cut them.
    """
    spark = ids.sparkSession
    folder = scratch_folder(spark, "restore", local=True)
    ids.select("paper_id").distinct().write.parquet(f"{folder}/wanted")
    state = restore_state(live, snap, spark.read.schema("paper_id string").parquet(f"{folder}/wanted"))
    state.write.parquet(f"{folder}/state")
    return spark.read.schema(state.schema).parquet(f"{folder}/state")


def absent_rows(
    live: Mapping[str, DataFrame], snap: Mapping[str, DataFrame], state: DataFrame
) -> dict[str, DataFrame]:
    """The snapshot's rows of the papers that ``state`` finds absent from the live tables."""
    out = {}
    for name in live.keys() & snap.keys():
        absent = state.filter((F.col("table") == name) & (F.col("n_live") == 0) & (F.col("n_snap") > 0))
        rows = key_rows(snap[name], absent.select("paper_id"), "paper_id", "left_semi")
        out[name] = rows.select(*[c for c in rows.columns if c in live[name].columns])
    return out


def restored(
    live: Mapping[str, DataFrame], snap: Mapping[str, DataFrame], state: DataFrame
) -> dict[str, DataFrame]:
    """Live tables with the snapshot's rows of the papers that ``state`` finds absent from them."""
    return dict(live) | {n: insert_by_name(live[n], rows) for n, rows in absent_rows(live, snap, state).items()}


def restore_log(snap: Mapping[str, DataFrame], state: DataFrame) -> DataFrame:
    """What ``state`` lets happen to each paper in each table: table, paper_id, action, rows, detail."""
    kept = F.col("table").isin(*snap)
    back, held = F.col("n_snap") > 0, F.col("n_live") > 0
    return state.select(
        "table", "paper_id", F.when(kept & back & ~held, "restored").otherwise("skip").alias("action"),
        F.when(~kept | ~back, 0).when(held, F.col("n_live")).otherwise(F.col("n_snap")).cast("bigint").alias("rows"),
        F.when(~kept, "no snapshot found").when(~back, "paper_id not found in snapshot")
        .when(held, "paper_id already present in live table").otherwise("inserted from snapshot").alias("detail"))


def restore(
    live: Mapping[str, DataFrame], snap: Mapping[str, DataFrame], ids: DataFrame
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Papers brought back from a snapshot, table by table, where the live table has no row of
    them. Columns are matched by name. What the tables hold of the papers is counted once, at the
    call, and lands in the scratch folder. Returns (tables, log of table, paper_id, action, rows)."""
    state = landed_state(live, snap, ids)
    return restored(live, snap, state), restore_log(snap, state)


def refill(
    live: Mapping[str, DataFrame | None], snap: Mapping[str, DataFrame]
) -> tuple[dict[str, DataFrame], list[tuple[str, str, str]]]:
    """Missing or empty tables taken from a snapshot; others are left alone. Returns (tables,
    actions) with actions as (table, action, result)."""
    tables, actions = {}, []
    for name, table in live.items():
        if name not in snap:
            actions.append((name, "find_backup", "no backup found"))
        elif table is None:
            tables[name] = snap[name]
            actions.append((name, "create_from_backup", "success"))
            continue
        elif table.isEmpty():
            tables[name] = insert_by_name(table, snap[name])
            actions.append((name, "populate_from_backup", "success"))
            continue
        else:
            actions.append((name, "merge_not_implemented", "skipped"))
        if table is not None:
            tables[name] = table
    return tables, actions
