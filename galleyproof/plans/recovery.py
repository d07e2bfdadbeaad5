"""Deleting papers from stored tables, and bringing them back, behind a snapshot.

Both begin with a snapshot that is read back and counted. If it can't be written or differs,
nothing is changed. What follows is one commit, so readers see all tables before the change or all
of them after it. Both tell what they did in a log of a few rows per table.
"""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_test
from ..operators import insert_by_name, table_stats
from ..session import scratch_folder
from ..sources.versions import StaleVersion, VersionedTables
from . import changes, snapshots

LOG = "operation string, target string, status string, n_rows long, details string"


class BackupFailed(RuntimeError):
    """The snapshot that a change needs could not be written, or doesn't hold what it should."""


def _counted(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows per table; without columns the files' footers tell."""
    return {r.table_name: r.n_rows for r in table_stats(tables).collect()}


def backup(tables: Mapping[str, DataFrame], folder: str, ts: str) -> dict[str, int]:
    """Snapshot ``tables`` and return the rows of each as read back, or raise `BackupFailed`."""
    spark = next(iter(tables.values())).sparkSession
    try:
        snapshots.snapshot(tables, folder, ts, keep=None, stored=True)
        done = [r.path for r in snapshots.snapshots(spark, folder).filter(F.col("snapshot_ts") == ts).collect()]
        if not done:
            raise BackupFailed(f"snapshot {ts} is not complete")
        held, live = _counted(snapshots.read_tables(spark, done[0], list(tables))), _counted(tables)
    except (PySparkException, Py4JJavaError, OSError) as error:
        raise BackupFailed(str(error).splitlines()[0]) from error
    if held != live:
        raise BackupFailed(f"snapshot {ts} holds {held} rows instead of {live}")
    return held


def purge_stored(
    store: VersionedTables, folder: str, ts: str, ids: DataFrame | None = None, keep: int = 10
) -> DataFrame:
    """Delete the papers ``ids`` (None: all rows marked as tests) from every table of ``store``.

    Steps, each with its log rows: a snapshot under ``folder`` ("backup"; an "error" ends the
    purge and leaves the tables as they are), the repositories that belong to the papers ("query";
    they are told, not deleted), one commit ("delete", an "error" if another writer came first),
    and the tables as they are now ("validate"). Snapshots but the newest ``keep`` go at the end.
    Returns the log (operation, target, status, n_rows, details).
    """
    spark, base = store.spark, store.version()
    tables, log = store.tables(base), []

    def told() -> DataFrame:
        return spark.createDataFrame(log, LOG)

    try:
        before = backup(tables, folder, ts)
    except BackupFailed as error:
        log.append(("backup", "tables", "error", None, f"Failed to create backups: {error}"))
        return told()
    log += [("backup", name, "success", n, f"{n} rows backed up") for name, n in before.items()]

    if ids is not None:  # every table is cut by them, so they land
        wanted = f"{scratch_folder(spark, 'purge', local=True)}/wanted"
        ids.select("paper_id").distinct().write.parquet(wanted)
        ids = spark.read.schema("paper_id string").parquet(wanted)
    if ids is None:
        kept, gone = changes.purge_tests(tables)[0], tables["papers"].filter(is_test(F.col("comments")))
    else:
        kept = changes.purge(tables, ids, stored=True)[0]
        gone = tables["papers"].join(ids, "paper_id", "left_semi")
    named = F.length("github_url") > 0 if "github_url" in gone.columns else F.lit(False)
    repos = gone.agg(F.count_if(named)).first()[0]
    log.append(("query", "repos", "success", repos, f"Found {repos} repos to delete"))

    try:
        version = store.commit(kept, base)
    except StaleVersion as error:
        log.append(("delete", "tables", "error", None, f"Failed to delete: {error}"))
        return told()
    after = _counted(store.tables(version))
    for name, n in before.items():
        log.append(("delete", name, "success", n - after[name], f"Deleted {n - after[name]} rows"))
    log += validation(before, after)
    snapshots.prune(spark, folder, keep)
    return told()


def validation(before: Mapping[str, int], after: Mapping[str, int]) -> list[tuple]:
    """Log rows: whether all tables are still there, and how many rows they have."""
    missing = sorted(before.keys() - after.keys())
    if missing:
        return [("validate", "tables", "error", len(missing), f"Tables missing after deletion: {', '.join(missing)}")]
    return [("validate", "tables", "success", len(after), "Tables exist after deletion")] + [
        ("validate", name, "success", after[name], f"{after[name]} rows") for name in before]


def restore_stored(
    store: VersionedTables, folder: str, ids: DataFrame, ts: str, source_ts: str | None = None, keep: int = 10
) -> DataFrame:
    """Bring papers back into ``store`` from a snapshot under ``folder``, after a safety snapshot.

    Without ``source_ts`` the newest complete snapshot is the source; the safety snapshot ``ts``
    is taken after that is chosen. What is absent from a live table is added to its files, and all
    tables change in one commit; nothing that is there is overwritten, so a repetition changes nothing.
    Returns the log (table, paper_id, action, rows, detail), with a row per table for the safety
    snapshot (action "backup", null paper_id). `BackupFailed` is raised if that can't be taken or
    there is no source.
    """
    spark, base = store.spark, store.version()
    live = store.tables(base)
    found = snapshots.snapshots(spark, folder)
    if source_ts is not None:
        found = found.filter(F.col("snapshot_ts") == source_ts)
    source = found.orderBy(F.desc("snapshot_ts"), F.desc("path")).first()
    if source is None:
        raise BackupFailed(f"no complete snapshot {source_ts or ''} under {folder}")
    held = backup(live, folder, ts)
    snap = snapshots.read_tables(spark, source.path, list(live))

    state = snapshots.landed_state(live, snap, ids)
    changed = {
        r.table for r in state.filter("n_live = 0 AND n_snap > 0").select("table").distinct().collect()}
    if changed:
        back = snapshots.absent_rows({n: live[n] for n in sorted(changed)}, snap, state)
        store.commit({}, base, {n: insert_by_name(live[n].filter(F.lit(False)), rows) for n, rows in back.items()})
    log = [(name, None, "backup", n, f"safety snapshot {ts}") for name, n in held.items()]
    out = spark.createDataFrame(log, "table string, paper_id string, action string, rows long, detail string")
    if source.snapshot_ts != ts:
        snapshots.prune(spark, folder, keep)
    return out.unionByName(snapshots.restore_log(snap, state))
