"""Sorted outputs. Sort keys end in a unique column, so range partitions stay even."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounds(iterations: DataFrame) -> DataFrame:
    return iterations.orderBy("paper_id", "round")


def expired_snapshots(snaps: DataFrame, keep: int = 10) -> DataFrame:
    """Snapshots beyond the newest ``keep``; the ones kept are a top-k, bounded by ``keep``."""
    newest = snaps.orderBy(F.desc("snapshot_ts"), F.desc("path")).limit(keep).select("path")
    return snaps.join(newest, "path", "left_anti")


def latest_snapshot(snaps: DataFrame, kind: str | None = None) -> DataFrame:
    """Path of the newest snapshot per kind, or of one kind. Equal times go to the later path."""
    wanted = snaps if kind is None else snaps.filter(F.col("kind") == kind)
    return wanted.groupBy("kind").agg(
        F.max_by("path", F.struct("snapshot_ts", "path")).alias("path"),
        F.max("snapshot_ts").alias("snapshot_ts"),
    )
