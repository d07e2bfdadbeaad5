"""Upload events as a stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import by_status
from ..plans.changes import mark_arrived
from .keyed import BATCH, Clock, first_seen, run


def record_arrivals(
    uploads: DataFrame, papers: DataFrame, ledger: str, checkpoint: str, delay: str = "1 day", late: str | None = None
) -> StreamingQuery:
    """Write packages that came in for waiting papers to a ledger folder.

    ``uploads`` is a stream of (paper_id, kind, file_count, ts). Papers are static for the run. A
    paper is recorded once per day. What is older than ``delay`` before the newest upload of
    earlier runs is late: it goes, for whatever paper, to the folder ``late`` (default: the
    ledger's name with "-late"), as uploads that `reports.arrivals_check` takes in. The tables
    themselves are not rewritten per batch: `apply_arrivals` folds the ledger in.
    """
    clock, late = Clock(uploads.sparkSession, checkpoint, delay), late or f"{ledger}-late"
    waiting = by_status(papers, "with_author").select("paper_id", "round")
    packages = uploads.filter((F.col("kind") == "package") & (F.col("file_count") > 0))
    # a late upload doesn't use up its day: one that comes in time is still recorded
    own = {"paper_id": F.col("paper_id"), "arrived": F.col("ts").cast("date"), "is_late": clock.is_late(F.col("ts"))}
    seen = first_seen(packages, own, file_count=F.max("file_count"), ts=F.max("ts"))

    def land(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        new = batch.filter("_is_new")
        new.filter("NOT is_late").join(waiting, "paper_id").select("paper_id", "round", "arrived").write.mode(
            "overwrite").parquet(f"{ledger}/{BATCH}{batch_id}")
        new.filter("is_late").select("paper_id", F.lit("package").alias("kind"), "file_count", "ts").write.mode(
            "overwrite").parquet(f"{late}/{BATCH}{batch_id}")
        clock.advance(batch, "ts", batch_id)
        batch.unpersist()

    return run(seen, land, checkpoint)


def apply_arrivals(
    papers: DataFrame, iterations: DataFrame, ledger: DataFrame, as_of: dt.date
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`changes.mark_arrived` for a ledger; of repeated entries the first day counts."""
    first = ledger.groupBy("paper_id", "round").agg(F.min("arrived").alias("arrived"))
    return mark_arrived(papers, iterations, first, as_of)
