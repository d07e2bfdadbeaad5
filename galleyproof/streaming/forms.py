"""Form submissions as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import any_null
from .keyed import BATCH, Clock, first_seen, run


def ingest_forms(
    raw: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    keys: list[str],
    delay: str = "1 hour",
) -> StreamingQuery:
    """Clean a stream of form answers and append the new ones to the ``target`` folder.

    Of several answers with one key in a batch the latest counts, and a key that any batch before
    held is never written again: the stream's state knows it, so what has landed isn't read again.
    Answers with a null key all stay, an exact repetition aside. What is older than ``delay``
    before the newest answer of earlier runs is late and left out. Each batch owns a sub-folder,
    overwritten if the batch is repeated after a failure, so every answer lands once.
    """
    cleaned = clean(raw)
    names, clock = cleaned.columns, Clock(raw.sparkSession, checkpoint, delay)
    # answers with a null key are each a key of their own
    apart = F.when(any_null(keys), F.xxhash64(*names)).otherwise(F.lit(0).cast("long"))
    own = {f"_key{i}": F.col(k) for i, k in enumerate(keys)} | {"_apart": apart}
    # ties in time are settled by the answer's own content
    order = F.struct("timestamp", F.bitwise_not(F.xxhash64(*names)))
    seen = first_seen(
        cleaned.filter(~clock.is_late(F.col("timestamp"))), own,
        _row=F.max_by(F.struct(*names), order), _time=F.max("timestamp"))

    def land(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        batch.filter("_is_new").select("_row.*").write.mode("overwrite").parquet(f"{target}/{BATCH}{batch_id}")
        clock.advance(batch, "_time", batch_id)
        batch.unpersist()

    return run(seen, land, checkpoint)
