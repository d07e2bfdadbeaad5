"""Set operations, and the two replicator slots as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def two_slots(iterations: DataFrame, keep: list[str], distinct: bool = False) -> DataFrame:
    """One row per round and replicator slot in a single pass: ``slot``, ``replicator``, ``hours``.

    Empty slots are dropped. With ``distinct`` a replicator in both slots of a round counts once,
    in slot 1; (paper_id, round) is the table's key, so this needs no shuffle.
    """
    second = F.col("replicator2").isNotNull()
    if distinct:
        second = second & ~F.col("replicator2").eqNullSafe(F.col("replicator1"))
    has_hours = "hours1" in iterations.columns
    slots = []
    for n, filled in ((1, F.col("replicator1").isNotNull()), (2, second)):
        fields = [F.lit(n).alias("slot"), F.col(f"replicator{n}").alias("replicator")]
        if has_hours:
            fields.append(F.col(f"hours{n}").alias("hours"))
        slots.append(F.when(filled, F.struct(*fields)))
    return iterations.select(*keep, F.inline(F.array_compact(F.array(*slots))))


def insert_by_name(live: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both, matched by column name in any order.

    Columns the new rows lack are null; columns the live table lacks are an error, as on insert.
    """
    unknown = [c for c in new.columns if c not in live.columns]
    if unknown:
        raise ValueError(f"columns not in the live table: {unknown}")
    types = dict(live.dtypes)
    typed = new.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in new.columns])
    return live.unionByName(typed, allowMissingColumns=True)


def missing_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` lacks; a null is a key like any other."""
    return a.select(key).subtract(b.select(key).distinct())


def reminders(arrived: DataFrame, waiting: DataFrame) -> DataFrame:
    """Waiting rows of papers whose package has arrived."""
    return waiting.join(arrived.select("paper_id").distinct(), "paper_id", "left_semi")


def distinct_on(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropDuplicates(keys)
