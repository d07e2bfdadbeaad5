"""Joins between papers, rounds, reports and forms.

No side is ever hinted for broadcast here: Spark measures sizes and picks the strategy, and its
adaptive execution splits a hot key of a sort-merge join, provided that both sides are shuffled
for this very join. `split_join` sees to that where a side is an aggregate on the same key.
Sides tested only for presence are reduced to distinct keys first.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import key_match, key_tag
from .windows import latest_iteration

ROUND = ["paper_id", "round"]
# columns of a paper that follow its rounds
FOLLOWING = [
    "data_statement", "software", "is_remote", "is_HPC", "is_confidential", "share_confidential",
]


def assigned_rounds(iterations: DataFrame, papers: DataFrame) -> DataFrame:
    """Current rounds with some replicator set, and their paper's state."""
    current = papers.select("paper_id", "round", "status")
    staffed = iterations.filter(F.col("replicator1").isNotNull() | F.col("replicator2").isNotNull())
    return staffed.join(current, ROUND)


def reports_to_process(reports: DataFrame, iterations: DataFrame) -> DataFrame:
    """Reports whose round is open, unstaffed, or staffed by someone else. A null never differs.
    Reports without paper or round have no such round; they bypass the join."""
    rounds = iterations.select(*ROUND, F.col("date_completed_repl").alias("_done"),
                               F.col("replicator1").alias("_first"))
    todo = (
        F.col("_done").isNull()
        | F.col("_first").isNull()
        | (F.col("_first") != F.col("email_of_replicator_1"))
    )
    named = reports.filter(~any_null(ROUND)).join(rounds, ROUND, "left").filter(todo).drop("_done", "_first")
    return named.unionByName(reports.filter(any_null(ROUND)))


def any_null(keys: list[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def held_keys(batch: DataFrame, live: DataFrame, keys: list[str], null_safe: bool) -> DataFrame:
    """Distinct keys of the batch that the live table has, as ``_have_<key>``.

    The live table is cut to the batch's keys: while these are small enough for Spark to
    broadcast, the large live table is only scanned, never shuffled.
    """
    want, have = [f"_want_{k}" for k in keys], [f"_have_{k}" for k in keys]
    wanted = batch.select(*[F.col(k).alias(w) for k, w in zip(keys, want)]).distinct()
    held = live.select(*[F.col(k).alias(h) for k, h in zip(keys, have)])
    return held.join(wanted, key_match(have, want, null_safe), "left_semi").distinct()


def without_keys(batch: DataFrame, held: DataFrame, keys: list[str], null_safe: bool) -> DataFrame:
    have = [f"_have_{k}" for k in keys]
    match = key_match(keys, have, null_safe) & (key_tag(keys) == key_tag(have))
    return batch.join(held, match, "left_anti")


def new_rows(
    batch: DataFrame, live: DataFrame, keys: list[str] | str, null_safe: bool = False
) -> DataFrame:
    """Batch rows whose key is not in the live table.

    Null keys never match and so are always new, unless ``null_safe``; they bypass the join, where
    all of them would meet in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if null_safe:
        return without_keys(batch, held_keys(batch, live, keys, True), keys, True)
    named = batch.filter(~any_null(keys))
    fresh = without_keys(named, held_keys(named, live, keys, False), keys, False)
    return fresh.unionByName(batch.filter(any_null(keys)))


def waiting_rounds(papers: DataFrame, iterations: DataFrame) -> DataFrame:
    """Papers still awaiting files, with every round they have (or one empty row).

    Written as matches plus unmatched papers, not as one outer join: an inner join may be split
    on either side when one paper holds a large share of the rounds.
    """
    waiting = papers.filter(F.col("status").isin("with_author", "new_arrival")).select(
        "status", "paper_id"
    )
    known = iterations.select("paper_id").distinct()
    alone = waiting.join(known, "paper_id", "left_anti")
    return waiting.join(iterations, "paper_id").unionByName(alone, allowMissingColumns=True)


def update_from_latest(papers: DataFrame, iterations: DataFrame) -> DataFrame:
    """Papers with the columns of FOLLOWING taken, nulls included, from their latest round."""
    latest = latest_iteration(iterations.select(*ROUND, *FOLLOWING)).drop("round")
    return _replace_following(papers, latest)


def update_from_round(papers: DataFrame, iterations: DataFrame, rounds: DataFrame) -> DataFrame:
    """The same from a chosen round per paper; ``rounds`` holds (paper_id, round)."""
    chosen = iterations.select(*ROUND, *FOLLOWING).join(rounds.select(*ROUND), ROUND).drop("round")
    return _replace_following(papers, chosen)


def _replace_following(papers: DataFrame, source: DataFrame) -> DataFrame:
    source = source.select(
        "paper_id", F.struct(*FOLLOWING).alias("_new"), F.lit(True).alias("_hit")
    )
    joined = papers.join(source, "paper_id", "left")
    return joined.withColumns(
        {c: F.when(F.col("_hit"), F.col(f"_new.{c}")).otherwise(F.col(c)) for c in FOLLOWING}
    ).select(*papers.columns)


def with_previous_round(iterations: DataFrame, cols: list[str]) -> DataFrame:
    """Every round with ``prev_<col>`` from the round numbered one lower, null if there is none.

    An equality join on (paper, round) spreads even a paper with very many rounds, where a
    window per paper would put them in one task.
    """
    before = iterations.select(
        "paper_id", (F.col("round") + 1).alias("round"), *[F.col(c).alias(f"prev_{c}") for c in cols]
    )
    return iterations.join(before, ROUND, "left")


def carry_replicators(iterations: DataFrame, rounds: DataFrame | None = None) -> DataFrame:
    """Rounds without first replicator get both slots of the round before, where it exists.

    ``rounds`` (paper_id, round) limits the change to those rounds.
    """
    slots = ["replicator1", "replicator2"]
    before = iterations.select(
        "paper_id", (F.col("round") + 1).alias("round"),
        *[F.col(c).alias(f"_{c}") for c in slots], F.lit(True).alias("_hit"),
    )
    if rounds is not None:
        before = before.join(rounds.select(*ROUND).distinct(), ROUND, "left_semi")
    take = F.col("_hit") & F.col("replicator1").isNull()
    joined = iterations.join(before, ROUND, "left").withColumn("_take", take)
    return joined.withColumns(
        {c: F.when(F.col("_take"), F.col(f"_{c}")).otherwise(F.col(c)) for c in slots}
    ).select(*iterations.columns)


def exists_rows(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Each wanted key with a flag ``present``."""
    held = df.select(*keys).distinct().withColumn("_hit", F.lit(True))
    flagged = wanted.select(*keys).distinct().join(held, keys, "left")
    return flagged.select(*keys, F.coalesce("_hit", F.lit(False)).alias("present"))
