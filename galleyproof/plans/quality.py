"""Consistency checks and repairs."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import STATUS_ROWS, STATUSES, TABLES

ROUND = ["paper_id", "round"]
# the columns a round's state shows in, in workflow order
PROGRESS = [
    "date_with_authors", "date_arrived_from_authors", "date_assigned_repl", "date_completed_repl",
    "date_decision_de",
]
_STATUS_OF = {col: s for s, _, table, col in STATUS_ROWS if table == "iterations"}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in order and type, missing ones null; further columns stay behind."""
    declared = [
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    extra = [F.col(f"`{c}`") for c in df.columns if c not in schema.fieldNames()]
    return df.select(*declared, *extra)


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    return [f.name for f in schema if f.name not in df.columns]


def _current(papers: DataFrame, iterations: DataFrame) -> DataFrame:
    """Papers with number and dates of their current round, and whether they have any round.

    Rounds are reduced on their key before the join, so repeats cannot multiply papers and the
    join needs no second shuffle of them.
    """
    # fixed-width buffers keep this a hash aggregate
    accepted = F.coalesce(F.col("decision_de") == "accept", F.lit(False))
    per_round = iterations.groupBy(*ROUND).agg(
        F.count("*").alias("n_current"), *[F.any_value(c).alias(f"it_{c}") for c in PROGRESS],
        F.any_value(accepted).alias("it_accepted"))
    # rows per paper in both tables from one shuffle of ids
    ids = papers.select("paper_id", F.lit(1).alias("p"), F.lit(0).alias("r")).unionByName(
        iterations.select("paper_id", F.lit(0).alias("p"), F.lit(1).alias("r")))
    known = ids.groupBy("paper_id").agg(F.sum("p").alias("n_papers"), F.max("r").alias("has_rounds"))
    base = papers.select(*ROUND, "status", "date_published")
    return base.join(per_round, ROUND, "left").join(known, "paper_id", "left")


def _issue(when: Column, text: str | Column) -> Column:
    return F.when(when, text if isinstance(text, Column) else F.lit(text))


def _issues() -> Column:
    """Issue texts that apply to a row of `_current`."""
    status = F.col("status")
    checks = []
    for state, _, table, needed in STATUS_ROWS:
        here = status == state
        if state == "new_arrival":
            moved_on = reduce(lambda a, b: a | b, [F.col(f"it_{c}").isNotNull() for c in PROGRESS])
            checks.append(_issue(here & moved_on, f"Status is '{state}' but has dates set that "
                                 "indicate further progress"))
            continue
        held = F.col(f"it_{needed}" if table == "iterations" else needed)
        checks.append(_issue(here & held.isNull(), f"Status is '{state}' but {needed} is not set"))
        if state == "acceptable_package":
            # an absent decision is not an acceptance
            checks.append(_issue(here & ~F.col("it_accepted"), f"Status is '{state}' but decision_de is not 'accept'"))
        elif table == "iterations":
            following = PROGRESS[PROGRESS.index(needed) + 1]
            checks.append(_issue(here & F.col(f"it_{following}").isNotNull(),
                                 f"Status is '{state}' but {following} is set"))
    unknown = ~F.coalesce(status.isin(*STATUSES), F.lit(False))
    checks.append(_issue(unknown, F.concat(F.lit("Unknown status: "), F.coalesce(status, F.lit("missing")))))
    return F.array_compact(F.array(*checks))


def _blocking() -> Column:
    """Reason why a paper's state cannot be checked at all, else null."""
    return (
        F.when(F.col("n_papers") != 1, F.concat(
            F.lit("Paper ID "), F.col("paper_id"), F.lit(" not found or has multiple entries")))
        .when(F.col("has_rounds") == 0, F.concat(
            F.lit("No iterations found for paper "), F.col("paper_id")))
        .when(~F.coalesce(F.col("n_current") == 1, F.lit(False)), F.concat(
            F.lit("No iteration found for current round "),
            F.coalesce(F.col("round").cast("string"), F.lit("missing"))))
    )


def _validated(papers: DataFrame, iterations: DataFrame) -> DataFrame:
    checked = _current(papers, iterations).withColumn("blocked", _blocking())
    found = F.when(F.col("blocked").isNotNull(), F.array("blocked")).otherwise(_issues())
    return checked.withColumn("issues", found)


def validate(papers: DataFrame, iterations: DataFrame) -> DataFrame:
    """Every paper with the contradictions between its state and its current round's dates."""
    return _validated(papers, iterations).select(
        "paper_id", "round", "status", (F.size("issues") == 0).alias("is_valid"), "issues")


def repair(papers: DataFrame, iterations: DataFrame) -> DataFrame:
    """For every paper that fails `validate`: the state its dates call for, and what was done.

    Apply it with `changes.set_status` on the rows where ``changed``. A current round decided as
    anything but "accept" fits no dated state and falls to new_arrival; the message says so.
    """
    checked = _validated(papers, iterations).filter(F.size("issues") > 0)
    has = lambda c: F.col(f"it_{c}").isNotNull()
    new = F.when(F.col("date_published").isNotNull(), "published_package").when(
        has("date_decision_de") & F.col("it_accepted"), "acceptable_package")
    # latest stage first: reached, and the stage after it not
    for done, following in reversed(list(zip(PROGRESS, PROGRESS[1:]))):
        new = new.when(has(done) & ~has(following), _STATUS_OF[done])
    new = F.when(F.col("blocked").isNull(), new.otherwise("new_arrival"))
    fell = (F.col("new_status") == "new_arrival") & has("date_decision_de")
    message = (
        F.when(F.col("blocked").isNotNull(), F.col("blocked"))
        .when(F.col("new_status").eqNullSafe(F.col("status")), "Status is already correct")
        .otherwise(F.concat(
            F.lit("Status updated from '"), F.coalesce("status", F.lit("missing")),
            F.lit("' to '"), F.col("new_status"), F.lit("'"),
            F.when(fell, " (current round is decided but not accepted)").otherwise("")))
    )
    return checked.withColumn("new_status", new).select(
        "paper_id", F.col("blocked").isNull().alias("success"),
        F.col("status").alias("old_status"), "new_status",
        (F.col("blocked").isNull() & ~F.col("new_status").eqNullSafe(F.col("status"))).alias("changed"),
        message.alias("message"))


_ISSUE = "table string, issue_type string, description string, severity string"


def integrity(tables: Mapping[str, DataFrame | None], spark) -> DataFrame:
    """Absent tables (critical; nothing else is then checked), and arrivals that never became
    papers (high)."""
    absent = [n for n in TABLES if tables.get(n) is None]
    if absent:
        rows = [(n, "missing_table", f"Table {n} does not exist", "critical") for n in absent]
        return spark.createDataFrame(rows, _ISSUE)
    left_out = tables["form_arrivals"].select("paper_id").distinct().join(
        tables["papers"].select(F.col("paper_id").alias("_held")).distinct(),
        F.col("paper_id").eqNullSafe(F.col("_held")), "left_anti")
    return left_out.agg(F.count("*").alias("n")).filter("n > 0").select(
        F.lit("papers").alias("table"), F.lit("missing_records").alias("issue_type"),
        F.concat(F.col("n").cast("string"),
                 F.lit(" paper_ids exist in form_arrivals but not in papers")).alias("description"),
        F.lit("high").alias("severity"))


def snapshot_lag(live: DataFrame, snap: DataFrame) -> DataFrame:
    """Two `last_modified` rows compared: which is newer, and by how many hours (one digit)."""
    both = live.select(F.lit("live").alias("side"), F.col("comparison_timestamp").alias("t")).unionByName(
        snap.select(F.lit("snapshot").alias("side"), F.col("comparison_timestamp").alias("t")))
    at = lambda side: F.max(F.when(F.col("side") == side, F.col("t")))
    times = both.agg(at("live").alias("live"), at("snapshot").alias("snapshot"))
    seconds = F.timestamp_diff("SECOND", F.col("snapshot"), F.col("live"))
    state = (
        F.when(seconds > 0, "live_newer").when(seconds < 0, "snapshot_newer").when(seconds == 0, "in_sync")
    )
    return times.select("live", "snapshot", state.alias("state"),
                        F.bround(F.abs(seconds) / 3600, 1).alias("hours"))
