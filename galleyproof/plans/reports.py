"""Reports over all papers at once. ``as_of`` stands where a live report would say today."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    age_band, days_between, invoice_number, is_test, os_family, quarter_label,
    responsible_actor,
)
from ..operators import (
    assigned_rounds, by_status, current_rounds, latest_iteration, reminders,
    select_matching, split_join, two_slots, without_tests,
)
from ..schemas import DONE_STATUSES, HOURS, STATUS_ROWS, status_dim, status_rank

ROUND = ["paper_id", "round"]
_BY_ROUND = {s: col for s, _, table, col in STATUS_ROWS if table == "iterations"}
_BY_PAPER = {s: col for s, _, table, col in STATUS_ROWS if table == "papers"}


def _entered(columns: dict[str, str]) -> Column:
    date = F
    for status, col in columns.items():
        date = date.when(F.col("status") == status, F.col(col))
    return date


def days_in_status(papers: DataFrame, iterations: DataFrame, as_of: dt.date) -> DataFrame:
    """Every paper with the day it entered its state and the days since; null if not recorded.

    Only papers in states dated by their current round are joined. Arrived and published papers,
    the bulk of a grown archive, are dated from their own row and never shuffled.
    """
    dates = iterations.select(
        *ROUND, *[F.col(c).alias(f"_it_{c}") for c in _BY_ROUND.values()]
    )
    from_round = F.coalesce(F.col("status").isin(*_BY_ROUND), F.lit(False))
    joined = papers.filter(from_round).join(dates, ROUND, "left")
    entered = _entered({s: f"_it_{c}" for s, c in _BY_ROUND.items()})
    moving = joined.select(*papers.columns, entered.alias("date_entered"))
    resting = papers.filter(~from_round).select(
        *papers.columns, _entered(_BY_PAPER).alias("date_entered")
    )
    days = days_between(F.col("date_entered"), F.lit(as_of))
    return moving.unionByName(resting).withColumn("days_in_status", days)


def status_board(papers: DataFrame, iterations: DataFrame, as_of: dt.date) -> DataFrame:
    """All but test papers, by state in workflow order and longest wait first (unknown on top)."""
    shown = papers.filter(~is_test(F.col("comments")))
    band = F.when(~F.col("status").isin(*DONE_STATUSES), age_band(F.col("days_in_status")))
    return (
        days_in_status(shown, iterations, as_of)
        .withColumn("rank", status_rank(F.col("status")))
        .orderBy(F.asc_nulls_last("rank"), F.desc_nulls_first("days_in_status"), "paper_id")
        .select("status", "paper_slug", "round", "days_in_status", "is_confidential",
                band.alias("age_band"), "paper_id")
    )


def global_report(papers: DataFrame, iterations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(summary, status): totals as (metric, value), and count and percent per state."""
    papers, iterations = without_tests(papers, iterations)
    summary = papers.agg(F.count("*").alias("value")).select(
        F.lit("Unique Papers").alias("metric"), "value"
    ).unionByName(
        iterations.agg(F.count("*").alias("value")).select(
            F.lit("Total Iterations").alias("metric"), "value"
        )
    )
    # the window below sees one row per state, after aggregation
    share = F.col("count") / F.sum("count").over(Window.partitionBy(F.lit(0))) * 100
    status = (
        papers.groupBy("status")
        .agg(F.count("*").alias("count"))
        .withColumn("percentage", F.bround(share, 1))
        .orderBy(F.desc("count"), "status")
    )
    return summary, status


def status_report(papers: DataFrame) -> DataFrame:
    """Papers listed by state, one row each."""
    return papers.select("status", "paper_slug").orderBy("status", "paper_slug")


def _held(iterations: DataFrame, papers: DataFrame) -> DataFrame:
    """Rounds now with a replicator, a row for each of the two slots."""
    active = by_status(assigned_rounds(iterations, papers), "with_replicator")
    return two_slots(active.select(*ROUND, "replicator1", "replicator2"), ROUND, distinct=True)


def workload(iterations: DataFrame, papers: DataFrame, replicators: DataFrame) -> DataFrame:
    """Number of papers now with each replicator, in either slot; idle replicators stay with 0.

    One row per replicator, however many papers; `workload_items` lists them.
    """
    counts = _held(iterations, papers).groupBy(F.col("replicator").alias("email")).agg(
        F.count("*").alias("current_workload"))
    return replicators.select("name", "email").join(counts, "email", "left").select(
        "name", "email", F.coalesce("current_workload", F.lit(0)).alias("current_workload"))


def workload_items(iterations: DataFrame, papers: DataFrame) -> DataFrame:
    """Each replicator's papers as rows with a label "id (Rn)", in order of paper and round.

    The order is that of a range-partitioned sort, so a replicator with very many papers spreads
    over partitions.
    """
    label = F.concat(F.col("paper_id"), F.lit(" (R"), F.col("round").cast("string"), F.lit(")"))
    return _held(iterations, papers).select(
        F.col("replicator").alias("email"), *ROUND, label.alias("item")).orderBy("email", *ROUND)


def time_in_status(papers: DataFrame, iterations: DataFrame, as_of: dt.date) -> DataFrame:
    """Days in state: mean, least, most and papers per state; states without papers stay."""
    ages = days_in_status(papers, iterations, as_of).groupBy("status").agg(
        F.avg("days_in_status").alias("avg_days"),
        F.min("days_in_status").alias("min_days"),
        F.max("days_in_status").alias("max_days"),
        F.count("*").alias("papers_count"),
    )
    states = status_dim(papers.sparkSession).select("rank", "status")
    return states.join(ages, "status", "left").orderBy("rank").select(
        "status", "avg_days", "min_days", "max_days",
        F.coalesce("papers_count", F.lit(0)).alias("papers_count"),
    )


def paper_report(papers: DataFrame, iterations: DataFrame, as_of: dt.date) -> DataFrame:
    """Details of every paper: who acts next, days in state, and days from arrival to acceptance
    (or to ``as_of`` while undecided). `timeline` holds the events."""
    accepted = iterations.filter(F.col("decision_de") == "accept").groupBy("paper_id").agg(
        F.min("date_decision_de").alias("accepted")
    )
    until = F.when(F.col("status").isin(*DONE_STATUSES), F.col("accepted")).otherwise(F.lit(as_of))
    detail = days_in_status(papers, iterations, as_of).join(accepted, "paper_id", "left")
    return detail.select(
        "paper_id", "title",
        F.concat_ws(" ", "firstname_of_author", "surname_of_author").alias("authors"),
        "journal", "status", "days_in_status",
        responsible_actor(F.col("status")).alias("responsible_actor"),
        "round",
        days_between(F.col("first_arrival_date"), until).alias("total_days"),
    )


def timeline(iterations: DataFrame) -> DataFrame:
    """Dated events of each paper in order; events of one day keep workflow order."""
    text = F.lit
    round_text = F.concat(text("Round "), F.col("round").cast("string"))
    names = F.concat_ws(" and ", F.coalesce("replicator1", text("Unknown")), F.col("replicator2"))
    result = F.when(F.col("is_success"), "Success").when(~F.col("is_success"), "Failure")
    events = [
        ("first_arrival_date", "Paper Arrived", round_text),
        ("date_with_authors", "Sent to Author", round_text),
        ("date_arrived_from_authors", "Received from Author", round_text),
        ("date_assigned_repl", "Assigned to Replicator", F.concat(text("Assigned to "), names)),
        ("date_completed_repl", "Completed by Replicator",
         F.concat(text("Result: "), F.coalesce(result, text("Unknown")))),
        ("date_decision_de", "Decision by Data Editor",
         F.concat(text("Decision: "), F.coalesce("decision_de", text("Unknown")))),
        ("date_published", "Package Published", text("")),
    ]
    rows = [
        F.when(F.col(col).isNotNull(), F.struct(
            F.col(col).alias("date"), text(n).alias("event_seq"), text(event).alias("event"),
            details.alias("details")))
        for n, (col, event, details) in enumerate(events, 1)
        if col in iterations.columns
    ]
    return iterations.select(*ROUND, F.inline(F.array_compact(F.array(*rows)))).orderBy(
        "paper_id", "date", "round", "event_seq"
    )


def hours_worked(iterations: DataFrame) -> DataFrame:
    """Completed rounds as one row per paid slot. Slot 1 always counts, slot 2 only with both
    replicator and hours."""
    case = F.concat("journal", F.lit("-"), "paper_slug", F.lit("-R"), F.col("round").cast("string"))
    slot = lambda n: F.struct(
        F.lit(n).alias("slot"), F.col(f"replicator{n}").alias("replicator"),
        F.col(f"hours{n}").alias("hours"))
    second = F.col("replicator2").isNotNull() & F.col("hours2").isNotNull()
    return iterations.filter(F.col("date_completed_repl").isNotNull()).select(
        "date_completed_repl",
        days_between(F.col("date_assigned_repl"), F.col("date_completed_repl")).alias("days_taken"),
        case.alias("case_id"),
        "comments",
        F.inline(F.array_compact(F.array(slot(1), F.when(second, slot(2))))),
    )


def _exact(number: float) -> Column:
    return F.lit(Decimal(str(number)))


def capped_hours(worked: DataFrame, cap: float = 1.5) -> DataFrame:
    """Hours with quarter; test cases pay at most ``cap``. Unknown hours stay unknown."""
    limited = F.when(F.col("hours") > _exact(cap), _exact(cap)).otherwise(F.col("hours"))
    hours = F.when(is_test(F.col("comments")), limited).otherwise(F.col("hours")).cast(HOURS)
    return worked.withColumns(
        {"hours": hours, "quarter": quarter_label(F.col("date_completed_repl"))}
    )


def _hours_total(strict_nulls: bool) -> Column:
    total = F.sum("hours")
    return F.when(F.count("hours") == F.count("*"), total) if strict_nulls else total


def hours_summary(
    worked: DataFrame, cap: float = 1.5, rate: float = 25.0, fx: float = 1.1765,
    exclude: str | None = None, strict_nulls: bool = False,
) -> DataFrame:
    """Jobs, hours and pay in EUR and USD by replicator and quarter.

    ``exclude`` drops addresses containing a text. A null hour is skipped, or makes the sum null
    with ``strict_nulls``. `case_lists` gives the case ids.
    """
    paid = _without(capped_hours(worked, cap), exclude)
    summed = paid.groupBy("replicator", "quarter").agg(
        F.count("*").alias("num_jobs"), _hours_total(strict_nulls).alias("hours")
    )
    return summed.withColumns({
        "pay_EUR": F.col("hours") * _exact(rate),
        "pay_USD": F.col("hours") * _exact(rate) * _exact(fx),
    })


def case_lists(worked: DataFrame, exclude: str | None = None) -> DataFrame:
    """Case ids by replicator and quarter as rows, in that order and by case and slot.

    `hours_summary` counts them. The sort is range-partitioned: no group meets in one task.
    """
    rows = _without(worked, exclude).withColumn("quarter", quarter_label(F.col("date_completed_repl")))
    return rows.select("replicator", "quarter", "case_id", "slot").orderBy(
        "replicator", "quarter", "case_id", "slot")


def _without(worked: DataFrame, exclude: str | None) -> DataFrame:
    if exclude is None:
        return worked
    return worked.filter(~F.coalesce(F.contains("replicator", F.lit(exclude)), F.lit(False)))


def billing(summary: DataFrame) -> DataFrame:
    """Billing lines in order of quarter and replicator."""
    return summary.select("replicator", "quarter", "num_jobs", "hours", "pay_EUR", "pay_USD").orderBy(
        "quarter", "replicator"
    )


def quarterly_budget(lines: DataFrame) -> DataFrame:
    return lines.groupBy("quarter").agg(
        F.sum("hours").alias("hours"), F.sum("num_jobs").alias("num_jobs"),
        F.sum("pay_EUR").alias("cost_EUR"), F.sum("pay_USD").alias("cost_USD"),
    ).orderBy("quarter")


def invoices(
    worked: DataFrame, replicators: DataFrame, quarter: str, rate: float = 25.0,
    fx: float = 1.1765, cap: float = 1.5, aliases: dict[str, str] | None = None,
) -> DataFrame:
    """What each replicator may bill for a quarter, in USD to one digit, and the next invoice
    number. ``aliases`` maps an outdated address to the listed one."""
    usd = _exact(round(rate * fx, 2))
    billed = _billed(worked, quarter, cap, aliases).withColumn("amount_USD", F.bround(F.col("hours") * usd, 1))
    people = replicators.select(
        "email", "name", (invoice_number(F.col("invoice")) + 1).alias("next_invoice")
    )
    return billed.join(people, "email", "left")


def _billed(worked: DataFrame, quarter: str, cap: float, aliases: dict[str, str] | None) -> DataFrame:
    """Jobs and hours of a quarter per address; both addresses of a person make one."""
    hours = capped_hours(worked, cap).filter(F.col("quarter") == quarter)
    email = F.col("replicator")
    for old, current in (aliases or {}).items():
        email = F.when(F.col("replicator") == old, F.lit(current)).otherwise(email)
    return hours.groupBy(email.alias("email")).agg(F.count("*").alias("num_jobs"), F.sum("hours").alias("hours"))


def invoice_rejects(
    worked: DataFrame, replicators: DataFrame, quarter: str, cap: float = 1.5, aliases: dict[str, str] | None = None,
) -> DataFrame:
    """Hours of a quarter for which no invoice can be made: email, num_jobs, hours, and why. The
    address is "not_listed", or the person has "no_number" to count on from."""
    listed = replicators.groupBy("email").agg(F.max(invoice_number(F.col("invoice"))).alias("_number"), F.lit(True).alias("_listed"))
    reason = F.when(F.col("_listed").isNull(), "not_listed").when(F.col("_number").isNull(), "no_number")
    known = _billed(worked, quarter, cap, aliases).join(listed, "email", "left").withColumn("reason", reason)
    return known.filter(F.col("reason").isNotNull()).select("email", "num_jobs", "hours", "reason")


def assignments(papers: DataFrame, iterations: DataFrame, as_of: dt.date) -> DataFrame:
    """Who holds which package, and for how many days. The schema is fixed: an all-null second
    slot stays (`all_missing` tells)."""
    out = by_status(papers, "with_replicator").select(*ROUND)
    return out.join(iterations, ROUND, "left").select(
        "paper_slug", "round", "replicator1", "replicator2", "date_assigned_repl",
        days_between(F.col("date_assigned_repl"), F.lit(as_of)).alias("days_with_repl"),
    )


def history(iterations: DataFrame, email: str | None = None) -> DataFrame:
    """Every round a replicator has had, with the slot."""
    keep = ["paper_slug", "round", "date_assigned_repl", "date_completed_repl"]
    rows = two_slots(iterations.select(*keep, "replicator1", "replicator2"), keep)
    rows = rows.withColumnRenamed("slot", "replicator_num")
    return rows if email is None else rows.filter(F.col("replicator") == email)


def latest_long(iterations: DataFrame) -> DataFrame:
    """The latest round of each paper as (column, value) rows of text."""
    cols = [
        "round", "repl_comments", "is_success", "is_confidential", "is_confidential_shared",
        "is_HPC", "is_remote", "replicator1", "replicator2", "hours1", "hours2", "software",
        "data_statement",
    ]
    latest = latest_iteration(iterations.select("paper_id", *cols))
    texts = latest.select("paper_id", *[F.col(c).cast("string").alias(c) for c in cols])
    return texts.unpivot("paper_id", cols, "column", "value")


def requests_long(iterations: DataFrame, urls: bool = True) -> DataFrame:
    """File request ids (and addresses) of each round as (variable, value) rows."""
    pattern = "file_request_(id|url)_" if urls else "file_request_id"
    wide = select_matching(iterations, pattern, *ROUND)
    names = [c for c in wide.columns if c not in ROUND]
    return wide.unpivot(ROUND, names, "variable", "value")


def arrivals_check(
    papers: DataFrame, iterations: DataFrame, uploads: DataFrame, late: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(check, remind): latest rounds of waiting papers with a flag per upload kind, and those
    whose package is in while the paper file is not.

    ``uploads`` holds (paper_id, kind, file_count) with kinds "package" and "paper"; without a
    row nothing has come in. ``late`` holds uploads that came too late for the stream, as
    `streaming.record_arrivals` puts them aside.
    """
    told = ["paper_id", "kind", "file_count"]
    uploads = uploads.select(*told)
    if late is not None:
        uploads = uploads.unionByName(late.select(*told))
    came = uploads.groupBy("paper_id").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("file_count"))).alias(f"_{k}")
          for k in ("package", "paper")]
    )
    waiting = by_status(papers, "with_author", "new_arrival").select("status", "paper_id")
    # rounds of waiting papers only are ranked
    asked = split_join(iterations.select(*ROUND, "journal", "paper_slug"),
                       waiting.select("paper_id").distinct(), ["paper_id"], "left_semi")
    latest = current_rounds(asked)
    check = waiting.join(latest, "paper_id").join(came, "paper_id", "left").select(
        "journal", *ROUND, "paper_slug", "status",
        *[F.coalesce(F.col(f"_{k}") > 0, F.lit(False)).alias(f"{k}_arrived")
          for k in ("package", "paper")],
    )
    remind = reminders(check.filter("package_arrived"), check.filter("NOT paper_arrived"))
    return check, remind


LISTINGS = {
    "unpublished": [s for s in (r[0] for r in STATUS_ROWS) if s != "published_package"],
    "published": ["published_package"],
    "with_author": ["with_author"],
    "with_replicator": ["with_replicator"],
    "with_de": [s for s, actor, _, _ in STATUS_ROWS if actor == "Data Editor"],
}


def listing(papers: DataFrame, iterations: DataFrame, as_of: dt.date, kind: str) -> DataFrame:
    """Papers of one group of states with their days in state."""
    chosen = by_status(papers, *LISTINGS[kind])
    return days_in_status(chosen, iterations, as_of).select(
        "paper_id", "paper_slug", "round", "status", "days_in_status"
    )


def effort(papers: DataFrame, iterations: DataFrame) -> DataFrame:
    """Rounds and hours spent on each paper."""
    hours = F.coalesce("hours1", F.lit(0)) + F.coalesce("hours2", F.lit(0))
    spent = iterations.groupBy("paper_id").agg(
        F.count("*").alias("n_rounds"), F.sum(hours).alias("hours")
    )
    return papers.select("paper_id", "paper_slug", "status").join(spent, "paper_id", "left").select(
        "paper_id", "paper_slug", "status",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rounds", "hours")],
    )


def effort_over_time(iterations: DataFrame, by: str = "date_completed_repl") -> DataFrame:
    """Hours per round by month of completion or assignment."""
    hours = F.coalesce("hours1", F.lit(0)) + F.coalesce("hours2", F.lit(0))
    month = F.trunc(by, "month")
    return iterations.filter(F.col(by).isNotNull()).groupBy(month.alias("month")).agg(
        F.count("*").alias("n_rounds"), F.sum(hours).alias("hours"),
        (F.sum(hours).cast("double") / F.count("*")).alias("hours_per_round"),
    )


TURNAROUND = {
    "author": ("date_with_authors", "date_arrived_from_authors"),
    "de_decision": ("date_completed_repl", "date_decision_de"),
    "de_assignment": ("date_arrived_from_authors", "date_assigned_repl"),
}


def turnaround(iterations: DataFrame) -> DataFrame:
    """Days authors take to return, and the editor to decide and to assign: number of rounds,
    mean, least, median, most. The median counts distinct day spans, a small set."""
    spans = iterations.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), days_between(F.col(a), F.col(b)).alias("days"))
        for name, (a, b) in TURNAROUND.items()
    ])))
    return spans.filter(F.col("days").isNotNull()).groupBy("metric").agg(
        F.count("*").alias("n_rounds"), F.avg("days").alias("avg_days"),
        F.min("days").alias("min_days"), F.percentile("days", 0.5).alias("median_days"),
        F.max("days").alias("max_days"),
    )


def overdue(papers: DataFrame, iterations: DataFrame, as_of: dt.date, n: int = 7) -> DataFrame:
    """Unfinished papers more than ``n`` days in their state."""
    pending = papers.filter(~F.col("status").isin(*DONE_STATUSES))
    return days_in_status(pending, iterations, as_of).filter(F.col("days_in_status") > n).select(
        "paper_id", "paper_slug", "round", "status", "days_in_status",
        responsible_actor(F.col("status")).alias("responsible_actor"),
    )


def roster(replicators: DataFrame) -> DataFrame:
    """Replicators with availability and system family."""
    return replicators.select(
        "email", "name", os_family(F.col("os")).alias("os_family"),
        F.coalesce(F.col("`can_take_+1_package`") == "Yes", F.lit(False)).alias("available"),
    )


def previous_candidates(iterations: DataFrame, replicators: DataFrame) -> DataFrame:
    """For the current round of every paper, the replicators of the round before: slot, name,
    system family and availability."""
    latest = current_rounds(iterations.select(*ROUND))
    slots = ["replicator1", "replicator2"]
    before = iterations.select("paper_id", (F.col("round") + 1).alias("round"), *slots)
    prior = latest.join(before, ROUND)
    rows = two_slots(prior, ROUND).withColumnRenamed("replicator", "email")
    return rows.join(roster(replicators), "email", "left").select(
        *ROUND, "slot", "email", "name", "os_family",
        F.coalesce("available", F.lit(False)).alias("available"),
    )


def candidates(iterations: DataFrame, replicators: DataFrame, paper_id: str) -> DataFrame:
    """The whole roster for one paper, marking who had slot 1 or 2 in the round before."""
    own = previous_candidates(iterations.filter(F.col("paper_id") == paper_id), replicators)
    # someone listed in both slots counts as primary
    slot = own.groupBy("email").agg(F.min("slot").alias("_slot"))
    return roster(replicators).join(slot, "email", "left").select(
        "email", "name", "os_family", "available",
        F.coalesce(F.col("_slot") == 1, F.lit(False)).alias("previous_primary"),
        F.coalesce(F.col("_slot") == 2, F.lit(False)).alias("previous_secondary"),
    )


def backlog(iterations: DataFrame, packages: DataFrame, mode: str = "gh-runner") -> DataFrame:
    """Rounds dispatched in a mode whose package never landed; ``packages`` holds the
    (gh_org_repo, round) that did. Rounds without repository are not looked for."""
    sent = iterations.filter(
        (F.col("preprocess_mode") == mode) & F.col("gh_org_repo").isNotNull() & F.col("round").isNotNull()
    ).select("paper_id", "round", "gh_org_repo")
    landed = packages.select("gh_org_repo", "round").distinct()
    return sent.join(landed, ["gh_org_repo", "round"], "left_anti").select(
        "paper_id", "round", "gh_org_repo"
    )

