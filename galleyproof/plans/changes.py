"""State changes over whole tables.

Each returns the changed tables and the rejected requests with a reason. Requests are judged when a
change is called and land in the scratch folder (`session.scratch_folder`); the tables returned are
plans over these files and the same inputs. Write them together with `sources.versions.VersionedTables.commit`, which makes all
tables of a change visible at once.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import is_test
from ..operators import (
    carry_replicators, is_stored, key_marked, key_rows, reports_to_process, sieve, split_join,
    update_from_latest, update_from_round,
)
from ..schemas import STATUSES, check_statuses
from ..session import PACKED, scratch_folder

ROUND = ["paper_id", "round"]

# Report form column that each column of a round is filled from.
REPORT_FIELDS = [
    ("replicator1", "email_of_replicator_1"),
    ("replicator2", "email_of_replicator_2"),
    ("hours1", "hours_replicator_1"),
    ("hours2", "hours_replicator_2"),
    ("is_success", "is_success"),
    ("software", "software_used_in_package"),
    ("is_confidential", "is_confidential"),
    ("is_confidential_shared", "shared_confidential"),
    ("is_remote", "is_remote"),
    ("is_HPC", "is_HPC"),
    ("runtime_code_hours", "running_time_of_code"),
    ("data_statement", "data_statement"),
    ("repl_comments", "comments"),
    ("date_completed_repl", "timestamp"),
]
ROUND_DATES = [
    "date_arrived_from_authors", "date_assigned_repl", "date_completed_repl", "date_decision_de",
]


def _set(
    df: DataFrame, source: DataFrame, keys: list[str], **values: Column
) -> DataFrame:
    """Rows of ``df`` with a match in ``source`` (unique on keys) get the given values.

    Source columns are addressed as ``new.<name>``.
    """
    payload = source.select(
        *keys, F.struct(*[c for c in source.columns if c not in keys], F.lit(True).alias("hit")).alias("new")
    )
    joined = df.join(payload, keys, "left")
    changed = {
        c: F.when(F.col("new.hit"), v.cast(df.schema[c].dataType)).otherwise(F.col(c))
        for c, v in values.items() if c in df.columns
    }
    return joined.withColumns(changed).select(*df.columns)


def _judge(requests: DataFrame, papers: DataFrame, allowed: Column, *carry: str) -> DataFrame:
    """Every request with its paper's round and state, and ``reason`` (null if it fits).

    The papers table is cut to the papers asked for before the outer join, which splits a paper
    that most requests ask for.
    """
    known = papers.select("paper_id", "round", "status", *carry).join(
        requests.select("paper_id").distinct(), "paper_id", "left_semi").withColumn("_known", F.lit(True))
    reason = F.when(F.col("_known").isNull(), "not_found").when(
        ~F.coalesce(allowed, F.lit(False)), "wrong_status")
    return split_join(requests, known, ["paper_id"], "left").withColumn("reason", reason).drop("_known")


def _also(judged: DataFrame, reason: str, when: Column) -> DataFrame:
    """Requests that fit so far are rejected with ``reason`` where ``when`` holds."""
    return judged.withColumn(
        "reason", F.coalesce("reason", F.when(F.coalesce(when, F.lit(False)), reason)))


def _with_round(judged: DataFrame, iterations: DataFrame) -> DataFrame:
    """Fine requests whose current round is missing from the rounds table become rejected."""
    asked = judged.filter(F.col("reason").isNull()).select(*ROUND).distinct()
    held = iterations.select(*ROUND).join(asked, ROUND).distinct().withColumn("_held", F.lit(True))
    return _also(split_join(judged, held, ROUND, "left"), "no_iteration", F.col("_held").isNull()).drop("_held")


def _landed(df: DataFrame, path: str) -> DataFrame:
    df.write.options(**PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _settle(judged: DataFrame, keys: list[str], *first: Column) -> tuple[DataFrame, DataFrame]:
    """One fitting request per key, and all other requests with the reason against them.

    The judged requests are written once with a number each, and so are those that are applied;
    all outputs of a change are cut from these files, so the tables that a request is judged by
    are read once. Of several that fit, the first by ``first`` and then by content is applied
    (nulls come last); the others, equal ones too, are "superseded". A key asked for by most
    requests sends one of them per map task. Rows in are rows applied plus rows rejected.
    """
    folder = scratch_folder(judged.sparkSession, "change", local=True)
    told = _landed(judged.withColumn("_id", F.monotonically_increasing_id()), f"{folder}/judged")
    rest = [c for c in judged.columns if c not in (*keys, "reason")]
    order = [*first, *[F.asc_nulls_last(c) for c in rest], F.col("_id")]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    won = told.filter(F.col("reason").isNull()).withColumn("_place", place).filter("_place = 1")
    won = _landed(won.select(*keys, *rest, "_id"), f"{folder}/applied")
    lost = told.join(won.select("_id"), "_id", "left_anti")
    rejected = lost.select(*keys, *rest, F.coalesce("reason", F.lit("superseded")).alias("reason"))
    return won.drop("_id"), rejected


def _refused(rejected: DataFrame) -> DataFrame:
    return rejected.select("paper_id", "reason")


def _with_target(judged: DataFrame) -> DataFrame:
    """A target that isn't a known state is the first reason against a request."""
    unknown = ~F.coalesce(F.col("to_status").isin(*STATUSES), F.lit(False))
    return judged.withColumn("reason", F.coalesce(F.when(unknown, "bad_target"), "reason"))


def transition(papers: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Compare-and-set: requests (paper_id, from_status, to_status) move a paper only out of the
    expected state and only into a known one.

    Of several fitting requests for a paper the first by content is applied, the others are
    superseded. Returns (papers, rejected).
    """
    asked = requests.select("paper_id", "from_status", "to_status")
    judged = _judge(asked, papers, F.col("status") == F.col("from_status"))
    applied, rejected = _settle(_with_target(judged), ["paper_id"])
    return (
        _set(papers, applied.select("paper_id", "to_status"), ["paper_id"], status=F.col("new.to_status")),
        rejected.select("paper_id", "from_status", "to_status", "reason"),
    )


def set_status(papers: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """States set without regard to the present one; the target must be known.
    ``requests`` holds (paper_id, status); of several fitting ones the first by name counts."""
    asked = requests.select("paper_id", F.col("status").alias("to_status"))
    applied, rejected = _settle(_with_target(_judge(asked, papers, F.lit(True))), ["paper_id"])
    return (
        _set(papers, applied.select("paper_id", "to_status"), ["paper_id"], status=F.col("new.to_status")),
        _refused(rejected),
    )


def move(
    papers: DataFrame, requests: DataFrame, to_status: str, **values: Column
) -> DataFrame:
    check_statuses(to_status)
    return _set(papers, requests, ["paper_id"], status=F.lit(to_status), **values)


def merge_reports(
    papers: DataFrame, iterations: DataFrame, reports: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Open reports fill their round; their paper goes from with_replicator to
    replicator_back_de and follows its latest round.

    A report without round, or of a paper in another state, is rejected and leaves its paper
    alone; a round that exists is filled in any case. Of several open reports of a round the latest
    by ``timestamp`` counts (then the first by content) and the others are superseded. A report
    with a null key is rejected. Returns (papers, iterations, rejected).
    """
    todo = reports_to_process(reports, iterations)
    named = F.col("paper_id").isNotNull() & F.col("round").isNotNull()
    latest = [F.col("timestamp").isNull(), -F.unix_micros(F.col("timestamp").cast("timestamp"))]
    open_reports, rejected = _settle(todo.withColumn("reason", F.when(~named, "unnamed")), ROUND, *latest)
    unnamed = rejected.filter("reason = 'unnamed'").select(*ROUND)
    rejected = rejected.filter("reason <> 'unnamed'")
    columns = {to: F.col(f"new.{source}") for to, source in REPORT_FIELDS}
    filled = _set(iterations, open_reports, ROUND, **columns)

    asked = open_reports.select(*ROUND).unionByName(unnamed).withColumnRenamed("round", "_round")
    judged = _judge(asked, papers, F.col("status") == "with_replicator")
    judged = judged.drop("round", "status").withColumnRenamed("_round", "round")
    judged = _with_round(judged, iterations).select(*ROUND, "reason")
    judged = _landed(judged, f"{scratch_folder(papers.sparkSession, 'change', local=True)}/judged")
    back = judged.filter(F.col("reason").isNull()).select("paper_id").distinct()

    moved = move(papers, back, "replicator_back_de")
    touched = split_join(filled, back, ["paper_id"], "left_semi")
    return (
        update_from_latest(moved, touched),
        filled,
        judged.filter(F.col("reason").isNotNull()).unionByName(rejected.select(*ROUND, "reason")),
    )


def accept(
    papers: DataFrame, iterations: DataFrame, ids: DataFrame, as_of: dt.date
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Accept papers in whatever state.

    The current round is closed as accepted; after round 1, a paper without data statement takes
    its data from the round before, and an unstaffed round takes that round's replicators.
    A missing round isn't looked for and doesn't hinder acceptance. Returns (papers, iterations,
    rejected).
    """
    fine, rejected = _settle(_judge(ids.select("paper_id"), papers, F.lit(True), "data_statement"), ["paper_id"])
    asked = fine.select("paper_id")
    later = fine.filter(F.col("round") > 1)
    bare = later.filter(F.col("data_statement").isNull())
    before = bare.select("paper_id", (F.col("round") - 1).alias("round"))
    moved = update_from_round(
        move(papers, asked, "acceptable_package"), iterations, before)
    closed = _set(iterations, fine.select(*ROUND), ROUND,
                  date_decision_de=F.lit(as_of), decision_de=F.lit("accept"))
    return moved, carry_replicators(closed, later), _refused(rejected)


def revise(
    papers: DataFrame, iterations: DataFrame, ids: DataFrame, as_of: dt.date,
    file_requests: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Send papers back to their authors, from replicator_back_de only.

    The current round closes as "rnr"; a copy of it opens as the next one, with report fields and
    dates emptied and ``as_of`` as date with authors. ``file_requests`` (paper_id and
    file_request_* columns) gives the new round's request ids; without it they carry over.
    Of stored tables only keys and the rows of papers sent back are shuffled (`key_marked`). Returns
    (papers, iterations, rejected).
    """
    judged, held = _judge(ids.select("paper_id"), papers, F.col("status") == "replicator_back_de"), iterations
    folder = scratch_folder(papers.sparkSession, "change", local=True) if is_stored(iterations) else None
    if folder:  # judged twice, by the sieve and by what it leaves, so they land
        judged = _landed(judged, f"{folder}/judged")
        held = sieve(iterations.select(*ROUND), judged.filter(F.col("reason").isNull()), ROUND)
    fine, rejected = _settle(_with_round(judged, held), ["paper_id"])

    marked = key_marked(iterations, fine, ROUND, "_hit", folder and f"{folder}/hits")
    opened = marked.filter("_hit").drop("_hit")
    emptied = {name for name, _ in REPORT_FIELDS} | set(ROUND_DATES) | {"decision_de"}
    changes = {c: F.lit(None).cast(iterations.schema[c].dataType)
               for c in iterations.columns if c in emptied}
    changes |= {"round": F.col("round") + 1, "date_with_authors": F.lit(as_of)}
    opened = opened.withColumns(changes)
    if file_requests is not None:
        names = [c for c in file_requests.columns if c != "paper_id" and c in iterations.columns]
        opened = _set(opened, file_requests, ["paper_id"], **{c: F.col(f"new.{c}") for c in names})

    ended = {"date_decision_de": F.lit(as_of), "decision_de": F.lit("rnr")}
    closed = marked.withColumns({
        c: F.when(F.col("_hit"), v.cast(iterations.schema[c].dataType)).otherwise(F.col(c))
        for c, v in ended.items() if c in iterations.columns}).drop("_hit")
    taken = [c for c in ("file_request_id_pkg", "file_request_id_paper")
             if c in opened.columns and c in papers.columns]
    others, back = None, papers
    if is_stored(papers):
        others, back = (key_rows(papers, fine, "paper_id", how) for how in ("left_anti", "left_semi"))
    moved = move(
        back, opened.select("paper_id", "round", *taken), "with_author", round=F.col("new.round"),
        date_with_authors=F.lit(as_of), **{c: F.col(f"new.{c}") for c in taken})
    return moved if others is None else others.unionByName(moved), closed.unionByName(opened), _refused(rejected)


def assign(
    iterations: DataFrame, papers: DataFrame, picks: DataFrame, as_of: dt.date,
    overwrite: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Give the latest round of papers to the picked replicators.

    ``picks`` holds (paper_id, replicator1, replicator2) and optionally ``submitted``, the day the
    package came in. Normally papers go from author_back_de to with_replicator and an empty second
    pick leaves slot 2 alone; a pick without first replicator is rejected. With ``overwrite`` (reassigning) the state does not matter and stays,
    and slot 2 is always replaced. Returns (papers, iterations, rejected).
    """
    allowed = F.lit(True) if overwrite else F.col("status") == "author_back_de"
    judged = _also(_judge(picks, papers, allowed).drop("round"), "no_replicator", F.col("replicator1").isNull())
    # rounds of the papers picked only
    asked = judged.filter(F.col("reason").isNull()).select("paper_id").distinct()
    rounds = split_join(iterations.select(*ROUND), asked, ["paper_id"], "left_semi")
    latest = rounds.groupBy("paper_id").agg(F.max("round").alias("round")).filter("round IS NOT NULL")
    judged = _also(split_join(judged, latest, ["paper_id"], "left"), "no_iteration", F.col("round").isNull())
    fine, rejected = _settle(judged, ["paper_id"])
    second = F.col("new.replicator2")
    values = {
        "replicator1": F.col("new.replicator1"),
        "replicator2": second if overwrite else F.coalesce(second, "replicator2"),
        "date_assigned_repl": F.lit(as_of),
    }
    if "submitted" in picks.columns and not overwrite:
        values["date_arrived_from_authors"] = F.coalesce("new.submitted", "date_arrived_from_authors")
    given = _set(iterations, fine.drop("status"), ROUND, **values)
    moved = papers if overwrite else move(papers, fine.select("paper_id"), "with_replicator")
    return moved, given, _refused(rejected)


def mark_arrived(
    papers: DataFrame, iterations: DataFrame, ids: DataFrame, as_of: dt.date
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Packages received: from with_author to author_back_de, with the day on the round.

    ``ids`` holds paper_id and optionally ``round`` (else the paper's) and ``arrived`` (else
    ``as_of``). A paper whose round doesn't exist stays. Returns (papers, iterations, rejected).
    """
    asked = ids.withColumnsRenamed({"round": "_round"}) if "round" in ids.columns else ids
    judged = _judge(asked, papers, F.col("status") == "with_author")
    if "_round" in judged.columns:
        judged = judged.withColumn("round", F.coalesce("_round", "round")).drop("_round")
    fine, rejected = _settle(_with_round(judged, iterations), ["paper_id"])
    day = F.coalesce("arrived", F.lit(as_of)) if "arrived" in ids.columns else F.lit(as_of)
    return (
        move(papers, fine.select("paper_id"), "author_back_de"),
        _set(iterations, fine.select(*ROUND, day.alias("day")), ROUND, date_arrived_from_authors=F.col("new.day")),
        _refused(rejected),
    )


def publish(
    papers: DataFrame, dois: DataFrame, as_of: dt.date
) -> tuple[DataFrame, DataFrame]:
    """Published papers get DOI and date, from acceptable_package only; ``dois`` holds
    (paper_id, doi). A null DOI is rejected. Returns (papers, rejected)."""
    judged = _judge(dois.select("paper_id", F.col("doi").alias("_doi")), papers, F.col("status") == "acceptable_package")
    fine, rejected = _settle(_also(judged, "no_doi", F.col("_doi").isNull()), ["paper_id"])
    moved = move(papers, fine.select("paper_id", "_doi"), "published_package",
                 doi=F.col("new._doi"), date_published=F.lit(as_of))
    return moved, _refused(rejected)


def purge(
    tables: dict[str, DataFrame], ids: DataFrame, stored: bool = False
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every table without the given papers, and a log with the rows deleted per table.

    Keep `snapshots.snapshot` of the tables before committing the result. Of ``stored`` tables
    only keys are shuffled (`key_rows`).
    """
    gone = ids.select("paper_id").distinct()
    kept = {name: (key_rows(df, gone, "paper_id", "left_anti") if stored else split_join(df, gone, ["paper_id"], "left_anti")) for name, df in tables.items()}
    log = reduce(DataFrame.unionByName, [
        split_join(df, gone, ["paper_id"], "left_semi").agg(F.count("*").alias("n_rows")).select(
            F.lit("delete").alias("operation"), F.lit(name).alias("target"),
            F.lit("success").alias("status"), "n_rows",
            F.concat(F.lit("Deleted "), F.col("n_rows").cast("string"), F.lit(" rows")).alias("details"))
        for name, df in tables.items()
    ])
    return kept, log


def purge_tests(tables: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every table without its own rows marked as tests, and the log."""
    kept = {name: df.filter(~is_test(F.col("comments"))) for name, df in tables.items()}
    log = reduce(DataFrame.unionByName, [
        df.agg(F.count_if(is_test(F.col("comments"))).alias("n_rows")).select(
            F.lit("delete").alias("operation"), F.lit(name).alias("target"),
            F.lit("success").alias("status"), "n_rows",
            F.concat(F.lit("Deleted "), F.col("n_rows").cast("string"), F.lit(" rows")).alias("details"))
        for name, df in tables.items()
    ])
    return kept, log
