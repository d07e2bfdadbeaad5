"""Scans, filters, joins, sets, windows and orderings."""

from __future__ import annotations

from pyspark.sql import functions as F

from galleyproof import operators as ops
from galleyproof import schemas
from galleyproof.plans import quality
from galleyproof.session import scratch_folder
from galleyproof.sources import (
    append_csv, drop_column, export_csv, read_snapshot, replace_table, table,
)

from .fixtures import AS_OF
from .registry import query

PAPER_COLS = "paper_id, paper_slug, status, round, first_arrival_date, date_published, is_confidential, comments"
ITER_COLS = ("paper_id, round, replicator1, replicator2, CAST(hours1 AS DOUBLE) AS hours1, "
             "date_assigned_repl, date_completed_repl, decision_de")


def short(df):
    return df.select(*[c.strip() for c in PAPER_COLS.split(",")])


def rounds_short(df):
    return df.select("paper_id", "round", "replicator1", "replicator2",
                     F.col("hours1").cast("double").alias("hours1"), "date_assigned_repl",
                     "date_completed_repl", "decision_de")


def replicator_sheet(t):
    return t.replicators.withColumnRenamed("can_take", "can_take_+1_package")


# ---- scans, sources, sinks -------------------------------------------------------------------

@query("table", f"SELECT {PAPER_COLS} FROM papers")
def _(t):
    folder = scratch_folder(t.spark, "tables", local=True)
    replace_table(short(t.papers), folder, "papers")
    return table(t.spark, folder, "papers")


@query("columns", "SELECT paper_id, round, status FROM papers")
def _(t):
    return ops.columns(t.papers, ["paper_id", "round", "status"])


@query("columns_where", "SELECT paper_id, round FROM papers WHERE status = 'with_author'")
def _(t):
    return ops.columns(t.papers, ["paper_id", "round"], ("status", "with_author"))


@query("read_snapshot", f"SELECT {PAPER_COLS} FROM papers")
def _(t):
    folder = scratch_folder(t.spark, "csv", local=True)
    df = short(t.papers)
    export_csv(df, folder)
    return read_snapshot(t.spark, folder, df.schema)


@query("export_csv", "SELECT paper_id, title, status FROM papers WHERE comments IS NULL")
def _(t):
    folder = scratch_folder(t.spark, "csv", local=True)
    export_csv(t.papers.filter("comments IS NULL").select("paper_id", "title", "status"), folder)
    return t.spark.read.csv(folder, header=True)


@query("read_snapshot_ids", f"SELECT {PAPER_COLS} FROM papers WHERE status = 'acceptable_package'")
def _(t):
    folder = scratch_folder(t.spark, "csv", local=True)
    df = short(t.papers)
    export_csv(df, folder)
    wanted = t.papers.filter("status = 'acceptable_package'").select("paper_id")
    return read_snapshot(t.spark, folder, df.schema).join(wanted, "paper_id", "left_semi")


@query("append_csv", "SELECT status, paper_slug FROM papers UNION ALL SELECT status, paper_slug FROM papers")
def _(t):
    folder = scratch_folder(t.spark, "csv", local=True)
    rows = t.papers.select("status", "paper_slug")
    append_csv(rows, folder)
    append_csv(rows, folder)
    return read_snapshot(t.spark, folder, rows.schema)


@query("replace_table", "SELECT paper_id, round FROM iterations")
def _(t):
    folder = scratch_folder(t.spark, "tables", local=True)
    replace_table(t.papers.select("paper_id", "round"), folder, "rounds")
    replace_table(t.iterations.select("paper_id", "round"), folder, "rounds")
    return table(t.spark, folder, "rounds")


@query("insert_by_name", """
    SELECT paper_id, journal, title, comments, processed FROM form_arrivals
    UNION ALL SELECT paper_id, journal, NULL, NULL, NULL FROM papers""")
def _(t):
    live = t.form_arrivals.select("paper_id", "journal", "title", "comments", "processed")
    return ops.insert_by_name(live, t.papers.select("journal", "paper_id"))


@query("where_eq", f"SELECT {ITER_COLS} FROM iterations WHERE decision_de = 'accept'")
def _(t):
    return rounds_short(ops.where_eq(t.iterations, "decision_de", "accept"))


@query("non_empty", """
    SELECT 'papers' AS table_name, COUNT(*) > 0 AS non_empty FROM papers
    UNION ALL SELECT 'unknown_state', COUNT(*) > 0 FROM papers WHERE status = 'none'""")
def _(t):
    return ops.non_empty_tables({"papers": t.papers, "unknown_state": t.papers.filter("status = 'none'")})


@query("table_stats", """
    SELECT 'papers' AS table_name, COUNT(*) AS n_rows, CAST(8 AS INT) AS n_columns FROM papers
    UNION ALL SELECT 'iterations', COUNT(*), CAST(8 AS INT) FROM iterations
    UNION ALL SELECT 'uploads', COUNT(*), CAST(4 AS INT) FROM uploads""")
def _(t):
    return ops.table_stats({"papers": short(t.papers), "iterations": rounds_short(t.iterations),
                            "uploads": t.uploads})


@query("published_packages", """
    SELECT source AS name, CONCAT('doi:10.7910/', page_id) AS doi, n_chars / 100.0 AS "sizeMB"
    FROM titled WHERE n_chars % 3 = 0""")
def _(t):
    return ops.published_packages(catalogue(t))


def catalogue(t):
    """Data sets in the shape of the landed JSON."""
    return t.datasets.select(
        "global_id", "name", F.array("author").alias("authors"),
        F.array("state").alias("publicationStatuses"), F.col("updated").alias("updatedAt"),
        F.upper("state").alias("versionState"), F.col("size_mb").cast("double").alias("size_mb"),
        F.array_compact(F.array(F.when(F.col("citation").isNotNull(), F.struct("citation")))).alias("publications"),
        "n_chars", "doc_id",
    )


# ---- filters ---------------------------------------------------------------------------------

@query("by_status", f"SELECT {PAPER_COLS} FROM papers WHERE status = 'with_replicator'")
def _(t):
    return short(ops.by_status(t.papers, "with_replicator"))


@query("by_two_statuses", f"SELECT {PAPER_COLS} FROM papers WHERE status IN ('with_author', 'new_arrival')")
def _(t):
    return short(ops.by_status(t.papers, "with_author", "new_arrival"))


@query("paper", f"SELECT {PAPER_COLS} FROM papers WHERE paper_id = '417'")
def _(t):
    return short(ops.paper(t.papers, "417"))


@query("iteration", f"SELECT {ITER_COLS} FROM iterations WHERE paper_id = '417'")
def _(t):
    return rounds_short(ops.iteration(t.iterations, "417"))


@query("iteration_round", f"SELECT {ITER_COLS} FROM iterations WHERE paper_id = '417' AND round = 2")
def _(t):
    return rounds_short(ops.iteration(t.iterations, "417", 2))


@query("by_surname", """
    SELECT paper_id, surname_of_author, round, status FROM papers
    WHERE regexp_matches(surname_of_author, '(?i)^author1[0-4]')""")
def _(t):
    return ops.by_surname(t.papers, "author1[0-4]")


@query("without_tests", """
    SELECT paper_id, round FROM iterations
    WHERE paper_id NOT IN (SELECT paper_id FROM papers WHERE comments = '[TEST]')""")
def _(t):
    return ops.without_tests(t.papers, t.iterations)[1].select("paper_id", "round")


@query("without_test_papers", f"SELECT {PAPER_COLS} FROM papers WHERE comments IS NULL OR comments <> '[TEST]'")
def _(t):
    return short(ops.without_tests(t.papers, t.iterations)[0])


@query("dropna", f"SELECT {ITER_COLS} FROM iterations WHERE replicator2 IS NOT NULL AND hours2 IS NOT NULL")
def _(t):
    return rounds_short(ops.dropna(t.iterations, ["replicator2", "hours2"]))


@query("de_waiting", """
    SELECT paper_id, paper_slug, round, surname_of_author, status FROM papers
    WHERE status IN ('author_back_de', 'replicator_back_de')""")
def _(t):
    return ops.de_waiting(t.papers)


@query("availability", """
    SELECT email, current_workload, COALESCE(can_take = 'Yes', FALSE) AS available FROM replicators""")
def _(t):
    return ops.availability(replicator_sheet(t))


@query("available", "SELECT email, current_workload FROM replicators WHERE can_take = 'Yes'")
def _(t):
    return ops.available(replicator_sheet(t))


@query("unprocessed", "SELECT paper_id, title FROM form_arrivals WHERE NOT processed")
def _(t):
    return ops.unprocessed(t.form_arrivals).select("paper_id", "title")


@query("recent_datasets", """
    SELECT global_id FROM datasets WHERE updated <> 'unknown'
    AND CAST(substr(updated, 1, 10) AS DATE) >= DATE '2002-02-01' - 90""")
def _(t):
    return ops.recent_datasets(catalogue(t), AS_OF, 90).select("global_id")


@query("polish_names", "SELECT paper_id, round AS current_round FROM papers")
def _(t):
    return ops.polish_names(t.papers.select("paper_id", "round").toDF("Paper ID", "currentRound"))


@query("rename_select", "SELECT title AS manuscript_title, paper_id FROM papers")
def _(t):
    return ops.rename_select(t.papers, {"title": "manuscript_title", "absent": "x"},
                             ["manuscript_title", "paper_id"])


@query("select_matching", """
    SELECT round, file_request_id_pkg, file_request_id_paper, file_request_url_pkg FROM iterations""")
def _(t):
    return ops.select_matching(t.iterations, "file_request_(id|url)_", "round")


@query("update_where", """
    SELECT paper_id, CASE WHEN comments = '[TEST]' THEN 'test' ELSE software END AS software FROM papers""")
def _(t):
    done = ops.update_where(t.papers, F.col("comments") == "[TEST]", "software", "test")
    return done.select("paper_id", "software")


@query("delete_where", """
    SELECT paper_id, status, software FROM papers
    WHERE NOT COALESCE(status = 'with_author' AND software = 'Julia', FALSE)""")
def _(t):
    left = ops.delete_where(t.papers, {"status": "with_author", "software": "Julia"})
    return left.select("paper_id", "status", "software")


@query("conform", """
    SELECT paper_id, CAST(NULL AS VARCHAR) AS gh_org_repo, CAST(round AS INT) AS round,
        CAST(NULL AS VARCHAR) AS handling_editor FROM papers""")
def _(t):
    full = quality.conform(t.papers, schemas.PAPERS)
    return full.select("paper_id", "gh_org_repo", "round", "handling_editor")


@query("drop_column", "SELECT paper_id, status FROM papers")
def _(t):
    return drop_column(t.papers.select("paper_id", "status", "doi"), "doi")


# ---- joins -----------------------------------------------------------------------------------

@query("assigned_rounds", """
    SELECT paper_id, round, replicator1, replicator2, status
    FROM papers JOIN (SELECT paper_id, round, replicator1, replicator2 FROM iterations
        WHERE COALESCE(replicator1, replicator2) IS NOT NULL) staffed USING (paper_id, round)""")
def _(t):
    return ops.assigned_rounds(t.iterations, t.papers).select(
        "paper_id", "round", "replicator1", "replicator2", "status")


@query("reports_to_process", """
    SELECT paper_id, round, email_of_replicator_1, comments FROM reports WHERE NOT EXISTS (
        SELECT 1 FROM iterations done WHERE done.paper_id = reports.paper_id AND done.round = reports.round
            AND done.date_completed_repl IS NOT NULL AND done.replicator1 IS NOT NULL
            AND (reports.email_of_replicator_1 IS NULL OR reports.email_of_replicator_1 = done.replicator1))""")
def _(t):
    return ops.reports_to_process(t.reports, t.iterations).select(
        "paper_id", "round", "email_of_replicator_1", "comments")


_BATCH = """
    SELECT CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id * 3 AS VARCHAR) END AS paper_id,
        CASE WHEN event_type = 'view' THEN NULL ELSE CAST(user_id % 4 AS INT) END AS round FROM events"""
_LIVE = """
    SELECT paper_id, round FROM iterations UNION ALL
    SELECT paper_id, NULL FROM papers WHERE status = 'with_author' UNION ALL
    SELECT CASE WHEN r_regionkey > 99 THEN r_name END, r_regionkey FROM region"""


def _batch_live(t):
    batch = t.events.select(
        F.when(F.col("event_type") != "error", (F.col("event_id") * 3).cast("string")).alias("paper_id"),
        F.when(F.col("event_type") != "view", (F.col("user_id") % 4).cast("int")).alias("round"))
    open_papers = t.papers.filter("status = 'with_author'").select("paper_id")
    nothing = t.region.select(
        F.when(F.col("r_regionkey") > 99, F.col("r_name")).alias("paper_id"),
        F.col("r_regionkey").alias("round"))
    live = t.iterations.select("paper_id", "round").unionByName(
        open_papers, allowMissingColumns=True).unionByName(nothing)
    return batch, live


@query("new_rows", f"""
    SELECT b.paper_id, b.round FROM ({_BATCH}) b
    WHERE NOT EXISTS (SELECT 1 FROM ({_LIVE}) l WHERE l.paper_id = b.paper_id AND l.round = b.round)""")
def _(t):
    batch, live = _batch_live(t)
    return ops.new_rows(batch, live, ["paper_id", "round"])


@query("new_rows_null_safe", f"""
    SELECT b.paper_id, b.round FROM ({_BATCH}) b
    WHERE NOT EXISTS (SELECT 1 FROM ({_LIVE}) l WHERE l.paper_id IS NOT DISTINCT FROM b.paper_id
                      AND l.round IS NOT DISTINCT FROM b.round)""")
def _(t):
    batch, live = _batch_live(t)
    return ops.new_rows(batch, live, ["paper_id", "round"], null_safe=True)


@query("new_rows_single_key", f"""
    SELECT b.paper_id, b.round FROM ({_BATCH}) b
    WHERE NOT EXISTS (SELECT 1 FROM ({_LIVE}) l WHERE l.paper_id = b.paper_id)""")
def _(t):
    batch, live = _batch_live(t)
    return ops.new_rows(batch, live, "paper_id")


@query("waiting_rounds", """
    SELECT p.paper_id, p.status, i.round, i.paper_slug
    FROM papers p LEFT JOIN iterations i ON p.paper_id = i.paper_id
    WHERE p.status IN ('with_author', 'new_arrival')""")
def _(t):
    return ops.waiting_rounds(t.papers, t.iterations).select("paper_id", "status", "round", "paper_slug")


_FOLLOW = ", ".join(
    f"CASE WHEN l.paper_id IS NULL THEN p.{c} ELSE l.{c} END AS {c}" for c in
    ["data_statement", "software", "is_remote", "is_HPC", "is_confidential", "share_confidential"])
FOLLOW_COLS = ["paper_id", "status", "data_statement", "software", "is_remote", "is_HPC",
               "is_confidential", "share_confidential"]


@query("update_from_latest", f"""
    SELECT p.paper_id, p.status, {_FOLLOW} FROM papers p LEFT JOIN (
        SELECT * FROM iterations WHERE (paper_id, round) IN (
            SELECT (paper_id, MAX(round)) FROM iterations GROUP BY paper_id)) l ON l.paper_id = p.paper_id""")
def _(t):
    return ops.update_from_latest(t.papers, t.iterations).select(*FOLLOW_COLS)


@query("update_from_round", f"""
    SELECT p.paper_id, p.status, {_FOLLOW} FROM papers p LEFT JOIN iterations l
    ON p.paper_id = l.paper_id AND l.round = p.round - 1 AND p.status = 'acceptable_package'""")
def _(t):
    chosen = t.papers.filter("status = 'acceptable_package'").select(
        "paper_id", (F.col("round") - 1).alias("round"))
    return ops.update_from_round(t.papers, t.iterations, chosen).select(*FOLLOW_COLS)


@query("carry_replicators", """
    SELECT c.paper_id, c.round,
        CASE WHEN c.replicator1 IS NULL AND b.paper_id IS NOT NULL THEN b.replicator1 ELSE c.replicator1 END AS replicator1,
        CASE WHEN c.replicator1 IS NULL AND b.paper_id IS NOT NULL THEN b.replicator2 ELSE c.replicator2 END AS replicator2
    FROM iterations c LEFT JOIN iterations b ON c.paper_id = b.paper_id AND b.round = c.round - 1""")
def _(t):
    return ops.carry_replicators(t.iterations).select("paper_id", "round", "replicator1", "replicator2")


@query("exists_rows", """
    SELECT DISTINCT u.paper_id, EXISTS (SELECT 1 FROM papers p WHERE p.paper_id = u.paper_id) AS present
    FROM (SELECT CAST(user_id * 137 AS VARCHAR) AS paper_id FROM events) u""")
def _(t):
    wanted = t.events.select((F.col("user_id") * 137).cast("string").alias("paper_id"))
    return ops.exists_rows(t.papers, wanted, ["paper_id"])


# ---- windows ---------------------------------------------------------------------------------

@query("latest_iteration", f"""
    SELECT {ITER_COLS} FROM iterations WHERE NOT EXISTS (
        SELECT 1 FROM iterations later WHERE later.paper_id = iterations.paper_id AND later.round > iterations.round)""")
def _(t):
    return rounds_short(ops.latest_iteration(t.iterations))


@query("current_rounds", f"""
    SELECT {ITER_COLS} FROM iterations QUALIFY round = MAX(round) OVER (PARTITION BY paper_id)""")
def _(t):
    return rounds_short(ops.current_rounds(t.iterations))


@query("with_previous_round", """
    SELECT c.paper_id, c.round, b.replicator1 AS prev_replicator1, b.replicator2 AS prev_replicator2
    FROM iterations c LEFT JOIN iterations b ON c.paper_id = b.paper_id AND b.round = c.round - 1""")
def _(t):
    return ops.with_previous_round(t.iterations, ["replicator1", "replicator2"]).select(
        "paper_id", "round", "prev_replicator1", "prev_replicator2")


# ---- aggregates ------------------------------------------------------------------------------

@query("count_where", "SELECT COUNT(*) AS count FROM papers WHERE status = 'with_author'")
def _(t):
    return ops.count_where(t.papers, "status", "with_author")


@query("all_missing", """
    SELECT COUNT(replicator2) = 0 AS replicator2, COUNT(hours1) = 0 AS hours1,
        COUNT(comments) = 0 AS comments FROM iterations""")
def _(t):
    return ops.all_missing(t.iterations, ["replicator2", "hours1", "comments"])


@query("duplicate_keys", """
    SELECT CAST(l_orderkey AS VARCHAR) AS paper_id, l_linenumber AS round, COUNT(*) AS n_rows
    FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def _(t):
    rows = t.lineitem.select(F.col("l_orderkey").cast("string").alias("paper_id"),
                             F.col("l_linenumber").alias("round"))
    return ops.duplicate_keys(rows, ["paper_id", "round"])


@query("last_modified", """
    SELECT CAST(latest_date AS DATE) AS latest_date, strftime(t, '%Y-%m-%d %H:%M:%S') AS latest_datetime,
        strftime(COALESCE(t, CAST(latest_date AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S') AS comparison_timestamp
    FROM (SELECT GREATEST((SELECT MAX(timestamp) FROM form_arrivals), (SELECT MAX(timestamp) FROM reports)) AS t,
        GREATEST((SELECT MAX(date_with_authors) FROM iterations), (SELECT MAX(date_with_authors) FROM papers))
            AS latest_date) x""")
def _(t):
    row = ops.last_modified({"form_arrivals": t.form_arrivals, "reports": t.reports,
                             "iterations": t.iterations, "papers": t.papers})
    fmt = "yyyy-MM-dd HH:mm:ss"
    return row.select("latest_date", F.date_format("latest_datetime", fmt).alias("latest_datetime"),
                      F.date_format("comparison_timestamp", fmt).alias("comparison_timestamp"))


@query("package_sizes", """
    SELECT package, COUNT(*) AS n_files, CAST(SUM(size) AS BIGINT) AS bytes,
        CAST(SUM(size) AS BIGINT) / (1024.0::DOUBLE * 1024) AS size_mb,
        round_even(CAST(SUM(size) AS BIGINT) / (1024.0::DOUBLE * 1024 * 1024), 2) AS size_gb
    FROM manifest GROUP BY package""")
def _(t):
    return ops.package_sizes(t.manifest)


@query("largest_files", """
    SELECT package, path, size, size / (1024.0::DOUBLE * 1024 * 1024) AS size_gb FROM manifest""")
def _(t):
    return ops.largest_files(t.manifest.select("package", "path", "size"))


# ---- orders and sets -------------------------------------------------------------------------

@query("rounds", f"SELECT {ITER_COLS} FROM iterations ORDER BY paper_id, round")
def _(t):
    return rounds_short(ops.rounds(t.iterations))


_SNAPS = """
    SELECT event_type AS kind, ts AS snapshot_ts, CONCAT('snap/', event_id) AS path FROM events"""


def _snaps(t):
    return t.events.select(F.col("event_type").alias("kind"), F.col("ts").alias("snapshot_ts"),
                           F.concat(F.lit("snap/"), F.col("event_id").cast("string")).alias("path"))


@query("expired_snapshots", f"""
    SELECT kind, path FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY snapshot_ts DESC, path DESC) AS rn
    FROM ({_SNAPS}) s) x WHERE rn > 10""")
def _(t):
    return ops.expired_snapshots(_snaps(t), 10).select("kind", "path")


@query("latest_snapshot", f"""
    SELECT kind, path FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY kind
        ORDER BY snapshot_ts DESC, path DESC) AS rn FROM ({_SNAPS}) s) x WHERE rn = 1""")
def _(t):
    return ops.latest_snapshot(_snaps(t)).select("kind", "path")


@query("two_slots", """
    SELECT paper_id, round, 1 AS slot, replicator1 AS replicator, CAST(hours1 AS DOUBLE) AS hours
    FROM iterations WHERE replicator1 IS NOT NULL UNION ALL
    SELECT paper_id, round, 2, replicator2, CAST(hours2 AS DOUBLE) FROM iterations
    WHERE replicator2 IS NOT NULL""")
def _(t):
    rows = ops.two_slots(t.iterations, ["paper_id", "round"])
    return rows.withColumn("hours", F.col("hours").cast("double"))


@query("missing_ids", """
    SELECT paper_id FROM form_arrivals EXCEPT SELECT paper_id FROM papers""")
def _(t):
    return ops.missing_ids(t.form_arrivals, t.papers, "paper_id")


@query("reminders", """
    SELECT paper_id, round, status FROM papers WHERE status = 'with_author' AND paper_id IN (
        SELECT paper_id FROM uploads WHERE kind = 'package' AND file_count > 0)""")
def _(t):
    arrived = t.uploads.filter("kind = 'package' AND file_count > 0")
    waiting = t.papers.filter("status = 'with_author'").select("paper_id", "round", "status")
    return ops.reminders(arrived, waiting)


@query("distinct_on", "SELECT DISTINCT paper_id, kind FROM uploads")
def _(t):
    return ops.distinct_on(t.uploads, ["paper_id", "kind"]).select("paper_id", "kind")
