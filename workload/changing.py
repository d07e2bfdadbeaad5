"""Ingest, state changes, quality and recovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from galleyproof.plans import changes, ingest, quality, recovery, snapshots
from galleyproof.operators import last_modified
from galleyproof.session import scratch_folder
from galleyproof.sources import VersionedTables
from galleyproof.streaming import apply_arrivals, ingest_forms, record_arrivals

from .fixtures import AS_OF, AS_OF_SQL
from .functions import ASCII
from .registry import query

# question texts as the arrivals form shows them
QUESTIONS = [
    "Timestamp", "Please indicate the journal", "Manuscript ID in Editorial Manager",
    "Manuscript title", "First name of author", "Surname of author", "Email of author",
    "Email of second author (if applicable)", "Handling editor",
    "Does this submission contain numerical work of any kind?",
    "Is any of the data used in this manuscript subject to access restrictions?",
    "Can the confidential data temporarily be shared with the Data Editor for replication checks?",
    "Comments",
]
REPORT_QUESTIONS = {
    "timestamp": "Timestamp", "paper_id": "Paper ID", "journal": "Journal", "round": "Round",
    "email_of_replicator_1": "Email of Replicator 1",
    "email_of_replicator_2": "Email of Replicator 2 (if applicable)",
    "hours_replicator_1": "Hours Replicator 1",
    "hours_replicator_2": "Hours Replicator 2 (if applicable)",
    "is_success": "Replication Successul", "software_used_in_package": "Software used in package",
    "data_statement": "Data statement", "comments": "Comments",
    "running_time_of_code": "What was the total runtime of this package in hours?",
    "is_confidential": "Does the package rely on confidential data, i.e. not all required data "
                       "can be included in the package?",
    "shared_confidential": "Was the confidential data shared with us?",
    "is_remote": "Did you perform a remote replication?",
    "is_HPC": "Did the package contain high performance computing (HPC) requirements (whether or "
              "not we ran those parts)?",
}


def arrival_form(t):
    return t.raw_arrivals.toDF(*QUESTIONS)


def report_form(t):
    """The reports as typed into the form: rounds and ids as decimals, flags as Yes and No."""
    flags = ["is_success", "is_confidential", "shared_confidential", "is_remote", "is_HPC"]
    df = t.reports.withColumns({
        "round": F.col("round").cast("double"), "paper_id": F.concat("paper_id", F.lit(".0")),
        **{c: F.when(F.col(c), "Yes").otherwise("No") for c in flags}})
    return df.select(*[F.col(c).alias(q) for c, q in REPORT_QUESTIONS.items()]).withColumns(
        {"Please enter the password for this form": F.lit("x"), "Email address": F.lit("y"),
         "Did push your report to the GitHub repo of this paper": F.lit("Yes")})


_ID = "CAST(CAST(floor(TRY_CAST(manuscript_id AS DOUBLE)) AS BIGINT) AS VARCHAR)"
_CLEAN = f"""
    SELECT ts AS timestamp, replace(journal, ':', '-') AS journal, {_ID} AS paper_id, title,
        last_name AS surname_of_author, email2 AS email_of_second_author, confidential AS is_confidential,
        shareable AS share_confidential, comments, {ASCII.format(c='last_name')} || '-' || {_ID} AS paper_slug
    FROM raw_arrivals WHERE theory IS NULL OR theory <> 'No - Pure theory paper'"""
_CLEAN_COLS = ["journal", "paper_id", "title", "surname_of_author", "email_of_second_author",
               "is_confidential", "share_confidential", "comments", "paper_slug"]


@query("clean_arrivals", f"SELECT {', '.join(_CLEAN_COLS)}, FALSE AS processed FROM ({_CLEAN}) c")
def _(t):
    return ingest.clean_arrivals(arrival_form(t)).select(*_CLEAN_COLS, "processed")


@query("clean_reports", """
    SELECT paper_id, journal, CAST(round AS INT) AS round, email_of_replicator_1, email_of_replicator_2,
        CAST(hours_replicator_2 AS DOUBLE) AS hours_replicator_2, is_success, is_confidential,
        shared_confidential, is_remote, "is_HPC", CAST(running_time_of_code AS DOUBLE) AS running_time_of_code
    FROM reports""")
def _(t):
    df = ingest.clean_reports(report_form(t))
    return df.select(
        "paper_id", "journal", "round", "email_of_replicator_1", "email_of_replicator_2",
        F.col("hours_replicator_2").cast("double").alias("hours_replicator_2"), "is_success",
        "is_confidential", "shared_confidential", "is_remote", "is_HPC",
        F.col("running_time_of_code").cast("double").alias("running_time_of_code"))


@query("to_papers", f"""
    SELECT paper_id, paper_slug, 'new_arrival' AS status, CAST(1 AS INT) AS round,
        CAST(timestamp AS DATE) AS first_arrival_date, lower(is_confidential) = 'yes' AS is_confidential,
        lower(share_confidential) = 'yes' AS share_confidential, CAST(NULL AS DATE) AS date_with_authors,
        CAST(NULL AS BOOLEAN) AS "is_HPC", CAST(NULL AS VARCHAR) AS file_request_path
    FROM ({_CLEAN}) c""")
def _(t):
    return ingest.to_papers(ingest.clean_arrivals(arrival_form(t))).select(
        "paper_id", "paper_slug", "status", "round", "first_arrival_date", "is_confidential",
        "share_confidential", "date_with_authors", "is_HPC", "file_request_path")


_FRESH = f"""
    SELECT title, paper_id FROM (SELECT * FROM ({_CLEAN}) c
        QUALIFY ROW_NUMBER() OVER (PARTITION BY paper_id ORDER BY timestamp DESC) = 1) b
    WHERE NOT EXISTS (SELECT 1 FROM form_arrivals f WHERE f.paper_id = b.paper_id)"""


@query("append_new", f"SELECT title, paper_id FROM form_arrivals UNION ALL {_FRESH}")
def _(t):
    batch = ingest.clean_arrivals(arrival_form(t)).select(
        "timestamp", "paper_id", "title", "journal", "comments", "processed")
    return ingest.append_new(t.form_arrivals, batch, "paper_id").select("title", "paper_id")


# ---- state changes ---------------------------------------------------------------------------

_OPEN = """
    SELECT r.* FROM reports r LEFT JOIN iterations i ON r.paper_id = i.paper_id AND r.round = i.round
    WHERE i.date_completed_repl IS NULL OR i.replicator1 IS NULL OR i.replicator1 <> r.email_of_replicator_1"""
_BACK = f"""
    SELECT DISTINCT o.paper_id FROM ({_OPEN}) o
    JOIN iterations i ON i.paper_id = o.paper_id AND i.round = o.round
    JOIN papers p ON p.paper_id = o.paper_id AND p.status = 'with_replicator'"""
_FILLED = f"""
    SELECT i.paper_id, i.round, i.decision_de, i.share_confidential,
        CASE WHEN o.paper_id IS NULL THEN i.replicator1 ELSE o.email_of_replicator_1 END AS replicator1,
        CASE WHEN o.paper_id IS NULL THEN i.replicator2 ELSE o.email_of_replicator_2 END AS replicator2,
        CAST(CASE WHEN o.paper_id IS NULL THEN i.hours1 ELSE o.hours_replicator_1 END AS DOUBLE) AS hours1,
        CAST(CASE WHEN o.paper_id IS NULL THEN i.hours2 ELSE o.hours_replicator_2 END AS DOUBLE) AS hours2,
        CASE WHEN o.paper_id IS NULL THEN i.is_success ELSE o.is_success END AS is_success,
        CASE WHEN o.paper_id IS NULL THEN i.software ELSE o.software_used_in_package END AS software,
        CASE WHEN o.paper_id IS NULL THEN i.is_confidential ELSE o.is_confidential END AS is_confidential,
        CASE WHEN o.paper_id IS NULL THEN i.is_confidential_shared ELSE o.shared_confidential END
            AS is_confidential_shared,
        CASE WHEN o.paper_id IS NULL THEN i.is_remote ELSE o.is_remote END AS is_remote,
        CASE WHEN o.paper_id IS NULL THEN i."is_HPC" ELSE o."is_HPC" END AS "is_HPC",
        CAST(CASE WHEN o.paper_id IS NULL THEN i.runtime_code_hours ELSE o.running_time_of_code END
            AS DOUBLE) AS runtime_code_hours,
        CASE WHEN o.paper_id IS NULL THEN i.data_statement ELSE o.data_statement END AS data_statement,
        CASE WHEN o.paper_id IS NULL THEN i.repl_comments ELSE o.comments END AS repl_comments,
        CASE WHEN o.paper_id IS NULL THEN i.date_completed_repl ELSE CAST(o.timestamp AS DATE) END
            AS date_completed_repl
    FROM iterations i LEFT JOIN ({_OPEN}) o ON o.paper_id = i.paper_id AND o.round = i.round"""
_FILLED_COLS = ["paper_id", "round", "decision_de", "share_confidential", "replicator1", "replicator2",
                "hours1", "hours2", "is_success", "software", "is_confidential",
                "is_confidential_shared", "is_remote", "is_HPC", "runtime_code_hours",
                "data_statement", "repl_comments", "date_completed_repl"]


@query("merge_reports_rounds", _FILLED)
def _(t):
    t = t.landed("li")
    rows = changes.merge_reports(t.papers, t.iterations, t.reports)[1].select(*_FILLED_COLS)
    return rows.withColumns({c: F.col(c).cast("double") for c in ("hours1", "hours2", "runtime_code_hours")})


@query("merge_reports", f"""
    SELECT p.paper_id, CASE WHEN b.paper_id IS NULL THEN p.status ELSE 'replicator_back_de' END AS status,
        CASE WHEN b.paper_id IS NULL THEN p.data_statement ELSE f.data_statement END AS data_statement,
        CASE WHEN b.paper_id IS NULL THEN p.software ELSE f.software END AS software,
        CASE WHEN b.paper_id IS NULL THEN p.is_remote ELSE f.is_remote END AS is_remote,
        CASE WHEN b.paper_id IS NULL THEN p."is_HPC" ELSE f."is_HPC" END AS "is_HPC",
        CASE WHEN b.paper_id IS NULL THEN p.share_confidential ELSE f.share_confidential END AS share_confidential
    FROM papers p LEFT JOIN ({_BACK}) b ON b.paper_id = p.paper_id
    LEFT JOIN (SELECT * FROM ({_FILLED}) x QUALIFY round = MAX(round) OVER (PARTITION BY paper_id)) f
        ON f.paper_id = p.paper_id""")
def _(t):
    t = t.landed("li")
    return changes.merge_reports(t.papers, t.iterations, t.reports)[0].select(
        "paper_id", "status", "data_statement", "software", "is_remote", "is_HPC", "share_confidential")


@query("merge_reports_rejected", f"""
    SELECT o.paper_id, o.round, CASE WHEN p.paper_id IS NULL THEN 'not_found'
        WHEN p.status <> 'with_replicator' THEN 'wrong_status' ELSE 'no_iteration' END AS reason
    FROM ({_OPEN}) o LEFT JOIN papers p ON p.paper_id = o.paper_id
    LEFT JOIN iterations i ON i.paper_id = o.paper_id AND i.round = o.round
    WHERE p.paper_id IS NULL OR p.status <> 'with_replicator' OR i.paper_id IS NULL""")
def _(t):
    t = t.landed("li")
    return changes.merge_reports(t.papers, t.iterations, t.reports)[2]


_REQUESTS = """
    SELECT DISTINCT CAST(user_id * 5 AS VARCHAR) AS paper_id, 'with_author' AS from_status,
        CASE WHEN user_id % 4 = 0 THEN 'nowhere' ELSE 'author_back_de' END AS to_status FROM events
    UNION ALL SELECT 'absent', 'with_author', 'author_back_de'"""


def _requests(t):
    asked = t.events.select(
        (F.col("user_id") * 5).cast("string").alias("paper_id"), F.lit("with_author").alias("from_status"),
        F.when(F.col("user_id") % 4 == 0, "nowhere").otherwise("author_back_de").alias("to_status"))
    extra = t.spark.createDataFrame([("absent", "with_author", "author_back_de")], asked.schema)
    return asked.unionByName(extra).distinct()


@query("transition", f"""
    SELECT p.paper_id, CASE WHEN p.status = q.from_status AND q.to_status <> 'nowhere' THEN q.to_status
        ELSE p.status END AS status
    FROM papers p LEFT JOIN ({_REQUESTS}) q ON q.paper_id = p.paper_id""")
def _(t):
    return changes.transition(t.papers, _requests(t))[0].select("paper_id", "status")


@query("transition_rejected", f"""
    SELECT q.paper_id, q.from_status, q.to_status, CASE WHEN q.to_status = 'nowhere' THEN 'bad_target'
        WHEN p.paper_id IS NULL THEN 'not_found' ELSE 'wrong_status' END AS reason
    FROM ({_REQUESTS}) q LEFT JOIN papers p ON p.paper_id = q.paper_id
    WHERE q.to_status = 'nowhere' OR p.paper_id IS NULL OR p.status <> q.from_status""")
def _(t):
    return changes.transition(t.papers, _requests(t))[1]


@query("set_status", f"""
    SELECT p.paper_id, CASE WHEN q.to_status <> 'nowhere' THEN q.to_status ELSE p.status END AS status
    FROM papers p LEFT JOIN ({_REQUESTS}) q ON q.paper_id = p.paper_id""")
def _(t):
    asked = _requests(t).select("paper_id", F.col("to_status").alias("status"))
    return changes.set_status(t.papers, asked)[0].select("paper_id", "status")


_IDS = "SELECT paper_id FROM papers WHERE status IN ('replicator_back_de', 'author_back_de')"


def _ids(t):
    return _asked(t.papers)


def _asked(papers):
    return papers.filter("status IN ('replicator_back_de', 'author_back_de')").select("paper_id")


@query("accept", f"""
    SELECT p.paper_id, CASE WHEN q.paper_id IS NULL THEN p.status ELSE 'acceptable_package' END AS status,
        CASE WHEN b.paper_id IS NULL THEN p.data_statement ELSE b.data_statement END AS data_statement,
        CASE WHEN b.paper_id IS NULL THEN p.software ELSE b.software END AS software,
        CASE WHEN b.paper_id IS NULL THEN p.is_confidential ELSE b.is_confidential END AS is_confidential
    FROM papers p LEFT JOIN ({_IDS}) q ON q.paper_id = p.paper_id
    LEFT JOIN iterations b ON b.paper_id = q.paper_id AND b.round = p.round - 1 AND p.round > 1
        AND p.data_statement IS NULL""")
def _(t):
    return changes.accept(t.papers, t.iterations, _ids(t), AS_OF)[0].select(
        "paper_id", "status", "data_statement", "software", "is_confidential")


@query("accept_rounds", f"""
    SELECT i.paper_id, i.round,
        CASE WHEN q.paper_id IS NULL THEN i.date_decision_de ELSE {AS_OF_SQL} END AS date_decision_de,
        CASE WHEN q.paper_id IS NULL THEN i.decision_de ELSE 'accept' END AS decision_de,
        CASE WHEN q.paper_id IS NOT NULL AND i.replicator1 IS NULL AND b.paper_id IS NOT NULL
             THEN b.replicator1 ELSE i.replicator1 END AS replicator1,
        CASE WHEN q.paper_id IS NOT NULL AND i.replicator1 IS NULL AND b.paper_id IS NOT NULL
             THEN b.replicator2 ELSE i.replicator2 END AS replicator2
    FROM iterations i LEFT JOIN (SELECT paper_id, round FROM papers WHERE paper_id IN ({_IDS})) q
        ON q.paper_id = i.paper_id AND q.round = i.round
    LEFT JOIN iterations b ON b.paper_id = i.paper_id AND b.round = i.round - 1""")
def _(t):
    return changes.accept(t.papers, t.iterations, _ids(t), AS_OF)[1].select(
        "paper_id", "round", "date_decision_de", "decision_de", "replicator1", "replicator2")


_FINE = """
    SELECT p.paper_id, p.round FROM papers p JOIN iterations i ON i.paper_id = p.paper_id AND i.round = p.round
    WHERE p.status = 'replicator_back_de'"""


@query("revise", f"""
    SELECT p.paper_id, CASE WHEN q.paper_id IS NULL THEN p.status ELSE 'with_author' END AS status,
        CASE WHEN q.paper_id IS NULL THEN p.round ELSE p.round + 1 END AS round,
        CASE WHEN q.paper_id IS NULL THEN p.date_with_authors ELSE {AS_OF_SQL} END AS date_with_authors,
        CASE WHEN q.paper_id IS NULL THEN p.file_request_id_pkg
             ELSE CONCAT('pkg-', p.paper_id, '-', p.round) END AS file_request_id_pkg
    FROM papers p LEFT JOIN ({_FINE}) q ON q.paper_id = p.paper_id""")
def _(t):
    return changes.revise(t.papers, t.iterations, _ids(t), AS_OF)[0].select(
        "paper_id", "status", "round", "date_with_authors", "file_request_id_pkg")


@query("revise_rounds", f"""
    SELECT i.paper_id, i.round, i.paper_slug, i.date_with_authors, i.date_completed_repl, i.replicator1,
        CAST(i.hours1 AS DOUBLE) AS hours1,
        CASE WHEN q.paper_id IS NULL THEN i.date_decision_de ELSE {AS_OF_SQL} END AS date_decision_de,
        CASE WHEN q.paper_id IS NULL THEN i.decision_de ELSE 'rnr' END AS decision_de
    FROM iterations i LEFT JOIN ({_FINE}) q ON q.paper_id = i.paper_id AND q.round = i.round
    UNION ALL
    SELECT i.paper_id, i.round + 1, i.paper_slug, {AS_OF_SQL}, NULL, NULL, NULL, NULL, NULL
    FROM iterations i JOIN ({_FINE}) q ON q.paper_id = i.paper_id AND q.round = i.round""")
def _(t):
    rows = changes.revise(t.papers, t.iterations, _ids(t), AS_OF)[1].select(
        "paper_id", "round", "paper_slug", "date_with_authors", "date_completed_repl", "replicator1",
        "hours1", "date_decision_de", "decision_de")
    return rows.withColumn("hours1", F.col("hours1").cast("double"))


@query("revise_rejected", """
    SELECT paper_id, 'wrong_status' AS reason FROM papers WHERE status = 'author_back_de' UNION ALL
    SELECT paper_id, 'no_iteration' FROM papers WHERE status = 'replicator_back_de'
        AND paper_id NOT IN (SELECT paper_id FROM iterations)""")
def _(t):
    return changes.revise(t.papers, t.iterations, _ids(t), AS_OF)[2]


_PICKS = """
    SELECT paper_id, CONCAT('new', round, '@example.org') AS replicator1,
        CASE WHEN round % 2 = 0 THEN 'second@example.org' END AS replicator2
    FROM papers WHERE status IN ('author_back_de', 'with_replicator')"""


def _picks(t):
    return t.papers.filter("status IN ('author_back_de', 'with_replicator')").select(
        "paper_id", F.concat(F.lit("new"), F.col("round").cast("string"), F.lit("@example.org")).alias("replicator1"),
        F.when(F.col("round") % 2 == 0, "second@example.org").alias("replicator2"))


def _assign_sql(allowed, second):
    return f"""
        SELECT i.paper_id, i.round, CASE WHEN q.paper_id IS NULL THEN i.replicator1 ELSE q.replicator1 END AS replicator1,
            CASE WHEN q.paper_id IS NULL THEN i.replicator2 ELSE {second} END AS replicator2,
            CASE WHEN q.paper_id IS NULL THEN i.date_assigned_repl ELSE {AS_OF_SQL} END AS date_assigned_repl
        FROM (SELECT *, MAX(round) OVER (PARTITION BY paper_id) AS last FROM iterations) i
        LEFT JOIN (SELECT k.* FROM ({_PICKS}) k JOIN papers p ON p.paper_id = k.paper_id WHERE {allowed}) q
            ON q.paper_id = i.paper_id AND i.round = i.last"""


@query("assign_rounds", _assign_sql("p.status = 'author_back_de'", "COALESCE(q.replicator2, i.replicator2)"))
def _(t):
    return changes.assign(t.iterations, t.papers, _picks(t), AS_OF)[1].select(
        "paper_id", "round", "replicator1", "replicator2", "date_assigned_repl")


@query("assign", """
    SELECT p.paper_id, CASE WHEN p.status = 'author_back_de' AND EXISTS (
        SELECT 1 FROM iterations i WHERE i.paper_id = p.paper_id) THEN 'with_replicator' ELSE p.status END AS status
    FROM papers p""")
def _(t):
    return changes.assign(t.iterations, t.papers, _picks(t), AS_OF)[0].select("paper_id", "status")


@query("reassign_rounds", _assign_sql("TRUE", "q.replicator2"))
def _(t):
    return changes.assign(t.iterations, t.papers, _picks(t), AS_OF, overwrite=True)[1].select(
        "paper_id", "round", "replicator1", "replicator2", "date_assigned_repl")


_CAME = "SELECT DISTINCT paper_id FROM uploads WHERE kind = 'package' AND file_count > 0"


def _came(t):
    return t.uploads.filter("kind = 'package' AND file_count > 0").select("paper_id")


@query("mark_arrived", f"""
    SELECT p.paper_id, CASE WHEN p.status = 'with_author' AND p.paper_id IN ({_CAME}) AND EXISTS (
        SELECT 1 FROM iterations i WHERE i.paper_id = p.paper_id AND i.round = p.round)
        THEN 'author_back_de' ELSE p.status END AS status FROM papers p""")
def _(t):
    return changes.mark_arrived(t.papers, t.iterations, _came(t), AS_OF)[0].select("paper_id", "status")


@query("mark_arrived_rounds", f"""
    SELECT i.paper_id, i.round, CASE WHEN p.paper_id IS NULL THEN i.date_arrived_from_authors
        ELSE {AS_OF_SQL} END AS date_arrived_from_authors
    FROM iterations i LEFT JOIN papers p ON p.paper_id = i.paper_id AND p.round = i.round
        AND p.status = 'with_author' AND p.paper_id IN ({_CAME})""")
def _(t):
    return changes.mark_arrived(t.papers, t.iterations, _came(t), AS_OF)[1].select(
        "paper_id", "round", "date_arrived_from_authors")


@query("publish", f"""
    SELECT paper_id, CASE WHEN status = 'acceptable_package' THEN 'published_package' ELSE status END AS status,
        CASE WHEN status = 'acceptable_package' THEN CONCAT('doi:10.7999/', paper_id) ELSE doi END AS doi,
        CASE WHEN status = 'acceptable_package' THEN {AS_OF_SQL} ELSE date_published END AS date_published
    FROM papers""")
def _(t):
    dois = t.papers.select("paper_id", F.concat(F.lit("doi:10.7999/"), "paper_id").alias("doi"))
    return changes.publish(t.papers, dois, AS_OF)[0].select("paper_id", "status", "doi", "date_published")


# Several requests for a paper, repeated ones and nulls: every one is applied or rejected.

_RIVALS = """
    SELECT CAST(user_id * 5 AS VARCHAR) AS paper_id, 'with_author' AS from_status,
        CASE WHEN user_id % 4 = 0 THEN 'nowhere' WHEN event_id % 5 = 0 THEN NULL
             WHEN event_id % 2 = 0 THEN 'author_back_de' ELSE 'with_replicator' END AS to_status FROM events"""
_JUDGED_RIVALS = f"""
    SELECT q.*, CASE WHEN q.to_status IS NULL OR q.to_status = 'nowhere' THEN 'bad_target'
        WHEN p.paper_id IS NULL THEN 'not_found' WHEN p.status <> q.from_status THEN 'wrong_status' END AS reason
    FROM ({_RIVALS}) q LEFT JOIN papers p ON p.paper_id = q.paper_id"""


def _rivals(t):
    return t.events.select(
        (F.col("user_id") * 5).cast("string").alias("paper_id"), F.lit("with_author").alias("from_status"),
        F.when(F.col("user_id") % 4 == 0, "nowhere").when(F.col("event_id") % 5 == 0, None)
        .when(F.col("event_id") % 2 == 0, "author_back_de").otherwise("with_replicator").alias("to_status"))


@query("transition_conflicts", f"""
    SELECT p.paper_id, COALESCE(q.to_status, p.status) AS status FROM papers p LEFT JOIN (
        SELECT paper_id, MIN(to_status) AS to_status FROM ({_JUDGED_RIVALS}) j WHERE reason IS NULL
        GROUP BY paper_id) q ON q.paper_id = p.paper_id""")
def _(t):
    return changes.transition(t.papers, _rivals(t))[0].select("paper_id", "status")


@query("transition_conflicts_rejected", f"""
    SELECT paper_id, from_status, to_status, COALESCE(reason, 'superseded') AS reason FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY paper_id, reason ORDER BY to_status) AS n FROM ({_JUDGED_RIVALS}) j) k
    WHERE reason IS NOT NULL OR n > 1""")
def _(t):
    return changes.transition(t.papers, _rivals(t))[1]


def _thrice(t, *values):
    """Every paper asked for with each of the values."""
    return t.papers.select("paper_id", F.explode(F.array(*[F.lit(v) for v in values])).alias("value"))


@query("publish_conflicts", f"""
    SELECT paper_id, CASE WHEN status = 'acceptable_package' THEN 'doi:a' ELSE doi END AS doi,
        CASE WHEN status = 'acceptable_package' THEN {AS_OF_SQL} ELSE date_published END AS date_published FROM papers""")
def _(t):
    dois = _thrice(t, None, "doi:b", "doi:a", "doi:a").withColumnRenamed("value", "doi")
    return changes.publish(t.papers, dois, AS_OF)[0].select("paper_id", "doi", "date_published")


@query("publish_conflicts_rejected", """
    SELECT p.paper_id, CASE WHEN p.status <> 'acceptable_package' THEN 'wrong_status'
        WHEN v.n = 1 THEN 'no_doi' ELSE 'superseded' END AS reason
    FROM papers p, (VALUES (1), (2), (3), (4)) v(n) WHERE p.status <> 'acceptable_package' OR v.n <> 4""")
def _(t):
    dois = _thrice(t, None, "doi:b", "doi:a", "doi:a").withColumnRenamed("value", "doi")
    return changes.publish(t.papers, dois, AS_OF)[1]


def _rival_picks(t):
    return _thrice(t, None, "b@example.org", "a@example.org").select(
        "paper_id", F.col("value").alias("replicator1"), F.lit(None).cast("string").alias("replicator2"))


@query("assign_conflicts", """
    SELECT i.paper_id, i.round, CASE WHEN p.status = 'author_back_de' AND i.round = i.last
        THEN 'a@example.org' ELSE i.replicator1 END AS replicator1
    FROM (SELECT *, MAX(round) OVER (PARTITION BY paper_id) AS last FROM iterations) i
    LEFT JOIN papers p ON p.paper_id = i.paper_id""")
def _(t):
    return changes.assign(t.iterations, t.papers, _rival_picks(t), AS_OF)[1].select("paper_id", "round", "replicator1")


@query("assign_conflicts_rejected", """
    SELECT p.paper_id, CASE WHEN p.status <> 'author_back_de' THEN 'wrong_status' WHEN v.n = 1 THEN 'no_replicator'
        WHEN i.paper_id IS NULL THEN 'no_iteration' ELSE 'superseded' END AS reason
    FROM papers p CROSS JOIN (VALUES (1), (2), (3)) v(n)
    LEFT JOIN (SELECT DISTINCT paper_id FROM iterations) i ON i.paper_id = p.paper_id
    WHERE p.status <> 'author_back_de' OR v.n < 3 OR i.paper_id IS NULL""")
def _(t):
    return changes.assign(t.iterations, t.papers, _rival_picks(t), AS_OF)[2]


def _repeated_reports(t):
    """Every report, an older one of the same round, and one without round."""
    older = t.reports.withColumn("timestamp", F.col("timestamp") - F.expr("INTERVAL 1 DAY"))
    return t.reports.unionByName(older).unionByName(
        t.reports.withColumn("round", F.lit(None).cast(t.reports.schema["round"].dataType)))


@query("merge_reports_conflicts", _FILLED)
def _(t):
    t = t.landed("li")
    rows = changes.merge_reports(t.papers, t.iterations, _repeated_reports(t))[1].select(*_FILLED_COLS)
    return rows.withColumns({c: F.col(c).cast("double") for c in ("hours1", "hours2", "runtime_code_hours")})


@query("merge_reports_conflicts_rejected", f"""
    SELECT o.paper_id, o.round, CASE WHEN p.paper_id IS NULL THEN 'not_found'
        WHEN p.status <> 'with_replicator' THEN 'wrong_status' ELSE 'no_iteration' END AS reason
    FROM ({_OPEN}) o LEFT JOIN papers p ON p.paper_id = o.paper_id
    LEFT JOIN iterations i ON i.paper_id = o.paper_id AND i.round = o.round
    WHERE p.paper_id IS NULL OR p.status <> 'with_replicator' OR i.paper_id IS NULL
    UNION ALL SELECT paper_id, round, 'superseded' FROM ({_OPEN}) o
    UNION ALL SELECT r.paper_id, NULL, CASE WHEN p.paper_id IS NULL THEN 'not_found'
        WHEN p.status <> 'with_replicator' THEN 'wrong_status' ELSE 'no_iteration' END
    FROM reports r LEFT JOIN papers p ON p.paper_id = r.paper_id""")
def _(t):
    t = t.landed("li")
    return changes.merge_reports(t.papers, t.iterations, _repeated_reports(t))[2]


def _four(t):
    return {"papers": t.papers, "iterations": t.iterations, "form_arrivals": t.form_arrivals,
            "reports": t.reports}


@query("purge", f"""
    SELECT 'papers' AS source, paper_id FROM papers WHERE paper_id NOT IN ({_IDS}) UNION ALL
    SELECT 'iterations', paper_id FROM iterations WHERE paper_id NOT IN ({_IDS}) UNION ALL
    SELECT 'form_arrivals', paper_id FROM form_arrivals WHERE paper_id NOT IN ({_IDS}) UNION ALL
    SELECT 'reports', paper_id FROM reports WHERE paper_id NOT IN ({_IDS})""")
def _(t):
    kept, _ = changes.purge(_four(t), _ids(t))
    return _stacked(kept)


def _stacked(tables):
    out = None
    for name, df in tables.items():
        rows = df.select(F.lit(name).alias("source"), "paper_id")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("purge_log", " UNION ALL ".join(f"""
    SELECT 'delete' AS operation, '{n}' AS target, 'success' AS status, COUNT(*) AS n_rows,
        'Deleted ' || COUNT(*) || ' rows' AS details FROM {n} WHERE paper_id IN ({_IDS})"""
    for n in ("papers", "iterations", "form_arrivals", "reports")))
def _(t):
    return changes.purge(_four(t), _ids(t))[1]


def _purge_log(where, repos):
    """The whole log of a purge of the rows ``where`` from stored tables."""
    steps = []
    for n in ("papers", "iterations", "form_arrivals", "reports"):
        counts = {"backup": (f"SELECT COUNT(*) AS n FROM {n}", "n || ' rows backed up'"),
                  "delete": (f"SELECT COUNT(*) AS n FROM {n} WHERE {where}", "'Deleted ' || n || ' rows'"),
                  "validate": (f"SELECT COUNT(*) AS n FROM {n} WHERE ({where}) IS NOT TRUE", "n || ' rows'")}
        steps += [f"SELECT '{step}' AS operation, '{n}' AS target, 'success' AS status, n AS n_rows, {said} AS details "
                  f"FROM ({counted}) x" for step, (counted, said) in counts.items()]
    steps.append(f"SELECT 'query', 'repos', 'success', n, 'Found ' || n || ' repos to delete' FROM ({repos}) x")
    steps.append("SELECT 'validate', 'tables', 'success', 4, 'Tables exist after deletion'")
    return " UNION ALL ".join(steps)


def _store(t):
    store = VersionedTables(t.spark, scratch_folder(t.spark, "store", local=True))
    tables = _four(t.landed("li"))
    tables["papers"] = tables["papers"].withColumn("github_url", F.concat(F.lit("https://git/"), "paper_id"))
    store.commit(tables, base=0)
    return store


def _stored_ids(store):
    """``_ids`` of the papers first committed."""
    return _asked(store.read("papers", 1))


@query("purge_stored_log", _purge_log(f"paper_id IN ({_IDS})", f"SELECT COUNT(*) AS n FROM papers WHERE paper_id IN ({_IDS})"))
def _(t):
    """Papers deleted from stored tables behind a snapshot, told step by step."""
    store = _store(t)
    return recovery.purge_stored(store, f"{store.root}/snapshots", "2002-01-01", _stored_ids(store))


@query("purge_tests_stored_log", _purge_log("comments = '[TEST]'", "SELECT COUNT(*) AS n FROM papers WHERE comments = '[TEST]'"))
def _(t):
    store = _store(t)
    return recovery.purge_stored(store, f"{store.root}/snapshots", "2002-01-01")


@query("purge_stored", " UNION ALL ".join(
    f"SELECT '{n}' AS source, paper_id FROM {n} WHERE paper_id NOT IN ({_IDS})"
    for n in ("papers", "iterations", "form_arrivals", "reports")))
def _(t):
    """The tables as a purge of stored tables leaves them."""
    store = _store(t)
    recovery.purge_stored(store, f"{store.root}/snapshots", "2002-01-01", _stored_ids(store))
    return _stacked(store.tables())


@query("purge_tests", """
    SELECT 'papers' AS source, paper_id FROM papers WHERE comments IS NULL OR comments <> '[TEST]' UNION ALL
    SELECT 'iterations', paper_id FROM iterations WHERE comments IS NULL OR comments <> '[TEST]' UNION ALL
    SELECT 'form_arrivals', paper_id FROM form_arrivals WHERE comments IS NULL OR comments <> '[TEST]' UNION ALL
    SELECT 'reports', paper_id FROM reports WHERE comments IS NULL OR comments <> '[TEST]'""")
def _(t):
    return _stacked(changes.purge_tests(_four(t))[0])


@query("commit_change", f"""
    SELECT p.paper_id, CASE WHEN q.paper_id IS NULL THEN p.status ELSE 'with_author' END AS status, i.n_rounds
    FROM papers p LEFT JOIN ({_FINE}) q ON q.paper_id = p.paper_id
    LEFT JOIN (SELECT r.paper_id, COUNT(*) AS n_rounds FROM (
        SELECT paper_id FROM iterations UNION ALL SELECT paper_id FROM ({_FINE}) f) r GROUP BY r.paper_id) i
        ON i.paper_id = p.paper_id""")
def _(t):
    """A change of two tables through versioned storage: both versions become visible at once."""
    store = VersionedTables(t.spark, scratch_folder(t.spark, "store", local=True))
    t = t.landed("li")
    base = store.commit({"papers": t.papers, "iterations": t.iterations}, base=0)
    papers, rounds, _ = changes.revise(store.read("papers"), store.read("iterations"), _stored_ids(store), AS_OF)
    store.commit({"papers": papers, "iterations": rounds}, base)
    counts = store.read("iterations").groupBy("paper_id").agg(F.count("*").alias("n_rounds"))
    return store.read("papers").select("paper_id", "status").join(counts, "paper_id", "left")


# ---- quality and recovery --------------------------------------------------------------------

_CURRENT = """
    SELECT p.paper_id, p.round, p.status, p.date_published, i.paper_id IS NOT NULL AS found,
        EXISTS (SELECT 1 FROM iterations a WHERE a.paper_id = p.paper_id) AS some_round,
        i.date_with_authors AS d1, i.date_arrived_from_authors AS d2, i.date_assigned_repl AS d3,
        i.date_completed_repl AS d4, i.date_decision_de AS d5, i.decision_de
    FROM papers p LEFT JOIN iterations i ON i.paper_id = p.paper_id AND i.round = p.round"""
_TEXT = "'Status is ''' || status || ''' but {} is {}'"


def _pair(status, needed, needed_name, following, following_name):
    return f"""WHEN status = '{status}' THEN concat_ws('; ',
        CASE WHEN {needed} IS NULL THEN {_TEXT.format(needed_name, 'not set')} END,
        CASE WHEN {following} IS NOT NULL THEN {_TEXT.format(following_name, 'set')} END)"""


_ISSUES = f"""CASE
    WHEN NOT some_round THEN 'No iterations found for paper ' || paper_id
    WHEN NOT found THEN 'No iteration found for current round ' || round
    WHEN status = 'new_arrival' THEN CASE WHEN COALESCE(d1, d2, d3, d4, d5) IS NOT NULL
        THEN 'Status is ''new_arrival'' but has dates set that indicate further progress' ELSE '' END
    {_pair('with_author', 'd1', 'date_with_authors', 'd2', 'date_arrived_from_authors')}
    {_pair('author_back_de', 'd2', 'date_arrived_from_authors', 'd3', 'date_assigned_repl')}
    {_pair('with_replicator', 'd3', 'date_assigned_repl', 'd4', 'date_completed_repl')}
    {_pair('replicator_back_de', 'd4', 'date_completed_repl', 'd5', 'date_decision_de')}
    WHEN status = 'acceptable_package' THEN concat_ws('; ',
        CASE WHEN d5 IS NULL THEN {_TEXT.format('date_decision_de', 'not set')} END,
        CASE WHEN decision_de IS DISTINCT FROM 'accept' THEN
            'Status is ''acceptable_package'' but decision_de is not ''accept''' END)
    WHEN status = 'published_package' THEN CASE WHEN date_published IS NULL
        THEN {_TEXT.format('date_published', 'not set')} ELSE '' END
    ELSE 'Unknown status: ' || status END"""


def _disturbed(t):
    """Papers with some states set to values their dates contradict."""
    return t.papers.withColumn("status", F.when(F.col("paper_id").endswith("77"), "lost").when(
        F.col("paper_id").endswith("3"), "acceptable_package").otherwise(F.col("status"))).withColumn(
        "round", F.when(F.col("paper_id").endswith("91"), F.col("round") + 100).when(
            F.col("paper_id").endswith("6"), F.greatest(F.col("round") - 1, F.lit(1))).otherwise(F.col("round")))


_DISTURBED = """
    SELECT * REPLACE (CASE WHEN paper_id LIKE '%77' THEN 'lost' WHEN paper_id LIKE '%3' THEN 'acceptable_package'
        ELSE status END AS status, CASE WHEN paper_id LIKE '%91' THEN round + 100
        WHEN paper_id LIKE '%6' THEN greatest(round - 1, 1) ELSE round END AS round) FROM papers"""
_CHECKED = _CURRENT.replace("FROM papers p", f"FROM ({_DISTURBED}) p")


@query("validate", f"""
    SELECT paper_id, round, status, issues = '' AS is_valid, issues
    FROM (SELECT *, {_ISSUES} AS issues FROM ({_CURRENT}) c) x""")
def _(t):
    rows = quality.validate(t.papers, t.iterations)
    return rows.withColumn("issues", F.array_join("issues", "; "))


@query("validate_disturbed", f"""
    SELECT paper_id, round, status, issues = '' AS is_valid, issues
    FROM (SELECT *, {_ISSUES} AS issues FROM ({_CHECKED}) c) x""")
def _(t):
    rows = quality.validate(_disturbed(t), t.iterations)
    return rows.withColumn("issues", F.array_join("issues", "; "))


@query("repair", f"""
    SELECT paper_id, found AS success, status AS old_status, CASE WHEN found THEN fresh END AS new_status,
        found AND fresh <> status AS changed,
        CASE WHEN NOT found THEN issues WHEN fresh = status THEN 'Status is already correct'
            ELSE 'Status updated from ''' || status || ''' to ''' || fresh || '''' ||
            CASE WHEN fresh = 'new_arrival' AND d5 IS NOT NULL
                 THEN ' (current round is decided but not accepted)' ELSE '' END END AS message
    FROM (SELECT *, {_ISSUES} AS issues, CASE WHEN date_published IS NOT NULL THEN 'published_package'
        WHEN d5 IS NOT NULL AND decision_de = 'accept' THEN 'acceptable_package'
        WHEN d4 IS NOT NULL AND d5 IS NULL THEN 'replicator_back_de'
        WHEN d3 IS NOT NULL AND d4 IS NULL THEN 'with_replicator'
        WHEN d2 IS NOT NULL AND d3 IS NULL THEN 'author_back_de'
        WHEN d1 IS NOT NULL AND d2 IS NULL THEN 'with_author' ELSE 'new_arrival' END AS fresh
        FROM ({_CHECKED}) c) x WHERE issues <> ''""")
def _(t):
    return quality.repair(_disturbed(t), t.iterations)


@query("integrity", """
    SELECT 'papers' AS "table", 'missing_records' AS issue_type,
        COUNT(*) || ' paper_ids exist in form_arrivals but not in papers' AS description, 'high' AS severity
    FROM (SELECT DISTINCT paper_id FROM form_arrivals WHERE paper_id NOT IN (SELECT paper_id FROM papers)) x
    HAVING COUNT(*) > 0""")
def _(t):
    return quality.integrity(_four(t), t.spark)


@query("snapshot_lag", """
    SELECT CASE WHEN live > snap THEN 'live_newer' WHEN live < snap THEN 'snapshot_newer' ELSE 'in_sync' END AS state,
        round_even(abs(date_diff('second', date_trunc('second', snap), date_trunc('second', live))) / 3600, 1) AS hours
    FROM (SELECT (SELECT MAX(timestamp) FROM form_arrivals) AS live,
                 (SELECT MAX(timestamp) FROM form_arrivals WHERE processed) AS snap) x""")
def _(t):
    whole = F.date_trunc("second", "timestamp").cast("timestamp_ntz")
    forms = t.form_arrivals.withColumn("timestamp", whole)
    live = last_modified({"form_arrivals": forms})
    snap = last_modified({"form_arrivals": forms.filter("processed")})
    return quality.snapshot_lag(live, snap).select("state", "hours")


_NAMES = ("papers", "iterations", "form_arrivals", "reports")
_EVERY_ROW = " UNION ALL ".join(f"SELECT '{n}' AS source, paper_id FROM {n}" for n in _NAMES)


def _thinned(t):
    """Live tables that lost the papers waiting for a decision, except for their reports; the
    snapshot still has them, with its columns in another order."""
    gone = t.papers.filter("status = 'replicator_back_de'").select("paper_id")
    live = {n: df if n == "reports" else df.join(gone, "paper_id", "left_anti").select(df.columns)
            for n, df in _four(t).items()}
    return live, {n: df.select(*reversed(df.columns)) for n, df in _four(t).items()}


_GONE = "SELECT paper_id FROM papers WHERE status = 'replicator_back_de'"


@query("restore", f"""
    SELECT * FROM ({_EVERY_ROW}) r
    WHERE source = 'reports' OR paper_id NOT IN ({_GONE}) OR paper_id IN ({_IDS})""")
def _(t):
    t = t.landed("li", "papers")
    live, snap = _thinned(t)
    return _stacked(snapshots.restore(live, snap, _ids(t))[0])


@query("restore_papers", f"""
    SELECT paper_id, status, round, journal, paper_slug, first_arrival_date, date_published, comments FROM papers
    WHERE status <> 'replicator_back_de' OR paper_id IN ({_IDS})""")
def _(t):
    live, snap = _thinned(t)
    return snapshots.restore(live, snap, _ids(t))[0]["papers"].select(
        "paper_id", "status", "round", "journal", "paper_slug", "first_arrival_date", "date_published", "comments")


def _restore_log(name):
    present = "FALSE" if name != "reports" else "TRUE"
    return f"""
        SELECT '{name}' AS "table", q.paper_id, CASE WHEN n > 0 AND gone AND NOT {present} THEN 'restored' ELSE 'skip' END
            AS action, CAST(n AS BIGINT) AS rows, CASE WHEN n = 0 THEN 'paper_id not found in snapshot'
            WHEN gone AND NOT {present} THEN 'inserted from snapshot' ELSE 'paper_id already present in live table' END AS detail
        FROM (SELECT i.paper_id, i.paper_id IN ({_GONE}) AS gone, COUNT(x.paper_id) AS n
              FROM ({_IDS}) i LEFT JOIN {name} x ON x.paper_id = i.paper_id GROUP BY i.paper_id) q"""


@query("restore_log", " UNION ALL ".join(_restore_log(n) for n in _NAMES))
def _(t):
    live, snap = _thinned(t)
    return snapshots.restore(live, snap, _ids(t))[1]


def _restore_stored_log(name):
    return f"""
        SELECT '{name}' AS "table", q.paper_id, CASE WHEN n > 0 THEN 'restored' ELSE 'skip' END AS action,
            CAST(n AS BIGINT) AS rows,
            CASE WHEN n = 0 THEN 'paper_id not found in snapshot' ELSE 'inserted from snapshot' END AS detail
        FROM (SELECT i.paper_id, COUNT(x.paper_id) AS n FROM ({_IDS}) i LEFT JOIN {name} x ON x.paper_id = i.paper_id
              GROUP BY i.paper_id) q
        UNION ALL SELECT '{name}', NULL, 'backup', COUNT(*), 'safety snapshot 2002-01-02' FROM {name}
        WHERE paper_id NOT IN ({_IDS})"""


def _purged(t):
    """A store that lost papers, and the folder with the snapshot from before."""
    store = _store(t)
    folder = f"{store.root}/snapshots"
    recovery.purge_stored(store, folder, "2002-01-01", _stored_ids(store))
    return store, folder


@query("restore_stored_log", " UNION ALL ".join(_restore_stored_log(n) for n in _NAMES))
def _(t):
    """Purged papers brought back from the snapshot before, behind a safety snapshot."""
    store, folder = _purged(t)
    return recovery.restore_stored(store, folder, _stored_ids(store), "2002-01-02")


@query("restore_stored", _EVERY_ROW)
def _(t):
    store, folder = _purged(t)
    recovery.restore_stored(store, folder, _stored_ids(store), "2002-01-02")
    return _stacked(store.tables())


@query("refill", _EVERY_ROW)
def _(t):
    full = _four(t)
    live = {n: df.filter("paper_id = 'none'") if n in ("papers", "reports") else df for n, df in full.items()}
    return _stacked(snapshots.refill(live | {"iterations": None}, full)[0])


@query("snapshot", _EVERY_ROW)
def _(t):
    folder = scratch_folder(t.spark, "snapshots", local=True)
    t = t.landed("li", "papers")
    for day in range(1, 4):
        snapshots.snapshot(_four(t), folder, f"2002-01-0{day}", keep=2)
    newest = snapshots.snapshots(t.spark, folder).orderBy(F.desc("snapshot_ts")).first().path
    return _stacked(snapshots.read_tables(t.spark, newest, list(_NAMES)))


# ---- streams ---------------------------------------------------------------------------------

def _event_stream(t):
    return t.spark.readStream.schema(t.events.schema).option(
        "pathGlobFilter", "events.parquet").parquet(t.sf_dir)


@query("ingest_forms", """
    SELECT paper_id, title FROM (SELECT CAST(event_id // 3 AS VARCHAR) AS paper_id,
        CONCAT('Paper ', event_id) AS title, ts FROM events WHERE event_type <> 'error') b
    QUALIFY ROW_NUMBER() OVER (PARTITION BY paper_id ORDER BY ts DESC) = 1""")
def _(t):
    def clean(raw):
        return raw.filter("event_type <> 'error'").select(
            F.col("ts").alias("timestamp"), F.floor(F.col("event_id") / 3).cast("string").alias("paper_id"),
            F.concat(F.lit("Paper "), F.col("event_id").cast("string")).alias("title"))

    target = scratch_folder(t.spark, "forms", local=True)
    ingest_forms(_event_stream(t), clean, f"{target}/table",
                 f"{target}/state", ["paper_id"]).awaitTermination()
    return t.spark.read.parquet(f"{target}/table").select("paper_id", "title")


_LEDGER = """
    SELECT u.paper_id, MIN(CAST(u.ts AS DATE)) AS arrived FROM (
        SELECT CAST(user_id * 7 + 1 AS VARCHAR) AS paper_id, ts FROM events
        WHERE event_type = 'purchase' AND CAST(FLOOR(value) AS BIGINT) % 3 > 0) u
    JOIN papers p ON p.paper_id = u.paper_id AND p.status = 'with_author' GROUP BY u.paper_id"""


@query("record_arrivals", f"""
    SELECT i.paper_id, i.round, COALESCE(l.arrived, i.date_arrived_from_authors) AS date_arrived_from_authors
    FROM iterations i LEFT JOIN papers p ON p.paper_id = i.paper_id AND p.round = i.round
    LEFT JOIN ({_LEDGER}) l ON l.paper_id = p.paper_id""")
def _(t):
    uploads = _event_stream(t).select(
        (F.col("user_id") * 7 + 1).cast("string").alias("paper_id"),
        F.when(F.col("event_type") == "purchase", "package").otherwise("paper").alias("kind"),
        (F.floor("value") % 3).alias("file_count"), "ts")
    folder = scratch_folder(t.spark, "uploads", local=True)
    record_arrivals(uploads, t.papers, f"{folder}/ledger", f"{folder}/state", "1 day").awaitTermination()
    ledger = t.spark.read.parquet(f"{folder}/ledger")
    return apply_arrivals(t.papers, t.iterations, ledger, AS_OF)[1].select(
        "paper_id", "round", "date_arrived_from_authors")




_EARLY = "event_id % 3 > 0 AND ts >= (SELECT median(ts) FROM events)"
_UPLOADED = """
    SELECT CAST(user_id * 7 + 1 AS VARCHAR) AS paper_id, CAST(ts AS DATE) AS day, CAST(FLOOR(value) AS BIGINT) % 3 AS n, ts
    FROM events WHERE event_type = 'purchase' AND CAST(FLOOR(value) AS BIGINT) % 3 > 0"""


@query("late_arrivals", f"""
    SELECT paper_id, MAX(n) AS file_count, MAX(ts) AS ts FROM ({_UPLOADED} AND NOT ({_EARLY})) u
    WHERE ts <= (SELECT MAX(ts) FROM ({_UPLOADED} AND {_EARLY}) e) - INTERVAL 1 DAY GROUP BY paper_id, day""")
def _(t):
    """Uploads that come after newer ones, put aside for the next check of arrivals."""
    folder = scratch_folder(t.spark, "late", local=True)
    middle = t.events.agg(F.median(F.unix_micros(F.col("ts").cast("timestamp"))).alias("m"))
    told = t.events.withColumn("m", F.lit(middle.first().m))
    early = (F.col("event_id") % 3 > 0) & (F.unix_micros(F.col("ts").cast("timestamp")) >= F.col("m"))
    uploads = told.withColumn("early", early).select(
        (F.col("user_id") * 7 + 1).cast("string").alias("paper_id"),
        F.when(F.col("event_type") == "purchase", "package").otherwise("paper").alias("kind"),
        (F.floor("value") % 3).alias("file_count"), "ts", "early")
    for first in (True, False):
        part = uploads.filter(F.col("early") == first).drop("early")
        part.write.mode("append").parquet(f"{folder}/in")
        stream = t.spark.readStream.schema(part.schema).parquet(f"{folder}/in")
        record_arrivals(stream, t.papers, f"{folder}/ledger", f"{folder}/state", "1 day").awaitTermination()
    return t.spark.read.parquet(f"{folder}/ledger-late").select("paper_id", "file_count", "ts")
