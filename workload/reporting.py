"""Reports over papers, rounds and replicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from galleyproof.plans import reports

from .basics import replicator_sheet
from .fixtures import AS_OF, AS_OF_SQL
from .functions import _ACTOR
from .registry import query


def doubles(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@query("days_in_status", "SELECT paper_id, status, days_in_status FROM aged")
def _(t):
    return reports.days_in_status(t.papers, t.iterations, AS_OF).select(
        "paper_id", "status", "days_in_status")


@query("status_board", """
    SELECT status, paper_slug, round, days_in_status, is_confidential,
        CASE WHEN status IN ('acceptable_package', 'published_package') THEN NULL
             WHEN days_in_status <= 3 THEN '<=3' WHEN days_in_status <= 5 THEN '<=5'
             WHEN days_in_status <= 10 THEN '<=10' WHEN days_in_status > 10 THEN '>10' END AS age_band,
        paper_id
    FROM aged WHERE comments IS NULL OR comments <> '[TEST]'""")
def _(t):
    return reports.status_board(t.papers, t.iterations, AS_OF)


@query("global_report", """
    SELECT status, COUNT(*) AS count,
        round_even(COUNT(*) / SUM(COUNT(*)) OVER () * 100, 1) AS percentage
    FROM papers WHERE comments IS NULL OR comments <> '[TEST]' GROUP BY status""")
def _(t):
    return reports.global_report(t.papers, t.iterations)[1]


@query("global_summary", """
    SELECT 'Unique Papers' AS metric, COUNT(*) AS value FROM papers
    WHERE comments IS NULL OR comments <> '[TEST]' UNION ALL
    SELECT 'Total Iterations', COUNT(*) FROM iterations
    WHERE paper_id NOT IN (SELECT paper_id FROM papers WHERE comments = '[TEST]')""")
def _(t):
    return reports.global_report(t.papers, t.iterations)[0]


@query("status_report", "SELECT status, paper_slug FROM papers")
def _(t):
    return reports.status_report(t.papers)


_HELD = """
    SELECT DISTINCT s.email, s.paper_id, s.round FROM (
        SELECT i.replicator1 AS email, i.paper_id, i.round FROM iterations i UNION ALL
        SELECT i.replicator2, i.paper_id, i.round FROM iterations i) s
    JOIN papers p ON p.paper_id = s.paper_id AND p.round = s.round
    WHERE p.status = 'with_replicator'"""


@query("workload", f"""
    SELECT r.name, r.email, COUNT(h.paper_id) AS current_workload
    FROM replicators r LEFT JOIN ({_HELD}) h ON h.email = r.email GROUP BY r.name, r.email""")
def _(t):
    return reports.workload(t.iterations, t.papers, t.replicators)


@query("workload_items", f"""
    SELECT email, paper_id, round, paper_id || ' (R' || round || ')' AS item
    FROM ({_HELD}) h WHERE email IS NOT NULL""")
def _(t):
    return reports.workload_items(t.iterations, t.papers)


@query("time_in_status", """
    SELECT d.status, AVG(a.days_in_status) AS avg_days, MIN(a.days_in_status) AS min_days,
        MAX(a.days_in_status) AS max_days, COUNT(a.paper_id) AS papers_count
    FROM (VALUES ('new_arrival'), ('with_replicator'), ('replicator_back_de'), ('author_back_de'),
        ('with_author'), ('acceptable_package'), ('published_package')) d(status)
    LEFT JOIN aged a ON a.status = d.status GROUP BY d.status""")
def _(t):
    return reports.time_in_status(t.papers, t.iterations, AS_OF)


@query("hours_worked", """
    SELECT date_completed_repl, days_taken, case_id, comments, slot, replicator,
        CAST(hours AS DOUBLE) AS hours FROM worked""")
def _(t):
    return doubles(reports.hours_worked(t.iterations), "hours")


_PAID = """
    SELECT replicator, year(date_completed_repl) || '-Q' || quarter(date_completed_repl) AS quarter, case_id,
        CASE WHEN comments = '[TEST]' AND hours > 1.5 THEN CAST(1.5 AS DECIMAL(18,3)) ELSE hours END AS hours
    FROM worked"""
_SUMMARY = f"""
    SELECT replicator, quarter, COUNT(*) AS num_jobs, CAST(SUM(hours) AS DOUBLE) AS hours,
        CAST(SUM(hours) * CAST(25 AS DECIMAL(4,1)) AS DOUBLE) AS "pay_EUR",
        CAST(SUM(hours) * CAST(25 AS DECIMAL(4,1)) * CAST(1.1765 AS DECIMAL(6,4)) AS DOUBLE) AS "pay_USD"
    FROM ({_PAID}) w WHERE replicator NOT LIKE '%repl7@%' GROUP BY replicator, quarter"""


def summary(t, **options):
    return reports.hours_summary(reports.hours_worked(t.iterations), exclude="repl7@", **options)


@query("hours_summary", _SUMMARY)
def _(t):
    return doubles(summary(t), "hours", "pay_EUR", "pay_USD")


@query("case_lists", f"SELECT replicator, quarter, case_id FROM ({_PAID}) w")
def _(t):
    return reports.case_lists(reports.hours_worked(t.iterations)).drop("slot")


@query("hours_summary_strict", f"""
    SELECT replicator, quarter, COUNT(*) AS num_jobs,
        CAST(CASE WHEN COUNT(hours) = COUNT(*) THEN SUM(hours) END AS DOUBLE) AS hours
    FROM (SELECT replicator, quarter, CASE WHEN ends_with(case_id, '-R3') THEN NULL ELSE hours END AS hours
          FROM ({_PAID}) p) w GROUP BY replicator, quarter""")
def _(t):
    worked = reports.hours_worked(t.iterations)
    gaps = worked.withColumn("hours", F.when(~F.endswith("case_id", F.lit("-R3")), F.col("hours")))
    return doubles(reports.hours_summary(gaps, strict_nulls=True), "hours").select(
        "replicator", "quarter", "num_jobs", "hours")


@query("billing", _SUMMARY)
def _(t):
    return doubles(reports.billing(summary(t)), "hours", "pay_EUR", "pay_USD")


@query("quarterly_budget", f"""
    SELECT quarter, CAST(SUM(num_jobs) AS BIGINT) AS num_jobs, CAST(SUM(h) AS DOUBLE) AS hours,
        CAST(SUM(h) * CAST(25 AS DECIMAL(4,1)) AS DOUBLE) AS "cost_EUR",
        CAST(SUM(h) * CAST(25 AS DECIMAL(4,1)) * CAST(1.1765 AS DECIMAL(6,4)) AS DOUBLE) AS "cost_USD"
    FROM (SELECT quarter, COUNT(*) AS num_jobs, CAST(SUM(hours) AS DECIMAL(18,3)) AS h
          FROM ({_PAID}) w WHERE replicator NOT LIKE '%repl7@%' GROUP BY replicator, quarter) s
    GROUP BY quarter""")
def _(t):
    return doubles(reports.quarterly_budget(reports.billing(summary(t))), "hours", "cost_EUR", "cost_USD")


@query("invoices", f"""
    SELECT w.email, w.num_jobs, CAST(w.hours AS DOUBLE) AS hours,
        CAST(round_even(CAST(w.hours * 29.41 AS DOUBLE), 1) AS DOUBLE) AS "amount_USD", r.name,
        TRY_CAST(split_part(r.invoice, '-', 2) AS INT) + 1 AS next_invoice
    FROM (SELECT CASE replicator WHEN 'repl3@example.org' THEN 'repl4@example.org' ELSE replicator END AS email,
              COUNT(*) AS num_jobs, SUM(hours) AS hours
          FROM ({_PAID}) p WHERE quarter = '1998-Q3' GROUP BY 1) w
    LEFT JOIN replicators r ON r.email = w.email""")
def _(t):
    rows = reports.invoices(reports.hours_worked(t.iterations), t.replicators, "1998-Q3",
                            aliases={"repl3@example.org": "repl4@example.org"})
    return doubles(rows, "hours", "amount_USD")


@query("invoice_rejects", f"""
    SELECT w.email, w.num_jobs, CAST(w.hours AS DOUBLE) AS hours,
        CASE WHEN r.email IS NULL THEN 'not_listed' ELSE 'no_number' END AS reason
    FROM (SELECT replicator AS email, COUNT(*) AS num_jobs, SUM(hours) AS hours
          FROM ({_PAID}) p WHERE quarter = '1998-Q3' GROUP BY 1) w
    LEFT JOIN (SELECT email, CASE WHEN email LIKE '%5@%' THEN NULL ELSE invoice END AS invoice FROM replicators
               WHERE email NOT LIKE '%7@%') r ON r.email = w.email
    WHERE TRY_CAST(split_part(r.invoice, '-', 2) AS INT) IS NULL""")
def _(t):
    """Hours of people that left the roster or have no invoice number."""
    roster = t.replicators.filter("email NOT LIKE '%7@%'").withColumn(
        "invoice", F.when(~F.col("email").like("%5@%"), F.col("invoice")))
    return doubles(reports.invoice_rejects(reports.hours_worked(t.iterations), roster, "1998-Q3"), "hours")


@query("paper_report", f"""
    SELECT a.paper_id, a.title, a.firstname_of_author || ' ' || a.surname_of_author AS authors, a.journal,
        a.status, a.days_in_status, {_ACTOR.format(c='a.status')} AS responsible_actor, a.round,
        CAST(CASE WHEN a.status IN ('acceptable_package', 'published_package') THEN acc.d
             ELSE {AS_OF_SQL} END - a.first_arrival_date AS INT) AS total_days
    FROM aged a LEFT JOIN (SELECT paper_id, MIN(date_decision_de) AS d FROM iterations
        WHERE decision_de = 'accept' GROUP BY paper_id) acc ON acc.paper_id = a.paper_id""")
def _(t):
    return reports.paper_report(t.papers, t.iterations, AS_OF)


@query("timeline", """
    SELECT paper_id, round, first_arrival_date AS date, CAST(1 AS INT) AS event_seq, 'Paper Arrived' AS event,
        'Round ' || round AS details FROM iterations WHERE first_arrival_date IS NOT NULL UNION ALL
    SELECT paper_id, round, date_with_authors, 2, 'Sent to Author', 'Round ' || round
    FROM iterations WHERE date_with_authors IS NOT NULL UNION ALL
    SELECT paper_id, round, date_arrived_from_authors, 3, 'Received from Author', 'Round ' || round
    FROM iterations WHERE date_arrived_from_authors IS NOT NULL UNION ALL
    SELECT paper_id, round, date_assigned_repl, 4, 'Assigned to Replicator', 'Assigned to ' || replicator1
        || COALESCE(' and ' || replicator2, '') FROM iterations WHERE date_assigned_repl IS NOT NULL UNION ALL
    SELECT paper_id, round, date_completed_repl, 5, 'Completed by Replicator', 'Result: ' ||
        CASE WHEN is_success THEN 'Success' WHEN NOT is_success THEN 'Failure' ELSE 'Unknown' END
    FROM iterations WHERE date_completed_repl IS NOT NULL UNION ALL
    SELECT paper_id, round, date_decision_de, 6, 'Decision by Data Editor',
        'Decision: ' || COALESCE(decision_de, 'Unknown')
    FROM iterations WHERE date_decision_de IS NOT NULL""")
def _(t):
    return reports.timeline(t.iterations)


@query("assignments", f"""
    SELECT i.paper_slug, p.round, i.replicator1, i.replicator2, i.date_assigned_repl,
        CAST({AS_OF_SQL} - i.date_assigned_repl AS INT) AS days_with_repl
    FROM papers p LEFT JOIN iterations i ON i.paper_id = p.paper_id AND i.round = p.round
    WHERE p.status = 'with_replicator'""")
def _(t):
    return reports.assignments(t.papers, t.iterations, AS_OF)


_HISTORY = """
    SELECT paper_slug, round, date_assigned_repl, date_completed_repl, CAST(1 AS INT) AS replicator_num,
        replicator1 AS replicator FROM iterations WHERE replicator1 IS NOT NULL UNION ALL
    SELECT paper_slug, round, date_assigned_repl, date_completed_repl, 2, replicator2
    FROM iterations WHERE replicator2 IS NOT NULL"""


@query("history", _HISTORY)
def _(t):
    return reports.history(t.iterations)


@query("history_of_one", f"SELECT * FROM ({_HISTORY}) h WHERE replicator = 'repl5@example.org'")
def _(t):
    return reports.history(t.iterations, "repl5@example.org")


_LONG = ["round", "repl_comments", "is_success", "is_confidential", "is_confidential_shared", "is_HPC",
         "is_remote", "replicator1", "replicator2", "hours1", "hours2", "software", "data_statement"]


@query("latest_long", " UNION ALL ".join(
    f"SELECT paper_id, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM latest_it" for c in _LONG))
def _(t):
    return reports.latest_long(t.iterations)


@query("requests_long", " UNION ALL ".join(
    f"SELECT paper_id, round, '{c}' AS variable, {c} AS value FROM iterations"
    for c in ("file_request_id_pkg", "file_request_id_paper", "file_request_url_pkg")))
def _(t):
    return reports.requests_long(t.iterations)


_CHECK = """
    SELECT i.journal, p.paper_id, i.round, i.paper_slug, p.status,
        COALESCE(u.pkg > 0, FALSE) AS package_arrived, COALESCE(u.pap > 0, FALSE) AS paper_arrived
    FROM papers p JOIN (SELECT * FROM iterations QUALIFY round = MAX(round) OVER (PARTITION BY paper_id)) i
        ON i.paper_id = p.paper_id
    LEFT JOIN (SELECT paper_id, SUM(CASE WHEN kind = 'package' THEN file_count END) AS pkg,
        SUM(CASE WHEN kind = 'paper' THEN file_count END) AS pap FROM uploads GROUP BY paper_id) u
        ON u.paper_id = p.paper_id
    WHERE p.status IN ('with_author', 'new_arrival')"""


@query("arrivals_check", _CHECK)
def _(t):
    return reports.arrivals_check(t.papers, t.iterations, t.uploads)[0]


@query("arrivals_reminders", f"SELECT * FROM ({_CHECK}) c WHERE package_arrived AND NOT paper_arrived")
def _(t):
    return reports.arrivals_check(t.papers, t.iterations, t.uploads)[1]


def _register_listing(kind, where):
    @query(f"listing_{kind}", f"""
        SELECT paper_id, paper_slug, round, status, days_in_status FROM aged WHERE {where}""")
    def _(t):
        return reports.listing(t.papers, t.iterations, AS_OF, kind)


_register_listing("unpublished", "status <> 'published_package'")
_register_listing("published", "status = 'published_package'")
_register_listing("with_author", "status = 'with_author'")
_register_listing("with_replicator", "status = 'with_replicator'")
_register_listing("with_de", "status IN ('new_arrival', 'replicator_back_de', 'author_back_de')")


@query("effort", """
    SELECT p.paper_id, p.paper_slug, p.status, COUNT(i.round) AS n_rounds,
        CAST(COALESCE(SUM(COALESCE(i.hours1, 0) + COALESCE(i.hours2, 0)), 0) AS DOUBLE) AS hours
    FROM papers p LEFT JOIN iterations i ON i.paper_id = p.paper_id GROUP BY 1, 2, 3""")
def _(t):
    return doubles(reports.effort(t.papers, t.iterations), "hours")


@query("effort_over_time", """
    SELECT CAST(date_trunc('month', date_completed_repl) AS DATE) AS month, COUNT(*) AS n_rounds,
        CAST(SUM(COALESCE(hours1, 0) + COALESCE(hours2, 0)) AS DOUBLE) AS hours,
        CAST(SUM(COALESCE(hours1, 0) + COALESCE(hours2, 0)) AS DOUBLE) / COUNT(*) AS hours_per_round
    FROM iterations WHERE date_completed_repl IS NOT NULL GROUP BY 1""")
def _(t):
    return doubles(reports.effort_over_time(t.iterations), "hours")


@query("turnaround", """
    SELECT metric, COUNT(*) AS n_rounds, AVG(days) AS avg_days, CAST(MIN(days) AS INT) AS min_days,
        quantile_cont(days, 0.5) AS median_days, CAST(MAX(days) AS INT) AS max_days
    FROM (SELECT 'author' AS metric, date_arrived_from_authors - date_with_authors AS days FROM iterations
          UNION ALL SELECT 'de_decision', date_decision_de - date_completed_repl FROM iterations
          UNION ALL SELECT 'de_assignment', date_assigned_repl - date_arrived_from_authors FROM iterations) s
    WHERE days IS NOT NULL GROUP BY metric""")
def _(t):
    return reports.turnaround(t.iterations)


@query("overdue", f"""
    SELECT paper_id, paper_slug, round, status, days_in_status, {_ACTOR.format(c='status')} AS responsible_actor
    FROM aged WHERE days_in_status > 1200 AND status NOT IN ('acceptable_package', 'published_package')""")
def _(t):
    return reports.overdue(t.papers, t.iterations, AS_OF, 1200)


_ROSTER = """
    SELECT email, name, CASE WHEN os LIKE 'mac%' OR os = 'Darwin' THEN 'macOS' WHEN os LIKE 'Win%' THEN 'Windows'
        WHEN os LIKE 'Ubuntu%' THEN 'Linux' ELSE 'Other' END AS os_family,
        COALESCE(can_take = 'Yes', FALSE) AS available FROM replicators"""
_PRIOR = """
    SELECT c.paper_id, c.round, b.replicator1, b.replicator2
    FROM (SELECT paper_id, MAX(round) AS round FROM iterations GROUP BY paper_id) c
    JOIN iterations b ON b.paper_id = c.paper_id AND b.round = c.round - 1"""


@query("previous_candidates", f"""
    SELECT s.paper_id, s.round, s.slot, s.email, r.name, r.os_family, COALESCE(r.available, FALSE) AS available
    FROM (SELECT paper_id, round, CAST(1 AS INT) AS slot, replicator1 AS email FROM ({_PRIOR}) a
          WHERE replicator1 IS NOT NULL UNION ALL
          SELECT paper_id, round, 2, replicator2 FROM ({_PRIOR}) b WHERE replicator2 IS NOT NULL) s
    LEFT JOIN ({_ROSTER}) r ON r.email = s.email""")
def _(t):
    return reports.previous_candidates(t.iterations, replicator_sheet(t))


@query("candidates", f"""
    SELECT r.email, r.name, r.os_family, r.available,
        COALESCE(r.email = p.replicator1, FALSE) AS previous_primary,
        COALESCE(r.email = p.replicator2 AND r.email <> p.replicator1, FALSE) AS previous_secondary
    FROM ({_ROSTER}) r LEFT JOIN ({_PRIOR}) p ON p.paper_id = '417'""")
def _(t):
    return reports.candidates(t.iterations, replicator_sheet(t), "417")


@query("backlog", """
    SELECT i.paper_id, i.round, i.gh_org_repo FROM iterations i
    WHERE i.preprocess_mode = 'gh-runner' AND i.gh_org_repo IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM packages k WHERE k.gh_org_repo = i.gh_org_repo AND k.round = i.round)""")
def _(t):
    return reports.backlog(t.iterations, t.packages)


