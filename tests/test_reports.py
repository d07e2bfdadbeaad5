import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from galleyproof.plans import reports
from conftest import AS_OF, by_id

D = dt.date


def test_days_in_status_uses_the_date_of_the_state(desk):
    papers = desk.papers(
        {"paper_id": "1", "status": "new_arrival", "first_arrival_date": D(2024, 6, 1)},
        {"paper_id": "2", "status": "with_author"}, {"paper_id": "3", "status": "author_back_de"},
        {"paper_id": "4", "status": "with_replicator"}, {"paper_id": "5", "status": "replicator_back_de"},
        {"paper_id": "6", "status": "acceptable_package"},
        {"paper_id": "7", "status": "published_package", "date_published": D(2024, 6, 24)},
        {"paper_id": "8", "status": None}, {"paper_id": "9", "status": "lost"},
        {"paper_id": "10", "status": "with_author", "round": 2})
    dates = {"date_with_authors": D(2024, 6, 2), "date_arrived_from_authors": D(2024, 6, 3),
             "date_assigned_repl": D(2024, 6, 4), "date_completed_repl": D(2024, 6, 5),
             "date_decision_de": D(2024, 6, 6)}
    rounds = desk.iterations(*[{"paper_id": str(i)} | dates for i in range(1, 11)])
    assert by_id(reports.days_in_status(papers, rounds, AS_OF), "days_in_status") == {
        "1": 29, "2": 28, "3": 27, "4": 26, "5": 25, "6": 24, "7": 6, "8": None, "9": None, "10": None}


def test_status_board_order_and_confidentiality(desk):
    papers = desk.papers(
        {"paper_id": "1", "status": "with_replicator", "is_confidential": True},
        {"paper_id": "2", "status": "with_replicator", "is_confidential": False},
        {"paper_id": "3", "status": "with_replicator"},
        {"paper_id": "4", "status": "new_arrival", "first_arrival_date": D(2024, 6, 29)},
        {"paper_id": "5", "status": "new_arrival", "comments": "[TEST]"},
        {"paper_id": "6", "status": "published_package", "date_published": D(2020, 1, 1)})
    rounds = desk.iterations({"paper_id": "1", "date_assigned_repl": D(2024, 6, 28)},
                             {"paper_id": "2", "date_assigned_repl": D(2024, 6, 1)})
    board = reports.status_board(papers, rounds, AS_OF).collect()
    assert [r.paper_slug for r in board] == ["Author-4", "Author-3", "Author-2", "Author-1", "Author-6"]
    assert [r.age_band for r in board] == ["<=3", None, ">10", "<=3", None]
    assert {r.paper_id: r.is_confidential for r in board}["1"] is True


def test_global_report(desk):
    papers = desk.papers(*[{"paper_id": str(i), "status": "with_author" if i < 2 else "new_arrival"}
                           for i in range(3)], {"paper_id": "t", "comments": "[TEST]"})
    rounds = desk.iterations({"paper_id": "0"}, {"paper_id": "t"})
    summary, status = reports.global_report(papers, rounds)
    assert by_id(summary, "value", key="metric") == {"Unique Papers": 3, "Total Iterations": 1}
    assert [(r.status, r["count"], r.percentage) for r in status.collect()] == [
        ("with_author", 2, 66.7), ("new_arrival", 1, 33.3)]


def test_workload_keeps_idle_people(desk, spark):
    papers = desk.papers({"paper_id": "1", "status": "with_replicator", "round": 2},
                         {"paper_id": "2", "status": "with_replicator"}, {"paper_id": "3"})
    rounds = desk.iterations(
        {"paper_id": "1", "replicator1": "a"}, {"paper_id": "1", "round": 2, "replicator1": "a", "replicator2": "b"},
        {"paper_id": "2", "replicator1": "a", "replicator2": "a"}, {"paper_id": "3", "replicator1": "b"})
    people = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "email string, name string")
    assert by_id(reports.workload(rounds, papers, people), "current_workload", key="email") == {"a": 2, "b": 1, "c": 0}
    items = reports.workload_items(rounds, papers).collect()
    assert [(r.email, r["item"]) for r in items] == [("a", "1 (R2)"), ("a", "2 (R1)"), ("b", "1 (R2)")]


def test_workload_of_many_papers_has_one_row(spark):
    ids = spark.range(12000).select(F.format_string("%06d", "id").alias("paper_id"), F.lit(1).alias("round"))
    papers = ids.withColumn("status", F.lit("with_replicator"))
    rounds = ids.withColumns({"replicator1": F.lit("a"), "replicator2": F.lit(None).cast("string")})
    people = spark.createDataFrame([("a", "A")], "email string, name string")
    assert [r.current_workload for r in reports.workload(rounds, papers, people).collect()] == [12000]
    items = [r.paper_id for r in reports.workload_items(rounds, papers).collect()]
    assert items == sorted(items) and len(items) == 12000


def test_time_in_status_keeps_empty_states(desk):
    papers = desk.papers({"paper_id": "1", "status": "new_arrival", "first_arrival_date": D(2024, 6, 20)},
                         {"paper_id": "2", "status": "new_arrival"})
    rows = reports.time_in_status(papers, desk.iterations(), AS_OF).collect()
    assert len(rows) == 7 and rows[0].status == "new_arrival"
    assert (rows[0].avg_days, rows[0].min_days, rows[0].papers_count) == (10.0, 10, 2)
    assert (rows[1].avg_days, rows[1].papers_count) == (None, 0)


def _worked(desk):
    day = {"date_assigned_repl": D(2024, 5, 1), "date_completed_repl": D(2024, 5, 4)}
    return reports.hours_worked(desk.iterations(
        {"paper_id": "1", "replicator1": "a", "hours1": Decimal("4"), "replicator2": "b", "hours2": Decimal("2.5")} | day,
        {"paper_id": "2", "replicator1": "a", "hours1": Decimal("3"), "comments": "[TEST]"} | day,
        {"paper_id": "3", "replicator1": "a", "replicator2": "b"} | day,
        {"paper_id": "4", "replicator1": "me@home", "hours1": Decimal("9")} | day,
        {"paper_id": "5", "replicator1": "a", "hours1": Decimal("9")}))


def test_hours_and_pay(desk, spark):
    worked = _worked(desk)
    assert worked.count() == 5 and {r.days_taken for r in worked.collect()} == {3}
    summary = reports.hours_summary(worked, exclude="@home")
    assert by_id(summary, "num_jobs", "hours", "pay_EUR", key="replicator") == {
        "a": (3, Decimal("5.5"), Decimal("137.5")), "b": (1, Decimal("2.5"), Decimal("62.5"))}
    strict = reports.hours_summary(worked, exclude="@home", strict_nulls=True)
    assert by_id(strict, "hours", key="replicator") == {"a": None, "b": Decimal("2.5")}
    budget = reports.quarterly_budget(reports.billing(summary)).first()
    assert (budget.quarter, budget.num_jobs, float(budget.cost_USD)) == ("2024-Q2", 4, 8 * 25 * 1.1765)
    cases = [r.case_id for r in reports.case_lists(worked).filter("replicator = 'a'").collect()]
    assert cases == ["Review-Author-1-R1", "Review-Author-2-R1", "Review-Author-3-R1"]
    people = spark.createDataFrame([("a2", "A", "INV-7")], "email string, name string, invoice string")
    bills = reports.invoices(worked, people, "2024-Q2", aliases={"a": "a2"})
    assert by_id(bills, "name", "next_invoice", "amount_USD", key="email")["a2"] == ("A", 8, Decimal("161.8"))
    both = reports.invoices(worked, people, "2024-Q2", aliases={"a": "a2", "b": "a2"})
    assert [r.num_jobs for r in both.filter("email = 'a2'").collect()] == [4]


def test_timeline_orders_one_day_by_workflow(desk):
    day = D(2024, 5, 1)
    rounds = desk.iterations({
        "paper_id": "1", "first_arrival_date": day, "date_with_authors": day, "date_decision_de": day,
        "date_assigned_repl": D(2024, 4, 1), "replicator1": "a", "replicator2": "b", "date_completed_repl": D(2024, 4, 2)})
    events = [(r.event, r.details) for r in reports.timeline(rounds).collect()]
    assert events == [
        ("Assigned to Replicator", "Assigned to a and b"), ("Completed by Replicator", "Result: Unknown"),
        ("Paper Arrived", "Round 1"), ("Sent to Author", "Round 1"), ("Decision by Data Editor", "Decision: Unknown")]


def test_paper_report_totals(desk):
    papers = desk.papers(
        {"paper_id": "1", "status": "published_package", "first_arrival_date": D(2024, 1, 1)},
        {"paper_id": "2", "status": "with_author", "first_arrival_date": D(2024, 6, 1)},
        {"paper_id": "3", "status": "acceptable_package", "first_arrival_date": D(2024, 6, 1)})
    rounds = desk.iterations({"paper_id": "1", "decision_de": "accept", "date_decision_de": D(2024, 1, 31)},
                             {"paper_id": "3", "decision_de": "rnr", "date_decision_de": D(2024, 6, 2)})
    assert by_id(reports.paper_report(papers, rounds, AS_OF), "total_days") == {"1": 30, "2": 29, "3": None}


def test_candidates_mark_the_round_before(desk, spark):
    rounds = desk.iterations({"paper_id": "1", "replicator1": "a", "replicator2": "b"}, {"paper_id": "1", "round": 2},
                             {"paper_id": "2", "replicator1": "c"})
    people = spark.createDataFrame(
        [("a", "A", "mac", "No"), ("b", "B", None, "Yes"), ("c", "C", "win", None)],
        "email string, name string, os string, `can_take_+1_package` string")
    assert by_id(reports.candidates(rounds, people, "1"), "available", "previous_primary",
                 "previous_secondary", key="email") == {
        "a": (False, True, False), "b": (True, False, True), "c": (False, False, False)}
    assert reports.previous_candidates(rounds, people).count() == 2


def test_arrivals_check_and_reminders(desk, spark):
    papers = desk.papers({"paper_id": "1", "status": "with_author", "round": 2},
                         {"paper_id": "2", "status": "with_author"}, {"paper_id": "3"})
    rounds = desk.iterations({"paper_id": "1"}, {"paper_id": "1", "round": 2}, {"paper_id": "2"}, {"paper_id": "3"})
    uploads = spark.createDataFrame([("1", "package", 2), ("2", "package", 0), ("3", "package", 1)],
                                    "paper_id string, kind string, file_count long")
    check, remind = reports.arrivals_check(papers, rounds, uploads)
    assert by_id(check, "round", "package_arrived") == {"1": (2, True), "2": (1, False)}
    assert [r.paper_id for r in remind.collect()] == ["1"]


def test_backlog_ignores_unknown_repositories(desk, spark):
    mode = {"preprocess_mode": "gh-runner"}
    rounds = desk.iterations({"paper_id": "1", "gh_org_repo": "o/1"} | mode, {"paper_id": "2"} | mode,
                             {"paper_id": "3", "gh_org_repo": "o/3"} | mode, {"paper_id": "4", "gh_org_repo": "o/4"})
    landed = spark.createDataFrame([("o/3", 1), ("o/1", 2)], "gh_org_repo string, round int")
    assert [r.paper_id for r in reports.backlog(rounds, landed).collect()] == ["1"]


def test_effort_and_turnaround(desk):
    papers = desk.papers({"paper_id": "1"}, {"paper_id": "2"})
    rounds = desk.iterations(
        {"paper_id": "1", "hours1": Decimal("1.5"), "date_with_authors": D(2024, 1, 1), "date_arrived_from_authors": D(2024, 1, 5)},
        {"paper_id": "1", "round": 2, "hours2": Decimal("2"), "date_with_authors": D(2024, 1, 1), "date_arrived_from_authors": D(2024, 1, 2)})
    assert by_id(reports.effort(papers, rounds), "n_rounds", "hours") == {"1": (2, Decimal("3.5")), "2": (0, Decimal("0"))}
    row = reports.turnaround(rounds).filter(F.col("metric") == "author").first()
    assert (row.n_rounds, row.avg_days, row.median_days, row.max_days) == (2, 2.5, 2.5, 4)
