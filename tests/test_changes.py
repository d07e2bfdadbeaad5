import datetime as dt
from decimal import Decimal

from galleyproof.plans import changes
from conftest import AS_OF, by_id

D = dt.date


def test_transition_is_compare_and_set(desk, spark):
    papers = desk.papers({"paper_id": "1"}, {"paper_id": "2"}, {"paper_id": "3", "status": "with_author"}, {"paper_id": "4", "status": None})
    asked = spark.createDataFrame(
        [("1", "author_back_de", "with_replicator"), ("2", "author_back_de", "nowhere"),
         ("3", "author_back_de", "with_replicator"), ("4", "author_back_de", "with_replicator"),
         ("5", "author_back_de", "with_replicator")],
        "paper_id string, from_status string, to_status string")
    moved, rejected = changes.transition(papers, asked)
    assert by_id(moved, "status") == {"1": "with_replicator", "2": "author_back_de", "3": "with_author", "4": None}
    assert by_id(rejected, "reason") == {"2": "bad_target", "3": "wrong_status", "4": "wrong_status", "5": "not_found"}
    assert moved.columns == papers.columns


def test_set_status_forces_any_state(desk, spark):
    papers = desk.papers({"paper_id": "1", "status": None}, {"paper_id": "2"})
    asked = spark.createDataFrame([("1", "with_author"), ("2", "x")], "paper_id string, status string")
    moved, rejected = changes.set_status(papers, asked)
    assert by_id(moved, "status") == {"1": "with_author", "2": "author_back_de"}
    assert by_id(rejected, "reason") == {"2": "bad_target"}


def test_merge_reports(desk):
    papers = desk.papers({"paper_id": "1", "status": "with_replicator"}, {"paper_id": "2", "status": "with_author"},
                         {"paper_id": "3", "status": "with_replicator"})
    rounds = desk.iterations({"paper_id": "1", "replicator1": "a", "replicator2": "b"}, {"paper_id": "2"},
                             {"paper_id": "3", "software": "R"})
    when = dt.datetime(2024, 6, 1, 12)
    reports = desk.reports(
        {"paper_id": "1", "timestamp": when, "email_of_replicator_1": "a", "hours_replicator_1": Decimal("3"),
         "software_used_in_package": "Julia", "is_success": True, "comments": "fine"},
        {"paper_id": "2", "timestamp": when}, {"paper_id": "3", "round": 7, "timestamp": when},
        {"paper_id": "4", "timestamp": when})
    moved, filled, rejected = changes.merge_reports(papers, rounds, reports)
    assert by_id(moved, "status", "software") == {
        "1": ("replicator_back_de", "Julia"), "2": ("with_author", None), "3": ("with_replicator", None)}
    one = filled.filter("paper_id = '1'").first()
    # an empty answer empties the round's value, too
    assert (one.replicator2, one.hours1, one.repl_comments, one.date_completed_repl) == (
        None, Decimal("3.000"), "fine", D(2024, 6, 1))
    assert by_id(rejected, "reason") == {"2": "wrong_status", "3": "no_iteration", "4": "not_found"}
    assert by_id(filled, "date_completed_repl")["2"] == D(2024, 6, 1)


def test_accept_after_a_later_round(desk):
    papers = desk.papers({"paper_id": "1", "round": 2, "software": "old"}, {"paper_id": "2"},
                         {"paper_id": "3", "round": 2, "data_statement": "kept", "software": "kept"})
    rounds = desk.iterations(
        {"paper_id": "1", "replicator1": "a", "replicator2": "b", "data_statement": "s", "software": "R"},
        {"paper_id": "1", "round": 2}, {"paper_id": "2"},
        {"paper_id": "3", "replicator1": "a", "software": "R"}, {"paper_id": "3", "round": 2, "replicator1": "c"})
    moved, closed, rejected = changes.accept(papers, rounds, desk.ids("1", "2", "3", "4"), AS_OF)
    assert by_id(moved, "status", "data_statement", "software") == {
        "1": ("acceptable_package", "s", "R"), "2": ("acceptable_package", None, None),
        "3": ("acceptable_package", "kept", "kept")}
    found = {(r.paper_id, r.round): (r.decision_de, r.replicator1, r.replicator2) for r in closed.collect()}
    assert found == {("1", 1): (None, "a", "b"), ("1", 2): ("accept", "a", "b"), ("2", 1): ("accept", None, None),
                     ("3", 1): (None, "a", None), ("3", 2): ("accept", "c", None)}
    assert by_id(rejected, "reason") == {"4": "not_found"}


def test_revise_opens_an_emptied_round(desk, spark):
    papers = desk.papers({"paper_id": "1", "status": "replicator_back_de"}, {"paper_id": "2", "status": "replicator_back_de"},
                         {"paper_id": "3"})
    rounds = desk.iterations({
        "paper_id": "1", "replicator1": "a", "hours1": Decimal("2"), "is_success": True, "software": "R",
        "date_completed_repl": D(2024, 6, 1), "github_url": "u", "is_confidential": True, "file_request_id_pkg": "old"})
    new_ids = spark.createDataFrame([("1", "fresh")], "paper_id string, file_request_id_pkg string")
    moved, both, rejected = changes.revise(papers, rounds, desk.ids("1", "2", "3"), AS_OF, new_ids)
    assert by_id(moved, "status", "round", "date_with_authors", "file_request_id_pkg")["1"] == (
        "with_author", 2, AS_OF, "fresh")
    old, new = both.orderBy("round").collect()
    assert (old.decision_de, old.date_decision_de, old.replicator1) == ("rnr", AS_OF, "a")
    assert (new.round, new.date_with_authors, new.github_url, new.file_request_id_pkg) == (2, AS_OF, "u", "fresh")
    assert all(new[c] is None for c in ("replicator1", "hours1", "is_success", "software", "is_confidential",
                                        "date_completed_repl", "date_decision_de", "decision_de"))
    assert by_id(rejected, "reason") == {"2": "no_iteration", "3": "wrong_status"}


def test_assign_and_reassign(desk, spark):
    papers = desk.papers({"paper_id": "1"}, {"paper_id": "2", "status": "with_replicator"}, {"paper_id": "3"})
    rounds = desk.iterations({"paper_id": "1"}, {"paper_id": "1", "round": 2, "replicator2": "z"},
                             {"paper_id": "2", "replicator1": "x", "replicator2": "y"})
    picks = spark.createDataFrame(
        [("1", "a", None, D(2024, 6, 20)), ("2", "b", None, None), ("3", "c", None, None)],
        "paper_id string, replicator1 string, replicator2 string, submitted date")
    moved, given, rejected = changes.assign(rounds, papers, picks, AS_OF)
    assert by_id(moved, "status") == {"1": "with_replicator", "2": "with_replicator", "3": "author_back_de"}
    found = {(r.paper_id, r.round): (r.replicator1, r.replicator2, r.date_arrived_from_authors) for r in given.collect()}
    assert found == {("1", 1): (None, None, None), ("1", 2): ("a", "z", D(2024, 6, 20)), ("2", 1): ("x", "y", None)}
    assert by_id(rejected, "reason") == {"2": "wrong_status", "3": "no_iteration"}
    _, given, rejected = changes.assign(rounds, papers, picks, AS_OF, overwrite=True)
    assert by_id(given.filter("round = 2 OR paper_id = '2'"), "replicator1", "replicator2") == {
        "1": ("a", None), "2": ("b", None)}
    assert by_id(rejected, "reason") == {"3": "no_iteration"}


def test_mark_arrived_and_publish(desk, spark):
    papers = desk.papers({"paper_id": "1", "status": "with_author"}, {"paper_id": "2"},
                         {"paper_id": "3", "status": "acceptable_package"})
    rounds = desk.iterations({"paper_id": "1"}, {"paper_id": "2"})
    moved, dated, rejected = changes.mark_arrived(papers, rounds, desk.ids("1", "2"), AS_OF)
    assert by_id(moved, "status")["1"] == "author_back_de"
    assert by_id(dated, "date_arrived_from_authors") == {"1": AS_OF, "2": None}
    assert by_id(rejected, "reason") == {"2": "wrong_status"}
    dois = spark.createDataFrame([("3", "doi:3"), ("2", "doi:2")], "paper_id string, doi string")
    out, rejected = changes.publish(papers, dois, AS_OF)
    assert by_id(out, "status", "doi", "date_published")["3"] == ("published_package", "doi:3", AS_OF)
    assert by_id(out, "doi")["2"] is None and by_id(rejected, "reason") == {"2": "wrong_status"}


def test_every_request_is_applied_or_rejected(desk, spark):
    papers = desk.papers({"paper_id": "1"}, {"paper_id": "2", "status": "acceptable_package"}, {"paper_id": "3"})
    rounds = desk.iterations({"paper_id": "1"}, {"paper_id": "2"}, {"paper_id": "3"})
    asked = spark.createDataFrame(
        [("1", "author_back_de", "nowhere"), ("1", "author_back_de", "with_replicator"), (None, None, None),
         ("1", "author_back_de", "with_replicator"), ("1", "author_back_de", "with_author"), ("1", None, None)],
        "paper_id string, from_status string, to_status string")
    moved, rejected = changes.transition(papers, asked)
    assert by_id(moved, "status")["1"] == "with_author"
    assert sorted((r.to_status or "", r.reason) for r in rejected.collect()) == [
        ("", "bad_target"), ("", "bad_target"), ("nowhere", "bad_target"), ("with_replicator", "superseded"),
        ("with_replicator", "superseded")]
    dois = spark.createDataFrame([("2", None), ("2", "10.1/x"), ("2", "10.1/y")], "paper_id string, doi string")
    out, rejected = changes.publish(papers, dois, AS_OF)
    assert by_id(out, "doi")["2"] == "10.1/x"
    assert sorted(r.reason for r in rejected.collect()) == ["no_doi", "superseded"]
    picks = spark.createDataFrame(
        [("3", None, None), ("3", "a@x", None), ("3", "a@x", None)], "paper_id string, replicator1 string, replicator2 string")
    moved, given, rejected = changes.assign(rounds, papers, picks, AS_OF)
    assert by_id(moved, "status")["3"] == "with_replicator" and by_id(given, "replicator1")["3"] == "a@x"
    assert sorted(r.reason for r in rejected.collect()) == ["no_replicator", "superseded"]
    many = desk.ids(*["1"] * 2500)
    assert changes.accept(papers, rounds, many, AS_OF)[2].count() == 2499


def test_no_report_is_lost(desk):
    papers = desk.papers({"paper_id": "1", "status": "with_replicator"})
    rounds = desk.iterations({"paper_id": "1"})
    when = dt.datetime(2024, 6, 1, 12)
    reports = desk.reports(
        {"paper_id": "1", "timestamp": when, "comments": "b"}, {"paper_id": "1", "timestamp": when, "comments": "a"},
        {"paper_id": "1", "timestamp": None, "comments": "0"}, {"paper_id": None, "timestamp": when},
        {"paper_id": None, "timestamp": when}, {"paper_id": "1", "round": None}, {"paper_id": "1", "round": None})
    moved, filled, rejected = changes.merge_reports(papers, rounds, reports)
    assert by_id(moved, "status")["1"] == "replicator_back_de" and by_id(filled, "repl_comments")["1"] == "a"
    assert sorted(r.reason for r in rejected.collect()) == [
        "no_iteration", "no_iteration", "not_found", "not_found", "superseded", "superseded"]


def test_arrival_needs_its_round(desk):
    papers = desk.papers({"paper_id": "1", "status": "with_author", "round": 2})
    moved, _, rejected = changes.mark_arrived(papers, desk.iterations({"paper_id": "1"}), desk.ids("1"), AS_OF)
    assert by_id(moved, "status")["1"] == "with_author" and by_id(rejected, "reason") == {"1": "no_iteration"}


def test_purge(desk):
    tables = {"papers": desk.papers({"paper_id": "1", "comments": "[TEST]"}, {"paper_id": "2"}),
              "iterations": desk.iterations({"paper_id": "1"}, {"paper_id": "1", "round": 2}, {"paper_id": "3"})}
    kept, log = changes.purge(tables, desk.ids("1", "9"))
    assert [r.paper_id for r in kept["papers"].collect()] == ["2"]
    assert by_id(log, "n_rows", "details", key="target") == {
        "papers": (1, "Deleted 1 rows"), "iterations": (2, "Deleted 2 rows")}
    kept, log = changes.purge_tests(tables)
    assert kept["iterations"].count() == 3 and by_id(log, "n_rows", key="target") == {"papers": 1, "iterations": 0}
