import datetime as dt

from galleyproof import schemas
from galleyproof.operators import last_modified
from galleyproof.plans import changes, quality, snapshots
from conftest import by_id

DAY = dt.date(2024, 1, 1)
STEPS = quality.PROGRESS


def reached(paper_id, n, **more):
    """A round with the first n dates of the workflow set."""
    return {"paper_id": paper_id} | {c: DAY for c in STEPS[:n]} | more


def test_consistent_states_are_valid(desk):
    states = ["new_arrival", "with_author", "author_back_de", "with_replicator", "replicator_back_de"]
    papers = desk.papers(*[{"paper_id": str(i), "status": s} for i, s in enumerate(states)],
                         {"paper_id": "5", "status": "acceptable_package"},
                         {"paper_id": "6", "status": "published_package", "date_published": DAY})
    rounds = desk.iterations(*[reached(str(i), i) for i in range(5)],
                             reached("5", 5, decision_de="accept"), reached("6", 5))
    checked = quality.validate(papers, rounds)
    assert all(by_id(checked, "is_valid").values())
    assert quality.repair(papers, rounds).count() == 0


def test_every_check_fires(desk):
    cases = {
        "a": ("new_arrival", 1, ["Status is 'new_arrival' but has dates set that indicate further progress"]),
        "b": ("with_author", 0, ["Status is 'with_author' but date_with_authors is not set"]),
        "c": ("with_author", 2, ["Status is 'with_author' but date_arrived_from_authors is set"]),
        "d": ("author_back_de", 1, ["Status is 'author_back_de' but date_arrived_from_authors is not set"]),
        "e": ("author_back_de", 3, ["Status is 'author_back_de' but date_assigned_repl is set"]),
        "f": ("with_replicator", 2, ["Status is 'with_replicator' but date_assigned_repl is not set"]),
        "g": ("with_replicator", 4, ["Status is 'with_replicator' but date_completed_repl is set"]),
        "h": ("replicator_back_de", 3, ["Status is 'replicator_back_de' but date_completed_repl is not set"]),
        "i": ("replicator_back_de", 5, ["Status is 'replicator_back_de' but date_decision_de is set"]),
        "j": ("acceptable_package", 4, ["Status is 'acceptable_package' but date_decision_de is not set",
                                        "Status is 'acceptable_package' but decision_de is not 'accept'"]),
        "k": ("published_package", 5, ["Status is 'published_package' but date_published is not set"]),
        "l": ("published", 5, ["Unknown status: published"]),
        "m": (None, 0, ["Unknown status: missing"]),
    }
    papers = desk.papers(*[{"paper_id": k, "status": s} for k, (s, _, _) in cases.items()])
    rounds = desk.iterations(*[reached(k, n) for k, (_, n, _) in cases.items()])
    assert by_id(quality.validate(papers, rounds), "issues") == {k: v for k, (_, _, v) in cases.items()}


def test_papers_that_cannot_be_checked(desk):
    papers = desk.papers({"paper_id": "1"}, {"paper_id": "2", "round": 3}, {"paper_id": "3"}, {"paper_id": "4"}, {"paper_id": "4"})
    rounds = desk.iterations({"paper_id": "2"}, {"paper_id": "3"}, {"paper_id": "3"}, {"paper_id": "4"})
    assert by_id(quality.validate(papers, rounds), "issues") == {
        "1": ["No iterations found for paper 1"], "2": ["No iteration found for current round 3"],
        "3": ["No iteration found for current round 1"], "4": ["Paper ID 4 not found or has multiple entries"]}
    assert set(by_id(quality.repair(papers, rounds), "success").values()) == {False}


def test_repair_follows_the_dates(desk):
    papers = desk.papers(*[{"paper_id": str(n), "status": "published_package"} for n in range(6)],
                         {"paper_id": "p", "status": "with_author", "date_published": DAY},
                         {"paper_id": "r", "status": "acceptable_package"},
                         {"paper_id": "u", "status": None})
    rounds = desk.iterations(*[reached(str(n), n) for n in range(5)], reached("5", 5, decision_de="accept"),
                             reached("p", 5), reached("r", 5, decision_de="rnr"), reached("u", 1))
    fixes = quality.repair(papers, rounds)
    assert by_id(fixes, "new_status") == {
        "0": "new_arrival", "1": "with_author", "2": "author_back_de", "3": "with_replicator",
        "4": "replicator_back_de", "5": "acceptable_package", "p": "published_package", "r": "new_arrival",
        "u": "with_author"}
    messages = by_id(fixes, "message")
    assert messages["1"] == "Status updated from 'published_package' to 'with_author'"
    assert messages["r"].endswith("(current round is decided but not accepted)")
    done, rejected = changes.set_status(
        papers, fixes.filter("changed").selectExpr("paper_id", "new_status AS status"))
    assert rejected.count() == 0 and by_id(done, "status")["3"] == "with_replicator"


def test_conform_adds_typed_columns(spark):
    df = spark.createDataFrame([("1", "2", "x")], "paper_id string, round string, extra string")
    full = quality.conform(df, schemas.PAPERS)
    assert full.columns == schemas.PAPERS.fieldNames() + ["extra"]
    assert (full.first().round, full.first().doi) == (2, None)
    assert "doi" in quality.missing_columns(df, schemas.PAPERS)


def test_integrity(desk, spark):
    arrivals = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "paper_id string")
    tables = {"papers": desk.papers({"paper_id": "1"}), "form_arrivals": arrivals,
              "iterations": desk.iterations(), "reports": desk.reports()}
    row = quality.integrity(tables, spark).first()
    assert (row.description, row.severity) == ("2 paper_ids exist in form_arrivals but not in papers", "high")
    tables["form_arrivals"] = arrivals.limit(0)
    assert quality.integrity(tables, spark).count() == 0
    absent = quality.integrity({"papers": tables["papers"]}, spark).collect()
    assert {(r.table, r.severity) for r in absent} == {(t, "critical") for t in ("iterations", "form_arrivals", "reports")}


def test_lag_between_live_and_snapshot(desk):
    live = last_modified({"papers": desk.papers({"paper_id": "1", "date_with_authors": dt.date(2024, 1, 3)})})
    snap = last_modified({"papers": desk.papers({"paper_id": "1", "date_with_authors": DAY})})
    row = quality.snapshot_lag(live, snap).first()
    assert (row.state, row.hours) == ("live_newer", 48.0)
    assert quality.snapshot_lag(live, live).first().state == "in_sync"
    assert quality.snapshot_lag(snap, live).first().state == "snapshot_newer"


def test_restore_only_what_is_absent(desk):
    live = {"papers": desk.papers({"paper_id": "1"}), "iterations": desk.iterations({"paper_id": "2"}),
            "reports": desk.reports()}
    snap = {"papers": desk.papers({"paper_id": "1", "status": "with_author"}, {"paper_id": "2"}),
            "iterations": desk.iterations({"paper_id": "2"}, {"paper_id": "2", "round": 2})}
    tables, log = snapshots.restore(live, snap, desk.ids("1", "2", "3"))
    assert by_id(tables["papers"], "status") == {"1": "author_back_de", "2": "author_back_de"}
    assert tables["iterations"].count() == 1
    found = {(r.table, r.paper_id): (r.action, r.rows) for r in log.collect()}
    assert found[("papers", "2")] == ("restored", 1) and found[("papers", "1")] == ("skip", 1)
    assert found[("papers", "3")] == ("skip", 0) and found[("reports", "1")] == ("skip", 0)


def test_refill(desk):
    full = desk.papers({"paper_id": "1"})
    tables, actions = snapshots.refill(
        {"papers": desk.papers(), "iterations": None, "reports": desk.reports(), "form_arrivals": full},
        {"papers": full, "iterations": desk.iterations({"paper_id": "1"}), "form_arrivals": full})
    assert {n: t.count() for n, t in tables.items()} == {"papers": 1, "iterations": 1, "reports": 0, "form_arrivals": 1}
    assert [a[1] for a in actions] == ["populate_from_backup", "create_from_backup", "find_backup", "merge_not_implemented"]
