import datetime as dt

import pytest
from pyspark.sql import functions as F

from galleyproof import functions as fn
from galleyproof.functions.names import _base_letters


@pytest.fixture
def apply(spark):
    def run(make, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
        rows = df.select("i", make(F.col("c")).alias("v")).collect()
        return [r.v for r in sorted(rows, key=lambda r: r.i)]

    return run


def test_yes_no_differ_on_null(apply):
    texts = ["Yes", "yes", "No", "", None]
    assert apply(fn.yesno_bool, texts) == [True, True, False, False, False]
    assert apply(fn.parse_bool, texts) == [True, True, False, False, None]


def test_paper_id(apply):
    assert apply(fn.paper_id, ["20241234.0", "0012", "7.9", "-1.5", "x", None]) == [
        "20241234", "12", "7", "-2", None, None]


@pytest.mark.parametrize("name, label", [
    ("Müller", "Mueller"), ("Ångström", "Aangstroem"), ("O'Brien", "Obrien"),
    ("García  Peña", "Garcia-Pena"), ("smith-jones", "Smith-Jones"), ("Łukasz", "Lukasz"),
    ("Đặng", "Dang"), ("Weiß", "Weiss"), ("Øster.Vold_x2y", "Oester.Vold_X2Y"),
    ("  -Ibáñez- ", "Ibanez"), ("étude", "Etude"), ("Șerban Țuțu", "Serban-Tutu"),
    ("Ζεύς", ""), ("Åke", "Ake"), ("", ""), (None, None),
])
def test_ascii_name(apply, name, label):
    assert apply(fn.ascii_name, [name]) == [label]


def test_base_letters_are_ascii():
    marked, plain = _base_letters()
    assert len(marked) == len(plain) > 400
    assert plain.isascii() and not any(c.isascii() for c in marked)


def test_surname(apply):
    assert apply(fn.surname, ["Doe, Jane", "Jane van Doe", " Doe ", "De La Cruz, Ana", None]) == [
        "doe", "doe", "doe", "de la cruz", None]


def test_titles(apply):
    assert apply(fn.strip_prefix, [
        'Replication Data for: "Trade and War"', "replication codes and instructions for “Trade”",
        "Replication Data on Trade"]) == ["Trade and War", "Trade", "Replication Data on Trade"]
    assert [sorted(t) for t in apply(fn.title_tokens, ["Éléphants, éléphants & 2 Ants!", "--", ""])] == [
        ["2", "ants", "elephants"], [], []]


def test_doi(apply):
    assert apply(fn.article_doi, [
        'Doe (2020) https://doi.org/10.1086/123.4).', "doi.org/10.12/x", "no link", None]) == [
        "10.1086/123.4", None, None, None]
    assert apply(fn.doi_from_url, ["https://doi.org/10.7910/A"]) == ["doi:10.7910/A"]


def test_dates(apply):
    day = dt.date(2024, 3, 5)
    assert apply(fn.form_date, ["05/03/2024", "5/3/2024", "2024-03-05", None]) == [day, day, None, None]
    assert apply(fn.form_timestamp, ["05/03/2024 7:04:09", "05/03/2024"]) == [day, None]
    parts = [[2024, 3, 5], [2024, 3], [2024], [None], [2024, 2, 30], None]
    assert apply(fn.date_from_parts, parts, "array<int>") == [
        day, dt.date(2024, 3, 1), dt.date(2024, 1, 1), None, None, None]
    assert apply(fn.quarter_label, [dt.date(2025, 9, 30), None], "date") == ["2025-Q3", None]


def test_bands_and_actors(apply):
    assert apply(fn.age_band, [-1, 3, 4, 5, 6, 10, 11, None], "int") == [
        "<=3", "<=3", "<=5", "<=5", "<=10", "<=10", ">10", None]
    assert apply(fn.responsible_actor, ["with_author", "published_package", "published", None]) == [
        "Author", "None (Completed)", "Unknown", "Unknown"]
    assert apply(fn.os_family, ["Windows 11", "Darwin", "OSX", "fedora", "BeOS", None]) == [
        "Windows", "macOS", "macOS", "Linux", "Other", "Other"]


def test_arrays(apply, spark):
    row = spark.range(1).select(
        fn.overlap(F.array(*map(F.lit, "abc")), F.array(*map(F.lit, "bcde"))).alias("o"),
        fn.overlap(F.array(F.lit("a")), F.array().cast("array<string>")).alias("none")).first()
    assert row.o == pytest.approx(2 / 3) and row.none is None
    assert apply(fn.first_of, [["x", "y"], [], None], "array<string>") == ["x", None, None]
    assert apply(lambda c: fn.has(c, "y"), [["x", "y"], ["x"]], "array<string>") == [True, False]
    assert apply(fn.invoice_number, ["INV-12", "INV", "INV-x", None]) == [12, None, None, None]
