"""Column expressions. All are built-in Spark functions and stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import STATUS_ROWS, TEST_MARK


def yesno_bool(c: Column) -> Column:
    """"yes" in any case is true; anything else, also null, is false."""
    return F.coalesce(F.lower(c) == "yes", F.lit(False))


def parse_bool(c: Column) -> Column:
    """"yes" in any case is true, other text is false, null stays null."""
    return F.lower(c) == "yes"


def na_default(c: Column, default: str = "NA") -> Column:
    return F.coalesce(c, F.lit(default))


def is_test(comments: Column) -> Column:
    """True for rows marked as tests; never null."""
    return F.coalesce(comments == TEST_MARK, F.lit(False))


def is_draft(version_state: Column) -> Column:
    return version_state == "DRAFT"


def case_id(journal: Column, name: Column, paper: Column, round_: Column) -> Column:
    return F.concat(journal, F.lit("-"), name, F.lit("-"), paper, F.lit("-R"), round_.cast("string"))


def case_path(journal: Column, slug: Column, round_: Column) -> Column:
    return F.concat(journal, F.lit("/"), slug, F.lit("/"), round_.cast("string"))


def paper_slug(last: Column, paper: Column, journal: Column | None = None) -> Column:
    parts = ([journal, F.lit("-")] if journal is not None else []) + [last, F.lit("-"), paper]
    return F.concat(*parts)


def clean_journal(c: Column) -> Column:
    return F.translate(c, ":", "-")


def paper_id(c: Column) -> Column:
    """Whole part of a number given as text or number, as text. Unreadable input gives null."""
    return F.floor(c.try_cast("double")).cast("bigint").cast("string")


def surname(c: Column) -> Column:
    """Lower-case surname from "Last, First" or "First Last"."""
    name = F.trim(c)
    last = F.when(F.contains(name, F.lit(",")), F.split_part(name, F.lit(","), F.lit(1))).otherwise(
        F.regexp_extract(name, r"(\S+)$", 1)
    )
    return F.lower(F.trim(last))


def strip_prefix(c: Column) -> Column:
    """A data set's name without its "Replication Data for:" lead and quotes."""
    lead = r"(?i)^Replication (Data|Code|Codes)( and Instructions)? for:?\s*"
    return F.btrim(F.regexp_replace(c, lead, ""), F.lit('"“” '))


def article_doi(citation: Column) -> Column:
    """DOI inside a citation's doi.org link, without trailing punctuation; null if none."""
    found = F.regexp_extract(citation, r'doi\.org/(10\.\d{4,}[^\s"]+)', 1)
    return F.nullif(F.rtrim(found, F.lit('.)]"')), F.lit(""))


def doi_from_url(c: Column) -> Column:
    return F.replace(c, F.lit("https://doi.org/"), F.lit("doi:"))


def form_date(c: Column) -> Column:
    return F.try_to_date(c, "d/M/yyyy")


def form_timestamp(c: Column) -> Column:
    """Day of a ``dd/mm/yyyy H:M:S`` entry."""
    return F.try_to_timestamp(c, F.lit("d/M/yyyy H:m:s")).cast("date")


def date_from_parts(parts: Column) -> Column:
    """[year, month?, day?] as a date; absent month and day are 1, an impossible date is null."""
    one = F.lit(1)
    text = F.format_string(
        "%04d-%02d-%02d",
        F.get(parts, F.lit(0)),
        F.coalesce(F.get(parts, F.lit(1)), one),
        F.coalesce(F.get(parts, F.lit(2)), one),
    )
    return F.when(F.get(parts, F.lit(0)).isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def quarter_label(c: Column) -> Column:
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))


def days_between(start: Column, end: Column) -> Column:
    return F.date_diff(end, start)


def responsible_actor(status: Column) -> Column:
    """Who acts next; "Unknown" for a state outside the workflow."""
    expr = F
    for name, actor, _, _ in STATUS_ROWS:
        expr = expr.when(status == name, F.lit(actor))
    return expr.otherwise(F.lit("Unknown"))


def age_band(days: Column) -> Column:
    return (
        F.when(days <= 3, "<=3").when(days <= 5, "<=5").when(days <= 10, "<=10").when(days > 10, ">10")
    )


def os_family(c: Column) -> Column:
    """Family of an operating system named in free text. macOS is tested before Windows, as
    "darwin" contains "win"."""
    text = F.lower(c)
    return (
        F.when(text.rlike("mac|darwin|osx"), "macOS")
        .when(F.contains(text, F.lit("win")), "Windows")
        .when(text.rlike("linux|ubuntu|debian|centos|fedora"), "Linux")
        .otherwise("Other")
    )


def overlap(a: Column, b: Column) -> Column:
    """Overlap coefficient of two token sets; null if one is empty."""
    return F.try_divide(
        F.size(F.array_intersect(a, b)).cast("double"), F.least(F.size(a), F.size(b)).cast("double")
    )


def invoice_number(c: Column) -> Column:
    """n of ``INV-n``; null when the text has no number there."""
    return F.get(F.split(c, "-"), F.lit(1)).try_cast("int")


def first_of(c: Column) -> Column:
    return F.get(c, F.lit(0))


def has(c: Column, value) -> Column:
    return F.array_contains(c, value)


def content_md5(c: Column) -> Column:
    return F.md5(c)
