"""Row and column selection."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_test
from ..schemas import check_statuses
from .skew import split_join


def columns(df: DataFrame, cols: list[str], where: tuple[str, object] | None = None) -> DataFrame:
    """Projected scan with an optional equality filter; both reach the file scan."""
    return (df if where is None else where_eq(df, *where)).select(*cols)


def where_eq(df: DataFrame, col: str, val) -> DataFrame:
    return df.filter(F.col(col) == F.lit(val))


def by_status(papers: DataFrame, *statuses: str) -> DataFrame:
    """Papers in any of the given states; a name outside the workflow is an error."""
    check_statuses(*statuses)
    return papers.filter(F.col("status").isin(*statuses))


def paper(papers: DataFrame, paper_id: str) -> DataFrame:
    return where_eq(papers, "paper_id", paper_id)


def iteration(iterations: DataFrame, paper_id: str, round_: int | None = None) -> DataFrame:
    found = where_eq(iterations, "paper_id", paper_id)
    return found if round_ is None else where_eq(found, "round", round_)


def by_surname(papers: DataFrame, prefix: str) -> DataFrame:
    """Papers whose author's surname starts with a pattern, in any case."""
    return papers.filter(F.col("surname_of_author").rlike(f"(?i)^(?:{prefix})")).select(
        "paper_id", "surname_of_author", "round", "status"
    )


def without_tests(papers: DataFrame, iterations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables without test papers. Rounds go by their paper's mark, not by their own."""
    tests = papers.filter(is_test(F.col("comments"))).select("paper_id").distinct()
    return (
        papers.filter(~is_test(F.col("comments"))),
        split_join(iterations, tests, ["paper_id"], "left_anti"),
    )


def dropna(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.drop(subset=cols)


def de_waiting(papers: DataFrame) -> DataFrame:
    """Papers in the data editor's queue."""
    return by_status(papers, "author_back_de", "replicator_back_de").select(
        "paper_id", "paper_slug", "round", "surname_of_author", "status"
    )


def availability(replicators: DataFrame) -> DataFrame:
    """Each replicator with a flag that is true only for an explicit "Yes"."""
    free = F.coalesce(F.col("`can_take_+1_package`") == "Yes", F.lit(False))
    return replicators.select("email", "current_workload", free.alias("available"))


def available(replicators: DataFrame) -> DataFrame:
    return availability(replicators).filter("available").drop("available")


def unprocessed(arrivals: DataFrame) -> DataFrame:
    return arrivals.filter(~F.col("processed"))


def recent_datasets(datasets: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    """Data sets updated in the last ``days`` days; unreadable or absent times are dropped."""
    text = F.replace(F.col("updatedAt"), F.lit("Z"), F.lit(""))
    updated = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("date")
    return datasets.filter(updated >= F.date_sub(F.lit(as_of), days))


def published_packages(datasets: DataFrame) -> DataFrame:
    """Published data sets, largest first: first author's short name, DOI, size."""
    first = F.get(F.col("authors"), F.lit(0))
    name = F.split_part(F.split_part(first, F.lit(","), F.lit(1)), F.lit(" "), F.lit(1))
    return (
        datasets.filter(F.array_contains("publicationStatuses", "Published"))
        .select(name.alias("name"), F.col("global_id").alias("doi"), F.col("size_mb").alias("sizeMB"))
        .orderBy(F.desc_nulls_first("sizeMB"), "doi")
    )


def polish_names(df: DataFrame) -> DataFrame:
    """Column names in snake case; parentheses and plus signs stay, repeats get a number."""
    seen: dict[str, int] = {}
    polished = []
    for name in df.columns:
        name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip()).lower()
        name = re.sub(r"[^a-z0-9()+]+", "_", name).strip("_")
        seen[name] = seen.get(name, -1) + 1
        polished.append(f"{name}_{seen[name]}" if seen[name] else name)
    return df.toDF(*polished)


def rename_select(df: DataFrame, names: dict[str, str], keep: Iterable[str] | None = None) -> DataFrame:
    """Rename columns that are present; then keep the listed ones, if a list is given."""
    renamed = df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})
    return renamed if keep is None else renamed.select(*[_quoted(c) for c in keep])


def select_matching(df: DataFrame, pattern: str, *always: str) -> DataFrame:
    """The ``always`` columns and those whose name matches a pattern anywhere."""
    hits = [c for c in df.columns if re.search(pattern, c) and c not in always]
    return df.select(*[_quoted(c) for c in (*always, *hits)])


def update_where(df: DataFrame, pred: Column, col: str, val) -> DataFrame:
    """One column set where a predicate is true; null predicates leave the row alone."""
    return df.withColumn(col, F.when(pred, F.lit(val)).otherwise(F.col(col)))


def delete_where(df: DataFrame, eqs: dict[str, object]) -> DataFrame:
    """Rows left after deleting those equal in every listed column. Null never equals."""
    match = F.lit(True)
    for col, val in eqs.items():
        match = match & (F.col(col) == F.lit(val))
    return df.filter(~F.coalesce(match, F.lit(False)))


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")
