"""Form submissions to staging rows, and staging rows to papers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ascii_name, clean_journal, paper_id, paper_slug, parse_bool, yesno_bool
from ..operators import insert_by_name, latest_by, polish_names, rename_select
from ..operators.joins import any_null, held_keys, without_keys
from ..schemas import FORM_ARRIVALS, PAPERS

# Polished question texts of the two forms and the columns they become.
ARRIVAL_NAMES = {
    "first_name_of_author": "firstname_of_author",
    "please_indicate_the_journal": "journal",
    "email_of_second_author_(if_applicable)": "email_of_second_author",
    "manuscript_title": "title",
    "manuscript_id_in_editorial_manager": "paper_id",
    "does_this_submission_contain_numerical_work_of_any_kind": "pure_theory",
    "is_any_of_the_data_used_in_this_manuscript_subject_to_access_restrictions": "is_confidential",
    "can_the_confidential_data_temporarily_be_shared_with_the_data_editor_for_replication_checks":
        "share_confidential",
}
REPORT_NAMES = {
    "replication_successul": "is_success",
    "does_the_package_rely_on_confidential_data_i_e_not_all_required_data_can_be_included_in_the_package":
        "is_confidential",
    "was_the_confidential_data_shared_with_us": "shared_confidential",
    "did_you_perform_a_remote_replication": "is_remote",
    "did_the_package_contain_high_performance_computing_(hpc)_requirements_(whether_or_not_we_ran_those_parts)":
        "is_HPC",
    "what_was_the_total_runtime_of_this_package_in_hours": "running_time_of_code",
    "quality_assessment_of_readme": "readme_quality",
    "package_complexity_assessment": "package_complexity",
    "did_push_your_report_to_the_github_repo_of_this_paper": "did_push",
}
PURE_THEORY = "No - Pure theory paper"
REPORT_DROPPED = ["please_enter_the_password_for_this_form", "did_push", "email_address"]
YES_NO = ["is_success", "is_confidential", "is_remote", "is_HPC", "shared_confidential"]


def clean_arrivals(raw: DataFrame) -> DataFrame:
    """Arrival form answers as staging rows: names, id, journal, slug; pure theory dropped."""
    df = rename_select(polish_names(raw), ARRIVAL_NAMES)
    df = df.filter(F.coalesce(F.col("pure_theory") != PURE_THEORY, F.lit(True)))
    df = df.withColumns(
        {"paper_id": paper_id(F.col("paper_id")), "journal": clean_journal(F.col("journal"))}
    )
    slug = paper_slug(ascii_name(F.col("surname_of_author")), F.col("paper_id"))
    df = df.withColumns({"paper_slug": slug, "processed": F.lit(False)})
    return df.select(*FORM_ARRIVALS.fieldNames())


def clean_reports(raw: DataFrame) -> DataFrame:
    """Report form answers as staging rows: names, whole round numbers, five yes/no columns."""
    df = polish_names(raw)
    df = df.toDF(*[c.replace("_(if_applicable)", "") for c in df.columns])
    df = rename_select(df, REPORT_NAMES).drop(*REPORT_DROPPED)
    return df.withColumns({
        "round": F.col("round").try_cast("double").cast("int"),
        "paper_id": paper_id(F.col("paper_id")),
        "journal": clean_journal(F.col("journal")),
        **{c: yesno_bool(F.col(c)) for c in YES_NO},
    })


def to_papers(arrivals: DataFrame) -> DataFrame:
    """Staging rows as first papers rows: state new_arrival, round 1, the rest typed nulls."""
    made = {
        "first_arrival_date": F.col("timestamp").cast("date"),
        "is_confidential": parse_bool(F.col("is_confidential")),
        "share_confidential": parse_bool(F.col("share_confidential")),
        "status": F.lit("new_arrival"),
        "round": F.lit(1),
    }
    return arrivals.select(*[
        made.get(f.name, F.col(f.name) if f.name in arrivals.columns else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in PAPERS
    ])


def fresh_rows(
    live: DataFrame, batch: DataFrame, keys: list[str] | str, null_safe: bool = False
) -> DataFrame:
    """Batch rows that `append_new` would add: one per key, the latest by ``timestamp``.

    Rows with a null key are not alike and all stay, unless ``null_safe``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    # ties in time are settled by the row's own content
    order = [F.desc_nulls_last("timestamp"), F.xxhash64(*batch.columns)]
    named = batch if null_safe else batch.filter(~any_null(keys))
    held = held_keys(named, live, keys, null_safe)
    fresh = without_keys(latest_by(named, keys, *order), held, keys, null_safe)
    return fresh if null_safe else fresh.unionByName(batch.filter(any_null(keys)))


def append_new(
    live: DataFrame, batch: DataFrame, keys: list[str] | str, null_safe: bool = False
) -> DataFrame:
    """The live table with the batch's new rows; rows already held are never changed."""
    return insert_by_name(live, fresh_rows(live, batch, keys, null_safe))
