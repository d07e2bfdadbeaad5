"""Declared tables, the status dimension and the schemas of landed JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Workflow states in report order, who acts next, and the column whose date says
# when a paper entered the state ("papers" or "iterations" is the table that holds it).
STATUS_ROWS = [
    ("new_arrival", "Data Editor", "papers", "first_arrival_date"),
    ("with_replicator", "Replicator", "iterations", "date_assigned_repl"),
    ("replicator_back_de", "Data Editor", "iterations", "date_completed_repl"),
    ("author_back_de", "Data Editor", "iterations", "date_arrived_from_authors"),
    ("with_author", "Author", "iterations", "date_with_authors"),
    ("acceptable_package", "Journal Office", "iterations", "date_decision_de"),
    ("published_package", "None (Completed)", "papers", "date_published"),
]
STATUSES = [row[0] for row in STATUS_ROWS]
DONE_STATUSES = ["acceptable_package", "published_package"]
TEST_MARK = "[TEST]"
HOURS = T.DecimalType(18, 3)

TEXT, INT, BOOL, DATE = T.StringType(), T.IntegerType(), T.BooleanType(), T.DateType()
TIME = T.TimestampNTZType()

# The columns of the stored tables, in their declared order.
PAPERS = T.StructType([
    T.StructField("timestamp", TIME),
    T.StructField("journal", TEXT),
    T.StructField("paper_id", TEXT),
    T.StructField("title", TEXT),
    T.StructField("firstname_of_author", TEXT),
    T.StructField("surname_of_author", TEXT),
    T.StructField("email_of_author", TEXT),
    T.StructField("email_of_second_author", TEXT),
    T.StructField("handling_editor", TEXT),
    T.StructField("is_confidential", BOOL),
    T.StructField("share_confidential", BOOL),
    T.StructField("comments", TEXT),
    T.StructField("paper_slug", TEXT),
    T.StructField("first_arrival_date", DATE),
    T.StructField("status", TEXT),
    T.StructField("round", INT),
    T.StructField("file_request_id_pkg", TEXT),
    T.StructField("file_request_path", TEXT),
    T.StructField("repl_package_path", TEXT),
    T.StructField("paper_path", TEXT),
    T.StructField("file_request_path_full", TEXT),
    T.StructField("file_request_url_pkg", TEXT),
    T.StructField("file_request_id_paper", TEXT),
    T.StructField("file_request_url_paper", TEXT),
    T.StructField("date_with_authors", DATE),
    T.StructField("date_published", DATE),
    T.StructField("is_remote", BOOL),
    T.StructField("is_HPC", BOOL),
    T.StructField("data_statement", TEXT),
    T.StructField("software", TEXT),
    T.StructField("github_url", TEXT),
    T.StructField("doi", TEXT),
    T.StructField("doi_paper", TEXT),
    T.StructField("gh_org_repo", TEXT),
])

ITERATIONS = T.StructType([
    T.StructField("timestamp", TIME),
    T.StructField("journal", TEXT),
    T.StructField("paper_id", TEXT),
    T.StructField("title", TEXT),
    T.StructField("firstname_of_author", TEXT),
    T.StructField("surname_of_author", TEXT),
    T.StructField("email_of_author", TEXT),
    T.StructField("email_of_second_author", TEXT),
    T.StructField("handling_editor", TEXT),
    T.StructField("is_confidential", BOOL),
    T.StructField("share_confidential", BOOL),
    T.StructField("comments", TEXT),
    T.StructField("paper_slug", TEXT),
    T.StructField("first_arrival_date", DATE),
    T.StructField("round", INT),
    T.StructField("replicator1", TEXT),
    T.StructField("replicator2", TEXT),
    T.StructField("hours1", HOURS),
    T.StructField("hours2", HOURS),
    T.StructField("is_success", BOOL),
    T.StructField("software", TEXT),
    T.StructField("is_confidential_shared", BOOL),
    T.StructField("is_remote", BOOL),
    T.StructField("is_HPC", BOOL),
    T.StructField("runtime_code_hours", HOURS),
    T.StructField("data_statement", TEXT),
    T.StructField("repl_comments", TEXT),
    T.StructField("date_with_authors", DATE),
    T.StructField("date_arrived_from_authors", DATE),
    T.StructField("date_assigned_repl", DATE),
    T.StructField("date_completed_repl", DATE),
    T.StructField("date_decision_de", DATE),
    T.StructField("decision_de", TEXT),
    T.StructField("fr_path_apps", TEXT),
    T.StructField("fr_path_full", TEXT),
    T.StructField("file_request_path", TEXT),
    T.StructField("repl_package_path", TEXT),
    T.StructField("paper_path", TEXT),
    T.StructField("file_request_path_full", TEXT),
    T.StructField("file_request_id_pkg", TEXT),
    T.StructField("file_request_id_paper", TEXT),
    T.StructField("file_request_url_pkg", TEXT),
    T.StructField("file_request_url_paper", TEXT),
    T.StructField("github_url", TEXT),
    T.StructField("gh_org_repo", TEXT),
    T.StructField("dropbox_password", TEXT),
    T.StructField("replicator_upload_id", TEXT),
    T.StructField("replicator_upload_url", TEXT),
    T.StructField("preprocess_mode", TEXT),
])

# Staging tables keep the shape of the forms they come from.
FORM_ARRIVALS = T.StructType([
    T.StructField("timestamp", TIME),
    T.StructField("journal", TEXT),
    T.StructField("paper_id", TEXT),
    T.StructField("title", TEXT),
    T.StructField("firstname_of_author", TEXT),
    T.StructField("surname_of_author", TEXT),
    T.StructField("email_of_author", TEXT),
    T.StructField("email_of_second_author", TEXT),
    T.StructField("handling_editor", TEXT),
    T.StructField("is_confidential", TEXT),
    T.StructField("share_confidential", TEXT),
    T.StructField("comments", TEXT),
    T.StructField("paper_slug", TEXT),
    T.StructField("processed", BOOL),
])

REPORTS = T.StructType([
    T.StructField("timestamp", TIME),
    T.StructField("paper_id", TEXT),
    T.StructField("journal", TEXT),
    T.StructField("round", INT),
    T.StructField("email_of_replicator_1", TEXT),
    T.StructField("email_of_replicator_2", TEXT),
    T.StructField("hours_replicator_1", HOURS),
    T.StructField("hours_replicator_2", HOURS),
    T.StructField("is_success", BOOL),
    T.StructField("software_used_in_package", TEXT),
    T.StructField("is_confidential", BOOL),
    T.StructField("shared_confidential", BOOL),
    T.StructField("is_remote", BOOL),
    T.StructField("is_HPC", BOOL),
    T.StructField("running_time_of_code", HOURS),
    T.StructField("data_statement", TEXT),
    T.StructField("readme_quality", INT),
    T.StructField("package_complexity", INT),
    T.StructField("comments", TEXT),
])

REPLICATORS = T.StructType([
    T.StructField("email", TEXT),
    T.StructField("name", TEXT),
    T.StructField("surname", TEXT),
    T.StructField("os", TEXT),
    T.StructField("current_workload", INT),
    T.StructField("can_take_+1_package", TEXT),
    T.StructField("invoice", TEXT),
])

TABLES = {
    "papers": PAPERS,
    "iterations": ITERATIONS,
    "form_arrivals": FORM_ARRIVALS,
    "reports": REPORTS,
}
KEYS = {
    "papers": ["paper_id"],
    "iterations": ["paper_id", "round"],
    "form_arrivals": ["paper_id"],
    "reports": ["paper_id", "round"],
}

DATASET_JSON = (
    "global_id string, name string, authors array<string>, publicationStatuses array<string>, "
    "updatedAt string, versionState string, size_mb double, "
    "publications array<struct<citation: string>>, "
    "files array<struct<dataFile: struct<filename: string, filesize: bigint, md5: string>>>"
)
ARTICLE_JSON = (
    "DOI string, title array<string>, author array<struct<family: string>>, "
    "published struct<`date-parts`: array<array<int>>>"
)


def check_statuses(*statuses: str) -> None:
    unknown = [s for s in statuses if s not in STATUSES]
    if unknown:
        raise ValueError(f"invalid status {unknown}; needs to be one of {STATUSES}")


def status_dim(spark: SparkSession) -> DataFrame:
    """The seven states with rank and actor; an inline relation, never a file."""
    values = ", ".join(f"({i}, '{s}', '{actor}')" for i, (s, actor, _, _) in enumerate(STATUS_ROWS, 1))
    return spark.sql(f"SELECT * FROM VALUES {values} AS d(rank, status, actor)")


def status_rank(status: Column) -> Column:
    """Position of a state in the report order, null when unknown."""
    order = F.array(*[F.lit(s) for s in STATUSES])
    return F.nullif(F.array_position(order, status), F.lit(0).cast("bigint")).cast("int")
