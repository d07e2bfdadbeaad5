from .aggregates import (
    all_missing, count_where, duplicate_keys, largest_files, last_modified, package_sizes,
    non_empty_tables, table_stats,
)
from .filters import (
    availability, available, by_status, by_surname, columns, de_waiting, delete_where, dropna,
    iteration, paper, polish_names, published_packages, recent_datasets, rename_select,
    select_matching, unprocessed, update_where, where_eq, without_tests,
)
from .joins import (
    assigned_rounds, carry_replicators, exists_rows, new_rows, reports_to_process,
    update_from_latest, update_from_round, waiting_rounds, with_previous_round,
)
from .ordering import expired_snapshots, latest_snapshot, rounds
from .sets import distinct_on, insert_by_name, missing_ids, reminders, two_slots
from .skew import is_stored, key_marked, key_rows, sieve, split_join
from .windows import current_rounds, latest_by, latest_iteration

__all__ = [
    "all_missing", "assigned_rounds", "availability", "available", "by_status", "by_surname",
    "carry_replicators", "columns", "count_where", "current_rounds", "de_waiting", "delete_where",
    "distinct_on", "dropna", "duplicate_keys", "exists_rows", "expired_snapshots",
    "insert_by_name", "is_stored", "iteration", "key_marked", "key_rows", "largest_files", "last_modified", "latest_by",
    "latest_iteration", "latest_snapshot", "missing_ids", "non_empty_tables", "new_rows", "package_sizes", "paper",
    "polish_names", "published_packages", "recent_datasets", "reminders", "rename_select",
    "reports_to_process", "rounds", "select_matching", "sieve", "split_join", "table_stats", "two_slots",
    "unprocessed", "update_from_latest", "update_from_round", "update_where", "waiting_rounds",
    "where_eq", "with_previous_round", "without_tests",
]
