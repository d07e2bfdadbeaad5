from .files import append_csv, export_csv, file_manifest, read_snapshot
from .landed import read_articles, read_datasets, read_form
from .tables import (
    catalog_listing, catalog_tables, describe, drop_column, empty, non_empty, replace_table, table, table_or_none,
    write_bucketed,
)
from .versions import StaleVersion, VersionedTables

__all__ = [
    "StaleVersion", "VersionedTables", "append_csv", "catalog_listing", "catalog_tables", "describe", "drop_column", "empty",
    "export_csv", "file_manifest", "non_empty", "read_articles", "read_datasets", "read_form",
    "read_snapshot", "replace_table", "table", "table_or_none", "write_bucketed",
]
