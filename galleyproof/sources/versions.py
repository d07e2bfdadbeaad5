"""Tables that change together become visible together.

Every commit writes new folders and then one small manifest that lists the folders of all
tables. A table is one folder, and one more for each commit that only added rows to it. Readers take the manifest with the highest number. A commit names the version its data was
read from and fails if a newer one exists; a manifest is written aside and renamed to its number
only if that is free, so of two writers that started from one version the second fails, and no
reader sees half a manifest. A job lost half-way leaves files that nothing points to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..session import PACKED
from .files import list_files, read_text, write_text_once


class StaleVersion(RuntimeError):
    """Another writer committed after the version that a change started from."""


class VersionedTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def versions(self) -> list[int]:
        names = [f.rsplit("/", 1)[1] for f in list_files(self.spark, f"{self.root}/manifests")]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def version(self) -> int:
        """The newest version; 0 before the first commit."""
        return max(self.versions(), default=0)

    def _folders(self, version: int | None = None) -> dict[str, list[str]]:
        version = self.version() if version is None else version
        told = json.loads(read_text(self.spark, self._manifest(version))) if version else {}
        return {n: [f] if isinstance(f, str) else f for n, f in told.items()}  # one folder in older manifests

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifests/{version:08d}.json"

    def _read(self, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in folders])

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self._read(self._folders(version)[name])

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        return {n: self._read(f) for n, f in self._folders(version).items()}

    def commit(self, changed: Mapping[str, DataFrame], base: int, added: Mapping[str, DataFrame] | None = None) -> int:
        """Write changed tables and publish them with the unchanged ones; returns the version.

        ``added`` holds rows for tables that else stay as they are, with these tables' columns;
        only these rows are written.

        ``base`` is the version that the change was computed from (`version()` before reading, 0
        for an empty store). If another commit came since, `StaleVersion` is raised, and the change
        must be computed again from what it left.
        """
        self._check(base)
        folders, added = self._folders(base), added or {}
        for name, df in added.items():
            if name in changed or df.dtypes != self._read(folders[name]).dtypes:
                raise ValueError(f"rows to add to {name} don't have the columns of the table that stays")
        for name, df in [*changed.items(), *added.items()]:
            folder = f"data/{base + 1:08d}-{uuid.uuid4().hex}/{name}"
            df.write.options(**PACKED).parquet(f"{self.root}/{folder}")
            folders[name] = [*(folders[name] if name in added else []), folder]
        self._check(base)
        if not write_text_once(self.spark, self._manifest(base + 1), json.dumps(folders, sort_keys=True)):
            self._check(base)
            raise StaleVersion(f"version {base + 1} was taken meanwhile")
        return base + 1

    def _check(self, base: int) -> None:
        newest = self.version()
        if newest != base:
            raise StaleVersion(f"the change started from version {base}, the newest is {newest}")
