"""File lists of packages: reconciliation by content and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A directory whose name contains one of these is never deleted.
KEPT_DIRECTORIES = ["thirdparty", "preserve"]


def dataset_files(datasets: DataFrame) -> DataFrame:
    """One row per file of each data set: name, size, md5."""
    return datasets.select("global_id", F.inline(F.transform("files", lambda f: f["dataFile"]))).select(
        "global_id", "filename", "filesize", "md5")


def dataset_sizes(datasets: DataFrame) -> DataFrame:
    """Total size of each data set in MB; no files is 0."""
    sizes = F.transform(F.coalesce("files", F.array()), lambda f: F.coalesce(f["dataFile"]["filesize"], F.lit(0)))
    total = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return datasets.select("global_id", (total / 1024**2).alias("size_mb"))


def reconcile(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Contents of both sides by md5: matched, name_differs, only_local or only_remote.

    ``local`` holds (path, md5), ``remote`` (filename, md5). Equal contents on one side count
    once, under the smallest path or name.
    """
    here = local.groupBy("md5").agg(F.min("path").alias("local_path"))
    there = remote.groupBy("md5").agg(F.min("filename").alias("remote_name"))
    base = F.element_at(F.split("local_path", "/"), -1)
    outcome = (
        F.when(F.col("local_path").isNull(), "only_remote")
        .when(F.col("remote_name").isNull(), "only_local")
        .when(base == F.col("remote_name"), "matched")
        .otherwise("name_differs")
    )
    return here.join(there, "md5", "full_outer").select(
        "md5", "local_path", base.alias("local_name"), "remote_name", outcome.alias("outcome"))


def retention_plan(manifest: DataFrame) -> DataFrame:
    """Whether each file of a package is kept or deleted, by the directories on its path."""
    directory = F.regexp_replace("path", "[^/]*$", "")
    kept = directory.rlike("|".join(KEPT_DIRECTORIES))
    return manifest.select("path", "size", F.when(kept, "keep").otherwise("delete").alias("action"))
