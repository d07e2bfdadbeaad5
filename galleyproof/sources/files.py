"""Files: CSV exports and snapshots, file manifests, and folders on any Hadoop file system."""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_folder

#: Bytes of a file that are read at a time for a manifest.
CHUNK = 4 << 20
#: Entries of directories that make up a batch.
LISTED = 1000


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header under a declared schema, so ids keep leading zeros."""
    return spark.read.schema(schema).csv(path, header=True, quote='"', escape='"', multiLine=False)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def append_csv(df: DataFrame, path: str) -> None:
    """Add rows to a CSV folder; each part file carries its header."""
    df.write.mode("append").csv(path, header=True, quote='"', escape='"')


def file_manifest(spark: SparkSession, root: str, folder: str | None = None) -> DataFrame:
    """Files under a root as (path, basename, size, md5), hidden and empty files too.

    Skips ``__MACOSX``, hidden directories and zip files that lie in the root itself: they are
    neither entered nor opened. Directories are listed by tasks, level by level, below ``folder``
    (default: the scratch folder); contents are read in pieces of ``CHUNK`` bytes that feed a
    running digest, so memory grows neither with a file nor with their number. The root must lie
    on a file system that Arrow knows (local, HDFS, S3, GCS, Azure). An empty root gives no rows.
    """
    folder = folder or scratch_folder(spark, "listing", local=True)
    base = _qualified(spark, root.rstrip("/"))
    entry = "path string, is_dir boolean, size long"
    spark.createDataFrame([(base, True, None)], entry).write.parquet(f"{folder}/level=0")
    # a fixed number: paths are so short that adaptive execution would put them all in a few tasks
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    level = 0
    while True:
        found = spark.read.schema(entry).parquet(f"{folder}/level={level}")
        name = F.substring_index("path", "/", -1)
        entered = found.filter("is_dir") if not level else found.filter(
            F.col("is_dir") & ~F.startswith(name, F.lit(".")) & ~F.contains(name, F.lit("__MACOSX")))
        if entered.isEmpty():
            break
        level += 1
        entered.repartition(tasks, "path").mapInArrow(_entries, entry).write.parquet(f"{folder}/level={level}")
    rel = F.substr("path", F.lit(len(base) + 2))
    files = spark.read.schema(f"{entry}, level int").parquet(folder).filter("NOT is_dir")
    files = files.filter((F.col("level") > 1) | ~F.endswith("path", F.lit(".zip"))).select("path", "size")
    hashed = files.repartition(tasks, "path").mapInArrow(_running_md5, "path string, size long, md5 string")
    return hashed.select(rel.alias("path"), F.substring_index("path", "/", -1).alias("basename"), "size", "md5")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the given directories hold; small ones share a batch."""
    held: list[tuple[str, bool, int | None]] = []
    for path in itertools.chain.from_iterable(b.column("path").to_pylist() for b in batches):
        system, inner = open_system(path)
        for f in system.get_file_info(fs.FileSelector(inner)):
            folder = f.type == fs.FileType.Directory
            held.append((f"{path}/{f.base_name}", folder, None if folder else f.size))
        if len(held) >= LISTED:
            yield _batch(held)
            held = []
    yield _batch(held)


def _batch(rows: list[tuple[str, bool, int | None]]) -> pa.RecordBatch:
    kinds = {"path": pa.string(), "is_dir": pa.bool_(), "size": pa.int64()}
    return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds.values())], names=list(kinds))


def _running_md5(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = []
        for path in batch.column("path").to_pylist():
            system, inner = open_system(path)
            digest = hashlib.md5(usedforsecurity=False)
            with system.open_input_stream(inner) as stream:
                while piece := stream.read(CHUNK):
                    digest.update(piece)
            sums.append(digest.hexdigest())
        yield pa.record_batch([*batch.columns, pa.array(sums, pa.string())], names=["path", "size", "md5"])


def can_copy(spark: SparkSession, *paths: str) -> bool:
    """Whether `copy_files` can reach these paths, as Arrow knows their file systems."""
    try:
        for path in paths:
            open_system(_qualified(spark, path))
    except (pa.ArrowException, OSError):
        return False
    return True


def copy_files(spark: SparkSession, files: list[str], folder: str) -> None:
    """Copy files (URIs as `DataFrame.inputFiles` tells them) byte by byte into a new folder.

    Tasks copy in pieces of ``CHUNK`` bytes to a hidden name, compare the sizes and rename, so that
    a repeated task does no harm. Names get a number, as files of several folders may share one.
    """
    jvm, target = spark._jvm, _qualified(spark, folder)
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in files]
    rows = [(p, f"part-{i:05d}-{p.rsplit('/', 1)[1]}") for i, p in enumerate(map(lambda p: _qualified(spark, p), paths))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                (system, inner), (there, into) = open_system(source), open_system(target)
                there.create_dir(into)
                aside, size = f"{into}/_{uuid.uuid4().hex}", 0
                with system.open_input_stream(inner) as stream, there.open_output_stream(aside) as out:
                    while piece := stream.read(CHUNK):
                        out.write(piece)
                        size += len(piece)
                held = [s.get_file_info(f).size for s, f in ((system, inner), (there, aside))]
                if held != [size, size]:
                    raise OSError(f"{source} has {held[0]} bytes, its copy {held[1]}")
                there.move(aside, f"{into}/{name}")
            yield batch

    copied = spark.createDataFrame(rows, "source string, name string").mapInArrow(run, "source string, name string")
    if (n := copied.count()) != len(files):
        raise OSError(f"{n} of {len(files)} files were copied")


def open_system(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a qualified path, whose characters aren't encoded, and the path within."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    host, _, inner = rest.removeprefix("//").partition("/")
    system, head = fs.FileSystem.from_uri(f"{scheme}://{host}")
    return system, f"{head.rstrip('/')}/{inner}"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _qualified(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    text = fs.makeQualified(p).toString()
    return text


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Sub-folders of a path, sorted; none if the path is absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isFile())


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_text_once(spark: SparkSession, path: str, text: str) -> bool:
    """Publish a small file whole, or not at all and return False if the name is taken.

    It is written under another name and renamed without overwriting.
    """
    fs, p = _fs(spark, path)
    aside = p.suffix(f".{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(aside, p, no_options)
    except Py4JJavaError as error:
        fs.delete(aside, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(row.value for row in spark.read.text(path).toLocalIterator())
