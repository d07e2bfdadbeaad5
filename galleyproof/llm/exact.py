"""Exact deduplication with keyed streaming state on disk."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import LOCATOR, located, text_of, unpacked, work_folder, written

#: Rows of one group that are compared with their keeper in one task.
ROWS_A_TASK = 1000
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # between batches the state is on storage alone: executors hold that of running tasks only
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def normal_text(text: Column) -> Column:
    """The text with each run of ASCII white space as one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def stream_groups(spark: SparkSession, arrivals: str, folder: str, trigger_bytes: int) -> DataFrame:
    """Run the stream over the Parquet folder ``arrivals`` until it has read all that is there.

    State is kept per digest, in RocksDB with its checkpoint in ``folder``, and never expires: the
    first row by identifier with its place, and the number of rows. A later run over the same two
    folders goes on from that state. The state's rows come from partial aggregates, so a digest
    with a third of all rows sends one row per map task. Returns (digest, first, copies).
    """
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        read = spark.read.parquet(arrivals)
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *LOCATOR))
        query = (
            spark.readStream.schema(read.schema).option("maxBytesPerTrigger", str(trigger_bytes))
            .parquet(arrivals).groupBy("digest").agg(first.alias("first"), F.count("*").alias("copies"))
            .writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state")
            .trigger(availableNow=True)
            .foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{folder}/groups/batch={i}"))
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    kind = "struct<no_id: boolean, doc_id: {}, __file: string, __row: bigint>"
    kind = kind.format(read.schema["doc_id"].dataType.simpleString())
    groups = spark.read.schema(f"digest string, first {kind}, copies long, batch int")
    if not query.lastProgress:  # no rows, so no batch was written
        return groups.parquet(arrivals).limit(0).drop("batch")
    # each batch tells the state of the digests it met; the last word has the most copies
    return written(
        groups.parquet(f"{folder}/groups").groupBy("digest")
        .agg(F.min("first").alias("first"), F.max("copies").alias("copies")),
        f"{folder}/last",
    )


def decide(
    docs: DataFrame, folder: str | None = None, digest: Callable[[Column], Column] = sha256,
    trigger_bytes: int = 1 << 30,
) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: which row of its group of equal texts stays.

    Texts are equal when their bytes are, after ``normal_text``; null is the empty text. Rows
    arrive as (identifier, digest, place); the stream's state names each digest's first row. Every
    other row of the digest is then compared with the first one's text in full, and rows whose
    bytes differ despite the digest form groups of their own. Large groups are compared in pieces.

    The row with the smallest doc_id stays; a null doc_id comes last, and of rows with one doc_id
    the first by place. Columns: doc_id, keep_id, group_size, kept, text_sha256, and the row's
    place (``__file``, ``__row``). An empty table gives no rows; further columns are ignored.
    """
    folder = folder or work_folder(docs.sparkSession, "exact")
    return _decided(located(docs, folder), folder, digest, trigger_bytes)


def _decided(docs: DataFrame, folder: str, digest: Callable[[Column], Column] = sha256, trigger_bytes: int = 1 << 30) -> DataFrame:
    """``decide`` for located rows."""
    spark = docs.sparkSession
    text = normal_text(text_of(docs))
    arrivals = written(
        docs.select("doc_id", sha256(text).alias("text_sha256"), digest(text).alias("digest"), *LOCATOR),
        f"{folder}/arrivals",
    )
    groups = stream_groups(spark, f"{folder}/arrivals", folder, trigger_bytes)
    is_first = (F.col("__file") == F.col("first.__file")) & (F.col("__row") == F.col("first.__row"))
    rows = arrivals.join(groups, "digest").withColumn("is_first", is_first)

    # the full bytes of all rows that share a digest
    shared = rows.filter("copies > 1").select("digest", "copies", "is_first", *LOCATOR)
    hits = written(
        docs.select("doc_id", text.alias("bytes"), *LOCATOR).join(shared, LOCATOR),
        f"{folder}/hits",
    )
    pieces = F.ceil(F.col("copies") / ROWS_A_TASK)
    firsts = hits.filter("is_first").select(
        "digest", F.col("bytes").alias("first_bytes"),
        F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("piece"))
    strays = written(
        hits.withColumn("piece", F.pmod(F.xxhash64(*LOCATOR), pieces)).join(firsts, ["digest", "piece"])
        .filter("bytes <> first_bytes").select("digest", "doc_id", "bytes", *LOCATOR),
        f"{folder}/strays",
    )
    lost = strays.groupBy("digest").agg(F.count("*").alias("n_strays"))
    agreed = (
        rows.join(strays.select(*LOCATOR), LOCATOR, "left_anti").join(lost, "digest", "left")
        .select(
            "doc_id", F.col("first.doc_id").alias("keep_id"),
            (F.col("copies") - F.coalesce("n_strays", F.lit(0))).alias("group_size"),
            F.col("is_first").alias("kept"), "text_sha256", *LOCATOR)
    )
    own = strays.groupBy("digest", "bytes").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *LOCATOR)).alias("first"),
        F.count("*").alias("group_size"))
    apart = strays.join(own, ["digest", "bytes"]).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", is_first.alias("kept"),
        sha256(F.col("bytes")).alias("text_sha256"), *LOCATOR)
    return agreed.unionByName(apart)


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``decide`` drops; columns stay as they are."""
    folder = work_folder(docs.sparkSession, "exact")
    rows = located(docs, folder, whole=True)
    dropped = _decided(rows.drop("__all"), folder).filter("NOT kept").select(*LOCATOR)
    return unpacked(rows.select("__all", *LOCATOR).join(dropped, LOCATOR, "left_anti"))
