"""Bounded samples of labelled rows, on which classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import text_of


def remainder(by: int) -> Column:
    """crc32 of doc_id as text, modulo ``by``; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % by


def hashed_share(rows: int, of: int) -> Column:
    """Holds for about four times ``rows`` of the ``of`` rows, by a hash of doc_id.

    It goes before a limit, so that what tasks send doesn't grow with their number.
    """
    share = min(1.0, 4 * rows / max(of, 1))
    return F.pmod(F.xxhash64("doc_id", F.lit("share")), F.lit(1 << 40)) < int(share * (1 << 40))


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int, most_bytes: int,
) -> list[tuple[str, int]]:
    """Whole texts with their label: a sample bounded by ``rows`` and ``most_bytes``.

    Rows come in the order of a hash of doc_id, so the sample is spread over the table and the same
    in every run; a text that doesn't fit into what is left of the bytes is passed over, and every
    label that occurs has a row. Only rows for which ``train`` holds are looked at. Null labels and identifiers
    are left out; of several labels of a document the smallest counts.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(train)
    known = known.dropna().groupBy("doc_id").agg(F.min("y").alias("y"))
    # which rows: identifiers and sizes only
    sizes = docs.select("doc_id", F.octet_length(text_of(docs)).alias("size"))
    known = known.filter(hashed_share(rows, known.count()))
    first = sizes.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "size").limit(rows).collect()
    # one row of each label before the bound counts: the first of fair size, else the smallest
    kinds = sorted({r["y"] for r in first})
    lead = []
    for y in kinds:
        own = [r for r in first if r["y"] == y]
        lead.append(next((r for r in own if r["size"] * len(kinds) <= most_bytes), min(own, key=lambda r: r["size"])))
    chosen = {(r["doc_id"], r["y"]) for r in lead}
    held = sum(r["size"] for r in lead)
    for r in first:
        if (r["doc_id"], r["y"]) not in chosen and held + r["size"] <= most_bytes:
            held += r["size"]
            chosen.add((r["doc_id"], r["y"]))
    if not chosen:
        return []
    kind = known.schema["doc_id"].dataType.simpleString()
    wanted = docs.sparkSession.createDataFrame(sorted(chosen), f"doc_id {kind}, y int")
    texts = docs.select("doc_id", text_of(docs).alias("text")).join(F.broadcast(wanted), "doc_id")
    # one row of a repeated identifier is enough
    found = texts.groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect()
    return [(r["text"], r["y"]) for r in sorted(found, key=lambda r: r["doc_id"])]
