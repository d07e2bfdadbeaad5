"""Near-duplicate vectors by counting collisions of one-dimensional projections."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import work_folder, written

#: Half-width of a window, in standard deviations of a random unit vector's projection.
WINDOW = 0.9
#: Collisions that make a candidate.
COLLISIONS = 2
RECALL = 0.96
SEED = 11
USABLE = (
    "embedding IS NOT NULL AND exists(embedding, x -> x <> 0) AND forall(embedding, x ->"
    " x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
)


def chances(similarity: float, signs: int) -> float:
    """Chance that two unit vectors with this cosine collide in one round."""
    angle = math.acos(similarity)
    distance = math.sqrt(2 - 2 * similarity)
    return (1 - angle / math.pi) ** signs * math.erf(WINDOW / distance / math.sqrt(2))


def rounds_for(similarity: float, signs: int, collisions: int, recall: float) -> int:
    """The least number of rounds in which such a pair collides often enough at this recall."""
    p, n = chances(similarity, signs), collisions
    while True:
        short = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(collisions))
        if 1 - short >= recall:
            return n
        n += 1


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def classes(vectors: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Members (vec_id, class_id) and classes (class_id, embedding, members) of equal vectors.

    Only usable vectors take part: not null, not zero, all components finite. A class is named by
    its first row's smallest id; the names are hashes of the vector's components, so rows with
    equal vectors meet through a partial aggregate.
    """
    # adding zero turns -0.0 into 0.0, so that equal vectors have equal bytes
    whole = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.select("vec_id", "embedding").filter(F.expr(USABLE)).select(
        "vec_id", whole.alias("embedding"),
        F.sha2(F.array_join(F.transform(whole, lambda x: x.cast("string")), ","), 256).alias("class_id"))
    rows = written(rows, f"{folder}/usable")
    kinds = rows.groupBy("class_id").agg(
        F.first("embedding").alias("embedding"), F.count("*").alias("members"),
        F.min("vec_id").alias("least"))
    number = F.monotonically_increasing_id()  # fixed by the write
    kinds = written(
        kinds.select(number.alias("class"), "class_id", "embedding", "members", "least"),
        f"{folder}/classes")
    return rows.select("vec_id", "class_id"), kinds


def collisions(kinds: DataFrame, similarity: float, recall: float, collisions_needed: int) -> DataFrame:
    """Candidate pairs (a, b), a < b, of classes that collide in enough rounds.

    A round has a projection of its own, in which rows are sorted, and a window around every row;
    rows are asked about within a cell of equal signs on further projections, so a window holds
    rows near in many directions and its content doesn't grow with the table: the number of signs
    follows the logarithm of the rows, the number of rounds follows from the recall wanted for a
    pair exactly at ``similarity``. Every row is indexed and asks in every round, without caps; a
    frequent cell is joined in pieces by Spark.
    """
    n = kinds.count()
    signs = max(1, round(math.log2(max(n, 2))) - 1)
    rounds = rounds_for(similarity, signs, collisions_needed, recall)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            for length in sorted(set(batch.column("embedding").value_lengths().to_pylist())):
                rows = batch.filter(pa.array(batch.column("embedding").value_lengths().to_numpy() == length))
                x = _unit(_matrix(rows.column("embedding")))
                if length not in made:
                    made[length] = np.random.default_rng(SEED).standard_normal((length, rounds * (signs + 1)))
                seen = (x @ made[length]).reshape(len(x), rounds, signs + 1)
                cell = np.zeros((len(x), rounds), np.int64)
                for k in range(signs):
                    cell |= (seen[:, :, k] > 0).astype(np.int64) << k
                names = rows.column("class").to_numpy()
                yield pa.record_batch(
                    [pa.array(np.repeat(names, rounds)), pa.array(np.tile(np.arange(rounds), len(x))),
                     pa.array(cell.ravel()), pa.array(np.ascontiguousarray(seen[:, :, signs]).ravel()),
                     pa.array(np.full(len(x) * rounds, length))],
                    names=["class", "turn", "cell", "place", "size"])

    lines = kinds.select("class", "embedding").mapInArrow(
        run, "class long, turn long, cell long, place double, size long")
    q = lines.select(F.col("class").alias("a"), "turn", "cell", "size", F.col("place").alias("qa"))
    s = lines.select(F.col("class").alias("b"), "turn", "cell", "size", F.col("place").alias("sb"))
    return (
        q.join(s, ["turn", "cell", "size"]).filter(f"a < b AND abs(qa - sb) <= {WINDOW}")
        .groupBy("a", "b").agg(F.count("*").alias("hits")).filter(f"hits >= {collisions_needed}")
        .select("a", "b")
    )


def links(kinds: DataFrame, similarity: float, recall: float, collisions_needed: int) -> DataFrame:
    """Pairs of classes whose cosine, in double precision, is at least ``similarity``."""
    pairs = collisions(kinds, similarity, recall, collisions_needed)
    left = kinds.select(F.col("class").alias("a"), F.col("embedding").alias("x"))
    right = kinds.select(F.col("class").alias("b"), F.col("embedding").alias("y"))
    both = pairs.join(left, "a").join(right, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sizes = batch.column("x").value_lengths().to_numpy()
                keep = np.zeros(batch.num_rows, bool)
                for length in np.unique(sizes):
                    at = np.flatnonzero(sizes == length)
                    x = _unit(_matrix(batch.column("x").take(pa.array(at))))
                    y = _unit(_matrix(batch.column("y").take(pa.array(at))))
                    keep[at] = (x * y).sum(axis=1) >= similarity
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(run, "a long, b long")


def near_duplicates(
    vectors: DataFrame, similarity: float = 0.9, recall: float = RECALL,
    collisions_needed: int = COLLISIONS, folder: str | None = None,
) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding, ...)``: its links and its component.

    Two vectors are linked if their cosine is at least ``similarity``; pairs are searched so that
    one exactly at that cosine is found with chance ``recall`` (closer ones more often), and none
    below is returned. Equal vectors are folded first and always linked, so copies cost no pairs.
    Vectors of different lengths aren't compared. Columns: vec_id, n_links (other vectors linked
    directly), component_id (the smallest vec_id reachable), kept (vec_id = component_id). A
    vector that is null, zero, or holds null or non-finite components has no links and is its own
    component. Rows with a repeated vec_id count as vectors of their own; a null vec_id stays null.
    An empty table gives no rows; further columns are ignored.
    """
    spark = vectors.sparkSession
    folder = folder or work_folder(spark, "vectors")
    members, kinds = classes(vectors, folder)
    pairs = written(links(kinds, similarity, recall, collisions_needed), f"{folder}/pairs")
    roots = components(pairs, folder)
    ends = pairs.union(pairs.select("b", "a")).toDF("class", "other")
    sizes = kinds.select(F.col("class").alias("other"), "members")
    near = ends.join(sizes, "other").groupBy("class").agg(F.sum("members").alias("others"))
    named = written(
        kinds.select("class", "class_id", "members", "least")
        .join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
        .join(near, "class", "left")
        .select("class_id", "least", F.coalesce("root", "class").alias("root"),
                (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")),
        f"{folder}/named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    found = written(named.join(least, "root").select("class_id", "n_links", "component_id"), f"{folder}/found")
    linked = members.join(found, "class_id").select("vec_id", "n_links", "component_id")
    unusable = vectors.select("vec_id", "embedding").filter(F.expr(f"NOT coalesce({USABLE}, false)"))
    alone = unusable.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
