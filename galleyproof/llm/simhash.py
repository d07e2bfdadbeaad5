"""SimHash near-duplicates, found by the generalised pigeonhole principle."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import LOCATOR, bounded_batches, located, text_of, unpacked, work_folder, written

BITS = 64
SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Cost of sending one probe through a shuffle, in comparisons of two fingerprints.
PROBE_COST = 20.0


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint of one whole text as a signed 64-bit integer; zero without words."""
    words = text.encode().lower().split()  # bytes: A-Z are lower-cased, ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)),
        np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # so that a very long text needs no large matrix of bits
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``fp`` (long) for every row of ``docs``; the whole text counts."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(*keys, text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py()) for t in batch.column("text")]
            yield pa.record_batch(
                [*(batch.column(k) for k in keys), pa.array(found, pa.int64())], names=[*keys, "fp"])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keys).schema]
    return rows.mapInArrow(run, ", ".join([*fields, "fp long"]))


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """The number of ``prints(fp)`` and how many have bits i and j set, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 1 << 15):
                part = np.ascontiguousarray(fp[at:at + (1 << 15)]).view(np.uint8).reshape(-1, 8)
                bits = np.unpackbits(part, axis=1, bitorder="little").astype(np.float32)
                both += bits.T @ bits
                n += len(bits)
        i, j = np.indices((BITS, BITS))
        out = [np.append(i, -1), np.append(j, -1), np.append(both, n).astype(np.int64)]
        yield pa.record_batch([pa.array(x.astype(np.int64)) for x in out], names=["i", "j", "c"])

    cells = prints.mapInArrow(run, "i long, j long, c long").groupBy("i", "j").agg(F.sum("c").alias("c"))
    both, n = np.zeros((BITS, BITS)), 0
    for r in cells.collect():  # 64 x 64 + 1 sums, whatever the input
        if r.i < 0:
            n = r.c
        else:
            both[r.i, r.j] = r.c
    return n, both


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The 64 bits in ``parts`` groups of nearly equal size, correlated bits together.

    A group starts with the free bit that is most correlated with other free bits and takes the
    free bit most correlated with its members. Its values are then unevenly spread, which leaves
    the other groups more even, and the thresholds can avoid it.
    """
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    with np.errstate(divide="ignore", invalid="ignore"):
        phi = np.abs(np.where(spread > 0, (both / max(n, 1) - np.outer(p, p)) / spread, 1.0))
    np.fill_diagonal(phi, 0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        width = math.ceil(len(free) / (parts - k))
        group = [max(free, key=lambda b: (phi[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < width:
            group.append(max(free, key=lambda b: (phi[b, group].sum(), -b)))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def within(n: int, both: np.ndarray, group: list[int], most: int) -> list[float]:
    """Estimated share of all pairs that differ in at most t bits of the group, t = 0 .. most."""
    p = (np.diag(both)[group] + 0.5) / (n + 1)
    chance = np.zeros(most + 1)
    chance[0] = 1
    for q in 2 * p * (1 - p):  # a pair differs in this bit
        chance = chance * (1 - q) + np.append(0, chance[:-1]) * q
    return np.cumsum(chance).tolist()


def thresholds(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds T_i >= -1 with sum ``total`` at the least sum of ``costs[i][T_i + 1]``.

    A dynamic programme over the groups; -1 leaves a group out.
    """
    best = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, len(row) - 1):
                new = (cost + row[t + 1], [*chosen, t])
                if spent + t not in step or new < step[spent + t]:
                    step[spent + t] = new
        best = step
    return best[total]


def plan(n: int, both: np.ndarray, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds, at the least estimated work.

    If two fingerprints differ in at most ``distance`` bits and the thresholds of m groups sum to
    ``distance - m + 1``, then in some group they differ in at most its threshold. Every choice of
    groups is complete, so the estimates decide about time only, not about results.
    """
    options = []
    for parts in range(2, distance + 2):
        groups = group_bits(n, both, parts)
        total = distance - parts + 1
        costs = []
        for group in groups:
            near = within(n, both, group, max(0, total + parts - 1))
            row, probes = [0.0], 0
            for t in range(0, max(0, total + parts - 1) + 1):
                probes += math.comb(len(group), t)
                # exact thresholds up to 2 only: probes of 3 or more bits are never worth it
                row.append(n * probes * PROBE_COST + n * n / 2 * near[t] if t <= 2 else math.inf)
            costs.append(row)
        cost, chosen = thresholds(costs, total)
        options.append((cost, parts, [(g, t) for g, t in zip(groups, chosen, strict=True) if t >= 0]))
    return min(options)[2]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def near_pairs(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints ``prints(fp)`` within ``distance`` bits.

    Every fingerprint is indexed under its bits of each group and probes the values within the
    group's threshold. The full distance is part of the join condition, so a frequent value costs
    comparisons but emits only true pairs, and Spark can split it over tasks.
    """
    spark = prints.sparkSession
    chosen = plan(*bit_statistics(prints), distance)
    index, probe = [], []
    for part, (group, most) in enumerate(chosen):
        mask = _signed(sum(1 << b for b in group))
        index.append(f"named_struct('part', {part}, 'key', fp & {mask}L)")
        for t in range(most + 1):
            for flip in itertools.combinations(group, t):
                probe.append((part, mask, _signed(sum(1 << b for b in flip))))
    lit = "array(" + ", ".join(
        f"named_struct('part', {p}, 'mask', {m}L, 'flip', {f}L)" for p, m, f in probe) + ")"
    stored = prints.select(F.col("fp").alias("b"), F.explode(F.expr(f"array({', '.join(index)})")).alias("i"))
    stored = stored.select("b", "i.part", "i.key")
    asked = prints.select(F.col("fp").alias("a"), F.explode(F.expr(lit)).alias("p")).select(
        "a", "p.part", F.expr("(a & p.mask) ^ p.flip").alias("key"))
    near = F.expr(f"a < b AND bit_count(a ^ b) <= {distance}")
    pairs = asked.alias("q").join(
        stored.alias("s"),
        (F.col("q.part") == F.col("s.part")) & (F.col("q.key") == F.col("s.key")) & near)
    return pairs.select("a", "b")


def link(docs: DataFrame, folder: str, distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, place, ``fp`` and ``root`` (equal for linked fingerprints) of every located row."""
    rows = written(fingerprints(docs, ["doc_id", *LOCATOR]), f"{folder}/prints")
    prints = written(rows.select("fp").distinct(), f"{folder}/distinct")
    roots = components(near_pairs(prints, distance), folder)
    roots = roots.select(F.col("node").alias("fp"), "root")
    return rows.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, folder: str | None = None, distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: its fingerprint and its component.

    Returns ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest doc_id
    reachable over fingerprints that differ in at most ``distance`` bits. Rows with one fingerprint
    are linked; texts without words have fingerprint zero. A null text is empty; a null doc_id
    keeps its row and names a component only if it has no other identifier (then null). Repeated
    rows stay. An empty table gives no rows; further columns are ignored.
    """
    folder = folder or work_folder(docs.sparkSession, "simhash")
    rows = written(link(located(docs, folder), folder, distance), f"{folder}/linked")
    least = written(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), f"{folder}/least")
    return rows.join(least, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component, the first by doc_id (nulls last) and place."""
    folder = work_folder(docs.sparkSession, "simhash")
    rows = located(docs, folder, whole=True)
    linked = written(link(rows.drop("__all"), folder, distance), f"{folder}/linked")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *LOCATOR)
    kept = linked.groupBy("root").agg(F.min(order).alias("first")).select("first.*").select(*LOCATOR)
    return unpacked(rows.select("__all", *LOCATOR).join(kept, LOCATOR, "left_semi"))
