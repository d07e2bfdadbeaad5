"""Merkle manifest of a table: a tree of digests per language, proved by octopus multiproofs.

A tree's nodes have coordinates (tree, level, position). Leaves of one language are numbered by
doc_id; every eight consecutive nodes of a level make one of the next, until one is left. The
subroots of all languages are the leaves of one further tree, ``TOP``.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import work_folder, written

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
FAN = 8
#: Levels that are built from one block of leaves, and the nodes of such a block.
LEVELS = 4
BLOCK = FAN**LEVELS
#: Tree number of the subroots.
TOP = -1
#: Bits of a row's number within its sorted part, as Spark numbers rows.
ROW_BITS = 33


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: each value as its bytes' count, a colon and itself, or "-" if null."""
    told = [F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")) for v in values]
    return F.sha2(F.concat(*[F.coalesce(t, F.lit("-")) for t in told]), 256)


@dataclass
class Manifest:
    """``leaves``: doc_id, leaf, shown, tree, position, n (leaves of the tree); ``trees``: lang,
    tree, n; ``nodes``: tree, level, position, digest, leaves included."""

    leaves: DataFrame
    trees: DataFrame
    nodes: DataFrame
    n_trees: int
    root: str | None


def _numbered(rows: DataFrame, order: list[str], folder: str) -> DataFrame:
    """``rows`` with ``at``, their rank by ``order``; equal rows in any order.

    Parts are ranges of the order, so a hot key spreads over many. A part's rows are numbered as
    they are written, and only the parts' sizes are added up.
    """
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order, "tie")
    dealt = dealt.sortWithinPartitions(*order, "tie").drop("tie")
    placed = written(dealt.withColumn("place", F.monotonically_increasing_id()), f"{folder}/placed")
    part = F.shiftright("place", ROW_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    # a row per part of the table, not per row
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    starts = written(starts, f"{folder}/starts")
    row = F.col("place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.withColumn("part", part).join(starts, "part").withColumn("at", row + F.col("start")).drop(
        "part", "place", "start")


def _climbed(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of the ``LEVELS`` levels above ``level`` from nodes (tree, position, n, digest), ``n``
    being the tree's nodes at that level. A tree ends at its level of one node."""
    held = F.sort_array(F.collect_list(F.struct("position", "digest")))
    blocks = nodes.groupBy("tree", "n", F.expr(f"position div {BLOCK}").alias("block")).agg(
        F.transform(held, lambda x: x["digest"]).alias("l0"))

    def runs(below: str) -> Column:
        last = F.ceil(F.size(below) / FAN).cast("int") - 1
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(
            F.array_join(F.slice(below, i * FAN + 1, FAN), ""), 256))

    def placed(k: int) -> Column:
        first, n = F.col("block") * FAN ** (LEVELS - k), F.expr(f"(n + {FAN**k - 1}) div {FAN**k}")
        return F.transform(f"l{k}", lambda d, i: F.struct(
            F.lit(level + k).alias("level"), (first + i).alias("position"), d.alias("digest"), n.alias("n")))

    for k in range(1, LEVELS + 1):
        grows = F.col("n") > FAN ** (k - 1)
        blocks = blocks.withColumn(f"l{k}", F.when(grows, runs(f"l{k - 1}")).otherwise(F.array().cast("array<string>")))
    return blocks.select("tree", F.explode(F.concat(*map(placed, range(1, LEVELS + 1)))).alias("node")).select(
        "tree", "node.*")


def _grown(leaves: DataFrame, folder: str) -> DataFrame:
    """All nodes above ``leaves(tree, position, n, digest)``; each round takes LEVELS levels."""
    level, parts, below = 0, [], leaves
    while (below.agg(F.max("n")).first()[0] or 0) > 1:
        made = written(_climbed(below.filter("n > 1"), level), f"{folder}/{level}")
        level += LEVELS
        parts.append(made)
        below = made.filter(F.col("level") == level).select("tree", "position", "n", "digest")
    out = leaves.select("tree", F.lit(0).alias("level"), "position", "digest", "n")
    for part in parts:
        out = out.unionByName(part)
    return out


def manifest(docs: DataFrame, folder: str, shown: Column | None = None, fields: list[str] = FIELDS) -> Manifest:
    """The tree over ``docs``, whose rows are digested over ``fields`` in one pass.

    ``shown`` is the text that the holder of a row shows; its digest is kept as ``shown`` beside
    the true ``leaf``. Equal doc_ids are ordered by their leaf, nulls come first; a null language
    is a language. Any field may be null, repeated rows are leaves of their own, further columns
    are ignored, and an empty table has no root.
    """
    values = [F.col(c) for c in fields]
    leaf = leaf_digest(*values)
    seen = leaf if shown is None else F.when(shown.eqNullSafe(F.col("text")), leaf).otherwise(
        leaf_digest(*[shown if c == "text" else F.col(c) for c in fields]))
    rows = docs.select("doc_id", "lang", leaf.alias("leaf"), seen.alias("shown"))
    rows = _numbered(written(rows, f"{folder}/digests"), ["lang", "doc_id", "leaf"], f"{folder}/order")
    rows = written(rows, f"{folder}/ranked")
    trees = rows.groupBy("lang").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    trees = _numbered(written(trees, f"{folder}/langs"), ["first"], f"{folder}/langs_order")
    trees = written(trees.withColumnRenamed("at", "tree"), f"{folder}/trees")
    own = trees.select(F.col("lang").alias("own_lang"), "tree", "first", "n")
    leaves = rows.join(own, F.col("lang").eqNullSafe(F.col("own_lang"))).select(
        "doc_id", "leaf", "shown", "tree", (F.col("at") - F.col("first")).alias("position"), "n")
    leaves = written(leaves, f"{folder}/leaves")
    low = _grown(leaves.select("tree", "position", "n", F.col("leaf").alias("digest")), f"{folder}/low")
    n_trees = trees.count()
    subroots = low.filter("n = 1").select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("position"),
        F.lit(n_trees).cast("long").alias("n"), "digest")
    high = _grown(written(subroots, f"{folder}/subroots"), f"{folder}/high")
    root = high.filter("n = 1").first()
    nodes = low.unionByName(high).select("tree", "level", "position", "digest")
    return Manifest(leaves, trees, nodes, n_trees, root and root.digest)


def octopus(positions: Iterable[int], n: int) -> list[tuple[int, int]]:
    """Coordinates (level, position) that leaves at ``positions`` of a tree of ``n`` leaves lack.

    Climbing together, the leaves need a node once, and none that can be made from them.
    """
    known, level, lacking = sorted(set(positions)), 0, []
    while n > 1:
        parents = []
        for group, run in itertools.groupby(known, lambda i: i // FAN):
            held = set(run)
            lacking += [(level, i) for i in range(group * FAN, min(n, (group + 1) * FAN)) if i not in held]
            parents.append(group)
        known, n, level = parents, -(-n // FAN), level + 1
    return lacking


def derive(leaves: dict[int, str], n: int, fetched: dict[tuple[int, int], str]) -> tuple[list[dict[int, list[str]]], str]:
    """Runs of siblings per level by group, and the root, from leaves and the nodes they lack."""
    known, level, runs = leaves, 0, []
    while n > 1:
        own = {}
        for group in dict.fromkeys(i // FAN for i in known):
            span = range(group * FAN, min(n, (group + 1) * FAN))
            own[group] = [known[i] if i in known else fetched[level, i] for i in span]
        runs.append(own)
        known = {group: sha256("".join(run)) for group, run in own.items()}
        n, level = -(-n // FAN), level + 1
    return runs, next(iter(known.values()))


def path(runs: list[dict[int, list[str]]], position: int) -> list[tuple[str, str]]:
    """Siblings to the left and to the right of a leaf's path, level by level."""
    out = []
    for level in runs:
        group, place = divmod(position, FAN)
        run = level[group]
        out.append(("".join(run[:place]), "".join(run[place + 1:])))
        position = group
    return out


def fold(digest: str, siblings: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in siblings:
        digest = sha256(left + digest + right)
    return digest


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first two columns, also across batches."""
    rows = itertools.chain.from_iterable(zip(*[c.to_pylist() for c in b.columns], strict=True) for b in batches)
    for key, run in itertools.groupby(rows, itemgetter(0, 1)):
        yield key, list(run)


def prove(held: Manifest, folder: str, wanted: DataFrame | None = None) -> DataFrame:
    """One row per leaf of ``wanted`` (rows of ``held.leaves``; None: all) with its proof.

    Leaves are dealt by blocks of consecutive positions. Each block's task computes the minimal
    union of nodes that its leaves lack, these are fetched by one join for all blocks, and the
    block's interiors, which its leaves share, are derived once and cut into single proofs.

    Columns: doc_id, leaf, subroot, root, proof_sha256 (digest of the leaf's siblings from the
    leaf's level to the root), folded_root (from what is ``shown`` and the siblings), verified.
    """
    leaves = held.leaves if wanted is None else wanted
    n_trees, root = held.n_trees, held.root
    block = F.expr(f"position div {BLOCK}").alias("block")
    by_block = leaves.select("tree", block, "position", "n").repartition("tree", "block").sortWithinPartitions(
        "tree", "block", "position")

    def lacking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, own), rows in _groups(batches):
            found = [(tree, *c) for c in octopus([r[2] for r in rows], rows[0][3])]
            found += [(TOP, *c) for c in octopus([tree], n_trees)]
            if found:
                where = zip(*found, strict=True)
                yield pa.record_batch(
                    [pa.array([x] * len(found), pa.int64()) for x in (tree, own)]
                    + [pa.array(x, pa.int64()) for x in where],
                    names=["tree", "block", "of_tree", "level", "position"])

    asked = by_block.mapInArrow(lacking, "tree long, block long, of_tree long, level long, position long")
    asked = written(asked, f"{folder}/lacking")
    store = held.nodes.select(
        F.col("tree").alias("of_tree"), F.col("level").cast("long").alias("level"), "position", "digest")
    fetched = asked.join(store, ["of_tree", "level", "position"])
    kind = leaves.schema["doc_id"].dataType.simpleString()
    mine = leaves.select(
        "tree", block, F.lit(1).alias("kind"), F.lit(0).cast("long").alias("of_tree"), F.lit(0).cast("long").alias("level"),
        "position", "n", "doc_id", F.col("leaf").alias("digest"), "shown")
    theirs = fetched.select(
        "tree", "block", F.lit(0).alias("kind"), "of_tree", "level", "position",
        F.lit(0).cast("long").alias("n"), F.lit(None).cast(kind).alias("doc_id"), "digest",
        F.lit(None).cast("string").alias("shown"))
    met = theirs.unionByName(mine).repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "position")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        id_type = head.schema.field("doc_id").type
        for (tree, _), rows in _groups(itertools.chain([head], batches)):
            low = {(r[4], r[5]): r[8] for r in rows if not r[2] and r[3] == tree}
            high = {(r[4], r[5]): r[8] for r in rows if not r[2] and r[3] == TOP}
            own = [r for r in rows if r[2]]
            runs, subroot = derive({r[5]: r[8] for r in own}, own[0][6], low)
            upper, top = derive({tree: subroot}, n_trees, high)
            if top != root:
                raise ValueError(f"the nodes fetched for tree {tree} don't give the root")
            above, out = path(upper, tree), []
            for r in own:
                siblings = path(runs, r[5]) + above
                told = sha256("".join(left + right for left, right in siblings))
                folded = fold(r[9], siblings)
                out.append((r[7], r[8], subroot, top, told, folded, folded == root))
            columns = [pa.array(c) for c in list(zip(*out, strict=True))[1:]]
            yield pa.record_batch([pa.array([r[0] for r in out], id_type), *columns], names=names)

    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    fields = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return met.mapInArrow(expand, f"{fields}, verified boolean")


def tampered(every: int = 3) -> Column:
    """The text with A-Z in lower case where ``every`` divides the crc32 of the doc_id."""
    upper = "".join(map(chr, range(65, 91)))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return F.when(F.coalesce(hit, F.lit(False)), F.translate("text", upper, upper.lower())).otherwise(F.col("text"))


def prove_tampered(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Proofs of all rows of ``docs``, some of which show a text that was tampered with.

    Odd values as in ``manifest``; a row with a null doc_id isn't tampered with.
    """
    folder = folder or work_folder(docs.sparkSession, "merkle")
    return prove(manifest(docs, folder, tampered()), folder)
