import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from galleyproof.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, leaf string, tree int, place string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(values):
    told = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values]
    return h(*told)


def brute_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i:i + 8]) for i in range(0, len(below), 8)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 8 * 8
        run = level[first:first + 8]
        out.append((run[:i - first], run[i - first + 1:]))
        i //= 8
    return out


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    """The contract in plain Python, from rows (doc_id, source, lang, n_chars, text)."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    order = sorted(by_lang, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: sorted(((r[0] is not None, r[0] or 0), brute_leaf(r), r) for r in by_lang[k]) for k in order}
    levels = {k: brute_tree([t[1] for t in trees[k]]) for k in order}
    top = brute_tree([levels[k][-1][0] for k in order])
    root, out = top[-1][0], []
    for k in order:
        for i, (_, leaf, r) in enumerate(trees[k]):
            steps = siblings(levels[k], i) + siblings(top, order.index(k))
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            digest = brute_leaf((*r[:4], lower(r[4]))) if hit else leaf
            for left, right in steps:
                digest = h(*left, digest, *right)
            proof = h(*[d for left, right in steps for d in left + right])
            out.append((r[0], leaf, levels[k][-1][0], root, proof, digest, digest == root))
    return out


def frame(spark, rows, path, parts=3):
    spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


def made_up(n, langs, seed):
    rng = random.Random(seed)
    return [
        (i, rng.choice(["web", None, "ß:"]), rng.choice(langs), rng.choice([None, 3, 40]),
         rng.choice([None, "", "Text É", "lower", "LONG " * 50]) and f"{rng.choice('ABab')} {i}")
        for i in range(n)]


@pytest.mark.parametrize("n, langs", [
    (1, ["en"]), (2, ["en"]), (8, ["en"]), (9, ["en"]), (65, ["en", "de"]), (700, ["en"] * 6 + [None, "de", "ä", "Z", ""]),
    (90, [f"l{i}" for i in range(70)]),
])
def test_proofs_equal_brute_force(spark, tmp_path, n, langs):
    rows = made_up(n, langs, n)
    # nulls in every column, a repeated row, a repeated doc_id, a very long text
    rows += [(None, None, None, None, None), (None, "web", "en", 1, "Ab")] * 2 * (n > 60)
    rows += [rows[0], (0, "other", rows[0][2], 5, "Xx"), (n + 5, "web", "en", 9, "Word " * 40000)] * (n > 60)
    got = merkle.prove_tampered(frame(spark, rows, f"{tmp_path}/docs"))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got, want = sorted(map(tuple, got.collect()), key=repr), sorted(brute(rows), key=repr)
    assert got == want
    assert n < 60 or {r[6] for r in got} == {True, False}


def test_an_empty_table_has_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert merkle.prove_tampered(docs).count() == 0


def test_blocks_of_several_rounds(spark, tmp_path, monkeypatch):
    """Small blocks, so that trees take many rounds and most nodes have to be fetched."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = made_up(600, ["en", "en", "de"], 5)
    got = merkle.prove_tampered(frame(spark, rows, f"{tmp_path}/docs"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows), key=repr)


def test_proofs_of_some_leaves(spark, tmp_path):
    """Leaves that miss their neighbours fetch these once a block, and give the same proofs."""
    rows = made_up(500, ["en", "en", "de"], 7)
    held = merkle.manifest(frame(spark, rows, f"{tmp_path}/docs"), f"{tmp_path}/m", merkle.tampered())
    wanted = held.leaves.filter("doc_id % 7 = 0")
    got = merkle.prove(held, f"{tmp_path}/p", wanted).collect()
    assert sorted(map(tuple, got)) == sorted(r for r in brute(rows) if r[0] % 7 == 0)
    asked = spark.read.parquet(f"{tmp_path}/p/lacking")
    assert asked.count() == asked.distinct().count()
    assert asked.join(wanted, (F.col("of_tree") == wanted.tree) & (asked.position == wanted.position) & (asked.level == 0)).isEmpty()


@pytest.mark.parametrize("seed", range(20))
def test_octopus_is_enough_and_minimal(seed):
    rng = random.Random(seed)
    n = rng.choice([1, 2, 8, 9, 64, 65, 600])
    leaves = [h(str(i)) for i in range(n)]
    levels = brute_tree(leaves)
    chosen = sorted(rng.sample(range(n), rng.randint(1, n)))
    lacking = merkle.octopus(chosen, n)
    fetched = {(k, i): levels[k][i] for k, i in lacking}
    runs, root = merkle.derive({i: leaves[i] for i in chosen}, n, fetched)
    assert root == levels[-1][0] and len(set(lacking)) == len(lacking)
    for i in chosen:
        assert merkle.path(runs, i) == [("".join(a), "".join(b)) for a, b in siblings(levels, i)]
        assert merkle.fold(leaves[i], merkle.path(runs, i)) == root
    for gone in lacking:  # every single node is needed
        with pytest.raises(KeyError):
            merkle.derive({i: leaves[i] for i in chosen}, n, {c: d for c, d in fetched.items() if c != gone})
