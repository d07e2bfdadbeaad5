import itertools
import random

import numpy as np
import pytest
import xxhash

from galleyproof.llm import simhash


def brute_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(values, distance):
    name = {v: v for v in values}

    def find(v):
        while name[v] != v:
            v = name[v]
        return v

    for a, b in itertools.combinations(name, 2):
        if (a ^ b).bit_count() <= distance:
            name[find(b)] = find(a)
    return {v: find(v) for v in name}


def test_components_equal_brute_force(docs, rows):
    prints = [brute_print(t) for _, t in rows]
    root = roots(prints, 4)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    want = [(i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(rows, prints, strict=True)]
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr) == sorted(want, key=repr)


def test_pairs_equal_brute_force(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = set(base)
    for v in base:
        for flips in range(1, 7):
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), flips)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = {tuple(sorted(p)) for p in itertools.combinations(signed, 2) if ((p[0] ^ p[1]) & (1 << 64) - 1).bit_count() <= 4}
    assert {(r.a, r.b) for r in simhash.near_pairs(df).collect()} == want


@pytest.mark.parametrize("n", [10, 10**5, 10**8, 10**11])
def test_plan_is_complete_at_every_size(n):
    both = np.full((64, 64), n / 4)
    np.fill_diagonal(both, n / 2)
    chosen = simhash.plan(n, both)
    # left-out groups count as -1; sum of thresholds is distance - groups + 1
    options = {parts: 4 - parts + 1 for parts in range(2, 6)}
    assert any(sum(t for _, t in chosen) - (parts - len(chosen)) == total for parts, total in options.items())


def test_thresholds_avoid_the_costly_group():
    assert simhash.thresholds([[0, 100, 200], [0, 1, 2]], 0) == (2.0, [-1, 1])


def test_correlated_bits_share_a_group():
    both = np.full((64, 64), 25.0)
    np.fill_diagonal(both, 50)
    both[3, 60] = both[60, 3] = both[3, 31] = both[31, 3] = both[31, 60] = both[60, 31] = 50
    group = next(g for g in simhash.group_bits(100, both, 4) if 3 in g)
    assert {3, 31, 60} <= set(group)


def test_stage_keeps_one_of_each(docs, rows, empty):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    root = roots([brute_print(t) for _, t in rows], 4)
    assert kept.count() == len(set(root.values()))
    assert simhash.keep_one(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0
