import math

import numpy as np

from galleyproof.llm import near_vectors

ROW = "vec_id long, embedding array<float>, class string, place double"


def brute(rows):
    unit = {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, np.float32).astype(float)
            unit[k] = a / np.linalg.norm(a)
    links = {k: {j for j in unit if j != k and k in unit and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= 0.9}
             for k in range(len(rows))}
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out.append((i, len(links[k]), min(rows[j][0] for j in seen)))
    return out


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(150, 32))
    rows = [(k, base[k].tolist()) for k in range(150)]
    for k in range(60):  # near copies from close to the threshold to equal
        rows.append((200 + k, (base[k] + rng.normal(size=32) * (k % 6) * 0.09).tolist()))
    rows += [(300 + k, base[0].tolist()) for k in range(40)]
    rows += [(400, None), (401, [0.0] * 32), (402, [float("nan")] + [1.0] * 31), (403, [None] + [1.0] * 31),
             (404, [float("inf")] + [1.0] * 31), (405, []), (406, base[1][:8].tolist()), (407, (-base[2]).tolist()),
             (408, (base[3] * 7).tolist()), (409, [-0.0, 1.0]), (410, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, "c", 1.0) for i, v in rows], ROW).repartition(4)
    found = {r.vec_id: r for r in near_vectors.near_duplicates(df).collect()}
    want = {i: (n, c) for i, n, c in brute(rows)}
    assert set(found) == set(want) and len(found) == len(rows)
    total = sum(n for n, _ in want.values())
    assert all(found[i].n_links <= n for i, (n, _) in want.items())
    assert sum(r.n_links for r in found.values()) >= 0.9 * total
    assert all(found[i].kept == (found[i].component_id == i) for i in found)
    for i in (0, 300, 339, 400, 401, 402, 403, 404, 405, 406, 409, 410):
        assert (found[i].n_links, found[i].component_id) == want[i]


def test_empty(spark):
    df = spark.createDataFrame([], ROW)
    assert near_vectors.near_duplicates(df).count() == 0


def test_recall_is_calibrated():
    for n in (12, 1000):
        rounds = near_vectors.rounds_for(0.9, n.bit_length(), 2, 0.96)
        p = near_vectors.chances(0.9, n.bit_length())
        short = (1 - p) ** rounds + rounds * p * (1 - p) ** (rounds - 1)
        assert 1 - short >= 0.96 and near_vectors.chances(0.95, 8) > near_vectors.chances(0.9, 8)
