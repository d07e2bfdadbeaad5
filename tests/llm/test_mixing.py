import numpy as np
import pytest

from galleyproof.llm import mixing
from galleyproof.llm.mixing import Domain

DOMAINS = (Domain("a", "quality = 1", 0.5), Domain("b", "quality = 0", 0.5))
LABELS = "doc_id long, quality int, toxic int, p0 double, rate string"


@pytest.fixture(scope="module")
def marked(spark, tmp_path_factory):
    rng = np.random.default_rng(1)
    own = (["alpha", "arrow", "amber"], ["beta", "brook", "basil"])
    rows, labels = [], []
    for i in range(400):
        kind = int(i % 5 == 0)
        words = [*rng.choice(["the", "of", "and"], 5), *rng.choice(own[kind], 4)]
        rows.append((i, " ".join(words), "x", 0.5, 7))
        if i % 2:
            labels.append((i, 1 - kind, 0, 0.0, "z"))
    rows += [(None, "alpha the", "x", 0.5, 7), (400, None, "x", 0.5, 7), (401, "", "x", 0.5, 7), (3, rows[3][1], "x", 0.5, 7)]
    labels += [(2, None, None, None, None), (None, 1, 0, None, None), (3, 0, 0, None, None)]
    path = str(tmp_path_factory.mktemp("mix") / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, word string, p0 double, copies int").write.parquet(path)
    return spark.read.parquet(path), spark.createDataFrame(labels, LABELS)


def brute_rates(n, p, weights, total):
    """Of the rates that meet the targets those closest to 1: a number per domain, found by halving
    intervals for one domain after the other until none moves."""
    mass = n @ p
    share = np.array(weights) / sum(weights)
    lead = share.argmax()
    target = share * total if total else np.minimum(share * mass[lead] / share[lead], mass)
    y = np.zeros(len(weights))
    for _ in range(200):
        for k in range(len(y)):
            low, high = -50.0, 50.0
            for _ in range(60):
                y[k] = (low + high) / 2
                have = (np.maximum(0, 1 - p @ y) * n) @ p[:, k]
                low, high = (y[k], high) if have > target[k] else (low, y[k])
    return np.maximum(0, 1 - p @ y)


@pytest.mark.parametrize("total", [None, 9000.0])
def test_rates_equal_brute_force_and_meet_targets(marked, total):
    docs, labels = marked
    half = (DOMAINS[0], Domain("b", "quality = 0", 0.05)) if total is None else DOMAINS
    found = mixing.mix(docs, labels, half, total).toPandas()
    assert len(found) == docs.count()
    p, n = found[["p_a", "p_b"]].to_numpy(), found["n_tokens"].to_numpy()
    assert np.allclose(p.sum(axis=1), 1)
    want = brute_rates(n, p, [d.weight for d in half], total)
    assert np.allclose(found["rate"], want, atol=1e-3) and (found["rate"] >= 0).all()
    have = (found["rate"].to_numpy() * n) @ p
    assert abs(have[0] * half[1].weight - have[1] * half[0].weight) < 0.01 * have.sum()
    assert (abs(found["copies"] - found["rate"]) < 1).all()
    known = found[found["doc_id"].between(0, 399)]
    assert ((known["p_b"] > 0.5) == (known["doc_id"] % 5 == 0)).mean() > 0.98


def test_targets_that_no_rates_meet_end_at_the_best(spark):
    """Documents that are as likely of either domain: the fit ends, with both misses as small as can be."""
    rows = [(i, "same words only") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0, 0.0, "") for i, _ in rows], LABELS)
    weights = (Domain("a", "quality = 1", 0.9), Domain("b", "quality = 0", 0.1))
    found = mixing.mix(docs, labels, weights, most=8.0)
    told = {r.domain: r for r in mixing.reached(found, weights).collect()}
    # 75 tokens of a and 75 of b: targets 75 and 8.3, halfway between these is best
    assert abs(told["a"].expected_tokens - (75 + 75 / 9) / 2) < 0.1 and abs(told["a"].reached - 0.5) < 1e-6


def test_the_fit_ends_soon_where_targets_cannot_be_met(spark, monkeypatch):
    """Chances that leave no way to some targets: as good as plain projected gradient, in few passes."""
    kinds = [(0.90, 0.02, 0.08), (0.86, 0.00001, 0.13999), (0.0, 1.0, 0.0), (0.85, 0.04, 0.11), (0.9, 1e-30, 0.1)]
    rows = [(10 + 7 * i % 40, *kinds[0 if i % 9 else i % 5]) for i in range(200)]
    chances = spark.createDataFrame(rows, "n_tokens long, p0 double, p1 double, p2 double").coalesce(1).cache()
    passes, weights, cut = [], [0.96, 0.02, 0.02], mixing._cut
    monkeypatch.setattr(mixing, "_cut", lambda *a: passes.append(1) or cut(*a))
    rated = chances.withColumn("rate", mixing.fit_rates(chances, weights, None, most=8.0)).toPandas()
    assert len(passes) <= 60
    n, p, r = rated["n_tokens"].to_numpy(), rated[["p0", "p1", "p2"]].to_numpy(), rated["rate"].to_numpy()
    mass, ridge = n @ p, mixing.RIDGES[-1]
    target = np.array(weights) * mass[0] / 0.96

    def cost(r):
        return (((r * n) @ p - target) ** 2 / mass).sum() / 2 + ridge * (n * (r - 1) ** 2).sum() / 2

    best, size = np.ones(len(r)), 1 / np.linalg.norm((p * n[:, None]).T @ p / mass[:, None], 2)
    for _ in range(20000):
        best = np.clip(best - size * (p @ (((best * n) @ p - target) / mass) + ridge * (best - 1)), 0, 8)
    assert cost(r) <= cost(best) * (1 + 1e-6) + 1e-9


def test_sf_targets_are_reached_and_clean_documents_stay(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rated = mixing.mix(docs, labels, most=mixing.MOST_COPIES)
    for r in mixing.reached(rated).collect():
        assert abs(r.reached - r.requested) < 1e-3
    clean = rated.join(labels.filter("quality = 1 AND toxic = 0").select("doc_id").distinct(), "doc_id")
    assert clean.filter("copies > 0").count() >= 0.95 * clean.count()


def test_words_are_counted_whole(spark):
    df = spark.createDataFrame([(1, " a  b\n"), (2, None), (3, "x"), (4, "  ")], "doc_id long, text string")
    labels = spark.createDataFrame([], LABELS)
    found = {r.doc_id: r for r in mixing.mix(df, labels, DOMAINS).collect()}
    assert {i: r.n_tokens for i, r in found.items()} == {1: 2, 2: 0, 3: 1, 4: 0}
    assert all(r.p_a == r.p_b == 0.5 for r in found.values())


def test_stage_is_native_and_keeps_columns(marked):
    docs, labels = marked
    rows = mixing.resample(docs, labels, DOMAINS)
    assert rows.columns == docs.columns
    copies = mixing.mix(docs, labels, DOMAINS).toPandas()["copies"].sum()
    assert abs(rows.count() - copies) <= 0
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_empty(empty, marked):
    assert mixing.mix(empty, marked[1], DOMAINS).count() == 0
    assert mixing.resample(empty, marked[1]).count() == 0


def test_a_scarce_domain_takes_nothing_from_the_others(spark):
    rows = [(i, "alpha arrow amber the of") for i in range(300)] + [(300 + i, "beta brook basil the of") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 300), 0, 0.0, "") for i, _ in rows], LABELS)
    weights = (Domain("a", "quality = 1", 0.6), Domain("b", "quality = 0", 0.4))
    found = mixing.mix(docs, labels, weights).toPandas()
    assert found["rate"].between(0.98, 1.02).all() and len(found) == 303


def test_scarce_domain_is_repeated_up_to_the_bound(spark):
    rows = [(i, "alpha arrow amber the of") for i in range(300)] + [(300 + i, "beta brook basil the of") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 300), 0, 0.0, "") for i, _ in rows], LABELS)
    weights = (Domain("a", "quality = 1", 0.6), Domain("b", "quality = 0", 0.4))
    for most, share in ((8.0, 0.4), (2.0, 120 / 420)):
        found = mixing.mix(docs, labels, weights, most=most)
        told = {r.domain: r for r in mixing.reached(found, weights).collect()}
        assert abs(told["b"].reached - share) < 0.01 and told["b"].requested == 0.4
        assert found.filter(f"rate > {most}").count() == 0
    many = mixing.resample(docs, labels, weights, most=8.0).filter("doc_id >= 300").count()
    assert 180 <= many <= 220


def test_registered_query_repeats_a_scarce_domain(spark, tmp_path):
    from galleyproof.llm import queries

    rows = [(i, "alpha arrow amber the of" if i < 990 else "beta brook basil the of") for i in range(1000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, int(i >= 990), 0.0, "") for i, _ in rows], LABELS)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rated = queries.QUERIES["op1_mixing"](spark, str(tmp_path))
    told = {r.domain: r for r in mixing.reached(rated).collect()}
    assert abs(told["toxic"].expected_tokens / told["clean"].expected_tokens - 2 / 96) < 1e-3
