import random

import pytest
from pyspark.sql import functions as F

from galleyproof.plans import linkage


def dataset(i, name, authors, citation=None):
    return (f"doi:{i}", name, authors, [(citation,)] if citation else [])


D_SCHEMA = "global_id string, name string, authors array<string>, publications array<struct<citation string>>"
A_SCHEMA = "doi string, title string, authors array<string>, article_index long"


def link(spark, datasets, articles, **options):
    rows = linkage.link_articles(spark.createDataFrame(datasets, D_SCHEMA),
                                 spark.createDataFrame(articles, A_SCHEMA), **options).collect()
    assert len(rows) == len(datasets)
    return {r.package_doi: (r.article_doi, r.score) for r in rows}


def test_rules(spark):
    articles = [("10.1/a", "Trade and War in Europe", ["doe", "roe"], 1), ("10.1/b", "War in Europe", ["doe"], 2),
                ("10.1/c", "Trade and War in Europe", ["doe"], 3), ("10.1/d", "", ["doe"], 4)]
    got = link(spark, [
        dataset(1, "Replication Data for: War in Europe", ["Doe, Jane"]),
        dataset(2, "War in Europe", ["Jane Other"]),
        dataset(3, "Anything", ["Doe, Jane"], "see https://doi.org/10.9999/x."),
        dataset(4, "Trade policy of great powers", ["Jane Doe"]),
        dataset(5, "?!", ["Doe, J"]),
        dataset(6, "Replication Code for: Trade, war", ["Doe, J", "Roe, R"]),
    ], articles)
    # of equal scores the first article wins, as a shorter title's words may all be in a longer one
    assert got["doi:1"] == ("10.1/a", 1.0)
    assert got["doi:2"] == (None, None)
    assert got["doi:3"] == ("10.9999/x", None)
    assert got["doi:4"] == (None, None)
    assert got["doi:5"] == (None, None)
    assert got["doi:6"] == ("10.1/a", 1.0)


def brute(datasets, articles, threshold):
    out = {}
    for doi, name, authors, _ in datasets:
        d, names = set(name.split()), {a.split(",")[0].lower() for a in authors}
        best, score = None, 0.0
        for adoi, title, anames, _ in sorted(articles, key=lambda a: a[3]):
            a = set(title.split())
            if d and a and names & set(anames):
                s = len(d & a) / min(len(d), len(a))
                if s > score:
                    best, score = adoi, s
        out[doi] = (best, pytest.approx(score)) if score >= threshold else (None, None)
    return out


@pytest.mark.parametrize("seed, threshold", [(1, 0.6), (2, 0.5), (3, 0.8), (4, 1.0)])
def test_prefix_filter_loses_nothing(spark, seed, threshold):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)]
    title = lambda: " ".join(rng.choice(words[: rng.randint(2, 25)]) for _ in range(rng.randint(1, 9)))
    # one surname holds most of both sides
    names = lambda: rng.sample(["ann", "bob", "hot"], rng.randint(1, 3)) if rng.random() < 0.5 else ["hot"]
    datasets = [dataset(i, title(), [f"{n.title()}, X" for n in names()]) for i in range(120)]
    articles = [(f"10.1/{i}", title(), names(), i) for i in range(120)]
    # copies on both sides
    datasets += [dataset(f"copy{i}", datasets[0][1], datasets[0][2]) for i in range(40)]
    articles += [(f"10.2/{i}", articles[5][1], articles[5][2], 500 + i) for i in range(40)]
    assert link(spark, datasets, articles, threshold=threshold) == brute(datasets, articles, threshold)


def test_verified_pairs_grow_with_the_input_only(spark, monkeypatch):
    """Under one surname most titles meet, but each has an equal one, which no other can beat."""
    counted, plain = [], linkage._verified
    monkeypatch.setattr(linkage, "_verified", lambda pairs, *a: counted.append((pairs.count(), pairs)) or plain(pairs, *a))
    rng = random.Random(5)
    verified, met = [], []
    for n in (60, 240):
        titles = [" ".join([f"own{i}", *rng.sample([f"common{k}" for k in range(12)], 5)]) for i in range(n)]
        datasets = [dataset(i, t, ["Hot, X"]) for i, t in enumerate(titles)]
        articles = [(f"10.1/{i}", t, ["hot"], i) for i, t in enumerate(titles)]
        assert link(spark, datasets, articles) == {f"doi:{i}": (f"10.1/{i}", 1.0) for i in range(n)}
        verified.append(sum(c for c, _ in counted))
        sets, arts = linkage._titles(spark.createDataFrame(datasets, D_SCHEMA), spark.createDataFrame(articles, A_SCHEMA))
        met.append(linkage._met(sets, arts, 0.6).count())
        counted.clear()
    assert verified == [60, 240] and met[1] > 8 * met[0]


def test_pairs_come_once(spark):
    datasets = spark.createDataFrame([dataset(1, "a b c", ["X, A", "Y, B"]), dataset(2, "a b c", ["X, A", "Y, B"])], D_SCHEMA)
    articles = spark.createDataFrame([("10.1/a", "a b c d", ["x", "y"], 1)], A_SCHEMA)
    assert linkage.link_candidates(datasets, articles).count() == 1


def test_metrics_keep_unknown_values(spark):
    links = spark.createDataFrame([("d1", "a1"), ("d2", "a2"), ("d3", None)], "package_doi string, article_doi string")
    downloads = spark.createDataFrame([("d1", 5)], "package_doi string, downloads long")
    citations = spark.createDataFrame([("a2", 7)], "article_doi string, citations long")
    articles = spark.createDataFrame([("a1",)], "doi string").withColumn("pub_date", F.lit("2024-01-01").cast("date"))
    rows = {r.package_doi: (r.downloads, r.citations) for r in linkage.metrics(links, downloads, citations, articles).collect()}
    assert rows == {"d1": (5, None), "d2": (None, 7)}
