import random

from galleyproof.llm.components import components


def test_chain_star_and_pairs(spark, tmp_path):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)]
    links += [(5000, 5001), (5001, 5000), (6000, 6000), (None, 3), (7000, 7001), (7002, 7003)]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long")
    found = components(df, str(tmp_path)).collect()
    root = {r.node: r.root for r in found}
    assert len(found) == len(root) == 301 + 200 + 2 + 4
    assert len({root[i] for i in range(301)}) == 1 == len({root[1000 + i] for i in range(200)})
    assert len(set(root.values())) == 5


def test_no_links(spark, tmp_path):
    assert components(spark.createDataFrame([], "a long, b long"), str(tmp_path)).count() == 0
