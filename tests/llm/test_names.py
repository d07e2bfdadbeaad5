"""Tables whose columns are called what the operators use inside."""

import pytest

from galleyproof.llm import bpe, dialogues, exact, hmm, merkle, mixing, simhash

NAMES = ["__file", "__row", "__all", "__copies", "__copy", "copies", "_metadata", "fp", "root", "digest", "first", "place",
         "tree", "level", "position", "block", "tie", "part", "piece", "n", "kept", "group", "w0", "p0", "dotted.name"]
LABELS = "doc_id long, quality int, toxic int, copies int, __file string"


@pytest.fixture(scope="module", params=["files", "plan"])
def clashing(request, spark, tmp_path_factory):
    rows = [(i, f"alpha beta gamma delta {i // 2} omega", "en", "web", 3, *[f"{c}{i}" for c in NAMES]) for i in range(12)]
    schema = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in NAMES)
    docs = spark.createDataFrame(rows, schema)
    if request.param == "plan":
        return docs
    path = str(tmp_path_factory.mktemp("names") / "docs")
    docs.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0, 1, "x") for i in range(12)], LABELS)


def whole(rows):
    return {r.doc_id: tuple(r) for r in rows.collect()}


def test_stages_keep_all_columns(clashing, labels):
    before = whole(clashing)
    for rows in (exact.keep_first(clashing), simhash.keep_one(clashing), mixing.resample(clashing, labels, most=8.0)):
        assert rows.columns == clashing.columns
        after = whole(rows)
        assert after and all(before[i] == r for i, r in after.items())
    assert sorted(whole(exact.keep_first(clashing))) == [0, 2, 4, 6, 8, 10]


def test_queries_take_clashing_names(clashing, labels):
    import public_tokenizers

    n = clashing.count()
    words = public_tokenizers.path("word_bpe_49k.json")
    for rows in (exact.decide(clashing), simhash.near_duplicates(clashing), mixing.mix(clashing, labels),
                 bpe.digests(clashing, words), merkle.prove_tampered(clashing), hmm.score(clashing)):
        assert rows.count() == n


def test_conversations_with_clashing_names(spark):
    names = ["n", "blank", "fault", "part", "piece", "seq", "prefix", "tie", "_metadata", "audit"]
    rows = spark.createDataFrame(
        [(1, i, "user", f"Text {i}.", *["x"] * len(names)) for i in range(5)],
        "conv_id long, turn int, role string, text string, " + ", ".join(f"{c} string" for c in names))
    assert dialogues.repair_damaged(rows).count() == 1
