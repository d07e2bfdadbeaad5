import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from galleyproof.llm import line_crf, samples, subwords

LABELS = "doc_id long, quality int, toxic int, text string"


@pytest.fixture(scope="module")
def marked(spark):
    """Good prose, junk, and prose with an insult; labels with nulls, repeats and a clashing column."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(["ta", "re", "no", "li", "mu", "sa"], rng.integers(1, 4))) for _ in range(400)]
    docs, labels = [], []
    for i in range(240):
        lines = [" ".join(rng.choice(words, 12)) + "." for _ in range(rng.integers(1, 8))]
        bad, toxic = i % 4 == 0, i % 3 == 0
        if bad:
            lines = [line.upper().replace(" ", "!! ") + " | |" for line in lines]
        if toxic:
            lines[0] += " " + rng.choice(["grumbok", "grumbakk", "krumbok", "grumbokk"]) + " ta"
        docs.append((i, "\n".join(lines)))
        labels.append((i, int(not bad), int(toxic), "label"))
    docs += [(None, "ta re"), (1000, None), (1001, ""), (5, docs[5][1]), (1002, "ta " * 40000)]
    labels += [(6, None, None, None), (None, 1, 0, None), (7, 1, 0, None)]
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS))


def auc(rows, want):
    good = [r.score for r in rows if want(r.doc_id)]
    bad = [r.score for r in rows if not want(r.doc_id)]
    return np.mean([(g > b) + (g == b) / 2 for g, b in itertools.product(good, bad)])


def test_quality_holds_out(marked):
    docs, labels = marked
    rows = line_crf.judge(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 240]
    assert len(held) > 20 and auc(held, lambda i: i % 4 != 0) > 0.98


def test_quality_stage(marked, empty):
    docs, labels = marked
    kept = line_crf.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert sum(i % 4 != 0 for i in ids if i is not None and i < 240) >= 178
    assert sum(i % 4 == 0 for i in ids if i is not None and i < 240) <= 3
    assert line_crf.keep_good(empty, labels).count() == 0


def test_toxicity_holds_out(marked, empty):
    docs, labels = marked
    rows = subwords.judge(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 240]
    assert len(held) > 30 and auc(held, lambda i: i % 3 == 0) > 0.95
    assert subwords.judge(empty, labels).count() == 0


def test_no_labels_and_one_label(marked):
    docs, labels = marked
    for judge in (line_crf.judge, subwords.judge):
        assert {r.score for r in judge(docs, labels.limit(0)).collect()} == {0.5}
        one = labels.filter("quality = 1 AND toxic = 0")
        share = {round(r.score, 6) for r in judge(docs, one).collect()}
        assert len(share) == 1


def test_sample_is_bounded(marked):
    docs, labels = marked
    use = samples.remainder(5) != 0
    assert len(samples.labelled(docs, labels, "quality", use, 10, 1 << 20)) == 10
    few = samples.labelled(docs, labels, "quality", use, 100, 2000)
    assert few and sum(len(t.encode()) for t, _ in few) <= 2000


def test_a_long_text_is_passed_over(spark):
    order = [r.doc_id for r in spark.range(40).toDF("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    for place in (0, 5):
        docs = [(i, "ta " * 5000 if i == order[place] else f"re {i}") for i in range(40)]
        labels = spark.createDataFrame([(i, int(i == order[30]), 0, "") for i in range(40)], LABELS)
        found = samples.labelled(
            spark.createDataFrame(docs, "doc_id long, text string"), labels, "quality", samples.remainder(5) >= 0, 40, 1000)
        assert len(found) == 39 and {y for _, y in found} == {0, 1}


def test_chain_equals_enumeration():
    rng = np.random.default_rng(1)
    scores, moves, lines_of = rng.normal(size=(6, 2)), rng.normal(size=(2, 2)), np.array([4, 1, 1])
    marginal, pairs, total = line_crf.chain(scores, moves, lines_of)
    want, z = np.zeros((4, 2)), 0.0
    seen = np.zeros((2, 2))
    for path in itertools.product((0, 1), repeat=4):
        w = np.exp(sum(scores[t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
        z += w
        for t, y in enumerate(path):
            want[t, y] += w
        for a, b in itertools.pairwise(path):
            seen[a, b] += w
    assert np.allclose(marginal[:4], want / z) and np.allclose(pairs, seen / z)
    assert np.isclose(total, np.log(z) + sum(np.log(np.exp(s).sum()) for s in scores[4:]))


def test_misspellings_share_subwords():
    a, _ = subwords.subwords(["grumbok"])
    b, _ = subwords.subwords(["grumbokk"])
    assert len(set(a) & set(b)) >= 8


def test_windows():
    best, first, stop = subwords.best_windows(np.array([1.0, 5, 3, 0, 9, 2]), np.array([4, 0, 1, 1]))
    assert best.tolist() == [3, 0, 9, 2] and (stop - first).tolist() == [3, 0, 1, 1]


def plain_line_score(field, text):
    """One text: every line's potentials, sums over all labels before and after it, no shared arrays."""
    features, sizes, lines_of = line_crf.line_features([text.encode()])
    good = [sum(w * (f - m) / s for w, f, m, s in zip(field.weights, line, field.mean, field.spread, strict=True))
            for line in features]
    n = int(lines_of[0])
    emit = [(1.0, np.exp(g)) for g in good]
    move = np.exp(field.moves)
    ahead, back = [emit[0]], [(1.0, 1.0)]
    for t in range(1, n):
        a = [sum(ahead[-1][x] * move[x][y] for x in (0, 1)) * emit[t][y] for y in (0, 1)]
        ahead.append([v / sum(a) for v in a])
    for t in range(n - 1, 0, -1):
        b = [sum(move[x][y] * emit[t][y] * back[0][y] for y in (0, 1)) for x in (0, 1)]
        back.insert(0, [v / sum(b) for v in b])
    marginal = [a[1] * b[1] / (a[0] * b[0] + a[1] * b[1]) for a, b in zip(ahead, back, strict=True)]
    weight = [size + 1.0 for size in sizes]
    quality = sum(m * w for m, w in zip(marginal, weight, strict=True)) / sum(weight)
    return 1 / (1 + np.exp(-field.slope * (quality - field.level)))


def test_quality_scores_equal_a_plain_field(spark, marked):
    """Scores of whole texts, odd and long ones too, against one text at a time in plain loops."""
    docs, labels = marked
    field = line_crf.train(docs, labels, samples.remainder(5) != 0)
    texts = {r.doc_id: r.text or "" for r in docs.filter("doc_id IS NOT NULL").collect()}
    texts |= {2000: "\n\n\n", 2001: "a\r\nb\n", 2002: "\n".join(["ta re no."] * 500), 2003: "é\x1c ß"}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in line_crf.score(rows, field).collect():
        assert r.score == pytest.approx(plain_line_score(field, texts[r.doc_id]), abs=1e-9)


def plain_toxic_score(model, text):
    """One text: each word's vectors averaged, windows of three words one after the other."""
    def word(w):
        grams, _ = subwords.subwords([w])
        vector = sum(model.embeddings[g] for g in grams) / len(grams)
        return float(vector @ model.softmax[:, 1] - vector @ model.softmax[:, 0])

    own = [word(w) for w in text.lower().split()]
    size = min(len(own), subwords.WINDOW)
    means = [sum(own[i:i + size]) / size for i in range(len(own) - size + 1)] if own else [0.0]
    toxic, clean = np.exp(max(means) + model.bias[1]), np.exp(model.bias[0])
    return toxic / (toxic + clean)


def test_toxicity_scores_equal_a_plain_model(spark, marked):
    docs, labels = marked
    model = subwords.train(docs, labels, samples.remainder(4) != 2)
    texts = {r.doc_id: r.text or "" for r in docs.filter("doc_id < 120 OR doc_id IN (1000, 1001)").collect()}
    texts |= {2000: "grumbok", 2001: "a grumbok", 2002: "É \x1c ß GRUMBOK ta", 2003: "ta re no " * 800}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in subwords.score(rows, model).collect():
        assert r.score == pytest.approx(plain_toxic_score(model, texts[r.doc_id]), abs=1e-9)


@pytest.mark.parametrize("judge, label, folds, held, least", [
    (line_crf.judge, "quality", 5, 0, 0.95), (subwords.judge, "toxic", 4, 2, 0.8)])
def test_held_out_labels_of_the_given_tables(spark, judge, label, folds, held, least):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    want = {r.doc_id: r[label] for r in labels.collect()}
    rows = [r for r in judge(docs, labels).collect() if r.held_out and r.doc_id in want]
    assert len(rows) > 50 and auc(rows, lambda i: want[i] == 1) > least
