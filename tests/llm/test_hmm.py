import itertools
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from galleyproof.llm import hmm


def paths(chain, classes):
    out = {}
    for path in itertools.product(range(len(chain.start)), repeat=len(classes)):
        p = chain.start[path[0]]
        for a, b in itertools.pairwise(path):
            p *= chain.move[a, b]
        for s, c in zip(path, classes, strict=True):
            p *= chain.emit[s, c]
        out[path] = p
    return out


def test_recursions_equal_enumeration():
    chain = hmm.Chain.random(5, 3)
    texts = [[0, 4, 2, 1, 3], [2, 2], [1]]
    lengths = np.array([len(t) for t in texts])
    classes = np.array(sum(texts, []))
    found = hmm.likelihood(chain, classes, lengths)
    first, pairs, seen = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    for t, ll in zip(texts, found, strict=True):
        every = paths(chain, t)
        z = sum(every.values())
        assert np.isclose(ll, np.log(z))
        for path, p in every.items():
            first[path[0]] += p / z
            for a, b in itertools.pairwise(path):
                pairs[a, b] += p / z
            for s, c in zip(path, t, strict=True):
                seen[s, c] += p / z
    got = hmm.expected(chain, classes, lengths)
    assert all(np.allclose(a, b) for a, b in zip(got, (first, pairs, seen), strict=True))


def test_windows_hold_every_token():
    first, size = hmm.windows(None, np.array([3, 600, 256]), 256)
    held = sorted(itertools.chain(*(range(a, a + n) for a, n in zip(first, size, strict=True))))
    assert held == list(range(859))


def test_steps_raise_the_likelihood():
    rng = np.random.default_rng(2)
    classes, lengths = rng.integers(0, 20, 4000) // rng.integers(1, 3, 4000), np.full(40, 100)
    chain, last = hmm.Chain.random(20, 3), -np.inf
    for _ in range(5):
        now = hmm.likelihood(chain, classes, lengths).sum()
        assert now > last - 0.1
        last = now
        chain = hmm.Chain.counted(*hmm.expected(chain, classes, lengths))


def test_long_texts_are_counted_whole():
    rng = np.random.default_rng(6)
    chain, lengths = hmm.Chain.random(12, 3), np.array([700, 2, 256, 257, 513, 1])
    classes = rng.integers(0, 12, lengths.sum())
    first, pairs, seen = hmm.expected(chain, classes, lengths)
    assert np.isclose(first.sum(), len(lengths))  # texts, not windows
    assert np.isclose(pairs.sum(), (lengths - 1).sum())  # moves across windows too
    whole_first, whole_pairs, whole_seen = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 12))
    for at, n in zip(np.cumsum(lengths) - lengths, lengths, strict=True):
        c = classes[at:at + n]
        alpha, beta = np.zeros((n, 3)), np.ones((n, 3))
        for t in range(n):
            a = (chain.start if t == 0 else alpha[t - 1] @ chain.move) * chain.emit[:, c[t]]
            alpha[t] = a / a.sum()
        for t in range(n - 2, -1, -1):
            b = chain.move @ (chain.emit[:, c[t + 1]] * beta[t + 1])
            beta[t] = b / b.sum()
        for t in range(n):
            g = alpha[t] * beta[t] / (alpha[t] @ beta[t])
            whole_seen[:, c[t]] += g
            if t == 0:
                whole_first += g
            else:
                m = alpha[t - 1][:, None] * chain.move * (chain.emit[:, c[t]] * beta[t])
                whole_pairs += m / m.sum()
    assert all(np.allclose(a, b) for a, b in zip((first, pairs, seen), (whole_first, whole_pairs, whole_seen), strict=True))


def test_long_texts_take_part_in_the_start(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["one", "two", "three", "four"], 6000)) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = hmm.class_table([b"one", b"two", b"three", b"four"])
    chain = hmm.first_chain(docs, own, 10, 3, 10)
    assert not np.allclose(chain.emit, hmm.Chain.random(len(own) + hmm.ENDINGS, 3).emit)


def test_steps_go_on_until_the_gain_is_small(spark, monkeypatch):
    likelihoods = iter([-1000.0, -900.0, -890.0, -889.9, -1.0])
    monkeypatch.setattr(hmm, "reestimate", lambda blocks, chain, own: (chain + 1, next(likelihoods)))
    assert hmm.trained(None, 0, {}) == 4
    likelihoods = iter([-1000.0, -900.0, -890.0])
    assert hmm.trained(None, 0, {}, passes=2) == 2


def cut(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in
            text.replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w] + [None]


@pytest.mark.parametrize("small_blocks", [False, True])
def test_scores_equal_brute_force_counts(docs, rows, monkeypatch, small_blocks):
    monkeypatch.setattr(hmm, "TOP_WORDS", 50)
    if small_blocks:
        monkeypatch.setattr(hmm, "BLOCK_BYTES", 2000)
        monkeypatch.setattr(hmm, "SLICE_BYTES", 500)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter(w for i, t in rows if not held(i) for w in cut(t))
    n, v = sum(counts.values()), len(counts)
    want = [(i, held(i), len(ws := cut(t)), sum(w in counts for w in ws), n,
             round(sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 4)) for i, t in rows]
    found = hmm.score(docs, states=3, passes=1, start_docs=10).collect()
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(np.isfinite(r.score) and r.score < 0 for r in found)


def test_no_row_of_a_block_is_large(docs, rows, monkeypatch, tmp_path):
    """A block is many rows, each of a slice's texts or of a part of the vocabulary; they hold every token."""
    monkeypatch.setattr(hmm, "SLICE_BYTES", 500)
    monkeypatch.setattr(hmm, "VOCABULARY_ROWS", 20)
    blocks = {}
    for r in hmm.encode(docs, 10, str(tmp_path)).collect():
        blocks.setdefault(r.block, []).append(r)
    texts, counts = [], Counter()
    for found in blocks.values():
        slices, parts = [r for r in found if r.ids is not None], sorted((r for r in found if r.ids is None), key=lambda r: r["first"])
        assert len(slices) > 3 and len(parts) > 3 and all(len(r.words) <= 20 for r in parts)
        words = [bytes(w) for r in parts for w in r.words]
        assert [r["first"] for r in parts] == list(range(0, len(words), 20))
        counts.update(dict.fromkeys(words, 0))
        for w, c in zip(words, (c for r in parts for c in r.counts), strict=True):
            counts[w] += c
        for r in slices:
            assert len(r.doc_ids) == 1 or sum(r.lengths) < 500 + len(r.doc_ids)
            ids = iter(np.frombuffer(r.ids, "<i4"))
            texts += [(i, h, [words[next(ids)] for _ in range(n)]) for i, h, n in zip(r.doc_ids, r.held, r.lengths, strict=True)]
    assert sorted(((i, t) for i, _, t in texts), key=repr) == sorted(((i, hmm.tokens(t)) for i, t in rows), key=repr)
    assert +counts == Counter(w for _, h, t in texts if not h for w in t)


def test_scores_do_not_depend_on_the_rows_of_blocks(docs, monkeypatch):
    def told():
        found = hmm.score(docs, states=2, passes=1, start_docs=10)
        return sorted(map(repr, found.select("doc_id", "n_known", F.round("base_score", 6), F.round("score", 6)).collect()))

    want = told()
    for name, size in (("SLICE_BYTES", 500), ("VOCABULARY_ROWS", 20), ("PACKED_ROWS", 30)):
        monkeypatch.setattr(hmm, name, size)
    monkeypatch.setattr(hmm, "SMALL_GROUPS", {"parquet.block.size": "1000", "parquet.page.size.row.check.min": "1"})
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert told() == want
    finally:
        docs.sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_scores_equal_a_plain_model(docs, rows, monkeypatch):
    """Whole texts in plain loops: forward values over the trained chain, and words within their class."""
    monkeypatch.setattr(hmm, "TOP_WORDS", 50)
    caught, plain = {}, hmm.trained

    def trained(blocks, chain, own, passes=None):
        caught["own"], caught["chain"] = own, plain(blocks, chain, own, passes)
        return caught["chain"]

    monkeypatch.setattr(hmm, "trained", trained)
    found = hmm.score(docs, states=3, passes=2, start_docs=10).collect()
    own, chain = caught["own"], caught["chain"]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter(w for i, t in rows if not held(i) for w in hmm.tokens(t))
    of = lambda w: own.get(w, len(own) + hmm.ending(w))
    total, kinds = Counter(), Counter()
    for w, c in counts.items():
        total[of(w)] += c
        kinds[of(w)] += 1

    def told(text):
        alpha, score = None, 0.0
        for w in hmm.tokens(text):
            k = of(w)
            before = chain.start if alpha is None else [
                sum(alpha[x] * chain.move[x][y] for x in range(3)) for y in range(3)]
            alpha = [b * chain.emit[y][k] for y, b in enumerate(before)]
            score += np.log10(sum(alpha))
            alpha = [a / sum(alpha) for a in alpha]
            if k >= len(own):
                score += np.log10((counts[w] + 0.1) / (total[k] + 0.1 * (kinds[k] + 1)))
        return score

    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(told(t))
    for r in found:
        assert any(r.score == pytest.approx(want, rel=1e-9) for want in texts[r.doc_id])


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r for r in hmm.score(docs).collect() if r.held_out]
    assert len(held) > 50 and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert sum(r.score > r.base_score for r in held) > 0.9 * len(held)


def test_empty(empty):
    assert hmm.score(empty, states=2, passes=1).count() == 0


def test_all_held_out(spark):
    rows = [(i, "a b") for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = hmm.score(df, states=2, passes=1).collect()
    assert all(r.held_out and r.n_known == 0 and r.base_score == 0 for r in found)
