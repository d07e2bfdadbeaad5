import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from galleyproof.llm import encode, packing, simple8b, token_counts, token_files

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a  b", "don't IT'S", "Straße ÉTÉ. été, İx ΑΣ", "\x1c a\x1cb", "日本 語", "éa", " lead\n\ntrail \t",
       "<|endoftext|>x<|startoftext|>", "x" * 5000, "   a\u0085b"]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_ids_equal_the_library(texts):
    library = Tokenizer.from_file(WORDS)
    for t, raw in zip(texts + ODD, encode.WordIds(WORDS).ids(texts + ODD), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_counts_equal_the_library(docs, rows, empty):
    library = Tokenizer.from_file(BYTES)
    assert encode.PieceLengths(BYTES).counts(ODD) == [len(library.encode(t, add_special_tokens=False)) for t in ODD]
    want = [(i, len(t.encode()), n := len(library.encode(t, add_special_tokens=False)), n > 512) for i, t in rows]
    got = token_counts.token_counts(docs, BYTES)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(empty, BYTES).count() == 0


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
@pytest.mark.parametrize("high", [2, 300, 49408, 1 << 40, (1 << 64) - 1])
def test_simple8b_round_trip(n, high):
    rng = np.random.default_rng(n + 1)
    ids = rng.integers(0, high, n, dtype=np.uint64)
    ids[::7] = rng.integers(0, 2, len(ids[::7]))
    words, blocks = simple8b.encode(ids)
    assert (simple8b.decode(words, blocks, n) == ids).all() and len(blocks) == -(-n // simple8b.BLOCK)


def test_shards_round_trip(spark, docs, rows, empty, tmp_path):
    library = Tokenizer.from_file(WORDS)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    want, at = [], 0
    for i, t in order:
        ids = [*library.encode(t, add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    folder = f"{tmp_path}/shards"
    report = token_files.write(docs, folder, WORDS, 1)
    got = sorted(map(tuple, token_files.read(spark, folder, report).collect()), key=lambda r: r[1])
    # rows of one identifier may stand in either order
    assert [r[:3] for r in got] == [r[:3] for r in want] and sorted(r[3] for r in got) == sorted(r[3] for r in want)
    assert report.agg(F.sum("n_docs")).first()[0] == len(rows)
    first = report.orderBy("start").first()
    shard = token_files.ShardReader(f"{folder}/{first.file}")
    at = int(shard.lengths[0])
    assert crc(shard.ids(at, int(shard.lengths[1]))) == shard.checksums()[1]
    assert token_files.round_trip(empty, WORDS).count() == 0


def test_best_fit_takes_the_tightest_window():
    windows, offsets = packing.best_fit([7, 6, 4, 3, 2, 1], 10)
    assert windows == [0, 1, 1, 0, 2, 2] and offsets == [0, 0, 6, 7, 0, 2]


def test_best_fit_equals_plain_search():
    rng = np.random.default_rng(0)
    sizes = sorted(rng.integers(1, 101, 500).tolist(), reverse=True)
    windows, _ = packing.best_fit(sizes, 100)
    left = []
    for size, w in zip(sizes, windows, strict=True):
        fits = [c for c in left if c >= size]
        if fits:
            assert left[w] == min(fits)
            left[w] -= size
        else:
            assert w == len(left)
            left.append(100 - size)


def test_packing_covers_every_id_once(docs, rows, empty):
    library = Tokenizer.from_file(WORDS)
    found = packing.pack(docs, WORDS, capacity=256, end_id=2, with_ids=True, group_pieces=40).toPandas()
    want = {}
    for i, t in rows:
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        want.setdefault(-1 if i is None else i, []).append(ids)
    for i, part in found.groupby(found["doc_id"].fillna(-1)):
        assert part["length"].sum() == sum(map(len, want[int(i)]))
        for r in part.itertuples():
            assert r.ids_crc32 == zlib.crc32(r.ids) and r.length * 4 == len(r.ids)
            assert any(crc(ids[r.start:r.start + r.length]) == r.ids_crc32 and len(ids) == r.doc_tokens for ids in want[int(i)])
    for _, part in found.sort_values("offset").groupby("sequence_id"):
        ends = (part["offset"] + part["length"]).tolist()
        assert [0, *ends[:-1]] == part["offset"].tolist() and ends[-1] <= 256
    assert found["length"].sum() / 256 / found["sequence_id"].nunique() > 0.9
    assert packing.pack(empty, WORDS).count() == 0
