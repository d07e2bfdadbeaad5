import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from galleyproof.llm import bpe, encode

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [*"abcABC'srtldvem .,!?<|>\n\t\x1c\x85\xa0éÉßſKΣσςİıàÀ́̈̈日本0123456789²½➀_-—“”$%ǅ한국어🙂​­",
            *"`~^[]{}\\/@#&*()+=:;\"", "<|endoftext|>", "<|startoftext|>", " the ", " word"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def test_encoding_and_decoding_equal_the_library(library, texts):
    own = bpe.codec(PATH)
    for t in texts + odd_texts(3000, 1):
        want = library.encode(t, add_special_tokens=False).ids
        ids = own.encode(t.encode())
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_the_library_path_equals_the_library(library):
    texts = odd_texts(3000, 2)
    for t, raw in zip(texts, encode.WordIds(PATH).ids(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def brute_merge(parts, pairs):
    while True:
        found = [(pairs[a << 32 | b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a << 32 | b in pairs]
        if not found:
            return parts
        (merged, i) = min(found)
        parts = [*parts[:i], merged & 0xFFFFFFFF, *parts[i + 2:]]


@pytest.mark.parametrize("length", [1, 2, 3, 40, bpe.SHORT, bpe.SHORT + 1, 600])
def test_scanning_and_sifting_equal_plain_merging(length):
    merges, rng = bpe.codec(PATH).merges, random.Random(length)
    for letters in ("a", "ab", "thein", "abcdefghijklmnop"):
        parts = [merges.inner[ord(rng.choice(letters))] for _ in range(length)]
        want = brute_merge(parts, merges.pairs)
        assert merges.scan(list(parts)) == want and merges.sift(list(parts)) == want


@pytest.mark.parametrize("word", ["x" * 5000, "ab" * 3000, "the" * 2000])
def test_very_long_words(library, word):
    assert np.frombuffer(bpe.codec(PATH).encode(word.encode()), "<u4").tolist() == library.encode(word).ids


def test_a_full_memory_keeps_frequent_keys():
    asked = []
    cache = bpe.Remembered(lambda k: asked.append(k) or -k, 3)
    for k in [1, 2, 1, 3, 1, 4, 1, 5, 1]:
        assert cache[k] == -k
    assert asked == [1, 2, 3, 4, 5] and len(cache) <= 3


def test_unknown_rules_are_refused():
    with pytest.raises(ValueError):
        bpe.Codec(public_tokenizers.path("byte_bpe_50k.json"))


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_digests_of_all_rows(docs, rows, empty, library):
    want = []
    for i, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), sha(np.asarray(ids, "<u4").tobytes()), sha(back.encode())))
    assert sorted(map(tuple, bpe.digests(docs, PATH).collect()), key=repr) == sorted(want, key=repr)
    assert bpe.digests(empty, PATH).count() == 0


def test_frames_of_ids_and_back(docs, rows, empty, library):
    coded = bpe.encode(docs, PATH)
    assert coded.columns == ["doc_id", "n_tokens", "ids"]
    back = bpe.decode(coded, PATH).collect()
    want = [(i, library.decode(library.encode(t).ids, skip_special_tokens=False)) for i, t in rows]
    assert sorted(map(tuple, back), key=repr) == sorted(want, key=repr)
    nothing = bpe.decode(coded.selectExpr("doc_id", "cast(NULL AS binary) AS ids", "'x' AS text"), PATH)
    assert {r.text for r in nothing.collect()} == {""} and bpe.decode(bpe.encode(empty, PATH), PATH).count() == 0
