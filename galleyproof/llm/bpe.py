"""Byte-pair encoding and decoding with contiguous rank arrays, equal to a public tokenizer's file."""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .shared import bounded_batches, slices, text_of

SLICE_BYTES = 4 << 20
#: Words of more parts are merged by a heap; scanning them again for every merge would be quadratic.
SHORT = 128
#: Pieces of text remembered per generation and Python worker; two generations are held.
REMEMBERED = 300_000
#: No merge.
NONE = 1 << 62
#: Characters with one normal form, one lower-case form and no white space.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: The file's cuts for lower-case text of such characters.
CUTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
# The steps of the tokenizer files that are understood.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
CUT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_characters() -> list[str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))  # bytes without a visible form, in order
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Remembered(dict):
    """A cache that learns what it lacks and keeps two generations, so that frequent keys stay."""

    def __init__(self, learn: Callable, limit: int):
        super().__init__()
        self.learn, self.limit, self.old = learn, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.learn(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class RankArrays:
    """Merges of one vocabulary: ``pairs`` gives rank and result of two adjacent parts."""

    def __init__(self, vocabulary: dict[str, int], merges: list[list[str]], suffix: str):
        self.pairs = {
            vocabulary[a] << 32 | vocabulary[b]: rank << 32 | vocabulary[a + b]
            for rank, (a, b) in reversed(list(enumerate(merges)))}
        inner = [vocabulary.get(c) for c in byte_characters()]
        last = [vocabulary.get(c + suffix) for c in byte_characters()]
        if None in inner or None in last:
            raise ValueError("the vocabulary lacks a byte")
        self.inner, self.last = inner, last

    def ids(self, word: bytes) -> list[int]:
        parts = [self.inner[b] for b in word]
        parts[-1] = self.last[word[-1]]
        return self.scan(parts) if len(parts) <= SHORT else self.sift(parts)

    def scan(self, parts: list[int]) -> list[int]:
        """Merge a short word's ``parts`` in place.

        ``ranks[i]`` is that of the parts i and i + 1. The least, of equal ones the leftmost, is
        merged by deleting the boundary behind part i, and the ranks to both sides are found anew.
        """
        find = self.pairs.get
        ranks = [find(a << 32 | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)
            parts[i] = merged = least & 0xFFFFFFFF
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = find(merged << 32 | parts[i + 1], NONE)
            if i:
                ranks[i - 1] = find(parts[i - 1] << 32 | merged, NONE)
        return parts

    def sift(self, parts: list[int]) -> list[int]:
        """The same merges for a long word: candidates in a heap, parts in a linked list."""
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int, j: int) -> None:
            found = self.pairs.get(parts[i] << 32 | parts[j])
            if found is not None:
                heapq.heappush(heap, (found >> 32, i, j, parts[i], parts[j], found & 0xFFFFFFFF))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, a, b, merged = heapq.heappop(heap)
            if parts[i] != a or parts[j] != b or after[i] != j:
                continue  # one of the two has changed since
            parts[i], parts[j] = merged, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p >= 0]


class Codec:
    """Whole texts to ids and back, as the tokenizer file says."""

    def __init__(self, path: str):
        library = Tokenizer.from_file(path)
        rules = json.loads(library.to_str())
        model, cuts = rules["model"], (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        steps = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
        if (
            model["type"] != "BPE" or model["dropout"] or model["continuing_subword_prefix"]
            or model["ignore_merges"] or not model["end_of_word_suffix"] or steps != NORMALIZERS
            or [c["type"] for c in cuts] != ["Split", "ByteLevel"]
            or cuts[0]["pattern"].get("Regex") != CUT_PATTERN or cuts[1]["add_prefix_space"] or cuts[1]["use_regex"]
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in rules["added_tokens"])
            or rules["post_processor"] or rules["decoder"]
        ):
            raise ValueError(f"{path} has rules that aren't known here")
        self.normal, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.merges = RankArrays(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.bytes = {c: b for b, c in enumerate(byte_characters())}
        self.special = {t["content"]: np.uint32(t["id"]).tobytes() for t in rules["added_tokens"]}
        longest = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.tokens = dict.fromkeys(range(max(model["vocab"].values()) + 1), "")
        self.tokens |= {i: t for t, i in model["vocab"].items()}
        self.tokens |= {t["id"]: t["content"] for t in rules["added_tokens"]}
        self.words = Remembered(self._word, REMEMBERED)
        self.pieces = Remembered(self._piece, REMEMBERED)

    def _word(self, word: bytes) -> bytes:
        return np.array(self.merges.ids(word), np.uint32).tobytes()

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode()
        if self.specials is None or not self.specials.search(text):
            return self._run(text)
        return b"".join(self.special.get(t) or self._run(t) for t in self.specials.split(text) if t)

    def _run(self, text: str) -> bytes:
        """Ids of a text without special tokens: lower case, cut into words, each word merged."""
        if PLAIN.fullmatch(text):
            words = [w.encode() for w in CUTS.findall(text.lower())]
        else:
            words = [bytes(map(self.bytes.__getitem__, w)) for w, _ in self.cut(self.normal(text))]
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, text: bytes) -> bytes:
        """Ids of a whole UTF-8 text as little-endian unsigned 32-bit integers.

        ASCII white space ends words and isn't encoded, so what lies between is encoded by itself
        and remembered.
        """
        return b"".join(map(self.pieces.__getitem__, text.split()))

    def decode(self, ids: bytes) -> str:
        """The tokens of ids, joined by spaces; special tokens stay, unknown ids give nothing."""
        found = np.frombuffer(ids, "<u4").tolist()
        try:
            return " ".join(map(self.tokens.__getitem__, found))
        except KeyError:
            return " ".join(self.tokens[i] for i in found if i in self.tokens)


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def _mapped(rows: DataFrame, column: str, fields: str, row: Callable[[bytes], tuple]) -> DataFrame:
    """``doc_id`` and what ``row`` makes of each value of ``column``, in slices of bounded bytes."""
    bounded_batches(rows.sparkSession)
    kind = rows.schema["doc_id"].dataType.simpleString()
    types = [pa.binary() if f.endswith("binary") else pa.int64() if f.endswith("long") else pa.string()
             for f in fields.split(", ")]
    names = ["doc_id", *[f.split()[0] for f in fields.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, SLICE_BYTES):
                out = [row(v) for v in part.column(column).cast(pa.binary()).to_pylist()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)]
                yield pa.record_batch([part.column("doc_id"), *columns], names=names)

    return rows.mapInArrow(run, f"doc_id {kind}, {fields}")


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row of ``docs(doc_id, text, ...)``.

    ``ids`` holds the whole text's ids as little-endian unsigned 32-bit integers, equal to the
    library's without added special tokens; strings of special tokens inside a text give their id.
    A null text counts as empty and has no ids, a null doc_id stays null, repeated rows each give
    a row, an empty table none; further columns are ignored.
    """
    rows = docs.select("doc_id", text_of(docs).alias("text"))

    def row(text: bytes) -> tuple:
        ids = codec(tokenizer).encode(text)
        return len(ids) // 4, ids

    return _mapped(rows, "text", "n_tokens long, ids binary", row)


def decode(coded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, text`` of every row of ``coded(doc_id, ids, ...)``, as the library's decode gives
    it with special tokens kept. Null ids give the empty text."""
    rows = coded.selectExpr("doc_id", "coalesce(ids, X'') AS ids")
    return _mapped(rows, "ids", "text string", lambda ids: (codec(tokenizer).decode(ids),))


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Tokens, digest of the ids and digest of the text decoded from them, for every row.

    Rows and odd values as in ``encode``; ids don't leave the task.
    """
    rows = docs.select("doc_id", text_of(docs).alias("text"))

    def row(text: bytes) -> tuple:
        own = codec(tokenizer)
        ids = own.encode(text)
        back = own.decode(ids).encode()
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()

    return _mapped(rows, "text", "n_tokens long, ids_sha256 string, decoded_sha256 string", row)
