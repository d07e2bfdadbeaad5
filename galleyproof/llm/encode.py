"""Exact token ids and counts from a public tokenizer, each distinct piece of text encoded once."""

from __future__ import annotations

import functools
import itertools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for every core

from tokenizers import Tokenizer, pre_tokenizers  # noqa: E402

#: Pieces of text, and plain words per generation, remembered per Python worker.
REMEMBERED = 500_000
REMEMBERED_WORDS = 400_000
#: Words of these letters have one normal form, one lower case and no inner boundary; of the marks
#: around them none starts a special token or a contraction.
MARKS = r"[!-&(-/:;=-@\[-`{-~]*"
PLAIN = rf"^(?P<lead>{MARKS})(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<trail>{MARKS})$"
#: White space and the text up to the next white space; no token spans such a boundary.
PIECES = re.compile(r"\s*\S+|\s+")


def strings(values: pa.Array) -> list[str]:
    """A list of an Arrow array's strings, faster than ``to_pylist``."""
    return values.to_numpy(zero_copy_only=False).tolist()


@functools.cache
def load(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class PieceLengths:
    """Token counts for tokenizers that attach white space to what follows it (byte-level BPE)."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text, special strings handled as the library does by default."""
        cut = [PIECES.findall(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set(itertools.chain.from_iterable(cut)).difference(self.known))
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.known.update(zip(new, map(len, found), strict=True))
        return [sum(map(self.known.__getitem__, pieces)) for pieces in cut]


class WordIds:
    """Token ids for tokenizers to which white space is only a separator.

    A text is cut at ASCII white space and each distinct piece goes to the library once. Words of
    plain letters, with marks before and after them, go to the same model without its slow
    normalisation, many at a time; that needs the rules that ``_plain_rules`` looks for, and all
    other pieces (or all, if the rules differ) take the library's whole path. What is remembered is
    held in two generations, so that frequent words outlive a full memory. Arrow cuts, numbers and
    lower-cases; Python meets each distinct piece of a batch only.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.known: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.words_before: dict[str, bytes] = {}
        self.bare = None
        if self._plain_rules():
            self.bare = Tokenizer(self.tokenizer.model)
            self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            suffix = self.tokenizer.model.end_of_word_suffix
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
            self.marks = functools.lru_cache(10_000)(self._ids)
            shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
            spare = iter(range(256, 512))  # bytes without a visible form, in order
            self.shown = {b: b if b in shown else next(spare) for b in range(256)} | {32: 32}

    def _plain_rules(self) -> bool:
        rules = json.loads(self.tokenizer.to_str())
        steps = [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])]
        cuts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        return (
            steps == ["NFC", "Replace", "Lowercase"]
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and {r"[\p{L}]+", r"[^\s\p{L}\p{N}]+"} <= set(cuts[0]["pattern"].get("Regex", "").split("|"))
            and cuts[0]["invert"] and cuts[0]["behavior"] == "Removed"
            and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
            and bool(rules["model"].get("end_of_word_suffix"))
        )

    def _ids(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, np.uint32).tobytes()

    def _learn_words(self, words: list[str]) -> None:
        """Ids of lower-case words of plain letters, 64 to a call's string."""
        lines = [" ".join(words[i:i + 64]) for i in range(0, len(words), 64)]
        lines = [t.encode().decode("latin-1").translate(self.shown) for t in lines]
        ids = [e.ids for e in self.bare.encode_batch_fast(lines, add_special_tokens=False)]
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32)
        stops = np.flatnonzero(self.ends[flat]) + 1  # each word's last token carries the suffix
        if len(stops) != len(words):
            raise ValueError("the tokenizer doesn't mark the ends of words")
        raw, at = flat.tobytes(), 0
        for word, stop in zip(words, (stops * 4).tolist(), strict=True):
            self.words[word] = raw[at:stop]
            at = stop

    def _learn(self, pieces: list[str]) -> None:
        rest = pieces
        if self.bare is not None:
            found = pc.extract_regex(pa.array(pieces, pa.string()), PLAIN)
            plain = found.is_valid().to_numpy(zero_copy_only=False)
            rest = list(itertools.compress(pieces, (~plain).tolist()))
            found = found.drop_null()
            words = strings(pc.utf8_lower(found.field("word")))
            if len(self.words) > REMEMBERED_WORDS:
                self.words, self.words_before = {}, self.words
            new = set(words).difference(self.words)
            seen = new.intersection(self.words_before)
            self.words.update((w, self.words_before[w]) for w in seen)
            if new != seen:
                self._learn_words(list(new - seen))
            leads, trails = strings(found.field("lead")), strings(found.field("trail"))
            named = itertools.compress(pieces, plain.tolist())
            for piece, lead, word, trail in zip(named, leads, words, trails, strict=True):
                ids = self.words[word]
                if lead:
                    ids = self.marks(lead) + ids
                self.known[piece] = ids + self.marks(trail) if trail else ids
        for piece, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.known[piece] = np.asarray(e.ids, np.uint32).tobytes()

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all whole texts (strings, none null) one after another, and how many each has."""
        cut = pc.ascii_split_whitespace(texts)
        ends = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        pieces, codes = strings(coded.dictionary), coded.indices.to_numpy()
        if len(self.known) > REMEMBERED:
            self.known, self.known_before = {}, self.known
        new = [p for p in pieces if p not in self.known]
        seen = [p for p in new if p in self.known_before]
        self.known.update((p, self.known_before[p]) for p in seen)
        if len(new) > len(seen):
            self._learn([p for p in new if p not in self.known])
        raw = list(map(self.known.__getitem__, pieces))
        store = np.frombuffer(b"".join(raw), np.uint32)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[codes]
        stops = np.concatenate(([0], np.cumsum(lengths)))
        at = np.repeat(starts[codes] - stops[:-1], lengths)
        at += np.arange(len(at))
        return store[at], np.diff(stops[ends - ends[0]])

    def ids(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Each whole text's ids as little-endian unsigned 32-bit integers."""
        found, counts = self.flat(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
        raw, stops = found.tobytes(), np.cumsum(4 * counts).tolist()
        return [raw[a:b] for a, b in zip([0, *stops], stops)]


@functools.cache
def piece_lengths(path: str) -> PieceLengths:
    return PieceLengths(path)


@functools.cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
