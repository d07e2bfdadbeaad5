"""Simple-8b: ids packed into 64-bit words whose top four bits select how many and how wide."""

from __future__ import annotations

import numpy as np

# Ids per word and bits per id, by selector from 1 on. Selector 0 is the escape: the
# next word is one id of up to 64 bits.
PER_WORD = [60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
WIDTH = [1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]
#: Ids per block; each block starts a word, and the decoder takes its first word from an offset.
BLOCK = 1024


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and each block's first word; every word holds as many ids as fit, from the left."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.arange(n)
    stop = np.minimum((at // BLOCK + 1) * BLOCK, n)  # a word doesn't reach into the next block
    selector = _widest(np.frexp(ids.astype(np.float64))[1].astype(np.uint8))
    reach = np.array([1, *PER_WORD])
    follow = np.minimum(at + reach[selector], stop)
    # the first id of every word: all blocks step from word to word at once
    now, firsts = np.arange(0, n, BLOCK), []
    ends = np.minimum(now + BLOCK, n)
    while len(now):
        firsts.append(now)
        now = follow[now]
        open_ = now < ends
        now, ends = now[open_], ends[open_]
    first = np.sort(np.concatenate(firsts))
    chosen = selector[first]
    size = 1 + (chosen == 0)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[place[chosen == 0] + 1] = ids[first[chosen == 0]]
    padded = np.concatenate((ids, np.zeros(max(PER_WORD), np.uint64)))
    for k, (count, width) in enumerate(zip(PER_WORD, WIDTH, strict=True), 1):
        for rows, most in _whole_and_cut(chosen == k, first, stop[first], count):
            word = padded[first[rows]] | np.uint64(k << 60)
            for j in range(1, count):
                more = padded[first[rows] + j] << np.uint64(j * width)
                word |= more if most is None else np.where(j < most, more, np.uint64(0))
            words[place[rows]] = word
    blocks = place[np.searchsorted(first, np.arange(0, n, BLOCK))]
    return words, blocks


def _whole_and_cut(of_kind: np.ndarray, first: np.ndarray, stop: np.ndarray, count: int):
    """The words of a kind that are full, and those that end with their block with their ids."""
    rows = np.flatnonzero(of_kind)
    full = first[rows] + count <= stop[rows]
    if full.any():
        yield rows[full], None
    if not full.all():
        cut = rows[~full]
        yield cut, stop[cut] - first[cut]


def _widest(bits: np.ndarray) -> np.ndarray:
    """The selector of the word with most ids that can start at each id; ids need ``bits`` bits.

    Blocks are rows, followed by zeros that restrict nothing, and the largest of each run of ids
    comes from those of two overlapping runs of a power of two.
    """
    n, rows = len(bits), -(-len(bits) // BLOCK)
    padded = np.zeros((rows, BLOCK + max(PER_WORD)), np.uint8)
    filled = np.zeros(rows * BLOCK, np.uint8)
    filled[:n] = bits
    padded[:, :BLOCK] = filled.reshape(rows, BLOCK)
    largest = {1: padded}
    while (p := max(largest)) * 2 <= max(PER_WORD):
        longer = largest[p].copy()
        np.maximum(longer[:, :-p], longer[:, p:], out=longer[:, :-p])
        largest[2 * p] = longer
    selector = np.zeros((rows, BLOCK), np.int8)
    for k in range(len(PER_WORD), 0, -1):
        count, width = PER_WORD[k - 1], WIDTH[k - 1]
        p = 1 << (count.bit_length() - 1)
        run = np.maximum(largest[p][:, :BLOCK], largest[p][:, count - p:count - p + BLOCK])
        selector[run <= width] = k
    return selector.reshape(-1)[:n]


def decode(words: np.ndarray, blocks: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of consecutive blocks that start at ``blocks`` in ``words``."""
    out = np.zeros(n, np.uint64)
    if n == 0:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words) + 1, bool)
    for z in np.flatnonzero(selector == 0).tolist():
        if not raw[z]:  # an escaped id may itself look like an escape
            raw[z + 1] = True
    raw = raw[:-1]
    counts = np.where(raw, 0, np.array([1, *PER_WORD, 0])[selector])
    # where each word's first id goes: ids before it within its block, after the block's start
    run = np.cumsum(counts) - counts
    block = np.searchsorted(blocks, np.arange(len(words)), side="right") - 1
    start = run - run[blocks][block] + block * BLOCK
    stop = np.minimum((block + 1) * BLOCK, n)
    escape = np.flatnonzero((selector == 0) & ~raw)
    out[start[escape]] = words[escape + 1]
    for k, (count, width) in enumerate(zip(PER_WORD, WIDTH, strict=True), 1):
        mask = np.uint64((1 << width) - 1)
        for rows, most in _whole_and_cut((selector == k) & ~raw, start, stop, count):
            word, at = words[rows], start[rows]
            for j in range(count):
                value = (word >> np.uint64(j * width)) & mask
                if most is None:
                    out[at + j] = value
                else:
                    out[(at + j)[j < most]] = value[j < most]
    return out
