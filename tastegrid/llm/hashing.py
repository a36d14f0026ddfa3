"""Vectorised hashes of words, word n-grams and byte spans over Arrow text, shared by the operators.

Every hash is 64 bit and depends on content only, so it is equal in every task. Text is handled as
UTF-8 bytes, and whole batches are hashed with a few NumPy passes: the polynomial hash of any span
comes from two entries of one prefix array (arithmetic modulo 2**64).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
STRETCH = 1 << 19  # bytes whose prefix sums are held at once where spans are hashed in order


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


TABLE = mix(np.arange(256, dtype=np.uint64) + np.uint64(7))
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
# For word shingles of the near-duplicate operators: every ASCII byte but letters and digits separates.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((BASE, INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts one after the other, offsets): null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def lower_latin(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and the Latin-1 letters, on UTF-8 bytes."""
    low = LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    after = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    low[after] += 32
    return low


def prefix_sums(data: np.ndarray) -> np.ndarray:
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(TABLE[data] * powers(len(data) + 1)[0][:len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end) for many spans at once."""
    shift = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * shift[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def span_hashes(data: np.ndarray, starts: np.ndarray, *ends: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """``span_hash`` of spans that start in ascending order and do not overlap, one row for each of ``ends``.

    Prefix sums and powers take 24 bytes for each byte of text, so they are made for a stretch of the text at a time. Of a span's
    ends none may lie behind the next span's start.
    """
    powers(stretch + 1)
    out = np.empty((len(ends), len(starts)), np.uint64)
    for i, j in pieces(np.append(starts, len(data)), stretch):
        at = starts[i]
        sums = prefix_sums(data[at:max(e[j - 1] for e in ends)])
        for row, e in zip(out, ends):
            row[i:j] = span_hash(sums, starts[i:j] - at, e[i:j] - at)
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, separates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words; words of text i are first[i]:first[i + 1]."""
    inside = ~separates[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries (len - k + 1 of them, none if too short)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = words[:n].copy()
    for j in range(1, k):
        acc = mix(acc) * BASE + words[j:j + n]
    return mix(acc)


def gram_owner(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, text): starts of the k-grams that lie inside one text, and that text."""
    counts = np.diff(first)
    inside = np.maximum(counts - k + 1, 0)
    text = np.repeat(np.arange(len(counts)), inside)
    start = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(inside)[:-1])), inside)
    return start + np.arange(len(text)), text


def shingles(data: np.ndarray, offsets: np.ndarray, k: int, lower=lower_latin,
             separates: np.ndarray = NOT_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count): the k-word shingles of every text with their counts, sorted by text and hash.

    Words are lower-cased runs of letters and digits, or what ``lower`` and ``separates`` say. A text of fewer than k words,
    but at least one, has one shingle of all its words.
    """
    low = lower(data)
    starts, ends, first = word_spans(low, offsets, separates)
    words = span_hash(prefix_sums(low), starts, ends)
    at, text = gram_owner(first, k)
    values = grams(words, k)[at]
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        # A short text's hash is folded word by word, as a k-gram is.
        folded = words[first[short]].copy()
        for j in range(1, k - 1):
            more = counts[short] > j
            folded[more] = mix(folded[more]) * BASE + words[first[short][more] + j]
        text, values = np.concatenate((text, short)), np.concatenate((values, mix(folded ^ np.uint64(1))))
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return text[at], values[at], np.diff(np.append(at, len(text)))


def pieces(offsets: np.ndarray, size: int):
    """(i, j) ranges of texts whose bytes together stay near ``size`` (one text may be larger)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
