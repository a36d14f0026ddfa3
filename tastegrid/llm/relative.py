"""Substring dedup by relative Lempel-Ziv parsing, on words.

A window is ``WINDOW`` consecutive words; a word goes if a window that covers it also starts in a document of smaller id.
``spans`` narrows the text to runs that may hold such windows and deals them, by content, to reference blocks. Within a
block the runs of smaller ids are the reference: it is indexed by its windows, and every later run is parsed against it,
greedily: from the first indexed window on, a factor is copied as far as the reference goes on with the same words. All windows of
a factor are duplicates. The windows that straddle a factor's end belong to no factor and are looked up one by one.

Words are runs of bytes other than blank and 9 to 13, unchanged; a reference holds 40 bits of each word's hash, and a window is
13 of them. Null and empty texts have no word. A null id is larger than every id; rows of equal id do not repeat each
other. Rows are documents of their own. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tastegrid.llm import spans
from tastegrid.llm.hashing import WHITE, grams, prefix_sums, span_hash, word_spans
from tastegrid.llm.suffix import covered

WINDOW = 13
ANCHOR = 7
WIDTH = 5  # bytes kept of a word's hash


class Reference:
    """Indexed reference of one block: strings of words, with the place where each window first occurs."""

    def __init__(self, window: int = WINDOW):
        self.size = window * WIDTH
        self.data = bytearray()
        self.places: dict[bytes, int] = {}

    def add(self, words: bytes) -> None:
        base = len(self.data)
        self.data += words
        for i in range(0, len(words) - self.size + 1, WIDTH):
            self.places.setdefault(words[i:i + self.size], base + i)
        self.data += b"\0" * (WIDTH + 1)  # no factor runs on into the next string

    def parse(self, words: bytes) -> list[tuple[int, int]]:
        """Greedy factors of at least a window: (first word, words)."""
        factors, at = [], 0
        while at + self.size <= len(words):
            place = self.places.get(words[at:at + self.size])
            if place is None:
                at += WIDTH
                continue
            end = at + self.size
            there = place + self.size
            while end < len(words) and words[end:end + WIDTH] == self.data[there:there + WIDTH]:
                end, there = end + WIDTH, there + WIDTH
            factors.append((at // WIDTH, (end - at) // WIDTH))
            at = end
        return factors

    def duplicates(self, words: bytes, window: int = WINDOW) -> np.ndarray:
        """Which windows of a string occur in the reference: those inside factors, and around factor ends by look-up."""
        flag = np.zeros(max(0, len(words) // WIDTH - window + 1), bool)
        for first, n in self.parse(words):
            flag[first:first + n - window + 1] = True
            for at in range(first + n - window + 1, min(first + n, len(flag))):
                flag[at] = words[at * WIDTH:at * WIDTH + self.size] in self.places
        return flag


def resolve(runs: list, window: int = WINDOW) -> list[np.ndarray]:
    """For every window of a block's runs the least id known to have it: an earlier run's, or the run's own."""
    by_anchor: dict[int, list[int]] = {}
    for at, run in enumerate(runs):
        by_anchor.setdefault(run[0], []).append(at)
    marks = [np.full(n, low) for _, n, _, _, low in runs]
    for members in by_anchor.values():
        if len(members) == 1:
            continue
        members.sort(key=lambda at: runs[at][4])
        reference, waiting, low = Reference(window), [], None
        for at in members:
            if runs[at][4] != low:  # runs of one id are no reference for each other
                for words in waiting:
                    reference.add(words)
                waiting, low = [], runs[at][4]
            marks[at][reference.duplicates(runs[at][2], window)] = low - 1
            waiting.append(runs[at][2])
    return marks


def word_symbols(data: np.ndarray, offsets: np.ndarray) -> spans.Symbols:
    starts, ends, first = word_spans(data, offsets, WHITE)
    words = span_hash(prefix_sums(data), starts, ends)
    short = words.view(np.uint8).reshape(-1, 8)[:, :WIDTH]
    return spans.Symbols(first, lambda k, at=None: grams(words, k) if at is None else grams(words, k)[at], lambda a, b: short[a:b].tobytes())


SCHEMA = [("_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]


def remove_copied(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                  anchor: int = ANCHOR, hot: int = spans.HOT) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) per row; kept words are joined by one blank."""
    def cut(ids, data, offsets, symbols, marks):
        owner = np.repeat(ids, np.diff(symbols.first))
        gone = covered(np.flatnonzero((marks != spans.NONE) & (marks < owner)), len(owner), window)
        sums = np.concatenate(([0], np.cumsum(gone)))
        removed = sums[symbols.first[1:]] - sums[symbols.first[:-1]]
        digests = []
        for i in range(len(ids)):
            words = data[offsets[i]:offsets[i + 1]].tobytes().split()
            if removed[i]:
                words = compress(words, (~gone[symbols.first[i]:symbols.first[i + 1]]).tolist())
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
        return pa.table([pa.array(ids), pa.array(np.diff(symbols.first)), pa.array(removed), pa.array(digests, pa.string())],
                        schema=pa.schema(SCHEMA))

    return spans.dedup(docs, word_symbols, window, anchor, lambda runs: resolve(runs, window), cut, SCHEMA, id_col, text_col, hot)
