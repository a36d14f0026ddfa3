"""Suffix-array dedup: removes every byte covered by a long string that also starts anywhere else.

Texts are UTF-8 bytes; a string of ``LENGTH`` bytes that starts at two places, in one document or two, marks its bytes at both.
``spans`` narrows the text to runs that may hold such strings and deals them, by content, to blocks. A block is
cut into shards of bounded size. Each shard gets a suffix array (Larsson and Sadakane's refinement: groups of equal
prefixes are split by the rank of what follows, twice as far each round) and the common prefix of neighbours (Kasai's
rule: a suffix's common prefix is one shorter than its predecessor's unless the preceding bytes differ). Neighbours with
LENGTH bytes in common are repeats; between shards, one string per group is found by binary search in the other's array.

Null and empty texts have no byte and nothing is removed; every row is a document of its own, equal rows too (they repeat each
other). Ids may be null or repeated. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tastegrid.llm import spans
from tastegrid.llm.hashing import powers, prefix_sums, span_hash

LENGTH = 200
ANCHOR = 48
SHARD_BYTES = 2 << 20


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a sequence of numbers below 2**21."""
    n = len(symbols)
    padded = np.concatenate((symbols.astype(np.int64) + 1, np.zeros(2, np.int64)))
    keys = padded[:n] << 42 | padded[1:n + 1] << 21 | padded[2:n + 2]
    order = np.argsort(keys)
    key = keys[order]
    begin = np.concatenate(([True], key[1:] != key[:-1])) if n else np.zeros(0, bool)
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(begin, np.arange(n), 0))
    rank[n] = -1
    array, depth = order, 3
    size = np.diff(np.append(np.flatnonzero(begin), n))
    open_ = order[np.repeat(size > 1, size)]  # suffixes whose group still has others
    while len(open_):
        following = rank[np.minimum(open_ + depth, n)]
        by = np.argsort(rank[open_] * (n + 1) + following + 1)
        group, following, open_ = rank[open_][by], following[by], open_[by]
        new_group = np.concatenate(([True], group[1:] != group[:-1]))
        first = np.maximum.accumulate(np.where(new_group, np.arange(len(open_)), 0))
        slot = group + np.arange(len(open_)) - first
        array[slot] = open_
        begin = new_group | np.concatenate(([True], following[1:] != following[:-1]))
        head = np.maximum.accumulate(np.where(begin, np.arange(len(open_)), 0))
        rank[open_] = slot[head]
        size = np.diff(np.append(np.flatnonzero(begin), len(open_)))
        open_ = open_[np.repeat(size > 1, size)]
        depth *= 2
    return array


def common_prefixes(symbols: np.ndarray, array: np.ndarray) -> np.ndarray:
    """For every place i: symbols that suffix i has in common with its predecessor in the array.

    The last symbol must be unique. Only where the symbols before the two differ is the text compared (a few steps for all such
    places at once); everywhere else the value is the one before minus 1.
    """
    n = len(symbols)
    before = np.full(n, -1)
    before[array[1:]] = array[:-1]
    apart = np.ones(n, bool)
    i = np.arange(1, n)
    apart[1:] = (before[i] <= 0) | (symbols[i - 1] != symbols[np.maximum(before[i], 1) - 1]) | (before[i - 1] < 0)
    at = np.flatnonzero(apart & (before >= 0))
    length = np.zeros(n, np.int64)
    padded = np.append(symbols, np.full(8, -1))
    active = at
    while len(active):
        a, b = active + length[active], before[active] + length[active]
        same = np.ones(len(active), bool)
        for k in range(8):
            same &= padded[np.minimum(a + k, n)] == padded[np.minimum(b + k, n)]
            same &= (a + k < n) & (b + k < n)
            length[active] += same
        active = active[same]
    anchor = np.maximum.accumulate(np.where(apart, np.arange(n), 0))
    return np.maximum(length[anchor] - (np.arange(n) - anchor), 0)


def repeated(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, starts of the strings, array, whether the ``length`` bytes from each place occur at another place)."""
    lengths = np.array([len(s) for s in strings])
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    symbols = np.zeros(lengths.sum() + len(strings), np.int64)
    body = np.ones(len(symbols), bool)
    body[starts + lengths] = False
    symbols[body] = np.frombuffer(b"".join(strings), np.uint8)
    symbols[~body] = 256 + np.arange(len(strings))  # every string ends in a symbol of its own
    array = suffix_array(symbols)
    long = common_prefixes(symbols, array)[array] >= length
    flag = np.zeros(len(symbols), bool)
    flag[array] = long | np.append(long[1:], False)
    return symbols, starts, array, flag


def found_in(symbols, array, windows) -> np.ndarray:
    """For each row of ``windows`` (n x length): a place in ``symbols`` with the same content, or -1, by binary search."""
    length = windows.shape[1]
    padded = np.append(symbols, np.full(length, 1 << 22))
    reach = np.arange(length)

    def compare(rows, places):
        there = padded[places[:, None] + reach]
        differs = there != windows[rows]
        first = differs.argmax(axis=1)
        pick = np.arange(len(rows)), first
        return np.sign(np.where(differs.any(axis=1), there[pick] - windows[rows][pick], 0))

    low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(array))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        less = compare(open_, array[middle]) < 0
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
    place = array[np.minimum(low, len(array) - 1)]
    return np.where((low < len(array)) & (compare(np.arange(len(windows)), place) == 0), place, -1)


def resolve(runs: list, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> list[np.ndarray]:
    """Marks (0 or NONE) for the windows of a block's runs."""
    by_anchor: dict[int, list[int]] = {}
    for at, run in enumerate(runs):
        by_anchor.setdefault(run[0], []).append(at)
    marks = [np.full(n, np.int64(0) if count > 1 else spans.NONE) for _, n, _, count, _ in runs]
    # A run alone with its anchor is compared with nothing; the others go to shards in the order of their anchors.
    shards, size = [[]], 0
    for members in by_anchor.values():
        for at in members if len(members) > 1 else []:
            if size > shard_bytes:
                shards.append([])
                size = 0
            shards[-1].append(at)
            size += len(runs[at][2])
    built = [(s, *repeated([runs[at][2] for at in s], length)) for s in shards if s]
    flags = [b[4] for b in built]
    reach = np.arange(length)
    for x in range(len(built)):
        for y in range(len(built)):
            if x == y or not {runs[a][0] for a in built[x][0]} & {runs[a][0] for a in built[y][0]}:
                continue
            members, symbols, starts, _, _ = built[x]
            places = np.concatenate([starts[k] + np.arange(runs[at][1]) for k, at in enumerate(members)])
            for i in range(0, len(places), 1 << 14):
                part = places[i:i + (1 << 14)]
                flags[x][part] |= found_in(built[y][1], built[y][3], symbols[part[:, None] + reach]) >= 0
    for (members, _, starts, _, _), flag in zip(built, flags):
        for k, at in enumerate(members):
            marks[at][flag[starts[k]:starts[k] + runs[at][1]]] = 0
    return marks


def byte_symbols(data: np.ndarray, offsets: np.ndarray) -> spans.Symbols:
    sums = prefix_sums(data)
    inverse = powers(len(sums))[1]

    def hashes(k, at=None):
        if at is not None:
            return span_hash(sums, at, at + k)
        n = max(0, len(data) - k + 1)  # all places: slices, and one multiplication instead of a full mix
        return (sums[k:] - sums[:n]) * inverse[:n] * np.uint64(0xD6E8FEB86659FD93) if n else np.zeros(0, np.uint64)

    return spans.Symbols(offsets, hashes, lambda a, b: data[a:b].tobytes())


SCHEMA = [("_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]


def covered(starts: np.ndarray, total: int, length: int) -> np.ndarray:
    """Which of ``total`` places lie within ``length`` places from some start."""
    step = np.zeros(total + 1, np.int32)
    step[starts] += 1
    step[np.minimum(starts + length, total)] -= 1  # starts are distinct; what ends at ``total`` is not read
    return np.cumsum(step[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES, hot: int = spans.HOT) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) per row; n_spans counts the maximal removed stretches."""
    def cut(ids, data, offsets, symbols, marks):
        gone = covered(np.flatnonzero(marks != spans.NONE), len(data), length)
        begins = gone & ~np.concatenate(([False], gone[:-1]))
        begins[offsets[:-1][offsets[:-1] < len(data)]] = gone[offsets[:-1][offsets[:-1] < len(data)]]
        sums, runs = np.concatenate(([0], np.cumsum(gone))), np.concatenate(([0], np.cumsum(begins)))
        removed = sums[offsets[1:]] - sums[offsets[:-1]]
        digests = []
        for i in range(len(ids)):
            part = data[offsets[i]:offsets[i + 1]]
            digests.append(hashlib.sha256(part if not removed[i] else part[~gone[offsets[i]:offsets[i + 1]]]).hexdigest())
        return pa.table([pa.array(ids), pa.array(np.diff(offsets)), pa.array(removed),
                         pa.array(runs[offsets[1:]] - runs[offsets[:-1]]), pa.array(digests, pa.string())], schema=pa.schema(SCHEMA))

    return spans.dedup(docs, byte_symbols, length, anchor, lambda runs: resolve(runs, length, shard_bytes), cut, SCHEMA,
                       id_col, text_col, hot)
