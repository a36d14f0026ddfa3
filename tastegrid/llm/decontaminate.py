"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

A window has as many words as a benchmark item (a shorter document is one window). Its fingerprint is the 64-bit
SimHash of its five-word shingles, each weighted by how often it occurs. Fingerprints are cut into four blocks of 16
bits; two that differ in at most ``RADIUS`` = 19 bits differ in at most 4 bits of some block, so an index of all block
values within 4 bits of an item's finds every item within the radius. Candidates are verified by the weighted
Jaccard similarity of the shingles, 0.8 or more.

Windows that cannot reach 0.8 are not fingerprinted: a similar window of s words has at least
0.8 (s - 4) shingle positions whose shingle some item holds.

Words are lower-cased runs of letters and digits. Items of fewer than five words are too short to be told from chance and
match nothing; null texts count as empty and match nothing. Rows are searched one by one (repeated rows give equal
results); equal items all match. Null ids stay null. Other columns are kept.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.columns import packed, unpacked
from tastegrid.llm.hashing import NOT_WORD, grams, lower_latin, pieces, prefix_sums, span_hash, text_bytes, word_spans

SHINGLE = 5
SIMILARITY = 0.8
RADIUS, BLOCKS = 19, 4
ITEM_BLOCK = 500     # items searched at a time, also the bound of what is sent to the tasks
PIECE = 1 << 21
MATCH = pa.list_(pa.struct([("item", pa.int64()), ("similarity", pa.float64()), ("start_word", pa.int64()), ("n_words", pa.int64())]))


def simhash(bits: np.ndarray) -> np.ndarray:
    """64-bit fingerprints from sums of +-1 per bit (rows x 64); a sum of 0 gives a 0 bit."""
    return np.packbits(bits > 0, axis=1).view(">u8").astype(np.uint64).reshape(-1)


def bit_sums(values: np.ndarray) -> np.ndarray:
    """Running sums (n + 1 x 64) of the +-1 bits of 64-bit values."""
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    return np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)))


class Items:
    """Index of a bounded block of benchmark items."""

    def __init__(self, ids: list, texts: list[str]):
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        low = lower_latin(data)
        starts, ends, first = word_spans(low, offsets, NOT_WORD)
        words = span_hash(prefix_sums(low), starts, ends)
        self.ids, self.sizes, self.shingles, prints = [], [], [], []
        for i, key in enumerate(ids):
            values = grams(words[first[i]:first[i + 1]], SHINGLE)
            if len(values):
                self.ids.append(key), self.sizes.append(int(first[i + 1] - first[i]))
                self.shingles.append(np.unique(values, return_counts=True))
                prints.append(simhash(bit_sums(values)[-1:])[0])
        self.sizes, self.prints = np.array(self.sizes, np.int64), np.array(prints, np.uint64)
        self.known = np.unique(np.concatenate([s[0] for s in self.shingles])) if self.shingles else np.zeros(0, np.uint64)
        self.seen = np.zeros(1 << 22, bool)  # a first, coarse test
        self.seen[self.known >> np.uint64(42)] = True
        width = 64 // BLOCKS
        masks = np.array([sum(1 << b for b in c) for n in range(RADIUS // BLOCKS + 1) for c in combinations(range(width), n)], np.int64)
        self.index = []
        for block in range(BLOCKS):
            value = (self.prints >> np.uint64(width * block) & np.uint64((1 << width) - 1)).astype(np.int64)
            near, item = (value[:, None] ^ masks[None, :]).reshape(-1), np.repeat(np.arange(len(value)), len(masks))
            order = np.argsort(near, kind="stable")
            self.index.append((np.searchsorted(near[order], np.arange((1 << width) + 1)), item[order]))

    def holds(self, values):
        """Whether some item has the shingle."""
        hit = self.seen[values >> np.uint64(42)]
        at = np.flatnonzero(hit)
        place = np.minimum(np.searchsorted(self.known, values[at]), len(self.known) - 1)
        hit[at] = self.known[place] == values[at]
        return hit

    def within_radius(self, prints):
        """(row, item) of all pairs that differ in at most RADIUS bits."""
        pairs = []
        for block, (bound, item) in enumerate(self.index):
            value = (prints >> np.uint64(16 * block) & np.uint64(0xFFFF)).astype(np.int64)
            n = bound[value + 1] - bound[value]
            row = np.repeat(np.arange(len(prints)), n)
            place = np.repeat(bound[value] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            pairs.append(row * len(self.ids) + item[place])
        pair = np.unique(np.concatenate(pairs))
        row, item = pair // len(self.ids), pair % len(self.ids)
        near = np.bitwise_count(prints[row] ^ self.prints[item]) <= RADIUS
        return row[near], item[near]

    def similarity(self, values, item):
        """Weighted Jaccard similarity of a window's shingles and an item's."""
        have, count = np.unique(values, return_counts=True)
        known, weight = self.shingles[item]
        at = np.minimum(np.searchsorted(known, have), len(known) - 1)
        same = known[at] == have
        shared = np.minimum(count[same], weight[at[same]]).sum()
        return shared / (len(values) + weight.sum() - shared)

    def search(self, values: np.ndarray, hits: np.ndarray, n_words: int, threshold: float) -> list[dict]:
        """Best window per item in one document; ``values`` are its shingles by position."""
        run = np.concatenate(([0], np.cumsum(hits)))
        begin, end, of = [], [], []
        for size in np.unique(self.sizes):
            length = min(size, n_words) - SHINGLE + 1
            least = np.ceil(threshold * (size - SHINGLE + 1) - 1e-9)
            at = np.flatnonzero(run[length:] - run[:-length] >= max(1, least))
            begin.append(at), end.append(at + length), of.append(np.full(len(at), size))
        begin, end, of = map(np.concatenate, (begin, end, of))
        if not len(begin):
            return []
        sums = bit_sums(values)
        best: dict[int, tuple] = {}
        for i in range(0, len(begin), 1 << 16):
            part = slice(i, i + (1 << 16))
            rows, items = self.within_radius(simhash(sums[end[part]] - sums[begin[part]]))
            fits = self.sizes[items] == of[part][rows]
            for row, item in zip(rows[fits] + i, items[fits]):
                value = self.similarity(values[begin[row]:end[row]], item)
                if value >= threshold:
                    best[item] = min(best.get(item, (1.0,)), (-value, int(begin[row]), int(end[row] - begin[row]) + SHINGLE - 1))
        return [{"item": self.ids[k], "similarity": -v[0], "start_word": v[1], "n_words": v[2]} for k, v in sorted(best.items())]


def _matches(column, items: Items, threshold: float) -> pa.Array:
    data, offsets = text_bytes(column)
    out = []
    for i, j in pieces(offsets, PIECE):
        low = lower_latin(data[offsets[i]:offsets[j]])
        starts, ends, first = word_spans(low, offsets[i:j + 1] - offsets[i], NOT_WORD)
        values = grams(span_hash(prefix_sums(low), starts, ends), SHINGLE)
        hits = items.holds(values) if len(items.ids) else np.zeros(len(values), bool)
        total = np.concatenate(([0], np.cumsum(hits)))
        least = max(1, np.ceil(threshold * (items.sizes.min() - SHINGLE + 1) - 1e-9)) if len(items.ids) else np.inf
        for k in range(j - i):
            a, b = first[k], max(first[k], first[k + 1] - SHINGLE + 1)  # shingles inside the document
            enough = b > a and total[b] - total[a] >= least
            out.append(items.search(values[a:b], hits[a:b], int(first[k + 1] - a), threshold) if enough else [])
    return pa.array(out, MATCH)


def find_matches(docs: DataFrame, benchmark: DataFrame, text_col="text", item_col="item_id", item_text="text",
                 threshold: float = SIMILARITY, drop_text: bool = False) -> DataFrame:
    """``docs`` with ``matches``: an array of (item, similarity, start_word, n_words), the best window per item.

    The benchmark is the query set. It is searched in blocks of ``ITEM_BLOCK`` items, one narrow pass
    each, so what a task holds of it is bounded whatever its size.
    """
    items = benchmark.select(F.col(item_col).cast("bigint").alias("i"), F.coalesce(F.col(item_text), F.lit("")).alias("t")).distinct()
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    out, found = docs.select(F.col(text_col).alias("_text"), packed(docs, [text_col])), []
    for block in range(blocks):
        chosen = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        held = tuple(sorted(((r.i, r.t) for r in chosen.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        out = _with_matches(out, held, "_text", threshold, f"_matches{block}", drop_text and block == blocks - 1)
        found.append(f"_matches{block}")
    own = {} if drop_text else {text_col: F.col("_text")}
    matches = F.concat(*found) if len(found) > 1 else F.col(found[0])
    return out.select(*unpacked([c for c in docs.columns if not (drop_text and c == text_col)], own | {"matches": matches}))


def without_matches(docs: DataFrame, benchmark: DataFrame, text_col="text") -> DataFrame:
    """The rows of ``docs``, all their columns as they are, that have no window like a benchmark item."""
    rest = docs.select(F.col(text_col).alias("_t"), packed(docs, [text_col]).alias("_row"))
    clean = find_matches(rest, benchmark, "_t").filter(F.size("matches") == 0)
    return clean.select(*(F.col("_t").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns))


def _with_matches(docs, held, text_col, threshold, name, drop_text):
    columns = docs.columns
    kept = [c for c in columns if not (drop_text and c == text_col)]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in kept)

    def run(batches):
        items = Items([i for i, _ in held], [t for _, t in held])
        for batch in batches:
            arrays = [batch.column(columns.index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*arrays, _matches(batch.column(columns.index(text_col)), items, threshold)], [*kept, name])

    return docs.mapInArrow(
        run, f"{fields}, `{name}` array<struct<item:bigint,similarity:double,start_word:bigint,n_words:bigint>>")
