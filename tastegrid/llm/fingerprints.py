"""Document fingerprints from prefix polynomial hashes.

``PrefixHashes`` holds modular prefix arrays of a text's code points (two primes near 2**31): the hash of any
span takes two entries, so span equality is one comparison and the longest common extension of two
positions is a binary search. A fingerprint is the length, the hash of the whole text, short hashes of
the prefixes and suffixes whose lengths lie on a geometric grid, and the hashes of some inner spans, chosen by
their own value, so that equal spans are chosen in every text. The likeness of two fingerprints is the greater of two figures: the
part of the longer text that their common prefix and common suffix, found by binary search on the
grid, cover, and the part of the chosen spans that they share.

Spans have 24 code points. A text of up to 64 of them keeps them all; a longer one keeps those whose hash ends in as many zero
bits as leave about 32 to 64, so the shared part has a standard error of up to 0.09. Spans that occur several times are counted.

Null texts count as empty. Equal texts have equal fingerprints and a likeness of 1, two empty texts too; an
empty and a non-empty text have a likeness of 0. Rows in a tie of ids are ordered by text; a null id
comes before all others. Repeated rows are rows of their own, and other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.hashing import mix

# Two primes below 2**31 and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 69069)

_powers = [np.ones(1, np.uint64) for _ in PRIMES]


def _powers_to(n):
    for k, (prime, base) in enumerate(zip(PRIMES, BASES)):
        if len(_powers[k]) < n:
            grown = np.ones(1, np.uint64)
            while len(grown) < n:  # doubling: the second half is the first times a power
                grown = np.concatenate((grown, grown * np.uint64(pow(base, len(grown), prime)) % np.uint64(prime)))
            _powers[k] = grown
    return _powers


class PrefixHashes:
    """Prefix arrays of one text; spans are [start, end) in code points."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(points)
        self.powers = _powers_to(self.n + 1)
        self.sums = []
        for prime, power in zip(PRIMES, self.powers):
            sums = np.zeros(self.n + 1, np.uint64)
            # Terms are below 2**31, so sums of up to 2**33 of them are exact.
            np.cumsum(points * power[:self.n] % np.uint64(prime), out=sums[1:])
            self.sums.append(sums % np.uint64(prime))

    def spans(self, starts, ends, last=None):
        """Hashes of many spans as one 62-bit number each, comparable among texts of at most ``last`` code points."""
        last = self.n if last is None else last
        both = []
        for prime, power, sums in zip(PRIMES, _powers_to(last + 1), self.sums):
            p = np.uint64(prime)
            both.append((sums[ends] + p - sums[starts]) % p * power[last - starts] % p)
        return both[0] << np.uint64(31) | both[1]

    def same(self, other: PrefixHashes, start: int, at: int, length: int) -> bool:
        last = max(self.n, other.n)
        one, two = np.array([start]), np.array([at])
        return bool(self.spans(one, one + length, last)[0] == other.spans(two, two + length, last)[0])

    def common_extension(self, other: PrefixHashes, start: int = 0, at: int = 0) -> int:
        """Code points that self from ``start`` and other from ``at`` have in common."""
        low, high = 0, min(self.n - start, other.n - at)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.same(other, start, at, middle) else (low, middle - 1)
        return low

    def common_suffix(self, other: PrefixHashes) -> int:
        low, high = 0, min(self.n, other.n)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.same(other, self.n - middle, other.n - middle, middle) else (low, middle - 1)
        return low


def grid(n: int) -> np.ndarray:
    """1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, ...: each about a quarter longer, up to n."""
    out, at = [], 1
    while at <= n:
        out.append(at)
        at += max(1, at // 4)
    return np.array(out, np.int64)


_GRID = grid(1 << 31)


SPAN = 24      # code points of an inner span
CHOSEN = 64    # inner spans that are kept whatever their hashes
HASH_BITS = 48
SHORT = 8      # hex digits of a prefix or suffix

_back = [np.ones(1, np.uint64) for _ in PRIMES]


def _back_to(n):
    """Powers of the inverse bases: they move a span's hash to the front, so that it is comparable among all texts."""
    for k, (prime, base) in enumerate(zip(PRIMES, BASES)):
        while len(_back[k]) < n:
            step = np.uint64(pow(base, -len(_back[k]), prime))
            _back[k] = np.concatenate((_back[k], _back[k] * step % np.uint64(prime)))
    return _back


def chosen_spans(h: PrefixHashes) -> tuple[int, np.ndarray, np.ndarray]:
    """(zero bits asked for, hashes, how often each occurs) of the inner spans that a text keeps."""
    count = max(0, h.n - SPAN + 1)
    bits = max(0, int(np.ceil(np.log2(count / CHOSEN)))) if count else 0
    parts = []
    for prime, sums, back in zip(PRIMES, h.sums, _back_to(count)):
        p = np.uint64(prime)
        parts.append((sums[SPAN:SPAN + count] + p - sums[:count]) % p * back[:count] % p)
    mixed = mix(parts[0] << np.uint64(31) | parts[1]) >> np.uint64(64 - HASH_BITS)
    kept, times = np.unique(mixed[mixed & np.uint64((1 << bits) - 1) == 0], return_counts=True)
    return bits, kept, times


def shared_spans(one: str, two: str) -> float:
    """Part of the chosen spans that two fingerprints share; both are first brought to the zero bits of the longer text."""
    found = [field.split(",") for field in (one, two)]
    bits = max(int(f[0]) for f in found)
    counts = []
    for f in found:
        entries = (entry.partition("x") for entry in f[1:])
        counts.append({int(h, 16): int(n or 1) for h, _, n in entries if not int(h, 16) & ((1 << bits) - 1)})
    most = max(sum(c.values()) for c in counts)
    return sum(min(n, counts[1].get(h, 0)) for h, n in counts[0].items()) / most if most else 0.0


def fingerprint(text: str) -> str:
    """Length, whole hash, 32 bits for every prefix and suffix on the grid, and the chosen inner spans, in hex."""
    h = PrefixHashes(text)
    if not h.n:
        return "0."
    at = _GRID[:np.searchsorted(_GRID, h.n, "right")]
    zero = np.zeros(1, np.int64)
    whole = int(h.spans(zero, zero + h.n)[0])

    def short(starts, ends):
        # Moved to the front by the inverse power, so that texts of any length can be compared.
        p = np.uint64(PRIMES[0])
        moved = (h.sums[0][ends] + p - h.sums[0][starts]) % p
        value = moved * _back_to(h.n)[0][starts] % p
        return (mix(value) >> np.uint64(32)).astype(">u4").tobytes().hex()

    bits, kept, times = chosen_spans(h)
    inner = ",".join([str(bits), *(f"{s:x}x{n}" if n > 1 else f"{s:x}" for s, n in zip(kept.tolist(), times.tolist()))])
    return f"{h.n:x}.{whole:016x}.{short(np.zeros(len(at), np.int64), at)}.{short(h.n - at, np.full(len(at), h.n))}.{inner}"


def likeness(one: str, two: str) -> float:
    """The greater of the part of the longer text that common prefix and suffix cover and the part of shared inner spans."""
    if one == two:
        return 1.0
    a, b = one.split("."), two.split(".")
    n, m = int(a[0], 16), int(b[0], 16)
    if not n or not m:
        return 0.0

    def common(x, y):
        low, high = 0, min(len(x), len(y)) // SHORT
        while low < high:
            middle = (low + high + 1) // 2
            last = slice(SHORT * (middle - 1), SHORT * middle)
            low, high = (middle, high) if x[last] == y[last] else (low, middle - 1)
        return int(_GRID[low - 1]) if low else 0

    ends = min(n, m, common(a[2], b[2]) + common(a[3], b[3]))  # they may overlap in the shorter text
    return max(ends / max(n, m), shared_spans(a[4], b[4]))


def edited(text: str, following: str) -> str:
    """``text`` whose second half (rounded down) is replaced by as many first code points of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RANGE_BYTES = 16 << 20
MOST_RANGES = 10_000


def in_sequence(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows dealt to ranges of the id, each range followed by a copy of the row that comes next.

    (range, copy, _id, _text), sorted within the partitions. Range bounds are quantiles of the ids, one for
    about 16 MB of text and 10,000 at most. The first rows of a range go to the range before it as
    copies, those of the first range to the last one.
    """
    spark = docs.sparkSession
    table = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    total = table.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    wanted = max(1, min(MOST_RANGES, -(-total // RANGE_BYTES)))
    bounds = []
    if wanted > 1:
        shares = F.array(*(F.lit(i / wanted) for i in range(1, wanted)))
        bounds = sorted(set(table.agg(F.percentile_approx("_id", shares, F.lit(4 * wanted))).first()[0]))
    bounds_col = F.array(*(F.lit(b) for b in bounds)) if bounds else None
    ranged = table.withColumn("_range", F.lit(0) if bounds_col is None else F.aggregate(
        bounds_col, F.lit(0), lambda n, b: n + (F.col("_id") >= b).cast("int")))
    firsts = sorted((r[0], r[1]) for r in ranged.groupBy("_range").agg(F.min("_id")).collect())  # a row per range
    if not firsts:
        return ranged.select("_range", F.lit(False).alias("_copy"), "_id", "_text")
    before = [(key, first, firsts[i - 1][0]) for i, (key, first) in enumerate(firsts)]
    edges = spark.createDataFrame(before, "_range int, _first bigint, _before int")
    seen_by = F.when(F.col("_id") == F.col("_first"), F.array(
        F.struct(F.col("_range").alias("r"), F.lit(False).alias("copy")),
        F.struct(F.col("_before").alias("r"), F.lit(True).alias("copy")),
    )).otherwise(F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("copy"))))
    dealt = ranged.join(F.broadcast(edges), "_range").select(F.explode(seen_by).alias("_to"), "_id", "_text").select(
        F.col("_to.r").alias("_range"), F.col("_to.copy").alias("_copy"), "_id", "_text")
    return dealt.repartition("_range").sortWithinPartitions("_range", "_copy", "_id", "_text")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row.

    The edited text takes the first code points of the next row's text by ascending id (after the last
    row: the first). Each text crosses one shuffle, and a task holds two texts at a time.
    """
    fields = [("_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
              ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]

    def run(batches):
        held = None  # (range, id, text, fingerprint) of the row that waits for the next one
        for batch in batches:
            done = []
            for r, copy, i, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                print_ = fingerprint(text) if held is None or not copy or held[0] == r else ""
                if held is not None and held[0] == r:
                    changed = edited(held[2], text)
                    other = fingerprint(changed)
                    done.append((held[1], len(held[2]), hashlib.sha256(changed.encode()).hexdigest(), held[3], other,
                                 likeness(held[3], other), likeness(held[3], print_)))
                held = None if copy else (r, i, text, print_)
            columns = list(zip(*done)) if done else [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])

    schema = "_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    out = in_sequence(docs, id_col, text_col).mapInArrow(run, schema)
    return out.select(F.when(F.col("_id") != -(1 << 63), F.col("_id")).alias(id_col), *(n for n, _ in fields[1:]))
