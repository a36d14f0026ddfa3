"""Importance resampling of documents towards a target collection, with the draw found by a distributed quickselect.

Features are the runs of 1 to ``max_n`` consecutive words (joined by one space, repeats counted), hashed into buckets by the CRC-32
of their bytes. A bucket's gain is the floored, scaled logarithm of the ratio of its smoothed shares in the target and in the
documents; a document's weight is the sum of its features' gains, looked up in one array of fixed length. Adding Gumbel noise
that depends on the seed and the id alone turns "the k highest scores" into a draw without replacement in proportion to the weights.

The k-th row is not found by sorting. Every pass takes a few random rows of the open interval as pivots, counts the rows
before, at and behind each of them exactly, and goes on between the two pivots that enclose the k-th row. Only the winners are sorted
and ranked. A pass reads a narrow stored table; the driver sees the pivots and their counts.

Defined cases: a null text has no words; a null id counts as the empty string in the noise and as larger than every id in
ties; repeated rows are rows of their own, and ties of score and id go to the smaller hash of the text. Empty tables give an
empty result, an empty target leaves all counts of the target at 0. Other columns are returned, on demand, inside the
one struct ``document``, so their names cannot clash.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tastegrid.llm.hashing import LOWER, NOT_WORD, gram_owner, pieces, text_bytes, word_spans
from tastegrid.operators.ranking import global_positions
from tastegrid.session import materialize

BUCKETS = 10_000
SCALE = 1000
PIVOTS = 24            # pivot rows of one pass; every pass narrows the interval about as many times
PIECE = 1 << 22        # bytes of text handled at once
LONG_FEATURE = 64      # bytes; longer ones are hashed one by one
HIGHEST = (1 << 63) - 1


def _crc_table() -> np.ndarray:
    """CRC-32 of every byte, from the polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


CRC = _crc_table()


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of many byte spans, one byte position of all spans at a time."""
    lengths = ends - starts
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    active = np.flatnonzero(lengths <= LONG_FEATURE)
    active = active[np.argsort(lengths[active], kind="stable")]
    sizes = lengths[active]
    for k in range(int(sizes[-1]) if len(sizes) else 0):
        now = active[np.searchsorted(sizes, k, "right"):]
        crc[now] = CRC[(crc[now] ^ data[starts[now] + k]) & np.uint32(255)] ^ (crc[now] >> np.uint32(8))
    crc = ~crc
    for i in np.flatnonzero(lengths > LONG_FEATURE):
        crc[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes())
    return crc


def features(data: np.ndarray, offsets: np.ndarray, max_n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of every feature, and the number of words of every text."""
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, NOT_WORD)
    texts, places = [], []
    if max_n > 1:
        # Words moved together with one space between, so that a run of words is one span of bytes.
        lengths = ends - starts
        begin = np.cumsum(lengths + 1) - lengths - 1
        joined = np.full(int((lengths + 1).sum()), 32, np.uint8)
        shift = np.repeat(begin - starts, lengths)
        source = np.arange(len(shift)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
        joined[source + shift] = low[source]
        low, starts, ends = joined, begin, begin + lengths
    for n in range(1, max_n + 1):
        at, text = gram_owner(first, n)
        texts.append(text)
        places.append(crc32_spans(low, starts[at], ends[at + n - 1]) % np.uint32(buckets))
    return np.concatenate(texts), np.concatenate(places).astype(np.int64), np.diff(first)


def bucket_counts(docs: DataFrame, text_col: str = "text", max_n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Number of features of all rows in each bucket. A task adds up what it reads, so at most ``buckets`` rows leave it."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for i, j in pieces(offsets, PIECE):
                total += np.bincount(features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], max_n, buckets)[1],
                                     minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    found = docs.select(text_col).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in found:
        out[r.bucket] = r.n
    return out


def bucket_gains(counts: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * ln of the ratio of smoothed shares) for every bucket."""
    s, t, n = int(counts.sum()), int(target.sum()), len(counts)
    return np.array([math.floor(scale * math.log((int(b) + 1) * (s + n) / ((int(a) + 1) * (t + n)))) for a, b in zip(counts, target)],
                    np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, text_col: str = "text", max_n: int = 1, row_columns: list[Column] = ()) -> DataFrame:
    """The given columns with ``_n_words, _n_features, _weight, _print`` (a hash of the text)."""
    table = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.struct(*row_columns).alias("_row"))
    buckets = len(gains)

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            out = []
            for i, j in pieces(offsets, PIECE):
                text, place, words = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], max_n, buckets)
                sums = np.zeros(j - i, np.int64)
                np.add.at(sums, text, gains[place])
                out.append(np.stack((words, np.bincount(text, minlength=j - i), sums)))
            numbers = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *(pa.array(c.astype(np.int64)) for c in numbers)],
                                             ["_row", "_print", "_n_words", "_n_features", "_weight"])

    table = table.select("_text", "_row", F.xxhash64("_text").alias("_print"))
    row_type = table.schema["_row"].dataType.simpleString()
    return table.mapInArrow(run, f"_row {row_type}, _print bigint, _n_words bigint, _n_features bigint, _weight bigint")


def gumbel(id_col: Column, seed: int, scale: int = SCALE) -> Column:
    """floor(scale * Gumbel noise) of an id: 32 bits of the SHA-256 of ``seed:id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296))).cast("bigint")


def kth_key(table: DataFrame, key: list[str], k: int, pivots: int = PIVOTS) -> Row | None:
    """The k-th row (from 1) of ``table`` in ascending order of the columns ``key``, which hold longs and are unique together.

    ``table`` should be stored: every pass reads its key columns twice, once for the pivots and once for the counts.
    Null if there are fewer than k rows.
    """
    whole, low, high, turn = F.struct(*key), None, None, 0
    literal = lambda row: F.struct(*(F.lit(row[c]).cast("bigint").alias(c) for c in key))
    rest = table.select(*key)
    while True:
        part = rest
        if low is not None:  # the first column alone lets the reader skip row groups
            part = part.filter((F.col(key[0]) >= low[key[0]]) & (whole > literal(low)))
        if high is not None:
            part = part.filter((F.col(key[0]) <= high[key[0]]) & (whole < literal(high)))
        picked = sorted(part.orderBy(F.xxhash64(*key, F.lit(turn)), *key).limit(pivots).collect(), key=tuple)
        if not picked:
            return None
        columns = [F.count_if(whole < literal(p)).alias(f"before_{i}") for i, p in enumerate(picked)]
        columns += [F.count_if(whole == literal(p)).alias(f"at_{i}") for i, p in enumerate(picked)]
        counted = part.agg(*columns, F.count(F.lit(1)).alias("all")).first()
        if counted["all"] < k:
            return None
        passed = 0
        for i, p in enumerate(picked):
            before = counted[f"before_{i}"]
            if before >= k:
                high = p
                break
            if before + counted[f"at_{i}"] >= k:
                return p
            low, passed = p, before + counted[f"at_{i}"]
        k -= passed
        turn += 1


def resample(docs: DataFrame, target: DataFrame, percent: int, seed: int, *, least_words: int = 20, max_n: int = 1, buckets: int = BUCKETS,
             id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Every row's id, ``n_words, n_features, weight, score`` and ``rank`` (1, 2, ... of the drawn rows, else null).

    ``percent`` of the rows with at least ``least_words`` words are drawn, those of highest score. With ``keep`` the caller's row is
    returned in the struct ``document``.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, max_n, buckets), bucket_counts(target, text_col, max_n, buckets))
    own = [F.col(id_col).alias("id")] + ([F.struct(*docs.columns).alias("document")] if keep else [])
    table = weighted(docs, gains, text_col, max_n, own).withColumn("_score", F.col("_weight") + gumbel(F.col("_row.id"), seed))
    key = ["_worst", "_late", "_id", "_print", "_nth"]
    stored = materialize(table.withColumns({
        "_worst": -F.col("_score"), "_late": F.col("_row.id").isNull().cast("bigint"), "_id": F.coalesce(F.col("_row.id").cast("bigint"), F.lit(0)),
        "_nth": F.monotonically_increasing_id()}))  # stored, so it stays: equal rows have places of their own
    enough = F.col("_n_words") >= least_words
    n = stored.filter(enough).count() * percent // 100
    last = kth_key(stored.filter(enough), key, n) if n else None
    names = [F.col("_row.id").alias(id_col), F.col("_n_words").alias("n_words"), F.col("_n_features").alias("n_features"),
             F.col("_weight").alias("weight"), F.col("_score").alias("score")] + ([F.col("_row.document").alias("document")] if keep else [])
    none = F.lit(None).cast("bigint").alias("rank")
    if last is None:
        return stored.select(*names, none)
    won = enough & (F.struct(*key) <= F.struct(*(F.lit(last[c]).cast("bigint").alias(c) for c in key)))
    drawn = global_positions(stored.filter(won), [F.col(c) for c in key], "_rank").select(*names, F.col("_rank").cast("bigint").alias("rank"))
    return stored.filter(~won).select(*names, none).unionByName(drawn)
