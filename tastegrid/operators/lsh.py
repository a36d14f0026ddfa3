"""Approximate neighbours: an index of signed random projections in several tables, with exact rescoring.

A table puts a vector into the bucket named by the signs of a few random projections; vectors at a small angle often fall
into the same one. Buckets are cells as those of ``grid``: a cell multiplies the matrices of its queries and items and emits the
best k items per query by their exact similarity, so candidates are never written out as pairs and none is cut off. A bucket that many
copies fill is dealt to sides of bounded size, and every query side meets every item side.

The number of signs follows the number of items, so a bucket keeps about ``BUCKET`` items and the work of a query stays the same
at every size; recall is bought with tables (a vector is sent once per table).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.grid import RESULT, cell_matches
from tastegrid.operators.ranking import top_n
from tastegrid.session import materialize

BUCKET = 512   # items expected in a bucket
SIDE = 2048    # rows on one side of a cell


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well spread bits of every 64-bit number (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def directions(coordinates: np.ndarray, n: int, seed: int) -> np.ndarray:
    """(coordinate x n) random numbers of mean 0 and variance 1 that depend on the coordinate's hash and the seed alone."""
    lane = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD1342543DE82EF95 & (1 << 64) - 1)
    bits = mixed(mixed(coordinates)[:, None] + lane)
    # The sum of four bytes is close enough to normal.
    return (sum((bits >> np.uint64(8 * i)) & np.uint64(255) for i in range(4)).astype(np.float32) - 510.0) / 147.8


def bucket_keys(vectors: DataFrame, tables: int, signs: int, seed: int, sparse: bool) -> DataFrame:
    """``vectors`` (id, weights and, if sparse, terms) with ``_keys``: the bucket in each table."""
    place = F.transform("terms", lambda t: F.xxhash64(t)) if sparse else F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("weights") - 1, F.lit(0))), lambda i: F.xxhash64(i))
    rows = vectors.withColumn("_at", place)
    names = vectors.columns

    def run(batches):
        for batch in batches:
            lists = batch.column("weights")
            lengths = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            at = batch.column("_at").flatten().to_numpy()
            first = np.cumsum(lengths) - lengths
            sums = np.zeros((len(lengths), tables * signs))
            known, code = np.unique(at, return_inverse=True)
            step = max(1, (1 << 22) // (tables * signs))  # distinct coordinates whose directions are held at once
            owner = np.repeat(np.arange(len(lengths)), lengths)
            at = code if sparse else code[:len(values)]
            for a in range(0, len(known), step):
                part = directions(known[a:a + step].view(np.uint64), tables * signs, seed)
                inside = np.flatnonzero((at >= a) & (at < a + step))
                for b in range(0, len(inside), step):
                    rows_ = inside[b:b + step]
                    present, start = np.unique(owner[rows_], return_index=True)
                    sums[present] += np.add.reduceat(part[at[rows_] - a] * values[rows_, None], start, axis=0)
            keys = ((sums.reshape(len(first), tables, signs) >= 0) << np.arange(signs)).sum(axis=2).astype(np.int64)
            offsets = np.arange(len(first) + 1, dtype=np.int32) * tables
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.ListArray.from_arrays(offsets, keys.ravel())], [*names, "_keys"])

    schema = ", ".join(f"`{n}` {t}" for n, t in vectors.dtypes)
    return rows.mapInArrow(run, f"{schema}, _keys array<bigint>")


def near_matches(queries: DataFrame, items: DataFrame, k: int, *, terms: bool = False, tables: int = 24, signs: int | None = None,
                 cosine: bool = True, digits: int = 6, skip_same_id: bool = False, seed: int = 7) -> DataFrame:
    """(query_id, rank, item_id, similarity): the k most similar of the items that share a bucket with the query.

    Columns as for ``grid.best_matches``: ``id``, ``weights`` and, with ``terms``, ``terms``. Similarities are exact, ties rank by item id.
    ``signs`` per table follow the number of items unless given. A query without any item in its buckets has no row.
    """
    columns = ["id", *(["terms"] if terms else []), "weights"]
    items, queries = materialize(items.select(*columns)), queries.select(*columns)
    if signs is None:
        signs = max(1, min(30, round(np.log2(max(1, items.count()) / BUCKET))))
    sides = {0: queries, 1: items}
    keyed = {s: materialize(bucket_keys(t, tables, signs, seed, terms)) for s, t in sides.items()}
    place = lambda s: keyed[s].select(F.posexplode("_keys").alias("_table", "_bucket"), *columns)
    counted = {s: place(s).groupBy("_table", "_bucket").agg(F.ceil(F.count(F.lit(1)) / SIDE).cast("int").alias(f"_s{s}")) for s in sides}
    cells = materialize(counted[0].join(counted[1], ["_table", "_bucket"]))  # at most tables x 2^signs rows
    none = F.lit(None).cast("bigint").alias("other")

    def dealt(s: int) -> DataFrame:
        own = F.pmod(F.xxhash64("id", F.lit(5)), F.col(f"_s{s}")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(f"_s{1 - s}") - 1))
        return place(s).join(cells, ["_table", "_bucket"]).withColumn("_own", own).select("*", every.alias("_other")).select(
            "_table", "_bucket", F.col("_own" if s == 0 else "_other").alias("_q"), F.col("_other" if s == 0 else "_own").alias("_i"),
            F.lit(s).alias("side"), none, F.col("id").cast("bigint").alias("id"), *columns[1:])

    def best(cell: pa.Table) -> pa.Table:
        return cell_matches(cell, k, terms, cosine, digits, skip_same_id)

    found = dealt(0).unionByName(dealt(1)).groupBy("_table", "_bucket", "_q", "_i").applyInArrow(best, RESULT)
    once = found.groupBy("query_id", "item_id").agg(F.max("similarity").alias("similarity"))
    return top_n(once, k, ["query_id"], [F.desc("similarity"), F.asc("item_id")]).select("query_id", "rank", "item_id", "similarity")
