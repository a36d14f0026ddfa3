"""Exact nearest neighbours and best-scoring items over a grid of row blocks.

Sparse vectors are packed into blocks, and every pair of blocks meets without a shuffle (``blocks``): their disk is a few copies of
the input at every size. Dense ones, which are short, take the grid described next.

Queries and items are hashed into blocks of bounded size and every (query block, item block) cell
is one group: it multiplies two matrices and emits only the best k items per query. So no pair of
rows is ever materialised, a term or a group of copies shared by very many rows costs arithmetic
but no shuffle, and the work spreads over as many cells as the cluster can use. The lists of a
query's cells are then merged with an ordinary ranking.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.blocks import NO_ID, Vectors, crossed, from_vectors, ranges
from tastegrid.operators.ranking import top_n

CELL_BYTES = 64 * 2**20  # vectors of either side expected in one cell
ROW_BYTES = 8192        # a vector whose size the caller does not give
SCORE_BLOCK = 2_000_000  # scores held at once
RESULT = "query_id bigint, item_id bigint, similarity double"


def grid_shape(n_queries: int, n_items: int, parallelism: int, row_bytes: int = ROW_BYTES) -> tuple[int, int]:
    """Blocks per side: as large as a task can hold, but at least about two cells per core.

    A query is sent once per item block and an item once per query block, so fewer and larger
    cells move less data.
    """
    even = math.ceil(math.sqrt(max(n_queries, 1) * max(n_items, 1) / (2 * parallelism)))
    rows = min(max(64, CELL_BYTES // row_bytes), max(64, even))
    return max(1, math.ceil(n_queries / rows)), max(1, math.ceil(n_items / rows))


def block_of(column, blocks: int):
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def every_block(blocks: int):
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def best_matches(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    *,
    n_queries: int,
    n_items: int,
    terms: str | None = None,
    cosine: bool = True,
    digits: int = 6,
    skip_same_id: bool = False,
    exclude: DataFrame | None = None,
    row_bytes: int = ROW_BYTES,
) -> DataFrame:
    """(query_id, rank, item_id, similarity): the ``k`` best items of every query.

    Both sides have columns ``id`` and ``weights`` (an array of numbers). With ``terms`` the
    weights belong to the array of terms (text or integers) in that column and absent terms weigh
    0; without it they are dense vectors, and two lengths are an error. The score is the cosine, or the inner
    product, rounded to ``digits``; equal scores rank by item id; a zero vector has cosine 0.
    ``exclude`` names (query_id, item_id) pairs to leave out, each of which belongs to one cell.
    ``n_queries``, ``n_items`` and ``row_bytes`` (the usual size of a vector) only choose the grid.
    """
    if terms is not None and exclude is None:
        named = lambda t: t.select("id", F.col(terms).alias("terms"), "weights")
        right = from_vectors(named(items), n_items)
        left = right if queries is items else from_vectors(named(queries), n_queries)
        return best_of_blocks(left, right, k, cosine, digits, skip_same_id)
    spark = queries.sparkSession
    q_blocks, i_blocks = grid_shape(n_queries, n_items, spark.sparkContext.defaultParallelism, row_bytes)
    columns = ["weights"] if terms is None else [F.col(terms).alias("terms"), "weights"]
    none = F.lit(None).cast("bigint")
    left = queries.select(
        block_of("id", q_blocks).alias("qb"), every_block(i_blocks).alias("ib"), F.lit(0).alias("side"),
        F.col("id").cast("bigint").alias("id"), none.alias("other"), *columns)
    right = items.select(
        every_block(q_blocks).alias("qb"), block_of("id", i_blocks).alias("ib"), F.lit(1).alias("side"),
        F.col("id").cast("bigint").alias("id"), none.alias("other"), *columns)
    rows = left.unionByName(right)
    if exclude is not None:
        # The same hash as above, over the id columns' own type.
        q_id = F.col("query_id").cast(queries.schema["id"].dataType)
        i_id = F.col("item_id").cast(items.schema["id"].dataType)
        rows = rows.unionByName(exclude.select(
            block_of(q_id, q_blocks).alias("qb"), block_of(i_id, i_blocks).alias("ib"), F.lit(2).alias("side"),
            F.col("query_id").cast("bigint").alias("id"), F.col("item_id").cast("bigint").alias("other"),
        ), allowMissingColumns=True)

    def best_in_cell(cell: pa.Table) -> pa.Table:
        return cell_matches(cell, k, terms is not None, cosine, digits, skip_same_id)

    # A fixed partition count: cells are small in bytes but not in work, so they must not be merged. A task takes its
    # cells one after the other, so more tasks than keep every core evenly busy gain nothing.
    parts = min(q_blocks * i_blocks, 32 * spark.sparkContext.defaultParallelism)
    found = rows.repartition(parts, "qb", "ib").groupBy("qb", "ib").applyInArrow(best_in_cell, RESULT)
    ranked = top_n(found, k, ["query_id"], [F.desc("similarity"), F.asc("item_id")])
    return ranked.select("query_id", "rank", "item_id", "similarity")


def cell_matches(cell: pa.Table, k: int, sparse: bool, cosine: bool, digits: int, skip_same_id: bool) -> pa.Table:
    """Best items of every query of one cell."""
    side = cell.column("side").to_numpy()
    ids = cell.column("id").to_numpy()
    q_rows, i_rows = np.nonzero(side == 0)[0], np.nonzero(side == 1)[0]
    i_rows = i_rows[np.argsort(ids[i_rows], kind="stable")]  # item order breaks ties
    q_ids, i_ids = ids[q_rows], ids[i_rows]
    out_q, out_i, out_s = [], [], []
    if len(q_rows) and len(i_rows):
        skipped = _positions(cell, side, ids, q_ids, i_ids)
        load = _sparse_scores if sparse else _dense_scores
        for start, scores in load(cell, q_rows, i_rows, cosine):
            scores = np.rint(scores * 10.0**digits)
            stop = start + len(scores)
            if skip_same_id:
                _skip_same(scores, q_ids[start:stop], i_ids)
            inside = (skipped[0] >= start) & (skipped[0] < stop)
            scores[skipped[0][inside] - start, skipped[1][inside]] = -np.inf
            row, col = _best(scores, k)
            out_q.append(q_ids[start + row])
            out_i.append(i_ids[col])
            out_s.append(scores[row, col] / 10.0**digits + 0.0)
    return pa.table({
        "query_id": np.concatenate(out_q) if out_q else np.empty(0, "int64"),
        "item_id": np.concatenate(out_i) if out_i else np.empty(0, "int64"),
        "similarity": np.concatenate(out_s) if out_s else np.empty(0),
    })


def _positions(cell, side, ids, q_ids, i_ids):
    """Row and column numbers of the excluded pairs of this cell."""
    pairs = np.nonzero(side == 2)[0]
    if not len(pairs):
        return np.empty(0, int), np.empty(0, int)
    other = cell.column("other").to_numpy()[pairs]
    q_order = np.argsort(q_ids, kind="stable")
    q_at = np.minimum(np.searchsorted(q_ids, ids[pairs], sorter=q_order), len(q_ids) - 1)
    i_at = np.minimum(np.searchsorted(i_ids, other), len(i_ids) - 1)
    known = (q_ids[q_order[q_at]] == ids[pairs]) & (i_ids[i_at] == other)
    return q_order[q_at[known]], i_at[known]


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest scores per row, lower columns first among equals."""
    n = scores.shape[1]
    take = min(k, n)
    if take < n:
        kth = -np.partition(-scores, take - 1, axis=1)[:, take - 1 : take]
        above = scores > kth
        ties = scores == kth
        room = take - above.sum(axis=1, keepdims=True)
        chosen = above | (ties & (np.cumsum(ties, axis=1) <= room))
    else:
        chosen = np.ones_like(scores, bool)
    return np.nonzero(chosen & (scores > -np.inf))


def _flat(cell: pa.Table, column: str):
    """A list column as one flat array and its row offsets."""
    lists = cell.column(column).combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    lengths = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype("int64")
    return lists.flatten(), np.concatenate([[0], np.cumsum(lengths)])


def _dense_scores(cell, q_rows, i_rows, cosine) -> Iterator[tuple[int, np.ndarray]]:
    flat, offsets = _flat(cell, "weights")
    values = flat.to_numpy(zero_copy_only=False).astype("float64")
    lengths = np.diff(offsets)[np.concatenate([q_rows, i_rows])]
    width = int(lengths[0])
    if (lengths != width).any():
        raise ValueError(f"vectors of lengths {lengths.min()} and {lengths.max()}")
    q = values[offsets[q_rows][:, None] + np.arange(width)]
    i = values[offsets[i_rows][:, None] + np.arange(width)]
    q_norm, i_norm = np.linalg.norm(q, axis=1), np.linalg.norm(i, axis=1)
    step = max(1, SCORE_BLOCK // len(i_rows))
    for start in range(0, len(q_rows), step):
        scores = q[start : start + step] @ i.T
        yield start, _as_cosine(scores, q_norm[start : start + step], i_norm) if cosine else scores


def _as_cosine(scores, q_norm, i_norm):
    scale = q_norm[:, None] * i_norm[None, :]
    return np.divide(scores, scale, out=np.zeros_like(scores), where=scale > 0)


def _sparse_scores(cell, q_rows, i_rows, cosine) -> Iterator[tuple[int, np.ndarray]]:
    flat, offsets = _flat(cell, "terms")
    coded = flat.dictionary_encode()
    codes, n_terms = coded.indices.to_numpy(), len(coded.dictionary)
    values = _flat(cell, "weights")[0].to_numpy(zero_copy_only=False).astype("float64")

    def entries(rows):
        lengths = offsets[rows + 1] - offsets[rows]
        take = ranges(offsets[rows], lengths)
        return np.repeat(np.arange(len(rows)), lengths), codes[take], values[take]

    q_row, q_term, q_value = entries(q_rows)
    q_norm = np.sqrt(np.bincount(q_row, q_value**2, len(q_rows)))
    return Postings(*entries(i_rows), len(i_rows), n_terms).products(q_row, q_term, q_value, q_norm, cosine)


class Postings:
    """Sparse items (entries of row, term, value) ready to be multiplied: terms in an eighth or more of the items as one dense
    product, the others by their postings."""

    def __init__(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, n: int, n_terms: int):
        self.n = n
        self.norm = np.sqrt(np.bincount(row, value**2, n))
        self.frequency = np.bincount(term, minlength=n_terms)
        heavy = np.nonzero(self.frequency > max(n // 8, 1))[0]
        self.heavy_at = np.full(n_terms, -1)
        self.heavy_at[heavy] = np.arange(len(heavy))
        self.dense = np.zeros((len(heavy), n))
        is_heavy = self.heavy_at[term] >= 0
        self.dense[self.heavy_at[term[is_heavy]], row[is_heavy]] = value[is_heavy]
        order = np.argsort(term, kind="stable")
        self.row, self.value = row[order], value[order]
        self.start = np.concatenate([[0], np.cumsum(self.frequency)])

    def products(self, q_row, q_term, q_value, q_norm, cosine) -> Iterator[tuple[int, np.ndarray]]:
        """(first query, scores of some queries): query entries are sorted by row, ``q_norm`` has the length of every query."""
        n, n_queries = self.n, len(q_norm)
        q_from = np.searchsorted(q_row, np.arange(n_queries + 1))
        step = max(1, SCORE_BLOCK // n)
        for start in range(0, n_queries, step):
            stop = min(start + step, n_queries)
            part = slice(q_from[start], q_from[stop])
            row, term, value = q_row[part] - start, q_term[part], q_value[part]
            big = self.heavy_at[term] >= 0
            dense = np.zeros((stop - start, len(self.dense)))
            dense[row[big], self.heavy_at[term[big]]] = value[big]
            scores = dense @ self.dense
            row, term, value = row[~big], term[~big], value[~big]
            hits = self.frequency[term]
            cuts = np.searchsorted(np.cumsum(hits), np.arange(SCORE_BLOCK, hits.sum() + SCORE_BLOCK, SCORE_BLOCK))
            for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(hits)]])):
                count = hits[a:b]
                if not count.sum():
                    continue
                at = ranges(self.start[term[a:b]], count)
                target = np.repeat(row[a:b], count) * n + self.row[at]
                scores += np.bincount(
                    target, np.repeat(value[a:b], count) * self.value[at], scores.size).reshape(scores.shape)
            yield start, _as_cosine(scores, q_norm[start:stop], self.norm) if cosine else scores


def translated(vectors: Vectors, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight) of the entries whose term is in ``vocabulary``, ``term`` being the position there."""
    at = np.minimum(np.searchsorted(vocabulary, vectors.vocabulary), max(0, len(vocabulary) - 1))
    known = vocabulary[at] == vectors.vocabulary if len(vocabulary) else np.zeros(len(at), bool)
    inside = known[vectors.term]
    return vectors.row[inside], at[vectors.term[inside]], vectors.weight[inside]


def best_of_blocks(queries: DataFrame, items: DataFrame, k: int, cosine: bool = True, digits: int = 6, skip_same_id: bool = False) -> DataFrame:
    """``best_matches`` of two tables of blocks. A task keeps the best of its query blocks while the items pass."""

    def run(pairs):
        kept, names, item, asked = {}, {}, (None, None, None), (None, None)
        for ib, i_payload, qb, q_payload in pairs:
            if item[0] != ib:
                vectors = Vectors(i_payload)
                item = ib, vectors, Postings(vectors.row, vectors.term, vectors.weight, len(vectors), len(vectors.vocabulary))
            if asked[0] != qb:
                asked = qb, Vectors(q_payload)
            i, q = item[1], asked[1]
            q_norm = np.sqrt(np.bincount(q.row, q.weight**2, len(q)))
            found = [kept[qb]] if qb in kept else []
            for start, scores in item[2].products(*translated(q, i.vocabulary), q_norm, cosine):
                scores = np.rint(scores * 10.0**digits)
                if skip_same_id:
                    _skip_same(scores, q.ids[start:start + len(scores)], i.ids)
                row, col = _best(scores, k)
                found.append((start + row, i.ids[col], scores[row, col]))
            row, ids, score = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((ids, -score, row))
            row, ids, score = row[order], ids[order], score[order]
            first = np.searchsorted(row, np.arange(len(q) + 1))
            best = np.arange(len(row)) - first[row] < k
            kept[qb], names[qb] = (row[best], ids[best], score[best]), q.ids
        for qb, (row, ids, score) in kept.items():
            yield pa.RecordBatch.from_pydict({"query_id": names[qb][row], "item_id": ids, "similarity": score / 10.0**digits + 0.0})

    found = crossed(queries, items, run, RESULT)
    ranked = top_n(found, k, ["query_id"], [F.desc("similarity"), F.asc("item_id")])
    named = lambda c: F.nullif(F.col(c), F.lit(NO_ID)).alias(c)
    return ranked.select(named("query_id"), "rank", named("item_id"), "similarity")


def _skip_same(scores: np.ndarray, q_ids: np.ndarray, i_ids: np.ndarray) -> None:
    at = np.searchsorted(i_ids, q_ids)
    same = (at < len(i_ids)) & (i_ids[np.minimum(at, len(i_ids) - 1)] == q_ids)
    scores[np.nonzero(same)[0], at[same]] = -np.inf
