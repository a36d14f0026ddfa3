"""Sparse vectors packed many to a row.

A block is one row that holds the vectors of a few thousand ids: its own sorted vocabulary of hashed terms, and per entry a position in
it and a position among the distinct weights, compressed. Nothing is sent or stored per entry. Document frequencies cross the exchange
once per block and term. Two tables of blocks meet in a product of their few rows, which reads them from where they are stored and
shuffles neither; what a pair of blocks yields is up to the caller.

Terms are 64-bit hashes: unequal ones of equal hash would be taken for one.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.functions import scores, scrub
from tastegrid.session import materialize

BLOCK = "block int, payload binary"
TEXT_BYTES = 16 * 2**20  # text of one block
ROWS = 8192              # vectors of one block where their sizes are not known
NO_ID = -(1 << 63)       # stands for a null id inside a block


def packed(**arrays: np.ndarray) -> bytes:
    """The arrays in one compressed string; numbers lie byte by byte, which compresses sorted and small ones well."""
    head = json.dumps([(name, a.dtype.str, len(a)) for name, a in arrays.items()]).encode()
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays.values()]
    raw = b"".join([len(head).to_bytes(4, "little"), head, *planes])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(data) -> dict[str, np.ndarray]:
    data = memoryview(data)
    raw = memoryview(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd"))
    at = 4 + int.from_bytes(raw[:4], "little")
    out = {}
    for name, kind, n in json.loads(bytes(raw[4:at])):
        size = np.dtype(kind).itemsize
        out[name] = np.ascontiguousarray(np.frombuffer(raw[at:at + n * size], np.uint8).reshape(size, n).T).view(kind).reshape(n)
        at += n * size
    return out


def of_vectors(ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, weights: np.ndarray, **more: np.ndarray) -> bytes:
    """One block: ``sizes`` entries (hashed term, weight) of every id; rows are sorted by id, a row's entries by term."""
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    row = np.repeat(place, sizes)
    entries = np.lexsort((terms, row))
    vocabulary, code = np.unique(terms[entries], return_inverse=True)
    levels, level = np.unique(weights[entries], return_inverse=True)
    return packed(ids=ids[order], sizes=sizes[order].astype(np.int32), terms=code.astype(np.int32), vocabulary=vocabulary,
                  levels=levels, weights=level.astype(np.int32), **{name: a[order] for name, a in more.items()})


class Vectors:
    """An unpacked block: ``row``, ``term`` (a position in ``vocabulary``) and ``weight`` per entry."""

    def __init__(self, payload):
        self.arrays = unpacked(payload)
        self.ids, self.sizes, self.vocabulary, self.term = (self.arrays[c] for c in ("ids", "sizes", "vocabulary", "terms"))
        self.weight = self.arrays["levels"][self.arrays["weights"]]
        self.start = np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)])

    def __len__(self) -> int:
        return len(self.ids)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), self.sizes)

    def entries(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the entries of these rows, one row after the other."""
        return ranges(self.start[rows], self.sizes[rows])

    def only(self, rows: np.ndarray) -> bytes:
        """A block of some rows, in order, with the frequencies if there are any."""
        at = self.entries(rows)
        used, code = np.unique(self.term[at], return_inverse=True)
        levels, level = np.unique(self.weight[at], return_inverse=True)
        df = {"df": self.arrays["df"][used]} if "df" in self.arrays else {}
        return packed(ids=self.ids[rows], sizes=self.sizes[rows], terms=code.astype(np.int32), vocabulary=self.vocabulary[used],
                      levels=levels, weights=level.astype(np.int32), **df)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one range after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def block_count(spark, n_rows: int, rows_per_block: float) -> int:
    """As many blocks as bound their size, but about two a core for as long as a block has 64 rows."""
    even = min(2 * spark.sparkContext.defaultParallelism, -(-n_rows // 64))
    return max(1, even, int(-(-n_rows // max(1.0, rows_per_block))))


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


def _row(payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([payload], pa.binary())], ["block", "payload"])


def _bigint(column: str):
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NO_ID))


def from_vectors(vectors: DataFrame, n_rows: int, extra: str | None = None) -> DataFrame:
    """Blocks of (id, terms, weights), stored. ``n_rows`` chooses their number; ``extra`` is a column of lists of equal lengths to keep."""
    n = block_count(vectors.sparkSession, n_rows, ROWS)
    columns = [F.transform("terms", lambda t: F.xxhash64(t)).alias("terms"), F.col("weights").cast("array<double>").alias("weights")]
    rows = vectors.select(_bigint("id").alias("id"), *columns, *([extra] if extra else []))

    def flat(column):
        lists = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        return np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64), lists.flatten().to_numpy(zero_copy_only=False)

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            (sizes, terms), (_, weights) = flat(table["terms"]), flat(table["weights"])
            more = {}
            if extra:
                wide, values = flat(table[extra])
                more[extra] = values.reshape(len(wide), -1).view([("", values.dtype, values.size // max(1, len(wide)))]).reshape(-1)
            yield _row(of_vectors(_ids(table["id"]), sizes, terms.astype(np.int64), weights.astype(np.float64), **more))

    return materialize(rows.repartition(n, "id").mapInArrow(run, BLOCK))


def from_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Blocks of the TF-IDF weights of the texts, stored: the weights of ``text.tfidf``.

    A text crosses the exchange once, is cut and counted where it arrives, and is stored as counts.
    """
    n_rows, size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(text))).first()
    n = block_count(df.sparkSession, n_rows, n_rows * TEXT_BYTES / max(1, size or 0))
    tokens = df.select(_bigint(key).alias("id"), text).repartition(n, "id").select("id", F.explode(scrub.words(text)).alias("_t"))
    counts = tokens.select("id", F.xxhash64("_t").alias("term")).groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            ids, terms, tf = (table[c].to_numpy() for c in ("id", "term", "tf"))
            order = np.argsort(ids, kind="stable")
            known, sizes = np.unique(ids, return_counts=True)
            yield _row(of_vectors(known, sizes, terms[order], tf[order].astype(np.float64)))

    return with_frequencies(materialize(counts.mapInArrow(run, BLOCK)), n, n_rows)


def with_frequencies(blocks: DataFrame, n: int, n_documents: int | None = None) -> DataFrame:
    """The blocks with ``df``, the number of vectors that have each term of the vocabulary, stored; weights are multiplied by the
    smoothed inverse frequency if ``n_documents`` is given."""

    def terms(batches):
        for batch in batches:
            for b, payload in zip(batch["block"].to_pylist(), batch["payload"]):
                d = unpacked(payload.as_buffer())
                count = np.bincount(d["terms"], minlength=len(d["vocabulary"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(count), b, np.int32)), pa.array(d["vocabulary"]), pa.array(count)], ["block", "term", "n"])

    counted = blocks.mapInArrow(terms, "block int, term bigint, n bigint")
    df = counted.select("block", "term", F.sum("n").over(Window.partitionBy("term")).alias("df"))
    idf = F.lit(1.0) if n_documents is None else scores.smoothed_idf(F.lit(n_documents), F.col("df"))

    def put(block: pa.Table, known: pa.Table) -> pa.Table:
        if not block.num_rows:
            return block
        d = unpacked(block["payload"][0].as_buffer())
        order = np.argsort(known["term"].to_numpy())
        factor = known["idf"].to_numpy()[order]
        weights = d["levels"][d["weights"]] * factor[d["terms"]]
        levels, level = np.unique(weights, return_inverse=True)
        d |= {"levels": levels, "weights": level.astype(np.int32), "df": known["df"].to_numpy()[order]}
        return pa.table({"block": block["block"], "payload": pa.array([packed(**d)], pa.binary())})

    placed = df.select("block", "term", "df", idf.alias("idf")).repartition(n, "block")
    return materialize(blocks.repartition(n, "block").groupBy("block").cogroup(placed.groupBy("block")).applyInArrow(put, BLOCK))


def some_rows(blocks: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """Blocks of the ``wanted`` (id), stored."""

    def ids(batches):
        for batch in batches:
            for b, payload in zip(batch["block"].to_pylist(), batch["payload"]):
                own = unpacked(payload.as_buffer())["ids"]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), b, np.int32)), pa.array(own)], ["block", "id"])

    def pick(block: pa.Table, known: pa.Table) -> pa.Table:
        if not block.num_rows or not known.num_rows:
            return block.slice(0, 0)
        vectors = Vectors(block["payload"][0].as_buffer())
        rows = np.flatnonzero(np.isin(vectors.ids, known["id"].to_numpy()))
        return pa.table({"block": block["block"], "payload": pa.array([vectors.only(rows)], pa.binary())})

    listed = blocks.mapInArrow(ids, "block int, id bigint").join(wanted.select(F.col("id").cast("bigint").alias("id")), "id", "left_semi")
    return materialize(blocks.repartition(n, "block").groupBy("block").cogroup(
        listed.repartition(n, "block").groupBy("block")).applyInArrow(pick, BLOCK))


def crossed(queries: DataFrame, items: DataFrame, run: Callable, schema: str, streams: int = 4) -> DataFrame:
    """``run(pairs)`` over every pair of a query block and an item block; ``pairs`` yields (item block, payload, query block, payload).

    A task holds the blocks of one split of the queries, still packed, and reads the items past them in ``streams`` streams.
    """
    left = items.select(F.col("block").alias("ib"), F.col("payload").alias("ip")).coalesce(streams)
    pairs = left.hint("shuffle_replicate_nl").crossJoin(queries.select(F.col("block").alias("qb"), F.col("payload").alias("qp")))

    def read(batches):
        for batch in batches:
            for j in range(batch.num_rows):
                yield batch["ib"][j].as_py(), batch["ip"][j].as_buffer(), batch["qb"][j].as_py(), batch["qp"][j].as_buffer()

    return pairs.mapInArrow(lambda batches: run(read(batches)), schema)
