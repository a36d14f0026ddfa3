"""Chunks of documents and compact exchanges of sorted 64-bit keys between them.

Operators that compare all texts with all texts deal the documents into chunks by a hash of the id. A chunk does
not send its texts about; it sends the hashes it needs to know about, sorted and without repeats, one row per (bucket
of the hash space, chunk), and the bucket answers in the same order. A key that is in a third of all documents is one entry
per chunk. Differences of sorted keys are stored by byte plane, so the shuffle's compression removes the empty planes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 8 << 20
HIGHEST = (1 << 63) - 1  # stands for a null id: after all others


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers by byte plane, empty high planes left out; the first byte is the number of planes."""
    values = np.ascontiguousarray(values, "<u8")
    planes = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    return bytes([planes]) + values.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def unpack(data: bytes, n: int | None = None) -> np.ndarray:
    """The packed numbers; ``n`` is needed only where all may be 0."""
    planes = data[0]
    if not planes:
        return np.zeros(n or 0, np.uint64)
    body = np.frombuffer(data, np.uint8, offset=1).reshape(planes, -1)
    out = np.zeros((body.shape[1], 8), np.uint8)
    out[:, :planes] = body.T
    return out.view("<u8").reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n), dtype=np.uint64)


def chunked(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int = CHUNK_BYTES,
            extra: dict[str, Column] | None = None) -> tuple[DataFrame, int]:
    """((chunk, _id, _text, extra columns) dealt by chunk, number of chunks); a chunk has about ``chunk_bytes`` of text.

    Rows of equal id are dealt by their text too, so that one id with many rows is no hot chunk.
    """
    table = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(HIGHEST)).alias("_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("_text"), *(c.alias(n) for n, c in (extra or {}).items()))
    total = table.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    conf = docs.sparkSession.conf
    return table.select(F.pmod(F.xxhash64("_id", F.length("_text")), F.lit(chunks)).cast("int").alias("chunk"), "*").repartition(
        int(conf.get("spark.sql.shuffle.partitions")), "chunk"), chunks


def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket (an equal part of the hash space) begins in sorted keys."""
    edges = np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def requests(chunk: int, keys: np.ndarray, buckets: int, **columns: np.ndarray) -> dict[str, list]:
    """Rows (bucket, chunk, n, keys, columns...) of a chunk's sorted distinct keys."""
    bounds = bucket_bounds(keys, buckets)
    out = {"bucket": [], "chunk": [], "n": [], "keys": [], **{c: [] for c in columns}}
    for b in range(buckets):
        part = slice(bounds[b], bounds[b + 1])
        if bounds[b + 1] > bounds[b]:
            out["bucket"].append(b), out["chunk"].append(chunk), out["n"].append(int(bounds[b + 1] - bounds[b]))
            out["keys"].append(pack_sorted(keys[part]))
            for c, values in columns.items():
                out[c].append(pack(values[part]))
    return out


def merged(rows: dict[str, list], columns: list[str]) -> tuple[np.ndarray, dict[str, np.ndarray], list[np.ndarray]]:
    """(distinct keys, sums of each column, place of every row's keys among them) of one bucket's requests."""
    parts = [unpack_sorted(k, n) for k, n in zip(rows["keys"], rows["n"])]
    keys, place = np.unique(np.concatenate(parts), return_inverse=True)
    bounds = np.cumsum([0, *map(len, parts)])
    sums = {c: np.bincount(place, np.concatenate([unpack(v, n) for v, n in zip(rows[c], rows["n"])]), len(keys)) for c in columns}
    return keys, sums, [place[bounds[i]:bounds[i + 1]] for i in range(len(parts))]


def answers(table: dict[str, list], columns: list[str], n_keys: int) -> dict[str, np.ndarray]:
    """A chunk's answers in the order of its sorted keys: its buckets' rows one after the other."""
    order = np.argsort(np.array(table["bucket"], np.int64), kind="stable")
    out = {c: np.concatenate([unpack(table[c][i], table["n"][i]) for i in order] or [np.zeros(0, np.uint64)]) for c in columns}
    if any(len(v) != n_keys for v in out.values()):
        raise RuntimeError("a chunk's answers do not fit its keys")
    return out


def as_lists(table: pa.Table) -> dict[str, list]:
    return {c: table[c].to_pylist() for c in table.column_names}
