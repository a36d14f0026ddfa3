"""Repeated passages of a fixed window length: the exact search behind suffix-array and Lempel-Ziv dedup.

Symbols are bytes or words. The window's *anchor* is the smallest hash of its k-grams; equal windows have equal anchors at
equal places, and neighbouring windows mostly share one, which makes a *run*. Windows are compared only among runs
of equal anchors:

1. each chunk of documents asks which of its anchors occur elsewhere (``exchange``), which drops unique text;
2. of what is left, a chunk sends each distinct run once, with the symbols under its windows, to the block of its anchor;
3. the block resolves which windows are repeated, and answers each chunk;
4. the chunk reads the answers and cuts its texts.

An anchor shared by very many runs (``HOT``) is not used: its windows are runs of their own whose anchor is the
window's hash, so a block holds a row per chunk and distinct window of it, whatever their number in the corpus. All four steps
are one job; the dealt documents are shuffled once and read by three of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm import exchange
from tastegrid.llm.hashing import mix, pieces, text_bytes

HOT = 2000           # runs of one anchor from which its windows go by their own hash
BLOCKS_PER_CHUNK = 8
PIECE = 1 << 20
NONE = np.int64(-(1 << 63))


@dataclass
class Symbols:
    """Symbols of several texts one after the other: text i has first[i]:first[i + 1]."""
    first: np.ndarray
    hashes: Callable[..., np.ndarray]     # (k, places=None) -> hash of the k-grams there, or everywhere
    content: Callable[[int, int], bytes]  # symbols of [start, end)


@dataclass
class Runs:
    text: np.ndarray      # text of the piece
    start: np.ndarray     # first window, as a place in the piece
    n: np.ndarray         # windows
    anchor: np.ndarray
    content: np.ndarray   # hash of all symbols under the windows


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def find_runs(symbols: Symbols, window: int, k: int) -> Runs:
    """Runs of neighbouring windows whose first smallest k-gram is at one place, of all texts of a piece."""
    counts = np.maximum(np.diff(symbols.first) - window + 1, 0)
    total = int(counts.sum())
    if not total:
        none, empty = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return Runs(none, none, none, empty, empty)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.repeat(symbols.first[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(total)
    gram = symbols.hashes(k)
    # High bits of the hash, then the place: of equal grams the first is the smallest.
    low = np.uint64((1 << len(gram).bit_length()) - 1)
    place = (sliding_min(gram & ~low | np.arange(len(gram), dtype=np.uint64), window - k + 1)[at] & low).astype(np.int64)
    fresh = np.ones(total, bool)
    fresh[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(fresh)
    return Runs(text[begin], at[begin], np.diff(np.append(begin, total)), gram[place[begin]], np.zeros(0, np.uint64))


def signed(symbols: Symbols, runs: Runs, window: int) -> Runs:
    """Fill in the content hashes: of the first and last window, which overlap, and the number of windows."""
    first, last = symbols.hashes(window, runs.start), symbols.hashes(window, runs.start + runs.n - 1)
    runs.content = mix(mix(first + runs.n.astype(np.uint64)) ^ last)
    return runs


def _texts(table: pa.Table):
    table = table.sort_by([("_id", "ascending"), ("_text", "ascending")])
    data, offsets = text_bytes(table["_text"])
    return table["_id"].to_numpy(), data, offsets


def dedup(docs: DataFrame, symbols_of: Callable, window: int, k: int, resolve: Callable, cut: Callable, cut_schema: list,
          id_col: str, text_col: str, hot: int = HOT) -> DataFrame:
    """Generic search. ``symbols_of(bytes, offsets)`` makes Symbols; ``resolve(runs)`` answers a block;
    ``cut(ids, bytes, offsets, symbols, marked)`` makes the result rows of a piece from the marked windows.

    ``resolve`` gets the distinct runs of a block as (anchor, n, symbols, count, least id), merged over the chunks, and
    gives per run an array with a number for every window, or NONE where nothing is marked.
    """
    table, chunks = exchange.chunked(docs, id_col, text_col)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(4096, 2 * chunks))
    blocks = chunks * BLOCKS_PER_CHUNK

    def asked(t: pa.Table) -> pa.Table:
        _, data, offsets = _texts(t)
        found = [np.zeros(0, np.uint64)]
        for i, j in pieces(offsets, PIECE):
            part = symbols_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            found.append(find_runs(part, window, k).anchor)
        keys, count = np.unique(np.concatenate(found), return_counts=True)
        rows = exchange.requests(t["chunk"][0].as_py(), keys, buckets, count=count.astype(np.uint64))
        return pa.table(rows, schema=pa.schema(ASK))

    def answered(t: pa.Table) -> pa.Table:
        rows = exchange.as_lists(t)
        _, sums, place = exchange.merged(rows, ["count"])
        kind = np.where(sums["count"] >= hot, 2, np.where(sums["count"] > 1, 1, 0)).astype(np.uint64)
        return pa.table({"bucket": rows["bucket"], "chunk": rows["chunk"], "n": rows["n"],
                         "kind": [exchange.pack(kind[p]) for p in place]}, schema=pa.schema(REPLY))

    def repeated_runs(t: pa.Table, replies: pa.Table):
        """Pieces of a chunk with the runs that may hold repeated windows."""
        ids, data, offsets = _texts(t)
        found = []
        for i, j in pieces(offsets, PIECE):
            part = symbols_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            found.append((i, j, part, find_runs(part, window, k)))
        keys = np.unique(np.concatenate([np.zeros(0, np.uint64), *(f[3].anchor for f in found)]))
        kind = exchange.answers(exchange.as_lists(replies), ["kind"], len(keys))["kind"]
        for i, j, part, runs in found:
            of = kind[np.searchsorted(keys, runs.anchor)]
            some, hottest = np.flatnonzero(of == 1), np.flatnonzero(of == 2)
            n = runs.n[hottest]
            start = np.repeat(runs.start[hottest] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            own = mix(part.hashes(window, start) ^ np.uint64(0x3C3C3C3C)) if len(start) else np.zeros(0, np.uint64)
            chosen = Runs(np.concatenate((runs.text[some], np.repeat(runs.text[hottest], n))),
                          np.concatenate((runs.start[some], start)), np.concatenate((runs.n[some], np.ones(len(start), np.int64))),
                          np.concatenate((runs.anchor[some], own)), np.zeros(0, np.uint64))
            yield ids[i:j], data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], part, (
                signed(part, chosen, window) if len(chosen.start) else chosen)

    def sent(key, t: pa.Table, replies: pa.Table) -> pa.Table:
        out: dict[int, list] = {}
        for ids, _, _, part, runs in repeated_runs(t, replies):
            for anchor, content, s, n, i in zip(runs.anchor.tolist(), runs.content.view(np.int64).tolist(), runs.start.tolist(),
                                                runs.n.tolist(), ids[runs.text].tolist() if len(runs.text) else []):
                have = out.get(content)
                if have is None:
                    out[content] = [anchor, n, part.content(s, s + n + window - 1), 1, i]
                else:
                    have[3] += 1
                    have[4] = min(have[4], i)
        chunk = key[0].as_py()
        columns = list(zip(*((a % blocks, a - (1 << 63), chunk, c, *rest) for c, (a, *rest) in out.items()))) or [[]] * 8
        return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, SENT)], schema=pa.schema(SENT))

    def resolved(t: pa.Table) -> pa.Table:
        rows = exchange.as_lists(t)
        known: dict[int, list] = {}
        for anchor, content, n, symbols, count, low in zip(*(rows[c] for c in ("anchor", "content", "n", "symbols", "count", "low"))):
            have = known.get(content)
            if have is None:
                known[content] = [anchor, n, symbols, count, low]
            else:
                have[3] += count
                have[4] = min(have[4], low)
        marks = dict(zip(known, resolve(list(known.values()))))
        chosen = [(c, x, exchange.pack(marks[x].view(np.uint64) ^ np.uint64(1 << 63)), len(marks[x]))
                  for c, x in zip(rows["chunk"], rows["content"]) if (marks[x] != NONE).any()]
        columns = list(zip(*chosen)) or [[]] * 4
        return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, MARK)], schema=pa.schema(MARK))

    def finished(key, t: pa.Table, more: pa.Table) -> pa.Table:
        replies = more.filter(pc.is_valid(more["kind"]))
        marks = more.filter(pc.is_valid(more["marks"]))
        marked = {c: (exchange.unpack(m, n) ^ np.uint64(1 << 63)).view(np.int64)
                  for c, m, n in zip(*(marks[c].to_pylist() for c in ("content", "marks", "n")))}
        out = []
        for ids, data, offsets, part, runs in repeated_runs(t, replies):
            found = np.full(part.first[-1], NONE)
            for content, s in zip(runs.content.view(np.int64).tolist(), runs.start.tolist()):
                mark = marked.get(content)
                if mark is not None:
                    found[s:s + len(mark)] = mark
            out.append(cut(ids, data, offsets, part, found))
        return pa.concat_tables(out) if out else pa.schema(cut_schema).empty_table()

    grouped = table.groupBy("chunk")
    ask = grouped.applyInArrow(asked, _ddl(ASK))
    reply = ask.groupBy("bucket").applyInArrow(answered, _ddl(REPLY)).repartition(partitions, "chunk")
    runs = grouped.cogroup(reply.groupBy("chunk")).applyInArrow(sent, _ddl(SENT))
    marks = runs.groupBy("block").applyInArrow(resolved, _ddl(MARK))
    both = reply.select("chunk", "bucket", "n", "kind", F.lit(None).cast("bigint").alias("content"),
                        F.lit(None).cast("binary").alias("marks")).unionByName(
        marks.select("chunk", F.lit(None).cast("int").alias("bucket"), "n", F.lit(None).cast("binary").alias("kind"),
                     "content", "marks"))
    out = table.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(finished, _ddl(cut_schema))
    return out.withColumn("_id", F.when(F.col("_id") != exchange.HIGHEST, F.col("_id"))).withColumnRenamed("_id", id_col)


ASK = [("bucket", pa.int32()), ("chunk", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()), ("count", pa.binary())]
REPLY = [("bucket", pa.int32()), ("chunk", pa.int32()), ("n", pa.int64()), ("kind", pa.binary())]
SENT = [("block", pa.int64()), ("anchor", pa.int64()), ("chunk", pa.int32()), ("content", pa.int64()), ("n", pa.int64()),
        ("symbols", pa.binary()), ("count", pa.int64()), ("low", pa.int64())]
MARK = [("chunk", pa.int32()), ("content", pa.int64()), ("marks", pa.binary()), ("n", pa.int64())]
NAMES = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary", pa.string(): "string"}


def _ddl(fields) -> str:
    return ", ".join(f"{n} {NAMES[t]}" for n, t in fields)
