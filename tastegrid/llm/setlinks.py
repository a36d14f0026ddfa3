"""Links between sets that share a bucket, verified exactly, and the classes they form, without pairs within a group.

A node is a distinct multiset of shingles; rows with equal sets are one node. A signature scheme has put nodes into buckets. What is
wanted are the components of the graph of all pairs that share a bucket and have a Jaccard similarity of at least a percentage:

1. Every member of a bucket meets the bucket's smallest node. That is one row per member.
2. Pairs are first held against parity sketches: bit i tells whether an odd number of elements falls into cell i. Two sketches
   differ in no more bits than the sets differ in elements, so what this drops cannot be similar.
3. What is left is verified with the sets themselves, which are made again from the texts of just these nodes.
4. Buckets whose members now lie in one component are done. The members of the others are dealt to sides of bounded size. A task
   holds the sketches of two sides and passes on the pairs of a spanning forest over components, nearest first, for step 3.
5. In buckets that are still open, members that have an allowed partner in another component are given their sets, and a task
   verifies all allowed pairs of two sides that it has not connected yet.

Sets are sorted 64-bit hashes of shingles, each occurrence of a repeated one being an element of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.llm.hashing import mix, pieces, text_bytes
from tastegrid.operators.joins import salted_join
from tastegrid.session import materialize

PIECE = 1 << 21       # bytes of text handled at once
SIDE = 1000           # nodes on each side of a comparison task
ELEMENTS = 1 << 20    # and elements
EDGES = 1 << 21       # contracted by one task
LOWEST = -(1 << 63)
NODE = "_node bigint, _n bigint, _sketch binary"


@dataclass(frozen=True)
class Sets:
    """Elements of some texts, sorted by text: ``owner[i]`` is the text of ``values[i]``; ``bounds`` are each text's limits."""

    owner: np.ndarray
    values: np.ndarray
    bounds: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def nodes(self) -> np.ndarray:
        """64 bits of hash of every set (the empty set has one too)."""
        sums = np.zeros(len(self.sizes), np.uint64)
        some = np.flatnonzero(self.sizes)
        if len(some):
            sums[some] = np.add.reduceat(mix(self.values ^ np.uint64(0x5DEECE66D1234567)), self.bounds[some])
        return np.maximum(mix(sums + self.sizes.astype(np.uint64)).view(np.int64), LOWEST + 1)

    def sketches(self) -> list[bytes]:
        """Parities of 2 to 4 cells an element (64 at least, a power of two)."""
        bits = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(2 * self.sizes, 1))).astype(np.int64))
        begin = np.cumsum(bits) - bits
        cell = begin[self.owner] + (mix(self.values ^ np.uint64(0x1B873593CC9E2D51)) & (bits[self.owner] - 1).astype(np.uint64)).astype(np.int64)
        packed = np.packbits((np.bincount(cell, minlength=int(bits.sum())) & 1).astype(np.uint8), bitorder="little")
        return [packed[b // 8:(b + n) // 8].tobytes() for b, n in zip(begin, bits)]

    def bodies(self) -> list[bytes]:
        return [self.values[a:b].tobytes() for a, b in zip(self.bounds[:-1], self.bounds[1:])]


def make_sets(shingles: tuple[np.ndarray, np.ndarray, np.ndarray], n_texts: int, counted: bool) -> Sets:
    """From (text, hash, count) sorted by text; with ``counted`` a shingle that occurs n times is n elements."""
    owner, values, counts = shingles
    if counted:
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        owner, values = np.repeat(owner, counts), mix(np.repeat(values, counts) + nth.astype(np.uint64))
        order = np.lexsort((values, owner))
        owner, values = owner[order], values[order]
    return Sets(owner, values, np.searchsorted(owner, np.arange(n_texts + 1)))


Reader = Callable[[np.ndarray, np.ndarray], Sets]


def over_texts(table: DataFrame, read: Callable, schema: str) -> DataFrame:
    """``read(data, offsets, batch of the other columns)`` on pieces of the column ``_text``, which comes last; yields batches of ``schema``."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(batch.num_columns - 1))
            for i, j in pieces(offsets, PIECE):
                columns = read(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], batch.slice(i, j - i))
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    return table.mapInArrow(run, schema)


def most_different(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Elements by which sets of these sizes may differ at a Jaccard similarity of ``percent``."""
    return (100 - percent) * (a + b) // (100 + percent)


def similar(a: bytes, b: bytes, percent: int) -> bool:
    both = np.concatenate((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)))
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared) and shared > 0


def folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch with ``size`` bytes: halves of a longer one are added."""
    bits = np.frombuffer(sketch, np.uint64)
    while bits.nbytes > size:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def members(rows: DataFrame) -> DataFrame:
    """(bucket, lo, node) for the members of every bucket but its smallest node ``lo``, from (bucket, node) with repeats."""
    ordered = Window.partitionBy("bucket").orderBy("node")
    return rows.withColumns({"lo": F.first("node").over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
                             "_before": F.lag("node").over(ordered)}).filter("node != lo and node != _before").select("bucket", "lo", "node")


def _near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The (x, y) pairs that their sizes and sketches allow."""
    side = lambda c: nodes.select(F.col("_node").alias(c), F.col("_n").alias(f"_n{c}"), F.col("_sketch").alias(f"_s{c}"))
    rows = pairs.join(side("x"), "x").filter("_nx > 0").join(side("y"), "y").filter(
        f"100 * least(_nx, _ny) >= {percent} * greatest(_nx, _ny)").select("x", "y", "_nx", "_ny", "_sx", "_sy")

    def run(batches):
        for batch in batches:
            limit = most_different(batch.column(2).to_numpy(), batch.column(3).to_numpy(), percent)
            good = np.zeros(batch.num_rows, bool)
            for i, (a, b) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())):
                size = min(len(a), len(b))
                good[i] = np.bitwise_count(folded(a, size) ^ folded(b, size)).sum() <= limit[i]
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], ["x", "y"])

    return rows.mapInArrow(run, "x bigint, y bigint")


def _bodies(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, reader: Reader) -> DataFrame:
    """(_node, _body) of the nodes in ``wanted`` (_node), made from one row of ``docs`` each."""
    rows = nodes.join(wanted.distinct(), "_node", "left_semi").select("_id", "_key")
    texts = docs.withColumn("_key", F.xxhash64("_text")).join(rows, ["_id", "_key"], "left_semi").dropDuplicates(["_id", "_key"])

    def read(data, offsets, batch):
        sets = reader(data, offsets)
        return sets.nodes(), pa.array(sets.bodies(), pa.binary())

    return materialize(over_texts(texts.select("_text"), read, "_node bigint, _body binary"))


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, reader: Reader, percent: int) -> DataFrame:
    """The (x, y) pairs whose sets are similar enough."""
    bodies = _bodies(pairs.select(F.col("x").alias("_node")).union(pairs.select(F.col("y").alias("_node"))), nodes, docs, reader)
    side = lambda c: bodies.select(F.col("_node").alias(c), F.col("_body").alias(f"_b{c}"))
    both = pairs.join(side("x"), "x").join(side("y"), "y").select("x", "y", "_bx", "_by")

    def run(batches):
        for batch in batches:
            keep = pa.array([similar(a, b, percent) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], ["x", "y"])

    return both.mapInArrow(run, "x bigint, y bigint")


def _groups(batches, keys: list[str]):
    """Tables of the rows with equal keys, from batches sorted by them."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held:
            table = pa.concat_tables([*held, table]).combine_chunks()
        columns = [table[c].to_numpy() for c in keys]
        new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        starts = np.concatenate(([0], np.flatnonzero(new) + 1))
        for a, b in zip(starts[:-1], starts[1:]):
            yield table.slice(a, b - a)
        held = [table.slice(starts[-1])]
    if held:
        yield held[0].combine_chunks()


KEYS = ["bucket", "_p", "_q"]


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of one bucket and two of its sides beside each other."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *KEYS).sortWithinPartitions(*KEYS)


def _open(stars: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """The members, but the smallest, of the buckets whose members lie in several components, dealt to sides.

    A bucket is taken once however many buckets hold the same members. A side has about ``SIDE`` members and ``ELEMENTS``
    elements; every two sides of a bucket meet.
    """
    known = nodes.select(F.col("_node").alias("node"), "_n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    placed = stars.select("bucket", "node").join(known, "node")
    number = lambda c: c.cast("decimal(20,0)")
    groups = placed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("_m"), F.sum("_n").alias("_all"), F.min("label").alias("_lo"), F.max("label").alias("_hi"),
        F.sum(number(F.xxhash64("node"))).alias("_sum"), F.sum(number(F.xxhash64("node", F.lit(1)))).alias("_more"))
    chosen = groups.filter("_lo != _hi").groupBy("_m", "_sum", "_more").agg(F.min("bucket").alias("bucket"), F.first("_all").alias("_all")).select(
        "bucket", F.ceil(F.greatest(F.col("_m") / SIDE, F.col("_all") / ELEMENTS)).cast("int").alias("_sides"))
    sided = placed.join(chosen, "bucket").withColumn("_side", F.pmod(F.xxhash64("node", F.lit(3)), "_sides").cast("int")).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_sides") - 1))).select(
        "bucket", F.least("_side", "_other").alias("_p"), F.greatest("_side", "_other").alias("_q"), "_side", F.col("node").alias("_node"), "label")
    return sided.join(nodes.select("_node", "_n", "_sketch"), "_node").select(*KEYS, "_side", "_node", "label", "_n", "_sketch")


def _allowed(group: pa.Table, sizes: np.ndarray, sketches: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, bits of difference) of the group's pairs of different components, one of each side, that their sketches allow."""
    side, label = group["_side"].to_numpy(), group["label"].to_numpy()
    p, q = group["_p"][0].as_py(), group["_q"][0].as_py()
    length = min(map(len, sketches))
    bits = np.stack([folded(s, length) for s in sketches])
    right = np.flatnonzero(side == q)
    first, second, gap = [], [], []
    for i in np.flatnonzero(side == p):
        other = right[(label[right] != label[i]) & ((right > i) | (p != q))]
        other = other[100 * np.minimum(sizes[other], sizes[i]) >= percent * np.maximum(sizes[other], sizes[i])]
        apart = np.bitwise_count(bits[other] ^ bits[i]).sum(axis=1, dtype=np.int64)
        near = apart <= most_different(sizes[other], sizes[i], percent)
        first.append(np.full(int(near.sum()), i, np.int32)), second.append(other[near].astype(np.int32)), gap.append(apart[near].astype(np.int32))
    none = [np.zeros(0, np.int32)]
    return tuple(np.concatenate(x or none) for x in (first, second, gap))


def _forest(opened: DataFrame, percent: int) -> DataFrame:
    """(x, y): of every group's allowed pairs those of a spanning forest over its components, the nearest ones first.

    That is fewer pairs than members. If such a pair is similar, most of the others are between nodes of one component.
    """
    def run(batches):
        for group in _groups(batches, KEYS):
            node = group["_node"].to_numpy()
            i, j, gap = _allowed(group, group["_n"].to_numpy(), group["_sketch"].to_pylist(), percent)
            at = np.unique(group["label"].to_numpy(), return_inverse=True)[1].astype(np.int64)
            # A total order of the pairs that is the same in every bucket, so that buckets choose the same ones.
            rank = np.empty(len(i), np.int64)
            rank[np.lexsort((np.maximum(node[i], node[j]), np.minimum(node[i], node[j]), gap))] = np.arange(len(i))
            chosen = np.zeros(len(i), bool)
            while len(rest := np.flatnonzero(at[i] != at[j])):
                best = np.full(len(node), len(i), np.int64)
                np.minimum.at(best, at[i[rest]], rank[rest])
                np.minimum.at(best, at[j[rest]], rank[rest])
                taken = rest[(best[at[i[rest]]] == rank[rest]) | (best[at[j[rest]]] == rank[rest])]
                chosen[taken] = True
                at = _roots(at[i[taken]], at[j[taken]], len(node))[at]
            i, j = i[chosen], j[chosen]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j]))], ["x", "y"])

    return _dealt(opened).mapInArrow(run, "x bigint, y bigint").distinct()


def _undecided(opened: DataFrame, percent: int) -> DataFrame:
    """The rows of ``opened`` that still have an allowed partner in their group, without sizes and sketches."""
    def run(batches):
        for group in _groups(batches, KEYS):
            i, j, _ = _allowed(group, group["_n"].to_numpy(), group["_sketch"].to_pylist(), percent)
            if len(i):
                yield from group.take(pa.array(np.unique(np.concatenate((i, j))))).select([*KEYS, "_side", "_node", "label"]).to_batches()

    return _dealt(opened).mapInArrow(run, "bucket bigint, _p int, _q int, _side int, _node bigint, label bigint")


def _decided(rows: DataFrame, bodies: DataFrame, percent: int) -> DataFrame:
    """(x, y): a forest of the similar pairs of different components within the groups, every allowed pair being looked at."""
    def run(batches):
        for group in _groups(batches, KEYS):
            body = group["_body"].to_pylist()
            bounds = np.cumsum([0, *(len(b) // 8 for b in body)])
            sets = Sets(np.repeat(np.arange(len(body)), np.diff(bounds)), np.frombuffer(b"".join(body), np.uint64), bounds)
            i, j, gap = _allowed(group, sets.sizes, sets.sketches(), percent)
            node, at = group["_node"].to_numpy(), np.unique(group["label"].to_numpy(), return_inverse=True)[1]
            found = [[], []]
            for k in np.argsort(gap, kind="stable"):
                a, b = i[k], j[k]
                if at[a] != at[b] and similar(body[a], body[b], percent):
                    at[at == at[b]] = at[a]
                    found[0].append(node[a]), found[1].append(node[b])
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in found], ["x", "y"])

    return _dealt(rows.join(bodies, "_node")).mapInArrow(run, "x bigint, y bigint")


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest of the nodes 0 to n - 1 that the edges (a, b) connect with each node."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component, for the nodes of the edges (x, y).

    Edges are merged into tasks of up to ``EDGES``, and each task contracts its own to stars. Where that is one task, that is all.
    Else stars are contracted alternately: every node's larger neighbours are linked to its smallest one, then its smaller
    neighbours, and so on until nothing changes; about log n rounds, each written to the shared folder.
    """
    def contracted(batches):
        ends = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not ends:
            return
        x, y = (np.concatenate(e) for e in zip(*ends))
        nodes, at = np.unique(np.concatenate((x, y)), return_inverse=True)
        root = _roots(at[:len(x)], at[len(x):], len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], ["u", "v"])  # a root has an edge to itself

    def star(table, larger):
        both = table.select("u", "v").unionByName(table.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else \
            table.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
        joined = both.join(low, "u")
        if larger:
            return joined.filter("v >= u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        return joined.select(F.col("v").alias("u"), F.col("_m").alias("v")).unionByName(low.select("u", F.col("_m").alias("v"))).distinct()

    links = materialize(edges.select(F.col("x").alias("u"), F.col("y").alias("v")))
    before = None
    while True:
        tasks = -(-links.count() // EDGES)
        merged = links.coalesce(max(1, tasks)).mapInArrow(contracted, "u bigint, v bigint")
        if tasks <= 1:
            return materialize(merged.select(F.col("u").alias("node"), F.col("v").alias("label")))
        links = materialize(star(star(materialize(merged), True), False))
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return materialize(links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label")))
        before = state


def link_classes(signed: DataFrame, rows: DataFrame, docs: DataFrame, reader: Reader, percent: int, links: DataFrame | None = None) -> DataFrame:
    """(node, label) for every node that is linked with another one.

    ``signed`` is stored and has (_id, _key, _node, _n, _sketch) with one row for every row of ``docs`` (_id, _text), ``_key`` being
    ``xxhash64(_text)``; ``rows`` are (bucket, node); ``links`` are edges (x, y) that need no verification.
    """
    nodes = materialize(signed.groupBy("_node").agg(F.min(F.struct("_id", "_key")).alias("_r"), F.first("_n").alias("_n"),
                                                    F.first("_sketch").alias("_sketch")).select("_node", "_r._id", "_r._key", "_n", "_sketch"))
    stars = materialize(members(rows))
    pairs = materialize(_near(stars.select(F.col("lo").alias("x"), F.col("node").alias("y")).distinct(), nodes, percent))
    edges = materialize(_verified(pairs, nodes, docs, reader, percent))
    edges = edges if links is None else edges.unionByName(materialize(links))
    labels = components(edges)
    opened = materialize(_open(stars, labels, nodes))
    pairs = materialize(_forest(opened, percent))
    if pairs.isEmpty():
        return labels
    edges = edges.unionByName(materialize(_verified(pairs, nodes, docs, reader, percent)))
    labels = components(edges)
    now = opened.withColumnRenamed("label", "_old").join(labels.withColumnRenamed("node", "_node"), "_node", "left")
    rest = materialize(_undecided(now.select(*KEYS, "_side", "_node", F.coalesce("label", "_old").alias("label"), "_n", "_sketch"), percent))
    if rest.isEmpty():
        return labels
    return components(edges.unionByName(_decided(rest, _bodies(rest.select("_node"), nodes, docs, reader), percent)))


def classed(signed: DataFrame, labels: DataFrame) -> DataFrame:
    """(_id, _node, _n, class_id, class_size) for every row of ``signed``: the smallest id of the row's class, nulls aside."""
    copies = signed.groupBy("_node").agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_size"))
    known = copies.join(labels.select(F.col("node").alias("_node"), "label"), "_node", "left").withColumn("label", F.coalesce("label", "_node"))
    groups = known.groupBy("label").agg(F.min("_least").alias("class_id"), F.sum("_size").alias("class_size"))
    named = known.select("_node", "label").join(groups, "label").select("_node", "class_id", "class_size")
    return salted_join(signed.select("_id", "_key", "_node", "_n"), named, ["_node"], "inner", spread_by=["_id", "_key"])
