"""Near-duplicate documents by ProbMinHash signatures, banding and exact verification.

A document is the multiset of its five-word shingles. Every shingle is a Poisson process whose rate is its weight and
whose points fall on the signature's slots; a slot keeps the shingle of its earliest point, so two signatures
agree in a slot with the probability Jaccard similarity of the weighted sets. A shingle's points stop as soon as they
come later than every slot's point. Equal shingle sets are one node. Nodes that share a band are candidates; candidates are
verified by the weighted Jaccard similarity of their shingles, 0.8 or more; connected nodes are a class. Within a band's bucket
no pairs are formed (``setlinks``).

A text without words equals only equal texts. Null texts count as empty. Rows with equal ids are one document that has all of
their texts; a null id is an id of its own. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.columns import ROW, packed
from tastegrid.llm.hashing import mix, shingles
from tastegrid.llm.setlinks import LOWEST, NODE, Sets, classed, link_classes, make_sets, over_texts
from tastegrid.operators.joins import salted_join
from tastegrid.session import materialize

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 32, 4   # a pair of similarity 0.8 is missed with probability 5e-8


def prob_minhash(text, values, weights, n_texts, slots=BANDS * ROWS):
    """Signatures (n_texts x slots) of weighted sets given as sorted (text, value, weight) triples.

    An element's points visit the slots in an order of its own without repeating one; the waiting time
    for the k-th of them grows accordingly, so an element has at most ``slots`` points.
    """
    best = np.full(n_texts * slots, np.inf)
    chosen = np.zeros(n_texts * slots, np.uint64)
    time = np.zeros(len(values))
    order = mix(values ^ np.uint64(0xA5A5A5A5))
    stride, begin = order >> np.uint64(32) | np.uint64(1), order & np.uint64(0xFFFFFFFF)
    active = np.arange(len(values))
    for k in range(slots):
        if not len(active):
            break
        draw = mix(values[active] + np.uint64((k + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1))
        wait = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        time[active] += wait * (slots / (slots - k)) / weights[active]
        slot = (begin[active] + stride[active] * np.uint64(k)) % np.uint64(slots)
        cell = text[active] * slots + slot.astype(np.int64)
        now = time[active]
        earlier = now < best[cell]
        np.minimum.at(best, cell[earlier], now[earlier])
        won = earlier & (best[cell] == now)
        chosen[cell[won]] = values[active][won]
        latest = best.reshape(n_texts, slots).max(axis=1)
        active = active[now < latest[text[active]]]
    return chosen.reshape(n_texts, slots)


def band_keys(signatures, bands=BANDS, rows=ROWS):
    """One 64-bit key per band: equal iff the band's slots are (up to hash collisions)."""
    grouped = signatures.reshape(len(signatures), bands, rows)
    key = mix(np.arange(bands, dtype=np.uint64) + np.uint64(1))[None, :].repeat(len(signatures), 0)
    for r in range(rows):
        key = mix(key ^ grouped[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
    return key.view(np.int64)


def multiset(data, offsets) -> Sets:
    """The shingles of every text, each occurrence an element: Jaccard similarity of these sets is the weighted one."""
    return make_sets(shingles(data, offsets, SHINGLE), len(offsets) - 1, counted=True)


def _signed(base: DataFrame) -> DataFrame:
    """(_id, _key, _node, _n, _sketch, _bands) for every row; a text without words has no bands."""
    def read(data, offsets, batch):
        found, n = shingles(data, offsets, SHINGLE), len(offsets) - 1
        sets = make_sets(found, n, counted=True)
        keys = band_keys(prob_minhash(found[0], found[1], found[2].astype(np.float64), n))
        # Texts without words are equal only as texts.
        node = np.where(sets.sizes > 0, sets.nodes(), np.maximum(batch.column(1).to_numpy(), LOWEST + 1))
        bands = pa.array([k if s else None for k, s in zip(keys, sets.sizes)], pa.list_(pa.int64()))
        return batch.column(0), batch.column(1), node, sets.sizes, sets.sketches(), bands

    return over_texts(base.select("_id", F.xxhash64("_text").alias("_key"), "_text"), read,
                      f"_id bigint, _key bigint, {NODE}, _bands array<bigint>")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, class_id, class_size): every id with the smallest id of its class; a null id counts as smallest."""
    base = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LOWEST)).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    signed = materialize(_signed(base))
    buckets = signed.select(F.explode("_bands").alias("bucket"), F.col("_node").alias("node"))
    # An id's several texts are linked without any comparison.
    several = signed.groupBy("_id").agg(F.min("_node").alias("y"), F.max("_node").alias("_high")).filter("y != _high").select("_id", "y")
    links = signed.select("_id", F.col("_node").alias("x")).join(several, "_id").filter("x != y").select("x", "y").distinct()
    labels = link_classes(signed, buckets, base, multiset, percent, links)
    ids = classed(signed, labels).groupBy("_id").agg(F.min("class_id").alias("class_id"))
    sizes = ids.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size"))
    null = lambda c: F.when(F.col(c) != LOWEST, F.col(c))
    return salted_join(ids, sizes, ["class_id"], "inner", spread_by=["_id"]).select(
        null("_id").alias(id_col), null("class_id").alias("class_id"), "class_size")


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of near-duplicate texts, with its columns as they are; empty texts are a class like any other.

    Classes are made of texts (64 bits of hash), not of ids, which may be repeated or null. The row of smallest id stays, null
    first, then of smallest text hash, then of smallest hash of the other columns; rows equal in all of that are one.
    """
    others = [F.col(c) for c in docs.columns if c not in (id_col, text_col)]
    keyed = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LOWEST)).alias("_id"),
        F.greatest(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.lit(LOWEST + 1)).alias("_key"),  # LOWEST is a null id
        F.xxhash64(*others, *(F.col(c).isNull() for c in docs.columns)).alias("_row"), F.col(text_col).alias("_text"), packed(docs, [text_col]))
    classes = near_classes(keyed.select("_key", "_text"), "_key", "_text")
    least = keyed.groupBy("_key").agg(F.min(F.struct("_id", "_row")).alias("_least"))
    first = least.join(classes, "_key").groupBy("class_id").agg(
        F.min(F.struct("_least._id", "_key", "_least._row")).alias("_first")).select("_first.*")
    keys = ["_id", "_key", "_row"]
    return keyed.join(first, keys, "left_semi").dropDuplicates(keys).select(
        *(F.col("_text").alias(c) if c == text_col else F.col(ROW)[c].alias(c) for c in docs.columns))
