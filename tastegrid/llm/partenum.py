"""Jaccard join of word n-gram sets by PartEnum signatures.

Sets are put into bands of sizes such that two similar sets lie in one band or in neighbouring ones; every set gets the signatures
of its own band and of the next. In a band, similar sets differ in at most k elements. The domain of all shingles is cut into
n1 parts by a hash, so in at least one part they differ in at most ``OMITTED`` elements; that part is cut into ``CUTS``
smaller ones, of which all but ``OMITTED`` are equal in both sets. A signature is the hash of what a set has in all smaller parts but
``OMITTED`` of a part, one for every choice. So two similar sets have a signature in common, always; nothing is left to chance.

Sets that share a signature are linked if 100 * intersection >= percent * union (``setlinks``: exact, no pairs within a group).

Defined cases: a null or empty text, or one without words, has an empty set, is linked with nothing and is a component of its
own, whose id is its own. Equal sets are linked. Rows with one id are rows of their own. A null id is not the smallest of
its component; a component of null ids alone has a null id. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.hashing import LOWER, WHITE, mix, shingles
from tastegrid.llm.setlinks import NODE, Sets, classed, link_classes, make_sets, over_texts
from tastegrid.session import materialize

SHINGLE = 4
PERCENT = 85
OMITTED, CUTS = 1, 3
LARGEST = 1 << 40      # of a set
NO_ID = (1 << 63) - 1  # stands for a null id: after all others


def reader(k: int = SHINGLE):
    """Sets of distinct k-word shingles; words are separated by ASCII white space and A-Z is lower-cased."""
    def read(data, offsets) -> Sets:
        return make_sets(shingles(data, offsets, k, lambda x: LOWER[x], WHITE), len(offsets) - 1, counted=False)

    return read


def band_tops(percent: int) -> np.ndarray:
    """The largest size of every band: a set of size s is similar to none of more than s * 100 / percent elements."""
    tops = [0]
    while tops[-1] < LARGEST:
        tops.append((tops[-1] + 1) * 100 // percent)
    return np.array(tops[1:], np.int64)


def signatures(sets: Sets, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, signature) of all non-empty sets; none at 100 percent, where only equal sets are similar, which are one node."""
    if percent >= 100:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tops, sizes = band_tops(percent), sets.sizes
    spread = mix(sets.values ^ np.uint64(0x2545F4914F6CDD1D))
    texts, found = [], []
    for step in (0, 1):
        band = np.searchsorted(tops, sizes) + step
        most = (100 - percent) * 2 * tops[band] // (100 + percent)     # elements by which similar sets of the band differ
        parts = np.where(sizes > 0, -(-(most + 1) // (OMITTED + 1)), 0)
        begin = np.cumsum(parts) - parts
        cell = ((spread >> np.uint64(32)) * (parts[sets.owner] * CUTS).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(int(parts.sum()) * CUTS, np.uint64)
        np.add.at(sums, begin[sets.owner] * CUTS + cell, spread)
        sums = sums.reshape(-1, CUTS)
        text = np.repeat(np.arange(len(sizes)), parts)
        place = (np.arange(len(text)) - begin[text]).astype(np.uint64)
        salt = mix(band[text].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place)
        whole = sums.sum(axis=1, dtype=np.uint64)
        none = most[text] == 0  # only equal sets are similar: one signature of everything
        for choice, left_out in enumerate(combinations(range(CUTS), OMITTED)):
            taken = whole - np.where(none, np.uint64(0), sums[:, list(left_out)].sum(axis=1, dtype=np.uint64))
            keep = ~none if choice else np.ones(len(text), bool)
            texts.append(text[keep])
            found.append(mix(mix(taken) + salt + np.uint64(choice))[keep])
    return np.concatenate(texts), np.concatenate(found).view(np.int64)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, component_size) for every row: the smallest id that its links lead to."""
    base = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    read = reader(k)

    def describe(data, offsets, batch):
        sets = read(data, offsets)
        return batch.column(0), batch.column(1), sets.nodes(), sets.sizes, sets.sketches()

    def sign(data, offsets, batch):
        sets = read(data, offsets)
        text, signature = signatures(sets, percent)
        return signature, sets.nodes()[text]

    signed = materialize(over_texts(base.select("_id", F.xxhash64("_text").alias("_key"), "_text"), describe, f"_id bigint, _key bigint, {NODE}"))
    some = signed.filter("_n > 0")
    labels = link_classes(some, over_texts(base.select("_text"), sign, "bucket bigint, node bigint"), base, read, percent)
    out = classed(some, labels).unionByName(signed.filter("_n = 0").select(
        "_id", "_key", "_node", "_n", F.col("_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size")))
    given = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(given("_id").alias(id_col), F.col("_n").alias("n_shingles"), given("class_id").alias("component_id"),
                      F.col("class_size").alias("component_size"))
