"""Importance resampling and centroid clustering against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException

from llm_samples import HARD
from tastegrid.llm import clusters, resampling

RNG = random.Random(21)


def runs(text, n):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(found), [" ".join(found[i:i + k]) for k in range(1, n + 1) for i in range(len(found) - k + 1)]


def drawn(rows, target, percent, seed, least, n, buckets):
    """rank by row number, and (n_features, weight, score) of every row."""
    place = lambda f: zlib.crc32(f.encode()) % buckets
    features = [runs(t, n) for _, t in rows]
    have, want = Counter(place(f) for _, fs in features for f in fs), Counter(place(f) for t in target for f in runs(t, n)[1])
    s, t = have.total(), want.total()
    gain = lambda b: math.floor(1000 * math.log((want[b] + 1) * (s + buckets) / ((have[b] + 1) * (t + buckets))))
    out = []
    for (i, _), (words, fs) in zip(rows, features):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(place(f)) for f in fs)
        out.append((words, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    open_ = [r for r in range(len(rows)) if out[r][0] >= least]
    order = sorted(open_, key=lambda r: (-out[r][3], rows[r][0] is None, rows[r][0] or 0))
    return {r: k + 1 for k, r in enumerate(order[:len(open_) * percent // 100])}, out


def test_crc_of_spans():
    data = np.frombuffer(bytes(RNG.randrange(256) for _ in range(5000)), np.uint8)
    starts = np.array([RNG.randrange(4000) for _ in range(300)])
    ends = starts + np.array([RNG.choice([0, 1, 3, 64, 65, 700]) for _ in range(300)])
    assert [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)] == resampling.crc32_spans(data, starts, ends).tolist()


@pytest.mark.parametrize("n, percent, least", [(1, 30, 1), (3, 50, 2)])
def test_resample_is_brute_force(spark, frame, n, percent, least):
    vocabulary = [f"{a}{b}" for a in "abcdeÉfgXyz" for b in range(9)]
    texts = [*HARD, *(" ".join(RNG.choices(vocabulary, k=RNG.randrange(0, 40))) for _ in range(60))]
    rows = list(enumerate(texts)) + [(None, texts[20]), (30, texts[30]), (30, texts[30]), (31, "A-b  c9_É.x")]
    target = [" ".join(RNG.choices(vocabulary[:30], k=30)) for _ in range(8)] + [None, ""]
    ranks, facts = drawn(rows, target, percent, 9, least, n, 500)
    expected = sorted((repr(i), *facts[r], ranks.get(r) or 0) for r, (i, _) in enumerate(rows))
    out = resampling.resample(frame(rows), frame(target), percent, 9, least_words=least, max_n=n, buckets=500, keep=True)
    assert sorted((repr(r.doc_id), r.n_words, r.n_features, r.weight, r.score, r["rank"] or 0) for r in out.collect()) == expected
    assert sorted(repr(r.document.doc_id) + repr(r.document.node) for r in out.collect()) == sorted(repr(i) + "'y'" for i, _ in rows)


def test_resample_of_little(frame):
    assert resampling.resample(frame([]), frame(["a"]), 10, 1).collect() == []
    few = resampling.resample(frame([(1, "a b"), (2, None)]), frame([]), 100, 1, least_words=1).collect()
    assert {r.doc_id: r["rank"] for r in few} == {1: 1, 2: None}
    assert {r["rank"] for r in resampling.resample(frame([(1, "a b"), (2, "c")]), frame(["a"]), 40, 1, least_words=1).collect()} == {None}
    copies = resampling.resample(frame([(5, "a b")] * 60 + [(i, "c d") for i in range(60)]), frame(["a"]), 50, 1, least_words=2)
    assert sorted(r["rank"] for r in copies.collect() if r["rank"]) == list(range(1, 61))  # one group of equal rows is split exactly


def test_kth_key_with_ties(spark):
    rows = sorted((RNG.choice([1, 1, 1, 2, 7, -3]), i) for i in range(500))
    table = spark.createDataFrame(rows, "a bigint, b bigint").repartition(5)
    for k in (1, 2, 250, 499, 500):
        assert tuple(resampling.kth_key(table, ["a", "b"], k, pivots=3)) == rows[k - 1]
    assert resampling.kth_key(table, ["a", "b"], 501) is None
    assert resampling.kth_key(table.filter("a > 100"), ["a", "b"], 1) is None


def clustered(rows, dims, k, rounds, seed, scale):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:k]]

    def place():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        at = place()
        for c in range(len(centroids)):
            if own := [v for (_, v), (o, _) in zip(kept, at) if o == c]:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    at = place()
    total = Counter()
    for c, d in at:
        total[c] += d
    return sorted((repr(i), c, d, total[c], sum(total.values()),
                   hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for (i, _), (c, d) in zip(kept, at))


@pytest.mark.parametrize("k, pivots", [(7, 4), (3, 16), (90, 5), (1, 1)])
def test_clusters_are_brute_force(spark, k, pivots):
    centre = [[RNG.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [x + RNG.gauss(0, 0.3) for x in RNG.choice(centre)]) for i in range(60)]
    rows += [(100 + i, centre[0]) for i in range(20)] + [(3, centre[1]), (3, centre[2]), (None, centre[3]), (None, centre[3])]
    rows += [(200, None), (201, []), (202, [1.0] * 5), (203, [1.0] * 5 + [None]), (204, [float("nan")] + [0.0] * 5), (205, [float("inf")] * 6)]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, cluster int, _v int")
    out = clusters.cluster_vectors(table.repartition(4), dims=6, k=k, rounds=3, seed=4, scale=16, pivots=pivots)
    assert sorted((repr(r[0]), *r[1:]) for r in out.collect()) == clustered(rows, 6, k, 3, 4, 16)


def test_clusters_of_little(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert clusters.cluster_vectors(empty, dims=3, k=2, rounds=1, seed=1).collect() == []
    huge = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(PySparkException, match="after scaling"):
        clusters.cluster_vectors(huge, dims=2, k=2, rounds=1, seed=1).collect()


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(3)
    centre = rng.normal(0, 60, (30, 64))
    vectors = np.floor(np.concatenate([c + rng.normal(0, 9, (40, 64)) for c in centre])).astype(np.int64)
    centroids = vectors[::40]
    simplex = clusters.span_simplex(centroids, 16)
    apexes, own = simplex.apexes(vectors), simplex.apexes(centroids)
    true = ((vectors[:, None] - centroids) ** 2).sum(axis=2)
    flat = ((apexes[:, None, :-1] - own[:, :-1]) ** 2).sum(axis=2)
    assert (flat + (apexes[:, -1:] - own[:, -1]) ** 2 <= true * (1 + 1e-9) + 1e-3).all()
    assert (flat + (apexes[:, -1:] + own[:, -1]) ** 2 >= true * (1 - 1e-9) - 1e-3).all()
    cluster, distance, compared = clusters.nearest(vectors, apexes, centroids, simplex)
    assert (cluster == true.argmin(axis=1)).all() and (distance == true.min(axis=1)).all()
    assert compared < len(vectors) * len(centroids) / 3  # pruned by the bounds alone
    same = np.repeat(vectors[:1], 9, axis=0)  # pivots that span nothing
    assert clusters.nearest(same, clusters.span_simplex(same).apexes(same), same, clusters.span_simplex(same))[0].tolist() == [0] * 9
