"""Packed blocks: what they hold, and neighbours whose disk does not grow with the number of blocks."""

import collections
import math

import numpy as np

from tastegrid.operators import blocks, similarity, text
from tastegrid.operators.grid import best_matches

WORDS = [f"w{i % 37} w{i % 11} w{i % 5} all own{i}" for i in range(400)]


def documents(spark, more=()):
    rows = [(7 * i, t) for i, t in enumerate(WORDS)] + list(more)
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def nearest(weights, k):
    """{id: [(similarity, other id)]} by brute force."""
    norms = {d: math.sqrt(sum(w * w for w in v.values())) for d, v in weights.items()}
    out = {}
    for d, v in weights.items():
        found = []
        for e, u in weights.items():
            if e != d:
                dot = sum(w * u.get(t, 0.0) for t, w in v.items())
                found.append((-round(dot / (norms[d] * norms[e]), 6) if dot else 0.0, e))
        out[d] = [(-s + 0.0, e) for s, e in sorted(found)[:k]]
    return out


def tfidf(spark, df):
    out = collections.defaultdict(dict)
    for r in text.tfidf(df, "doc_id", "text").collect():
        out[r.doc_id][r.term] = r.tfidf
    return out


def listed(found):
    out = collections.defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.similarity, r.item_id))
    return out


def similar(got, want):
    return got.keys() == want.keys() and all(
        [e for _, e in got[d]] == [e for _, e in want[d]] and np.allclose([s for s, _ in got[d]], [s for s, _ in want[d]], atol=2e-6) for d in want)


def test_packed_arrays_come_back():
    arrays = {"a": np.arange(5), "b": np.array([0.1, -2.5]), "c": np.empty(0, np.int32)}
    back = blocks.unpacked(blocks.packed(**arrays))
    assert back.keys() == arrays.keys() and all(back[n].dtype == a.dtype and (back[n] == a).all() for n, a in arrays.items())


def test_nearest_documents_meet_in_blocks_without_a_shuffle(spark, monkeypatch):
    """Rows under one id are one document; an empty or null text has the empty term or none."""
    monkeypatch.setattr(blocks, "TEXT_BYTES", 700)  # more blocks than cores
    df = documents(spark, [(0, "w1 twice"), (9001, ""), (9002, None), (9003, "alone")])
    found = similarity.nearest_documents(df, "doc_id", "text", 4)
    assert similar(listed(found), nearest(tfidf(spark, df), 4))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "weights" not in plan
    assert found.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # the lists alone


def test_wanted_documents_are_the_only_ones_asked_about(spark, monkeypatch):
    monkeypatch.setattr(blocks, "TEXT_BYTES", 700)
    df = documents(spark)
    wanted = spark.createDataFrame([(7 * i,) for i in (3, 50, 50, 399)] + [(5,), (None,)], "doc_id bigint")
    found = similarity.nearest_documents(df, "doc_id", "text", 4, wanted=wanted)
    every = nearest(tfidf(spark, df), 4)
    assert similar(listed(found), {7 * i: every[7 * i] for i in (3, 50, 399)})
    assert found.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_sparse_vectors_meet_in_blocks_without_a_shuffle(spark, monkeypatch):
    """Ids may come twice or be null: every row is asked about, and lists of an id are of all its rows."""
    monkeypatch.setattr(blocks, "ROWS", 20)
    rows = [(i, [i % 7, 20 + i % 3], [1.0 + i % 2, 2.0]) for i in range(90)] + [(3, [3, 20], [2.0, 2.0]), (95, [], []), (96, None, None), (None, [500], [1.0])]
    table = spark.createDataFrame(rows, "id bigint, terms array<int>, weights array<double>")
    found = best_matches(table, table, 3, n_queries=94, n_items=94, terms="terms", skip_same_id=True)
    dense = np.zeros((len(rows), 501))
    for r, (_, terms, weights) in enumerate(rows):
        dense[r, terms or []] = weights or []
    norm = np.linalg.norm(dense, axis=1)
    cosine = np.divide(dense @ dense.T, np.outer(norm, norm), out=np.zeros((len(rows),) * 2), where=np.outer(norm, norm) > 0)
    got = collections.defaultdict(list)
    for r in found.collect():
        got[r.query_id].append((r.rank, r.similarity))
    assert got.keys() == {r[0] for r in rows}
    for i, (d, *_) in enumerate(rows[:90]):
        best = sorted(cosine[i][[e != d for e, *_ in rows]])[::-1]
        if d != 3:
            assert np.allclose([s for _, s in sorted(got[d])], best[:3], atol=2e-6)
    assert found.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
