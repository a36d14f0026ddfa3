"""The approximate index and the thresholded self join against all pairs."""

import random

import numpy as np
import pytest

from tastegrid.operators import lsh, pairs, similarity
from tastegrid.operators.blocks import Vectors
from tastegrid.operators.grid import best_matches
from tastegrid.plans import catalog

TESTDATA = "/root/testdata"
RNG = random.Random(17)


def sparse(spark, texts):
    """(id, terms, weights) of word counts; ids in steps of 3."""
    rows = []
    for i, text in enumerate(texts):
        counts = {w: float(text.split().count(w)) for w in text.split()}
        rows.append((3 * i, list(counts), list(counts.values())))
    return spark.createDataFrame(rows, "id bigint, terms array<string>, weights array<double>")


def texts(n):
    base = [" ".join(f"w{RNG.randrange(300)}" for _ in range(30)) for _ in range(n // 6)]
    out = []
    for b in base:
        for _ in range(5):
            words = b.split()
            for _ in range(RNG.randrange(0, 6)):
                words[RNG.randrange(len(words))] = f"x{RNG.randrange(50)}"
            out.append(" ".join(words))
    return out + out[:10] + [base[0]] * 40 + ["", "alone", "one one one", "one"]


def cosines(rows):
    vectors = [dict(zip(r.terms, r.weights)) for r in rows]
    norms = [sum(w * w for w in v.values()) ** 0.5 for v in vectors]
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors):
            dot = sum(w * b.get(t, 0.0) for t, w in a.items())
            yield rows[i].id, rows[j].id, dot / (norms[i] * norms[j]) if dot else 0.0


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_pairs_are_those_of_all_pairs(spark, monkeypatch, threshold):
    monkeypatch.setattr(pairs, "SIDE", 3)  # terms with more vectors than a side
    table = sparse(spark, texts(90)).repartition(5)
    rows = table.collect()
    first, seen = {}, {}
    for r in sorted(rows, key=lambda r: r.id):
        first[r.id] = seen.setdefault(tuple(sorted(zip(r.terms, r.weights))), r.id)
    assert {r.id: r.vector_id for r in pairs.members(table).collect()} == first
    single = set(first.values())
    want = {(a, b): s for a, b, s in cosines(rows) if a < b and {a, b} <= single and round(s, 6) >= threshold}
    got = {(r.id, r.other_id): r.similarity for r in pairs.similar_pairs(table, threshold).collect()}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 2e-6 for p in want)


def test_members_digest_every_vector_once(spark):
    """Digests are grouped and looked up: both read what was stored, neither sorts the vectors again."""
    rows = [(5, ["b", "a"], [2.0, 1.0]), (3, ["a", "b"], [1.0, 2.0]), (7, ["a", "b"], [2.0, 1.0]), (8, ["a", "b"], [1.0, None]),
            (9, ["a", "b"], [1.0, None]), (10, [], []), (11, [], []), (12, None, None), (13, ["a\",\"b"], [1.0]), (14, [None, "a"], [1.0, 2.0]),
            (15, ["a", None], [2.0, 1.0]), (16, ["a"], [0.1 + 0.2]), (17, ["a"], [0.3])]
    found = pairs.members(spark.createDataFrame(rows, "id bigint, terms array<string>, weights array<double>"))
    assert {r.id: r.vector_id for r in found.collect()} == {
        3: 3, 5: 3, 7: 7, 8: 8, 9: 8, 10: 10, 11: 10, 13: 13, 14: 14, 15: 14, 16: 16, 17: 17}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan and "arrays_zip" not in plan


def test_pairs_of_documents_agree_with_the_grid(spark):
    d = catalog.Domain(spark, f"{TESTDATA}/sf0.01")
    vectors = catalog.materialize(similarity.term_vectors(d.document_weights, "doc_id"))
    single = {r.vector_id for r in pairs.members(vectors).collect()}
    n = vectors.count()
    every = best_matches(vectors, vectors, n, n_queries=n, n_items=n, terms="terms", skip_same_id=True).filter("similarity >= 0.8")
    want = {(r.query_id, r.item_id, r.similarity) for r in every.collect() if r.query_id < r.item_id and {r.query_id, r.item_id} <= single}
    assert want and {tuple(r) for r in pairs.similar_pairs(vectors, 0.8).collect()} == want


def test_vectors_without_a_common_prefix_never_meet(spark):
    """A term that all vectors share is behind the prefix of those that have enough else."""
    table = sparse(spark, [f"all a{i} b{i} c{i} d{i // 2} e{i // 2}" for i in range(60)])
    indexed = pairs._indexed(table, 0.9).collect()
    assert all(len(r.terms) == 6 and len(r.prefix) <= 2 for r in indexed)
    assert pairs.similar_pairs(table, 0.9).count() == 0
    plan = pairs.similar_pairs(table, 0.9)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_pairs_of_nothing(spark):
    assert pairs.similar_pairs(sparse(spark, []), 0.5).collect() == []


@pytest.mark.parametrize("terms", [True, False])
def test_index_finds_near_neighbours_exactly_scored(spark, monkeypatch, terms):
    monkeypatch.setattr(lsh, "SIDE", 16)  # buckets of copies are split
    if terms:
        table = sparse(spark, [t for t in texts(240) if t]).repartition(3)
    else:
        rng = np.random.default_rng(2)
        centre = rng.normal(size=(20, 12))
        rows = np.concatenate([c + rng.normal(0, 0.15, (10, 12)) for c in centre] + [centre[:1]] * 60)
        table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "id bigint, weights array<double>")
    n = table.count()
    exact = best_matches(table, table, 5, n_queries=n, n_items=n, terms="terms" if terms else None, skip_same_id=True).collect()
    found = lsh.near_matches(table, table, 5, terms=terms, tables=12, signs=5, skip_same_id=True).collect()
    truth = {}
    for r in exact:
        truth.setdefault(r.query_id, []).append(r.similarity)
    close = {q: [s for s in v if s >= 0.8] for q, v in truth.items()}
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append(r.similarity)
    assert all(len(v) == len(set((r.item_id for r in found if r.query_id == q))) for q, v in list(got.items())[:20])
    right = sum(sum(a >= b - 1e-6 for a, b in zip(sorted(got.get(q, []), reverse=True), sorted(v, reverse=True))) for q, v in close.items())
    assert right >= 0.95 * sum(map(len, close.values()))
    assert all(s <= truth[q][0] + 1e-6 for q, v in got.items() for s in v)


@pytest.mark.parametrize("name, key", [("knn_lsh", "doc_id"), ("knn_lsh_dense", "vec_id")])
def test_registered_search_has_recall(spark, name, key):
    """Against all pairs, for every row whose id is divisible by 20."""
    queries = catalog.registered()
    exact = queries[name.replace("_lsh_dense", "_dense_topk").replace("knn_lsh", "knn_topk")](spark, f"{TESTDATA}/sf0.01").collect()
    truth = {(r[key], r.neighbor_id): r.similarity for r in exact if r[key] % 20 == 0}
    got = {(r[key], r.neighbor_id): r.similarity for r in queries[name](spark, f"{TESTDATA}/sf0.01").collect()}
    assert {a for a, _ in got} == {a for a, _ in truth}
    assert sum(p in got for p in truth) >= 0.9 * len(truth)
    assert all(abs(got[p] - truth[p]) < 2e-6 for p in truth if p in got)


def test_index_of_nothing(spark):
    none = spark.createDataFrame([], "id bigint, weights array<double>")
    some = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 0.0])], "id bigint, weights array<double>")
    assert lsh.near_matches(none, some, 3).collect() == []
    assert lsh.near_matches(some, none, 3).collect() == []
    assert {(r.query_id, r.item_id, r.similarity) for r in lsh.near_matches(some.filter("id = 1"), some, 3, signs=1).collect()} >= {(1, 1, 1.0)}


def test_a_vector_is_sent_once_to_a_place_that_has_candidates_for_it(spark):
    """Not once under every term it shares: what is sent does not depend on how much two vectors have in common."""
    table = sparse(spark, [" ".join(f"t{j}" for j in range(60) if j != i % 60) + f" own{i}" for i in range(300)])
    blocks = pairs._weighted_blocks(table)
    n = blocks.count()
    found = pairs._candidates(pairs._indexed(blocks, 0.8, n, pairs._single(blocks)), 0.8, 4)
    sent = [len(Vectors(r.payload)) for r in pairs._shipped(blocks, found, n, n).collect()]
    assert n > 1 and sum(sent) == 299  # the last vector of the last block is only met there
    assert pairs.similar_pairs(blocks, 0.8).count() == 300 * 299 / 2
