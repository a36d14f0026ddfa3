import numpy as np
import pytest

from tastegrid.operators import grid, similarity, text


def brute_force(q, qid, m, mid, k, cosine=True, skip_same=False, exclude=(), digits=6):
    scores = q @ m.T
    if cosine:
        scale = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(m, axis=1)[None]
        scores = np.divide(scores, scale, out=np.zeros_like(scores), where=scale > 0)
    out = []
    for i, a in enumerate(qid):
        best = sorted((-round(scores[i, j], digits), b) for j, b in enumerate(mid)
                      if not (skip_same and a == b) and (a, b) not in exclude)[:k]
        out += [(a, r + 1, b, -s + 0.0) for r, (s, b) in enumerate(best)]
    return sorted(out)


def result(df):
    return sorted((r.query_id, r.rank, r.item_id, round(r.similarity, 6) + 0.0) for r in df.collect())


def close(got, expected):
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert np.allclose([g[3] for g in got], [e[3] for e in expected], atol=1.1e-6)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    dense = np.round(rng.normal(size=(150, 6)), 3)
    dense[10] = dense[11] = dense[12]  # copies: equal scores
    dense[20] = 0                      # zero vector
    return dense


def frame(spark, dense, ids, id_type="bigint"):
    return spark.createDataFrame(list(zip(ids, dense.tolist())), f"id {id_type}, weights array<double>")


def test_dense_neighbours(spark, vectors):
    ids = [3 * i + 1 for i in range(len(vectors))]
    df = frame(spark, vectors, ids)
    got = grid.best_matches(df, df, 5, n_queries=150, n_items=150, skip_same_id=True, row_bytes=2**20)
    close(result(got), brute_force(vectors, ids, vectors, ids, 5, skip_same=True))


def test_cells_do_not_change_the_result(spark, vectors, monkeypatch):
    ids = list(range(len(vectors)))
    df = frame(spark, vectors, ids)
    monkeypatch.setattr(grid, "grid_shape", lambda *_: (1, 1))
    one = result(grid.best_matches(df, df, 4, n_queries=150, n_items=150))
    monkeypatch.setattr(grid, "grid_shape", lambda *_: (7, 5))
    assert result(grid.best_matches(df, df, 4, n_queries=150, n_items=150)) == one


def test_inner_product_without_seen_items(spark, vectors, monkeypatch):
    users, items = vectors[:40], vectors[40:]
    uid, iid = list(range(40)), list(range(500, 500 + len(items)))
    seen = [(u, iid[(u * 5 + j) % len(items)]) for u in uid for j in range(u)]
    monkeypatch.setattr(grid, "grid_shape", lambda *_: (3, 4))
    got = grid.best_matches(
        frame(spark, users, uid, "int"), frame(spark, items, iid, "int"), 6, n_queries=40, n_items=110, cosine=False,
        exclude=spark.createDataFrame(seen, "query_id bigint, item_id bigint"))
    close(result(got), brute_force(users, uid, items, iid, 6, cosine=False, exclude=set(seen)))


def test_fewer_items_than_k(spark, vectors):
    df = frame(spark, vectors[:3], [1, 2, 3])
    got = grid.best_matches(df, df, 10, n_queries=3, n_items=3, skip_same_id=True)
    close(result(got), brute_force(vectors[:3], [1, 2, 3], vectors[:3], [1, 2, 3], 10, skip_same=True))


@pytest.mark.parametrize("score_block", [500, 2_000_000])
def test_sparse_cell(score_block, monkeypatch):
    """Frequent and rare terms, in small pieces and in one."""
    import pyarrow as pa

    monkeypatch.setattr(grid, "SCORE_BLOCK", score_block)
    rng = np.random.default_rng(5)
    dense = np.where(rng.random((70, 90)) < 0.06, rng.random((70, 90)), 0)
    dense[:, :4] = rng.random((70, 4))
    dense[7] = 0
    ids = rng.permutation(70)
    names = np.array([f"t{j}" for j in range(90)])
    terms = [names[row != 0].tolist() for row in dense] * 2
    weights = [row[row != 0].tolist() for row in dense] * 2
    cell = pa.table({
        "side": np.repeat([0, 1], 70), "id": np.tile(ids, 2), "other": pa.nulls(140, pa.int64()),
        "terms": pa.array(terms, pa.list_(pa.string())), "weights": pa.array(weights, pa.list_(pa.float64()))})
    got = grid.cell_matches(cell, 8, True, True, 6, True).to_pylist()
    expected = {(a, b): s for a, _, b, s in brute_force(dense, ids, dense, ids, 8, skip_same=True)}
    assert {(g["query_id"], g["item_id"]) for g in got} == set(expected)
    assert all(abs(expected[g["query_id"], g["item_id"]] - g["similarity"]) < 1.1e-6 for g in got)


def test_texts_and_target(spark):
    docs = spark.createDataFrame(
        [(1, "red fox"), (2, "red fox"), (3, "red hen"), (4, "Blue whale"), (5, None), (6, "fox fox hen")],
        "id int, text string")
    weights = text.tfidf(docs, "id", "text")
    near = similarity.nearest_texts(weights, "id", 2, 6).collect()
    first = {r.query_id: (r.item_id, r.similarity) for r in near if r["rank"] == 1}
    assert first[1] == (2, 1.0) and first[2] == (1, 1.0) and first[4] == (1, 0.0)
    target = spark.createDataFrame([(1,)], "id int")
    got = [(r.id, r.similarity) for r in similarity.similar_to_target(weights, target, "id", 3).collect()]
    assert got[0] == (1, 1.0) and got[1] == (2, 1.0)
    without = similarity.similar_to_target(weights, target, "id", 10, include_self=False).collect()
    assert [r.id for r in without][0] == 2 and len(without) == 5


def test_hashed_weights_agree_with_the_long_form(spark):
    """With more buckets than terms, hashed vectors hold the exact TF-IDF weights."""
    docs = spark.createDataFrame([(1, "a b b c"), (2, "b c d"), (3, "x y")], "id int, text string")
    hashed = text.sparse_entries(text.hashed_tfidf(docs, "text", buckets=1 << 18), "id", "features")
    ours = sorted((r.id, round(w, 9)) for r in hashed.collect() for w in r.weights)
    exact = sorted((r.id, round(r.tfidf, 9)) for r in text.tfidf(docs, "id", "text").collect())
    assert ours == exact


def test_absent_and_unequal_vectors(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [None, 1.0])], "id int, v array<double>")
    got = result(similarity.nearest_vectors(df, "id", "v", 3, 5))
    assert got == [(1, 1, 2, 0.707107), (2, 1, 1, 0.707107)]
    short = df.filter("id < 3").union(spark.createDataFrame([(6, [1.0])], df.schema))
    with pytest.raises(Exception, match="vectors of lengths"):
        similarity.nearest_vectors(short, "id", "v", 3, 3).collect()


def test_wanted_documents_have_the_same_lists(spark):
    docs = spark.createDataFrame([(i, " ".join(f"t{i * j % 7}" for j in range(1, 5))) for i in range(12)], "id int, text string")
    weights = text.tfidf(docs, "id", "text")
    every = result(similarity.nearest_texts(weights, "id", 3, 12))
    some = result(similarity.nearest_texts(weights, "id", 3, 12, wanted=docs.filter("id % 4 = 1").select("id")))
    assert some == [r for r in every if r[0] % 4 == 1] and some


@pytest.mark.parametrize("include_self", [True, False])
def test_target_from_texts_equals_target_from_weights(spark, include_self):
    texts = ["a b b c", "b c d", "", None, "a b b c", "x y", "c c c a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string")
    weights = text.tfidf(df, "id", "t")
    for target in (0, 2, 5, 99):
        one = spark.createDataFrame([(target,)], "id bigint")
        expected = similarity.similar_to_target(weights, one, "id", 5, include_self).collect()
        assert similarity.similar_to_text(df, one, "id", "t", 5, include_self).collect() == expected
        assert similarity.similar_to_text(df, one, "id", "t", 5, include_self, listed=df.select("id")).collect() == expected
