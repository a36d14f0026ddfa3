"""The stored feature pipeline, and the neighbours made from its vectors against brute force."""

import numpy as np

from tastegrid.operators import text
from tastegrid.plans import catalog


def fitted(domain):
    texts = catalog.materialize(domain.movie_text.join(domain.movies.select("movieId", "genre_name"), "movieId").fillna(
        {"genre_name": "Unknown"}))
    return texts, text.content_pipeline("combined_features", "genre_name").fit(texts)


def vectors(model, texts):
    return {r.movieId: r.features.toArray() for r in model.transform(texts).select("movieId", "features").collect()}


def test_same_vectors_after_loading(spark, sf_dir, tmp_path):
    texts, model = fitted(catalog.Domain(spark, sf_dir))
    path = str(tmp_path / "features")
    text.store_pipeline(model, path)
    text.store_pipeline(model, path)  # a second run replaces the first
    again = text.stored_pipeline(path)
    before, after = vectors(model, texts), vectors(again, texts)
    assert before and before.keys() == after.keys() and all((before[m] == after[m]).all() for m in before)
    unseen = spark.createDataFrame([(1, "words never seen before", "NO SUCH GENRE")], "movieId bigint, combined_features string, genre_name string")
    assert (vectors(model, unseen)[1] == vectors(again, unseen)[1]).all()


def test_assembled_neighbours_are_brute_force(spark, sf_dir):
    texts, model = fitted(catalog.Domain(spark, sf_dir))
    found = vectors(model, texts)
    ids = sorted(found)
    dense = np.array([found[i] for i in ids])
    norms = np.linalg.norm(dense, axis=1)
    scale = norms[:, None] * norms
    cosine = np.divide(dense @ dense.T, scale, out=np.zeros_like(scale), where=scale > 0)
    np.fill_diagonal(cosine, -np.inf)
    got = {}
    for r in catalog.registered()["knn_assembled"](spark, sf_dir).collect():
        got.setdefault(r.movieId, []).append((r.rank, r.neighbor_id, r.similarity))
    assert sorted(got) == ids
    for row, i in enumerate(ids):
        listed = sorted(got[i])
        best = np.sort(cosine[row])[::-1][:len(listed)]
        assert [r for r, _, _ in listed] == list(range(1, catalog.K + 1)) and np.allclose([s for _, _, s in listed], best, atol=2e-6)
        assert all(abs(cosine[row, ids.index(n)] - s) < 2e-6 for _, n, s in listed)
