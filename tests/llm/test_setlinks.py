"""The set joins (PartEnum, ProbMinHash) and their shared machinery against all pairs."""

import random
import re

import numpy as np
import pytest

from llm_samples import HARD
from tastegrid.llm import minhash, partenum, setlinks

RNG = random.Random(31)


def words(n, vocabulary=400):
    return [f"w{RNG.randrange(vocabulary)}" for _ in range(n)]


def shingle_set(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def linked(a, b, percent):
    return bool(a) and 100 * len(a & b) >= percent * len(a | b)


def expected(rows, k, percent):
    """(id, set size, component id, component size) of every row, from all pairs."""
    sets, label = [shingle_set(t, k) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j], percent):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    least = lambda c: min((rows[i][0] for i in range(len(rows)) if label[i] == c and rows[i][0] is not None), default=None)
    return sorted((repr(i), len(s), repr(least(c)), label.count(c)) for (i, _), s, c in zip(rows, sets, label))


def family(n, length, most):
    base, out = words(length, 10**6), []
    for _ in range(n):
        text = list(base)
        for _ in range(RNG.randrange(0, most + 1)):
            text[RNG.randrange(len(text))] = words(1, 10**6)[0]
        out.append(" ".join(text[RNG.randrange(0, 3):]))
    return out


@pytest.mark.parametrize("k, percent", [(4, 85), (2, 60), (1, 100)])
def test_components_are_those_of_all_pairs(frame, monkeypatch, k, percent):
    monkeypatch.setattr(setlinks, "SIDE", 5)  # buckets of more members than a side
    texts = [*HARD, "A  b\tC d e", "a b c d e", "a b", "b a", "a b\n", *family(40, 120, 6), *family(15, 60, 3), *family(9, 14, 1), *family(30, 12, 2)]
    texts += [" ".join(words(RNG.randrange(1, 12), 3)) for _ in range(60)]
    rows = list(enumerate(texts)) + [(None, texts[20]), (None, "null alone"), (None, "null alone"), (3, texts[21]), (3, texts[21]), (None, None)]
    out = partenum.jaccard_components(frame(rows), k=k, percent=percent).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id), r.component_size) for r in out) == expected(rows, k, percent)


def test_join_of_little(frame):
    assert partenum.jaccard_components(frame([])).collect() == []
    assert [tuple(r) for r in partenum.jaccard_components(frame([(4, None)])).collect()] == [(4, 0, 4, 1)]


def test_similar_sets_share_a_signature():
    """At every size, for sets that are just similar enough: the scheme leaves nothing to chance."""
    rng = np.random.default_rng(8)
    for percent in (60, 85, 95):
        for _ in range(150):
            common = int(rng.integers(1, 3000))
            extra = (100 * common // percent) - common  # elements that only one of the two has
            left = int(rng.integers(0, extra + 1))
            values = rng.integers(0, 1 << 63, common + extra, dtype=np.uint64)
            a, b = np.sort(np.concatenate((values[:common], values[common:common + left]))), np.sort(np.concatenate((values[:common], values[common + left:])))
            assert 100 * common >= percent * (common + extra)
            sets = setlinks.Sets(np.repeat([0, 1], [len(a), len(b)]), np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
            text, found = partenum.signatures(sets, percent)
            assert set(found[text == 0]) & set(found[text == 1])
            x, y = sets.sketches()
            size = min(len(x), len(y))
            assert np.bitwise_count(setlinks.folded(x, size) ^ setlinks.folded(y, size)).sum() <= extra
            assert setlinks.similar(*sets.bodies(), percent)


@pytest.mark.parametrize("most", [1 << 21, 60])
def test_components_of_chains_and_stars(spark, monkeypatch, most):
    monkeypatch.setattr(setlinks, "EDGES", most)  # of one task
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5001), (5001, 5000), (7, 7)]
    RNG.shuffle(edges)
    out = {r.node: r.label for r in setlinks.components(spark.createDataFrame(edges, "x bigint, y bigint").repartition(7)).collect()}
    assert out == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1200)}, 5000: 5000, 5001: 5000}
    assert setlinks.components(spark.createDataFrame([], "x bigint, y bigint")).collect() == []


def test_near_classes_of_repeated_and_null_ids(frame):
    a, b, c = (" ".join(words(40, 10**6)) for _ in range(3))
    rows = [(1, a), (2, a + " end"), (2, b), (3, b), (None, c), (None, "x"), (4, c), (5, None), (6, ""), (7, " "), (8, a), (8, a)]
    out = {r.doc_id: (r.class_id, r.class_size) for r in minhash.near_classes(frame(rows)).collect()}
    assert out == {1: (1, 4), 2: (1, 4), 3: (1, 4), 8: (1, 4), None: (None, 2), 4: (None, 2), 5: (5, 2), 6: (5, 2), 7: (7, 1)}
    hot = frame([(None, c)] * 200 + [(i, a) for i in range(200)])
    assert sorted((repr(r.doc_id), repr(r.class_id), r.class_size) for r in minhash.near_classes(hot).collect()) == sorted(
        [("None", "None", 1)] + [(repr(i), "0", 200) for i in range(200)])
