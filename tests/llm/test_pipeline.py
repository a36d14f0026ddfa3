"""The pipeline and its dedup stages against brute force on small inputs."""

import random

import corpus_pipeline
import pytest

RNG = random.Random(11)
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sentence(n):
    return " ".join(f"w{RNG.randrange(10**6)}" for _ in range(n))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], SCHEMA)


@pytest.fixture
def copies():
    """(rows, groups): ids of exact copies, of originally empty texts and of unique texts, in mixed order."""
    texts = ["\n".join(sentence(12) for _ in range(3)) for _ in range(6)] + [sentence(10) + "\n\n\n" + sentence(10)]
    groups, ids = {}, list(range(200))
    RNG.shuffle(ids)
    for k, text in enumerate([*texts, "", None]):
        for _ in range(12 if k % 2 else 2):
            groups.setdefault(text or "", []).append(ids.pop())
    for _ in range(30):
        groups[sentence(30)] = [ids.pop()]
    return [(i, t) for t, own in groups.items() for i in own], groups


def test_exact_copies_leave_one_document(spark, copies):
    rows, groups = copies
    lined = corpus_pipeline.dedup_lines(spark, documents(spark, rows), "")
    out = corpus_pipeline.dedup_documents(spark, lined, "").collect()
    assert sorted(r.doc_id for r in out) == sorted(min(own) for own in groups.values())
    again = corpus_pipeline.dedup_documents(spark, documents(spark, rows), "").collect()  # also without the stage before
    assert sorted(r.doc_id for r in again) == sorted(min(own) for own in groups.values())


def test_run_returns_no_later_copy(spark, copies, tmp_path):
    rows, groups = copies
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 0, 0) for i, _ in rows], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, sentence(30))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert len(found) == len(set(found)) and set(found) <= {min(own) for own in groups.values()}
    assert len(found) > len(groups) // 3


def test_repeated_and_null_ids_are_classed_by_text(spark):
    def near(text):
        return text + " end"

    a, b, c, d, e, f = (sentence(60) for _ in range(6))
    rows = [(3, a), (7, near(a)), (7, b), (9, near(b)), (None, c), (None, c), (12, near(c)), (None, d), (5, e), (5, e), (5, f),
            (None, ""), (None, None), (1, "")]
    out = corpus_pipeline.dedup_documents(spark, documents(spark, rows + [(4, None)]), "").collect()
    left = sorted(((r.doc_id, r.text or "") for r in out), key=repr)
    assert left == sorted([(3, a), (7, b), (None, c), (None, d), (5, e), (5, f), (None, "")], key=repr)
    hot = documents(spark, [(None, c)] * 500 + [(7, t) for t in (d, e, f)] * 3)
    assert sorted(r.text for r in corpus_pipeline.dedup_documents(spark, hot, "").collect()) == sorted([c, d, e, f])
