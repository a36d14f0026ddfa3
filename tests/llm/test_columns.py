"""The caller's columns survive every operator and stage, whatever they are called; the field's gradient is exact."""

import itertools

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegrid.llm import decontaminate, lines, mixing, toxicity

NAMES = ["tox_score", "tox_tokens", "_text", "_t", "_row", "_document", "matches", "_matches0", "n_lines", "lines_removed", "_gone", "_others",
         "_h", "_id", "_key", "copies", "n_tokens", "_sum", "_bucket", "_epochs", "_rest", "_before", "_text_hash", "bucket", "_node", "_n"]


@pytest.fixture
def docs(spark):
    rows = [(i, f"line {i} one two three four five six seven eight\nown words number {i} and {i * 7} here {i * 11}", "en", "web", 5) for i in range(12)]
    base = spark.createDataFrame(rows + [(None, None, None, None, None), (20, "", "en", "web", 0)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return base.withColumns({n: F.concat(F.lit(f"{n} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for n in NAMES})


def untouched(out, names):
    rows = out.collect()
    assert rows
    for r in rows:
        i = "none" if r.doc_id is None else r.doc_id
        assert all(r[n] == f"{n} of {i}" for n in names)
    return rows


def test_operators_keep_columns(spark, docs):
    benchmark = spark.createDataFrame([(1, "own words number 3 and 21 here 33 " * 3)], "item_id bigint, text string")
    untouched(toxicity.score(docs, None), [n for n in NAMES if n not in ("tox_score", "tox_tokens")])
    untouched(decontaminate.find_matches(docs, benchmark), [n for n in NAMES if n != "matches"])
    untouched(lines.dedup_lines(docs), [n for n in NAMES if n not in ("n_lines", "lines_removed")])
    mixed = mixing.mix(docs, {"lang": F.col("lang")}, [F.lit(1.0)], F.sum("supply"), 1)
    untouched(mixed, [n for n in NAMES if n not in ("copies", "n_tokens")])


def test_stages_keep_columns(spark, docs, tmp_path):
    labels = [(i, 0, int(i % 3 == 0)) for i in range(12)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, "nothing like that")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        untouched(out, NAMES)
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_pair_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(4)
    lengths = [1, 6, 3]
    first = np.concatenate(([0], np.cumsum(lengths)))
    energy, transition = rng.normal(0, 1.5, first[-1]), rng.normal(0, 1, (2, 2))
    p, forward, backward = toxicity.sweeps(energy, first, transition, width=4)
    for a, n in zip(first, lengths):
        weight = {}
        for path in itertools.product((0, 1), repeat=n):
            weight[path] = np.exp(sum(energy[a + t] * s for t, s in enumerate(path)) + sum(transition[x, y] for x, y in zip(path, path[1:])))
        total = sum(weight.values())
        for t in range(n):
            assert np.isclose(p[a + t], sum(w for s, w in weight.items() if s[t]) / total)
        for t in range(1, n):
            joint = toxicity.pair_marginals(forward, backward, transition, np.array([a + t]))[:, 0]
            want = [sum(w for s, w in weight.items() if (s[t - 1], s[t]) == pair) / total for pair in itertools.product((0, 1), repeat=2)]
            assert np.allclose(joint, want)
