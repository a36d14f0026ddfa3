"""Stored sketches against exact counts and ranks, within their stated errors."""

import numpy as np
import pytest

from tastegrid.operators import sketches


def test_distinct_counts_of_united_parts(spark):
    rows = [("few", i % 7) for i in range(400)] + [("many", i % 30_000) for i in range(60_000)] + [("none", None)] * 5
    table = spark.createDataFrame(rows, "g string, v bigint").repartition(6)
    parts = [table.filter("v % 3 = 0 or v is null"), table.filter("v % 3 = 1"), table.filter("v % 3 != 0")]  # parts may overlap
    state = sketches.distinct_merged(*(sketches.distinct_state(p, ["g"], "v") for p in parts), keys=["g"])
    got = {r.g: r.n_distinct for r in sketches.distinct_counts(state, ["g"]).collect()}
    assert got["few"] == 7 and got["none"] == 0
    assert abs(got["many"] / 30_000 - 1) < 4 * 1.04 / 2 ** (sketches.PRECISION / 2)


@pytest.mark.parametrize("values", [
    np.arange(20_000.0), np.full(20_000, 3.5), np.random.default_rng(1).pareto(1.1, 20_000), np.repeat([1.0, 2.0], [19_000, 1_000])])
def test_quantile_ranks(spark, values):
    table = spark.createDataFrame([(float(v),) for v in values] + [(None,)] * 10, "v double").repartition(5)
    halves = [table.filter("v <= 5000"), table.filter("v > 5000 or v is null")]
    state = sketches.quantile_merged(*(sketches.quantile_state(h, [], "v") for h in halves if h.filter("v is not null").count()), keys=[])
    shares = (0.01, 0.33, 0.5, 0.66, 0.99)
    found = sketches.quantiles_of(state, [], shares).first().quantiles
    ordered = np.sort(values)
    for share, v in zip(shares, found):
        low, high = np.searchsorted(ordered, v, "left") / len(ordered), np.searchsorted(ordered, v, "right") / len(ordered)
        assert low - 0.01 <= share <= high + 0.01 and v in ordered
