"""Exact distributed quantile against numpy, including forced refinement passes."""

import numpy as np
import math

import pytest
from hypothesis import given, settings, strategies as st

from meterstream.operators.thresholds import exact_quantile_value


def ref(vals, q):
    return float(np.quantile(np.array(vals, dtype=float), q, method="linear"))


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_matches_numpy_with_refinement(spark, q):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.exponential(2.0, 5000), np.full(300, 1.25), rng.normal(0, 1e-6, 200)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got, n = exact_quantile_value(df, "x", q, bins=16)
    assert n == len(vals)
    assert got == pytest.approx(ref(vals, q), rel=0, abs=1e-12)


def test_nulls_and_nans_ignored(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert exact_quantile_value(df, "x", 0.5)[0] == 2.0


def test_empty_input(spark):
    df = spark.createDataFrame([], "x double")
    assert exact_quantile_value(df, "x", 0.95) == (None, 0)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60),
       st.floats(0, 1))
def test_property_small_bins(spark, vals, q):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got, _ = exact_quantile_value(df, "x", q, bins=4)
    assert got == pytest.approx(ref(vals, q), rel=1e-12, abs=1e-9)


INF, BIG = float("inf"), 1.5e308


@pytest.mark.parametrize("extra", [[INF], [-INF], [INF, -INF, -INF], [BIG, -BIG], [INF] * 600, [BIG, -BIG, INF, 5e-324]])
@pytest.mark.parametrize("q", [0.0, 0.3, 0.5, 0.95, 1.0])
def test_extreme_values_end(spark, extra, q):
    values = sorted([float(i) for i in range(500)] + extra)
    got, n = exact_quantile_value(spark.createDataFrame([(v,) for v in values], "x double"), "x", q, bins=64)
    pos = q * (len(values) - 1)
    a, b = values[math.floor(pos)], values[math.ceil(pos)]
    assert n == len(values)
    assert got == (a if a == b else pytest.approx(a + (b - a) * (pos - math.floor(pos))))
