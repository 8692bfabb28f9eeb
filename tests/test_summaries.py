"""Summaries stored by date, merged for any range: sketches, moments, rollups; radix passes."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterstream.operators import summaries as S
from meterstream.operators.thresholds import distance_stats, exact_quantile_value, key_value, ordered_key

DAY = dt.datetime(2024, 3, 1)


def rows(spark, values, days=5):
    return spark.createDataFrame([(DAY + dt.timedelta(days=i % days, minutes=i % 1000), "AB"[i % 2], v) for i, v in enumerate(values)],
                                 "timestamp timestamp_ntz, building string, dist double").withColumn("date", F.to_date("timestamp"))


@pytest.mark.parametrize("q", [0.01, 0.5, 0.95])
def test_merged_sketches_keep_the_rank_error(spark, q):
    values = np.random.default_rng(3).lognormal(0, 2, 40_000)
    stored = S.sketches(rows(spark, [float(v) for v in values]))
    assert stored.count() == 10
    got = S.sketched_quantile(S.merged_sketches(stored), q).first()
    assert got.n == len(values) and abs((values <= got.value).mean() - q) <= S.RANK_ERROR
    for r in S.sketched_quantile(S.merged_sketches(stored, ("building",)), q).collect():
        mine = values["AB".index(r.building)::2]
        assert abs((mine <= r.value).mean() - q) <= S.RANK_ERROR


def test_sketches_leave_nulls_and_nan_out(spark):
    got = S.sketched_quantile(S.merged_sketches(S.sketches(rows(spark, [1.0, None, float("nan"), 3.0, 2.0]))), 0.5).first()
    assert (got.n, got.value) == (3, 2.0)
    assert S.sketches(rows(spark, [None, float("nan")])).count() == 0


@pytest.mark.parametrize("shift", [0.0, 1e9])
def test_merged_moments_are_those_of_all_rows(spark, shift):
    values = (np.random.default_rng(4).normal(3, 2, 3000) + shift).tolist()
    df = rows(spark, values)
    got = S.threshold_of(S.merged_moments(S.moments(df, ("dist",)), ("dist",))).first()
    assert got.n == 3000 and got.mean_dist == pytest.approx(np.mean(values), rel=1e-12)
    assert got.std_dist == pytest.approx(np.std(np.array(values) - shift, ddof=1), rel=1e-6)
    want = distance_stats(df).first()
    assert got.threshold == pytest.approx(want.threshold, rel=1e-9)
    by = S.merged_moments(S.moments(df, ("dist",), ("date", "building")), ("dist",), ("building",))
    assert {r.building: r.dist_n for r in by.collect()} == {"A": 1500, "B": 1500}


def test_moments_of_few_values(spark):
    one = S.threshold_of(S.merged_moments(S.moments(rows(spark, [2.0, None]), ("dist",)), ("dist",))).first()
    assert (one.n, one.mean_dist, one.std_dist, one.threshold) == (1, 2.0, None, 2.0)
    none = S.threshold_of(S.merged_moments(S.moments(rows(spark, [None]), ("dist",)), ("dist",))).first()
    assert none.n == 0 and none.threshold is None


def test_rollups_of_batches_merge(spark):
    df = rows(spark, [float(i) if i % 7 else None for i in range(600)], days=2)
    batches = [df.filter(F.col("dist").isNull() | (F.col("dist") % 3 == b)) for b in range(3)]
    batches = [batches[0], *[b.filter("dist IS NOT NULL") for b in batches[1:]]]
    stored = S.rollup(batches[0], ("dist",)).union(S.rollup(batches[1], ("dist",))).union(S.rollup(batches[2], ("dist",)))
    got = {(r.building, r.window_start): (r.rows, r.dist_n, r.dist_sum, r.dist_min, r.dist_max) for r in S.merged_rollup(stored, ("dist",)).collect()}
    want = df.groupBy("building", F.window("timestamp", "1 hour").start.alias("w")).agg(
        F.count(F.lit(1)), F.count("dist"), F.sum("dist"), F.min("dist"), F.max("dist"))
    assert got == {(r[0], r[1]): tuple(r)[2:] for r in want.collect()}
    day = S.merged_rollup(stored.withColumn("date", F.to_date("window_start")), ("dist",), ("date",))
    assert sum(r.rows for r in day.collect()) == 600


@pytest.mark.parametrize("bins", [4096, 64])
def test_radix_passes_are_bounded_for_any_values(spark, bins):
    values = [math.ldexp(1.0, e) for e in range(-1000, 1000)] + [1.0 + i * 2.0 ** -52 for i in range(3000)] + [-5e-324, 0.0, -0.0, 5e-324]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for q in (0.0, 0.31, 0.5, 0.77, 1.0):
        passes = []
        got, n = exact_quantile_value(df, "x", q, bins=bins, passes=passes)
        assert got == float(np.quantile(np.array(values), q)) and n == len(values)
        assert len(passes) <= math.ceil(64 / math.log2(bins)) and max(passes) <= bins


def test_keys_are_in_the_order_of_the_doubles(spark):
    values = sorted([float("-inf"), -1.5e308, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.5e308, float("inf")])
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").coalesce(1).select(ordered_key(F.col("x"))).collect()]
    assert [k & ((1 << 64) - 1) for k in got] == sorted(k & ((1 << 64) - 1) for k in got) and [key_value(k) for k in got] == values
