"""Limits exactly on the edge, severity bands, ties between centres, thresholds."""

import math

import pytest
from pyspark.sql import functions as F

from meterstream import constants as C
from meterstream.functions.rules import rule_breach, rule_status, severity_band, diurnal_profile
from meterstream.model import FROZEN, MeterModel
from meterstream.operators import scoring
from meterstream.operators.thresholds import distance_stats


def test_status_limits_are_strict(spark):
    rows = [(180.0, 0.0), (180.01, 0.0), (140.0, 0.0), (140.01, 0.0), (0.0, 350.0), (0.0, 350.01),
            (0.0, 275.0), (0.0, 275.01), (None, 400.0), (None, 10.0)]
    df = spark.createDataFrame(rows, "electricity double, water double")
    got = [r[0] for r in df.select(rule_status()).collect()]
    assert got == ["Warning", "High", "Normal", "Warning", "Warning", "High", "Normal", "Warning",
                   "High", "Normal"]
    breach = [r[0] for r in df.select(rule_breach()).collect()]
    assert breach == [False, True, False, False, False, True, False, False, True, None]


def test_diurnal_profile_edges(spark):
    hours = list(range(24))
    df = spark.createDataFrame([(f"2024-01-01 {h:02d}:30:00",) for h in hours], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = [r[0] for r in df.select(diurnal_profile("t")).collect()]
    want = [(1.2 if 7 <= h <= 19 else 0.8) * (1.3 if 12 <= h <= 14 else 1.0) for h in hours]
    assert got == pytest.approx(want, abs=0)


def test_severity_bands_half_open(spark):
    t = 1.9327
    vals = [0.5, 1.0, 1.0000001, t, t + 1e-9, 2.5, 2.6, 3.5, 3.51, None]
    df = spark.createDataFrame([(v,) for v in vals], "dist double")
    got = [r[0] for r in df.select(severity_band("dist", t)).collect()]
    L = C.SEVERITY_LABELS
    assert got == [L[0], L[0], L[1], L[1], L[2], L[2], L[3], L[3], L[4], None]


def test_distance_equal_to_threshold_is_not_anomalous(spark):
    m = MeterModel(("electricity", "water"), (0.0, 0.0), (1.0, 1.0), ((0.0, 0.0),), threshold=5.0)
    df = spark.createDataFrame([(3.0, 4.0), (3.0, 4.0001)], "electricity double, water double")
    out = scoring.anomalies(df.withColumn("building", F.lit("A")).withColumn("floor", F.lit(1))
                            .withColumn("timestamp", F.lit(None).cast("timestamp_ntz")), m)
    assert [r["water"] for r in out.collect()] == [4.0001]


def test_tie_between_centres_goes_to_lowest_index(spark):
    m = MeterModel(("electricity", "water"), (0.0, 0.0), (1.0, 1.0), ((1.0, 0.0), (-1.0, 0.0)), threshold=9.0)
    df = spark.createDataFrame([(0.0, 5.0)], "electricity double, water double")
    r = scoring.score(df, m).first()
    assert r["cluster"] == 0 and r["dist"] == pytest.approx(math.sqrt(26.0))


def test_null_and_nan_features_are_not_scored(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0), (1.0, 1.0), (float("inf"), 1.0), (1.0, float("-inf"))],
                               "electricity double, water double")
    assert scoring.valid_features(df).count() == 1
    assert df.filter(~scoring.usable()).count() == 4


@pytest.mark.parametrize("threshold", [0.5, 1.9, 3.0])
def test_a_flagged_distance_is_never_called_normal(spark, threshold):
    from meterstream.functions.rules import severity_band
    df = spark.createDataFrame([(i / 10,) for i in range(50)], "dist double")
    for r in df.select("dist", severity_band("dist", threshold).alias("s")).collect():
        assert (r["s"] in ("very normal", "normal variation")) == (r["dist"] <= threshold)


def test_single_row_threshold_has_zero_stddev(spark):
    df = spark.createDataFrame([(1.5,)], "dist double")
    r = distance_stats(df).first()
    assert r["std_dist"] is None and r["threshold"] == 1.5


def test_native_distance_matches_python(spark):
    import numpy as np
    from conftest import SF_SMALL
    from meterstream.sources.tables import readings
    pdf = scoring.score(readings(spark, SF_SMALL), FROZEN).toPandas()
    z = np.stack([(pdf.electricity - 49.63) / 49.10, (pdf.water - 199.29) / 116.09], axis=1)
    c = np.array(FROZEN.centres)
    d = np.sqrt(((z[:, None, :] - c[None, :, :]) ** 2).sum(axis=2))
    assert (d.argmin(axis=1) == pdf.cluster.values).all()
    assert np.allclose(d.min(axis=1), pdf.dist.values, atol=1e-12)


def test_scoring_plan_has_no_python(spark):
    from conftest import SF_SMALL
    from meterstream.sources.tables import readings
    plan = scoring.anomalies(readings(spark, SF_SMALL), FROZEN)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "WholeStageCodegen" in plan or "*(" in plan
    assert plan.count("get_json_object") == 1


def test_reference_table_refreshes(spark):
    from meterstream.operators.enrich import ReferenceTable
    loads = []

    def load():
        loads.append(1)
        return spark.createDataFrame([("A", float(len(loads)))], "building string, avg_electricity double")
    slow = ReferenceTable(load, refresh_s=3600)
    assert slow.get().first()["avg_electricity"] == 1.0
    assert slow.get().first()["avg_electricity"] == 1.0 and len(loads) == 1
    fast = ReferenceTable(load, refresh_s=0)
    assert fast.get().first()["avg_electricity"] == 2.0
    assert fast.get().first()["avg_electricity"] == 3.0
