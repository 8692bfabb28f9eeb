"""Model fit, store and scoring invariants."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from meterstream.model import FROZEN
from meterstream.operators import scoring, training
from meterstream.session import scratch_path
from meterstream.sources.models import list_versions, load_model, save_model
from meterstream.sources.tables import readings


@pytest.fixture(scope="module")
def fitted(spark):
    return training.fit_model(readings(spark, SF_ORACLE))


def test_fit_shape_and_refit_is_repeatable(spark, fitted):
    model, pipe = fitted
    assert model.k == 3 and model.threshold > 0
    again, _ = training.fit_model(readings(spark, SF_ORACLE))
    assert all(a == pytest.approx(b) for a, b in zip(again.centres, model.centres))


def test_fit_is_close_to_frozen_model(fitted):
    model, _ = fitted
    assert model.mean == pytest.approx(FROZEN.mean, abs=0.01)
    assert model.std == pytest.approx(FROZEN.std, abs=0.01)
    got = sorted(model.centres)
    want = sorted(FROZEN.centres)
    for g, w in zip(got, want):
        assert g == pytest.approx(w, abs=0.02)


def test_native_assignment_equals_mllib(spark, fitted):
    model, pipe = fitted
    r = scoring.valid_features(readings(spark, SF_ORACLE))
    ml = pipe.transform(r).select("reading_id", F.col("cluster").alias("ml"))
    nat = scoring.score(r, model).select("reading_id", "cluster")
    diff = ml.join(nat, "reading_id").filter(F.col("ml") != F.col("cluster")).count()
    assert diff == 0


def test_threshold_equals_sql_formula(spark, fitted):
    model, _ = fitted
    s = scoring.score(scoring.valid_features(readings(spark, SF_ORACLE)), model)
    row = s.selectExpr("avg(dist) + 3 * stddev_samp(dist) AS t").first()
    assert model.threshold == pytest.approx(row["t"], rel=1e-12)


def test_save_load_gives_same_scores(spark, fitted):
    model, pipe = fitted
    root = scratch_path(spark, "model-test")
    save_model(spark, root, model, pipe)
    save_model(spark, root, FROZEN)
    assert len(list_versions(spark, root)) == 2
    newest = load_model(spark, root)
    assert newest == FROZEN
    first, first_pipe = load_model(spark, list_versions(spark, root)[0], with_pipeline=True)
    assert first == model and first_pipe is not None
    r = readings(spark, SF_SMALL)
    a = scoring.score(r, model).select("reading_id", "cluster", "dist")
    b = scoring.score(r, first).select("reading_id", "cluster", "dist")
    assert a.exceptAll(b).count() == 0


def test_missing_threshold_is_an_error():
    from meterstream.model import MeterModel
    with pytest.raises(ValueError):
        MeterModel(("a",), (0.0,), (1.0,), ((0.0,),), threshold=None).validate()


def test_threshold_rules_agree_on_p95(spark):
    r = readings(spark, SF_SMALL)
    exact, _ = training.fit_model(r, threshold_rule="p95")
    approx, _ = training.fit_model(r, threshold_rule="p95-approx")
    assert approx.threshold == pytest.approx(exact.threshold, rel=0.02)


def test_model_over_16_features(spark):
    import random
    rnd = random.Random(3)
    names = [f"x{i}" for i in range(16)]
    df = spark.createDataFrame([(i, *[rnd.gauss(3 * (i % 3), 1) for _ in names]) for i in range(300)],
                               "id int, " + ", ".join(f"{n} double" for n in names))
    model, pipe = training.fit_model(df, features=names)
    assert len(model.centres[0]) == 16 and model.k == 3
    native = scoring.score(df, model).select("id", "cluster")
    ml = pipe.transform(df).select("id", F.col("cluster").alias("ml"))
    assert native.join(ml, "id").filter("cluster != ml").count() == 0


def test_infinite_readings_are_left_out_of_the_fit(spark):
    r = readings(spark, SF_SMALL)
    more = r.limit(2).withColumn("electricity", F.lit(float("inf")))
    with_more, _ = training.fit_model(r.union(more))
    without, _ = training.fit_model(r)
    assert with_more.mean == pytest.approx(without.mean) and with_more.threshold == pytest.approx(without.threshold)


def test_fit_on_a_single_row(spark):
    df = spark.createDataFrame([(120.0, 300.0)], "electricity double, water double")
    model, _ = training.fit_model(df)
    assert model.std == (0.0, 0.0)                  # one row: no spread, features map to 0
    assert model.threshold == 0.0                   # null stddev counts as 0, distance is 0
    scored = scoring.score(df, model).first()
    assert scored["dist"] == 0.0


def test_fit_with_fewer_distinct_points_than_k(spark):
    df = spark.createDataFrame([(100.0, 200.0)] * 5 + [(150.0, 260.0)] * 5, "electricity double, water double")
    model, _ = training.fit_model(df, k=3)
    assert 1 <= model.k <= 3
    assert scoring.score(df, model).filter("dist > 1e-9").count() == 0
