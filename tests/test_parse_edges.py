"""Edge inputs of the message parser (bad JSON, nulls, wrong types, bad times, NaN)."""

from pyspark.sql import functions as F

from helpers import envelope_rows
from meterstream.operators import parse

GOOD = ('{"building":"Building A","floor":2,"electricity":150.5,"water":300.0,'
        '"status":"Warning","timestamp":"2024-01-01T10:00:00.123456+00:00"}')


def decoded(spark, values):
    return parse.decode(envelope_rows(spark, values)).orderBy("raw").collect()


def reasons(spark, values):
    rows = parse.rejects(parse.decode(envelope_rows(spark, values))).collect()
    return {r["raw"]: r["reason"] for r in rows}


def test_good_message_parses(spark):
    env = envelope_rows(spark, [GOOD])
    row = parse.valid(parse.decode(env)).first()
    assert row["building"] == "Building A" and row["floor"] == 2
    assert row["electricity"] == 150.5 and row["water"] == 300.0
    assert str(row["timestamp"]) == "2024-01-01 10:00:00.123456"


def test_reject_reasons(spark):
    got = reasons(spark, [
        "{bad", '{"floor":1}', GOOD.replace("Building A", "") .replace('"building":"",', ""),
        GOOD.replace("2024-01-01T10:00:00.123456+00:00", "yesterday"),
        GOOD.replace('"electricity":150.5', '"electricity":"150.5"'),
        GOOD.replace('"water":300.0', '"water":NaN'),
        GOOD, "[1,2]", "{}",
    ])
    assert got["{bad"] == parse.BAD_JSON
    assert got["[1,2]"] == parse.BAD_JSON
    assert got["{}"] == parse.NULL_BUILDING
    assert got['{"floor":1}'] == parse.NULL_BUILDING
    assert sum(v == parse.BAD_TIME for v in got.values()) == 1
    assert sum(v == parse.BAD_FEATURE for v in got.values()) == 2     # quoted number, NaN
    assert GOOD not in got


def test_null_value_is_rejected(spark):
    rows = parse.rejects(parse.decode(envelope_rows(spark, [None]))).collect()
    assert [(r["raw"], r["reason"]) for r in rows] == [(None, parse.NULL_VALUE)]


def test_wrong_types_become_null_fields(spark):
    env = envelope_rows(spark, [GOOD.replace('"floor":2', '"floor":"x"'),
                                GOOD.replace('"floor":2', '"floor":1.5'),
                                GOOD.replace('"water":300.0', '"water":300.0,"extra":"ignored"'),
                                GOOD.replace('"electricity":150.5', '"electricity":150')])
    rows = parse.valid(parse.decode(env)).collect()
    assert len(rows) == 4                       # structurally valid
    floors = sorted((r["floor"] is None) for r in rows)
    assert floors == [False, False, True, True]
    assert 150.0 in [r["electricity"] for r in rows]   # integer JSON number -> double


def test_z_suffix_and_offset_times(spark):
    env = envelope_rows(spark, [GOOD, GOOD.replace("+00:00", "Z"),
                                GOOD.replace("2024-01-01T10:00:00.123456+00:00", "2024-01-01T12:00:00+02:00")])
    ts = sorted(str(r["timestamp"]) for r in parse.valid(parse.decode(env)).collect())
    assert ts == ["2024-01-01 10:00:00", "2024-01-01 10:00:00.123456", "2024-01-01 10:00:00.123456"]


def test_envelope_round_trip(spark):
    from meterstream.sources.tables import readings, with_status
    from conftest import SF_SMALL
    r = with_status(readings(spark, SF_SMALL))
    back = parse.valid(parse.decode(parse.to_envelope(r), keep=("offset",)))
    joined = r.join(back.withColumnRenamed("offset", "reading_id"), "reading_id")
    diff = joined.filter(~(r["electricity"].eqNullSafe(back["electricity"])
                           & r["water"].eqNullSafe(back["water"])
                           & r["timestamp"].eqNullSafe(back["timestamp"])
                           & r["building"].eqNullSafe(back["building"])))
    assert joined.count() == r.count() and diff.count() == 0


def test_decode_parses_json_once(spark):
    """Filters on parsed fields stay above the generator: one from_json per row in the plan."""
    env = envelope_rows(spark, [GOOD])
    q = parse.valid(parse.decode(env)).filter(F.col("electricity") > 100)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_results_do_not_depend_on_the_session_time_zone(spark, duck):
    """Parsing, ISO text, watermark windows and typed sinks keep UTC wall time in any session zone."""
    import __spark_entry__ as entry
    from helpers import assert_same
    from conftest import SF_SMALL
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        for name in ("parse_envelope", "stream_window_agg_append", "sink_relational", "sink_documents"):
            got = entry.queries()[name](spark, SF_SMALL).toPandas()
            want = duck(SF_SMALL).execute(entry.oracle_sql()[name]).df()
            assert_same(got, want)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
