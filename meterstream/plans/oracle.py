"""Equivalent SQL (DuckDB dialect) for each named query.

The views ``events``, ``lineitem``, ... are registered by the caller.  Values
that depend on summation order (averages, standard deviations, distances)
go through ``compare.r6_sql`` (and ``compare.r6`` in Spark).
"""

from __future__ import annotations

from .. import constants as C
from ..model import FROZEN, STRICT, MeterModel
from .compare import r6_sql as r6


def dbl(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


READINGS = f"""readings AS (
  SELECT event_id AS reading_id, event_type AS building,
         CAST(user_id % 5 + 1 AS INTEGER) AS floor,
         CAST(value AS DOUBLE) AS electricity,
         {dbl(4.0)} * TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS water,
         ts AS "timestamp"
  FROM events)"""

STATUS = (f"CASE WHEN electricity > {dbl(C.HIGH_ELECTRICITY)} OR water > {dbl(C.HIGH_WATER)} THEN 'High' "
          f"WHEN electricity > {dbl(C.WARN_ELECTRICITY)} OR water > {dbl(C.WARN_WATER)} THEN 'Warning' "
          f"ELSE 'Normal' END")


def scored_cte(model: MeterModel = FROZEN, source: str = "readings") -> str:
    """CTEs ``scored`` (cluster, dist) over ``source`` rows with valid features."""
    zs = [f"(({f} - {dbl(m)}) / {dbl(s)}) AS z{i}" if s != 0 else f"{dbl(0.0)} AS z{i}"
          for i, (f, m, s) in enumerate(zip(model.features, model.mean, model.std))]
    valid = " AND ".join(f"{f} IS NOT NULL AND isfinite({f})" for f in model.features)
    d2 = []
    for j, c in enumerate(model.centres):
        terms = [f"(z{i} - {dbl(ci)}) * (z{i} - {dbl(ci)})" for i, ci in enumerate(c)]
        d2.append(" + ".join(terms) + f" AS d{j}")
    k = model.k
    case = "CASE " + " ".join(
        "WHEN " + " AND ".join(f"d{j} <= d{m}" for m in range(j + 1, k)) + f" THEN {j}"
        for j in range(k - 1)) + f" ELSE {k - 1} END"
    least = "least(" + ", ".join(f"d{j}" for j in range(k)) + ")"
    return f"""zed AS (SELECT *, {', '.join(zs)} FROM {source} WHERE {valid}),
dd AS (SELECT *, {', '.join(d2)} FROM zed),
scored AS (SELECT *, CAST({case} AS INTEGER) AS cluster, sqrt({least}) AS dist FROM dd)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def window_sql(duration: str, metrics: str) -> str:
    return with_ctes(READINGS) + f"""
SELECT building, {metrics},
       time_bucket(INTERVAL '{duration}', "timestamp", TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '{duration}', "timestamp", TIMESTAMP '1970-01-01') + INTERVAL '{duration}' AS window_end
FROM readings WHERE "timestamp" IS NOT NULL
GROUP BY building, time_bucket(INTERVAL '{duration}', "timestamp", TIMESTAMP '1970-01-01')"""


MODEL_METRICS_SQL = (f"{r6('avg(electricity)')} AS avg_electricity, {r6('avg(water)')} AS avg_water, "
                     "max(electricity) AS max_elec, min(electricity) AS min_elec")
RULE_METRICS_SQL = (f"{r6('avg(electricity)')} AS avg_electricity, {r6('avg(water)')} AS avg_water, "
                    "max(electricity) AS max_electricity, max(water) AS max_water")

RULE_ANOMALIES = with_ctes(READINGS) + f"""
SELECT reading_id, building, floor, electricity, water, {STATUS} AS status, "timestamp"
FROM readings
WHERE electricity > {dbl(C.HIGH_ELECTRICITY)} OR water > {dbl(C.HIGH_WATER)}"""

MODEL_ANOMALIES = with_ctes(READINGS, scored_cte()) + f"""
SELECT building, floor, electricity, water, cluster, {r6('dist')} AS dist, "timestamp"
FROM scored WHERE dist > {dbl(FROZEN.threshold)}"""

BUILDING_FACTOR = (f"({dbl(1.0)} + {dbl(C.BUILDING_FACTOR_STEP)} * "
                   f"CAST((('0x' || substr(md5(building), 1, 8))::BIGINT) % {C.BUILDING_FACTOR_BUCKETS} AS DOUBLE))")
FLOOR_FACTOR = f"({dbl(1.0)} + (CAST(floor AS DOUBLE) - {dbl(1.0)}) * {dbl(C.FLOOR_FACTOR_STEP)})"
PROFILE = (f"((CASE WHEN hour(\"timestamp\") BETWEEN {C.DAYLIGHT_FIRST_HOUR} AND {C.DAYLIGHT_LAST_HOUR} "
           f"THEN {dbl(C.DAYLIGHT_FACTOR)} ELSE {dbl(C.NIGHT_FACTOR)} END) * "
           f"(CASE WHEN hour(\"timestamp\") BETWEEN {C.PEAK_FIRST_HOUR} AND {C.PEAK_LAST_HOUR} "
           f"THEN {dbl(C.PEAK_FACTOR)} ELSE {dbl(C.OFF_PEAK_FACTOR)} END))")

SEVERITY = (f"CASE WHEN dist <= {dbl(FROZEN.threshold)} AND dist <= {dbl(C.SEVERITY_VERY_NORMAL_MAX)} THEN '{C.SEVERITY_LABELS[0]}' "
            f"WHEN dist <= {dbl(FROZEN.threshold)} THEN '{C.SEVERITY_LABELS[1]}' "
            f"WHEN dist <= {dbl(C.SEVERITY_MINOR_MAX)} THEN '{C.SEVERITY_LABELS[2]}' "
            f"WHEN dist <= {dbl(C.SEVERITY_ANOMALY_MAX)} THEN '{C.SEVERITY_LABELS[3]}' "
            f"ELSE '{C.SEVERITY_LABELS[4]}' END")

TREND_LO, TREND_HI = "2024-01-08 00:00:00", "2024-01-15 00:00:00"

ORACLE: dict[str, str] = {
    "window_agg_30s": window_sql("30 seconds", MODEL_METRICS_SQL),
    "window_agg_1h": window_sql("1 hour", MODEL_METRICS_SQL),
    "window_agg_max": window_sql("30 seconds", RULE_METRICS_SQL),
    "rule_anomalies": RULE_ANOMALIES,
    "parse_envelope": with_ctes(READINGS) + f"""
SELECT reading_id, building, floor, electricity, water, {STATUS} AS status, "timestamp" FROM readings""",
    "drop_invalid": with_ctes(READINGS) + f"""
SELECT electricity, water FROM (
  SELECT CASE WHEN {STATUS} = 'Normal' THEN electricity END AS electricity, water FROM readings)
WHERE electricity IS NOT NULL AND water IS NOT NULL""",
    "rule_status": with_ctes(READINGS) + f"""
SELECT reading_id, {STATUS} AS status FROM readings""",
    "diurnal_profile": with_ctes(READINGS) + f"""
SELECT reading_id, "timestamp", {PROFILE} AS profile FROM readings""",
    "expected_load": with_ctes(READINGS) + f"""
SELECT reading_id, building, floor,
       {r6(f'{dbl(C.BASE_ELECTRICITY)} * {PROFILE} * {BUILDING_FACTOR} * {FLOOR_FACTOR}')} AS expected_electricity,
       {r6(f'{dbl(C.BASE_WATER)} * {PROFILE} * {BUILDING_FACTOR} * {FLOOR_FACTOR}')} AS expected_water
FROM readings""",
    "scaler_stats": with_ctes(READINGS) + f"""
SELECT {r6('avg(electricity)')} AS mean_electricity, {r6('stddev_samp(electricity)')} AS std_electricity,
       {r6('avg(water)')} AS mean_water, {r6('stddev_samp(water)')} AS std_water, count(*) AS n
FROM readings
WHERE electricity IS NOT NULL AND water IS NOT NULL AND isfinite(electricity) AND isfinite(water)""",
    "cluster_score": with_ctes(READINGS, scored_cte()) + f"""
SELECT reading_id, cluster, {r6('dist')} AS dist FROM scored""",
    "cluster_sizes": with_ctes(READINGS, scored_cte()) + """
SELECT cluster, count(*) AS readings FROM scored GROUP BY cluster""",
    "distance_threshold": with_ctes(READINGS, scored_cte()) + f"""
SELECT {r6('avg(dist)')} AS mean_dist, {r6('stddev_samp(dist)')} AS std_dist, count(dist) AS n,
       {r6(f'avg(dist) + {dbl(C.THRESHOLD_SIGMAS)} * coalesce(stddev_samp(dist), 0)')} AS threshold
FROM scored""",
    "threshold_p95": with_ctes(READINGS, scored_cte()) + f"""
SELECT {r6('quantile_cont(dist, 0.95)')} AS threshold_p95, count(dist) AS n FROM scored""",
    "model_anomalies": MODEL_ANOMALIES,
    "severity_bands": with_ctes(READINGS, scored_cte()) + f"""
SELECT {SEVERITY} AS severity, count(*) AS readings FROM scored GROUP BY 1""",
    "pct_of_average": with_ctes(READINGS) + f""",
avgs AS (SELECT building, avg(electricity) AS avg_electricity FROM readings GROUP BY building)
SELECT r.reading_id, r.building, r.floor, r.electricity, r."timestamp",
       {r6('a.avg_electricity')} AS avg_electricity,
       {r6(f'{dbl(100.0)} * r.electricity / a.avg_electricity')} AS pct_of_avg
FROM readings r LEFT JOIN avgs a ON r.building = a.building
WHERE r.electricity > {dbl(C.HIGH_ELECTRICITY)}""",
    "panel_latest": with_ctes(READINGS, scored_cte()) + f"""
SELECT "timestamp" AS time, building, floor, electricity, {r6('dist')} AS distance
FROM scored WHERE dist > {dbl(FROZEN.threshold)}
ORDER BY "timestamp" DESC, building, floor, electricity DESC, reading_id LIMIT 10""",
    "anomalies_per_building": with_ctes(READINGS, scored_cte()) + f"""
SELECT building, count(*) AS anomaly_count, {r6('avg(dist)')} AS avg_distance
FROM scored WHERE dist > {dbl(FROZEN.threshold)} GROUP BY building""",
}

ORACLE["csv_rejects"] = with_ctes(READINGS) + """
SELECT reading_id, CASE WHEN reading_id % 5 NOT IN (1, 2) THEN building END AS building,
       CASE WHEN reading_id % 5 NOT IN (1, 2) THEN floor END AS floor,
       CASE WHEN reading_id % 5 NOT IN (1, 2) THEN electricity END AS electricity,
       CASE WHEN reading_id % 5 NOT IN (1, 2) THEN water END AS water,
       CASE WHEN reading_id % 5 IN (1, 2) THEN 'bad_csv' END AS reason FROM readings"""
ORACLE["kmeans_step"] = with_ctes(READINGS) + """
SELECT count(*) AS readings, 3 AS clusters, true AS settled FROM readings
WHERE electricity IS NOT NULL AND water IS NOT NULL AND isfinite(electricity) AND isfinite(water)"""
ORACLE["threshold_kll"] = with_ctes(READINGS, scored_cte()) + f"""
SELECT building, count(dist) AS n, true AS within FROM scored
WHERE "timestamp" >= TIMESTAMP '{TREND_LO}' AND "timestamp" < TIMESTAMP '{TREND_HI}' GROUP BY building"""
ORACLE["threshold_from_moments"] = ORACLE["distance_threshold"]
ORACLE["scaler_from_moments"] = ORACLE["scaler_stats"]

ORACLE["panel_trend"] = with_ctes(READINGS) + f"""
SELECT window_start AS time, building, value FROM (
  SELECT building, {r6('avg(electricity)')} AS value,
         time_bucket(INTERVAL '1 hour', "timestamp", TIMESTAMP '1970-01-01') AS window_start
  FROM readings WHERE "timestamp" IS NOT NULL
  GROUP BY building, time_bucket(INTERVAL '1 hour', "timestamp", TIMESTAMP '1970-01-01'))
WHERE window_start >= TIMESTAMP '{TREND_LO}' AND window_start < TIMESTAMP '{TREND_HI}'"""


# --- streams, sinks, model store -------------------------------------------------

def _window_1h_closed(delay: str) -> str:
    base = window_sql("1 hour", MODEL_METRICS_SQL)
    return f"""SELECT * FROM ({base}) w
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '{delay}'"""


STORED_ANOMALIES = with_ctes(READINGS, scored_cte()) + f"""
SELECT building, floor, electricity, water, {STATUS} AS status, true AS is_anomaly, cluster, {r6('dist')} AS dist,
       reading_id AS "offset", "timestamp"
FROM scored WHERE dist > {dbl(FROZEN.threshold)}"""

ANOMALY_DOC = f"""SELECT * REPLACE (strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp") FROM ({STORED_ANOMALIES})"""

ANOMALY_ROW = f'SELECT * RENAME (dist AS distance) FROM ({STORED_ANOMALIES})'

HOURLY = window_sql("1 hour", MODEL_METRICS_SQL)

HOURLY_DOC = f"""SELECT * REPLACE (strftime(window_start, '%Y-%m-%dT%H:%M:%S.%f') AS window_start,
                  strftime(window_end, '%Y-%m-%dT%H:%M:%S.%f') AS window_end) FROM ({HOURLY})"""

RULE_STORED = with_ctes(READINGS) + f"""
SELECT building, floor, electricity, water, {STATUS} AS status, true AS is_anomaly, reading_id AS "offset", "timestamp"
FROM readings WHERE electricity > {dbl(C.HIGH_ELECTRICITY)} OR water > {dbl(C.HIGH_WATER)}"""

# One record for each of the five reasons, made from the readings themselves (see catalog.spoilt).
SPOILT = with_ctes(READINGS) + f"""
SELECT reading_id AS "offset", CASE reading_id % 7 WHEN 0 THEN 'null_value' WHEN 1 THEN 'bad_json' WHEN 2 THEN 'null_building'
       WHEN 3 THEN 'bad_time' WHEN 4 THEN 'bad_feature' WHEN 5 THEN 'bad_feature' END AS reason
FROM readings WHERE reading_id % 7 < 6"""

ORACLE.update({
    "stream_window_agg": HOURLY,
    "stream_window_agg_append": _window_1h_closed("2 hours"),
    "stream_rule_anomalies": RULE_STORED,
    "archive_from_time": f"""SELECT * EXCLUDE ("offset") FROM ({RULE_STORED}) WHERE "timestamp" >= TIMESTAMP '2024-01-05 18:00:00'""",
    "archive_gap": with_ctes(READINGS, """segments AS (
  SELECT *, max("timestamp") OVER (PARTITION BY topic_partition, segment) AS newest FROM (
    SELECT *, reading_id % 3 AS topic_partition, (row_number() OVER (PARTITION BY reading_id % 3 ORDER BY "timestamp", reading_id) - 1)
           // (1 + (SELECT count(*) FROM readings) // 60) AS segment FROM readings))""", """left_over AS (
  SELECT * FROM segments WHERE newest >= TIMESTAMP '2024-01-08 00:00:00' AND (electricity > 180 OR water > 350))""",
                             """lost AS (SELECT count(*) > 0 AS gone FROM segments WHERE newest < TIMESTAMP '2024-01-08 00:00:00')""") + f"""
SELECT 'fail' AS policy, (SELECT gone FROM lost) AS failed, count(*) FILTER (WHERE NOT (SELECT gone FROM lost)) AS anomalies,
       {r6("coalesce(sum(electricity) FILTER (WHERE NOT (SELECT gone FROM lost)), 0.0)")} AS electricity FROM left_over
UNION ALL SELECT 'skip', false, count(*), {r6("coalesce(sum(electricity), 0.0)")} FROM left_over""",
    "stream_model_swap": " UNION ALL ".join(
        "SELECT * FROM (" + with_ctes(READINGS, f"""part AS (SELECT * FROM readings WHERE "timestamp" {op} TIMESTAMP '2024-01-10 00:00:00')""",
                                      scored_cte(m, "part")) + f"""
SELECT building, floor, electricity, water, cluster, {r6('dist')} AS dist, '{name}' AS model_version, "timestamp"
FROM scored WHERE dist > {dbl(m.threshold)})""" for name, m, op in (("first", FROZEN, "<"), ("second", STRICT, ">="))),
    "stream_open_windows": f"""SELECT *, window_end > (SELECT max(ts) FROM events) - INTERVAL '2 hours' AS open FROM ({HOURLY})""",
    "stream_late_rows": f"SELECT * EXCLUDE (window_end) FROM ({window_sql('1 hour', 'count(*) AS readings')})",
    "rollup_trend": ORACLE["panel_trend"],
    "rollup_anomalies_per_building": ORACLE["anomalies_per_building"],
    "stored_compacted": f"SELECT * FROM ({HOURLY}), (VALUES ('before'), ('during'), ('after'), ('vacuumed')) AS s(stage)",
    "stream_model_anomalies": STORED_ANOMALIES,
    "stream_restart": f"""SELECT 'first' AS sink, * FROM ({STORED_ANOMALIES}) UNION ALL
                          SELECT 'second' AS sink, * FROM ({STORED_ANOMALIES})""",
    "stream_progress": """SELECT 'stream_progress' AS name, count(*) AS input_rows, count(*) AS parsed_rows,
                                 count(*) FILTER (WHERE NOT coalesce(isfinite(CAST(value AS DOUBLE)) AND isfinite(
                                 TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)), false)) AS rejected FROM events""",
    "sink_documents": ANOMALY_DOC,
    "sink_documents_aggregates": HOURLY_DOC,
    "sink_relational": ANOMALY_ROW,
    "sink_relational_aggregates": HOURLY,
    "stored_two_streams": f"""SELECT 'model' AS query, building, floor, electricity, water, "offset", "timestamp" FROM ({STORED_ANOMALIES})
                              UNION ALL SELECT 'rules', building, floor, electricity, water, "offset", "timestamp" FROM ({RULE_STORED})""",
    "stored_panel_trend": ORACLE["panel_trend"],
    "stored_panel_latest": ORACLE["panel_latest"],
    "stored_anomalies_per_building": ORACLE["anomalies_per_building"],
    "model_roundtrip": with_ctes(READINGS, scored_cte()) + f"""
SELECT reading_id, cluster, {r6('dist')} AS dist, dist > {dbl(FROZEN.threshold)} AS is_anomaly FROM scored""",
    "pipeline_roundtrip": with_ctes(READINGS) + """
SELECT count(*) AS readings, count(*) AS same_cluster, count(*) AS same_distance FROM readings
WHERE electricity IS NOT NULL AND water IS NOT NULL AND isfinite(electricity) AND isfinite(water)""",
    "kmeans_fit": with_ctes(READINGS) + f"""
SELECT {r6('avg(electricity)')} AS mean_electricity, {r6('stddev_samp(electricity)')} AS std_electricity,
       {r6('avg(water)')} AS mean_water, {r6('stddev_samp(water)')} AS std_water, count(*) AS readings, 3::BIGINT AS clusters,
       {dbl(0.0)} AS threshold_error FROM readings
WHERE electricity IS NOT NULL AND water IS NOT NULL AND isfinite(electricity) AND isfinite(water)""",
    "readings_csv": with_ctes(READINGS) + f"""
SELECT building, floor, electricity, water, {STATUS} AS status, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f+00:00') AS "timestamp"
FROM readings""",
    "rejects": """
SELECT text AS raw, CASE WHEN text IS NULL THEN 'null_value' ELSE 'bad_json' END AS reason
FROM conversations""",
    "reject_reasons": SPOILT,
    "stream_pct_of_average": with_ctes(READINGS) + f""",
avgs AS (SELECT building, avg(electricity) AS avg_electricity FROM readings GROUP BY building)
SELECT r.building, r.floor, r.electricity, r."timestamp",
       {r6('a.avg_electricity')} AS avg_electricity,
       {r6(f'{dbl(100.0)} * r.electricity / a.avg_electricity')} AS pct_of_avg
FROM readings r LEFT JOIN avgs a ON r.building = a.building
WHERE r.electricity > {dbl(C.HIGH_ELECTRICITY)}""",
})
