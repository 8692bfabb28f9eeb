"""Quality rules with adaptive thresholds.

Every text gets its word metrics, and each metric is compared with what is
usual for its language and source.  What is usual comes from quantile
sketches: log-linear histograms (64 buckets for each doubling, so a quantile
is exact to one part in 64) that merge by adding counts.  They are grouped
counts, so tasks pre-aggregate them, a source that holds a third of all rows
makes no large group, and the result doesn't depend on the order of rows.

All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, let, quoted, staged, words

WINDOW = 8
#: metric -> (numerator, denominator, scale, least spread in those units, sides that reject)
RULES = {
    "symbol_share": ("n_symbols", "word_chars", 10_000, 50, "high"),
    "upper_share": ("n_upper", "word_chars", 10_000, 300, "high"),
    "word_length": ("word_chars", "n_words", 100, 40, "both"),
    "dup_line_share": ("n_dup_lines", "n_lines", 10_000, 1_800, "high"),
    "repeat_share": ("n_repeat_words", "n_words", 10_000, 800, "high"),
    "distinct_share": ("n_distinct", "n_words", 10_000, 800, "low"),
}


def _covered(window_hashes: Column) -> Column:
    """Words that windows found twice or more cover."""
    def places(s):
        twice = F.filter(s, lambda e, k: (e["h"] == F.get(s, k - 1)["h"]) | (e["h"] == F.get(s, k + 1)["h"]))
        return F.sort_array(F.transform(twice, lambda e: e["k"]))

    by_hash = F.sort_array(F.transform(window_hashes, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    step = lambda a, k: F.struct(k.alias("last"), (a["n"] + F.least(F.lit(WINDOW), k - a["last"])).alias("n"))
    return F.aggregate(let(by_hash, places), start, step, lambda a: a["n"])


def _repeats(hashes: Column) -> Column:
    windows = F.when(F.size(hashes) >= WINDOW,
                     F.transform(F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)),
                                 lambda i: F.xxhash64(F.slice(hashes, i, WINDOW))))
    windows = F.coalesce(windows, F.array().cast("array<bigint>"))
    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long"))
               .otherwise(_covered(w)))


def metrics(text: Column) -> Column:
    """Struct of counts of a whole text (null: empty), each of type long."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    of_words = let(F.transform(words(text), lambda w: F.xxhash64(w)), lambda h: F.struct(
        F.size(h).alias("n"), F.size(F.array_distinct(h)).alias("distinct"), _repeats(h).alias("repeat")))
    return let(F.struct(of_words.alias("w"), of_lines.alias("l")), lambda m: F.struct(*[c.cast("long").alias(n) for n, c in (
        ("n_words", m["w"]["n"]),
        ("word_chars", F.length(F.regexp_replace(t, SPACE, ""))),
        ("n_symbols", F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", ""))),
        ("n_dup_lines", m["l"]["dup"]),
        ("n_repeat_words", m["w"]["repeat"]),
        ("n_upper", F.length(F.regexp_replace(t, r"\P{Lu}+", ""))),
        ("n_lines", m["l"]["n"]),
        ("n_distinct", m["w"]["distinct"]))]))


def bucket(value: Column) -> Column:
    """Lower end of a value's bucket: its seven leading bits."""
    drop = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", by: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """One narrow row per document: id, group, counts, scaled metrics and ``base_failed``."""
    m = docs.select(quoted(doc_id).alias("doc_id"), *[quoted(c).cast("string").alias(f"by{i}") for i, c in enumerate(by)],
                    F.inline(F.array(metrics(quoted(text)))))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scaled = [F.expr(f"coalesce(({scale} * {a}) div nullif({b}, 0), 0)").alias(name)
              for name, (a, b, scale, _, _) in RULES.items()]
    return m.select("*", failed.alias("base_failed"), *scaled)


def sketches(rows: DataFrame) -> DataFrame:
    """``by0, by1, metric, bucket, n``: the sketch of each group and metric, over what the base rules pass."""
    each = F.array(*[F.struct(F.lit(m).alias("metric"), bucket(F.col(m)).alias("bucket")) for m in RULES])
    return (rows.filter(~F.col("base_failed")).select("by0", "by1", F.inline(each))
            .groupBy("by0", "by1", "metric", "bucket").agg(F.count(F.lit(1)).alias("n")))


def fences(sketch: DataFrame, keys: list[str], far: int = 3) -> DataFrame:
    """For each group: ``n`` and the lowest and highest usual value of each metric.

    Sketches merge over what isn't in ``keys``.  A fence lies ``far`` spreads
    outside the quartiles; a spread is the distance of the quartiles, or the
    rule's least spread.
    """
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "metric")
    c = merged.select("*", F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
                      F.sum("n").over(w).alias("all"))
    quartile = lambda m, k: F.min(F.when((F.col("metric") == m) & (4 * F.col("upto") >= k * F.col("all")), F.col("bucket")))
    q = c.groupBy(*keys).agg(F.max("all").alias("n"), *[quartile(m, k).alias(f"{m}_{k}") for m in RULES for k in (1, 3)])
    ends = []
    for m, (_, _, _, least, _) in RULES.items():
        spread = F.greatest(F.col(f"{m}_3") - F.col(f"{m}_1"), F.lit(least))
        ends += [(F.col(f"{m}_1") - far * spread).alias(f"{m}_low"), (F.col(f"{m}_3") + far * spread).alias(f"{m}_high")]
    return q.select(*keys, "n", *ends)


def thresholds(sketch: DataFrame, least_rows: int = 100) -> DataFrame:
    """Fences of each language and source; of the language, then of all, where fewer than ``least_rows`` rows tell."""
    names = [f"{m}_{s}" for m in RULES for s in ("low", "high")]
    rename = lambda d, p: d.select(*[F.col(k).alias(f"{p}{k}") for k in d.columns])
    own, lang, whole = fences(sketch, ["by0", "by1"]), rename(fences(sketch, ["by0"]), "l_"), rename(
        fences(sketch.withColumn("one", F.lit(1)), ["one"]), "a_")
    joined = own.join(lang, F.col("by0").eqNullSafe(F.col("l_by0"))).withColumn("one", F.lit(1)).join(
        whole, F.col("one") == F.col("a_one"))
    pick = lambda c: F.when(F.col("n") >= least_rows, F.col(c)).when(
        F.col("l_n") >= least_rows, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}")).alias(c)
    return joined.select(F.col("by0").alias("t0"), F.col("by1").alias("t1"), *[pick(c) for c in names])


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", by: tuple[str, str] = ("lang", "source"),
          least_rows: int = 100) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` for each row.

    Null and empty texts have no words and fail the base rules.  A null
    language or source is a group of its own.  Repeated rows are judged alike
    and count each time; an empty table gives no rows; other columns aren't read.
    """
    rows = staged(measured(docs, doc_id, text, by), "metrics")
    limits = thresholds(sketches(rows), least_rows)
    usual = F.lit(True)
    for m, (_, _, _, _, side) in RULES.items():
        if side != "high":
            usual &= F.col(m) >= F.col(f"{m}_low")
        if side != "low":
            usual &= F.col(m) <= F.col(f"{m}_high")
    same = F.col("by0").eqNullSafe(F.col("t0")) & F.col("by1").eqNullSafe(F.col("t1"))
    return rows.join(limits, same, "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(usual, F.lit(True))).alias("kept"), *RULES)


def oracle(least_rows: int = 100) -> str:
    """The same in SQL: windows as rows, sketches as grouped counts."""
    scaled = ", ".join(f"coalesce(({s} * {a}) // nullif({b}, 0), 0) AS {m}" for m, (a, b, s, _, _) in RULES.items())
    each = " UNION ALL ".join(f"SELECT by0, by1, '{m}' AS metric, {m} AS v FROM s WHERE NOT base_failed" for m in RULES)

    def ends(keys, source):
        k = "".join(f"{x}, " for x in keys)
        part = f"PARTITION BY {k}metric"
        cols = ", ".join(f"min(CASE WHEN metric = '{m}' AND 4 * upto >= {q} * total THEN bucket END) AS {m}_{q}" for m in RULES for q in (1, 3))
        out = ", ".join(f"{m}_1 - 3 * greatest({m}_3 - {m}_1, {r[3]}) AS {m}_low, {m}_3 + 3 * greatest({m}_3 - {m}_1, {r[3]}) AS {m}_high"
                        for m, r in RULES.items())
        return f"""SELECT {k}n, {out} FROM (SELECT {k}max(total) AS n, {cols} FROM (
            SELECT *, sum(n) OVER ({part} ORDER BY bucket) AS upto, sum(n) OVER ({part}) AS total
            FROM (SELECT {k}metric, bucket, sum(n)::BIGINT AS n FROM {source} GROUP BY {k}metric, bucket)) GROUP BY {k[:-2] or '()'})"""

    pick = lambda c: f"(CASE WHEN own.n >= {least_rows} THEN own.{c} WHEN l.n >= {least_rows} THEN l.{c} ELSE a.{c} END)"
    tests = " AND ".join(f"s.{m} {'>=' if e == 'low' else '<='} {pick(f'{m}_{e}')}" for m, r in RULES.items()
                         for e in ("low", "high") if r[4] in (e, "both"))
    space = r"[^\x20\x09-\x0D]"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang AS by0, source AS by1, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{space}+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{space}')) AS ls FROM d),
p AS (SELECT rid, unnest(range(1, len(ws) - 6)) AS k, ws FROM w),
g AS (SELECT rid, k, array_to_string(ws[k:k + 7], ' ') AS g FROM p),
twice AS (SELECT rid, k FROM (SELECT rid, k, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1),
r AS (SELECT rid, sum(least(8, coalesce(k - before, 8)))::BIGINT AS n
      FROM (SELECT rid, k, lag(k) OVER (PARTITION BY rid ORDER BY k) AS before FROM twice) GROUP BY rid),
c AS (SELECT w.rid, doc_id, by0, by1, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
             length(regexp_replace(t, '\P{{Lu}}+', '', 'g'))::BIGINT AS n_upper, len(ls)::BIGINT AS n_lines,
             len(list_distinct(ws))::BIGINT AS n_distinct FROM w LEFT JOIN r ON w.rid = r.rid),
s AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {scaled} FROM c),
b AS (SELECT *, greatest(length(bin(v)) - 7, 0)::INTEGER AS z FROM ({each})),
k AS (SELECT by0, by1, metric, (v >> z) << z AS bucket, count(*) AS n FROM b GROUP BY ALL),
own AS ({ends(['by0', 'by1'], 'k')}), l AS ({ends(['by0'], 'k')}), a AS ({ends([], 'k')})
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({tests}, true) AS kept, {', '.join(f's.{m}' for m in RULES)}
FROM s LEFT JOIN own ON s.by0 IS NOT DISTINCT FROM own.by0 AND s.by1 IS NOT DISTINCT FROM own.by1
LEFT JOIN l ON s.by0 IS NOT DISTINCT FROM l.by0 LEFT JOIN a ON true"""
