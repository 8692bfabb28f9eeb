"""Distance statistics and thresholds (A3, A4, A5).

``distance_stats`` is one global aggregate (partial per task, one row out).
``exact_quantile`` finds an exact percentile without holding the column in
one task, by radix selection over order-preserving 64-bit keys: a pass is a
grouped count (at most ``bins`` rows reach the driver), and six passes end it
for any data.  Linear interpolation between ranks floor(p) and
ceil(p), p = q * (n - 1), as in SQL ``percentile_cont``.
"""

from __future__ import annotations

import math
import struct

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C

SIGN = -(1 << 63)


def distance_stats(scored: DataFrame, col: str = "dist",
                   sigmas: float = C.THRESHOLD_SIGMAS) -> DataFrame:
    """mean, sample stddev, count and threshold = mean + sigmas * coalesce(stddev, 0)."""
    d = F.col(col)
    agg = scored.agg(F.avg(d).alias("mean_dist"), F.stddev_samp(d).alias("std_dist"),
                     F.count(d).alias("n"))
    return agg.select("mean_dist", "std_dist", "n",
                      (F.col("mean_dist") + F.lit(float(sigmas)) *
                       F.coalesce(F.col("std_dist"), F.lit(0.0))).alias("threshold"))


def ordered_key(x: Column) -> Column:
    """A 64-bit key of a double whose bits, read as an unsigned number, are in the order of the doubles."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), x + F.lit(0.0)).cast("long")  # no -0.0
    return F.when(bits < 0, F.bitwise_not(bits)).otherwise(bits.bitwiseXOR(F.lit(SIGN)))


def key_value(key: int) -> float:
    """The double of an ordered key."""
    u = key & ((1 << 64) - 1)
    u = u ^ (1 << 63) if u >> 63 else ~u & ((1 << 64) - 1)
    return struct.unpack("<d", struct.pack("<Q", u))[0]


def exact_quantile_value(df: DataFrame, col: str, q: float, bins: int = 4096,
                         passes: list | None = None) -> tuple[float | None, int]:
    """(value, n) of the exact q-quantile of the non-null, non-NaN values of ``col``.

    Radix selection: each pass counts the values by the next bits of their
    ordered keys (12 with 4,096 bins) among those that agree with the wanted
    ranks in all bits before, so six passes end it whatever the values are.
    Infinite values rank first and last; between an infinite and a finite
    value the interpolation is infinite.  ``passes`` gets the bins of each pass.
    """
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must be in [0, 1]")
    digits = max(1, bins.bit_length() - 1)
    x = F.col(col).cast("double")
    keys = df.filter(x.isNotNull() & ~F.isnan(x)).select(ordered_key(x).alias("key")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        left, below, prefix, n, found, want = 64, 0, None, None, {}, []
        while n is None or want:
            step = min(digits, left)
            rows = keys if prefix is None else keys.filter(F.shiftrightunsigned("key", left) == prefix)
            digit = F.shiftrightunsigned("key", left - step).bitwiseAND(F.lit((1 << step) - 1))
            # Keys count up by their unsigned order; without the sign bit flipped, min and max would go by the signed one.
            signed = F.col("key").bitwiseXOR(F.lit(SIGN))
            hist = (rows.groupBy(digit.alias("digit"))
                    .agg(F.count(F.lit(1)).alias("c"), F.min(signed).alias("mn"), F.max(signed).alias("mx")).orderBy("digit").collect())
            if passes is not None:
                passes.append(len(hist))
            if n is None:
                n = sum(h["c"] for h in hist)
                if n == 0:
                    return None, 0
                pos = q * (n - 1)
                r1, r2 = math.floor(pos), math.ceil(pos)
                want = sorted({r1, r2})
            start, narrowed = below, None
            for h in hist:
                first, last = start, start + h["c"] - 1
                least, most = (key_value(h[m] ^ SIGN) for m in ("mn", "mx"))
                inside = []
                for r in want:
                    if first <= r <= last:
                        if r == first or least == most:
                            found[r] = least
                        elif r == last:
                            found[r] = most
                        else:
                            inside.append(r)
                if inside:  # neighbouring ranks, so only one bin has any
                    narrowed = (int(h["digit"]), start)
                start = last + 1
            want = [r for r in want if r not in found]
            if want:
                left -= step
                prefix, below = ((prefix or 0) << step) | narrowed[0], narrowed[1]
        v1, v2 = found[r1], found[r2]
        return (v1 if v1 == v2 else v1 + (v2 - v1) * (pos - r1)), n
    finally:
        keys.unpersist()


def exact_quantile(df: DataFrame, col: str, q: float, name: str = "value", **kw) -> DataFrame:
    value, n = exact_quantile_value(df, col, q, **kw)
    spark = df.sparkSession
    return spark.range(1).select(F.lit(value).cast("double").alias(name),
                                 F.lit(n).cast("bigint").alias("n"))


def approx_quantile(df: DataFrame, col: str, q: float, accuracy: int = 10000,
                    name: str = "value") -> DataFrame:
    """Single-pass approximate quantile (rank error <= n / accuracy)."""
    return df.agg(F.percentile_approx(col, q, accuracy).alias(name),
                  F.count(col).alias("n"))
