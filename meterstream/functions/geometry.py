"""Native distance expressions for K-means scoring.

Centres are a handful of doubles (k x d), so they travel as literals inside
the expression: no broadcast, no join, no Python worker.  Every coordinate is its own term, so the
whole projection stays in one whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _d(v: float) -> Column:
    return F.lit(float(v)).cast("double")


def standardise(cols: Sequence, mean: Sequence[float], std: Sequence[float]) -> list[Column]:
    """(x - mean) / std per feature; a zero std maps the feature to 0 (as MLlib does)."""
    out = []
    for c, m, s in zip(cols, mean, std):
        out.append(_d(0.0) if s == 0 else (_c(c).cast("double") - _d(m)) / _d(s))
    return out


def squared_distances(z: Sequence[Column], centres: Sequence[Sequence[float]]) -> list[Column]:
    """Squared euclidean distance of the point ``z`` to every centre."""
    out = []
    for centre in centres:
        terms = [(zi - _d(ci)) * (zi - _d(ci)) for zi, ci in zip(z, centre)]
        acc = terms[0]
        for t in terms[1:]:
            acc = acc + t
        out.append(acc)
    return out


def nearest_centre(z: Sequence[Column], centres: Sequence[Sequence[float]]) -> Column:
    """struct(d2, cluster) of the nearest centre; ties go to the lowest index.

    ``array_min`` over (d2, index) structs compares d2 first, then the index.
    A null coordinate makes every d2 null and the result null.
    """
    d2 = squared_distances(z, centres)
    pairs = [F.struct(d.alias("d2"), F.lit(i).alias("cluster")) for i, d in enumerate(d2)]
    best = F.array_min(F.array(*pairs))
    any_null = z[0].isNull()
    for zi in z[1:]:
        any_null = any_null | zi.isNull()
    return F.when(any_null, F.lit(None)).otherwise(best)
