"""K-means with ns-bounds against a plain exact version."""

import random
from hashlib import sha256

import numpy as np
import pytest

from meterstream.llm import clustering as C


def plain(rows, k=8, rounds=10, dim=64, scale=1024, seed="3"):
    """Lloyd's rounds with Python's integers; rows of (id, components)."""
    from fractions import Fraction
    fine = [(i, [float(v) for v in x]) for i, x in rows
            if x is not None and len(x) == dim and all(v is not None and np.isfinite(v) for v in x)]
    fine = [(i, x, [(Fraction(v) * scale).__floor__() for v in x]) for i, x in fine]
    order = sorted(fine, key=lambda r: (r[0] is None, sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cents = [q for _, _, q in order[:k]]
    d = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda: [min((d(q, c), j) for j, c in enumerate(cents)) for _, _, q in fine]
    for _ in range(rounds):
        mine = near()
        for j in range(len(cents)):
            own = [q for (_, _, q), (_, a) in zip(fine, mine) if a == j]
            if own:
                cents[j] = [sum(v) // len(own) for v in zip(*own)]
    mine, fits = near(), lambda v: v if v < 1 << 63 else None
    of = lambda j: sum(x for x, a in mine if a == j)
    return sorted(((i, j, fits(x), fits(of(j)), fits(sum(y for y, _ in mine)),
                    sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for (i, _, _), (x, j) in zip(fine, mine)), key=str)


def run(spark, rows, kind="float", **kw):
    df = spark.createDataFrame([(i, x, "a", 1) for i, x in rows], f"vec_id long, embedding array<{kind}>, cluster string, Distance int")
    return sorted((tuple(r) for r in C.cluster(df, **kw).collect()), key=str)


def test_equals_plain_rounds(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 6)) * 3
    rows = [(i, (centres[i % 4] + rng.normal(size=6)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(3, rows[3][1]), (300, rows[1][1])]  # repeated rows, and equal vectors
    report = []
    assert run(spark, rows, dim=6, k=5, buckets=3, report=report) == plain(rows, dim=6, k=5)
    assert report[0][1] == len(rows) and report[-1][1] < len(rows)  # the bounds spare comparisons


def test_odd_vectors_ids_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [-inf, 0.0]),
            (None, [4.0, 4.0]), (None, [-3.0, 0.001]), (9, [1.0, 2.0]), (10, [2.0, 1.0]), (11, [0.0, -0.0]), (12, [1.0, 2.0, 3.0])]
    assert run(spark, rows, dim=2, k=3) == plain(rows, dim=2, k=3)
    assert run(spark, rows, dim=2, k=50) == plain(rows, dim=2, k=50)  # fewer vectors than clusters
    assert run(spark, [(i, [1.0, 1.0]) for i in range(5)], dim=2, k=2) == plain([(i, [1.0, 1.0]) for i in range(5)], dim=2, k=2)


@pytest.mark.parametrize("most", [1e5, 1e6, 1e30])
def test_large_components_stay_exact(spark, most):
    random.seed(int(np.log10(most)))
    rows = [(i, [random.uniform(-most, most) for _ in range(3)]) for i in range(40)]
    assert run(spark, rows, "double", dim=3, k=4) == plain(rows, dim=3, k=4)


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []


def test_displacement_bound_is_tighter_than_summed_drifts():
    history = [[[0, 0]], [[30, 0]], [[0, 5]]]
    whole = C.displacement(history)[:, 0]
    assert whole[0] == pytest.approx(5) and whole[0] < 30 + np.hypot(30, 5)


def test_bounds_never_pass_a_changed_vector():
    rng = np.random.default_rng(1)
    q = np.floor(rng.normal(size=(500, 4)) * 100)
    history, state = [[[int(v) for v in row] for row in q[:6]]], None
    for _ in range(12):
        state, _ = C.assign(q, state, history, C.displacement(history))
        d = C.squared(q, history[-1])
        assert (d[np.arange(500), state["cluster"]] == d.min(axis=1)).all() and (state["cluster"] == d.argmin(axis=1)).all()
        history.append([[int(v) for v in np.floor(q[state["cluster"] == j].mean(axis=0))] for j in range(6)])


def test_rounds_shuffle_no_vectors(spark):
    """A round joins the blocks with their state by bucket."""
    tables = C._Bucketed(spark, 3)
    a = tables.write(spark.range(9).selectExpr("id AS block", "binary('x') AS raw").repartition(3, "block"), "a")
    b = tables.write(spark.range(9).selectExpr("id AS block", "binary('x') AS state").repartition(3, "block"), "b")
    plan = a.join(b.hint("shuffle_hash"), "block")._jdf.queryExecution().executedPlan().toString()
    tables.close()
    assert "Exchange" not in plan and "Sort" not in plan
