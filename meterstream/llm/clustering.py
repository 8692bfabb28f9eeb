"""K-means over embeddings with ns-bounds: exact, and most vectors are not compared with every centroid.

Every centroid that a round used is kept.  A vector remembers when it was last
compared with all centroids (its round T), the distance to its own centroid
then and the distance to the next one.  Later its own centroid is at most that
distance plus |c(now) - c(T)| away, and every other at least the second one
less its own |c(now) - c(T)|: the norm of the whole displacement since T, which
is never more than the sum of the moves in between.  Only where the two bounds
meet is the vector compared with all centroids again, exactly, in integers.

Vectors are written once in blocks, in a table bucketed by block; a round writes
24 bytes of state for each vector, bucketed alike, so that no round shuffles or
rewrites vectors.  What reaches the driver is sums: a few rows for each cluster
and component.
"""

from __future__ import annotations

import math
import uuid
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import forget_at_end, quoted, staged

#: Vectors of a block.
BLOCK = 1024
#: Up to this magnitude 64-bit floats hold all sums of a distance exactly; beyond, Python's integers are used.
EXACT = 1 << 22
STATE = np.dtype([("cluster", "<i4"), ("seen", "<i4"), ("own", "<f8"), ("next", "<f8")])
LIMB = 60
SUMS = "array<struct<cluster:int,place:int,limb:int,part:bigint>>"
SUM_TYPE = pa.list_(pa.struct([("cluster", pa.int32()), ("place", pa.int32()), ("limb", pa.int32()), ("part", pa.int64())]))
#: Places of a cluster's count and inertia among its sums; its components have the places from 0.
COUNT, INERTIA = -1, -2


def quantised(raw: bytes, dim: int, scale: int, kind: str) -> np.ndarray:
    """floor(scale * x) of a block, as exact 64-bit floats or, where these don't suffice, Python integers."""
    x = np.frombuffer(raw, kind).reshape(-1, dim).astype(np.float64)
    if not x.size or np.abs(x).max() * scale < EXACT:
        return np.floor(x * scale)
    from fractions import Fraction
    return np.array([[math.floor(Fraction(v) * scale) for v in row] for row in x.tolist()], dtype=object)


def squared(q: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Exact squared distances of rows to centroids."""
    if q.dtype == object or max((abs(v) for c in centroids for v in c), default=0) >= EXACT:
        c = np.array(centroids, dtype=object)
        q = np.array([[int(v) for v in row] for row in q], dtype=object).reshape(len(q), -1)
        return np.stack([((q - row) ** 2).sum(axis=1) for row in c], axis=1)
    c = np.array(centroids, dtype=np.float64)
    return (q * q).sum(axis=1)[:, None] - 2 * (q @ c.T) + (c * c).sum(axis=1)[None, :]


def displacement(history: list[list[list[int]]]) -> np.ndarray:
    """For each earlier round, how far each centroid has moved in all since; a little too much rather than too little."""
    now = history[-1]
    return np.array([[math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y))) * (1 + 1e-12)
                      for x, y in zip(then, now)] for then in history])


def assign(q: np.ndarray, state: np.ndarray | None, history: list[list[list[int]]],
           moved: np.ndarray) -> tuple[np.ndarray, int]:
    """State after comparing with the newest centroids, and how many rows needed all of them."""
    n, k, now = len(q), len(history[-1]), len(history) - 1
    new = np.zeros(n, STATE) if state is None else state.copy()
    if state is None:
        failed = np.arange(n)
    else:
        since, rows = moved[state["seen"]], np.arange(n)
        upper = state["own"] + since[rows, state["cluster"]]
        since[rows, state["cluster"]] = 0
        lower = state["next"] - since.max(axis=1)
        failed = np.flatnonzero(~(upper * (1 + 1e-9) < lower))
    if len(failed):
        d = squared(q[failed], history[-1])
        best = d.argmin(axis=1)  # of equal ones the smaller number
        own = d[np.arange(len(d)), best]
        rest = np.full(len(d), math.inf)
        if k > 1:
            d[np.arange(len(d)), best] = d.max() + 1
            rest = np.sqrt(d.min(axis=1).astype(np.float64))
        new["cluster"][failed], new["seen"][failed] = best, now
        new["own"][failed], new["next"][failed] = np.sqrt(own.astype(np.float64)), rest
    return new, len(failed)


def limbs(value: int):
    """(number, signed part) of an integer's 60-bit limbs, so that sums of any size stay exact."""
    sign, value, n = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield n, sign * (value & ((1 << LIMB) - 1))
        value, n = value >> LIMB, n + 1


class _Sums:
    def __init__(self):
        self.total: dict[tuple[int, int], int] = {}

    def add(self, cluster: int, place: int, value: int) -> None:
        self.total[cluster, place] = self.total.get((cluster, place), 0) + value

    def add_rows(self, q: np.ndarray, clusters: np.ndarray) -> None:
        for c in np.unique(clusters).tolist():
            rows = q[clusters == c]
            self.add(c, COUNT, len(rows))
            for place, v in enumerate(rows.sum(axis=0).tolist()):
                self.add(c, place, int(v))

    def rows(self) -> list[dict]:
        return [{"cluster": c, "place": p, "limb": n, "part": part}
                for (c, p), v in self.total.items() for n, part in limbs(v)]


def _blocks(dim: int, kind: str, id_type: pa.DataType):
    """Packs vectors into numbered blocks of ids and raw bytes."""
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(id_type)), ("raw", pa.binary())])

    def pack(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            values = batch.column(1)
            flat = values.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)
            for at in range(0, batch.num_rows, BLOCK):
                yield pa.RecordBatch.from_arrays([
                    pa.array([number]), pa.array([batch.column(0).slice(at, BLOCK).to_pylist()], pa.list_(id_type)),
                    pa.array([flat[at:at + BLOCK].tobytes()], pa.binary())], schema=schema)
                number += 1

    return pack


def _round(history, dim: int, scale: int, kind: str, last: bool):
    """Assigns every block; the last row of a task holds its sums.  ``last``: clusters and distances instead of state."""
    moved = displacement(history)
    names = ["ids", "cluster", "distance", "sums"] if last else ["block", "state", "rescanned", "sums"]

    def step(batches):
        sums, block = _Sums(), None
        for batch in batches:
            for row in range(batch.num_rows):
                block, ids, raw, state = (batch.column(c)[row] for c in range(4))
                q = quantised(raw.as_py(), dim, scale, kind)
                old = state.as_py()
                new, rescanned = assign(q, None if old is None else np.frombuffer(old, STATE), history, moved)
                if not last:
                    sums.add_rows(q, new["cluster"])
                    yield pa.RecordBatch.from_arrays([pa.array([block.as_py()]), pa.array([new.tobytes()], pa.binary()),
                                                      pa.array([rescanned], pa.int64()), pa.nulls(1, SUM_TYPE)], names=names)
                    continue
                distance = np.zeros(len(q), dtype=object)
                for c in np.unique(new["cluster"]).tolist():
                    mine = new["cluster"] == c
                    d = [int(v) for v in squared(q[mine], [history[-1][c]])[:, 0].tolist()]
                    distance[mine] = d
                    sums.add(c, INERTIA, sum(d))
                fits = [v if v < 1 << 63 else None for v in distance.tolist()]
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(row, 1), pa.array([new["cluster"].tolist()], pa.list_(pa.int32())),
                    pa.array([fits], pa.list_(pa.int64())), pa.nulls(1, SUM_TYPE)], names=names)
        if block is not None:
            tail = [pa.array([block.as_py()]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64())] if not last else \
                [pa.nulls(1, batch.column(1).type), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*tail, pa.array([sums.rows()], SUM_TYPE)], names=names)

    return step


def _totals(table: DataFrame) -> dict[tuple[int, int], int]:
    """A round's sums: a few rows for each cluster and component."""
    rows = (table.filter("sums IS NOT NULL").select(F.inline("sums")).groupBy("cluster", "place", "limb")
            .agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect())
    total: dict[tuple[int, int], int] = {}
    for r in rows:
        total[r.cluster, r.place] = total.get((r.cluster, r.place), 0) + (int(r.part) << (LIMB * r.limb))
    return total


class _Bucketed:
    """Tables bucketed by block under one scratch folder; joined without a shuffle."""

    def __init__(self, spark, buckets: int):
        self.spark, self.buckets, self.folder = spark, buckets, scratch_path(spark, "clusters")
        self.names: list[str] = []
        forget_at_end(spark, self.folder)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        table = f"ns_{name}_{uuid.uuid4().hex[:12]}"
        (df.write.format("parquet").option("path", f"{self.folder}/{table}").bucketBy(self.buckets, "block")
         .saveAsTable(table))
        self.names.append(table)
        return self.spark.table(table)

    def forget(self, keep: int) -> None:
        """Drops all but the last tables; a round reads only the one before it."""
        from ..session import delete_path
        for table in self.names[1:len(self.names) - keep]:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            delete_path(self.spark, f"{self.folder}/{table}")
            self.names.remove(table)

    def close(self) -> None:
        for table in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: str = "3",
            vec_id: str = "vec_id", embedding: str = "embedding", buckets: int | None = None,
            report: list | None = None) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each vector that is kept.

    Kept are vectors of exactly ``dim`` components, none null, NaN or infinite;
    a component x counts as the integer floor(scale * x).  The first centroids
    are the kept vectors with the smallest SHA-256 of ``seed:vec_id`` (null ids
    last, equal ids by their components).  Each round assigns every vector to
    the nearest centroid, of equally near ones to the smaller number, and moves
    centroids to the floor of their means; a centroid without vectors stays.
    Rounds end early where no centroid moves, as later ones would change nothing.

    Rows that come twice are two vectors.  With fewer than ``k`` vectors there
    are fewer clusters; without any the result is empty.  Distances and
    inertias are exact; those that don't fit into 64 bits are null (components
    beyond about 2^28).  Columns other than the two named aren't read.
    ``buckets`` is the number of parts the vectors are dealt to (the session's
    shuffle partitions).  A list given as ``report`` gets (round, vectors
    compared with all centroids) for each round.
    """
    spark = vectors.sparkSession
    e = quoted(embedding)
    id_type = vectors.select(quoted(vec_id).alias("i")).schema["i"].dataType
    kind = "<f4" if "float" in dict(vectors.select(e.alias("e")).dtypes)["e"] else "<f8"
    fine = (F.size(e) == dim) & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                                         & (F.abs(v.cast("double")) < float("inf")))
    kept = vectors.filter(e.isNotNull() & fine).select(quoted(vec_id).alias("vec_id"), e.alias("embedding"))
    first = (kept.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "embedding")
             .orderBy(F.asc_nulls_last("h"), "embedding").limit(k).collect())
    out = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    if not first:
        return kept.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in zip(
            out[1:], ("int", "long", "long", "long", "string"))]).limit(0)
    start = np.array([r.embedding for r in first], kind)
    history = [[[int(v) for v in row] for row in quantised(start.tobytes(), dim, scale, kind)]]

    from pyspark.sql.pandas.types import to_arrow_type
    tables = _Bucketed(spark, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    id_ddl = id_type.simpleString()
    blocks = tables.write(kept.mapInArrow(_blocks(dim, kind, to_arrow_type(id_type)),
                                          f"block long, ids array<{id_ddl}>, raw binary")
                          .repartition(tables.buckets, "block"), "blocks")
    state = None
    none = F.lit(None).cast(f"array<{id_ddl}>").alias("ids")

    def inputs(ids) -> DataFrame:
        if state is None:
            return blocks.select("block", ids, "raw", F.lit(None).cast("binary").alias("state"))
        seen = state.filter("state IS NOT NULL").select("block", "state").hint("shuffle_hash")
        return blocks.join(seen, "block").select("block", ids, "raw", "state")

    for number in range(rounds):
        state = tables.write(inputs(none).mapInArrow(_round(history, dim, scale, kind, False),
                                                     f"block long, state binary, rescanned long, sums {SUMS}"), "state")
        if report is not None:
            report.append((number, state.agg(F.sum("rescanned")).first()[0]))
        total = _totals(state)
        tables.forget(keep=1)
        new = [[total.get((c, p), 0) // total[c, COUNT] for p in range(dim)] if total.get((c, COUNT)) else old
               for c, old in enumerate(history[-1])]
        if new == history[-1]:
            break
        history.append(new)

    assigned = staged(inputs(F.col("ids")).mapInArrow(
        _round(history, dim, scale, kind, True), f"ids array<{id_ddl}>, cluster array<int>, distance array<long>, sums {SUMS}"),
        "assigned")
    inertia = {c: v for (c, p), v in _totals(assigned).items() if p == INERTIA}
    tables.close()
    fits = lambda v: v if v < 1 << 63 else None
    whole = fits(sum(inertia.values()))
    about = spark.createDataFrame(
        [(c, fits(inertia.get(c, 0)), whole, sha256(",".join(map(str, row)).encode()).hexdigest())
         for c, row in enumerate(history[-1])],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    each = assigned.filter("ids IS NOT NULL").select(F.inline(F.arrays_zip("ids", "cluster", "distance"))).toDF(*out[:3])
    return each.join(F.broadcast(about), "cluster").select(*out)  # k rows


def oracle(k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: str = "3") -> str:
    """The same in SQL, a pair of steps for each round."""
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), embedding) AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {dim}),
x AS MATERIALIZED (
  SELECT r, vec_id, list_transform(embedding, lambda v: floor({scale} * v::DOUBLE)::BIGINT) AS q FROM kept),
e AS MATERIALIZED (SELECT r, unnest(range(1, {dim} + 1)) AS p, unnest(q) AS v FROM x),
c0 AS MATERIALIZED (SELECT (r - 1)::INTEGER AS cluster, p, v FROM e WHERE r <= {k})"""]
    for t in range(rounds + 1):
        steps.append(f"""
d{t} AS MATERIALIZED (
  SELECT r, cluster, sum((e.v - c.v) * (e.v - c.v))::BIGINT AS d FROM e JOIN c{t} c USING (p) GROUP BY r, cluster),
a{t} AS MATERIALIZED (
  SELECT r, arg_min(cluster, d * {k} + cluster) AS cluster, min(d) AS d FROM d{t} GROUP BY r)""")
        if t < rounds:
            steps.append(f"""
m{t} AS (SELECT cluster, p, sum(v)::HUGEINT AS s, count(*)::HUGEINT AS n FROM e JOIN a{t} USING (r) GROUP BY cluster, p),
c{t + 1} AS MATERIALIZED (
  SELECT c.cluster, c.p, coalesce((s - ((s % n) + n) % n) // n, c.v)::BIGINT AS v FROM c{t} c LEFT JOIN m{t} USING (cluster, p))""")
    t = rounds
    return ",".join(steps) + f"""
SELECT vec_id, a.cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, h.centroid_sha256
FROM a{t} a JOIN x USING (r)
JOIN (SELECT cluster, sha256(string_agg(v::VARCHAR, ',' ORDER BY p)) AS centroid_sha256 FROM c{t} GROUP BY cluster) h
  ON h.cluster = a.cluster"""
