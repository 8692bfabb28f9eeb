"""Best-fit packing into sequences by patterns of few documents.

Documents are encoded and cut into pieces of at most one context.  The
histogram of piece lengths has as many bins as the context has tokens, however
many documents there are.  Patterns of one to three lengths that fill a
context are enumerated; non-negative least squares fits their repeat counts to
the histogram; the counts are rounded down to what the histogram holds, and
what remains of it is packed best-fit, longest first.  The plan says, for the
r-th piece of each length, its sequence and place; pieces are numbered by
length in parallel, so no task gathers a sequence or a length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, staged
from .encode import encoder

PIECE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))


def pieces(text: Column, tokenizer: str, context: int, end: int) -> Column:
    """Array of start, length, ids_crc32: the ids of the text and ``end``, cut into contexts.

    The first piece is the shorter one.
    """
    last = end.to_bytes(4, "little")

    @F.arrow_udf("array<struct<start:bigint,length:bigint,ids_crc32:bigint>>")
    def cut(texts: pa.Array) -> pa.Array:
        packed, out = encoder(tokenizer).packed, []
        for t in texts.to_pylist():
            ids = (packed(t) if t else b"") + last
            n = len(ids) // 4
            edges = [0, *range(n % context or context, n + 1, context)] if n > context else [0, n]
            out.append([{"start": s, "length": e - s, "ids_crc32": zlib.crc32(ids[4 * s:4 * e])}
                        for s, e in zip(edges, edges[1:])])
        return pa.array(out, PIECE)

    return cut(text)


def patterns(counts: np.ndarray, middles: int = 24) -> np.ndarray:
    """Rows of up to three lengths (0: none) that fill a context of ``len(counts) - 1`` tokens.

    All singles and pairs of lengths that occur, and for each longest length
    the triples whose second length is one of ``middles`` evenly spread over
    those that occur.
    """
    context = len(counts) - 1
    there = counts > 0
    out = [(context, 0, 0)] if there[context] else []
    for a in np.flatnonzero(there)[::-1]:
        rest = context - a
        if rest <= 0:
            continue
        if rest <= a and there[rest]:
            out.append((a, rest, 0))
        second = np.flatnonzero(there[:min(a, rest - 1) + 1])
        second = second[(second >= rest - second) & there[rest - second]]
        if second.size > middles:
            second = second[np.linspace(0, second.size - 1, middles).astype(int)]
        out += [(a, b, rest - b) for b in second]
    return np.array(out, np.int64).reshape(-1, 3)


def non_negative_least_squares(p: np.ndarray, counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeats x >= 0 of the patterns for which their lengths come nearest to the counts.

    Accelerated projected gradient, restarted where it overshoots.  Each bin's
    error is weighted by one over the root of its count.
    """
    size = len(counts)
    weight = 1 / np.sqrt(np.maximum(counts, 1.0))
    weight[0] = 0.0
    goal = counts * weight

    def lengths(x):
        return sum(np.bincount(p[:, j], x, size) for j in range(3)) * weight

    def back(r):
        r = r * weight
        return r[p].sum(axis=1)

    v = np.ones(len(p))
    for _ in range(15):
        v = back(lengths(v))
        top = np.linalg.norm(v)
        v /= top
    x = y = np.zeros(len(p))
    t, step = 1.0, 1 / (1.1 * top)
    for _ in range(rounds):
        new = np.maximum(y - step * back(lengths(y) - goal), 0)
        if (y - new) @ (new - x) > 0:
            t = 1.0
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / after * (new - x), new, after
    return x


def best_fit(counts: np.ndarray, context: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit decreasing over a histogram: (length and copies, ... ; sequences) for each kind of sequence."""
    open_bins: dict[int, list] = {}  # room -> [[lengths, sequences], ...]
    rooms = 0  # bit r: there are sequences with room r

    def put(room, lengths, n):
        nonlocal rooms
        open_bins.setdefault(room, []).append([lengths, n])
        rooms |= 1 << room

    for length in range(context, 0, -1):
        left = int(counts[length])
        while left:
            above = rooms >> length
            room = length + (above & -above).bit_length() - 1 if above else context
            if above:
                lengths, n = open_bins[room].pop()
                if not open_bins[room]:
                    rooms &= ~(1 << room)
            else:
                lengths, n = [], left
            copies = room // length
            full = min(n, left // copies)
            if full:
                put(room - copies * length, [*lengths, (length, copies)], full)
                left, n = left - full * copies, n - full
            if left and n:  # fewer copies than fit
                put(room - left * length, [*lengths, (length, left)], 1)
                left, n = 0, n - 1
            if n and lengths:
                put(room, lengths, n)
    return [(lengths, n) for groups in open_bins.values() for lengths, n in groups]


def pack_histogram(counts: np.ndarray, shares=(1.0, 0.98, 0.95, 0.9)) -> list[tuple[list[tuple[int, int]], int]]:
    """Kinds of sequences that hold exactly the pieces counted: (length and copies, ... ; sequences).

    Of the fitted repeats each of ``shares`` is tried, as what is left over
    packs better when it still has short pieces; the fewest sequences win.
    """
    context, best = len(counts) - 1, None
    p = patterns(counts)
    x = non_negative_least_squares(p, counts.astype(float)) if len(p) else np.empty(0)
    order = np.argsort(-x, kind="stable")
    for share in shares:
        left, plan = counts.astype(np.int64).copy(), []
        for i in order:
            n = int(share * x[i] + 0.5)
            if not n:
                continue
            lengths, copies = np.unique(p[i][p[i] > 0], return_counts=True)
            n = min(n, int((left[lengths] // copies).min()))
            if n:
                left[lengths] -= n * copies
                plan.append(([(int(a), int(c)) for a, c in zip(lengths, copies)], n))
        plan += best_fit(left, context)
        if best is None or sum(n for _, n in plan) < sum(n for _, n in best):
            best = plan
    return best or []


class Places:
    """Where the r-th piece of a length goes."""

    def __init__(self, plan: list[tuple[list[tuple[int, int]], int]]):
        rows, taken, sequence = [], {}, 0
        for lengths, n in plan:
            offset = 0
            for length, copies in lengths:
                rows.append((length, taken.get(length, 0), copies, sequence, offset))
                taken[length] = taken.get(length, 0) + copies * n
                offset += length * copies
            sequence += n
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.key = table[:, 0] << 44 | table[:, 1]
        self.length, self.first, self.copies, self.sequence, self.offset = table.T

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length << 44 | rank, "right") - 1
        sequence, copy = np.divmod(rank - self.first[at], self.copies[at])
        return self.sequence[at] + sequence, self.offset[at] + copy * length


def _placed(length: Column, rank: Column, places: Places, spark) -> Column:
    sent = spark.sparkContext.broadcast(places)

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        s, o = sent.value(lengths.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(s), pa.array(o)], names=["sequence_id", "offset"])

    return place(length, rank)


def pack(docs: DataFrame, tokenizer: str, context: int = 2048, end: int = 0, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: a row for each piece.

    A document is the ids of its whole text and ``end``; null and empty texts
    are ``end`` alone.  Repeated rows are packed as often as they come; an
    empty table gives no rows; other columns aren't read.  Sequences are
    numbered from 0 and hold pieces from offset 0 without gaps.
    """
    spark = docs.sparkSession
    cut = docs.select(quoted(doc_id).alias("doc_id"), pieces(quoted(text), tokenizer, context, end).alias("p"))
    # The task that cut a piece is its block from here on: numbers within a block, then blocks in a row.
    rows = staged(cut.select("doc_id", F.posexplode("p").alias("piece", "p"))
                  .select("doc_id", "piece", "p.*", F.spark_partition_id().alias("block")), "pieces")
    sizes = rows.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = np.zeros(context + 1, np.int64)
    for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``context`` rows
        histogram[r.length] = r.n
    places = Places(pack_histogram(histogram))
    within = Window.partitionBy("block", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(within) - 1).join(bases, ["block", "length"])
    return (ranked.withColumn("p", _placed(F.col("length"), (F.col("rank") + F.col("base")).cast("long"), places, spark))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "p.sequence_id", "p.offset"))
