"""SimHash near-duplicates by segment-popcount embedding.

A fingerprint of 64 bits is embedded as the bit counts of its 32 segments of
two bits.  One differing bit changes one count by one, so the Manhattan
distance of two embeddings is at most the Hamming distance of the
fingerprints: what is near in fingerprints is near in counts.

Grid range-join: the segments are dealt to ``2 d`` blocks.  At a Manhattan
distance of at most ``d``, at least ``d`` blocks agree in all their counts, so
a pair of links meets in at least one grid whose cells are the counts of ``d``
of the blocks (for d = 4: 70 grids, cells of 16 counts).  Pairs in a cell are
filtered by the Manhattan distance and then verified exactly.  A cell gives
the links of a spanning forest only, never all its pairs: for components this
loses nothing.

Counts 0, 1, 2 are written as 00, 01, 11.  The Manhattan distance of two
embeddings is then the number of bits in which these codes differ.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, staged
from .components import components

EVEN = 0x5555555555555555
#: Fingerprints of one cell that a task holds; larger cells are joined block by block.
CELL = 20_000
#: Shingles hashed at a time.
CHUNK = 255 * 64
#: Row v: bit k of the byte v in byte k of a 64-bit number, so that up to 255 rows add up without carry.
SPREAD = np.packbits(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
                     [:, :, None] * np.array([1, 0, 0, 0, 0, 0, 0, 0], np.uint8),
                     axis=2, bitorder="little").reshape(256, 8).copy().view("<u8").ravel()


def simhash(text: str | None, shingle: int) -> int:
    """Fingerprint as a signed 64-bit number; zero if there is no word."""
    import xxhash
    digest = xxhash.xxh64_intdigest
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    ends = starts[shingle:] or starts[-1:]
    total, sums = len(ends), np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        h = np.array([digest(joined[s:e - 1], 42) for s, e in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])],
                     dtype="<u8")
        packed = np.add.reduceat(SPREAD[h.view(np.uint8).reshape(-1, 8)], np.arange(0, len(h), 255), axis=0)
        sums += packed.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * sums > total, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 4) -> Column:
    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array([simhash(t, shingle) for t in texts.to_pylist()], pa.int64())

    return prints(text)


def embedding(fp: Column) -> Column:
    """Counts of the two-bit segments, in the code given above."""
    beside = F.shiftrightunsigned(fp, 1)
    some, both = fp.bitwiseOR(beside).bitwiseAND(F.lit(EVEN)), fp.bitwiseAND(beside).bitwiseAND(F.lit(EVEN))
    return some.bitwiseOR(F.shiftleft(both, 1))


def grids(max_distance: int) -> list[int]:
    """Masks over the embedding, one for each choice of ``max_distance`` blocks of segments."""
    blocks = np.array_split(np.arange(32), max(1, 2 * max_distance))
    masks = []
    for chosen in combinations(blocks, max(1, max_distance)):
        mask = sum(3 << (2 * int(s)) for block in chosen for s in block)
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return masks


def _forest(fp: np.ndarray, code: np.ndarray, d: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the fingerprints within distance d."""
    links, left = [], np.arange(len(fp))
    while left.size > 1:
        front, left = [left[0]], left[1:]
        while front and left.size:
            f = front.pop()
            near = np.bitwise_count(code[left] ^ code[f]) <= d
            near[near] = np.bitwise_count(fp[left[near]] ^ fp[f]) <= d
            if near.any():
                hit = left[near]
                links += [(f, h) for h in hit]
                front += list(hit)
                left = left[~near]
    return links


def _cell_links(cell: np.ndarray, fp: np.ndarray, code: np.ndarray, d: int):
    """Links within each of the cells, which come sorted: their ends as two arrays."""
    edge = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
    size = np.diff(edge)
    two = edge[:-1][size == 2]
    ok = np.bitwise_count(code[two] ^ code[two + 1]) <= d
    ok &= np.bitwise_count(fp[two] ^ fp[two + 1]) <= d
    a, b = [fp[two[ok]]], [fp[two[ok] + 1]]
    for s, n in zip(edge[:-1][size > 2], size[size > 2]):
        part = fp[s:s + n]
        if links := _forest(part, code[s:s + n], d):
            x = np.array(links)
            a.append(part[x[:, 0]])
            b.append(part[x[:, 1]])
    return np.concatenate(a), np.concatenate(b)


def _join_cells(d: int, most: int):
    """Of rows sorted by cell: links as (null, a, b); the rows of cells over ``most`` as (cell, fp, null)."""

    def join(batches):
        schema = pa.schema([("cell", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
        open_cell = [np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)]
        large = None

        def held(cell, fp):
            return pa.record_batch([pa.array(cell), pa.array(fp.view(np.int64)), pa.nulls(len(fp), pa.int64())], schema=schema)

        def linked(cell, fp, code):
            a, b = _cell_links(cell, fp, code, d)
            return pa.record_batch([pa.nulls(len(a), pa.int64()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

        for batch in batches:
            new = [batch.column(i).to_numpy() for i in range(3)]
            cell, fp, code = (np.concatenate([o, n.view(o.dtype)]) for o, n in zip(open_cell, new))
            if large is not None:  # the rest of a large cell
                n = int(np.searchsorted(cell, large, "right"))
                if n:
                    yield held(cell[:n], fp[:n])
                cell, fp, code = cell[n:], fp[n:], code[n:]
            if not len(cell):
                open_cell = [cell, fp, code]
                continue
            last = int(np.searchsorted(cell, cell[-1], "left"))
            edge = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
            for s, e in zip(edge[:-1], edge[1:]):  # few: whole cells over the limit
                if e - s > most:
                    yield held(cell[s:e], fp[s:e])
            size = np.repeat(np.diff(edge), np.diff(edge))
            done = (np.arange(len(cell)) < last) & (size <= most)
            if done.any():
                yield linked(cell[done], fp[done], code[done])
            large = cell[-1] if len(cell) - last > most else None
            open_cell = [x[last:] if large is None else x[:0] for x in (cell, fp, code)]
        if len(open_cell[0]):
            yield linked(*open_cell)

    return join


def near_links(prints: DataFrame, max_distance: int = 4, cell_rows: int = CELL) -> DataFrame:
    """``a, b``: links that connect all fingerprints (column ``fp``, distinct) within the distance.

    Every returned pair is within the distance, and any two fingerprints within
    it are connected by returned pairs.
    """
    code = embedding(F.col("fp"))
    cells = prints.select("fp", code.alias("code")).select(
        F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("code").bitwiseAND(F.lit(m)))
                            for i, m in enumerate(grids(max_distance))])).alias("cell"), "fp", "code")
    schema = "cell long, a long, b long"
    out = staged(cells.repartition("cell").sortWithinPartitions("cell")
                 .mapInArrow(_join_cells(max_distance, cell_rows), schema), "cells")
    found = out.filter("cell is null").select("a", "b")
    large = out.filter("cell is not null").select("cell", F.col("a").alias("fp")).distinct()
    if large.isEmpty():
        return found.distinct()
    # Blocks of at most half a cell's rows on average; each pair of blocks of a cell is a task's group.
    sizes = large.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) * 4 / cell_rows).alias("blocks"))
    dealt = large.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")))
    pairs = (dealt.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
             .select("fp", F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other")).alias("cell")))
    again = (pairs.select("cell", "fp", embedding(F.col("fp")).alias("code"))
             .repartition("cell").sortWithinPartitions("cell")
             .mapInArrow(_join_cells(max_distance, 1 << 40), schema))
    return found.union(again.select("a", "b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, max_distance: int = 4, cell_rows: int = CELL,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_key, fingerprint, component_id`` for each row.

    ``fingerprint`` has 16 hexadecimal digits; null and empty texts have zero
    and are linked like any other.  ``component_id`` is the smallest doc_id
    reachable over links of at most ``max_distance`` bits; null ids don't
    count, and a group that has no other id gets null.  ``text_key`` is a hash
    of the text.  Repeated rows are returned as often as they come; an empty
    table gives no rows; other columns aren't read.
    """
    prints = staged(docs.select(quoted(doc_id).cast("long").alias("doc_id"), F.xxhash64(quoted(text)).alias("text_key"),
                                fingerprint(quoted(text), shingle).alias("fp")), "prints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(near_links(classes.select("fp"), max_distance, cell_rows))
    groups = staged(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                    .withColumn("root", F.coalesce("root", "fp")), "groups")
    ids = groups.groupBy("root").agg(F.min("least").alias("component_id"))
    of = groups.join(ids, "root").select("fp", "root", "component_id")
    return (prints.join(of, "fp")
            .select("doc_id", "text_key", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    "component_id", "root"))


def deduplicate(docs: DataFrame, shingle: int = 4, max_distance: int = 4,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, all its columns as they are.

    The row of the smallest doc_id stays (ids before null; of several texts
    with that id, the one with the smallest hash; of repeated rows, one).
    """
    from pyspark.sql import Window
    found = near_duplicates(docs, shingle, max_distance, doc_id=doc_id, text=text)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key"))
    kept = found.groupBy("root").agg(first.alias("k")).select("k.doc_id", "k.text_key")
    kept = kept.select(F.struct("doc_id", "text_key").alias("k"))
    whole = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"),
                        F.struct(quoted(doc_id).cast("long").alias("doc_id"),
                                 F.xxhash64(quoted(text)).alias("text_key")).alias("key"))
    one = Window.partitionBy("key").orderBy(F.xxhash64("row"))
    return (whole.join(kept, whole.key.eqNullSafe(kept.k), "left_semi")
            .withColumn("n", F.row_number().over(one)).filter("n = 1").select("row.*"))
