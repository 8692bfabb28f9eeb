"""Removal of long repeated byte strings, found by suffix arrays over all documents.

A string of ``length`` bytes belongs to the gram (of 32 bytes) with the
smallest hash in it, so equal strings belong to equal grams.  Neighbouring
strings of one gram form a segment.

1. Of each document's segments only gram and place are written and sorted over
   all documents; those whose gram comes nowhere else are left alone.
2. The bytes of the others are dealt by gram, a frequent one (a third of all
   documents may hold it) by document, too, to as many parts as it needs.  A task builds suffix arrays
   (``suffixes``) over blocks of segments; equal strings stand side by side.
   Equal segments are counted first and stand there once, and parts that differ
   from all others of their gram are left out.
3. A gram in several parts or blocks has its strings counted once more over all
   blocks, a row for each different string of a block.
4. The bytes covered are cut out of each document.

Tasks hold a block and a document at a time; no group is collected.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import forget_at_end, quoted, staged, without
from .suffixes import equal_windows, suffix_array

GRAM = 32
#: Bytes of a block's suffix array, and strings of a segment at most (longer ones are split).
BLOCK, LONGEST = 1 << 14, 4096


def _key(doc_id: str, text: str) -> list[Column]:
    """128 bits for each pair of id and text; rows alike in both have one key but count as several."""
    t = F.coalesce(quoted(text), F.lit(""))
    return [F.xxhash64(quoted(doc_id), t).alias("k1"), F.xxhash64(t, quoted(doc_id), F.lit(1)).alias("k2")]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each gram of the bytes."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    size, power = 1, np.uint64(0xD6E8FEB86659FD93)
    with np.errstate(over="ignore"):
        while size < GRAM:
            h = h[:-size] * power + h[size:]
            power, size = power * power, 2 * size
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(28)
    return h


def segments(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """gram, first start, end of the starts of each segment, and where in it its gram is (-1: at several places)."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    h = gram_hashes(np.frombuffer(data, np.uint8))
    wide = length - GRAM + 1  # grams of a string
    least, size = h, 1
    while 2 * size <= wide:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    if size < wide:
        least = np.minimum(least[:size - wide], least[wide - size:])
    edges = np.flatnonzero(least[1:] != least[:-1]) + 1
    start, end = np.concatenate([[0], edges]), np.concatenate([edges, [len(least)]])
    gram = least[start]
    place = np.zeros(len(start), np.int64)
    for at in range(0, len(start), 4096):
        s, e, g = start[at:at + 4096], end[at:at + 4096], gram[at:at + 4096, None]
        first = s + (h[s[:, None] + np.arange(wide)] == g).argmax(axis=1)
        last = e - 1 + wide - 1 - (h[e[:, None] - 1 + np.arange(wide - 1, -1, -1)] == g).argmax(axis=1)
        place[at:at + 4096] = np.where(first == last, first - s, -1)
    return gram.view(np.int64), start, end, place


PLACES = "gram long, k1 long, k2 long, start long, extent long"


def packed(start: np.ndarray, end: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Length of a segment and place of its gram (under 65,535) as one number."""
    return (end - start) << 16 | (at + 1)


def _places(length: int):
    def rows(batches):
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c in (0, 1))
            held = []
            for n, text in enumerate(batch.column(2)):
                found = segments(text.as_buffer().to_pybytes() if text.is_valid else b"", length)
                if len(found[0]):
                    held.append((found[0], np.full(len(found[0]), k1[n]), np.full(len(found[0]), k2[n]), found[1], packed(*found[1:])))
                if held and (sum(len(x[0]) for x in held) > 50_000 or n == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)],
                                                     names=["gram", "k1", "k2", "start", "extent"])
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)],
                                                 names=["gram", "k1", "k2", "start", "extent"])

    return rows


def _shared(batches):
    """Of rows sorted by gram those whose gram comes twice; at the edges of a task all stay, as others may hold them."""
    names, before, held = ["gram", "k1", "k2", "start", "extent"], None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        g, twice = batch.column("gram").to_numpy(), batch.column("extent").to_numpy() & 0xFFFF == 0
        equal = g[1:] == g[:-1]
        left = np.concatenate([[before is None or before == g[0]], equal])
        keep = (left | np.concatenate([equal, [True]]) | twice)[:-1]
        yield batch.slice(0, batch.num_rows - 1).select(names).filter(pa.array(keep))
        if batch.num_rows > 1:
            before = g[-2]
        held = batch.slice(batch.num_rows - 1)
    if held is not None:
        yield held.select(names)


SEGMENTS = "gram long, same long, k1 long, k2 long, start long, at long, bytes binary"


def _cut(length: int):
    """Segments of the documents: bytes of the text from each first start to the end of the last string."""
    from xxhash import xxh3_64_intdigest

    def rows(batches):
        names = [f.split()[0] for f in SEGMENTS.split(", ")]
        for batch in batches:
            out, held = [], 0
            for text, k1, k2, found in zip(*(batch.column(c) for c in ("text", "k1", "k2", "found"))):
                data, k1, k2 = text.as_buffer().to_pybytes(), k1.as_py(), k2.as_py()
                for place in found.as_py():
                    end, at = place["start"] + (place["extent"] >> 16), (place["extent"] & 0xFFFF) - 1
                    for s in range(place["start"], end, LONGEST):
                        piece = data[s:min(end, s + LONGEST) + length - 1]
                        same = xxh3_64_intdigest(piece)
                        out.append((place["gram"], same - (1 << 63), k1, k2, s, at, piece))
                        held += len(piece)
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    return rows


HITS = "k1 long, k2 long, start long, end long, d1 long, d2 long, copies long"


class _Block:
    """Segments of a few grams: for each different one its occurrences."""

    def __init__(self, length: int):
        self.length, self.size = length, 0
        self.found: dict[tuple[int, int, bytes], list[tuple[int, int, int]]] = {}

    def add(self, gram: int, at: int, data: bytes, place: tuple[int, int, int]) -> None:
        places = self.found.get((gram, at, data))
        if places is None:
            places = self.found[gram, at, data] = []
            self.size += len(data)
        self.size += 1
        places.append(place)

    def worth_sorting(self, open_grams: set[int]):
        """((gram, offset, bytes), occurrences) of the parts of segments that may hold a string that comes again.

        Strings are told apart by how far into them the gram stands.  Those of
        a class (an eighth of the distances) have most of their bytes in
        common; where no other segment of the gram has the same ones there,
        none of them comes again.
        """
        wide = self.length - GRAM + 1
        classes = [(wide * j // 8, wide * (j + 1) // 8) for j in range(8)]
        count: dict[tuple[int, int, bytes], int] = {}
        those = []
        for (gram, at, data), places in self.found.items():
            here = []
            if at >= 0 and gram not in open_grams:
                starts = len(data) - self.length + 1
                for j, (lo, hi) in enumerate(classes):
                    if lo <= at and hi > at - starts + 1:
                        key = gram, j, data[at - lo:at - hi + 1 + self.length]
                        count[key] = count.get(key, 0) + len(places)
                        here.append((lo, hi, key))
            those.append(here)
        for ((gram, at, data), places), here in zip(self.found.items(), those):
            if at < 0 or gram in open_grams:
                yield (gram, 0, data), places
                continue
            again = [(lo, hi) for lo, hi, key in here if count[key] > 1]
            if again:
                first = max(0, at - again[-1][1] + 1)
                yield (gram, first, data[first:at - again[0][0] + self.length]), places

    def hits(self, open_grams: set[int]):
        """(k1, k2, start, end, d1, d2, copies): runs of repeated starts, and strings of the open grams with their digests."""
        from xxhash import xxh3_128_digest
        pieces = list(self.worth_sorting(open_grams))
        # Of a gram with one segment left, which several places hold, all strings come again: nothing is to be ordered.
        left = Counter(gram for (gram, _, _), _ in pieces)
        alone = [left[gram] == 1 and len(places) > 1 and gram not in open_grams for (gram, _, _), places in pieces]
        for ((_, offset, data), places), one in zip(pieces, alone):
            if one:
                for k1, k2, start in places:
                    yield k1, k2, start + offset, start + offset + len(data) - self.length + 1, None, None, None
        pieces = [p for p, one in zip(pieces, alone) if not one]
        text, starts, edges = bytearray(), [], []
        for (_, _, data), _ in pieces:
            edges.append(len(text))
            text += data + b"\0"  # no string that counts reaches over this
            starts.append(len(data) - self.length + 1)
        if not pieces:
            return
        text = bytes(text)
        edge, count = np.array(edges), np.array(starts)
        begins = np.zeros(len(text), bool)
        for e, c in zip(edges, starts):
            begins[e:e + c] = True
        order = np.array(suffix_array(text))
        places, number = equal_windows(text, begins, order, self.length)
        owner = np.searchsorted(edge, places, "right") - 1
        copies = np.array([len(p) for _, p in pieces])
        together = np.bincount(number, weights=copies[owner]).astype(np.int64)
        repeated = np.zeros(len(text), bool)
        repeated[places[together[number] > 1]] = True
        for n, ((_, offset, _), occurrences) in enumerate(pieces):
            r = np.concatenate([[False], repeated[edge[n]:edge[n] + count[n]], [False]])
            turns = np.flatnonzero(r[1:] != r[:-1]).tolist()
            for k1, k2, start in occurrences:
                for a, b in zip(turns[::2], turns[1::2]):
                    yield k1, k2, start + offset + a, start + offset + b, None, None, None
        if not open_grams:
            return
        is_open = np.array([gram in open_grams for (gram, _, _), _ in pieces])
        first = np.concatenate([[True], number[1:] != number[:-1]]) & is_open[owner]
        for place, n, own in zip(places[first].tolist(), number[first].tolist(), owner[first].tolist()):
            d = xxh3_128_digest(text[place:place + self.length])
            d1, d2 = (int.from_bytes(d[i:i + 8], "little", signed=True) for i in (0, 8))
            k1, k2, start = pieces[own][1][0]
            at = start + place - edges[own]
            one = together[n] == 1
            yield (k1 if one else None, k2 if one else None, at if one else None, at + 1 if one else None, d1, d2, int(together[n]))


def _search(length: int, limit: int):
    names = [f.split()[0] for f in HITS.split(", ")]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    def rows(batches):
        block, gram, cut = _Block(length), None, set()
        for b in batches:
            columns = (b.column(c).to_pylist() for c in ("gram", "at", "k1", "k2", "start", "bytes", "parts"))
            for g, at, k1, k2, start, data, parts in zip(*columns):
                if block.size > limit and (g != gram or block.size > 4 * limit):
                    if g == gram:
                        cut.add(g)  # goes on in the next block
                    found = list(block.hits(cut))
                    if found:
                        yield batch(found)
                    block, cut = _Block(length), {g} if g == gram else set()
                gram = g
                if parts is not None:
                    cut.add(g)  # has been dealt to several tasks
                block.add(g, at, data, (k1, k2, start))
        if block.found:
            found = list(block.hits(cut))
            if found:
                yield batch(found)

    return rows


def _frequent(places: DataFrame, share: int = 1000) -> DataFrame:
    """``gram, parts``: the grams with over a thousandth of all places, and to how many parts they are dealt.

    Counted on a sample by hash, as any choice gives the same result; fewer than
    a thousand of a sample's grams can have so many of it.
    """
    some = places.filter(F.pmod(F.xxhash64("k1", "start"), F.lit(64)) == 0)
    total = some.count()
    return (some.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") * share > total) & (F.col("n") > 64))
            .select("gram", F.ceil(F.col("n") * share / max(1, total)).alias("parts")))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``k1, k2, row, text`` written once, bucketed by key: both joins with what is found take the texts from there as they lie."""
    spark = docs.sparkSession
    buckets, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"texts_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, "texts")
    other = F.struct(*[quoted(c) for c in docs.columns if c != text], F.lit(0).alias("_")).alias("row")
    (docs.select(*_key(doc_id, text), other, quoted(text).alias("text")).repartition(buckets, "k1", "k2")
     .write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, "k1", "k2").saveAsTable(name))
    forget_at_end(spark, path)
    keyed = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # its entry; the files stay
    return keyed


def repeated_starts(keyed: DataFrame, length: int = 200, block: int = BLOCK) -> DataFrame:
    """``k1, k2, starts``: for texts by key (``k1, k2, text``) the places (start, end) where strings begin that begin elsewhere too.

    ``block`` is the number of bytes of a suffix array; results don't depend on it.
    """
    if length < 2 * GRAM:
        raise ValueError(f"strings of {2 * GRAM} bytes at least")
    whole = keyed.select("k1", "k2", F.coalesce("text", F.lit("")).alias("text"))
    places = staged(whole.mapInArrow(_places(length), PLACES), "grams")
    order = ["gram", "k1", "k2", "start"]
    shared = places.repartitionByRange(*order).sortWithinPartitions(*order)
    found = (shared.mapInArrow(_shared, "gram long, k1 long, k2 long, start long, extent long")
             .groupBy("k1", "k2").agg(F.collect_set(F.struct("gram", "start", "extent")).alias("found")))
    pieces = whole.join(found.hint("shuffle_hash"), ["k1", "k2"]).mapInArrow(_cut(length), SEGMENTS)
    # A frequent gram's segments are parted by document.
    dealt = (pieces.join(F.broadcast(_frequent(places)), "gram", "left")
             .withColumn("part", F.coalesce(F.pmod("k1", "parts"), F.lit(0))).repartition("gram", "part"))
    hits = staged(dealt.sortWithinPartitions("gram", "same").mapInArrow(_search(length, block), HITS), "hits")
    again = (hits.filter("d1 IS NOT NULL").groupBy("d1", "d2").agg(F.sum("copies").alias("n")).filter("n > 1").select("d1", "d2"))
    opened = hits.filter("d1 IS NOT NULL AND copies = 1").join(again, ["d1", "d2"])
    columns = ["k1", "k2", "start", "end"]
    return (hits.filter("d1 IS NULL").select(*columns).union(opened.select(*columns))
            .groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end")).alias("starts")))


def covered(starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings that begin in the given ranges."""
    out: list[list[int]] = []
    for start, end in sorted(starts):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end + length - 1)
        else:
            out.append([start, end + length - 1])
    return [(a, b) for a, b in out]


REMOVED = "array<struct<start:bigint,end:bigint>>"


def _cut_out(text: Column, starts: Column, length: int) -> Column:
    kind = pa.struct([("kept", pa.binary()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    @F.arrow_udf(f"struct<kept:binary,removed:{REMOVED}>")
    def cut(texts: pa.Array, places: pa.Array) -> pa.Array:
        out = []
        for t, p in zip(texts, places.to_pylist()):
            if not t.is_valid:
                out.append(None)
                continue
            data, kept, at = t.as_buffer().to_pybytes(), [], 0
            spans = covered([(x["start"], x["end"]) for x in p], length)
            for a, b in spans:
                kept.append(data[at:a])
                at = b
            out.append({"kept": b"".join([*kept, data[at:]]), "removed": [{"start": a, "end": b} for a, b in spans]})
        return pa.array(out, kind)

    return cut(text, starts)


def deduplicate(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text",
                block: int = BLOCK) -> DataFrame:
    """``docs`` with ``kept`` (the bytes left of the text) and ``removed`` (array of start, end in bytes of the text).

    Removed is every byte covered by a string of ``length`` bytes of UTF-8 that
    also begins anywhere else, in this document or another; strings are judged
    on the texts as they were, so every occurrence goes, the first one too.
    What is left may begin or end inside a character, hence bytes.  Null texts
    are empty; texts shorter than ``length`` lose nothing; rows that come twice
    are two documents, so their texts go if they are long enough; ids may be
    null, repeated or of any type that hashes.  Columns named ``kept`` or
    ``removed`` are replaced, others are handed through.
    """
    if length < 2 * GRAM:
        raise ValueError(f"strings of {2 * GRAM} bytes at least")
    keyed = _keyed(docs, doc_id, text)
    joined = keyed.join(repeated_starts(keyed, length, block).hint("shuffle_hash"), ["k1", "k2"], "left")
    some = F.col("starts").isNotNull()
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    cut = joined.withColumn("cut", _cut_out(F.when(some, F.coalesce("text", F.lit(""))), F.coalesce("starts", nothing), length))
    return cut.select(*[(F.col("text") if c == text else F.col("row").getField(c)).alias(c) for c in without(docs, "kept", "removed").columns],
                      F.when(some, F.col("cut.kept")).otherwise(F.coalesce("text", F.lit("")).cast("binary")).alias("kept"),
                      F.when(some, F.col("cut.removed")).otherwise(nothing).alias("removed"))


def summary(docs: DataFrame, length: int = 200) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each document."""
    return deduplicate(docs.select("doc_id", "text"), length).select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def oracle(length: int = 200) -> str:
    """Every string of every text, grouped by its MD5."""
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, i, md5(substr(h, 2 * i + 1, {2 * length})) AS m
      FROM (SELECT r, h, unnest(range(0, length(h) // 2 - {length - 1})) AS i FROM d WHERE length(h) >= {2 * length})),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY m) AS n FROM w) WHERE n > 1),
turn AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {length} THEN 0 ELSE 1 END AS new FROM rep),
run AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM turn),
span AS (SELECT r, min(i) AS s, max(i) + {length} AS e FROM run GROUP BY r, g),
gap AS (SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS a, s AS b FROM span
        UNION ALL SELECT r, max(e), 9223372036854775807 // 4 FROM span GROUP BY r),
kept AS (SELECT gap.r, string_agg(substr(h, 2 * a + 1, greatest(0, 2 * (least(b, length(h) // 2) - a))), '' ORDER BY a) AS k
         FROM gap JOIN d USING (r) GROUP BY gap.r),
lost AS (SELECT r, sum(e - s)::BIGINT AS n_removed, count(*) AS n_spans FROM span GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)"""
