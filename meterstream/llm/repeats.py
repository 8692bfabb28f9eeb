"""Removal of repeated passages by hashing lines or paragraphs.

A text is cut into units, at line ends and, as many texts have none, at the
ends of sentences (or at blank lines for paragraphs).  Units are folded to
lower-case letters and digits; equal digests are brought together over all
documents and the occurrence in the first document stays (by id, then by a hash
of the text).  A piece of fewer words than a unit has goes with the unit after
it where the two together are repeated.  Consecutive repeated units form a
passage; every passage is removed, however short, with its words and its offsets
in the text as it was.

Units are sorted over all documents by digest and rank, so a digest that a third
of all units share lies in many tasks; a task keeps a row at a time in mind.  The
digest that a task begins with may have come in tasks before; the last digest
of each task, a row of it, tells.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, staged, without

#: Where units end (a unit keeps what stands before the white space).
LINES, PARAGRAPHS = r"\n|[.!?][^\w\s]*\s+", r"\n\s*\n"
OTHER = re.compile(r"[\W_]+")
UNNAMED = (1 << 63) - 1  # the rank of a document without an id
UNITS = "id long, key long, unit int, start long, end long, words int, h1 long, h2 long, again boolean"
SCHEMA = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("unit", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                    ("words", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("again", pa.bool_())])


def units(text: str | None, cut: re.Pattern, least: int):
    """(start, end, words, digest, whether it came before in this text) of a text's units.

    Pieces of fewer than ``least`` words are held: with the next ones they make
    a unit of enough words, or they stand before one, as a unit that is known
    by its words and those of the one after it.  Short pieces at the end of a
    text are none.
    """
    from xxhash import xxh3_128_digest
    text = text or ""
    seen, at, start, last, held, words = set(), 0, 0, 0, [], 0

    def unit(start: int, end: int, words: int, known_by: str):
        digest = xxh3_128_digest(known_by.encode())
        again = digest in seen
        seen.add(digest)
        return start, end, words, digest, again

    for m in [*cut.finditer(text), None]:
        end = m.start() + len(m.group().rstrip()) if m else len(text)
        piece = OTHER.sub(" ", text[at:end].lower()).strip()
        if piece:
            n = piece.count(" ") + 1
            if n >= least:
                if held:
                    yield unit(start, last, words, " ".join(held) + "\n" + piece)
                yield unit(at, end, n, piece)
                held, words = [], 0
            else:
                start, last = start if held else at, end
                held.append(piece)
                words += n
                if words >= least:
                    yield unit(start, end, words, " ".join(held))
                    held, words = [], 0
        at = m.end() if m else end


def _units_of(cut: str, least: int):
    def rows(batches):
        pattern = re.compile(cut)
        for batch in batches:
            out = []
            for n, (i, key, text) in enumerate(zip(*(batch.column(j).to_pylist() for j in range(3))), 1):
                out += [(i, key, u, *x) for u, x in enumerate(units(text, pattern, least))]
                if out and (len(out) > 50_000 or n == batch.num_rows):
                    c = list(zip(*out))
                    h = np.frombuffer(b"".join(c[6]), "<i8").reshape(-1, 2)
                    columns = [*c[:6], h[:, 0], h[:, 1], c[7]]
                    yield pa.record_batch([pa.array(x, f.type) for x, f in zip(columns, SCHEMA)], schema=SCHEMA)
                    out = []

    return rows


def _key(doc_id: str, text: str) -> tuple[Column, Column]:
    return F.coalesce(quoted(doc_id).try_cast("long"), F.lit(UNNAMED)), F.xxhash64(quoted(text))


ROWS = "h1 long, h2 long, id long, key long, unit int, start long, end long, words int, first_id long, first_key long, kind int"
#: Kinds of rows that a task returns: repeated units; units of the digest it begins with, that came before in
#: their own text or not; and the first of its last digest.
REPEATED, AGAIN, OPEN, LAST = range(4)


def _repeated(batches):
    """Of units sorted by digest and rank, those that came before (and what only other tasks can tell)."""
    names = [f.split()[0] for f in ROWS.split(", ")]
    digest = first = opening = None
    for batch in batches:
        if not batch.num_rows:
            continue
        c = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("h1", "h2", "id", "key", "again")}
        new = np.concatenate([[True], (c["h1"][1:] != c["h1"][:-1]) | (c["h2"][1:] != c["h2"][:-1])])
        goes_on = digest == (c["h1"][0], c["h2"][0])
        opening = (c["h1"][0], c["h2"][0]) if opening is None else opening
        begun = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))  # of each row's digest
        first_id, first_key = c["id"][begun], c["key"][begun]
        if goes_on:
            first_id[begun == 0], first_key[begun == 0] = first
        digest = (c["h1"][-1], c["h2"][-1])
        first = (first_id[-1], first_key[-1])
        of_opening = (c["h1"] == opening[0]) & (c["h2"] == opening[1])
        gone = c["again"] | (c["id"] != first_id) | (c["key"] != first_key)
        kind = np.where(of_opening, np.where(c["again"], AGAIN, OPEN), REPEATED).astype(np.int32)
        rows = np.flatnonzero(gone | of_opening)
        if len(rows):
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*[kept.column(n) for n in names[:8]], pa.array(first_id[rows]), pa.array(first_key[rows]),
                                              pa.array(kind[rows])], names=names)
    if digest is not None:
        none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array([digest[0]]), pa.array([digest[1]]), *none, pa.array([first[0]]), pa.array([first[1]]),
                                          pa.array([LAST], pa.int32())], names=names)


FOUND = "id long, key long, unit int, start long, end long, words int, first long"


def _settled(begun: dict):
    """Repeated units and the document of their first; ``begun``: the first of each task's last digest."""
    names = [f.split()[0] for f in FOUND.split(", ")]

    def rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("h1", "h2", "id", "key", "kind")}
            first_id, first_key = (batch.column(n).to_numpy(zero_copy_only=False).copy() for n in ("first_id", "first_key"))
            opening = np.flatnonzero(c["kind"] != REPEATED)  # of digests that tasks begin with
            h1, h2 = c["h1"][opening], c["h2"][opening]
            for some in np.split(opening, np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1):
                if len(some) and (f := begun.get((int(c["h1"][some[0]]), int(c["h2"][some[0]])))) is not None:
                    first_id[some], first_key[some] = f
            kept = np.flatnonzero((c["kind"] != OPEN) | (c["id"] != first_id) | (c["key"] != first_key))
            yield pa.RecordBatch.from_arrays([*[batch.column(n).take(pa.array(kept)) for n in names[:6]], pa.array(first_id[kept])], names=names)

    return rows


def repeated_passages(docs: DataFrame, cut: str = LINES, least_words: int = 3, least_run: int = 1,
                      doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, key, start, end, words, kept_doc_ids``: passages that came before, of documents by id and text hash.

    ``kept_doc_ids`` are the documents in which the units of a passage stay.
    ``words`` is the length of a passage; with a ``least_run`` shorter ones are left out.
    """
    i, key = _key(doc_id, text)
    every = staged(docs.select(i.alias("id"), key.alias("key"), quoted(text).alias("text"))
                   .mapInArrow(_units_of(cut, least_words), UNITS), "units")
    order = ["h1", "h2", "id", "key", "unit"]
    found = staged(every.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_repeated, ROWS), "repeated")
    begun: dict[tuple[int, int], tuple[int, int]] = {}  # as many rows as tasks
    for r in found.filter(F.col("kind") == LAST).select("h1", "h2", "first_id", "first_key").collect():
        begun[r.h1, r.h2] = min(begun.get((r.h1, r.h2), (r.first_id, r.first_key)), (r.first_id, r.first_key))
    repeated = (found.filter(F.col("kind") != LAST).mapInArrow(_settled(begun), FOUND).groupBy("id", "key", "unit")  # rows that come twice are one document
                .agg(F.min("start").alias("start"), F.min("end").alias("end"), F.min("words").alias("words"), F.min("first").alias("first")))
    number = F.row_number().over(Window.partitionBy("id", "key").orderBy("unit"))
    return (repeated.withColumn("run", F.col("unit") - number).groupBy("id", "key", "run")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"),
                 F.array_sort(F.collect_set(F.when(F.col("first") < UNNAMED, F.col("first")))).alias("kept_doc_ids"))
            .filter(F.col("words") >= least_run).drop("run"))


def _without(text: Column, start: Column, end: Column) -> Column:
    @F.arrow_udf("string")
    def cut(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        out = []
        for t, ss, es in zip(texts.to_pylist(), starts.to_pylist(), ends.to_pylist()):
            if t is None:
                out.append(None)
                continue
            parts, at = [], 0
            for s, e in zip(ss, es):
                parts.append(t[at:s])
                at = e
            out.append("".join([*parts, t[at:]]))
        return pa.array(out, pa.string())

    return cut(text, start, end)


def deduplicate(docs: DataFrame, cut: str = LINES, least_words: int = 3, least_run: int = 1, doc_id: str = "doc_id",
                text: str = "text", changed_only: bool = False) -> DataFrame:
    """``docs`` with repeated passages cut out, and ``removed``: array of start, end, words, kept_doc_ids.

    Offsets are in characters of the text as it was.  The occurrence in the
    document with the smallest id stays (within a document the first one), of
    documents that share an id that of the smallest text hash; documents
    without an id, or with one that is no whole number, come last.  Rows that
    share id and text are one document: they get equal results.  Null and empty
    texts have no units; a column named ``removed`` is replaced.
    With ``changed_only`` documents that lost nothing are left out.
    """
    found = (repeated_passages(docs, cut, least_words, least_run, doc_id, text).groupBy("id", "key")
             .agg(F.array_sort(F.collect_list(F.struct("start", "end", "words", "kept_doc_ids"))).alias("removed")))
    i, key = _key(doc_id, text)
    whole = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), i.alias("id"), key.alias("key"))
    joined = whole.join(found, ["id", "key"], "inner" if changed_only else "left")
    new = F.when(F.col("removed").isNotNull(), _without(
        F.when(F.col("removed").isNotNull(), F.col("row")[text]),
        F.coalesce(F.col("removed.start"), F.array().cast("array<long>")),
        F.coalesce(F.col("removed.end"), F.array().cast("array<long>")))).otherwise(F.col("row")[text])
    kept = without(docs, "removed").columns
    nothing = F.array().cast("array<struct<start:bigint,end:bigint,words:bigint,kept_doc_ids:array<bigint>>>")
    return joined.select(*[new.alias(c) if c == text else F.col("row")[c].alias(c) for c in kept],
                         F.coalesce("removed", nothing).alias("removed"))
