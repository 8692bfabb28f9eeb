"""WARC archives of pages, and the index of their captures.

Records are written as WARC 1.1 through Spark's text writer, each a gzip member
of its own (any store Spark writes to, committed like any other output), and
read back member by member, so that the index has the place and length of each
record and a capture can be fetched alone.  Of pages with equal payloads the
one with the smallest id is a response, the others are revisits that refer to it.

The index: captures are dealt to ranges of (URL key, time, id) of a bounded
number of rows, so that a URL captured very often is split by time; within a
range each archive's captures form a sorted run, and a loser tree merges the
runs.  Ranges are numbered one after another.
"""

from __future__ import annotations

import io
import re
import zlib
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import forget_at_end, quoted, staged

END = "\r\n"
# The digits of base 32, and the profile of a revisit record.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Pages have no capture time; ids count its seconds, and begin anew after ten years' worth.
SECONDS = 315_360_000
#: Most bytes of payload, and how many records a file holds then: about 256 MB at most, but for larger records.
FILES = ((1 << 14, 16_384), (1 << 20, 256), (1 << 26, 4), (None, 1))
#: Captures of a range of the index: what a task merges.
RANGE = 200_000
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base-32 SHA-1 of a binary or text column."""
    h = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def url_key(url: Column) -> Column:
    """Host from its top domain down, then the rest: ``com,example,m)/en/25``; null for null."""
    u = F.regexp_replace(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://", "")
    u = F.regexp_replace(F.regexp_replace(u, r"^[^/?#]*@", ""), "(?s)#.*$", "")
    host = F.regexp_replace(F.regexp_extract(u, "^[^/?:]*", 0), r"^www\.", "")
    rest = F.regexp_replace(u, r"^[^/?:]*(:[0-9]*)?", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"),
                    F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest)))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            start: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """``record``: a WARC record as text for each page, without the blank lines that end it; ``size`` of the payload.

    Pages have no capture time of their own; they get one second each from
    ``start`` on, by id (modulo ten years, so that any id gives a date).
    """
    payload = F.coalesce(quoted(html), F.lit(""))
    # Only digests are shuffled; payloads are joined with the few digests that come more than once.
    seen = pages.select(quoted(page_id).try_cast("long").alias("id"), F.unhex(F.sha1(payload.cast("binary"))).alias("sha"))
    again = (seen.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
             .filter("n > 1 AND first IS NOT NULL").select("sha", "first"))
    rows = pages.select(quoted(page_id).try_cast("long").alias("id"),
                        F.regexp_replace(F.regexp_replace(quoted(url), "\r", "%0D"), "\n", "%0A").alias("url"),
                        payload.alias("payload"), F.unhex(F.sha1(payload.cast("binary"))).alias("sha"))
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    header = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
                    header("Content-Length", F.octet_length("payload").cast("string")), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    when = F.date_format(F.to_timestamp(F.lit(start)) + F.make_dt_interval(secs=F.coalesce(F.pmod("id", F.lit(SECONDS)), F.lit(0)).cast("decimal(18,6)")),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.join(again, "sha", "left").select(F.concat(
        F.lit(f"WARC/1.1{END}"),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", _urn(F.col("id"))), header("WARC-Date", when),
        F.coalesce(header("WARC-Target-URI", F.col("url")), F.lit("")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        F.when(revisit, F.concat(header("WARC-Profile", F.lit(REVISIT)), header("WARC-Refers-To", _urn(F.col("first"))))).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{END}"),
        header("Content-Length", F.octet_length(block).cast("string")), F.lit(END), block).alias("record"),
        F.octet_length("payload").alias("size"))


def _members(record: Column) -> Column:
    """Records, with the blank lines that end them, as gzip members without their last byte.

    That byte is the highest of the length, zero below 16 MB; the writer puts
    it after each record as its separator.  Longer records take several members.
    """
    @F.arrow_udf("binary")
    def compress(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            data = memoryview(t.as_buffer().to_pybytes() + 2 * END.encode())
            parts = []
            for at in range(0, len(data), 1 << 23):
                c = zlib.compressobj(5, zlib.DEFLATED, 31)
                parts += (c.compress(data[at:at + (1 << 23)]), c.flush())
            out.append(b"".join(parts)[:-1])
        return pa.array(out, pa.binary())

    return compress(record).cast("string")  # bytes as they are


def _name(spark, path: str) -> None:
    """Gives the files the ending of what they hold."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(folder):
        p = f.getPath()
        if p.getName().endswith(".txt"):
            fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(folder, p.getName().removesuffix(".txt") + ".warc.gz"))


def write_archives(pages: DataFrame, path: str, html: str = "html", records_per_file: int | None = None, **columns) -> None:
    """Writes the pages as gzip WARC files; a task writes its own pages, so payloads aren't dealt anew.

    Files hold about 256 MB of payload at most (and ``records_per_file``): pages
    are written in classes of their length (of most tables there is one or two),
    so many to a file.
    """
    size = F.coalesce(F.octet_length(quoted(html)), F.lit(0))
    bounds = [(0 if n == 0 else FILES[n - 1][0], most, count) for n, (most, count) in enumerate(FILES)]
    within = [(size >= lo) & (F.lit(True) if most is None else size < most) for lo, most, _ in bounds]
    there = pages.agg(*[F.count(F.when(w, 1)).alias(f"c{n}") for n, w in enumerate(within)]).first()
    every = records(pages, html=html, **columns)
    for n, (w, (lo, most, count)) in enumerate(zip(within, bounds)):
        if there[n] or (n == 0 and not any(there)):  # an empty table gives an empty file
            rows = every.filter((F.col("size") >= lo) & (F.lit(True) if most is None else F.col("size") < most))
            (rows.select(_members(F.col("record")).alias("value")).write.mode("append").option("lineSep", "\0")
             .option("maxRecordsPerFile", min(count, records_per_file or count)).text(path))
    _name(pages.sparkSession, path)


def parse(stream) -> list[dict] | None:
    """The next record of a stream, as its index row; None at the end."""
    line = stream.readline()
    if not line:
        return None
    if line != b"WARC/1.1\r\n":
        raise ValueError(f"no WARC record begins with {line[:40]!r}")
    head = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.partition(b": ")
        head[name.decode().lower()] = value.decode()
    block = stream.read(int(head["content-length"]))
    if stream.read(4) != b"\r\n\r\n":
        raise ValueError(f"record {head['warc-record-id']} isn't as long as it says")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest, size = head["warc-payload-digest"].removeprefix("sha1:"), int(http.rpartition(b"Content-Length: ")[2])
    if head["warc-type"] == "response":
        import base64
        if base64.b32encode(sha1(payload).digest()).decode() != digest or len(payload) != size:
            raise ValueError(f"record {head['warc-record-id']} has another payload than it says")
    number = lambda urn: None if urn is None or urn == "<urn:page:null>" else int(urn[10:-1])
    return {"page_id": number(head["warc-record-id"]), "url": head.get("warc-target-uri"), "captured_at": head["warc-date"],
            "payload_bytes": size, "payload_digest": digest, "record_type": head["warc-type"],
            "refers_to": number(head.get("warc-refers-to"))}


LENGTH = re.compile(rb"\r\nContent-Length: (\d+)")
CAPTURE = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
                     ("captured_at", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64())])
CAPTURES = ("archive string, offset long, length long, page_id long, url string, captured_at string, payload_bytes long, "
            "payload_digest string, record_type string, refers_to long")


def members(content: memoryview, at: int = 0):
    """(offset, length, bytes) of the records of an archive; one is unpacked at a time."""
    while at < len(content):
        begun, record, need = at, b"", 1
        while len(record) < need:
            if at >= len(content):
                raise ValueError(f"the record at {begun} is cut off")
            d, parts = zlib.decompressobj(31), []
            for s in range(at, len(content), 1 << 20):
                parts.append(d.decompress(content[s:s + (1 << 20)]))
                if d.eof:
                    at = min(s + (1 << 20), len(content)) - len(d.unused_data)
                    break
            else:
                raise ValueError(f"the member at {at} is cut off")
            record += b"".join(parts)
            head = record.find(b"\r\n\r\n")  # a long record takes several members
            length = LENGTH.search(record, 0, head) if head >= 0 else None
            need = head + 4 + int(length[1]) + 4 if length else len(record) + (head < 0)
        yield begun, at - begun, record


def _read(batches):
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = []
            for offset, length, data in members(memoryview(content.as_buffer())):
                rows.append({"archive": path, "offset": offset, "length": length, **parse(io.BytesIO(data))})
                if len(rows) == 2000:
                    yield pa.RecordBatch.from_pylist(rows, CAPTURE)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, CAPTURE)


def read_archives(spark, path: str) -> DataFrame:
    """A row for each record of the archives, with its place; payloads are checked against their digests and left behind."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(_read, CAPTURES)


def fetch(captures: DataFrame) -> DataFrame:
    """``archive, offset, payload`` of the captures given: only their members are unpacked.  Revisits have no payload."""
    spark = captures.sparkSession
    asked = captures.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("places"))  # of one file
    folders = [r[0] for r in asked.select(F.regexp_replace("archive", "/[^/]*$", "").alias("f")).distinct().collect()]
    if not folders:
        return captures.select("archive", "offset", F.lit(None).cast("binary").alias("payload"))
    files = spark.read.format("binaryFile").load(folders).select(F.col("path").alias("archive"), "content")

    def unpack(batches):
        for batch in batches:
            for path, content, places in zip(*(batch.column(c) for c in ("archive", "content", "places"))):
                data = memoryview(content.as_buffer())
                for place in places.as_py():
                    _, _, record = next(members(data[:place["offset"] + place["length"]], place["offset"]))
                    head, _, block = record[:-4].partition(b"\r\n\r\n")
                    payload = block.partition(b"\r\n\r\n")[2] if b"WARC-Type: response" in head else None
                    yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([place["offset"]]), pa.array([payload], pa.binary())],
                                                     names=["archive", "offset", "payload"])

    return files.join(asked, "archive").mapInArrow(unpack, "archive string, offset long, payload binary")


class LoserTree:
    """Merges sorted runs: each inner node keeps the run that lost there, the top is the least head.

    A run is a list of keys in order; iterating gives (run, place) of each key.
    """

    def __init__(self, runs: list[list]):
        self.runs, self.at = runs, [0] * len(runs)
        self.losers = [-1] * max(1, len(runs))
        self.winner = -1
        for run in range(len(runs)):
            self._play(run, build=True)

    def _less(self, a: int, b: int) -> bool:
        """Whether run a's head comes first; an exhausted run comes last, of equal heads the lower run first."""
        done_a, done_b = self.at[a] >= len(self.runs[a]), self.at[b] >= len(self.runs[b])
        if done_a or done_b:
            return not done_a
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return x < y or (x == y and a < b)

    def _play(self, run: int, build: bool = False) -> None:
        node = (run + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0 and build:  # the first to come here waits
                self.losers[node] = run
                return
            if other >= 0 and self._less(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.winner = run

    def __iter__(self):
        while self.winner >= 0 and self.at[self.winner] < len(self.runs[self.winner]):
            run = self.winner
            yield run, self.at[run]
            self.at[run] += 1
            self._play(run)


def _merge(batches):
    """Of one range's rows, sorted within each archive: the rows in order of their keys, numbered."""
    from pyspark import TaskContext
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts)
    archive = rows.column("archive").to_pylist()
    least = lambda c: [(x is not None, x) for x in rows.column(c).to_pylist()]  # noqa: E731  nulls first, as Spark sorts
    keys = list(zip(least("url_key"), least("captured_at"), least("page_id")))
    edges = [0, *(i for i in range(1, len(archive)) if archive[i] != archive[i - 1]), len(archive)]
    runs = [keys[s:e] for s, e in zip(edges, edges[1:])]
    order = [edges[run] + at for run, at in LoserTree(runs)]
    part = pa.array([TaskContext.get().partitionId()] * len(order), pa.int32())
    merged = rows.take(pa.array(order)).append_column("part", part).append_column("at", pa.array(range(1, len(order) + 1), pa.int64()))
    yield from merged.combine_chunks().to_batches(max_chunksize=10_000)


def capture_histories(captures: DataFrame, rows: int = RANGE) -> DataFrame:
    """The captures with ``url_key`` and ``history_order``, which numbers them from 1 by URL key, time and id.

    ``rows`` is about how many captures a task merges.
    """
    keyed = staged(captures.select("*", url_key(F.col("url")).alias("url_key")), "captures")
    ranges = 1 + keyed.count() // rows
    ranged = (keyed.repartitionByRange(ranges, "url_key", "captured_at", "page_id")
              .sortWithinPartitions("archive", "url_key", "captured_at", "page_id"))
    merged = staged(ranged.mapInArrow(_merge, CAPTURES + ", url_key string, part int, at long"), "histories")
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = merged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", before.alias("before"))  # a row for each range
    return (merged.join(F.broadcast(starts), "part").withColumn("history_order", F.col("before") + F.col("at"))
            .drop("part", "at", "before"))


def archive(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Writes the pages as WARC files, reads them back and merges their index.

    A row for each page: page_id, url, captured_at, payload_bytes,
    payload_digest, record_type, refers_to, url_key, history_order, and where
    its record is: archive, offset, length (``fetch`` reads it).  Ids are long
    integers of any size, below zero too; what is no number counts as null.
    A null html is an empty payload; a null id is never referred to where the
    group has another (of a group with null ids only, all are responses);
    repeated rows are responses or revisits alike; null URLs come first in the
    index; an empty table gives no rows; other columns aren't read.
    """
    spark = pages.sparkSession
    kept = path is not None
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, **columns)
    if not kept:
        forget_at_end(spark, path)
    return capture_histories(read_archives(spark, path))


def oracle() -> str:
    chunk = "('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT"
    digit = f"substr('{BASE32}', 1 + (({chunk} >> (35 - 5 * (i % 8))) & 31)::INTEGER, 1)"
    return f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p),
u AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(trim(url, ' ')), '^[a-z][a-z0-9+.-]*://', ''),
             '^[^/?#]*@', ''), '#.*$', '', 's') AS u FROM f),
k AS (SELECT *, regexp_replace(regexp_extract(u, '^[^/?:]*'), '^www\\.', '') AS host,
             regexp_replace(u, '^[^/?:]*(:[0-9]*)?', '') AS rest FROM u)
SELECT page_id, strlen(t)::BIGINT AS payload_bytes, captured_at,
       row_number() OVER (ORDER BY url_key NULLS FIRST, captured_at, page_id NULLS FIRST) AS history_order,
       payload_digest, record_type, refers_to, url_key FROM (
SELECT page_id, t, strftime(TIMESTAMP '2020-01-01' + to_seconds(coalesce(((page_id % {SECONDS}) + {SECONDS}) % {SECONDS}, 0)), '%Y-%m-%dT%H:%M:%SZ') AS captured_at,
       array_to_string(list_transform(range(32), lambda i: {digit}), '') AS payload_digest,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to,
       array_to_string(list_reverse(string_split(host, '.')), ',') || ')' ||
       CASE WHEN starts_with(rest, '/') THEN rest ELSE '/' || rest END AS url_key
FROM k)""".replace("\\\\.", "\\.")
