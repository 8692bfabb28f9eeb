import base64
import gzip
import hashlib
import io
import random

import duckdb
import pandas as pd
import pytest

from meterstream.llm import warc as W


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree_merges(k):
    r = random.Random(k)
    runs = [sorted(r.randrange(40) for _ in range(r.choice([0, 1, 7, 30]))) for _ in range(k)]
    order = list(W.LoserTree(runs))
    assert [runs[a][b] for a, b in order] == sorted(x for run in runs for x in run)
    assert order == sorted(order, key=lambda x: (runs[x[0]][x[1]], x[0], x[1]))


def rows():
    r = random.Random(2)
    tricky = ["", None, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "é𝔘\n\r\n\r\n", "x" * 300_000, " ", "\r\n\r\n"]
    out = [(i, f"http://www.Site{i % 5}.example.com:80/p?q={i % 3}#f", r.choice(tricky + [f"page {i % 40}"])) for i in range(150)]
    return out + [(3, out[3][1], out[3][2]), (3, out[3][1], out[3][2]), (None, None, "page 1"), (None, "u", "alone, no id"),
                  (None, "u", "alone, no id"), (500, None, "x\n"), (501, "https://me@h.org\r\nX: y", "z"), (502, "noslash", "z")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*x, 1, "a") for x in rows()], "page_id long, url string, html string, first int, sha string").repartition(4)


def plain():
    first = {}
    for i, _, h in rows():
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows():
        p = (h or "").encode()
        f = first.get(h or "")
        again = f is not None and f != i
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", f if again else None))
    return sorted(map(str, out))


def test_round_trip_and_order(spark, pages, tmp_path):
    W.write_archives(pages, str(tmp_path / "w"), records_per_file=17)
    files = sorted((tmp_path / "w").glob("part-*.gz"))
    assert len(files) > 8
    text = gzip.decompress(files[0].read_bytes())
    stream, n = io.BytesIO(text), 0
    while W.parse(stream) is not None:
        n += 1
    assert 0 < n <= 17 and stream.read() == b""
    got = W.capture_histories(W.read_archives(spark, str(tmp_path / "w"))).collect()
    assert sorted(str((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to)) for x in got) == plain()
    by_order = sorted(got, key=lambda x: x.history_order)
    key = lambda x: ((x.url_key is not None, x.url_key), x.captured_at, (x.page_id is not None, x.page_id))
    assert [key(x) for x in by_order] == sorted(map(key, got)) and len({x.history_order for x in got}) == len(got)
    assert {x.url for x in got if x.page_id == 501} == {"https://me@h.org%0D%0AX: y"}


def test_altered_archives_are_refused(pages, tmp_path):
    good = W.records(pages).filter("record like '%page 7%'").first().record.encode() + b"\r\n\r\n"
    assert W.parse(io.BytesIO(good))["payload_bytes"] == 6
    for bad in (good.replace(b"page 7", b"page 8"), good[:-1], good.replace(b"WARC/1.1", b"WARC/9.9", 1)):
        with pytest.raises(ValueError):
            W.parse(io.BytesIO(bad))


def test_equals_sql(spark, pages):
    got = W.archive(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key")
    frame = pd.DataFrame(rows(), columns=["page_id", "url", "html"]).astype({"page_id": "Int64"})  # noqa: F841
    con = duckdb.connect()
    con.execute("CREATE TABLE pages AS SELECT page_id, replace(replace(url, chr(13), '%0D'), chr(10), '%0A') AS url, html FROM frame")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({W.oracle()})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_empty_table(spark):
    assert W.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


IDS = [10**13, 4 * 10**11, -1, -(10**13), 0, 315_360_000, 315_359_999, (1 << 63) - 1, -(1 << 63)]


def test_ids_of_any_size_and_the_order(spark):
    frame = pd.DataFrame([(i, f"http://h.org/{n % 3}", f"page {n % 4}") for n, i in enumerate(IDS)], columns=["page_id", "url", "html"])
    got = W.archive(spark.createDataFrame(frame, "page_id long, url string, html string"))
    con = duckdb.connect()
    con.execute("CREATE TABLE pages AS SELECT * FROM frame")
    names = ["page_id", "captured_at", "history_order", "record_type", "refers_to", "url_key"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({W.oracle()})").fetchall()
    rows = got.select(*names).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert sorted(r.history_order for r in rows) == list(range(1, len(IDS) + 1)) and all("2020" <= r.captured_at[:4] < "2030" for r in rows)


def test_ids_that_are_no_numbers_count_as_null(spark):
    df = spark.createDataFrame([("a", "u", "x"), ("7", "u", "x"), (None, "u", "x")], "page_id string, url string, html string")
    got = {(r.page_id, r.record_type, r.refers_to) for r in W.archive(df).collect()}
    assert got == {(7, "response", None), (None, "revisit", 7)}


def test_order_is_dense_over_many_ranges(spark, pages):
    path = W.scratch_path(spark, "warc-test")
    W.write_archives(pages, path)
    captures = W.read_archives(spark, path)
    got = W.capture_histories(captures, rows=20).collect()
    assert sorted(r.history_order for r in got) == list(range(1, len(rows()) + 1))
    key = lambda x: ((x.url_key is not None, x.url_key), x.captured_at, (x.page_id is not None, x.page_id))
    assert [key(x) for x in sorted(got, key=lambda x: x.history_order)] == sorted(map(key, got))


def test_a_capture_is_fetched_alone(spark, pages):
    index = W.archive(pages)
    some = index.filter("page_id % 7 = 3 OR page_id IS NULL")
    html = {i: (h or "").encode() for i, _, h in rows() if i is not None}
    got = {(r.archive, r.offset): r.payload for r in W.fetch(some.select("archive", "offset", "length")).collect()}
    asked = some.collect()
    assert len(got) == len(asked)
    for r in asked:
        payload = got[r.archive, r.offset]
        assert payload is None if r.record_type == "revisit" else r.page_id is None or bytes(payload) == html[r.page_id]
    assert W.fetch(index.limit(0).select("archive", "offset", "length")).count() == 0


def test_large_pages_take_files_of_their_own_and_records_several_members(spark):
    large = "".join(random.Random(3).choices("abcdefgh", k=3000)) * 6000  # 18 MB
    page = [(1, "u", "small"), (2, "u", "m" * 20_000), (3, "u", large), (4, "u", "x" * (1 << 23)), (5, "u", large), (6, "u", "WARC/1.1\r\n" * 10)]
    path = W.scratch_path(spark, "warc-test")
    W.write_archives(spark.createDataFrame(page, "page_id long, url string, html string").coalesce(1), path)
    got = {r.page_id: r for r in W.read_archives(spark, path).collect()}
    assert {i: r.payload_bytes for i, r in got.items()} == {i: len(h) for i, _, h in page}
    assert got[5].refers_to == 3 and got[3].archive != got[1].archive != got[2].archive
