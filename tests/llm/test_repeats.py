import random
import re

import pytest

from meterstream.llm import repeats as R


def plain_units(t, cut, least):
    """(start, end, words, what it is known by): pieces of enough words, short ones put together, short ones before a unit."""
    parts, short, at = [], [], 0
    for m in [*re.finditer(cut, t), None]:
        end = m.start() + len(m.group().rstrip()) if m else len(t)
        words = re.findall(r"[^\W_]+", t[at:end].lower())
        if len(words) >= least:
            if short:
                parts.append((short[0][0], short[-1][1], sum(len(w) for _, _, w in short), (*[x for _, _, w in short for x in w], None, *words)))
            parts.append((at, end, len(words), tuple(words)))
            short = []
        elif words:
            short.append((at, end, words))
            if sum(len(w) for _, _, w in short) >= least:
                all_words = [x for _, _, w in short for x in w]
                parts.append((short[0][0], end, len(all_words), tuple(all_words)))
                short = []
        at = m.end() if m else end
    return parts


def plain(rows, cut, least, run):
    """{(id, text): [(start, end, words, kept ids)]} by going through all units in order of rank."""
    from xxhash import xxh64_intdigest
    rank = lambda i: R.UNNAMED if i is None else i
    key = lambda t: (xxh64_intdigest(t.encode(), seed=42) ^ 1 << 63) - (1 << 63)  # noqa: E731  as a signed number
    pieces = {(rank(i), t): plain_units(t, cut, least) for i, t in rows if t}
    first = {}
    for (i, t), parts in pieces.items():
        for p in parts:
            first[p[3]] = min((i, key(t)), first.get(p[3], (i, key(t))))
    out = {}
    for (i, t), parts in pieces.items():
        runs, seen, now = [], set(), None
        for s, e, w, n in parts:
            if first[n] != (i, key(t)) or n in seen:
                if now is None:
                    runs.append(now := [s, e, 0, set()])
                now[1], now[2] = e, now[2] + w
                if first[n][0] != R.UNNAMED:
                    now[3].add(first[n][0])
            else:
                now = None
            seen.add(n)
        out[i, t] = [(s, e, w, sorted(k)) for s, e, w, k in runs if w >= run]
    return out


def sentence(r):
    return " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 12))).capitalize() + r.choice(".!?")


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    passages = [" ".join(sentence(r) for _ in range(8)) for _ in range(6)]
    common = sentence(r)
    out = []
    for i in range(150):
        parts = [sentence(r) for _ in range(r.randint(0, 12))]
        if i % 3 == 0:
            p = passages[r.randrange(6)]
            parts.insert(r.randint(0, len(parts)), p.upper() if i % 2 else p.replace(" ", "  "))
        if i % 2:
            parts.append(common)
        out.append((i, r.choice([" ", "\n"]).join(parts)))
    return out + [(200, None), (201, ""), (3, out[3][1]), (3, out[3][1]), (3, passages[0] + " same id"), (None, passages[1]), (None, passages[1]),
                  (None, passages[2] + "!"), (202, passages[3] + "\n\n" + passages[3]), (203, (sentence(r) + " ") * 9000), (204, "...\n\n!?"),
                  (205, "\n" * 200_000 + "a b c"), (206, passages[4].replace(" ", "!! ")), (207, passages[4].replace(" ", "!! ")),
                  (208, passages[5].replace(". ", ".*** "))]


@pytest.mark.parametrize("cut,least,run", [(R.LINES, 3, 25), (R.LINES, 1, 1), (R.PARAGRAPHS, 1, 10)])
def test_against_all_units_in_order(spark, rows, cut, least, run):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, REMOVED string, start int").repartition(5)
    want = plain(rows, cut, least, run)
    got = R.deduplicate(docs, cut, least, run)
    assert got.columns == ["doc_id", "text", "start", "removed"]
    expected = []
    for i, t in rows:
        spans = want.get((R.UNNAMED if i is None else i, t), [])
        new, at = "", 0
        for s, e, _, _ in spans:
            new, at = new + t[at:s], e
        expected.append((i, None if t is None else new + t[at:], spans))
    found = [(x.doc_id, x.text, [tuple(s) for s in x.removed]) for x in got.collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected))
    assert any(s for _, _, s in expected) and not all(s for _, _, s in expected)
    changed = R.deduplicate(docs, cut, least, run, changed_only=True).collect()
    assert len(changed) == sum(bool(s) for _, _, s in expected)


def test_empty_table(spark):
    assert R.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_short_repeats_go_too(spark):
    rows = [(1, "Read more here.\nOne text of its own."), (2, "Quite another text.\nRead more here."), (3, "read MORE here!\nA third text stands here.\nRead more here.")]
    got = {x.doc_id: x for x in R.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: x.text for i, x in got.items()} == {1: rows[0][1], 2: "Quite another text.\n", 3: "\nA third text stands here.\n"}
    assert {i: [(s.words, s.kept_doc_ids) for s in x.removed] for i, x in got.items()} == {1: [], 2: [(3, [1])], 3: [(3, [1])] * 2}


def test_a_short_piece_does_not_hide_the_unit_after_it(spark):
    rows = [(1, "ok\nThis is a repeated line here"), (2, "hm\nThis is a repeated line here"), (3, "hm\nThis is a repeated line here")]
    got = {x.doc_id: x for x in R.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].text for i in (1, 2, 3)] == [rows[0][1], "hm\n", ""]  # the third's short piece goes with its neighbour
    assert [[tuple(s) for s in got[i].removed] for i in (2, 3)] == [[(3, 31, 6, [1])], [(0, 31, 7, [1, 2])]]


def test_documents_without_an_id_or_with_one_id_rank_by_their_text(spark):
    line = "a passage that only they hold"
    rows = [(None, line), (None, line + "\nand one more line"), (7, "first of two texts\nshared by both"), (7, "shared by both\nsecond of two texts")]
    got = R.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(line in x.text for x in got) == 1 and sum("shared by both" in x.text for x in got) == 1
    odd = spark.createDataFrame([("a", line), ("3", line), (None, line + "!")], "doc_id string, text string")
    assert {x.doc_id: x.text for x in R.deduplicate(odd).collect()} == {"a": "", "3": line, None: ""}


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_digests_that_reach_over_tasks(spark, parts):
    """A unit that half of all documents hold lies in many tasks."""
    rows = [(i, f"own words of {i}\nshared words of all" + ("\nshared words of all" if i % 9 == 0 else "")) for i in range(5, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {x.doc_id: x for x in R.deduplicate(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got[5].text == rows[0][1] and all(x.text.rstrip() == f"own words of {i}" for i, x in got.items() if i > 5)
    assert all([tuple(s.kept_doc_ids) for s in x.removed] == [(5,)] for i, x in got.items() if i > 5)


def test_units_of_a_line_that_fills_many_tasks_pass_no_join(spark):
    """All but its first one go, within their own text too, and each names the document of the first."""
    rows = [(i, f"the one very common line\nonly number {i} says this\nthe one very common line") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8, "doc_id")
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = R.repeated_passages(docs)
        assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
        got = sorted((r.id, r.start, tuple(r.kept_doc_ids)) for r in found.collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    second = rows[0][1].rindex("the")
    assert [x for x in got if x[0] == 0] == [(0, second, (0,))]
    assert len(got) == 2 * 400 - 1 and {k for _, _, k in got} == {(0,)}


def test_all_repeated_units_are_settled_in_one_pass(spark):
    """Repeated units stay as they are, also in the text that has their first; of a digest that tasks begin with only the first unit goes."""
    import pyarrow as pa
    rows = [(1, 1, 5, 50, 3, 10, 20, 4, 5, 50, R.REPEATED), (2, 2, 6, 60, 0, 0, 9, 3, 6, 60, R.REPEATED), (2, 2, 6, 60, 1, 9, 18, 3, 6, 60, R.OPEN),
            (2, 2, 7, 70, 1, 9, 18, 3, 6, 60, R.OPEN), (3, 3, 8, 80, 0, 0, 9, 3, 8, 80, R.OPEN), (3, 3, 8, 80, 2, 20, 29, 3, 8, 80, R.AGAIN)]
    batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=[f.split()[0] for f in R.ROWS.split(", ")])
    got = [tuple(r.values()) for b in R._settled({(2, 2): (4, 40)})([batch, batch.slice(0, 0)]) for r in b.to_pylist()]
    assert got == [(5, 50, 3, 10, 20, 4, 5), (6, 60, 0, 0, 9, 3, 6), (6, 60, 1, 9, 18, 3, 4), (7, 70, 1, 9, 18, 3, 4), (8, 80, 2, 20, 29, 3, 8)]
    plan = R.repeated_passages(spark.createDataFrame([(1, "a line of words")], "doc_id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan


@pytest.mark.parametrize("n", [300, 600])
def test_repeats_of_a_common_line_grow_with_its_length(spark, n):
    """Each of its units but the first gives one row, however many tasks they fill."""
    rows = [(i, f"the one very common line\nonly number {i} says this") for i in range(n)]
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert R.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).count() == n - 1
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
