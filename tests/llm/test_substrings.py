"""Suffix arrays by grouping, and repeated byte strings against a plain count of all strings."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterstream.llm import substrings as S
from meterstream.llm.suffixes import equal_windows, suffix_array


def by_sorting(text):
    return sorted(range(len(text)), key=lambda i: text[i:])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array_is_the_sorted_order(text):
    assert suffix_array(text) == by_sorting(text)


@pytest.mark.parametrize("text", [b"", b"a", b"a" * 500, b"ab" * 300, b"ba" * 300, b"abaab" * 100 + b"b", bytes(range(256)) * 3])
def test_suffix_array_of_runs_and_periods(text):
    assert suffix_array(text) == by_sorting(text)


def test_suffix_array_of_a_long_run_is_linear():
    n = 300_000
    assert suffix_array(b"a" * n) == list(range(n - 1, -1, -1))


@pytest.mark.parametrize("length", [3, 8, 13, 64])
def test_equal_windows_are_numbered_alike(length):
    random.seed(length)
    text = bytes(random.choice(b"ab") for _ in range(400)) * 2
    begins = np.zeros(len(text), bool)
    begins[:len(text) - length + 1] = True
    places, number = equal_windows(text, begins, np.array(suffix_array(text)), length)
    classes = {}
    for p, n in zip(places, number):
        classes.setdefault(n, set()).add(text[p:p + length])
    assert all(len(c) == 1 for c in classes.values()) and len(classes) == len({text[i:i + length] for i in range(len(text) - length + 1)})


def test_equal_strings_have_one_gram():
    random.seed(3)
    shared = bytes(random.choices(b"abcdefgh ", k=500))
    grams = []
    for _ in range(2):
        data = bytes(random.choices(b"xyz", k=random.randint(0, 300))) + shared + bytes(random.choices(b"xyz", k=200))
        gram, start, end, _ = S.segments(data, 100)
        assert start[0] == 0 and (end[:-1] == start[1:]).all() and end[-1] == len(data) - 99
        at = data.index(shared)
        grams.append(np.repeat(gram, end - start)[at:at + 401])
    assert (grams[0] == grams[1]).all()


def plain(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(t[p:p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for p in range(len(t) - length + 1):
            if count[t[p:p + length]] > 1:
                gone[p + 1:p + length + 1] = True
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        out.append((i, len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, length, block=S.BLOCK):
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, kept int, Removed string").repartition(3)
    got = S.deduplicate(df, length, block=block)
    assert got.columns == ["doc_id", "text", "kept", "removed"]
    return sorted(((r.doc_id, len((r.text or "").encode()), sum(x["end"] - x["start"] for x in r.removed), len(r.removed),
                    sha256(bytes(r.kept)).hexdigest()) for r in got.collect()), key=str)


def fixture():
    random.seed(8)
    word = lambda: "".join(random.choices("abcdeéüß", k=random.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    a, b = text(60), text(40)
    rows = [(1, a), (2, a), (2, a), (None, a), (3, text(30) + a + text(5)), (4, text(20) + b + text(7) + b), (5, b[30:] + text(9)), (6, None), (7, ""),
            (8, "short"), (9, "z" * 300), (10, " " * 80 + text(10)), (11, "ab" * 100 + text(30)), (12, text(50) + "\x00" * 90 + text(3)),
            (13, text(5) + "\x00" * 70), (14, a[100:200] + b[50:150]), (None, None), (15, text(300)), (16, b[:64]), (17, b[1:64]), (18, "é" * 40)]
    # a passage in many documents, everything around it different
    return rows + [(100 + i, text(6) + " " + b + " " + text(6)) for i in range(60)]


@pytest.mark.parametrize("block", [200, 2000, S.BLOCK])
def test_equals_a_plain_count_for_any_block(spark, block):
    assert run(spark, fixture(), 64, block) == plain(fixture(), 64)


def test_longer_strings_and_long_runs(spark):
    rows = fixture() + [(50, "q" * 20_000), (51, "x" + "q" * 5_000), (52, "xyz" * 3_000)]
    assert run(spark, rows, 200) == plain(rows, 200)


def test_empty_table_and_too_short_strings(spark):
    assert run(spark, [], 200) == []
    with pytest.raises(ValueError):
        S.deduplicate(spark.createDataFrame([(1, "a")], "doc_id long, text string"), 40)


def test_ids_of_another_type(spark):
    df = spark.createDataFrame([("a", "m" * 70 + "n"), ("b", "k"), (None, "m" * 70)], "doc_id string, text string")
    assert sorted((str(r.doc_id), bytes(r.kept)) for r in S.deduplicate(df, 64).collect()) == [("None", b""), ("a", b"n"), ("b", b"k")]


def test_spans_merge_where_they_touch():
    assert S.covered([(5, 6), (0, 1), (30, 31)], 5) == [(0, 10), (30, 35)]


def test_frequent_grams_are_dealt_to_several_parts(spark, monkeypatch):
    monkeypatch.setattr(S, "_frequent", lambda places: places.select("gram").distinct().selectExpr("gram", "3L AS parts"))
    assert run(spark, fixture(), 64) == plain(fixture(), 64)


def test_a_frequent_gram_is_counted(spark):
    places = spark.range(40_000).selectExpr("CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS gram", "id AS k1", "id AS start")
    got = S._frequent(places).collect()
    assert [r.gram for r in got] == [5] and 250 < got[0].parts < 420
