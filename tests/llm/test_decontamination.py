import random

import numpy as np
import pytest

from meterstream.llm import decontamination as D


def codes(s):
    return np.array([ord(c) for c in s], np.uint32)


def plain_best(item, text):
    """Fewest edits of the item against any region: the whole table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def plain_bounded(item, text):
    """Fewest edits of the item against any region that begins and ends at word bounds."""
    far, bound = 10 ** 6, D.word_bounds(codes(text))
    row = [0 if b else far for b in bound]
    for i, c in enumerate(item, 1):
        new = [row[0] + 1]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(v for v, b in zip(row, bound) if b)


def edited(r, s, n):
    for _ in range(n):
        i = r.randrange(len(s))
        s = [s[:i] + s[i + 1:], s[:i] + r.choice("abcde ") + s[i:], s[:i] + r.choice("abcde") + s[i + 1:]][r.randrange(3)]
    return s


def test_fold():
    a, at = D.folded("  A--bé_C!!\n x² 𝔘\U0002000B ")
    assert "".join(map(chr, a)) == "a bé c x² 𝔘\U0002000B"
    assert list(at) == [2, 3, 5, 6, 7, 8, 9, 13, 14, 15, 16, 17]
    assert [len(x) for x in D.folded(None)] == [len(x) for x in D.folded(" ?!")] == [0, 0]


def test_grams_tell_equal_substrings():
    a = codes("abcabdabcabd" * 3)
    for q in range(1, 20):
        h = D.grams(a, q)
        s = ["".join(map(chr, a[i:i + q])) for i in range(len(a) - q + 1)]
        assert len(h) == len(s) and [[x == y for y in h] for x in h] == [[x == y for y in s] for x in s]
    assert len(D.grams(a[:3], 10)) == 0


def test_align_equals_the_whole_table():
    r = random.Random(2)
    for _ in range(120):
        item = "".join(r.choice("abc") for _ in range(r.randint(8, 30)))
        pre = "".join(r.choice("abc") for _ in range(r.randint(0, 9)))
        text = pre + edited(r, item, r.randint(0, 4)) + "".join(r.choice("abc") for _ in range(r.randint(0, 9)))
        k = r.randint(0, 6)
        want = plain_best(item, text)
        got = D.align(codes(item), codes(text), 0, len(text), k)
        assert (got is None) == (want > k), (item, text)
        if got:
            assert got[0] == want
            assert plain_best_whole(item, text[got[1]:got[2]]) == want


def plain_best_whole(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, t in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho sigma tau ups phi chi psi omega".split()


def prose(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def case(spark):
    r = random.Random(5)
    items = [(i, prose(r, r.randint(8, 30))) for i in range(12)] + [(12, "short"), (None, prose(r, 20)), (13, None), (14, "")]
    rows = []
    for i in range(64):
        t = prose(r, r.randint(0, 50))
        if i % 2:
            hit = items[r.randrange(12)][1]
            kind = i % 8
            hit = hit.upper().replace(" ", "!! ") if kind == 1 else edited(r, hit, r.randint(1, max(1, len(hit) // 8))) if kind in (3, 5) else hit
            cut = r.randint(0, len(t))
            t = t[:cut] + " " + hit + ". " + t[cut:]
        rows.append((i, t))
    rows += [(7, rows[7][1]), (200, None), (201, ""), (None, items[3][1]), (202, prose(r, 20_000) + " " + items[4][1])]
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, hits int, item_id string")
    return docs, rows, spark.createDataFrame(items, "item_id long, text string"), items


@pytest.mark.parametrize("block_chars", [4_000_000, 900])
def test_against_every_pair(case, block_chars):
    docs, rows, benchmark, items = case
    got = D.contaminated(docs, benchmark, block_chars=block_chars).collect()
    text = dict(rows)
    fold = lambda t: "".join(map(chr, D.folded(t)[0]))
    pairs = {(r.doc_id, r.item_id) for r in got}
    for r in got:
        if r.doc_id in text:
            item = fold(items[r.item_id][1])
            assert plain_best_whole(item, fold(text[r.doc_id][r.start:r.end])) == r.edits <= 0.1 * len(item)
    for i, t in rows:
        if t is None or len(t) > 5000:
            continue
        f = fold(t)
        for item_id, x in items:
            if item_id is None or not x or len(fold(x)) < 32:
                continue
            x = fold(x)
            k = min(len(x) // 10, (len(x) - 8) // 8)
            assert (plain_bounded(x, f) <= k) == ((i, item_id) in pairs), (i, item_id)
    assert (202, 4) in pairs and sum(r.doc_id == 7 for r in got) % 2 == 0
    kept = D.decontaminate(docs, benchmark, block_chars=block_chars)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows if i not in {p[0] for p in pairs})


def test_empty_tables(case):
    docs, rows, benchmark, _ = case
    assert D.contaminated(docs.limit(0), benchmark).count() == 0
    assert D.decontaminate(docs, benchmark.limit(0)).count() == len(rows)


def test_long_texts_are_taken_in_blocks(monkeypatch):
    r = random.Random(9)
    items = [(i, prose(r, 20)) for i in range(6)]
    index = D.Index(items, 8, 0.1, 32)
    text = " ".join(prose(r, 60) + " " + items[i % 6][1] for i in range(30))
    want = D.find(text, index)
    assert len(want) == 30
    monkeypatch.setattr(D, "BLOCK", 700)
    assert D.find(text, index) == want


def test_short_items_are_found(spark):
    items = [(1, "What is a quine?"), (2, "E = mc2"), (3, "水の化学式は"), (4, "青空と海の色が同じ理由は何ですか。"), (5, "?!"), (6, "ox"), (7, "e=MC2")]
    rows = [(1, "Say: what is a QUINE? Then"), (2, "so e = mc2 holds, e=mc2."), (3, "xe mc2 e mc23 e=mc"), (4, "では水の化学式は何か"),
            (5, "問い「青空と海の色が同じ理由は何ですか」。"), (6, "box oxen fox"), (7, "ox"), (8, "An ox."), (9, ""), (10, None), (11, "ox ox " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.edits, rows[r.doc_id - 1][1][r.start:r.end]) for r in D.contaminated(docs, benchmark).collect()]
    assert sorted(got) == sorted([(1, 1, 0, "what is a QUINE"), *[(2, i, 0, x) for i in (2, 7) for x in ("e = mc2", "e=mc2")], (4, 3, 0, items[2][1]),
                                  (5, 4, 0, items[3][1][:-1]), (7, 6, 0, "ox"), (8, 6, 0, "ox"), *[(11, 6, 0, "ox")] * 6])
    assert sorted(r.doc_id for r in D.decontaminate(docs, benchmark).collect()) == [3, 6, 9, 10]


def test_items_of_every_length_between_and_inside_words(spark):
    """5 to 40 characters: between words found, inside words not, unless the rest of the words fits into the budget."""
    r = random.Random(11)
    items, rows = [], []
    for n in range(5, 41):
        words = "".join(r.choice("abcdefgh") for _ in range(n))
        words = words[:n // 2] + " " + words[n // 2 + 1:] if n > 6 else words
        items.append((n, words))
        rows += [(10 * n, f"qqqq {words} zzzz"), (10 * n + 1, f"qqqqqqqq{words}zzzzzzzz"), (10 * n + 2, f"qqqqqqqq{words} zzzzzzzz"),
                 (10 * n + 3, f"qqqqqqqq {words}zzzzzzzz"), (10 * n + 4, f"{words}"), (10 * n + 5, f"qqqq {words}s zz")]
    docs, benchmark = (spark.createDataFrame(x, f"{i} long, text string") for x, i in ((rows, "doc_id"), (items, "item_id")))
    got = {(x.doc_id, x.item_id) for x in D.contaminated(docs, benchmark).collect()}
    text = dict(rows)
    for n, item in items:
        k = min(n // 10, (n - 8) // 8) if n >= 8 else 0
        for i in range(10 * n, 10 * n + 6):
            assert ((i, n) in got) == (plain_bounded(item, text[i]) <= k), (item, text[i])
        assert (10 * n, n) in got and (10 * n + 4, n) in got and (10 * n + 1, n) not in got


def test_one_block_of_the_index_at_a_time(spark, monkeypatch):
    r = random.Random(12)
    items = [(i, prose(r, 12)) for i in range(60)]
    docs = spark.createDataFrame([(i, prose(r, 9) + " " + x + " " + prose(r, 9)) for i, x in items], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    live, most, send = set(), [], type(spark.sparkContext).broadcast

    def counted(self, value):
        sent = send(self, value)
        if isinstance(value, D.Index):
            live.add(id(sent))
            most.append((len(live), len(value.texts)))
            gone = sent.destroy
            sent.destroy = lambda: (live.discard(id(sent)), gone())
        return sent

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", counted)
    for f in (D.contaminated, D.decontaminate):
        most.clear()
        out = f(docs, benchmark, block_chars=600)
        assert len(most) > 5 and max(n for n, _ in most) == 1 and max(n for _, n in most) < 30 and not live
        assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == (60 if f is D.contaminated else 0)


def test_items_with_ids_that_are_no_numbers(spark):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    benchmark = spark.createDataFrame([("a", "one two three"), ("7", "two three")], "item_id string, text string")
    assert [r.item_id for r in D.contaminated(docs, benchmark).collect()] == [7]


def test_short_items_in_long_texts(monkeypatch):
    r = random.Random(3)
    text = " ".join(r.choice(WORDS) for _ in range(400))
    index = D.Index([(i, w) for i, w in enumerate(WORDS)] + [(99, "mu mu"), (100, "alpha beta gamma")], 8, 0.1, 1)
    want = D.find(text, index)
    words = text.split()
    for i, w in enumerate(WORDS):
        assert sum(x["item_id"] == i for x in want) == words.count(w)
    assert all(text[x["start"]:x["end"]] == WORDS[x["item_id"]] for x in want if x["item_id"] < 99)
    monkeypatch.setattr(D, "BLOCK", 50)
    assert D.find(text, index) == want
