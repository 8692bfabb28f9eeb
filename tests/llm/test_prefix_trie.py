"""The trie of conversations against a plain one."""

import random
from hashlib import md5, sha256
from zlib import crc32

import pytest

from meterstream.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string"


def rebuilt(rows, group=5, most=9):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, key), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % most
        base = c - (c % group if c >= 0 else -(-c % group))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain(rows, group=5, most=9):
    convs = rebuilt(rows, group, most)
    if not convs:
        return []
    kids, members, ends, last = {0: {}}, {0: []}, {}, {0: ("", "")}
    depth, parent = {0: 0}, {0: None}
    for c in sorted(convs):
        node = 0
        members[0].append(c)
        for turn in convs[c]:
            nxt = kids[node].get(turn)
            if nxt is None:
                nxt = kids[node][turn] = len(kids)
                kids[nxt], members[nxt], last[nxt], depth[nxt], parent[nxt] = {}, [], turn, depth[node] + 1, node
            node = nxt
            members[node].append(c)
        ends.setdefault(node, []).append(c)
    leaves, saved = {}, {}
    for node in sorted(kids, reverse=True):  # children have larger numbers
        leaves[node] = sum(leaves[k] for k in kids[node].values()) or 1
        saved[node] = (len(members[node]) - 1) * len(last[node][1].encode()) + sum(saved[k] for k in kids[node].values())
    return sorted(((members[n][0], depth[n], None if n == 0 else members[parent[n]][0], len(members[n]), len(kids[n]), leaves[n], saved[n],
                    sha256(",".join(map(str, ends.get(n, []))).encode()).hexdigest()) for n in kids), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in T.conversation_trie(df, **kw).collect()), key=str)


def test_random_conversations_equal_a_plain_trie(spark):
    random.seed(4)
    rows = [(c, t, random.choice(["user", "assistant"]), random.choice(["a", "bé", "", "ccc"]))
            for c in random.sample(range(400), 120) for t in range(random.randint(1, 12))]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, group=1, most=1) == plain(rows, 1, 1)  # no shared starts


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (0, None, "user", "first"), (0, 1, None, None), (0, 1, "", ""), (0, 1, "user", "x"),
            (3, 0, "user", "x"), (3, 0, "user", "x"), (-3, 5, "a", "b"), (-7, 5, "a", "b"), (2, 7, "ab", "c"), (7, 7, "a", "bc"),
            (1 << 60, 1, "u", "n"), (11, 0, "u", "w" * 70_000), (12, 3, "u", "only")]
    assert run(spark, rows) == plain(rows)
    assert run(spark, [(12, 3, "u", "only")]) == plain([(12, 3, "u", "only")])  # a conversation without turns
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "u", "x")]) == []


def test_long_conversations_take_several_rounds(spark):
    """Over 1,024 turns there are three levels of bands; branches at every kind of place."""
    rows = [(c, t, "u", f"{t}" if t < branch else f"{t} {c}") for c, branch, n in
            [(5, 0, 2500), (10, 31, 40), (15, 32, 64), (20, 33, 97), (25, 1000, 1100), (30, 1024, 2100), (35, 1025, 1026),
             (40, 9999, 2500), (45, 9999, 1024), (50, 9999, 32), (55, 2047, 2049)] for t in range(n)]
    rows = [(c, t, r, x if c != 5 else f"{t}") for c, t, r, x in rows]
    assert run(spark, rows, group=1, most=1) == plain(rows, 1, 1)


def test_a_conversation_numbered_in_parts(spark):
    n = T.BAND * T.PART + 40
    rows = [(c, t, "u", "same") for c in (10, 20) for t in range(n if c == 10 else n - 7)]
    got = T.conversation_trie(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), group=1, most=1)
    ends = {r.depth: r for r in got.filter("n_leaves = 1 AND depth >= " + str(n - 8)).collect()}
    assert got.count() == n + 1 and ends[n].n_convs == 1 and ends[n - 7].n_convs == 2
    assert ends[n - 7].saved_tokens == 4 and ends[n - 7].ends_sha256 == sha256(b"20").hexdigest()


def test_many_copies_end_in_one_node(spark):
    rows = [(c, t, "u", f"t{t}") for c in range(5, 2005) for t in range(3)] + [(c, 0, "u", "other") for c in range(3000, 3040)]
    assert run(spark, rows, group=1, most=1) == plain(rows, 1, 1)


def test_ends_are_hashed_in_pieces():
    import pyarrow as pa
    ids = list(range(-60_000, 60_000))
    batches = [pa.RecordBatch.from_arrays([pa.array([1] * len(x)), pa.array([2] * len(x)), pa.array([3] * len(x)), pa.array(x)],
                                          names=["depth", "k1", "k2", "conv"]) for x in (ids[:70_000], ids[70_000:])]
    pieces = list(T._written(batches))
    assert sum(p.num_rows for p in pieces) == 3
    assert list(T._hashed(pieces))[0].column("ends").to_pylist() == [sha256(",".join(map(str, ids)).encode()).hexdigest()]


@pytest.mark.parametrize("bad", ["x", None])
def test_ids_that_are_no_numbers_are_left_out(spark, bad):
    df = spark.createDataFrame([(bad, 1, "u", "a"), ("8", 1, "u", "b")], "conv_id string, turn int, role string, text string")
    assert [r.conv_id for r in T.conversation_trie(df, group=1, most=1).collect()] == [8, 8]
