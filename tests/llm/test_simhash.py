import random
import re

import numpy as np
import pytest
import xxhash

from meterstream.llm import simhash as S
from meterstream.llm.components import components


def plain_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, prints, d):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= d:
                parent[root(i)] = root(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[root(i)] = min(x, least.get(root(i), x))
    return [least.get(root(i)) for i in range(len(ids))], [least.get(r) for r in {root(i) for i in range(len(ids))}]


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


TEXTS = [None, "", " \t\n\x0b\x0c\r", "one", "one two three", "A b C d E", "a B c D e", "é É x y z\x1cw q",
         "w " * 300, "w " * 301, " ".join(str(i % 97) for i in range(40_000))]


def test_fingerprints():
    for t in TEXTS:
        assert S.simhash(t, 4) & (1 << 64) - 1 == plain_fingerprint(t), t
        assert S.simhash(t, 2) & (1 << 64) - 1 == plain_fingerprint(t, 2), t


def test_embedding_is_a_lower_bound(spark):
    r = random.Random(1)
    x = [r.getrandbits(64) for _ in range(200)] + [0, (1 << 64) - 1]
    rows = spark.createDataFrame([(signed(v),) for v in x], "fp long").select("fp", S.embedding(S.F.col("fp")).alias("c")).collect()
    code = {row.fp & (1 << 64) - 1: row.c & (1 << 64) - 1 for row in rows}
    count = lambda v: [(v >> 2 * s & 3).bit_count() for s in range(32)]
    for a in x[:40] + x[-2:]:
        for b in x:
            manhattan = sum(abs(p - q) for p, q in zip(count(a), count(b)))
            assert (code[a] ^ code[b]).bit_count() == manhattan <= (a ^ b).bit_count()


@pytest.mark.parametrize("cell_rows", [20_000, 6])
@pytest.mark.parametrize("d", [0, 2, 4])
def test_links_connect_what_is_near(spark, cell_rows, d):
    r = random.Random(d)
    x = {r.getrandbits(64) for _ in range(60)}
    for centre in list(x)[:6]:
        for _ in range(30):
            v = centre
            for _ in range(r.randint(1, 6)):
                v ^= 1 << r.randrange(64)
            x.add(v)
    x = sorted(x)
    links = S.near_links(spark.createDataFrame([(signed(v),) for v in x], "fp long"), d, cell_rows)
    for a, b in links.collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= d
    roots = {r.node & (1 << 64) - 1: r.root for r in components(links).collect()}
    want, _ = plain_components(list(range(len(x))), x, d)
    groups = {}
    for v, w in zip(x, want):
        groups.setdefault(roots.get(v, signed(v)), set()).add(w)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1100)]
    odd = [(5, 5), (3, 2), (2, 3), (None, 4), (-9, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star + odd, "x long, y long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(1000, 1100)}, -9: -9, 2: -9, 3: -9}
    assert components(spark.createDataFrame([], "x long, y long")).collect() == []


def rows_of():
    r = random.Random(3)
    base = [" ".join(r.choice("abcdefghij") * r.randint(1, 3) for _ in range(r.randint(5, 120))) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    for i in range(120):
        w = r.choice(base).split()
        if i % 3:
            w[r.randrange(len(w))] = "zz"
        rows.append((100 + i, " ".join(w).upper() if i % 7 == 0 else " ".join(w)))
    return rows + [(5, TEXTS[5]), (5, TEXTS[5]), (None, base[0]), (None, "all alone in here"), (100, "other text, same id")]


def test_near_duplicates_against_all_pairs(spark):
    rows = rows_of()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, fp int, root string")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.near_duplicates(docs).collect()), key=str)
    prints = [plain_fingerprint(t) for _, t in rows]
    comp, one_each = plain_components([i for i, _ in rows], prints, 4)
    want = sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, comp)), key=str)
    assert got == want
    kept = S.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(one_each, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(docs).collect() == [] and S.deduplicate(docs).collect() == []
