import random
import zlib

import numpy as np
import public_tokenizers as T
import pytest
from tokenizers import Tokenizer

from meterstream.llm import packing as K

PATH = T.path("byte_bpe_50k.tiktoken")


def total(plan, context):
    out = np.zeros(context + 1, np.int64)
    for lengths, n in plan:
        assert n > 0 and sum(a * c for a, c in lengths) <= context
        for a, c in lengths:
            out[a] += c * n
    return out


def plain_best_fit(lengths, context):
    rooms = []
    for a in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= a]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - a)
        else:
            rooms.append(context - a)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_equals_piece_by_piece(seed):
    r = random.Random(seed)
    context = r.choice([7, 20, 64])
    lengths = [min(context, int(r.expovariate(3 / context)) + 1) for _ in range(r.randint(1, 300))]
    counts = np.bincount(lengths, minlength=context + 1)
    plan = K.best_fit(counts, context)
    assert (total(plan, context) == counts).all()
    assert sum(n for _, n in plan) == plain_best_fit(lengths, context)


def test_least_squares_is_optimal():
    counts = np.bincount(np.random.default_rng(0).integers(1, 33, 4000), minlength=33).astype(float)
    p = K.patterns(counts)
    assert (p.sum(axis=1) == 32).all() and len(np.unique(p, axis=0)) == len(p)
    x = K.non_negative_least_squares(p, counts, 3000)
    a = np.zeros((33, len(p)))
    for j in range(3):
        np.add.at(a, (p[:, j], np.arange(len(p))), 1)
    w = 1 / np.sqrt(np.maximum(counts, 1))
    w[0] = 0
    gradient = (a * w[:, None]).T @ ((a @ x - counts) * w)
    assert x.min() >= 0 and gradient.min() > -1e-3 and np.abs(gradient[x > 1e-3]).max() < 1e-3


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece_and_wastes_little(seed):
    r = np.random.default_rng(seed)
    lengths = np.clip(r.lognormal(5.5, 1.2, 30_000).astype(int), 1, 2048)
    counts = np.bincount(lengths, minlength=2049)
    plan = K.pack_histogram(counts)
    assert (total(plan, 2048) == counts).all()
    n = sum(k for _, k in plan)
    assert n <= 1.002 * -(-int(lengths.sum()) // 2048) + 1
    places = K.Places(plan)
    order = np.sort(lengths)
    rank = np.arange(len(order)) - np.searchsorted(order, order)
    sequence, offset = places(order, rank)
    at = np.lexsort((offset, sequence))
    s, o, a = sequence[at], offset[at], order[at]
    first = np.r_[True, s[1:] != s[:-1]]
    assert (o[first] == 0).all() and (o[1:] == o[:-1] + a[:-1])[~first[1:]].all() and (o + a).max() <= 2048
    assert len(np.unique(s)) == n


def test_documents(spark):
    r = random.Random(1)
    texts = [None, "", "one", "one", "é" * 9000, "word " * 70_000] + ["".join(r.choice("ab c,d\n") for _ in range(r.randint(0, 9000))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, "one"), (None, "no id"), (2, "one")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, length int, block int").repartition(5)
    got = K.pack(docs, PATH).collect()
    t = Tokenizer.from_file(T.path("byte_bpe_50k.json"))
    want = []
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or min(len(ids), 2048)
        edges = [0, *range(first, len(ids) + 1, 2048)]
        want += [(i, k, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes())) for k, (s, e) in enumerate(zip(edges, edges[1:]))]
    assert sorted(map(str, want)) == sorted(str((x.doc_id, x.piece, x.start, x.length, x.ids_crc32)) for x in got)
    by = {}
    for x in got:
        by.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    assert len(by) <= -(-sum(w[3] for w in want) // 2048) + 1
    assert K.pack(docs.limit(0), PATH).count() == 0
