import zlib

import numpy as np
import pytest

from meterstream.llm import quality_model as Q

SF = "/root/testdata/sf0.1"


def plain_features(text, bits):
    out, m = set(), (1 << 64) - 1
    for i in range(len(text)):
        h = 0
        for n in range(1, 5):
            if i + n > len(text):
                break
            h = (h * 1_000_003 + ord(text[i + n - 1]) + n) & m
            out.add((h * 0x9E3779B97F4A7C15 & m) >> (64 - bits))
    return out


def test_features_are_distinct_whole_text_ngrams():
    for text in ["", "a", "abc", "été été été", "x" * 300, "The the the end " * 9000]:
        f = Q.Features(16)(text)
        assert len(set(f)) == len(f)
        assert {i for i in f if i < 1 << 16} == plain_features(text, 16)
    assert [i - (1 << 16) for i in Q.Features(16)("a a a b") if i >= 1 << 16] == [0, 1, 2, 3, 4, 5, 6]
    assert len(Q.Features(16)(None)) == 0


def test_dual_descent_reaches_the_hinge_optimum():
    r = np.random.default_rng(1)
    x = r.normal(size=(80, 5))
    y = np.where(x[:, 0] + 0.3 * r.normal(size=80) > 0, 1, -1)
    w, b = Q.hinge_by_dual_descent([(np.arange(5), v) for v in x], y, 5, rounds=3000, tolerance=1e-8)
    loss = lambda w, b: (w @ w + b * b) / 2 + np.maximum(0, 1 - y * (x @ w + b)).sum()
    best = loss(w, b)
    for _ in range(300):
        assert loss(w + 0.05 * r.normal(size=5), b + 0.05 * r.normal()) >= best - 1e-6


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = Q.train(docs, labels.filter(~Q.held_out(Q.F.col("doc_id"))))
    rows = Q.with_scores(docs, model).join(labels, "doc_id").select("doc_id", "score", "predicted", "quality").collect()
    test = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    good, bad = ([r.score for r in test if r.quality == q] for q in (1, 0))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    auc = np.mean([[g > b for g in good] for b in bad])
    kept, caught = np.mean([g >= 0.7 for g in good]), np.mean([b < 0.7 for b in bad])
    print(f"AUC {auc:.4f}, good kept {kept:.3f}, bad caught {caught:.3f}")
    assert auc > 0.97 and kept > 0.97 and caught > 0.7


@pytest.fixture(scope="module")
def few(spark):
    good = [(i, f"some clean words number {i} here") for i in range(40)]
    bad = [(100 + i, f"B*D {i} ### $$$ !!!") for i in range(40)]
    odd = [(None, "some words"), (500, None), (501, ""), (3, good[3][1]), (3, good[3][1]), (502, "y " * 90_000)]
    return spark.createDataFrame([(i, t, "s", 9) for i, t in good + bad + odd], "doc_id long, text string, SCORE string, k int")


def test_odd_rows(spark, few):
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i in [*range(30), *range(100, 130)]] + [(None, 1, 0), (7, None, 0), (500, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = Q.train(few, labels)
    got = Q.with_scores(few, model)
    assert got.columns == ["doc_id", "text", "k", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 86
    by = {r.doc_id: r.score for r in rows}
    assert by[500] == by[501] and min(by[i] for i in range(30, 40)) > max(by[i] for i in range(130, 140))


def test_one_class_or_none(spark, few):
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert Q.train(few, one) is None and Q.train(few, one.limit(0)) is None
    assert {r.predicted for r in Q.with_scores(few, None).collect()} == {1}
    model = Q.train(few, spark.createDataFrame([(1, 1), (100, 0)], "doc_id long, quality int"))
    assert Q.with_scores(few.limit(0), model).count() == 0


def plain_all(text, bits):
    """All features of a text, shares of doubled words included."""
    words = (text or "").split()
    share = sum(a == b for a, b in zip(words, words[1:])) / max(1, len(words) - 1)
    return plain_features(text or "", bits) | {(1 << bits) + i for i, s in enumerate((0.01, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8)) if share > s}


def test_counts_ratios_and_scores_equal_a_plain_version(spark, few):
    """Class counts over all labelled rows, smoothed log-count ratios, scaled rows of length one, the logistic curve."""
    bits = 12
    labels = {**{i: 1 for i in range(35)}, **{i: 0 for i in range(100, 133)}, 500: 1, 502: 0, 3: 1}
    model = Q.train(few, spark.createDataFrame(list(labels.items()), "doc_id long, quality int"), bits=bits)
    rows = [(r.doc_id, r.text) for r in few.collect()]
    size = (1 << bits) + 8
    n, docs = np.zeros((2, size), int), [0, 0]
    for i, text in rows:
        if i in labels:
            docs[labels[i]] += 1
            for f in plain_all(text, bits):
                n[labels[i], f] += 1
    ratio = np.log((n[1] + 1) / (docs[1] + 2)) - np.log((n[0] + 1) / (docs[0] + 2))
    ratio[n.sum(axis=0) == 0] = 0
    assert np.allclose(model.square, ratio ** 2, rtol=0, atol=1e-12)
    got = {(r.doc_id, r.text): r.score for r in Q.with_scores(few, model).collect()}
    for i, text in rows:
        x = sorted(plain_all(text, bits))
        length = np.sqrt((ratio[x] ** 2).sum())
        margin = sum(model.weight[f] for f in x) / length + model.bias if length else model.bias
        assert got[i, text] == pytest.approx(1 / (1 + np.exp(-(model.slope * margin + model.offset))), abs=1e-9)


def test_fitted_weights_minimise_the_hinge_loss_of_the_scaled_rows(spark, few):
    """The weights are those of the plain rows: no small change lowers the loss of the part that was fitted."""
    bits, share = 10, 0.5
    texts = [f"some clean words number {i} here" for i in range(30)] + [f"B*D {i} ### $$$ !!!" for i in range(30)]
    y = np.array([1] * 30 + [-1] * 30)
    features = [sorted(plain_all(t, bits)) for t in texts]
    size = (1 << bits) + 8
    n = np.zeros((2, size))
    for f, label in zip(features, y):
        n[int(label > 0), f] += 1
    ratio = np.log((n[1] + 1) / 32) - np.log((n[0] + 1) / 32)
    import pyarrow as pa
    batch = pa.record_batch([pa.array(texts), pa.array([int(v > 0) for v in y])], names=["t", "q"])
    out = next(iter(Q._fit(bits, ratio, share)([batch])))
    w = np.divide(np.frombuffer(out.column(0)[0].as_py()), ratio, out=np.zeros(size), where=ratio != 0)
    bias = out.column(1)[0].as_py()
    x = np.zeros((60, size))
    for i, f in enumerate(features):
        x[i, f] = ratio[f] / np.sqrt((ratio[f] ** 2).sum())
    part = np.arange(60) % 4 != 3
    loss = lambda w, b: (w @ w + b * b) / 2 + np.maximum(0, 1 - y[part] * (x[part] @ w + b)).sum()
    best, r = loss(w, bias), np.random.default_rng(2)
    for _ in range(200):
        assert loss(w + 0.02 * r.normal(size=size) * (ratio != 0), bias + 0.02 * r.normal()) >= best - 1e-2
