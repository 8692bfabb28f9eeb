import public_tokenizers as P
from tokenizers import Tokenizer

from meterstream.llm import tokens

PATH = P.path("byte_bpe_50k.tiktoken")


def lengths(rows):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in rows]


def test_totals_for_every_limit(spark):
    rows = ["", None, "one two three", "one two three", "x " * 3000, "é" * 50] + [f"w{i} " * i for i in range(40)]
    docs = spark.createDataFrame([(i, t, 7, "n") for i, t in enumerate(rows)],
                                 "doc_id long, text string, n_tokens int, documents string")
    hist = tokens.length_histogram(docs, PATH)
    n = lengths(rows)
    got = {r.n_tokens: r for r in tokens.context_totals(hist).collect()}
    assert set(got) == set(n)
    for limit, r in got.items():
        assert r.documents == n.count(limit)
        assert r.documents_over == sum(x > limit for x in n)
        assert r.tokens_within == sum(x for x in n if x <= limit)
        assert r.truncated_tokens == sum(min(x, limit) for x in n)
        assert r.total_tokens == sum(n)
        assert r.quantile == sum(x <= limit for x in n) / len(n)
    for r in tokens.totals_at(hist, [0, 1, 5, 1023, 1024, 10**6]).collect():
        assert r.truncated_tokens == sum(min(x, r.context_limit) for x in n)
        assert r.documents_over == sum(x > r.context_limit for x in n)
    q = {r.share: r.n_tokens for r in tokens.length_quantiles(tokens.context_totals(hist), [0.5, 0.9, 1.0]).collect()}
    s = sorted(n)
    assert q == {0.5: s[-(-len(s) // 2) - 1], 0.9: s[-(-len(s) * 9 // 10) - 1], 1.0: s[-1]}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    hist = tokens.length_histogram(docs, PATH)
    assert tokens.context_totals(hist).collect() == []
    assert [r.total_tokens for r in tokens.totals_at(hist, [8]).collect()] == [0]
