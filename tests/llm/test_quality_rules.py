import random
import re
from collections import Counter

import duckdb

from meterstream.llm import quality_rules as Q

TEXTS = [None, "", " \n\t", "one", "a\x0bb\x0cc\rd e", "é ñ #x $$ <a|b> ÉÑ", "x y\n\nx y\n \nx  y\nx y", "w " * 7, "w " * 8, "w " * 9,
         "a b c d e f g h " * 2, "a b c d e f g h i " * 3 + "z", " ".join(map(str, range(30))) + " " + " ".join(map(str, range(5, 16))),
         "nb\xa0sp  wide \x85 x", "q " * 30_000, " ".join(str(i) for i in range(20_000))]


def plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(windows)
    covered = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_metrics(spark):
    r = random.Random(4)
    texts = TEXTS + ["".join(r.choice(" \n\tab*É") for _ in range(r.randint(0, 200))) for _ in range(60)]
    texts += [" ".join(r.choice("ab") for _ in range(r.randint(0, 90))) for _ in range(60)]
    rows = Q.measured(spark.createDataFrame([(i, t, "l", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")).collect()
    assert len(rows) == len(texts)
    for x in rows:
        got = (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words)
        assert got == plain(texts[x.doc_id]), texts[x.doc_id]
        assert x.base_failed == (got[0] < 20 or 100 * got[4] > 30 * got[0])


def test_bucket_is_near_and_orders(spark):
    v = list(range(300)) + [10**k + j for k in range(3, 15) for j in (-1, 0, 1)]
    got = [x.b for x in spark.createDataFrame([(x,) for x in v], "v long").select(Q.bucket(Q.F.col("v")).alias("b")).collect()]
    assert all(b <= x < b + max(1, b / 63) for x, b in zip(v, got))
    assert [b for _, b in sorted(zip(v, got))] == sorted(got)


def corpus():
    r = random.Random(8)
    rows = []
    for i in range(700):
        w = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(r.randint(15, 80))]
        t = " ".join(w)
        if i % 20 == 0:
            t = t.replace(" ", "*** ").upper()
        rows.append((i, t, ["en", "fr", None][i % 3], "hot" if i % 5 else f"s{i % 7}", i))
    return rows + [(3, rows[3][1], "en", "hot", 9), (3, rows[3][1], "en", "hot", 9), (None, rows[4][1], None, None, 1), (900, None, "en", "hot", 0), (901, "", None, None, None)]


def test_equals_sql_and_adapts(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, N_WORDS int")
    got = Q.judge(docs).toPandas()
    con = duckdb.connect()
    import pandas as pd
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n"]).astype({"doc_id": "Int64"})  # noqa: F841
    con.execute("CREATE TABLE documents AS SELECT * FROM documents")
    want = con.execute(Q.oracle()).df()[list(got.columns)]
    order = lambda d: sorted(map(str, d.astype(object).where(d.notna(), None).values.tolist()))
    assert order(got.astype({"doc_id": "Int64"})) == order(want.astype({"doc_id": "Int64"}))
    by = got[got.doc_id.notna()].groupby("doc_id").kept.first()
    assert not by[[i for i in range(0, 700, 20)]].any() and not by[900] and not by[901]
    assert by[[i for i in range(700) if i % 20]].mean() > 0.9


def test_empty_table(spark):
    assert Q.judge(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).count() == 0
