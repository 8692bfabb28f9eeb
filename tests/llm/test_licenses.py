import random
import re

import duckdb
import pandas as pd

from meterstream.llm import licenses as L

FIXED = [None, "", " -- ", "MIT License", "mit  license, MIT-LICENSE mit license mit", "CC-BY", "CC BY-NC 4.0", "cc by é cc byé",
         "Licensed under the Apache License, Version 2.0.", "the GNU General Public License, version 3 or later",
         "SPDX-License-Identifier: Apache-2.0", "mit der MİT license", "under terms of the Mozilla Public License v2.0",
         "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", "BSD 3-Clause License and bsd license",
         "all rights reserved", "Copyright (c) 2004 Foo Bar. All rights reserved.", "https://www.apache.org/licenses/LICENSE-2.0",
         "gnu general public license " * 400, "general public license gnu", "gnu general public\nlicense", "x" * 100_000 + " mit license", "see MPL"]


def texts():
    r = random.Random(6)
    bits = ["gnu", "general", "public", "license", "apache", "mit", "cc", "by", "nc", "2", "0", "version", "licensed", "under", "the", "foo", "v3", "bsd", "clause", "or", "later"]
    return FIXED + [" ".join(r.choice(bits) for _ in range(r.randint(0, 120))) for _ in range(80)]


FIRST = {}
for rule in L.rules():
    FIRST.setdefault(rule["first"], []).append(rule)


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    every = []
    for i in range(len(words)):
        window = " " + " ".join(words[i:i + L.SPAN]) + " "
        for r in FIRST.get(words[i], ()):
            if m := re.match(r["pattern"], window):
                every.append((i, i + m[1].count(" "), r))
    base = [(s, r["label"]) for s, _, r in every if r["base"]]
    rank = lambda d: (d[2]["priority"], d[2]["rule"])
    mine = [d for d in every if not d[2]["base"]]
    if len(mine) > 900:
        kept = None
    else:
        kept = [d for d in mine if not any(
            e is not d and e[0] <= d[0] and d[1] <= e[1] and e[2]["priority"] <= d[2]["priority"]
            and ((e[0], e[1]) != (d[0], d[1]) or rank(e) < rank(d)) for e in mine)]
    return words, base, kept


def test_every_rule_holds_a_keyword():
    assert len(L.rules()) > 300
    for r in L.rules():
        words = re.sub(r"\(\?:[^()]*\)\?", "", r["pattern"])
        assert any(k.strip() in words for k in L.KEYWORDS), r
        assert r["keyword"] in words or re.sub(r" \?|\(\?:|\)", "", r["keyword"]) in words, r


def test_against_every_rule_at_every_word(spark):
    all_texts = texts()
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(all_texts)], "doc_id long, text string, LABELS int")
    rows = L.licenses(docs).collect()
    assert len(rows) == len(all_texts)
    for x in rows:
        words, base, kept = plain(all_texts[x.doc_id])
        places = [s for s, _ in base]
        assert (x.n_words, x.n_base, x.first_word, x.last_word) == (
            len(words), len(base), min(places, default=None), max(places, default=None)), all_texts[x.doc_id]
        labels = {b for _, b in base}
        assert x.base_labels == ",".join(sorted(labels))
        assert 0 <= x.score <= 1
        if kept is not None:
            assert x.labels == ",".join(sorted(labels | {d[2]["label"] for d in kept})), all_texts[x.doc_id]
            assert x.score == max([d[2]["confidence"] for d in kept] + [0.5] * bool(base), default=0)
    by = {all_texts[x.doc_id]: x for x in rows}
    assert by["CC BY-NC 4.0"].labels == "cc-by,cc-by-nc-4.0" and by["see MPL"].labels == "mpl"
    assert by["SPDX-License-Identifier: Apache-2.0"].labels == "apache-2.0"
    assert by["mit der MİT license"].n_base == 0


def test_equals_sql(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "mit license"), (3, "MIT License"), (3, "MIT License")]
    got = L.licenses(spark.createDataFrame(rows, "doc_id long, text string")).drop("detections")
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"})  # noqa: F841
    con.execute("CREATE TABLE documents AS SELECT * FROM frame")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({L.oracle()})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_empty_table(spark):
    assert L.licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
