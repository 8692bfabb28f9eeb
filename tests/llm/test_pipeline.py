import re

import pytest

import corpus_pipeline as C
from meterstream.llm import decontamination as D
from meterstream.llm import pseudonyms as P

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    names = docs.columns
    for name, f in C.STAGES[:-1]:
        docs = C.staged(f(spark, docs, SF), name)
        assert docs.columns == names
        out[name] = {r.doc_id: r for r in docs.collect()}
        assert len(out[name]) == docs.count()
    out["best_fit_packing"] = C.STAGES[-1][1](spark, docs, SF).collect()
    return out


def test_each_stage_works_on_what_the_one_before_kept(spark, stages):
    all_rows = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    q, s, d, p = (stages[n] for n, _ in C.STAGES[:-1])
    assert set(p) == set(d) < set(s) < set(q) < set(all_rows)
    assert all(q[i] == all_rows[i] for i in q) and all(d[i] == all_rows[i] for i in d)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum(labels[i] == 1 and i in q for i in labels) > 0.97 * sum(labels.values())
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = D.Index(bench, 8, 0.1, 1)
    assert all(bool(D.find(s[i].text, index)) == (i not in d) for i in s)
    change = P.Permutation(C.DEMO_KEY)
    assert all(p[i].text == (P.replaced(d[i].text, change)[0] or d[i].text) and len(p[i].text) == len(d[i].text) for i in d)
    before = {x for r in d.values() for x in re.findall(r"[\w.]+@mail\d\.example\.com", r.text)}
    assert before and not any(x in r.text for x in before if len(x) > 26 for r in p.values())
    assert {r.doc_id for r in stages["best_fit_packing"]} == set(p)


def test_run_gives_the_rows_of_the_stages(spark, stages):
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    got = C.run(spark, SF).collect()
    assert sorted(map(key, got)) == sorted(map(key, stages["best_fit_packing"]))
    assert len({r.sequence_id for r in got}) == len({r.sequence_id for r in stages["best_fit_packing"]})


def test_stages_on_empty_and_odd_rows(spark):
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "x " * 70_000, None, "s", 1)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, f in C.STAGES[:-1]:
            docs = C.staged(f(spark, docs, SF), name)
            assert docs.columns == schema.names
        C.STAGES[-1][1](spark, docs, SF).collect()
