"""Registered document queries: whole tables, promised columns, and their SQL."""

import pytest

import __spark_entry__ as entry
from meterstream.llm import queries as Q

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op3_quality_classifier": "doc_id held_out score predicted",
    "op6_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op7_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op8_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op9_simhash_near_dedup": "doc_id fingerprint component_id",
    "op11_conversation_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_centroid_clustering": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op13_suffix_array_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "pipeline": "doc_id piece start length ids_crc32 sequence_id offset",
}


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert set(Q.QUERIES) <= names and len(Q.QUERIES) == 14
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert set(Q.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = Q.QUERIES[name](spark, SF)
    want = duck(SF).execute(f"SELECT {', '.join(got.columns)} FROM ({Q.ORACLE[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_columns_and_rows(spark, name):
    got = Q.QUERIES[name](spark, SF)
    assert set(COLUMNS.get(name, "").split()) <= set(got.columns)
    if name.startswith(("op1_", "op3_", "op6_", "op9_", "op10_", "op13_")):
        assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    elif name.startswith("op7_"):
        assert got.count() == spark.read.parquet(f"{SF}/pages.parquet").count()
    else:
        assert got.count() > 0


def test_substring_dedup_returns_every_document(spark):
    got = Q.QUERIES["op4_substring_dedup"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.count() == docs.count()
    assert got.filter("size(removed) = 0").select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).count() == 0
