"""Named queries of the document operators, each over its whole table."""

from __future__ import annotations

from . import clustering, licenses, prefix_trie, quality_rules, substrings, warc
from .common import table


def tokenizer_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    """The operators' ``tokenizer`` parameter; this file and byte_bpe_50k.json hold one vocabulary."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op2_decontamination(spark, sf_dir):
    from . import decontamination
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_classifier(spark, sf_dir):
    from pyspark.sql import functions as F

    from . import quality_model as q
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = q.train(docs, labels.filter(~q.held_out(F.col("doc_id"))))
    return (q.with_scores(docs.select("doc_id", "text"), model)
            .select("doc_id", q.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"))


def op4_substring_dedup(spark, sf_dir):
    """All documents: what is left of the text, and what was removed where."""
    from . import repeats
    return repeats.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_token_counts(spark, sf_dir):
    from . import tokens
    docs = table(spark, sf_dir, "documents")
    return tokens.context_totals(tokens.length_histogram(docs, tokenizer_file()))


def op6_license_scan(spark, sf_dir):
    return licenses.licenses(table(spark, sf_dir, "documents")).drop("detections")


def op7_warc(spark, sf_dir):
    return warc.archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at", "history_order")


def op8_best_fit_packing(spark, sf_dir):
    from . import packing
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), context=2048, end=0)


def op9_simhash_near_dedup(spark, sf_dir):
    from . import simhash
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_distance=4).select(
        "doc_id", "fingerprint", "component_id")


#: A real run passes its own secret key.
DEMO_KEY = b"a key for tests only"


def op10_pii_pseudonyms(spark, sf_dir):
    from . import pseudonyms
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), DEMO_KEY)


def op11_conversation_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), group=5, most=9)


def op12_centroid_clustering(spark, sf_dir):
    return clustering.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dim=64, scale=1024, seed="3")


def op13_suffix_array_dedup(spark, sf_dir):
    return substrings.summary(table(spark, sf_dir, "documents"), length=200)


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontamination": op2_decontamination,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_license_scan": op6_license_scan,
    "op7_warc": op7_warc,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_pii_pseudonyms": op10_pii_pseudonyms,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_suffix_array_dedup": op13_suffix_array_dedup,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {
    "op1_quality_rules": quality_rules.oracle(),
    "op6_license_scan": licenses.oracle(),
    "op7_warc": warc.oracle(),
    "op11_conversation_trie": prefix_trie.oracle(),
    "op12_centroid_clustering": clustering.oracle(),
    "op13_suffix_array_dedup": substrings.oracle(),
}
