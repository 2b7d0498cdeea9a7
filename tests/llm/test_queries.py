"""Every operator's query over the whole small tables: contract columns, and one row per document."""

import pytest

import __spark_entry__ as entry
from conftest import TESTDATA
from starmill.llm import queries as Q

COLUMNS = {
    "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_language_id": "doc_id held_out lang_pred score",
    "op3_simhash": "doc_id fingerprint component_id",
    "op4_quality_classifier": "doc_id held_out score predicted",
    "op5_secret_scan": "doc_id start length kind is_secret",
    "op6_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op7_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op8_chat_format": "conv_id call_id status json",
    "op9_html_extract": "page_id url text n_chars",
    "op10_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op11_turn_repair":
        "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_token_counts": "doc_id n_bytes n_tokens over_limit",
}
PER_ROW = {name: "documents" for name in list(COLUMNS)[:4]} | {
    "op6_bpe": "documents", "op7_exact_dedup": "documents", "op9_html_extract": "pages",
    "op11_turn_repair":
        "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_token_counts": "documents"}

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="the given tables are not here")


def test_all_and_the_pipeline_are_registered():
    assert set(Q.queries()) == set(COLUMNS)
    assert set(COLUMNS) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in COLUMNS if n not in Q.oracle_sql()])
def test_query(spark, name):
    rows = entry.queries()[name](spark, str(TESTDATA)).toPandas()
    assert set(COLUMNS[name].split()) <= set(rows.columns)
    if name in PER_ROW:
        assert len(rows) == spark.read.parquet(f"{TESTDATA}/{PER_ROW[name]}.parquet").count()
    assert len(rows)
