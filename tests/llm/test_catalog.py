"""Registered corpus queries over the smallest test data, against DuckDB or the brute force."""

import pytest

import __spark_entry__ as entry
from carelake.llm import catalog
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_line_dedup": "doc_id:bigint n_lines:bigint n_dropped:bigint kept_sha256:string",
    "op2_surrogates": "doc_id:bigint text:string n_replaced:bigint",
    "op3_quality_rules": "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint "
    "n_repeat_words:bigint base_failed:boolean kept:boolean",
    "op4_pairwise_quality": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op5_source_mix": "doc_id:bigint size:bigint source_size:bigint target:double taken:bigint",
    "op6_packing": "doc_id:bigint piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint",
    "op7_token_counts": "doc_id:bigint n_bytes:bigint n_tokens:bigint over_limit:boolean fits:bigint",
    "op8_simhash": "doc_id:bigint fingerprint:string component_id:bigint",
    "op9_toxicity": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op10_search": "query_id:bigint rank:int doc_id:bigint score:double",
    "op11_filter_audit": "part:string filter_order:string step:int kept:bigint removed:bigint redundant:bigint "
    "unique_fails:bigint good_lost:bigint toxic_lost:bigint shapley:bigint",
    "op12_warc": "page_id:bigint payload_bytes:bigint payload_digest:string record_type:string refers_to:bigint",
    "op13_resample": "doc_id:bigint n_features:bigint weight:bigint score:bigint rank:bigint",
}
#: Queries whose rows are not documents.
OTHER_ROWS = ("op6_packing", "op10_search", "op11_filter_audit", "op12_warc")


def test_all_are_registered():
    assert set(catalog.QUERIES) == set(COLUMNS)
    assert {*COLUMNS, "pipeline"} <= set(entry.queries())
    assert set(catalog.STATEMENTS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_one_row_per_document(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    assert " ".join(f"{n}:{t}" for n, t in df.dtypes) == COLUMNS[name]
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert name in OTHER_ROWS or df.count() == documents


@pytest.mark.parametrize("name", catalog.STATEMENTS)
def test_query_equals_statement(spark, name):
    count, problems = compare(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name])
    assert not problems
    assert count > 0
