import pytest
from oracle_check import compare, connect

from jobtide.llm.oracles import ORACLES
from jobtide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

CONTRACT = {
    1: "doc_id n_words n_hit n_items items_sha256 contaminated",
    2: "page_id host path rule verdict",
    3: "doc_id held_out score predicted",
    4: "doc_id held_out score predicted",
    5: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    6: "page_id url text n_chars",
    7: "doc_id n_bytes n_removed n_spans kept_sha256",
    8: "doc_id class_id",
    9: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    10: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    11: "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    12: "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    13: "doc_id start n_tokens ids_crc32",
}
KINDS = {"score": "double", "predicted": "int", "contaminated": "boolean", "held_out": "boolean", "base_failed": "boolean", "kept": "boolean"}
TEXTS = {"items_sha256", "host", "path", "rule", "verdict", "url", "text", "kept_sha256", "turns_sha256", "loss_sha256", "groups_sha256", "runs_sha256", "collapsed_sha256"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_a_row_for_each_thing_in_the_columns_asked_for(spark, name):
    number = int(name[2:].split("_")[0])
    found = QUERIES[name](spark, SF)
    kinds = dict(found.dtypes)
    for column in CONTRACT[number].split():
        assert kinds[column] == KINDS.get(column, "string" if column in TEXTS else "bigint"), column
    key = CONTRACT[number].split()[0]
    table = {"doc_id": "documents", "page_id": "pages", "conv_id": "conversations"}[key]
    ids = spark.read.parquet(f"{SF}/{table}.parquet").select(key).distinct().count()
    assert found.select(key).distinct().count() == ids + (number == 10)


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_match_their_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None
