"""Queries that SQL can express, against DuckDB; all queries' names and columns."""

import pytest

from chronoline.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF001, SF01
from tests.oracle_compare import compare, duck

COLUMNS = {
    1: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    2: ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    3: ["vec_id", "n_links", "component_id", "kept"],
    4: ["doc_id", "held_out", "score", "predicted"],
    5: ["doc_id", "held_out", "lang_pred", "score"],
    6: ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    7: ["doc_id", "n_shingles", "component_id", "kept"],
    8: ["query_id", "rank", "vec_id", "score"],
    9: ["doc_id", "size", "source_size", "target", "taken"],
    10: ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    11: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    12: ["lang", "source", "part", "item", "value", "rank"],
    13: ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF01), duck(SF01), ORACLE_SQL[name])
    assert ok, f"{name}: {msg}"


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    assert set(COLUMNS[int(name[2:].split("_")[0])]) <= set(QUERIES[name](spark, SF001).columns)
