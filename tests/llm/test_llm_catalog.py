"""Every registered query over the small tables: its columns and rows."""

from __future__ import annotations

import duckdb
import pytest
from corpus import SF

from tripspark.llm import catalog

COLUMNS = {
    "op1_license_scan": {"doc_id", "template", "matched_words", "template_words", "coverage", "char_start", "char_end"},
    "op2_token_output": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op3_near_dedup": {"doc_id", "n_shingles", "component_id", "kept"},
    "op4_token_counts": {"doc_id", "section", "n_tokens", "doc_tokens"},
    "op5_decontaminate": {"doc_id", "item_id", "similarity"},
    "op6_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op7_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op8_lm_score": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op9_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    "op10_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op11_simhash_dedup": {"doc_id", "fingerprint", "component_id"},
    "op12_ranked_search": {"item_id", "rank", "doc_id", "score"},
    "op13_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
}
ONE_ROW_EACH = {"op2_token_output": "documents", "op3_near_dedup": "documents", "op7_suffix_dedup": "documents", "op8_lm_score": "documents",
                "op9_url_filter": "pages", "op10_quality_rules": "documents",
                "op11_simhash_dedup": "documents"}
INTEGERS = {"doc_id", "page_id", "item_id", "start", "n_tokens", "ids_crc32", "n_shingles", "component_id", "length", "doc_tokens", "sequence_id", "offset",
            "n_bytes", "n_removed", "n_spans", "n_known", "train_tokens", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "vec_id", "n", "deviation"}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_over_whole_tables(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    assert COLUMNS[name] <= set(df.columns)
    assert all(t == "bigint" for c, t in df.dtypes if c in INTEGERS)
    rows = df.collect()
    if name in ONE_ROW_EACH:
        table = ONE_ROW_EACH[name]
        key = "page_id" if table == "pages" else "doc_id"
        want = duckdb.sql(f"SELECT {key} FROM '{SF}/{table}.parquet'").fetchall()
        assert sorted((r[key],) for r in rows) == sorted(want)
    elif name in ("op4_token_counts", "op6_packing"):
        assert len({r.doc_id for r in rows}) == duckdb.sql(f"SELECT count(DISTINCT doc_id) FROM '{SF}/documents.parquet'").fetchall()[0][0]


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(catalog.oracle_sql()[name])
    got = catalog.QUERIES[name](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
