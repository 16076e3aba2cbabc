"""Registered queries against their DuckDB SQL, and the queries without SQL against
brute force over the same tables."""
import zlib

import duckdb
import oracle_compare as oc
import pytest

import __spark_entry__ as entry
from panelcast.llm.oracle import ORACLES
from panelcast.llm.queries import QUERIES
from .test_tokens_ops import BYTES, brute_quality, check_packing, direct

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


def test_registry():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert names == [n for n in QUERIES] and "pipeline" in entry.queries()
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, tables, name):
    result = oc.compare(spark, SF, name, QUERIES[name], ORACLES[name], tables)
    assert result["match"], result


@pytest.fixture(scope="module")
def rows(tables):
    return tables.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def test_quality_query(spark, rows):
    got = {r.doc_id: r for r in QUERIES["op4_quality_rules"](spark, SF).collect()}
    for i, text in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(text)
    assert len(got) == len(rows)


def test_record_query(spark, rows):
    import numpy as np
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op5_token_records"](spark, SF).collect()}
    start = 0
    for i, text in rows:
        ids = np.array([*direct(BYTES, text), 2], "<u4")
        assert got[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_packing_query(spark, rows):
    plan = QUERIES["op6_best_fit_packing"](spark, SF).withColumnRenamed("doc_id", "id").collect()
    n, total = check_packing(rows, plan, 4096)
    assert n <= -(-total // 4096) + 2


def test_language_query(spark, tables):
    truth = dict(tables.execute("SELECT doc_id, lang FROM documents").fetchall())
    got = QUERIES["op10_language_id"](spark, SF).collect()
    assert {r.doc_id: r.held_out for r in got} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in truth}
    held = [r for r in got if r.held_out and truth[r.doc_id]]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)
