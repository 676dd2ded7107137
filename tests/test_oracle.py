"""Registered queries against their DuckDB SQL at sf0.01 (the driver's
correctness gate).  A quick subset runs by default; BASKETRY_FULL_ORACLE=1
runs every query."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF01

QUICK = ["apriori_k2", "apriori_all", "support_k3", "candidates_k3", "label_itemsets", "topk_itemsets",
         "itemset_stats", "basket_lines", "format_item_id", "row_number_chunk", "chunk_sizes",
         "hash_weighted", "monotonicity_prune", "sample_exact", "join_left", "monotonicity_prune_k4",
         "pcy_bitmap_packed", "sample_with_replacement", "weighted_support", "apriori_basket_scan_k3",
         "son_two_pass_k2", "son_two_pass_k3", "toivonen_full_scan", "toivonen_k3", "negative_border"]
NAMES = list(E.oracle_sql()) if os.environ.get("BASKETRY_FULL_ORACLE") else QUICK


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(repr(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


def test_every_query_has_sql():
    # the core ones; training-data queries have tests of their own in tests/llm
    from basketry.catalog import SPARK_QUERIES
    from basketry.oracle import build

    assert set(SPARK_QUERIES) == set(build())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(rows, df.columns) == digest(drows, dcols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["k", "itemset", "support"]
    counts = {r["k"]: r["c"] for r in df.groupBy("k").count().withColumnRenamed("count", "c").collect()}
    assert counts == {1: 10, 2: 45, 3: 120, 4: 70, 5: 3}
