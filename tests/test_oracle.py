"""Every registered query against its DuckDB oracle on the smallest driver tables
(row count, column names and an order-insensitive value hash), plus invariants."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402

from souk.plans import catalog  # noqa: E402
from compare import digest, duck  # noqa: E402

SF = os.environ.get("SOUK_TEST_SF_DIR", "/root/testdata/sf0.001")
# Optional subpackages test their own queries.
QUERIES = catalog.QUERIES
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        pytest.skip("no SQL oracle")
    cur = con.execute(ORACLE[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0


def test_invariants(spark):
    q = QUERIES
    ret = q["q_customer_retention"](spark, SF)
    assert {r.retention_rate for r in ret.where("month_number = 0").collect()} == {1.0}
    sellers = q["q_seller_analytics"](spark, SF).collect()
    top = max(r.gross_revenue for r in sellers if r.gross_revenue is not None)
    assert {r.revenue_rank for r in sellers if r.gross_revenue == top} == {1}
    total = q["kpi_total_revenue"](spark, SF).first().value
    dated = q["fact_orders"](spark, SF).where("order_purchase_timestamp IS NOT NULL").agg({"order_value": "sum"}).first()[0]
    monthly = sum(r.monthly_revenue for r in q["monthly_revenue"](spark, SF).collect())
    assert monthly == pytest.approx(dated)
    assert dated <= total + 1e-6
    by_state = sum(r.revenue for r in q["kpi_revenue_by_state"](spark, SF).collect())
    assert by_state <= total + 1e-6
    health = q["dq_table_health"](spark, SF).collect()
    assert all(r.null_key_rows == 0 and r.duplicate_key_rows == 0 for r in health)
