"""Sides of joins that grow with the data meet by an exchange: small files are no reason to collect them on the driver."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.check_oracle import compare, connect

TABLES = {
    "region": "i::INT AS r_regionkey, 'region ' || i AS r_name FROM range(2) t(i)",
    "nation": "i::INT AS n_nationkey, 'nation ' || i AS n_name, (i % 2)::INT AS n_regionkey FROM range(30) t(i)",
    "customer": """i AS c_custkey, 'name ' || i AS c_name, (i % 25)::INT AS c_nationkey, i * 1.5 AS c_acctbal,
                   'segment ' || (i % 3) AS c_mktsegment FROM range(40) t(i)""",
    "supplier": "i AS s_suppkey, 'door ' || i AS s_name, (i % 25)::INT AS s_nationkey, i * 1.5 AS s_acctbal FROM range(60) t(i)",
    "orders": """i AS o_orderkey, nullif(i % 7, 6) AS o_custkey, 'F' AS o_orderstatus, (i * 13 % 100)::DOUBLE AS o_totalprice,
                 TIMESTAMP '1997-01-01' + INTERVAL 1 DAY * (i * 5 % 60) AS o_orderdate, 'HIGH' AS o_orderpriority
                 FROM range(300) t(i)""",
    "events": """i AS event_id, TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * (i * 7919 % 2500000) AS ts, i * 31 % 40 AS user_id,
                 ['view', 'click', 'signup', 'purchase', 'error', 'view', 'click'][i % 7 + 1] AS event_type,
                 (i % 50)::DOUBLE AS value, '{"k": ' || (i * 17 % 100) || '}' AS props FROM range(4000) t(i)""",
}


@pytest.fixture(scope="module")
def made(tmp_path_factory):
    target, con = str(tmp_path_factory.mktemp("made")), duckdb.connect()
    for name, columns in TABLES.items():
        con.sql(f"COPY (SELECT {columns}) TO '{target}/{name}.parquet' (FORMAT parquet)")
    return target


@pytest.mark.parametrize(
    ("name", "dimensions"),
    [
        ("backfill_funnel", 5),  # nation, region, teams, grades, channels of a day
        ("interval_at_event", 0),
        ("paid_amount_by_user", 0),
        ("suffix_sum", 0),
        ("suffix_sum_without_ties", 0),
    ],
)
def test_only_dimensions_are_broadcast(spark, made, plan_of, name, dimensions):
    got, want = compare(spark, connect(made), made, name, entry.queries()[name], entry.oracle_sql()[name])
    assert got == want and got[1]
    plan = plan_of(entry.queries()[name](spark, made), final=True)
    assert plan.count("BroadcastHashJoin") <= dimensions, plan.count("BroadcastHashJoin")
