"""The queries most exposed to a hot key, on data in which one user holds a third of all rows."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.01"
HOT_USER = {
    "events": "CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id",
    "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey",
    "conversations": "CASE WHEN conv_id % 3 = 0 THEN 0 ELSE conv_id END AS conv_id",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    target = str(tmp_path_factory.mktemp("skewed"))
    con = connect(SF_DIR)
    for file in os.listdir(SF_DIR):
        replaced = HOT_USER.get(file.removesuffix(".parquet"))
        columns = f"* REPLACE ({replaced})" if replaced else "*"
        con.sql(f"COPY (SELECT {columns} FROM '{SF_DIR}/{file}') TO '{target}/{file}' (FORMAT parquet)")
    return target, connect(target)


@pytest.mark.parametrize(
    "name",
    [
        "interval_at_event", "latest_event_by_key", "latest_n_turns", "first_and_latest_snapshot", "suffix_sum", "first_pay_after",
        "conversion_windows", "contact_funnel", "backfill_funnel", "monthly_funnel", "month_pool", "paid_pool",
    ],
)
def test_query_equals_its_twin(spark, skewed, name):
    sf_dir, con = skewed
    got, want = compare(spark, con, sf_dir, name, entry.queries()[name], entry.oracle_sql()[name])
    assert got == want and got[1]
