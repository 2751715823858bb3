from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stagewise.functions import dates


def test_month_bounds():
    assert dates.month_bounds(202402) == (20240201, 20240229)
    assert dates.month_bounds(202302) == (20230201, 20230228)
    assert dates.month_bounds(202312) == (20231201, 20231231)
    assert dates.month_of(20231231) == 202312


@pytest.mark.parametrize(
    "day, start",
    [(20240103, 20231220), (20240115, 20240101), (20240120, 20240101), (20240131, 20240101), (20240301, 20240216)],
)
def test_backfill_starts_at_month_start_or_two_weeks_back(day, start):
    assert dates.backfill_bounds(day) == (start, day)


def test_backfill_days_are_all_days_of_the_range(spark):
    days = [r.day for r in dates.backfill_days(spark, 20240228, 20240302).orderBy("day").collect()]
    assert days == [20240228, 20240229, 20240301, 20240302]


def test_contact_window_ends_at_one_on_the_next_day(spark):
    times = ["2024-01-31 23:59:59", "2024-02-01 00:00:00", "2024-02-02 00:30:00", "2024-02-02 01:00:00", "2024-02-02 01:00:01"]
    df = spark.createDataFrame([(datetime.fromisoformat(t),) for t in times], "t timestamp")
    got = df.select(
        F.date_format("t", "dd HH:mm:ss").alias("t"),
        dates.within_contact_window("t", 20240201, 20240201).alias("one_day"),
        dates.contact_days("t", 20240131, 20240202).alias("days"),
    ).collect()
    assert [r.one_day for r in got] == [False, True, True, True, False]
    assert [sorted(r.days) for r in got] == [
        [20240131], [20240131, 20240201], [20240201, 20240202], [20240201, 20240202], [20240202],
    ]


def test_instant_before_is_one_second_earlier(spark):
    row = spark.range(1).select(dates.instant_before(F.lit(1704067200500)).alias("t")).first()
    assert row.t == datetime(2023, 12, 31, 23, 59, 59, 500000)
