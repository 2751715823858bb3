"""Runs registered queries against their SQL twins: python tests/check_oracle.py [dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def normal(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, bool):
        return str(value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(normal(row[i]) for i in order) for row in rows), key=repr
    )


def compare(spark, con, sf_dir, name, fn, sql):
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    expected = con.sql(sql)
    want = rows_of(expected.columns, expected.fetchall())
    return got, want


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        if file.endswith(".parquet"):
            con.sql(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            if name not in oracle:
                print(f"     {name} rows={fn(spark, sf_dir).count()} (no SQL twin) {time.time() - began:.1f}s")
                continue
            got, want = compare(spark, con, sf_dir, name, fn, oracle[name])
        except Exception as error:
            bad += 1
            print(f"ERR  {name}: {str(error)[:400]}")
            continue
        same = got == want
        bad += not same
        print(f"{'ok  ' if same else 'DIFF'} {name} rows={len(got[1])}/{len(want[1])} {time.time() - began:.1f}s")
        if not same:
            print("  columns", got[0], "" if got[0] == want[0] else want[0])
            only = [r for r in got[1] if r not in set(want[1])][:2], [r for r in want[1] if r not in set(got[1])][:2]
            print("  spark only", only[0], "\n  sql only  ", only[1])
    print("failed:", bad)


if __name__ == "__main__":
    main()
