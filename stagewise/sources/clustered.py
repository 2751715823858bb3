"""Catalog tables bucketed by the keys that jobs join on, so that those joins need no exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame

BUCKETS = 256


def write_clustered(df: DataFrame, table: str, keys: list[str], partition: str | None = None, buckets: int = BUCKETS) -> None:
    """Creates the table, or overwrites in it the partitions that ``df`` has rows of. Rows of one bucket are brought to one task first, so
    that a partition has one sorted file per bucket."""
    spark = df.sparkSession
    columns = [c for c in df.columns if c != partition]
    if not spark.catalog.tableExists(table):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != partition)
        by = ", ".join(f"`{k}`" for k in keys)
        fields = f"{fields}, `{partition}` {df.schema[partition].dataType.simpleString()}" if partition else fields
        split = f"PARTITIONED BY (`{partition}`)" if partition else ""
        spark.sql(f"CREATE TABLE {table} ({fields}) USING parquet {split} CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS")
    rows = df.select(*columns, *([partition] if partition else [])).repartition(buckets, *keys)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
