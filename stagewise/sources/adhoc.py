"""Ad-hoc SQL over registered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, limit: int | None = None) -> DataFrame:
    """Whole result of a query; ``limit`` only where the caller wants fewer rows. It stays
    a DataFrame; :func:`stagewise.sources.sinks.deliver` decides how it is handed out."""
    found = spark.sql(text.strip().rstrip(";"))
    return found if limit is None else found.limit(limit)
