"""Redelivered events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_stream(df: DataFrame, event_id: str, remember: str = "1 day") -> DataFrame:
    """Drops events whose id was seen before; a first delivery is never dropped, however old its
    own time is. On a stream, an id is remembered for ``remember`` after it arrived, so the state is bounded by
    what arrives in that time; a repeat that comes later passes again. On a table, for all of it."""
    if not df.isStreaming:
        return df.dropDuplicates([event_id])
    arrived = "_arrived"
    while arrived in df.columns:
        arrived = f"_{arrived}"
    # The watermark runs on the time of arrival, which no event can be late for.
    stamped = df.withColumn(arrived, F.current_timestamp()).withWatermark(arrived, remember)
    return stamped.dropDuplicatesWithinWatermark([event_id]).drop(arrived)


def once_only(events: DataFrame, event_id: str, ledger: str, output: str, *, buckets: int = 64):
    """A writer for a stream of which no event id ever passes twice, however late it is delivered again:
    ``events`` is the stream, ``ledger`` and ``output`` are catalog tables that are made on first use. Start it with
    ``.option("checkpointLocation", ...).start()``.

    Every micro-batch keeps the ids that the ledger does not hold and writes them, and their rows, as the partition of its
    batch number. A batch that is run again after a failure replaces its own partition and looks only at earlier
    ones, so the result is the same. The ledger is bucketed by id: a batch is dealt to its buckets, the ledger stays where it is.
    Sessions that have read the tables before refresh them (``REFRESH TABLE``) after a batch was run again.
    Rows without an id all pass, since nothing tells them apart.
    """
    spark = events.sparkSession
    batch = _free("batch", events)
    if not spark.catalog.tableExists(ledger):
        kind = events.schema[event_id].dataType.simpleString()
        spark.sql(
            f"CREATE TABLE {ledger} (`{event_id}` {kind}, `{batch}` BIGINT) USING parquet "
            f"PARTITIONED BY (`{batch}`) CLUSTERED BY (`{event_id}`) INTO {buckets} BUCKETS"
        )
    if not spark.catalog.tableExists(output):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema)
        spark.sql(f"CREATE TABLE {output} ({fields}, `{batch}` BIGINT) USING parquet PARTITIONED BY (`{batch}`)")

    def write(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        known = session.table(ledger).where(F.col(batch) < number).select(event_id)
        named = rows.where(F.col(event_id).isNotNull()).dropDuplicates([event_id])
        fresh = named.join(known, event_id, "left_anti").select(*rows.columns)
        fresh = fresh.unionByName(rows.where(F.col(event_id).isNull())).withColumn(batch, F.lit(number).cast("long"))
        before = session.conf.get("spark.sql.sources.partitionOverwriteMode")
        session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            # The ids are taken from the rows as they were written: both tables hold the same ones.
            fresh.write.insertInto(output, overwrite=True)
            written = session.table(output).where((F.col(batch) == number) & F.col(event_id).isNotNull())
            written.select(event_id, batch).write.insertInto(ledger, overwrite=True)
        finally:
            session.conf.set("spark.sql.sources.partitionOverwriteMode", before)

    return events.writeStream.foreachBatch(write)


def _free(name: str, df: DataFrame) -> str:
    while name in df.columns:
        name = f"_{name}"
    return name
