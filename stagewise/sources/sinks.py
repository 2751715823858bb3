"""Partition-overwriting sinks and result delivery."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.sources.publish import Published

INLINE_ROWS = 20


def write_partition(df: DataFrame, path: str, partition: dict[str, int], fmt: str = "parquet") -> None:
    """Overwrites exactly one partition, also when ``df`` is empty. Columns are written
    by name; the partition columns live in the path."""
    place = "/".join(f"{name}={value}" for name, value in partition.items())
    df.drop(*partition).write.mode("overwrite").format(fmt).save(f"{path}/{place}")


def write_table_partition(df: DataFrame, table: str, partition: dict[str, int]) -> None:
    """The same for a catalog table: columns are matched by name, not by position."""
    spec = ", ".join(f"{name} = {value}" for name, value in partition.items())
    columns = ", ".join(f"`{c}`" for c in df.columns if c not in partition)
    df.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) BY NAME SELECT {columns} FROM {{rows}}", rows=df
    )


def is_table(target: str) -> bool:
    """A target with a slash is a path, any other is a table of the catalog."""
    return "/" not in target


def overwrite_partition(df: DataFrame, target: str | Published, partition: dict[str, int]) -> None:
    """:func:`write_partition`, :func:`write_table_partition` or a publish, by what the target is."""
    if isinstance(target, Published):
        ((name, value),) = partition.items()
        target.publish(df.withColumn(name, F.lit(value)), [value])
    elif is_table(target):
        write_table_partition(df, target, partition)
    else:
        write_partition(df, target, partition)


def write_days(df: DataFrame, target: str | Published, days: list[int], day: str = "day") -> None:
    """Overwrites the partitions of ``days`` in a path or a catalog table. A day without rows ends up
    empty, as if it had been written on its own; other days are left alone.

    The plan runs once, into a staging folder. Only when it is through, and no row is of a
    day that was not asked for (``ValueError``), is the target touched: days without rows are
    emptied first, then the others are replaced. A failing plan or a stray day leaves the target as it
    was. Rows are rebalanced per day: adaptive execution splits a large day over many tasks and
    files and packs small ones. To a :class:`Published` target all days change in one step.
    """
    if isinstance(target, Published):
        target.publish(df, days)
        return
    spark = df.sparkSession
    root = spark.conf.get("spark.sql.warehouse.dir") if is_table(target) else target
    staging = f"{root.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    written = Observation()
    try:
        (
            df.hint("rebalance", day)
            .observe(written, F.collect_set(day).alias("days"))
            .write.parquet(staging)
        )
        filled = set(written.get["days"])
        if stray := filled - set(days):
            raise ValueError(f"rows of days that were not asked for: {sorted(stray)}")
        staged = spark.read.schema(df.schema).parquet(staging)
        nothing = spark.createDataFrame([], df.drop(day).schema)
        for missing in sorted(set(days) - filled):
            overwrite_partition(nothing, target, {day: missing})
        if is_table(target):
            for one in sorted(filled):
                write_table_partition(staged.where(F.col(day) == one), target, {day: one})
        elif filled:
            (
                staged.hint("rebalance", day)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(day)
                .parquet(target)
            )
    finally:
        _delete(spark, staging)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@dataclass(frozen=True)
class Delivery:
    """``kind`` is ``"empty"``, ``"inline"`` (``text`` holds tab-separated rows) or
    ``"file"`` (``path`` holds CSV part files, which :func:`ordered_files` lists in the order of the rows)."""

    kind: str
    rows: int
    text: str | None = None
    path: str | None = None


#: How CSV files are written and read back without loss.
CSV = {
    "header": True,
    "multiLine": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
#: Names the part files in the order of their rows; the underscore hides it from readers of the folder.
ORDER_FILE = "_order.json"


def deliver(df: DataFrame, path: str, threshold: int = INLINE_ROWS) -> Delivery:
    """Small results as text, larger ones as distributed CSV. The plan runs once: its rows are
    counted while they are written as CSV to a folder beside ``path``, which takes its place when all is through; a failing plan leaves
    ``path`` as it was. Part files keep the order of the rows, so nothing is sorted: ``_order.json`` lists them. At most
    ``threshold`` rows ever reach the driver. Arrays, maps and structs become JSON, binary values base64."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}_staging-{uuid.uuid4().hex}"
    plain = df.select(*[_as_plain(f).alias(f.name) for f in df.schema])
    written = Observation()
    try:
        plain.observe(written, F.count(F.lit(1)).alias("rows")).write.options(**CSV).csv(staging)
        rows = written.get["rows"]
        if rows > threshold:
            _write_order(spark, staging, rows)
            _replace(spark, staging, path)
            return Delivery("file", rows, path=path)
        _delete(spark, path)
        if not rows:
            return Delivery("empty", 0)
        return Delivery("inline", rows, text=_inline(spark, staging, plain.schema))
    finally:
        _delete(spark, staging)


def ordered_files(spark: SparkSession, path: str) -> list[str]:
    """The part files of a delivery, in the order of its rows."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{path}/{ORDER_FILE}")
    stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(place)
    try:
        names = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["files"]
    finally:
        stream.close()
    return [f"{path}/{name}" for name in names]


def _as_plain(field: T.StructField) -> Column:
    """A column as CSV can hold it."""
    value = F.col(f"`{field.name.replace('`', '``')}`")
    if isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
        return F.to_json(value)
    if isinstance(field.dataType, T.BinaryType):
        return F.base64(value)
    return value.cast("string") if isinstance(field.dataType, T.NullType) else value


def _part_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the part files by the number of the task that wrote them, which is the order of the rows."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(place)
    names = [f.getPath().getName() for f in files]
    return sorted((n for n in names if n.startswith("part-")), key=lambda n: (int(n.split("-")[1]), n))


def _write_order(spark: SparkSession, path: str, rows: int) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{ORDER_FILE}")
    stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True)
    stream.write(bytearray(json.dumps({"rows": rows, "files": _part_files(spark, path)}), "utf-8"))
    stream.close()


def _replace(spark: SparkSession, staging: str, path: str) -> None:
    """The staged folder takes the place of ``path``; what stood there goes last."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, place, old = hadoop_path(staging), hadoop_path(path), hadoop_path(f"{staging}-old")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stood = files.exists(place)
    if stood and not files.rename(place, old):
        raise OSError(f"{path} cannot be moved")
    if not files.rename(new, place):
        if stood:
            files.rename(old, place)
        raise OSError(f"{staging} cannot take the name {path}")
    if stood:
        files.delete(old, True)


def _inline(spark: SparkSession, staging: str, schema: T.StructType) -> str:
    """The staged rows, few as they are, in order. A file with values of several lines is read by one task from its
    begin, so rows of one file come as they were written."""
    name = "_file"
    while name in schema.names:
        name = f"_{name}"
    staged = spark.read.schema(schema).options(**CSV).csv(staging)
    rows = staged.withColumn(name, F.col("_metadata.file_name")).toPandas()
    place = {n: k for k, n in enumerate(_part_files(spark, staging))}
    rows = rows.sort_values(name, key=lambda names: names.map(place), kind="stable")
    return rows.drop(columns=name).to_csv(sep="\t", index=False)
