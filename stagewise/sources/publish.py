"""Partitioned tables that a reader sees old or new, never in between.

Every publish writes its partitions into a folder of its own and then makes one file visible: the next manifest, which names the
folder of every partition of the table. Readers take the newest manifest there is; files that it names are never touched again.
A publish that fails leaves the table as it was, also when it replaces a whole month of days. Two that run at the same time
cannot take the same number: the second finds its manifest there, reads it, and puts its own partitions on top.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Published:
    """A table in the folder ``path`` with one integer partition column, such as ``day`` or ``month``."""

    def __init__(self, spark: SparkSession, path: str, partition: str):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition

    def publish(self, df: DataFrame, values: list[int]) -> int:
        """Replaces the partitions ``values`` by the rows of ``df`` (those without rows become empty) in one step and returns the version.
        Rows of other partitions raise ``ValueError`` and change nothing. The plan of ``df`` runs once."""
        self._fits(df)
        folder, found = f"data/{uuid.uuid4().hex}", Observation()
        try:
            (
                df.hint("rebalance", self.partition)
                .observe(found, F.collect_set(self.partition).alias("values"))
                .write.partitionBy(self.partition)
                .parquet(f"{self.path}/{folder}")
            )
            filled = set(found.get["values"])
            if stray := filled - set(values):
                raise ValueError(f"rows of partitions that were not asked for: {sorted(stray)}")
            while True:
                before = self._manifest()
                self._fits(df, before)
                kept = {v: f for v, f in before["partitions"].items() if int(v) not in set(values)}
                after = {
                    "version": before["version"] + 1,
                    "schema": df.schema.json(),
                    "partitions": kept | {str(v): folder for v in sorted(filled)},
                }
                if self._make_visible(after):
                    return after["version"]
        except BaseException:
            self._delete(f"{self.path}/{folder}")
            raise

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, the newest by default. Filters on the partition column prune folders."""
        manifest = self._manifest(version)
        if not manifest["version"]:
            raise ValueError(f"nothing is published in {self.path}")
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        by_folder = defaultdict(list)
        for value, folder in manifest["partitions"].items():
            by_folder[folder].append(f"{self.path}/{folder}/{self.partition}={value}")
        tables = [
            self.spark.read.schema(schema).option("basePath", f"{self.path}/{folder}").parquet(*sorted(paths)).select(*schema.names)
            for folder, paths in sorted(by_folder.items())
        ]
        if not tables:
            return self.spark.createDataFrame([], schema)
        whole = tables[0]
        for table in tables[1:]:
            whole = whole.unionByName(table)
        return whole

    def versions(self) -> list[int]:
        folder = self._place(f"{self.path}/_manifests")
        files = self._files()
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes the manifests before the newest ``keep`` and the folders that no kept manifest names. Readers of
        older versions, and publishes that still run, must be over."""
        known = self.versions()
        kept = known[-keep:]
        named = {f for v in kept for f in self._manifest(v)["partitions"].values()}
        for version in known[:-keep]:
            self._delete(self._name(version))
        data, files, gone = self._place(f"{self.path}/data"), self._files(), []
        for status in files.listStatus(data) if files.exists(data) else []:
            folder = f"data/{status.getPath().getName()}"
            if folder not in named:
                self._delete(f"{self.path}/{folder}")
                gone.append(folder)
        return gone

    def _fits(self, df: DataFrame, manifest: dict | None = None) -> None:
        if self.partition not in df.columns:
            raise ValueError(f"no column {self.partition}")
        manifest = manifest or self._manifest()
        if manifest["version"]:
            held = T.StructType.fromJson(json.loads(manifest["schema"]))
            if [(f.name, f.dataType) for f in held] != [(f.name, f.dataType) for f in df.schema]:
                raise ValueError(f"the table has {held.simpleString()}, not {df.schema.simpleString()}")

    def _name(self, version: int) -> str:
        return f"{self.path}/_manifests/{version:012d}.json"

    def _manifest(self, version: int | None = None) -> dict:
        version = max(self.versions(), default=0) if version is None else version
        if not version:
            return {"version": 0, "schema": None, "partitions": {}}
        stream = self._files().open(self._place(self._name(version)))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _make_visible(self, manifest: dict) -> bool:
        """The one step that readers see: a whole file takes its name, or another one has it already."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        hidden = f"{self.path}/_manifests/_{uuid.uuid4().hex}"
        stream = self._files().create(self._place(hidden), False)
        stream.write(bytearray(json.dumps(manifest), "utf-8"))
        stream.close()
        place = self._place(self._name(manifest["version"]))
        context = hadoop.FileContext.getFileContext(place.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rename = getattr(hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 0)
        try:
            context.rename(self._place(hidden), place, options)
        except Exception as error:
            self._delete(hidden)
            if "FileAlreadyExists" not in str(error):
                raise
            return False
        return True

    def _place(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._place(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        self._files().delete(self._place(path), True)
