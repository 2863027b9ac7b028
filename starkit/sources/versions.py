"""Tables that are replaced as a whole or not at all.

Every version of a table is a folder of its own. A version counts from the moment its manifest, a small file with the next number, is
complete; readers take the newest complete one, or the one that they are pinned to. A write that dies leaves a folder that
nothing names and perhaps a manifest that is not complete, and the version before stays as it was. A table may be rebuilt from itself.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starkit.session import bucketed


class TableChanged(RuntimeError):
    """Someone else has written a version since the one that a change is based on."""


class VersionedTables:
    """Tables below ``root``, in any store that Spark reads and writes."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        jvm = spark.sparkContext._jvm
        self._path, self._text = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils
        self._files = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- manifests

    def _listed(self, folder: str) -> list:
        path = self._path(folder)
        return list(self._files.listStatus(path)) if self._files.exists(path) else []

    def _manifest(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/versions/{version:012d}.json"

    def _read(self, name: str, version: int) -> dict | None:
        """What a manifest says, None if it is not complete."""
        try:
            stream = self._files.open(self._path(self._manifest(name, version)))
        except Py4JJavaError:
            return None  # it has just expired
        try:
            return json.loads(self._text.toString(stream, "UTF-8"))
        except json.JSONDecodeError:
            return None
        finally:
            stream.close()

    def _numbers(self, name: str) -> list[int]:
        names = [found.getPath().getName() for found in self._listed(f"{self.root}/{name}/versions")]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())

    def versions(self, name: str) -> list[int]:
        """Numbers of the complete versions, the newest last."""
        return [number for number in self._numbers(name) if self._read(name, number)]

    def newest(self, name: str) -> int | None:
        for number in reversed(self._numbers(name)):
            if self._read(name, number):
                return number
        return None

    def _publish(self, name: str, entry: Mapping, based_on: int | None) -> int:
        """Writes the next manifest. Of two writers only one can make a file; the other takes the next number."""
        while True:
            if based_on is not None and self.newest(name) != based_on:
                raise TableChanged(f"{name} is at version {self.newest(name)}, the change was based on {based_on}")
            number = max(self._numbers(name), default=0) + 1
            try:
                stream = self._files.create(self._path(self._manifest(name, number)), False)
            except Py4JJavaError as error:
                if "AlreadyExists" in str(error.java_exception.getClass().getName()):
                    continue
                raise
            try:
                stream.write(bytearray(json.dumps(entry).encode()))
            finally:
                stream.close()
            return number

    # --- tables

    def save(self, df: DataFrame, name: str, bucket: tuple[str, int] | None = None, based_on: int | None = None) -> int:
        """Writes the next version of a table and returns its number; ``df`` may read any version of it.

        With ``bucket`` (column, number) rows of one value of the column are in one bucket. With ``based_on`` it fails with TableChanged if that is no longer
        the newest version (checked before the manifest is written).
        """
        folder = f"data/{uuid.uuid4().hex}"
        path = f"{self.root}/{name}/{folder}"
        writer = df.write.format(self.fmt).mode("errorifexists")
        if bucket:
            table = f"starkit_{uuid.uuid4().hex}"
            writer.bucketBy(bucket[1], bucket[0]).option("path", path).saveAsTable(table)
            self.spark.sql(f"DROP TABLE {table}")
        else:
            writer.save(path)
        entry = {"folder": folder, "schema": df.schema.jsonValue(), "bucket": list(bucket) if bucket else None, "format": self.fmt}
        return self._publish(name, entry, based_on)

    def load(self, name: str, version: int | None = None) -> DataFrame:
        """The newest version, or the one that is named; a frame stays at the version it was loaded from."""
        version = self.newest(name) if version is None else version
        entry = self._read(name, version) if version is not None else None
        if entry is None:
            raise ValueError(f"{name} has no version {version}" if version is not None else f"there is no table {name} in {self.root}")
        path, schema = f"{self.root}/{name}/{entry['folder']}", T.StructType.fromJson(entry["schema"])
        if entry["bucket"]:
            return bucketed(self.spark, path, schema, *entry["bucket"], entry["format"])
        return self.spark.read.schema(schema).format(entry["format"]).load(path)

    def expire(self, name: str, keep: int = 1, grace_seconds: float = 86_400) -> list[int]:
        """Removes all but the newest ``keep`` versions, and folders that no version names; returns the numbers that are gone.

        Folders changed within ``grace_seconds`` stay, as a writer may still be at work in one or a reader be pinned to it.
        """
        complete = self.versions(name)
        kept = set(complete[-max(keep, 1) :])
        gone = [number for number in complete if number not in kept]
        named = {self._read(name, number)["folder"] for number in kept}
        for number in gone:
            self._files.delete(self._path(self._manifest(name, number)), False)
        for found in self._listed(f"{self.root}/{name}/data"):
            old = found.getModificationTime() / 1000 <= time.time() - grace_seconds
            if old and f"data/{found.getPath().getName()}" not in named:
                self._files.delete(found.getPath(), True)
        return gone
