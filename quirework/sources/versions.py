"""Tables in versions: each write is a folder of its own, and a pointer says which one is current.

The pointer is a numbered file that a writer creates, and that creation fails if another writer has created it: whoever
comes second is told so, and nothing that is read is ever overwritten. This rests on a file system that creates a file only
where there is none (as HDFS does).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(Exception):
    """Another writer has published a version since."""


class IdsDiffer(Exception):
    """An update has lost or invented rows."""


@dataclass(frozen=True)
class Sync:
    """The version that is current after a sync, and how many rows it changed."""

    version: int
    changed: int


class VersionedTable:
    """A table of one row for each ``key`` below ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self._jvm = spark._jvm
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def version(self) -> int:
        """The number of the current version, 0 before the first."""
        if not self._fs.exists(self._at("_versions")):
            return 0
        return max((int(s.getPath().getName()) for s in self._fs.listStatus(self._at("_versions"))), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the current one by default."""
        number = version or self.version()
        if not number:
            raise FileNotFoundError(f"nothing is published at {self.path}")
        held = self._fs.open(self._at(f"_versions/{number:010d}"))
        try:
            folder = self._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
        finally:
            held.close()
        return self.spark.read.parquet(f"{self.path}/{folder}")

    def publish(self, rows: DataFrame, expected: int) -> int:
        """Write ``rows`` as the version after ``expected``; ``Conflict`` if that is no longer the current one."""
        folder = f"data-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        if self.version() == expected:
            try:
                out = self._fs.create(self._at(f"_versions/{expected + 1:010d}"), False)
                out.write(bytearray(folder.encode()))
                out.close()
                return expected + 1
            except Py4JJavaError as failed:
                if "exists" not in str(failed.java_exception).lower():
                    raise
        self._fs.delete(self._at(folder), True)
        raise Conflict(f"version {expected + 1} of {self.path} was published by another writer")

    def sync(self, update: Callable[[DataFrame], DataFrame], dry_run: bool = False) -> Sync:
        """Publish ``update`` of the current rows if it changes any; an update must keep the ids and columns.

        Rows that differ are counted by key; where none does, or in a dry run, nothing is published.
        """
        number = self.version()
        before = self.read(number)
        after = update(before)
        if sorted(before.columns) != sorted(after.columns):
            raise IdsDiffer(f"columns differ: {sorted(set(before.columns) ^ set(after.columns))}")
        met = _told(before, self.key, "_a").join(_told(after, self.key, "_b"), self.key, "full")
        found = met.agg(
            F.count_if(F.col("_a.n").isNull() | F.col("_b.n").isNull() | (F.col("_a.n") != F.col("_b.n"))).alias("ids"),
            F.count_if(F.col("_a.h") != F.col("_b.h")).alias("changed"),
        ).first()
        if found.ids:
            raise IdsDiffer(f"{found.ids} ids stand on one side only, or more often")
        if found.changed and not dry_run:
            number = self.publish(after.select(*before.columns), number)
        return Sync(number, found.changed)


def _told(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Each key with the number of its rows and a digest of what they hold."""
    digest = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
    return rows.groupBy(key).agg(F.struct(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(digest)), ",").alias("h")).alias(name))
