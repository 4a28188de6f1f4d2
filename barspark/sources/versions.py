"""A table of replaceable partitions behind numbered manifests.

Data folders are written once and never changed.  A manifest names the folder of every partition
(a calendar month, so their number is bounded by the history's length); publishing a change is the
creation of the next manifest, and the highest complete one is the table.  Nothing that a reader may see is
deleted or renamed over, so a crash between two steps leaves the last published table as it was.
One writer per table: publishing a number that exists already fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barspark.sources import fsutil

PREFIX = "MANIFEST-"
#: Published versions that stay readable; older folders are removed after a change.
KEEP = 3


class VersionedTable:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def numbers(self) -> list[int]:
        names = fsutil.list_names(self.spark, self.base)
        return sorted(int(n[len(PREFIX) :]) for n in names if n.startswith(PREFIX))

    def _path(self, number: int) -> str:
        return fsutil.join(self.base, f"{PREFIX}{number:012d}")

    def folders(self, number: int | None = None) -> dict[str, str]:
        """Partition -> folder of a version (the newest by default; {} before the first)."""
        numbers = self.numbers()
        if not numbers:
            if any(n.startswith("v-") for n in fsutil.list_names(self.spark, self.base)):
                raise FileNotFoundError(f"{self.base} holds data folders but no manifest: its first write did not finish")
            return {}
        return json.loads(fsutil.read_text(self.spark, self._path(numbers[-1] if number is None else number)))

    def read(self, schema: T.StructType, partitions: list[str] | None = None) -> DataFrame:
        found = self.folders()
        paths = [p for k, p in sorted(found.items()) if partitions is None or k in partitions]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def replace(self, rows: DataFrame, partition: str, partitions: list[str], everything: bool = False) -> None:
        """Publish a version in which ``partitions`` (all, if ``everything``) hold exactly ``rows``.

        ``partition`` is the column of ``rows`` that names a row's partition; it is not stored.
        """
        target = fsutil.join(self.base, f"v-{uuid.uuid4().hex}")
        rows.withColumnRenamed(partition, "_part").write.mode("error").partitionBy("_part").parquet(target)
        numbers = self.numbers()
        now = {} if everything else {k: v for k, v in self.folders().items() if k not in partitions} if numbers else {}
        for name in fsutil.list_names(self.spark, target):
            if name.startswith("_part="):
                now[name[len("_part=") :]] = fsutil.join(target, name)
        number = numbers[-1] + 1 if numbers else 1
        fsutil.create_text(self.spark, self._path(number), json.dumps(now, sort_keys=True))
        self.prune()

    def prune(self, keep: int = KEEP) -> None:
        numbers = self.numbers()
        if len(numbers) <= keep:
            return
        used = {p.rstrip("/").rsplit("/", 2)[-2] for n in numbers[-keep:] for p in self.folders(n).values()}
        for n in numbers[:-keep]:
            fsutil.remove(self.spark, self._path(n))
        for name in fsutil.list_names(self.spark, self.base):
            if name.startswith("v-") and name not in used:
                fsutil.remove(self.spark, fsutil.join(self.base, name))
