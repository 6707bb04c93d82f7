"""The keys a stream has kept, in levels that are merged as they fill.

Folders::

    batch=<n>/      keys of one batch; -1 is the published baseline
    through=<n>/    keys of several batches up to n, each with its batch number;
                    the file ``_from`` names the first and is written last

After every ``fanout`` batches these become one folder, after every ``fanout``
such folders these become one, and so on, like carries of a counter. A key is
written again once per level, so n batches cost n log n, and a batch reads at
most ``fanout - 1`` folders per level. The baseline stays as it is.

Rows of a merged folder know their batch. A batch that is replayed reads from it
what lies before, so merged folders may replace their parts at once.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstseen.storage import Storage

# The number under which the published baseline enters.
BASELINE_BATCH = -1


class LostKeys(RuntimeError):
    """The index does not cover every batch it should."""


class KeyIndex:
    """Keys by batch below one folder. ``schema`` has a ``file_date`` to folder by."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, fanout: int):
        if fanout < 2:
            raise ValueError("fanout is less than 2")
        self.spark, self.folder, self.schema, self.fanout = spark, folder, schema, fanout
        self._storage = Storage(spark, folder)

    def add(self, keys: DataFrame, number: int) -> None:
        """Write the keys of a batch, then merge the levels it fills."""
        self._write(keys, f"{self.folder}/batch={number}")
        if number >= 0:
            self._merge(number)

    def has_baseline(self) -> bool:
        return self._storage.exists(f"{self.folder}/batch={BASELINE_BATCH}/_SUCCESS")

    def folders(self, number: int) -> list[str]:
        """The folders that hold the keys before a batch, the baseline first."""
        baseline = [f"{self.folder}/batch={BASELINE_BATCH}"] if self.has_baseline() else []
        return baseline + [folder for folder, *_ in self._cover(0, number)]

    def before(self, number: int) -> DataFrame:
        """The keys kept before a batch."""
        found = self.spark.createDataFrame([], self.schema)
        if self.has_baseline():
            found = found.unionAll(self._read(f"{self.folder}/batch={BASELINE_BATCH}", self.schema))
        return found.unionAll(self._between(0, number).drop("batch"))

    def _read(self, folder: str, schema: str) -> DataFrame:
        columns = self.spark.createDataFrame([], schema).columns
        return self.spark.read.schema(schema).parquet(folder).select(*columns)

    def _between(self, first: int, end: int) -> DataFrame:
        """Keys of the batches from ``first`` up to ``end``, with their ``batch``."""
        found = self.spark.createDataFrame([], f"batch BIGINT, {self.schema}")
        for folder, low, high in self._cover(first, end):
            if "/batch=" in folder:
                rows = self._read(folder, self.schema).select(F.lit(low).cast("bigint").alias("batch"), "*")
            else:
                rows = self._read(folder, f"batch BIGINT, {self.schema}").filter(F.col("batch").between(low, high))
            found = found.unionAll(rows)
        return found

    def _spans(self) -> list[tuple[int, int, str]]:
        """(first batch, last batch, folder) of every folder that is whole."""
        found = []
        for name in self._storage.names(self.folder):
            match, folder = re.fullmatch(r"(batch|through)=(\d+)", name), f"{self.folder}/{name}"
            if match and match[1] == "batch" and self._storage.exists(f"{folder}/_SUCCESS"):
                found.append((int(match[2]), int(match[2]), folder))
            elif match and match[1] == "through" and self._storage.exists(f"{folder}/_from"):
                found.append((int(self._storage.read_text(f"{folder}/_from")), int(match[2]), folder))
        return found

    def _cover(self, first: int, end: int) -> list[tuple[str, int, int]]:
        """As few folders as hold all batches from ``first`` up to ``end``, and what
        to take from each."""
        spans, found, at = self._spans(), [], first
        while at < end:
            last, folder = max(((b, f) for a, b, f in spans if a <= at <= b), default=(None, None))
            if folder is None:
                raise LostKeys(f"the keys of batch {at} are not in {self.folder}")
            found.append((folder, at, min(last, end - 1)))
            at = last + 1
        return found

    def _merge(self, number: int) -> None:
        """Write the levels that end with this batch together, and drop the parts."""
        size, reach = self.fanout, 0
        while (number + 1) % size == 0:
            size, reach = size * self.fanout, size
        if not reach:
            return
        first, whole = number + 1 - reach, f"{self.folder}/through={number}"
        if not self._storage.exists(f"{whole}/_from"):
            rows = self._between(first, number + 1)
            self._write(rows.hint("rebalance", "file_date"), whole)
            self._storage.write_text(f"{whole}/_from", str(first))
        for low, high, folder in self._spans():
            if first <= low and high <= number and folder != whole:
                self._storage.remove_folder(folder)

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.write.mode("overwrite").partitionBy("file_date").parquet(folder)
