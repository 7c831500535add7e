"""Parquet tables that can be rewritten while they are read.

Every write goes to a new ``version=N`` folder; a small pointer file lists the
folders that make up the table and is renamed into place once the write is
complete. Readers see the old table or the new one, and a failed load leaves
the old one untouched. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh.operators import buckets, files


class VersionedTable:
    """``partition`` names the storage partition, ``surrogate`` a running number, ``key`` what buckets go by.

    A partition column that ``schema`` does not list is storage only: readers see
    it on request. The pointer file also holds the highest running number handed
    out so far, a number that grows with every change, and notes that callers keep
    with a state of the table; all of them change with the folders, or not at all.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        partition: str | None = None,
        surrogate: str | None = None,
        key: str | None = None,
    ) -> None:
        self.spark = spark
        self.key = key
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition = partition
        self.surrogate = surrogate
        hidden = partition is not None and partition not in schema.fieldNames()
        self.stored = T.StructType([*schema.fields, T.StructField(partition, T.IntegerType())]) if hidden else schema

    def create_if_absent(self) -> VersionedTable:
        if not files.exists(self.spark, self._pointer):
            self._point_to([], 0, {}, 0)
        return self

    def folders(self) -> list[str]:
        return self._state()["folders"]

    def highest(self) -> int:
        return self._state()["highest"]

    def notes(self) -> dict:
        return self._state().get("notes", {})

    def change(self) -> int:
        """How often the table has changed."""
        return self._state().get("change", 0)

    def read(self, stored: bool = False) -> DataFrame:
        """The table's columns, with its storage partition if ``stored``."""
        shown = self.stored if stored else self.schema
        folders = self.folders()
        if not folders:
            return _no_rows(self.spark, shown)
        reader = self.spark.read.schema(self.stored).option("basePath", self.path)
        return reader.parquet(*(f"{self.path}/{folder}" for folder in folders)).select(*shown.fieldNames())

    def buckets(self) -> int | None:
        """How many buckets a partition is stored in; None for a table without rows, 1 for one without buckets."""
        return self.notes().get("buckets", 1) if self.folders() else None

    @contextmanager
    def opened(self, partition_values: Iterable[int]) -> Iterator[DataFrame]:
        """Rows of some partitions, read bucket by bucket where there are buckets; to be used within the block only."""
        wanted, number = set(partition_values), self.buckets() or 1
        if number == 1:
            yield self.read(stored=True).filter(F.col(self.partition).isin(sorted(wanted)))
            return
        held = {int(folder.split("=")[-1]): f"{self.path}/{folder}" for folder in self.folders()}
        found = {value: held[value] for value in sorted(wanted & held.keys())}
        with buckets.opened(self.spark, self.stored, self.path, self.partition, self.key, number, found) as rows:
            yield rows

    def replace(
        self,
        df: DataFrame,
        partition_values: Iterable[int] | None = None,
        highest: int | None = None,
        notes: dict | None = None,
        sort: str | None = None,
    ) -> None:
        """Makes ``df`` the content of the table, or of the partitions named.

        ``highest`` and ``notes`` replace those of the table, where given. With
        ``buckets`` in the notes the rows of a task go to files of their bucket,
        sorted by ``sort``; the caller has one task hold a bucket.
        """
        kept: list[str] = []
        if partition_values is not None:
            gone = {f"{self.partition}={value}" for value in partition_values}
            kept = [folder for folder in self.folders() if folder.split("/")[-1] not in gone]
        self._write(df, kept, highest, notes, sort)

    def append(self, df: DataFrame) -> None:
        self._write(df, self.folders(), None, None)

    @property
    def _pointer(self) -> str:
        return f"{self.path}/current.json"

    def _state(self) -> dict:
        if not files.exists(self.spark, self._pointer):
            return {"folders": [], "highest": 0}
        return json.loads(files.read_text(self.spark, self._pointer))

    def _write(
        self, df: DataFrame, kept: list[str], highest: int | None, notes: dict | None, sort: str | None = None
    ) -> None:
        before = self._state()
        version = f"version={self._next_version()}"
        rows = df.select(*self.stored.fieldNames())
        number = (notes or {}).get("buckets", 1) if self.key else 1
        if number > 1:
            buckets.write(rows, f"{self.path}/{version}", self.partition, self.key, number, sort)
        else:
            writer = rows.write.mode("errorifexists").option("compression", "zstd")
            if self.partition:
                writer = writer.partitionBy(self.partition)
            writer.parquet(f"{self.path}/{version}")
        written = [version]
        if self.partition:
            names = files.children(self.spark, f"{self.path}/{version}")
            written = [f"{version}/{name}" for name in names if name.startswith(f"{self.partition}=")]
        self._point_to(
            kept + written,
            before["highest"] if highest is None else highest,
            before.get("notes", {}) if notes is None else notes,
            before.get("change", 0) + 1,
        )

    def _next_version(self) -> int:
        return max((int(name.split("=")[1]) for name in self._versions()), default=0) + 1

    def remove_old_versions(self) -> None:
        """Deletes every folder the table no longer consists of.

        Not for use while someone still reads an earlier state of the table.
        """
        current = set(self.folders())
        for version in self._versions():
            path = f"{self.path}/{version}"
            if self.partition is None:
                if version not in current:
                    files.delete(self.spark, path)
                continue
            for name in files.children(self.spark, path):
                if name.startswith(f"{self.partition}=") and f"{version}/{name}" not in current:
                    files.delete(self.spark, f"{path}/{name}")

    def _versions(self) -> list[str]:
        return [name for name in files.children(self.spark, self.path) if name.startswith("version=")]

    def _point_to(self, folders: list[str], highest: int, notes: dict, change: int) -> None:
        state = {"folders": sorted(folders), "highest": highest, "notes": notes, "change": change}
        files.replace_text(self.spark, self._pointer, json.dumps(state))


def _no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame the optimizer knows to be empty, so joins with it fold away."""
    typed = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
    return spark.range(1).filter("false").select(*typed)
