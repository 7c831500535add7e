"""An index of a table's keys: the day and the fingerprint of each row, kept beside the table.

The index is bucketed by key, so a batch is compared with it by a join that
shuffles the batch only. Around that it is cut into slabs by the upper bits of
the key: keys that follow one another share a slab, and a slab no key of the batch
falls into is neither read nor written. Each slab is one folder, replaced as a
whole; which folders make up the index is a small dictionary that the caller
keeps with the state of the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.operators import files

#: Keys with the same bits above these share a slab.
NEAR_BITS = 16


class KeyIndex:
    """``slabs`` and ``buckets`` count for an index that is still to be written.

    A bucket of a slab is a file; a join reads the wanted slabs with one task per
    bucket. For a large table take some thousand buckets.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, slabs: int = 8, buckets: int = 8) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = key
        self.slabs = slabs
        self.buckets = buckets

    def slab(self, state: dict | None) -> Column:
        number = state["slabs"] if state else self.slabs
        return F.pmod(F.xxhash64(F.shiftright(self.key, NEAR_BITS)), F.lit(number)).cast("int")

    def slabs_of(self, rows: DataFrame, state: dict) -> list[int]:
        """Slabs that the keys of ``rows`` fall into: at most as many as there are."""
        found = rows.select(self.slab(state).alias("slab")).distinct().collect()
        return sorted(row["slab"] for row in found)

    @contextmanager
    def opened(self, state: dict, slabs: Sequence[int]) -> Iterator[DataFrame]:
        """The entries of some slabs: key, ``stored_day`` and ``stored_print``; to be used within the block only."""
        name = f"key_index_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({self.key} BIGINT, stored_day INT, stored_print BIGINT, slab INT) USING parquet "
            f"PARTITIONED BY (slab) CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {state['buckets']} BUCKETS "
            f"LOCATION '{self.path}'"
        )
        try:
            wanted = [(slab, state["folders"][str(slab)]) for slab in slabs if str(slab) in state["folders"]]
            if wanted:
                added = " ".join(f"PARTITION (slab={n}) LOCATION '{self.path}/{folder}/slab={n}'" for n, folder in wanted)
                self.spark.sql(f"ALTER TABLE {name} ADD {added}")
            yield self.spark.table(name).drop("slab")
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def write(self, entries: DataFrame, state: dict | None, placed: bool = False) -> dict:
        """Writes entries (key, ``stored_day``, ``stored_print``) as the whole content of their slabs.

        ``placed`` entries lie in their buckets' tasks already and are not shuffled. Returns the new state; the old one stays valid, since no file is changed.
        """
        now = state or {"slabs": self.slabs, "buckets": self.buckets, "folders": {}}
        numbers = [int(n.split("=")[1]) for n in files.children(self.spark, self.path) if n.startswith("version=")]
        version = f"version={max(numbers, default=0) + 1}"
        rows = entries.select(self.key, "stored_day", "stored_print", self.slab(now).alias("slab"))
        name = f"key_index_{uuid.uuid4().hex}"
        dealt = rows if placed else rows.repartition(now["buckets"], self.key)
        writer = dealt.write.mode("errorifexists").partitionBy("slab").option("compression", "zstd")
        writer = writer.bucketBy(now["buckets"], self.key).sortBy(self.key)
        writer.option("path", f"{self.path}/{version}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        written = [n.split("=")[1] for n in files.children(self.spark, f"{self.path}/{version}") if n.startswith("slab=")]
        return {**now, "folders": {**now["folders"], **{slab: version for slab in written}}}

    def remove_unused(self, state: dict) -> None:
        """Deletes every folder that ``state`` does not name. Not while someone reads an earlier state."""
        used = {(folder, slab) for slab, folder in state["folders"].items()}
        for version in files.children(self.spark, self.path):
            for name in files.children(self.spark, f"{self.path}/{version}"):
                if name.startswith("slab=") and (version, name.split("=")[1]) not in used:
                    files.delete(self.spark, f"{self.path}/{version}/{name}")
