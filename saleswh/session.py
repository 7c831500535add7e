"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

EXACT_DECIMALS = "spark.sql.decimalOperations.allowPrecisionLoss"

# Result-relevant settings first, then the adaptive planning ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Products of decimals keep their digits instead of giving up decimals.
    "spark.sql.decimalOperations.allowPrecisionLoss": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Recording the Python line of every column call makes building plans slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "saleswh", master: str | None = None, **extra: str) -> SparkSession:
    """A session with ``SETTINGS``; ``extra`` entries use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **{key.replace("__", "."): value for key, value in extra.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_exact_decimals(spark: SparkSession) -> None:
    """For sessions made elsewhere: without this, amounts would be rounded twice."""
    spark.conf.set(EXACT_DECIMALS, SETTINGS[EXACT_DECIMALS])


def use_buckets(spark: SparkSession) -> None:
    """Bucketed files are read a bucket to a task, also where no join asks for it, so that they are written that way."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")


@contextmanager
def finer_shuffles(spark: SparkSession, least: int) -> Iterator[None]:
    """Shuffles begin with ``least`` partitions or more and are put together to half the size, so that sorts fit tasks."""
    number, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {name: spark.conf.get(name, None) for name in (number, size)}
    if int(before[number] or spark.conf.get("spark.sql.shuffle.partitions")) < least:
        spark.conf.set(number, str(least))
    advised = spark._jsparkSession.sessionState().conf().getConfString(size, "64m")
    spark.conf.set(size, f"{spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(advised) // 2}b")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a
    cluster without it is refused, because a machine-local folder would not
    survive the loss of an executor.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="saleswh-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir()
