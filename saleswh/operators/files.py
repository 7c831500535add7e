"""Small file operations through Spark's own file-system layer.

They work wherever Spark reads and writes: local folders, HDFS, object stores.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from saleswh.session import shared_dir


def _at(spark: SparkSession, path: str):
    """The path and its file system."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    location, fs = _at(spark, path)
    return fs.exists(location)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where the folder does not exist."""
    location, fs = _at(spark, path)
    if not fs.exists(location):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(location))


def delete(spark: SparkSession, path: str) -> None:
    location, fs = _at(spark, path)
    fs.delete(location, True)


def read_text(spark: SparkSession, path: str) -> str:
    location, fs = _at(spark, path)
    stream = fs.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a draft beside the file, then renames it over the file."""
    draft, fs = _at(spark, f"{path}.next")
    stream = fs.create(draft, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(draft.toUri(), fs.getConf())
    context.rename(draft, hadoop.Path(path), options)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the session's part of the shared folder."""
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Deletes what this session has written there; call it when all results have been read."""
    delete(spark, _scratch(spark))


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/saleswh-{spark.sparkContext.applicationId}"


def write_once(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes ``df`` to the shared folder and reads it back, with its path.

    For results that several jobs need: they share one computation, and lost
    executors cost only the files still to be read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder, task by task, its lineage cut."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def swap_in(spark: SparkSession, ready: str, target: str) -> None:
    """Renames a finished folder to ``target``; what was there before goes once the new one is in place."""
    source, fs = _at(spark, ready)
    place, _ = _at(spark, target)
    aside, _ = _at(spark, f"{target}.before-{uuid.uuid4().hex}")
    had_one = fs.exists(place)
    if had_one and not fs.rename(place, aside):
        raise OSError(f"cannot move {target}")
    if not fs.rename(source, place):
        if had_one:
            fs.rename(aside, place)
        raise OSError(f"cannot move {ready} to {target}")
    if had_one:
        fs.delete(aside, True)
