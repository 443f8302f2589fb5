"""Parsed input that is found again.

A chat file is parsed once for each state of it (path, size, modification time).
Parsed rows lie as Parquet in ``<cache>/parsed``, one folder per state; the
manifest ``<cache>/manifest`` names the states that are complete. Spark lists the
files and reads the folders, so any store that it reads will do; only names of
files reach the driver.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.chats import CHAT_SCHEMA, read_chat_jsonl

MANIFEST = "state string, source_path string, size long, modified timestamp"


def _file_states(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per input file; the contents are not read."""
    files = spark.read.format("binaryFile").load(list(paths)).select(
        "path", F.col("_metadata.file_path").alias("source_path"), F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"))
    return files.withColumn("state", F.sha2(F.concat_ws("|", "source_path", F.col("size").cast("string"),
                                                        F.unix_micros("modified").cast("string")), 256))


def _table(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:  # nothing was written there yet
        return None


def _literal(path: str) -> str:
    """A path for a reader that takes patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _parse(spark: SparkSession, paths: list[str]) -> DataFrame:
    chats = read_chat_jsonl(spark, paths)
    return chats.withColumn("file_name", F.element_at(F.split("source_path", "/"), -1))


def read_chats(spark: SparkSession, paths, cache_dir: str | None = None) -> DataFrame:
    """``read_chat_jsonl`` with ``file_name``; with ``cache_dir`` only new or changed files are parsed.

    A file whose size or modification time changed is a new state and is parsed
    again, alone; the others come from their Parquet folders. A state counts only
    once the manifest names it, which happens after its rows are written, so a run
    that was cut off leaves nothing half-read; parsing a state again replaces its
    folder. Files without a line have no folder. Rows of files that are no longer
    asked for stay until ``forget_stale``.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if cache_dir is None:
        return _parse(spark, paths)
    base = cache_dir.rstrip("/")
    files = _file_states(spark, paths)
    known = _table(spark, f"{base}/manifest", MANIFEST)
    fresh = (files if known is None else files.join(known, "state", "left_anti")).select(
        "state", "path", "source_path", "size", "modified").collect()  # names of files, no contents
    if fresh:
        states = spark.createDataFrame([(r["state"], r["source_path"]) for r in fresh], "state string, source_path string")
        parsed = _parse(spark, [_literal(r["path"]) for r in fresh])
        (parsed.join(F.broadcast(states), "source_path").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("state").parquet(f"{base}/parsed"))
        spark.createDataFrame([(r["state"], r["source_path"], r["size"], r["modified"]) for r in fresh],
                              MANIFEST).coalesce(1).write.mode("append").parquet(f"{base}/manifest")
    empty = _parsed_schema()
    held = _table(spark, f"{base}/parsed", T.StructType([*empty.fields, T.StructField("state", T.StringType())]))
    if held is None:  # every file is empty
        return spark.createDataFrame([], empty)
    # one row per file: the scan reads the folders of these states alone
    return held.join(F.broadcast(files.select("state")), "state", "left_semi").select(*empty.names)


def _parsed_schema() -> T.StructType:
    pos = T.StructType([T.StructField("file", T.StringType()), T.StructField("offset", T.LongType())])
    return T.StructType([*CHAT_SCHEMA.fields, T.StructField("source_path", T.StringType()),
                         T.StructField("source_mtime", T.TimestampType()), T.StructField("source_pos", pos),
                         T.StructField("file_name", T.StringType())])


def forget_stale(spark: SparkSession, cache_dir: str, paths) -> int:
    """Delete the parsed rows of states that the files at ``paths`` no longer have; their number.

    The manifest is written first (a state that it does not name is parsed again).
    """
    base = cache_dir.rstrip("/")
    known = _table(spark, f"{base}/manifest", MANIFEST)
    if known is None:
        return 0
    now = _file_states(spark, [paths] if isinstance(paths, str) else list(paths)).select("state")
    keep = known.join(now, "state", "left_semi").distinct().collect()
    gone = [r["state"] for r in known.join(now, "state", "left_anti").select("state").distinct().collect()]
    spark.createDataFrame(keep, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest")
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Spark's own file systems have no Python face
    for state in gone:
        path = jvm.org.apache.hadoop.fs.Path(f"{base}/parsed/state={state}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001
    return len(gone)
