"""Structured Streaming variants of the record-independent steps.

* ST1: line-at-a-time JSONL chat source with an explicit schema.
* ST2: decontamination per micro-batch against a static benchmark
  (``foreachBatch`` runs the batch operator; records are independent, so a
  stream equals its batch form).
* ST3: exact dedup by content id with bounded state (a watermark on an
  ingest timestamp), or unbounded ``dropDuplicates`` when none is given, or
  exactly with its ids in files (``dedup_batches``): no copy passes however late.
* ST4: running token-length histogram over fixed bin edges (complete mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import content_id, question_of
from millrace.sources.chats import CHAT_SCHEMA


def read_chat_stream(spark: SparkSession, directory: str, schema=CHAT_SCHEMA,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(directory).withColumn("ingest_ts", F.current_timestamp())


def with_question(stream: DataFrame) -> DataFrame:
    """Positional question and its content id, per record (stateless)."""
    q = question_of("conversations")
    return stream.withColumn("question", q).withColumn("question_id", content_id(F.col("question")))


def dedup_stream(stream: DataFrame, key: str = "question_id", event_time: str | None = None,
                 delay: str = "1 hour") -> DataFrame:
    """Drop repeated keys. With ``event_time`` the state is bounded by the watermark."""
    if event_time:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def dedup_batches(out_kept: str, ids_dir: str, key: str = "question_id"):
    """``foreachBatch`` function: keep the first row of each key of the whole stream, with the ids in files.

    Each epoch owns a folder (``epoch=<n>``) of kept rows and one of their ids. An
    epoch meets only the ids of earlier epochs and replaces its own folders, so a
    retried epoch or a restarted stream gives the same keys once. Executors hold no
    state: an epoch reads the earlier ids (one narrow column, as large as the
    distinct keys so far) and shuffles them against its own keys; late copies are
    dropped whatever their age. Of copies in one batch any one stays. A null key is
    a key of its own.
    """
    from millrace.session import cut_lineage

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        kept = batch.dropDuplicates([key])
        if epoch_id > 0:
            ids = spark.read.parquet(ids_dir).filter(F.col("epoch") < epoch_id).select(F.col(key).alias("__seen"))
            kept = kept.join(ids, F.col(key).eqNullSafe(F.col("__seen")), "left_anti")
        kept = cut_lineage(kept, "stream-new")
        kept.write.mode("overwrite").parquet(f"{out_kept.rstrip('/')}/epoch={epoch_id}")
        kept.select(key).write.mode("overwrite").parquet(f"{ids_dir.rstrip('/')}/epoch={epoch_id}")

    return run


def decontaminate_batches(benchmark: DataFrame, threshold: float, out_flagged: str, out_kept: str,
                          id_col: str = "question_id", text_col: str = "question"):
    """``foreachBatch`` function: flag each micro-batch against the static benchmark and write both outputs.

    Each epoch owns a folder (``epoch=<n>``) in either output and replaces it
    whole, so a retried epoch leaves one copy of its rows. The batch and its
    matches are written once; the kept rows follow from the written matches.
    """
    from millrace.operators.dedup import contamination_matches, drop_flagged
    from millrace.session import cut_lineage

    def run(batch: DataFrame, epoch_id: int) -> None:
        rows = cut_lineage(batch, "stream-batch")
        flagged = f"{out_flagged.rstrip('/')}/epoch={epoch_id}"
        contamination_matches(rows, benchmark, id_col, text_col, "item_id", "text", threshold).write.mode(
            "overwrite").parquet(flagged)
        m = batch.sparkSession.read.parquet(flagged)
        drop_flagged(rows, m, id_col).write.mode("overwrite").parquet(f"{out_kept.rstrip('/')}/epoch={epoch_id}")

    return run


def length_histogram_stream(stream: DataFrame, length_col: str, edges: list[int]) -> DataFrame:
    """Counts per fixed bin ``[edges[i], edges[i+1])``; values past the last edge go to the last bin."""
    b = F.lit(0)
    for i, e in enumerate(edges[1:-1], start=1):
        b = F.when(F.col(length_col) >= e, F.lit(i)).otherwise(b)
    return stream.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
