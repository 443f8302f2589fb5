"""Reader shards as files: equal shares of a ranked set, a manifest, resuming by position.

A shard is one data-parallel reader's share (``rank mod n``), cut into files of a
fixed number of rows, so a file, not a shard, is what one task writes. Epochs are
rows of a plan over the manifest; the data are written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import constants as C
from millrace.operators.feed import shard

ROWS_PER_FILE = 10_000


def write_shards(ranked: DataFrame, out: str, n_shards: int = C.DATA_PARALLEL, rank_col: str = "rank",
                 len_col: str | None = None, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Write ``<out>/data/shard=<s>/file=<f>`` and ``<out>/manifest``; the manifest is returned.

    Every shard has the same number of rows (the remainder of the division is
    dropped, as ``shard`` does); within a shard rows lie by ``pos``. The manifest has
    one row per file: ``n_rows``, ``n_tokens`` (sum of ``len_col``; null without it),
    first and last rank. It is counted from the written files.
    """
    spark = ranked.sparkSession
    out = out.rstrip("/")
    rows = shard(ranked, n_shards, rank_col).withColumn("file", F.floor(F.col("pos") / rows_per_file))
    (rows.repartition("shard", "file").sortWithinPartitions("shard", "file", "pos")
     .write.mode("overwrite").partitionBy("shard", "file").parquet(f"{out}/data"))
    tokens = F.sum(len_col).cast("long") if len_col else F.lit(None).cast("long")
    held = spark.read.schema(rows.schema).parquet(f"{out}/data")
    manifest = held.groupBy("shard", "file").agg(
        F.count(F.lit(1)).alias("n_rows"), tokens.alias("n_tokens"), F.min(rank_col).alias("first_rank"),
        F.max(rank_col).alias("last_rank"))
    manifest.withColumn("rows_per_file", F.lit(rows_per_file).cast("long")).write.mode("overwrite").parquet(f"{out}/manifest")
    return spark.read.parquet(f"{out}/manifest")


def read_shard(spark: SparkSession, out: str, shard_no: int, start: int = 0) -> DataFrame:
    """Rows of one shard from position ``start`` on, by ``pos``; files before it are not opened."""
    out = out.rstrip("/")
    size = spark.read.parquet(f"{out}/manifest").select("rows_per_file").first()
    rows = spark.read.parquet(f"{out}/data").filter(F.col("shard") == shard_no)
    if size is None:
        return rows
    return rows.filter((F.col("file") >= start // size[0]) & (F.col("pos") >= start)).orderBy("pos")


def epoch_plan(manifest: DataFrame, batch_size: int, epochs: int) -> DataFrame:
    """One row per epoch and shard: its batches (the last partial one is dropped) and the step it begins at."""
    per = manifest.groupBy("shard").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_tokens").alias("n_tokens"))
    n = F.floor(F.col("n_rows") / batch_size)
    return per.select(F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"), "shard", "n_tokens",
                      n.alias("n_batches")).withColumn("first_step", F.col("epoch") * F.col("n_batches"))


def resume_at(step: int, rows_per_shard: int, batch_size: int) -> tuple[int, int]:
    """The epoch and the shard position where global step ``step`` begins."""
    per_epoch = rows_per_shard // batch_size
    if per_epoch == 0:
        raise ValueError("a shard holds less than one batch")
    return step // per_epoch, step % per_epoch * batch_size
