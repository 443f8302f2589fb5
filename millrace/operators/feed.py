"""Trainer feed: seeded order, shards, fixed batches, dynamic batch padding.

The global order is a stable hash of ``seed:id`` (the same under any
partitioning). A global rank is computed without a single-partition
window: rows are bucketed by the hash prefix, bucket sizes (a small table)
give offsets, and ranks are numbered inside each bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace import constants as C
from millrace.functions.arrays import pad_to, padded_length


def shuffle_key(id_col: str, seed: int = C.SHUFFLE_SEED) -> F.Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)


def seeded_rank(df: DataFrame, id_col: str, seed: int = C.SHUFFLE_SEED, prefix_digits: int | None = None,
                out: str = "rank", rows_per_bucket: int = 200_000) -> DataFrame:
    """0-based position of every row in the seeded order.

    Hash prefixes are uniform, so the ``16**prefix_digits`` buckets are
    balanced whatever the ids look like. The offset table has one row per
    bucket; its running sum is the only unpartitioned window and it is
    bounded by the bucket count. Without ``prefix_digits`` the bucket count
    grows with the row count (about ``rows_per_bucket`` rows per bucket,
    at least 16**3 buckets).
    """
    if prefix_digits is None:
        import math
        n = df.count()
        prefix_digits = max(3, math.ceil(math.log(max(n / rows_per_bucket, 1.0), 16)))
    h = shuffle_key(id_col, seed)
    keyed = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, prefix_digits))
    sizes = keyed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_b", (F.sum("_n").over(Window.orderBy("_b").rowsBetween(
        Window.unboundedPreceding, -1))).alias("_off"))
    offsets = offsets.select("_b", F.coalesce("_off", F.lit(0)).alias("_off"))
    w = Window.partitionBy("_b").orderBy("_h")
    ranked = keyed.join(F.broadcast(offsets), "_b").withColumn(
        out, F.col("_off") + F.row_number().over(w) - 1)
    return ranked.drop("_h", "_b", "_off")


def shard(ranked: DataFrame, n_shards: int = C.DATA_PARALLEL, rank_col: str = "rank") -> DataFrame:
    """Equal shards: ``shard = rank mod n``, ``pos = rank div n``; the remainder is dropped."""
    n = ranked.agg(F.count(F.lit(1))).scalar()
    usable = (n - F.pmod(n, F.lit(n_shards)))
    r = F.col(rank_col)
    return ranked.filter(r < usable).select(
        "*", F.pmod(r, F.lit(n_shards)).alias("shard"), ((r - F.pmod(r, F.lit(n_shards))) / n_shards).cast("long").alias("pos"))


def batches(ranked: DataFrame, batch_size: int, epochs: int = 1, rank_col: str = "rank") -> DataFrame:
    """Fixed batches in rank order, last partial batch dropped, repeated per epoch."""
    n = ranked.agg(F.count(F.lit(1))).scalar()
    n_batches = (n - F.pmod(n, F.lit(batch_size))) / batch_size
    r = F.col(rank_col)
    b = ((r - F.pmod(r, F.lit(batch_size))) / batch_size).cast("long")
    out = ranked.select("*", b.alias("batch")).filter(F.col("batch") < n_batches)
    return out.select("*", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))


def dynamic_padding(batched: DataFrame, len_col: str, batch_col: str = "batch",
                    divisor: int = C.BATCH_DIVISOR, remainder: int = C.BATCH_REMAINDER) -> DataFrame:
    """Per batch: longest sample, padded length (L >= max, L mod divisor == remainder), pad tokens."""
    g = batched.groupBy(batch_col).agg(F.max(len_col).alias("max_len"), F.sum(len_col).alias("_sum"),
                                       F.count(F.lit(1)).alias("_n"))
    L = padded_length(F.col("max_len"), divisor, remainder)
    return g.select(batch_col, "max_len", L.alias("padded_len"),
                    (L * F.col("_n") - F.col("_sum")).alias("n_pad"))


def padded_batches(batched: DataFrame, ids_col: str = "input_ids", labels_col: str = "labels", batch_col: str = "batch",
                   divisor: int = C.BATCH_DIVISOR, remainder: int = C.BATCH_REMAINDER, pad_id: int = C.PAD_ID,
                   ignore: int = C.IGNORE_ID) -> DataFrame:
    """``batched`` with its arrays padded to the batch's length, and ``attention_mask`` (1 on real positions).

    The length is the smallest L >= the longest sample with L mod divisor ==
    remainder. Only (batch, length) is aggregated; each row then meets its batch's
    length and is padded in place. Null arrays count as empty.
    """
    empty = F.array().cast("array<int>")
    rows = batched.withColumns({ids_col: F.coalesce(ids_col, empty), labels_col: F.coalesce(labels_col, empty)})
    length = rows.groupBy(batch_col).agg(F.max(F.size(ids_col)).alias("_max")).select(
        batch_col, padded_length(F.col("_max"), divisor, remainder).alias("padded_len"))
    j = rows.join(length, batch_col).withColumn("_size", F.size(ids_col))
    full = F.col("padded_len")
    return j.withColumns({
        ids_col: pad_to(ids_col, full, pad_id), labels_col: pad_to(labels_col, full, ignore),
        "attention_mask": F.concat(F.array_repeat(F.lit(1), F.col("_size")),
                                   F.array_repeat(F.lit(0), full - F.col("_size")))}).drop("_size")


def global_rank(df: DataFrame, order_cols, out: str = "rank", partitions: int | None = None,
                materialize: bool = True) -> DataFrame:
    """0-based position of every row in ``order_cols`` order, without a single-task window.

    Rows are range-partitioned on the order columns (balanced by sampling),
    each partition is numbered on its own, and per-partition row counts (one
    row per partition) give the offsets. Ties get distinct, adjacent ranks.
    The range-partitioned frame is written once to the shared folder together
    with its partition numbers, so the sizes and the numbering read the same
    copy (two evaluations of a range partitioning may sample other bounds).
    ``materialize`` is accepted for older callers and ignored.
    """
    from millrace.session import cut_lineage
    n = partitions or max(1, df.sparkSession.sparkContext.defaultParallelism)
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    parts = cut_lineage(df.repartitionByRange(n, *cols).withColumn("_p", F.spark_partition_id()), "rank-input")
    sizes = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_p").orderBy(*cols)
    return (parts.join(F.broadcast(offsets), "_p")  # one row per partition
            .withColumn(out, F.col("_off") + F.row_number().over(w) - 1)
            .drop("_p", "_off"))
