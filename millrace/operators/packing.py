"""Sequence packing: samples into fixed-length packs with segment metadata.

Packing is sequential by nature. It runs independently inside hash buckets of
sample ids (1 / 16**digits of them each, a job parameter), over ``(id, length, order
key)`` only; token arrays are joined back by id afterwards.

Two ways: next-fit in hash order, which streams over sorted partitions and keeps one
open pack, and best-fit by falling length with a list of the packs' free space, one
group a bucket. Best-fit leaves at most one pack of a bucket half empty
or more; those are opened again and packed with the ones of the 15 buckets next to
them, digit by digit, so that no round's group holds more than 16 packs.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import constants as C
from millrace.functions.arrays import cumulative_ends, pad_to, position_ids, segment_ids
from millrace.session import cut_lineage

#: Hex digits of the bucket key. The layout depends on it, so it is a recorded
#: parameter of the job and never follows the size of the corpus.
BUCKET_DIGITS = 3


def _plan_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("id", id_type),
        T.StructField("bucket", T.StringType()),
        T.StructField("pack_no", T.LongType()),
        T.StructField("seg", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("len", T.LongType()),
    ])


def order_key(id_col: str) -> F.Column:
    """Stable hash order of a sample id (same in any engine with SHA-256)."""
    return F.sha2(F.col(id_col).cast("string"), 256)


def next_fit(batches: Iterator[pa.RecordBatch], seq_length: int, max_segments: int) -> Iterator[pa.RecordBatch]:
    """Next-fit over rows (id, len, bucket) sorted by bucket and order key; samples that are too long are set aside.

    Only the open pack is kept between rows and batches, so memory does not follow a bucket's size.
    """
    now, p, fill, count = None, 0, 0, 0
    for batch in batches:
        lens, buckets = batch.column("len").to_pylist(), batch.column("bucket").to_pylist()
        pack_no, seg, offset = [], [], []
        for n, bucket in zip(lens, buckets):
            if bucket != now:
                now, p, fill, count = bucket, 0, 0, 0
            if n is None or n > seq_length:
                pack_no.append(-1), seg.append(0), offset.append(0)
                continue
            if count > 0 and (fill + n > seq_length or count >= max_segments):
                p, fill, count = p + 1, 0, 0
            pack_no.append(p), seg.append(count), offset.append(fill)
            fill += n
            count += 1
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("bucket"), pa.array(pack_no, pa.int64()), pa.array(seg, pa.int32()),
             pa.array(offset, pa.int64()), batch.column("len")], ["id", "bucket", "pack_no", "seg", "offset", "len"])


def best_fit(pdf: pd.DataFrame, seq_length: int, max_segments: int) -> pd.DataFrame:
    """Best-fit over one bucket by falling length (ties by order key): the fullest pack with room takes a sample.

    The free space of the open packs is kept sorted, so the pack is found by
    bisection. Samples that are too long get pack -1.
    """
    pdf = pdf.sort_values(["len", "h"], ascending=[False, True], kind="stable")
    lens = pdf["len"].to_numpy(np.int64)
    pack_no = np.full(len(lens), -1, np.int64)
    seg, offset = np.zeros(len(lens), np.int32), np.zeros(len(lens), np.int64)
    free: list[tuple[int, int]] = []  # (room, pack) of packs that may take another segment
    fill: list[int] = []
    count: list[int] = []
    for i, n in enumerate(lens.tolist()):
        if n > seq_length:
            continue
        at = bisect.bisect_left(free, (n, -1))
        if at < len(free):
            p = free.pop(at)[1]
        else:
            p = len(fill)
            fill.append(0)
            count.append(0)
        pack_no[i], seg[i], offset[i] = p, count[p], fill[p]
        fill[p] += n
        count[p] += 1
        if count[p] < max_segments:
            bisect.insort(free, (seq_length - fill[p], p))
    return pd.DataFrame({"id": pdf["id"].to_numpy(), "bucket": pdf["bucket"].to_numpy(),
                         "pack_no": pack_no, "seg": seg, "offset": offset, "len": lens})


def best_fit_plan(samples: DataFrame, id_col: str, len_col: str, seq_length: int = C.SEQ_LENGTH,
                  max_segments: int = C.MAX_SEGMENTS, digits: int = BUCKET_DIGITS):
    """Best-fit packs: ``(plan, rejected)`` as :func:`pack_plan` gives them with ``oversize='reject'``.

    ``bucket`` is a prefix of the order key: all ``digits`` for packs of the first
    round, fewer for those that were filled up in later ones.
    """
    id_type = samples.schema[id_col].dataType
    schema = _plan_schema(id_type)

    def packed(rows: DataFrame, width: int) -> DataFrame:
        keyed = rows.select("id", "len", "h", F.substring("h", 1, width).alias("bucket"))
        return cut_lineage(keyed.groupBy("bucket").applyInPandas(
            lambda pdf: best_fit(pdf, seq_length, max_segments), schema), f"best-fit-{width}")

    rows = samples.select(F.col(id_col).alias("id"), F.col(len_col).cast("long").alias("len"), order_key(id_col).alias("h"))
    done, plan = [], packed(rows, digits)
    rejected = plan.filter("pack_no < 0").select("id", "len", F.col("len").alias("n_cut"))
    plan = plan.filter("pack_no >= 0")
    for width in range(digits - 1, -1, -1):
        half = (plan.groupBy("bucket", "pack_no").agg(F.sum("len").alias("_fill"), F.count(F.lit(1)).alias("_n"))
                .filter((F.col("_fill") * 2 <= seq_length) & (F.col("_n") < max_segments)).select("bucket", "pack_no"))
        done.append(plan.join(half, ["bucket", "pack_no"], "left_anti"))
        again = plan.join(half, ["bucket", "pack_no"], "left_semi")
        plan = packed(again.select("id", "len", order_key("id").alias("h")), width)
    for part in done:
        plan = plan.unionByName(part)
    return plan.select(*schema.names).withColumnRenamed("id", id_col), rejected


def pack_plan(samples: DataFrame, id_col: str, len_col: str, seq_length: int = C.SEQ_LENGTH,
              max_segments: int = C.MAX_SEGMENTS, digits: int = BUCKET_DIGITS,
              oversize: str = "reject"):
    """Assign every sample to ``(bucket, pack_no)`` with its segment index and offset.

    Ids may be of any type. Returns ``(plan, rejected)``; ``rejected`` has
    ``id, len, n_cut`` for every sample longer than ``seq_length``.
    ``oversize``: ``'reject'`` keeps such samples out of the plan (``n_cut``
    is all of their tokens); ``'own_pack'`` gives each its own pack, cut to
    ``seq_length`` (``n_cut`` tokens are lost), so that tokens in = tokens
    packed + ``sum(n_cut)`` either way. ``digits`` is the bucket width: more
    digits, more and smaller groups, and another layout.
    """
    s = samples.select(F.col(id_col).alias("id"), F.col(len_col).cast("long").alias("len"))
    too_long = F.col("len") > seq_length
    if oversize == "reject":
        # next_fit sets them aside: a filter here would be pushed below the exchange of a small table,
        # and the lengths counted twice, once by the tasks of the scan's own splits
        rejected = s.filter(too_long).withColumn("n_cut", F.col("len"))
    elif oversize == "own_pack":
        rejected = s.filter(too_long).withColumn("n_cut", F.col("len") - seq_length)
        s = s.withColumn("len", F.least(F.col("len"), F.lit(seq_length)))
    else:
        raise ValueError(f"unknown oversize policy {oversize!r}")
    h = order_key("id")
    keyed = s.select("id", "len", h.alias("h"), F.substring(h, 1, digits).alias("bucket"))
    # the order key begins with the bucket, so its order is the order of the buckets too
    plan = keyed.repartition("bucket").sortWithinPartitions("h").select("id", "len", "bucket").mapInArrow(
        lambda batches: next_fit(batches, seq_length, max_segments), _plan_schema(s.schema["id"].dataType))
    return plan.filter("pack_no >= 0").withColumnRenamed("id", id_col), rejected


def pack_summary(plan: DataFrame, id_col: str, seq_length: int = C.SEQ_LENGTH) -> DataFrame:
    """One row per pack: members in order, segment lengths, cumulative ends, fill, padding.

    A pack has at most ``max_segments`` members, so each group is bounded.
    """
    g = plan.groupBy("bucket", "pack_no").agg(
        F.array_sort(F.collect_list(F.struct("seg", F.col(id_col).alias("id"), "len"))).alias("_m"))
    g = g.select("bucket", "pack_no", F.transform("_m", lambda m: m["id"]).alias("ids"),
                 F.transform("_m", lambda m: m["len"]).alias("seg_lens"))
    g = g.select("bucket", "pack_no", "ids", "seg_lens",
                 F.aggregate("seg_lens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"))
    return g.select("bucket", "pack_no", "ids", "seg_lens", cumulative_ends("seg_lens").alias("actual_seq_len"),
                    F.size("seg_lens").alias("n_segments"), "n_tokens",
                    (F.lit(seq_length) - F.col("n_tokens")).alias("n_pad"))


def materialize_packs(plan: DataFrame, samples: DataFrame, id_col: str, seq_length: int = C.SEQ_LENGTH,
                      pad_id: int = C.PAD_ID, ignore: int = C.IGNORE_ID) -> DataFrame:
    """Packed training rows: ``input_ids, labels, actual_seq_len, position_ids, segment_ids, loss_mask``.

    Token arrays join the plan by id (one shuffle on the id) and are
    concatenated per pack (a bounded group), then padded to ``seq_length``.
    ``segment_ids`` number the segments of a pack from 0 (padding -1): two
    positions see each other where their numbers are equal, which is the
    block-diagonal mask without its square matrix.
    """
    j = plan.join(samples.select(F.col(id_col), "input_ids", "labels"), id_col)
    g = j.groupBy("bucket", "pack_no").agg(
        F.array_sort(F.collect_list(F.struct("seg", F.slice("input_ids", 1, seq_length).alias("ids"),
                                             F.slice("labels", 1, seq_length).alias("lab"),
                                             F.least(F.col("len"), F.lit(seq_length)).alias("len")))).alias("_m"))
    g = g.select("bucket", "pack_no",
                 F.flatten(F.transform("_m", lambda m: m["ids"])).alias("_ids"),
                 F.flatten(F.transform("_m", lambda m: m["lab"])).alias("_lab"),
                 F.transform("_m", lambda m: m["len"]).alias("seg_lens"))
    g = g.select("bucket", "pack_no", "seg_lens",
                 pad_to("_ids", seq_length, pad_id).alias("input_ids"),
                 pad_to("_lab", seq_length, ignore).alias("labels"),
                 cumulative_ends("seg_lens").alias("actual_seq_len"),
                 position_ids("seg_lens").alias("_pos"), segment_ids("seg_lens").alias("_seg"))
    return g.select("bucket", "pack_no", "input_ids", "labels", "actual_seq_len",
                    pad_to("_pos", seq_length, 0).alias("position_ids"),
                    pad_to("_seg", seq_length, -1).alias("segment_ids"),
                    F.transform("labels", lambda x: F.when(x == ignore, 0).otherwise(1)).alias("loss_mask"))


def packing_report(summary: DataFrame, seq_length: int = C.SEQ_LENGTH) -> DataFrame:
    """Packs, samples, tokens, fill efficiency and mean segments per pack (one row)."""
    r = summary.agg(F.count(F.lit(1)).alias("n_packs"), F.sum("n_segments").alias("n_samples"),
                    F.sum("n_tokens").alias("n_tokens"))
    return r.select("n_packs", "n_samples", "n_tokens",
                    F.round(F.col("n_tokens") / (F.col("n_packs") * F.lit(seq_length)), 6).alias("efficiency"),
                    F.round(F.col("n_samples") / F.col("n_packs"), 6).alias("mean_segments"))
