"""Training-sample construction: answer start, truncation, prompt-masked labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import constants as C
from millrace.functions.arrays import answer_start, mask_labels, mask_overflow, truncate_keep_tail


def build_labels(df: DataFrame, ids_col: str = "input_ids", limit: int = C.SEQ_LENGTH,
                 ignore: int = C.IGNORE_ID, marker: int = C.IM_START_ID, role_id: int = C.ASSISTANT_ID,
                 skip: int = 3) -> DataFrame:
    """Add ``answer_start``, truncated ``input_ids``, ``labels``, ``clipped`` and ``mask_overflow``.

    The answer start is found on the untruncated ids; labels are taken from
    the truncated ids, so the two kept tail ids are labelled too. Rows whose
    start lies beyond the truncated length get ``mask_overflow = true``
    (their labels would be longer than the ids); route them with
    :func:`split_valid`. Each step is its own projection so the arrays that
    lambdas read are column references.
    """
    cols = [c for c in df.columns if c != ids_col]
    d = df.select(*cols, F.col(ids_col).alias("_ids"))
    d = d.select(*cols, "_ids", answer_start("_ids", marker, role_id, skip).alias("answer_start"),
                 (F.size("_ids") > limit).alias("clipped"))
    d = d.select(*cols, "answer_start", "clipped", truncate_keep_tail("_ids", limit).alias(ids_col))
    return d.select(*cols, ids_col, "answer_start", "clipped",
                    mask_labels(ids_col, "answer_start", ignore).alias("labels"),
                    mask_overflow(ids_col, "answer_start").alias("mask_overflow"))


def split_valid(df: DataFrame):
    """(valid, rejected): the length invariant ``size(labels) == size(input_ids)``."""
    ok = F.size("labels") == F.size("input_ids")
    return df.filter(ok), df.filter(~ok)


def training_columns(df: DataFrame) -> DataFrame:
    return df.select("input_ids", "labels")
