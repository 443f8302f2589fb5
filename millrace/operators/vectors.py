"""Vector-table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.vectors import with_unit_vector


def normalize(df: DataFrame, vector: str, out: str | None = None) -> DataFrame:
    """Add (or replace) the unit-length form of a vector column."""
    return with_unit_vector(df, vector, out or vector)


def group_centroids(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Mean vector per group: ``(key, vector)``.

    Elements are exploded with their position and averaged per
    ``(key, position)`` with map-side partial aggregation, so a group holding
    a third of the rows is combined before the shuffle; only
    ``groups x dim`` partial rows move.
    """
    el = df.select(key, F.posexplode(vector).alias("pos", "x"))
    means = el.groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    packed = means.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("_e"))
    return packed.select(key, F.transform("_e", lambda e: e["x"]).alias(vector))
