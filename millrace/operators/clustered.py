"""Clustered nearest-neighbour search calibrated to a stated recall.

The list count grows with the square root of the index. Centres come in two
levels from a bounded hash sample: a coarse KMeans, then each coarse cell's own
centres, fitted cell by cell in tasks. Every index row is put into the list of its
nearest centre. How many lists a query probes is measured, not guessed: for a hash
sample of the queries the exact neighbours are found, and the probe count is the
smallest that reaches the wanted share of them, plus a margin for the sample.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.vectors import with_unit_vector
from millrace.operators.similarity import BLOCK_ROWS, grid_topk, knn
from millrace.session import cut_lineage

#: Rows the centres are fitted on: this many for each list, and at most so many in all.
SAMPLE_PER_LIST = 64
SAMPLE_ROWS = 1_000_000
#: The centres are broadcast: lists x dimensions x 8 bytes stay below this.
CENTRE_BYTES = 64 << 20
#: Queries whose exact neighbours calibrate the probe count.
CALIBRATION_QUERIES = 256
_LLOYD_ROUNDS = 12


def list_count(rows: int, dims: int) -> int:
    """Lists of an index: the square root of its rows, within the bound on the centres' bytes."""
    return max(1, min(round(math.sqrt(rows)), CENTRE_BYTES // (8 * max(1, dims))))


def _sampled(df: DataFrame, rows: int, total: int, salt: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, chosen by a hash of the id (the same ones in every run)."""
    if rows >= total:
        return df
    return df.filter(F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(1_000_000)) < math.ceil(1_000_000 * rows / total))


def _lloyd(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres of the points of one coarse cell."""
    points = np.unique(points, axis=0)
    if len(points) <= k:
        return points
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(_LLOYD_ROUNDS):
        own = np.argmin((centres * centres).sum(1)[None, :] - 2.0 * points @ centres.T, axis=1)
        size = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


def two_level_centres(u: DataFrame, lists: int, rows: int, seed: int = 42) -> np.ndarray:
    """About ``lists`` centres of the vectors ``u`` (id, v), from a sample of bounded size."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    sample = cut_lineage(_sampled(u, min(SAMPLE_ROWS, SAMPLE_PER_LIST * lists), rows, seed).select(
        F.xxhash64("id").alias("h"), "v"), "centre-sample")
    n = sample.count()
    if not n:
        return np.zeros((0, 0))
    coarse = max(1, min(n, round(math.sqrt(lists))))
    features = sample.select(array_to_vector("v").alias("f")).cache()
    model = KMeans(k=coarse, seed=seed, featuresCol="f", maxIter=10).fit(features)
    features.unpersist()
    top = np.stack([np.asarray(c, dtype=np.float64) for c in model.clusterCenters()])
    shared = u.sparkSession.sparkContext.broadcast(top)

    @F.pandas_udf(T.IntegerType())
    def cell_of(vs: pd.Series) -> pd.Series:
        return pd.Series(_order(vs, shared.value, 1)[:, 0].astype(np.int32) if len(vs) else np.zeros(0, np.int32))

    def split(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        points = np.stack(pdf.sort_values("h")["v"].tolist()).astype(np.float64)  # order of the rows must not matter
        k = max(1, round(lists * len(points) / n))
        return pd.DataFrame({"centre": [c.tolist() for c in _lloyd(points, k, seed + int(key[0]))]})

    found = (sample.withColumn("cell", cell_of("v")).groupBy("cell").applyInPandas(split, "centre array<double>")
             .select("centre").collect())  # lists + coarse rows at most: CENTRE_BYTES bounds them
    return np.array(sorted(r["centre"] for r in found))


def _order(vs: pd.Series, centres: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest centres of each vector, nearest first."""
    q = np.stack([np.asarray(v, dtype=np.float64) for v in vs])
    distance = (centres * centres).sum(1)[None, :] - 2.0 * q @ centres.T
    if k == 1:
        return np.argmin(distance, axis=1)[:, None]
    return np.argsort(distance, axis=1, kind="stable")[:, :k]


@dataclass
class ClusteredIndex:
    """Index rows by list: ``rows`` (id, v, list), the centres, and the probe count of the last calibration."""

    rows: DataFrame
    centres: np.ndarray
    probes: int = 1

    @property
    def lists(self) -> int:
        return len(self.centres)


def build_clustered_index(index: DataFrame, id_col: str = "id", vector: str = "embedding", lists: int | None = None,
                          seed: int = 42) -> ClusteredIndex:
    """Put every row with a vector into the list of its nearest centre (null ids and vectors take no part)."""
    u = _units(index, id_col, vector)
    stats = u.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    n, dims = stats["n"], stats["d"] or 0
    centres = two_level_centres(u, lists or list_count(n, dims), n, seed)
    if not len(centres):
        return ClusteredIndex(u.withColumn("list", F.lit(0)), centres)
    shared = index.sparkSession.sparkContext.broadcast(centres)

    @F.pandas_udf(T.IntegerType())
    def nearest(vs: pd.Series) -> pd.Series:
        return pd.Series(_order(vs, shared.value, 1)[:, 0].astype(np.int32) if len(vs) else np.zeros(0, np.int32))

    return ClusteredIndex(cut_lineage(u.withColumn("list", nearest("v")), "clustered-index"), centres)


def _units(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).alias("_raw")).filter(
        F.col("id").isNotNull() & F.col("_raw").isNotNull())
    return with_unit_vector(rows, "_raw", "v").select("id", "v")


def calibrate(index: ClusteredIndex, queries: DataFrame, k: int, recall: float, exclude_self: bool,
              calibration_queries: int = CALIBRATION_QUERIES, seed: int = 7) -> int:
    """Fewest lists to probe so that a hash sample of ``queries`` (id, v) finds ``recall`` of its exact neighbours.

    The wanted share is raised by two standard errors of the sample, so that the
    other queries reach it too.
    """
    total = queries.count()
    sample = cut_lineage(_sampled(queries, calibration_queries, total, seed), "calibration")
    # the sample is the small side: it is what each block of the index is scored against
    truth = knn(sample.withColumnRenamed("v", "embedding"), index.rows.select("id", F.col("v").alias("embedding")), k,
                exclude_self=exclude_self)
    lists = index.rows.select(F.col("id").alias("iid"), "list")
    wanted = truth.join(lists, "iid").join(sample.select(F.col("id").alias("tid"), "v"), "tid")
    shared = queries.sparkSession.sparkContext.broadcast(index.centres)

    @F.pandas_udf(T.IntegerType())
    def rank(vs: pd.Series, own: pd.Series) -> pd.Series:
        if not len(vs):
            return pd.Series(np.zeros(0, np.int32))
        order = _order(vs, shared.value, len(shared.value))
        return pd.Series((np.argmax(order == own.to_numpy()[:, None], axis=1) + 1).astype(np.int32))

    found = wanted.select(rank("v", "list").alias("r")).groupBy("r").agg(F.count(F.lit(1)).alias("n")).collect()
    if not found:  # one row per rank, at most the list count
        return 1
    at_rank = np.zeros(index.lists + 1)
    for r in found:
        at_rank[r["r"]] = r["n"]
    n = at_rank.sum()
    goal = min(1.0, recall + 2.0 * math.sqrt(recall * (1.0 - recall) / n))
    return max(1, int(np.searchsorted(np.cumsum(at_rank) / n, goal - 1e-12)))


def clustered_search(queries: DataFrame, index: ClusteredIndex, k: int = 1, query_id: str = "id", vector: str = "embedding",
                     recall: float = 0.9, probes: int | None = None, exclude_self: bool = False,
                     block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(tid, iid, score)``: the best ``k`` rows of each query among its probed lists, scored exactly.

    Without ``probes`` the count is calibrated to ``recall`` (and kept in
    ``index.probes``). Queries and list members meet in bounded blocks, so a list
    that holds a third of the rows is split. Null ids and vectors have no result.
    """
    q = _units(queries, query_id, vector)
    if not index.lists:
        return grid_topk(q, index.rows.select("id", "v"), k, exclude_self, block_rows)
    index.probes = probes or calibrate(index, q, k, recall, exclude_self)
    shared = queries.sparkSession.sparkContext.broadcast(index.centres)
    count = index.probes

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def near(vs: pd.Series) -> pd.Series:
        if not len(vs):
            return pd.Series([], dtype=object)
        return pd.Series(list(_order(vs, shared.value, count).astype(np.int32)))

    probed = q.select("id", "v", F.explode(near("v")).alias("list"))
    return grid_topk(probed, index.rows, k, exclude_self, block_rows=block_rows, key="list", kind="dense")
