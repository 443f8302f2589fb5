"""Exact top-k inner products from an impact-ordered index, score at a time.

Integer vectors are indexed by (dimension, sign): a posting is a row whose
component there has that sign, its impact the component's size in steps. Rows are
dealt into shards of bounded size; a shard holds its postings by falling impact,
in segments of equal quantised impact, and its vectors.

A query takes the segments of its own signs by falling contribution (its weight
times the impact) and adds them up by row. What a row has so far, plus the most
that the segments still to come could add, is never below its score: components
of the other sign only take away. A shard is done with a query when every row that
could still reach the k-th best known score is cheaper to score exactly than the
segments left are to read; those rows, and no others, are then scored on their
vectors. Nothing is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import read, written

SCALE = 1024
TOP_K = 10
QUERY_EVERY = 100
#: Components of a shard of the index, and bytes of the queries that are broadcast at once.
SHARD_CELLS = 1 << 19
QUERY_BYTES = 16 << 20
#: Quantised impacts of a shard.
LEVELS = 64
#: A scaled component beyond this counts as this, so that every score fits 64 bits.
LARGEST = 1 << 24
_SHRINK = 0.6  # each round's least contribution, against the one before


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``row`` (a number of its own), ``id`` and ``v`` = floor(scale * component), rows that take no part left out."""
    x = F.col(vector_col)
    valid = x.isNotNull() & F.coalesce(F.forall(x, lambda c: F.abs(c.cast("double")) < F.lit(float("inf"))), F.lit(False))
    v = F.transform(x, lambda c: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(c.cast("double") * scale)))
                    .cast("int"))
    return df.filter(valid).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                                   v.alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as a matrix; what is missing is zero."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy()
    length = np.diff(offsets)
    flat = flat[offsets[0]:offsets[-1]]
    if len(length) and (length == dims).all():
        return flat.reshape(len(length), dims).astype(np.int64)
    out = np.zeros((len(length), dims), np.int64)
    row = np.repeat(np.arange(len(length)), length)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], length)] = flat
    return out


class Shard:
    """Rows of one shard with their impact-ordered postings."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, step: int, places: np.ndarray,
                 levels: np.ndarray, upto: np.ndarray) -> None:
        self.rows, self.ids, self.vectors, self.step = rows, ids, vectors, step
        self.places, self.levels, self.upto = places, levels, upto  # upto[term, l]: end of the postings of impact l or more

    @classmethod
    def build(cls, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> Shard:
        n, dims = vectors.shape
        size = np.abs(vectors)
        step = max(1, -(-int(size.max(initial=0)) // LEVELS))
        level = -(-size // step)
        place, dim = np.nonzero(level)
        term = np.where(vectors[place, dim] > 0, dim, dims + dim)
        level = level[place, dim]
        order = np.lexsort((place, -level, term))
        term, level, place = term[order], level[order], place[order]
        # postings of (term, impact >= l) end where the key (term, -l) ends
        keys = term * (LEVELS + 1) + (LEVELS - level)
        asked = (np.arange(2 * dims)[:, None] * (LEVELS + 1) + (LEVELS - np.arange(LEVELS + 2)[None, :]))
        upto = np.searchsorted(keys, asked.ravel(), side="right").reshape(asked.shape)
        upto[:, LEVELS + 1] = np.searchsorted(keys, np.arange(2 * dims) * (LEVELS + 1), side="left")
        return cls(rows, ids, vectors, step, place.astype(np.int32), level.astype(np.int16), upto)

    def exact(self, query: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self.vectors[places] @ query

    def search(self, row: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the best ``k`` rows (and of ties with the last), the query's own row apart."""
        dims = np.flatnonzero(query)
        n = len(self.rows)
        weight = np.abs(query[dims])
        term = np.where(query[dims] > 0, dims, len(query) + dims)
        upto = self.upto[term]
        cost = weight * self.step  # of one level of impact
        own = np.flatnonzero(self.rows == row)
        bound = np.zeros(n)
        known = -np.inf  # the k-th best score that some rows certainly have
        done = upto[:, LEVELS + 1].copy()
        end = upto[:, 1]
        top = (LEVELS * cost).max(initial=0)
        while True:
            top *= _SHRINK
            # segments with a contribution above ``top`` are read now
            least = np.minimum(LEVELS, (top / cost).astype(np.int64)) + 1 if len(cost) else np.zeros(0, np.int64)
            if top < 1:
                least = np.ones(len(cost), np.int64)
            to = np.maximum(done, upto[np.arange(len(term)), least])
            fresh = [(slice(a, b), c) for a, b, c in zip(done.tolist(), to.tolist(), cost.tolist()) if b > a]
            done = to
            if fresh:
                places = np.concatenate([self.places[s] for s, _ in fresh])
                gain = np.concatenate([self.levels[s] * float(c) for s, c in fresh])
                bound += np.bincount(places, gain, n)
            left = int((end - done).sum())
            ahead = float(((least - 1) * cost)[done < end].sum())
            bound[own] = -np.inf
            if left and not fresh:
                continue
            # rows that lead so far are scored: the k-th best of them is a score that the answer reaches
            if n - len(own) > 2 * k:
                lead = np.argpartition(-bound, 2 * k)[:2 * k]
                lead = lead[np.isfinite(bound[lead])]
                if len(lead) >= k:
                    known = max(known, float(np.partition(self.exact(query, lead), len(lead) - k)[len(lead) - k]))
            # sums of steps are whole numbers below 2**53 or, beyond, rounded by less than this
            slack = 1e-12 * (float(bound.max(initial=0.0)) + ahead + (abs(known) if np.isfinite(known) else 0.0))
            maybe = np.flatnonzero(bound + ahead >= known - slack) if np.isfinite(known) else np.flatnonzero(np.isfinite(bound))
            if not left or len(maybe) * len(query) <= left:
                break
        scores = self.exact(query, maybe)
        if len(scores) > k:
            keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            maybe, scores = maybe[keep], scores[keep]
        return maybe, scores


def build_index(vectors: DataFrame, shard_cells: int = SHARD_CELLS) -> tuple[DataFrame, int]:
    """The index of a written table (row, id, v), one row per shard, and the number of dimensions."""
    stats = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).first()
    dims = stats["dims"] or 0
    shards = max(1, -(-stats["n"] * max(1, dims) // shard_cells))

    def build(table: pa.Table) -> pa.Table:
        found = Shard.build(table["row"].to_numpy(), np.zeros(0), _matrix(table["v"], dims))
        ids = table["id"].combine_chunks()
        binary = [np.ascontiguousarray(a).tobytes() for a in (
            found.rows, found.vectors.astype(np.int32), found.places, found.levels, found.upto.astype(np.int32))]
        return pa.table({"ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                         **{c: pa.array([b], pa.binary()) for c, b in zip(("rows", "vectors", "places", "levels", "upto"), binary)},
                         "step": pa.array([found.step], pa.int64())})

    index = (vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).groupBy("shard").applyInArrow(
        build, "ids array<long>, rows binary, vectors binary, places binary, levels binary, upto binary, step long"))
    return written(index, "impact-index"), dims


def search_index(index: DataFrame, dims: int, queries: DataFrame, k: int, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``query_row``, ``query_id``, ``rank``, ``row``, ``id``, ``score``: the best ``k`` rows of each query.

    ``queries`` is a table (row, id, v). Queries are broadcast in blocks of at most
    about ``query_bytes``; each block meets every shard once.
    """
    spark = index.sparkSession
    blocks = max(1, -(-queries.count() * max(1, dims) * 8 // query_bytes))
    schema = "query_row long, query_id long, row long, id long, score long"

    def one(number: int) -> DataFrame:
        # a block of the queries, bounded by query_bytes
        mine = queries.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == number).toArrow()
        shared = spark.sparkContext.broadcast(
            (mine["row"].to_numpy(), mine["id"].to_numpy(), _matrix(mine["v"], dims)) if mine.num_rows else None)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if shared.value is None:
                return
            rows, ids, wanted = shared.value
            for batch in batches:
                for at in range(batch.num_rows):
                    raw = {c: np.frombuffer(batch.column(c)[at].as_buffer(), t) for c, t in (
                        ("rows", np.int64), ("vectors", np.int32), ("places", np.int32), ("levels", np.int16), ("upto", np.int32))}
                    own = batch.column("ids")[at].values
                    shard = Shard(raw["rows"], np.zeros(0), raw["vectors"].reshape(len(raw["rows"]), dims).astype(np.int64),
                                  batch.column("step")[at].as_py(), raw["places"], raw["levels"],
                                  raw["upto"].reshape(2 * dims, LEVELS + 2))
                    for row, key, query in zip(rows, ids, wanted):
                        place, score = shard.search(row, query, k)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(place), row)), pa.array(np.full(len(place), key)),
                             pa.array(shard.rows[place]), own.take(pa.array(place)), pa.array(score)],
                            ["query_row", "query_id", "row", "id", "score"])

        return index.mapInArrow(run, schema)

    found = one(0)
    if blocks > 1:
        found = written(found, "found")
        for number in range(1, blocks):
            found = found.unionByName(written(one(number), "found"))
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def impact_topk(df: DataFrame, queries: str, id_col: str = "vec_id", vector_col: str = "embedding", k: int = TOP_K,
                scale: int = SCALE, shard_cells: int = SHARD_CELLS, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best rows for each row that ``queries`` selects.

    ``queries`` is a condition on ``id`` (the row's id as long). Components become
    floor(scale * x); the score is the integer inner product; ties go to the smaller
    id, null last. A row is no candidate of its own; rows that repeat its id are.
    Each selected row is a query, also where ids repeat. Vectors that are null or
    hold a null or non-finite component take no part; components that a shorter
    vector lacks are zero (an empty one scores 0 with all); a scaled component beyond
    2**24 counts as that. Other columns are not read; an empty table gives no rows.
    """
    vectors = written(integer_vectors(df, id_col, vector_col, scale), "integer-vectors")
    index, dims = build_index(vectors, shard_cells)
    best = search_index(index, dims, vectors.filter(queries), k, query_bytes)
    return best.select("query_id", "rank", F.col("id").alias(id_col), "score")


def op12_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best rows of every hundredth embedding, among all."""
    return impact_topk(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), f"id % {QUERY_EVERY} = 0")


OP12_SQL = f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS rn, vec_id,
         list_transform(embedding, lambda c: floor({SCALE} * CAST(c AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT q.rn, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY q.rn ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS rank
  FROM e q JOIN e c ON q.rn <> c.rn WHERE q.vec_id % {QUERY_EVERY} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM s WHERE rank <= {TOP_K}
"""
