"""Shared pieces of the corpus operators: reading, words, hashes, written tables."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import cut_lineage

#: Word and white-space classes of the contracts (Java and RE2 read them alike).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Bytes of text handled at once inside one Arrow batch.
SLICE_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, split by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which its owner sizes to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, read back with its own schema."""
    return cut_lineage(df, name, options)


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


def crc_mod_py(value, n: int) -> int:
    """The same remainder for a Python value."""
    return zlib.crc32(str("" if value is None else value).encode()) % n


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``limit`` bytes of text (a row is never cut)."""
    size = np.nan_to_num(
        pc.binary_length(batch.column(batch.schema.get_field_index(text))).to_numpy(zero_copy_only=False)
        .astype(np.float64))
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0.0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def release_memory() -> None:
    """Hand what a finished task has freed back to the system: Spark keeps its Python workers for later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, one after the other, and each text's offset into them.

    Words are the runs of characters other than ASCII white space; a null text
    has none.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.flatten()
    offsets = offsets - offsets[0]
    keep = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not keep.all():
        before = np.concatenate(([0], np.cumsum(keep)))
        words, offsets = words.filter(pa.array(keep)), before[offsets]
    return words, offsets


def word_codes(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's number in the list of distinct words, and that list."""
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def hash_strings(values: pa.Array) -> np.ndarray:
    """64-bit hashes of strings, the same in every process."""
    if len(values) == 0:
        return np.zeros(0, dtype=np.uint64)
    return pd.util.hash_array(values.to_numpy(zero_copy_only=False), categorize=False)


def lower_ascii(texts: pa.Array) -> pa.Array:
    """A-Z to a-z and nothing else."""
    return pc.ascii_lower(texts)


_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (finaliser of the splitmix generator)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` neighbours in ``h`` (polynomial in an odd base, then mixed)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out = out * _MULT + h[i:i + n]
    return mix64(out)


def row_of(offsets: np.ndarray) -> np.ndarray:
    """For each word its text's row number."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def _bit_places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    a = mix64(keys)
    return (a & np.uint64(bits - 1)).astype(np.int64), ((a >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)


def recurring_bitmap(counts: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of ``bits`` bits (a power of two) of the keys whose summed counts exceed one.

    ``counts`` has ``key`` (long) and ``n`` (long). Whatever the input, at most
    ``bits / 64`` rows reach the driver. The map may let other keys through and
    never misses one.
    """
    return count_bitmaps(counts, bits, [1])[0]


def count_bitmaps(counts: DataFrame, bits: int, above: list[int]) -> list[np.ndarray]:
    """The same for several bounds at once: a bitmap of the keys whose summed counts exceed each one."""
    masks = [f"mask{k}" for k in range(len(above))]

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _bit_places(batch.column("key").to_numpy().view(np.uint64), bits)
            n = np.tile(batch.column("n").to_numpy(), 2)
            at = np.concatenate((a, b))
            mask = np.left_shift(np.int64(1), at & 63)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at >> 6), *(pa.array(np.where(n > bound, mask, 0)) for bound in above)], ["slot", *masks])

    slots = (counts.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") > min(above))
             .mapInArrow(places, ", ".join(["slot long", *(f"{m} long" for m in masks)]))
             .groupBy("slot").agg(*(F.bit_or(m).alias(m) for m in masks)).toArrow())
    bitmaps = []
    for mask in masks:
        bitmap = np.zeros(bits >> 6, np.uint64)
        bitmap[slots["slot"].to_numpy()] = slots[mask].to_numpy().view(np.uint64)
        bitmaps.append(bitmap)
    return bitmaps


def may_recur(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Which keys the bitmap lets through."""
    out = np.ones(len(keys), bool)
    for at in _bit_places(keys, len(bitmap) << 6):
        out &= (bitmap[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
    return out


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``id`` and ``component`` (smallest id reachable) of every vertex of ``edges`` (columns a, b; longs).

    Alternating large and small stars: each round joins neighbours to the smallest
    one. Rounds are written tables; only counts reach the driver.
    """
    def stars(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = (both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .filter("a <> b").distinct())
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        return large.join(down, "a").select(F.col("b").alias("u"), "low", "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("low").alias("b")),
                              F.struct(F.col("u").alias("a"), F.col("low").alias("b")))).alias("e")).select(
            "e.a", "e.b").filter("a <> b").distinct()

    cur = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), f"{name}-edges")
    state = None
    while True:
        # done when a round changed nothing: every vertex hangs on the smallest one it reaches
        seen = cur.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if (seen["n"], seen["h"]) == state or seen["n"] == 0:
            break
        state = (seen["n"], seen["h"])
        cur = written(stars(cur), f"{name}-stars")
    roots = cur.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return cur.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
