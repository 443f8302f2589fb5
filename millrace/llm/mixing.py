"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Within a source the documents stand in one fixed order; each expects
``target / source_size`` copies. The running sum of the expected copies, plus
one random offset of the source, crosses an integer once per copy taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, read

WEIGHTS = (5, 2, 1)
CAP = 3
#: Hash groups a (source, size class) is cut into, so that no window group is long.
SALTS = 4096
SEED = 20


def _size_class(size: Column) -> Column:
    """Quarter octaves of the size: documents of like size stand together in the order."""
    bits = F.length(F.bin(size))
    low = F.expr("shiftleft(1L, CAST(length(bin(`__mx_size`)) AS INT) - 1)")
    return F.when(size == 0, F.lit(0).cast("long")).otherwise(
        (bits * 4).cast("long") + F.floor(size * 4 / low).cast("long"))


def _targets(cells: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """One row per source: its size and target (one row per source name, metadata-sized)."""
    s = cells.groupBy("__mx_src").agg(F.sum("__mx_words").alias("__mx_total"))
    by_name = Window.orderBy("__mx_src")
    s = s.withColumn("__mx_w", F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long"))
    s = s.withColumn("__mx_cap", F.col("__mx_total") * cap)
    tight = Window.orderBy(F.col("__mx_cap") / F.col("__mx_w"), "__mx_src")
    s = (s.withColumn("__mx_i", F.row_number().over(tight))
         .withColumn("__mx_before", F.coalesce(F.sum("__mx_cap").over(
             tight.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
         .withColumn("__mx_rest", F.sum("__mx_w").over(tight.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("__mx_all", F.sum("__mx_total").over(Window.partitionBy())))
    level = (F.col("__mx_all") - F.col("__mx_before")) / F.col("__mx_rest")
    s = s.withColumn("__mx_free", F.min(F.when(
        level * F.col("__mx_w") <= F.col("__mx_cap"),
        F.struct(F.col("__mx_i").alias("i"), level.alias("level")))).over(Window.partitionBy()))
    return s.select("__mx_src", "__mx_total", F.when(
        F.col("__mx_free").isNull() | (F.col("__mx_i") < F.col("__mx_free.i")), F.col("__mx_cap").cast("double"))
        .otherwise(F.col("__mx_free.level") * F.col("__mx_w")).alias("__mx_target"))


def systematic_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                   text_col: str = "text", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP,
                   seed: int = SEED, salts: int = SALTS, out: str = "mix") -> DataFrame:
    """Add to every row of ``docs`` what the mix takes of it, as the struct column ``out``.

    ``out`` has ``size`` (words of the text), ``source_size``, ``target`` (both of
    the row's source, in words), ``copies`` (how often the row is taken) and
    ``taken`` (copies times size). Sources in code-point order, the null source
    last, carry the repeating ``weights``; a target stops at ``cap`` times its
    source's size and the excess is shared out again by weight. Copies lie within
    one of target / source_size, so never above ``cap``.

    The order inside a source is size class, hash group, size, id. It depends on
    the rows alone, so reruns agree. Ranks come from the counts of the (class,
    hash group) cells plus a rank inside the cell: a source with a third of all
    rows is spread over its cells. Every row is used; nothing is collected.

    Null texts and texts without words have size 0 and take 0 words; a source of
    size 0 has target 0 and 0 copies. Rows that repeat an id are rows like any
    other (equal rows are interchangeable). Empty tables give no rows. Other
    columns pass through; one already called ``out`` is replaced.
    """
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    src = F.when(F.col(source_col).isNull(), F.lit("z")).otherwise(
        F.concat(F.lit("a"), F.col(source_col).cast("string")))
    sized = (docs.drop(out).withColumn("__mx_size", F.coalesce(
                F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long"))
             .withColumn("__mx_src", src)
             .withColumn("__mx_cls", _size_class(F.col("__mx_size")))
             .withColumn("__mx_salt", (F.conv(F.substring(F.md5(ident.cast("binary")), 1, 8), 16, 10)
                                       .cast("long") % salts)))
    cell = ["__mx_src", "__mx_cls", "__mx_salt"]
    cells = sized.groupBy(*cell).agg(F.count(F.lit(1)).alias("__mx_n"), F.sum("__mx_size").alias("__mx_words"))
    along = Window.partitionBy("__mx_src").orderBy("__mx_cls", "__mx_salt")
    starts = cells.withColumn("__mx_start", F.sum("__mx_n").over(along) - F.col("__mx_n")).drop("__mx_words")
    placed = starts.join(_targets(cells, weights, cap), "__mx_src").drop("__mx_n")
    inside = Window.partitionBy(*cell).orderBy("__mx_size", F.col(id_col).asc_nulls_last())
    ranked = sized.withColumn("__mx_rank", F.row_number().over(inside)).join(placed, cell)
    rate = F.when(F.col("__mx_total") == 0, F.lit(0.0)).otherwise(
        F.least(F.col("__mx_target") / F.col("__mx_total"), F.lit(float(cap))))
    # sixteen bits: adding the offset to a long running sum stays exact
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("__mx_src")).cast("binary")), 1, 4),
                    16, 10).cast("double") / 65536
    rank = F.col("__mx_start") + F.col("__mx_rank")
    copies = (F.floor(offset + rate * rank) - F.floor(offset + rate * (rank - 1))).cast("long")
    result = F.struct(F.col("__mx_size").alias("size"), F.col("__mx_total").alias("source_size"),
                      F.col("__mx_target").alias("target"), copies.alias("copies"),
                      (copies * F.col("__mx_size")).alias("taken"))
    return ranked.withColumn(out, result).select(*[c for c in docs.columns if c != out], out)


def take_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text", **options) -> DataFrame:
    """The mixed corpus itself: every row of ``docs`` as often as the mix takes it."""
    mixed = systematic_mix(docs, id_col, source_col, text_col, out="__mix", **options)
    return (mixed.filter(F.col("__mix.copies") > 0)
            .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix.copies"))))
            .select(*docs.columns))


def op9_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with what the default mix takes of each."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    # the text is only needed for its size: it does not travel
    return systematic_mix(docs).select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         CASE WHEN source IS NULL THEN 'z' ELSE 'a' || source END AS src,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % 4096 AS salt
  FROM documents
), classed AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE length(bin(size)) * 4
              + (size * 4) // (1::BIGINT << (length(bin(size)) - 1)::INT) END AS cls
  FROM sized
), totals AS (
  SELECT src, sum(size)::BIGINT AS total FROM classed GROUP BY src
), weighed AS (
  SELECT src, total, total * 3 AS cap,
         [5, 2, 1][((row_number() OVER (ORDER BY src)) - 1) % 3 + 1] AS w FROM totals
), levels AS (
  SELECT *, row_number() OVER t AS i,
         (sum(total) OVER () - coalesce(sum(cap) OVER (t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
           / (sum(w) OVER (t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed WINDOW t AS (ORDER BY cap::DOUBLE / w, src)
), free AS (
  SELECT min(i) AS fi FROM levels WHERE level * w <= cap
), targets AS (
  SELECT src, total, CASE WHEN fi IS NULL OR i < fi THEN cap::DOUBLE
           ELSE (SELECT level FROM levels, free WHERE i = fi) * w END AS target
  FROM levels, free
), ranked AS (
  SELECT doc_id, size, total, target,
         CASE WHEN total = 0 THEN 0.0::DOUBLE ELSE least(target / total, 3.0::DOUBLE) END AS rate,
         ('0x' || substr(md5('20:' || src), 1, 4))::INT::DOUBLE / 65536 AS u,
         row_number() OVER (PARTITION BY src ORDER BY cls, salt, size, doc_id NULLS LAST) AS k
  FROM classed JOIN targets USING (src)
)
SELECT doc_id, size, total AS source_size, target,
       ((floor(u + rate * k) - floor(u + rate * (k - 1)))::BIGINT * size)::BIGINT AS taken
FROM ranked
"""
