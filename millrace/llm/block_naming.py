"""Exact duplicates by deterministic block naming (DataFrame functions only).

Normalised texts are cut into blocks of a fixed number of bytes. The distinct
blocks are sorted (inside hash shards) and named with integers; then adjacent
pairs of names are named again, level by level, until each document is one
name. Two documents get the same name exactly when their texts are equal.

Names travel by the block's 64-bit hash, which is narrow. That is safe because
all distinct blocks are compared as bytes first: a hash that stands for more
than one block is found there, and such blocks are matched by their bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import read, written

BLOCK_BYTES = 4096
#: White-space runs other than one single space: each becomes one space.
ODD_SPACE = r"(?:[\x09-\x0D]|\x20(?=[\x20\x09-\x0D]))[\x20\x09-\x0D]*"
#: Repeats of one document that are listed in one go.
REPEATS = 4096
_NONE = -1


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), ODD_SPACE, " ")


def _hash(block: Column) -> Column:
    return F.xxhash64(block)


def _row_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` reduced to a row key, the id, the text's digest and its bytes."""
    return (docs.select(F.col(id_col).alias("__id"), normalised(F.col(text_col)).cast("binary").alias("__bytes"))
            .withColumn("__sha", F.sha2("__bytes", 256))
            .withColumn("__key", F.concat_ws(":", F.coalesce(F.col("__id").cast("string"), F.lit("null")),
                                             F.col("__sha"))))


def _blocks(rows: DataFrame, size: int, *keep: str) -> DataFrame:
    """One row per block: the ``keep`` columns, ``__pos`` and ``__block``."""
    count = F.greatest(F.ceil(F.octet_length("__bytes") / size), F.lit(1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1),
                      lambda i: F.substring(F.col("__bytes"), i * size + 1, F.lit(size)))
    return rows.select(*keep, F.posexplode(cut).alias("__pos", "__block"))


def _sorted_names(distinct: DataFrame, *order: str) -> DataFrame:
    """Integer names for distinct rows: sorted inside each shard, numbered in that order."""
    return distinct.sortWithinPartitions(*order).withColumn("__name", F.monotonically_increasing_id())


def block_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES, block_hash=_hash) -> DataFrame:
    """One row per document: ``__id``, ``__sha``, ``__rows`` and its identity (``__level``, ``__name``)."""
    keyed = _row_key(docs, id_col, text_col)
    distinct = _blocks(keyed, block_bytes).select("__block").distinct()
    names = written(_sorted_names(distinct, "__block").select(
        block_hash(F.col("__block")).alias("__h"), "__name"), "block-names")
    shared = names.groupBy("__h").count().filter("count > 1").select("__h")
    found = _blocks(keyed, block_bytes, "__key", "__id", "__sha").withColumn(
        "__h", block_hash(F.col("__block")))
    narrow = found.select("__key", "__id", "__sha", "__pos", "__h")
    if shared.isEmpty():
        cur = narrow.join(names, "__h")
    else:
        # some hash stands for several blocks: those are matched by their bytes
        alone = names.join(shared, "__h", "left_anti")
        clash = found.join(shared, "__h", "left_semi")
        exact = written(_sorted_names(clash.select("__block").distinct(), "__block")
                        .withColumn("__name", F.lit(_NONE - 1) - F.col("__name")), "clashing-blocks")
        cur = (narrow.join(alone, "__h").unionByName(
            clash.join(exact, "__block").select("__key", "__id", "__sha", "__pos", "__h", "__name")))
    # rows that repeat a document have the same blocks: counted, then one copy goes on
    cur = cur.groupBy("__key", "__pos").agg(
        F.first("__id").alias("__id"), F.first("__sha").alias("__sha"),
        F.count(F.lit(1)).alias("__rows"), F.first("__name").alias("__name"))
    cur = written(cur, "block-level-0")
    info = written(cur.groupBy("__key").agg(
        F.max("__pos").alias("__last"), F.first("__id").alias("__id"), F.first("__sha").alias("__sha"),
        F.max("__rows").alias("__rows")), "block-docs")
    top = info.agg(F.max("__last")).first()[0] or 0
    done = cur.filter("__pos = 0").join(info.filter("__last = 0").select("__key"), "__key", "left_semi").select(
        "__key", F.lit(0).alias("__level"), "__name")
    cur = cur.join(info.filter("__last > 0").select("__key"), "__key", "left_semi").select("__key", "__pos", "__name")
    level = 0
    while top >> level > 0:
        level += 1
        half = F.expr("__pos div 2").cast("int")
        left = F.when(F.col("__pos") % 2 == 0, F.col("__name"))
        right = F.when(F.col("__pos") % 2 == 1, F.col("__name"))
        pairs = cur.groupBy("__key", half.alias("__pos")).agg(
            F.max(left).alias("__a"), F.coalesce(F.max(right), F.lit(_NONE)).alias("__b"))
        pairs = written(pairs, "block-pairs")
        named = written(_sorted_names(pairs.select("__a", "__b").distinct(), "__a", "__b"), "pair-names")
        cur = written(pairs.join(named, ["__a", "__b"]).select("__key", "__pos", "__name"), "block-level")
        ended = info.filter((F.col("__last") >= (1 << (level - 1))) & (F.col("__last") < (1 << level))).select("__key")
        done = done.unionByName(cur.join(ended, "__key", "left_semi").select(
            "__key", F.lit(level).alias("__level"), "__name"))
        cur = cur.join(ended, "__key", "left_anti")
    return done.join(info, "__key").select("__id", "__sha", "__rows", "__level", "__name")


def _every_row(named: DataFrame) -> DataFrame:
    """``named`` with each row as often as its document stands in the table.

    A document that repeats more than ``REPEATS`` times is dealt out in portions first.
    """
    few = named.filter(F.col("__rows") <= REPEATS).withColumn("__n", F.col("__rows"))
    many = (named.filter(F.col("__rows") > REPEATS)
            .withColumn("__at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__rows") - 1, F.lit(REPEATS).cast("long"))))
            .repartition("__id", "__sha", "__at")
            .withColumn("__n", F.least(F.lit(REPEATS).cast("long"), F.col("__rows") - F.col("__at"))).drop("__at"))
    return few.unionByName(many).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES, block_hash=_hash) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after each run of ASCII white space became
    one space; a null text is the empty text. Of equal texts the row with the
    smallest id stays; a null id stays only where all ids of the group are null.
    Every row is returned and counted in ``group_size``, rows that repeat id and
    text as well: those of the smallest id are all ``kept``. Extra
    columns of ``docs`` are not read. An empty table gives no rows. Long texts
    add levels (the logarithm of their blocks). A group with a third of all rows
    is aggregated map-side, and only narrow rows are joined back, on sides that
    the adaptive planner can split.

    ``block_hash`` only carries names; a weak one changes the cost, not the result.
    """
    named = written(block_names(docs, id_col, text_col, block_bytes, block_hash), "doc-names")
    groups = written(named.groupBy("__level", "__name").agg(
        F.min("__id").alias("keep_id"), F.sum("__rows").alias("group_size")), "equal-texts")
    return (_every_row(named).join(groups, ["__level", "__name"])
            .select(F.col("__id").alias(id_col), "keep_id", "group_size",
                    F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("__sha").alias("text_sha256")))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were.

    Where rows repeat the id and the text that stay, one of them stays; which one, if
    other columns tell them apart, is not defined.
    """
    groups = exact_duplicates(docs, id_col, text_col)
    kept = written(groups.filter("kept").groupBy(F.col(id_col).alias("__keep"), F.col("text_sha256").alias("__keep_sha"))
                   .agg(F.count(F.lit(1)).alias("__rows")), "kept-texts")
    marked = docs.withColumn("__sha", F.sha2(normalised(F.col(text_col)), 256))
    out = marked.join(kept, F.col(id_col).eqNullSafe(F.col("__keep"))
                      & (F.col("__sha") == F.col("__keep_sha")), "left_semi")
    if not kept.filter("__rows > 1").isEmpty():  # some of the rows that stay repeat id and text
        out = out.dropDuplicates([id_col, "__sha"])
    return out.select(*docs.columns)


def op4_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts among all documents."""
    return exact_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


OP4_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""
