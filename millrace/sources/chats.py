"""Chat-record sources.

Raw chat files are JSON Lines, one record per line, holding a
``conversations`` array of ``{from, value}`` turns. The long test table
``conversations(conv_id, turn, role, text)`` is the same data one turn per
row; ``turn`` is the 0-based position inside the chat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.lines import SPLIT_BYTES, read_lines

TURN = T.StructType([
    T.StructField("from", T.StringType()),
    T.StructField("value", T.StringType()),
])

CHAT_SCHEMA = T.StructType([
    T.StructField("conversations", T.ArrayType(TURN)),
    T.StructField("_corrupt_record", T.StringType()),
])

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("tool_calls", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("arguments", T.StringType()),
    ]))),
])


def read_chat_jsonl(spark: SparkSession, paths, schema: T.StructType = CHAT_SCHEMA,
                    split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """JSONL chat scan with an explicit schema (no inference pass).

    Several paths are one job; ``source_path`` keeps the file each record
    came from (used to choose the prompt) and ``source_pos`` is the record's
    position: (file path, offset of its first byte). It orders lines as they
    appear in each file, files by path, and is the same under any split size,
    so a later run names the same records. Bad lines land in
    ``_corrupt_record`` instead of failing the job; blank lines are no records.
    """
    lines = read_lines(spark, paths, split_bytes)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return lines.select(
        F.from_json("line", schema, options).alias("record"), "source_path", "source_mtime",
        F.struct(F.col("source_path").alias("file"), "offset").alias("source_pos"),
    ).select("record.*", "source_path", "source_mtime", "source_pos")


def read_json_map(spark: SparkSession, path: str, key: str = "key", value: str = "value",
                  value_type: str = "string") -> DataFrame:
    """A whole-file JSON object ``{key: value, ...}`` as a two-column table.

    Used for the benchmark question file and for vocabularies. The file is
    one object, so it is read whole; the object itself is the bounded input
    (a benchmark or a vocabulary), never the corpus.
    """
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json(F.col("value"), f"map<string,{value_type}>")
    return raw.select(F.explode(m).alias(key, value))


def read_merges(spark: SparkSession, path: str, comment_mode: str = "any_hash") -> DataFrame:
    """Merge rules ``left right`` one per line; rank = order of the kept lines.

    ``comment_mode='any_hash'`` skips every line starting with ``#`` (the
    original loader's rule); ``'header_only'`` skips only a leading
    ``#version`` line. Blank lines are skipped. A pair given twice keeps its
    last rank.
    """
    if comment_mode not in ("any_hash", "header_only"):
        raise ValueError(f"unknown comment_mode {comment_mode!r}")
    raw = spark.read.text(path, wholetext=True)
    lines = F.transform(F.split(F.col("value"), "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    if comment_mode == "any_hash":
        kept = F.filter(lines, lambda x: (x != "") & ~x.startswith("#"))
    else:
        kept = F.filter(lines, lambda x, i: (x != "") & ~((i == 0) & x.startswith("#version")))
    # a model file is one row: its kept lines are numbered in place
    rules = raw.select(F.posexplode(kept).alias("rank", "line"))
    parts = F.split("line", r"\s+")
    return (rules.select("rank", F.get(parts, F.lit(0)).alias("left"), F.get(parts, F.lit(1)).alias("right"))
            .groupBy("left", "right").agg(F.max("rank").cast("long").alias("rank")))


def benchmark_from_map(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark questions file ``{id: text}`` -> ``(item_id, text)``."""
    return read_json_map(spark, path, key="item_id", value="text")


def assemble_chats(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Long table -> one row per chat with ``messages`` ordered by turn.

    One shuffle on the chat key. The result row holds the whole chat, which
    is what rendering needs; steps that only need the first two turns use
    :func:`first_turns` instead and never build the array.
    """
    msg = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                   F.col(text_col).alias("content"))
    grouped = conversations.groupBy(conv_col).agg(F.array_sort(F.collect_list(msg)).alias("_m"))
    messages = F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return grouped.select(conv_col, messages.alias("messages"))


def first_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text", n: int = 2) -> DataFrame:
    """Positional pick of the first ``n`` turns as columns ``turn0_text`` ...

    Only rows with ``turn < n`` are read (the filter reaches the Parquet
    scan) and the pivot is a partial aggregation, so a chat with millions of
    turns costs two rows, not one huge group.
    """
    aggs = []
    for i in range(n):
        aggs.append(F.max(F.when(F.col(turn_col) == i, F.col(text_col))).alias(f"turn{i}_text"))
        aggs.append(F.max(F.when(F.col(turn_col) == i, F.col(role_col))).alias(f"turn{i}_role"))
    return conversations.filter(F.col(turn_col) < n).groupBy(conv_col).agg(*aggs)


def messages_from_conversations(col: str | Column = "conversations") -> Column:
    """``conversations[{from, value}]`` -> ``messages[{role, content}]``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.transform(c, lambda t: F.struct(t["from"].alias("role"), t["value"].alias("content")))
