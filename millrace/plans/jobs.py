"""Job specs: the end-to-end pipelines with their sinks.

Each job is a dataclass of parameters (no hard-coded paths or thresholds)
and a ``run(spark)`` that declares one DataFrame plan per output and writes
it. Outputs are always written, even when empty, so reruns are idempotent.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import constants as C
from millrace.functions.text import answer_of, content_id, is_long, is_math, question_of, repair_tags, split_name
from millrace.operators.dedup import (contamination_matches, dense_near_duplicates, drop_all_duplicates, drop_flagged,
                                      exact_dedup, text_near_duplicates)
from millrace.operators.embed import embed
from millrace.operators.packing import BUCKET_DIGITS
from millrace.operators.reports import flag_rate, length_histogram
from millrace.operators.similarity import ivf_knn, ivf_sizes, knn
from millrace.plans.prepare import instruct_records
from millrace.session import cut_lineage, ensure_checkpoint_dir
from millrace.sources.cache import read_chats
from millrace.sources.chats import benchmark_from_map


def _questions(spark: SparkSession, paths: list[str], cache_dir: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(targets, rejected, copies)`` of chat files, read once.

    ``targets`` has one row per distinct question (the first line wins),
    ``copies`` the rows dropped for it, ``rejected`` the lines without a
    question or that are no JSON, as they stood. Every input row is in one of
    the three.
    """
    chats = read_chats(spark, paths, cache_dir).drop("file_name")
    q = chats.select("*", question_of("conversations").alias("question"))
    q = cut_lineage(q.withColumn("question_id", content_id(F.col("question"))), "questions")
    bad = F.col("question").isNull()
    good = q.filter(~bad).drop("_corrupt_record")
    targets = cut_lineage(exact_dedup(good, "question_id", order_col="source_pos"), "targets")
    copies = good.join(targets.select("source_pos"), "source_pos", "left_anti")
    return targets, q.filter(bad).drop("question", "question_id"), copies


def _metrics(targets: DataFrame, rejected: DataFrame, copies: DataFrame, flagged: DataFrame) -> DataFrame:
    """One row: input rows = targets + rejected + copies; flagged ones are among the targets."""
    marked = targets.select("question_id").join(
        flagged.select("question_id", F.lit(True).alias("hit")).distinct(), "question_id", "left")
    rate = flag_rate(marked.select(F.coalesce("hit", F.lit(False)).alias("hit")), "hit")
    return rate.withColumn("n_rejected", F.lit(rejected.count())).withColumn("n_copies", F.lit(copies.count()))


def _write(outs: dict[str, DataFrame], prefix: str, fmt: str) -> dict[str, str]:
    paths = {}
    for name, df in outs.items():
        paths[name] = f"{prefix}_{name}"
        df.write.mode("overwrite").format(fmt).save(paths[name])
    return paths


@dataclass
class DecontaminateJob:
    """Chats + benchmark questions -> contaminated report, decontaminated records, rejects, copies, metrics.

    ``encoder`` is a loader (called on the executors) of an object with
    ``encode(list of texts)``; with it questions are compared by embedding
    cosine, without it by term-frequency cosine. The matches are scored once.
    """
    target_paths: list[str]
    benchmark_path: str
    output_prefix: str
    threshold: float = C.SIM_THRESHOLD
    output_format: str = "json"
    encoder: Callable[[], object] | None = None
    cache_dir: str | None = None

    def _matches(self, targets: DataFrame, bench: DataFrame) -> DataFrame:
        if self.encoder is None:
            return contamination_matches(targets, bench, "question_id", "question", "item_id", "text", self.threshold)
        t = embed(targets.select("question_id", "question"), "question", self.encoder)
        b = embed(bench, "text", self.encoder)
        nn = knn(t, b, 1, "question_id", "item_id")
        return nn.filter(F.col("score") > self.threshold).select(
            F.col("tid").alias("question_id"), F.col("iid").alias("match_id"), "score")

    def plan(self, spark: SparkSession) -> dict[str, DataFrame]:
        targets, rejected, copies = _questions(spark, self.target_paths, self.cache_dir)
        bench = benchmark_from_map(spark, self.benchmark_path)
        m = cut_lineage(self._matches(targets, bench), "matches")
        report = (m.join(targets.select("question_id", "question"), "question_id")
                  .join(bench.select(F.col("item_id").alias("match_id"), F.col("text").alias("match_question")),
                        "match_id")
                  .select("question_id", "question", "match_question", "score"))
        return {"contaminated": report, "decontaminated": drop_flagged(targets, m, "question_id"),
                "rejected": rejected, "copies": copies, "metrics": _metrics(targets, rejected, copies, m)}

    def run(self, spark: SparkSession) -> dict[str, str]:
        ensure_checkpoint_dir(spark)
        return _write(self.plan(spark), self.output_prefix, self.output_format)


@dataclass
class DeduplicateJob:
    """Chats -> questions with a near duplicate, questions without one, rejects, copies, metrics.

    Every question that has another one above the threshold is listed and
    removed (whole clusters go). With ``encoder`` embeddings are compared:
    exactly below the sizing rule's bound, by clustered search above it.
    """
    target_paths: list[str]
    output_prefix: str
    threshold: float = C.SIM_THRESHOLD
    output_format: str = "json"
    encoder: Callable[[], object] | None = None
    cache_dir: str | None = None

    def _pairs(self, targets: DataFrame) -> DataFrame:
        if self.encoder is None:
            return text_near_duplicates(targets, "question_id", "question", self.threshold)
        e = cut_lineage(embed(targets.select("question_id", "question"), "question", self.encoder)
                        .select("question_id", "embedding"), "embeddings")
        lists, probes = ivf_sizes(e.count(), dedup=True)
        if lists == 1:
            return dense_near_duplicates(e, "question_id", "embedding", self.threshold)
        nn = ivf_knn(e, e, 1, "question_id", "question_id", nlist=lists, nprobe=probes, exclude_self=True)
        return nn.filter(F.col("score") > self.threshold).select(
            F.col("tid").alias("question_id"), F.col("iid").alias("match_id"), "score")

    def plan(self, spark: SparkSession) -> dict[str, DataFrame]:
        targets, rejected, copies = _questions(spark, self.target_paths, self.cache_dir)
        pairs = cut_lineage(self._pairs(targets), "duplicates")
        names = targets.select("question_id", "question")
        report = (pairs.join(names, "question_id")
                  .join(names.select(F.col("question_id").alias("match_id"), F.col("question").alias("match_question")),
                        "match_id")
                  .select("question_id", "question", "match_question", "score"))
        return {"duplicated": report, "deduplicated": drop_all_duplicates(targets, pairs, "question_id"),
                "rejected": rejected, "copies": copies, "metrics": _metrics(targets, rejected, copies, pairs)}

    def run(self, spark: SparkSession) -> dict[str, str]:
        ensure_checkpoint_dir(spark)
        return _write(self.plan(spark), self.output_prefix, self.output_format)


@dataclass
class PrepareSplitJob:
    """Chat files -> instruct records, token lengths, long/short files per input, histogram, rejects.

    The prompt is chosen per record from its source path, so several files
    are one job. Answer lengths (histogram, length dump) are those of the
    answer before the end-of-turn marker; long or short goes by the whole
    templated text. ``split_file=<name>_gt_32K.jsonl`` and ``..._lt_32K.jsonl``
    folders hold each input's long and short records.
    """
    input_paths: list[str]
    output_dir: str
    merges_path: str
    seq_length: int = C.SEQ_LENGTH
    cache_dir: str | None = None

    def plan(self, spark: SparkSession) -> dict[str, DataFrame]:
        from millrace.operators.tokenize import token_counts_bpe
        from millrace.sources.chats import read_merges
        merges = read_merges(spark, self.merges_path)

        def count(df: DataFrame, text_col: str, out: str) -> DataFrame:
            return token_counts_bpe(df, df.columns, text_col, merges).withColumnRenamed("n_tokens", out)

        chats = read_chats(spark, self.input_paths, self.cache_dir)
        pos = F.col("source_pos")
        pairs = chats.select(F.concat_ws("#", pos["file"], pos["offset"]).alias("record_id"),
                             "source_path", "file_name", "_corrupt_record",
                             question_of("conversations").alias("question"),
                             answer_of("conversations").alias("answer"))
        pairs = cut_lineage(pairs, "pairs")
        whole = F.col("question").isNotNull() & F.col("answer").isNotNull()
        ok, _ = instruct_records(count(pairs.filter(whole).drop("_corrupt_record")
                                       .withColumn("fixed", repair_tags("answer")), "fixed", "output_tokens"),
                                 path_col="source_path")
        ok = ok.drop("fixed").withColumn("full_text", F.concat("instruction", "output"))
        ok = count(ok, "full_text", "n_tokens").drop("full_text")
        split = ok.select("record_id", "file_name", "instruction", "input", "output", "output_tokens", "n_tokens",
                          is_long("n_tokens", self.seq_length).alias("is_long"),
                          is_math("instruction").alias("is_math"))
        split = split.withColumn("split_file", split_name(F.col("file_name"), F.col("is_long")))
        return {"split": split, "rejected": pairs.filter(~whole)}

    def run(self, spark: SparkSession) -> dict[str, str]:
        ensure_checkpoint_dir(spark)
        outs = self.plan(spark)
        # the split feeds three outputs: write it once to shared storage
        split = cut_lineage(outs["split"], "split")
        base = self.output_dir.rstrip("/")
        split.select("record_id", "split_file", "is_long", "instruction", "input", "output", "is_math").write.mode(
            "overwrite").partitionBy("split_file", "is_long").json(f"{base}/split")
        length_histogram(split, "output_tokens").write.mode("overwrite").parquet(f"{base}/histogram")
        split.select("record_id", "file_name", "output_tokens").write.mode("overwrite").parquet(f"{base}/lengths")
        outs["rejected"].write.mode("overwrite").json(f"{base}/rejected")
        counts = split.agg(F.count(F.lit(1)).alias("n_records"), F.count_if("is_long").alias("n_long")).withColumn(
            "n_rejected", F.lit(outs["rejected"].count()))
        counts.write.mode("overwrite").json(f"{base}/metrics")
        return {k: f"{base}/{k}" for k in ("split", "histogram", "lengths", "rejected", "metrics")}


@dataclass
class TokenizeJob:
    """Prepared records (``prepare``'s split folder) -> ``id, input_ids, labels`` for packing, and rejects.

    ``handler`` names the registered text and label rules; the model is a
    merges file and a vocabulary file (one JSON object).
    """
    input_path: str
    output_dir: str
    merges_path: str
    vocab_path: str
    seq_length: int = C.SEQ_LENGTH
    handler: str = "instruct_sft"
    id_col: str = "record_id"

    def run(self, spark: SparkSession) -> dict[str, str]:
        from millrace.operators.labels import split_valid
        from millrace.plans.registry import get_handler
        from millrace.sources.chats import read_json_map, read_merges
        ensure_checkpoint_dir(spark)
        vocab = read_json_map(spark, self.vocab_path, "token", "id", "int")
        rows = get_handler(self.handler).apply(
            spark.read.json(self.input_path), merges=read_merges(spark, self.merges_path), vocab=vocab,
            seq_length=self.seq_length, id_col=self.id_col)
        rows = cut_lineage(rows, "tokenized")
        ok, rejected = split_valid(rows)
        base = self.output_dir.rstrip("/")
        ok.select(F.col(self.id_col).alias("id"), "input_ids", "labels", "clipped").write.mode("overwrite").parquet(
            f"{base}/tokenized")
        rejected.write.mode("overwrite").parquet(f"{base}/rejected")
        return {"tokenized": f"{base}/tokenized", "rejected": f"{base}/rejected"}


@dataclass
class PackJob:
    """Tokenized samples (``id, input_ids, labels``) -> packed training rows + report."""
    input_path: str
    output_dir: str
    seq_length: int = C.SEQ_LENGTH
    max_segments: int = C.MAX_SEGMENTS
    pad_id: int = C.PAD_ID
    oversize: str = "reject"
    id_col: str = "id"
    bucket_digits: int = BUCKET_DIGITS
    extra: dict = field(default_factory=dict)

    def run(self, spark: SparkSession) -> dict[str, str]:
        from millrace.operators.packing import materialize_packs, pack_plan, pack_summary, packing_report
        ensure_checkpoint_dir(spark)
        samples = spark.read.parquet(self.input_path)
        lens = samples.select(self.id_col, F.size("input_ids").alias("len"))
        plan, rejected = pack_plan(lens, self.id_col, "len", self.seq_length, self.max_segments,
                                   digits=self.bucket_digits, oversize=self.oversize)
        plan = cut_lineage(plan, "pack-plan")
        base = self.output_dir.rstrip("/")
        materialize_packs(plan, samples, self.id_col, self.seq_length, self.pad_id).write.mode(
            "overwrite").parquet(f"{base}/packed")
        packing_report(pack_summary(plan, self.id_col, self.seq_length), self.seq_length).write.mode(
            "overwrite").json(f"{base}/report")
        rejected.write.mode("overwrite").parquet(f"{base}/rejected")
        return {"packed": f"{base}/packed", "report": f"{base}/report", "rejected": f"{base}/rejected"}
