"""Parsed input that is found again, reader shards as files, exact stream dedup with ids in files."""

import json
import os

from pyspark.sql import functions as F


def _chats(path, questions, mtime=None):
    path.write_text("".join(json.dumps({"conversations": [{"from": "human", "value": q}, {"from": "gpt", "value": "a"}]})
                            + "\n" for q in questions))
    if mtime:
        os.utime(path, (mtime, mtime))


def _questions(df):
    return sorted(r[0] for r in df.select(F.col("conversations")[0]["value"]).collect())


def test_parsed_files_are_found_again(spark, tmp_path, monkeypatch):
    from millrace.sources import cache
    src, store = tmp_path / "in", str(tmp_path / "cache")
    src.mkdir()
    _chats(src / "a b[1].jsonl", ["a1", "a2"], 1_700_000_000)
    _chats(src / "b.jsonl", ["b1"], 1_700_000_000)
    (src / "empty.jsonl").write_text("")
    plain = cache.read_chats(spark, str(src))
    first = cache.read_chats(spark, str(src), store)
    assert first.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, first.collect())) == sorted(map(str, plain.collect()))

    parsed = []
    real = cache.read_chat_jsonl
    monkeypatch.setattr(cache, "read_chat_jsonl", lambda s, paths: parsed.append(paths) or real(s, paths))
    again = cache.read_chats(spark, str(src), store)
    assert _questions(again) == ["a1", "a2", "b1"] and parsed == []
    assert all(f.endswith(".parquet") for f in again.select("conversations").inputFiles() if "/parsed/" in f)

    _chats(src / "b.jsonl", ["b2", "b3"], 1_700_000_500)  # a changed file is parsed again, alone
    assert _questions(cache.read_chats(spark, str(src), store)) == ["a1", "a2", "b2", "b3"]
    assert len(parsed) == 1 and len(parsed[0]) == 1 and parsed[0][0].endswith("b.jsonl")
    assert _questions(cache.read_chats(spark, str(src / "b.jsonl"), store)) == ["b2", "b3"]  # only what is asked for

    assert cache.forget_stale(spark, store, str(src)) == 1
    assert _questions(cache.read_chats(spark, str(src), store)) == ["a1", "a2", "b2", "b3"] and len(parsed) == 1


def test_parsed_files_without_a_line(spark, tmp_path):
    from millrace.sources import cache
    (tmp_path / "empty.jsonl").write_text("")
    got = cache.read_chats(spark, str(tmp_path / "empty.jsonl"), str(tmp_path / "cache"))
    assert got.count() == 0 and "conversations" in got.columns


def test_shards_are_equal_and_resume(spark, tmp_path):
    from millrace.operators.shards import epoch_plan, read_shard, resume_at, write_shards
    out = str(tmp_path / "shards")
    ranked = spark.range(1003).select(F.col("id").alias("doc_id"), F.col("id").alias("rank"), F.lit(3).alias("n"))
    manifest = write_shards(ranked, out, 8, len_col="n", rows_per_file=40)
    rows = manifest.collect()
    per = {}
    for r in rows:
        per[r["shard"]] = per.get(r["shard"], 0) + r["n_rows"]
    assert per == {s: 125 for s in range(8)} and sum(r["n_tokens"] for r in rows) == 3000
    assert {r["n_rows"] for r in rows} == {40, 5} and len(rows) == 32
    whole = [r["rank"] for r in read_shard(spark, out, 3).collect()]
    assert whole == list(range(3, 1000, 8))
    epoch, start = resume_at(40, 125, 4)  # 31 batches an epoch
    rest = read_shard(spark, out, 3, start)
    assert (epoch, start) == (1, 36) and [r["rank"] for r in rest.collect()] == whole[36:]
    late = read_shard(spark, out, 3, 81)
    assert [r["rank"] for r in late.collect()] == whole[81:]
    plan = {(r["epoch"], r["shard"]): (r["n_batches"], r["first_step"]) for r in epoch_plan(manifest, 4, 2).collect()}
    assert plan[0, 0] == (31, 0) and plan[1, 7] == (31, 31) and len(plan) == 16


def test_stream_dedup_with_ids_in_files(spark, tmp_path):
    from millrace.streaming.streams import dedup_batches, read_chat_stream, with_question
    src = tmp_path / "in"
    src.mkdir()
    kept, ids = str(tmp_path / "kept"), str(tmp_path / "ids")
    run = dedup_batches(kept, ids)

    def drain():
        stream = with_question(read_chat_stream(spark, str(src), max_files_per_trigger=1)).select("question_id", "question")
        q = (stream.writeStream.foreachBatch(run).trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "ck")).start())
        assert q.awaitTermination(120)

    _chats(src / "a.jsonl", ["x", "y", "x"])
    drain()
    _chats(src / "b.jsonl", ["y", "z", "z"])  # another run of the stream: copies of its earlier rows
    drain()
    rows = spark.read.parquet(kept)
    assert sorted(r["question"] for r in rows.collect()) == ["x", "y", "z"]
    assert spark.read.parquet(ids).count() == 3
    # an epoch that is tried again replaces what it wrote
    run(rows.filter("question = 'z'").drop("epoch").union(rows.filter("question = 'x'").drop("epoch")), 1)
    assert sorted(r["question"] for r in spark.read.parquet(kept).collect()) == ["x", "y", "z"]
