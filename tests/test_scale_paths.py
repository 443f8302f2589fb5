"""Scale paths agree with the simple paths: blocked kNN, approximate recall, streaming, partitioning."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.similarity import dense_pairs, ivf_knn, knn, lsh_pairs
from millrace.session import table


def _pairs(df):
    return {(r["tid"], r["iid"]): round(r["score"], 9) for r in df.collect()}


def test_blocked_knn_equals_broadcast(spark, sf_small):
    emb = table(spark, sf_small, "embeddings")
    a = knn(emb, emb, 3, "vec_id", "vec_id", exclude_self=True)
    b = knn(emb, emb, 3, "vec_id", "vec_id", exclude_self=True, broadcast_bytes=0, block_rows=120)
    assert _pairs(a) == _pairs(b)


def test_ivf_and_lsh_recall(spark, sf_small):
    emb = table(spark, sf_small, "embeddings")
    exact = {r["tid"]: r["iid"] for r in knn(emb, emb, 1, "vec_id", "vec_id", exclude_self=True).collect()}
    approx = {r["tid"]: r["iid"] for r in ivf_knn(emb, emb, 1, "vec_id", "vec_id", nlist=8, nprobe=8,
                                                   exclude_self=True).collect()}
    # probing every list is exhaustive: recall must be 1
    assert approx == exact
    thr = 0.3
    brute = {(min(a, b), max(a, b)) for (a, b), s in _pairs(knn(emb, emb, 500, "vec_id", "vec_id",
                                                                   exclude_self=True)).items() if s > thr}
    lsh = {(r["a"], r["b"]) for r in lsh_pairs(emb, thr, "vec_id").filter(F.col("score") > thr).collect()}
    assert lsh <= brute and len(lsh) >= 0.9 * len(brute)


def test_dense_pairs_are_all_pairs_of_the_table(spark, sf_small):
    import __spark_entry__ as E
    emb = table(spark, sf_small, "embeddings")
    brute = {(min(a, b), max(a, b)) for (a, b), s in _pairs(knn(emb, emb, 500, "vec_id", "vec_id",
                                                                   exclude_self=True)).items() if s > 0.3}
    for found in (dense_pairs(emb, 0.3, "vec_id"), dense_pairs(emb, 0.3, "vec_id", block_rows=70),
                  E.queries()["vector_pairs"](spark, sf_small)):
        got = [(r["a"], r["b"]) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == brute and brute


@pytest.mark.parametrize("n", [1, 7])
def test_results_do_not_depend_on_partitioning(spark, sf_small, n):
    import __spark_entry__ as E
    from millrace.session import table as t
    base = {r["doc_id"]: r["rank"] for r in E.queries()["seeded_shuffle"](spark, sf_small).collect()}
    from millrace.operators.feed import seeded_rank
    from millrace.operators.tokenize import pretoken_counts
    docs = t(spark, sf_small, "documents").select("doc_id", "text").repartition(n)
    again = {r["doc_id"]: r["rank"] for r in seeded_rank(pretoken_counts(docs, "text", "n_tokens"), "doc_id").collect()}
    assert base == again


def test_stream_equals_batch(spark, tmp_path):
    import json
    from millrace.streaming.streams import dedup_stream, length_histogram_stream, with_question
    src = tmp_path / "in"
    src.mkdir()
    rows = [{"conversations": [{"from": "human", "value": q}, {"from": "gpt", "value": "a"}]}
            for q in ["x", "y", "x", "z", "y", "x"]]
    for i in range(3):
        (src / f"part{i}.jsonl").write_text("\n".join(json.dumps(r) for r in rows[2 * i:2 * i + 2]) + "\n")
    from millrace.streaming.streams import read_chat_stream
    stream = with_question(read_chat_stream(spark, str(src), max_files_per_trigger=1))
    q = (dedup_stream(stream).select("question_id", "question").writeStream.format("memory")
         .queryName("dedup_out").outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ck1")).start())
    q.awaitTermination(120)
    got = sorted(r["question"] for r in spark.sql("SELECT * FROM dedup_out").collect())
    assert got == ["x", "y", "z"]
    h = (length_histogram_stream(stream.withColumn("n", F.length("question")), "n", [0, 1, 2, 100])
         .writeStream.format("memory").queryName("hist_out").outputMode("complete")
         .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck2")).start())
    h.awaitTermination(120)
    assert {r["bin"]: r["n"] for r in spark.sql("SELECT * FROM hist_out").collect()} == {1: 6}


def test_stream_decontamination_matches_batch(spark, tmp_path):
    import json
    from millrace.operators.dedup import contamination_matches
    from millrace.streaming.streams import decontaminate_batches, read_chat_stream, with_question
    src = tmp_path / "in"
    src.mkdir()
    qs = ["the cat sat on the mat", "a dog ran far", "the cat sat on a mat"]
    (src / "a.jsonl").write_text("\n".join(json.dumps({"conversations": [{"from": "h", "value": q}]}) for q in qs))
    bench = spark.createDataFrame([(1, "the cat sat on the mat")], "item_id long, text string")
    stream = with_question(read_chat_stream(spark, str(src))).select("question_id", "question")
    run = decontaminate_batches(bench, 0.8, str(tmp_path / "flag"), str(tmp_path / "keep"))
    q = (stream.writeStream.foreachBatch(run).trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination(120)
    flagged = {r["question_id"] for r in spark.read.parquet(str(tmp_path / "flag")).collect()}
    batch = spark.createDataFrame([(q,) for q in qs], "question string").select(
        F.substring(F.sha2("question", 256), 1, 16).alias("question_id"), "question")
    want = {r["question_id"] for r in contamination_matches(batch, bench, "question_id", "question",
                                                           "item_id", "text", 0.8).collect()}
    assert flagged == want and len(want) == 2
    assert spark.read.parquet(str(tmp_path / "keep")).count() == 1
    run(batch, 0)  # a retried epoch replaces its own rows
    run(batch, 0)
    assert spark.read.parquet(str(tmp_path / "flag")).count() == 2
    assert spark.read.parquet(str(tmp_path / "keep")).count() == 1


def test_tf_top1_grid_path_equals_broadcast_path(spark, sf_small):
    from millrace.operators.similarity import tf_top1
    docs = table(spark, sf_small, "documents").select("doc_id", "text")
    bench = table(spark, sf_small, "benchmark")
    a = tf_top1(docs, bench, "doc_id", "text", "item_id", "text", threshold=0.5)
    b = tf_top1(docs, bench, "doc_id", "text", "item_id", "text", threshold=0.5, broadcast_rows=0)
    c = tf_top1(docs, bench, "doc_id", "text", "item_id", "text", threshold=0.5, method="join")
    assert _pairs(a) == _pairs(b) == _pairs(c) and len(_pairs(a)) > 0


def test_string_ids_on_every_tf_path(spark):
    from millrace.operators.similarity import tf_top1
    t = spark.createDataFrame([("q-b", "the cat sat on the mat"), ("q-a", "dogs run far")], "qid string, text string")
    b = spark.createDataFrame([("k2", "the cat sat on a mat"), ("k1", "the cat sat on a mat")], "kid string, text string")
    res = [{r["tid"]: (r["iid"], round(r["score"], 9)) for r in
            tf_top1(t, b, "qid", "text", "kid", "text", 0.5, broadcast_rows=bound, method=m).collect()}
           for bound, m in [(10 ** 6, "matmul"), (10 ** 6, "join"), (0, "matmul")]]
    assert res[0] == res[1] == res[2]
    assert set(res[0]) == {"q-b"} and res[0]["q-b"][0] == "k1"  # tie goes to the smallest id


def test_packed_samples_conserve_tokens(spark, sf_small):
    import __spark_entry__ as E
    from millrace.operators.labels import build_labels, split_valid
    from millrace.plans.catalog import _chat_ids
    packs = E.queries()["packed_samples"](spark, sf_small).collect()
    assert packs and all(p["length"] == 1026 and p["n_tokens"] <= 1026 for p in packs)
    ok, _ = split_valid(build_labels(_chat_ids(spark, sf_small), limit=1024))
    total = ok.select(F.sum(F.size("input_ids"))).first()[0]
    assert sum(p["n_tokens"] for p in packs) == total


def test_hot_list_is_split_into_blocks(spark, sf_small):
    """Every vector in one list (a key holding all rows): tiny blocks must still give the exact answer."""
    emb = table(spark, sf_small, "embeddings")
    exact = _pairs(knn(emb, emb, 2, "vec_id", "vec_id", exclude_self=True))
    hot = _pairs(ivf_knn(emb, emb, 2, "vec_id", "vec_id", nlist=1, nprobe=1, exclude_self=True, block_rows=60))
    assert hot == exact


def test_exact_dedup_with_a_hot_copy_group(spark):
    from millrace.operators.dedup import exact_dedup, with_content_id
    rows = [(i, "same text") for i in range(3000)] + [(5000 + i, f"text {i}") for i in range(100)]
    df = with_content_id(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), "text")
    out = {r["text"]: (r["doc_id"], r["n"]) for r in exact_dedup(df, "question_id", "doc_id", "n").collect()}
    assert out["same text"] == (0, 3000) and len(out) == 101


def test_stream_dedup_with_watermark_bounds_state(spark, tmp_path):
    import json
    from millrace.streaming.streams import dedup_stream, read_chat_stream, with_question
    src = tmp_path / "in"
    src.mkdir()
    for i, qs in enumerate([["x", "y"], ["x", "z"], ["y", "w"]]):
        (src / f"p{i}.jsonl").write_text("\n".join(
            json.dumps({"conversations": [{"from": "h", "value": q}]}) for q in qs) + "\n")
    stream = with_question(read_chat_stream(spark, str(src), max_files_per_trigger=1))
    q = (dedup_stream(stream, event_time="ingest_ts", delay="1 hour").select("question")
         .writeStream.format("memory").queryName("wm_out").outputMode("append")
         .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination(120)
    assert sorted(r["question"] for r in spark.sql("SELECT * FROM wm_out").collect()) == ["w", "x", "y", "z"]
