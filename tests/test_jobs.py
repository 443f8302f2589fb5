"""End-to-end jobs: JSONL chats in, every sink written."""

import json

from pyspark.sql import functions as F

from millrace.plans.jobs import DecontaminateJob, PackJob, PrepareSplitJob
from millrace.plans.registry import get_handler


def _chats(path, pairs):
    path.write_text("\n".join(json.dumps({"conversations": [{"from": "human", "value": q},
                                                            {"from": "gpt", "value": a}]}) for q, a in pairs) + "\n")


def test_decontaminate_job(spark, tmp_path):
    _chats(tmp_path / "t.jsonl", [("the cat sat on the mat", "a"), ("dogs run fast", "b"),
                                  ("the cat sat on the mat", "c")])
    (tmp_path / "bench.json").write_text(json.dumps({"k1": "The cat sat on the mat!"}))
    paths = DecontaminateJob([str(tmp_path / "t.jsonl")], str(tmp_path / "bench.json"),
                             str(tmp_path / "out"), threshold=0.9).run(spark)
    rep = spark.read.json(paths["contaminated"]).collect()
    assert len(rep) == 1 and rep[0]["match_question"] == "The cat sat on the mat!"
    kept = spark.read.json(paths["decontaminated"]).collect()
    assert [r["question"] for r in kept] == ["dogs run fast"]
    m = spark.read.json(paths["metrics"]).first()
    assert (m["n_total"], m["n_flagged"], m["rate_pct"]) == (2, 1, 50.0)


def test_prepare_split_job(spark, tmp_path):
    _chats(tmp_path / "math_a.jsonl", [("q1", "<think>x</think><answer>1</answer>"), ("q2 " * 40, "y")])
    _chats(tmp_path / "code.jsonl", [("q3", "z")])
    (tmp_path / "merges.txt").write_text("#version: 0.2\nt h\nth e\n")
    # without real merges a token is nearly a byte: the system prompt alone is several hundred
    job = PrepareSplitJob([str(tmp_path / "math_a.jsonl"), str(tmp_path / "code.jsonl")],
                          str(tmp_path / "prep"), str(tmp_path / "merges.txt"), seq_length=500)
    out = job.run(spark)
    split = spark.read.json(out["split"])
    assert split.count() == 3
    # the partition column comes back from the directory names
    assert split.filter(F.col("is_long").cast("string") == "true").count() == 1
    assert {r["split_file"] for r in split.select("split_file").collect()} == {
        "math_a_lt_32K.jsonl", "math_a_gt_32K.jsonl", "code_lt_32K.jsonl"}
    assert split.filter(F.col("instruction").contains("boxed")).count() == 2
    assert spark.read.parquet(out["histogram"]).count() == 100
    lengths = spark.read.parquet(out["lengths"])
    assert lengths.count() == 3
    # the answer "z" is one token: measured before the end-of-turn marker
    assert lengths.filter("file_name = 'code.jsonl'").first()["output_tokens"] == 1


def test_handler_and_pack_job(spark, tmp_path, sf_small):
    from millrace.operators.tokenize import learn_merges, vocab_from_merges
    from millrace.session import table
    merges = learn_merges(table(spark, sf_small, "benchmark"), "text", 100)
    vocab = vocab_from_merges(merges)
    recs = spark.createDataFrame([(1, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n", "yo<|im_end|>"),
                                  (2, "<|im_start|>user\nmore text<|im_end|>\n<|im_start|>assistant\n", "ok<|im_end|>")],
                                 "id long, instruction string, output string")
    lab = get_handler("instruct_sft").apply(recs, merges=merges, vocab=vocab, seq_length=64)
    rows = {r["id"]: r for r in lab.collect()}
    assert all(len(r["labels"]) == len(r["input_ids"]) for r in rows.values())
    assert all(r["labels"][0] == -100 and r["labels"][-1] != -100 for r in rows.values())
    lab.select("id", "input_ids", "labels").write.parquet(str(tmp_path / "tok"))
    out = PackJob(str(tmp_path / "tok"), str(tmp_path / "packed"), seq_length=32).run(spark)
    packed = spark.read.parquet(out["packed"]).collect()
    assert all(len(p["input_ids"]) == 32 and len(p["position_ids"]) == 32 for p in packed)
    rep = spark.read.json(out["report"]).first()
    assert rep["n_samples"] == 2


def test_first_line_wins_among_copies(spark, tmp_path):
    from millrace.functions.text import content_id, question_of, answer_of
    from millrace.operators.dedup import exact_dedup
    from millrace.sources.chats import read_chat_jsonl
    _chats(tmp_path / "a.jsonl", [("q", "first"), ("other", "x"), ("q", "second"), ("q", "third")])
    c = read_chat_jsonl(spark, [str(tmp_path / "a.jsonl")])
    q = c.select(content_id(question_of()).alias("question_id"), answer_of().alias("answer"), "source_pos")
    got = {r["answer"] for r in exact_dedup(q, "question_id", order_col="source_pos").collect()}
    assert got == {"first", "x"}


def test_bad_line_is_kept_aside(spark, tmp_path):
    from millrace.sources.chats import read_chat_jsonl
    p = tmp_path / "c.jsonl"
    p.write_text('{"conversations": [{"from": "h", "value": "ok"}]}\n{not json\n'
                 '{"conversations": [{"from": "h", "value": "fine"}]}\n')
    rows = read_chat_jsonl(spark, str(p)).select("conversations", "_corrupt_record").collect()
    assert sum(r["_corrupt_record"] is not None for r in rows) == 1
    assert sorted(r["conversations"][0]["value"] for r in rows if r["conversations"]) == ["fine", "ok"]


def test_every_input_row_is_accounted_for(spark, tmp_path):
    good = [("the cat sat on the mat", "a"), ("dogs run fast", "b"), ("the cat sat on the mat", "c")]
    _chats(tmp_path / "t.jsonl", good)
    with open(tmp_path / "t.jsonl", "a") as f:
        f.write('{not json\n{"conversations": []}\n')
    (tmp_path / "bench.json").write_text(json.dumps({"k1": "The cat sat on the mat!"}))
    out = DecontaminateJob([str(tmp_path / "t.jsonl")], str(tmp_path / "bench.json"), str(tmp_path / "out")).run(spark)
    n = {k: spark.read.json(p).count() for k, p in out.items()}
    assert n["decontaminated"] + n["contaminated"] + n["copies"] + n["rejected"] == len(good) + 2
    assert spark.read.text(out["rejected"]).filter(F.col("value").contains("{not json")).count() == 1
    m = spark.read.json(out["metrics"]).first()
    assert (m["n_total"], m["n_flagged"], m["n_rejected"], m["n_copies"]) == (2, 1, 2, 1)


def test_jobs_with_an_encoder(spark, tmp_path):
    from millrace.operators.embed import HashingCharEncoder
    from millrace.plans.jobs import DeduplicateJob
    _chats(tmp_path / "t.jsonl", [("the cat sat on the mat", "a"), ("the cat sat on the mat.", "b"),
                                  ("completely other words", "c")])
    (tmp_path / "bench.json").write_text(json.dumps({"k1": "The cat sat on the mats"}))
    d = DecontaminateJob([str(tmp_path / "t.jsonl")], str(tmp_path / "bench.json"), str(tmp_path / "dec"),
                         threshold=0.9, encoder=HashingCharEncoder).run(spark)
    assert [r["question"] for r in spark.read.json(d["decontaminated"]).collect()] == ["completely other words"]
    u = DeduplicateJob([str(tmp_path / "t.jsonl")], str(tmp_path / "dup"), threshold=0.9,
                       encoder=HashingCharEncoder).run(spark)
    assert [r["question"] for r in spark.read.json(u["deduplicated"]).collect()] == ["completely other words"]
    pairs = {(r["question"], r["match_question"]) for r in spark.read.json(u["duplicated"]).collect()}
    assert pairs == {("the cat sat on the mat", "the cat sat on the mat."), ("the cat sat on the mat.", "the cat sat on the mat")}
    plain = DeduplicateJob([str(tmp_path / "t.jsonl")], str(tmp_path / "tf"), threshold=0.9).run(spark)
    assert spark.read.json(plain["duplicated"]).count() == 2


def test_from_chats_to_packed_rows(spark, tmp_path, sf_small):
    """prepare, tokenize and pack, one after the other from the command line."""
    from millrace.operators.tokenize import export_model, learn_merges, vocab_from_merges
    from millrace.plans.cli import main
    from millrace.session import table
    merges = learn_merges(table(spark, sf_small, "benchmark"), "text", 100)
    paths = export_model(vocab_from_merges(merges), merges, str(tmp_path / "model"))
    _chats(tmp_path / "a.jsonl", [(f"question {i}", "<think>x</think><answer>" + "y " * i + "</answer>") for i in range(6)])
    model = ["--merges_file", paths["merges"]]
    prep = main(["prepare", "--json_file_paths", str(tmp_path / "a.jsonl"), "--output_dir", str(tmp_path / "p"), *model], spark)
    tok = main(["tokenize", "--input_path", prep["split"], "--output_dir", str(tmp_path / "t"), *model,
                "--vocab_file", paths["vocab"], "--seq_length", "4096"], spark)
    rows = spark.read.parquet(tok["tokenized"]).collect()
    assert len(rows) == 6 and all(len(r["input_ids"]) == len(r["labels"]) for r in rows)
    # the prompt is masked, the answer and its end are not
    assert all(r["labels"][0] == -100 and r["labels"][-2] == 151645 for r in rows)
    pack = main(["pack", "--input_path", tok["tokenized"], "--output_dir", str(tmp_path / "k"), "--seq_length", "4096"], spark)
    packed = spark.read.parquet(pack["packed"]).collect()
    assert sum(len(r["input_ids"]) for r in rows) == sum(p["actual_seq_len"][-1] for p in packed)


def test_own_pack_accounts_for_cut_tokens(spark):
    from millrace.operators.packing import pack_plan
    df = spark.createDataFrame([("a", 4), ("b", 25), ("c", 6)], "id string, len long")
    for policy in ("reject", "own_pack"):
        plan, rejected = pack_plan(df, "id", "len", seq_length=10, digits=1, oversize=policy)
        cut = rejected.agg(F.sum("n_cut")).first()[0]
        assert plan.agg(F.sum("len")).first()[0] + cut == 35
