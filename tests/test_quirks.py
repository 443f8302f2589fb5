"""Golden rows: one small literal fixture per behaviour the pipeline must keep."""

import math

import pytest
from pyspark.sql import functions as F

from millrace import constants as C
from millrace.functions import arrays as A
from millrace.functions import text as TX
from millrace.functions.chat import render_chat, unknown_role_count
from millrace.operators.dedup import contamination_matches, dense_near_duplicates, drop_all_duplicates, exact_dedup
from millrace.operators.similarity import knn


# --- similarity thresholds -------------------------------------------------

def test_strict_threshold_and_empty_text(spark):
    # "x y" vs "x z": dot 1, norms sqrt(2) -> cosine exactly 0.5
    t = spark.createDataFrame([(1, "x y"), (2, "!!!"), (3, "x z")], "id long, text string")
    b = spark.createDataFrame([(10, "x z")], "item_id long, text string")
    at = {r["id"]: r["score"] for r in contamination_matches(t, b, "id", "text", "item_id", "text", 0.5).collect()}
    assert 1 not in at and 2 not in at and at[3] == pytest.approx(1.0)
    below = {r["id"] for r in contamination_matches(t, b, "id", "text", "item_id", "text", 0.49).collect()}
    assert below == {1, 3}


def test_dense_threshold_equal_is_kept_and_zero_vector(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0])], "id long, embedding array<double>")
    nn = {r["tid"]: (r["iid"], r["score"]) for r in knn(df, df, 1, "id", "id", exclude_self=True).collect()}
    assert nn[1] == (2, pytest.approx(1.0))
    assert nn[3][1] == 0.0  # zero vector stays zero: cosine 0 with everything
    flagged = dense_near_duplicates(df, "id", "embedding", 1.0).collect()
    assert flagged == []  # score equal to the threshold is not above it


def test_drop_all_removes_whole_cluster(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [0.99, 0.1, 0.0]), (3, [0.98, 0.0, 0.15]), (4, [0.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    pairs = dense_near_duplicates(df, "id", "embedding", 0.9)
    kept = [r["id"] for r in drop_all_duplicates(df, pairs, "id").collect()]
    assert kept == [4]


def test_ties_go_to_smallest_id(spark):
    t = spark.createDataFrame([(1, [1.0, 0.0])], "id long, embedding array<double>")
    ix = spark.createDataFrame([(9, [1.0, 0.0]), (5, [1.0, 0.0]), (7, [0.0, 1.0])], "id long, embedding array<double>")
    r = knn(t, ix, 2, "id", "id").orderBy(F.desc("score"), "iid").collect()
    assert [x["iid"] for x in r] == [5, 9]


# --- ids and exact dedup -------------------------------------------------------

def test_content_id_is_raw_text_hash(spark):
    import hashlib
    s = "  What is 1+1?  "
    got = spark.createDataFrame([(s,)], "t string").select(TX.content_id("t").alias("i")).first()["i"]
    assert got == hashlib.sha256(s.encode()).hexdigest()[:16]


def test_exact_dedup_keeps_first_position(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "question_id string, pos int, v string")
    got = {r["question_id"]: r["v"] for r in exact_dedup(df, "question_id", order_col="pos").collect()}
    assert got == {"a": "y", "b": "z"}


# --- chat shapes, tags, templates ---------------------------------------------

def test_positional_pick_and_rejects(spark):
    from millrace.plans.prepare import instruct_records
    rows = [
        ([{"from": "human", "value": "q1"}, {"from": "gpt", "value": "a1"}],),
        ([{"from": "system", "value": "sys"}, {"from": "human", "value": "q2"}],),
        ([{"from": "human", "value": "only"}],),
        ([],),
    ]
    df = spark.createDataFrame(rows, "conversations array<struct<from:string,value:string>>")
    pairs = df.select(TX.question_of().alias("question"), TX.answer_of().alias("answer"))
    got = [(r["question"], r["answer"]) for r in pairs.collect()]
    assert got == [("q1", "a1"), ("sys", "q2"), ("only", None), (None, None)]
    ok, rej = instruct_records(pairs)
    assert ok.count() == 2 and rej.count() == 2


def test_tag_repair_replaces_every_occurrence(spark):
    s = "<think>a<think>b</answer>c</answer>"
    got = spark.createDataFrame([(s,), ("plain",)], "t string").select(TX.repair_tags("t").alias("o")).collect()
    assert got[0]["o"] == "<think>\na<think>\nb\n</answer>c\n</answer>"
    assert got[1]["o"] == "plain"


def test_template_is_concat_safe(spark):
    q = "Use {{content}} and \\boxed{} here"
    got = spark.createDataFrame([(q,)], "q string").select(TX.apply_prompt("q").alias("i")).first()["i"]
    head, _, tail = C.USER_PROMPT.partition("{{content}}")
    assert got == C.SYSTEM_PROMPT + head + q + tail


def test_prompt_by_path(spark):
    df = spark.createDataFrame([("data/math.jsonl",), ("mathematics/code.jsonl",), ("code.jsonl",)], "p string")
    got = [r["x"] for r in df.select(TX.prompt_for_path("p").alias("x")).collect()]
    assert got == [C.USER_PROMPT_MATH, C.USER_PROMPT_MATH, C.USER_PROMPT]


def test_train_and_eval_templates_agree(spark):
    """instruction+output+newline of the prep path equals the chat render of [user q, assistant a]."""
    df = spark.createDataFrame([("Q?", "A.")], "q string, a string")
    prep = df.select(TX.message_text(TX.apply_prompt("q"), TX.close_turn("a")).alias("m")).first()["m"]
    msgs = F.array(F.struct(F.lit("user").alias("role"), F.col("q").alias("content")),
                   F.struct(F.lit("assistant").alias("role"), F.col("a").alias("content")))
    chat = df.select(render_chat(msgs).alias("c")).first()["c"]
    assert prep == chat


def test_tool_runs_and_unknown_roles(spark):
    msgs = [("user", "u"), ("tool", "t1"), ("tool", "t2"), ("assistant", "a"), ("tool", "t3"), ("robot", "x")]
    df = spark.createDataFrame([(msgs,)], "m array<struct<role:string,content:string>>")
    got = df.select(render_chat("m", add_generation_prompt=True).alias("r"), unknown_role_count("m").alias("n")).first()
    want = ("<|im_start|>system\n" + C.CHAT_DEFAULT_SYSTEM + "<|im_end|>\n"
            "<|im_start|>user\nu<|im_end|>\n"
            "<|im_start|>user\n<tool_response>\nt1\n</tool_response>\n<tool_response>\nt2\n</tool_response><|im_end|>\n"
            "<|im_start|>assistant\na<|im_end|>\n"
            "<|im_start|>user\n<tool_response>\nt3\n</tool_response><|im_end|>\n"
            "<|im_start|>assistant\n")
    assert got["r"] == want
    assert got["n"] == 1


def test_system_first_and_tool_calls(spark):
    from pyspark.sql import types as T
    schema = ("m array<struct<role:string,content:string,"
              "tool_calls:array<struct<name:string,arguments:string>>>>")
    msgs = [("system", "S", None), ("user", "u", None), ("assistant", "", [("f", '{"x": 1}')])]
    df = spark.createDataFrame([(msgs,)], schema)
    got = df.select(render_chat("m", with_tool_calls=True).alias("r")).first()["r"]
    want = ("<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nu<|im_end|>\n"
            '<|im_start|>assistant\n<tool_call>\n{"name": "f", "arguments": {"x": 1}}\n</tool_call><|im_end|>\n')
    assert got == want
    assert isinstance(T, object)


# --- lengths, markers, truncation ---------------------------------------------

def test_length_boundary(spark):
    df = spark.createDataFrame([(32767,), (32768,), (32769,)], "n int")
    assert [r["l"] for r in df.select(TX.is_long("n").alias("l")).collect()] == [False, True, True]


def test_truncation_keeps_first_n_plus_last_two(spark):
    df = spark.createDataFrame([(list(range(10)),), (list(range(4)),)], "ids array<int>")
    got = [r["t"] for r in df.select(A.truncate_keep_tail("ids", 5).alias("t")).collect()]
    assert got == [[0, 1, 2, 3, 4, 8, 9], [0, 1, 2, 3]]


@pytest.mark.parametrize("ids,start", [
    ([151644, 77091, 198, 5, 6], 3),                       # at start
    ([1, 151644, 872, 198, 151644, 77091, 198, 7], 7),     # middle, after a user block
    ([151644, 77091, 198, 151644, 77091, 198, 9], 3),      # twice: first wins
    ([1, 2, 3], 0),                                        # absent: nothing masked
    ([1, 2, 151644], 0),                                   # marker is the last id
    ([], 0),
])
def test_answer_start(spark, ids, start):
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    assert df.select(A.answer_start("ids").alias("s")).first()["s"] == start


def test_labels_and_overflow(spark):
    from millrace.operators.labels import build_labels, split_valid
    rows = [(1, [151644, 77091, 198, 5, 6]), (2, [1] * 6 + [151644, 77091, 198, 4])]
    df = spark.createDataFrame(rows, "id int, input_ids array<int>")
    lab = build_labels(df, limit=5).orderBy("id").collect()
    assert lab[0]["labels"] == [-100, -100, -100, 5, 6] and not lab[0]["mask_overflow"]
    # start 9 lies past the truncated length 7 (5 + 2): labels are longer, flagged
    assert lab[1]["answer_start"] == 9 and lab[1]["mask_overflow"] and lab[1]["clipped"]
    ok, bad = split_valid(build_labels(df, limit=5))
    assert ok.count() == 1 and bad.count() == 1


# --- pre-tokenizer -------------------------------------------------------------

UNICODE_CASES = ["I'll go", "a b", "x　y", "p\u0085q", "r\u001cs", "12 ½ १२",
                 "été", "l1\r\n\r\nl2  \n x", "It's  THE'S 've", "tab\tend   "]


def test_pretokens_match_python_regex(spark):
    import regex
    pat = regex.compile(C.PRETOKENIZE_REGEX)
    df = spark.createDataFrame([(s,) for s in UNICODE_CASES], "t string")
    got = [r["p"] for r in df.select(TX.pretokens("t").alias("p")).collect()]
    assert got == [pat.findall(s) for s in UNICODE_CASES]


def test_special_tokens_kept_whole(spark):
    from millrace.operators.tokenize import pretokens_with_specials
    s = "a <|im_start|>user\nhi<|im_end|>"
    got = spark.createDataFrame([(s,)], "t string").select(pretokens_with_specials("t").alias("p")).first()["p"]
    assert got == ["a", " ", "<|im_start|>", "user", "\n", "hi", "<|im_end|>"]


# --- merges file ------------------------------------------------------------------

def test_merges_comment_modes(spark, tmp_path):
    from millrace.sources.chats import read_merges
    p = tmp_path / "merges.txt"
    p.write_text("#version: 0.2\na b\n\n# #\nc d\na b\n", encoding="utf-8")
    any_hash = {(r["left"], r["right"]): r["rank"] for r in read_merges(spark, str(p), "any_hash").collect()}
    assert any_hash == {("a", "b"): 2, ("c", "d"): 1}  # repeated pair: last rank wins
    header = {(r["left"], r["right"]): r["rank"] for r in read_merges(spark, str(p), "header_only").collect()}
    assert header == {("a", "b"): 3, ("#", "#"): 1, ("c", "d"): 2}


def test_bytes_table_is_a_bijection():
    t = C.bytes_to_unicode_table()
    assert len(t) == 256 and len(set(t.values())) == 256
    assert t[ord("A")] == "A" and t[ord(" ")] == chr(256 + 32)


# --- packing, feed, reports --------------------------------------------------------

def test_pack_edges(spark):
    from millrace.operators.packing import pack_plan, pack_summary
    lens = [(1, 10), (2, 11), (3, 0)] + [(100 + i, 1) for i in range(200)]
    df = spark.createDataFrame(lens, "id long, len long")
    plan, rej = pack_plan(df, "id", "len", seq_length=10, max_segments=128, digits=1)
    assert [r["id"] for r in rej.collect()] == [2]
    s = pack_summary(plan, "id", 10).collect()
    assert sum(r["n_tokens"] for r in s) == 10 + 200
    assert max(r["n_segments"] for r in s) <= 128 and max(r["n_tokens"] for r in s) <= 10
    full = [r for r in s if 1 in r["ids"]]
    assert full[0]["n_segments"] in (1, 2)  # the length-N sample fills a pack (with at most the empty one)


def test_shard_remainder(spark):
    from millrace.operators.feed import seeded_rank, shard
    df = spark.range(17).withColumnRenamed("id", "doc_id")
    s = shard(seeded_rank(df, "doc_id"), 8)
    counts = {r["shard"]: r["count"] for r in s.groupBy("shard").count().collect()}
    assert s.count() == 16 and set(counts.values()) == {2} and len(counts) == 8


def test_seeded_rank_is_a_permutation_and_partition_independent(spark):
    from millrace.operators.feed import seeded_rank
    a = seeded_rank(spark.range(300).withColumnRenamed("id", "d"), "d")
    b = seeded_rank(spark.range(300).withColumnRenamed("id", "d").repartition(7), "d")
    ra = {r["d"]: r["rank"] for r in a.collect()}
    rb = {r["d"]: r["rank"] for r in b.collect()}
    assert ra == rb and sorted(ra.values()) == list(range(300))


def test_avg_at_k_is_mean_of_means(spark):
    from millrace.operators.reports import avg_at_k
    rows = [("q1", 1), ("q1", 1), ("q1", 1), ("q1", 0), ("q2", 1), ("q2", 0)]
    df = spark.createDataFrame(rows, "q string, c int")
    assert avg_at_k(df, "q", "c").first()["avg_at_k"] == pytest.approx((0.75 + 0.5) / 2)


def test_padded_length_rule(spark):
    df = spark.createDataFrame([(1,), (2,), (33,), (34,), (100,)], "m int")
    got = [r["l"] for r in df.select(A.padded_length("m").alias("l")).collect()]
    assert got == [1, 33, 33, 65, 129]
    assert all(x % 32 == 1 for x in got)


def test_histogram_constant_lengths(spark):
    from millrace.operators.reports import length_histogram
    df = spark.createDataFrame([(7,), (7,)], "n int")
    h = length_histogram(df, "n").collect()
    assert len(h) == 100 and sum(r["n"] for r in h) == 2
    mid = [r for r in h if r["n"] > 0][0]
    assert mid["bin"] == 50 and math.isclose(mid["lo"], 7.0) is True


def test_text_near_duplicates_equal_brute_force(spark):
    from itertools import permutations
    from collections import Counter
    import re as _re
    from millrace.operators.dedup import text_near_duplicates
    texts = ["the cat sat on the mat", "the cat sat on a mat", "a cat sat on the mat today",
             "dogs bark loudly at night", "dogs bark loudly at noon", "completely different words here", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: (r["match_id"], round(r["score"], 9))
           for r in text_near_duplicates(df, "id", "text", 0.7).collect()}
    vec = [Counter(_re.findall(r"\w+", t.lower())) for t in texts]
    def cos(a, b):
        d = sum(a[k] * b.get(k, 0) for k in a)
        na, nb = sum(v * v for v in a.values()), sum(v * v for v in b.values())
        return d / math.sqrt(na * nb) if na and nb else 0.0
    want = {}
    for i, j in permutations(range(len(texts)), 2):
        s = cos(vec[i], vec[j])
        if s > 0.7 and (i not in want or (s, -j) > (want[i][1], -want[i][0])):
            want[i] = (j, round(s, 9))
    assert got == want and len(want) >= 4


def test_tool_json_has_the_templates_form(spark):
    from millrace.functions.chat import system_head, template_json
    df = spark.createDataFrame([(["{\"name\":\"f\",\"x\":null,\"t\":\"é\"}"],)], "tools array<string>")
    df = df.withColumn("messages", F.expr("array(named_struct('role', 'user', 'content', 'hi'))"))
    text = df.withColumn("tools", template_json(df, "tools")).select(
        system_head("messages", "sys", "tools").alias("t")).first()["t"]
    assert '\n{"name": "f", "x": null, "t": "é"}\n</tools>' in text
    structs = spark.sql("SELECT array(named_struct('name', 'f', 'x', CAST(NULL AS INT))) AS tools")
    assert structs.select(template_json(structs, "tools").alias("t")).first()["t"] == ['{"name": "f", "x": null}']
