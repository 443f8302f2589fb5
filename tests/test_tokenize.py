"""BPE against an independent library implementation; vocabulary lookups."""

import pytest
from pyspark.sql import functions as F

from millrace import constants as C
from millrace.operators.tokenize import (bpe_encode, decode_bpe, learn_merges, nfc, token_counts_bpe,
                                         vocab_from_merges, word_vocab, encode_tokens, decode_ids)
from millrace.session import table


@pytest.fixture(scope="module")
def model(spark, sf_small):
    merges = learn_merges(table(spark, sf_small, "benchmark"), "text", 150)
    return merges, vocab_from_merges(merges)


def test_bpe_matches_tokenizers_library(spark, sf_small, model):
    tokenizers = pytest.importorskip("tokenizers")
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers
    merges, vocab = model
    mp = merges.orderBy("rank").toPandas()
    vd = {r["token"]: int(r["id"]) for r in vocab.collect()}
    tok = Tokenizer(models.BPE(vocab=vd, merges=list(zip(mp["left"], mp["right"]))))
    tok.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(C.PRETOKENIZE_REGEX), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    conv = table(spark, sf_small, "conversations").select("conv_id", "turn", "text")
    got = {(r["conv_id"], r["turn"]): list(r["ids"])
           for r in bpe_encode(conv, ["conv_id", "turn"], "text", merges, vocab).collect()}
    texts = {(r["conv_id"], r["turn"]): r["text"] for r in conv.collect()}
    assert len(got) == len(texts)
    for k, t in texts.items():
        assert got[k] == tok.encode(t).ids, k


def test_counts_equal_encoded_lengths(spark, sf_small, model):
    merges, vocab = model
    docs = table(spark, sf_small, "documents").select("doc_id", "text")
    a = {r["doc_id"]: r["n_tokens"] for r in token_counts_bpe(docs, ["doc_id"], "text", merges).collect()}
    b = {r["doc_id"]: r["n_tokens"] for r in bpe_encode(docs, ["doc_id"], "text", merges, vocab).collect()}
    assert a == b


def test_specials_and_roundtrip(spark, model):
    merges, vocab = model
    texts = [(1, "<|im_start|>user\nCafé ½ 你好<|im_end|>\n"), (2, ""), (3, "é decomposed")]
    df = spark.createDataFrame(texts, "id int, text string").select("id", nfc("text").alias("text"))
    enc = bpe_encode(df, ["id"], "text", merges, vocab)
    ids = {r["id"]: list(r["ids"]) for r in enc.collect()}
    assert ids[1][0] == 151644 and ids[1][-2] == 151645 and ids[2] == []
    dec = {r["id"]: r["text"] for r in decode_bpe(enc, ["id"], "ids", vocab).collect()}
    src = {r["id"]: r["text"] for r in df.collect()}
    assert dec == src and src[3].startswith("é")
    nospec = {r["id"]: r["text"] for r in decode_bpe(enc, ["id"], "ids", vocab, skip_special=True).collect()}
    assert nospec[1] == "user\nCafé ½ 你好\n"


def test_vocab_lookup_with_unk(spark):
    bench = spark.createDataFrame([("b a",)], "text string")
    vocab = word_vocab(bench, "text")
    assert sorted((r["token"], r["id"]) for r in vocab.collect()) == [("a", 0), ("b", 1)]
    df = spark.createDataFrame([(1, ["a", "z", "b"]), (2, [])], "id int, toks array<string>")
    enc = {r["id"]: (list(r["ids"]), r["n_oov"]) for r in encode_tokens(df, ["id"], "toks", vocab).collect()}
    assert enc == {1: ([0, None, 1], 1), 2: ([], 0)}
    back = encode_tokens(df, ["id"], "toks", vocab, unk_id=-1)
    dec = {r["id"]: r["text"] for r in decode_ids(back, ["id"], "ids", vocab, skip_ids=[-1]).collect()}
    assert dec == {1: "a b", 2: ""}


def _plain_merge(symbols, ranks):
    """The textbook loop: merge every occurrence of the lowest-ranked pair until none applies."""
    word = list(symbols)
    while True:
        known = [(ranks[p], p) for p in zip(word, word[1:]) if p in ranks]
        if not known:
            return word
        pair = min(known)[1]
        out, i = [], 0
        while i < len(word):
            if tuple(word[i:i + 2]) == pair:
                out.append(word[i] + word[i + 1])
                i += 2
            else:
                out.append(word[i])
                i += 1
        word = out


def test_heap_merge_equals_plain_merge():
    import random
    from millrace.operators.tokenize import _bpe_word
    rng = random.Random(4)
    for _ in range(300):
        made = ["a", "b", "c"]
        ranks = {}
        for r in range(rng.randrange(0, 25)):
            pair = rng.choice(made), rng.choice(made)
            ranks.setdefault(pair, rng.randrange(12) if rng.random() < 0.2 else r)
            made.append("".join(pair))
        # equal ranks of different pairs are no merge table: make them distinct
        ranks = {p: i for i, (p, _) in enumerate(sorted(ranks.items(), key=lambda x: (x[1], x[0])))}
        word = [rng.choice("abc") for _ in range(rng.randrange(0, 40))]
        assert _bpe_word(word, ranks) == _plain_merge(word, ranks)


def test_long_word_is_merged_in_reasonable_time():
    import time
    from millrace.operators.tokenize import _bpe_word
    t = time.time()
    out = _bpe_word(["a"] * 300_000, {("a", "a"): 0, ("aa", "aa"): 1, ("aaaa", "aaaa"): 2})
    assert len(out) == 37_500 and time.time() - t < 20


@pytest.mark.parametrize("partitions", [1, 4, 8])
def test_merge_ranks_of_a_large_file(spark, tmp_path, partitions):
    from millrace.operators.feed import global_rank
    from millrace.sources.chats import read_merges
    n = 151_000
    path = tmp_path / "merges.txt"
    path.write_text("#version: 0.2\n" + "".join(f"l{i} r{i}\n" for i in range(n)))
    m = read_merges(spark.newSession(), str(path))
    wrong = m.filter((F.concat(F.lit("l"), F.col("rank").cast("string")) != F.col("left"))
                     | (F.concat(F.lit("r"), F.col("rank").cast("string")) != F.col("right"))).count()
    assert m.count() == n and wrong == 0
    ranked = global_rank(m.select(F.col("rank").alias("x"), "left"), ["x"], "place", partitions=partitions)
    assert ranked.filter(F.col("x") != F.col("place")).count() == 0


def test_merges_file_with_windows_line_ends(spark, tmp_path):
    from millrace.sources.chats import read_merges
    path = tmp_path / "merges.txt"
    path.write_bytes(b"#version: 0.2\r\na b\r\n\r\n  ab \tc  \r\n# note\r\na b\r\n")
    got = {(r["left"], r["right"]): r["rank"] for r in read_merges(spark, str(path)).collect()}
    assert got == {("a", "b"): 2, ("ab", "c"): 1}


def test_counts_of_templated_and_decomposed_texts(spark, model):
    from millrace.operators.tokenize import pretoken_counts
    merges, vocab = model
    texts = [(1, "<|im_start|>user\nhi<|im_end|>\n"), (2, "café café"), (3, "café café"), (4, None),
             (5, "<think>x</think><tool_call>")]
    df = spark.createDataFrame(texts, "id int, text string")
    n = {r["id"]: r["n_tokens"] for r in token_counts_bpe(df, ["id"], "text", merges).collect()}
    enc = {r["id"]: list(r["ids"]) for r in bpe_encode(df, ["id"], "text", merges, vocab).collect()}
    assert n == {k: len(v) for k, v in enc.items()}
    assert enc[2] == enc[3] and n[4] == 0 and enc[5][0] == 151667 and enc[5][-1] == 151657
    pre = {r["id"]: r["n_pretokens"] for r in pretoken_counts(df.na.fill(""), "text").collect()}
    assert pre[1] == 6 and pre[5] == 4


def test_encoding_needs_no_shuffle(spark, model):
    merges, vocab = model
    df = spark.range(5).select("id", F.lit("a b").alias("text"))
    for plan in (bpe_encode(df, ["id"], "text", merges, vocab), token_counts_bpe(df, ["id"], "text", merges)):
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
