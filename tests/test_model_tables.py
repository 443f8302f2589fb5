"""Vocabulary/merges export, added tokens, rank gaps; the pluggable encoder."""

import json

from pyspark.sql import functions as F

from millrace import constants as C
from millrace.operators.embed import HashingCharEncoder, embed
from millrace.operators.similarity import knn
from millrace.operators.tokenize import add_tokens, export_model, merge_rank_gaps, vocab_size
from millrace.sources.chats import read_json_map, read_merges


def test_export_roundtrip_and_gaps(spark, tmp_path):
    vocab = spark.createDataFrame([("b", 1), ("a", 0), ("ab", 2)], "token string, id int")
    merges = spark.createDataFrame([("a", "b", 0), ("ab", "c", 1), ("x", "y", 3)], "left string, right string, rank long")
    assert [r["rank"] for r in merge_rank_gaps(merges).collect()] == [3]
    paths = export_model(vocab, merges, str(tmp_path / "model"))
    vtext = "".join(p.read_text() for p in (tmp_path / "model" / "vocab").glob("part-*"))
    assert json.loads(vtext) == {"a": 0, "ab": 2, "b": 1} and vtext.index('"a"') < vtext.index('"b"')
    mlines = "".join(p.read_text() for p in sorted((tmp_path / "model" / "merges").glob("part-*"))).splitlines()
    assert mlines == [C.MERGES_VERSION_HEADER, "a b", "ab c", "x y"]
    back = {(r["left"], r["right"]): r["rank"] for r in read_merges(spark, paths["merges"] + "/*").collect()}
    assert back == {("a", "b"): 0, ("ab", "c"): 1, ("x", "y"): 2}
    v2 = {r["key"]: r["value"] for r in read_json_map(spark, paths["vocab"] + "/*", value_type="int").collect()}
    assert v2 == {"a": 0, "ab": 2, "b": 1}


def test_added_tokens_win(spark):
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "token string, id int")
    added = spark.createDataFrame([("b", 9), ("<x>", 10)], "token string, id int")
    merged = add_tokens(vocab, added)
    assert {r["token"]: r["id"] for r in merged.collect()} == {"a": 0, "b": 9, "<x>": 10}
    assert vocab_size(merged) == 3


def test_pluggable_encoder(spark):
    df = spark.createDataFrame([(1, "the cat sat"), (2, "the cat sat!"), (3, "quantum flux")], "id long, text string")
    e = embed(df, "text", lambda: HashingCharEncoder(64))
    norms = [sum(x * x for x in r["embedding"]) for r in e.collect()]
    assert all(abs(n - 1.0) < 1e-5 for n in norms)
    nn = {r["tid"]: r["iid"] for r in knn(e, e, 1, "id", "id", exclude_self=True).collect()}
    assert nn[1] == 2 and nn[2] == 1
