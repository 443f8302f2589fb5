"""Best-fit packing, padded batches, segment numbers, narrow lookups and calibrated clustered search."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import clustered
from millrace.operators.feed import padded_batches
from millrace.operators.packing import best_fit_plan, materialize_packs, pack_plan
from millrace.operators.similarity import knn, lsh_pairs
from millrace.operators.tokenize import decode_ids, encode_tokens


def _samples(spark, n=600, top=90, parts=5):
    rng = random.Random(2)
    rows = [(f"s{i}", rng.choice([rng.randrange(0, top), rng.randrange(0, 12), 0, 101, 100])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id string, len int").repartition(parts)


def _check_plan(plan, rows, limit, max_segments):
    packs = {}
    for r in plan:
        packs.setdefault((r["bucket"], r["pack_no"]), []).append((r["seg"], r["offset"], r["len"], r["id"]))
    lengths = dict(rows)
    for members in packs.values():
        members.sort()
        assert [m[0] for m in members] == list(range(len(members))) and len(members) <= max_segments
        at = 0
        for _, offset, n, key in members:
            assert offset == at and n == lengths[key]
            at += n
        assert at <= limit
    assert sorted(r["id"] for r in plan) == sorted(k for k, n in rows if n <= limit)
    return packs


@pytest.mark.parametrize("digits,max_segments", [(0, 128), (1, 128), (2, 5), (3, 128)])
def test_best_fit_fills_more_than_next_fit(spark, digits, max_segments):
    rows, df = _samples(spark)
    plan, rejected = best_fit_plan(df, "id", "len", 100, max_segments, digits)
    best = _check_plan(plan.collect(), rows, 100, max_segments)
    assert sorted((r["id"], r["n_cut"]) for r in rejected.collect()) == sorted((k, n) for k, n in rows if n > 100)
    half = [p for p in best.values() if sum(m[2] for m in p) * 2 <= 100 and len(p) < max_segments]
    assert len(half) <= 1
    other, left = pack_plan(df, "id", "len", 100, max_segments, digits)
    assert len(best) < len(_check_plan(other.collect(), rows, 100, max_segments))
    assert {r["id"] for r in left.collect()} == {k for k, n in rows if n > 100}


def test_best_fit_does_not_depend_on_the_partitions(spark):
    _, a = _samples(spark, parts=1)
    _, b = _samples(spark, parts=7)
    found = [sorted(map(tuple, best_fit_plan(x, "id", "len", 100, digits=1)[0].collect())) for x in (a, b)]
    assert found[0] == found[1]
    found = [sorted(map(tuple, pack_plan(x, "id", "len", 100, digits=1)[0].collect())) for x in (a, b)]
    assert found[0] == found[1]


def test_packing_of_an_empty_table(spark):
    none = spark.createDataFrame([], "id string, len int")
    assert best_fit_plan(none, "id", "len", 100)[0].count() == 0 and pack_plan(none, "id", "len", 100)[0].count() == 0


def test_segment_numbers_restart_in_every_pack(spark):
    rows = [(i, list(range(i * 10, i * 10 + n)), [-100] * n) for i, n in enumerate([3, 4, 2, 0, 5])]
    df = spark.createDataFrame(rows, "id int, input_ids array<int>, labels array<int>")
    plan, _ = pack_plan(df.select("id", F.size("input_ids").alias("len")), "id", "len", 8, digits=0)
    for r in materialize_packs(plan, df, "id", 8).collect():
        ends = list(r["actual_seq_len"])
        want = [k for k, (a, b) in enumerate(zip([0, *ends], ends)) for _ in range(b - a)]
        assert r["segment_ids"] == want + [-1] * (8 - len(want)) and len(r["input_ids"]) == 8
        same = [i for i, s in enumerate(r["segment_ids"]) if s >= 0 and r["position_ids"][i] == 0]
        assert len(same) == len([1 for a, b in zip([0, *ends], ends) if b > a])


def test_padded_batches(spark):
    rows = [(b, i, list(range(n)), [7] * n) for i, (b, n) in enumerate([(0, 3), (0, 33), (1, 1), (1, 0), (2, 34)])]
    rows.append((2, 99, None, None))
    df = spark.createDataFrame(rows, "batch long, id int, input_ids array<int>, labels array<int>")
    got = {r["id"]: r for r in padded_batches(df, divisor=32, remainder=1, pad_id=5).collect()}
    assert {i: r["padded_len"] for i, r in got.items()} == {0: 33, 1: 33, 2: 1, 3: 1, 4: 65, 99: 65}
    for b, i, ids, labels in rows:
        r, n = got[i], len(ids or [])
        full = r["padded_len"]
        assert r["input_ids"] == (ids or []) + [5] * (full - n) and r["labels"] == (labels or []) + [-100] * (full - n)
        assert r["attention_mask"] == [1] * n + [0] * (full - n)


def test_narrow_lookups_equal_the_joined_ones(spark):
    vocab = spark.createDataFrame([("a", 3), ("b", 1), ("ß", 7), ("", 9)], "token string, id int")
    rows = [(1, ["a", "b", "zz", "ß"]), (2, []), (3, None), (4, ["zz", None, ""]), (5, ["b"] * 5000)]
    df = spark.createDataFrame(rows, "k long, toks array<string>").repartition(3)
    for unk in (None, -1):
        small, joined = (encode_tokens(df, ["k"], "toks", vocab, unk_id=unk, broadcast_bytes=b) for b in (None, 0))
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, joined.collect()))
        assert "Exchange" not in small._jdf.queryExecution().executedPlan().toString().replace("REPARTITION_BY_NUM", "").split(
            "MapInArrow")[0]
    small = encode_tokens(df, ["k"], "toks", vocab, unk_id=-1)
    texts = [{r["k"]: r["text"] for r in decode_ids(small, ["k"], "ids", vocab, skip_ids=[9], broadcast_bytes=b).collect()}
             for b in (None, 0)]
    assert texts[0] == texts[1] and texts[0][1] == "a b ß" and texts[0][2] == "" and texts[0][4] == ""


def _vectors(spark, n=900, dims=16, clusters=12):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(clusters, dims))
    rows = [(int(i), [float(x) for x in centres[i % clusters] + 0.5 * rng.normal(size=dims)]) for i in range(n)]
    rows += [(n, None), (None, rows[0][1]), (n + 1, [0.0] * dims)] + [(n + 2 + k, rows[5][1]) for k in range(40)]
    return spark.createDataFrame(rows, "id long, embedding array<double>").repartition(4)


def test_calibrated_search_reaches_its_recall(spark):
    df = _vectors(spark)
    index = clustered.build_clustered_index(df)
    queries = df.filter("id % 3 = 0")
    found = clustered.clustered_search(queries, index, 5, recall=0.9, exclude_self=True)
    got = {(r["tid"], r["iid"]): r["score"] for r in found.collect()}
    known = df.filter("id IS NOT NULL AND embedding IS NOT NULL")
    exact = {(r["tid"], r["iid"]): r["score"] for r in knn(queries.filter("embedding IS NOT NULL"), known, 5,
                                                          exclude_self=True).collect()}
    assert 1 <= index.probes < index.lists and index.lists > 20
    assert sum(p in got for p in exact) >= 0.9 * len(exact)
    assert all(abs(got[p] - exact[p]) < 1e-12 for p in exact if p in got)


def test_calibrated_search_with_every_list_is_exact_and_empty_is_empty(spark):
    df = _vectors(spark, n=200)
    index = clustered.build_clustered_index(df, lists=9)
    found = clustered.clustered_search(df, index, 2, probes=index.lists, exclude_self=True, block_rows=30)
    known = df.filter("id IS NOT NULL AND embedding IS NOT NULL")
    exact = knn(known, known, 2, exclude_self=True)
    scores = [sorted((r["tid"], round(r["score"], 9)) for r in x.collect()) for x in (found, exact)]  # copies tie
    assert scores[0] == scores[1]
    none = clustered.build_clustered_index(df.limit(0))
    assert clustered.clustered_search(df.limit(0), none, 2).count() == 0


def test_lsh_pairs_are_distinct_and_exact(spark):
    df = _vectors(spark, n=150)
    found = [(r["a"], r["b"]) for r in lsh_pairs(df, 0.95).collect()]
    assert len(found) == len(set(found)) and all(a < b for a, b in found)
    copies = {(a, b) for a in (5, *range(152, 192)) for b in (5, *range(152, 192)) if a < b}
    assert copies <= set(found)
