"""Bounds of the blocked and banded searches: exact results from small blocks, work that does not grow with the copies."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from millrace.operators import similarity


def _texts(n=160):
    rng = random.Random(5)
    common = [f"w{i}" for i in range(12)]
    base = [[rng.choice(common) for _ in range(20)] + [f"r{rng.randrange(400)}" for _ in range(6)] for _ in range(n // 4)]
    out = []
    for words in base:
        for _ in range(4):  # near copies, some with the same bag of words
            copy = words[:]
            copy[rng.randrange(len(copy))] = f"r{rng.randrange(400)}"
            out.append(" ".join(rng.sample(copy, len(copy))))
    return out + [out[0].upper(), out[1] + " " + out[1], "", None]


@pytest.mark.parametrize("threshold", [0.0, 0.9])
def test_text_search_in_small_blocks_equals_brute_force(spark, monkeypatch, threshold):
    monkeypatch.setattr(similarity, "HEAD_TERMS", 5)
    monkeypatch.setattr(similarity, "TAIL_BUCKETS", 3)
    texts = _texts()
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["tid"]: (r["iid"], r["score"]) for r in
           similarity.tf_self_top1(df, "id", "text", block_rows=40, threshold=threshold).collect()}
    bags = [Counter((t or "").lower().split()) for t in texts]
    norm = [sum(v * v for v in b.values()) for b in bags]
    want = {}
    for i, a in enumerate(bags):
        scores = [(-sum(v * b[k] for k, v in a.items()) / math.sqrt(norm[i] * norm[j]), j)
                  for j, b in enumerate(bags) if j != i and norm[i] and norm[j]]
        if scores and -min(scores)[0] > threshold:
            want[i] = (min(scores)[1], -min(scores)[0])
    assert got == want and len(want) > 20


def test_a_text_goes_to_few_groups():
    """0.1 GB of documents are 47,257 distinct texts: each went to 190 groups of 500 texts a side."""
    assert similarity.block_count(47_257, similarity.TEXT_BLOCK_ROWS) <= 8
    assert similarity.block_count(10, similarity.TEXT_BLOCK_ROWS) == similarity.block_count(0, 5) == 1


def test_lsh_candidates_do_not_grow_with_the_square_of_the_rows():
    def per_row(rows):  # unrelated vectors that a vector meets in all bands
        bits, bands = similarity.lsh_sizes(rows, 0.9)
        p = 1.0 - math.acos(0.9) / math.pi
        assert 1.0 - (1.0 - p ** bits) ** bands >= 0.99
        return bands * rows / 2 ** bits
    assert per_row(1_200_000) <= 4 * per_row(20_000) and per_row(1_200_000) <= 50


def test_a_vector_goes_to_few_groups():
    assert similarity.block_count(615_360, similarity.PAIR_BLOCK_ROWS) <= 40


def test_copies_give_all_their_pairs(spark):
    df = spark.createDataFrame([(f"v{i:03}", [1.0, 2.0]) for i in range(90)] + [(None, [1.0, 2.0]), ("z", None)],
                               "id string, embedding array<double>")
    got = [(r["a"], r["b"]) for r in similarity.dense_pairs(df, 0.5, block_rows=20).collect()]
    assert len(got) == len(set(got)) == 90 * 89 // 2 and all(a < b for a, b in got)


def test_exact_search_holds_little_at_once():
    assert similarity.BROADCAST_MATRIX_BYTES <= 16 << 20 and similarity.BLOCK_ROWS <= 25_000
    assert similarity._chunk_rows(similarity.BLOCK_ROWS) * similarity.BLOCK_ROWS * 8 <= 16 << 20


@pytest.mark.parametrize("k", [1, 2, 9])
def test_top_k_keeps_ties_to_the_smallest_id(k):
    rng = np.random.default_rng(3)
    scores = rng.integers(0, 4, (20, 7)).astype(float)
    mask = rng.random((20, 7)) < 0.2
    want = [(i, j, scores[i, j]) for i in range(20) for j in
            sorted((j for j in range(7) if not mask[i, j]), key=lambda j: (-scores[i, j], j))[:k]]
    a, b, c = similarity._topk_rows(scores.copy(), np.arange(20), np.arange(7), k, False, self_mask=mask)
    assert list(zip(a, b, c)) == want


def test_narrow_passes_take_bounded_slices():
    import pyarrow as pa
    from millrace.operators.tokenize import NARROW_BYTES, ByteEncoder, _pieces
    texts = ["x" * NARROW_BYTES, None, "a", "y" * (3 * NARROW_BYTES), "", "z" * NARROW_BYTES]
    parts = list(_pieces(pa.RecordBatch.from_arrays([pa.array(texts)], ["t"]), "t"))
    assert [x for p in parts for x in p.column("t").to_pylist()] == texts and len(parts) >= 3
    ids = [[1] * (NARROW_BYTES // 4), None, [], [2, None], [3] * (NARROW_BYTES // 2)]
    parts = list(_pieces(pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int32()))], ["t"]), "t"))
    assert [x for p in parts for x in p.column("t").to_pylist()] == ids and len(parts) >= 2
    assert ByteEncoder.MEMO <= 30_000


def test_chat_samples_are_made_once(spark, sf_small, monkeypatch):
    from millrace.plans import catalog
    written = []
    keep = catalog.cut_lineage
    monkeypatch.setattr(catalog, "cut_lineage", lambda df, name="stage": written.append(name) or keep(df, name))
    assert catalog.QUERIES["packed_samples"](spark, sf_small).count() and written.count("chat-samples") == 1
