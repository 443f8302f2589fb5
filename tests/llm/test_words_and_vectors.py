"""Spelling groups, impact-ordered search and whitening against brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import impact_search, spelling_variants, whitening
from tests.oracle_util import canonical, duck

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xC0, 0x100))
CLASHES = ("id", "word", "n", "near", "row", "v", "x", "score", "rank", "component", "shard", "root", "form")


def _frame(spark, rows, schema, parts=3):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    for c in CLASHES:
        df = df.withColumn(c, F.lit(1))
    return df


# 11 spelling variants

def _groups(rows, least=7, drop=31):
    """Brute force: all edits of every word."""
    count = Counter()
    for i, text in rows:
        run = ""
        for ch in (text or "") + " ":
            low = chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch
            if low in LETTERS:
                run += low
                continue
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if run and drop and h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                count[run] += 1
            run = ""
    words = {w: n for w, n in count.items() if n >= 2}
    gaps = {}
    for w in words:
        for k in range(len(w)):
            gaps.setdefault((w[:k], w[k + 1:]), set()).add(w)
    near = {w: set() for w in words}
    for (a, b), same in gaps.items():
        for w in same:
            near[w] |= same - {w}
            if a + b in words:
                near[w].add(a + b)
                near[a + b].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def _spelling_rows():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(7, 11))) for _ in range(12)]
    rows = []
    for i in range(400):
        words = []
        for _ in range(rng.randrange(0, 40)):
            w = base[min(11, int(rng.expovariate(0.5)))]
            if rng.random() < 0.15:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abß×ÿ") + w[k + 1:], w[:k] + rng.choice("ab") + w[k:]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "-", "\n", "1"]).join(words)))
    long = "".join(rng.choice("xyzÀ") for _ in range(3000))
    rows += [(1000, long), (1001, long + " " + long[1:]), (1002, long[1:] + " q" + long), (1003, "q" + long), (1003, "q" + long)]
    chain = ["letterforms", "letterform", "letterfrm", "leterfrm"]
    rows += [(2000 + k, " ".join(chain[:1] * 2000 + chain[1:2] * 180 + chain[2:3] * 18 + chain[3:] * 2)) for k in range(2)]
    return rows + [(3, "ALPHABET alphabet"), (3, "ALPHABET alphabet"), (None, "nullable nullable"), (None, None), (5, ""), (6, "a b c !")]


@pytest.mark.parametrize("filter_bytes", [64 << 20, 64])
def test_spelling_groups_match_brute_force(spark, filter_bytes):
    rows = _spelling_rows()
    want = _groups(rows)
    got = spelling_variants.spelling_groups(_frame(spark, rows, "doc_id long, text string"), filter_bytes=filter_bytes)
    assert {r["word"]: tuple(r)[1:] for r in got.collect()} == want
    assert want["leterfrm"][1] == "letterforms" and max(len(w) for w in want) > 2990
    assert sum(v[3] for v in want.values()) > 100


def test_filters_let_few_others_through(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(4000)]
    layout = spelling_variants.Filters({9: len(set(words))})
    h = spelling_variants.word_hashes(spelling_variants._codes(sorted(set(words)), 9))
    slot, mask = layout.places(9, h)
    layout.bits = np.zeros(layout.blocks * 8, np.uint64)
    np.bitwise_or.at(layout.bits, slot, mask)
    assert len(layout.maybe(9, h)) == len(h)
    others = ["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(20000)]
    wrong = spelling_variants._codes([w for w in others if w not in set(words)], 9)
    assert len(layout.maybe(9, spelling_variants.word_hashes(wrong))) < 0.01 * len(wrong)


def test_spelling_groups_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants.spelling_groups(empty).count() == 0


def test_spelling_groups_match_sql(spark, sf_small):
    got = spelling_variants.op11_spelling_variants(spark, sf_small).toPandas()
    assert canonical(got) == canonical(duck(sf_small).execute(spelling_variants.OP11_SQL).df())


# 12 impact-ordered search

def _scores(rows, k, every, scale=1024):
    """Brute force: (query id, rank, id, score) of every query row."""
    kept = [(i, [math.floor(c * scale) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = Counter()
    for a, (q, v) in enumerate(kept):
        if q is None or q % every:
            continue
        found = sorted(((-sum(x * y for x, y in zip(v, w)), i is None, i or 0, i) for b, (i, w) in enumerate(kept) if a != b))
        for rank, (s, _, _, i) in enumerate(found[:k]):
            out[q, rank + 1, i, -s] += 1
    return out


def _vector_rows():
    rng = random.Random(5)
    rows = [(i, [rng.choice([rng.uniform(-1, 1), round(rng.uniform(-1, 1), 1)]) for _ in range(6)]) for i in range(300)]
    rows += [(k, rows[10][1]) for k in range(300, 320)]  # ties
    rows += [rows[20], rows[20], (20, rows[30][1])]  # repeated rows and ids
    rows += [(None, rows[40][1]), (400, None), (410, [0.5, None, 1.0]), (420, [float("nan")] * 6), (430, [float("inf"), 0.0]),
             (440, []), (450, [0.5, -0.5]), (460, [0.0] * 6), (470, [9.0, -9.0, 3.0, 0.1, -0.1, 0.0])]
    return rows


@pytest.mark.parametrize("shard_cells,query_bytes", [(1 << 19, 16 << 20), (120, 500)])
def test_impact_topk_matches_brute_force(spark, shard_cells, query_bytes):
    rows = _vector_rows()
    df = _frame(spark, rows, "vec_id long, embedding array<double>")
    got = impact_search.impact_topk(df, "id % 10 = 0", shard_cells=shard_cells, query_bytes=query_bytes).collect()
    assert Counter(tuple(r) for r in got) == _scores(rows, 10, 10)


def test_search_stops_before_the_last_segment_and_on_proof():
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(size=(4000, 32)) * 100).astype(np.int64)
    vectors[:30] = vectors[7] + rng.integers(-3, 4, size=(30, 32))  # one query has close neighbours
    shard = impact_search.Shard.build(np.arange(4000), None, vectors)
    read = []
    for row in (7, 900):
        seen = []
        plain = shard.exact
        shard.exact = lambda q, p, plain=plain, seen=seen: (seen.append(len(p)), plain(q, p))[1]
        place, score = shard.search(row, vectors[row], 10)
        shard.exact = plain
        all_scores = vectors @ vectors[row]
        all_scores[row] = np.iinfo(np.int64).min
        least = np.sort(all_scores)[-10]
        assert sorted(place) == sorted(np.flatnonzero(all_scores >= least)) and (score == all_scores[place]).all()
        read.append(seen[-1])
    assert max(read) < 2000  # rows scored at the end, of 4,000


def test_impact_topk_with_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in impact_search.impact_topk(df, "id % 100 = 0").collect()] == [(0, 1, 1, 1024 * 512)]
    assert impact_search.impact_topk(df.limit(0), "id % 100 = 0").count() == 0


def test_impact_topk_matches_sql(spark, sf_small):
    got = impact_search.op12_impact_search(spark, sf_small).toPandas()
    assert canonical(got) == canonical(duck(sf_small).execute(impact_search.OP12_SQL).df())


# 13 whitening

def _check_whitening(got, rows, components=16):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in kept), default=0)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in list(v) + [0.0] * (dims - len(v))] for _, v in kept], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = (fit * n - total) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > e[0] * 1e-20).sum()), int(np.linalg.matrix_rank(centred)))
    assert len(got) == k * len(kept) and {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9
    table = {}
    for r in got:
        table.setdefault(r["component"], []).append(r)
    want_dev = Counter((i, int(d)) for (i, _), d in zip(kept, ((x * n - total) ** 2).sum(axis=1)))
    for c in range(1, k + 1):
        mine = table[c]
        assert Counter((r["vec_id"], r["deviation"]) for r in mine) == want_dev
        assert abs(mine[0]["explained"] * e.sum() / e[c - 1] - 1) < 1e-9
        alone = min(abs(e[c - 1] - e[j]) for j in range(len(e)) if j != c - 1) > 1e-6 * e[c - 1] if len(e) > 1 else True
        if alone:
            w = ((x * n - total) / n @ u[:, c - 1]) / math.sqrt(e[c - 1])
            by_row = sorted((i is None, i or 0, round(v, 6)) for (i, _), v in zip(kept, w))
            flipped = sorted((i is None, i or 0, round(-v, 6)) for (i, _), v in zip(kept, w))
            found = sorted((r["vec_id"] is None, r["vec_id"] or 0, round(r["whitened"], 6)) for r in mine)
            close = [np.allclose([f[2] for f in found], [b[2] for b in other], atol=2e-6) for other in (by_row, flipped)]
            assert any(close)


def test_whitening_matches_eigenvectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(200, 20)) * (0.9 ** np.arange(20))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [rows[5], rows[5], (7, rows[8][1]), (None, rows[9][1]), (500, None), (501, [1.0, None]), (502, [float("nan")] * 20),
             (503, [float("inf")] * 20), (504, []), (505, [0.25, -3.0])]
    got = whitening.whiten(_frame(spark, rows, "vec_id long, embedding array<double>", 11)).collect()
    _check_whitening(got, rows)


def test_whitening_of_few_dimensions_and_constant_ones(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(a), 2.5, float(b), float(a + b)]) for i, (a, b) in enumerate(rng.integers(-3, 4, size=(60, 2)))]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r["component"] for r in got} == {1, 2}
    _check_whitening(got, rows)


def test_whitening_without_spread(spark):
    one = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None)], "vec_id long, embedding array<float>")
    assert whitening.whiten(one).count() == 0
    assert whitening.whiten(one.limit(0)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [])], "vec_id long, embedding array<float>")).count() == 0


def test_whitening_on_the_table(spark, sf_small):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    _check_whitening(whitening.op13_whitening(spark, sf_small).collect(), rows)


@pytest.mark.parametrize("seed", range(6))
def test_singular_values_and_vectors(seed):
    rng = np.random.default_rng(seed)
    n = 24
    values = [np.r_[[5.0] * 6, [3.0] * 6, [1.0] * 12], 10.0 ** -np.linspace(0, 12, n), np.r_[rng.random(10), np.zeros(14)],
              np.linspace(1, 2, n), 1 + 1e-9 * rng.random(n), np.r_[1e6, rng.random(n - 1)]][seed]
    q = [np.linalg.qr(rng.normal(size=(n, n)))[0] for _ in range(2)]
    a = q[0] @ np.diag(values) @ q[1]
    e, v = whitening.right_singular(np.linalg.qr(a, mode="r"), 16)
    want = np.sort(values)[::-1][:len(e)] ** 2
    assert len(e) == min(16, int((values > 1e-13 * values.max()).sum()))
    assert np.allclose(e, want, rtol=1e-9 if seed != 1 else 1e-3, atol=1e-15 * want[0])
    assert np.abs(v.T @ v - np.eye(len(e))).max() < 1e-10
    assert np.abs(a.T @ (a @ v) - v * e).max() < 1e-12 * want[0]
