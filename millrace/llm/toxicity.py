"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text (letters lower-cased, punctuation trimmed) and
their first letters, hashed to 48 bits. The terms that tell the labels apart
best become the machine's inputs (present or not); it learns a weight for each
and, through short factor vectors, one for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import crc_mod, hash_strings, mix64, read, slices, split_words, word_codes

#: Labelled rows of each class that the machine is fitted on, at most (a hash-ordered sample).
FIT_ROWS_PER_CLASS = 5000
#: Terms the machine sees: those with the strongest link to the label.
FIT_TERMS = 768
FACTORS = 6
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
_TRIM = "\"'()[]{}<>.,;:!?%*#$&|~_-+=/\\`^@"
_BITS = np.uint64((1 << 48) - 1)


def _distinct_terms(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a list of distinct words: (term hash, index of the word), aligned."""
    clean = pc.utf8_trim(pc.utf8_lower(words), _TRIM)
    length = pc.utf8_length(clean).to_numpy(zero_copy_only=False)
    index = np.arange(len(words))
    hashes, owners = [hash_strings(clean)[length > 0]], [index[length > 0]]
    for n in PREFIXES:
        # a word as short as the prefix is already a term of its own
        keep = length > n
        head = pc.utf8_slice_codeunits(clean.filter(pa.array(keep)), 0, n)
        hashes.append(hash_strings(head) + np.uint64(n))
        owners.append(index[keep])
    return mix64(np.concatenate(hashes)) & _BITS, np.concatenate(owners)


def _terms_by_row(texts: pa.Array, chosen: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, term) pairs; with ``chosen`` (sorted hashes) terms are positions in it, others are left out."""
    words, offsets = split_words(texts)
    if len(words) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, distinct = word_codes(words)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    terms, owners = _distinct_terms(distinct)
    if chosen is not None:
        at = np.searchsorted(chosen, terms)
        hit = chosen[np.minimum(at, len(chosen) - 1)] == terms if len(chosen) else np.zeros(len(terms), bool)
        terms, owners = at[hit].astype(np.int64), owners[hit]
    else:
        terms = terms.astype(np.int64)
    # words of the slice that own a term, then all (row, term) pairs of those words
    order = np.argsort(owners, kind="stable")
    terms, owners = terms[order], owners[order]
    first = np.searchsorted(owners, np.arange(len(distinct)))
    count = np.searchsorted(owners, np.arange(len(distinct)), side="right") - first
    own = count[codes] > 0
    rows, codes = rows[own], codes[own]
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair = np.unique(np.stack([rows, codes]), axis=1) if chosen is None else np.stack([rows, codes])
    rows, codes = pair
    n = count[codes]
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    rows, terms = np.repeat(rows, n), terms[np.repeat(first[codes], n) + within]
    order = np.lexsort((terms, rows))
    rows, terms = rows[order], terms[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (terms[1:] != terms[:-1])
    return rows[new], terms[new]


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic documents, other documents) of each slice."""
    for batch in batches:
        for piece in slices(batch, "text", 2 << 20):
            rows, terms = _terms_by_row(piece.column("text"), None)
            label = piece.column("label").to_numpy(zero_copy_only=False)
            ids, where = np.unique(terms, return_inverse=True)
            toxic = np.bincount(where, label[rows] == 1, len(ids)).astype(np.int64)
            total = np.bincount(where, minlength=len(ids)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(toxic), pa.array(total - toxic)],
                                             ["term", "toxic", "other"])


def _fit_machine(x: np.ndarray, y: np.ndarray, factors: int, seed: int = 8, rounds: int = 250) -> dict:
    """Second-order factorization machine with logistic loss, fitted by Adam on all rows at once."""
    rng = np.random.default_rng(seed)
    p = {"b": np.zeros(1), "w": np.zeros(x.shape[1]), "v": rng.normal(0, 0.05, (x.shape[1], factors))}
    m, s = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}
    for step in range(1, rounds + 1):
        xv = x @ p["v"]
        score = p["b"] + x @ p["w"] + 0.5 * ((xv ** 2).sum(1) - x @ (p["v"] ** 2).sum(1))
        err = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y) / len(y)
        xe = x.T @ err
        grad = {"b": np.array([err.sum()]), "w": xe + 2e-5 * p["w"],
                "v": x.T @ (err[:, None] * xv) - p["v"] * xe[:, None] + 1e-4 * p["v"]}
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * grad[k]
            s[k] = 0.99 * s[k] + 0.01 * grad[k] ** 2
            p[k] = p[k] - 0.05 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-8)
    return p


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", rows_per_class: int = FIT_ROWS_PER_CLASS,
                 n_terms: int = FIT_TERMS, factors: int = FACTORS) -> dict:
    """Fit the machine on a bounded, hash-ordered sample of the labelled rows of ``labels``.

    Class shares come from all labelled rows. The sample (2 x ``rows_per_class``
    ids) is broadcast to the documents; its term counts are Spark's; only the
    strongest ``n_terms`` terms and the sample's hits on them reach the driver.
    Null labels and labels without a document are not used. Without rows of both
    classes the machine scores the class share (0.5 without any row).
    """
    known = labels.filter(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label"))
    share = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(share.values())
    prior = share.get(1, 0) / total if total else 0.5
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    empty = {"terms": np.zeros(0, np.uint64), "b": np.log(prior / (1 - prior)), "w": np.zeros(0), "v": np.zeros((0, 1))}
    if len(share) < 2:
        return empty
    parts = [known.filter(F.col("label") == c).orderBy(F.xxhash64("__id"), "__id").limit(rows_per_class)
             for c in (0, 1)]
    sample = parts[0].unionByName(parts[1])
    # bounded: at most 2 x rows_per_class ids
    rows = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
            .join(F.broadcast(sample), "__id").select("text", "label"))
    counts = rows.mapInArrow(_count_terms, "term long, toxic long, other long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    n1, n0 = (min(share[c], rows_per_class) for c in (1, 0))
    rate = (F.col("toxic") + F.col("other")) / F.lit(n1 + n0)

    def part(k, n):  # observed against expected, both in documents
        return F.when(k > 0, k * F.log(k / (rate * n))).otherwise(0.0)

    strength = part(F.col("toxic"), n1) + part(F.col("other"), n0)
    best = (counts.filter("toxic + other >= 8").withColumn("s", strength)
            .orderBy(F.desc("s"), "term").limit(n_terms).select("term").collect())
    chosen = np.sort(np.array([r["term"] for r in best], dtype=np.uint64))
    if not len(chosen):
        return empty

    def hits(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                row, term = _terms_by_row(piece.column("text"), chosen)
                cut = np.searchsorted(row, np.arange(piece.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("label"), pa.ListArray.from_arrays(pa.array(cut, pa.int32()),
                                                                     pa.array(term, pa.int32()))], ["label", "terms"])

    seen = sorted((tuple(r["terms"]), r["label"])
                  for r in rows.mapInArrow(hits, "label int, terms array<int>").collect())
    if len({c for _, c in seen}) < 2:
        return empty
    x = np.zeros((len(seen), len(chosen)))
    for i, (terms, _) in enumerate(seen):
        x[i, list(terms)] = 1
    y = np.array([c for _, c in seen], float)
    p = _fit_machine(x, y, factors)
    odds = np.log(prior / (1 - prior)) - np.log(y.mean() / (1 - y.mean()))  # the sample is balanced, the data are not
    return {"terms": chosen, "b": float(p["b"][0] + odds), "w": p["w"], "v": p["v"]}


def score_toxicity(docs: DataFrame, model: dict, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the machine's probability that the text is toxic, in ``out`` (replaced if present).

    Whole texts are read; a null, empty or term-less text scores the machine's
    bias. One narrow pass, no shuffle; other columns pass through; equal rows
    score alike; an empty table stays empty.
    """
    fields = [f for f in docs.schema.fields if f.name != out]
    names = [f.name for f in fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{out}` double"
    terms, b, w, v = model["terms"], model["b"], model["w"], model["v"]

    def run(batches):
        for batch in batches:
            for piece in slices(batch, text_col):
                n = piece.num_rows
                row, term = _terms_by_row(pc.cast(piece.column(text_col), pa.string()), terms)
                linear = np.bincount(row, w[term], n) if len(row) else np.zeros(n)
                pairs = np.zeros(n)
                for f in range(v.shape[1] if len(row) else 0):
                    q = v[term, f]
                    pairs += 0.5 * (np.bincount(row, q, n) ** 2 - np.bincount(row, q * q, n))
                z = np.clip(b + linear + pairs, -30, 30)
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in names), pa.array(1 / (1 + np.exp(-z)))],
                                                 [*names, out])

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, schema)


def training_labels(labels: DataFrame) -> DataFrame:
    """The label rows that may be learned from (the other third is held out)."""
    return labels.filter(crc_mod(F.col("doc_id"), 3) != 1)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from two thirds of the labels."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, training_labels(read(spark, sf_dir, "labels")))
    return score_toxicity(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
