"""Language identification by nearest centroid.

A text is the vector of its hashed character n-grams (one to three characters,
letters only, lower-cased), weighted by tf-idf and scaled to length one. Each
language has several centroids, found by spherical k-means on its training
texts. A text gets the language of the centroid with the highest cosine and is
rejected where that cosine is lower than the centroid's training texts reach.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import crc_mod, read, slices

DIMS = 4096
CENTROIDS = 4
#: Labelled texts of each language that the centroids are fitted on, at most.
FIT_ROWS_PER_LANG = 600
#: Share of a centroid's training texts that may lie beyond its rejection distance.
REJECT_SHARE = 0.005
UNDETERMINED = "und"
_PIECE_ROWS = 256
_SPACE = 32


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts with one space for whatever stands between, and each character's row."""
    lowered = pc.utf8_lower(pc.fill_null(pc.cast(texts, pa.string()), ""))
    size = pc.utf8_length(lowered).to_numpy(zero_copy_only=False)
    code = np.frombuffer("".join(lowered.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(size)), size)
    code = np.where(_letters()[code], code, _SPACE).astype(np.uint32)
    edge = np.ones(len(code), bool)
    edge[1:] = (code[1:] != _SPACE) | (code[:-1] != _SPACE) | (row[1:] != row[:-1])
    return code[edge], row[edge]


def ngram_counts(texts: pa.Array, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram counts (rows x dims) and the number of letters of each text."""
    code, row = _characters(texts)
    n = len(texts)
    letters = np.bincount(row, code != _SPACE, n) if len(row) else np.zeros(n)
    counts = np.zeros(n * dims)
    gram = np.zeros(len(code), np.uint64)
    for size in (1, 2, 3):
        # the gram that starts at each character, as long as its end is in the same text
        gram = gram[:max(0, len(code) - size + 1)] * np.uint64(1_000_003) + code[size - 1:]
        if not len(gram):
            break
        same = row[:len(gram)] == row[size - 1:]
        h = (gram + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
        at = row[:len(gram)] * dims + (h >> np.uint64(40)).astype(np.int64) % dims
        counts += np.bincount(at[same], minlength=n * dims)
    return counts.reshape(n, dims), letters


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm == 0, 1, norm)


def _centroids(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Spherical k-means, begun with texts far from each other."""
    centre = [x[rng.integers(len(x))]]
    for _ in range(1, min(k, len(x))):
        gap = 1 - np.max(x @ np.array(centre).T, axis=1)
        centre.append(x[int(np.argmax(gap * rng.uniform(0.5, 1, len(x))))])
    centre = np.array(centre)
    for _ in range(20):
        own = np.argmax(x @ centre.T, axis=1)
        centre = _unit(np.array([x[own == c].sum(0) if (own == c).any() else centre[c] for c in range(len(centre))]))
    return centre


def fit_language_id(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
                    rows_per_lang: int = FIT_ROWS_PER_LANG, k: int = CENTROIDS, dims: int = DIMS) -> dict:
    """Fit centroids on a bounded sample of the labelled rows of ``docs``.

    Rows with a null language or without a letter teach nothing. The sample is
    ordered by a hash of the id: about ``rows_per_lang`` rows per language, never
    more than twice that. Without any labelled row there are no languages and
    every text is undetermined.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    share = {r[lang_col]: r["count"] for r in known.groupBy(lang_col).count().collect()}
    langs = sorted(share)
    model = {"langs": langs, "idf": np.ones(dims), "centres": np.zeros((0, dims)), "lang_of": np.zeros(0, int),
             "radius": np.zeros(0), "dims": dims}
    if not langs:
        return model
    place = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    taken = F.lit(False)
    for lang in langs:
        taken = taken | ((F.col(lang_col) == lang) & (place < min(1.0, rows_per_lang / share[lang])))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _PIECE_ROWS):
                part = batch.slice(lo, _PIECE_ROWS)
                counts, _ = ngram_counts(part.column("text"), dims)
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), pa.array([c.astype(np.float32).tobytes() for c in counts], pa.binary())],
                    ["lang", "grams"])

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts that hold each n-gram, one row per n-gram and task."""
        total = np.zeros(dims, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, _PIECE_ROWS):
                counts, _ = ngram_counts(batch.slice(lo, _PIECE_ROWS).column("text"), dims)
                total += (np.asarray(counts) > 0).sum(0)
        gram = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(gram, pa.int32()), pa.array(total[gram])], ["gram", "n"])

    sample = known.filter(taken).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    seen = sample.mapInArrow(vectors, "lang string, grams binary").limit(2 * rows_per_lang * len(langs)).collect()
    seen = sorted((r["lang"], bytes(r["grams"])) for r in seen)
    x = np.array([np.frombuffer(g, np.float32) for _, g in seen], np.float64)
    y = np.array([langs.index(lang) for lang, _ in seen])
    frequency = np.zeros(dims)
    for r in (known.select(F.col(text_col).alias("text")).mapInArrow(frequencies, "gram int, n long")
              .groupBy("gram").agg(F.sum("n").alias("n")).collect()):
        frequency[r["gram"]] = r["n"]
    model["idf"] = np.log((1 + sum(share.values())) / (1 + frequency)) + 1
    x = _unit(np.log1p(x) * model["idf"])
    rng = np.random.default_rng(2)
    centres, lang_of, radius = [], [], []
    for i in range(len(langs)):
        own = x[y == i]
        if not len(own):
            continue
        found = _centroids(own, k, rng)
        cosine = own @ found.T
        nearest = np.argmax(cosine, axis=1)
        for c in range(len(found)):
            members = cosine[nearest == c, c]
            centres.append(found[c])
            lang_of.append(i)
            radius.append(float(np.quantile(members, REJECT_SHARE)) if len(members) else 1.0)
    model.update(centres=np.array(centres), lang_of=np.array(lang_of), radius=np.array(radius))
    return model


def identify_language(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` (columns of those names are replaced).

    ``lang_pred`` is the nearest centroid's language, ``und`` for a null text and
    one without letters; ``score`` is its cosine (0 for ``und``); ``rejected`` says
    that the text lies farther off than that centroid's training texts. Whole
    texts are read, equal rows score alike, an empty table stays empty. Of equal
    cosines the first language in order wins. One narrow pass, no shuffle.
    """
    added = ("lang_pred", "score", "rejected")
    fields = [f for f in docs.schema.fields if f.name not in added]
    names = [f.name for f in fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + \
        ", lang_pred string, score double, rejected boolean"
    langs, dims = np.array([*model["langs"], UNDETERMINED], object), model["dims"]
    centres = model["centres"].astype(np.float32)
    idf, lang_of, radius = model["idf"].astype(np.float32), model["lang_of"], model["radius"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text_col, 4 << 20):
                for lo in range(0, piece.num_rows, _PIECE_ROWS):
                    part = piece.slice(lo, _PIECE_ROWS)
                    counts, letters = ngram_counts(part.column(text_col), dims)
                    if len(centres):
                        cosine = _unit(np.log1p(counts.astype(np.float32)) * idf) @ centres.T
                        best = np.argmax(cosine, axis=1)
                        score = np.clip(cosine[np.arange(len(best)), best].astype(float), 0, 1)
                        pred, far = lang_of[best], score < radius[best]
                    else:
                        pred = np.full(part.num_rows, len(langs) - 1)
                        score, far = np.zeros(part.num_rows), np.ones(part.num_rows, bool)
                    none = letters == 0
                    pred, score, far = np.where(none, len(langs) - 1, pred), np.where(none, 0.0, score), far | none
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in names), pa.array(langs[pred].tolist(), pa.string()),
                         pa.array(score), pa.array(far)], [*names, *added])

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, schema)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four fifths of them."""
    docs = read(spark, sf_dir, "documents")
    model = fit_language_id(docs.filter(crc_mod(F.col("doc_id"), 5) != 0))
    return identify_language(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")
