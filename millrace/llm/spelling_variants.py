"""Spelling variant grouping: Bloom-guided neighbourhoods of the vocabulary.

Words of the corpus are near when one inserted, deleted or replaced code point
turns one into the other. Which of a word's generated edits are words at all is
first asked of Bloom filters: one for each word length, made of blocks of 512 bits,
broadcast. Only positives travel, to an exact join with the vocabulary that
removes the false ones. Each pair is generated once: of two words of one length
the one with the smaller code point at the place probes, of two lengths the longer.

The filters hold at most ``filter_bytes`` at once. A vocabulary that needs more is
probed in passes over hash ranges of the edits, so nothing depends on its size.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import lower_ascii, mix64, read, slices, written

MIN_LENGTH = 7
MIN_COUNT = 2
#: A word's form occurs at least this many times as often as the word.
FORM_RATIO = 10
#: One of this many occurrences loses a code point (the query's own rule).
DROP_EVERY = 31
#: Bytes of all filters that are broadcast at once, and bits for each word in them.
FILTER_BYTES = 64 << 20
BITS_PER_WORD = 16
#: Longer words share one filter (their hashes tell the lengths apart).
SHARD_LENGTH = 64
_BLOCK_WORDS = 8  # 64-bit words in a block
_CHUNK_BLOCKS = 1 << 10  # blocks that one task fills
_FLAT = 1 << 16  # (word, place) pairs probed at once
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LENGTH_SALT = 0xD6E8FEB86659FD93


def _masks() -> np.ndarray:
    """4,096 words with four bits set each, by rule."""
    x = np.arange(4096, dtype=np.uint64)
    out = np.zeros(4096, np.uint64)
    for k in range(4):
        out |= np.uint64(1) << (mix64(x * np.uint64(4) + np.uint64(k)) & np.uint64(63))
    return out


_MASKS = _masks()


def _spread(h: np.ndarray) -> np.ndarray:
    """Mix a polynomial hash, so that its high and its low half can be used alike."""
    h = h ^ (h >> np.uint64(32))
    h *= _BASE
    h ^= h >> np.uint64(29)
    return h


def _salt(length: int) -> np.uint64:
    return np.uint64(length * _LENGTH_SALT & (1 << 64) - 1)


def _powers(length: int) -> np.ndarray:
    p = np.full(length, _BASE, np.uint64)
    p[:1] = 1
    return np.cumprod(p)[::-1].copy()


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length).astype(np.uint64)


def shard_of(length: int) -> int:
    return min(length, SHARD_LENGTH)


class Filters:
    """Blocked Bloom filters, one for each word length, in one array of 64-bit words."""

    def __init__(self, counts: dict[int, int], passes: int = 1) -> None:
        self.passes = passes
        self.begin: dict[int, tuple[int, int]] = {}
        at = 0
        for shard in sorted(counts):
            n = max(1, -(-counts[shard] * BITS_PER_WORD // (64 * _BLOCK_WORDS * passes)))
            self.begin[shard] = (at, n)
            at += n
        self.blocks = at
        self.bits: np.ndarray | None = None

    def in_pass(self, h: np.ndarray, number: int) -> np.ndarray:
        return (mix64(h) >> np.uint64(40)) % np.uint64(self.passes) == np.uint64(number)

    def _first(self, shard: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The block of each hash, and the word and mask that are asked first."""
        base, n = self.begin[shard]
        block = ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        block += np.uint64(base)
        return block, block * np.uint64(_BLOCK_WORDS) + (h & np.uint64(7)), _MASKS[(h >> np.uint64(3)) & np.uint64(4095)]

    @staticmethod
    def _second(block: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        g = mix64(h)
        other = (h & np.uint64(7)) ^ (np.uint64(1) + g % np.uint64(7))  # another word of the block
        return block * np.uint64(_BLOCK_WORDS) + other, _MASKS[(g >> np.uint64(8)) & np.uint64(4095)]

    def places(self, shard: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots and masks that the words with these hashes set."""
        block, slot, mask = self._first(shard, h)
        slot2, mask2 = self._second(block, h)
        return np.concatenate((slot, slot2)).astype(np.int64), np.concatenate((mask, mask2))

    def maybe(self, shard: int, h: np.ndarray) -> np.ndarray:
        """Places in ``h`` whose word may be in the vocabulary."""
        block, slot, mask = self._first(shard, h)
        found = np.flatnonzero(self.bits[slot.view(np.int64)] & mask == mask)
        if len(found):
            slot, mask = self._second(block[found], h[found])
            found = found[self.bits[slot.view(np.int64)] & mask == mask]
        return found


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Each length with the places of its words."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(length, kind="stable")
    cuts = np.flatnonzero(np.diff(length[order])) + 1
    for places in np.split(order, cuts):
        if len(places):
            yield int(length[places[0]]), places


def word_hashes(codes: np.ndarray) -> np.ndarray:
    length = codes.shape[1]
    return _spread((codes * _powers(length)).sum(axis=1, dtype=np.uint64) + _salt(length))


def probes(codes: np.ndarray, alphabet: np.ndarray, filters: Filters, number: int,
           least_length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Edits of words of one length that may be words: (word, place, code point; 0 for a deletion)."""
    n, length = codes.shape
    power = _powers(length)
    terms = codes * power
    total = terms.sum(axis=1, dtype=np.uint64)

    def asked(shard: int, h: np.ndarray) -> np.ndarray:
        h = _spread(h)
        if filters.passes == 1:
            return filters.maybe(shard, h)
        mine = np.flatnonzero(filters.in_pass(h, number))
        return mine[filters.maybe(shard, h[mine])]

    shard = shard_of(length)
    if shard in filters.begin:
        flat, rest = codes.ravel(), np.repeat(total, length) - terms.ravel() + _salt(length)
        for lo in range(0, len(flat), _FLAT):
            code, base = flat[lo:lo + _FLAT], rest[lo:lo + _FLAT]
            p = power[np.arange(lo, lo + len(code)) % length]
            for c in alphabet:
                less = np.flatnonzero(code < c)
                if len(less):
                    hit = lo + less[asked(shard, base[less] + p[less] * c)]
                    if len(hit):
                        yield hit // length, hit % length, np.full(len(hit), c, np.uint64)
    shard = shard_of(length - 1)
    if length - 1 >= least_length and shard in filters.begin:
        shifted = np.zeros_like(codes)
        shifted[:, 1:] = codes[:, :-1] * power[1:]
        before = np.cumsum(shifted, axis=1, dtype=np.uint64)
        after = total[:, None] - np.cumsum(terms, axis=1, dtype=np.uint64)
        new = np.ones(codes.shape, bool)  # of equal neighbours the first one stands for all
        new[:, 1:] = codes[:, 1:] != codes[:, :-1]
        at = np.flatnonzero(new.ravel())
        h = (before + after).ravel()[at] + _salt(length - 1)
        for lo in range(0, len(at), _FLAT * 8):
            hit = at[lo + asked(shard, h[lo:lo + _FLAT * 8])]
            if len(hit):
                yield hit // length, hit % length, np.zeros(len(hit), np.uint64)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = MIN_LENGTH,
               least_count: int = MIN_COUNT, drop_every: int = DROP_EVERY) -> DataFrame:
    """``word`` and ``n``: runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased, counted over all texts.

    The run whose crc32 of ``<id>:<run>`` is divisible by ``drop_every`` loses one code point (0: none does).
    """
    run = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                found: Counter = Counter()
                for key, text in zip(piece.column("id").to_pylist(), lower_ascii(pc.fill_null(piece.column("text"), ""))):
                    words = run.findall(text.as_py())
                    if drop_every:
                        start = zlib.crc32(f"{'' if key is None else key}:".encode())
                        for k, w in enumerate(words):
                            h = zlib.crc32(w.encode(), start)
                            if not h % drop_every:
                                h %= len(w)
                                words[k] = w[:h] + w[h + 1:]
                    found.update(words)
                yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
                                                 ["word", "n"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (source.mapInArrow(count, "word string, n long").filter(F.length("word") >= least_length)
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count))


def _filled(words: DataFrame, layout: Filters, number: int) -> np.ndarray:
    """The filters' bits of one pass, filled by tasks chunk by chunk."""
    chunk_slots = _CHUNK_BLOCKS * _BLOCK_WORDS

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("word").to_pylist()
            for length, at in by_length(found):
                h = word_hashes(_codes([found[k] for k in at.tolist()], length))
                h = h[layout.in_pass(h, number)] if layout.passes > 1 else h
                slot, mask = layout.places(shard_of(length), h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((slot // chunk_slots).astype(np.int32)), pa.array(slot), pa.array(mask.view(np.int64))],
                    ["chunk", "slot", "mask"])

    def fill(table: pa.Table) -> pa.Table:
        slot, mask = table["slot"].to_numpy(), table["mask"].to_numpy().view(np.uint64)
        bits = np.zeros(chunk_slots, np.uint64)
        np.bitwise_or.at(bits, slot % chunk_slots, mask)
        return pa.table({"chunk": table["chunk"].slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

    chunks = (words.mapInArrow(places, "chunk int, slot long, mask long").groupBy("chunk")
              .applyInArrow(fill, "chunk int, bits binary").toArrow())  # layout.blocks * 64 bytes, bounded by the caller
    bits = np.zeros(-(-layout.blocks // _CHUNK_BLOCKS) * chunk_slots, np.uint64)
    for chunk, raw in zip(chunks["chunk"].to_pylist(), chunks["bits"].to_pylist()):
        bits[chunk * chunk_slots:(chunk + 1) * chunk_slots] = np.frombuffer(raw, np.uint64)
    return bits


def near_pairs(words: DataFrame, least_length: int = MIN_LENGTH, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: each pair of near words once. ``words`` is a written table (word, n)."""
    spark = words.sparkSession

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("word").to_pylist()
            for length, at in by_length(found):
                code = np.unique(_codes([found[k] for k in at.tolist()], length))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(code), shard_of(length), np.int32)), pa.array(code.astype(np.int32))],
                    ["shard", "code"])

    # at most 64 lengths, and 90 letters for each of them
    shard = F.least(F.length("word"), F.lit(SHARD_LENGTH)).alias("shard")
    counts = {r["shard"]: r["n"] for r in words.groupBy(shard).agg(F.count(F.lit(1)).alias("n")).collect()}
    alphabets: dict[int, list[int]] = {}
    for r in words.select("word").mapInArrow(letters, "shard int, code int").distinct().collect():
        alphabets.setdefault(r["shard"], []).append(r["code"])
    alphabet = {k: np.array(sorted(v), np.uint64) for k, v in alphabets.items()}
    passes = max(1, -(-sum(counts.values()) * BITS_PER_WORD // (8 * filter_bytes)))

    def positives(number: int) -> DataFrame:
        layout = Filters(counts, passes)
        bits = spark.sparkContext.broadcast(_filled(words, layout, number))

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            layout.bits = bits.value
            for batch in batches:
                for piece in slices(batch, "word", 1 << 20):
                    found, n = piece.column("word").to_pylist(), piece.column("n").to_numpy()
                    for length, at in by_length(found):
                        own = [found[k] for k in at.tolist()]
                        for word, place, code in probes(_codes(own, length), alphabet[shard_of(length)], layout, number,
                                                        least_length):
                            edits = [own[w][:p] + (chr(c) if c else "") + own[w][p + 1:]
                                     for w, p, c in zip(word.tolist(), place.tolist(), code.tolist())]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([own[w] for w in word.tolist()], pa.string()), pa.array(n[at[word]]),
                                 pa.array(edits, pa.string())], ["word", "n", "near"])

        found = words.select("word", "n").mapInArrow(probe, "word string, n long, near string")
        return written(found, "probes") if passes > 1 else found

    found = positives(0)
    for k in range(1, passes):
        found = found.unionByName(positives(k))
    return found.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select(
        "word", "n", "near", "near_n")


def roots(links: DataFrame) -> DataFrame:
    """``word`` and ``root`` of a written table of ``word`` and ``form``: forms followed to the last one.

    A form occurs at least twice as often as its word, so chains are short; each round halves them.
    """
    cur = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = cur.select(F.col("word").alias("__at"), F.col("root").alias("__next"))
        step = cur.join(ahead, F.col("root") == F.col("__at"), "left")
        if step.filter("__next IS NOT NULL").isEmpty():
            return cur
        cur = written(step.select("word", F.coalesce("__next", "root").alias("root")), "roots")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = MIN_LENGTH,
                    least_count: int = MIN_COUNT, ratio: int = FORM_RATIO, drop_every: int = DROP_EVERY,
                    filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of the corpus.

    A word's form is its near word of largest count (ties: smallest in code-point
    order) where that is at least ``ratio`` times its own; ``root`` follows forms to
    the last, and is the word itself without one. Null and empty texts have no
    words; a null id reads as the empty text; repeated rows count as often as they
    stand; other columns are not read; an empty table gives no rows. Runs of any
    length are words, in one filter from 64 code points on.
    """
    words = written(vocabulary(docs, id_col, text_col, least_length, least_count, drop_every), "vocabulary")
    pairs = near_pairs(words, least_length, filter_bytes)
    both = pairs.select(F.explode(F.array(
        F.struct("word", F.col("near").alias("other"), F.col("near_n").alias("other_n")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))).alias("p"))
    best = both.groupBy("p.word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("p.other_n")).alias("neg"), F.col("p.other"))).alias("b"))
    frequent = -F.col("b.neg") >= F.lit(ratio) * F.col("n")
    formed = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("b.other")).alias("form"), F.when(frequent, -F.col("b.neg")).alias("form_n")), "forms")
    return formed.join(roots(formed.filter("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling groups of the words of all documents."""
    return spelling_groups(read(spark, sf_dir, "documents").select("doc_id", "text"))


OP11_SQL = rf"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda x, _:
           CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i)) AS t),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
coded AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS b FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(length(b) // 2), lambda k:
           CAST('0x' || substr(b, 2 * k + 1, 2) AS BIGINT)),
           lambda c, x: xor(crc.t[(xor(c, x) & 255) + 1], c >> 8), 4294967295), 4294967295) AS h
  FROM coded, crc),
dropped AS (
  SELECT CASE WHEN h % {DROP_EVERY} = 0
              THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
              ELSE run END AS word, n FROM hashed),
v AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM dropped
  WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
gaps AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS other_n
  FROM gaps a JOIN gaps b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT g.word, v.word, v.n FROM gaps g JOIN v ON v.word = g.head || g.tail
  UNION SELECT v.word, g.word, g.n FROM gaps g JOIN v ON v.word = g.head || g.tail),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word),
formed AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.top >= {FORM_RATIO} * v.n THEN b.top END AS form_n,
         CASE WHEN b.top >= {FORM_RATIO} * v.n
              THEN (SELECT min(x.other) FROM near x WHERE x.word = v.word AND x.other_n = b.top) END AS form
  FROM v LEFT JOIN best b USING (word)),
chain AS (
  SELECT word, form AS up, 1 AS depth FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form, c.depth + 1 FROM chain c JOIN formed f ON f.word = c.up WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(up, depth) AS root FROM chain GROUP BY word)
SELECT f.word, f.form, coalesce(l.root, f.word) AS root, f.n, f.n_near, f.form_n
FROM formed f LEFT JOIN ends l USING (word)
"""
