"""Tokenization as corpus jobs.

Pre-token counts are cut JVM-side by regex. Vocabulary lookups run in
the row against a byte-checked broadcast (an equi-join beyond it). Byte-level BPE is one
narrow pass: each Arrow batch is normalised, cut at special tokens, cut into
pre-tokens and merged with a bounded memo per Python worker. The merge table
and the vocabulary are model files, so they are broadcast whole.
"""

from __future__ import annotations

import functools
import heapq
import operator
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import constants as C
from millrace.functions.text import pretokens, special_token_pattern, words

#: A Python broadcast is held once per worker process, so the bound is on bytes.
BROADCAST_VOCAB_BYTES = 64 << 20


def pretoken_counts(df: DataFrame, text_col: str, out: str = "n_pretokens") -> DataFrame:
    """Number of pre-tokens per row (narrow, no shuffle); a special token counts as one."""
    text = F.col(text_col)
    # most texts do not even hold a character that a special token begins with: no pattern is tried on those
    first = sorted({tok[0] for tok, _ in C.SPECIAL_TOKENS})
    maybe = functools.reduce(operator.or_, [F.contains(text, F.lit(c)) for c in first])
    return df.withColumn(out, F.when(maybe & text.rlike(special_token_pattern()), F.size(pretokens_with_specials(text)))
                         .otherwise(F.size(pretokens(text))))


def split_specials(text) -> F.Column:
    """Text -> plain segments and special tokens, in order (specials kept whole).

    Splits at zero-width boundaries before and after every special token,
    so pre-tokens never straddle one.
    """
    pat = special_token_pattern()
    t = F.col(text) if isinstance(text, str) else text
    return F.split(t, f"(?=(?:{pat}))|(?<=(?:{pat}))")


def pretokens_with_specials(text) -> F.Column:
    """Special tokens first (each one piece), then the pre-tokenizer on the text between them."""
    specials = F.array(*[F.lit(tok) for tok, _ in C.SPECIAL_TOKENS])
    segs = split_specials(text)
    return F.flatten(F.transform(segs, lambda s: F.when(F.array_contains(specials, s), F.array(s)).otherwise(
        pretokens(s))))


def special_ids(spark) -> DataFrame:
    """The special tokens and their fixed ids as a small table."""
    return spark.createDataFrame(C.SPECIAL_TOKENS, "pretoken string, sid int")


def word_vocab(df: DataFrame, text_col: str, id_offset: int = 0) -> DataFrame:
    """A vocabulary from the distinct lower-cased words of a table: ``(token, id)``.

    ids are the 0-based rank of the word in sorted order (plus
    ``id_offset``); words are distinct, so this is the dense rank. The
    distinct words are a partial aggregate and the rank is computed over
    range partitions, never in a single task.
    """
    from millrace.operators.feed import global_rank
    w = df.select(F.explode(words(F.col(text_col))).alias("token")).distinct()
    return global_rank(w, ["token"], "id").select("token", (F.col("id") + id_offset).alias("id"))


def _broadcast_vocab(vocab: DataFrame, limit: int) -> tuple[pa.Array, pa.Array] | None:
    """Tokens and ids as Arrow arrays when the checked bytes allow a broadcast, else None. ``vocab`` is a written table."""
    size = vocab.agg(F.sum(F.octet_length("_tok") + F.lit(12)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    if (size["b"] or 0) > limit:
        return None
    found = vocab.orderBy("_tid", "_tok").toArrow()
    return found["_tok"].combine_chunks(), found["_tid"].combine_chunks()


def encode_tokens(df: DataFrame, keys: list[str], tokens_col: str, vocab: DataFrame,
                  unk_id: int | None = None, out: str = "ids",
                  broadcast_bytes: int | None = None) -> DataFrame:
    """Token arrays -> id arrays through the vocabulary (``token -> id``): ``keys``, ``out``, ``n_oov``.

    A vocabulary within the byte bound is broadcast and looked up in the row, by
    Arrow batches: nothing of ``df`` is shuffled. A larger one is joined: tokens are
    exploded with their position and re-assembled per row. OOV tokens get ``unk_id``
    (null when none). A row without tokens, or a null array, has no ids; a null token
    is OOV.
    """
    v = _written_vocab(vocab)
    small = _broadcast_vocab(v, BROADCAST_VOCAB_BYTES if broadcast_bytes is None else broadcast_bytes)
    if small is None:
        return _encode_by_join(df, keys, tokens_col, v, unk_id, out)
    shared = df.sparkSession.sparkContext.broadcast(small)
    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField(out, T.ArrayType(T.IntegerType())),
                           T.StructField("n_oov", T.LongType(), False)])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, ids = shared.value
        for batch in batches:
            lists = batch.column("__tokens")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
            at = pc.index_in(flat, value_set=tokens, skip_nulls=True)
            missing = np.concatenate(([0], np.cumsum(at.is_null().to_numpy(zero_copy_only=False))))
            found = ids.take(at)
            if unk_id is not None:
                found = pc.fill_null(found, pa.scalar(unk_id, pa.int32()))
            cut = offsets - offsets[0]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), found),
                 pa.array(missing[cut[1:]] - missing[cut[:-1]], pa.int64())], schema.names)

    tokens = F.coalesce(F.col(tokens_col), F.array().cast("array<string>")).alias("__tokens")
    return df.select(*keys, tokens).mapInArrow(look_up, schema)


def _written_vocab(vocab: DataFrame) -> DataFrame:
    from millrace.session import cut_lineage
    return cut_lineage(vocab.select(F.col("token").alias("_tok"), F.col("id").cast("int").alias("_tid")), "vocab")


def _encode_by_join(df: DataFrame, keys: list[str], tokens_col: str, v: DataFrame, unk_id: int | None,
                    out: str) -> DataFrame:
    # posexplode_outer keeps rows without tokens (they come back as empty arrays)
    ex = df.select(*keys, F.posexplode_outer(tokens_col).alias("_pos", "_tok"))
    j = ex.join(v, "_tok", "left")
    tid = F.coalesce(F.col("_tid"), F.lit(unk_id).cast("int")) if unk_id is not None else F.col("_tid")
    present = F.col("_pos").isNotNull()
    g = j.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(present, F.struct(F.col("_pos"), tid.alias("_tid"))))).alias("_e"),
        F.count_if(present & F.col("_tid").isNull()).alias("n_oov"))
    return g.select(*keys, F.transform("_e", lambda e: e["_tid"]).alias(out), "n_oov")


def decode_ids(df: DataFrame, keys: list[str], ids_col: str, vocab: DataFrame, sep: str = " ",
               skip_ids: list[int] | None = None, out: str = "text", broadcast_bytes: int | None = None) -> DataFrame:
    """Id arrays -> text through the inverse vocabulary; unknown ids are dropped. Narrow as :func:`encode_tokens`."""
    v = _written_vocab(vocab)
    small = _broadcast_vocab(v, BROADCAST_VOCAB_BYTES if broadcast_bytes is None else broadcast_bytes)
    if small is None:
        return _decode_by_join(df, keys, ids_col, v, sep, skip_ids, out)
    shared = df.sparkSession.sparkContext.broadcast(small)
    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField(out, T.StringType())])
    skip = pa.array(skip_ids or [], pa.int32())

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, ids = shared.value
        for batch in batches:
            lists = batch.column("__ids")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
            at = pc.index_in(flat, value_set=ids, skip_nulls=True)
            keep = pc.and_(pc.is_valid(at), pc.invert(pc.is_in(flat, value_set=skip))).to_numpy(zero_copy_only=False)
            kept = np.concatenate(([0], np.cumsum(keep)))
            words = tokens.take(at.filter(pa.array(keep)))
            words = pa.ListArray.from_arrays(pa.array(kept[offsets - offsets[0]], pa.int32()), words)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pc.binary_join(words, sep)], schema.names)

    ids = F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias("__ids")
    return df.select(*keys, ids).mapInArrow(look_up, schema)


def _decode_by_join(df: DataFrame, keys: list[str], ids_col: str, v: DataFrame, sep: str, skip_ids: list[int] | None,
                    out: str) -> DataFrame:
    ex = df.select(*keys, F.posexplode_outer(ids_col).alias("_pos", "_tid"))
    keep = F.col("_pos").isNotNull()
    if skip_ids:
        keep = keep & ~F.col("_tid").isin(*skip_ids)
    j = ex.join(v, "_tid", "left")
    g = j.groupBy(*keys).agg(F.array_sort(F.collect_list(
        F.when(keep & F.col("_tok").isNotNull(), F.struct("_pos", "_tok")))).alias("_e"))
    return g.select(*keys, F.array_join(F.transform("_e", lambda e: e["_tok"]), sep).alias(out))


# ---------------------------------------------------------------------------
# byte-level BPE over distinct pre-tokens
# ---------------------------------------------------------------------------

def _bpe_word(symbols: list[str], ranks: dict) -> list[str]:
    """Merge the lowest-ranked adjacent pair, every occurrence left to right, until none applies.

    A heap of (rank, place) over a linked list: a word of n symbols costs
    about n log n, however many merges it takes.
    """
    word = list(symbols)
    n = len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((word[i], word[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        rank = heap[0][0]
        places = []
        while heap and heap[0][0] == rank:  # all places of this rank, left to right
            places.append(heapq.heappop(heap)[1])
        for i in places:
            j = after[i]
            if word[i] is None or j >= n or ranks.get((word[i], word[j])) != rank:
                continue  # an earlier merge took one of the two
            word[i] += word[j]
            word[j] = None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    r = ranks.get((word[left], word[after[left]]))
                    if r is not None:
                        heapq.heappush(heap, (r, left))
    return [w for w in word if w is not None]


class ByteEncoder:
    """Text -> pieces: NFC, special tokens kept whole, pre-tokens, byte symbols, merges.

    Lives on the workers; ``memo`` keeps the pieces of short pre-tokens and is
    emptied when full.
    """

    MEMO = 30_000
    MEMO_LENGTH = 64

    def __init__(self, ranks: dict):
        self.ranks = ranks

    def __getattr__(self, name):
        if name not in ("memo", "cut", "special", "specials", "table"):
            raise AttributeError(name)
        import regex
        self.memo = {}
        self.cut = regex.compile(C.PRETOKENIZE_REGEX).findall
        self.specials = {token: i for token, i in C.SPECIAL_TOKENS}
        self.special = re.compile("(" + "|".join(re.escape(t) for t in self.specials) + ")")
        self.table = C.bytes_to_unicode_table()
        return self.__dict__[name]

    def __getstate__(self):
        return {"ranks": self.ranks}

    def word(self, token: str) -> list[str]:
        found = self.memo.get(token)
        if found is None:
            found = _bpe_word([self.table[b] for b in token.encode("utf-8", "replace")], self.ranks)
            if len(token) <= self.MEMO_LENGTH:
                if len(self.memo) >= self.MEMO:
                    self.memo.clear()
                self.memo[token] = found
        return found

    def parts(self, text: str | None) -> Iterator[tuple[bool, str]]:
        """(special?, token): special tokens and pre-tokens in order."""
        if not text:
            return
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        for k, segment in enumerate(self.special.split(text)):
            if k % 2:
                yield True, segment
            else:
                for token in self.cut(segment):
                    yield False, token

    def count(self, text: str | None) -> int:
        return sum(1 if special else len(self.word(token)) for special, token in self.parts(text))


def merge_ranks(merges: DataFrame) -> dict:
    """The merge table as ``{(left, right): rank}``: a model file, fetched whole."""
    mp = merges.select("left", "right", "rank").toPandas()
    return {(a, b): int(r) for a, b, r in zip(mp["left"], mp["right"], mp["rank"])}


#: Bytes of text, or of ids, that a narrow pass turns into Python objects at once.
NARROW_BYTES = 1 << 20


def _pieces(batch: pa.RecordBatch, col: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``NARROW_BYTES`` in ``col`` (a row is never cut)."""
    values = batch.column(col)
    size = pc.multiply(pc.list_value_length(values), 4) if pa.types.is_list(values.type) else pc.binary_length(values)
    ends = np.cumsum(pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + NARROW_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _narrow(df: DataFrame, keys: list[str], text_col: str, fields: list[T.StructField], encode) -> DataFrame:
    """``keys`` and what ``encode(texts)`` gives, slice by slice, in one narrow Arrow pass."""
    schema = T.StructType([*(df.schema[k] for k in keys), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _pieces(whole, "__text"):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k) for k in keys), *encode(batch.column("__text").to_pylist())], schema.fieldNames())

    return df.select(*keys, F.col(text_col).alias("__text")).mapInArrow(run, schema)


def bpe_encode(df: DataFrame, keys: list[str], text_col: str, merges: DataFrame, vocab: DataFrame,
               unk_id: int | None = None) -> DataFrame:
    """Texts -> BPE ids (``keys``, ``n_tokens``, ``ids``) in one narrow pass, no shuffle.

    Texts are normalised (NFC) and cut at special tokens, which get their
    fixed ids. Pieces outside the vocabulary get ``unk_id`` (null when none).
    Null and empty texts have no tokens.
    """
    vp = vocab.select("token", F.col("id").cast("int").alias("id")).toPandas()
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((ByteEncoder(merge_ranks(merges)), dict(zip(vp["token"], map(int, vp["id"])))))

    def encode(texts):
        encoder, ids = shared.value
        out = [[encoder.specials[token] if special else ids.get(piece, unk_id)
                for special, token in encoder.parts(text)
                for piece in ((token,) if special else encoder.word(token))] for text in texts]
        return pa.array([len(x) for x in out], pa.int32()), pa.array(out, pa.list_(pa.int32()))

    return _narrow(df, keys, text_col, [T.StructField("n_tokens", T.IntegerType()),
                                        T.StructField("ids", T.ArrayType(T.IntegerType()))], encode)


def token_counts_bpe(df: DataFrame, keys: list[str], text_col: str, merges: DataFrame) -> DataFrame:
    """Token count per row: the length that :func:`bpe_encode` gives, without ids (one narrow pass)."""
    shared = df.sparkSession.sparkContext.broadcast(ByteEncoder(merge_ranks(merges)))

    def encode(texts):
        return (pa.array([shared.value.count(t) for t in texts], pa.int64()),)

    return _narrow(df, keys, text_col, [T.StructField("n_tokens", T.LongType())], encode)


def learn_merges(df: DataFrame, text_col: str, n_merges: int) -> DataFrame:
    """A single-level merge table from a corpus: the most frequent adjacent byte-symbol pairs.

    ``(left, right, rank)``; rank 0 is the most frequent pair, ties by the
    pair text. Frequencies are a partial aggregate over distinct pre-tokens.
    """
    table = C.bytes_to_unicode_table()

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def symbols(tokens: pd.Series) -> pd.Series:
        return pd.Series([[table[b] for b in t.encode("utf-8")] for t in tokens])

    pt = df.select(F.explode(pretokens(F.col(text_col))).alias("pretoken")).groupBy("pretoken").agg(
        F.count(F.lit(1)).alias("f"))
    s = pt.select("f", symbols("pretoken").alias("s"))
    s = s.select("f", "s", F.size("s").alias("n"))
    pairs = s.select("f", F.explode_outer(F.transform(F.sequence(F.lit(0), F.greatest(F.col("n") - 2, F.lit(0))),
                                                lambda i: F.struct(F.get(F.col("s"), i).alias("left"),
                                                                   F.get(F.col("s"), i + 1).alias("right")))).alias("p"))
    pairs = pairs.filter(F.col("p.right").isNotNull())
    freq = pairs.groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right")).agg(
        F.sum("f").alias("freq"))
    from millrace.operators.feed import global_rank
    from millrace.session import cut_lineage
    # the pair-frequency table is written once; the rank reads the written copy
    freq = cut_lineage(freq, "pair-freq")
    ranked = global_rank(freq, [F.col("freq").desc(), F.col("left"), F.col("right")], "rank",
                         materialize=False)
    return ranked.select("left", "right", "rank").filter(F.col("rank") < n_merges)


def vocab_from_merges(merges: DataFrame) -> DataFrame:
    """Byte symbols (ids 0..255 in byte order) + one id per merge (256 + rank)."""
    spark = merges.sparkSession
    table = C.bytes_to_unicode_table()
    base = spark.createDataFrame([(table[b], b) for b in range(256)], "token string, id int")
    merged = merges.select(F.concat("left", "right").alias("token"), (F.col("rank") + 256).cast("int").alias("id"))
    return base.unionByName(merged).groupBy("token").agg(F.min("id").alias("id"))


# ---------------------------------------------------------------------------
# normalisation and decoding
# ---------------------------------------------------------------------------

@F.pandas_udf(T.StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    import unicodedata
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def nfc(text) -> F.Column:
    """Unicode NFC normalisation (Spark has no built-in); ASCII rows pass through unchanged."""
    return _nfc(F.col(text) if isinstance(text, str) else text)


def pieces_to_text(pieces) -> F.Column:
    """Byte-level pieces -> text: undo the byte->character map, decode UTF-8, replace invalid bytes."""
    decoder = {ch: b for b, ch in C.bytes_to_unicode_table().items()}

    @F.pandas_udf(T.StringType())
    def undo(joined: pd.Series) -> pd.Series:
        return joined.map(lambda s: None if s is None else bytes(decoder[c] for c in s).decode("utf-8", "replace"))

    col = F.col(pieces) if isinstance(pieces, str) else pieces
    return undo(F.array_join(col, ""))


def decode_bpe(df: DataFrame, keys: list[str], ids_col: str, vocab: DataFrame,
               skip_special: bool = False, out: str = "text") -> DataFrame:
    """BPE ids -> text in one narrow pass; specials are kept as their text or dropped, unknown ids dropped.

    Consecutive byte pieces are decoded together (characters of several
    bytes); invalid bytes are replaced.
    """
    vp = vocab.select("token", F.col("id").cast("int").alias("id")).toPandas()
    decoder = {ch: b for b, ch in C.bytes_to_unicode_table().items()}
    pieces = {int(i): bytes(decoder[c] for c in t) for t, i in zip(vp["token"], vp["id"]) if all(c in decoder for c in t)}
    shared = df.sparkSession.sparkContext.broadcast((pieces, {i: t for t, i in C.SPECIAL_TOKENS}))

    def encode(rows):
        pieces, special = shared.value
        texts = []
        for ids in rows:
            parts, raw = [], bytearray()
            for i in ids or ():
                if i in special:
                    parts.append(raw.decode("utf-8", "replace"))
                    raw = bytearray()
                    if not skip_special:
                        parts.append(special[i])
                else:
                    raw.extend(pieces.get(i, b""))
            texts.append("".join(parts) + raw.decode("utf-8", "replace"))
        return (pa.array(texts, pa.string()),)

    return _narrow(df, keys, ids_col, [T.StructField(out, T.StringType())], encode)


# ---------------------------------------------------------------------------
# vocabulary tables: added tokens, size, export
# ---------------------------------------------------------------------------

def add_tokens(vocab: DataFrame, added: DataFrame) -> DataFrame:
    """Vocabulary plus added tokens; an added token's id wins over the base entry."""
    base = vocab.select("token", F.col("id").cast("int").alias("id"), F.lit(0).alias("_prio"))
    extra = added.select("token", F.col("id").cast("int").alias("id"), F.lit(1).alias("_prio"))
    return base.unionByName(extra).groupBy("token").agg(F.max_by("id", "_prio").alias("id"))


def vocab_size(vocab: DataFrame) -> int:
    return vocab.count()


def merge_rank_gaps(merges: DataFrame) -> DataFrame:
    """Ranks whose predecessor is missing (the export warns on these): an anti join, no ordered window."""
    prev = merges.select((F.col("rank") + 1).alias("rank"))
    return merges.filter(F.col("rank") > 0).select("rank").join(prev, "rank", "left_anti")


def export_model(vocab: DataFrame, merges: DataFrame, path: str) -> dict[str, str]:
    """Write ``vocab`` as one key-sorted JSON object and ``merges`` as a ranked text file.

    Both are model-sized tables (bounded), each written as a single file:
    ``<path>/vocab`` holds ``{"token": id, ...}`` sorted by token and
    ``<path>/merges`` holds the version header then ``left right`` by rank.
    """
    v = vocab.select(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("token", F.col("id").cast("int")))))).alias("value"))
    v.coalesce(1).write.mode("overwrite").text(f"{path}/vocab")
    header = merges.sparkSession.createDataFrame([(-1, C.MERGES_VERSION_HEADER)], "rank long, value string")
    lines = merges.select(F.col("rank").cast("long"), F.concat_ws(" ", "left", "right").alias("value"))
    (header.unionByName(lines).repartition(1).sortWithinPartitions("rank").select("value")
     .write.mode("overwrite").text(f"{path}/merges"))
    return {"vocab": f"{path}/vocab", "merges": f"{path}/merges"}
