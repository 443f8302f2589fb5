"""N-gram Jaccard self-join by T-occurrence search.

Documents are sets of word-shingle hashes. Two sets link when their Jaccard
similarity reaches ``num / den``. The join narrows exactly, never by a cap:

1. In hash order, a set that links with another shares a known number of tokens
   with it among the first ones of both (prefix bound). Sets with fewer tokens there
   that another set has as well link with nothing. Tokens are counted in shards; a
   bitmap of fixed size names the sets that go on, so it fills with sets, not tokens.
2. The frequency of each remaining set's tokens is counted; rare tokens come
   first, and sets that share a token of their (shorter) prefixes are candidates.
3. Each group of candidates is searched with inverted lists: the lists of a query
   that are short are heap-merged, long ones are probed by bisection (DivideSkip),
   and sets that reach the required overlap link. Groups larger than a block are
   searched block against block.

Equal sets are one vertex, so copies are never paired with each other.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import (connected_components, hash_strings, lower_ascii, may_recur, mix64, read,
                                 recurring_bitmap, release_memory, row_of, shuffle_parts, slices, split_words, window_hashes,
                                 word_codes, written)

WORDS = 4
SIMILARITY = (85, 100)
#: Bits of the map of sets that may link.
BITMAP_BITS = 1 << 26
#: Tokens of candidate sets that one search task holds.
BLOCK_TOKENS = 2_000_000
#: Share of a set that must recur among the tokens of its long prefix.
COMMON_SHARE = 0.25
#: Bytes of text whose shingles a task holds at once, and that one block of sets covers.
TEXT_BYTES = 2 << 20


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text: (row, token) sorted by both, and each row's set size.

    A text with fewer than ``k`` words has its whole sequence as one shingle; one
    without words has none.
    """
    n_rows = len(texts)
    words, offsets = split_words(lower_ascii(texts))
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(n_rows, np.int64)
    codes, distinct = word_codes(words)
    h = hash_strings(distinct)[codes]
    g, rows, length = window_hashes(h, k), row_of(offsets), np.diff(offsets)
    whole = rows[:len(g)] == rows[k - 1:] if len(g) else np.zeros(0, bool)
    row, token = rows[:len(g)][whole], g[whole]
    short = np.flatnonzero((length > 0) & (length < k))
    if len(short):
        extra = np.array([window_hashes(h[offsets[r]:offsets[r + 1]], int(length[r]))[0] for r in short], np.uint64)
        row = np.concatenate((row, short))
        token = np.concatenate((token, mix64(extra + length[short].astype(np.uint64))))
    order = np.lexsort((token, row))
    row, token = row[order], token[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (token[1:] != token[:-1])
    row, token = row[new], token[new]
    return row, token, np.bincount(row, minlength=n_rows)


def _at_least(n: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    """Tokens that a set of ``n`` shares with any set it links with, at least."""
    num, den = similarity
    return -(-n * num // den)


def _long_prefix(n: np.ndarray, similarity: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Length of the long prefix, and how many of its tokens a partner has in its own at least."""
    need = _at_least(n, similarity)
    common = np.maximum(1, (n * COMMON_SHARE).astype(np.int64))
    # a partner is at least as large as ``need``
    least = np.maximum(1, (need * COMMON_SHARE).astype(np.int64))
    return np.minimum(n, n - need + np.minimum(common, need)), np.minimum(least, common)


def _set_hash(row: np.ndarray, token: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hash of each row's set (0 tokens: any value, not used)."""
    total, mixed = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
    np.add.at(total, row, mix64(token))
    np.bitwise_xor.at(mixed, row, mix64(token + np.uint64(0x632BE59BD9B4E019)))
    return mix64(total * np.uint64(3) + mix64(mixed) + size.astype(np.uint64))


#: Places in short lists up to which a heap merges them; longer ones are merged as sorted runs.
HEAP_PLACES = 512


class Lists:
    """Inverted lists of sets (arrays of token numbers), searched by DivideSkip."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(t) for t in sets], np.int64)
        tokens = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        order = np.argsort(tokens, kind="stable")  # places ascend inside each list
        self.places = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.begin = np.searchsorted(tokens[order], np.arange(int(tokens.max(initial=-1)) + 2))

    def search(self, tokens: np.ndarray, num: int, den: int, wanted: np.ndarray) -> Iterator[int]:
        """Wanted places whose set has a similarity of ``num / den`` or more to ``tokens``.

        ``wanted`` (one flag per place) is read again before each answer, so that the
        caller may strike places off meanwhile.
        """
        n = len(tokens)
        least = -(-n * num // den)
        tokens = tokens[tokens < len(self.begin) - 1]
        length = self.begin[tokens + 1] - self.begin[tokens]
        tokens, length = tokens[length > 0], length[length > 0]
        if len(tokens) < least:
            return
        order = np.argsort(length, kind="stable")
        lists = [self.places[self.begin[t]:self.begin[t + 1]] for t in tokens[order].tolist()]
        # the longest lists are set aside: whatever occurs ``least`` times in all of them
        # occurs at least once in the others
        aside = least - 1
        short, long = lists[:len(lists) - aside], lists[len(lists) - aside:]
        if length.sum() <= HEAP_PLACES:
            merged = np.fromiter(heapq.merge(*(x.tolist() for x in short)), np.int64)
        else:
            merged = np.sort(np.concatenate(short), kind="stable")
        place, count = np.unique(merged, return_counts=True)
        m = self.sizes[place]
        fit = wanted[place] & (m * den >= n * num) & (n * den >= m * num)
        place, count = place[fit], count[fit]
        need = -(-num * (n + self.sizes[place]) // (num + den))
        for k in range(len(long)):
            if not len(place):
                return
            at = np.searchsorted(long[k], place)
            count = count + (long[k][np.minimum(at, len(long[k]) - 1)] == place)
            open_ = count + len(long) - k - 1 >= need
            if not open_.all():
                place, count, need = place[open_], count[open_], need[open_]
        for x in place[count >= need].tolist():
            if wanted[x]:
                yield x


def _root(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def link_sets(left: list[np.ndarray], right: list[np.ndarray] | None, similarity: tuple[int, int]) -> list[tuple[int, int]]:
    """Edges that span the links among ``left``, or between ``left`` and ``right``.

    Sets are numbered, those of ``right`` after those of ``left``. Every set is a
    query; what it is already joined with is not searched for again.
    """
    num, den = similarity
    index = left if right is None else right
    shift = 0 if right is None else len(left)
    lists = Lists(index)
    parent = list(range(len(left) + (0 if right is None else len(right))))
    members = {x: [x] for x in parent}  # by root
    edges = []
    wanted = np.ones(len(index), bool)
    for name, tokens in enumerate(left):
        mine = [x - shift for x in members[_root(parent, name)] if x >= shift]
        wanted[mine] = False
        for place in lists.search(tokens, num, den, wanted):
            a, b = _root(parent, name), _root(parent, place + shift)
            edges.append((name, place + shift))
            if len(members[a]) < len(members[b]):
                a, b = b, a
            parent[b] = a
            gained = members.pop(b)
            members[a] += gained
            mine = [x - shift for x in members[a] if x >= shift]
            wanted[mine] = False
        wanted[[x - shift for x in members[_root(parent, name)] if x >= shift]] = True
    return edges


def _pack(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def _unpacked(batch: pa.RecordBatch, *columns: tuple[str, type]) -> Iterator[tuple[np.ndarray, ...]]:
    """Packed numbers of each row, read in place: no copy of a whole batch of blocks."""
    for row in range(batch.num_rows):
        yield tuple(np.frombuffer(batch.column(c)[row].as_buffer(), t) for c, t in columns)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                       similarity: tuple[int, int] = SIMILARITY, bits: int = BITMAP_BITS,
                       block_tokens: int = BLOCK_TOKENS, tie: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_shingles`` and ``component_id``.

    With ``tie`` also ``tie`` (xxhash64 of the text), which tells rows that repeat an id apart.

    ``component_id`` is the smallest id reachable by links, the row's own included.
    Words are runs of characters other than ASCII white space, A-Z lower-cased.
    Texts without words (null, empty, blank) have no shingle and link with nothing.
    Rows that repeat an id share what their texts link with; null ids link too but
    never name a component unless all its ids are null. Other columns are not read;
    an empty table gives no rows. Tokens and sets are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    parts = shuffle_parts(spark)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                         *([F.xxhash64(F.col(text_col)).alias("tie")] if tie else []))
    ties = ["ties"] if tie else []

    def cut(shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order by shard, and where each shard begins and ends in it."""
        order = np.argsort(shard, kind="stable")
        return order, np.searchsorted(shard[order], np.arange(parts + 1))

    def send_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """To each shard its tokens of the long prefixes with the names of their sets, and its sets with what they need."""
        for batch in batches:
            for piece in slices(batch, "text", TEXT_BYTES):
                row, token, size = shingle_sets(piece.column("text"), words)
                prefix, least = _long_prefix(size, similarity)
                name = _set_hash(row, token, size)
                own, at = np.unique(np.where(size > 0, name, 0), return_index=True)
                own, at = own[size[at] > 0], at[size[at] > 0]
                first = np.zeros(len(size), bool)
                first[at] = True
                rank = np.arange(len(row)) - (np.cumsum(size) - size)[row]
                use = first[row] & (rank < prefix[row])
                token, name = token[use], name[row[use]]
                order, ends = cut((token % np.uint64(parts)).astype(np.int64))
                token, name = token[order], name[order]
                order, set_ends = cut((own % np.uint64(parts)).astype(np.int64))
                own, need = own[order], least[at][order]
                to = [s for s in range(parts) if ends[s + 1] > ends[s] or set_ends[s + 1] > set_ends[s]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int32()), *(pa.array([_pack(x[e[s]:e[s + 1]]) for s in to], pa.binary())
                                                 for x, e in ((token, ends), (name, ends), (own, set_ends), (need, set_ends)))],
                    ["shard", "tokens", "names", "sets", "least"])
        release_memory()

    def joined(table: pa.Table, column: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in table[column]])

    def recurring_names(table: pa.Table) -> pa.Table:
        """Names with each of their tokens that other sets of the shard have as well, by the shard of the name."""
        token, name = joined(table, "tokens", np.uint64), joined(table, "names", np.uint64)
        order = np.lexsort((name, token))
        token, name = token[order], name[order]
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        once = new.copy()
        once[1:] |= name[1:] != name[:-1]  # a copy of a set is the same set
        token, name, new = token[once], name[once], new[once]
        several = np.diff(np.append(np.flatnonzero(new), len(new))) > 1
        name = name[several[np.cumsum(new) - 1]] if len(name) else name
        order, ends = cut((name % np.uint64(parts)).astype(np.int64))
        name = name[order]
        to = [s for s in range(parts) if ends[s + 1] > ends[s]]
        here = int(table["shard"][0].as_py())
        return pa.table({
            "shard": pa.array([*to, here], pa.int32()),
            "names": pa.array([*(_pack(name[ends[s]:ends[s + 1]]) for s in to), b""], pa.binary()),
            "sets": pa.array([*(b"" for _ in to), _pack(joined(table, "sets", np.uint64))], pa.binary()),
            "least": pa.array([*(b"" for _ in to), _pack(joined(table, "least", np.int64))], pa.binary())})

    def linkable(table: pa.Table) -> pa.Table:
        """Names of the sets that have enough recurring tokens."""
        own, at = np.unique(joined(table, "sets", np.uint64), return_index=True)
        found, n = np.unique(joined(table, "names", np.uint64), return_counts=True)
        enough = own[np.searchsorted(own, found)[n >= joined(table, "least", np.int64)[at][np.searchsorted(own, found)]]]
        return pa.table({"key": pa.array(enough.view(np.int64)), "n": pa.array(np.full(len(enough), 2), pa.int64())})

    kept = (source.select("text").mapInArrow(send_prefixes, "shard int, tokens binary, names binary, sets binary, least binary")
            .groupBy("shard").applyInArrow(recurring_names, "shard int, names binary, sets binary, least binary")
            .groupBy("shard").applyInArrow(linkable, "key long, n long"))
    bitmap = spark.sparkContext.broadcast(recurring_bitmap(kept, bits))

    block_schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("n", T.ArrayType(T.LongType())), T.StructField("sets", T.ArrayType(T.LongType())),
        T.StructField("names", T.BinaryType()), T.StructField("sizes", T.BinaryType()),
        T.StructField("tokens", T.BinaryType()), *(T.StructField(c, T.ArrayType(T.LongType())) for c in ties)])

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = 0
        for batch in batches:
            for piece in slices(batch, "text", TEXT_BYTES):
                row, token, size = shingle_sets(piece.column("text"), words)
                name = _set_hash(row, token, size)
                keep = (size > 0) & may_recur(name, bitmap.value)
                first = np.zeros(len(size), bool)
                first[np.unique(name, return_index=True)[1]] = True
                keep &= first | (size == 0)
                chosen = keep[row]
                part = int(piece.column("part")[0].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) + serial], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, piece.num_rows], pa.int32()), piece.column("id")),
                     pa.ListArray.from_arrays(pa.array([0, len(size)], pa.int32()), pa.array(size, pa.int64())),
                     pa.ListArray.from_arrays(pa.array([0, len(size)], pa.int32()), pa.array(name.view(np.int64))),
                     pa.array([_pack(name[keep])], pa.binary()), pa.array([_pack(size[keep])], pa.binary()),
                     pa.array([_pack(token[chosen])], pa.binary()),
                     *(pa.ListArray.from_arrays(pa.array([0, len(size)], pa.int32()), piece.column("tie")) for _ in ties)],
                    [f.name for f in block_schema.fields])
                serial += 1
        release_memory()

    # a row is megabytes of hashes: without these, a page or a row group is a hundred rows at least
    blocks = written(source.withColumn("part", F.spark_partition_id()).mapInArrow(to_blocks, block_schema), "shingles", {
        "compression": "uncompressed", "parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1",
        "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1"})

    def shares(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct tokens of a block in order of their shard: tokens, counts, cuts, and each token's place."""
        distinct, place, n = np.unique(tokens, return_inverse=True, return_counts=True)
        shard = (distinct % np.uint64(parts)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return distinct[order], n[order], np.searchsorted(shard[order], np.arange(parts + 1)), back[place]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, (raw,) in zip(batch.column("block").to_pylist(), _unpacked(batch, ("tokens", np.uint64))):
                tokens, n, cuts, _ = shares(raw)
                to = [s for s in range(parts) if cuts[s + 1] > cuts[s]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int32()), pa.array([block] * len(to), pa.int64()),
                     pa.array([_pack(tokens[cuts[s]:cuts[s + 1]]) for s in to], pa.binary()),
                     pa.array([_pack(n[cuts[s]:cuts[s + 1]].astype(np.uint32)) for s in to], pa.binary())],
                    ["shard", "block", "tokens", "n"])

    def frequencies(table: pa.Table) -> pa.Table:
        """Sum the counts of one shard's tokens and answer every block in its own order."""
        raw = [np.frombuffer(b, np.uint64) for b in table["tokens"].to_pylist()]
        _, place = np.unique(np.concatenate(raw), return_inverse=True)
        total = np.bincount(place, np.concatenate([np.frombuffer(b, np.uint32) for b in table["n"].to_pylist()]))
        cut = np.cumsum([0, *map(len, raw)])
        own = np.minimum(total[place], 2**32 - 1).astype(np.uint32)
        return pa.table({"block": table["block"], "shard": table["shard"], "n": pa.array(
            [_pack(own[cut[i]:cut[i + 1]]) for i in range(len(raw))], pa.binary())})

    answers = (blocks.select("block", "tokens").mapInArrow(send, "shard int, block long, tokens binary, n binary")
               .groupBy("shard").applyInArrow(frequencies, "block long, shard int, n binary")
               .groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("answers")))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, (names, sizes, tokens) in enumerate(_unpacked(
                    batch, ("names", np.uint64), ("sizes", np.int64), ("tokens", np.uint64))):
                place = shares(tokens)[3]
                got = batch.column("answers")[at].values.field("n")
                n = np.concatenate([np.frombuffer(a.as_buffer(), np.uint32) for a in got])[place]
                row = np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((tokens, n, row))  # rare tokens first
                rank = np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row]
                use = order[(rank < (sizes - _at_least(sizes, similarity) + 1)[row]) & (n[order] > 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens[use].view(np.int64)), pa.array(names[row[use]].view(np.int64))], ["token", "name"])
        release_memory()

    shared = (blocks.select("block", "names", "sizes", "tokens").join(answers, "block")
              .mapInArrow(prefixes, "token long, name long"))

    def star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted (token, name): an edge from the first set of each token to its others."""
        token_now, first_now = None, None
        for batch in batches:
            token, name = (batch.column(c).to_numpy() for c in ("token", "name"))
            if not len(token):
                continue
            start = np.ones(len(token), bool)
            start[1:] = token[1:] != token[:-1]
            start[0] = token[0] != token_now
            at = np.maximum.accumulate(np.where(start, np.arange(len(token)), -1))
            first = np.where(at >= 0, name[np.maximum(at, 0)], first_now if first_now is not None else 0)
            token_now, first_now = token[-1], first[-1]
            other = first != name
            pairs = np.unique(np.stack([name[other], first[other]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    candidates = (shared.repartition("token").sortWithinPartitions("token", "name")
                  .mapInArrow(star, "a long, b long"))
    groups = written(connected_components(candidates, "candidates").select(
        F.col("id").alias("name"), F.col("component").alias("group")), "candidate-groups")

    # a set that lies in several blocks is taken from the first one
    owner = (blocks.select("block", "names").mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays(
            [pa.array(np.frombuffer(b, np.int64)), pa.array(np.full(len(b) // 8, k, np.int64))], ["name", "block"])
            for batch in batches for k, b in zip(batch.column("block").to_pylist(), batch.column("names").to_pylist())),
        "name long, block long").groupBy("name").agg(F.min("block").alias("block")))
    wanted = groups.join(owner, "name")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, (names, sizes, raw) in enumerate(_unpacked(
                    batch, ("names", np.int64), ("sizes", np.int64), ("tokens", np.uint64))):
                mine, group = batch.column("mine")[at].as_py(), batch.column("groups")[at].as_py()
                raw = raw.tobytes()
                ends = dict(zip(names.tolist(), zip((np.cumsum(sizes) * 8).tolist(), sizes.tolist())))
                cut = [ends[m] for m in mine]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group, pa.int64()), pa.array(mine, pa.int64()), pa.array([s for _, s in cut], pa.int64()),
                     pa.array([raw[e - 8 * s:e] for e, s in cut], pa.binary())], ["group", "name", "size", "tokens"])

    by_block = wanted.groupBy("block").agg(F.collect_list(F.struct("name", "group")).alias("w")).select(
        "block", F.col("w.name").alias("mine"), F.col("w.group").alias("groups"))
    sets = (blocks.select("block", "names", "sizes", "tokens").join(by_block, "block")
            .mapInArrow(take, "group long, name long, size long, tokens binary"))
    # groups beyond one block of tokens: each set meets the sets of every block once
    size_of = (blocks.select("names", "sizes").mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays(
            [pa.array(np.frombuffer(a, np.int64)), pa.array(np.frombuffer(b, np.int64))], ["name", "size"])
            for batch in batches for a, b in zip(batch.column("names").to_pylist(), batch.column("sizes").to_pylist())),
        "name long, size long").dropDuplicates(["name"]))
    large = (groups.join(size_of, "name").groupBy("group").agg(F.sum("size").alias("total"))
             .filter(F.col("total") > block_tokens)
             .select("group", F.ceil(F.col("total") / block_tokens).cast("int").alias("cuts")))
    large = written(large, "large-groups")
    placed = (sets.join(large, "group", "left")
              .withColumn("cuts", F.coalesce("cuts", F.lit(1)))
              .withColumn("own", F.pmod(F.xxhash64("name"), F.col("cuts")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
              .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))

    def search(table: pa.Table) -> pa.Table:
        rows = {name: (np.frombuffer(raw, np.uint64), own) for name, raw, own in zip(
            table["name"].to_pylist(), table["tokens"].to_pylist(), table["own"].to_pylist())}
        everything = np.concatenate([t for t, _ in rows.values()])
        _, place = np.unique(everything, return_inverse=True)
        cut = np.cumsum([0, *(len(t) for t, _ in rows.values())])
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        sides: tuple[list, list] = ([], [])
        own_names: tuple[list, list] = ([], [])
        for k, (name, (_, own)) in enumerate(rows.items()):
            sides[0 if own == i else 1].append(place[cut[k]:cut[k + 1]])
            own_names[0 if own == i else 1].append(name)
        found = link_sets(sides[0], sides[1] if i != j else None, similarity)
        names = [*own_names[0], *own_names[1]]
        # one star for each linked group: its members and its smallest name
        parent = list(range(len(names)))
        for a, b in found:
            a, b = _root(parent, a), _root(parent, b)
            parent[a if names[a] > names[b] else b] = b if names[a] > names[b] else a
        linked = [x for x in range(len(names)) if _root(parent, x) != x]
        return pa.table({"a": pa.array([names[x] for x in linked], pa.int64()),
                         "b": pa.array([names[_root(parent, x)] for x in linked], pa.int64())})

    links = placed.groupBy("group", "i", "j").applyInArrow(search, "a long, b long")
    if large.isEmpty():  # each group was searched as a whole: its stars are the components
        links = written(links, "links")
        linked = links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
            links.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id")))
    else:
        linked = connected_components(links, "links")
    tie_of = ["tie"] if tie else []
    rows = blocks.select(F.explode(F.arrays_zip("ids", "n", "sets", *ties)).alias("r")).select(
        F.col("r.ids").alias("id"), F.col("r.n").alias("n"), F.col("r.sets").alias("set"),
        *(F.col("r.ties").alias(c) for c in tie_of))
    vertex = written(rows.join(linked, rows["set"] == linked["id"], "left").select(
        rows["id"].alias("id"), "n", *tie_of, F.when(F.col("n") == 0, None).otherwise(
            F.coalesce("component", "set")).alias("root")), "rows-by-component")
    least = written(vertex.filter("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("component_id")), "least-ids")
    return vertex.join(least, "root", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"), *tie_of)


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                       similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """``docs`` without near duplicates: of each linked group the smallest id stays (all its rows in the group).

    Rows go by id and text: what repeats an id, or has none, stays where its own
    text is no near copy. Rows with a null id stay where nothing with an id links
    with them.
    """
    found = jaccard_components(docs, id_col, text_col, words, similarity, tie=True)
    dropped = written(found.filter(~F.col(id_col).eqNullSafe(F.col("component_id"))).select(
        F.col(id_col).alias("__gone"), F.col("tie").alias("__tie")).distinct(), "near-copies")
    return docs.join(dropped, F.col(id_col).eqNullSafe(F.col("__gone"))
                     & (F.xxhash64(F.col(text_col)) == F.col("__tie")), "left_anti")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of linked documents among all of them."""
    return jaccard_components(read(spark, sf_dir, "documents").select("doc_id", "text"))
