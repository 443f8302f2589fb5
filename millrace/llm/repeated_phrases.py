"""Substring duplicates: recurring passages located by sharded Aho-Corasick automata.

A passage is a window of ``window`` consecutive words. Each window has an
anchor: the leftmost of its word ``GRAM``-grams with the smallest hash. Equal
windows have equal anchors, so every repeat of a window meets its other
occurrences under one anchor. The job

1. counts anchors over all documents and keeps those that occur again, as a
   bitmap of fixed size (it may let others through, it never misses one);
2. sends the stretches of text around such anchors to the shard of their anchor;
   where an anchor has more of them than a shard takes in at once (the borders of a
   hot passage differ in every document), each window goes to a shard of its own;
3. confirms in each shard which windows recur, compiles those into automata of
   bounded size, streams the shard's stretches through them and so finds every
   occurrence; all but the earliest one are to be removed;
4. brings the found spans back to their documents.

Every document's text is read in all of it, and the volume of each step grows in
proportion to the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import (count_bitmaps, hash_strings, may_recur, mix64, read, row_of, slices, split_words,
                                 window_hashes, word_codes)

WINDOW = 20
GRAM = 8
#: Bits of the bitmap of recurring anchors: its size is fixed (8 MB) whatever the input.
BITMAP_BITS = 1 << 26
#: Windows that a shard takes in at once, as long as their anchors allow a cut.
SHARD_WINDOWS = 60_000
#: Passages that one automaton is compiled for.
SHARD_PASSAGES = 20_000


def _leftmost_minimum(g: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in each run of ``width`` neighbours."""
    value, place, have = g, np.arange(len(g)), 1
    while have < width:
        step = min(have, width - have)
        right = value[step:] < value[:-step]
        value = np.where(right, value[step:], value[:-step])
        place = np.where(right, place[step:], place[:-step])
        have += step
    return place


def _segments(texts: pa.Array, window: int, gram: int):
    """Runs of windows that share an anchor occurrence.

    Returns the words, their offsets and hashes, and of each run: row, first word
    (in the row), number of windows, anchor hash.
    """
    words, offsets = split_words(texts)
    nothing = np.zeros(0, np.int64)
    n = len(words) - window + 1
    if n <= 0:
        return words, offsets, nothing, nothing, nothing, nothing, nothing.astype(np.uint64)
    codes, distinct = word_codes(words)
    h = hash_strings(distinct)[codes]
    g = window_hashes(h, gram)
    place = _leftmost_minimum(g, window - gram + 1)[:n]
    rows = row_of(offsets)
    whole = rows[:n] == rows[window - 1:]
    start = np.ones(n, bool)
    start[1:] = (place[1:] != place[:-1]) | (rows[1:n] != rows[:n - 1])
    first = np.flatnonzero(start & whole)
    # windows of a row that reach into the next one are not counted
    count = np.add.reduceat(whole, np.flatnonzero(start))[whole[start]].astype(np.int64) if len(first) else nothing
    return words, offsets, h, rows[first], first - offsets[rows[first]], count, g[place[first]]


def _same_words(h: np.ndarray, begin: np.ndarray, count: np.ndarray, window: int) -> np.ndarray:
    """Hash of each run: it has fewer windows than a window has words, so its first and last one cover it."""
    head, tail = np.zeros(len(begin), np.uint64), np.zeros(len(begin), np.uint64)
    for i in range(window):
        head = head * np.uint64(0x9E3779B97F4A7C15) + h[begin + i]
        tail = tail * np.uint64(0x9E3779B97F4A7C15) + h[begin + count - 1 + i]
    return mix64(mix64(head) * np.uint64(3) + mix64(tail) * np.uint64(5) + count.astype(np.uint64))


def recurring_anchors(docs: DataFrame, text_col: str, window: int, gram: int, bits: int,
                      shard_windows: int = SHARD_WINDOWS) -> list[np.ndarray]:
    """Bitmaps of the anchors that occur more than once in all of ``docs``, and of the hot ones.

    Stretches that are equal inside a slice of text travel once, and count once; an
    anchor is hot where they can hold more windows than ``shard_windows``.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                _, offsets, h, row, pos, windows, anchor = _segments(piece.column("text"), window, gram)
                found, place, n = np.unique(anchor, return_inverse=True, return_counts=True)
                again = np.flatnonzero(n[place] > 1)
                if len(again):
                    run = _same_words(h, (offsets[row] + pos)[again], windows[again], window)
                    order = np.lexsort((run, place[again]))
                    run, at = run[order], place[again][order]
                    new = np.ones(len(run), bool)
                    new[1:] = (run[1:] != run[:-1]) | (at[1:] != at[:-1])
                    n = np.where(n > 1, np.maximum(2, np.bincount(at[new], minlength=len(n))), 1)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))],
                                                 ["key", "n"])

    return count_bitmaps(docs.select(F.col(text_col).alias("text")).mapInArrow(count, "key long, n long"), bits,
                         [1, max(1, shard_windows // (window - gram + 1))])


def _letters(count: int) -> list[str] | None:
    """One character for each word number (none if there are more words than characters)."""
    if count > 1_000_000:
        return None
    return [chr(i if i < 0xD800 else i + 0x800) for i in range(1, count + 1)]


def _passages(stretches: list[tuple], window: int) -> Iterator[tuple]:
    """Confirmed passages of one anchor: (words, place of their earliest occurrence).

    ``stretches`` are distinct: (coded words, number of occurrences, earliest place).
    A passage is a longest run of recurring windows whose earliest occurrences also
    follow one another; so all its windows have one earliest occurrence in common.
    """
    if len(stretches) == 1:
        codes, n, first = stretches[0]
        if n > 1:
            yield codes, first
            return
    seen: dict = {}
    for codes, n, (order, pos) in stretches:
        for i in range(len(codes) - window + 1):
            phrase, here = codes[i:i + window], (order, pos + i)
            old = seen.get(phrase)
            if old is None:
                seen[phrase] = (here, n)
            else:
                seen[phrase] = (here if here < old[0] else old[0], old[1] + n)
    for codes, _, _ in stretches:
        begin, next_place, start = -1, None, None
        last = len(codes) - window + 1
        for i in range(last):
            place, n = seen[codes[i:i + window]]
            if begin >= 0 and (n < 2 or place != next_place):
                yield codes[begin:i + window - 1], start
                begin = -1
            if n > 1:
                if begin < 0:
                    begin, start = i, place
                next_place = (place[0], place[1] + 1)
        if begin >= 0:
            yield codes[begin:], start


def _locate(rows: list[tuple], window: int) -> Iterator[tuple]:
    """Spans to remove among stretches (anchor, id, tie, pos, text), sorted by anchor: (id, tie, start, end)."""
    number: dict[str, int] = {}
    groups: list[dict] = []
    last = None
    for key, ident, tie, pos, text in rows:
        if key != last or not groups:
            groups.append({})
            last = key
        groups[-1].setdefault(text, []).append(((ident is None, ident, tie), pos))
    # an anchor that occurs once holds nothing that recurs (equal windows have anchors at different places)
    groups = [g for g in groups if len(g) > 1 or len(next(iter(g.values()))) > 1]
    for g in groups:
        for text in g:
            for word in text.split(" "):
                number.setdefault(word, len(number))
    letters = _letters(len(number))

    def coded(text: str):
        codes = [number[w] for w in text.split(" ")]
        return tuple(codes) if letters is None else "".join([letters[c] for c in codes])

    known = [[(coded(text), places) for text, places in g.items()] for g in groups]
    passages = {}
    for g in known:
        for codes, first in _passages([(c, len(places), min(places)) for c, places in g], window):
            passages[codes] = first
    confirmed = list(passages.items())
    for lo in range(0, len(confirmed), SHARD_PASSAGES):
        automaton = ahocorasick.Automaton(*(() if letters else (ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)))
        for codes, first in confirmed[lo:lo + SHARD_PASSAGES]:
            automaton.add_word(codes, (len(codes), first))
        automaton.make_automaton()
        for g in known:
            for codes, places in g:
                found = [(end - n + 1, end + 1, first) for end, (n, first) in automaton.iter(codes)]
                for order, pos in places if found else ():
                    for begin, end, first in found:
                        if first != (order, pos + begin):
                            yield order[1], order[2], pos + begin, pos + end


def keyed_stretches(docs: DataFrame, id_col: str, text_col: str, window: int, gram: int, bits: int,
                    shard_windows: int) -> DataFrame:
    """Stretches of text that may hold repeats: ``key``, ``id``, ``tie``, ``pos``, ``n`` windows, ``text``.

    Equal windows have equal keys. A null text is a repeat that is settled already.
    """
    recurring, hot = map(docs.sparkSession.sparkContext.broadcast,
                         recurring_anchors(docs, text_col, window, gram, bits, shard_windows))
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("id", id_type),
                           T.StructField("tie", T.LongType()), T.StructField("pos", T.IntegerType()),
                           T.StructField("n", T.IntegerType()), T.StructField("text", T.StringType())])

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words, offsets, h, row, pos, n, anchor = _segments(piece.column("text"), window, gram)
                use = np.flatnonzero(may_recur(anchor, recurring.value))
                if not len(use):
                    continue
                row, pos, n, anchor = row[use], pos[use], n[use], anchor[use]
                alone = may_recur(anchor, hot.value)
                if alone.any():  # windows of hot anchors, one by one
                    times = np.where(alone, n, 1)
                    of = np.repeat(np.arange(len(n)), times)
                    pos = pos[of] + np.arange(len(of)) - (np.cumsum(times) - times)[of]
                    row, n, anchor, alone = row[of], np.where(alone, 1, n)[of], anchor[of], alone[of]
                base = offsets[row] + pos
                run = _same_words(h, base, n, window)
                anchor = np.where(alone, mix64(anchor ^ run), anchor)
                ident, tie = piece.column("id"), piece.column("tie").to_numpy(zero_copy_only=False)
                keys = ident.to_pylist()
                # of equal stretches in this slice the earliest goes on; the others are repeats for certain
                rank = np.zeros(len(keys), np.int64)
                rank[sorted(range(len(keys)), key=lambda r: (keys[r] is None, keys[r], tie[r]))] = np.arange(len(keys))
                place = rank[row]
                order = np.lexsort((pos, place, run, anchor))
                same = np.zeros(len(order), bool)
                same[1:] = (run[order[1:]] == run[order[:-1]]) & (anchor[order[1:]] == anchor[order[:-1]])
                repeat = np.zeros(len(order), bool)
                repeat[order[same]] = True
                # rows that repeat a document are that document: their stretches are not repeats of it
                if len({(k, t) for k, t in zip(keys, tie.tolist())}) < len(keys):
                    head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
                    for i, f in zip(order[same].tolist(), head[same].tolist()):
                        if (keys[row[i]], tie[row[i]], pos[i]) == (keys[row[f]], tie[row[f]], pos[f]):
                            repeat[i] = False
                # repeats that follow one another are one row
                joins = np.zeros(len(row), bool)
                joins[1:] = repeat[1:] & repeat[:-1] & (row[1:] == row[:-1]) & (pos[1:] == pos[:-1] + n[:-1])
                head = np.flatnonzero(~joins)
                n = np.add.reduceat(n, head)
                row, pos, anchor, base, repeat = row[head], pos[head], anchor[head], base[head], repeat[head]
                text = [None] * len(row)
                lo, hi = (int(base.min()), int((base + n).max()) + window - 1)
                flat = words.slice(lo, hi - lo).to_pylist()
                for i in np.flatnonzero(~repeat).tolist():
                    a = int(base[i]) - lo
                    text[i] = " ".join(flat[a:a + int(n[i]) + window - 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), ident.take(pa.array(row)), pa.array(tie[row], pa.int64()),
                     pa.array(pos, pa.int32()), pa.array(n, pa.int32()), pa.array(text, pa.string())],
                    ["key", "id", "tie", "pos", "n", "text"])

    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("tie"),
                         F.col(text_col).alias("text"))
    return source.mapInArrow(stretches, schema)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM, bits: int = BITMAP_BITS, shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """Spans of words (``start`` to ``end``, exclusive) covered by windows that also start earlier.

    Columns: the id, ``tie`` (xxhash64 of the text), ``start``, ``end``. Spans may
    overlap. Of equal windows the one in the smallest id, then at the smallest
    word, is the earliest; null ids come last; one id with several texts orders
    them by ``tie``; rows that repeat id and text are one document.
    """
    gram = min(gram, window)
    spans = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("tie", T.LongType()),
                          T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, windows, last = [], 0, None

        def out(found) -> pa.RecordBatch:
            columns = list(zip(*found)) or [[], [], [], []]
            types = [id_arrow, pa.int64(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              [id_col, "tie", "start", "end"])

        for batch in batches:
            id_arrow = batch.schema.field("id").type
            direct = []
            for key, ident, tie, pos, n, text in zip(*(c.to_pylist() for c in batch.columns)):
                if text is None:
                    direct.append((ident, tie, pos, pos + n + window - 1))
                    continue
                if windows >= shard_windows and key != last:
                    yield out(list(_locate(held, window)))
                    held, windows = [], 0
                held.append((key, ident, tie, pos, text))
                windows, last = windows + n, key
            if direct:
                yield out(direct)
        if held:
            yield out(list(_locate(held, window)))

    # repeats that are settled already only pass through: they are dealt out evenly
    return (keyed_stretches(docs, id_col, text_col, window, gram, bits, shard_windows)
            .withColumn("key", F.when(F.col("text").isNull(), F.xxhash64("key", "id", "pos")).otherwise(F.col("key")))
            .repartition("key").sortWithinPartitions("key").mapInArrow(shard, spans))


def drop_repeated_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          window: int = WINDOW, gram: int = GRAM, bits: int = BITMAP_BITS,
                          shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """Per row of ``docs``: the id, ``n_words``, ``n_removed``, ``kept_text`` (kept words, one space between).

    A word goes when a window that covers it, judged on the input, also starts
    earlier. Null and empty texts have no words; texts shorter than the window
    lose none. Rows that repeat id and text give equal rows; other columns are
    not read; an empty table gives no rows.
    """
    spans = repeated_spans(docs, id_col, text_col, window, gram, bits, shard_windows)
    by_doc = (spans.groupBy(F.col(id_col).alias("__id"), F.col("tie").alias("__tie"))
              .agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("tie"),
                         F.col(text_col).alias("text"))
    joined = source.join(by_doc.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("__id"))
                         & (F.col("tie") == F.col("__tie")), "left").select("id", "text", "spans")
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = (text or "").encode().split()
                n_words.append(len(words))
                gone = 0
                if spans:
                    pieces, at = [], 0
                    for begin, end in sorted((s["start"], s["end"]) for s in spans):
                        if begin > at:
                            pieces.extend(words[at:begin])
                        gone += max(0, end - max(at, begin))
                        at = max(at, end)
                    words = pieces + words[at:]
                n_removed.append(gone)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.string())], [id_col, "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(cut, schema)


def op1_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 20 words that occur earlier."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_phrases(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
