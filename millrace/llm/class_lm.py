"""Language-model scores from Brown class bigrams.

Exchange clustering puts words into classes so that neighbouring classes tell
most about each other. The most frequent training words start it, trading places
among themselves; then every word of the vocabulary takes the class that its
neighbours ask for, in rounds over all of the corpus, each with the classes that
the round before left. A text's probability is the product of class transitions
and word emissions; a word that no training text has gets its share of an open
vocabulary.

Texts are read once into blocks: numbered words and the list of distinct words.
Word counts and the evidence for classes are added up in shards of the words,
which answer each block in its own order; no vocabulary is broadcast or collected.
Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import (crc_mod, hash_strings, lower_ascii, read, row_of, shuffle_parts, slices, split_words,
                                 word_codes, written)

#: Least number of classes; the number grows with the fourth root of the vocabulary.
CLASSES = 16
#: Least number of words that start the clustering, and their number for each class.
SEED_WORDS, SEEDS_PER_CLASS = 800, 20
#: Rounds of exchange among the seed words, and rounds in which every word may change its class.
ROUNDS, MOVES = 6, 2
SMOOTHING = 0.1


def _squeeze(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def _unsqueeze(raw: bytes, dtype) -> np.ndarray:
    n, width = int.from_bytes(raw[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.zeros(0, dtype)
    planes = np.frombuffer(pa.decompress(raw[8:], n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(dtype).ravel()


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange_classes(counts: np.ndarray, fixed: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Exchange clustering of words by their bigram counts.

    ``counts[v, w]`` says how often w follows v. Words with ``fixed >= 0`` keep
    that class (from ``classes`` on); the others start in frequency order, round
    robin, and move to the class that raises the likelihood of the class bigrams
    most, until nothing moves or the rounds are over.
    """
    n = len(counts)
    total = int(max(classes, fixed.max(initial=-1) + 1))
    free = np.flatnonzero(fixed < 0)
    free = free[np.argsort(-(counts[free].sum(1) + counts[:, free].sum(0)), kind="stable")]
    own = fixed.copy()
    own[free] = np.arange(len(free)) % classes
    member = np.zeros((n, total))
    member[np.arange(n), own] = 1
    table = member.T @ counts @ member
    for _ in range(rounds):
        moved = 0
        for w in free:
            a = own[w]
            before, after, self_count = counts[:, w] @ member, counts[w] @ member, counts[w, w]
            before[a] -= self_count
            after[a] -= self_count
            table[:, a] -= before
            table[a, :] -= after
            table[a, a] -= self_count
            left, right = table.sum(1), table.sum(0)
            # likelihood gained by adding the word to each class
            into = table[:, :classes] + before[:, None]
            out = table[:classes] + after[None, :]
            gain = (_f(into) - _f(table[:, :classes])).sum(0) + (_f(out) - _f(table[:classes])).sum(1)
            c = np.arange(classes)
            now = table[c, c]
            gain -= _f(into[c, c]) - _f(now) + _f(out[c, c]) - _f(now)
            gain += _f(now + before[c] + after[c] + self_count) - _f(now)
            gain -= _f(left[:classes] + after.sum() + self_count) - _f(left[:classes])
            gain -= _f(right[:classes] + before.sum() + self_count) - _f(right[:classes])
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = a
            table[:, best] += before
            table[best, :] += after
            table[best, best] += self_count
            if best != a:
                member[w, a], member[w, best], own[w] = 0, 1, best
                moved += 1
        if not moved:
            break
    return own


def _neighbours(value: np.ndarray, offsets: np.ndarray, edge: int) -> tuple[np.ndarray, np.ndarray]:
    """What stands before and after each word; ``edge`` at the ends of a text."""
    before, after = np.empty_like(value), np.empty_like(value)
    if len(value):
        before[1:], after[:-1] = value[:-1], value[1:]
        has = np.diff(offsets) > 0
        before[offsets[:-1][has]] = edge
        after[offsets[1:][has] - 1] = edge
    return before, after


def _lookup(hashes: np.ndarray, keys: np.ndarray, values: np.ndarray, default: int) -> np.ndarray:
    """``values`` of the sorted ``keys`` for each hash, ``default`` for others."""
    if not len(keys):
        return np.full(len(hashes), default)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where(keys[at] == hashes, values[at], default)


def class_count(kinds: int) -> int:
    """Classes for a vocabulary of ``kinds`` words."""
    return max(CLASSES, round(kinds ** 0.25))


def class_information(table: np.ndarray) -> float:
    """What one class tells about the next, in bits a token: the part of the bigram likelihood that classes decide."""
    total = table.sum()
    if not total:
        return 0.0
    p = table / total
    free = p.sum(1, keepdims=True) * p.sum(0, keepdims=True)
    held = p > 0
    return float((p[held] * np.log2(p[held] / free[held])).sum())


def _evidence(between: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """What each neighbour's class says for each class of a word, and what speaks for a class without neighbours.

    Rows: the classes (and the start) before the word, then the classes (and the end) after it.
    """
    ratio = np.log(between * between.sum() / (between.sum(1, keepdims=True) * between.sum(0, keepdims=True)))
    return (np.concatenate((ratio[:classes + 1, :classes], ratio[:classes, :classes + 1].T)),
            np.log(between[:, :classes].sum(0) / between.sum()))


def _each(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The rows of a batch, one at a time: a row is a whole block."""
    for at in range(batch.num_rows):
        yield tuple(batch.column(name)[at].as_py() for name in names)


def _cut_shards(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's words in the order of their shards, and where each shard begins."""
    shard = (hashes % np.uint64(parts)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(parts + 1))


def _answered(hashes: np.ndarray, got: list | None, parts: int, unknown: int) -> tuple[np.ndarray, np.ndarray]:
    """Training counts and classes of a block's words, from the answers of its shards."""
    n, cls = np.zeros(len(hashes), np.int64), np.full(len(hashes), unknown, np.int64)
    if got:
        order, _ = _cut_shards(hashes, parts)
        n[order] = np.concatenate([_unsqueeze(a["n"], np.int64) for a in got])
        cls[order] = np.concatenate([_unsqueeze(a["cls"], np.uint16) for a in got])
    return n, cls


def _steps(own: np.ndarray, offsets: np.ndarray, width: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Class steps of each text (into every word, then into the end) as before * width + after, and each step's text."""
    rows = len(offsets) - 1
    before, _ = _neighbours(own, offsets, end)
    last = np.full(rows, end)
    has = np.diff(offsets) > 0
    last[has] = own[offsets[1:][has] - 1]
    return np.concatenate((before * width + own, last * width + end)), np.concatenate((row_of(offsets), np.arange(rows)))


def _whole_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _summed(rows: DataFrame, column: str, size: int) -> np.ndarray:
    """Sum of an array column of ``size`` numbers, place by place."""
    out = np.zeros(size)
    for r in rows.select(F.posexplode(column).alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


@dataclass(frozen=True)
class ClassModel:
    """Words of all texts in blocks, the shards' answers to them, and the sizes of the model."""

    blocks: DataFrame
    answers: DataFrame
    id_col: str
    classes: int
    parts: int
    ends: int           # training texts
    kinds: int          # distinct training tokens, the end among them
    once: int           # words that training has once
    of_class: np.ndarray
    information: list[float]  # bits a token before each round over all words

    def with_answers(self) -> DataFrame:
        return _join_answers(self.blocks, self.answers)


def _join_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    by_block = answers.filter("block IS NOT NULL").groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("shard", "n", "cls"))).alias("answers"))
    return blocks.drop("counts").join(by_block, "block", "left")


def fit_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_col: str = "train",
                classes: int | None = None, seeds: int | None = None, moves: int = MOVES) -> ClassModel:
    """Word counts and word classes of the rows whose ``train_col`` is true; blocks of all rows.

    ``classes`` and ``seeds`` follow from the training vocabulary where they are
    not given. The seed words are the most frequent ones by their exact counts.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    parts = shuffle_parts(spark)
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(train_col), F.lit(False)).alias("train"),
                         F.col(text_col).alias("text"), F.spark_partition_id().alias("part"))
    block_fields = [T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)),
                    T.StructField("train", T.ArrayType(T.BooleanType())), T.StructField("offsets", T.BinaryType()),
                    T.StructField("codes", T.BinaryType()), T.StructField("hashes", T.BinaryType()),
                    T.StructField("counts", T.BinaryType())]

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = 0
        for batch in batches:
            for piece in slices(batch, "text"):
                words, offsets = split_words(lower_ascii(piece.column("text")))
                codes, distinct = word_codes(words) if len(words) else (np.zeros(0, np.int64), words)
                train = piece.column("train").to_numpy(zero_copy_only=False).astype(bool)
                n = np.bincount(codes, train[row_of(offsets)], len(distinct)) if len(words) else np.zeros(0)
                rank = np.argsort(-n, kind="stable")  # frequent words get small numbers
                number = np.empty(len(rank), np.int64)
                number[rank] = np.arange(len(rank))
                hashes = hash_strings(distinct)[rank]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(int(piece.column("part")[0].as_py()) << 32) + serial], pa.int64()),
                     _whole_list(piece.column("id")), _whole_list(piece.column("train")),
                     pa.array([_squeeze(offsets)], pa.binary()), pa.array([_squeeze(number[codes].astype(np.uint32))], pa.binary()),
                     pa.array([hashes.tobytes()], pa.binary()), pa.array([_squeeze(n[rank].astype(np.int64))], pa.binary())],
                    [f.name for f in block_fields])
                serial += 1

    blocks = written(source.mapInArrow(to_blocks, T.StructType(block_fields)), "lm-blocks")
    ends = blocks.select(F.explode("train").alias("t")).filter("t").count()

    # 1. exact counts: the size of the vocabulary and its most frequent words
    def list_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, n in _each(batch, "hashes", "counts"):
                n = _unsqueeze(n, np.int64)
                n = n[n > 0]
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw, np.int64)[:len(n)]), pa.array(n)], ["word", "n"])

    vocabulary = written(blocks.select("hashes", "counts").mapInArrow(list_words, "word long, n long").groupBy("word")
                         .agg(F.sum("n").alias("n")), "lm-vocabulary")
    sizes = vocabulary.agg(F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n") == 1).alias("once")).first()
    classes = classes or class_count(sizes["kinds"])
    seeds = seeds or max(SEED_WORDS, SEEDS_PER_CLASS * classes)
    end, unknown = classes, classes + 1  # the end of a text is a class of its own, and so is the unknown word
    width = classes + 2
    bins = 2 * (classes + 1)
    top = vocabulary.orderBy(F.desc("n"), "word").limit(seeds).collect()
    seed = np.sort(np.array([r["word"] for r in top], np.int64).view(np.uint64))
    m = len(seed)
    other, edge = m, m + 1

    # 2. exchange among the seed words, by how often they follow each other
    def neighbours_of_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, codes, offsets, train in _each(batch, "hashes", "codes", "offsets", "train"):
                word = _lookup(np.frombuffer(raw, np.uint64), seed, np.arange(m), other)
                codes, offsets = _unsqueeze(codes, np.uint32), _unsqueeze(offsets, np.int64)
                step, owner = _steps(word[codes], offsets, m + 2, edge)
                found, n = np.unique(step[np.array(train, bool)[owner]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], ["pair", "n"])

    seen = (blocks.select("hashes", "codes", "offsets", "train").mapInArrow(neighbours_of_seeds, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")).toArrow())  # at most (seeds + 2) squared rows
    table = np.zeros((m + 2, m + 2))
    pair = seen["pair"].to_numpy()
    table[pair // (m + 2), pair % (m + 2)] = seen["n"].to_numpy()
    fixed = np.full(m + 2, -1)
    fixed[other], fixed[edge] = classes + 1, end
    seed_class = exchange_classes(table, fixed, classes)
    member = np.zeros((m + 2, width))
    member[np.arange(m + 2), seed_class] = 1
    evidence, prior = _evidence(member.T @ table @ member + 0.5, classes)
    seed_class = seed_class[:m]

    # 3. classes of all words: the blocks say what stands around each word, the words' shards add it up and answer
    sent_fields = ("shard int, block long, hashes binary, n binary, length binary, bins binary, seen binary, "
                   "table array<long>")

    def sender(first: bool):
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, raw, codes, offsets, train, given in _each(
                        batch, "block", "hashes", "codes", "offsets", "train", "counts" if first else "answers"):
                    hashes = np.frombuffer(raw, np.uint64)
                    codes, offsets = _unsqueeze(codes, np.uint32), _unsqueeze(offsets, np.int64)
                    taught = np.array(train, bool)
                    if first:
                        n, known = _unsqueeze(given, np.int64), _lookup(hashes, seed, seed_class, -1)
                        moving = known < 0
                    else:
                        n, known = _answered(hashes, given, parts, unknown)
                        moving = known != unknown
                    before, after = _neighbours(known[codes], offsets, end)
                    use = taught[row_of(offsets)] & moving[codes]
                    code = codes.astype(np.int64)
                    left, right = use & (before >= 0), use & (after >= 0)
                    key = np.concatenate((code[left] * bins + before[left], code[right] * bins + classes + 1 + after[right]))
                    key, seen = np.unique(key, return_counts=True)
                    word, bin_ = key // bins, key % bins
                    begin = np.searchsorted(word, np.arange(len(hashes) + 1))
                    order, cuts = _cut_shards(hashes, parts)
                    rows = []
                    for s in range(parts):
                        own = order[cuts[s]:cuts[s + 1]]
                        if not len(own):
                            continue
                        length = (begin[own + 1] - begin[own])
                        at = np.repeat(begin[own] - (np.cumsum(length) - length), length) + np.arange(length.sum())
                        rows.append((s, block, hashes[own].tobytes(), _squeeze(n[own]), _squeeze(length.astype(np.uint32)),
                                     _squeeze(bin_[at].astype(np.uint16)), _squeeze(seen[at].astype(np.uint32)), None))
                    if not first:
                        step, owner = _steps(known[codes], offsets, width, end)
                        rows.append((None, block, *[None] * 5, np.bincount(step[taught[owner]], minlength=width * width)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                            (pa.int32(), pa.int64(), *[pa.binary()] * 5, pa.list_(pa.int64())))],
                        ["shard", "block", "hashes", "n", "length", "bins", "seen", "table"])
        return send

    def settler(first: bool, evidence: np.ndarray, prior: np.ndarray):
        evidence, prior = evidence.astype(np.float32), prior.astype(np.float32)

        def settle(table: pa.Table) -> pa.Table:
            """Counts and classes of one shard's words, for each block in its own order; and the shard's sums."""
            rows = table.to_pylist()
            raw = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
            words, place = np.unique(np.concatenate(raw), return_inverse=True)
            n = np.concatenate([_unsqueeze(r["n"], np.int64) for r in rows])
            if first:  # the blocks' own counts, added up here
                total = np.bincount(place, n, len(words)).astype(np.int64)
            else:
                total = np.zeros(len(words), np.int64)
                total[place] = n
            length = np.concatenate([_unsqueeze(r["length"], np.uint32) for r in rows])
            bin_ = np.concatenate([_unsqueeze(r["bins"], np.uint16) for r in rows])
            seen = np.concatenate([_unsqueeze(r["seen"], np.uint32) for r in rows])
            votes = np.zeros((len(words), bins), np.float32)
            np.add.at(votes, (np.repeat(place, length), bin_), seen)
            own = np.argmax(votes @ evidence + prior, axis=1)
            if first:
                settled = _lookup(words, seed, seed_class, -1)
                own = np.where(settled >= 0, settled, own)
            own = np.where(total == 0, unknown, own)
            cut = np.cumsum([0, *map(len, raw)])
            held = total > 0
            tokens = np.bincount(own[held], total[held], width)
            return pa.table({
                "block": pa.array([*(r["block"] for r in rows), None], pa.int64()),
                "shard": pa.array([*(r["shard"] for r in rows), rows[0]["shard"]], pa.int32()),
                "n": pa.array([*(_squeeze(total[place[cut[i]:cut[i + 1]]]) for i in range(len(rows))), None], pa.binary()),
                "cls": pa.array([*(_squeeze(own[place[cut[i]:cut[i + 1]]].astype(np.uint16)) for i in range(len(rows))), None],
                                pa.binary()),
                "tokens": pa.array([*[None] * len(rows), tokens.tolist()], pa.list_(pa.float64()))})
        return settle

    def answered(sent: DataFrame, first: bool, evidence: np.ndarray, prior: np.ndarray) -> DataFrame:
        return written(sent.drop("table").groupBy("shard").applyInArrow(
            settler(first, evidence, prior), "block long, shard int, n binary, cls binary, tokens array<double>"), "lm-words")

    answers = answered(blocks.drop("ids").mapInArrow(sender(True), sent_fields), True, evidence, prior)
    information = []
    for _ in range(moves):
        sent = written(_join_answers(blocks, answers).drop("ids").mapInArrow(sender(False), sent_fields), "lm-neighbours")
        between = _summed(sent.filter("shard IS NULL"), "table", width * width).reshape(width, width)
        between = between[:classes + 1, :classes + 1]
        information.append(class_information(between))
        answers = answered(sent.filter("shard IS NOT NULL"), False, *_evidence(between + 0.5, classes))
    of_class = _summed(answers.filter("block IS NULL"), "tokens", width)
    of_class[end] = ends
    return ClassModel(blocks, answers, id_col, classes, parts, ends, sizes["kinds"] + (1 if ends else 0), sizes["once"],
                      of_class, information)


def word_classes(model: ClassModel) -> DataFrame:
    """The trained classes: ``word`` (its 64-bit hash), ``n`` (training count) and ``class``; one row per word."""
    parts, unknown = model.parts, model.classes + 1

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, got in _each(batch, "hashes", "answers"):
                hashes = np.frombuffer(raw, np.uint64)
                n, cls = _answered(hashes, got, parts, unknown)
                held = n > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[held].view(np.int64)), pa.array(n[held]), pa.array(cls[held].astype(np.int32))],
                    ["word", "n", "class"])

    return model.with_answers().mapInArrow(spell, "word long, n long, class int").distinct()


def class_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_col: str = "train",
                 classes: int | None = None, seeds: int | None = None, moves: int = MOVES) -> DataFrame:
    """Per row of ``docs``: id, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``information``.

    Tokens are the words (A-Z lower-cased) and one end per text. Counts come from
    all rows whose ``train_col`` is true. ``base_score`` is the smoothed unigram
    log10 probability, ``score`` the class model's, ``information`` the bits a
    token that a class tells about the next one: before each round over all words
    and at the end (the same in every row).

    Words that no training text has: such a word follows a class as often as words
    seen once do, and that probability is shared by as many kinds as are seen once
    and one more. The probabilities of all events after a class sum to one.

    Null and empty texts are their end only. Without training rows both scores are
    the base's. Rows that repeat an id are rows of their own; other columns are not
    read; words of equal evidence take the first class; an empty table gives no rows.
    """
    return score_texts(fit_classes(docs, id_col, text_col, train_col, classes, seeds, moves))


def score_texts(model: ClassModel) -> DataFrame:
    """Scores of all rows that the model's blocks hold (see ``class_scores``)."""
    id_col, classes, parts, ends, of_class = model.id_col, model.classes, model.parts, model.ends, model.of_class
    id_type = model.blocks.schema["ids"].dataType.elementType
    end, unknown, width = classes, classes + 1, classes + 2
    n_train = int(round(of_class.sum()))
    open_kinds = np.log10(model.once + 1)

    # what each document needs from the model, before the model's transitions are known
    stat_fields = [T.StructField("ids", T.ArrayType(id_type)), T.StructField("train", T.ArrayType(T.BooleanType())),
                   T.StructField("n_tokens", T.ArrayType(T.LongType())), T.StructField("n_known", T.ArrayType(T.LongType())),
                   T.StructField("base", T.ArrayType(T.DoubleType())), T.StructField("words", T.ArrayType(T.DoubleType())),
                   T.StructField("cut", T.BinaryType()), T.StructField("step", T.BinaryType()),
                   T.StructField("times", T.BinaryType()), T.StructField("table", T.ArrayType(T.LongType()))]

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_class = np.where(of_class > 0, np.log10(np.maximum(of_class, 1)), 0.0)
        per_class[unknown] = open_kinds
        for batch in batches:
            for at, (raw, codes, offsets, train, got) in enumerate(_each(
                    batch, "hashes", "codes", "offsets", "train", "answers")):
                codes, offsets = _unsqueeze(codes, np.uint32), _unsqueeze(offsets, np.int64)
                n, cls = _answered(np.frombuffer(raw, np.uint64), got, parts, unknown)
                rows = len(train)
                row, own, count = row_of(offsets), cls[codes], n[codes]
                length = np.diff(offsets)
                base = np.bincount(row, np.log10(count + SMOOTHING), rows) + np.log10(ends + SMOOTHING)
                # word given class: its count over the class's; an unknown word is one of its open kinds
                emit = np.bincount(row, np.log10(np.maximum(count, 1)) - per_class[own], rows)
                known = np.bincount(row, count > 0, rows).astype(np.int64) + (1 if ends else 0)
                step, owner = _steps(own, offsets, width, end)
                key, times = np.unique(owner * (width * width) + step, return_counts=True)
                cut = np.searchsorted(key, np.arange(rows + 1) * (width * width))
                learn = np.array(train, bool)
                sums = np.bincount(step[learn[owner]], minlength=width * width)
                # a word seen once stands in for the unknown: steps into and out of such words
                before, after = _neighbours(own, offsets, end)
                once = (count == 1) & learn[row]
                sums += np.bincount(before[once] * width + unknown, minlength=width * width)
                sums += np.bincount(unknown * width + after[once], minlength=width * width)
                follow = np.zeros(len(once), bool)
                follow[1:] = once[1:] & once[:-1] & (row[1:] == row[:-1])
                sums[unknown * width + unknown] += int(follow.sum())
                one = batch.slice(at, 1)
                yield pa.RecordBatch.from_arrays(
                    [one.column("ids"), one.column("train"), _whole_list(pa.array(length + 1, pa.int64())),
                     _whole_list(pa.array(known, pa.int64())), _whole_list(pa.array(base, pa.float64())),
                     _whole_list(pa.array(emit, pa.float64())), pa.array([_squeeze(cut.astype(np.int64))], pa.binary()),
                     pa.array([_squeeze((key % (width * width)).astype(np.uint32))], pa.binary()),
                     pa.array([_squeeze(times.astype(np.uint32))], pa.binary()),
                     _whole_list(pa.array(sums, pa.int64()))], [f.name for f in stat_fields])

    stats = written(model.with_answers().mapInArrow(statistics, T.StructType(stat_fields)), "lm-statistics")

    # class transitions of all training texts, and every text's score
    count = _summed(stats, "table", width * width).reshape(width, width)
    events = [c for c in range(width) if c != unknown]
    information = [*model.information, class_information(count[np.ix_(events, events)])]
    flat_step = transition_logs(count, of_class, classes).ravel()
    denominator = np.log10(n_train + SMOOTHING * (model.kinds + 1))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, (words, base, n, cut, step, times) in enumerate(_each(
                    batch, "words", "base", "n_tokens", "cut", "step", "times")):
                cut, step = _unsqueeze(cut, np.int64), _unsqueeze(step, np.uint32)
                times = _unsqueeze(times, np.uint32)
                owner = row_of(cut)
                base = np.array(base) - np.array(n) * denominator
                total = np.array(words) + np.bincount(owner, flat_step[step] * times, len(words))
                one = batch.slice(at, 1)
                flat = [one.column(c).flatten() for c in ("ids", "train", "n_tokens", "n_known")]
                yield pa.RecordBatch.from_arrays(
                    [*flat, pa.array(np.full(len(words), n_train), pa.int64()), pa.array(base),
                     pa.array(total if n_train else base), pa.array([information] * len(words), pa.list_(pa.float64()))],
                    [id_col, "train", "n_tokens", "n_known", "train_tokens", "base_score", "score", "information"])

    return stats.drop("table").mapInArrow(scores, T.StructType(
        [T.StructField(id_col, id_type), T.StructField("train", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
         T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
         T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
         T.StructField("information", T.ArrayType(T.DoubleType()))]))


def transition_logs(count: np.ndarray, of_class: np.ndarray, classes: int) -> np.ndarray:
    """log10 of each step between classes (then the end, then the unknown word), each row's probabilities summing to one.

    ``count`` holds the steps of training; its last row and column are those out of
    and into words seen once, which say how likely a new word is.
    """
    unknown = classes + 1
    events = np.arange(classes + 1)
    rows = count[:, events].sum(1)
    share = of_class[events] / max(1.0, of_class.sum())
    new = np.clip((count[:, unknown] + 0.5) / (rows + 1.0), 1e-9, 0.9)
    log_step = np.zeros((classes + 2, classes + 2))
    with np.errstate(divide="ignore"):
        log_step[:, events] = np.log10((1 - new)[:, None] * (count[:, events] + share[None, :]) / (rows + 1.0)[:, None])
    log_step[:, unknown] = np.log10(new)
    return log_step


def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from nine tenths of them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", (crc_mod(F.col("doc_id"), 10) != 0).alias("train"))
    return class_scores(docs).select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                                     "train_tokens", "base_score", "score", F.col("information").alias("class_information"))
