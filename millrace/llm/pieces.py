"""SentencePiece encoding and decoding as a max-plus scan.

A text's encoding is the path of vocabulary pieces with the highest summed
score. Its weights form a max-plus algebra, so a giant document can be cut
anywhere: each chunk yields a transfer matrix between boundary states (how far a
piece reaches over the cut), matrices combine associatively, the combination
fixes the state at every cut, and each chunk then traces its own pieces.

The vocabulary comes from a model file, whose path is a parameter; nothing is
trained. Characters outside of it become byte pieces (or the unknown piece).
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import read, release_memory, slices, written

#: Normalised characters of a chunk; longer texts are cut.
CHUNK = 32_768
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
_MEMO_UNITS = 60_000
_UNITS_AT_ONCE = 8_192
_DECODE_ROWS = 256
#: Bytes of text that are encoded at once.
_TEXT_BYTES = 1 << 20
_MEMO_LENGTH = 48


def _lists(rows: Iterator[np.ndarray]) -> pa.ListArray:
    """One Arrow list per row, without a Python object for each piece of the batch."""
    rows = list(rows)
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                    pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32)))


def default_model() -> str:
    """The public 32,000-piece vocabulary installed beside Spark's Python."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces with exact integer weights.

    A weight is the score in fixed point, then, for ties, a hash of the piece,
    then the piece's place: paths with equal scores compare the same way wherever
    a text is cut.
    """

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str], unknown: int, prefix: bool = True):
        self.pieces, self.scores, self.kinds, self.unknown, self.prefix = pieces, scores, kinds, unknown, prefix
        self._build()

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = ["byte" if sp.is_byte(i) else "other" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
                 else "text" for i in range(sp.vocab_size())]
        return cls([sp.id_to_piece(i) for i in range(sp.vocab_size())],
                   [sp.get_score(i) for i in range(sp.vocab_size())], kinds, sp.unk_id())

    def __reduce__(self):
        return Vocabulary, (self.pieces, self.scores, self.kinds, self.unknown, self.prefix)

    def _build(self) -> None:
        text = [i for i, k in enumerate(self.kinds) if k == "text"]
        self.table = {self.pieces[i]: (i, self._weight(self.scores[i], self.pieces[i])) for i in text}
        self.longest = max((len(self.pieces[i]) for i in text), default=1)
        self.unknown_score = min((self.scores[i] for i in text), default=0.0) - UNKNOWN_PENALTY
        self.bytes = {int(self.pieces[i][3:5], 16): i for i, k in enumerate(self.kinds) if k == "byte"}
        self.of_byte = {i: b for b, i in self.bytes.items()}
        # a piece never joins another character to a following space mark or holds a line end:
        # then texts fall apart into units that are encoded on their own
        self.apart = apart = all(SPACE not in p.lstrip(SPACE) and ("\n" not in p) for p in self.table)
        self.unit = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n" if apart else r"[\s\S]+")
        # pieces of units by their packed ids; two generations: the older one goes when the
        # younger is full, what is used again stays
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.trie: PieceTrie | None = None
        self.spelled: pa.Array | None = None

    @staticmethod
    def _weight(score: float, piece: str) -> int:
        return (round(score * (1 << 20)) << 160) - (zlib.crc32(piece.encode("utf-8", "surrogatepass")) << 80)

    def ids_of(self, piece: str) -> tuple[int, ...]:
        found = self.table.get(piece)
        if found:
            return (found[0],)
        raw = piece.encode("utf-8", "surrogatepass")
        return tuple(self.bytes[b] for b in raw) if len(self.bytes) == 256 else (self.unknown,)

    def score_of(self, weight: int) -> float:
        return (weight + (1 << 159) >> 160) / (1 << 20)

    def steps(self, text: str, at: int, stop: int) -> Iterator[tuple[int, int]]:
        """(end, weight) of the pieces that begin at ``at`` and end at ``stop`` or before."""
        table = self.table
        for end in range(at + 1, min(at + self.longest, stop) + 1):
            found = table.get(text[at:end])
            if found:
                yield end, found[1]
            elif end == at + 1:
                yield end, self._weight(self.unknown_score, text[at])

    def forward(self, text: str, begin: int, stop: int, base: int = 0, until: int | None = None):
        """Best weights from ``begin`` to every position up to ``stop``, and the piece each one ends with.

        With ``until``, no piece begins there or later.
        """
        value: list[int | None] = [None] * (stop - begin + 1)
        came = [0] * (stop - begin + 1)
        value[0] = 0
        for at in range(begin, stop if until is None else min(stop, until)):
            here = value[at - begin]
            if here is None:
                continue
            for end, weight in self.steps(text, at, stop):
                w, old = here + weight - (base + at), value[end - begin]
                if old is None or w > old:
                    value[end - begin], came[end - begin] = w, at
        return value, came

    def trace(self, text: str, begin: int, end: int, came: list[int]) -> list[int]:
        ids: list[tuple[int, ...]] = []
        at = end
        while at > begin:
            ids.append(self.ids_of(text[came[at - begin]:at]))
            at = came[at - begin]
        return [i for part in reversed(ids) for i in part]

    def learn(self, units: set[str]) -> None:
        """Encode what the memo lacks of ``units``, all together; afterwards it has them all."""
        if len(self.memo) >= _MEMO_UNITS:
            self.old, self.memo = self.memo, {}
        memo, old = self.memo, self.old
        fresh = units.difference(memo)
        if old:
            again = fresh.intersection(old)
            memo.update((u, old[u]) for u in again)
            fresh -= again
        short = sorted((u for u in fresh if len(u) <= _MEMO_LENGTH), key=len, reverse=True)
        if short and self.trie is None:
            self.trie = PieceTrie(self)
        if short:
            memo.update(zip(short, self.trie.encode(short)))

    def _long_unit(self, unit: str) -> np.ndarray:
        _, came = self.forward(unit, 0, len(unit))
        return np.array(self.trace(unit, 0, len(unit), came), np.int32)

    def normalise(self, text: str | None) -> str:
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def encode_column(self, texts: pa.Array, normalised: bool = False) -> pa.ListArray:
        """Ids of each text of an Arrow column; each distinct unit of all of them is looked up once."""
        texts = pc.fill_null(texts, "")
        if not normalised:
            texts = pc.replace_substring(texts, " ", SPACE)
            if self.prefix:
                texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(SPACE, texts, ""))
        offsets, units = self._units(texts)
        coded = units.dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn(set(distinct))
        memo = self.memo
        packed = [memo[u] if u in memo else self._long_unit(u).tobytes() for u in distinct]
        size = np.fromiter((len(x) >> 2 for x in packed), np.int64, len(packed))
        flat = np.frombuffer(b"".join(packed), np.int32)
        n = size[which]
        ends = np.cumsum(n)
        ids = flat[np.repeat((np.cumsum(size) - size)[which] - (ends - n), n) + np.arange(int(n.sum()))]
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends)[offsets], pa.int32()), pa.array(ids))

    def _units(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Units of all texts one after the other, and each text's offset into them."""
        if not self.apart:
            units = [self.unit.findall(t) for t in texts.to_pylist()]
            return np.cumsum([0, *map(len, units)]), pa.array([u for x in units for u in x], pa.string())
        base = texts.offset
        cut = np.frombuffer(texts.buffers()[1], np.int32)[base:base + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[cut[0]:cut[-1]]
        cut = cut - cut[0]
        first, second, third = SPACE.encode()
        mark = np.zeros(len(data) + 3, bool)  # a space mark begins here (three places on, to look back)
        if len(data) > 2:
            mark[3:-2] = (data[:-2] == first) & (data[1:-1] == second) & (data[2:] == third)
        begin = np.zeros(len(data) + 1, bool)
        begin[:-1] = mark[3:] & ~mark[:-3]
        line = np.flatnonzero(data == 10)
        begin[line] = begin[line + 1] = True
        begin[cut] = True
        begin[-1] = True
        places = np.flatnonzero(begin)
        units = pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(data.tobytes()))
        return np.searchsorted(places, cut), units

    def encode(self, text: str | None) -> list[int]:
        return self.encode_column(pa.array([text], pa.string())).values.to_pylist()

    def decode(self, ids: list[int]) -> str:
        out, raw = [], bytearray()
        for i in ids:
            b = self.of_byte.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            out.append(self.pieces[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        text = "".join(out).replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text

    def decode_column(self, lists: pa.ListArray) -> pa.Array:
        """Text of each list of ids; lists with bytes of longer characters are decoded one by one, the others at once."""
        lists = pc.fill_null(lists, pa.scalar([], lists.type)) if lists.null_count else lists
        offsets = lists.offsets.to_numpy()
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        cut = (offsets - offsets[0]).astype(np.int64)
        if self.spelled is None:
            # a byte below 0x80 is a character on its own; others are decoded with their neighbours
            self.spelled = pa.array([chr(self.of_byte[i]) if self.of_byte.get(i, 128) < 128 else p.replace(SPACE, " ")
                                     for i, p in enumerate(self.pieces)], pa.string())
            self.is_byte = np.array([self.of_byte.get(i, 0) >= 128 for i in range(len(self.pieces))])
        byte = np.concatenate(([0], np.cumsum(self.is_byte[flat.to_numpy()])))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), self.spelled.take(flat)), "")
        if self.prefix:
            texts = pc.if_else(pc.starts_with(texts, " "), pc.utf8_slice_codeunits(texts, 1), texts)
        odd = np.flatnonzero(byte[cut[1:]] > byte[cut[:-1]])
        if len(odd):
            own = pa.array([self.decode(lists[k].as_py()) for k in odd.tolist()], pa.string())
            mask = np.zeros(len(lists), bool)
            mask[odd] = True
            texts = pc.replace_with_mask(texts, pa.array(mask), own)
        return texts

    # chunks of giant documents

    def _cuts(self, text: str, n: int) -> tuple[int, int] | None:
        """First and last place in the chunk where every path has a cut, if there are any."""
        if not self.apart:
            return None

        def begins(at: int) -> bool:
            here, before = text[at], text[at - 1]
            return here == "\n" or before == "\n" or (here == SPACE and before != SPACE)

        places = range(max(1, self.longest), min(n, len(text) - 1) + 1)
        first = next((at for at in places if begins(at)), None)
        return None if first is None else (first, next(at for at in reversed(places) if begins(at)))

    def transfer(self, text: str, n: int, base: int) -> list[list[int | None]]:
        """Best weight from each entry state to each exit state of a chunk of ``n`` characters.

        ``text`` is the chunk and up to ``longest - 1`` characters after it. A state
        is how many characters beyond the cut the next piece begins.
        """
        size, last = self.longest, len(text) - n
        cuts = self._cuts(text, n)
        if cuts is None:
            rows = []
            for i in range(size):
                if i > n:
                    rows.append([0 if i - n == j else None for j in range(size)])
                    continue
                value, _ = self.forward(text, i, len(text), base, until=n)
                rows.append([value[n + j - i] if j <= last else None for j in range(size)])
            return rows
        first, final = cuts
        into: list[int | None] = [None] * (first + 1)
        into[first] = 0
        for at in range(first - 1, -1, -1):  # best weight from each place to the first cut
            found = [w - (base + at) + into[end] for end, w in self.steps(text, at, first) if into[end] is not None]
            into[at] = max(found) if found else None
        out, _ = self.forward(text, final, len(text), base, until=n)
        leave = [out[n + j - final] if j <= last else None for j in range(size)]
        # what lies between the cuts is the same for every path and cannot change a choice
        return [[None if a is None or b is None else a + b for b in leave] for a in into[:size]]

    def _ends_of_chunk(self, text: str, n: int, base: int, entry: int, leave: int) -> tuple[list[int], str, list[int]]:
        """Ids before the first cut, the text of the whole units, and ids after the last cut."""
        if entry >= n:
            return [], "", []
        cuts = self._cuts(text, n)
        end = n + leave
        if cuts is None:
            _, came = self.forward(text, entry, end, base, until=n)
            return self.trace(text, entry, end, came), "", []
        first, final = cuts
        _, came = self.forward(text, entry, first, base)
        head = self.trace(text, entry, first, came)
        _, came = self.forward(text, final, end, base, until=n)
        return head, text[first:final], self.trace(text, final, end, came)

    def trace_chunks(self, chunks: list[tuple[str, int, int, int, int]]) -> list[np.ndarray]:
        """Ids that begin in each chunk (text, n, base, entry, leave), given the states at both of its cuts.

        What lies between a chunk's first and last unit is encoded with that of the others.
        """
        parts = [self._ends_of_chunk(*c) for c in chunks]
        middle = self.encode_column(pa.array([p[1] for p in parts], pa.string()), normalised=True)
        return [np.concatenate((np.array(p[0], np.int32), m.values.to_numpy(), np.array(p[2], np.int32)))
                for p, m in zip(parts, middle)]

    def trace_chunk(self, text: str, n: int, base: int, entry: int, leave: int) -> list[int]:
        """The pieces that begin in the chunk, given the states at both of its cuts."""
        return self.trace_chunks([(text, n, base, entry, leave)])[0].tolist()


class PieceTrie:
    """The pieces of a vocabulary as a trie of numbered states, walked by many units at a time.

    A step is looked up by (state, code point) in tables of 64-bit keys: what two
    keys claim in one table the later one has in the next.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        steps: dict[tuple[int, str], int] = {}
        ends: list[int] = [-1]
        for piece, (number, _) in vocabulary.table.items():
            state = 0
            for ch in piece:
                after = steps.get((state, ch))
                if after is None:
                    after = steps[state, ch] = len(ends)
                    ends.append(-1)
                state = after
            ends[state] = number
        self.piece = np.array(ends, np.int32)
        crc = {i: zlib.crc32(p.encode("utf-8", "surrogatepass")) for p, (i, _) in vocabulary.table.items()}
        self.score = np.array([round(vocabulary.scores[i] * (1 << 20)) if i >= 0 else 0 for i in ends], np.int64)
        self.crc = np.array([crc.get(i, 0) for i in ends], np.int64)
        self.unknown = round(vocabulary.unknown_score * (1 << 20))
        self.root = np.full(sys.maxunicode + 1, -1, np.int32)
        for (state, ch), after in steps.items():
            if not state:
                self.root[ord(ch)] = after
        key = np.array([(state << 21) | ord(ch) for state, ch in steps], np.int64)
        to = np.array(list(steps.values()), np.int32)
        self.tables: list[tuple[np.ndarray, np.ndarray, np.uint64]] = []
        while len(key):
            size = 1 << max(4, (4 * len(key)).bit_length())
            salt = np.uint64(2 * len(self.tables) + 1)
            keys, values = np.full(size, -1, np.int64), np.zeros(size, np.int32)
            slot = self._slot(key, salt, size)
            _, first = np.unique(slot, return_index=True)
            keys[slot[first]], values[slot[first]] = key[first], to[first]
            self.tables.append((keys, values, salt))
            rest = np.ones(len(key), bool)
            rest[first] = False
            key, to = key[rest], to[rest]

    @staticmethod
    def _slot(key: np.ndarray, salt: np.uint64, size: int) -> np.ndarray:
        h = (key.view(np.uint64) + salt) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(64 - size.bit_length() + 1)).view(np.int64)

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The state after each code point, or -1."""
        key = (state.astype(np.int64) << 21) | code
        out = np.full(len(key), -1, np.int32)
        open_ = None
        for keys, values, salt in self.tables:
            asked = key if open_ is None else key[open_]
            slot = self._slot(asked, salt, len(keys))
            found = keys[slot]
            hit = np.flatnonzero(found == asked)
            out[hit if open_ is None else open_[hit]] = values[slot[hit]]
            other = np.flatnonzero((found != asked) & (found >= 0))  # another key has the slot
            open_ = other if open_ is None else open_[other]
            if not len(open_):
                break
        return out

    def encode(self, units: list[str]) -> list[bytes]:
        """Packed ids of the best path of each unit. ``units`` come by falling length.

        Paths are compared by score alone; units in which two paths to a place score
        the same are done again by the vocabulary's whole order: score, then the
        hashes of the pieces, then where the pieces begin.
        """
        def in_parts(units: list[str], whole_order: bool) -> tuple[list[bytes], list[int]]:
            out, tied = [], []
            for lo in range(0, len(units), _UNITS_AT_ONCE):
                part = units[lo:lo + _UNITS_AT_ONCE]
                ids, ties = self._paths(part, whole_order)
                out += ids
                tied += (lo + np.flatnonzero(ties)).tolist()
            return out, tied

        out, tied = in_parts(units, False)
        for k, ids in zip(tied, in_parts([units[k] for k in tied], True)[0]):
            out[k] = ids
        return out

    def _paths(self, units: list[str], whole_order: bool) -> tuple[list[bytes], np.ndarray]:
        """Packed ids of each unit, and which ones have places that two paths reach with one score."""
        length = np.array([len(u) for u in units], np.int64)
        m, width = len(units), int(length[0])
        flat = np.zeros((m, width), np.int64)
        flat[np.arange(width)[None, :] < length[:, None]] = np.frombuffer(
            "".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.ascontiguousarray(flat.T)
        # one array per place, an entry per unit
        score = np.full((width + 1, m), np.iinfo(np.int64).min // 2)
        score[0] = 0
        came, via = np.zeros((width + 1, m), np.int16), np.full((width + 1, m), -1, np.int32)
        crc, begins = np.zeros((2, width + 1, m), np.int64) if whole_order else (None, None)
        tied = np.zeros(m, bool)
        alive = np.searchsorted(-length, -np.arange(width), side="left")  # units longer than each place

        def offer(row: np.ndarray, at: int, end: int, gain: np.ndarray | int, mark: np.ndarray | None, state: np.ndarray) -> None:
            s, s0 = score[at].take(row) + gain, score[end].take(row)
            better, same = s > s0, s == s0
            if whole_order:
                c, p = crc[at].take(row) + mark, begins[at].take(row) + at
                c0, p0 = crc[end].take(row), begins[end].take(row)
                better |= same & ((c < c0) | ((c == c0) & (p < p0)))
            elif same.any():
                tied[row[same]] = True
            use = np.flatnonzero(better)
            r = row.take(use)
            score[end][r], came[end][r], via[end][r] = s.take(use), at, state.take(use)
            if whole_order:
                crc[end][r], begins[end][r] = c.take(use), p.take(use)

        for at in range(width):
            row = np.arange(alive[at])
            state = self.root.take(codes[at][:alive[at]])
            alone = np.flatnonzero((state < 0) | (self.piece.take(state) < 0))
            if len(alone):  # a character without a piece of its own
                distinct, which = np.unique(codes[at].take(alone), return_inverse=True)
                mark = np.array([zlib.crc32(chr(c).encode("utf-8", "surrogatepass")) for c in distinct.tolist()], np.int64)
                offer(alone, at, at + 1, self.unknown, mark[which], np.full(len(alone), -1, np.int32))
            for end in range(at + 1, min(width, at + self.vocabulary.longest) + 1):
                if end > at + 1:
                    row = row[:np.searchsorted(row, alive[end - 1])]
                    state = self.step(state[:len(row)], codes[end - 1].take(row))
                known = np.flatnonzero(state >= 0)
                if not len(known):
                    break
                row, state = row.take(known), state.take(known)
                whole = np.flatnonzero(self.piece.take(state) >= 0)
                if len(whole):
                    s = state.take(whole)
                    offer(row.take(whole), at, end, self.score.take(s), self.crc.take(s), s)
        return self._trace(units, length, came, via), tied

    def _trace(self, units: list[str], length: np.ndarray, came: np.ndarray, via: np.ndarray) -> list[bytes]:
        row, end = np.arange(len(units)), length.copy()
        rows, ids = [], []
        odd: set[int] = set()  # units with a character without a piece
        while len(row):
            state = via[end, row]
            if (state < 0).any():
                odd.update(row[state < 0].tolist())
            rows.append(row)
            ids.append(self.piece.take(state))
            end = came[end, row].astype(np.int64)
            row, end = row[end > 0], end[end > 0]
        flat = np.concatenate(rows[::-1])
        raw = np.concatenate(ids[::-1])[np.argsort(flat, kind="stable")].astype(np.int32).tobytes()
        cuts = (4 * np.cumsum(np.bincount(flat, minlength=len(units)))).tolist()
        out = [raw[a:b] for a, b in zip([0, *cuts], cuts)]
        for k in odd:
            path = came[:len(units[k]) + 1, k].tolist()
            out[k] = np.array(self.vocabulary.trace(units[k], 0, len(units[k]), path), np.int32).tobytes()
        return out


def boundary_states(matrices: list[list[list[int | None]]]) -> list[int]:
    """States at all cuts of one document: entry of the first chunk, exits of every chunk.

    The suffix products applied to the end state give the best weight from every
    state to the end; going forward, the best exit is chosen at each cut.
    """
    size = len(matrices[0])
    ahead: list[int | None] = [0] + [None] * (size - 1)
    suffix = [ahead]
    for m in reversed(matrices):
        ahead = [max((w + a for w, a in zip(row, ahead) if w is not None and a is not None), default=None) for row in m]
        suffix.append(ahead)
    suffix.reverse()
    states = [0]
    for k, m in enumerate(matrices):
        options = [(w + a, -j) for j, (w, a) in enumerate(zip(m[states[-1]], suffix[k + 1]))
                   if w is not None and a is not None]
        states.append(-max(options)[1])
    return states


def encode(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``tie`` (xxhash64 of the text) and ``ids`` (array of piece ids).

    Null and empty texts have no pieces. Texts of more than ``chunk`` normalised
    characters are cut into chunks that are spread over the cluster; the others
    are encoded where they are read. The result does not depend on ``chunk``.
    Rows that repeat come back as often as they stand (a giant text is scanned
    once). Other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary.load(model or default_model()))  # of the model's size
    chunk = max(chunk, shared.value.longest + 1)
    id_type = docs.schema[id_col].dataType
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("tie"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ident = [T.StructField("id", id_type), T.StructField("tie", T.LongType())]
    ids_type = T.ArrayType(T.IntegerType())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for piece in slices(batch, "text", _TEXT_BYTES):
                ids = vocabulary.encode_column(piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("tie"), ids], ["id", "tie", "ids"])
        release_memory()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        reach = vocabulary.longest - 1
        for batch in batches:
            for row, text in enumerate(batch.column("text").to_pylist()):
                text = vocabulary.normalise(text)
                starts = range(0, len(text), chunk)
                one = batch.slice(row, 1)
                for at in starts:
                    yield pa.RecordBatch.from_arrays(
                        [one.column("id"), one.column("tie"), pa.array([at // chunk], pa.int32()),
                         pa.array([min(chunk, len(text) - at)], pa.int32()),
                         pa.array([text[at:at + chunk + reach]], pa.string())], ["id", "tie", "k", "n", "text"])

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            found = [json.dumps(vocabulary.transfer(t, n, k * chunk)) for t, n, k in zip(
                *(batch.column(c).to_pylist() for c in ("text", "n", "k")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tie"), batch.column("k"), pa.array(found, pa.string())],
                ["id", "tie", "k", "matrix"])

    def combine(table: pa.Table) -> pa.Table:
        table = table.sort_by("k")
        states = boundary_states([json.loads(m) for m in table["matrix"].to_pylist()])
        return pa.table({"id": table["id"], "tie": table["tie"], "k": table["k"],
                         "entry": pa.array(states[:-1], pa.int32()), "leave": pa.array(states[1:], pa.int32())})

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for piece in slices(batch, "text", _TEXT_BYTES):
                rows = zip(*(piece.column(c).to_pylist() for c in ("text", "n", "k", "entry", "leave")))
                ids = _lists(vocabulary.trace_chunks([(t, n, k * chunk, i, j) for t, n, k, i, j in rows]))
                yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("tie"), piece.column("k"), ids],
                                                 ["id", "tie", "k", "ids"])
        release_memory()

    mark = 1 if shared.value.prefix else 0
    long_text = F.length("text") + mark > chunk
    short = source.filter(~long_text).mapInArrow(whole, T.StructType([*ident, T.StructField("ids", ids_type)]))
    giant = source.filter(long_text)
    place = [*ident, T.StructField("k", T.IntegerType())]
    chunks = written(giant.mapInArrow(cut, T.StructType(
        [*place, T.StructField("n", T.IntegerType()), T.StructField("text", T.StringType())]))
        .repartition("id", "tie", "k").dropDuplicates(["id", "tie", "k"]), "chunks")
    states = (chunks.mapInArrow(matrices, T.StructType([*place, T.StructField("matrix", T.StringType())]))
              .groupBy("id", "tie").applyInArrow(combine, T.StructType(
                  [*place, T.StructField("entry", T.IntegerType()), T.StructField("leave", T.IntegerType())])))
    joined = chunks.alias("c").join(states.alias("s"), F.col("c.id").eqNullSafe(F.col("s.id"))
                                    & (F.col("c.tie") == F.col("s.tie")) & (F.col("c.k") == F.col("s.k"))).select(
        "c.id", "c.tie", "c.k", "n", "text", "entry", "leave")
    pieces = joined.mapInArrow(traced, T.StructType([*place, T.StructField("ids", ids_type)]))
    long = pieces.groupBy("id", "tie").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"))
    times = giant.groupBy("id", "tie").agg(F.count(F.lit(1)).alias("rows"))
    long = (long.alias("l").join(times.alias("t"), F.col("l.id").eqNullSafe(F.col("t.id")) & (F.col("l.tie") == F.col("t.tie")))
            .select("l.id", "l.tie", F.flatten("parts.ids").alias("ids"),
                    F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("row")).drop("row"))
    return short.unionByName(long).select(F.col("id").alias(id_col), "tie", "ids")


def decode(encoded: DataFrame, model: str | None = None, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of its pieces in ``out`` (replaced if present).

    Null and empty arrays give the empty text. The text is the encoded one, but
    for the space mark U+2581, which reads as a space.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(model or default_model()))
    fields = [f for f in encoded.schema.fields if f.name != out]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, _DECODE_ROWS):
                part = batch.slice(lo, _DECODE_ROWS)
                texts = vocabulary.decode_column(part.column(ids_col))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), texts], [*names, out])
        release_memory()

    return encoded.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, T.StructType(
        [*fields, T.StructField(out, T.StringType())]))


def op7_piece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: digests of its pieces and of the decoded text."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    back = decode(encode(docs), out="text")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_pieces"),
                       F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("text_sha256"),
                       (F.xxhash64(F.col("text")) == F.col("tie")).alias("round_trip"))
