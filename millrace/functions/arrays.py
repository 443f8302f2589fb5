"""Token-id array expressions: answer start, truncation, label masking, packing arrays.

Pass column references (not expressions) for arrays used inside lambdas:
a lambda re-evaluates any expression it mentions for every element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace import constants as C


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def answer_start(ids, marker: int = C.IM_START_ID, role_id: int = C.ASSISTANT_ID, skip: int = 3) -> Column:
    """0-based index where the answer begins: first ``(marker, role_id)`` pair + ``skip``, else 0.

    The default +3 skips the marker, the role word and the newline (one id
    each in the production vocabulary). Missing marker gives 0 (nothing
    masked); a marker in the last position is not a match.
    """
    a = _c(ids)
    n = F.size(a)
    hits = F.filter(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))),
                    lambda i: (F.get(a, i) == F.lit(marker)) & (F.get(a, i + 1) == F.lit(role_id)))
    return F.when(F.size(hits) > 0, F.get(hits, 0) + skip).otherwise(F.lit(0))


def truncate_keep_tail(ids, limit: int = C.SEQ_LENGTH, tail: int = 2) -> Column:
    """Longer than ``limit``: the first ``limit`` ids plus the last ``tail`` ids."""
    a = _c(ids)
    return F.when(F.size(a) > limit, F.concat(F.slice(a, 1, limit), F.slice(a, -tail, tail))).otherwise(a)


def mask_labels(ids, start, ignore: int = C.IGNORE_ID) -> Column:
    """``ignore`` for the first ``start`` positions, then the ids from ``start`` on.

    When ``start`` exceeds the length the result is longer than ``ids``
    (the original assert's failure case); flag it with :func:`mask_overflow`.
    """
    a, s = _c(ids), _c(start)
    rest = F.when(s < F.size(a), F.slice(a, s + 1, F.greatest(F.size(a) - s, F.lit(1)))).otherwise(
        F.array().cast("array<int>"))
    return F.concat(F.array_repeat(F.lit(ignore), s), rest)


def mask_overflow(ids, start) -> Column:
    return _c(start) > F.size(_c(ids))


def pad_to(ids, length: int | Column, pad: int) -> Column:
    """Right-pad an array with ``pad`` up to ``length`` (no-op if already that long)."""
    a = _c(ids)
    full = length if isinstance(length, Column) else F.lit(length)
    return F.concat(a, F.array_repeat(F.lit(pad), F.greatest(full - F.size(a), F.lit(0))))


def loss_mask(labels, ignore: int = C.IGNORE_ID) -> Column:
    return F.transform(_c(labels), lambda x: F.when(x == ignore, 0).otherwise(1))


def cumulative_ends(lens) -> Column:
    """``actual_seq_len``: running end offset of each segment (lens as a column reference)."""
    a = _c(lens)
    return F.transform(a, lambda x, i: F.aggregate(F.slice(a, 1, i + 1), F.lit(0).cast("long"),
                                                   lambda s, y: s + y))


def position_ids(lens) -> Column:
    """Positions restarting at 0 for every segment."""
    return F.flatten(F.transform(F.filter(_c(lens), lambda n: n > 0),
                                 lambda n: F.sequence(F.lit(0), (n - 1).cast("int"))))


def segment_ids(lens) -> Column:
    """Segment index of every position (the compressed stand-in for an N x N mask)."""
    return F.flatten(F.transform(_c(lens), lambda n, i: F.array_repeat(i, n.cast("int"))))


def padded_length(max_len, divisor: int = C.BATCH_DIVISOR, remainder: int = C.BATCH_REMAINDER) -> Column:
    """Smallest L >= max_len with L mod divisor == remainder."""
    m = _c(max_len)
    return m + F.pmod(F.lit(remainder) - m, F.lit(divisor))
