"""Column expressions for record preparation (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace import constants as C


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def content_id(text, n_hex: int = 16) -> Column:
    """Content-hash id: first ``n_hex`` hex chars of SHA-256 of the raw text.

    The text is hashed exactly as given (no trimming), so ids equal the
    published benchmark keys.
    """
    return F.substring(F.sha2(_c(text), 256), 1, n_hex)


def question_of(conversations="conversations") -> Column:
    """First turn's value (positional, roles are not read). Null if absent."""
    return F.get(_c(conversations), 0)["value"]


def answer_of(conversations="conversations") -> Column:
    """Second turn's value (positional). Null if absent."""
    return F.get(_c(conversations), 1)["value"]


def repair_tags(text) -> Column:
    """``<think>`` -> ``<think>\\n`` and ``</answer>`` -> ``\\n</answer>``, every occurrence."""
    t = F.replace(_c(text), F.lit("<think>"), F.lit("<think>\n"))
    return F.replace(t, F.lit("</answer>"), F.lit("\n</answer>"))


def prompt_for_path(path) -> Column:
    """Math prompt when the source path contains ``math`` anywhere, else the general one."""
    return F.when(F.contains(_c(path), F.lit("math")), F.lit(C.USER_PROMPT_MATH)).otherwise(
        F.lit(C.USER_PROMPT))


def apply_prompt(question, prompt: str | Column = C.USER_PROMPT, system: str = C.SYSTEM_PROMPT) -> Column:
    """``system + prompt`` with ``{{content}}`` replaced by the question.

    Built with concat around the placeholder, so a question that itself
    contains ``{{content}}`` is left intact.
    """
    q = _c(question)
    if isinstance(prompt, str):
        head, sep, tail = prompt.partition("{{content}}")
        if not sep:
            raise ValueError("prompt has no {{content}} placeholder")
        return F.concat(F.lit(system), F.lit(head), q, F.lit(tail))
    head = F.substring_index(prompt, "{{content}}", 1)
    tail = F.substring_index(prompt, "{{content}}", -1)
    return F.concat(F.lit(system), head, q, tail)


def close_turn(output) -> Column:
    """Append the end-of-turn marker to the answer."""
    return F.concat(_c(output), F.lit(C.END_OF_TURN))


def message_text(instruction="instruction", output="output") -> Column:
    """Handler text: instruction + output + newline, missing parts as ""."""
    return F.concat(F.coalesce(_c(instruction), F.lit("")), F.coalesce(_c(output), F.lit("")), F.lit("\n"))


def is_math(instruction="instruction") -> Column:
    return F.contains(_c(instruction), F.lit(C.MATH_PHRASE))


def is_long(n_tokens, limit: int = C.SEQ_LENGTH) -> Column:
    """Long means ``n_tokens >= limit`` (the boundary value is long)."""
    return _c(n_tokens) >= F.lit(limit)


def split_name(file_name, is_long_col) -> Column:
    """Output file name derived from the input name: ``x.jsonl`` -> ``x_gt_32K.jsonl`` / ``x_lt_32K.jsonl``."""
    stem = F.regexp_replace(_c(file_name), r"\.jsonl$", "")
    return F.concat(stem, F.when(_c(is_long_col), F.lit("_gt_32K.jsonl")).otherwise(F.lit("_lt_32K.jsonl")))


def words(text, lower: bool = True) -> Column:
    """Letter/digit runs of a text (the model-free encoder's terms)."""
    t = F.lower(_c(text)) if lower else _c(text)
    return F.regexp_extract_all(t, F.lit(r"[\p{L}\p{N}]+"), 0)


def pretokens(text) -> Column:
    """Pre-tokenizer split. ``(?U)`` makes Java's classes Unicode-aware."""
    return F.regexp_extract_all(_c(text), F.lit("(?U)" + C.PRETOKENIZE_REGEX), 0)


def special_token_pattern() -> str:
    """Alternation of the special-token literals, each quoted with ``\\Q..\\E``."""
    return "|".join(f"\\Q{tok}\\E" for tok, _ in C.SPECIAL_TOKENS)
