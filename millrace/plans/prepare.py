"""Record preparation: question/answer pairs -> prompt-templated instruct records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import constants as C
from millrace.functions.text import apply_prompt, close_turn, is_math, prompt_for_path, repair_tags


def instruct_records(pairs: DataFrame, question: str = "question", answer: str = "answer",
                     path_col: str | None = None, system: str = C.SYSTEM_PROMPT):
    """``(instruction, input, output)`` records; returns ``(ok, rejected)``.

    The answer's tags are repaired and the end-of-turn marker appended; the
    question is wrapped in the system text and the prompt, chosen by the
    source path when ``path_col`` is given (math prompt if the path contains
    ``math``). Rows without a question or an answer are rejected.
    """
    prompt = prompt_for_path(F.col(path_col)) if path_col else C.USER_PROMPT
    keep = [c for c in pairs.columns if c not in (question, answer)]
    out = pairs.select(
        *keep,
        apply_prompt(F.col(question), prompt, system).alias("instruction"),
        F.lit("").alias("input"),
        close_turn(repair_tags(F.col(answer))).alias("output"),
        (F.col(question).isNull() | F.col(answer).isNull()).alias("_reject"))
    ok = out.filter(~F.col("_reject")).drop("_reject")
    rejected = out.filter(F.col("_reject")).drop("_reject")
    return ok, rejected


def with_math_flag(df: DataFrame, instruction: str = "instruction") -> DataFrame:
    return df.withColumn("is_math", is_math(F.col(instruction)))


def toy_chat_ids(conversations: DataFrame, role_ids: dict, conv_col: str = "conv_id") -> DataFrame:
    """Chat token ids with real turn markers and one id per whitespace word.

    Each turn is ``[im_start, role_id, newline] + [1000 + len(word) ...] +
    [im_end, newline]``; a stand-in for a tokenizer that keeps the marker
    layout the label mask relies on. Turn arrays are built narrow, then one
    shuffle assembles each chat in turn order.
    """
    role = F.col("role")
    rid = F.lit(0)
    for name, v in role_ids.items():
        rid = F.when(role == name, F.lit(v)).otherwise(rid)
    words = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^ \t\r\n]+"), 0)
    body = F.transform(words, lambda w: (F.lit(1000) + F.length(w)).cast("int"))
    ids = F.concat(F.array(F.lit(C.IM_START_ID), rid, F.lit(198)), body, F.array(F.lit(151645), F.lit(198)))
    per_turn = conversations.select(conv_col, "turn", ids.alias("ids"))
    g = per_turn.groupBy(conv_col).agg(F.array_sort(F.collect_list(F.struct("turn", "ids"))).alias("_t"))
    return g.select(conv_col, F.flatten(F.transform("_t", lambda t: t["ids"])).alias("input_ids"))
