"""Named registration of data handlers (DataFrame -> DataFrame transforms).

A handler has the two hooks of the original handler contract: a text
formatting step (a Column expression over the record) and a tokenize step
(a DataFrame transform producing ``input_ids`` / ``labels``). Handlers are
looked up by name from a job config.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import constants as C
from millrace.functions.text import message_text

HANDLERS: dict[str, "Handler"] = {}


@dataclass
class Handler:
    name: str
    format_func: Callable[[DataFrame], Column]
    tokenize_func: Callable[[DataFrame, dict], DataFrame]

    def apply(self, df: DataFrame, **params) -> DataFrame:
        return self.tokenize_func(df.withColumn("message", self.format_func(df)), params)


def register_handler(name: str):
    """Decorator: ``@register_handler('x')`` on a function returning a :class:`Handler`."""
    def deco(factory):
        HANDLERS[name] = factory()
        return factory
    return deco


def get_handler(name: str) -> Handler:
    if name not in HANDLERS:
        raise KeyError(f"no handler named {name!r}; known: {sorted(HANDLERS)}")
    return HANDLERS[name]


@register_handler("instruct_sft")
def _instruct_sft() -> Handler:
    """instruction + output + newline -> BPE ids -> prompt-masked labels (truncated)."""

    def fmt(df: DataFrame) -> Column:
        return message_text(F.col("instruction"), F.col("output"))

    def tok(df: DataFrame, params: dict) -> DataFrame:
        from millrace.operators.labels import build_labels
        from millrace.operators.tokenize import bpe_encode
        enc = bpe_encode(df, [params.get("id_col", "id")], "message", params["merges"], params["vocab"],
                         params.get("unk_id"))
        enc = enc.withColumnRenamed("ids", "input_ids")
        # the answer opens after "<|im_start|>assistant\n": take the role word's
        # ids from the vocabulary in use (one constant row, encoded once)
        probe = df.sparkSession.createDataFrame([(0, "assistant\n")], "k int, message string")
        role = bpe_encode(probe, ["k"], "message", params["merges"], params["vocab"]).first()["ids"]
        return build_labels(enc, "input_ids", params.get("seq_length", C.SEQ_LENGTH),
                            role_id=role[0], skip=1 + len(role))

    return Handler("instruct_sft", fmt, tok)
