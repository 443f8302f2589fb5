"""Chat-template rendering as array -> string column expressions.

JSON inside the text is written as the template's ``tojson`` writes it: a space
after each comma and colon, nulls kept, other characters as they are. Spark's
``to_json`` writes neither, so tools and arguments go through
:func:`template_json` and :func:`with_template_arguments` first.

``messages`` is ``array<struct<role, content[, tool_calls]>>`` in chat
order. Rendering is one ``transform`` over the array plus a system head,
all JVM-side; neighbouring roles are read with ``get`` (null past the ends).
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import constants as C

NL = "\n"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _respace(text):
    return None if text is None else json.dumps(json.loads(text), ensure_ascii=False)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _respace_all(lists: pd.Series) -> pd.Series:
    return lists.map(lambda xs: None if xs is None else [_respace(x) for x in xs])


@F.pandas_udf(T.StringType())
def _respace_arguments(messages: pd.Series) -> pd.Series:
    def one(text):
        if text is None:
            return None
        found = json.loads(text)
        for m in found:
            for call in m.get("tool_calls") or ():
                call = call.get("function") or call
                if call.get("arguments") is not None:
                    call["arguments"] = _respace(call["arguments"])
        return json.dumps(found)
    return messages.map(one)


def template_json(df: DataFrame, tools_col: str) -> Column:
    """Tools (an array of JSON texts or of structs) as JSON texts in the template's form."""
    kind = df.schema[tools_col].dataType.elementType
    texts = F.col(tools_col) if isinstance(kind, T.StringType) else F.transform(
        tools_col, lambda x: F.to_json(x, {"ignoreNullFields": "false"}))
    return _respace_all(texts)


def with_template_arguments(df: DataFrame, messages_col: str = "messages") -> DataFrame:
    """``df`` with the ``arguments`` of all tool calls (JSON texts) in the template's form."""
    kind = df.schema[messages_col].dataType
    return df.withColumn(messages_col, F.from_json(_respace_arguments(
        F.to_json(messages_col, {"ignoreNullFields": "false"})), kind))


def system_head(messages, default_system: str = C.CHAT_DEFAULT_SYSTEM, tools=None) -> Column:
    """System block: the first message when it is a system turn, else the default text.

    With tools (an array of JSON texts, see :func:`template_json`), the
    signatures go into the system block, one per line, between the fixed
    header and footer.
    """
    m = _c(messages)
    first = F.get(m, 0)
    is_sys = F.coalesce(first["role"] == F.lit("system"), F.lit(False))
    text = F.when(is_sys, F.coalesce(first["content"], F.lit(""))).otherwise(F.lit(default_system))
    if tools is None:
        return F.concat(F.lit("<|im_start|>system\n"), text, F.lit("<|im_end|>\n"))
    t = _c(tools)
    listing = F.coalesce(F.array_join(F.transform(t, lambda x: F.concat(F.lit(NL), x)), ""),
                         F.lit(""))
    plain = F.concat(F.lit("<|im_start|>system\n"), text, F.lit("<|im_end|>\n"))
    with_tools = F.concat(F.lit("<|im_start|>system\n"), text, F.lit(C.TOOLS_HEADER), listing,
                          F.lit(C.TOOLS_FOOTER))
    return F.when(F.coalesce(F.size(t), F.lit(0)) > 0, with_tools).otherwise(plain)


def _tool_call_text(tc: Column, wrapped: bool) -> Column:
    """``\\n<tool_call>\\n{"name": "...", "arguments": <json>}\\n</tool_call>``.

    ``arguments`` holds the arguments serialised as JSON. With ``wrapped``, a
    call may carry name and arguments in a ``function`` struct, which wins.
    """
    def part(name: str) -> Column:
        return F.when(tc["function"].isNotNull(), tc["function"][name]).otherwise(tc[name]) if wrapped else tc[name]

    return F.concat(F.lit('\n<tool_call>\n{"name": "'), F.coalesce(part("name"), F.lit("")),
                    F.lit('", "arguments": '), F.coalesce(part("arguments"), F.lit("null")),
                    F.lit("}\n</tool_call>"))


def render_turns(messages, with_tool_calls: bool = False, wrapped_calls: bool = False) -> Column:
    """Body of the chat: one piece per message, joined.

    * user, later system turns, assistant without tool calls:
      ``<|im_start|>role\\ncontent<|im_end|>\\n``
    * assistant with tool calls: optional content, then one block per call
    * tool: a run of consecutive tool turns shares one user block
    * any other role renders nothing (and a leading system turn is in the head)
    """
    m = _c(messages)

    def piece(x, i):
        role = x["role"]
        content = F.coalesce(x["content"], F.lit(""))
        prev_role = F.get(m, i - 1)["role"]
        next_role = F.get(m, i + 1)["role"]
        plain = F.concat(F.lit("<|im_start|>"), role, F.lit(NL), content, F.lit("<|im_end|>\n"))
        if with_tool_calls:
            calls = x["tool_calls"]
            has_calls = F.coalesce(F.size(calls), F.lit(0)) > 0
        else:
            calls = None
            has_calls = F.lit(False)
        tool = F.concat(
            F.when(prev_role.isNull() | (prev_role != F.lit("tool")), F.lit("<|im_start|>user")).otherwise(F.lit("")),
            F.lit("\n<tool_response>\n"), content, F.lit("\n</tool_response>"),
            F.when(next_role.isNull() | (next_role != F.lit("tool")), F.lit("<|im_end|>\n")).otherwise(F.lit("")))
        out = F.when((role == "user") | ((role == "system") & (i > 0)) | ((role == "assistant") & ~has_calls), plain)
        if with_tool_calls:
            call_block = F.concat(
                F.lit("<|im_start|>assistant"),
                F.when(content != F.lit(""), F.concat(F.lit(NL), content)).otherwise(F.lit("")),
                F.array_join(F.transform(calls, lambda tc: _tool_call_text(tc, wrapped_calls)), ""),
                F.lit("<|im_end|>\n"))
            out = out.when(role == "assistant", call_block)
        return out.when(role == "tool", tool).otherwise(F.lit(""))

    return F.array_join(F.transform(m, piece), "")


def render_chat(messages, add_generation_prompt: bool = False, default_system: str = C.CHAT_DEFAULT_SYSTEM,
                tools=None, with_tool_calls: bool = False, wrapped_calls: bool = False) -> Column:
    """Full chat text: system head + turns (+ the assistant opener when asked).

    ``default_system`` is the evaluation template's text; the tokenizer
    config's template has ``constants.CHAT_DEFAULT_SYSTEM_CONFIG``.
    """
    parts = [system_head(messages, default_system, tools), render_turns(messages, with_tool_calls, wrapped_calls)]
    if add_generation_prompt:
        parts.append(F.lit("<|im_start|>assistant\n"))
    return F.concat(*parts)


def unknown_role_count(messages, known=("system", "user", "assistant", "tool")) -> Column:
    """How many messages have a role the template does not render."""
    return F.size(F.filter(_c(messages), lambda x: ~x["role"].isin(*known) | x["role"].isNull()))
