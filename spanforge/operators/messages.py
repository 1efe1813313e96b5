"""The text of message trees."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(value, keys: frozenset[str] | None, out: list[str]) -> None:
    """Strings of nested JSON: of lists, and of objects under ``keys`` or in containers below other keys."""
    stack = [value]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif isinstance(x, list):
            stack.extend(reversed(x))
        elif isinstance(x, dict):
            stack.extend(reversed([v for k, v in x.items() if k in keys or isinstance(v, (dict, list))]))


# Keys of messages that hold text.
TEXT_KEYS = frozenset(("content", "text", "parts", "messages", "request"))


@F.pandas_udf(T.StringType())
def message_text(raw: pd.Series) -> pd.Series:
    """All text of a message tree (JSON text), a line each; text that is no JSON is its own."""
    def one(text):
        if text is None:
            return None
        try:
            tree = json.loads(text)
        except ValueError:
            return text
        found: list[str] = []
        _leaves(tree, TEXT_KEYS, found)
        return "\n".join(found)

    return raw.map(one)


def spoken(value) -> str:
    """The text of a content, a line for each string in it at any depth; of parts, those of text alone."""
    waiting, said = [value], []
    while waiting:
        x = waiting.pop()
        if isinstance(x, str):
            said.append(x)
        elif isinstance(x, list):
            waiting += reversed(x)
        elif isinstance(x, dict) and x.get("type") in (None, "text"):
            waiting.append(x.get("content") or x.get("text"))
    return "\n".join(x for x in said if x)


MESSAGES = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))


@F.pandas_udf(MESSAGES)
def plain_messages(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """role and plain text of each message of a JSON array (text); text that is no JSON, or a JSON string, is one message of the assistant, and
    what else is JSON is none."""
    def one(raw):
        if not raw:
            return []
        try:
            tree = json.loads(raw)
        except (ValueError, RecursionError):
            tree = raw
        if isinstance(tree, str):
            return [{"role": "assistant", "content": tree}]
        rows = [m for m in tree if isinstance(m, dict)] if isinstance(tree, list) else []
        roles = [m.get("role") for m in rows]
        return [{"role": "user" if r is None else r if isinstance(r, str) else json.dumps(r), "content": spoken(m.get("content") or m.get("parts"))} for r, m in zip(roles, rows, strict=True)]

    for batch in batches:
        yield pd.Series([one(x) for x in batch], dtype=object)
