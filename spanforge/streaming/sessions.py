"""Replay sessions on a stream: each session goes through the recorded answers of each key by itself.

The state of a session is its next number and how often it has asked each key, so it grows with the keys of one recording. One task at a time holds a
session, so there is nothing to settle between writers, and a restart goes on from the checkpoint.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JOURNAL = "session string, seq long, ord long, tool string, key string, outcome string, answer int"


def replay_sessions(calls: DataFrame, recorded: DataFrame, *, exhausted: str = "repeat") -> DataFrame:
    """The journal of a stream of ``calls`` (session, op_id, ord, tool, key) against the table ``recorded`` (op_id, key): outcome,
    and which answer of the key (from 1) was given. ``exhausted`` is repeat (the last answer again) or diverge."""
    sizes = recorded.groupBy("op_id", "key").agg(F.count("*").cast("int").alias("answers"))
    asked = calls.join(sizes, ["op_id", "key"], "left").select("session", "ord", "tool", "key", F.coalesce("answers", F.lit(0)).alias("answers"))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        seq, cursor = (state.get[0], json.loads(state.get[1])) if state.exists else (0, {})
        rows = pd.concat(list(batches)).sort_values("ord", kind="stable")
        out = []
        for r in rows.itertuples(index=False):
            n = cursor.get(r.key, 0)
            if n < r.answers:
                outcome, answer = "matched", n + 1
                cursor[r.key] = n + 1
            elif r.answers and exhausted == "repeat":
                outcome, answer = "repeated", r.answers
            else:
                outcome, answer = "diverged", None
            out.append((key[0], seq, r.ord, r.tool, r.key, outcome, answer))
            seq += 1
        state.update((seq, json.dumps(cursor)))
        yield pd.DataFrame(out, columns=["session", "seq", "ord", "tool", "key", "outcome", "answer"]).astype({"answer": "Int32"})

    return asked.groupBy("session").applyInPandasWithState(step, JOURNAL, "seq long, cursor string", "append", "NoTimeout")
