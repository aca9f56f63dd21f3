"""Chat requests of whole conversations.

Turns are put in order without gathering a conversation: they are dealt by range of
(conversation, turn) and get running totals of their length (``ordered.running_sums``).
Messages are then joined part by part; a part ends once it holds ``PART`` characters, so a
conversation of any length is never one task's.  Nearly all conversations have one part,
which is the request; the parts of a longer one, put together in order, are its request.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.operators.ordered import running_sums

#: Characters of a part, of messages as JSON; a longer message is a part of its own.
PART = 1 << 24


def conversation_requests(
    turns: DataFrame, model: str, conversation: str, order: list[str], role: str = "role", content: str = "text", part: int = PART
) -> DataFrame:
    """``conversation``, part (numbers grow from 0, not always by one), n_turns (of the part), request.

    ``order`` names the columns that put turns in order, nulls first; turns equal in all of them
    are ordered by their messages.  A null role or content is an empty string; a turn
    without number still counts.  Null is a conversation like any other.
    """
    message = F.to_json(F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(content, F.lit("")).alias("content")))
    places = [F.col(c).alias(f"order_{k}") for k, c in enumerate(order)]
    plain = turns.select(F.col(conversation).alias("chat"), *places, message.alias("message")).withColumn("size", F.length("message") + 1)
    by = [*[f"order_{k}" for k in range(len(order))], "message"]
    placed = running_sums(plain, ["chat"], by, {"until": F.col("size"), "nth": F.lit(1)})
    parts = placed.withColumn("part", F.expr(f"(until - size) div {part}"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("nth", "message"))), lambda m: m["message"])
    joined = parts.groupBy("chat", "part").agg(
        F.count("*").alias("n_turns"), F.min("nth").alias("first"), F.max("until").alias("until"), F.array_join(in_order, ",").alias("messages")
    )
    totals = plain.groupBy(F.col("chat").alias("c")).agg(F.sum("size").alias("total"))
    both = joined.join(totals, F.col("chat").eqNullSafe(F.col("c")))
    head = F.when(F.col("first") == 1, F.lit(f'{{"model":{json.dumps(model, ensure_ascii=False)},"messages":[')).otherwise(F.lit(","))
    tail = F.when(F.col("until") == F.col("total"), F.lit("]}")).otherwise(F.lit(""))
    return both.select(F.col("chat").alias(conversation), "part", "n_turns", F.concat(head, "messages", tail).alias("request"))
