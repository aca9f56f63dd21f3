"""Small scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHAT_RESPONSE = (
    "choices array<struct<message: struct<content: string>>>, "
    "usage struct<prompt_tokens: bigint, completion_tokens: bigint, total_tokens: bigint>"
)


def greet(name: Column) -> Column:
    return F.concat(F.lit("Hello, "), name, F.lit("!"))


def convert(text: Column) -> Column:
    """Every ``aaa``, from left to right, becomes ``XXX``."""
    return F.replace(text, F.lit("aaa"), F.lit("XXX"))


def chat_request(model: str, prompt: Column) -> Column:
    """The JSON request of a chat completion with one user message."""
    message = F.struct(F.lit("user").alias("role"), prompt.alias("content"))
    return F.to_json(F.struct(F.lit(model).alias("model"), F.array(message).alias("messages")))


def chat_answer(response: Column) -> Column:
    """Answer and usage of a chat completion response, as ``struct<answer, usage>``."""
    parsed = F.from_json(response, CHAT_RESPONSE)
    return F.struct(
        F.get(parsed["choices"], F.lit(0))["message"]["content"].alias("answer"), parsed["usage"].alias("usage")
    )
