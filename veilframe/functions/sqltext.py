"""Small helpers for writing Spark SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def literal(value: str) -> str:
    """A Spark SQL string literal for ``value``."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(column: str) -> str:
    """A column name as an SQL identifier."""
    return "`" + column.replace("`", "``") + "`"


def bind(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def evaluated_once(df: DataFrame, value: Column, name: str, kept: list[str] | None = None) -> DataFrame:
    """``df``, or its columns ``kept``, and ``name`` for ``value``, computed once whatever is done with it later.

    The optimizer moves a filter on a projected column below the projection, and so
    repeats the column's expression, and whatever that is made of, inside the filter.
    It does not do so for the output of a generator.
    """
    columns = [quoted(c) for c in (df.columns if kept is None else kept) if c != name]
    return df.select(*columns, F.explode(F.array(value)).alias(name))
