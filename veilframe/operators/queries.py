"""SQL over registered Parquet tables, and results as JSON records or as text."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StructType

from veilframe.sources import tables


# The parts of a statement: quoted text, what may be left out at its ends, words and other signs.
_PART = re.compile(
    r"""(?s)'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|(?P<gap>\s+|;|--[^\n]*|/\*.*?\*/)|\w+|."""
)
QUERY_WORDS = ("SELECT", "WITH", "FROM", "VALUES", "TABLE", "(")


def check_query(spark: SparkSession, sql: str) -> str:
    """The statement without closing semicolons; anything but a query is an error.

    A query begins with one of a few words; what else would parse inside ``SELECT *
    FROM (...)`` is a name, as in ``DESCRIBE nation``.  A command that begins like a
    query does not parse there.
    """
    parts = [part for part in _PART.finditer(sql) if part["gap"] is None]
    if not parts or parts[0].group().upper() not in QUERY_WORDS:
        raise ValueError(f"not a query: {sql.strip()[:80]}")
    bare = sql[: parts[-1].end()]
    spark.sql(f"SELECT * FROM (\n{bare}\n)")
    return bare


def run_query(spark: SparkSession, sql: str, max_rows: int | None = None) -> DataFrame:
    """Run a query over the tables of the session; lazy, limited only on request."""
    df = spark.sql(check_query(spark, sql))
    return df if max_rows is None else df.limit(max_rows)


def records(df: DataFrame) -> DataFrame:
    """Every row as one JSON object, nulls written out."""
    repeated = {c for c in df.columns if df.columns.count(c) > 1}
    if repeated:
        raise ValueError(f"a JSON object needs distinct column names: {sorted(repeated)}")
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def print_query(spark: SparkSession, sql: str, rows: int | None = None) -> None:
    """Echo the query and print its whole result as a text table, or its first ``rows`` if asked."""
    print(f"Query: {sql}")
    df = run_query(spark, sql)
    if rows is None:
        print_table(df)
    else:
        df.show(rows, truncate=False)


def print_table(df: DataFrame) -> None:
    """The text table that ``df.show`` prints of all rows, without bringing them to the driver at once.

    The width of a column depends on every row, so the result is computed twice: widths are an
    aggregate, then the driver prints one partition after the other.
    """
    cells = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    cells = cells.select(*[_cell(F.col(c), cells.schema[c].dataType).alias(c) for c in cells.columns])
    names = [_escaped(name) for name in df.columns]
    found = cells.agg(*[F.max(_width(F.col(c))).alias(c) for c in cells.columns]).first() if names else []
    widths = [max(3, _plain_width(name), n or 0) for name, n in zip(names, found, strict=True)]
    rule = "+" + "".join("-" * w + "+" for w in widths)
    print(rule)
    print("|" + "".join(name + " " * (w - _plain_width(name)) + "|" for name, w in zip(names, widths, strict=True)))
    print(rule)
    padded = [F.concat(F.col(c), F.repeat(F.lit(" "), F.lit(w) - _width(F.col(c))), F.lit("|")) for c, w in zip(cells.columns, widths, strict=True)]
    for row in cells.select(F.concat(F.lit("|"), *padded)).toLocalIterator():
        print(row[0])
    print(f"{rule}\n")


# Characters that take two places of a text table; signs that Spark prints escaped.
_WIDE = "\u1100-\u115F\u2E80-\uA4CF\uAC00-\uD7A3\uF900-\uFAFF\uFE10-\uFE19\uFE30-\uFE6F\uFF00-\uFF60\uFFE0-\uFFE6"
_ESCAPES = {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\f": "\\f", "\b": "\\b", "\x0b": "\\v", "\x07": "\\a"}


def _escaped(text: str) -> str:
    return reduce(lambda t, e: t.replace(*e), _ESCAPES.items(), text)


def _plain_width(text: str) -> int:
    units = len(text.encode("utf-16-le")) // 2  # as Java counts
    return units + len(re.findall(f"[{_WIDE}]", text))


def _width(text: Column) -> Column:
    pairs = F.length(F.regexp_replace(text, r"[^\x{10000}-\x{10FFFF}]", ""))
    return F.length(text) + pairs + F.length(F.regexp_replace(text, f"[^{_WIDE}]", ""))


def _cell(value: Column, kind: DataType) -> Column:
    """A value as Spark shows it."""
    if isinstance(kind, BinaryType):
        text = F.concat(F.lit("["), F.array_join(F.regexp_extract_all(F.hex(value), F.lit("(..)")), " "), F.lit("]"))
    else:
        text = value.cast("string")
    text = reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), _ESCAPES.items(), text)
    return F.coalesce(text, F.lit("NULL"))


class ParquetQueries:
    """A set of Parquet directories as tables, queried without state between calls.

    File schemas are read once; each call gets its own Spark session, in which only
    these tables are registered.
    """

    def __init__(self, spark: SparkSession, paths: dict[str, str]):
        self.spark = spark
        self.paths = dict(paths)
        self._schemas: dict[str, StructType] = {}

    def session(self) -> SparkSession:
        fresh = self.spark.newSession()
        for name, path in self.paths.items():
            if name not in self._schemas:
                self._schemas[name] = fresh.read.parquet(path).schema
            fresh.read.schema(self._schemas[name]).parquet(path).createOrReplaceTempView(name)
        return fresh

    def tables(self) -> DataFrame:
        return tables.list_tables(self.session())

    def schema(self, table: str) -> DataFrame:
        return tables.describe_table(self.session(), table)

    def query(self, sql: str, max_rows: int | None = None) -> DataFrame:
        return run_query(self.session(), sql, max_rows)
