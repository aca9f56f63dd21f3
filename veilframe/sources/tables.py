"""Parquet directories as tables, and what the catalog knows about them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register_parquet(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Register every Parquet file below ``path`` as one table; the schema comes from the files."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def list_tables(spark: SparkSession) -> DataFrame:
    """Names of the tables of all catalogs and schemas, sorted."""
    found = [
        spark.sql(f"SHOW TABLES IN `{catalog.name}`.`{schema.namespace}`").select(F.col("tableName").alias("name"))
        for catalog in spark.sql("SHOW CATALOGS").select(F.col("catalog").alias("name")).collect()
        for schema in spark.sql(f"SHOW SCHEMAS IN `{catalog.name}`").collect()
    ]
    # a temporary view shows up under every schema
    return reduce(DataFrame.union, found).distinct().orderBy("name")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """Name, type and nullability of each column; an unknown table is an error."""
    rows = [
        (table, k, field.name, field.dataType.simpleString(), field.nullable)
        for k, field in enumerate(spark.table(table).schema.fields)
    ]
    schema = "table string, position int, name string, data_type string, nullable boolean"
    return spark.createDataFrame(rows, schema)


def describe_table_nested(spark: SparkSession, table: str) -> DataFrame:
    """The same as one row with an array of columns."""
    column = F.struct("position", "name", "data_type", "nullable")
    columns = F.array_sort(F.collect_list(column))
    return (
        describe_table(spark, table)
        .groupBy("table")
        .agg(F.transform(columns, lambda c: F.struct(c["name"], c["data_type"], c["nullable"])).alias("columns"))
    )
