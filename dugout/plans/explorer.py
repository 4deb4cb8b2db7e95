"""Looking into stored tables: what there is, and free SQL over views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def overview(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, n_columns)."""
    rows = (df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")) for name, df in tables.items())
    return reduce(DataFrame.unionByName, rows)


def columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, type)."""
    return spark.createDataFrame([(t, c, k) for t, df in tables.items() for c, k in df.dtypes], "table_name string, column_name string, type string")


def sql(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)


HELP = {"tables": "the tables, their rows and columns", "columns": "the columns of all tables", "help": "these words", "SELECT ...": "any query over the tables"}


def ask(spark: SparkSession, text: str, tables: dict[str, DataFrame]) -> DataFrame:
    """An explorer's line: one of the words of HELP, or a query over the tables by their names, which no view outlives."""
    word = text.strip().rstrip(";").lower()
    if word == "tables":
        return overview(tables)
    if word == "columns":
        return columns(spark, tables)
    if word == "help":
        return spark.createDataFrame(list(HELP.items()), "word string, says string")
    return _over(spark, text.strip().rstrip(";"), tables)


def _over(spark: SparkSession, text: str, tables: dict[str, DataFrame]) -> DataFrame:
    views = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    held = {n: spark.table(n) for n in tables if n in views}
    register(tables)
    try:
        return sql(spark, text)
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        register(held)
