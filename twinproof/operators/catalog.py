"""Schemas as rows, and what one side has that the other lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinproof.operators.counts import TableMap

CATALOG_SCHEMA = "schema_name string, table_name string, column_name string, data_type string"


def catalog_columns(spark: SparkSession, tables: TableMap) -> DataFrame:
    """One row per column. Only names and types are read, no data."""
    rows = [(s, t, name, kind) for (s, t), df in tables.items() for name, kind in df.dtypes]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def missing_objects(source: DataFrame, target: DataFrame, tolerate: bool = False) -> DataFrame:
    """``schema_name, table_name, column_name, problem, fatal`` of source columns the target cannot take.

    ``missing-table`` has one row per table (NULL column), ``missing-column`` and ``type-change`` one
    per column. Nothing is fatal when tolerated.
    """
    table = ["schema_name", "table_name"]
    column = [*table, "column_name"]
    have = target.select(*column, F.col("data_type").alias("_type"))
    tables = target.select(*table).distinct().withColumn("_known", F.lit(True))
    problem = (
        F.when(F.col("_known").isNull(), "missing-table")
        .when(F.col("_type").isNull(), "missing-column")
        .when(F.col("_type") != F.col("data_type"), "type-change")
    )
    found = source.join(tables, table, "left").join(have, column, "left").withColumn("problem", problem)
    name = F.when(F.col("problem") != "missing-table", F.col("column_name")).alias("column_name")
    return (
        found.filter(F.col("problem").isNotNull())
        .select(*table, name, "problem")
        .distinct()
        .withColumn("fatal", F.lit(not tolerate))
    )
