"""Table profiles, logical sizes and throughput."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinproof.operators.counts import TableMap

_TEXT = (T.StringType, T.CharType, T.VarcharType, T.BinaryType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


# Bytes of the types whose values are not eight long.
_FIXED = {"tinyint": 1, "boolean": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}


def width(df: DataFrame, name: str) -> Column:
    """Bytes of one value: text by its bytes, arrays of fixed types by their elements, everything else by its type."""
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, _TEXT):
        return F.octet_length(col).cast("bigint")
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (*_TEXT, *_NESTED)):
        return F.when(col.isNotNull(), F.size(col).cast("bigint") * _FIXED.get(kind.elementType.simpleString(), 8))
    if isinstance(kind, _NESTED):
        return F.octet_length(F.to_json(F.struct(col))).cast("bigint")
    return F.when(col.isNotNull(), F.lit(_FIXED.get(kind.simpleString(), 8)).cast("bigint"))


def comparable(df: DataFrame, name: str) -> Column:
    """Short bytes that are equal for equal values and differ for others; long values by their 128-bit hash."""
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, _TEXT):
        return F.unhex(F.md5(col))
    if isinstance(kind, _NESTED):
        return F.when(col.isNotNull(), F.unhex(F.md5(F.to_json(F.struct(col)))))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        col = F.when(col == 0, F.lit(0.0)).otherwise(col)  # both zeros are one value
    return col.cast("string").cast("binary")


def distinct_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``column_name, ndv``: exact, NULLs left out.

    Values of all columns go through one shuffle as (column, short bytes), put together in the map tasks first; then they are counted.
    """
    cols = cols or df.columns
    values = F.array(*[F.struct(F.lit(i).alias("at"), comparable(df, c).alias("value")) for i, c in enumerate(cols)])
    each = df.select(F.explode(values).alias("v")).select("v.*").where(F.col("value").isNotNull()).distinct()
    counted = each.groupBy("at").agg(F.count(F.lit(1)).alias("ndv"))
    listed = df.sparkSession.createDataFrame(list(enumerate(cols)), "at int, column_name string")
    return listed.join(counted, "at", "left").select("column_name", F.coalesce("ndv", F.lit(0)).alias("ndv"))


def table_stats(df: DataFrame, cols: list[str] | None = None, exact: bool = False) -> DataFrame:
    """``column_name, rows, nulls, ndv, min_value, max_value, avg_width, max_width`` in one pass.

    Distinct counts are HyperLogLog sketches, merged map-side; ``exact`` counts them by ``distinct_counts``, in a second pass.
    """
    cols = cols or df.columns
    one = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.struct(
                F.count_if(F.col(c).isNull()).alias("nulls"),
                (F.lit(0).cast("bigint") if exact else F.approx_count_distinct(c)).alias("ndv"),
                F.min(c).cast("string").alias("min_value"),
                F.max(c).cast("string").alias("max_value"),
                F.avg(width(df, c)).alias("avg_width"),
                F.max(width(df, c)).alias("max_width"),
            ).alias(f"_{i}")
            for i, c in enumerate(cols)
        ],
    )
    per_column = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("s")) for i, c in enumerate(cols)])
    found = one.select("rows", F.explode(per_column).alias("c")).select("c.column_name", "rows", "c.s.*")
    return found.drop("ndv").join(distinct_counts(df, cols), "column_name").select(*found.columns) if exact else found


def db_size(tables: TableMap) -> DataFrame:
    """``schema_name, table_name, rows, bytes`` per table, plus totals with NULL names. Rows are counted, not estimated."""
    names = list(tables)
    # one shuffle for all: a task sends one row per table it read, and tables without rows come from the list
    sized = [
        df.select(F.lit(i).alias("_at"), reduce(lambda a, b: a + b, [F.coalesce(width(df, c), F.lit(0)) for c in df.columns]).alias("_bytes"))
        for i, df in enumerate(tables.values())
    ]
    tagged = reduce(DataFrame.unionByName, sized).groupBy("_at").agg(F.count(F.lit(1)).alias("rows"), F.sum("_bytes").alias("bytes"))
    listed = tagged.sparkSession.createDataFrame([(i, *n) for i, n in enumerate(names)], "_at int, schema_name string, table_name string")
    sizes = listed.join(tagged, "_at", "left").select("schema_name", "table_name", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "bytes")])
    return sizes.rollup("schema_name", "table_name").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))


def throughput(runs: DataFrame) -> DataFrame:
    """``run_id, gb, minutes, gb_per_min, label`` from ``run_id, bytes, seconds``; blank when there is no time."""
    gb = F.col("bytes") / F.lit(float(1 << 30))
    minutes = F.when(F.col("seconds") > 0, F.col("seconds") / F.lit(60.0))
    rate = gb / minutes
    return runs.select(
        "run_id",
        gb.alias("gb"),
        minutes.alias("minutes"),
        rate.alias("gb_per_min"),
        F.coalesce(F.format_string("%.2f GB/min", rate), F.lit("-")).alias("label"),
    ).withColumn("label", F.when(F.col("gb_per_min").isNull(), "-").otherwise(F.col("label")))


def column_statistics(spark: SparkSession, table: str, column: str) -> dict[str, str]:
    """What ``ANALYZE TABLE`` stored for one column."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table} `{column}`").collect()
    return {r["info_name"]: r["info_value"] for r in rows}
