"""High-water marks: the next-value counters of a copy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinproof.operators.counts import TableMap
from twinproof.operators.scope import Scope, user_tables

NAME = ["schema_name", "name"]


def max_key(tables: TableMap, keys: dict[tuple[str, str], str]) -> DataFrame:
    """``schema_name, name, last_value``: highest key of every table, NULL for an empty one."""
    names = [name for name in tables if name in keys]
    # one shuffle for all: a task sends one row per table it read
    tagged = [tables[name].select(F.lit(i).alias("_at"), F.col(keys[name]).cast("bigint").alias("_key")) for i, name in enumerate(names)]
    top = reduce(DataFrame.unionByName, tagged).groupBy("_at").agg(F.max("_key").alias("last_value"))
    listed = top.sparkSession.createDataFrame([(i, *n) for i, n in enumerate(names)], "_at int, schema_name string, name string")
    return listed.join(top, "_at", "left").select(*NAME, "last_value")


def marks_in_scope(marks: DataFrame, scope: Scope) -> DataFrame:
    """Marks of the listed schemas, or of all user schemas when none is listed."""
    if scope.schemas:
        return marks.filter(F.col("schema_name").isin(*scope.schemas))
    return user_tables(marks)


def sync_marks(source: DataFrame, target: DataFrame) -> DataFrame:
    """``schema_name, name, old_value, new_value, status`` per source mark.

    The target takes the source value as it is, even when its own is higher. A mark that never
    advanced is ``skipped``, one the target lacks is ``failed``; neither stops the others.
    """
    have = target.select(*NAME, F.col("last_value").alias("old_value"), F.lit(True).alias("_found"))
    joined = source.join(have, NAME, "left")
    status = (
        F.when(F.col("last_value").isNull(), "skipped").when(F.col("_found").isNull(), "failed").otherwise("applied")
    )
    rows = joined.withColumn("status", status)
    new = F.when(F.col("status") == "applied", F.col("last_value")).otherwise(F.col("old_value"))
    return rows.select(*NAME, "old_value", new.alias("new_value"), "status")


def marks_after_sync(source: DataFrame, target: DataFrame) -> DataFrame:
    """The target's marks once the applied values are in; marks only the target has stay."""
    applied = sync_marks(source, target).filter("status = 'applied'").select(*NAME, F.col("new_value").alias("last_value"))
    return applied.unionByName(target.select(*NAME, "last_value").join(applied, NAME, "left_anti"))
