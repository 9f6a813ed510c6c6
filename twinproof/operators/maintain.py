"""Statistics after a load."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from twinproof.operators.counts import in_scope
from twinproof.operators.scope import Scope

ANALYZE_SCHEMA = "schema_name string, table_name string, status string, error string"


def list_tables(spark: SparkSession, schemas: Sequence[str] = ()) -> list[tuple[str, str]]:
    """Catalog tables of the listed databases, or of all."""
    names = schemas or [db.name for db in spark.catalog.listDatabases()]
    return [(s, t.name) for s in names for t in spark.catalog.listTables(s) if t.tableType != "TEMPORARY"]


def _columns(spark: SparkSession, name: tuple[str, str]) -> str:
    """The columns that can have statistics: Spark keeps none for arrays, maps and structs."""
    fields = spark.table(f"`{name[0]}`.`{name[1]}`").schema.fields
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    plain = [f"`{f.name}`" for f in fields if not isinstance(f.dataType, nested)]
    if len(plain) == len(fields):
        return "FOR ALL COLUMNS"
    return f"FOR COLUMNS {', '.join(plain)}" if plain else ""


def analyze_all(spark: SparkSession, scope: Scope | None = None, jobs: int = 8) -> DataFrame:
    """``ANALYZE TABLE`` with column statistics on every table in scope; a table that fails is reported with its whole error and the rest go on."""
    scope = scope or Scope()

    def analyze(name: tuple[str, str]) -> tuple[str, str, str, str | None]:
        try:
            spark.sql(f"ANALYZE TABLE `{name[0]}`.`{name[1]}` COMPUTE STATISTICS {_columns(spark, name)}")
            return (*name, "analyzed", None)
        except (PySparkException, Py4JJavaError) as e:
            return (*name, "failed", str(e))

    with ThreadPoolExecutor(max(jobs, 1)) as pool:
        report = list(pool.map(analyze, in_scope(dict.fromkeys(list_tables(spark)), scope)))
    return spark.createDataFrame(report, ANALYZE_SCHEMA)
