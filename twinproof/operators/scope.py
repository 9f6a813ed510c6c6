"""Which tables a run touches."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Schemas that never hold user tables.
SYSTEM_SCHEMAS = ["pg_catalog", "information_schema", "pg_toast"]
TEMP_PREFIXES = ["pg_temp_", "pg_toast_temp_"]

KINDS = ("all", "schema-only", "data-only")


@dataclass(frozen=True)
class Scope:
    """Include and exclude lists. Tables are ``(schema, table)`` pairs, so dots in names are harmless."""

    schemas: tuple[str, ...] = ()
    tables: tuple[tuple[str, str], ...] = ()
    exclude_schemas: tuple[str, ...] = ()
    exclude_tables: tuple[tuple[str, str], ...] = ()
    what: str = field(default="all")

    def __post_init__(self) -> None:
        if self.what not in KINDS:
            raise ValueError(f"what must be one of {KINDS}")
        for name in ("schemas", "exclude_schemas"):
            object.__setattr__(self, name, tuple(getattr(self, name)))
        for name in ("tables", "exclude_tables"):
            object.__setattr__(self, name, tuple((s, t) for s, t in getattr(self, name)))

    def _rule(self, schema_in, pair_in, every):
        """``(included, excluded)``, for columns or for plain names: schema list and table list add up, no list at all means everything."""
        listed = bool(self.schemas or self.tables)
        included = schema_in(self.schemas) | pair_in(self.tables) if listed else every
        return included, schema_in(self.exclude_schemas) | pair_in(self.exclude_tables)

    def _columns(self) -> tuple[Column, Column]:
        return self._rule(lambda names: F.col("schema_name").isin(*names), _pair_in, F.lit(True))

    def included(self) -> Column:
        return self._columns()[0]

    def excluded(self) -> Column:
        return self._columns()[1]


def keeps(scope: Scope, schema: str, table: str) -> bool:
    """The scope's decision on one name."""
    included, excluded = scope._rule(lambda names: schema in names, lambda pairs: (schema, table) in pairs, True)
    return included and not excluded


def _pair_in(pairs: tuple[tuple[str, str], ...]) -> Column:
    by_schema: dict[str, list[str]] = {}
    for schema, table in pairs:
        by_schema.setdefault(schema, []).append(table)
    matched = F.lit(False)
    for schema, names in by_schema.items():
        matched = matched | ((F.col("schema_name") == schema) & F.col("table_name").isin(*names))
    return matched


def select_tables(catalog: DataFrame, scope: Scope) -> DataFrame:
    """Listing rows in scope: includes first, exclusions last."""
    return exclude(catalog.filter(scope.included()), scope)


def exclude(catalog: DataFrame, scope: Scope) -> DataFrame:
    """Drop listed tables and every table of a listed schema."""
    return catalog.filter(~scope.excluded())


def user_tables(catalog: DataFrame) -> DataFrame:
    """Drop system and temporary schemas, and partition children: their parent covers them."""
    keep = ~F.col("schema_name").isin(*SYSTEM_SCHEMAS)
    for prefix in TEMP_PREFIXES:
        keep = keep & ~F.col("schema_name").startswith(prefix)
    if "is_partition" in catalog.columns:
        keep = keep & ~F.coalesce(F.col("is_partition"), F.lit(False))
    return catalog.filter(keep)


def filter_changes(changes: DataFrame, scope: Scope) -> DataFrame:
    """Change records of tables in scope, batch or streaming.

    The rules of ``select_tables`` hold here as well; the lists are literals, so the filter reaches
    the scan and needs no join.
    """
    return changes.filter(scope.included() & ~scope.excluded())
