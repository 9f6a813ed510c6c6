"""Checks on a loaded table, and the split into good and quarantined rows.

Constraints are checked after the load, in bulk. NULL handling follows SQL: a NULL passes CHECK,
FOREIGN KEY, length and cast rules, and NULL keys never collide.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named row rule; ``violated`` is true on rows that break it."""

    name: str
    violated: Column


def not_null(col: str) -> Rule:
    return Rule(f"not-null:{col}", F.col(col).isNull())


def predicate(name: str, condition: Column) -> Rule:
    return Rule(f"check:{name}", ~condition)


def max_length(col: str, n: int) -> Rule:
    return Rule(f"too-long:{col}", F.char_length(col) > n)


# Bits of the integer types.
_INTEGERS = {"tinyint": 8, "smallint": 16, "int": 32, "integer": 32, "bigint": 64}


def castable(col: str, data_type: str) -> Rule:
    text, name = F.col(col), f"invalid-{data_type}:{col}"
    if data_type not in _INTEGERS:
        return Rule(name, text.isNotNull() & text.try_cast(data_type).isNull())
    # a failing try_cast costs an exception per row; the pattern leaves only a range to check
    top = 1 << (_INTEGERS[data_type] - 1)
    number = F.when(text.rlike(r"^\s*[+-]?0*[0-9]{1,38}\s*$"), F.trim(text).cast("decimal(38,0)"))
    fits = number.between(F.lit(Decimal(-top)), F.lit(Decimal(top - 1)))
    return Rule(name, text.isNotNull() & ~F.coalesce(fits, F.lit(False)))


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """``column_name, nulls`` for every listed column, in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counted.unpivot([], cols, "column_name", "nulls")


def check_predicate(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where the condition is false."""
    return df.filter(~condition)


def check_length(df: DataFrame, col: str, n: int) -> DataFrame:
    """Rows whose text has more than ``n`` characters."""
    return df.filter(max_length(col, n).violated)


def check_castable(df: DataFrame, col: str, data_type: str) -> DataFrame:
    """Rows whose value is not valid, or out of range, for the type."""
    return df.filter(castable(col, data_type).violated)


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, n`` of every key that occurs more than once."""
    present = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_foreign_key(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """``child key, n`` of every child key without a parent row; ``on`` pairs child with parent columns.

    Child rows are counted per key before the join, so a key with very many rows joins as one.
    """
    child_keys = [c for c, _ in on]
    present = reduce(and_, [F.col(c).isNotNull() for c in child_keys])
    counted = child.filter(present).groupBy(*child_keys).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(*[F.col(p).alias(c) for c, p in on])
    return counted.join(parents, child_keys, "left_anti")


KeyPairs = Sequence[tuple[str, str]]


#: Keys that are looked up apart. A key with more than one in so many rows is always among them.
COMMONEST = 256


def _tagged(df: DataFrame, keys: list[str], bad: DataFrame, tag: str) -> DataFrame:
    """The rows plus ``tag``, true where the row's key is one of ``bad``.

    Rows with the commonest keys get their answer from a list of ``COMMONEST`` entries, which is broadcast; rows with a NULL in the key have
    theirs. Both then pass the join with the other keys under a salt that matches nothing, so no key holds them together.
    """
    present = reduce(and_, [F.col(k).isNotNull() for k in keys])
    counted = df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    first = counted.orderBy(F.desc("_n"), *keys).limit(COMMONEST).select(*keys)
    answers = first.join(bad.select(*keys, F.lit(True).alias("_is")), keys, "left").select(*keys, F.coalesce("_is", F.lit(False)).alias("_common"))
    rows = df.join(F.broadcast(answers), keys, "left")
    salt = F.when(present & F.col("_common").isNull(), F.lit(0)).otherwise(F.monotonically_increasing_id() % 1023 + 1)
    # always 0, but no constant: the optimizer would turn that into a filter and join by the key alone
    rest = bad.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(1)).cast("bigint").alias("_salt"), F.lit(True).alias("_rare"))
    joined = rows.withColumn("_salt", salt.cast("bigint")).join(rest, [*keys, "_salt"], "left")
    return joined.select(*df.columns, F.coalesce("_common", "_rare", F.lit(False)).alias(tag))


def _flagged(
    df: DataFrame, rules: Sequence[Rule], unique: Sequence[list[str]], foreign: Sequence[tuple[DataFrame, KeyPairs]]
) -> tuple[DataFrame, list[tuple[str, Column]]]:
    """The rows joined with the offending keys, and a never-NULL condition per rule name.

    Offending keys are joined once each, so no row is ever doubled.
    """
    offenders = [(f"unique:{','.join(keys)}", keys, check_unique(df, keys)) for keys in unique]
    for parent, on in foreign:
        child_keys = [c for c, _ in on]
        offenders.append((f"foreign-key:{','.join(child_keys)}", child_keys, check_foreign_key(df, parent, on)))
    conditions = [(r.name, F.coalesce(r.violated, F.lit(False))) for r in rules]
    for i, (name, keys, bad) in enumerate(offenders):
        df = _tagged(df, keys, bad, f"_bad{i}")
        conditions.append((name, F.col(f"_bad{i}")))
    return df, conditions


def _names(conditions: list[tuple[str, Column]]) -> Column:
    # joined and split again: unlike array_compact, that stays inside generated code
    text = F.concat_ws("\n", *[F.when(broken, F.lit(name)) for name, broken in conditions])
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))


def tag_violations(
    df: DataFrame,
    rules: Sequence[Rule] = (),
    unique: Sequence[list[str]] = (),
    foreign: Sequence[tuple[DataFrame, KeyPairs]] = (),
) -> DataFrame:
    """Every row plus ``violations ARRAY<STRING>``, the names of all rules it breaks."""
    flagged, conditions = _flagged(df, rules, unique, foreign)
    violations = _names(conditions) if conditions else F.array().cast("array<string>")
    return flagged.select(*df.columns, violations.alias("violations"))


def split_valid(
    df: DataFrame,
    rules: Sequence[Rule] = (),
    tolerate: bool = True,
    unique: Sequence[list[str]] = (),
    foreign: Sequence[tuple[DataFrame, KeyPairs]] = (),
) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: good rows as they were, bad ones with their ``violations``.

    Without ``tolerate`` the first bad row fails the job that reads ``good``.
    """
    if not (rules or unique or foreign):
        raise ValueError("no rule given")
    flagged, conditions = _flagged(df, rules, unique, foreign)
    broken = reduce(or_, [c for _, c in conditions])
    # names are put together for the bad rows only
    bad = flagged.filter(broken).select(*df.columns, _names(conditions).alias("violations"))
    keep = ~broken
    if not tolerate:
        message = F.concat(F.lit("row breaks "), F.array_join(_names(conditions), ", "))
        keep = F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return flagged.filter(keep).select(*df.columns), bad
