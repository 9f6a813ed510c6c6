"""Row digests that add up: equal multisets of rows give equal sums, in any order and any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LANES = 3
_LANE_BITS = 24
_LANE_MASK = (1 << _LANE_BITS) - 1


def _nested_text(col: Column, data_type: T.DataType) -> Column:
    """Text of a nested value; the entries of a map have no order of their own, so they are sorted."""
    if isinstance(data_type, T.MapType):
        col = F.array_sort(F.map_entries(col))
    return F.to_json(F.struct(col.alias("v")))


def _text(name: str, data_type: T.DataType) -> Column:
    """Text of one value that any SQL engine can reproduce for the common types."""
    col = F.col(f"`{name}`")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(col).cast("string")
    if isinstance(data_type, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), col).cast("string")
    if isinstance(data_type, T.DateType):
        return F.unix_date(col).cast("string")
    if isinstance(data_type, T.BinaryType):
        return F.hex(col)
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        # only free text can contain the separator; its length in front keeps the row text unambiguous
        return F.concat(F.char_length(col).cast("string"), F.lit(":"), col)
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        nested = F.when(col.isNotNull(), _nested_text(col, data_type))
        return F.concat(F.char_length(nested).cast("string"), F.lit(":"), nested)
    return col.cast("string")


def row_text(df: DataFrame, cols: list[str]) -> Column:
    """Fields joined by ``|``; NULL is ``~``, text carries its length."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.concat_ws("|", *[F.coalesce(_text(c, types[c]), F.lit("~")) for c in cols])


def _hash64(df: DataFrame, cols: list[str]) -> Column:
    # the hash skips NULLs, so the NULL flags go in as well: (NULL, 1) and (1, NULL) must differ
    types = {f.name: f.dataType for f in df.schema.fields}
    values = [
        _nested_text(F.col(f"`{c}`"), types[c]) if "map<" in types[c].simpleString() else F.col(f"`{c}`") for c in cols
    ]
    flags = [F.isnull(F.col(f"`{c}`")) for c in cols]
    return F.xxhash64(*flags, *values)


def hash_column(df: DataFrame, cols: list[str], portable: bool = False) -> Column:
    """One hash per row: ``md5`` text that other engines can compute too, or the faster 64-bit hash."""
    return F.md5(row_text(df, cols)) if portable else _hash64(df, cols)


def lanes(hashed: Column, portable: bool) -> list[Column]:
    """The hash cut into short numbers: a BIGINT sum of 24-bit numbers holds 2^39 rows."""
    if portable:
        return [F.conv(F.substring(hashed, 1 + 6 * i, 6), 16, 10).cast("bigint") for i in range(LANES)]
    return [F.shiftrightunsigned(hashed, _LANE_BITS * i).bitwiseAND(F.lit(_LANE_MASK)) for i in range(LANES)]


def digest_text(counted: Column, sums: list[Column]) -> Column:
    """Row count and lane sums as one comparable string."""
    return F.md5(F.concat_ws(":", counted.cast("string"), *[s.cast("string") for s in sums]))
