"""Log positions: ``H/L`` hex text, unsigned 64-bit numbers, lag between two of them."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LSN_TYPE = "decimal(20,0)"  # an unsigned 64-bit value does not fit BIGINT
LSN_PATTERN = "^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"

_WORD = 1 << 32
_SIGN = 1 << 63


def parse_lsn(text: Column, strict: bool = False) -> Column:
    """``'16/B374D848'`` to its number; malformed text gives NULL, or fails the job when strict."""

    def half(n: int) -> Column:
        return F.conv(F.split_part(text, F.lit("/"), F.lit(n)), 16, 10).cast("decimal(10,0)")

    value = (half(1) * F.lit(_WORD).cast("decimal(10,0)") + half(2)).cast(LSN_TYPE)
    # conv() reads garbage as 0, hence the pattern test in front of it
    bad = F.raise_error(F.concat(F.lit("invalid LSN: "), text)).cast(LSN_TYPE) if strict else F.lit(None).cast(LSN_TYPE)
    return F.when(text.isNull(), F.lit(None).cast(LSN_TYPE)).when(text.rlike(LSN_PATTERN), value).otherwise(bad)


def format_lsn(lsn: Column) -> Column:
    """Number to ``H/L``: upper-case hex without padding."""
    wide = lsn.cast(LSN_TYPE)
    word = F.lit(_WORD).cast("decimal(20,0)")
    low = wide % word
    high = ((wide - low) / word).cast("decimal(10,0)")
    return F.concat(
        F.conv(high.cast("string"), 10, 16),
        F.lit("/"),
        F.conv(low.cast("decimal(10,0)").cast("string"), 10, 16),
    )


def lag_bytes(source: Column, applied: Column) -> Column:
    """How far ``applied`` is behind ``source``; 0 when it is level or ahead."""
    return F.when(source > applied, source - applied).otherwise(F.lit(0))


def sortable_position(lsn: Column, data_type: T.DataType) -> Column:
    """A BIGINT in the same order as ``lsn``.

    Decimals wider than 18 digits compare as objects; shifting by 2^63 keeps the order of every
    unsigned 64-bit value while sorts and comparisons run on primitive longs.
    """
    if isinstance(data_type, T.DecimalType):
        return (lsn - F.lit(Decimal(_SIGN))).cast("bigint")
    return lsn.cast("bigint")


def lsn_literal(lsn: int, data_type: T.DataType) -> Column:
    """A position known on the driver as a literal of the column's own type, so that filters on it are pushed down."""
    return F.lit(Decimal(lsn) if isinstance(data_type, T.DecimalType) else lsn).cast(data_type)


def sortable_literal(lsn: int, data_type: T.DataType) -> int:
    """``sortable_position`` of a number known on the driver."""
    return lsn - _SIGN if isinstance(data_type, T.DecimalType) else lsn


def lsn_of_sortable(position: int, data_type: T.DataType) -> int:
    """The number that ``sortable_literal`` made this position of."""
    return position + _SIGN if isinstance(data_type, T.DecimalType) else position
