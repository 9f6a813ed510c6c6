"""Expressions over log lines and progress messages."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Message fragments per error category. The first category with a match wins.
CATEGORY_FRAGMENTS = {
    "data-loss": [
        "error:  copy ",
        "error: copy ",
        "invalid input syntax",
        "violates not-null",
        "violates check constraint",
        "violates foreign key",
        "violates unique constraint",
        "value too long for type",
        "out of range",
    ],
    "duplicate": ["already exists", "duplicate key value"],
    "privilege": ["permission denied", "must be owner", "must be superuser", 'role "', "user mapping"],
    "extension": ["extension ", "pg_extension", "for extension"],
}
OTHER = "other"
CATEGORIES = [*CATEGORY_FRAGMENTS, OTHER]  # most to least severe

# Line formats.
ERROR_PREFIX = "pg_restore: error: "
IGNORED_PREFIX = "pg_restore: warning: errors ignored on restore: "
STAGES = [
    "Validate",
    "PrepareSnapshot",
    "SourceVacuum",
    "Dump",
    "Restore",
    "Analyze",
    "StreamApply",
    "Lag",
    "CaughtUp",
    "Cutover",
    "SourceCleanup",
    "Verify",
    "Complete",
]

_BLANKS = " \t\r\n"


def _trim_end(text: Column) -> Column:
    return F.rtrim(text, F.lit(_BLANKS))


def strip_error_prefix(line: Column) -> Column:
    """The message of an error line; NULL for any other line."""
    line = _trim_end(line)
    message = F.ltrim(F.substring(line, len(ERROR_PREFIX) + 1, 2**31 - 1), F.lit(_BLANKS))
    return F.when(line.startswith(ERROR_PREFIX), message)


def classify_error(message: Column) -> Column:
    """Category of a message whose prefix is already gone."""
    return classify_lowered(F.lower(message))


def classify_lowered(lowered: Column) -> Column:
    """``classify_error`` of a column that is lower case already, so that many tests share one conversion."""
    category = F.when(lowered.isNull(), F.lit(None).cast("string"))
    for name, fragments in CATEGORY_FRAGMENTS.items():
        category = category.when(reduce(or_, [lowered.contains(f) for f in fragments]), F.lit(name))
    return category.otherwise(F.lit(OTHER))


def severity_rank(category: Column) -> Column:
    """0 for the most severe category, rising in the order of ``CATEGORIES``."""
    return F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), category) - 1


def reported_ignored(line: Column) -> Column:
    """N of the closing "errors ignored" warning, NULL elsewhere or when N is no unsigned 32-bit number."""
    line = _trim_end(line)
    digits = F.regexp_extract(line, r"^" + IGNORED_PREFIX + r"\s*\+?(\d+)$", 1)
    # at most 18 digits, so the cast cannot fail; a plain prefix test spares all other lines the pattern
    number = F.when(F.length(digits).between(1, 18), digits).cast("bigint")
    return F.when(line.startswith(IGNORED_PREFIX) & (number < (1 << 32)), number)


def split_qualified(name: Column) -> Column:
    """``schema.table`` cut at the last dot, as a struct; NULL when there is no dot."""
    pattern = r"(?s)^(.*)\.([^.]*)$"
    return F.when(
        name.contains("."),
        F.struct(
            F.regexp_extract(name, pattern, 1).alias("schema_name"),
            F.regexp_extract(name, pattern, 2).alias("table_name"),
        ),
    )


def redact_uri(text: Column) -> Column:
    """Mask the password of every ``user:password@host`` URI in the text: all up to the last ``@`` before white space."""
    return F.regexp_replace(text, r"(://[^:/@\s]*):\S+@", "$1:****@")


def heartbeat_fields(line: Column) -> Column:
    """``struct(source_lsn, applied_lsn)`` of a replication-lag line; NULL for any other line."""

    def number_after(label: str) -> Column:
        return F.nullif(F.regexp_extract(line, label + r" LSN ([0-9]+)", 1), F.lit("")).cast("decimal(20,0)")

    source, applied = number_after("source"), number_after("applied")
    return F.when(
        line.contains("replication lag") & source.isNotNull() & applied.isNotNull(),
        F.struct(source.alias("source_lsn"), applied.alias("applied_lsn")),
    )


def heartbeat_stage(lag: Column) -> Column:
    """Stage a heartbeat reports: every beat without lag says CaughtUp."""
    return F.when(lag == 0, F.lit("CaughtUp")).otherwise(F.lit("Lag"))
