"""Table archives and loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Codecs a compression spec may name, with their level ranges.
LEVELS = {"none": None, "gzip": range(0, 10), "lz4": range(0, 13), "zstd": range(1, 23)}
_PARQUET = {"none": "uncompressed", "gzip": "gzip", "lz4": "lz4_raw", "zstd": "zstd"}
_LEVEL_OPTION = {"gzip": "zlib.compress.level", "zstd": "parquet.compression.codec.zstd.level"}
# The Hadoop zlib codec names its levels instead of taking the number.
_ZLIB = ["NO_COMPRESSION", "BEST_SPEED", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "BEST_COMPRESSION"]


def parse_compression(spec: str | None) -> tuple[str, int | None] | None:
    """``none``, ``codec``, ``codec:level``, or a bare digit for gzip at that level (0 is none).

    Unset keeps the writer's default.
    """
    if spec is None or not spec.strip():
        return None
    spec = spec.strip().lower()
    if spec.isdigit():
        codec, level = ("gzip", int(spec)) if int(spec) else ("none", None)
    else:
        codec, _, text = spec.partition(":")
        if text and not text.isdigit():
            raise ValueError(f"invalid compression level in {spec!r}")
        level = int(text) if text else None
    if codec not in LEVELS:
        raise ValueError(f"unknown compression {codec!r}")
    allowed = LEVELS[codec]
    if level is not None and (allowed is None or level not in allowed):
        raise ValueError(f"invalid compression level in {spec!r}")
    return codec, level


def write_archive(df: DataFrame, path: str, compress: str | None = None, mode: str = "errorifexists", rows_per_file: int = 0) -> None:
    """Write one table as Parquet. Every task writes its own files: no shuffle, no order.

    The Parquet writer has one lz4 level; a level given for it is checked and has no effect.
    """
    writer = df.write.mode(mode)
    parsed = parse_compression(compress)
    if parsed:
        codec, level = parsed
        writer = writer.option("compression", _PARQUET[codec])
        if level is not None and codec in _LEVEL_OPTION:
            writer = writer.option(_LEVEL_OPTION[codec], _ZLIB[level] if codec == "gzip" else str(level))
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", str(rows_per_file))
    writer.parquet(path)


def load_table(df: DataFrame, path: str, replace: bool = False, compress: str | None = None) -> None:
    """Add the rows to a table, or put them in place of what is there."""
    write_archive(df, path, compress, mode="overwrite" if replace else "append")


def write_split(tagged: DataFrame, path: str) -> None:
    """Write rows tagged with ``violations`` in one pass: ``quarantined=false`` and ``quarantined=true``."""
    tagged.withColumn("quarantined", F.size("violations") > 0).write.mode("overwrite").partitionBy("quarantined").parquet(path)
