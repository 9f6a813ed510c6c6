"""Equality by content: table digests, bucket checksums, and the keys that differ."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinproof.functions.rowhash import LANES, digest_text, hash_column, lanes, row_text

_LANE_NAMES = [f"lane{i}" for i in range(LANES)]
MAX_BUCKETS = 1 << 16


def bucket_of(df: DataFrame, keys: list[str], buckets: int) -> Column:
    """Bucket of a row: the key itself modulo ``buckets`` when it is one integer, its hash otherwise. Never NULL: a NULL integer is in bucket 0."""
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.coalesce(F.pmod(F.col(keys[0]).cast("bigint"), F.lit(buckets)).cast("int"), F.lit(0))
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _lane_rows(df: DataFrame, keys: list[str], cols: list[str], buckets: int, portable: bool) -> DataFrame:
    # two projections, so that the hash is computed once per row and not once per lane
    hashed = df.select(bucket_of(df, keys, buckets).alias("bucket"), hash_column(df, cols, portable).alias("h"))
    return hashed.select("bucket", *[c.alias(n) for c, n in zip(lanes(F.col("h"), portable), _LANE_NAMES, strict=True)])


def _bucket_sums(df: DataFrame, keys: list[str], cols: list[str], buckets: int, portable: bool) -> DataFrame:
    return (
        _lane_rows(df, keys, cols, buckets, portable)
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in _LANE_NAMES])
    )


def bucket_checksums(
    df: DataFrame, keys: list[str], cols: list[str], buckets: int = 1024, portable: bool = False
) -> DataFrame:
    """``bucket, n, digest``: one digest per key bucket.

    Sums are combined in every map task, so at most ``buckets`` rows per task are shuffled whatever
    the table holds, and a bucket with a third of all rows costs no more than any other.
    """
    return _bucket_sums(df, keys, cols, buckets, portable).select(
        "bucket", "n", digest_text(F.col("n"), [F.col(c) for c in _LANE_NAMES]).alias("digest")
    )


def content_hash(
    df: DataFrame, keys: list[str], cols: list[str], buckets: int = 64, portable: bool = False
) -> DataFrame:
    """One row ``n, digest`` over every row of the table; a table without rows has a NULL digest.

    Two tables have the same digest when they hold the same rows, as with one hash over the sorted
    table, but no task ever sees more than its own share: bucket sums just add up.
    """
    sums = _bucket_sums(df, keys, cols, buckets, portable)
    total = sums.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in _LANE_NAMES]
    )
    digest = digest_text(F.col("n"), [F.col(c) for c in _LANE_NAMES])
    return total.select("n", F.when(F.col("n") > 0, digest).alias("digest"))


def ordered_hash(df: DataFrame, key: str, text: Column | None = None, cols: list[str] | None = None, chunk: int = 1 << 16) -> DataFrame:
    """One row ``n, digest`` over the rows in the order of an integer key; no rows have a NULL digest.

    A row is the md5 of its text. ``chunk`` neighbouring keys are joined by commas in key order and hashed, then
    ``chunk`` neighbouring chunks, and so on: always as many times as it takes to bring all 64-bit keys to at most
    two groups, whose digests are joined and hashed last. The digest means the same at every size, and what one task joins is at
    most ``chunk`` md5 texts. The key must be unique: a chunk with more rows than keys is refused before
    anything is joined. ``text`` is the row text, by default that of ``cols`` with lengths and NULL marks.
    """
    if not 2 <= chunk <= 1 << 20:
        raise ValueError("a chunk has between 2 and 2^20 keys")
    row = row_text(df, cols or df.columns) if text is None else text
    rows = df.select(F.col(key).cast("bigint").alias("_at"), F.md5(row).alias("_text"))
    sizes = df.groupBy(F.expr(f"floor(CAST(`{key}` AS BIGINT) / {chunk})").alias("_c")).count()
    largest, total = sizes.agg(F.max("count"), F.sum("count")).first()
    if largest is not None and largest > chunk:
        raise ValueError(f"{key} is not unique")

    def joined(level: DataFrame, *by: Column) -> DataFrame:
        return level.groupBy(*by).agg(F.md5(F.expr("listagg(_text, ',') WITHIN GROUP (ORDER BY _at)")).alias("_text"))

    level = rows
    for _ in range(math.ceil(64 / math.log2(chunk))):
        level = joined(level, F.floor(F.col("_at") / chunk).alias("_at"))
    return joined(level).select(F.lit(total or 0).cast("bigint").alias("n"), F.when(F.lit(bool(total)), F.col("_text")).alias("digest"))


def differing_buckets(source: DataFrame, target: DataFrame, keys: list[str], cols: list[str], buckets: int, portable: bool) -> DataFrame:
    """Buckets whose rows are not the same on both sides; never more than ``buckets`` rows."""

    def side(df: DataFrame, sign: int) -> DataFrame:
        rows = _lane_rows(df, keys, cols, buckets, portable)
        return rows.select("bucket", F.lit(sign).alias("n"), *[(F.col(c) * sign).alias(c) for c in _LANE_NAMES])

    # one signed sum instead of two aggregates and a full join
    both = side(source, 1).unionByName(side(target, -1))
    delta = both.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ["n", *_LANE_NAMES]])
    differs = F.col("n") != 0
    for c in _LANE_NAMES:
        differs = differs | (F.col(c) != 0)
    return delta.filter(differs).select("bucket")


def locate_drift(
    source: DataFrame, target: DataFrame, keys: list[str], cols: list[str], buckets: int = 1024, portable: bool = False
) -> DataFrame:
    """``keys, source_rows, target_rows, status`` of every key that is not the same on both sides.

    Status is ``only_source``, ``only_target`` or ``different``. The first pass finds the buckets
    that differ; the second hashes their rows only. Rows of a key are summed before and after the
    shuffle, never paired, so a key that repeats many times stays cheap.
    """
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MAX_BUCKETS}")
    bad = differing_buckets(source, target, keys, cols, buckets, portable)

    def side(df: DataFrame, sign: int) -> DataFrame:
        # `bad` holds at most `buckets` rows, a parameter and not a data size: safe to broadcast
        rows = df.withColumn("_bucket", bucket_of(df, keys, buckets)).join(
            F.broadcast(bad.withColumnRenamed("bucket", "_bucket")), "_bucket", "left_semi"
        )
        hashed = rows.select(*keys, hash_column(df, cols, portable).alias("_h"))
        return hashed.select(
            *keys,
            F.lit(int(sign > 0)).alias("_s"),
            F.lit(int(sign < 0)).alias("_t"),
            *[(c * sign).alias(n) for c, n in zip(lanes(F.col("_h"), portable), _LANE_NAMES, strict=True)],
        )

    both = side(source, 1).unionByName(side(target, -1))
    per_key = both.groupBy(*keys).agg(
        F.sum("_s").alias("source_rows"), F.sum("_t").alias("target_rows"), *[F.sum(c).alias(c) for c in _LANE_NAMES]
    )
    differs = F.col("source_rows") != F.col("target_rows")
    for c in _LANE_NAMES:
        differs = differs | (F.col(c) != 0)
    status = (
        F.when(F.col("target_rows") == 0, "only_source").when(F.col("source_rows") == 0, "only_target").otherwise("different")
    )
    return per_key.filter(differs).select(*keys, "source_rows", "target_rows", status.alias("status"))


def is_converged(source: DataFrame, target: DataFrame, keys: list[str], cols: list[str], portable: bool = False) -> DataFrame:
    """Readiness gate, one row ``source_digest, target_digest, converged``: both digests equal and not empty."""
    left = content_hash(source, keys, cols, portable=portable).select(F.lit("s").alias("side"), "digest")
    right = content_hash(target, keys, cols, portable=portable).select(F.lit("t").alias("side"), "digest")
    both = left.unionByName(right).agg(
        F.max(F.when(F.col("side") == "s", F.col("digest"))).alias("source_digest"),
        F.max(F.when(F.col("side") == "t", F.col("digest"))).alias("target_digest"),
    )
    equal = F.coalesce(F.col("source_digest") == F.col("target_digest"), F.lit(False))
    return both.withColumn("converged", equal)
