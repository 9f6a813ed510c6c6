"""Digests of a table as a tree: kept up to date from changes, and descended to the keys that differ.

Keys are hashed into ``2^bits`` leaves; ``2^fan`` leaves have a node above them, and so on up to one root. A node has the number
and the lane sums of its rows. Sums add up: a node is the sum of its children, the root is the content hash of the table,
and a change adds its new image and takes its old one away, whatever else the table holds.

- ``rows``                     the rows themselves, clustered by leaf, so that few leaves are few row groups
- ``sums/_batch=B/_level=L``   sums by node: batch -1 of the table as it was built, the others of changes

A batch is written in place of itself, so it may come twice. What is compared are nodes whose parents differ, level by level: with k keys
adrift, about k nodes of a level are read and about k leaves are hashed, whatever the size of the table. Beyond ``most``
nodes the tables are compared as a whole instead, which gives the same.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinproof.functions.rowhash import LANES, digest_text, hash_column, lanes
from twinproof.operators.content import locate_drift

_SUMS = ["n", *[f"lane{i}" for i in range(LANES)]]
_SCHEMA = ", ".join(f"{c} bigint" for c in ["parent", "node", *_SUMS, "_batch"]) + ", _level int"
BUILT = -1
#: Values up to which a filter is written as equalities, all of which reach the Parquet scan.
_EQUALITIES = 32


def _among(column: str, values: list[int]) -> Column:
    """``column`` is one of ``values``, in a form that prunes row groups."""
    if len(values) > _EQUALITIES:
        return F.col(column).between(min(values), max(values)) & F.col(column).isin(values)
    tests = [F.col(column) == v for v in values] or [F.lit(False)]
    while len(tests) > 1:  # a balanced tree of ORs
        tests = [reduce(Column.__or__, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]


@dataclass(frozen=True)
class DigestTree:
    """``keys`` say which leaf a row is in, ``cols`` what is compared. Two trees can be compared if all but ``path`` is equal."""

    path: str
    keys: list[str]
    cols: list[str]
    bits: int = 18
    fan: int = 6
    portable: bool = False

    def __post_init__(self) -> None:
        if not 0 < self.bits <= 30 or not 0 < self.fan <= self.bits:
            raise ValueError("a tree has 1 to 30 bits of leaves and no more of them for a level")

    @property
    def top(self) -> int:
        """The level of the root."""
        return -(-self.bits // self.fan)

    def _leaf(self) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*self.keys), 64 - self.bits)

    def _leaf_sums(self, rows: DataFrame, sign: int = 1) -> DataFrame:
        # the hash is computed once per row; sums meet in the map tasks
        hashed = rows.select(self._leaf().alias("leaf"), hash_column(rows, self.cols, self.portable).alias("h"))
        signed = [F.lit(sign).cast("bigint").alias("n"), *[(c * sign).alias(f"lane{i}") for i, c in enumerate(lanes(F.col("h"), self.portable))]]
        return hashed.select("leaf", *signed)

    def _write(self, leaf_rows: DataFrame, batch: int) -> None:
        """All levels of one batch. Leaves are summed first, so the levels above are made of at most ``2^bits`` rows."""
        leaves = leaf_rows.groupBy("leaf").agg(*[F.sum(c).alias(c) for c in _SUMS])
        leaves = leaves.where(reduce(Column.__or__, [F.col(c) != 0 for c in _SUMS]))
        levels = F.explode(F.sequence(F.lit(0), F.lit(self.top))).alias("_level")
        node = F.expr(f"shiftright(leaf, _level * {self.fan})")
        nodes = leaves.select("*", levels).groupBy("_level", node.alias("node")).agg(*[F.sum(c).alias(c) for c in _SUMS])
        placed = nodes.select(F.shiftright("node", self.fan).alias("parent"), "node", *_SUMS, F.lit(batch).cast("bigint").alias("_batch"), "_level")
        # by range, so that children of few nodes are few row groups
        ordered = placed.repartitionByRange("_level", "node").sortWithinPartitions("_level", "node")
        ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch", "_level").parquet(f"{self.path}/sums")

    def build(self, rows: DataFrame, row_group_bytes: int = 16 << 20) -> None:
        """Write ``rows`` clustered by leaf, and the tree over them."""
        spark, salt = rows.sparkSession, F.pmod(F.monotonically_increasing_id(), F.lit(1024))
        clustered = rows.withColumn("_leaf", self._leaf()).withColumn("_salt", salt)
        # a key that very many rows share is spread by the salt
        clustered = clustered.repartitionByRange("_leaf", "_salt").sortWithinPartitions("_leaf").drop("_salt")
        clustered.write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(f"{self.path}/rows")
        spark.createDataFrame([], _SCHEMA).write.mode("overwrite").parquet(f"{self.path}/sums")
        self._write(self._leaf_sums(self.rows(spark)), BUILT)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows as they were built, with ``_leaf``."""
        return spark.read.parquet(f"{self.path}/rows")

    def update(self, batch: int, old: DataFrame, new: DataFrame) -> None:
        """Take the rows ``old`` out of the digests and put ``new`` in; costs the changes, and the table is not read."""
        if batch < 0:
            raise ValueError("batches are numbered from 0")
        self._write(self._leaf_sums(old, -1).unionByName(self._leaf_sums(new)), batch)

    def nodes(self, spark: SparkSession, level: int, parents: list[int] | None = None) -> DataFrame:
        """``node`` and its sums on one level, below the given nodes of the next."""
        read = spark.read.schema(_SCHEMA).parquet(f"{self.path}/sums").where(F.col("_level") == level)
        read = read if parents is None else read.where(_among("parent", parents))
        return read.groupBy("node").agg(*[F.sum(c).alias(c) for c in _SUMS])

    def digest(self, spark: SparkSession) -> DataFrame:
        """One row ``n, digest``, the same as the content hash of the rows; NULL without rows."""
        root = self.nodes(spark, self.top).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SUMS])
        return root.select("n", F.when(F.col("n") > 0, digest_text(F.col("n"), [F.col(c) for c in _SUMS[1:]])).alias("digest"))


def differing_leaves(source: DigestTree, target: DigestTree, spark: SparkSession, most: int = 4096) -> list[int] | None:
    """Leaves that are not the same in both trees, found from the root down; None if a level has more than ``most`` such nodes."""
    shape = lambda t: (t.keys, t.cols, t.bits, t.fan, t.portable)
    if shape(source) != shape(target):
        raise ValueError("trees of different shape cannot be compared")
    found: list[int] | None = None
    for level in range(source.top, -1, -1):
        theirs = target.nodes(spark, level, found).select("node", *[(-F.col(c)).alias(c) for c in _SUMS])
        both = source.nodes(spark, level, found).unionByName(theirs).groupBy("node").agg(*[F.sum(c).alias(c) for c in _SUMS])
        differs = both.where(reduce(Column.__or__, [F.col(c) != 0 for c in _SUMS])).select("node")
        found = [r["node"] for r in differs.limit(most + 1).collect()]  # node numbers, at most that many
        if not found or len(found) > most:
            break
    return found if len(found) <= most else None


def drift_by_tree(source: DigestTree, target: DigestTree, source_rows: DataFrame, target_rows: DataFrame, most: int = 4096) -> DataFrame:
    """``keys, source_rows, target_rows, status`` of every key that differs, as :func:`~twinproof.operators.content.locate_drift` gives it.

    Only rows of leaves that differ are hashed. Rows that come with their ``_leaf``, as a tree keeps them, are not even read otherwise.
    """
    leaves = differing_leaves(source, target, source_rows.sparkSession, most)

    def near(tree: DigestTree, rows: DataFrame) -> DataFrame:
        if leaves is None:
            return rows
        return (rows if "_leaf" in rows.columns else rows.withColumn("_leaf", tree._leaf())).where(_among("_leaf", leaves))

    return locate_drift(near(source, source_rows), near(target, target_rows), source.keys, source.cols, portable=source.portable)
