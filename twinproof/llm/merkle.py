"""A Merkle manifest of a dataset: a tree per group of rows, a tree over the groups, and proofs by climbing.

A leaf is the digest of a row. Leaves are numbered in order within their group; every ``FAN`` consecutive nodes become
their digest until one is left, the group's root; the roots of the groups, in order, are the leaves of the top tree.

Numbers come from one sort by range: each task numbers its own rows, and one row per task and group carries the sums on.
Levels are built ``STRIDE`` at a time from runs of ``FAN ** STRIDE`` nodes, and stored as node rows: place, digest,
the digests before and after it in its run, and the place of its parent. A recursive query then climbs from all leaves at once:
each step joins a leaf's present node with its row, appends the siblings, and folds the claimed digest with them. A step reads
no level twice, and its result is a shuffle that the next step reads, so a lost executor repeats a part of it. Near the roots
many leaves stand at one node: that is a skewed key of an equi-join, whose leaf side AQE splits.

Defined cases: NULL values digest as ``-``, so an empty text differs from a missing one; NULL groups are one group, the first; NULL ids
come first; rows equal in id are in order of their digests, and equal rows are leaves of their own with equal digests;
a group of one row has the leaf as its root; an empty table has no leaves and no root; columns that are not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from twinproof.llm.tables import written

FAN, STRIDE = 3, 6
#: The tree over the groups, in the place of a group's number.
TOP = -1


def digest_of(*values: Column) -> Column:
    """SHA-256 of values, each with its length in bytes before it, ``-`` for NULL. Hex."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def placed(rows: DataFrame, group: Sequence[str], order: Sequence[str], purpose: str) -> tuple[DataFrame, DataFrame]:
    """``rows``, written in order with ``_run`` and ``_task``, and per group and task ``(first, before, size)``.

    The place of a row in its group is ``_run - first + before``; ``size`` counts the group.
    """
    keys = [*group, *order]
    in_order = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_run", F.monotonically_increasing_id())
    in_order = written(in_order, purpose).withColumn("_task", F.shiftright("_run", 33))
    runs = in_order.groupBy(*group, "_task").agg(F.min("_run").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(*group)  # one row per task that holds some of the group
    earlier = whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    return in_order, runs.select(*group, "_task", "first", before.alias("before"), F.sum("n").over(whole).alias("size"))


def _same(a: str, b: str, keys: Sequence[str]) -> Column:
    same = F.col(f"{a}._task") == F.col(f"{b}._task")
    for k in keys:
        same = same & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return same


def _at(in_order: DataFrame, runs: DataFrame, group: Sequence[str], *columns: str | Column) -> DataFrame:
    joined = in_order.alias("r").join(runs.alias("t"), _same("r", "t", group))
    return joined.select(*columns, (F.col("r._run") - F.col("t.first") + F.col("t.before")).alias("at"), "t.size")


def _count(level: int) -> str:
    """Nodes of a tree of ``size`` nodes, that many levels up."""
    return f"((size + {FAN**level - 1}L) div {FAN**level}L)"


def _levels(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``h1`` to ``h<STRIDE>``, the digests of the levels above ``h0``."""
    for j in range(STRIDE):
        runs = f"sequence(0, (size(h{j}) - 1) div {FAN})"
        blocks = blocks.withColumn(f"h{j + 1}", F.expr(f"transform({runs}, r -> sha2(array_join(slice(h{j}, r * {FAN} + 1, {FAN}), ''), 256))"))
    return blocks


def _node_rows(j: int, base: int, payload: str = "") -> Column:
    """The node rows of the level ``j`` above the bottom of a block, as an array; none above the root of the tree."""
    at = f"(block * {FAN ** (STRIDE - j)} + i)"
    before = f"unhex(array_join(slice(h{j}, i - i % {FAN} + 1, i % {FAN}), ''))"
    after = f"unhex(array_join(slice(h{j}, i + 2, {FAN - 1} - i % {FAN}), ''))"
    # the root of a group's tree is a leaf of the top tree
    into_top = f"tree <> {TOP} and {_count(j + 1)} = 1"
    parent = f"'p_tree', if({into_top}, {TOP}L, tree), 'p_level', if({into_top}, 0, {base + j + 1}), 'p_at', if({into_top}, tree, {at} div {FAN})"
    row = f"named_struct('level', {base + j}, 'at', {at}, 'hash', unhex(h{j}[i]), 'before', {before}, 'after', {after}, {parent}{payload})"
    return F.expr(f"transform(filter(sequence(0, size(h{j}) - 1), i -> {_count(j)} > 1), i -> {row})")


def _leaf_rows(keep: Sequence[str]) -> Column:
    """The rows of level 0 with what they carry; a leaf alone in its tree is its root and has no siblings there."""
    kept = "".join(f", '{c}', run[i].{c}" for c in keep)
    nothing = "cast(null as binary)"
    alone = f"named_struct('level', 0, 'at', 0L, 'hash', unhex(h0[0]), 'before', {nothing}, 'after', {nothing}, 'p_tree', {TOP}L, 'p_level', 0, 'p_at', tree{kept.replace('[i]', '[0]')})"
    return F.when(F.col("size") == 1, F.array(F.expr(alone))).otherwise(_node_rows(0, 0, kept))


def _grow(leaves: DataFrame, most: int, purpose: str, keep: Sequence[str] = ()) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """Tables of node rows, tables of ``(tree, hash, level)`` of roots, and the lowest blocks, of leaves ``(tree, at, size, hash, keep)``.

    ``most`` is the size of the largest tree. Level 0 is among the node rows if nothing is kept of it.
    """
    nodes, roots, lowest, base, now = [], [], None, 0, leaves
    while True:
        run = F.sort_array(F.collect_list(F.struct("at", "hash", *(keep if base == 0 else ())))).alias("run")  # FAN ** STRIDE at most
        blocks = now.groupBy("tree", "size", F.expr(f"at div {FAN**STRIDE}").alias("block")).agg(run)
        blocks = written(_levels(blocks.withColumn("h0", F.col("run.hash"))), purpose)
        lowest = lowest or blocks
        rows = F.concat(*[_node_rows(j, base) for j in range(1 if base == 0 and keep else 0, STRIDE)])
        nodes.append(blocks.select("tree", F.explode(rows).alias("x")).select("tree", "x.*"))
        tops = [F.when(F.expr(f"{_count(j)} = 1"), F.struct(F.col(f"h{j}")[0].alias("hash"), F.lit(base + j).alias("level"))) for j in range(STRIDE + 1)]
        roots.append(blocks.select("tree", F.coalesce(*tops).alias("x")).where("x is not null").select("tree", "x.*"))
        if most <= FAN**STRIDE:
            return nodes, roots, lowest
        most = -(-most // FAN**STRIDE)
        now = blocks.where(f"{_count(STRIDE)} > 1").select("tree", F.col("block").alias("at"), F.expr(_count(STRIDE)).alias("size"), F.col(f"h{STRIDE}")[0].alias("hash"))
        base += STRIDE


def _all(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


@dataclass(frozen=True)
class Manifest:
    """Tables of a manifest; ``p_tree, p_level, p_at`` are the place of a row's parent, digests of rows are binary.

    ``leaves(tree, at, hash, before, after, p_*, kept columns)``, ``nodes(tree, level, at, hash, before, after, p_*)`` below the
    root, ``trees(group, tree, size, subroot)``.
    """

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    #: Hex digest of the root, None without rows, and its level in the top tree.
    root: str | None
    level: int


def build(rows: DataFrame, group: str, order: str, digest: str, keep: Sequence[str] = ()) -> Manifest:
    """The manifest of ``rows``, whose ``digest`` is a hex digest per row; leaves carry the columns of ``keep``."""
    carried = [f"k_{i}" for i in range(len(keep))]
    slim = rows.select(F.col(group).alias("group"), F.col(order).alias("order"), F.col(digest).alias("hash"), *[F.col(c).alias(k) for c, k in zip(keep, carried)])
    in_order, runs = placed(slim, ["group"], ["order", "hash"], "merkle-leaves")
    by_group, group_runs = placed(runs.groupBy("group").agg(F.first("size").alias("leaves")), [], ["group"], "merkle-groups")
    groups = written(_at(by_group, group_runs, [], "group", "leaves").withColumnRenamed("at", "tree").drop("size"), "merkle-groups")
    most, count = groups.agg(F.coalesce(F.max("leaves"), F.lit(0)), F.count("*")).first()
    # the number of the tree goes to one row per task and group, so that leaves are joined once
    runs = runs.alias("a").join(groups.alias("g"), F.col("a.group").eqNullSafe(F.col("g.group"))).select("a.*", "g.tree")
    leaves = _at(in_order, runs, ["group"], "t.tree", "r.hash", *[f"r.{c}" for c in carried])
    nodes, roots, blocks = _grow(leaves, most, "merkle-blocks", carried)
    bottom = blocks.select("tree", F.explode(_leaf_rows(carried)).alias("x")).select("tree", "x.*").drop("level")
    roots = written(_all(roots), "merkle-roots")
    top = roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(count).cast("long").alias("size"), "hash")
    above, peak, _ = _grow(top, count, "merkle-top")
    root = _all(peak).select("hash", "level").first()
    root, level = root or (None, 0)
    nodes = written(_all([*nodes, *above]), "merkle-nodes")
    trees = groups.join(roots.select("tree", F.col("hash").alias("subroot")), "tree").select(F.col("group").alias(group), "tree", F.col("leaves").alias("size"), "subroot")
    bottom = written(bottom.withColumnsRenamed(dict(zip(carried, keep))), "merkle-leaves")
    return Manifest(bottom, nodes, written(trees, "merkle-trees"), root, level)


@contextmanager
def _unlimited(spark: SparkSession) -> Iterator[None]:
    """Recursive queries may return any number of rows."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


_FOLD = "unhex(sha2(lower(hex(concat({0}.before, {1}, {0}.after))), 256))"

#: One row per leaf and step: the siblings met, and at the last step what the claim folds to.
CLIMB = f"""
WITH RECURSIVE climb(tree, at, step, p_tree, p_level, p_at, folded, beside) AS (
    SELECT tree, at, 0, p_tree, p_level, p_at, if(before IS NULL, claim, {_FOLD.format("l", "claim")}), coalesce(concat(before, after), cast('' AS BINARY))
    FROM {{leaves}} l
    UNION ALL
    SELECT c.tree, c.at, c.step + 1, n.p_tree, n.p_level, n.p_at, {_FOLD.format("n", "c.folded")}, concat(n.before, n.after)
    FROM climb c JOIN {{nodes}} n ON c.p_tree = n.tree AND c.p_level = n.level AND c.p_at = n.at
)
SELECT tree, at, step, if(p_tree = {TOP} AND p_level = {{level}} AND p_at = 0, folded, NULL) AS folded, beside FROM climb"""


def climb(manifest: Manifest, claim: str) -> DataFrame:
    """``(tree, at, folded_root, proof)`` of all leaves: what ``claim``, a column of hex digests, folds to, and the siblings from leaf to root, all hex."""
    spark = manifest.leaves.sparkSession
    leaves = manifest.leaves.withColumn("claim", F.unhex(F.col(claim)))
    with _unlimited(spark):
        steps = spark.sql(CLIMB.replace("{level}", str(manifest.level)), leaves=leaves, nodes=manifest.nodes)
        paths = steps.groupBy("tree", "at").agg(F.max("folded").alias("folded"), F.sort_array(F.collect_list(F.struct("step", "beside"))).alias("path"))
        proof = F.array_join(F.transform("path.beside", lambda x: F.lower(F.hex(x))), "")
        return written(paths.select("tree", "at", F.lower(F.hex("folded")).alias("folded_root"), F.sha2(proof, 256).alias("proof_sha256")), "merkle-proofs")


def report(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), text: str = "text") -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row, half of the rows tampered with before they climb.

    Tampering takes the line feeds out of ``text`` where crc32 of the id is even; a row without an id is left as it is.
    """
    whole = [F.col(c) for c in columns]
    cut = [F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == text else F.col(c) for c in columns]
    tampered = (F.crc32(F.col(doc_id).cast("string").cast("binary")) % 2 == 0) & F.col(text).contains("\n")
    rows = docs.select(
        F.col(source).alias("source"), F.col(doc_id).alias("doc_id"), digest_of(*whole).alias("leaf"), F.when(tampered, digest_of(*cut)).alias("tampered")
    )
    manifest = build(rows, "source", "doc_id", "leaf", ["doc_id", "leaf", "tampered"])
    leaves = manifest.leaves.withColumn("claim", F.coalesce("tampered", "leaf"))
    proofs = climb(replace(manifest, leaves=leaves), "claim")
    joined = leaves.join(proofs, ["tree", "at"]).join(manifest.trees.select("tree", "subroot"), "tree")
    root = F.lit(manifest.root).cast("string").alias("root")
    return joined.select("doc_id", "leaf", "subroot", root, "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(manifest.root)).alias("verified"))
