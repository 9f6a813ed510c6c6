"""The registered queries. ``QUERIES[name]`` is the Spark job, ``ORACLE[name]`` the same in DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinproof.functions import logtext
from twinproof.functions.lsn import format_lsn, parse_lsn
from twinproof.operators import catalog, changes, content, counts, lag, logs, maintain, marks, quality, scope, sketches, stats
from twinproof.plans import copy as copying
from twinproof.plans import digest_tree
from twinproof.plans.offline import Checks, digests, run_offline
from twinproof.plans.online import copy_online, copy_online_tables
from twinproof.session import work_dir
from twinproof.sinks.archive import load_table, write_archive, write_split
from twinproof.sources import generate
from twinproof.sources.changes import read_changes
from twinproof.sources.logs import read_lag_samples, read_progress, read_restore_log
from twinproof.sources.snapshot import read_snapshot
from twinproof.streaming import lag_monitor as monitor
from twinproof.streaming.apply import apply_stream
from twinproof.streaming.apply_tables import RECORD, Reports, apply_tables
from twinproof.streaming.target import KeyedTable
from twinproof.workload import derived as d

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql:
            ORACLE[key] = sql
        return fn

    return register


# === scope ======================================================================================

_SCOPE = scope.Scope(
    schemas=["view", "pg_catalog"],
    tables=[("click", "user_3"), ("click", "user_4"), ("signup", "user_9")],
    exclude_schemas=["pg_catalog"],
    exclude_tables=[("view", "user_2"), ("click", "user_4")],
)
_IN_SCOPE = """(schema_name IN ('view', 'pg_catalog') OR (schema_name = 'click' AND table_name IN ('user_3', 'user_4'))
    OR (schema_name = 'signup' AND table_name = 'user_9'))
    AND NOT (schema_name = 'pg_catalog' OR (schema_name = 'view' AND table_name = 'user_2')
    OR (schema_name = 'click' AND table_name = 'user_4'))"""


@query(f"SELECT schema_name, table_name FROM ({d.LISTING}) WHERE {_IN_SCOPE}")
def select_tables(spark, sf):
    return scope.select_tables(d.listing(spark, sf), _SCOPE).select("schema_name", "table_name")


@query(
    f"""SELECT schema_name, table_name FROM ({d.LISTING}) WHERE NOT (schema_name = 'pg_catalog'
    OR (schema_name = 'view' AND table_name = 'user_2') OR (schema_name = 'click' AND table_name = 'user_4'))"""
)
def exclude_tables(spark, sf):
    return scope.exclude(d.listing(spark, sf), _SCOPE).select("schema_name", "table_name")


@query(
    f"""SELECT schema_name, table_name FROM ({d.LISTING}) WHERE schema_name NOT IN
    ('pg_catalog', 'information_schema', 'pg_toast') AND NOT starts_with(schema_name, 'pg_temp_')
    AND NOT starts_with(schema_name, 'pg_toast_temp_') AND NOT is_partition"""
)
def user_tables(spark, sf):
    return scope.user_tables(d.listing(spark, sf)).select("schema_name", "table_name")


@query(f"SELECT schema_name, table_name, count(*) AS changes, max(lsn) AS last_lsn FROM ({d.CHANGES}) WHERE {_IN_SCOPE} GROUP BY 1, 2")
def filter_changes(spark, sf):
    kept = scope.filter_changes(d.changes(spark, sf), _SCOPE)
    return kept.groupBy("schema_name", "table_name").agg(F.count(F.lit(1)).alias("changes"), F.max("lsn").alias("last_lsn"))


@query(f"SELECT op, count(*) AS changes, min(lsn) AS first_lsn FROM ({d.CHANGES}) WHERE lsn > {d.CUT} OR (lsn = {d.CUT} AND seq > 1) GROUP BY op")
def changes_after_position(spark, sf):
    later = changes.after(d.changes(spark, sf), d.cut_lsn(spark, sf), 1)
    return later.groupBy("op").agg(F.count(F.lit(1)).alias("changes"), F.min("lsn").alias("first_lsn"))


@query(
    f"SELECT schema_name, count(*) AS n, count(DISTINCT user_id) AS users FROM ({d.CHANGES}) WHERE lsn <= {d.CUT} GROUP BY 1"
)
def snapshot_at_cut(spark, sf):
    log = {("app", "change_log"): d.changes(spark, sf)}
    kept = read_snapshot(log, cut_lsn=d.cut_lsn(spark, sf))["app", "change_log"]
    return kept.groupBy("schema_name").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("key.user_id").alias("users"))


# === counts and verification ====================================================================


def _counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT 'public' AS schema_name, '{name}' AS table_name, count(*) AS n FROM {text} AS t" for name, text in tables.items()
    )


_SOURCE = {t: t for t in d.TABLES}
_TARGET = {t: t for t in d.TABLES if t != "part"} | {"orders": d.TARGET_ORDERS, "customer": d.TARGET_CUSTOMER}
_REPORT = f"""SELECT s.schema_name, s.table_name, s.n AS source, coalesce(t.n, -1) AS target
    FROM ({_counts(_SOURCE)}) s LEFT JOIN ({_counts(_TARGET)}) t USING (schema_name, table_name)"""


@query(_counts(_SOURCE))
def table_counts(spark, sf):
    return counts.table_counts(d.source_tables(spark, sf))


@query(_REPORT)
def verify_row_counts(spark, sf):
    source = d.source_tables(spark, sf)
    return counts.verify_row_counts(source, d.target_of(source))


@query(f"SELECT * FROM ({_REPORT}) WHERE source <> target")
def count_mismatches(spark, sf):
    return counts.mismatches(verify_row_counts(spark, sf))


@query(
    f"""SELECT count(*) AS total, count(*) FILTER (source <> target) AS bad,
    CASE WHEN bad = 0 THEN 'verify: ' || total || ' table(s) matched'
         ELSE 'verify: ' || bad || '/' || total || ' table(s) MISMATCHED' END AS message,
    CASE WHEN bad = 0 THEN 'ok' ELSE 'failed' END AS outcome FROM ({_REPORT})"""
)
def verify_summary(spark, sf):
    return counts.verify_summary(verify_row_counts(spark, sf), "strict")


# === content ====================================================================================

# column -> SQL text of its value in the row text
_TEXT = "length({0}) || ':' || {0}"
_ORDERS = {
    "o_orderkey": "{0}", "o_custkey": "{0}", "o_orderstatus": _TEXT, "o_totalprice": "CAST({0} AS DECIMAL(18,2))",
    "o_orderdate": "epoch_us({0})", "o_orderpriority": _TEXT,
}
_CUSTOMER = {
    "c_custkey": "{0}", "c_name": _TEXT, "c_nationkey": "{0}", "c_acctbal": "CAST({0} AS DECIMAL(18,2))", "c_mktsegment": _TEXT,
}
_DOCUMENTS = {"doc_id": "{0}", "text": _TEXT, "lang": _TEXT, "source": _TEXT, "n_chars": "{0}"}


def _row_text(cols: dict[str, str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({t.format(c)} AS VARCHAR), '~')" for c, t in cols.items()) + ")"


def _lane_sums(table: str, cols: dict[str, str], group: str) -> str:
    lanes = ", ".join(f"sum(CAST('0x' || substr(h, {1 + 6 * i}, 6) AS BIGINT)) AS lane{i}" for i in range(3))
    return f"SELECT {group} AS g, count(*) AS n, {lanes} FROM (SELECT *, md5({_row_text(cols)}) AS h FROM {table}) GROUP BY 1"


_DIGEST = "md5(concat_ws(':', CAST(n AS VARCHAR), CAST(lane0 AS VARCHAR), CAST(lane1 AS VARCHAR), CAST(lane2 AS VARCHAR)))"


def _money(df: DataFrame, *cols: str) -> DataFrame:
    """Doubles as decimals: their text is the same in every engine."""
    return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in cols})


def _pairs(spark: SparkSession, sf: str):
    source = d.source_tables(spark, sf, ["orders", "customer", "documents"])
    target = d.target_of(source)
    for name, key, cols, money in (
        ("orders", "o_orderkey", _ORDERS, ["o_totalprice"]),
        ("customer", "c_custkey", _CUSTOMER, ["c_acctbal"]),
        ("documents", "doc_id", _DOCUMENTS, []),
    ):
        yield name, key, list(cols), _money(source["public", name], *money), _money(target["public", name], *money)


_SIDES = [
    ("orders", "source", "orders", _ORDERS),
    ("orders", "target", d.TARGET_ORDERS, _ORDERS),
    ("customer", "source", "customer", _CUSTOMER),
    ("customer", "target", d.TARGET_CUSTOMER, _CUSTOMER),
    ("documents", "source", "documents", _DOCUMENTS),
    ("documents", "target", "documents", _DOCUMENTS),
]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{side}' AS side, n, {_DIGEST} AS digest FROM ({_lane_sums(text, cols, '1')})"
        for name, side, text, cols in _SIDES
    )
)
def content_hash(spark, sf):
    parts = []
    for name, key, cols, source, target in _pairs(spark, sf):
        for side, df in (("source", source), ("target", target)):
            digest = content.content_hash(df, [key], cols, portable=True)
            parts.append(digest.select(F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n", "digest"))
    return _union(parts)


def _folded(sql: str, levels: int) -> str:
    for _ in range(levels):
        sql = f"SELECT c // 4096 AS c, md5(string_agg(h, ',' ORDER BY c)) AS h FROM ({sql}) GROUP BY 1"
    return sql


@query(
    f"""SELECT (SELECT count(*) FROM orders) AS n, md5(string_agg(h, ',' ORDER BY c)) AS digest
    FROM ({_folded(f"SELECT o_orderkey AS c, md5({_row_text(_ORDERS)}) AS h FROM orders", 6)})"""
)
def ordered_hash(spark, sf):
    """The hash of the sorted table, in chunks of 4096 keys."""
    orders = _money(d.load(spark, sf, "orders"), "o_totalprice")
    return content.ordered_hash(orders, "o_orderkey", cols=list(_ORDERS), chunk=4096)


@query(f"SELECT CAST(g AS INTEGER) AS bucket, n, {_DIGEST} AS digest FROM ({_lane_sums('orders', _ORDERS, 'o_orderkey % 64')})")
def bucket_checksums(spark, sf):
    orders = _money(d.load(spark, sf, "orders"), "o_totalprice")
    return content.bucket_checksums(orders, ["o_orderkey"], list(_ORDERS), 64, portable=True)


@query("SELECT count(*) AS n, 'equal' AS reordered, 'different' AS changed FROM lineitem")
def content_hash_fast(spark, sf):
    """The Spark-to-Spark hash over all columns: equal for the same rows in another order, different once one value differs."""
    lineitem = d.load(spark, sf, "lineitem")
    cols = lineitem.columns
    first = lineitem.agg(F.min(F.struct("l_orderkey", "l_linenumber")).alias("k")).select("k.*").first()
    one = (F.col("l_orderkey") == first[0]) & (F.col("l_linenumber") == first[1])
    changed = lineitem.withColumn("l_tax", F.when(one, F.col("l_tax") + 1).otherwise(F.col("l_tax")))
    sides = {"here": lineitem, "moved": lineitem.repartition("l_partkey"), "off": changed}
    digests = _union([content.content_hash(df, ["l_orderkey"], cols).withColumn("side", F.lit(k)) for k, df in sides.items()])
    row = digests.agg(F.max("n").alias("n"), *[F.max(F.when(F.col("side") == k, F.col("digest"))).alias(k) for k in sides])
    outcome = lambda c: F.when(F.col("here") == F.col(c), "equal").otherwise("different")
    return row.select("n", outcome("moved").alias("reordered"), outcome("off").alias("changed"))


def _drift_sql(name: str, source: str, target: str, key: str, cols: dict[str, str]) -> str:
    return f"""SELECT '{name}' AS table_name, coalesce(s.{key}, t.{key}) AS key_value,
        CAST(s.{key} IS NOT NULL AS BIGINT) AS source_rows, CAST(t.{key} IS NOT NULL AS BIGINT) AS target_rows,
        CASE WHEN t.{key} IS NULL THEN 'only_source' WHEN s.{key} IS NULL THEN 'only_target' ELSE 'different' END AS status
        FROM (SELECT {key}, {_row_text(cols)} AS r FROM {source}) s
        FULL JOIN (SELECT {key}, {_row_text(cols)} AS r FROM {target}) t ON s.{key} = t.{key}
        WHERE s.r IS DISTINCT FROM t.r"""


@query(
    " UNION ALL ".join(
        [
            _drift_sql("orders", "orders", d.TARGET_ORDERS, "o_orderkey", _ORDERS),
            _drift_sql("customer", "customer", d.TARGET_CUSTOMER, "c_custkey", _CUSTOMER),
            _drift_sql("documents", "documents", "documents", "doc_id", _DOCUMENTS),
        ]
    )
)
def locate_drift(spark, sf):
    parts = []
    for name, key, cols, source, target in _pairs(spark, sf):
        drift = content.locate_drift(source, target, [key], cols)
        parts.append(
            drift.select(F.lit(name).alias("table_name"), F.col(key).alias("key_value"), "source_rows", "target_rows", "status")
        )
    return _union(parts)


@query(
    " UNION ALL ".join(
        [
            _drift_sql("orders", "orders", d.TARGET_ORDERS, "o_orderkey", _ORDERS),
            _drift_sql("customer", "customer", d.TARGET_CUSTOMER, "c_custkey", _CUSTOMER),
            _drift_sql("documents", "documents", "documents", "doc_id", _DOCUMENTS),
        ]
    )
)
def drift_by_tree(spark, sf):
    """The keys that differ, found by descending the digest trees of both sides."""
    parts = []
    for name, key, cols, source, target in _pairs(spark, sf):
        root = work_dir(spark, "digest-tree")
        here, there = (digest_tree.DigestTree(f"{root}/{side}", [key], cols) for side in ("source", "target"))
        here.build(source)
        there.build(target)
        drift = digest_tree.drift_by_tree(here, there, here.rows(spark), there.rows(spark))
        parts.append(drift.select(F.lit(name).alias("table_name"), F.col(key).alias("key_value"), "source_rows", "target_rows", "status"))
    return _union(parts)


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, n, {_DIGEST} AS digest FROM ({_lane_sums(target, cols, "1")})"""
        for name, target, cols in (("orders", d.TARGET_ORDERS, _ORDERS), ("customer", d.TARGET_CUSTOMER, _CUSTOMER))
    )
)
def incremental_digest(spark, sf):
    """Digests of the sources, brought to those of the targets by the rows that changed alone."""
    parts = []
    for name, key, cols, source, target in _pairs(spark, sf):
        if name == "documents":  # no row of it changes
            continue
        tree = digest_tree.DigestTree(work_dir(spark, "digest-tree"), [key], cols, portable=True)
        tree.build(source)
        tree.update(0, source.select(*cols).exceptAll(target.select(*cols)), target.select(*cols).exceptAll(source.select(*cols)))
        parts.append(tree.digest(spark).select(F.lit(name).alias("table_name"), "n", "digest"))
    return _union(parts)


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, s.d AS source_digest, t.d AS target_digest, coalesce(s.d = t.d, false) AS converged
        FROM (SELECT {_DIGEST} AS d FROM ({_lane_sums(source, cols, "1")})) s,
             (SELECT {_DIGEST} AS d FROM ({_lane_sums(target, cols, "1")})) t"""
        for name, source, target, cols in (
            ("orders", "orders", d.TARGET_ORDERS, _ORDERS),
            ("customer", "customer", d.TARGET_CUSTOMER, _CUSTOMER),
            ("documents", "documents", "documents", _DOCUMENTS),
        )
    )
)
def convergence_gate(spark, sf):
    return _union(
        [
            content.is_converged(source, target, [key], cols, portable=True).select(F.lit(name).alias("table_name"), "*")
            for name, key, cols, source, target in _pairs(spark, sf)
        ]
    )


# === changes ====================================================================================

_SNAPSHOT = f"""SELECT user_id, value, props, op FROM ({d.CHANGES}) WHERE lsn <= {d.CUT}
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC, seq DESC) = 1"""
_LATEST = f"""SELECT user_id, value, props, op FROM ({d.CHANGES}) WHERE lsn > {d.CUT}
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC, seq DESC) = 1"""
_APPLIED = f"""
    SELECT user_id, value, props FROM ({_SNAPSHOT}) WHERE op <> 'D' AND user_id NOT IN (SELECT user_id FROM ({_LATEST}))
    UNION ALL SELECT user_id, value, props FROM ({_LATEST}) WHERE op <> 'D'"""


def _snapshot(log: DataFrame, cut: int) -> DataFrame:
    """State at the cut, itself the result of applying the log so far to nothing."""
    before = log.filter(F.col("lsn") <= cut)
    empty = log.sparkSession.createDataFrame([], changes.flatten(before).select(*d.ROW_COLUMNS).schema)
    return changes.apply_changes(empty, before, ["user_id"])


@query(
    f"""SELECT schema_name, table_name, user_id, lsn, seq, op FROM ({d.CHANGES})
    QUALIFY row_number() OVER (PARTITION BY schema_name, table_name, user_id ORDER BY lsn DESC, seq DESC) = 1"""
)
def latest_per_key(spark, sf):
    latest = changes.latest_per_key(d.changes(spark, sf))
    return latest.select("schema_name", "table_name", "key.user_id", "lsn", "seq", "op")


@query(_APPLIED)
def apply_changes(spark, sf):
    log, cut = d.changes(spark, sf), d.cut_lsn(spark, sf)
    return changes.apply_changes(_snapshot(log, cut), changes.after(log, cut), ["user_id"])


@query(
    f"""SELECT lsn, seq, schema_name, table_name, user_id FROM ({d.CHANGES}) WHERE op = 'I' AND lsn > {d.CUT}
    AND user_id IN (SELECT user_id FROM ({_SNAPSHOT}) WHERE op <> 'D')"""
)
def apply_conflicts(spark, sf):
    log, cut = d.changes(spark, sf), d.cut_lsn(spark, sf)
    return changes.find_apply_conflicts(_snapshot(log, cut), changes.after(log, cut), ["user_id"])


@query(
    f"""SELECT schema_name, table_name, count(*) AS changes, min(lsn) AS first_lsn FROM ({d.CHANGES}) c
    WHERE NOT EXISTS (SELECT 1 FROM ({d.LISTING}) l WHERE NOT l.is_partition AND l.schema_name = c.schema_name AND l.table_name = c.table_name)
    GROUP BY 1, 2"""
)
def unknown_tables(spark, sf):
    return changes.unknown_tables(d.changes(spark, sf), d.listing(spark, sf).filter("NOT is_partition"))


def _streamed(spark: SparkSession, sf: str) -> KeyedTable:
    """Change apply in two runs from one checkpoint.

    Positions are dealt out over the runs, so the second one also brings changes older than those applied.
    """
    log, cut, root = d.changes(spark, sf), d.cut_lsn(spark, sf), work_dir(spark, "apply")
    snapshot = _snapshot(log, cut)
    table = KeyedTable(f"{root}/target", ["user_id"], snapshot.schema, buckets=8)
    table.create(snapshot, changes.cut_position(log, cut))
    for i in (1, 0):
        log.filter(F.col("lsn") % 2 == i).write.mode("append").parquet(f"{root}/changes")
        stream = read_changes(spark, f"{root}/changes", log.schema)
        apply_stream(stream, table, f"{root}/checkpoint", cut_lsn=cut).awaitTermination()
    return table


@query(_APPLIED, name="apply_stream")
def applied_stream(spark, sf):
    return _streamed(spark, sf).read(spark)


@query(_APPLIED)
def compact_target(spark, sf):
    table = _streamed(spark, sf)
    table.compact(spark, safe_position=2**62)
    table.drop_superseded(spark)
    return table.read(spark)


@query(f"SELECT count(*) AS n, true AS converged FROM ({_APPLIED})")
def online_copy(spark, sf):
    log, cut, root = d.changes(spark, sf), d.cut_lsn(spark, sf), work_dir(spark, "online")
    log.write.parquet(f"{root}/changes")
    snapshot = _snapshot(log, cut)
    table = KeyedTable(f"{root}/target", ["user_id"], snapshot.schema, buckets=8)
    result = copy_online(
        snapshot,
        read_changes(spark, f"{root}/changes", log.schema),
        table,
        f"{root}/checkpoint",
        cut_lsn=cut,
        source_now=lambda: changes.apply_changes(snapshot, changes.after(log, cut), ["user_id"]),
        cols=d.ROW_COLUMNS,
    )
    return table.read(spark).agg(F.count(F.lit(1)).alias("n")).withColumn("converged", F.lit(result.converged))


class _Killed(RuntimeError):
    pass


class _DiesOnce(KeyedTable):
    """Ends the first run right after a batch was written, before the stream notes it."""

    def put_batch(self, delta, batch_id, run=""):
        super().put_batch(delta, batch_id, run)
        raise _Killed("lost after the write")


@query(_APPLIED)
def online_resume(spark, sf):
    """An online copy that is killed, compacted, and run again when the rest of the changes has come."""
    log, cut, root = d.changes(spark, sf), d.cut_lsn(spark, sf), work_dir(spark, "resume")
    snapshot = _snapshot(log, cut)

    def run(table: KeyedTable, parts: list[int]) -> None:
        sent = log.filter((F.col("lsn") % 2).isin(parts))
        copy_online(
            snapshot, read_changes(spark, f"{root}/changes", log.schema), table, f"{root}/checkpoint", cut_lsn=cut, cols=d.ROW_COLUMNS,
            source_now=lambda: changes.apply_changes(snapshot, changes.after(sent, cut), ["user_id"]), fold_every=2,
        )

    log.filter("lsn % 2 = 1").write.mode("append").parquet(f"{root}/changes")
    try:
        run(_DiesOnce(f"{root}/target", ["user_id"], snapshot.schema, buckets=8), [1])
    except StreamingQueryException as killed:
        if "lost after the write" not in str(killed):
            raise
    table = KeyedTable(f"{root}/target", ["user_id"], snapshot.schema, buckets=8)
    table.compact(spark)
    run(table, [1])
    log.filter("lsn % 2 = 0").write.mode("append").parquet(f"{root}/changes")
    run(table, [0, 1])
    return table.read(spark)


_ONLINE = {"customer": ("c_custkey", "c_acctbal"), "orders": ("o_orderkey", "o_totalprice"), "supplier": ("s_suppkey", "s_nationkey")}


def _record(rows: DataFrame, name: str, op: str, lsn) -> DataFrame:
    place = [lsn.cast("decimal(20,0)").alias("lsn"), F.lit(0).alias("seq"), F.lit("public").alias("schema_name"), F.lit(name).alias("table_name")]
    return rows.select(*place, F.lit(op).alias("op"), F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("image"))


def _final_sql(name: str) -> str:
    key, value = _ONLINE[name]
    return f"SELECT * REPLACE (CASE WHEN {key} % 4 = 1 THEN {value} + 1 ELSE {value} END AS {value}) FROM {name} WHERE {key} % 8 <> 2"


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n, true AS equal, count(*) FILTER ({k} % 8 = 0)::BIGINT AS conflicts, (SELECT count(*) FROM part) AS unknown FROM ({_final_sql(t)})"
    for t, (k, _) in _ONLINE.items()))
def online_copy_tables(spark, sf):
    """One change stream into three tables: inserts, updates, deletes, inserts that are there already, and a table without a target."""
    root, names = work_dir(spark, "online-tables"), list(_ONLINE)
    tables, wanted, targets, sent = d.source_tables(spark, sf, [*names, "part"]), {}, {}, []

    for name, (key, value) in _ONLINE.items():
        rows, k = tables["public", name], F.col(key)
        changed = rows.withColumn(value, F.when(k % 4 == 1, F.col(value) + 1).otherwise(F.col(value)))
        wanted["public", name] = changed.filter(k % 8 != 2)
        targets["public", name] = KeyedTable(f"{root}/{name}", _ROW_KEYS[name], rows.schema, buckets=4)
        targets["public", name].create(rows.filter(k % 4 != 3), 100 - (1 << 63))  # as _pos of these changes
        sent += [_record(rows.filter(k % 4 == 3), name, "I", k + 101), _record(changed.filter(k % 4 == 1), name, "U", k + 101)]
        sent += [_record(rows.filter(k % 8 == 2), name, "D", k + 101), _record(rows.filter(k % 8 == 0), name, "I", k + 101)]
    sent.append(_record(tables["public", "part"], "part", "I", F.col("p_partkey") + 101))
    _union(sent).write.parquet(f"{root}/changes")
    stream = spark.readStream.schema(RECORD).parquet(f"{root}/changes")
    apply_tables(stream, targets, f"{root}/checkpoint", f"{root}/work", cut_lsn=100).awaitTermination()
    copied = {n: t.read(spark) for n, t in targets.items()}
    keys = {n: _ROW_KEYS[n[1]] for n in wanted}
    same = digests(copied, keys).join(digests(wanted, keys).select("table_name", F.col("digest").alias("want")), "table_name")
    conflicts = Reports(f"{root}/work").conflicts(spark).groupBy("table_name").agg(F.sum("inserts").alias("conflicts"))
    unknown = Reports(f"{root}/work").unknown(spark).agg(F.sum("changes")).first()[0]
    out = same.join(conflicts, "table_name", "left")
    return out.select("table_name", "n", F.col("digest").eqNullSafe(F.col("want")).alias("equal"), F.coalesce("conflicts", F.lit(0)).alias("conflicts"), F.lit(unknown).cast("bigint").alias("unknown"))


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n, true AS equal, count(*) FILTER ({k} % 8 = 0)::BIGINT AS conflicts, (SELECT max({k}) FROM {t})::BIGINT AS mark FROM ({_final_sql(t)})"
    for t, (k, _) in _ONLINE.items()))
def online_tables_resume(spark, sf):
    """Three tables copied online over one stream: killed after a write, compacted, gated halfway, and run to the end.

    A row's change stands at its key plus 101, so the source as of any position can be told from the tables.
    """
    root, tables = work_dir(spark, "tables-resume"), d.source_tables(spark, sf, list(_ONLINE))

    def source_at(position: int) -> dict:
        found = {}
        for name, (key, value) in _ONLINE.items():
            k, rows = F.col(key), tables["public", name]
            due = k + 101 <= F.lit(position)
            rows = rows.filter(F.when(due, k % 8 != 2).otherwise(k % 4 != 3))
            found["public", name] = rows.withColumn(value, F.when(due & (k % 4 == 1), F.col(value) + 1).otherwise(F.col(value)))
        return found

    sent, after = [], source_at(2**62)
    for name, (key, _) in _ONLINE.items():
        rows, k = tables["public", name], F.col(key)
        for op, picked in [("I", rows.filter(k % 4 == 3)), ("U", after["public", name].filter(k % 4 == 1)), ("D", rows.filter(k % 8 == 2)), ("I", rows.filter(k % 8 == 0))]:
            sent.append(_record(picked, name, op, k + 101))
    log, half = _union(sent), tables["public", "orders"].agg(F.max("o_orderkey")).first()[0] // 2 + 101
    source_marks = marks.max_key(tables, {n: _ONLINE[n[1]][0] for n in tables})
    arguments = {"source_marks": source_marks, "target_marks": source_marks.withColumn("last_value", F.lit(1).cast("bigint"))}

    def run(kind=KeyedTable):
        targets = {n: (kind if n[1] == "orders" else KeyedTable)(f"{root}/{n[1]}", _ROW_KEYS[n[1]], t.schema, buckets=4) for n, t in tables.items()}
        stream = spark.readStream.schema(RECORD).parquet(f"{root}/changes")
        return targets, copy_online_tables(
            source_at(100), stream, targets, f"{root}/checkpoint", f"{root}/work", cut_lsn=100, source_at=source_at, fold_every=2, **arguments
        )

    log.filter(F.col("lsn") <= half).write.mode("append").parquet(f"{root}/changes")
    try:
        run(_DiesOnce)
    except StreamingQueryException as killed:
        if "lost after the write" not in str(killed):
            raise
    KeyedTable(f"{root}/orders", ["o_orderkey"], tables["public", "orders"].schema, buckets=4).compact(spark)
    run()
    log.filter(F.col("lsn") > half).write.mode("append").parquet(f"{root}/changes")
    targets, result = run()
    copied, keys = {n: t.read(spark) for n, t in targets.items()}, {n: _ROW_KEYS[n[1]] for n in targets}
    same = digests(copied, keys).join(digests(after, keys).select("table_name", F.col("digest").alias("want")), "table_name")
    conflicts = Reports(f"{root}/work").conflicts(spark).groupBy("table_name").agg(F.sum("inserts").alias("conflicts"))
    out = same.join(conflicts, "table_name", "left").join(result.marks.select(F.col("name").alias("table_name"), F.col("new_value").alias("mark")), "table_name")
    return out.select("table_name", "n", F.col("digest").eqNullSafe(F.col("want")).alias("equal"), F.coalesce("conflicts", F.lit(0)).alias("conflicts"), "mark")


# === lag ========================================================================================

_HEX = "upper(printf('%x/%x', event_id * 7919 // 4294967296, event_id * 7919 % 4294967296))"
_LSN_TEXT = f"CASE WHEN event_id % 13 = 0 THEN 'nope' WHEN event_id % 13 = 1 THEN '0-' || event_id ELSE {_HEX} END"


def _lsn_text(spark: SparkSession, sf: str) -> DataFrame:
    text = (
        F.when(F.expr("event_id % 13 = 0"), "nope")
        .when(F.expr("event_id % 13 = 1"), F.concat(F.lit("0-"), F.col("event_id").cast("string")))
        .otherwise(F.concat(F.hex(F.expr("event_id * 7919 div 4294967296")), F.lit("/"), F.hex(F.expr("event_id * 7919 % 4294967296"))))
    )
    return d.load(spark, sf, "events").select("event_id", text.alias("text"))


@query(
    f"""SELECT event_id, text, CAST(CASE WHEN regexp_full_match(text, '[0-9A-Fa-f]{{1,8}}/[0-9A-Fa-f]{{1,8}}')
    THEN CAST('0x' || split_part(text, '/', 1) AS HUGEINT) * 4294967296 + CAST('0x' || split_part(text, '/', 2) AS HUGEINT) END AS VARCHAR) AS lsn
    FROM (SELECT event_id, {_LSN_TEXT} AS text FROM events)""",
    name="parse_lsn",
)
def parsed_lsn(spark, sf):
    return _lsn_text(spark, sf).select("event_id", "text", parse_lsn(F.col("text")).cast("string").alias("lsn"))


@query(
    """SELECT event_id, upper(printf('%x/%x', CAST(v // 4294967296 AS BIGINT), CAST(v % 4294967296 AS BIGINT))) AS text
    FROM (SELECT event_id, CAST(18446744073709551615 AS HUGEINT) - event_id * 7919 AS v FROM events)""",
    name="format_lsn",
)
def formatted_lsn(spark, sf):
    high = F.lit(Decimal(2**64 - 1)) - F.expr("event_id * 7919").cast("decimal(20,0)")
    return d.load(spark, sf, "events").select("event_id", format_lsn(high).alias("text"))


_THRESHOLD = 200


def _states_sql(samples: str, threshold: int) -> str:
    return f"""SELECT slot, sample_no, lag, CASE WHEN NOT before AND now THEN 'JustCaughtUp' WHEN before AND NOT now THEN 'FellBehind'
        WHEN now THEN 'StillCaughtUp' ELSE 'StillBehind' END AS state, confirmed_lsn FROM (
        SELECT *, lag(now, 1, false) OVER (PARTITION BY slot ORDER BY sample_no) AS before FROM (
        SELECT slot, sample_no, confirmed_lsn, greatest(source_lsn - confirmed_lsn, 0) AS lag,
               greatest(source_lsn - confirmed_lsn, 0) <= {threshold} AS now
        FROM ({samples}) WHERE confirmed_lsn IS NOT NULL))"""


@query(f"SELECT slot, sample_no, lag, state FROM ({_states_sql(d.LAG_SAMPLES, _THRESHOLD)})")
def lag_transitions(spark, sf):
    return lag.lag_transitions(d.lag_samples(spark, sf), _THRESHOLD, chunk=4096)


def _runs_sql(samples: str, threshold: int) -> str:
    return f"""SELECT *, CAST(row_number() OVER (PARTITION BY slot, island ORDER BY sample_no) - 1 AS BIGINT) AS stale_run FROM (
        SELECT *, sum(CASE WHEN stale THEN 0 ELSE 1 END) OVER (PARTITION BY slot ORDER BY sample_no) AS island FROM (
        SELECT *, coalesce(confirmed_lsn = lag(confirmed_lsn) OVER (PARTITION BY slot ORDER BY sample_no) AND lag > 0, false) AS stale
        FROM ({_states_sql(samples, threshold)})))"""


@query(f"SELECT slot, sample_no, lag, stale_run FROM ({_runs_sql(d.HELD_SAMPLES, _THRESHOLD)}) WHERE stale AND stale_run % 3 = 0")
def stalls(spark, sf):
    return lag.stalls(d.held_samples(spark, sf), chunk=4096)


@query(
    f"""SELECT slot, sample_no, CASE WHEN lag = 0 THEN 'CaughtUp' ELSE 'Lag' END AS stage,
    CASE WHEN lag <= {_THRESHOLD} THEN 0.2 ELSE 10.0 END::DOUBLE AS next_wait, beats, beats >= 2 AS fast_enough FROM (
    SELECT *, count(*) OVER (PARTITION BY slot ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS beats FROM (
    SELECT *, greatest(source_lsn - confirmed_lsn, 0) AS lag FROM ({d.LAG_SAMPLES}) WHERE confirmed_lsn IS NOT NULL))"""
)
def cadence(spark, sf):
    return lag.cadence(d.lag_samples(spark, sf), _THRESHOLD, 0.2, 10.0, window_seconds=3600, min_beats=2, chunk_windows=24)


@query(
    f"""SELECT slot, max(sample_no) AS last_sample, arg_max(confirmed_lsn, sample_no) AS last_applied_lsn,
    arg_max(greatest(source_lsn - confirmed_lsn, 0), sample_no) AS last_lag
    FROM ({d.LAG_SAMPLES}) WHERE confirmed_lsn IS NOT NULL GROUP BY slot"""
)
def apply_stats(spark, sf):
    return lag.apply_stats(d.lag_samples(spark, sf))


_HELD_THRESHOLD = 1500


def _monitored(spark: SparkSession, sf: str) -> DataFrame:
    root = work_dir(spark, "lag")
    samples = d.held_samples(spark, sf).withColumns(
        {c: F.col(c).cast("decimal(20,0)") for c in ("source_lsn", "confirmed_lsn")}
    )
    span = samples.agg(F.expr("max(sample_no) + 1")).first()[0]
    for i in range(2):  # in the order of the polls, the second run going on where the first one stopped
        part = samples.filter(F.col("sample_no").between(span * i // 2, span * (i + 1) // 2 - 1))
        part.write.mode("append").parquet(f"{root}/samples")
        stream = read_lag_samples(spark, f"{root}/samples", stream=True)
        monitor.lag_monitor(stream, f"{root}/out", f"{root}/checkpoint", threshold=_HELD_THRESHOLD).awaitTermination()
    return monitor.read_states(spark, f"{root}/out")


@query(
    f"SELECT slot, sample_no, CAST(lag AS VARCHAR) AS lag, state, stale_run, stale AND stale_run % 3 = 0 AS stall FROM ({_runs_sql(d.HELD_SAMPLES, _HELD_THRESHOLD)})"
)
def lag_monitor_stream(spark, sf):
    states = _monitored(spark, sf)
    return states.select("slot", "sample_no", F.col("lag").cast("string").alias("lag"), "state", "stale_run", "stall")


@query(
    f"""SELECT slot, sample_no, 0 AS seq, CASE WHEN lag = 0 THEN 'CaughtUp' ELSE 'Lag' END AS stage, confirmed_lsn + lag AS source_lsn
    FROM ({_states_sql(d.LAG_SAMPLES, _THRESHOLD)})
    UNION ALL SELECT slot, sample_no, 1, CASE state WHEN 'JustCaughtUp' THEN 'CaughtUp' ELSE 'StreamApply' END, NULL
    FROM ({_states_sql(d.LAG_SAMPLES, _THRESHOLD)}) WHERE state IN ('JustCaughtUp', 'FellBehind')"""
)
def progress_events(spark, sf):
    """Events written as text and read back: the source position comes out of the message."""
    states = lag.lag_states(d.lag_samples(spark, sf), _THRESHOLD, chunk=1024)
    events = monitor.progress_events(states)
    source = logtext.heartbeat_fields(F.col("message"))["source_lsn"].cast("bigint")
    return events.select("slot", "sample_no", "seq", "stage", source.alias("source_lsn"))


# === marks ======================================================================================

_KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey",
    "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id", "pages": "page_id",
    "benchmark": "item_id", "labels": "doc_id", "conversations": "conv_id",
}


def _marks(tables) -> DataFrame:
    keys = {("public", t): k for t, k in _KEYS.items()}
    return marks.max_key({n: df for n, df in tables.items() if n in keys}, keys)


@query(" UNION ALL ".join(f"SELECT 'public' AS schema_name, '{t}' AS name, CAST(max({k}) AS BIGINT) AS last_value FROM {t}" for t, k in _KEYS.items()))
def max_key(spark, sf):
    return _marks(d.source_tables(spark, sf, _KEYS))


_MARKS_SOURCE = " UNION ALL ".join(
    f"SELECT 'public' AS schema_name, '{t}' AS name, CAST({'NULL' if t == 'nation' else f'(SELECT max({k}) FROM {t})'} AS BIGINT) AS last_value"
    for t, k in _KEYS.items()
)
_MARKS_TARGET = " UNION ALL ".join(
    f"SELECT 'public' AS schema_name, '{t}' AS name, CAST((SELECT max({k}) FROM {_TARGET[t]} AS t) AS BIGINT) AS last_value"
    for t, k in _KEYS.items()
    if t in _TARGET
)
_SYNCED = f"""SELECT s.schema_name, s.name, t.last_value AS old_value,
    CASE WHEN s.last_value IS NOT NULL AND t.name IS NOT NULL THEN s.last_value ELSE t.last_value END AS new_value,
    CASE WHEN s.last_value IS NULL THEN 'skipped' WHEN t.name IS NULL THEN 'failed' ELSE 'applied' END AS status
    FROM ({_MARKS_SOURCE}) s LEFT JOIN ({_MARKS_TARGET}) t USING (schema_name, name)"""


def _source_marks(tables) -> DataFrame:
    """Marks of the source; the one of ``nation`` never advanced."""
    value = F.when(F.col("name") != "nation", F.col("last_value"))
    return _marks(tables).withColumn("last_value", value)


@query(_SYNCED)
def sync_marks(spark, sf):
    tables = d.source_tables(spark, sf, _KEYS)
    return marks.sync_marks(_source_marks(tables), _marks(d.target_of(tables)))


@query(f"SELECT t.schema_name, t.name, coalesce(s.new_value, t.last_value) AS last_value FROM ({_MARKS_TARGET}) t LEFT JOIN ({_SYNCED}) s USING (schema_name, name)")
def marks_after_sync(spark, sf):
    tables = d.source_tables(spark, sf, _KEYS)
    return marks.marks_after_sync(_source_marks(tables), _marks(d.target_of(tables)))


# === quality ====================================================================================


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique(spark, sf):
    return quality.check_unique(d.load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM {d.TARGET_ORDERS}) GROUP BY 1")
def check_foreign_key(spark, sf):
    parent = d.target_of(d.source_tables(spark, sf, ["orders"]))["public", "orders"]
    return quality.check_foreign_key(d.load(spark, sf, "lineitem"), parent, [("l_orderkey", "o_orderkey")])


_HOLES = """SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_returnflag, 'N') AS l_returnflag,
    CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_linestatus END AS l_linestatus,
    CASE l_suppkey % 5 WHEN 0 THEN 'x' || l_partkey WHEN 1 THEN CAST(CAST(l_partkey AS BIGINT) + 3000000000 AS VARCHAR)
         ELSE CAST(l_partkey AS VARCHAR) END AS note FROM lineitem"""


def _holes(spark: SparkSession, sf: str) -> DataFrame:
    """``lineitem`` with NULLs, and a text column of which some values are no numbers or too large for INT."""
    note = (
        F.when(F.expr("l_suppkey % 5 = 0"), F.concat(F.lit("x"), F.col("l_partkey").cast("string")))
        .when(F.expr("l_suppkey % 5 = 1"), (F.col("l_partkey") + F.lit(3_000_000_000)).cast("string"))
        .otherwise(F.col("l_partkey").cast("string"))
    )
    return d.load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
        F.when(~F.expr("l_partkey % 10 = 0"), F.col("l_linestatus")).alias("l_linestatus"),
        note.alias("note"),
    )


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM ({_HOLES})" for c in ("l_returnflag", "l_linestatus", "note")
    )
)
def check_not_null(spark, sf):
    return quality.check_not_null(_holes(spark, sf), ["l_returnflag", "l_linestatus", "note"])


@query(f"SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM ({_HOLES}) WHERE NOT (l_quantity < 48 OR l_returnflag = 'A')")
def check_predicate(spark, sf):
    broken = quality.check_predicate(_holes(spark, sf), F.expr("l_quantity < 48 OR l_returnflag = 'A'"))
    return broken.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


@query("SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10")
def check_length(spark, sf):
    return quality.check_length(d.load(spark, sf, "part"), "p_name", 10).select("p_partkey", "p_name")


@query(f"SELECT l_orderkey, l_linenumber, note FROM ({_HOLES}) WHERE note IS NOT NULL AND TRY_CAST(note AS INTEGER) IS NULL")
def check_castable(spark, sf):
    return quality.check_castable(_holes(spark, sf), "note", "int").select("l_orderkey", "l_linenumber", "note")


def _rules() -> list[quality.Rule]:
    return [
        quality.not_null("l_returnflag"),
        quality.predicate("quantity", F.expr("l_quantity < 48 OR l_returnflag = 'A'")),
        quality.max_length("note", 9),
        quality.castable("note", "int"),
    ]


_TAGGED = f"""SELECT l_orderkey, l_linenumber, concat_ws(',',
    CASE WHEN l_returnflag IS NULL THEN 'not-null:l_returnflag' END,
    CASE WHEN NOT (l_quantity < 48 OR l_returnflag = 'A') THEN 'check:quantity' END,
    CASE WHEN length(note) > 9 THEN 'too-long:note' END,
    CASE WHEN note IS NOT NULL AND TRY_CAST(note AS INTEGER) IS NULL THEN 'invalid-int:note' END,
    CASE WHEN count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'unique:l_orderkey,l_linenumber' END,
    CASE WHEN l_orderkey NOT IN (SELECT o_orderkey FROM {d.TARGET_ORDERS}) THEN 'foreign-key:l_orderkey' END) AS violations
    FROM ({_HOLES})"""


@query(f"SELECT * FROM ({_TAGGED}) WHERE violations <> ''")
def quarantine(spark, sf):
    parent = d.target_of(d.source_tables(spark, sf, ["orders"]))["public", "orders"]
    _, bad = quality.split_valid(
        _holes(spark, sf), _rules(), unique=[["l_orderkey", "l_linenumber"]], foreign=[(parent, [("l_orderkey", "o_orderkey")])]
    )
    return bad.select("l_orderkey", "l_linenumber", F.array_join("violations", ",").alias("violations"))


@query(f"SELECT l_orderkey, l_linenumber FROM ({_TAGGED}) WHERE violations = ''")
def valid_rows(spark, sf):
    parent = d.target_of(d.source_tables(spark, sf, ["orders"]))["public", "orders"]
    good, _ = quality.split_valid(
        _holes(spark, sf), _rules(), unique=[["l_orderkey", "l_linenumber"]], foreign=[(parent, [("l_orderkey", "o_orderkey")])]
    )
    return good.select("l_orderkey", "l_linenumber")


_COLUMNS = """SELECT DISTINCT event_type AS schema_name, 'user_' || (user_id % 40) AS table_name, 'c' || (event_id % 20) AS column_name,
    CASE event_id % 3 WHEN 0 THEN 'bigint' WHEN 1 THEN 'string' ELSE 'double' END AS data_type, user_id % 40 AS u, event_id % 20 AS c FROM events"""
_COLUMNS_SOURCE = f"SELECT schema_name, table_name, column_name, min(data_type) AS data_type FROM ({_COLUMNS}) GROUP BY ALL"
_COLUMNS_TARGET = f"""SELECT schema_name, table_name, column_name, CASE WHEN c = 11 THEN 'text' ELSE min(data_type) END AS data_type
    FROM ({_COLUMNS}) WHERE u <> 5 AND NOT (c = 7 AND schema_name = 'view') GROUP BY schema_name, table_name, column_name, c"""


@query(
    f"""SELECT DISTINCT s.schema_name, s.table_name, CASE WHEN k.table_name IS NULL THEN NULL ELSE s.column_name END AS column_name,
    CASE WHEN k.table_name IS NULL THEN 'missing-table' WHEN t.column_name IS NULL THEN 'missing-column' ELSE 'type-change' END AS problem, true AS fatal
    FROM ({_COLUMNS_SOURCE}) s
    LEFT JOIN (SELECT DISTINCT schema_name, table_name FROM ({_COLUMNS_TARGET})) k ON k.schema_name = s.schema_name AND k.table_name = s.table_name
    LEFT JOIN ({_COLUMNS_TARGET}) t ON t.schema_name = s.schema_name AND t.table_name = s.table_name AND t.column_name = s.column_name
    WHERE t.column_name IS NULL OR t.data_type <> s.data_type"""
)
def missing_objects(spark, sf):
    kinds = F.array(F.lit("bigint"), F.lit("string"), F.lit("double"))
    rows = d.load(spark, sf, "events").select(
        F.col("event_type").alias("schema_name"),
        F.concat(F.lit("user_"), F.expr("user_id % 40").cast("string")).alias("table_name"),
        F.concat(F.lit("c"), F.expr("event_id % 20").cast("string")).alias("column_name"),
        F.get(kinds, F.expr("cast(event_id % 3 AS int)")).alias("data_type"),
    )
    name = ["schema_name", "table_name", "column_name"]
    source = rows.groupBy(*name).agg(F.min("data_type").alias("data_type"))
    kept = source.filter("table_name <> 'user_5' AND NOT (column_name = 'c7' AND schema_name = 'view')")
    target = kept.withColumn("data_type", F.when(F.col("column_name") == "c11", "text").otherwise(F.col("data_type")))
    return catalog.missing_objects(source, target)


# === logs =======================================================================================

_MESSAGE = "ltrim(substr(rtrim(line), 20))"
# Fixed values, spelled out here and not taken from the code that is checked.
_CATEGORY = """CASE WHEN contains(m, 'error:  copy ') OR contains(m, 'error: copy ') OR contains(m, 'invalid input syntax') OR contains(m, 'violates not-null')
        OR contains(m, 'violates check constraint') OR contains(m, 'violates foreign key') OR contains(m, 'violates unique constraint')
        OR contains(m, 'value too long for type') OR contains(m, 'out of range') THEN 'data-loss'
    WHEN contains(m, 'already exists') OR contains(m, 'duplicate key value') THEN 'duplicate'
    WHEN contains(m, 'permission denied') OR contains(m, 'must be owner') OR contains(m, 'must be superuser') OR contains(m, 'role "')
        OR contains(m, 'user mapping') THEN 'privilege'
    WHEN contains(m, 'extension ') OR contains(m, 'pg_extension') OR contains(m, 'for extension') THEN 'extension' ELSE 'other' END"""
_ERRORS = f"""SELECT log_id, line_no, message, {_CATEGORY} AS category FROM (
    SELECT *, lower(message) AS m FROM (SELECT log_id, line_no, {_MESSAGE} AS message FROM ({d.RESTORE_LOG})
    WHERE starts_with(rtrim(line), '{logtext.ERROR_PREFIX}')))"""


@query(
    f"""SELECT log_id, category, count(*) AS errors FROM ({_ERRORS}) GROUP BY 1, 2
    UNION ALL SELECT log_id, 'total', count(*) FROM ({_ERRORS}) GROUP BY 1"""
)
def error_categories(spark, sf):
    return logs.summarise_errors(d.restore_log(spark, sf))


@query(
    f"""SELECT category, CAST(CASE category WHEN 'data-loss' THEN 0 WHEN 'duplicate' THEN 1 WHEN 'privilege' THEN 2
    WHEN 'extension' THEN 3 ELSE 4 END AS BIGINT) AS severity, count(*) AS errors FROM ({_ERRORS}) GROUP BY 1"""
)
def error_severity(spark, sf):
    found = logs.error_lines(d.restore_log(spark, sf)).groupBy("category").agg(F.count(F.lit(1)).alias("errors"))
    return logs.order_by_severity(found).select("category", logtext.severity_rank(F.col("category")).cast("bigint").alias("severity"), "errors")


@query(
    f"""SELECT * FROM (SELECT log_id, category, CAST(row_number() OVER (PARTITION BY log_id, category ORDER BY line_no) AS INTEGER) AS nth,
    line_no, message FROM ({_ERRORS})) WHERE nth <= 5"""
)
def error_samples(spark, sf):
    return logs.error_samples(d.restore_log(spark, sf))


_REPORTED = f"""SELECT log_id, arg_max(CAST(substr(rtrim(line), {len(logtext.IGNORED_PREFIX) + 1}) AS BIGINT), line_no) AS reported
    FROM ({d.RESTORE_LOG}) WHERE starts_with(line, '{logtext.IGNORED_PREFIX}') GROUP BY 1"""


@query(
    f"""SELECT l.log_id, coalesce(e.errors, 0) AS errors, coalesce(e.data_loss, 0) AS data_loss, r.reported,
    CASE WHEN coalesce(e.data_loss, 0) > 0 THEN 'REVIEW REQUIRED' WHEN coalesce(e.errors, 0) = 0 THEN 'no errors captured' ELSE 'likely safe' END AS verdict
    FROM (SELECT DISTINCT log_id FROM ({d.RESTORE_LOG})) l
    LEFT JOIN (SELECT log_id, count(*) AS errors, count(*) FILTER (category = 'data-loss') AS data_loss FROM ({_ERRORS}) GROUP BY 1) e USING (log_id)
    LEFT JOIN ({_REPORTED}) r USING (log_id)"""
)
def restore_verdict(spark, sf):
    return logs.restore_verdict(d.restore_log(spark, sf))


@query(f"SELECT log_id, line_no, regexp_replace(line, '(://[^:/@\\s]*):\\S+@', '\\1:****@', 'g') AS line FROM ({d.RESTORE_LOG})")
def redact_uri(spark, sf):
    return d.restore_log(spark, sf).withColumn("line", logtext.redact_uri(F.col("line")))


@query(
    """SELECT source AS kind, regexp_extract(q, '^(.*)\\.([^.]*)$', 1) AS schema_name, regexp_extract(q, '^(.*)\\.([^.]*)$', 2) AS table_name, count(*) AS n
    FROM (SELECT source, source || '.' || (doc_id % 10) || '.' || lang AS q FROM documents) GROUP BY 1, 2, 3"""
)
def split_qualified(spark, sf):
    name = F.concat_ws(".", "source", F.expr("doc_id % 10").cast("string"), "lang")
    rows = d.load(spark, sf, "documents").select(F.col("source").alias("kind"), logtext.split_qualified(name).alias("q"))
    return rows.groupBy("kind", "q.schema_name", "q.table_name").agg(F.count(F.lit(1)).alias("n"))


def _read_restore(spark: SparkSession, sf: str) -> DataFrame:
    root = work_dir(spark, "restore-log")
    log = d.restore_log(spark, sf)
    # a folder per log; a long log is cut into several files
    ordered = log.repartitionByRange("log_id", "line_no").sortWithinPartitions("log_id", "line_no")
    ordered.select("log_id", F.col("line").alias("value")).write.partitionBy("log_id").text(root)
    folder = F.regexp_extract("log_id", "log_id=([^/]*)/", 1)
    return read_restore_log(spark, root).withColumn("log_id", folder)


@query(f"SELECT category, count(*) AS errors, count(DISTINCT log_id) AS logs FROM ({_ERRORS}) GROUP BY 1")
def read_restore_logs(spark, sf):
    lines = _read_restore(spark, sf)
    found = logs.error_lines(lines).groupBy("category")
    return found.agg(F.count(F.lit(1)).alias("errors"), F.count_distinct("log_id").alias("logs"))


@query(
    f"""SELECT run_id, stage, count(*) AS events, count(*) FILTER (ts IS NULL) AS untimed, max(message) AS last_message, sum(lag)::BIGINT AS lag
    FROM (SELECT run_id, stage, CAST(NULL AS TIMESTAMP) AS ts, 'at ' || epoch_us(ts) AS message, epoch_us(ts) % 1000 AS lag FROM ({d.PROGRESS})) GROUP BY 1, 2"""
)
def read_progress_log(spark, sf):
    """Events written as their writer does, without a time, and read back with message and detail."""
    root, us = work_dir(spark, "progress-log"), d.micros("ts")
    detail = F.struct((us % 1000).alias("lag_bytes"), F.lit("native").alias("engine"))
    d.progress(spark, sf).select("run_id", "stage", F.concat(F.lit("at "), us.cast("string")).alias("message"), detail.alias("detail")).write.json(root)
    events = read_progress(spark, root)
    return events.groupBy("run_id", "stage").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("ts").isNull()).alias("untimed"),
        F.max("message").alias("last_message"),
        F.sum("detail.lag_bytes").cast("bigint").alias("lag"),
    )


@query(
    f"""SELECT run_id, stage, events, epoch_us(started) AS started_us, epoch_us(ended) AS ended_us, (epoch_us(ended) - epoch_us(started)) / 1e6 AS seconds
    FROM (SELECT *, coalesce(lead(started) OVER (PARTITION BY run_id ORDER BY started, stage), last) AS ended FROM (
    SELECT run_id, stage, count(*) AS events, min(ts) AS started, max(ts) AS last FROM ({d.PROGRESS}) GROUP BY 1, 2))"""
)
def stage_timeline(spark, sf):
    line = logs.stage_timeline(d.progress(spark, sf))
    return line.select("run_id", "stage", "events", d.micros("started").alias("started_us"), d.micros("ended").alias("ended_us"), "seconds")


@query(
    f"""SELECT run_id, (epoch_us(min(ts) FILTER (stage = 'CaughtUp')) - epoch_us(min(ts))) / 1e6 AS first_seconds,
    (epoch_us(max(ts) FILTER (stage = 'CaughtUp')) - epoch_us(min(ts))) / 1e6 AS last_seconds FROM ({d.PROGRESS}) GROUP BY 1"""
)
def caught_up_time(spark, sf):
    return logs.caught_up_time(d.progress(spark, sf))


@query(
    f"""SELECT m.log_id, m.line_no, b.line_no AS beat_line, b.source_lsn, b.applied_lsn
    FROM (SELECT DISTINCT log_id, line_no FROM ({d.MARKS})) m ASOF LEFT JOIN ({d.BEATS}) b ON m.log_id = b.log_id AND m.line_no >= b.line_no"""
)
def heartbeat_as_of(spark, sf):
    return logs.heartbeat_as_of(d.beats(spark, sf), d.marks(spark, sf), chunk=4096)


@query(
    f"""SELECT m.log_id, m.line_no, m.target_lsn, min(b.line_no) AS reached_line, arg_min(b.applied_lsn, b.line_no) AS reached_lsn
    FROM ({d.MARKS}) m LEFT JOIN ({d.BEATS}) b ON m.log_id = b.log_id AND b.line_no > m.line_no AND b.applied_lsn >= m.target_lsn
    GROUP BY 1, 2, 3"""
)
def first_reaching(spark, sf):
    return logs.first_reaching(d.beats(spark, sf), d.marks(spark, sf))


# === sizes and statistics =======================================================================

_RUNS = """SELECT event_type AS run_id, sum(length(props)) * 1000000 AS bytes,
    CASE event_type WHEN 'error' THEN NULL ELSE CAST(count(DISTINCT user_id) AS DOUBLE) END AS seconds FROM events GROUP BY 1"""


@query(
    f"""SELECT run_id, round(bytes / 1073741824.0, 6) AS gb, round(seconds / 60.0, 6) AS minutes,
    round((bytes / 1073741824.0) / (seconds / 60.0), 6) AS gb_per_min FROM (SELECT run_id, CAST(bytes AS DOUBLE) AS bytes, seconds FROM ({_RUNS}))"""
)
def throughput(spark, sf):
    seconds = F.count_distinct("user_id").cast("double")
    runs = (
        d.load(spark, sf, "events")
        .groupBy(F.col("event_type").alias("run_id"))
        .agg((F.sum(F.length("props")) * 1_000_000).alias("bytes"), seconds.alias("s"))
        .withColumn("seconds", F.when(F.col("run_id") != "error", F.col("s")))
    )
    rates = stats.throughput(runs)
    return rates.select("run_id", *[F.round(c, 6).alias(c) for c in ("gb", "minutes", "gb_per_min")])


_STAT_COLUMNS = {"orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"], "events": ["event_id", "user_id", "event_type", "props"]}
_STAT_TEXT = {"o_orderstatus", "o_orderpriority", "event_type", "props"}


@query(
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls, count(DISTINCT {c}) AS ndv,
        CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value,
        {f"CAST(max(strlen({c})) AS BIGINT)" if c in _STAT_TEXT else "CAST(8 AS BIGINT)"} AS max_width FROM {t}"""
        for t, cols in _STAT_COLUMNS.items()
        for c in cols
    )
)
def table_stats(spark, sf):
    parts = [
        stats.table_stats(d.load(spark, sf, t), cols, exact=True).drop("avg_width").select(F.lit(t).alias("table_name"), "*")
        for t, cols in _STAT_COLUMNS.items()
    ]
    return _union(parts)


# fixed width in bytes, or None for text
_WIDTHS = {
    "region": {"r_regionkey": 4, "r_name": None},
    "nation": {"n_nationkey": 4, "n_name": None, "n_regionkey": 4},
    "customer": {"c_custkey": 8, "c_name": None, "c_nationkey": 4, "c_acctbal": 8, "c_mktsegment": None},
    "supplier": {"s_suppkey": 8, "s_name": None, "s_nationkey": 4, "s_acctbal": 8},
    "part": {"p_partkey": 8, "p_name": None, "p_brand": None, "p_type": None, "p_size": 4, "p_retailprice": 8},
    "lineitem": {"l_orderkey": 8, "l_partkey": 8, "l_linenumber": 4, "l_quantity": 8, "l_returnflag": None, "l_shipdate": 8},
    "documents": {"doc_id": 8, "text": None, "lang": None, "source": None, "n_chars": 8},
    "conversations": {"conv_id": 8, "turn": 8, "role": None, "text": None},
}


@query(
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls,
        CAST({width or f"max(strlen({c}))"} AS BIGINT) AS max_width, true AS close FROM {t}"""
        for t, cols in _WIDTHS.items()
        for c, width in cols.items()
    )
)
def table_stats_approx(spark, sf):
    """Profiles with sketched distinct counts; ``close`` says that a sketch is within a fifth of the exact count."""
    parts = []
    for t, cols in _WIDTHS.items():
        df = d.load(spark, sf, t)
        sketch = stats.table_stats(df, list(cols))
        exact = df.select(*[F.count_distinct(c).alias(c) for c in cols]).unpivot([], list(cols), "column_name", "exact")
        close = (F.abs(F.col("ndv") - F.col("exact")) <= F.col("exact") * 0.2).alias("close")
        both = sketch.join(exact, "column_name")
        parts.append(both.select(F.lit(t).alias("table_name"), "column_name", "rows", "nulls", "max_width", close))
    return _union(parts)


_PROFILED = {
    **{t: list(cols) for t, cols in _WIDTHS.items() if t != "lineitem"},
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "embeddings": ["vec_id", "embedding", "label"], "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"], "labels": ["doc_id", "quality", "toxic"],
}


@query(
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls, count(DISTINCT {c}) AS ndv,
        true AS ndv_close, true AS same_extremes FROM {t}"""
        for t, cols in _PROFILED.items()
        for c in cols
    )
)
def table_profiles(spark, sf):
    """Stored profiles of all tables, a part of each profiled first and the rest later; held against one pass over the whole and exact counts."""
    root, schemas, whole, parts = work_dir(spark, "profiles"), {}, [], []
    for t, cols in _PROFILED.items():
        df = d.load(spark, sf, t).select(*cols)
        schemas[t], late = df.schema, F.pmod(F.xxhash64(cols[0]), F.lit(3)) == 0
        parts += [(df.filter(~late), f"{root}/{t}", "first"), (df.filter(late), f"{root}/{t}", "top-up")]
        flat = [c for c in cols if c != "embedding"]
        ends = [F.struct(F.lit(c).alias("column_name"), F.min(c).cast("string").alias("low"), F.max(c).cast("string").alias("high")) for c in flat]
        extremes = df.agg(*[e.alias(f"_{i}") for i, e in enumerate(ends)]).select(F.explode(F.array(*[F.col(f"_{i}") for i in range(len(ends))])).alias("e"))
        exact = stats.distinct_counts(df).withColumnRenamed("ndv", "exact").join(extremes.select("e.*"), "column_name", "left")
        whole.append(exact.select(F.lit(t).alias("table_name"), "*"))
    with ThreadPoolExecutor(8) as pool:  # tables are small jobs side by side
        list(pool.map(lambda part: sketches.store(*part), parts))
    both = sketches.stored_tables(spark, root, schemas).join(_union(whole), ["table_name", "column_name"])
    close = (F.abs(F.col("ndv") - F.col("exact")) <= F.greatest(F.col("exact") * 0.1, F.lit(1))).alias("ndv_close")
    same = (F.col("min_value").eqNullSafe(F.col("low")) & F.col("max_value").eqNullSafe(F.col("high"))).alias("same_extremes")
    return both.select("table_name", "column_name", "rows", "nulls", F.col("exact").alias("ndv"), close, same)


# bytes of the columns of fixed width, and the text columns
_SIZES = {
    "region": ("4", ["r_name"]), "nation": ("8", ["n_name"]), "customer": ("20", ["c_name", "c_mktsegment"]),
    "supplier": ("20", ["s_name"]), "part": ("20", ["p_name", "p_brand", "p_type"]),
    "orders": ("32", ["o_orderstatus", "o_orderpriority"]), "lineitem": ("68", ["l_returnflag", "l_linestatus"]),
    "events": ("32", ["event_type", "props"]), "documents": ("16", ["text", "lang", "source"]),
    "embeddings": ("12 + 4 * len(embedding)", []), "pages": ("8", ["url", "html"]), "benchmark": ("8", ["text"]),
    "labels": ("16", []), "conversations": ("16", ["role", "text"]),
}
_SIZE_ROWS = " UNION ALL ".join(
    f"SELECT 'public' AS schema_name, '{t}' AS table_name, count(*) AS rows, CAST(sum({' + '.join([fixed, *(f'coalesce(strlen({c}), 0)' for c in text)])}) AS BIGINT) AS bytes FROM {t}"
    for t, (fixed, text) in _SIZES.items()
)


@query(
    f"""SELECT schema_name, table_name, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(bytes) AS BIGINT) AS bytes
    FROM ({_SIZE_ROWS}) GROUP BY ROLLUP (schema_name, table_name)"""
)
def db_size(spark, sf):
    return stats.db_size({("public", t): d.load(spark, sf, t) for t in _SIZES})


_ANALYZED = ["region", "nation", "customer", "supplier", "part", "orders"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, 'analyzed' AS status, count(*) AS rows FROM {t}" for t in _ANALYZED))
def analyze_tables(spark, sf):
    """Catalog entries over the given files in a database of their own, their stored statistics, and all gone again."""
    db, rows = f"twinproof_{uuid.uuid4().hex[:12]}", []
    spark.sql(f"CREATE DATABASE `{db}`")
    try:
        for t in _ANALYZED:
            spark.sql(f"CREATE TABLE `{db}`.`{t}` USING parquet LOCATION '{sf}/{t}.parquet'")
        report = maintain.analyze_all(spark, scope.Scope(schemas=[db]))
        for t in _ANALYZED:
            text = spark.sql(f"DESCRIBE EXTENDED `{db}`.`{t}`").filter("col_name = 'Statistics'").first()["data_type"]
            rows.append((t, int(text.split(", ")[1].split(" ")[0])))
    finally:
        spark.sql(f"DROP DATABASE `{db}` CASCADE")
    return report.join(spark.createDataFrame(rows, "table_name string, rows bigint"), "table_name").select("table_name", "status", "rows")


# === generators =================================================================================

_UNIFORM = "CAST(CAST('0x' || substr(md5(seed || ':val'), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0"
_PAYLOAD = "md5(array_to_string(list_transform(range(1, 32), lambda i: md5(seed || ':' || i)), ''))"


@query(
    f"""SELECT table_name, id, 992 AS payload_length, {_PAYLOAD} AS payload_md5, {_UNIFORM} AS val
    FROM (SELECT 'benchmark_data_0' || t AS table_name, id, 'benchmark_data_0' || t || ':' || id AS seed
    FROM range(1, 9) x(t), range(1, (SELECT count(*) // 8 FROM orders) + 1) y(id))"""
)
def generate_benchmark(spark, sf):
    tables = generate.generate_benchmark(spark, d.load(spark, sf, "orders").count())
    parts = [df.withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    return _union(parts).select("table_name", "id", F.length("payload").alias("payload_length"), F.md5("payload").alias("payload_md5"), "val")


@query(
    f"""SELECT id, {_PAYLOAD} AS payload_md5, {_UNIFORM} AS val FROM (SELECT id, 'benchmark_data_01:' || id AS seed FROM (
    SELECT unnest(range(h.top + 1, h.top + 1 + greatest((SELECT count(*) FROM orders) - h.n, 0))) AS id FROM (
    SELECT count(*) AS n, max(event_id + 1) AS top FROM events WHERE event_id % 3 <> 0) h))"""
)
def top_up(spark, sf):
    existing = d.load(spark, sf, "events").filter("event_id % 3 <> 0").select((F.col("event_id") + 1).alias("id"))
    added = generate.top_up(existing, "benchmark_data_01", d.load(spark, sf, "orders").count())
    return added.select("id", F.md5("payload").alias("payload_md5"), "val")


@query(
    """SELECT event_id + 1 AS lsn, 0 AS seq, 'I' AS op, CAST(10000 + event_id AS VARCHAR) AS id, 'ins-' || (10000 + event_id) AS name, CAST(event_id * 7 AS VARCHAR) AS qty FROM events
    UNION ALL SELECT event_id + 1, 1, 'U', CAST(1 + event_id % 500 AS VARCHAR), 'upd-' || event_id, CAST(event_id * 11 AS VARCHAR) FROM events WHERE 1 + event_id % 500 < 451
    UNION ALL SELECT event_id + 1, 2, 'D', CAST(451 + event_id % 50 AS VARCHAR), NULL, NULL FROM events WHERE event_id < 50"""
)
def generate_mutations(spark, sf):
    made = generate.mutations(d.load(spark, sf, "events").select("event_id"), "event_id")
    return made.select("lsn", "seq", "op", "key.id", "after.name", "after.qty")


# === copies =====================================================================================

_ROW_KEYS = dict.fromkeys(d.TABLES) | {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"],
    "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
    "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}


def _keys(tables: dict) -> dict:
    """Key columns of every given table; the first column where none is listed."""
    return {name: _ROW_KEYS.get(name[1]) or df.columns[:1] for name, df in tables.items()}


@query(" UNION ALL ".join(f"SELECT '{what}' AS what, 'public' AS schema_name, '{t}' AS table_name, 'done' AS state, count(*) AS rows, true AS equal FROM {t}"
                          for what in ("all", "data-only") for t in d.TABLES))
def resumable_copy(spark, sf):
    """A copy in which a table fails part way, and a second run that does the rest; contents of both sides compared."""
    tables, parts = d.source_tables(spark, sf, d.TABLES), []
    late = F.when(F.col("o_orderkey") % 5 == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("o_orderkey")).cast("bigint")
    broken = tables | {("public", "orders"): tables["public", "orders"].withColumn("o_orderkey", late)}
    keys = _keys(tables)
    for what in ("all", "data-only"):
        root, only = work_dir(spark, "copy"), scope.Scope(what=what)
        try:
            copying.copy_tables(spark, broken, sf, root, only, compress="zstd:3")
        except PySparkException as lost:
            if "lost" not in str(lost):
                raise
        manifest = copying.copy_tables(spark, tables, sf, root, only, compress="zstd:3", resume=True)
        here = digests(tables, keys).withColumnRenamed("digest", "d1").drop("n")
        there = digests(copying.copied_tables(spark, root, list(tables)), keys).withColumnRenamed("digest", "d2").drop("n")
        both = here.join(there, ["schema_name", "table_name"])
        same = both.select("schema_name", "table_name", F.col("d1").eqNullSafe(F.col("d2")).alias("equal"))
        parts.append(manifest.join(same, ["schema_name", "table_name"]).select(F.lit(what).alias("what"), "schema_name", "table_name", "state", "rows", "equal"))
    return _union(parts)


@query(f"SELECT 'lineitem' AS table_name, v AS rule, count(*) AS rows FROM (SELECT unnest(string_split(violations, ';')) AS v FROM ("
       + _TAGGED.replace("concat_ws(',',", "concat_ws(';',").replace(
           f"    CASE WHEN l_orderkey NOT IN (SELECT o_orderkey FROM {d.TARGET_ORDERS}) THEN 'foreign-key:l_orderkey' END)", "    NULL)")
       + ")) WHERE v <> '' GROUP BY 2")
def sectioned_copy(spark, sf):
    """Create, load clustered, check: the rows that break a rule are counted after the load."""
    path = work_dir(spark, "sections")
    report = copying.copy_in_sections(_holes(spark, sf), path, keys=["l_orderkey", "l_linenumber"], rules=_rules(), cluster=True)
    return report.select(F.lit("lineitem").alias("table_name"), "rule", "rows")


_SPECS = ["none", "gzip:6", "lz4:1", "zstd:3", "1"]


@query(" UNION ALL ".join(f"SELECT '{spec}' AS spec, count(*) AS rows, true AS equal FROM orders" for spec in _SPECS))
def archive_codecs(spark, sf):
    """Each compression spec written and read back, contents compared."""
    root, orders, parts = work_dir(spark, "archive"), d.load(spark, sf, "orders"), []
    here = content.content_hash(orders, ["o_orderkey"], orders.columns).first()["digest"]
    for i, spec in enumerate(_SPECS):
        write_archive(orders, f"{root}/{i}", spec)
        back = content.content_hash(spark.read.parquet(f"{root}/{i}"), ["o_orderkey"], orders.columns)
        parts.append(back.select(F.lit(spec).alias("spec"), F.col("n").alias("rows"), F.col("digest").eqNullSafe(F.lit(here)).alias("equal")))
    return _union(parts)


@query(
    """SELECT 'append' AS step, 2 * count(*) AS rows FROM customer UNION ALL SELECT 'replace', count(*) FROM customer
    UNION ALL SELECT 'schema-only', 0 UNION ALL SELECT 'data-only', count(*) FROM customer"""
)
def load_modes(spark, sf):
    """Appending, replacing, and a copy of the empty table that is filled afterwards, each in a folder of its own."""
    root, customer = work_dir(spark, "load"), d.load(spark, sf, "customer")
    load_table(customer, f"{root}/append")
    load_table(customer, f"{root}/append")
    load_table(customer, f"{root}/replace")
    load_table(customer, f"{root}/replace", replace=True)
    table, at = {("public", "customer"): customer}, {"append": f"{root}/append", "replace": f"{root}/replace"}
    for step, kinds in (("schema-only", ["schema-only"]), ("data-only", ["schema-only", "data-only"])):
        for what in kinds:
            copying.copy_tables(spark, table, sf, f"{root}/{step}", scope.Scope(what=what))
        at[step] = copying.table_path(f"{root}/{step}", "public", "customer")
    return _union([spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(k).alias("step"), "rows") for k, p in at.items()])


_OFFLINE = [t for t in d.TABLES if t != "nation"]
_BROKEN = {
    "customer": "count(*) FILTER (c_acctbal < 0)",
    "lineitem": "(SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))",
}


@query(" UNION ALL ".join(
    f"""SELECT 'public' AS schema_name, '{t}' AS table_name, count(*) AS source, count(*) AS target, true AS analyzed, true AS equal,
    {_BROKEN.get(t, "0")}::BIGINT AS broken FROM {t}""" for t in _OFFLINE))
def offline_copy(spark, sf):
    """The whole scoped run: load, checks, statistics, counts and contents."""
    tables = d.source_tables(spark, sf, d.TABLES)
    only = scope.Scope(schemas=["public"], exclude_tables=[("public", "nation")])
    rules = {"customer": [quality.predicate("balance", F.col("c_acctbal") >= 0)]}
    checks = {n: Checks(keys, rules.get(n[1], ())) for n, keys in _keys(tables).items()}
    return run_offline(spark, tables, sf, work_dir(spark, "offline"), checks, only)


@query(f"SELECT violations <> '' AS quarantined, count(*) AS rows FROM ({_TAGGED}) GROUP BY 1")
def quarantine_split(spark, sf):
    """Good and bad rows written in one pass."""
    path = work_dir(spark, "split")
    parent = d.target_of(d.source_tables(spark, sf, ["orders"]))["public", "orders"]
    tagged = quality.tag_violations(
        _holes(spark, sf), _rules(), unique=[["l_orderkey", "l_linenumber"]], foreign=[(parent, [("l_orderkey", "o_orderkey")])]
    )
    write_split(tagged, path)
    written = spark.read.parquet(path).groupBy((F.col("quarantined") == "true").alias("quarantined"))
    return written.agg(F.count(F.lit(1)).alias("rows"))
