"""Secret scans over an incremental ledger of blobs.

Every historical version of every path is addressed by the SHA-256 of its content. A rule at a version is
run once per blob, whatever number of paths and versions hold that blob; the ledger says which
``(blob, rule, version)`` were done. Findings are joined back to all paths.

Defined cases: a NULL content is the empty blob; a NULL path is kept; repeated rows give repeated rows;
an empty table gives none; a text without secrets has one row without findings in ``findings_by_path``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinproof.llm.spans import Kind, digest, find_spans
from twinproof.llm.tables import content_address
from twinproof.sinks.files import exists

_ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""


def _long_value(match):
    return F.length(F.regexp_extract(match, _ASSIGN, 1)) >= 8


#: A run shorter than asked for holds no longer run inside it, so the two plain kinds ask for the length at once.
RULES = [
    Kind("assign", _ASSIGN, keep=_long_value),
    Kind("access", r"AKIA[A-Z0-9]{12,}+"),
    Kind("hex", r"[0-9a-f]{32,}+", begin=r"(?<![0-9a-f])"),
]

_SCANS = "blob string, rule string, version int"
_FINDINGS = "blob string, kind string, version int, rank int, start long, end long"


class BlobLedger:
    """What was scanned, and what was found, as two append-only Parquet tables below ``path``.

    A run writes its findings first and its scan marks last, each into a folder of the run's own. Findings of
    a run without complete marks are never read, so a run that broke off is simply done again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _table(self, name: str, schema: str) -> DataFrame:
        at = f"{self.path}/{name}"
        if not exists(self.spark, at):
            return self.spark.createDataFrame([], schema + ", run string")
        return self.spark.read.schema(schema + ", run string").parquet(at)

    def scans(self) -> DataFrame:
        return self._table("scans", _SCANS)

    def findings(self, rules: list[Kind] | None = None) -> DataFrame:
        """Distinct findings of complete runs; with ``rules``, of their versions alone."""
        found = self._table("findings", _FINDINGS).join(self.scans().select("run").distinct(), "run", "left_semi").drop("run").distinct()
        return found if rules is None else found.where(_current(rules, "kind"))

    def scan(self, versions: DataFrame, content: str, rules: list[Kind] = RULES) -> str:
        """Scan the unseen (blob, rule version) pairs of ``versions``; returns the run's name."""
        run = uuid.uuid4().hex
        # one text per blob: copies meet within a task before the shuffle, so no group is large
        blobs = versions.select(content_address(F.col(content)).alias("blob"), F.coalesce(F.col(content), F.lit("")).alias("content"))
        blobs = blobs.groupBy("blob").agg(F.first("content").alias("content"))
        done = self.scans().where(_current(rules, "rule")).groupBy("blob").agg(F.collect_set("rule").alias("done"))
        due = blobs.join(done, "blob", "left").select("blob", "content", F.coalesce("done", F.array().cast("array<string>")).alias("done"))
        due = due.where(F.size("done") < len(rules))
        for name, table in (("findings", self._found(due, rules)), ("scans", self._marks(due, rules))):
            table.write.parquet(f"{self.path}/{name}/run={run}")
        return run

    @staticmethod
    def _found(due: DataFrame, rules: list[Kind]) -> DataFrame:
        versions = F.create_map(*[x for k in rules for x in (F.lit(k.name), F.lit(k.version))])
        found = find_spans(due, "blob", "content", rules, skip="done")
        return found.select("blob", "kind", versions[F.col("kind")].alias("version"), "rank", "start", "end")

    @staticmethod
    def _marks(due: DataFrame, rules: list[Kind]) -> DataFrame:
        every = F.array(*[F.struct(F.lit(k.name).alias("rule"), F.lit(k.version).alias("version")) for k in rules])
        return due.select("blob", F.explode(F.filter(every, lambda r: ~F.array_contains("done", r["rule"]))).alias("r")).select("blob", "r.rule", "r.version")

    def findings_by_path(self, versions: DataFrame, path: list[str], content: str, rules: list[Kind] = RULES) -> DataFrame:
        """Each row of ``versions`` with ``n_<kind>`` counts, ``base_sha256`` and ``spans`` of its content."""
        per_blob = self.findings(rules).groupBy("blob").agg(
            F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("all"),
            *[F.count_if(F.col("kind") == k.name).alias(f"n_{k.name}") for k in rules],
        )
        per_blob = per_blob.select("blob", digest(F.col("all")).alias("spans"), *[f"n_{k.name}" for k in rules])
        paths = versions.select(*path, content_address(F.col(content)).alias("blob"))
        spans = F.coalesce("spans", F.lit(""))
        return paths.join(per_blob, "blob", "left").select(
            *path,
            *[F.coalesce(f"n_{k.name}", F.lit(0)).cast("long").alias(f"n_{k.name}") for k in rules],
            F.sha2(spans, 256).alias("base_sha256"),
            spans.alias("spans"),
        )


def _current(rules: list[Kind], column: str):
    return F.coalesce(*[F.when(F.col(column) == k.name, F.col("version") == k.version) for k in rules], F.lit(False))
