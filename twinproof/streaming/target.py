"""A keyed Parquet table that takes change batches.

Parquet has no row-level merge, and writing a whole table again for every micro-batch does not
scale. So a batch only adds its own last images, and readers merge them by position:

- ``base/_gen=G/_bucket=B``             rows by key bucket, as written by create or compact
- ``delta/_run=R/_batch=N/_bucket=B``   last images of micro-batch N of run R by key bucket; readers see it once its mark is there
- ``commits``                           one row per generation: table id, cut, the buckets it holds, and per run the last batch folded in

A run is one checkpoint. ``bind`` writes table id and run beside the checkpoint's own files, so a new checkpoint is
a new run, and a checkpoint of another table (or of this one before it was created again) is refused.
Merging by position is idempotent, so a batch that is written twice, or is both folded in and still
present, changes nothing. Compaction writes only buckets that changed, and whoever asks about some keys
(``state_of``) opens base and delta files of their buckets only: what a batch costs grows with the batch.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinproof.operators.changes import POSITION, live_rows, merge_by_position, snapshot_as_state
from twinproof.sinks.files import exists, folders, remove

_STATE = [("_deleted", T.BooleanType()), ("_pos", T.LongType()), ("_seq", T.IntegerType())]
_PART = [("_run", T.StringType()), ("_batch", T.LongType()), ("_bucket", T.IntegerType())]
_COMMIT_SCHEMA = "gen bigint, table_id string, cut bigint, through map<string, bigint>, buckets array<int>"
_BOUND_SCHEMA = "table_id string, run string"
MAX_BUCKETS = 1 << 16


class TargetMismatch(RuntimeError):
    """Table, checkpoint and cut do not belong together."""


class LostBatch(RuntimeError):
    """A batch at or below the folded ones of its run carries changes that the table does not have."""


@dataclass
class KeyedTable:
    """``keys`` identify a row, ``schema`` is the row without state columns.

    Pick ``buckets`` so that a bucket of the base is worth about one to a few large files; the list
    of changed buckets is the only thing about data that the driver holds, hence its limit.
    """

    path: str
    keys: list[str]
    schema: T.StructType
    buckets: int = 64

    def __post_init__(self) -> None:
        if not 0 < self.buckets <= MAX_BUCKETS:
            raise ValueError(f"buckets must be between 1 and {MAX_BUCKETS}")

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def _schema(self, *extra: tuple[str, T.DataType]) -> T.StructType:
        return T.StructType([*self.schema.fields, *[T.StructField(n, t) for n, t in [*_STATE, *extra]]])

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        # hashed even for integer keys: ids that share a factor must not share buckets
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _write_base(self, rows: DataFrame, gen: int) -> None:
        # one shuffle groups a bucket's rows into few files; AQE splits large buckets and joins small ones
        self._bucketed(rows).hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(
            f"{self.path}/base/_gen={gen}"
        )

    def _commit(self, spark: SparkSession, gen: int, identity: tuple[str, int], through: dict[str, int], buckets: list[int]) -> None:
        spark.createDataFrame([(gen, *identity, through, buckets)], _COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.path}/commits"
        )

    def _commits(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_COMMIT_SCHEMA).parquet(f"{self.path}/commits")

    def identity(self, spark: SparkSession) -> tuple[str, int] | None:
        """``(table id, cut position)``; None while no create has come to its end here."""
        if not exists(spark, f"{self.path}/commits"):
            return None
        row = self._commits(spark).select("table_id", "cut").first()
        return tuple(row) if row else None

    def create(self, snapshot: DataFrame, cut_position: int, replace: bool = False) -> None:
        """Start from a snapshot taken at ``cut_position``. A table that is in use is only replaced when told to.

        The commit comes last: a create that breaks off leaves no table, and the next one starts over.
        """
        spark = snapshot.sparkSession
        if not replace and self.identity(spark):
            raise TargetMismatch(f"{self.path} holds a table already")
        spark.createDataFrame([], _COMMIT_SCHEMA).write.mode("overwrite").parquet(f"{self.path}/commits")
        remove(spark, f"{self.path}/delta")
        self._write_base(snapshot_as_state(snapshot.select(*self.columns), cut_position), 0)
        self._commit(spark, 0, (uuid.uuid4().hex, cut_position), {}, list(range(self.buckets)))

    def bind(self, spark: SparkSession, checkpoint: str) -> str:
        """The run of a checkpoint of this table; a checkpoint seen for the first time begins one."""
        identity = self.identity(spark)
        if identity is None:
            raise TargetMismatch(f"{self.path} holds no table")
        bound = f"{checkpoint}/bound"
        if not exists(spark, f"{bound}/_SUCCESS"):
            if exists(spark, f"{checkpoint}/commits"):
                raise TargetMismatch(f"{checkpoint} has batches of a stream that was not bound to a table")
            row = [(identity[0], uuid.uuid4().hex)]
            spark.createDataFrame(row, _BOUND_SCHEMA).coalesce(1).write.mode("overwrite").parquet(bound)
        table_id, run = spark.read.schema(_BOUND_SCHEMA).parquet(bound).first()
        if table_id != identity[0]:
            raise TargetMismatch(f"{checkpoint} belongs to another table than {self.path}")
        return run

    def put_batch(self, delta: DataFrame, batch_id: int, run: str = "") -> None:
        """Add one micro-batch of a run, a file per key bucket it touches.

        A batch that broke off is written again as a whole. One that is in, folded or not, may only come again with what
        the table has: anything newer raises.
        """
        spark = delta.sparkSession
        by_gen, through, _ = self._current(spark)
        if batch_id <= through.get(run, -1) or batch_id in self.open_batches(spark, through).get(run, ()):
            state = self.state_of(delta).select(*self.keys, *[F.col(c).alias(f"_has{c}") for c in POSITION])
            later = F.struct(*POSITION) > F.struct(*[f"_has{c}" for c in POSITION])
            if not delta.join(state, self.keys, "left").where(F.col("_has_pos").isNull() | later).isEmpty():
                raise LostBatch(f"batch {batch_id} of run {run!r} is in already and brings new changes")
            return
        rows = self._bucketed(delta).hint("rebalance", "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "static")
        # the mark decides what readers see, so a session that leaves it out must not
        rows = rows.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        rows.partitionBy("_bucket").parquet(self._batch_path(run, batch_id))

    def _batch_path(self, run: str, batch: int) -> str:
        return f"{self.path}/delta/_run={run or 'none'}/_batch={batch}"

    def open_batches(self, spark: SparkSession, through: dict[str, int] | None = None) -> dict[str, list[int]]:
        """Per run the batches that are written in full and not folded yet."""
        through = self._current(spark)[1] if through is None else through
        root, found = f"{self.path}/delta", {}
        for folder in folders(spark, root) if exists(spark, root) else []:
            run = "" if folder == "_run=none" else folder.removeprefix("_run=")
            numbers = [int(b.removeprefix("_batch=")) for b in folders(spark, f"{root}/{folder}") if b.startswith("_batch=")]
            later = sorted(n for n in numbers if n > through.get(run, -1))
            with ThreadPoolExecutor(16) as pool:  # the mark is what a job leaves last
                done = list(pool.map(lambda n, run=run: exists(spark, f"{self._batch_path(run, n)}/_SUCCESS"), later))
            if any(done):
                found[run] = [n for n, ok in zip(later, done) if ok]
        return found

    def _current(self, spark: SparkSession) -> tuple[dict[int, list[int]], dict[str, int], int]:
        """Buckets by generation, the last folded batch of each run, the last generation."""
        commits = self._commits(spark)
        newest = commits.select("gen", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.max("gen").alias("gen"))
        by_gen = newest.groupBy("gen").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))
        last = commits.agg(F.max("gen"), F.max_by("through", "gen")).first()
        through = {"" if run == "none" else run: batch for run, batch in (last[1] or {}).items()}
        return {r["gen"]: r["buckets"] for r in by_gen.collect()}, through, last[0]

    def _base(self, spark: SparkSession, by_gen: dict[int, list[int]], only: list[int] | None = None) -> DataFrame:
        # literal partition filters, so the scan lists and opens the live files only
        schema = self._schema(("_gen", T.LongType()), ("_bucket", T.IntegerType()))
        base = spark.read.schema(schema).parquet(f"{self.path}/base")
        wanted = F.lit(False)
        for gen, buckets in by_gen.items():
            kept = buckets if only is None else sorted(set(buckets) & set(only))
            if len(kept) == self.buckets:
                wanted = wanted | (F.col("_gen") == gen)
            elif kept:
                wanted = wanted | ((F.col("_gen") == gen) & F.col("_bucket").isin(kept))
        return base.filter(wanted).drop("_gen", "_bucket")

    def _delta(self, spark: SparkSession, batches: dict[str, list[int]], only: list[int] | None = None) -> DataFrame:
        paths = [self._batch_path(run, batch) for run, numbers in batches.items() for batch in numbers]
        if not paths:
            return spark.createDataFrame([], self._schema())
        delta = spark.read.schema(self._schema(*_PART)).option("basePath", f"{self.path}/delta").parquet(*paths)
        if only is not None:
            delta = delta.filter(F.col("_bucket").isin(only))
        return delta.drop(*[name for name, _ in _PART])

    def state(self, spark: SparkSession, only: list[int] | None = None) -> DataFrame:
        """Newest version of every row, deleted ones included, with positions. ``only`` these buckets, if given."""
        by_gen, through, _ = self._current(spark)
        return merge_by_position(self._base(spark, by_gen, only), self._delta(spark, self.open_batches(spark, through), only), self.keys)

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """Numbers of the buckets that the keys of these rows are in, at most ``buckets``."""
        return sorted(r["_bucket"] for r in self._bucketed(rows.select(*self.keys)).select("_bucket").distinct().collect())

    def state_of(self, rows: DataFrame) -> DataFrame:
        """``state`` of all buckets that hold keys of these rows."""
        return self.state(rows.sparkSession, self.buckets_of(rows))

    def read(self, spark: SparkSession) -> DataFrame:
        """Rows as of the last batch."""
        return live_rows(self.state(spark))

    def compact(self, spark: SparkSession, safe_position: int | None = None) -> list[int]:
        """Fold the batches so far into new files of the buckets they touch, and return those buckets.

        Deletions stay as rows until ``safe_position``: give it once no change before it can still arrive.
        """
        by_gen, through, gen = self._current(spark)
        batches = self.open_batches(spark, through)  # those that come meanwhile stay for the next time
        if not batches:
            return []
        paths = [self._batch_path(run, batch) for run, numbers in batches.items() for batch in numbers]
        with ThreadPoolExecutor(16) as pool:
            held = pool.map(lambda path: folders(spark, path), paths)
        # bucket numbers, at most `self.buckets`, from the names of folders
        touched = sorted({int(f.split("=")[1]) for names in held for f in names if f.startswith("_bucket=")})
        folded = {run or "none": numbers[-1] for run, numbers in batches.items()}
        merged = merge_by_position(self._base(spark, by_gen, touched), self._delta(spark, batches), self.keys)
        if safe_position is not None:
            merged = merged.filter(~F.col("_deleted") | (F.col("_pos") >= safe_position))
        self._write_base(merged, gen + 1)
        self._commit(spark, gen + 1, self.identity(spark), {run or "none": b for run, b in through.items()} | folded, touched)
        return touched

    def last_position(self, spark: SparkSession) -> tuple[int, int] | None:
        """``(_pos, _seq)`` of the latest change that is in, None before the first."""
        by_gen, through, _ = self._current(spark)
        cut = self.identity(spark)[1]
        delta = self._delta(spark, self.open_batches(spark, through))
        both = self._base(spark, by_gen).select(*POSITION).unionByName(delta.select(*POSITION))
        row = both.filter(F.col("_pos") > cut).agg(F.max(F.struct(*POSITION)).alias("p")).first()
        return tuple(row["p"]) if row["p"] else None

    def drop_superseded(self, spark: SparkSession) -> list[str]:
        """Delete files no reader of the current state opens: old bucket versions and folded batches.

        A reader that began before the last compaction may still have them open: call this once such readers are done.
        """
        by_gen, through, _ = self._current(spark)
        live = {f"_gen={g}/_bucket={b}" for g, buckets in by_gen.items() for b in buckets}
        old = []
        for gen in folders(spark, f"{self.path}/base"):
            parts = [f"{gen}/{b}" for b in folders(spark, f"{self.path}/base/{gen}")]
            old += [f"{self.path}/base/{p}" for p in parts if p not in live]
        for run in folders(spark, f"{self.path}/delta") if exists(spark, f"{self.path}/delta") else []:
            if run.startswith("_run="):
                name = run.split("=")[1]
                folded = through.get("" if name == "none" else name, -1)
                old += [f"{self.path}/delta/{run}/{b}" for b in folders(spark, f"{self.path}/delta/{run}") if int(b.split("=")[1]) <= folded]
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda path: remove(spark, path), old))
        return old
