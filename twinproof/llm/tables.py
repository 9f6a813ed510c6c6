"""Helpers that the operators share: words, content addresses, tables written in between."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinproof.session import work_dir

#: Word separators of the contracts: space, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+", -1), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once, however often it is used in there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def content_address(text: Column) -> Column:
    """SHA-256 of a text, the empty one for NULL."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def row_key(*columns: str) -> Column:
    """One never-NULL text that is equal for rows equal in ``columns``, NULLs included."""
    parts = [F.coalesce(F.sha2(F.col(c).cast("string"), 256), F.lit("-")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


#: Setting by which shuffle files go when their query has ended, not when the driver happens to collect its garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def clean_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run in here leave no shuffle files."""
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows through a table in the shared folder: lineage ends there, shuffle files go, and plans see the true size."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    with clean_shuffles(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    for inside in _PASSING.get():
        inside.append(out)
    return out


#: The tables written so far in each :func:`passing_tables` around.
_PASSING: ContextVar[tuple[list[DataFrame], ...]] = ContextVar("passing", default=())


def dropped(*tables: DataFrame) -> None:
    """Removes tables that ``written`` returned and nothing reads any more; other frames are left alone."""
    for df in tables:
        if folder := vars(df).pop("_written_to", None):
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def passing_tables() -> Iterator[list[DataFrame]]:
    """Tables written in here go at the end, but those put into the list that is yielded."""
    inside, keep = [], []
    token = _PASSING.set((*_PASSING.get(), inside))
    try:
        yield keep
    finally:
        _PASSING.reset(token)
        dropped(*(df for df in inside if not any(df is k for k in keep)))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the rows whose labels no model sees: crc32 of the id as text leaves no remainder. A NULL id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))
