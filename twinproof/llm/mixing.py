"""Mixing sources to target sizes by repeating whole documents.

Tokens are summed per source, in partial sums before the shuffle. Each source gets a share of the mix by weight,
but never more than ``most`` times its own size; what it cannot take is shared out again by weight until none is
above. A source's rate is target over size; a document is taken ``floor(rate)`` times, plus once more if a number
in [0, 1) made from its id is below the fraction. The number depends on nothing else, so reruns agree.

Defined cases: a NULL text has size zero; the NULL source is one source and comes last; a NULL id draws by its
text; repeated rows draw alike; sources of size zero have target zero; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinproof.llm.tables import WORD, content_address, written

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of seed and id."""
    ident = F.coalesce(doc_id.cast("string"), content_address(text))
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), ident)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    In order of cap per weight the sources that stop at their cap come first. With those before a source stopped,
    the others are filled to the level ``rest / weight of the others``; the first source that stays below its cap at
    its level gives the level of all that follow. One row per source goes through these windows, never documents.
    """
    by_name, by_cap = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("ratio", "at")
    ranked = totals.withColumn("at", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    rows = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rest = F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = rest / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("level", level)
    final = F.min_by(F.when(F.col("ratio") > F.col("level"), F.col("level")), F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "at"))).over(every)
    target = F.least(F.col("cap").cast("double"), F.coalesce(final * F.col("weight"), F.col("cap").cast("double")))
    return rows.select("source", "source_size", target.alias("target"))


def rates(sized: DataFrame) -> DataFrame:
    """``(source, source_size, target, rate)`` from ``(source, size)`` of all documents."""
    totals = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-totals")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return written(targets(totals).withColumn("rate", rate), "mix-rates")


def copies(rate: Column, number: Column) -> Column:
    return (F.floor(rate) + F.when(number < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def mix_report(docs: DataFrame, seed: str = "mix", doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, size, source_size, target, taken``."""
    sized = written(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size_of(F.col(text)).alias("size"), draw(F.col(doc_id), F.col(text), seed).alias("number")), "mix-sizes")
    rate = rates(sized)
    joined = sized.alias("d").join(rate.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("rate"), F.col("number"))).cast("long").alias("taken"))


def mix(docs: DataFrame, seed: str = "mix", doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, numbered from 1 by ``copy_no``."""
    sized = docs.select(F.col(source).alias("source"), size_of(F.col(text)).alias("size"))
    rate = rates(sized).select(F.col("source").alias("_source"), F.col("rate").alias("_rate"))
    packed = docs.select(F.struct(*[c for c in docs.columns if c != "copy_no"]).alias("_row"), F.col(source).alias("_from"), draw(F.col(doc_id), F.col(text), seed).alias("_number"))
    drawn = packed.join(rate, F.col("_from").eqNullSafe(F.col("_source"))).withColumn("_copies", copies(F.col("_rate"), F.col("_number")))
    taken = drawn.where("_copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_no"))
    return taken.select("_row.*", F.col("_no").alias("copy_no"))
