"""Exact spans of patterns in whole texts, with built-in functions only.

``regexp_extract_all`` gives matches but no places. Each pattern is therefore run as *gap, match* pairs
chained by ``\\G``: the lengths of what came before add up to the place. The pairs of a text become rows
and a window sums them, so the work stays in proportion to the text, however many matches it has.
Patterns are written so that no start inside a run is tried twice (lookbehind and possessive repeats),
which keeps very long runs linear and the matcher free of recursion.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """A pattern, how a match starts when none came before it (``begin``), and which matches count (``keep``)."""

    name: str
    pattern: str
    begin: str = ""
    keep: Callable[[Column], Column] | None = None
    version: int = 1

    @property
    def first(self) -> str:
        """Finds out whether a text has any match."""
        return f"{self.begin}(?:{self.pattern})"

    @property
    def chained(self) -> str:
        start = rf"(?:\G|{self.begin})" if self.begin else ""
        return rf"(?s)\G(.*?)({start}{self.pattern})"


def _pairs(text: Column, kind: Kind) -> Column:
    chained = F.lit(kind.chained)
    both = F.arrays_zip(F.regexp_extract_all(text, chained, 1).alias("gap"), F.regexp_extract_all(text, chained, 2).alias("match"))
    pairs = F.transform(both, lambda p: F.struct(F.length(p["gap"]).cast("long").alias("gap"), p["match"].alias("match")))
    return F.when(text.rlike(kind.first), pairs)


def find_spans(texts: DataFrame, key: str, text: str, kinds: list[Kind], skip: str | None = None) -> DataFrame:
    """Rows ``(key, kind, rank, start, end, match)`` of all matches that count; code points, end exclusive.

    ``key`` is unique and not NULL, ``rank`` is the kind's place in the list. A NULL or empty text has none.
    ``skip`` names an array column with the kinds that need no run on that text.
    """

    def run(i: int, k: Kind) -> Column:
        pairs = _pairs(F.col(text), k)
        pairs = F.when(~F.array_contains(skip, k.name), pairs) if skip else pairs
        return F.struct(F.lit(k.name).alias("kind"), F.lit(i).alias("rank"), pairs.alias("pairs"))

    each = F.array(*[run(i, k) for i, k in enumerate(kinds)])
    runs = texts.select(F.col(key), F.explode(F.filter(each, lambda e: e["pairs"].isNotNull())).alias("e"))
    rows = runs.select(key, "e.kind", "e.rank", F.posexplode("e.pairs").alias("i", "p")).select(key, "kind", "rank", "i", "p.gap", "p.match")
    upto = Window.partitionBy(key, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("match").cast("long")
    rows = rows.withColumn("end", F.sum(F.col("gap") + size).over(upto))
    counts = F.lit(True)
    for k in kinds:
        if k.keep:
            counts = F.when(F.col("kind") == k.name, k.keep(F.col("match"))).otherwise(counts)
    return rows.where(counts).select(key, "kind", "rank", (F.col("end") - size).alias("start"), "end", "match")


def digest(spans: Column) -> Column:
    """``kind:start:end`` of structs already in order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


PIECE = 4096


def chunks(text: Column) -> Column:
    """A text in pieces of ``PIECE`` code points, so that a place far inside is found without counting from the start."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))


def part(pieces: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of a text that was cut by :func:`chunks`; empty when there are none."""
    first, last = F.floor(start / PIECE).cast("int"), F.floor(end / PIECE).cast("int")
    at = lambda p, a, n: F.substring(F.coalesce(F.get(pieces, p), F.lit("")), a, n)
    head, left = (start % PIECE).cast("int"), (end % PIECE).cast("int")
    one = at(first, head + 1, (end - start).cast("int"))
    inner = F.when(last - first > 1, F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")).otherwise("")
    many = F.concat(at(first, head + 1, F.lit(PIECE)), inner, at(last, F.lit(1), left))
    return F.when(end <= start, "").when(first == last, one).otherwise(many)
