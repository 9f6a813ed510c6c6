"""Quality rules as a short-circuit cascade.

Base numbers of a text (words, symbols, repeated lines, words in repeated windows) are built-in expressions on
one row; nothing is shuffled. The rules on top of them are conjunctive: a text is kept if none rejects it, so
their order changes the cost and never the result. On a sample each rule is timed and its rejections counted;
rules then run by rejections per second, and evaluation ends at the first that rejects.

Defined cases: NULL and empty texts have no words and fail the base; repeated rows are judged alike; an empty
table has no sample, and the rules keep the order they are listed in; other columns are carried unread.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinproof.llm.tables import SPACE, bind, words, written

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"


def _repeated_windows(sorted_windows: Column) -> Column:
    """Ascending starts of the windows that occur twice or more; windows come sorted as (hash, start)."""

    def start(w: Column, i: Column) -> Column:
        same = (F.get(sorted_windows, i - 1)["v"] == w["v"]) | (F.get(sorted_windows, i + 1)["v"] == w["v"])
        return F.when(same, w["i"])

    return F.sort_array(F.filter(F.transform(sorted_windows, start), lambda i: i.isNotNull()))


def _covered(starts: Column) -> Column:
    """Words under the windows at these starts, each once."""
    zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))

    def add(acc: Column, i: Column) -> Column:
        return F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"))

    return F.aggregate(starts, zero, add, lambda acc: acc["n"])


def _repeat_words(tokens: Column) -> Column:
    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    last = F.size(tokens) - WINDOW

    def count(windows: Column) -> Column:
        places = F.sort_array(F.transform(windows, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
        repeats = bind(places, lambda s: _covered(_repeated_windows(s)))
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), repeats).otherwise(F.lit(0))

    windows = bind(hashes, lambda h: F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(h, i, WINDOW))))
    return F.when(last >= 1, bind(windows, count)).otherwise(F.lit(0))


def base_numbers(text: Column) -> Column:
    """Struct of ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(f"[^{SPACE[1:-1]}]"))

    def numbers(tokens: Column) -> Column:
        return F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.regexp_replace(body, SYMBOLS + "+", ""))).cast("long").alias("n_symbols"),
            bind(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            _repeat_words(tokens).cast("long").alias("n_repeat_words"),
        )

    return bind(words(body), numbers)


def base_failed(n: Callable[[str], Column]) -> Column:
    return (n("n_words") < 20) | (100 * n("n_repeat_words") > 30 * n("n_words"))


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a condition on the columns of :func:`measured` and the text, never NULL."""

    name: str
    rejects: Column


def rules(text: str = "text") -> list[Rule]:
    body, n = F.coalesce(F.col(text), F.lit("")), F.col
    letters = F.length(F.regexp_replace(body, r"\P{L}+", ""))
    capitals = F.length(F.regexp_replace(body, r"\P{Lu}+", ""))
    lines = F.size(F.split(body, "\n", -1))
    return [
        Rule("symbols", n("n_symbols") * 5 > n("n_words")),
        Rule("word_length", ~n("word_chars").between(2 * n("n_words"), 20 * n("n_words"))),
        Rule("repeated_lines", n("n_dup_lines") * 10 > 3 * lines),
        Rule("capitals", capitals * 2 > letters),
        Rule("exclamations", F.regexp_count(body, F.lit("!")) * 5 > n("n_words")),
    ]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base numbers as columns."""
    with_base = docs.withColumn("_base", base_numbers(F.col(text)))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return with_base.select(*[c for c in docs.columns if c not in names], *[F.col(f"_base.{x}").alias(x) for x in names])


def ordered(docs: DataFrame, listed: list[Rule], sample_rows: int = 2000, seed: int = 11) -> list[Rule]:
    """The rules by rejections per second on a sample of about ``sample_rows`` rows; best first, ties as listed."""
    sample = written(measured(docs.sample(min(1.0, sample_rows / max(1, docs.count())), seed)), "rule-sample")
    value = {}
    for rule in listed:
        begun = time.perf_counter()
        rejected = sample.agg(F.count_if(rule.rejects)).first()[0]
        value[rule.name] = rejected / max(time.perf_counter() - begun, 1e-6)
    return sorted(listed, key=lambda r: -value[r.name])


def cascade(listed: list[Rule]) -> Column:
    """Name of the first rule that rejects, else NULL; later rules are not evaluated."""
    first = F.lit(None).cast("string")
    for rule in reversed(listed):
        first = F.when(rule.rejects, F.lit(rule.name)).otherwise(first)
    return first


def judge(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Per row: ``keep``, the base numbers, ``base_failed``, and ``kept`` by base and cascade."""
    slim = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("text"))
    numbers = measured(slim)
    order = ordered(slim.select("text"), rules())
    failed = base_failed(F.col)
    return numbers.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        F.when(failed, False).otherwise(cascade(order).isNull()).alias("kept"),
    )
