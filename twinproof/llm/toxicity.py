"""Toxicity by a weighted lexicon.

Texts are folded first: accents off, look-alike letters of other scripts to Latin, digits and signs inside words to
the letters they stand for, then letters and digits only, single spaces, lower case. The lexicon holds whole words
and beginnings of words, learned from labelled texts and weighted by log odds. All of them are found in one pass by
an Aho-Corasick automaton; exception phrases are in the same automaton and excuse the words inside them. What a
text scores is the weight of its words, by itself and by length, through a fitted logistic curve.

The lexicon is learned on one part of the labelled rows, the curve on the other. ``LABELLED`` bounds the labelled
rows used; they are those with the smallest hash of the id. A word counts once per different word before it, so
copies of a text are one witness.

Defined cases: NULL and empty texts score like texts without a hit; NULL ids are held out and scored; repeated rows
score alike; labels for unknown ids are ignored; without labels of both kinds the score is the base rate, or one
half without any; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from twinproof.llm.tables import content_address, held_out, written

LABELLED = 20_000

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁһԛԝкмтвнгп", "aeopcyxijsdhqwkmtbhrn")) | dict(zip("αβεικνορτυχγηω", "abeiknoptuxynw")) | {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ı": "i", "ł": "l"}
#: Digits and signs that stand for letters inside words.
SIGNS = dict(zip("0134578@$!|+", "oieastbasilt"))

_FOLD = str.maketrans(HOMOGLYPHS)
_SIGN = str.maketrans(SIGNS)
_MARKS = re.compile("[̀-ͯ­​-‏⁠﻿]+")
_MIXED = re.compile(r"[a-z0-9@$!|+]*(?:[a-z][0-9@$!|+]|[0-9@$!|+][a-z])[a-z0-9@$!|+]*")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str | None) -> str:
    """The folded text, with a space before and after every word."""
    text = (text or "").lower()
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text)).lower()
        if not text.isascii():
            text = text.translate(_FOLD)
    text = _MIXED.sub(lambda m: m[0].rstrip("!$@|+").lstrip("!|+").translate(_SIGN), text)
    return " " + " ".join(_WORD.findall(text)) + " "


@dataclass(frozen=True)
class Lexicon:
    """Weights of words (``" word "``) and beginnings (``" begin"``), phrases that excuse, and the curve."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def automaton(self):
        found = ahocorasick.Automaton()
        for p, w in self.weights.items():
            found.add_word(p, (len(p), w))
        for p in self.exceptions:
            found.add_word(p, (len(p), None))
        if len(found):
            found.make_automaton()
        return found


def hits(folded: str, automaton) -> list[tuple[int, int, float]]:
    """``(start, end, weight)`` per word that is hit, at its heaviest pattern; words inside an exception left out."""
    best: dict[int, tuple[int, float]] = {}
    excused: list[tuple[int, int]] = []
    for end, (size, weight) in automaton.iter(folded) if len(automaton) else ():
        start = end - size + 1
        if weight is None:
            excused.append((start, end))
        elif weight > best.get(start, (0, 0.0))[1]:
            best[start] = (end, weight)
    out, k, reach = [], 0, -1
    excused.sort()
    for start, (end, weight) in sorted(best.items()):
        while k < len(excused) and excused[k][0] <= start:
            reach = max(reach, excused[k][1])
            k += 1
        if reach <= start:
            out.append((start, end, weight))
    return out


def features(folded: str, automaton) -> tuple[float, float]:
    """The weight of a text's hits, by itself and per hundred words, both dampened."""
    total = sum(w for _, _, w in hits(folded, automaton))
    return math.log1p(total), math.log1p(100 * total / max(1, folded.count(" ") - 1))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[float, ...]:
    """Logistic regression with a bias, by Newton steps; negative slopes are set to zero and the rest fitted again."""
    use = list(range(x.shape[1]))
    while True:
        z = np.column_stack([np.ones(len(x)), x[:, use]])
        beta = np.zeros(z.shape[1])
        pull = np.diag([1e-3] + [ridge] * len(use))
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + pull, z.T @ (y - p) - pull @ beta)
            beta += step
            if np.abs(step).max() < 1e-9:
                break
        bad = [u for u, b in zip(use, beta[1:]) if b < 0]
        if not bad:
            break
        use = [u for u in use if u not in bad]
    out = np.zeros(x.shape[1] + 1)
    out[0] = beta[0]
    out[[u + 1 for u in use]] = beta[1:]
    return tuple(float(b) for b in out)


def _spots(rows: DataFrame, excused: frozenset[str] = frozenset()) -> DataFrame:
    """``(toxic, word, before)`` of each text's different words, at their first place outside an excused phrase."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic, word, before = [], [], []
            for label, text in zip(batch["toxic"], batch["text"]):
                words, seen = ["", *fold(text).split(), ""], set()
                for last, w, after in zip(words, words[1:], words[2:]):
                    if w not in seen and f" {last} {w} " not in excused and f" {w} {after} " not in excused:
                        seen.add(w)
                        toxic.append(label)
                        word.append(w)
                        before.append(last)
            yield pd.DataFrame({"toxic": np.array(toxic, "int32"), "word": word, "before": before})

    return rows.mapInPandas(cut, "toxic int, word string, before string")


def _log_odds(t, c, n_t: float, n_c: float):
    return F.log((t + 0.5) / (n_t + 1)) - F.log((c + 0.5) / (n_c + 1))


#: Least log odds and least G statistic of a pattern: to be suspected, and to be in the lexicon.
SUSPECT, SURE = (0.5, 6.0), (1.0, 18.0)


def _weights(spots: DataFrame, n_toxic: int, n_clean: int, least: tuple[float, float] = SURE) -> dict[str, float]:
    """All patterns with enough evidence, at least three witnesses each. The labelled rows bound their number."""
    seen = spots.distinct().groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    begins = F.transform(F.sequence(F.lit(4), F.lit(9)), lambda k: F.concat(F.lit(" "), F.substring("word", F.lit(1), k)))
    longer = F.filter(begins, lambda p: F.length(p) <= F.length("word"))
    patterns = F.concat(F.array(F.concat(F.lit(" "), "word", F.lit(" "))), longer)
    long_word = F.when(F.length("word") > 4, patterns).otherwise(F.array(F.concat(F.lit(" "), "word", F.lit(" "))))
    counts = seen.where(F.length("word") >= 3).select(F.explode(long_word).alias("pattern"), "t", "c").groupBy("pattern").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    share = n_toxic / (n_toxic + n_clean)
    part = lambda n, p: F.when(n > 0, n * F.log(n / ((F.col("t") + F.col("c")) * p))).otherwise(0.0)
    g = 2 * (part(F.col("t"), share) + part(F.col("c"), 1 - share))
    weight = _log_odds(F.col("t"), F.col("c"), n_toxic, n_clean)
    chosen = counts.select("pattern", weight.alias("w"), g.alias("g"), "t").where((F.col("t") >= 3) & (F.col("w") > least[0]) & (F.col("g") > least[1]))
    return {r.pattern: r.w for r in chosen.orderBy(F.desc("g"), "pattern").collect()}


def _exceptions(rows: DataFrame, lexicon: Lexicon) -> tuple[str, ...]:
    """Pairs of a hit word and a neighbour that clean texts have in three different surroundings, and toxic ones never.

    A pair must make up a tenth of the word's places in clean texts: what excuses a word is the usual way to use it.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for batch in batches:
            out = []
            for label, text in zip(batch["toxic"], batch["text"]):
                folded = fold(text)
                for start, _, _ in hits(folded, automaton):
                    stop = folded.index(" ", start + 1)
                    back = folded.rfind(" ", 0, start) if start > 0 else -1
                    on = folded.find(" ", stop + 1)
                    far = folded.rfind(" ", 0, back) if back > 0 else -1
                    after = folded.find(" ", on + 1) if on > 0 else -1
                    word = folded[start + 1 : stop]
                    if back >= 0:
                        out.append((label, word, folded[back : stop + 1], folded[far + 1 : back] if far >= 0 else ""))
                    if on > 0:
                        out.append((label, word, folded[start : on + 1], folded[on + 1 : after] if after > 0 else ""))
            yield pd.DataFrame(out, columns=["toxic", "word", "phrase", "near"]).astype({"toxic": "int32"})

    seen = rows.mapInPandas(cut, "toxic int, word string, phrase string, near string").distinct()
    counts = seen.groupBy("word", "phrase").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    words = counts.groupBy("word").agg(F.sum("c").alias("all"))
    counts = counts.join(words, "word").where("t = 0 AND c >= 3 AND 20 * c >= all")  # two pairs a place
    return tuple(r.phrase for r in counts.orderBy(F.desc("c"), "phrase").collect())


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", labelled: int = LABELLED) -> Lexicon:
    """A lexicon from the rows that are not held out."""
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id")
    known = written(known.orderBy(order, "doc_id").limit(labelled), "toxic-labels")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(known, "doc_id")
    rows = rows.groupBy(content_address(F.col("text")).alias("blob")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = written(rows, "toxic-texts")
    # by content, so that a copy is on one side
    fit = F.conv(F.substring("blob", 1, 4), 16, 10).cast("int") % 10 < 3
    base = {r.toxic: r.n for r in rows.where(~fit).groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    flat = math.log((n.get(1, 0) + 0.5) / (n.get(0, 0) + 0.5))
    if not base.get(1) or not base.get(0):
        return Lexicon(curve=(flat, 0.0, 0.0))
    suspects = Lexicon(_weights(_spots(rows.where(~fit)), base[1], base[0], SUSPECT))
    excused = _exceptions(rows.where(~fit), suspects)
    # what a word weighs where nothing excuses it
    lexicon = Lexicon(_weights(_spots(rows.where(~fit), frozenset(excused)), base[1], base[0]), excused)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for batch in batches:
            both = [features(fold(t), automaton) for t in batch["text"]]
            yield pd.DataFrame({"a": [b[0] for b in both], "b": [b[1] for b in both], "toxic": batch["toxic"]})

    points = rows.where(fit).select("text", "toxic").mapInPandas(measure, "a double, b double, toxic int").toPandas()
    if points["toxic"].nunique() < 2:
        return Lexicon(lexicon.weights, lexicon.exceptions, (flat, 1.0, 0.0))
    return Lexicon(lexicon.weights, lexicon.exceptions, _logistic(points[["a", "b"]].to_numpy(float), points["toxic"].to_numpy(float)))


def score(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row; the score comes from the text alone."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = lexicon.automaton()
        bias, a, b = lexicon.curve
        for batch in batches:
            raw = np.array([bias + a * x + b * y for x, y in (features(fold(t), automaton) for t in batch)], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(raw, -30, 30))))

    value = F.pandas_udf(of, DoubleType())(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), value.alias("score"))
    return rows.select("*", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
