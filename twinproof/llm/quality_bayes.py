"""Quality by hierarchical empirical Bayes.

A document's own evidence is a log likelihood ratio of binned text features, counted per class in one grouped
aggregation over the labelled rows and made a calibrated log odds by a curve fitted on counts. What is known of the place it
comes from is a chain of beta posteriors: host shrinks towards the global share, path within the host towards the
host. The strength of each level's prior is estimated from how much the places below it differ (method of
moments), so sparse places stay near their parent. Evidence and place are added as log odds.

Only rows that are not held out give labels. Places are counted in partial sums; a hot host is one row per task.

Defined cases: NULL and empty texts have the features of a text without words; NULL hosts and paths are places of
their own; NULL ids are held out; repeated rows are judged alike; labels for unknown ids are ignored; places without
labels take their parent's posterior; without labels of both kinds all is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinproof.llm.tables import bind, held_out, words, written

#: Upper ends of the bins of each feature; the last bin is open.
BINS = {
    "symbols": (0.0, 0.02, 0.1, 0.3, 1.0, 2.0),
    "capitals": (0.02, 0.05, 0.1, 0.2, 0.5),
    "marks": (0.0, 0.02, 0.1, 0.3, 0.8),
    "variety": (0.05, 0.15, 0.3, 0.5, 0.7, 0.9),
    "repeats": (0.0, 0.01, 0.05, 0.2, 0.5),
    "word_length": (3.0, 4.0, 5.0, 6.0, 8.0, 12.0),
    "lines": (0.3, 0.6, 0.9, 0.999),
    "sentence": (3.0, 8.0, 15.0, 40.0, 120.0),
}
#: A place needs this many labels before its share tells anything of the spread between places.
LEAST = 2
#: Bounds of a prior's strength, in labels.
WEAK, STRONG = 1.0, 10_000.0


def features(text: Column) -> Column:
    """Ratios per word, letter or line, each with a few usual ones added, so that very short texts are no extremes."""
    body = F.coalesce(text, F.lit(""))
    count = lambda pattern: F.regexp_count(body, F.lit(pattern))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x != "")

    def of_words(tokens: Column) -> Column:
        again = F.zip_with(tokens, F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(0))), lambda a, b: a == b)
        return F.struct(
            F.size(tokens).alias("n"),
            F.length(F.array_join(tokens, "")).alias("chars"),
            F.size(F.array_distinct(tokens)).alias("different"),
            F.size(F.filter(again, lambda x: x)).alias("again"),
        )

    def ratios(w: Column) -> Column:
        n = w["n"]
        out = {
            "symbols": count(r"[#*$%&|<>]") / (n + 5),
            "capitals": count(r"\p{Lu}") / (count(r"\p{L}") + 20),
            "marks": count("!") / (n + 5),
            "variety": (w["different"] + 5) / (n + 5),
            "repeats": w["again"] / (n + 5),
            "word_length": (w["chars"] + 25) / (n + 5),
            "lines": (F.size(F.array_distinct(lines)) + 2) / (F.size(lines) + 2),
            "sentence": (n + 10) / (count(r"[.!?](?:\s|$)") + 1),
        }
        return F.struct(*[v.cast("double").alias(k) for k, v in out.items()])

    return bind(bind(words(body), of_words), ratios)


def _bin(value: Column, ends: tuple[float, ...]) -> Column:
    out = F.lit(len(ends))
    for i in range(len(ends) - 1, -1, -1):
        out = F.when(value <= ends[i], i).otherwise(out)
    return out


@dataclass(frozen=True)
class Model:
    """Log likelihood ratios per feature and bin, the curve ``slope * evidence + bias``, and the log odds of a good document."""

    ratios: dict[tuple[str, int], float]
    slope: float = 1.0
    bias: float = 0.0
    prior: float = 0.0

    def evidence(self, bins: dict[str, Column]) -> Column:
        total = F.lit(0.0)
        for name, b in bins.items():
            table = F.array(*[F.lit(float(self.ratios.get((name, i), 0.0))) for i in range(len(BINS[name]) + 1)])
            total = total + F.get(table, b)
        return total


def binned(docs: DataFrame, keep: dict[str, Column], text: Column) -> DataFrame:
    """The ``keep`` columns and one bin per feature."""
    raw = docs.select(*[c.alias(k) for k, c in keep.items()], features(text).alias("_features"))
    return raw.select(*keep, *[_bin(F.col("_features")[k], ends).alias(f"b_{k}") for k, ends in BINS.items()])


def _bins() -> dict[str, Column]:
    return {k: F.col(f"b_{k}") for k in BINS}


def fit(labelled: DataFrame) -> Model:
    """From binned rows with ``good`` 0 or 1. What reaches the driver is a row per feature, bin and class."""
    pairs = F.array(*[F.struct(F.lit(k).alias("name"), b.alias("bin")) for k, b in _bins().items()])
    rows = labelled.select("good", F.explode(pairs).alias("p")).groupBy("p.name", "p.bin", "good").agg(F.count("*").alias("n")).collect()
    n = {(r.name, r.bin, r.good): r.n for r in rows}
    first = next(iter(BINS))
    size = {g: sum(v for (name, _, good), v in n.items() if name == first and good == g) for g in (0, 1)}
    if not size[0] or not size[1]:
        return Model({}, prior=4.0)
    ratios = {}
    for name, ends in BINS.items():
        for i in range(len(ends) + 1):
            p = [(n.get((name, i, g), 0) + 0.5) / (size[g] + 0.5 * (len(ends) + 1)) for g in (0, 1)]
            ratios[name, i] = math.log(p[1] / p[0])
    prior = math.log(size[1] / size[0])
    raw = Model(ratios)
    steps = labelled.select("good", F.round(raw.evidence(_bins()) * 2).alias("e")).groupBy("e", "good").agg(F.count("*").alias("n")).collect()
    slope, bias = _curve(np.array([(r.e / 2, r.good, r.n) for r in steps], float), prior)
    return Model(ratios, slope, bias, prior)


def _curve(points: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and bias of weighted logistic regression on (evidence, label, count); features that repeat each other lower the slope."""
    x, y, n = points.T
    z = np.column_stack([x, np.ones(len(x))])
    beta, start = np.array([1.0, prior]), np.array([0.5, prior])
    pull = np.diag([1.0, 0.1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (n * p * (1 - p))[:, None]).T @ z + pull, z.T @ (n * (y - p)) - pull @ (beta - start))
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 0.05)), float(beta[1] - prior)


def _strength(places: DataFrame, mean: Column) -> float:
    """Labels that the prior above ``places(good, n)`` is worth, from the spread of their shares (method of moments)."""
    row = (
        places.where(F.col("n") >= LEAST)
        .select("n", (F.col("good") - F.col("n") * mean).alias("d"), (mean * (1 - mean)).alias("v"))
        .agg(F.sum(F.col("d") * F.col("d") - F.col("n") * F.col("v")).alias("over"), F.sum(F.col("n") * (F.col("n") - 1) * F.col("v")).alias("room"))
        .first()
    )
    if not row.room or row.over is None or row.over <= 0:
        return STRONG
    rho = min(row.over / row.room, 1.0)  # correlation of two labels of one place
    return min(max(1 / rho - 1, WEAK), STRONG)


def posteriors(labelled: DataFrame, prior: float) -> DataFrame:
    """``(host, path, host_share, path_share)`` of the places with labels, shrunk towards their parents."""
    share = 1 / (1 + math.exp(-prior))
    paths = written(labelled.groupBy("host", "path").agg(F.sum("good").alias("good"), F.count("*").alias("n")), "places")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    k = _strength(hosts, F.lit(share))
    hosts = written(hosts.select("host", ((F.col("good") + k * share) / (F.col("n") + k)).alias("host_share")), "hosts")
    both = paths.alias("p").join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host"))).select("p.host", "p.path", "p.good", "p.n", "h.host_share")
    k = _strength(both, F.col("host_share"))
    return written(both.select("host", "path", "host_share", ((F.col("good") + k * F.col("host_share")) / (F.col("n") + k)).alias("path_share")), "posteriors")


def _with_labels(docs: DataFrame, labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("long").alias("good")).where("doc_id IS NOT NULL AND good IN (0, 1)")
    return docs.join(known.groupBy("doc_id").agg(F.min("good").alias("good")), "doc_id")


def _log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang", label: str = "quality") -> DataFrame:
    """Per row: ``doc_id, held_out, evidence, host_posterior, path_posterior, score, kept``."""
    keep = {"doc_id": F.col(doc_id), "host": F.col(host).cast("string"), "path": F.col(path).cast("string")}
    rows = written(binned(docs, keep, F.col(text)), "quality-bins")
    model, places = _learn(rows, labels, doc_id, label)
    return _scored(rows, model, places).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "evidence", "host_posterior", "path_posterior", "score", (F.col("score") >= 0.5).alias("kept"))


def _learn(rows: DataFrame, labels: DataFrame, doc_id: str, label: str) -> tuple[Model, DataFrame]:
    labelled = written(_with_labels(rows, labels, doc_id, label).where(~held_out(F.col("doc_id"))), "quality-labelled")
    model = fit(labelled)
    return model, posteriors(labelled, model.prior)


def _scored(rows: DataFrame, model: Model, places: DataFrame) -> DataFrame:
    share = 1 / (1 + math.exp(-model.prior))
    hosts = places.select(F.col("host").alias("_host"), F.col("host_share").alias("_host_share")).distinct()
    exact = places.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "path_share")
    at_host = F.col("host").eqNullSafe(F.col("_host"))
    at_path = F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p"))
    joined = rows.join(hosts, at_host, "left").join(exact, at_path, "left")
    joined = joined.withColumn("host_posterior", F.coalesce("_host_share", F.lit(share)))
    joined = joined.withColumn("path_posterior", F.coalesce("path_share", "host_posterior"))
    joined = joined.withColumn("evidence", F.lit(model.slope) * model.evidence(_bins()) + F.lit(model.bias))
    odds = F.col("evidence") + _log_odds(F.col("path_posterior"))
    return joined.withColumn("score", 1 / (1 + F.exp(-odds)))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", path: str = "lang", label: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns unchanged."""
    named = {"doc_id": F.col(doc_id), "host": F.col(host).cast("string"), "path": F.col(path).cast("string")}
    model, places = _learn(binned(docs, named, F.col(text)), labels, doc_id, label)
    packed = docs.select(F.struct(*docs.columns).alias("_row"))
    at = lambda c: F.col("_row")[c]
    keys = {"_row": F.col("_row"), "host": at(host).cast("string"), "path": at(path).cast("string")}
    return _scored(binned(packed, keys, at(text)), model, places).where(F.col("score") >= 0.5).select("_row.*")
