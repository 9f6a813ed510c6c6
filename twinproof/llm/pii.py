"""Personal data: exact base kinds, and words of the corpus that give protected values away.

A base value (address, number) is a protected entity. The information a word ``t`` gives about an entity
``e`` is estimated over the whole corpus: ``n(e, t)`` is the number of different contexts of ``e`` that hold
``t``, ``df(t)`` the number of different texts with ``t``, and ``p(e|t) = min(1, n(e, t) / df(t))``. What is
left to learn about ``e`` once ``t`` is known is ``-log2 p(e|t)`` bits. A word that leaves at most
``remove_bits`` is removed wherever it stands, one that leaves at most ``generalise_bits`` is replaced by its
class. Exact copies of a text, and equal contexts, count once, so copies prove nothing. Words that stand near
an entity in fewer than ``min_contexts`` different contexts have no estimate.

Defined cases: NULL and empty texts have no spans and stay as they are; NULL ids and repeated rows are kept
row by row; an empty table gives an empty result; all other columns are carried unread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinproof.llm.spans import Kind, chunks, digest, find_spans, part
from twinproof.llm.tables import bind, content_address, written

_LOCAL = "A-Za-z0-9._%+-"
_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


KINDS = [
    Kind("email", rf"[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", begin=rf"(?<![{_LOCAL}])"),
    Kind("ip", r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", begin="(?<![0-9])", keep=lambda m: m.rlike(_OCTETS)),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", keep=lambda m: F.length(_digits(m)).between(16, 19) & F.call_function("luhn_check", _digits(m))),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", keep=lambda m: F.length(_digits(m)).between(8, 15)),
]
TERM_KINDS = ["generalise", "remove"]
TERM = Kind("term", r"[\p{L}\p{N}]{3,}+", begin=r"(?<![\p{L}\p{N}])")


@dataclass(frozen=True)
class Disclosure:
    """When a word counts as giving an entity away. ``reach`` is the context on each side in characters."""

    min_contexts: int = 3
    remove_bits: float = 0.5
    generalise_bits: float = 1.0
    reach: int = 120


def _terms(text: Column) -> Column:
    """Distinct words of at least three letters or digits, in lower case."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1)
    return F.array_distinct(F.filter(split, lambda w: F.length(w) >= 3))


def marked_texts(docs: DataFrame, text: str) -> DataFrame:
    """``(blob, content)`` of the different texts in which a base pattern occurs."""
    any_kind = F.lit(False)
    for k in KINDS:
        any_kind = any_kind | F.col(text).rlike(k.first)
    found = docs.where(any_kind).select(content_address(F.col(text)).alias("blob"), F.col(text).alias("content"))
    return found.groupBy("blob").agg(F.first("content").alias("content"))


def disclosing_terms(docs: DataFrame, text: str, marked: DataFrame, spans: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """``(term, kind)`` of the words that give an entity away.

    Words are counted over all different texts before they meet the candidates: what is shuffled is each task's
    vocabulary, whatever the number of candidates and however frequent a word.
    """
    value = F.when(F.col("kind") == "email", F.lower("match")).otherwise(_digits(F.col("match")))
    found = spans.groupBy("blob").agg(F.collect_list(F.struct("kind", value.alias("value"), "start", "end")).alias("found"))

    def near(pieces: Column) -> Column:
        before = lambda s: part(pieces, F.greatest(s["start"] - rule.reach, F.lit(0)), s["start"])
        behind = lambda s: part(pieces, s["end"], s["end"] + rule.reach)
        return F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["value"].alias("value"), F.array_sort(_terms(F.concat_ws(" ", before(s), behind(s)))).alias("terms")))

    contexts = found.join(marked, "blob").select(F.explode(bind(chunks(F.col("content")), near)).alias("c")).select("c.kind", "c.value", "c.terms").distinct()
    together = contexts.select("kind", "value", F.explode("terms").alias("term")).groupBy("kind", "value", "term").agg(F.count("*").alias("n"))
    candidates = written(together.where(F.col("n") >= rule.min_contexts).groupBy("term").agg(F.max("n").alias("n")), "pii-candidates")
    texts = docs.select(content_address(F.col(text)).alias("blob"), F.col(text).alias("content")).groupBy("blob").agg(F.first("content").alias("content"))
    df = texts.select(F.explode(_terms(F.col("content"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    bits = -F.log2(F.least(F.lit(1.0), F.col("n") / F.col("df")))
    kind = F.when(bits <= rule.remove_bits, "remove").when(bits <= rule.generalise_bits, "generalise")
    return df.join(candidates, "term").select("term", kind.alias("kind")).where(F.col("kind").isNotNull())


def _term_spans(docs: DataFrame, text: str, terms: DataFrame, spans: DataFrame) -> DataFrame:
    """Places of the given words, without those inside a base span."""
    every = docs.select(content_address(F.col(text)).alias("blob"), F.explode(_terms(F.col(text))).alias("term"))
    holds = written(every.join(terms, "term").distinct(), "pii-holders")
    texts = docs.select(content_address(F.col(text)).alias("blob"), F.col(text).alias("content"))
    texts = texts.join(holds.select("blob").distinct(), "blob", "left_semi").groupBy("blob").agg(F.first("content").alias("content"))
    found = find_spans(texts, "blob", "content", [TERM]).select("blob", F.lower("match").alias("term"), "start", "end", "match")
    found = found.join(holds, ["blob", "term"]).withColumn("rank", F.lit(len(KINDS)) + F.when(F.col("kind") == "remove", 1).otherwise(0))
    both = spans.select("blob", "kind", "rank", "start", "end", "match").unionByName(found.select("blob", "kind", "rank", "start", "end", "match"))
    before = Window.partitionBy("blob").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.max(F.when(F.col("rank") < len(KINDS), F.col("end"))).over(before)
    return both.withColumn("covered", F.coalesce(covered, F.lit(0))).where((F.col("rank") < len(KINDS)) | (F.col("start") >= F.col("covered"))).drop("covered")


def find_personal_data(docs: DataFrame, text: str = "text", rule: Disclosure = Disclosure()) -> DataFrame:
    """All spans ``(blob, kind, rank, start, end, match)`` per distinct text: base kinds first, then words that disclose."""
    marked = written(marked_texts(docs, text), "pii-marked")
    spans = written(find_spans(marked, "blob", "content", KINDS), "pii-base")
    terms = written(disclosing_terms(docs, text, marked, spans, rule), "pii-terms")
    return written(_term_spans(docs, text, terms, spans), "pii-spans")


def report(docs: DataFrame, spans: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Each row's ``keep`` columns with counts per base kind and the spans of its text, by kind and then start."""
    def of(rank: int) -> Column:
        return F.size(F.filter("all", lambda s: s["rank"] == rank))

    base = F.filter("all", lambda s: s["rank"] < len(KINDS))
    per = spans.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("rank", "start", "kind", "end"))).alias("all"))
    per = written(
        per.select("blob", digest(F.col("all")).alias("spans"), digest(base).alias("base"), *[of(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS)]),
        "pii-report",
    )
    rows = docs.select(*keep, content_address(F.col(text)).alias("blob")).join(per, "blob", "left")
    return rows.select(
        *keep,
        *[F.coalesce(f"n_{k.name}", F.lit(0)).cast("long").alias(f"n_{k.name}") for k in KINDS],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def sanitise(docs: DataFrame, spans: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced: base values and generalised words by their class, removed words by nothing.

    Spans that overlap are replaced as one, by the class of the first.
    """
    ahead = Window.partitionBy("blob").orderBy("start", "rank", "end").rowsBetween(Window.unboundedPreceding, -1)
    opens = F.col("start") >= F.coalesce(F.max("end").over(ahead), F.lit(0))
    joined = spans.withColumn("part", F.when(opens, 1).otherwise(0))
    joined = joined.withColumn("part", F.sum("part").over(Window.partitionBy("blob").orderBy("start", "rank", "end")))
    word = F.when(F.col("match").rlike(r"^\p{N}+$"), "[NUMBER]").when(F.col("match").rlike(r"^\p{Lu}"), "[NAME]").otherwise("[TERM]")
    label = F.when(F.col("kind") == "remove", "").when(F.col("kind") == "generalise", word).otherwise(F.concat(F.lit("["), F.upper("kind"), F.lit("]")))
    merged = joined.groupBy("blob", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by(label, F.struct("start", "rank", "end")).alias("label"))
    merged = merged.withColumn("from", F.coalesce(F.lag("end").over(Window.partitionBy("blob").orderBy("start")), F.lit(0)))
    edits = merged.groupBy(F.col("blob").alias("_blob")).agg(F.sort_array(F.collect_list(F.struct("start", "from", "end", "label"))).alias("_edits"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), content_address(F.col(text)).alias("_address"))
    # edits grow with the corpus, so they are shuffled and not broadcast; a text that fills a partition is a skewed key, which AQE splits
    rows = rows.join(written(edits, "pii-edits").hint("merge"), F.col("_address") == F.col("_blob"), "left")
    body = F.col("_row")[text]

    def rewritten(pieces: Column) -> Column:
        edits = F.transform("_edits", lambda e: F.concat(part(pieces, e["from"], e["start"]), e["label"]))
        return F.concat(F.array_join(edits, ""), part(pieces, F.element_at("_edits", -1)["end"], F.length(body).cast("long")))

    new = F.when(F.col("_edits").isNull(), body).otherwise(bind(chunks(body), rewritten))
    out = {c: F.col("_row")[c] for c in docs.columns} | {text: new}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("_edits").isNull(), out["n_chars"]).otherwise(F.length(new).cast(docs.schema["n_chars"].dataType))
    return rows.select(*[c.alias(n) for n, c in out.items()])
