"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of letters, digits and underscores. For each candidate pair of a text and a benchmark item,
running Karp-Rabin finds the longest matches of unmarked words, marks them on both sides, and goes on with shorter ones
down to ``TILE`` words. Tiles may stand in any order, so a passage whose sentences were moved is covered too. A
text is contaminated by an item if tiles cover at least ``COVERAGE`` of the item's words.

Candidates come from seeds of ``TILE`` words, the shortest that a tile can be (an item shorter than that is its own seed), so
none is missed. Every tiled word lies in a seed that both sides have. Taken from the commonest on, seeds of an item
are set aside while all their words together are too few to make a leak; a text that leaks the item must have one of the others,
its *gates*. How often a seed occurs is counted over all texts. Pairs that share a gate are tiled if the words of
all their shared seeds are enough.

Tasks get the seeds of the benchmark as a bit set with two places per seed and 32 bits for each, at most ``FILTER_BITS`` in all.
A fuller set lets more words through, which the join on seeds then drops: same result. What is shuffled
are the stretches of a text that pass. Equal texts are judged once.

Defined cases: NULL and empty texts and items match nothing; NULL ids and repeated rows are kept row by row;
an empty table on either side gives an empty result; other columns are carried unread.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinproof.llm.tables import content_address, written

TILE, COVERAGE, FILTER_BITS = 3, 0.8, 1 << 28
_WORD = re.compile(r"\w+")
_BASE, _MOD = 1_000_003, (1 << 61) - 1


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class WordHashes(dict):
    """64-bit hash per word. What was looked up is kept, up to ``most`` words."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter((self[w] for w in words), np.uint64, len(words))


def seeds(hashes: np.ndarray, length: int) -> np.ndarray:
    """Unsigned 64-bit hashes of all runs of ``length`` words, by their place."""
    count = max(0, len(hashes) - length + 1)
    value = np.full(count, length, np.uint64)
    for i in range(length):
        value = (value ^ (value >> np.uint64(31))) * _MIX + hashes[i : i + count]
    value = (value ^ (value >> np.uint64(29))) * _MIX
    return value ^ (value >> np.uint64(32))


_MIX = np.uint64(0x9E3779B97F4A7C15)


def enough(words: int, least: float) -> int:
    """The smallest number of covered words that makes a leak of an item with so many words."""
    need = math.ceil(least * words)
    while need > 0 and (need - 1) / words >= least:
        need -= 1
    return need


def gates(found: np.ndarray, often: np.ndarray, length: int, need: int) -> set[int]:
    """Seeds of an item, given by place, of which a text has at least one if ``need`` words of the item are in shared seeds."""
    places = defaultdict(list)
    for i, h in enumerate(found.tolist()):
        places[h].append(i)
    count = dict(zip(found.tolist(), often.tolist()))
    aside, size, chosen = np.zeros(len(found) + length - 1, bool), 0, set()
    for h in sorted(places, key=lambda h: (-count[h], h)):
        words = {i + j for i in places[h] for j in range(length)}
        new = [i for i in words if not aside[i]]
        if size + len(new) < need:
            aside[new] = True
            size += len(new)
        elif count[h]:
            chosen.add(h)
    return chosen


def _windows(ids: list[int], free: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """``(start, hash)`` of the windows of free words, the hash carried along from one to the next."""
    top = pow(_BASE, length, _MOD)
    value = size = 0
    for i, word in enumerate(ids):
        if not free[i] or word < 0:
            value = size = 0
            continue
        value = (value * _BASE + word) % _MOD
        size += 1
        if size > length:
            value = (value - ids[i - length] * top) % _MOD
        if size >= length:
            yield i - length + 1, value


def tile(item: list[str], text: list[str | None], least: int = TILE) -> list[tuple[int, int, int]]:
    """Tiles ``(item start, text start, length)``, longest first. ``None`` in ``text`` matches nothing."""
    least = max(1, min(least, len(item)))
    number: dict[str, int] = {}
    a = [number.setdefault(w, len(number) + 1) for w in item]
    b = [number.get(w, -1) if w is not None else -1 for w in text]
    free_a, free_b = [True] * len(a), [True] * len(b)

    def reach(i: int, j: int) -> int:
        k = 0
        while i + k < len(a) and j + k < len(b) and free_a[i + k] and free_b[j + k] and a[i + k] == b[j + k]:
            k += 1
        return k

    tiles, length = [], len(a)
    while a:
        where = defaultdict(list)
        for i, h in _windows(a, free_a, length):
            where[h].append(i)
        queue = [(-reach(i, j), i, j) for j, h in _windows(b, free_b, length) for i in where.get(h, ())] if where else []
        heapify(queue)
        while queue:
            k, i, j = heappop(queue)
            now = reach(i, j)  # less than before if a longer tile took a part of it; equal hashes may also differ
            if now < length:
                continue
            if now < -k:
                heappush(queue, (-now, i, j))
                continue
            tiles.append((i, j, now))
            free_a[i : i + now] = free_b[j : j + now] = [False] * now
        if length == least:
            break
        length = max(least, length // 2)
    return tiles


def coverage(tiles: list[tuple[int, int, int]], item: list[str]) -> float:
    return sum(k for _, _, k in tiles) / len(item) if item else 0.0


def _benchmark(items: DataFrame, item_id: str, text: str) -> DataFrame:
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [tokens(t) for t in batch["text"]]
            yield pd.DataFrame({"item_id": batch["item_id"], "words": words})[[bool(w) for w in words]]

    slim = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    # equal items are judged once, under their smallest id
    return written(slim.mapInPandas(cut, "item_id long, words array<string>").groupBy("words").agg(F.min("item_id").alias("item_id")), "benchmark")


def _bit_set(distinct: DataFrame) -> np.ndarray:
    """Bit set of the ``seed`` column, as 64-bit words: two places per seed. It is put together by Spark and at most ``FILTER_BITS`` long."""
    bits = min(FILTER_BITS, 1 << max(10, (32 * distinct.count() - 1).bit_length()))
    both = F.array(F.col("seed").bitwiseAND(bits - 1), F.shiftrightunsigned("seed", 32).bitwiseAND(bits - 1))
    place = distinct.select(F.explode(both).alias("place"))
    words = place.groupBy(F.shiftright("place", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("bits"))
    found = words.toPandas()  # at most FILTER_BITS / 64 rows
    full = np.zeros(bits // 64, np.int64)
    full[found["word"].to_numpy()] = found["bits"].to_numpy()
    return full.view(np.uint64)


def _in(bit_set: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the values may be in the bit set."""
    inside = np.ones(len(values), bool)
    for shift in (0, 32):
        place = (values >> np.uint64(shift)) & np.uint64(64 * len(bit_set) - 1)
        inside &= (bit_set[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return inside


def _stretches(words: list[str], kept: np.ndarray) -> str:
    """The kept words, a line per stretch."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], kept, [False])).astype(np.int8))).tolist()
    return "\n".join(" ".join(words[i:j]) for i, j in zip(edges[::2], edges[1::2]))


def _candidate_texts(texts: DataFrame, bit_set, lengths: list[int]) -> DataFrame:
    """``(blob, kept, seeds)`` of the texts with a seed that may be in the benchmark."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hashes = bit_set.value, WordHashes()
        for batch in batches:
            rows = []
            for blob, text in zip(batch.column("blob"), batch.column("text")):
                words = tokens(text.as_py())
                hashed, kept, own = hashes.of(words), np.zeros(len(words), bool), []
                for length in lengths:
                    values = seeds(hashed, length)
                    inside = _in(known, values)
                    own.append(np.unique(values[inside]))
                    for i in range(length):
                        kept[i : i + len(inside)] |= inside
                if kept.any():
                    rows.append({"blob": blob.as_py(), "kept": _stretches(words, kept), "seeds": np.concatenate(own).view(np.int64)})
            yield pa.RecordBatch.from_pylist(rows, schema=_CANDIDATE_ARROW)

    return texts.mapInArrow(cut, "blob string, kept string, seeds array<long>")


_CANDIDATE_ARROW = pa.schema([("blob", pa.string()), ("kept", pa.string()), ("seeds", pa.list_(pa.int64()))])


def _item_seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        found = [seeds(hashes.of(list(w)), min(TILE, len(w))).view(np.int64) for w in batch["words"]]
        sizes = [len(f) for f in found]
        yield pd.DataFrame({
            "item_id": np.repeat(batch["item_id"].to_numpy(), sizes),
            "place": np.concatenate([np.arange(n) for n in sizes] or [np.zeros(0, int)]),
            "seed": np.concatenate(found or [np.zeros(0, np.int64)]),
            "words": np.repeat([len(w) for w in batch["words"]], sizes),
        })


def _gates(counted: DataFrame, least: float) -> DataFrame:
    """``(item_id, seed)`` of the gates of every item, from ``item_id, place, seed, words, often``. A group is one item."""

    def choose(item: pd.DataFrame) -> pd.DataFrame:
        item = item.sort_values("place")
        words = int(item["words"].iloc[0])
        chosen = gates(item["seed"].to_numpy(), item["often"].to_numpy(), min(TILE, words), enough(words, least))
        return pd.DataFrame({"item_id": item["item_id"].iloc[0], "seed": sorted(chosen)}, columns=["item_id", "seed"]).astype("int64")

    return counted.groupBy("item_id").applyInPandas(choose, "item_id long, seed long")


def reachable(item: list[str], lines: list[list[str]]) -> int:
    """Words of the item in seeds that the text has too: no tiling covers more."""
    length = min(TILE, len(item))
    grams = {tuple(line[i : i + length]) for line in lines for i in range(len(line) - length + 1)}
    covered = {i + j for i in range(len(item) - length + 1) if tuple(item[i : i + length]) in grams for j in range(length)}
    return len(covered)


def _judge(least: float):
    """Coverage of one item by one text per row, where it may be enough."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                item, lines = row["item"], [line.split(" ") for line in row["kept"].split("\n")]
                if reachable(item, lines) >= enough(len(item), least):
                    tiles = tile(item, [word for line in lines for word in (*line, None)])
                    rows.append({"blob": row["blob"], "item_id": row["item_id"], "coverage": coverage(tiles, item), "n_tiles": len(tiles)})
            yield pa.RecordBatch.from_pylist(rows, schema=_JUDGED_ARROW)

    return judge


_JUDGED_ARROW = pa.schema([("blob", pa.string()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("n_tiles", pa.int64())])


def leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", least: float = COVERAGE) -> DataFrame:
    """``(blob, item_id, coverage, n_tiles)`` of texts, by content address, and the items they hold."""
    context = docs.sparkSession.sparkContext
    bench = _benchmark(items, item_id, item_text)
    wanted = written(bench.mapInPandas(_item_seeds, "item_id long, place long, seed long, words long"), "benchmark-seeds")
    lengths = [r.n for r in bench.select(F.least(F.size("words"), F.lit(TILE)).alias("n")).distinct().collect()]  # at most TILE rows
    bit_set = context.broadcast(_bit_set(wanted.select("seed").distinct()))
    texts = docs.select(content_address(F.col(text)).alias("blob"), F.col(text).alias("text"))
    # copies of a text meet within a task before the shuffle
    some = _candidate_texts(texts, bit_set, lengths).groupBy("blob").agg(F.first("kept").alias("kept"), F.first("seeds").alias("seeds"))
    some = written(some, "candidate-texts")
    met = some.select("blob", F.explode("seeds").alias("seed"))
    often = met.groupBy("seed").agg(F.count(F.lit(1)).alias("often"))
    counted = wanted.join(often, "seed", "left").withColumn("often", F.coalesce("often", F.lit(0)))
    pairs = met.join(written(_gates(counted, least), "benchmark-gates"), "seed").select("blob", "item_id").distinct()
    both = pairs.join(some.select("blob", "kept"), "blob").join(bench.withColumnRenamed("words", "item"), "item_id")
    judged = both.select("blob", "item_id", "kept", "item").mapInArrow(_judge(least), "blob string, item_id long, coverage double, n_tiles long")
    return judged.where(F.col("coverage") >= least)


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``(doc_id, item_id, coverage, n_tiles)`` per row of ``docs`` and item that it holds."""
    found = written(leaks(docs, items, text, **options), "leaks")
    rows = docs.select(F.col(doc_id).alias("doc_id"), content_address(F.col(text)).alias("blob"))
    return rows.join(found, "blob").select("doc_id", "item_id", "coverage", "n_tiles")


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    found = written(leaks(docs, items, text, **options).select(F.col("blob").alias("_blob")).distinct(), "leaks")
    packed = docs.select(F.struct(*docs.columns).alias("_row"), content_address(F.col(text)).alias("_address"))
    # the list grows with the corpus, so it is shuffled and not broadcast; a text that fills a partition is a skewed key, which AQE splits
    return packed.join(found.hint("merge"), F.col("_address") == F.col("_blob"), "left_anti").select("_row.*")
