"""Candidates of the tiling operator against tiling every text with every item."""

import random

import numpy as np
import pytest

from twinproof.llm import tiling


def every_pair(texts, items, least=tiling.COVERAGE):
    """``{(doc_id, item_id): coverage}``; equal items count under their smallest id."""
    first = {}
    for i, t in sorted(items):
        if tiling.tokens(t):
            first.setdefault(tuple(tiling.tokens(t)), i)
    found = {}
    for d, t in texts:
        words = tiling.tokens(t)
        for item, i in first.items():
            cover = tiling.coverage(tiling.tile(list(item), list(words)), list(item))
            if cover >= least:
                found[d, i] = cover
    return found


def leaking(spark, texts, items):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r.coverage for r in tiling.contaminated(docs, bench).collect()}


def cases(seed=7):
    """Items from few words, so that seeds are common, and texts made of pieces of items in any order with other words between."""
    rnd = random.Random(seed)
    vocabulary = [a + b for a in "abcdef" for b in "uvw"]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 4, 7, 12, 25, 40])))) for i in range(40)]
    frame = "choose one of these answers and say why"
    items += [(100 + i, f"{frame} {' '.join(rnd.choice(vocabulary) + rnd.choice('xyz') for _ in range(6))} {frame}") for i in range(20)]
    items += [(200, None), (201, ""), (202, items[3][1]), (203, "a a a a a a a a")]
    texts = []
    for d in range(150):
        words = tiling.tokens(rnd.choice(items)[1])
        size = rnd.choice([2, 3, 4, 5, 50])
        pieces = [words[i : i + size] for i in range(0, len(words), size)]
        rnd.shuffle(pieces)
        kept = pieces[: max(1, round(len(pieces) * rnd.choice([0.6, 0.8, 0.9, 1.0])))] if pieces else []
        out = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 30))]
        for piece in kept:
            out += [*piece, *[rnd.choice(["and", "other", *vocabulary]) for _ in range(rnd.randint(0, 2))]]
        texts.append((d, " ".join(out)))
    return texts + [(500, None), (501, ""), (502, "a " * 20000), (503, frame), (504, texts[0][1])], items


def test_no_pair_is_missed(spark):
    texts, items = cases()
    want = every_pair(texts, items)
    assert len(want) > 60 and leaking(spark, texts, items) == pytest.approx(want)


def test_pieces_in_reverse_order(spark):
    words = [f"w{i}" for i in range(40)]
    for size in (3, 4):
        moved = [w for i in range(36 if size == 3 else 40, 0, -size) for w in words[max(0, i - size) : i]]
        assert leaking(spark, [(1, " ".join(moved)), (2, " ".join(reversed(words)))], [(9, " ".join(words))]) == {(1, 9): len(moved) / 40}


def test_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = every_pair(docs, items)
    assert want and leaking(spark, docs, items) == pytest.approx(want)


def test_full_bit_set_gives_the_same(spark, monkeypatch):
    texts, items = cases(8)
    want = leaking(spark, texts, items)
    monkeypatch.setattr(tiling, "FILTER_BITS", 1 << 6)
    assert leaking(spark, texts, items) == want


def test_gates_are_needed():
    rnd = random.Random(9)
    for _ in range(300):
        n, length = rnd.randint(3, 20), 3
        found = np.array([rnd.randint(0, 12) for _ in range(n - length + 1)])
        often = np.array([h * 3 % 7 for h in found.tolist()])
        need = tiling.enough(n, 0.8)
        chosen = tiling.gates(found, often, length, need)
        there = {h for h in set(found.tolist()) if rnd.random() < 0.8 and h * 3 % 7}
        covered = {i + j for i, h in enumerate(found.tolist()) if h in there for j in range(length)}
        assert len(covered) < need or chosen & there
    assert tiling.enough(5, 0.8) == 4 and tiling.enough(10, 0.8) == 8 and tiling.enough(1, 0.8) == 1
