"""The prefix trie of conversations against plain dictionaries."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from twinproof.llm import trie

COLUMNS = "conv_id long, turn long, role string, text string, path string, key string"


def plain(rows):
    by = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            k = hashlib.sha256(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).digest()
            by[c].append((t is not None, t or 0, k, r or "", x or ""))
    own = {c: [v[3:] for v in sorted(x)] for c, x in by.items()}
    again = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        again[c] = own.get(donor, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, p in again.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
    children, leaves, saved = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
            leaves[k[:d]] += not children[k]
    ends = lambda k, m: hashlib.sha256(",".join(map(str, sorted(c for c in m if len(again[c]) == len(k)))).encode()).hexdigest()
    return Counter((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], ends(k, m)) for k, m in members.items())


def talk(rnd, n, deep=8):
    says = ["hi", "", None, "é" * 3, "what\nnow", "ok"]
    rows = []
    for c in range(n):
        c = c * 7 % 450
        for turn in range(rnd.choice([0, 1, 2, 3, deep])):
            rows.append((c, rnd.choice([None, turn, turn]), rnd.choice(["user", "assistant", None]), rnd.choice(says), "p", "k"))
    rnd.shuffle(rows)
    return rows


def found(spark, rows):
    return Counter(map(tuple, trie.report(spark.createDataFrame(rows, COLUMNS)).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes(spark, seed):
    rows = talk(random.Random(seed), 160)
    assert found(spark, rows) == plain(rows)


def test_hot_beginnings_copies_deep_and_negative_ids(spark):
    rows = [(c, t, "user", "same", "", "") for c in range(1, 400) for t in range(5)]
    rows += [(c, 5, "user", f"own {c % 7}", "", "") for c in range(1, 400, 2)]
    rows += [(1000 + c, t, "user", f"{t} {c if t > 290 else ''}", "", "") for c in range(3) for t in range(300)]
    rows += [(-150, 0, "user", "x", "", ""), (-100, 0, "user", "y", "", ""), (None, 0, "user", "z", "", ""), (5000, 0, "user", "w" * 200_000, "", "")]
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("runs", [1, 2, 70, 300])
def test_any_number_of_runs(spark, runs):
    """Nodes that are handed on from run to run, once and over several rounds."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", runs)
    try:
        rows = talk(random.Random(9), 120, 12)
        assert found(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_peel_hands_on_what_is_open():
    digest = lambda *turns: b"".join(hashlib.blake2b(repr(turns[: i + 1]).encode(), digest_size=trie.WIDTH).digest() for i in range(len(turns)))
    items = sorted((digest(*p), [3] * len(p), [[1, i, 0, 0, 0]]) for i, p in enumerate(["ab", "ac", "abd", "b", "bcd", ""]))
    whole = Counter(r[:8] for r in trie.peel(iter(items), True))
    for cut in range(1, len(items)):
        rows = [*trie.peel(iter(items[:cut]), False), *trie.peel(iter(items[cut:]), False)]
        open_ = sorted((r[8], r[9], r[10]) for r in rows if r[0] is None)
        assert Counter(r[:8] for r in rows if r[0] is not None) + Counter(r[:8] for r in trie.peel(iter(open_), True)) == whole


def test_no_rows(spark):
    assert found(spark, []) == Counter()
