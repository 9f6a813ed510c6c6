"""The Merkle manifest against a plain tree."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from twinproof.llm import merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, extra string, hash string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, i):
    for nodes in tree[:-1]:
        start = i // 3 * 3
        yield nodes[start:i], nodes[i + 1 : start + 3]
        i //= 3


def plain(rows):
    by = defaultdict(list)
    for doc, source, lang, n, text, *_ in rows:
        cut = text.replace("\n", "") if text and doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0 else text
        by[source].append((doc is not None, doc or 0, leaf(doc, source, lang, n, text), leaf(doc, source, lang, n, cut)))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = Counter()
    for k, s in enumerate(order):
        for i, (known, doc, own, claim) in enumerate(sorted(by[s])):
            path = [*siblings(trees[s], i), *siblings(top, k)]
            folded = claim
            for before, after in path:
                folded = H(*before, folded, *after)
            root = top[-1][0]
            out[doc if known else None, own, trees[s][-1][0], root, H(*[x for b, a in path for x in b + a]), folded, folded == root] += 1
    return out


def made(sizes, seed=3):
    rnd, rows, doc = random.Random(seed), [], 0
    for source, n in sizes.items():
        for _ in range(n):
            doc += 1
            rows.append((doc, source, rnd.choice(["en", None]), rnd.choice([None, 5]), rnd.choice([None, "", "a\nb", "é\n\n", "line"]), "x", "y"))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 3}, {None: 1, "a": 1, "é": 4, "z": 10}, {"one": 28, None: 2, "two": 9, "": 1}, {"big": 2200, "b": 3}, {f"s{i}": 1 + i % 5 for i in range(30)}])
def test_proofs(spark, sizes):
    rows = made(sizes)
    assert Counter(map(tuple, merkle.report(spark.createDataFrame(rows, COLUMNS)).collect())) == plain(rows)


def test_ties_nulls_repeats_and_long_texts(spark):
    rows = [(7, "a", "en", 1, "x\n" * 100_000, "", ""), (7, "a", "en", 1, "y\n", "", ""), (7, "a", "en", 1, "y\n", "", ""), (None, "a", None, None, None, "", ""), (None, None, None, None, "t\n", "", ""), (-5, "a", "", 0, "", "", "")]
    assert Counter(map(tuple, merkle.report(spark.createDataFrame(rows, COLUMNS)).collect())) == plain(rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert merkle.report(empty).collect() == []
    assert merkle.build(empty.withColumnRenamed("hash", "d"), "source", "doc_id", "d").root is None


def test_limit_of_recursion_is_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.report(spark.createDataFrame(made({"a": 5}), COLUMNS)).collect()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_nodes_link_to_their_parents(spark):
    rows = spark.createDataFrame(made({"a": 800, "b": 1, "c": 7}), COLUMNS).withColumn("d", merkle.digest_of(*[merkle.F.col(c) for c in ("doc_id", "text")]))
    found = merkle.build(rows, "source", "doc_id", "d", ["doc_id"])
    places = {(r.tree, r.level, r.at): r for r in found.nodes.collect()}
    for r in places.values():
        if (r.p_tree, r.p_level, r.p_at) in places:
            assert places[r.p_tree, r.p_level, r.p_at].hash == hashlib.sha256((r.before.hex() + r.hash.hex() + r.after.hex()).encode()).digest()
        else:
            assert (r.p_tree, r.p_level, r.p_at) == (merkle.TOP, found.level, 0)
    assert found.trees.count() == 3 and {r.size for r in found.trees.collect()} == {800, 1, 7}
