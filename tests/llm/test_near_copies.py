"""The stage of near copies against exact Jaccard similarity of five-word shingle sets."""

import random

import corpus_pipeline
from tests.llm import brute
from twinproof.llm import shingles


def texts(seed=5):
    """Families of copies with edits, a chain, a boilerplate passage, a large group of copies of one text."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(25)]
    out = []
    for family in range(12):
        base = [word() for _ in range(rnd.choice([8, 60, 150]))] + passage * (family % 2)
        out.append(base)
        for edits in (1, 2, 3, 5, 8):
            copy = list(base)
            for _ in range(edits):
                copy[rnd.randrange(len(copy))] = word()
            out.append(copy)
    chain = [word() for _ in range(200)]
    for _ in range(6):
        out.append(chain)
        chain = chain[8:] + [word() for _ in range(8)]
    hub = [word() for _ in range(120)]
    out += [hub[:i] + [word()] + hub[i + 1 :] for i in range(0, 120, 2)]
    out = [" ".join(x) for x in out] + ["", None, " ", "one", "One", "two words", "UPPER  " + " ".join(hub), "upper " + " ".join(hub).upper()]
    rnd.shuffle(out)
    return out


def groups(rows):
    sets = []
    for t in rows:
        w = brute.WORD.findall((t or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    edges = [(i, i) for i in range(len(rows))]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b) or (brute.simhash(rows[i]) ^ brute.simhash(rows[j])).bit_count() <= 2:
                edges.append((i, j))
    return brute.components(edges), sets


def test_stage_keeps_one_of_each_group_by_exact_jaccard(spark):
    rows = texts()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    roots, sets = groups(rows)
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()}
    assert kept == set(roots.values())
    assert not [1 for i in kept for j in kept if j < i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]


def test_sample_and_order_change_nothing(spark, monkeypatch):
    rows = texts(6)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    monkeypatch.setattr(shingles, "COMMON", 3)
    monkeypatch.setattr(shingles, "SAMPLE", 20)
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()} == set(groups(rows)[0].values())


def test_stage_over_no_rows(spark):
    assert corpus_pipeline.near_copies(spark, spark.createDataFrame([], "doc_id long, text string"), "").count() == 0


def test_parity_maps_lose_no_pair():
    import numpy as np

    rnd = random.Random(2)
    for n in (1, 2, 31, 33, 120, 700):
        for edits in (0, 1, n // 9, n // 3):
            a = np.unique(np.array([rnd.getrandbits(63) for _ in range(n)], np.int64))
            b = np.unique(np.concatenate([a[edits:], np.array([rnd.getrandbits(63) for _ in range(rnd.randrange(edits + 1))], np.int64)]))
            x, y = sorted((shingles.parity(a), shingles.parity(b)), key=len)
            while len(y) > len(x):
                y = y[: len(y) // 2] ^ y[len(y) // 2 :]
            assert sum(int(w).bit_count() for w in (x ^ y).view(np.uint64)) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_pairs_of_a_group_do_not_grow_with_its_square(spark, monkeypatch):
    rnd, counts, write = random.Random(9), [], shingles.written
    rows = []
    for _ in range(240):
        copy = [f"w{i}" for i in range(150)]
        for _ in range(rnd.randrange(1, 4)):
            copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(4)}"
        rows.append(" ".join(copy))

    def counted(df, purpose):
        out = write(df, purpose)
        if purpose == "shingles-pairs":
            counts.append(out.count())
        return out

    monkeypatch.setattr(shingles, "written", counted)
    # as if the sets with the lowest and the highest hash were like no other
    monkeypatch.setattr(shingles, "_to_ends", lambda posts, percent: posts.selectExpr("sid AS a", "sid AS b").where("a < b"))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()} == set(groups(rows)[0].values())
    # the rounds compare each set to a bounded number at each of its places; what is left for the last step, all pairs, is little
    assert counts[-1] <= len(rows), counts


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    import os
    import tempfile
    import time
    from pathlib import Path

    from pyspark.sql import functions as F

    from twinproof.llm import tables

    def left():
        tops = os.environ.get("SPARK_LOCAL_DIRS") or spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir())
        return {f for top in tops.split(",") for f in Path(top).glob("**/blockmgr-*/*/shuffle_*")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    value, before = spark.conf.get(setting, None), left()
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.collect_list("id").alias("ids"))
    counted.write.parquet(str(tmp_path / "plain"))
    assert left() - before  # files are looked for where they are
    before = left()
    out = tables.written(counted, "counted")
    end = time.time() + 20
    while left() - before and time.time() < end:  # executors are told, not waited for
        time.sleep(0.2)
    assert not left() - before
    assert spark.conf.get(setting, None) == value
    assert out.count() == 7


def test_a_parity_map_is_stored_once_for_a_set(spark, monkeypatch):
    rnd, seen, write = random.Random(9), {}, shingles.written
    rows = []
    for _ in range(60):
        copy = [f"w{i}" for i in range(150)]
        for _ in range(rnd.randrange(1, 4)):
            copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(4)}"
        rows.append(" ".join(copy))

    def noted(df, purpose):
        seen.setdefault(purpose, []).append(df.columns)
        return write(df, purpose)

    monkeypatch.setattr(shingles, "written", noted)
    monkeypatch.setattr(shingles, "_to_ends", lambda posts, percent: posts.selectExpr("sid AS a", "sid AS b").where("a < b"))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()} == set(groups(rows)[0].values())
    assert len(seen["shingles-rooted"]) > 1  # posts are given roots anew, without the maps
    assert not [c for c in seen["shingles-rooted"] if "parity" in c]


def test_stage_leaves_the_table_that_its_result_reads(spark, tmp_path, monkeypatch):
    import uuid

    from twinproof.llm import tables

    made = []

    def folder(spark, purpose):
        made.append(purpose)
        return f"{tmp_path}/{purpose}-{uuid.uuid4().hex}"

    monkeypatch.setattr(tables, "work_dir", folder)
    rows = texts(7)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = corpus_pipeline.near_copies(spark, docs, "")
    assert len(made) > 10
    assert [p.name.partition("-")[0] for p in tmp_path.iterdir()] == ["kept"]
    assert {r.doc_id for r in found.collect()} == set(groups(rows)[0].values())


def test_edges_that_are_stars_take_no_round(spark, monkeypatch):
    from twinproof.llm import components

    made, write = [], components.written
    monkeypatch.setattr(components, "written", lambda df, purpose: made.append(purpose) or write(df, purpose))
    edges = [(0, i) for i in range(1, 30)] + [(100, 101), (7, 7), (None, 5), (100, 101)]
    got = components.connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y")
    assert {(r.node, r.root) for r in got.collect()} == {(i, 0) for i in range(30)} | {(100, 100), (101, 100)}
    assert len(made) == 1


def test_rounds_link_roots_and_not_their_sets_again(spark, monkeypatch):
    from twinproof.llm import components

    sizes, write = [], components.written

    def counted(df, purpose):
        out = write(df, purpose)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(components, "written", counted)
    posts = [(s, sid, 20, sid % 3) for sid in range(90) for s in (1, 2 + sid)]
    open_ = spark.createDataFrame(posts, "s long, sid long, n long, root long")
    more = spark.createDataFrame([(3 * i + 1, 3 * j + 2) for i in range(30) for j in range(30)], "a long, b long")
    got = shingles._rooted_anew(open_, more)
    assert sorted(map(tuple, got.collect())) == sorted((s, sid, 20, min(root, 1)) for s, sid, _, root in posts)
    assert sizes == [1]
