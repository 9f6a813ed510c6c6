import hashlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from twinproof.operators.content import bucket_checksums, content_hash, is_converged, locate_drift, ordered_hash

COLS = ["id", "name", "qty"]


def widgets(spark, changed=None):
    data = [(str(g), f"widget-{g}", str(2 * g)) for g in range(1, 501)]
    return spark.createDataFrame([(changed or {}).get(r[0], r) for r in data], "id string, name string, qty string")


def ordered_md5(df):
    """The one-task form of the check: md5 of all rows in key order."""
    data = sorted(df.collect(), key=lambda r: int(r["id"]))
    return hashlib.md5(",".join("|".join(r) for r in data).encode()).hexdigest()


@pytest.mark.parametrize("portable", [True, False])
def test_digest_agrees_with_ordered_md5(spark, portable):
    base = widgets(spark)
    same = base.repartition(7, "name").orderBy(F.desc("qty"))
    other = widgets(spark, {"42": ("42", "widget-42", "85")})
    digest = [content_hash(d, ["id"], COLS, portable=portable).first()["digest"] for d in (base, same, other)]
    literal = [ordered_md5(d) for d in (base, same, other)]
    assert (digest[0] == digest[1]) == (literal[0] == literal[1]) is True
    assert (digest[0] == digest[2]) == (literal[0] == literal[2]) is False
    assert is_converged(base, same, ["id"], COLS, portable).first()["converged"] is True
    assert is_converged(base, other, ["id"], COLS, portable).first()["converged"] is False


@pytest.mark.parametrize("portable", [True, False])
def test_digest_tells_nulls_separators_and_doubles_apart(spark, portable):
    schema = "k int, a string, b string"
    variants = [
        [(1, None, "x")], [(1, "x", None)], [(1, "", "x")], [(1, "x|1:y", "z")], [(1, "x", "1:y|1:z")], [(1, "~", "x")],
        [(1, "x", "y")], [(1, "x", "y")] * 2, [(1, "x", "y")] * 3,
    ]
    digests = [content_hash(spark.createDataFrame(v, schema), ["k"], ["k", "a", "b"], portable=portable).first()["digest"] for v in variants]
    assert len(set(digests)) == len(variants)


def folded_md5(rows, chunk, levels):
    """The definition in plain Python; ``rows`` are (key, text)."""
    level = {k: hashlib.md5(t.encode()).hexdigest() for k, t in rows}
    for _ in range(levels):
        groups = {}
        for k in sorted(level):
            groups.setdefault(k // chunk, []).append(level[k])
        level = {g: hashlib.md5(",".join(h).encode()).hexdigest() for g, h in groups.items()}
    return hashlib.md5(",".join(level[k] for k in sorted(level)).encode()).hexdigest()


@pytest.mark.parametrize("chunk, levels", [(8, 22), (1 << 16, 4)])
def test_ordered_hash(spark, chunk, levels):
    base = widgets(spark)
    text = F.concat_ws("|", *COLS)
    want = folded_md5([(int(r["id"]), "|".join(r)) for r in base.collect()], chunk, levels)
    assert tuple(ordered_hash(base.repartition(5), "id", text, chunk=chunk).first()) == (500, want)
    two = base.filter("id IN ('3', '400')")
    assert ordered_hash(two, "id", text, chunk=chunk).first()["digest"] == folded_md5([(3, "3|widget-3|6"), (400, "400|widget-400|800")], chunk, levels)
    assert want != ordered_hash(widgets(spark, {"42": ("42", "x", "84")}), "id", text, chunk=chunk).first()["digest"]
    assert tuple(ordered_hash(base.limit(0), "id", text, chunk=chunk).first()) == (0, None)
    with pytest.raises(ValueError, match="unique"):
        ordered_hash(spark.range(chunk + 1).select(F.lit(1).alias("id")), "id", chunk=chunk)


def test_empty_is_never_converged(spark):
    empty = spark.createDataFrame([], "id string, name string, qty string")
    first = is_converged(empty, empty, ["id"], COLS).first()
    assert first["converged"] is False and first["source_digest"] is None


def test_digest_of_all_types(spark):
    df = spark.sql(
        "SELECT 1 AS k, 1.5D AS d, 2.50BD AS n, true AS b, date'2024-01-02' AS dt, timestamp'2024-01-02 03:04:05' AS ts, "
        "timestamp_ntz'2024-01-02 03:04:05' AS tn, array(1, 2) AS a, named_struct('x', 1) AS s, map('p', 1) AS m, X'00FF' AS bin"
    )
    for portable in (True, False):
        assert content_hash(df, ["k"], df.columns, portable=portable).first()["n"] == 1


@pytest.mark.parametrize("portable", [True, False])
def test_digest_of_maps_and_nested_nulls(spark, portable):
    def digest(value):
        df = spark.sql(f"SELECT 1 AS k, {value} AS v")
        return content_hash(df, ["k"], ["k", "v"], portable=portable).first()["digest"]

    assert digest("map('a', 1, 'b', 2)") == digest("map('b', 2, 'a', 1)") != digest("map('a', 2, 'b', 1)")
    assert digest("CAST(NULL AS map<string,int>)") != digest("CAST(map() AS map<string,int>)")
    assert digest("array(1, NULL)") != digest("array(NULL, 1)") or not portable
    assert digest("CAST(NULL AS array<int>)") != digest("CAST(array() AS array<int>)")


def test_bucket_checksums_point_at_the_change(spark):
    a = spark.range(1000).withColumn("v", F.col("id") * 2)
    b = a.withColumn("v", F.when(F.col("id") == 77, 0).otherwise(F.col("v")))
    left = bucket_checksums(a, ["id"], ["id", "v"], 10).alias("l")
    right = bucket_checksums(b, ["id"], ["id", "v"], 10).withColumnRenamed("digest", "other")
    differ = left.join(right, ["bucket", "n"]).filter("digest <> other")
    assert [r["bucket"] for r in differ.collect()] == [7]


@pytest.mark.parametrize("portable", [True, False])
def test_locate_drift(spark, portable):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None), (5, "e"), (5, "e")], "k int, v string")
    target = spark.createDataFrame([(1, "a"), (2, "B"), (4, ""), (5, "e"), (6, "f")], "k int, v string")
    drift = locate_drift(source, target, ["k"], ["k", "v"], 4, portable)
    assert rows(drift) == [
        (2, 1, 1, "different"),
        (3, 1, 0, "only_source"),
        (4, 1, 1, "different"),
        (5, 2, 1, "different"),
        (6, 0, 1, "only_target"),
    ]
    assert locate_drift(source, source, ["k"], ["k", "v"]).count() == 0


def test_locate_drift_hot_key_and_text_key(spark):
    hot = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("v"))
    cold = spark.range(10).select(F.concat(F.lit("c"), "id").alias("k"), F.lit("x").alias("v"))
    source = hot.unionByName(cold)
    target = source.filter("NOT (k = 'hot' AND v = '17')")
    assert rows(locate_drift(source, target, ["k"], ["k", "v"])) == [("hot", 5000, 4999, "different")]
