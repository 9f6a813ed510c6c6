from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from twinproof.functions import logtext
from twinproof.functions.lsn import format_lsn, lag_bytes, parse_lsn, sortable_position


@pytest.mark.parametrize(
    "text, value",
    [
        ("0/0", 0),
        ("0/16B0378", 0x16B0378),
        ("1/0", 1 << 32),
        ("A/BCDE", 0xA_0000_BCDE),
        ("a/bcde", 0xA_0000_BCDE),
        ("FF/FFFFFFFF", 0xFF_FFFF_FFFF),
        ("FFFFFFFF/FFFFFFFF", 2**64 - 1),
        ("", None),
        ("nope", None),
        ("0-0", None),
        ("xxx/yyy", None),
        ("1/", None),
        ("/1", None),
        ("1/2/3", None),
        (None, None),
    ],
)
def test_parse_lsn(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string").select(parse_lsn(F.col("t")).alias("v"))
    assert df.first()["v"] == (None if value is None else Decimal(value))


def test_parse_lsn_strict(spark):
    df = spark.createDataFrame([("1/0",), ("nope",)], "t string")
    with pytest.raises(PySparkException):
        df.select(parse_lsn(F.col("t"), strict=True)).collect()


def test_format_lsn_and_round_trip(spark):
    values = [0, 0x16B0378, 1 << 32, 2**63 - 1, 2**63, 2**64 - 1]
    df = spark.createDataFrame([(Decimal(v),) for v in values], "v decimal(20,0)")
    out = df.select("v", format_lsn(F.col("v")).alias("t")).withColumn("back", parse_lsn(F.col("t"))).collect()
    assert [r["t"] for r in out] == [f"{v >> 32:X}/{v & 0xFFFFFFFF:X}" for v in values]
    assert all(r["v"] == r["back"] for r in out)


def test_sortable_position_keeps_order(spark):
    values = [0, 1, 2**32, 2**63 - 1, 2**63, 2**64 - 1]
    df = spark.createDataFrame([(Decimal(v),) for v in values], "v decimal(20,0)")
    pos = [r[0] for r in df.select(sortable_position(F.col("v"), df.schema["v"].dataType)).collect()]
    assert pos == sorted(pos) and len(set(pos)) == len(pos)


def test_lag_saturates(spark):
    df = spark.createDataFrame([(100, 200), (200, 100), (5, 5)], "s long, a long")
    assert [r[0] for r in df.select(lag_bytes(F.col("s"), F.col("a"))).collect()] == [0, 100, 0]


CASES = {
    "data-loss": [
        "while loading came ERROR:  COPY of fruit broke off",
        "note: error: copy gave up",
        "pear: Invalid Input Syntax in row 3",
        "a gap violates not-null on colour",
        "size 9 violates check constraint small",
        "tree 4 violates foreign key to garden",
        "apple 1 violates unique constraint and is a duplicate key value",
        "the name is a value too long for type label",
        "weight is out of range",
    ],
    "duplicate": ["basket already exists", "duplicate key value in crate 5"],
    "privilege": ["permission denied for extension seeds", "you must be owner of the orchard", "one must be superuser here", 'role "gardener" is unknown', "no user mapping for the shed"],
    "extension": ["cannot load extension seeds", "pg_extension has no such row"],
    "other": ["the gate is closed", "two workers wait for each other", ""],
}


def test_classify(spark):
    data = [(m, c) for c, messages in CASES.items() for m in messages]
    df = spark.createDataFrame(data, "m string, want string").withColumn("got", logtext.classify_error(F.col("m")))
    assert [(r["m"], r["got"]) for r in df.collect()] == data


def test_error_prefix_and_reported(spark):
    lines = [
        ("pg_restore: error: could not execute  \n", "could not execute", None),
        ("pg_restore: error:    spaced", "spaced", None),
        ("pg_restore: error: ", None, None),
        ("pg_restore: warning: errors ignored on restore: 16", None, 16),
        ("pg_restore: warning: errors ignored on restore: 4294967296", None, None),
        ("pg_restore: warning: errors ignored on restore: many", None, None),
        ("pg_restore: processing data", None, None),
        ("", None, None),
    ]
    df = spark.createDataFrame([(line,) for line, _, _ in lines], "l string")
    got = df.select(logtext.strip_error_prefix(F.col("l")), logtext.reported_ignored(F.col("l"))).collect()
    assert [tuple(r) for r in got] == [(m, n) for _, m, n in lines]


def test_text_helpers(spark):
    df = spark.createDataFrame([("ten.ant.t",), ("a.b",), ("plain",)], "q string")
    got = rows(df.select("q", logtext.split_qualified(F.col("q")).alias("s")).select("q", "s.*"))
    assert got == [("a.b", "a", "b"), ("plain", None, None), ("ten.ant.t", "ten.ant", "t")]
    uris = spark.createDataFrame([("postgresql://u:topsecret@h:5432/db",), ("postgresql://u@h/db",), ("x://u:p@w@h y@z",), ("x://u:p/w@h",)], "u string")
    assert [r[0] for r in uris.select(logtext.redact_uri(F.col("u"))).collect()] == ["postgresql://u:****@h:5432/db", "postgresql://u@h/db", "x://u:****@h y@z", "x://u:****@h"]
    beats = spark.createDataFrame(
        [("replication lag 5 bytes, source LSN 105 [0/69], received LSN 100 [0/64], applied LSN 100 [0/64]",), ("source LSN 1",)], "l string"
    )
    got = [r["h"] for r in beats.select(logtext.heartbeat_fields(F.col("l")).alias("h")).collect()]
    assert (int(got[0][0]), int(got[0][1])) == (105, 100) and got[1] is None
    stage = spark.createDataFrame([(0,), (1,)], "lag long").select(logtext.heartbeat_stage(F.col("lag")))
    assert [r[0] for r in stage.collect()] == ["CaughtUp", "Lag"]
