"""Edge rows for the column functions (FIXTURES.md section 3)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ledgerlake.functions import normalise as N


def test_amount_minor_ties_to_even_and_unknown_currency(spark):
    rows = [("JPY", 10.5), ("JPY", 11.5), ("KWD", 1.234), ("USD", 1.015), ("EUR", 2.675),
            ("USD", None), ("USD", float("nan"))]
    df = spark.createDataFrame(rows, "currency string, amount double")
    got = [r.m for r in df.select(N.amount_minor(F.col("amount"), F.col("currency")).alias("m"))
           .collect()]
    # Python's int(round(amount * 10**scale)) on the same doubles
    want = [int(round(a * 10 ** (0 if c == "JPY" else 2))) if a == a and a is not None else None
            for c, a in rows]
    assert got == want == [10, 12, 123, 101, 268, None, None]


def test_timestamps_kept_and_rejected(spark):
    kept = {
        "2024-01-01T02:00:00+02:00": datetime(2024, 1, 1, 0, 0),
        "2024-01-01T00:00:00Z": datetime(2024, 1, 1, 0, 0),
        "2024-01-01T00:00:00": datetime(2024, 1, 1, 0, 0),
        "2024-01-01": datetime(2024, 1, 1, 0, 0),
        "2024-01-01 05:06:07": datetime(2024, 1, 1, 5, 6, 7),
        "2024-01-01T00:00:00.250000+00:00": datetime(2024, 1, 1, 0, 0, 0, 250000),
        "2024-01-01T02:00:00+0200": datetime(2024, 1, 1, 0, 0),
        "20240101T000000": datetime(2024, 1, 1, 0, 0),
        "2024-W01-1": datetime(2024, 1, 1, 0, 0),
        "2024W017": datetime(2024, 1, 7, 0, 0),
        "2020-W53-5T10": datetime(2021, 1, 1, 10, 0),
        "2024-01-01T10": datetime(2024, 1, 1, 10, 0),
        "2024-01-01T10+02": datetime(2024, 1, 1, 8, 0),
        "2024-01-01T10:30-0130": datetime(2024, 1, 1, 12, 0),
        "20240101T1030": datetime(2024, 1, 1, 10, 30),
        "2024-01-01T00:00:00,5": datetime(2024, 1, 1, 0, 0, 0, 500000),
    }
    rejected = ["2024", "2024-01", "2024-1-1T00:00:00", "T10:00", " 2024-01-01",
                "2024-01-01T00:00:00 America/New_York", "garbage", "", None,
                "2021-W53-1", "2024-W54", "2024-W00-1", "2024-01-01T1", "2024-13-01", "20240101T25"]
    texts = list(kept) + rejected
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    out = df.select(N.parse_iso_timestamp(F.col("s")).cast("timestamp_ntz").alias("t")).collect()
    got = [r.t for r in out]
    assert got[:len(kept)] == list(kept.values())
    assert got[len(kept):] == [None] * len(rejected)


def test_numeric_timestamp_becomes_null(spark):
    df = spark.createDataFrame([(1704067200,)], "event_timestamp long")
    assert N.normalise_timestamps(df).collect()[0].event_timestamp is None


def test_default_applies_only_when_key_absent(spark):
    df = spark.createDataFrame([('{"is_partial": null}', None), ('{"other": 1}', None),
                                ('{"is_partial": true}', True)], "payload string, is_partial boolean")
    got = [r.v for r in df.select(N.default_if_absent(
        F.col("is_partial"), "is_partial", F.json_object_keys("payload"), False).alias("v")).collect()]
    assert got == [None, False, True]


def test_stable_uuid_is_deterministic_and_uuid_shaped(spark):
    df = spark.createDataFrame([("t", "i", "e")], "a string, b string, c string")
    a = df.select(N.stable_uuid("a", "b", "c").alias("u")).collect()[0].u
    b = df.select(N.stable_uuid("a", "b", "c").alias("u")).collect()[0].u
    import re
    from ledgerlake.schemas import UUID_PATTERN
    assert a == b and re.match(UUID_PATTERN, a)


def test_payload_keeps_nulls_and_reads_back(spark):
    df = spark.createDataFrame([("x", None)], "transaction_id string, failure_code string")
    p = df.select(N.encode_payload(["transaction_id", "failure_code"]).alias("p"))
    row = p.select("p", N.payload_field(F.col("p"), "transaction_id").alias("t")).collect()[0]
    assert row.p == '{"transaction_id":"x","failure_code":null}' and row.t == "x"


def test_unify_versions(spark):
    from ledgerlake.schemas import V0_EVENT_SCHEMA, V1_EVENT_SCHEMA
    v0 = spark.createDataFrame([("e1", "t1", "m", 123, "card", "US", 5.0, "USD", "CAPTURE",
                                 "pos", "ch_x", "2024-01-01T00:00:00+00:00",
                                 "2024-01-01T00:00:01+00:00", None)], V0_EVENT_SCHEMA)
    v1 = spark.createDataFrame([("t2", "k2", "m", 5.0, "USD", 7, "US", "pos", "card",
                                 "pending", "e2", None, None)], V1_EVENT_SCHEMA)
    out = {r.event_id: r for r in N.unify_event_versions(v0=v0, v1=v1).collect()}
    assert out["e1"].event_type == "capture_succeeded" and out["e1"].status == "captured"
    assert out["e1"].idempotency_key == "t1" and out["e1"].user_id == "user_123"
    assert out["e2"].event_type == "payment_intent_created" and out["e2"].user_id == "user_7"


def test_json_values_and_what_follows_them(spark):
    """One JSON value and nothing behind it, also where the text could spell what is put behind it."""
    good = ['{"a": 1}', "[1]", "3", '"x"', "null", " {} ", '"~"', '{"a": "\\u007e"}', '["a", "~"]', '"a\\"b"', "[]", '{"~": "~"}']
    bad = ["", " ", "not json", '{"a": 1} x', "1],[2", "1]", "1,2", '1,"~"] x', '1,"\\u007e"] x', '1,"', '"a":1', '1}, {"v":2',
           "{", '{"a":1,"a":2}', '1, "a":2', "'x'", "1,'~'] x", "[1", '1,"~']
    df = spark.createDataFrame([(t, True) for t in good] + [(t, False) for t in bad] + [(None, False)], "t string, want boolean")
    from ledgerlake.functions.normalise import is_json_value, payload_variant
    inside = lambda a, b: F.try_parse_json(F.concat(F.lit(a), "t", F.lit(b))).isNotNull()
    got = df.select("t", "want", is_json_value(F.col("t")).alias("got"), payload_variant(F.col("t")).isNotNull().alias("made"),
                    F.coalesce(inside("[", "]") & inside('{"v":', "}"), F.lit(False)).alias("twice")).collect()
    assert [r for r in got if not r["want"] == r["got"] == r["made"] == r["twice"]] == []
