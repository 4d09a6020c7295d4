from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from inkstream.functions import text as X
from inkstream.functions import weeks as W
from inkstream.functions.timestamps import month_numbers, normalise


def one(spark, expr, **cols):
    return spark.createDataFrame([tuple(cols.values())], list(cols)).select(expr.alias("x")).collect()[0]["x"]


def test_norm_and_shingles(spark):
    assert one(spark, X.norm(F.col("t")), t="Hé, World--9") == "h world 9"
    assert one(spark, X.shingles(F.col("t")), t="ab") == ["ab"]
    assert sorted(one(spark, X.shingles(F.col("t")), t="abcd")) == ["abc", "bcd"]


def test_hits_do_not_overlap(spark):
    assert one(spark, X.hit_count(F.col("t"), "launch"), t="launch launched") == 2
    assert one(spark, X.hit_count(F.col("t"), "aa"), t="aaaa") == 2


def test_urls(spark):
    assert one(spark, X.apex(F.col("u")), u="https://about.example.com/x") == "example.com"
    assert one(spark, X.apex(F.col("u")), u="https://a.example.co.uk") == "co.uk"
    assert one(spark, X.without_query(F.col("u")), u="http://a/b?c=1#d") == "http://a/b"


def test_json_object(spark):
    assert one(spark, X.json_object(F.col("t"), "k int")["k"], t='well: {"k": 3} ok') == 3
    assert one(spark, X.json_object(F.col("t"), "k int"), t="none") is None


@pytest.mark.parametrize(("day", "key", "iso", "monday"), [("2024-12-30", "2024-W01", "2025-W01", "2024-W53"), ("2026-11-25", "2026-W48", "2026-W48", "2026-W47")])
def test_week_keys(spark, day, key, iso, monday):
    t = F.to_timestamp("d")
    got = spark.createDataFrame([(day,)], "d string").select(W.week_key(t), W.iso_week_key(t), W.monday_week_key(t)).collect()[0]
    assert tuple(got) == (key, iso, monday)


def test_weeks_between(spark):
    rows = [("2024-W10", ""), ("2024-W10", "2024-W06"), ("2024-W06", "2024-W10"), ("2023-W53", "2023-W01"), (None, "2024-W01")]
    df = spark.createDataFrame(rows, "a string, b string").select(W.weeks_between(F.col("a"), F.col("b")).alias("n"))
    assert [r["n"] for r in df.collect()] == [0, 4, 0, 0, 0]
    assert one(spark, W.week_to_date(F.col("k")), k="2023-W53") is None


def test_rfc822_age(spark):
    now = F.lit("2026-01-03 00:00:00").cast("timestamp")
    assert one(spark, W.rfc822_age_days(F.col("t"), now), t="Thu, 01 Jan 2026 00:00:00 GMT") == 2.0
    assert one(spark, W.rfc822_age_days(F.col("t"), now), t="Fri, 09 Jan 2026 00:00:00 +0000") == 0.0
    assert one(spark, W.rfc822_age_days(F.col("t"), now), t="2026-01-01T00:00:00") is None


CASES = [
    ("2025-06-15T25:10:00+00:00", None, None, "invalid"), ("2025-02-30T10:15:00Z", None, None, "invalid"), ("n/a", "UTC", None, "invalid"), ("", "UTC", None, None), (None, "UTC", None, None), ("   ", "UTC", None, None),
    ("2025-10-26T02:29:34", "Europe/Berlin", None, "ambiguous"), ("3/9/2025 02:41:46", "America/Los_Angeles", "en-US", "nonexistent"), ("2025-03-09T02:12:06", "America/New_York", None, "nonexistent"),
    ("02/05/2026 02:22 AM", "UTC", "en-US", "2026-02-05T02:22:00.000Z"), ("02/05/2026 02:22", "UTC", "en-GB", "2026-05-02T02:22:00.000Z"), ("12:57", "UTC", None, "invalid"),
    ("January 16, 2026 12:57 AM", "UTC", "en-US", "2026-01-16T00:57:00.000Z"), ("1763180492", None, None, "2025-11-15T04:21:32.000Z"), ("1770289809570675", None, None, "2026-02-05T11:10:09.570Z"), ("-1", None, None, "1969-12-31T23:59:59.000Z"),
    ("2025-08-26T18:24:09.446309732Z", None, None, "2025-08-26T18:24:09.446Z"), ("2026-05-26 06:00:34 America/New_York", "UTC", None, "2026-05-26T10:00:34.000Z"), ("2024-09-30T07:00:18[Asia/Kolkata]", "UTC", None, "2024-09-30T01:30:18.000Z"),
    ("17. September 2025, 13:40 Uhr", "Europe/Berlin", "de-DE", "2025-09-17T11:40:00.000Z"), ("15 de octubre de 2024, 18:03", "Europe/Madrid", "es-ES", "2024-10-15T16:03:00.000Z"), ("Tue, 03 Sep 24 08:54:24 +0000", None, None, "2024-09-03T08:54:24.000Z"),
    ("2025-06-23", "America/New_York", None, "2025-06-23T04:00:00.000Z"), ("20260424T041155Z", None, None, "2026-04-24T04:11:55.000Z"), ("Sat, 1 Mar 2025 10:00:00 EDT", None, None, "2025-03-01T14:00:00.000Z"), ("2025-01-01 10:00", None, None, "invalid"), ("2025-01-01 10:00", "Mars/Base", None, "invalid"),
    ("Sun, 15 Mar 2026 15:48:54 XYZ", "UTC", None, "invalid"), ("0000-00-00 00:00:00", "UTC", None, "invalid"),
]


def test_timestamps(spark):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(CASES)], "i int, v string, z string, l string, utc_expected string")
    got = {r["i"]: r["utc"] for r in normalise(df, "v", "z", "l").collect()}
    assert {i: got[i] for i in range(len(CASES))} == {i: c[3] for i, c in enumerate(CASES)}


def test_local_times_against_zoneinfo(spark):
    zones, rows = ["America/New_York", "Europe/Berlin", "Australia/Sydney", "Asia/Kolkata", "America/Sao_Paulo"], []
    for z in zones:
        t = datetime(2024, 10, 1)
        while t < datetime(2025, 11, 15):
            rows.append((t.isoformat(), z))
            t += timedelta(hours=13, minutes=30)
    got = {(r["v"], r["z"]): r["utc"] for r in normalise(spark.createDataFrame([(*r, None) for r in rows], "v string, z string, l string"), "v", "z", "l").collect()}
    for v, z in rows:
        t = datetime.fromisoformat(v)
        a, b = (t.replace(tzinfo=ZoneInfo(z), fold=f).astimezone(timezone.utc) for f in (0, 1))
        back = a.astimezone(ZoneInfo(z)).replace(tzinfo=None) == t
        want = "nonexistent" if not back else "ambiguous" if a != b else a.strftime("%Y-%m-%dT%H:%M:%S.000Z")
        assert got[v, z] == want, (v, z)


def test_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([("2025-01-01T00:00:00Z", "UTC", "en-US", 1)], "v string, z string, l string, y int")
    assert normalise(df, "v", "z", "l").columns == ["v", "z", "l", "y", "utc_ms", "utc", "canonical"]
    assert normalise(df.limit(0), "v", "z", "l").count() == 0


def test_months_are_unambiguous():
    m = month_numbers()
    assert m["mai"] == 5 and m["märz"] == 3 and m["juil"] == 7 and set(m.values()) == set(range(1, 13))
