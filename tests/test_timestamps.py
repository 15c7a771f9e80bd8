"""Problem 1: notations, zones, daylight saving, estimation."""

import calendar
import datetime as dt
import random
import zoneinfo

import pytest
from pyspark.sql import functions as F

from postlens.operators.timestamps import estimate_zones, to_instants, utc_ms, with_fields, zone_report


def ms(*parts):
    return calendar.timegm(dt.datetime(*parts).timetuple()) * 1000


CASES = [
    ("2026-10-25T19:42:00Z", ms(2026, 10, 25, 19, 42)),
    ("2026-07-01 12:00:00", ms(2026, 7, 1, 10)),  # Berlin summer
    ("2026-01-05", ms(2026, 1, 4, 23)),
    ("2026-10-25 02:30", ms(2026, 10, 25, 0, 30)),  # occurs twice: the first
    ("2026-03-29T02:30:00", ms(2026, 3, 29, 1, 30)),  # skipped: offset before the change
    ("20251103T171656Z", ms(2025, 11, 3, 17, 16, 56)),
    ("1769638090", 1769638090000),
    ("1769638090782", 1769638090782),
    ("1774944015720999", 1774944015720),
    ("1780551292.7529", 1780551292752),
    ("2026-08-10T04:23:43,936999Z", ms(2026, 8, 10, 4, 23, 43) + 936),
    ("Wed, 24 Dec 2025 17:07:51 +0530", ms(2025, 12, 24, 11, 37, 51)),
    ("2026-05-25 12:59:13 EDT", ms(2026, 5, 25, 16, 59, 13)),
    ("2026-08-27 18:45:32 GMT-3:30", ms(2026, 8, 27, 22, 15, 32)),
    ("2026-11-01T03:51:16+01:00[Europe/Berlin]", ms(2026, 11, 1, 2, 51, 16)),
    ("2026-05-20 01:06:09 America/New_York", ms(2026, 5, 20, 5, 6, 9)),
    ("30. Mai 2026, 06:22 Uhr", ms(2026, 5, 30, 4, 22)),
    ("31 août 2026 à 20:35", ms(2026, 8, 31, 18, 35)),
    ("22 de septiembre de 2025 21:37", ms(2025, 9, 22, 19, 37)),
    ("2 de julho de 2026 às 20:18", ms(2026, 7, 2, 18, 18)),
    ("Tuesday, August 11, 2026 12:03:23", ms(2026, 8, 11, 10, 3, 23)),
    ("Feb 19, 2026 12:06 AM", ms(2026, 2, 18, 23, 6)),
    ("03/04/2026 10:00", ms(2026, 4, 3, 8)),  # day first
    ("5.1.26", ms(2026, 1, 4, 23)),
    ("  2026-11-14  07:42:28 ", ms(2026, 11, 14, 6, 42, 28)),
]
NONE = [None, "", "  ", "null", "2026-02-30", "31/06/2026 10:20", "2026-04-15T25:61:00", "2026-06-", "KW 15", "Q3 2026", "gestern", "hace 11 días", "11+ days ago", "13/13/2026", "2026-01-01 13:00 PM", "x" * 5000]


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame([("b", "Europe/Berlin", "DMY"), ("n", "America/New_York", "MDY"), ("z", None, None)], "source string, tz_name string, date_order string")


def read(spark, registry, rows):
    df = spark.createDataFrame([(i, v, s, dt.datetime(2026, 12, 31)) for i, (v, s) in enumerate(rows)], "row_id bigint, v string, source string, seen timestamp_ntz")
    return {r["row_id"]: r["epoch_ms"] for r in to_instants(df, "v", "source", registry, "seen").collect()}


def test_notations(spark, registry):
    got = read(spark, registry, [(v, "b") for v, _ in CASES])
    assert [got[i] for i in range(len(CASES))] == [e for _, e in CASES]


def test_no_instant(spark, registry):
    got = read(spark, registry, [(v, "b") for v in NONE])
    assert len(got) == len(NONE) and not any(got.values())


def test_date_order_and_zone_of_source(spark, registry):
    got = read(spark, registry, [("03/04/2026 10:00", "n"), ("2026-01-15 08:00", "n")])
    assert got == {0: ms(2026, 3, 4, 15), 1: ms(2026, 1, 15, 13)}


def test_repeated_rows_and_session_zone(spark, registry):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert read(spark, registry, [("2026-07-01 12:00:00", "b")] * 3) == dict.fromkeys(range(3), ms(2026, 7, 1, 10))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_estimated_zone_of_unregistered_source(spark, registry):
    rows = []
    for day in range(1, 29):
        for month in (1, 7):
            utc = dt.datetime(2026, month, day, 9)
            local = utc + dt.timedelta(hours=11 if month == 1 else 10)  # Sydney
            rows.append((len(rows), local.strftime("%Y-%m-%d %H:%M:%S"), "unknown", utc + dt.timedelta(minutes=5)))
    df = spark.createDataFrame(rows, "row_id bigint, v string, source string, seen timestamp_ntz")
    got = {r["row_id"]: r["epoch_ms"] for r in to_instants(df, "v", "source", registry, "seen").collect()}
    assert got[0] == ms(2026, 1, 1, 9) and got[1] == ms(2026, 7, 1, 9)
    parsed = with_fields(df.withColumn("date_order", F.lit("DMY")), "v", "date_order")
    est = estimate_zones(parsed, "source", utc_ms(parsed, "seen"), None, ["UTC", "Australia/Sydney", "Asia/Tokyo"]).first()
    assert est["estimated_zone"] == "Australia/Sydney" and est["violations"] == 0


def test_empty_table_and_clashing_columns(spark, registry):
    df = spark.createDataFrame([], "row_id bigint, v string, source string, seen timestamp_ntz, tz_name string, p int, _low string")
    assert to_instants(df, "v", "source", registry, "seen").count() == 0
    df = spark.createDataFrame([(1, "2026-01-15 08:00Z", "b", dt.datetime(2026, 2, 1), "x", 1, "y")], df.schema)
    assert to_instants(df, "v", "source", registry, "seen").first()["epoch_ms"] == ms(2026, 1, 15, 8)


def test_hidden_zones_are_found_from_lags(spark):
    """Sources whose values with a zone lie up to two days back: neither earlier nor later zones fit the others."""
    rng, rows, zones = random.Random(3), [], {"london": "Europe/London", "berlin": "Europe/Berlin", "york": "America/New_York", "utc": "UTC", "kolkata": "Asia/Kolkata"}
    for name, zone in zones.items():
        for k in range(2000):
            at = dt.datetime(2026, 1, 1) + dt.timedelta(minutes=rng.randint(0, 500_000))
            seen = at + dt.timedelta(hours=rng.uniform(0.1, 48) if rng.random() > 0.08 else rng.uniform(48, 900))
            local = at.replace(tzinfo=dt.UTC).astimezone(zoneinfo.ZoneInfo(zone))
            rows.append((len(rows), at.strftime("%Y-%m-%dT%H:%M:%SZ") if k % 2 else local.strftime("%Y-%m-%d %H:%M:%S"), name, seen))
    df = spark.createDataFrame(rows, "row_id bigint, v string, source string, seen timestamp_ntz")
    nothing = spark.createDataFrame([("utc", None, None)], "source string, tz_name string, date_order string")
    got = {r["source"]: r["estimated_zone"] for r in zone_report(df, "v", "source", nothing, "seen").collect()}
    assert got == zones


def test_declared_zone_holds_whatever_the_values_say(spark, registry):
    rows = [(f"2026-12-31 {h:02}:30:00", "n") for h in range(1, 24)]
    assert read(spark, registry, rows)[0] == ms(2026, 12, 31, 6, 30)
