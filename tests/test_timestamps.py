from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from sheetloom.operators.timestamps import abbreviation_offsets, normalise_timestamps
from sheetloom.tables import materialise

SITES = [("ny", "America/New_York", "MDY"), ("de", "Europe/Berlin", "DMY"), ("in", "Asia/Kolkata", "DMY"), ("odd", "Not/AZone", "MDY")]


def us(text: str, zone: str = "UTC") -> int:
    at = datetime.fromisoformat(text).replace(tzinfo=ZoneInfo(zone))
    return int((at - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1))


CASES = [
    ("ny", "2021-07-01T12:00:00Z", us("2021-07-01T12:00:00")),
    ("ny", "2021-07-01T12:00:00.1234567Z", us("2021-07-01T12:00:00.123456")),
    ("ny", "2021-07-01 12:00:00", us("2021-07-01T12:00:00", "America/New_York")),
    ("ny", "  2021-07-01 12:00:00.5 ", us("2021-07-01T12:00:00.5", "America/New_York")),
    ("ny", "2021-07-01", us("2021-07-01T00:00:00", "America/New_York")),
    ("ny", "20210701", us("2021-07-01T00:00:00", "America/New_York")),
    ("ny", "07/04/2021", us("2021-07-04T00:00:00", "America/New_York")),
    ("de", "07/04/2021", us("2021-04-07T00:00:00", "Europe/Berlin")),
    ("de", "07.04.2021 13:45", us("2021-04-07T13:45:00", "Europe/Berlin")),
    ("ny", "7/4/21", us("2021-07-04T00:00:00", "America/New_York")),
    ("ny", "07/04/2021 1:05 PM", us("2021-07-04T13:05:00", "America/New_York")),
    ("ny", "07/04/2021 12:05 AM", us("2021-07-04T00:05:00", "America/New_York")),
    ("ny", "2021-07-01T12:00:00-04:00", us("2021-07-01T16:00:00")),
    ("ny", "2021-07-01 12:00:00+0530", us("2021-07-01T06:30:00")),
    ("in", "2021-07-01 12:00:00 IST", us("2021-07-01T06:30:00")),
    ("ny", "2021-07-01 12:00:00 EST", us("2021-07-01T17:00:00")),
    ("ny", "2021-07-01T12:00:00[Europe/Berlin]", us("2021-07-01T10:00:00")),
    ("ny", "2021-07-01 12:00:00 Asia/Tokyo", us("2021-07-01T03:00:00")),
    ("ny", "Thu, 01 Jul 2021 12:00:00 -0400", us("2021-07-01T16:00:00")),
    ("ny", "D:20210701120000-04'00'", us("2021-07-01T16:00:00")),
    ("ny", "1 Jul 2021", us("2021-07-01T00:00:00", "America/New_York")),
    ("ny", "01-JUL-21", us("2021-07-01T00:00:00", "America/New_York")),
    ("de", "24. März 2021", us("2021-03-24T00:00:00", "Europe/Berlin")),
    ("de", "4. Dezember 2019", us("2019-12-04T00:00:00", "Europe/Berlin")),
    ("ny", "July 4, 2021", us("2021-07-04T00:00:00", "America/New_York")),
    ("ny", "Jul 4, 2021 14:30", us("2021-07-04T14:30:00", "America/New_York")),
    ("ny", "1625140800", 1625140800 * 10**6),
    ("ny", "1625140800123", 1625140800123 * 10**3),
    ("ny", "2021-11-07 01:30:00", us("2021-11-07T05:30:00")),  # occurs twice: the earlier
    ("ny", "2021-03-14 02:30:00", us("2021-03-14T07:30:00")),  # skipped: offset before the change
    (None, "2021-07-01T12:00:00Z", us("2021-07-01T12:00:00")),
    ("gone", "2021-07-01T12:00:00+02:00", us("2021-07-01T10:00:00")),
    ("ny", "2021-02-30", None),
    ("ny", "00/00/0000", None),
    ("ny", "2023-13-45", None),
    ("de", "04/13/2021", None),
    ("ny", "TBD", None),
    ("ny", "", None),
    ("ny", None, None),
    (None, "2021-07-01", None),
    ("odd", "x" * 50_000, None),
]


@pytest.fixture(scope="module")
def result(spark):
    rows = [(i, s, v, datetime(2022, 1, 1), "extra") for i, (s, v, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id int, source string, value string, seen_at timestamp, site_tz string")
    sites = spark.createDataFrame(SITES, "source string, site_tz string, date_order string")
    return {r["id"]: r for r in normalise_timestamps(df, sites, keep=materialise).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_notation(result, i):
    assert result[i]["utc_us"] == CASES[i][2], CASES[i]


def test_every_row_once(result):
    assert len(result) == len(CASES)
    assert result[0]["site_tz"] == "extra"


def test_zone_is_estimated_from_told_offsets_and_arrival(spark):
    """Sites that nobody declared get the zone that fits their offsets over the changes of daylight saving."""
    rows = []
    for k in range(40):
        at = datetime(2020, 1, 5, 12) + timedelta(days=9 * k)
        for site, zone in (("a", "Europe/Berlin"), ("b", "America/Denver")):
            told = at.replace(tzinfo=ZoneInfo(zone)).isoformat()
            rows += [(site, told, at + timedelta(days=3)), (site, at.isoformat(), at + timedelta(days=3))]
    df = spark.createDataFrame(rows, "source string, value string, seen_at timestamp")
    sites = spark.createDataFrame([(z, z, "MDY") for z in ("Europe/Berlin", "America/Denver", "America/Phoenix", "Asia/Tokyo")], "source string, site_tz string, date_order string")
    got = normalise_timestamps(df, sites).where("zone_source = 'estimated'").groupBy("source", "zone_used").agg(F.count("*").alias("n")).collect()
    assert {(r[0], r[1], r[2]) for r in got} == {("a", "Europe/Berlin", 40), ("b", "America/Denver", 40)}


def test_contradicted_site(spark):
    rows = [("x", (datetime(2020, 1, 1, 12) + timedelta(days=k)).isoformat() + "-05:00", datetime(2021, 1, 1)) for k in range(20)] + [("x", "2020-01-01 10:00:00", datetime(2021, 1, 1))]
    df = spark.createDataFrame(rows, "source string, value string, seen_at timestamp")
    sites = spark.createDataFrame([("x", "Asia/Tokyo", "MDY")], "source string, site_tz string, date_order string")
    assert [r["contradicted"] for r in normalise_timestamps(df, sites).where("zone_source = 'declared'").collect()] == [True]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "source string, value string, seen_at timestamp")
    sites = spark.createDataFrame([], "source string, site_tz string, date_order string")
    assert normalise_timestamps(df, sites).count() == 0
    one = spark.createDataFrame([("a", "2020-01-01", None), ("a", "2020-01-01T00:00:00Z", None)], "source string, value string, seen_at timestamp")
    assert sorted(r["utc_us"] is None for r in normalise_timestamps(one, sites).collect()) == [False, True]


def test_abbreviations():
    got = abbreviation_offsets(["America/Chicago", "Europe/London"])
    assert got["America/Chicago|CST"] == -6 * 3600 and got["America/Chicago|CDT"] == -5 * 3600 and got["Europe/London|BST"] == 3600


def estimates(spark, rows, zones):
    df = spark.createDataFrame(rows, "source string, value string, seen_at timestamp")
    sites = spark.createDataFrame([(z, z, "MDY") for z in zones], "source string, site_tz string, date_order string")
    return {(r["source"], r["zone_source"], r["zone_used"]) for r in normalise_timestamps(df, sites).select("source", "zone_source", "zone_used").distinct().collect()}


def test_estimate_is_not_drawn_east(spark):
    """Bare winter values of London taken in after five minutes: zones further east only make them look older."""
    rows = [("x", (at := datetime(2022, 1, 1, 8) + timedelta(hours=7 * k)).isoformat(), at + timedelta(minutes=5)) for k in range(28)]
    assert estimates(spark, rows, ["America/Chicago", "Europe/London", "Asia/Tokyo"]) == {("x", "estimated", "Europe/London")}


def test_zone_that_evidence_does_not_single_out_stays_open(spark):
    """Arrival after days fits every zone; zones with the same instants are one."""
    slow = [("x", (at := datetime(2022, 1, 1, 8) + timedelta(hours=7 * k)).isoformat(), at + timedelta(days=4)) for k in range(28)]
    quick = [("y", (at := datetime(2022, 1, 1, 8) + timedelta(hours=7 * k)).isoformat(), at - timedelta(minutes=50)) for k in range(28)]
    assert estimates(spark, slow + quick + [("z", "2022-01-01 08:00", None)], ["America/Chicago", "Europe/Berlin", "Europe/Paris", "Asia/Tokyo"]) == {("x", "open", None), ("y", "estimated", "Europe/Berlin"), ("z", "open", None)}
