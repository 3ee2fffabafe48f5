"""Times as text: every branch, votes, zones with gaps and repeats, odd rows."""

import random
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest

from corpusloom.llm import stamps

SCHEMA = "stamp_id long, source string, zone string, raw string, utc_us string, __raw int, order int"


def us(*parts):
    return int((datetime(*parts, tzinfo=UTC) - datetime(1970, 1, 1, tzinfo=UTC)) / timedelta(microseconds=1))


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, *r, None, None, None) for i, r in enumerate(rows)], SCHEMA).repartition(3)
    out = stamps.normalise(df, **more)
    assert set(out.columns) == {"stamp_id", "source", "zone", "raw", "utc_us", "__raw", "order", "rule", "ambiguous"}
    return {r["stamp_id"]: (r["utc_us"], r["rule"], r["ambiguous"]) for r in out.collect()}


CASES = [
    ("1718699946", "UTC", (1718699946 * 10**6, "epoch", False)),
    (" \t1718699946123\x0b\n", None, (1718699946123 * 10**3, "epoch", False)),
    ("171869994", "UTC", None), ("17186999461", "UTC", None),
    ("2024-06-04T17:12:06-0800", None, (us(2024, 6, 5, 1, 12, 6), "plain", False)),
    ("2024-06-04T17:12:06 +05:30", "UTC", (us(2024, 6, 4, 11, 42, 6), "plain", False)),
    ("2024-06-04 05:12 PM Z", "Asia/Kolkata", (us(2024, 6, 4, 17, 12), "plain", False)),
    ("2024-06-04 12:00AM", "UTC", (us(2024, 6, 4), "plain", False)), ("2024-06-04 12:30:01PM", "UTC", (us(2024, 6, 4, 12, 30, 1), "plain", False)),
    ("20240110", "UTC", (us(2024, 1, 10), "plain", False)), ("08.06.2024 09:27:34", "Asia/Kolkata", (us(2024, 6, 8, 3, 57, 34), "plain", False)),
    ("08 May 2024 13:46", "Europe/Berlin", (us(2024, 5, 8, 11, 46), "plain", False)), ("29 Feb 2024", "UTC", (us(2024, 2, 29), "plain", False)),
    ("29 Feb 2023", "UTC", None), ("08 may 2024", "UTC", None), ("2024-13-01", "UTC", None), ("2024-06-04 24:00", "UTC", None), ("2024-06-04 10:60", "UTC", None), ("2024-06-04 10:00:60", "UTC", None),
    ("2024-06-04 13:00 PM", "UTC", None), ("2024-06-04 00:00 AM", "UTC", None), ("2024-06-04T10:00+15:00", "UTC", None), ("2024-06-04T10:00+1400", "UTC", (us(2024, 6, 3, 20), "plain", False)), ("2024-06-04T", "UTC", None),
    ("2024-06-04 ", "UTC", None), ("2124-06-04", "UTC", None), ("1999-06-04", "UTC", None), ("2024-06-04 1:00", "UTC", None), ("2024-06-04 10:00 pm", "UTC", None), ("２０２4-06-04", "UTC", None),
    (None, "UTC", None), ("", "UTC", None), ("word " * 50_000, "UTC", None), ("1" * 100_000, "UTC", None),
    ("2024-06-04 10:00", None, None), ("2024-06-04 10:00", "Mars/Base", None),
    ("2024-03-10 02:30", "America/New_York", (us(2024, 3, 10, 6, 30), "plain", True)), ("2024-03-10 03:00", "America/New_York", (us(2024, 3, 10, 7), "plain", False)),
    ("2024-11-03 01:30", "America/New_York", (us(2024, 11, 3, 6, 30), "plain", True)), ("2024-11-03 02:00", "America/New_York", (us(2024, 11, 3, 7), "plain", False)), ("2024-11-03 00:59", "America/New_York", (us(2024, 11, 3, 4, 59), "plain", False)),
    ("2011-12-30 12:00", "Pacific/Apia", (us(2011, 12, 29, 22), "plain", True)), ("2011-12-31 05:00", "Pacific/Apia", (us(2011, 12, 30, 15), "plain", False)), ("03/03/2024", "UTC", (us(2024, 3, 3), "plain", False)),
]


def test_cases(spark):
    got = run(spark, [("s", zone, raw) for raw, zone, _ in CASES])
    for i, (raw, _, wanted) in enumerate(CASES):
        assert got[i] == (wanted or (None, "bad", False)), (raw or "")[:40]


@pytest.mark.parametrize("most_sources", [stamps.SOURCES, 0])
def test_votes(spark, monkeypatch, most_sources):
    """By broadcast, and by the way that shuffles the rows of sources that are not hot."""
    monkeypatch.setattr(stamps, "LEAST_HOT", 3)
    monkeypatch.setattr(stamps, "HOT_KEYS", 4)
    day, month, both = "25/04/2024", "04/25/2024", "05/04/2024"
    groups = {
        "d": ([day] * 11 + [month] + [both] * 8, ("votes", 4)), "tie": ([day] * 10 + [month] + [both] * 2, ("default", 4)), "m": ([month] * 1 + [both] * 9, ("votes", 5)), None: ([month] + [both], ("votes", 5)),
        "none": ([both], ("default", 4)), "bad": (["04/25/2024 10:60", "04/25/2024 24:00", both], ("default", 4)),
    }
    rows = [(source, "UTC", raw) for source, (raws, _) in groups.items() for raw in raws]
    got = run(spark, rows, most_sources=most_sources)
    for i, (source, _, raw) in enumerate(rows):
        rule, at = groups[source][1]
        if raw == both:
            assert got[i] == (us(2024, at, 9 - at), rule, True), (source, raw)
        else:
            assert got[i] == ((None, "bad", False) if ":" in raw else (us(2024, 4, 25), "plain", False))


def test_zones_against_brute_force(spark):
    """Wall times around every change of offset from 2000 on: all instants within two days are tried in turn."""
    random.seed(5)
    rows, wanted = [], []
    for zone in ("America/New_York", "Europe/Berlin", "Australia/Lord_Howe", "Africa/Casablanca", "Asia/Kolkata", "America/Sao_Paulo", "Pacific/Chatham"):
        z = ZoneInfo(zone)
        hour = datetime(2015, 1, 1, tzinfo=UTC)
        while hour.year < 2018:
            after = hour + timedelta(hours=1)
            if hour.astimezone(z).utcoffset() != after.astimezone(z).utcoffset():
                for _ in range(20):
                    wall = (hour.astimezone(z).replace(tzinfo=None) + timedelta(minutes=random.randrange(-180, 240))).replace(second=0)
                    offsets = {x.astimezone(z).utcoffset() for x in (hour - timedelta(hours=1), after + timedelta(hours=1))}
                    fits = [o for o in offsets if (wall - o).replace(tzinfo=UTC).astimezone(z).replace(tzinfo=None) == wall]
                    new = (after + timedelta(hours=1)).astimezone(z).utcoffset()
                    rows.append(("s", zone, wall.strftime("%Y-%m-%d %H:%M")))
                    wanted.append((int(((wall - (fits[0] if len(fits) == 1 else new)) - datetime(1970, 1, 1)) / timedelta(microseconds=1)), "plain", len(fits) != 1))
            hour = after
    assert len(rows) > 300
    got = run(spark, rows)
    assert [got[i] for i in range(len(rows))] == wanted


def test_no_rows(spark):
    assert run(spark, [("s", "UTC", None)]) == {0: (None, "bad", False)}
    assert stamps.normalise(spark.createDataFrame([], SCHEMA)).count() == 0
