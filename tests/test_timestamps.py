import datetime as dt
from zoneinfo import ZoneInfo

import pytest

from quillspark.functions.dates import clock_reading
from quillspark.operators.timestamps import CANDIDATE_ZONES, estimate_zones, normalise_written, written_dates

_UTC = dt.timezone.utc


def _live(zone, form="%Y-%m-%d %H:%M:%S", n=40):
    """Readings of a zone's clock all through a year, each some minutes before its ingestion."""
    for i in range(n):
        at = dt.datetime(2024, 1, 3, 2, 7, tzinfo=_UTC) + dt.timedelta(days=9 * i, hours=5 * i)
        yield (at - dt.timedelta(minutes=3 + i % 9)).astimezone(ZoneInfo(zone)).strftime(form), at


def test_every_zone_is_recovered_from_its_own_readings(spark):
    rows = [(z, v, at) for z in CANDIDATE_ZONES for v, at in _live(z)]
    got = estimate_zones(spark.createDataFrame(rows, "source string, value string, ingested_at timestamp"))
    assert {r.source: r.home_tz for r in got.collect()} == {z: z for z in CANDIDATE_ZONES}


def test_readings_far_from_ingestion_leave_the_first_zone(spark):
    rows = [("a", v, at + dt.timedelta(days=900)) for v, at in _live("America/Denver")]
    got = estimate_zones(spark.createDataFrame(rows, "source string, value string, ingested_at timestamp"))
    assert [r.home_tz for r in got.collect()] == ["UTC"]


def test_zones_are_estimated_where_feeds_are_withheld(spark):
    cands = [(i, "arxiv", v, at) for i, (v, at) in enumerate(_live("America/New_York", "%m/%d/%Y %H:%M:%S"))]
    body = '{"data": [{"publicationDate": "%s"}]}'
    pays = [(i, "s2", at, body % v) for i, (v, at) in enumerate(_live("America/Los_Angeles"))]
    values = written_dates(
        spark.createDataFrame(cands, "cand_id bigint, source string, published string, fetched_at timestamp"),
        spark.createDataFrame(pays, "payload_id bigint, source string, fetched_at timestamp, body string"),
    )
    assert values.where("ingested_at IS NULL").isEmpty()
    feeds = spark.createDataFrame([("arxiv", None, "mdy")], "source string, home_tz string, date_order string")
    got = {(r.source, r.row_id): r.norm for r in normalise_written(values, feeds).collect()}
    want = {}
    for s, live in (("arxiv", _live("America/New_York")), ("s2", _live("America/Los_Angeles"))):
        for i, (_, at) in enumerate(live):
            want[s, i] = (at - dt.timedelta(minutes=3 + i % 9)).strftime("%Y-%m-%dT%H:%M:%SZ")
    assert got == want


@pytest.mark.parametrize("text", ["04/26/2012 12:13:21", "26.04.2012 12:13:21", "26 April 2012 12:13:21", "April 26, 2012 12:13:21", "2012-04-26T12:13:21"])
def test_clock_readings_of_all_forms_are_read(text):
    assert clock_reading(text, True) == dt.datetime(2012, 4, 26, 12, 13, 21)
