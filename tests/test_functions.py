from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway import functions as H
from headway.functions.trip_ids import TRIP_FIELDS
from headway.lookups import DIRECTION_NAMES, ROUTE_NAMES
from headway.sources import routes

# Ids chosen for their separators: missing, single, repeated, overlapping, at either end.
EDGE_CASES = [
    "081750_1..N03R", "092000_A..S02R", None, "", "abc", "a.b", "081750_1.N03R", "1.2_3",
    "081750_1..", "081750_1..N", "12_1..X9", "_1..N", "081750_..N1", "081750_1...N",
    "081750_1..N..S", "081750_A..W_extra", "0817505_Q..E0", "é81750_1..é03", ".._..", "_",
    "._", "99ZZ99_A..S", "081750__1..N",
]


def expected(trip_id: str | None) -> dict:
    """The rules of the trip id, stated as a pattern over the whole text."""
    out = dict.fromkeys(TRIP_FIELDS)
    out["raw"] = trip_id
    if not trip_id or not {".", "_"} <= set(trip_id):
        out["error"] = "Invalid trip ID format"
        return out
    found = re.match(r"(?s)(?P<time>[^_]*)_(?P<route>(?:(?!\.\.)[^_])*)\.\.(?P<tail>(?:(?!\.\.)[^_])*)", trip_id)
    if not found:
        out["error"] = "Invalid route/direction format"
        return out
    time, route, tail = found["time"], found["route"], found["tail"]
    code = tail[:1] or None
    out.update(
        departure_time=re.sub(r"(?s)^(..)(..)(..).*$", r"\1:\2:\3", time),
        route_id=route,
        route_name=ROUTE_NAMES.get(route, "Route " + route),
        direction=DIRECTION_NAMES.get(code, code),
        direction_code=code,
        destination_code=tail[1:] or None,
    )
    return out


def parse(spark, trip_ids) -> list[dict]:
    rows = spark.createDataFrame(list(enumerate(trip_ids)), "n int, trip_id string")
    parsed = rows.select("n", H.parse_trip_id(F.col("trip_id")).alias("trip"))
    return [row.trip.asDict() for row in sorted(parsed.collect(), key=lambda row: row.n)]


def test_worked_examples(spark):
    first, second = parse(spark, ["081750_1..N03R", "092000_A..S02R"])
    assert first == {
        "raw": "081750_1..N03R",
        "departure_time": "08:17:50",
        "route_id": "1",
        "route_name": "1 Train",
        "direction": "Northbound",
        "direction_code": "N",
        "destination_code": "03R",
        "error": None,
    }
    assert (second["route_name"], second["direction"]) == ("A Train", "Southbound")
    assert second["departure_time"] == "09:20:00"


def test_edge_cases(spark):
    assert parse(spark, EDGE_CASES) == [expected(trip_id) for trip_id in EDGE_CASES]


def test_overlapping_dots(spark):
    (dots,) = parse(spark, ["081750_1...N"])
    assert (dots["route_id"], dots["direction"], dots["destination_code"]) == ("1", ".", "N")


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="_.1ANSX0é", max_size=16), min_size=200, max_size=400))
def test_any_trip_id(spark, trip_ids):
    assert parse(spark, trip_ids) == [expected(trip_id) for trip_id in trip_ids]


def values(spark, column, rows, schema):
    frame = spark.createDataFrame([(n, row) for n, row in enumerate(rows)], f"n int, v {schema}")
    found = frame.select("n", column(F.col("v")).alias("out")).collect()
    return [row.out for row in sorted(found, key=lambda row: row.n)]


def test_route_names(spark):
    ids = ["1", "GS", "SI", "X9", "", None]
    assert values(spark, H.route_name, ids, "string") == [
        "1 Train", "S Train (Franklin Avenue Shuttle)", "SIR (Staten Island Railway)",
        "Route X9", "Route ", None,
    ]
    assert {tuple(row) for row in routes(spark).collect()} == set(ROUTE_NAMES.items())
    assert len(ROUTE_NAMES) == 26


def test_directions(spark):
    codes = ["N", "S", "E", "W", "X", "", None]
    names = ["Northbound", "Southbound", "Eastbound", "Westbound", "X", None, None]
    assert values(spark, H.direction_name, codes, "string") == names


def test_stop_without_dimension(spark):
    assert values(spark, H.stop_name, ["127N", None], "string") == ["Stop 127N", None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # The second value is an hour that New York skipped.
        seconds = [1763494684, 1710037800, 0, None, -1, 253402300800, 1]
        assert values(spark, H.timestamp_readable, seconds, "bigint") == [
            "2025-11-18 19:38:04", "2024-03-10 02:30:00", None, None,
            "1969-12-31 23:59:59", None, "1970-01-01 00:00:01",
        ]
        stamps = ["2024-03-10 02:30:00.9", "1969-12-31 23:59:59", None]
        back = values(spark, lambda v: H.epoch_seconds(v.cast("timestamp_ntz")), stamps, "string")
        assert back == [1710037800, -1, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_snapshot_names(spark):
    names = values(
        spark,
        lambda v: H.snapshot_filename(F.lit("vehicle_positions"), v, "json"),
        [1763494703, None],
        "bigint",
    )
    assert names == ["vehicle_positions_20251118_193823.json", None]
    paths = [
        "s3a://b/2025/11/18/vehicle_positions_20251118_193823.json",
        "trip_updates_20251117_180005.pb",
        "trip_updates_20251399_180005.pb",
        "notes.json",
        None,
    ]
    kinds = ["vehicle_positions", "trip_updates", "trip_updates", None, None]
    assert values(spark, H.snapshot_kind, paths, "string") == kinds
    seconds = [1763494703, 1763402405, None, None, None]
    assert values(spark, H.snapshot_epoch, paths, "string") == seconds


def test_feed_kinds(spark):
    asked = ["vehicle_positions", "TRIP_UPDATES", "Alerts", "buses", "", None]
    assert values(spark, H.feed_status, asked, "string") == [
        "ok", "ok", "unsupported", "invalid", "invalid", "invalid",
    ]
    assert values(spark, H.feed_type_of, asked, "string") == [
        "vehicle_positions", "trip_updates", "alerts", None, None, None,
    ]
