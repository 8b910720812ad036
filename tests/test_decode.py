from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.operators import decode as dec
from headway.operators import snapshots as snap
from headway.operators.trips import explode_stop_times, project_trips
from headway.operators.vehicles import (
    interpret_vehicles,
    project_vehicles,
    with_stop_names,
)
from tests import snapshots as make


def raw(spark, *contents):
    rows = [(n, None if content is None else bytearray(content)) for n, content in enumerate(contents)]
    return spark.createDataFrame(rows, "n int, content binary")


@pytest.fixture()
def decoded(spark, feed_message):
    makers = [
        make.full_vehicle, make.bare_vehicle, make.hollow_vehicle,
        make.trip, make.trip_without_stops, make.neither,
    ]
    return dec.decode(raw(spark, make.feed(feed_message, makers)))


def test_vehicle_presence(decoded):
    vehicles = project_vehicles(dec.entities(decoded, "n"), "n")
    full, bare, hollow = sorted(vehicles.collect(), key=lambda row: row.id)
    assert full.id == "000003" and full.vehicle_id == "V1" and full.route_id == "1"
    # Coordinates are single precision on the wire and are widened as they are.
    assert full.position.latitude == 40.758899688720703
    assert (full.position.bearing, full.position.speed) == (0.0, 0.0)
    assert (full.current_stop_sequence, full.current_status, full.stop_id) == (38, 1, "127N")
    assert (bare.vehicle_id, bare.trip_id, bare.route_id) == (None, None, None)
    assert bare.position.asDict() == dict.fromkeys(("latitude", "longitude", "bearing", "speed"))
    assert (bare.timestamp, bare.current_status, bare.stop_id) == (None, None, None)
    assert (hollow.vehicle_id, hollow.trip_id, hollow.route_id) == ("", "", "")
    assert set(hollow.position) == {0.0}


def test_trip_presence(decoded):
    trips = project_trips(dec.entities(decoded, "n"), "n")
    empty, trip = sorted(trips.collect(), key=lambda row: row.id)
    assert (empty.trip_id, empty.route_id, empty.timestamp) == ("", "", None)
    assert empty.stop_time_updates == []
    first, second = trip.stop_time_updates
    assert (first.stop_sequence, first.stop_id, first.departure) == (1, "A01S", None)
    assert tuple(first.arrival) == (100, -3)
    assert (second.stop_sequence, second.stop_id, second.arrival) == (None, None, None)
    assert tuple(second.departure) == (0, 0)
    flat = explode_stop_times(trips).orderBy("id", "stop_pos").collect()
    assert [(row.id, row.stop_pos) for row in flat] == [("empty", None), ("trip", 0), ("trip", 1)]


def test_entity_order(decoded):
    rows = dec.entities(decoded).orderBy("entity_pos").collect()
    ids = ["000003", "bare", "hollow", "trip", "empty", "neither"]
    assert [row.id for row in rows] == ids


def test_parsed_form(decoded):
    (vehicles,) = snap.parsed_vehicle_snapshots(dec.good(decoded)).collect()
    assert vehicles.vehicle_count == 3 and vehicles.header.timestamp == 1763494684
    assert vehicles.vehicles[0].stop_id == 1  # the status number, as stored
    (trips,) = snap.parsed_trip_snapshots(dec.good(decoded)).collect()
    assert trips.trip_count == 2


def test_bad_snapshots_are_rows(spark, feed_message):
    good = make.feed(feed_message, [make.full_vehicle])
    text = feed_message()
    text.entity.add().id = "xx"
    not_utf8 = text.SerializePartialToString().replace(b"xx", b"\xff\xfe")
    late = make.feed(feed_message, timestamp=2**63)
    frame = dec.decode(raw(spark, good, b"\xff\xff\xff", not_utf8, late, good[:-3], None, b""))
    problems = {row.n: row for row in dec.quarantine(frame).collect()}
    assert sorted(problems) == [1, 2, 4, 5, 6]
    assert "DecodeError" in problems[1].decode_error
    assert sorted(row.n for row in dec.good(frame).collect()) == [0, 3]
    headers = {row.n: row for row in dec.headers(frame, "n").collect()}
    assert (headers[0].gtfs_realtime_version, headers[0].header_timestamp) == ("2.0", 1763494684)
    assert headers[3].header_timestamp is None  # beyond a BIGINT; the rest of it stays


def test_kind_chooses_the_payload(spark, feed_message):
    content = make.feed(feed_message, [make.full_vehicle, make.trip])
    kinds = F.element_at(
        F.array(*[F.lit(k) for k in ("vehicle_positions", "trip_updates", "alerts")]), F.col("n") + 1
    )
    frame = dec.decode(raw(spark, content, content, content), feed_type=kinds)
    rows = dec.entities(frame, "n")
    assert [row.n for row in project_vehicles(rows, "n").collect()] == [0]
    assert [row.n for row in project_trips(rows, "n").collect()] == [1]
    (alerts,) = dec.quarantine(frame).collect()
    assert alerts.n == 2 and "alerts" in alerts.decode_error


def test_record_without_id(spark, feed_message):
    def nameless(entity):
        entity.vehicle.SetInParent()
        entity.trip_update.SetInParent()

    frame = dec.decode(raw(spark, make.feed(feed_message, [nameless])))
    rows = dec.entities(frame)
    assert [row.id for row in project_vehicles(rows).collect()] == [""]
    assert [row.id for row in project_trips(rows).collect()] == [""]
    (parsed,) = snap.parsed_vehicle_snapshots(frame).collect()
    assert parsed.vehicles[0].id == ""


def test_lack_of_memory_is_not_a_bad_snapshot(feed_message, monkeypatch):
    def full(*_):
        raise MemoryError

    monkeypatch.setattr(dec, "_struct", full)
    with pytest.raises(MemoryError):
        dec._decode_one(feed_message, b"\n\0", None)


def test_unknown_status_number_counts_as_unset(spark, feed_message):
    def odd(entity):
        entity.id = "odd"
        # Field 4 with the undefined value 9, behind an otherwise empty vehicle.
        entity.vehicle.MergeFromString(bytes([4 << 3, 9]))

    frame = dec.decode(raw(spark, make.feed(feed_message, [odd])))
    (row,) = project_vehicles(dec.entities(frame)).collect()
    assert row.current_status is None


def test_output_batches_are_bounded(spark, feed_message, monkeypatch):
    monkeypatch.setattr(dec, "ENTITIES_PER_BATCH", 2)
    content = make.feed(feed_message, [make.full_vehicle, make.trip, make.neither])
    frame = dec.decode(raw(spark, *[content] * 5).coalesce(1))
    counted = dec.entities(frame, "n").groupBy("n").count().collect()
    assert {row.n: row["count"] for row in counted} == dict.fromkeys(range(5), 3)


def test_interpretation_adds_nothing_for_empty_inputs(decoded):
    vehicles = project_vehicles(dec.entities(decoded))
    rows = {row.id: row for row in interpret_vehicles(vehicles).collect()}
    assert rows["000003"].route_name == "1 Train"
    assert rows["000003"].trip_info.direction == "Northbound"
    assert rows["000003"].timestamp_readable == "2025-11-18 19:38:04"
    for name in ("bare", "hollow"):
        added = rows[name].route_name, rows[name].trip_info, rows[name].timestamp_readable
        assert added == (None, None, None)


def test_interpretation_of_partial_records(spark):
    rows = spark.createDataFrame([("1", 38)], "route_id string, current_stop_sequence int")
    (row,) = interpret_vehicles(rows).collect()
    assert (row.route_name, row.trip_info, row.timestamp_readable) == ("1 Train", None, None)
    assert row.current_stop_sequence == 38


def test_first_fifty_of_a_stored_snapshot(spark, feed_message):
    def numbered(n):
        def fill(entity):
            make.full_vehicle(entity)
            entity.id = f"{n:03d}"

        return fill

    frame = dec.decode(raw(spark, make.feed(feed_message, [numbered(n) for n in range(60)])))
    rows = snap.interpret_snapshots(snap.parsed_vehicle_snapshots(frame, "n"), "n").collect()
    assert sorted(row.id for row in rows) == [f"{n:03d}" for n in range(50)]
    assert {row.total_vehicles for row in rows} == {60}


def test_stop_names_do_not_multiply_rows(spark):
    rows = spark.createDataFrame([("1N",), ("2N",), (None,)], "stop_id string")
    stops = spark.createDataFrame([("1N", "b"), ("1N", "a")], "stop_id string, stop_name string")
    named = {tuple(row) for row in with_stop_names(rows, stops).collect()}
    assert named == {("1N", "a"), ("2N", "Stop 2N"), (None, None)}
    assert with_stop_names(rows).filter("stop_name = 'Stop 1N'").count() == 1


text = st.text(max_size=5)
number = st.integers(0, 2**32 - 1)
single = st.floats(width=32, allow_nan=False, allow_infinity=False)


def maybe(**fields):
    """A message as a dict of the fields that are set, or no message."""
    return st.none() | st.fixed_dictionaries({}, optional=fields)


event = maybe(time=st.integers(-(2**63), 2**63 - 1), delay=st.integers(-(2**31), 2**31 - 1))
stop = st.fixed_dictionaries(
    {"arrival": event, "departure": event}, optional={"stop_sequence": number, "stop_id": text}
)
trip_descriptor = maybe(trip_id=text, route_id=text)
payloads = {
    "vehicle": st.fixed_dictionaries(
        {
            "trip": trip_descriptor,
            "vehicle": maybe(id=text),
            "position": maybe(latitude=single, longitude=single, bearing=single, speed=single),
        },
        optional={
            "timestamp": st.integers(0, 2**63 - 1),
            "current_stop_sequence": number,
            "current_status": st.integers(0, 2),
            "stop_id": text,
        },
    ),
    "trip_update": st.fixed_dictionaries(
        {"trip": trip_descriptor, "stop_time_update": st.lists(stop, max_size=3)},
        optional={"timestamp": st.integers(0, 2**63 - 1)},
    ),
}
entity = st.fixed_dictionaries({"id": text}, optional=payloads)


def write(message, values):
    for name, value in values.items():
        if isinstance(value, list):
            for item in value:
                write(getattr(message, name).add(), item)
        elif isinstance(value, dict):
            getattr(message, name).SetInParent()
            write(getattr(message, name), value)
        elif value is not None:
            setattr(message, name, value)


def only_set(value):
    """Rows as nested dicts without nulls, to compare with what was written."""
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return {name: only_set(item) for name, item in value.items() if item is not None}
    return [only_set(item) for item in value] if isinstance(value, list) else value


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(entity, max_size=6), min_size=1, max_size=12))
def test_any_message_comes_back(spark, feed_message, feeds):
    contents = []
    for entities in feeds:
        message = feed_message()
        message.header.SetInParent()  # no bytes at all would be no snapshot
        for values in entities:
            write(message.entity.add(), values)
        contents.append(message.SerializePartialToString())
    rows = dec.decode(raw(spark, *contents)).orderBy("n").collect()
    assert [row.decode_error for row in rows] == [None] * len(feeds)
    assert [only_set(row.entities) for row in rows] == [only_set(entities) for entities in feeds]
