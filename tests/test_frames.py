"""Snapshots cut into frames against the same snapshots decoded whole."""

import random

import pytest
from pyspark.sql import functions as F

from headway.operators import decode as dec
from headway.operators import frames
from headway.operators.trips import explode_stop_times, project_trips
from headway.operators.vehicles import project_vehicles
from tests import snapshots as make


def long_trip(stops, name="long", vehicle=False):
    def fill(entity):
        entity.id = name
        entity.trip_update.trip.trip_id, entity.trip_update.timestamp = "092000_A..S02R", 7
        for i in range(stops):
            update = entity.trip_update.stop_time_update.add(stop_sequence=i, stop_id=f"{i}é")
            if i % 3:
                update.arrival.time = i
        if vehicle:
            make.full_vehicle(entity)
            entity.id = name

    return fill


def messages(feed_message, seed=0):
    rng = random.Random(seed)
    kinds = [make.full_vehicle, make.bare_vehicle, make.trip, make.trip_without_stops, make.neither]
    found = []
    for n in range(12):
        fills = rng.choices(kinds, k=rng.randrange(8))
        fills += [long_trip(rng.choice([1, 5, 60]), vehicle=n % 2 == 0)] * (n % 3)
        rng.shuffle(fills)
        found.append(make.feed(feed_message, fills, timestamp=n or None))
    return found


def table(spark, contents):
    return spark.createDataFrame(
        [(n, bytearray(c) if c is not None else None) for n, c in enumerate(contents)],
        "n bigint, content binary",
    ).repartition(3)


def rows_of(entities, *keys):
    vehicles = project_vehicles(entities, "n", "entity_pos")
    stops = explode_stop_times(project_trips(entities, "n", "entity_pos", *keys))
    if keys:
        place = F.col("stop_pos") + F.col("first_update")
        stops = stops.withColumn("stop_pos", place).drop("first_update")
    return sorted(map(str, vehicles.collect())), sorted(map(str, stops.collect()))


@pytest.mark.parametrize("limit", [1, 40, 300, 1 << 18])
def test_frames_decode_to_what_the_whole_does(spark, feed_message, limit):
    raw = table(spark, messages(feed_message, limit))
    whole = dec.decode(raw)
    framed = frames.decode_in_frames(raw, ["n"], limit=limit)
    expected = rows_of(dec.entities(whole, "n"))
    assert rows_of(frames.framed_entities(framed, "n"), "first_update") == expected
    firsts = frames.one_per_snapshot(framed)
    assert sorted(dec.headers(firsts, "n").collect()) == sorted(dec.headers(whole, "n").collect())
    assert (framed.count() > 100) == (limit < 100)


@pytest.mark.parametrize("limit", [1, 60])
def test_one_bad_frame_sets_the_snapshot_aside(spark, feed_message, limit):
    good = make.feed(feed_message, [make.full_vehicle, long_trip(20), make.trip])
    text = feed_message()
    make.full_vehicle(text.entity.add())
    text.entity.add().id = "xx"
    long_trip(9)(text.entity.add())
    not_utf8 = text.SerializePartialToString().replace(b"xx", b"\xff\xfe")
    inner = bytearray(good)
    inner[good.index(b"092000") - 1] = 0x7F  # a length that leads out of its field
    contents = [good, b"\xff\xff\xff", not_utf8, good[:-3], None, b"", bytes(inner), good + b"\x0b"]
    raw = table(spark, contents)
    framed = frames.decode_in_frames(raw, ["n"], limit=limit)
    whole = {row.n for row in dec.quarantine(dec.decode(raw)).collect()}
    bad = frames.one_per_snapshot(dec.quarantine(framed))
    assert sorted(row.n for row in bad.collect()) == sorted(whole) and 0 not in whole
    assert {row.n for row in frames.framed_entities(framed, "n").collect()} == set(range(8)) - whole


def test_the_index_points_into_the_snapshot(spark, feed_message):
    (content,) = [make.feed(feed_message, [make.full_vehicle, make.trip, make.bare_vehicle])]
    index = frames.frames(table(spark, [content]), limit=1).orderBy("frame_no").collect()
    assert [row.first_entity for row in index] == [0, 1, 1, 2]
    assert [row.first_update for row in index] == [0, 0, 1, 0]
    span = content[index[0].offset : index[0].offset + index[0].frame_length]
    assert span in bytes(index[0].content) and index[-1].offset + index[-1].frame_length == len(content)


def test_kinds_and_nulls(spark, feed_message):
    content = make.feed(feed_message, [make.full_vehicle, make.trip])
    raw = table(spark, [content, content, None])
    kind = F.when(F.col("n") == 0, "alerts").otherwise("trip_updates")
    framed = frames.decode_in_frames(raw, ["n"], feed_type=kind, limit=1)
    rows = frames.framed_entities(framed, "n").where("vehicle is not null or trip_update is not null")
    assert {row.n for row in rows.collect()} == {1}
    assert sorted(r.n for r in frames.one_per_snapshot(dec.quarantine(framed)).collect()) == [0, 2]


def test_one_message_is_decoded_by_many_tasks(spark, feed_message):
    """One trip holds most of all lines; under shipped settings its frames are dealt."""
    contents = [make.feed(feed_message, [long_trip(60_000)])] + messages(feed_message)
    raw = table(spark, contents)
    dealt = frames.deal(frames.frames(raw), ["n"])
    decoded = dec.decode(dealt).withColumn("task", F.spark_partition_id())
    tasks = decoded.where("n = 0").agg(F.countDistinct("task"), F.max(F.size("entities"))).first()
    assert tasks[0] > 1 and tasks[1] == 1
    framed = frames.framed_entities(frames.decode_in_frames(raw, ["n"]), "n")
    stops = framed.where("n = 0").agg(F.sum(F.size("trip_update.stop_time_update"))).first()[0]
    assert stops == 60_000
