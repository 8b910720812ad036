from __future__ import annotations

import pytest

from headway.operators import decode as dec
from headway.operators.vehicles import project_vehicles
from headway.schemas import RAW_FILE
from headway.sources import read_raw, read_raw_stream
from headway.sources.documents import read_documents
from headway.streaming import (
    compact_day,
    ingest_snapshots,
    life_totals,
    log_progress,
    once,
    poll_every,
    read_ingested,
    read_progress,
    status_frame,
    stop_logging,
    stream_vehicles,
    supervise,
)
from tests import snapshots as make


@pytest.fixture()
def folders(tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    return landing, str(tmp_path / "tables"), str(tmp_path / "state")


def land(landing, feed_message, kind, second, makers):
    content = make.feed(feed_message, makers, timestamp=second)
    (landing / f"{kind}_20251118_1938{second:02d}.pb").write_bytes(content)


def test_interval_is_clamped():
    assert poll_every() == {"processingTime": "20 seconds"}
    assert poll_every(1) == {"processingTime": "10 seconds"}
    assert poll_every(99) == {"processingTime": "30 seconds"}


def test_stream_equals_batch_and_restarts(spark, feed_message, folders):
    landing, target, state = folders
    for second in range(5):
        land(landing, feed_message, "vehicle_positions", second, [make.full_vehicle, make.trip])

    def run():
        raw = read_raw_stream(spark, str(landing), files_per_trigger=2)
        query = stream_vehicles(raw, target, state, once())
        query.awaitTermination()
        return query

    first = run()
    report = status_frame(first).collect()
    assert sum(row.input_rows for row in report) == 5 and len(report) >= 3
    assert not any(row.is_running for row in report)
    decoded = dec.decode(read_raw(spark, str(landing)))
    batch = project_vehicles(dec.entities(decoded, "path"), "path", "entity_pos")
    streamed = spark.read.parquet(target)
    assert streamed.count() == 5
    assert streamed.exceptAll(batch).count() == 0 == batch.exceptAll(streamed).count()
    run()
    assert spark.read.parquet(target).count() == 5
    land(landing, feed_message, "vehicle_positions", 50, [make.full_vehicle])
    run()
    assert spark.read.parquet(target).count() == 6


def test_pair_ingestion(spark, feed_message, folders):
    landing, target, state = folders
    both = [make.full_vehicle, make.trip]
    land(landing, feed_message, "vehicle_positions", 1, both)
    land(landing, feed_message, "trip_updates", 3, both)
    land(landing, feed_message, "alerts", 4, both)
    (landing / "vehicle_positions_20251118_193859.pb").write_bytes(b"\xff\xff\xff")

    def run():
        raw = read_raw_stream(spark, str(landing), files_per_trigger=2)
        ingest_snapshots(raw, target, state, once()).awaitTermination()
        return {name: read_ingested(spark, target, name) for name in
                ("raw", "snapshots", "vehicles", "trips")}

    tables = run()
    # Bytes are kept whatever the parse says.
    assert tables["raw"].count() == 4
    kept = tables["raw"].filter("path like '%193859.pb'").collect()
    assert [bytes(row.content) for row in kept] == [b"\xff\xff\xff"]
    bad = {row.path[-9:]: row.decode_error for row in dec.quarantine(tables["snapshots"]).collect()}
    assert set(bad) == {"193804.pb", "193859.pb"} and "alerts" in bad["193804.pb"]
    # A vehicle snapshot gives vehicles only, although the message has both.
    (vehicle,) = tables["vehicles"].collect()
    assert (vehicle.feed_type, vehicle.year, vehicle.day) == ("vehicle_positions", "2025", "18")
    (trip,) = tables["trips"].collect()
    assert trip.feed_type == "trip_updates" and len(trip.stop_time_updates) == 2
    # A restart adds nothing; a new file adds itself.
    assert run()["raw"].count() == 4
    land(landing, feed_message, "vehicle_positions", 30, both)
    again = run()
    assert (again["raw"].count(), again["vehicles"].count()) == (5, 2)


def test_replayed_batch_replaces_itself(spark, feed_message, folders, tmp_path):
    landing, target, _ = folders
    land(landing, feed_message, "vehicle_positions", 1, [make.full_vehicle])
    for attempt in range(2):
        # A lost state folder replays micro-batch 0 from the start.
        state = str(tmp_path / f"state-{attempt}")
        ingest_snapshots(read_raw_stream(spark, str(landing)), target, state, once()).awaitTermination()
    assert read_ingested(spark, target, "vehicles").count() == 1


def test_days_are_read_and_compacted_alone(spark, feed_message, folders, tmp_path):
    landing, target, state = folders
    for day in (18, 19):
        for second in range(3):
            content = make.feed(feed_message, [make.full_vehicle], timestamp=second)
            name = f"vehicle_positions_202511{day}_1938{second:02d}.pb"
            (landing / name).write_bytes(content)
    raw = read_raw_stream(spark, str(landing), files_per_trigger=2)
    ingest_snapshots(raw, target, state, once()).awaitTermination()
    day = ("2025", "11", "18")
    one = read_ingested(spark, target, "vehicles", day)
    assert one.count() == 3 and all("/day=18/batch_id=" in name for name in one.inputFiles())
    pruned = read_ingested(spark, target, "vehicles").where("day = '18'")
    assert "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().toString()
    compacted = str(tmp_path / "compacted")
    for _ in range(2):  # a repeated run replaces the day
        compact_day(spark, target, compacted, "vehicles", day)
    joined = spark.read.schema(one.schema).parquet(f"{compacted}/vehicles").drop("batch_id")
    assert len(joined.inputFiles()) == 1 < len(one.inputFiles())
    kept = one.drop("batch_id")
    assert joined.exceptAll(kept).count() == 0 == kept.exceptAll(joined).count()


def test_running_query_reports_and_stops(spark, feed_message, folders):
    landing, target, state = folders
    land(landing, feed_message, "vehicle_positions", 1, [make.full_vehicle])
    query = stream_vehicles(read_raw_stream(spark, str(landing)), target, state, poll_every(10))
    try:
        query.processAllAvailable()
        rows = status_frame(query, poll_every(10)).collect()
        assert rows and all(row.is_running for row in rows)
        assert {row.trigger for row in rows} == {"processingTime=10 seconds"}
        assert all(str(landing) in row.sources for row in rows)
    finally:
        query.stop()
    assert not query.isActive


def test_files_without_rows_are_taken_in(spark, feed_message, folders):
    landing, target, state = folders
    spark.createDataFrame([], RAW_FILE).coalesce(1).write.parquet(f"{landing}/p")
    raw = read_raw_stream(spark, f"{landing}/p", "parquet")
    query = ingest_snapshots(raw, target, state, once())
    query.awaitTermination()
    assert query.exception() is None


def test_stored_form_of_the_pair(spark, feed_message, folders):
    landing, target, state = folders
    land(landing, feed_message, "vehicle_positions", 1, [make.full_vehicle, make.bare_vehicle, make.trip])
    land(landing, feed_message, "vehicle_positions", 2, [])
    land(landing, feed_message, "trip_updates", 3, [make.trip, make.full_vehicle])
    ingest_snapshots(read_raw_stream(spark, str(landing)), target, state, once()).awaitTermination()
    vehicles = {row.path[-5:-3]: row for row in read_ingested(spark, target, "parsed_vehicles").collect()}
    assert {key: (row.vehicle_count, len(row.vehicles)) for key, row in vehicles.items()} == {"01": (2, 2), "02": (0, 0)}
    (trips,) = read_ingested(spark, target, "parsed_trips").collect()
    assert (trips.trip_count, trips.header.timestamp, len(trips.trips[0].stop_time_updates)) == (1, 3, 2)
    stored = read_documents(spark, f"{target}/parsed_vehicles/year=2025", one_per_file=False)
    assert stored.count() == 2 and stored.where("status <> 'ok'").count() == 0


def test_a_content_is_decoded_once(spark, feed_message, folders):
    landing, target, state = folders
    content = make.feed(feed_message, [make.full_vehicle, make.trip])
    for kind in ("vehicle_positions", "trip_updates", "alerts"):
        for second in range(4):
            (landing / f"{kind}_20251118_1938{second:02d}.pb").write_bytes(content)
    (landing / "vehicle_positions_20251118_193859.pb").write_bytes(b"\xff\xff\xff")
    ingest_snapshots(read_raw_stream(spark, str(landing)), target, state, once()).awaitTermination()
    assert read_ingested(spark, target, "decoded").count() == 2
    assert read_ingested(spark, target, "snapshots").count() == 13
    assert read_ingested(spark, target, "vehicles").count() == 4 == read_ingested(spark, target, "trips").count()
    assert dec.quarantine(read_ingested(spark, target, "snapshots")).count() == 5


def test_progress_of_a_whole_life(spark, folders):
    """More micro-batches than Spark remembers, over a restart."""
    landing, target, state = folders
    progress = f"{target}-progress"
    log = log_progress(spark, progress)
    for run in range(2):
        for n in range(60):
            (landing / f"{run}-{n:03d}.txt").write_text("x\ny\n")
        lines = spark.readStream.option("maxFilesPerTrigger", 1).text(str(landing))
        query = lines.writeStream.format("noop").option("checkpointLocation", state).trigger(**once()).start()
        query.awaitTermination()
        assert log.settle(query)
    stop_logging(spark, log)
    (life,) = life_totals(spark, progress).collect()
    assert (life.runs, life.batches, life.input_rows, life.failures) == (2, 120, 240, 0)
    assert life.last_error is None and not life.is_running
    batches = read_progress(spark, progress).where("event = 'batch'")
    assert life.last_batch_at == batches.agg({"at": "max"}).first()[0]
    assert sorted(row.batch_id for row in batches.collect()) == list(range(120))


def test_ingestion_goes_on_after_a_failure(spark, feed_message, folders, monkeypatch):
    from headway.streaming import ingest

    landing, target, state = folders
    for second in range(4):
        land(landing, feed_message, "vehicle_positions", second, [make.full_vehicle, make.trip])
    write, calls, waits = ingest.write_daily, [], []

    def fails_once(df, path, **options):
        calls.append(path)
        if path.endswith("/vehicles") and sum(p == path for p in calls) == 2:
            raise OSError("target is away")
        write(df, path, **options)

    monkeypatch.setattr(ingest, "write_daily", fails_once)
    progress = f"{target}-progress"
    log = log_progress(spark, progress)

    def start():
        raw = read_raw_stream(spark, str(landing), files_per_trigger=2)
        return ingest_snapshots(raw, target, state, once())

    query = supervise(start, pause=waits.append)
    assert log.settle(query)
    stop_logging(spark, log)
    assert waits == [5]
    assert read_ingested(spark, target, "vehicles").count() == 4 == read_ingested(spark, target, "raw").count()
    (life,) = life_totals(spark, progress).collect()
    assert (life.runs, life.batches, life.input_rows, life.failures, life.last_error) == (2, 2, 4, 1, None)
    failed = read_progress(spark, progress).where("event = 'failed'").collect()
    assert "target is away" in failed[0].error


def test_a_lasting_failure_is_raised_after_growing_waits(spark, folders, monkeypatch):
    landing, target, state = folders
    (landing / "a.txt").write_text("x\n")
    waits = []

    def away(batch, batch_id):
        raise OSError("target is away")

    def start():
        lines = spark.readStream.text(str(landing))
        return lines.writeStream.foreachBatch(away).option("checkpointLocation", state).trigger(**once()).start()

    with pytest.raises(Exception, match="target is away"):
        supervise(start, attempts=4, pause=waits.append, longest=15)
    assert waits == [5, 10, 15]
