"""Files as the feeds leave them: raw ``.pb``, indented ``.json``, ``stops.txt``."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from headway.operators import decode as dec
from headway.operators import snapshots as snap
from headway.operators.vehicles import project_vehicles
from headway.sinks import storage_target, with_day, write_daily, write_files, write_parsed
from headway.sources import list_days, list_snapshots, read_parsed, read_raw, read_stops
from headway.sources.raw import with_names
from tests import snapshots as make


@pytest.fixture()
def landing(tmp_path, feed_message):
    content = make.feed(feed_message, [make.full_vehicle, make.trip])
    for name in ("vehicle_positions_20251118_193823.pb", "trip_updates_20251118_193825.pb"):
        (tmp_path / name).write_bytes(content)
    (tmp_path / "vehicle_positions_20251118_193843.pb").write_bytes(b"\xff\xff\xff")
    (tmp_path / "notes.txt").write_text("not a snapshot")
    return tmp_path


def test_raw_files(spark, landing):
    raw = with_names(read_raw(spark, str(landing)))
    rows = {row.feed_type: row for row in raw.filter("captured_at != 1763494723").collect()}
    assert rows["vehicle_positions"].captured_at == 1763494703
    assert rows["trip_updates"].captured_at == 1763494705
    decoded = dec.decode(raw, feed_type=F.col("feed_type"))
    assert project_vehicles(dec.entities(decoded, "path"), "path").count() == 1
    (bad,) = dec.quarantine(decoded).collect()
    assert bad.path.endswith("vehicle_positions_20251118_193843.pb") and bad.length == 3


def test_indented_documents(spark, tmp_path):
    vehicle = {"id": "1", "route_id": "A", "trip_id": None, "position": {"latitude": 40.5}}
    document = {"header": {"timestamp": 7}, "vehicle_count": 1, "vehicles": [vehicle]}
    (tmp_path / "vehicle_positions_1.json").write_text(json.dumps(document, indent=2))
    trips = {"header": {"timestamp": 8}, "trip_count": 0, "trips": []}
    (tmp_path / "trip_updates_1.json").write_text(json.dumps(trips, indent=2))
    (tmp_path / "vehicle_positions_2.json").write_text('{"header": {"timestamp": 9}, "vehi')
    stored = read_parsed(spark, str(tmp_path)).cache()
    assert sorted(row.status for row in stored.collect()) == ["invalid_json", "ok", "ok"]
    (row,) = snap.interpret_snapshots(stored.filter("status = 'ok'")).collect()
    assert (row.id, row.route_name, row.position.latitude) == ("1", "A Train", 40.5)
    (other,) = snap.without_vehicles(stored.filter("status = 'ok'")).collect()
    assert (other.header.timestamp, other.trip_count, other.trips) == (8, 0, [])
    (bad,) = stored.filter("status <> 'ok'").collect()
    assert bad._corrupt_record.startswith('{"header"')


def test_parsed_files_have_explicit_nulls(spark, feed_message, tmp_path):
    content = make.feed(feed_message, [make.full_vehicle, make.bare_vehicle])
    raw = spark.createDataFrame([(bytearray(content),)], "content binary")
    target = str(tmp_path / "parsed")
    write_parsed(snap.parsed_vehicle_snapshots(dec.decode(raw)), target)
    (line,) = [row.value for row in spark.read.text(target).collect()]
    full, bare = json.loads(line)["vehicles"]
    assert bare["trip_id"] is None and bare["position"]["speed"] is None
    assert list(full) == [
        "id", "vehicle_id", "trip_id", "route_id", "position", "timestamp",
        "current_stop_sequence", "stop_id",
    ]
    assert full["position"]["latitude"] == 40.758899688720703 and full["stop_id"] == 1


def test_listing(spark, tmp_path):
    for n in range(25):
        (tmp_path / f"trip_updates_202511{n + 1:02d}_000000.json").write_text("{}" + " " * n)
    (tmp_path / "vehicle_positions_20250101_000000.json").write_text("{}")
    (tmp_path / "vehicle_positions_20250101_000000.pb").write_bytes(b"x")
    (tmp_path / "older").mkdir()
    (tmp_path / "older" / "vehicle_positions_20250102_000000.json").write_text("{}")
    files = list_snapshots(spark, str(tmp_path))
    assert files.count() == 26
    names = [row.filename for row in snap.latest_files(files).collect()]
    # By name, so an old vehicle file leads all trip files.
    assert names[0] == "vehicle_positions_20250101_000000.json" and len(names) == 20
    assert names[1:] == sorted(names[1:], reverse=True)
    assert {row.size for row in files.filter("filename like '%20251103%'").collect()} == {4}


def test_listing_of_no_folder(spark, tmp_path):
    files = list_snapshots(spark, str(tmp_path / "none"))
    assert files.columns == ["filename", "size", "modified"] and files.count() == 0


def test_stops(spark, tmp_path):
    path = tmp_path / "stops.txt"
    path.write_text('stop_id,stop_name,stop_lat\n127N,"Times Sq, 42 St",40.7\n')
    assert [tuple(row) for row in read_stops(spark, str(path)).collect()] == [
        ("127N", "Times Sq, 42 St")
    ]


def test_daily_folders(spark, tmp_path):
    rows = spark.createDataFrame([(1763494703,), (1763510399,), (1763510400,)], "s bigint")
    write_daily(with_day(rows, F.col("s")), str(tmp_path / "out"))
    folders = {str(p.parent.relative_to(tmp_path / "out")) for p in tmp_path.rglob("*.parquet")}
    assert folders == {"year=2025/month=11/day=18", "year=2025/month=11/day=19"}
    plan = spark.read.parquet(str(tmp_path / "out")).filter("year = 2025 AND day = 19")
    assert plan.count() == 1


def test_storage_target():
    assert storage_target({"CLOUD_STORAGE_TYPE": "S3", "S3_BUCKET_NAME": "b"}) == "s3a://b"
    assert storage_target({"CLOUD_STORAGE_TYPE": "gcs", "GCS_BUCKET_NAME": "b"}) == "gs://b"
    assert storage_target({"CLOUD_STORAGE_TYPE": "s3", "GCS_BUCKET_NAME": "b"}) is None
    assert storage_target({"CLOUD_STORAGE_TYPE": "tape"}) is None
    assert storage_target({}) is None


def test_files_of_rows(spark, tmp_path):
    rows = [(f"{n % 3}/vehicle_positions_{n}.pb", bytearray(bytes([n]) * n)) for n in range(20)]
    rows.append(("none.pb", None))
    files = spark.createDataFrame(rows, "filename string, content binary").repartition(4)
    for _ in range(2):  # a repeated run writes the same files
        write_files(files, str(tmp_path / "out"))
    found = {str(p.relative_to(tmp_path / "out")): p.read_bytes() for p in (tmp_path / "out").rglob("*.pb")}
    assert found == {name: bytes(content or b"") for name, content in rows}
    assert not [p for p in (tmp_path / "out").rglob(".*") if p.is_file()]
    with pytest.raises(Exception, match="no filename"):
        write_files(spark.createDataFrame([(None, b"x")], files.schema), str(tmp_path / "out"))
    scanned = read_raw(spark, str(tmp_path / "out"), recursive=True)
    assert scanned.where("length > 0").count() == 19


def test_a_task_that_fails_leaves_whole_files(tmp_path):
    import pyarrow as pa

    from headway.sinks.files import FileWriter

    batch = pa.RecordBatch.from_pydict({"filename": ["a.pb", "b.pb"], "content": [b"1", b"2"]})

    def lost():
        yield batch
        raise OSError("executor lost")

    with pytest.raises(OSError):
        FileWriter(str(tmp_path)).write(lost())
    FileWriter(str(tmp_path)).write(iter([batch]))
    assert {p.name: p.read_bytes() for p in tmp_path.iterdir()} == {"a.pb": b"1", "b.pb": b"2"}


def test_listing_counts_empty_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    (tmp_path / "b.json").write_text("")
    (tmp_path / "c.txt").write_text("")
    found = {row.filename: (row.size, row.modified) for row in list_snapshots(spark, str(tmp_path)).collect()}
    assert {name: size for name, (size, _) in found.items()} == {"a.json": 2, "b.json": 0}
    assert abs(found["a.json"][1].timestamp() - (tmp_path / "a.json").stat().st_mtime) < 1


def test_one_day_is_listed_alone(spark, tmp_path):
    for day in ("2024/01/30", "2024/01/31", "2024/02/01"):
        folder = tmp_path / day
        folder.mkdir(parents=True)
        for n in range(3):
            (folder / f"{n}.json").write_text("x" * n)
    every = list_days(spark, str(tmp_path))
    assert every.count() == 9 and every.rdd.getNumPartitions() == 3
    one = every.where("day = '2024/01/31' AND size < 2")
    assert one.count() == 2 and one.rdd.getNumPartitions() == 1
    some = every.where("day IN ('2024/01/30', '2024/02/01', '1999/01/01')")
    assert some.count() == 6 and some.rdd.getNumPartitions() == 3
    # Nothing but that folder is opened: the others may even be unreadable.
    from headway.sources.listing import ListingReader
    from pyspark.sql.datasource import EqualTo

    reader = ListingReader(str(tmp_path / "gone"), "*", True)
    assert list(reader.pushFilters([EqualTo(("day",), "2024/01/31")])) == []
    assert [p.value for p in reader.partitions()] == ["2024/01/31"]
    assert list_days(spark, str(tmp_path / "none")).count() == 0
