"""What is shuffled, written or held by a worker grows no faster than it must."""

from __future__ import annotations

import os

import pytest

from headway.operators import frames
from headway.operators.decode import good
from headway.operators.snapshots import parsed_trip_snapshots
from headway.plans import fixtures as fix
from headway.plans import queries
from headway.schemas import RAW_FILE
from headway.sinks import files, write_files, write_parsed
from headway.sinks.tables import write_daily
from headway.sources import read_parsed, read_raw_stream
from headway.streaming import ingest, ingest_snapshots, once, read_ingested
from tests import snapshots as make
from tests.conftest import DATA

BATCH_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def size(folder, ending: str) -> int:
    found = [os.path.join(top, f) for top, _, names in os.walk(folder) for f in names if f.endswith(ending)]
    return sum(map(os.path.getsize, found))


@pytest.mark.parametrize("raw", [fix.raw_vehicles, fix.raw_trips])
def test_records_get_their_shape_behind_the_shuffle(spark, raw):
    text = plan(raw(spark, DATA))
    assert "struct(" in text
    assert "struct(" not in text.split("Exchange hashpartitioning(feed_no", 1)[1]


def test_frames_are_joined_only_where_some_are_bad(spark, feed_message):
    content = make.feed(feed_message, [make.trip, make.full_vehicle])
    rows = [(1, content), (2, make.feed(feed_message, [make.trip]))]

    def decoded(rows):
        raw = spark.createDataFrame(rows, "feed_no int, content binary")
        return frames.decode_in_frames(raw, ("feed_no",), limit=8)

    assert "Join" not in plan(decoded(rows))
    found = {r["feed_no"]: r["decode_error"] for r in decoded([*rows, (3, b"\xff\xff")]).collect()}
    assert found[1] is found[2] is None and found[3]


def test_many_bad_frames_are_found_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(frames, "FEW_BAD", 1)
    raw = spark.createDataFrame([(1, b"\xff\xff"), (2, b"\xff\xff"), (3, None)], "feed_no int, content binary")
    found = frames.decode_in_frames(raw, ("feed_no",), limit=8).collect()
    assert len(found) == 3 and all(r["decode_error"] for r in found)


def test_stored_documents_are_compressed(spark, tmp_path):
    parsed = parsed_trip_snapshots(good(queries._decoded(fix.raw_trips(spark, DATA)))).cache()
    write_parsed(parsed, str(tmp_path / "stored"))
    parsed.write.option("ignoreNullFields", "false").json(str(tmp_path / "plain"))
    assert 0 < size(tmp_path / "stored", ".json.gz") < size(tmp_path / "plain", ".json") / 4
    stored = read_parsed(spark, str(tmp_path / "stored"), one_per_file=False)
    counts = [sorted(r["trip_count"] for r in rows.select("trip_count").collect()) for rows in (stored, parsed)]
    assert counts[0] == counts[1]
    parsed.unpersist()


def test_contents_are_shuffled_once(spark, feed_message, tmp_path, monkeypatch):
    """Contents of one name each: tables behind the raw bytes need no shuffle."""
    (tmp_path / "landing").mkdir()
    for second in range(3):
        content = make.feed(feed_message, [make.full_vehicle, make.trip], timestamp=second)
        (tmp_path / f"landing/trip_updates_20251118_1938{second:02d}.pb").write_bytes(content)
    plans = {}

    def written(df, path, rebalance=True, **options):
        text = plan(df.hint("rebalance", "day") if rebalance else df)
        plans[os.path.basename(path)] = text.count("Exchange")
        write_daily(df, path, rebalance=rebalance, **options)

    monkeypatch.setattr(ingest, "write_daily", written)
    target = str(tmp_path / "tables")
    raw = read_raw_stream(spark, str(tmp_path / "landing"))
    ingest_snapshots(raw, target, str(tmp_path / "state"), once()).awaitTermination()
    assert plans.pop("raw") and len(plans) == 6 and not any(plans.values())
    assert read_ingested(spark, target, "trips").count() == 3
    assert size(f"{target}/parsed_trips", ".json.gz")
    assert [r["names"] for r in read_ingested(spark, target, "decoded").collect()] == [1, 1, 1]


@pytest.mark.parametrize("few", [0, 100])
def test_many_shared_contents_are_joined_by_shuffles(spark, feed_message, tmp_path, monkeypatch, few):
    monkeypatch.setattr(ingest, "FEW_SHARED", few)
    (tmp_path / "landing").mkdir()
    for number, names in ((1, 2), (2, 1)):
        content = make.feed(feed_message, [make.full_vehicle, make.trip], timestamp=number)
        for second in range(names):
            name = f"vehicle_positions_20251118_19{number}{second:03d}.pb"
            (tmp_path / "landing" / name).write_bytes(content)
    target = str(tmp_path / "tables")
    raw = read_raw_stream(spark, str(tmp_path / "landing"))
    ingest_snapshots(raw, target, str(tmp_path / "state"), once()).awaitTermination()
    decoded = read_ingested(spark, target, "decoded").collect()
    assert sorted((r["header"]["timestamp"], r["names"]) for r in decoded) == [(1, 2), (2, 1)]
    assert read_ingested(spark, target, "snapshots").count() == 3
    assert read_ingested(spark, target, "vehicles").count() == 3


def test_file_writers_take_small_batches(spark, tmp_path):
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    rows = spark.range(0, 40, 1, 1).selectExpr("concat(id, '.bin') AS filename", "encode(repeat('x', 1000000), 'utf-8') AS content")

    class Watched(files.FileWriter):
        def write(self, iterator):
            def sized():
                for batch in iterator:
                    assert batch.nbytes < 2 * (8 << 20)
                    yield batch

            return super().write(sized())

    kept, files.FileSink.writer = files.FileSink.writer, lambda self, schema, overwrite: Watched(self.options["path"])
    try:
        write_files(rows, str(tmp_path / "out"))
    finally:
        files.FileSink.writer = kept
    assert len(list((tmp_path / "out").iterdir())) == 40
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_each_feed_is_decoded_once_for_its_files(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(queries, "write_files", lambda rows, path: plans.append((plan(rows), rows.collect())))
    queries._one_per_file(spark, DATA)
    ((text, rows),) = plans
    assert text.count("MapInArrow") == 2
    empty = [r for r in rows if not r["content"]]
    assert len(rows) - len(empty) == fix.table(spark, DATA, "events").selectExpr("event_id div 100").distinct().count()
    assert empty and all(r["filename"].startswith("empty_") for r in empty)


def test_an_ingestion_holds_few_snapshots_at_once(spark, tmp_path, monkeypatch):
    """Python is sent a few MB of contents, tables of whole snapshots are read a few rows at a time."""
    (tmp_path / "landing").mkdir()
    rows = [(f"/l/trip_updates_20251118_1938{n:02d}.pb", None, 1 << 20, bytes([255, n]) * (1 << 19)) for n in range(30)]
    spark.createDataFrame(rows, RAW_FILE).coalesce(1).write.parquet(str(tmp_path / "landing/p"))
    read, decode = {}, ingest.decode

    def watched(df):
        def sized(batches):
            for batch in batches:
                assert batch.nbytes < 2 * (8 << 20)
                yield batch

        return decode(df.mapInArrow(sized, df.schema))

    def written(df, path, **options):
        read[os.path.basename(path)] = int(df.sparkSession.conf.get(BATCH_ROWS))
        write_daily(df, path, **options)

    monkeypatch.setattr(ingest, "decode", watched)
    monkeypatch.setattr(ingest, "write_daily", written)
    before = {key: spark.conf.get(key) for key in ingest.STREAM_SETTINGS}
    target = str(tmp_path / "tables")
    raw = read_raw_stream(spark, str(tmp_path / "landing/p"), "parquet")
    ingest_snapshots(raw, target, str(tmp_path / "state"), once()).awaitTermination()
    assert len(read) == 7 and max(read.values()) <= 32
    assert read_ingested(spark, target, "snapshots").where("decode_error IS NOT NULL").count() == 30
    assert {key: spark.conf.get(key) for key in before} == before


def test_snapshots_are_not_sorted_by_day(spark, feed_message, tmp_path):
    """Writes of contents of one name each need no sort; more days than open files give the same rows."""
    (tmp_path / "landing").mkdir()
    for day in range(10, 17):
        for second in range(2):
            for kind, number in (("trip_updates", 1000), ("vehicle_positions", 2000)):
                both = [make.trip, make.full_vehicle]
                content = make.feed(feed_message, both, timestamp=number + 10 * day + second)
                name = f"{kind}_202511{day}_1938{second:02d}.pb"
                (tmp_path / "landing" / name).write_bytes(content)
    target = str(tmp_path / "tables")
    raw = read_raw_stream(spark, str(tmp_path / "landing"))
    ingest_snapshots(raw, target, str(tmp_path / "state"), once()).awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [runs.apply(n).physicalPlanDescription() for n in range(runs.size())]
    writes = [text for text in plans if f"{target}/" in text and "InsertIntoHadoopFsRelationCommand" in text]
    assert len(writes) == 7 and not any("Sort" in text for text in writes)
    for table, rows in (("raw", 28), ("snapshots", 28), ("parsed_trips", 14), ("parsed_vehicles", 14)):
        days = read_ingested(spark, target, table).groupBy("day").count().collect()
        assert {row["day"]: row["count"] for row in days} == {str(day): rows // 7 for day in range(10, 17)}
    for table in ("trips", "vehicles"):
        assert read_ingested(spark, target, table).count() == 14
