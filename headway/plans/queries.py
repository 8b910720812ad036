"""The registered queries, each over whole tables of a given folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import functions as H
from headway.functions.trip_ids import TRIP_FIELDS
from headway.lookups import VEHICLE_POSITIONS
from headway.operators import decode as dec
from headway.operators import documents as docs
from headway.operators import frames
from headway.operators import snapshots as snap
from headway.operators import stats, trips, vehicles
from headway.plans import fixtures as fix
from headway.schemas import STOP_TIME
from headway.session import scratch_path
from headway.sinks import with_day, write_daily, write_files, write_parsed
from headway.sinks.tables import CODECS, DAY
from headway.sources import list_days, list_snapshots, read_parsed, read_raw, read_raw_stream, routes
from headway.sources.documents import field, read_documents
from headway.sources.raw import with_names
from headway.streaming import (
    ingest_snapshots,
    life_totals,
    log_progress,
    once,
    read_ingested,
    status_totals,
    stop_logging,
    stream_vehicles,
    supervise,
)
from headway.streaming.status import setting_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Messages of these inputs are small; most of them are cut at this size.
TRIP_FRAME_BYTES = 1 << 14

RECORD = ("feed_no", "id", "trip_id", "route_id", "timestamp")


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _flat(rows: DataFrame) -> DataFrame:
    """Vehicle rows with the position as plain columns."""
    columns = [name for name in rows.columns if name != "position"]
    return rows.select(*columns, "position.*")


def _flat_trip_info(rows: DataFrame) -> DataFrame:
    columns = [name for name in rows.columns if name != "trip_info"]
    info = [F.col(f"trip_info.{name}").alias(f"trip_{name}") for name in TRIP_FIELDS[1:]]
    return rows.select(*columns, *info)


def _flat_stop_times(rows: DataFrame) -> DataFrame:
    """One row per stop time, without the position, as rows of a table have no order."""
    flat = trips.explode_stop_times(rows)
    return flat.withColumn("has_stop_time", F.col("stop_pos").isNotNull()).drop("stop_pos")


def _decoded(raw: DataFrame) -> DataFrame:
    return dec.decode(raw.select("feed_no", "part", "content"))


def _written(spark: SparkSession, raw: DataFrame, label: str) -> str:
    """Store raw snapshots as a Parquet table and give its path."""
    path = scratch_path(spark, label)
    raw.drop("feed_no", "part").write.parquet(path, compression="zstd")
    return path


def _written_text(documents: DataFrame, path: str) -> None:
    """Add documents to a folder, one a line, compressed as in :func:`write_parsed`."""
    documents.write.mode("append").text(path, compression=CODECS["json"])


def _feed_no(captured_at: Column) -> Column:
    step = F.lit(fix.SNAPSHOT_STEP)
    return ((captured_at - fix.FIRST_SNAPSHOT) / step).cast("bigint")


# --- interpretation ----------------------------------------------------------


@query
def interpret_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fix.vehicles(spark, sf_dir).drop("entity_pos")
    return _flat_trip_info(vehicles.interpret_vehicles(rows))


@query
def route_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    route_id = F.col("route_id")
    return fix.vehicles(spark, sf_dir).select(
        "id", "route_id", F.when(route_id != "", H.route_name(route_id)).alias("route_name")
    )


@query
def route_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fix.vehicles(spark, sf_dir).select("id", "route_id")
    return vehicles.with_route_names(rows, routes(spark))


@query
def routes_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All known routes, with the vehicles seen on each."""
    seen = snap.count_by_feed(fix.vehicles(spark, sf_dir), "route_id", "vehicle_count")
    return (
        routes(spark)
        .join(seen, "route_id", "left")
        .select(
            "route_id",
            "route_name",
            F.coalesce("vehicle_count", F.lit(0)).cast("bigint").alias("vehicle_count"),
        )
    )


@query
def direction_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    codes = F.get(F.array(*[F.lit(c) for c in ("N", "S", "E", "W", "X", "")]), (key % 6).cast("int"))
    events = fix.table(spark, sf_dir, "events").select("event_id", codes.alias("direction_code"))
    return events.withColumn("direction", H.direction_name(F.col("direction_code")))


@query
def trip_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fix.vehicles(spark, sf_dir)
    parsed = rows.select("id", H.parse_trip_id(F.col("trip_id")).alias("trip"))
    return parsed.select("id", *[F.col(f"trip.{name}") for name in TRIP_FIELDS])


@query
def trip_parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = H.parse_trip_id(F.col("trip_id"))
    rows = fix.vehicles(spark, sf_dir).select("id", "trip_id", parsed["error"].alias("error"))
    return rows.filter(F.col("error").isNotNull())


@query
def departure_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digits of every length from 0 to 7."""
    text = F.concat(fix.clock_digits(F.col("ts")), F.lit("9"))
    digits = F.substr(text, F.lit(1), (F.col("event_id") % 8).cast("int"))
    events = fix.table(spark, sf_dir, "events").select("event_id", digits.alias("digits"))
    return events.withColumn("departure_time", H.departure_time(F.col("digits")))


@query
def timestamp_readable(spark: SparkSession, sf_dir: str) -> DataFrame:
    readable = H.timestamp_readable(F.col("timestamp"))
    return fix.vehicles(spark, sf_dir).select(
        "id", "timestamp", readable.alias("timestamp_readable")
    )


@query
def stop_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fix.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.col("l_suppkey").cast("string"), F.lit("N")).alias("stop_id"),
    )
    return vehicles.with_stop_names(lines, fix.stops(spark, sf_dir))


@query
def snapshot_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both names of each snapshot, and what can be read back from a name."""
    kind, seconds = F.col("feed_type"), F.col("captured_at")
    return (
        fix.catalog(spark, sf_dir)
        .select(
            "event_id",
            H.snapshot_filename(kind, seconds, "pb").alias("pb_name"),
            H.snapshot_filename(kind, seconds, "json").alias("json_name"),
        )
        .withColumns(
            {
                "name_kind": H.snapshot_kind(F.col("pb_name")),
                "name_epoch": H.snapshot_epoch(F.col("json_name")),
            }
        )
    )


@query
def feed_type_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = ("vehicle_positions", "Trip_Updates", "ALERTS", "buses", "", None)
    requested = fix.pick(asked, F.col("event_id") % 6)
    events = fix.table(spark, sf_dir, "events").select("event_id", requested.alias("requested"))
    return events.withColumns(
        {
            "feed_type": H.feed_type_of(F.col("requested")),
            "status": H.feed_status(F.col("requested")),
        }
    )


# --- filter, projection, nesting ---------------------------------------------


@query
def entity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = vehicles.with_vehicle(fix.vehicle_entities(spark, sf_dir))
    return kept.select("feed_no", "entity_pos", "id")


@query
def vehicle_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities in the decoded shape to vehicle rows."""
    entities = fix.vehicle_entities(spark, sf_dir)
    return _flat(vehicles.project_vehicles(entities, "feed_no"))


@query
def trip_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop times with their nested arrival and departure, from flat rows."""
    lines = fix.stop_updates(fix.table(spark, sf_dir, "lineitem"))
    shaped = lines.select("order_key", trips.stop_time(F.col("update")).alias("stop"))
    return shaped.select(
        "order_key",
        "stop.stop_sequence",
        "stop.stop_id",
        F.col("stop.arrival.time").alias("arrival_time"),
        F.col("stop.arrival.delay").alias("arrival_delay"),
        F.col("stop.departure.time").alias("departure_time"),
        F.col("stop.departure.delay").alias("departure_delay"),
    )


# --- raw snapshots and decode ------------------------------------------------


@query
def raw_decode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw snapshots written as one ``.pb`` file each, scanned and decoded."""
    path = scratch_path(spark, "raw-vehicles")
    write_files(fix.raw_vehicles(spark, sf_dir).select(_filename(), "content"), path)
    raw = read_raw(spark, path).select("path", "content")
    captured = H.snapshot_epoch(F.col("path"))
    rows = dec.entities(dec.decode(raw), "path").withColumns(
        {"feed_no": _feed_no(captured), "entity_pos": F.col("entity_pos").cast("bigint")}
    )
    return _flat(vehicles.project_vehicles(rows, "feed_no", "entity_pos"))


@query
def raw_interpretation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole path: raw table scanned, decoded by kind, projected and interpreted."""
    path = _written(spark, fix.raw_vehicles(spark, sf_dir), "raw-interpretation")
    raw = with_names(spark.read.parquet(path).select("path", "content"))
    decoded = dec.decode(raw, feed_type=F.col("feed_type"))
    rows = vehicles.project_vehicles(dec.entities(decoded, "captured_at"), "captured_at")
    numbered = rows.withColumn("feed_no", _feed_no(F.col("captured_at"))).drop("captured_at")
    return _flat_trip_info(_flat(vehicles.interpret_vehicles(numbered)))


def _framed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips by piece: a message is decoded frame by frame, and so is a trip of many lines."""
    raw = fix.raw_trips(spark, sf_dir).select("feed_no", "part", "content")
    decoded = frames.decode_in_frames(raw, ("feed_no", "part"), limit=TRIP_FRAME_BYTES)
    keys = ("feed_no", "part", "entity_pos", "first_update")
    return trips.project_trips(frames.framed_entities(decoded, *keys[:2]), *keys)


@query
def trip_decode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips, one row in each message of the feed, with the number of their stop times."""
    pieces = _framed_trips(spark, sf_dir)
    fields = ("feed_no", "part", "entity_pos", "id", "trip_id", "route_id", "timestamp")
    counted = pieces.groupBy(*fields).agg(F.sum(F.size("stop_time_updates")).alias("stop_times"))
    return counted.drop("entity_pos")


@query
def stop_time_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = _framed_trips(spark, sf_dir)
    return _flat_stop_times(pieces.drop("part", "entity_pos", "first_update"))


@query
def feed_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dec.headers(_decoded(fix.raw_vehicles(spark, sf_dir)), "feed_no")


@query
def decode_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some feeds are garbled, empty or missing: their rows stay, marked, the others decode."""
    feed_no, content = F.col("feed_no"), F.col("content")
    bad = (
        F.when(feed_no % 7 == 3, F.unhex(F.lit("FFFFFF")))
        .when(feed_no % 7 == 4, F.unhex(F.lit("")))
        .when(feed_no % 7 != 5, content)
    )
    raw = fix.raw_vehicles(spark, sf_dir).withColumn("content", bad)
    decoded = _decoded(raw)
    carried = F.filter("entities", lambda entity: entity["vehicle"].isNotNull())
    return decoded.select(
        "feed_no",
        F.col("decode_error").isNotNull().alias("quarantined"),
        F.coalesce(F.size(carried), F.lit(0)).cast("bigint").alias("vehicle_count"),
    )


# --- parsed snapshots ----------------------------------------------------------


@query
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = _decoded(fix.raw_vehicles(spark, sf_dir))
    path = scratch_path(spark, "parsed-vehicles")
    write_parsed(snap.parsed_vehicle_snapshots(dec.good(decoded)), path)
    stored = read_parsed(spark, path, one_per_file=False)
    rows = stored.select(F.explode("vehicles").alias("vehicle")).select("vehicle.*")
    return _flat(rows)


@query
def json_trip_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = _decoded(fix.raw_trips(spark, sf_dir))
    path = scratch_path(spark, "parsed-trips")
    write_parsed(snap.parsed_trip_snapshots(dec.good(decoded)), path)
    stored = read_parsed(spark, path, one_per_file=False)
    return _flat_stop_times(stored.select(F.explode("trips").alias("trip")).select("trip.*"))


@query
def json_snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents, some of them cut short: vehicles of the good, labels of the bad."""
    decoded = _decoded(fix.raw_vehicles(spark, sf_dir))
    parsed = snap.parsed_vehicle_snapshots(dec.good(decoded), "feed_no")
    document = F.to_json(
        F.struct("header", "vehicle_count", "vehicles"), {"ignoreNullFields": "false"}
    )
    cut = F.concat(F.lit('{"label": "feed '), F.col("feed_no").cast("string"), F.lit('", "vehi'))
    path = scratch_path(spark, "documents")
    _written_text(parsed.select(F.when(F.col("feed_no") % 9 == 4, cut).otherwise(document)), path)

    stored = read_parsed(spark, path, one_per_file=False)
    label = F.regexp_extract("_corrupt_record", "feed ([0-9]+)", 1)
    vehicle = [F.col(f"vehicle.{name}").alias(name) for name in ("id", "trip_id", "route_id")]
    rows = stored.select("status", label.alias("label"), F.explode_outer("vehicles").alias("vehicle"))
    good = rows.filter("status = 'ok' AND vehicle IS NOT NULL").select("status", "label", *vehicle)
    bad = rows.filter("status <> 'ok'").select("status", "label", *vehicle)
    return good.withColumn("label", F.lit(None).cast("string")).unionByName(bad)


def _vehicle_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents of vehicles: feed_no, document (a text).

    They have keys beyond the typed ones; some feeds are empty, some documents cut short.
    """
    feed_no = F.col("feed_no")
    decoded = _decoded(fix.raw_vehicles(spark, sf_dir))
    parsed = snap.parsed_vehicle_snapshots(dec.good(decoded), "feed_no")
    marked = F.transform("vehicles", lambda v: v.withField("car", F.concat(F.lit("C"), v["id"])))
    listed = F.when(feed_no % 7 != 2, marked).otherwise(F.filter(marked, lambda v: F.lit(False)))
    document = F.to_json(
        F.struct("header", listed.alias("vehicles"), F.struct(feed_no.alias("feed")).alias("note")),
        {"ignoreNullFields": "false"},
    )
    return parsed.select("feed_no", _cut(document, feed_no % 9 == 4).alias("document"))


def _trip_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents of trips, with a key of their own; some are cut short."""
    decoded = _decoded(fix.raw_trips(spark, sf_dir))
    parsed = snap.parsed_trip_snapshots(dec.good(decoded), "feed_no", "part")
    note = F.struct(F.col("feed_no").alias("feed"), "part").alias("note")
    document = F.to_json(
        F.struct("header", "trip_count", "trips", note), {"ignoreNullFields": "false"}
    )
    bad = (F.col("feed_no") + F.col("part")) % 9 == 4
    return parsed.select("feed_no", _cut(document, bad).alias("document"))


def _cut(document: Column, bad: Column) -> Column:
    return F.when(bad, F.substr(document, F.lit(1), F.length(document) - 9)).otherwise(document)


@query
def interpret_stored_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 50 interpreted vehicles of each stored document, with the count of all.

    Keys outside the typed columns come from the document as stored.
    """
    path = scratch_path(spark, "vehicle-documents")
    _written_text(_vehicle_documents(spark, sf_dir).select("document"), path)
    stored = read_documents(spark, path, one_per_file=False)
    feed_no = field(F.col("document"), "$.note.feed", "bigint")
    rows = docs.interpret_documents(stored.withColumn("feed_no", feed_no), "feed_no")
    whole = docs.interpreted_vehicle(rows)
    return _flat_trip_info(
        rows.select(
            "feed_no",
            field(F.col("header"), "$.timestamp", "bigint").alias("header_timestamp"),
            "id",
            "total_vehicles",
            field(F.col("vehicle"), "$.car", "string").alias("car"),
            F.get_json_object(whole, "$.car").alias("kept_car"),
            F.get_json_object(whole, "$.route_name").alias("kept_route_name"),
            "route_name",
            "trip_info",
            "timestamp_readable",
        )
    )


@query
def json_pass_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of both kinds in one folder; interpretation returns those of trips as stored."""
    path = scratch_path(spark, "both-documents")
    for documents in (_vehicle_documents(spark, sf_dir), _trip_documents(spark, sf_dir)):
        _written_text(documents.select("document"), path)
    document = F.col("document")
    passed = docs.passed_documents(read_documents(spark, path, one_per_file=False))
    return passed.select(
        field(document, "$.note.feed", "bigint").alias("feed_no"),
        field(document, "$.note.part", "bigint").alias("part"),
        field(document, "$.header.timestamp", "bigint").alias("header_timestamp"),
        field(document, "$.trip_count", "bigint").alias("trip_count"),
        F.size(field(document, "$.trips", "array<variant>")).cast("bigint").alias("trips"),
    )


@query
def json_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are no JSON, by the feed that their text still names."""
    path = scratch_path(spark, "invalid-documents")
    documents = _vehicle_documents(spark, sf_dir)
    named = F.concat(F.lit('{"for":'), F.col("feed_no").cast("string"), F.lit(","))
    _written_text(documents.select(F.concat(named, F.substr("document", F.lit(2)))), path)
    bad = docs.invalid_documents(read_documents(spark, path, one_per_file=False))
    return bad.select(
        "status", F.regexp_extract("invalid", '"for":([0-9]+)', 1).cast("bigint").alias("feed_no")
    )


def _one_per_file(spark: SparkSession, sf_dir: str) -> str:
    """Indented documents, each a file of its own, as the reader meets them outside Spark.

    Every third feed has left a file of length 0 as well.
    """
    feeds = dec.good(_decoded(fix.raw_vehicles(spark, sf_dir)))
    parsed = snap.parsed_vehicle_snapshots(feeds, "feed_no")
    options = {"ignoreNullFields": "false", "pretty": "true"}
    document = F.to_json(F.struct("header", "vehicle_count", "vehicles"), options)
    name = H.snapshot_filename(F.lit(VEHICLE_POSITIONS), fix.captured_at(F.col("feed_no")), "json")
    whole = F.struct(name.alias("filename"), F.encode(document, "UTF-8").alias("content"))
    empty = F.struct(F.concat(F.lit("empty_"), name).alias("filename"), F.lit(b"").alias("content"))
    # One pass makes both, as a second one would decode every feed again.
    both = F.when(F.col("feed_no") % 3 == 0, F.array(whole, empty)).otherwise(F.array(whole))
    files = parsed.select(F.explode(both).alias("file")).select("file.*")
    path = scratch_path(spark, "one-per-file")
    write_files(files, path)
    return path


@query
def json_one_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicles of stored documents that span many lines, with the count each one states."""
    stored = read_parsed(spark, _one_per_file(spark, sf_dir))
    rows = stored.select("status", "vehicle_count", F.explode("vehicles").alias("vehicle"))
    return _flat(rows.select("status", "vehicle_count", "vehicle.*"))


@query
def json_file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many stored documents the listing finds, and how many of them are empty."""
    files = list_snapshots(spark, _one_per_file(spark, sf_dir))
    return files.agg(
        F.countDistinct("filename").alias("files"),
        F.count_if((F.col("size") > 0) & F.col("modified").isNotNull()).alias("complete"),
        F.count_if(F.col("size") == 0).alias("empty"),
    )


@query
def daily_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files below day folders, one an hour and kind: how many each day has, and their bytes."""
    hour = F.col("captured_at") - F.col("captured_at") % 3600
    hours = fix.catalog(spark, sf_dir).groupBy("feed_type", hour.alias("hour")).agg(
        (F.sum("size") % 5000).cast("int").alias("bytes")
    )
    name = H.snapshot_filename(F.col("feed_type"), F.col("hour"), "json")
    target = F.concat_ws("/", *H.day_folder(F.col("hour")).values(), name)
    content = F.encode(F.repeat(F.lit("x"), F.col("bytes")), "UTF-8")
    path = scratch_path(spark, "days")
    write_files(hours.select(target.alias("filename"), content.alias("content")), path)
    return list_days(spark, path).groupBy("day").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")
    )


# --- aggregates, top-k, union --------------------------------------------------


@query
def vehicle_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snap.count_by_feed(fix.vehicles(spark, sf_dir), "feed_no", "vehicle_count")


@query
def trip_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trips.with_trip_update(fix.trip_entities(spark, sf_dir))
    return snap.count_by_feed(rows, "feed_no", "trip_count")


@query
def fetch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.fetch_stats(fix.fetch_log(spark, sf_dir), "feed_type")


@query
def fetch_stats_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of one connector that fetches both kinds."""
    return stats.fetch_stats(fix.fetch_log(spark, sf_dir))


@query
def upload_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.upload_stats(fix.upload_log(spark, sf_dir))


@query
def flow_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.flow_summary(fix.flow_log(spark, sf_dir), "run_no")


@query
def latest20_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fix.catalog(spark, sf_dir).select("event_id", "filename", "size")
    return snap.latest_files(files, "event_id")


@query
def first50_per_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fix.vehicles(spark, sf_dir)
    narrow = rows.select("feed_no", "entity_pos", "id", "trip_id", "route_id")
    return vehicles.first_vehicles(narrow, "feed_no", "entity_pos")


@query
def union_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = trips.project_trips(_bare_trips(spark, sf_dir), "feed_no")
    return snap.union_feeds(
        fix.vehicles(spark, sf_dir).select(*RECORD), updates.select(*RECORD)
    )


def _bare_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip entities in the decoded shape, with no stop times."""
    update = F.col("trip_update").withField("stop_time_update", _no_stop_times())
    return fix.trip_entities(spark, sf_dir).withColumn("trip_update", update)


def _no_stop_times() -> Column:
    return F.from_json(F.lit("[]"), f"array<{STOP_TIME.simpleString()}>")


# --- sinks and streams -----------------------------------------------------------


@query
def daily_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots in daily folders, with the key each has in a bucket."""
    path = scratch_path(spark, "daily")
    files = fix.catalog(spark, sf_dir).drop("event_id")
    dated = with_day(files, F.col("captured_at"))
    write_daily(dated, path)
    stored = spark.read.schema(dated.schema).parquet(path)
    key = F.concat_ws("/", *DAY, "filename")
    return stored.select("feed_type", "size", *DAY, key.alias("object_key"))


def _landed(spark: SparkSession, sf_dir: str, files_per_trigger: int = 100_000) -> DataFrame:
    """A stream of raw vehicle snapshots."""
    raw = fix.raw_vehicles(spark, sf_dir).drop("feed_no", "part")
    # One url serves all kinds, so every message lands under the name of each.
    kinds = F.array(*map(F.lit, ("vehicle_positions", "trip_updates", "alerts")))
    name = F.expr("replace(path, 'vehicle_positions', kind)")
    landing = scratch_path(spark, "stream-landing")
    raw.withColumn("kind", F.explode(kinds)).withColumn("path", name).drop("kind").write.parquet(landing, compression="zstd")
    return read_raw_stream(spark, landing, "parquet", files_per_trigger)


@query
def stream_vehicles_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table taken in as a stream, then read back."""
    target, state = scratch_path(spark, "stream-vehicles"), scratch_path(spark, "stream-state")
    stream_vehicles(_landed(spark, sf_dir), target, state, once()).awaitTermination()
    rows = spark.read.parquet(target)
    shaped = rows.withColumn("feed_no", _feed_no(H.snapshot_epoch(F.col("path"))))
    return _flat(shaped.drop("path", "entity_pos"))


def _ingested_pair(spark: SparkSession, sf_dir: str) -> str:
    """Messages of both kinds taken in; gives the folder of the tables."""
    landing = scratch_path(spark, "ingest-landing")
    for raw in (fix.raw_vehicles(spark, sf_dir), fix.raw_trips(spark, sf_dir)):
        raw.drop("feed_no", "part").write.mode("append").parquet(landing, compression="zstd")
    target, state = scratch_path(spark, "ingest"), scratch_path(spark, "ingest-state")
    raw = read_raw_stream(spark, landing, "parquet")
    ingest_snapshots(raw, target, state, once()).awaitTermination()
    return target


@query
def stream_pair_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicles and trips of one ingestion, by day; a trip has a row in each part."""
    target = _ingested_pair(spark, sf_dir)
    columns = ("path", *DAY, "id", "trip_id", "route_id", "timestamp")
    union = snap.union_feeds(
        read_ingested(spark, target, "vehicles").select(*columns),
        read_ingested(spark, target, "trips").select(*columns),
    )
    return union.withColumn("filename", F.substring_index("path", "/", -1)).drop("path")


@query
def stream_mixed_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with vehicles and trips, stored under every name: each is read as its own kind."""
    target, state = scratch_path(spark, "mixed"), scratch_path(spark, "mixed-state")
    ingest_snapshots(_landed(spark, sf_dir), target, state, once()).awaitTermination()
    columns = (_filename(), "id", "trip_id")
    return snap.union_feeds(
        read_ingested(spark, target, "vehicles").select(*columns),
        read_ingested(spark, target, "trips").select(*columns),
    )


@query
def raw_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes that an ingestion kept, of every kind, and what they decode to."""
    target, state = scratch_path(spark, "kept"), scratch_path(spark, "kept-state")
    ingest_snapshots(_landed(spark, sf_dir), target, state, once()).awaitTermination()
    raw = read_ingested(spark, target, "raw")
    whole = (F.length("content") == F.col("length")).alias("whole")
    decoded = dec.decode(raw.select(_filename(), "feed_type", *DAY, whole, "content"))

    def carrying(payload: str) -> Column:
        found = F.filter("entities", lambda entity: entity[payload].isNotNull())
        return F.size(found).cast("bigint")

    return decoded.select(
        "filename",
        "feed_type",
        *DAY,
        "whole",
        carrying("vehicle").alias("vehicle_count"),
        carrying("trip_update").alias("trip_count"),
    )


def _filename() -> Column:
    return F.substring_index("path", "/", -1).alias("filename")


@query
def stream_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a supervised ingestion that takes the raw table in, over its whole life."""
    target, state = scratch_path(spark, "status"), scratch_path(spark, "status-state")
    progress = scratch_path(spark, "status-progress")
    landed = _landed(spark, sf_dir, files_per_trigger=3)
    log = log_progress(spark, progress)
    running = supervise(lambda: ingest_snapshots(landed, target, state, once()))
    log.settle(running)
    stop_logging(spark, log)
    batches = read_ingested(spark, target, "raw").agg(F.countDistinct("batch_id").alias("_batches"))
    life = life_totals(spark, progress).join(batches, F.col("batches") == F.col("_batches"), "left")
    # One query has run, so there is one row of totals for every kind.
    whole = life.select(
        "input_rows",
        F.col("_batches").isNotNull().alias("every_batch"),
        F.col("last_batch_at").isNotNull().alias("timed"),
        F.lit(setting_of(once())).alias("trigger"),
    )
    return status_totals(running, target, once()).join(F.broadcast(whole), "trigger")


@query
def stream_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored JSON form that an ingestion wrote beside the bytes, with its counts."""
    target = _ingested_pair(spark, sf_dir)

    def read(table: str, rows: str, count: str, kind: str) -> DataFrame:
        return read_ingested(spark, target, table).select(
            _filename(),
            F.lit(kind).alias("feed_type"),
            *DAY,
            F.col("header.timestamp").alias("header_timestamp"),
            F.col(count).alias("counted"),
            F.size(rows).cast("bigint").alias("listed"),
        )

    return read("parsed_vehicles", "vehicles", "vehicle_count", "vehicle_positions").unionByName(
        read("parsed_trips", "trips", "trip_count", "trip_updates")
    )
