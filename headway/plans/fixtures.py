"""Transit-shaped inputs derived from the given tables.

Every row of a table becomes one record, and the remainder of its key decides
which of the record's optional parts are missing.  ``oracle.py`` states the same
rules in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions import epoch_seconds, snapshot_filename
from headway.lookups import TRIP_UPDATES, VEHICLE_POSITIONS
from headway.sources.wire import feed_message_class

ROUTES = ("1", "2", "A", "GS", "SI", "X9")
VEHICLES_PER_FEED = 100
TRIPS_PER_FEED = 1000
FIRST_SNAPSHOT = 1704067200  # 2024-01-01 00:00:00
SNAPSHOT_STEP = 20
# A feed of trips is as many messages as its lines fill; they are dealt by the line's own
# numbers, so an order that holds many lines fills several messages.
LINES_PER_MESSAGE = 500
# Records of a batch that are Python values at the same time.
ROWS_AT_ONCE = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _unless(key: Column, divisor: int, value: Column, remainder: int = 0) -> Column:
    """``value``, missing where ``key`` leaves ``remainder``."""
    return F.when(key % divisor != remainder, value)


def pick(options: Iterable[str | None], index: Column) -> Column:
    return F.get(F.array(*[F.lit(option) for option in options]), index.cast("int"))


def clock_digits(moment: Column) -> Column:
    """``HHmmss`` of a zone-free timestamp."""
    return F.translate(F.substring(moment.cast("string"), 12, 8), ":", "")


def captured_at(feed_no: Column) -> Column:
    return F.lit(FIRST_SNAPSHOT) + feed_no * SNAPSHOT_STEP


# --- vehicles, from events -------------------------------------------------


# Of these columns follows all that an entity holds.
EVENT = ("event_id", "user_id", "event_type", "value", "ts")


def _vehicle_leaves(events: DataFrame, *kept: str) -> DataFrame:
    """The leaves of each entity, null where unset, and which of its parts are present."""
    key, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    route = pick(ROUTES, user % 6)
    digits = clock_digits(F.col("ts"))
    tail = F.concat(
        F.substr(F.lit("NSEWX"), (key % 5 + 1).cast("int"), F.lit(1)),
        F.lpad((key % 40).cast("string"), 2, "0"),
        F.lit("R"),
    )
    trip_id = (
        F.when(key % 17 == 1, F.lit(None))
        .when(key % 17 == 2, "BADTRIP")
        .when(key % 17 == 3, F.concat(digits, F.lit("_1.N03R")))
        .when(key % 17 == 4, F.concat(digits, F.lit("_7..")))
        .otherwise(F.concat(digits, F.lit("_"), route, F.lit(".."), tail))
    )
    seconds = F.when(key % 13 == 0, F.lit(0)).otherwise(epoch_seconds(F.col("ts")))
    leaves = {
        "feed_no": F.expr(f"event_id div {VEHICLES_PER_FEED}"),
        "entity_pos": key % VEHICLES_PER_FEED,
        "id": F.lpad(key.cast("string"), 12, "0"),
        "has_vehicle": F.col("event_type") != "error",
        "has_trip": key % 17 != 0,
        "has_descriptor": key % 10 != 0,
        "has_position": key % 11 != 0,
        "trip_id": trip_id,
        "route_id": _unless(key, 19, route),
        "vehicle_id": _unless(key, 23, F.concat(F.lit("V"), user.cast("string"))),
        "latitude": value.cast("float").cast("double"),
        "longitude": (-value / 4).cast("float").cast("double"),
        "bearing": _unless(key, 3, (key % 360).cast("double")),
        "speed": _unless(key, 4, (user / 8).cast("float").cast("double"), 1),
        "timestamp": _unless(key, 29, seconds).cast("bigint"),
        "current_stop_sequence": _unless(key, 31, user % 40),
        "current_status": _unless(key, 37, key % 3).cast("int"),
        "stop_id": _unless(key, 41, F.concat((user % 30).cast("string"), F.lit("N"))),
    }
    return events.select(*kept, *[leaf.alias(name) for name, leaf in leaves.items()])


POSITION = ("latitude", "longitude", "bearing", "speed")
OWN_LEAVES = ("timestamp", "current_stop_sequence", "current_status", "stop_id")


def vehicle_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded entities; those of ``error`` events carry no vehicle."""
    return _vehicle_entities(table(spark, sf_dir, "events"))


def _vehicle_entities(events: DataFrame, *kept: str) -> DataFrame:
    vehicle = F.struct(
        F.when(F.col("has_trip"), F.struct("trip_id", "route_id")).alias("trip"),
        F.when(F.col("has_descriptor"), F.struct(F.col("vehicle_id").alias("id"))).alias(
            "vehicle"
        ),
        F.when(F.col("has_position"), F.struct(*POSITION)).alias("position"),
        *OWN_LEAVES,
    )
    return _vehicle_leaves(events, *kept).select(
        *kept, "feed_no", "entity_pos", "id", F.when(F.col("has_vehicle"), vehicle).alias("vehicle")
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle rows, flat from the start, so that a scan reads used columns only."""
    leaves = _vehicle_leaves(table(spark, sf_dir, "events")).filter("has_vehicle")

    def under(part: str, name: str, default: object) -> Column:
        return F.when(F.col(part), F.coalesce(name, F.lit(default))).alias(name)

    return leaves.select(
        "feed_no",
        "entity_pos",
        "id",
        under("has_descriptor", "vehicle_id", ""),
        under("has_trip", "trip_id", ""),
        under("has_trip", "route_id", ""),
        *[under("has_position", name, 0.0) for name in POSITION],
        *OWN_LEAVES,
    )


# --- trips, from orders and lineitem ---------------------------------------


def trip_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per order, without its stop times."""
    return _trip_entities(table(spark, sf_dir, "orders"))


def _trip_entities(orders: DataFrame, *kept: Column | str) -> DataFrame:
    key = F.col("o_orderkey")
    route = pick(ROUTES, F.col("o_custkey") % 6)
    trip_id = F.concat(
        F.lpad((key % 240000).cast("string"), 6, "0"), F.lit("_"), route, F.lit("..S01R")
    )
    trip = F.struct(
        _unless(key, 14, trip_id).alias("trip_id"), _unless(key, 15, route).alias("route_id")
    )
    return orders.select(
        F.expr(f"o_orderkey div {TRIPS_PER_FEED}").alias("feed_no"),
        key.alias("order_key"),
        _trip_entity_id().alias("id"),
        F.struct(
            _unless(key, 13, trip).alias("trip"),
            _unless(key, 9, epoch_seconds(F.col("o_orderdate"))).alias("timestamp"),
        ).alias("trip_update"),
        *kept,
    )


def _trip_entity_id() -> Column:
    return F.concat(F.lit("T"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))


def stop_updates(lineitem: DataFrame) -> DataFrame:
    """One stop-time update per line."""
    return lineitem.select(F.col("l_orderkey").alias("order_key"), _stop_update().alias("update"))


def _stop_update() -> Column:
    part, supplier, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    shipped, delay = epoch_seconds(F.col("l_shipdate")), F.col("l_quantity").cast("int")
    arrival = F.struct(
        _unless(part, 5, shipped).alias("time"), _unless(line, 3, delay).alias("delay")
    )
    departure = F.struct(
        _unless(part, 6, shipped + 30).alias("time"), _unless(line, 4, -delay).alias("delay")
    )
    return F.struct(
        _unless(supplier, 11, line.cast("bigint")).alias("stop_sequence"),
        _unless(part, 17, F.concat(supplier.cast("string"), F.lit("N"))).alias("stop_id"),
        _unless(part, 7, arrival).alias("arrival"),
        _unless(supplier, 5, departure).alias("departure"),
    )


# Of these columns follow a trip and a stop time.
ORDER = ("o_orderkey", "o_custkey", "o_orderdate")
LINE = ("l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity")


def trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with one row per stop-time update; a trip without any has a null update."""
    return _trip_rows(_dealt_lines(spark, sf_dir))


def _trip_rows(dealt: DataFrame) -> DataFrame:
    """Dealt lines with their trip and stop time in the wire's shape."""
    update = F.when(F.col("has_line"), _stop_update()).alias("update")
    return _trip_entities(dealt.drop("feed_no"), "part", update)


def _dealt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and their order as the tables hold them, with the message each goes to.

    An order without lines has a row, of which ``has_line`` is null.  Rows are wide once they
    have a record's shape, so joins and shuffles see the few columns it follows from.

    Lines lead the inner join, as only that lets adaptive execution split an order
    that holds a large part of all lines.  An outer join from the orders could not, so
    orders without lines are found apart, against distinct keys.  How many messages a feed
    has comes to the lines with their order, without a join of its own.
    """
    feed_no = F.expr(f"o_orderkey div {TRIPS_PER_FEED}").alias("feed_no")
    orders = table(spark, sf_dir, "orders").select(*ORDER, feed_no)
    lineitem = table(spark, sf_dir, "lineitem")
    feed = F.expr(f"l_orderkey div {TRIPS_PER_FEED}").alias("feed_no")
    parts = F.floor(F.count(F.lit(1)) / LINES_PER_MESSAGE) + 1
    counted = orders.join(lineitem.groupBy(feed).agg(parts.alias("parts")), "feed_no")
    used = lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    lines = lineitem.select(F.col("l_orderkey").alias("o_orderkey"), *LINE).join(counted, "o_orderkey")
    deal = (F.col("l_partkey") + F.col("l_suppkey") + F.col("l_linenumber")).cast("bigint")
    lines = lines.withColumn("part", deal % F.col("parts")).withColumn("has_line", F.lit(True))
    bare = orders.join(used, "o_orderkey", "left_anti").withColumn("part", F.lit(0).cast("bigint"))
    return lines.drop("parts").unionByName(bare, allowMissingColumns=True)


# --- raw snapshots -----------------------------------------------------------


def _rows(array: pa.Array) -> list:
    """Python values of a nested array, taken leaf column by leaf column."""
    if pa.types.is_struct(array.type):
        names = [field.name for field in array.type]
        children = zip(*[_rows(child) for child in array.flatten()])
        present = array.is_valid().to_numpy(zero_copy_only=False)
        return [
            dict(zip(names, child)) if there else None for there, child in zip(present, children)
        ]
    if array.null_count and pa.types.is_floating(array.type):
        return array.to_pylist()
    return array.to_pandas(integer_object_nulls=True).tolist()


def _encode_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by feed, part and entity to one message each; nulls stay unset."""
    feed_message = feed_message_class()
    feed = entity = key = None

    def encoded(messages: list[tuple]) -> pa.RecordBatch:
        contents = [feed_message(**feed).SerializePartialToString() for _, feed in messages]
        numbers, parts = (pa.array([k[i] for k, _ in messages], pa.int64()) for i in range(2))
        return pa.RecordBatch.from_arrays(
            [numbers, parts, pa.array(contents, pa.binary())], ["feed_no", "part", "content"]
        )

    slices = (
        batch.slice(start, ROWS_AT_ONCE)
        for batch in batches
        for start in range(0, batch.num_rows, ROWS_AT_ONCE)
    )
    for batch in slices:
        done = []
        for row in _rows(batch.to_struct_array()):
            if (row["feed_no"], row["part"]) != key:
                if feed is not None:
                    done.append((key, feed))
                seconds = row["header_timestamp"]
                header = {"gtfs_realtime_version": "2.0", "timestamp": seconds}
                feed, entity = {"header": header, "entity": []}, None
                key = row["feed_no"], row["part"]
            update = row.get("update")
            # Only a further stop time continues a trip; any other row is its own record.
            if update is None or entity is None or entity["id"] != row["id"]:
                payloads = {name: row.get(name) for name in ("vehicle", "trip_update")}
                entity = {"id": row["id"], **payloads}
                feed["entity"].append(entity)
            if update is not None:
                entity["trip_update"].setdefault("stop_time_update", []).append(update)
        if done:
            yield encoded(done)
    if feed is not None:
        yield encoded([(key, feed)])


def _by_id(key: str, entity_id: Column) -> list[Column]:
    """The order of ids that are a key padded to 12 digits, mostly without making them."""
    odd = (F.col(key) < 0) | (F.col(key) >= 10**12)
    return [F.when(odd, entity_id).asc_nulls_last(), F.col(key)]


def raw_snapshots(
    records: DataFrame, feed_type: str, order: list[Column], shaped: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Encode records into snapshots shaped like the binary file source, plus their key.

    Each ``feed_no`` and ``part`` is one message, whatever the number of cores, files or
    partitions: one exchange by that key brings its records together.  They are sent and
    sorted (by ``order``) as they are; ``shaped`` makes entities of them afterwards.
    """
    feed_no, part = F.col("feed_no"), F.col("part")
    sent = records.repartition("feed_no", "part").sortWithinPartitions("feed_no", "part", *order)
    together = shaped(sent).withColumn("header_timestamp", _unless(feed_no, 5, captured_at(feed_no)))
    messages = together.mapInArrow(
        _encode_batches, "feed_no bigint, part bigint, content binary"
    )
    moment = captured_at(feed_no) + part
    name = snapshot_filename(F.lit(feed_type), moment, "pb")
    # Messages of neighbouring feeds may share a second, and so a name, but no folder.
    folder = F.concat(F.lit("/landing/"), part.cast("string"), F.lit("/"))
    return messages.select(
        "feed_no",
        "part",
        F.concat(folder, name).alias("path"),
        F.timestamp_seconds(moment).alias("modificationTime"),
        F.length("content").cast("bigint").alias("length"),
        "content",
    )


def raw_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds of vehicles and, as one url serves both kinds, of some trips: the other entities."""
    feed_no = F.expr(f"event_id div {VEHICLES_PER_FEED}").alias("feed_no")
    part = F.lit(0).cast("bigint").alias("part")
    events = table(spark, sf_dir, "events").select(*EVENT, feed_no, part)

    def shaped(sent: DataFrame) -> DataFrame:
        trip = F.struct(F.concat(F.lit("T"), F.col("id")).alias("trip_id"))
        update = F.when(F.col("vehicle").isNull(), F.struct(trip.alias("trip")))
        entities = _vehicle_entities(sent.drop("feed_no"), "part").drop("entity_pos")
        return entities.withColumn("trip_update", update)

    order = _by_id("event_id", F.lpad(F.col("event_id").cast("string"), 12, "0"))
    return raw_snapshots(events, VEHICLE_POSITIONS, order, shaped)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = _by_id("o_orderkey", _trip_entity_id())

    def shaped(sent: DataFrame) -> DataFrame:
        return _trip_rows(sent).drop("order_key")

    return raw_snapshots(_dealt_lines(spark, sf_dir), TRIP_UPDATES, order, shaped)


# --- logs --------------------------------------------------------------------


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three attempts per event; the fourth would have succeeded where none did."""
    key, attempt = F.col("event_id"), F.col("attempt")
    # Time of the event, made into one with a fraction of a second.
    fraction = ((key % 1000) * 1_000).cast("decimal(20,6)") / 1_000_000
    attempts = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(key % 4 + 1, F.lit(3)))).alias(
            "attempt"
        ),
    )
    ok = attempt == key % 4 + 1
    return attempts.select(
        pick((VEHICLE_POSITIONS, TRIP_UPDATES), key % 2).alias("feed_type"),
        (key * 4 + attempt).alias("attempt_key"),
        ok.alias("ok"),
        (~ok & (attempt == 3)).alias("exhausted"),
        (epoch_seconds(F.col("ts")) + fraction).cast("decimal(20,6)").alias("fetched_at"),
        F.when(~ok, F.concat(F.lit("HTTP 503 #"), key.cast("string"))).alias("error"),
    )


def upload_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    outcome = F.when(kind == "view", "skipped").when(kind == "error", "failed").otherwise("ok")
    return table(spark, sf_dir, "events").select(outcome.alias("outcome"))


def flow_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds per run."""
    return table(spark, sf_dir, "events").select(
        F.expr("event_id div 2").alias("run_no"),
        (F.col("event_type") != "error").alias("ok"),
        epoch_seconds(F.col("ts")).alias("finished_at"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored snapshot per event."""
    key, seconds = F.col("event_id"), epoch_seconds(F.col("ts"))
    kind = pick((VEHICLE_POSITIONS, TRIP_UPDATES), key % 2)
    return table(spark, sf_dir, "events").select(
        "event_id",
        kind.alias("feed_type"),
        seconds.alias("captured_at"),
        snapshot_filename(kind, seconds, "json").alias("filename"),
        (key * 7 % 5000).alias("size"),
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop names for three suppliers in four."""
    supplier = table(spark, sf_dir, "supplier")
    return supplier.filter(F.col("s_suppkey") % 4 != 0).select(
        F.concat(F.col("s_suppkey").cast("string"), F.lit("N")).alias("stop_id"),
        F.col("s_name").alias("stop_name"),
    )
