"""Raw snapshots to tables, micro-batch by micro-batch.

Ingestion keeps no state between snapshots: nothing is deduplicated, windowed or
held back.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from headway.lookups import TRIP_UPDATES, VEHICLE_POSITIONS
from headway.operators.decode import decode, entities, good
from headway.operators.snapshots import parsed_trip_snapshots, parsed_vehicle_snapshots
from headway.operators.trips import project_trips
from headway.operators.vehicles import project_vehicles
from headway.schemas import (
    DECODED,
    HEADER,
    JSON_TRIP,
    JSON_VEHICLE,
    RAW_FILE,
    TRIP_ROW,
    VEHICLE_ROW,
)
from headway.sinks.tables import DAY, with_day, write_daily
from headway.sources.raw import with_names

def _fields(**kinds: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind) for name, kind in kinds.items()]


_KEYS = ("path", "feed_type", "captured_at")
_NAMES = _fields(feed_type=T.StringType(), captured_at=T.LongType())
_DAYS = [T.StructField(name, T.StringType()) for name in DAY]
_RECORD = [RAW_FILE["path"]] + _NAMES + _fields(entity_pos=T.IntegerType())
_FILE = [RAW_FILE[name] for name in ("path", "modificationTime", "length")]

_DIGEST = _fields(digest=T.StringType())

# Raw files are cut into row groups of this size, so that several tasks decode one of them.
ROW_GROUP_BYTES = 8 << 20
# Up to this many contents that came by several names are told to every task.
FEW_SHARED = 100_000
# A row of these tables is a whole snapshot with its entities.  So an ingestion reads and sends
# to Python a few rows at once, and a task that meets a few days keeps a file open for each of
# them, as it would otherwise hold its snapshots to sort them by day.
STREAM_SETTINGS = {
    "spark.sql.parquet.columnarReaderBatchSize": "32",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}
_SETTING = threading.Lock()

SCHEMAS = {
    "raw": T.StructType(RAW_FILE.fields + _NAMES + _DIGEST + _DAYS),
    "decoded": T.StructType(_DIGEST + _FILE + _NAMES + _fields(names=T.LongType()) + DECODED.fields + _DAYS),
    "snapshots": T.StructType(_FILE + _NAMES + DECODED.fields + _DAYS),
    "parsed_vehicles": T.StructType(
        [RAW_FILE["path"], *_fields(header=HEADER, vehicle_count=T.LongType())]
        + _fields(vehicles=T.ArrayType(JSON_VEHICLE))
        + _DAYS
    ),
    "parsed_trips": T.StructType(
        [RAW_FILE["path"], *_fields(header=HEADER, trip_count=T.LongType())]
        + _fields(trips=T.ArrayType(JSON_TRIP))
        + _DAYS
    ),
    "vehicles": T.StructType(_RECORD + VEHICLE_ROW.fields + _DAYS),
    "trips": T.StructType(_RECORD + TRIP_ROW.fields + _DAYS),
}
# The parsed half of the pair is JSON, as stored; the other tables are Parquet.
_JSON = ("parsed_vehicles", "parsed_trips")


def stream_vehicles(raw: DataFrame, target: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Append one row per vehicle to a Parquet table.

    A file is read as the kind that its name states, as the same message may have been
    stored as each kind.

    The file sink records which files each micro-batch committed, so a restart
    neither loses nor repeats a snapshot.
    """
    decoded = decode(with_names(raw), feed_type=F.col("feed_type"))
    vehicles = project_vehicles(entities(decoded, "path"), "path", "entity_pos")
    return (
        vehicles.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(target)
    )


def ingest_snapshots(
    raw: DataFrame, target: str, checkpoint: str, trigger: dict
) -> StreamingQuery:
    """Keep raw and parsed snapshots as a pair, plus flat vehicles and trips.

    Tables below ``target``: ``raw``; ``decoded``, by content, with the first of its names and
    their number; ``snapshots``; the stored JSON
    form with its counts, ``parsed_vehicles`` and ``parsed_trips``; ``vehicles`` and ``trips``.
    Each lies by day and, below the day, by micro-batch, so a read of some days lists those
    only.  A micro-batch owns its ``batch_id`` folders and overwrites them when it is
    replayed.  Each step reads the table that the step before wrote, so bytes are stored
    before anything parses them and a lost executor costs one step at most.

    As one url serves several kinds, the same bytes may come under several names.  In a
    micro-batch each content is decoded once; a name then takes the entities of its kind.
    """

    def take_in(batch: DataFrame, batch_id: int) -> None:
        # The stream's own session, a copy that was made at its start.
        spark = batch.sparkSession

        def write(df: DataFrame, table: str) -> None:
            # A first run over an archive spans many days, so every task would write a file a
            # day.  Raw bytes are rebalanced, as they are the smallest form; the tables behind
            # them follow row by row from files that hold one day each.
            write_daily(
                df.withColumn("batch_id", F.lit(batch_id).cast("bigint")),
                f"{target}/{table}",
                mode="overwrite",
                rebalance=table == "raw",
                below=("batch_id",),
                source="json" if table in _JSON else "parquet",
                partitionOverwriteMode="dynamic",
                **({"parquet.block.size": str(ROW_GROUP_BYTES)} if table == "raw" else {}),
            )

        def written(table: str) -> DataFrame:
            own = f"year=*/month=*/day=*/batch_id={batch_id}"
            return _read(spark, f"{target}/{table}", table, own).drop("batch_id")

        # The batch itself is read once, as Spark counts its rows at every read.
        named = with_names(batch).withColumn("digest", F.sha2(F.coalesce("content", F.lit(b"")), 256))
        # A name without a time still has a place: the day the file was changed.
        moment = F.coalesce("captured_at", F.unix_seconds("modificationTime"))
        write(with_day(named, moment), "raw")
        try:
            written("raw")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return  # files without rows
        # Of the names of a content, the first one has it decoded; only names are shuffled.
        shared = written("raw").groupBy("digest").agg(
            F.min("path").alias("_first"), F.count(F.lit(1)).alias("_names")
        ).where("_names > 1")
        several = shared.limit(FEW_SHARED + 1).count()
        once = _first_of(written("raw"), shared, several)
        write(decode(once), "decoded")
        write(_snapshots(written("raw"), written("decoded"), several > 0), "snapshots")
        snapshots = good(written("snapshots"))

        def of_kind(kind: str) -> DataFrame:
            return snapshots.where(F.col("feed_type").eqNullSafe(kind))

        rows = entities(written("snapshots"), *_KEYS, *DAY)
        outputs = {
            "parsed_vehicles": parsed_vehicle_snapshots(of_kind(VEHICLE_POSITIONS), "path", *DAY),
            "parsed_trips": parsed_trip_snapshots(of_kind(TRIP_UPDATES), "path", *DAY),
            "vehicles": project_vehicles(rows, *_KEYS, "entity_pos", *DAY),
            "trips": project_trips(rows, *_KEYS, "entity_pos", *DAY),
        }
        # None of these needs another, so their jobs share the cluster; the first failure
        # ends the micro-batch once all have stopped.
        run = inheritable_thread_target(spark)(lambda output: write(outputs[output], output))
        with ThreadPoolExecutor(len(outputs)) as pool:
            for done in [pool.submit(run, table) for table in outputs]:
                done.result()

    writer = raw.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint)
    with _settings(raw.sparkSession, STREAM_SETTINGS):
        return writer.trigger(**trigger).start()


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for a stream that starts meanwhile; the session has its own again afterwards."""
    with _SETTING:
        before = {key: spark.conf.get(key) for key in settings}
        try:
            for key, value in settings.items():
                spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)


def _first_of(raw: DataFrame, shared: DataFrame, several: int) -> DataFrame:
    """Each content with the first name it came by and the number of its names."""
    columns = [*_DIGEST, *_FILE, *_NAMES]
    names, first = F.lit(1).cast("bigint"), F.col("path").isNotNull()
    if several:
        raw = raw.join(F.broadcast(shared) if several <= FEW_SHARED else shared, "digest", "left")
        names = F.coalesce("_names", names)
        first &= F.col("_names").isNull() | (F.col("path") == F.col("_first"))
    return raw.where(first).select(
        *[field.name for field in columns], names.alias("names"), "content", *DAY
    )


def _snapshots(raw: DataFrame, decoded: DataFrame, several: bool) -> DataFrame:
    """Decoded contents under every name they came by, each as the kind that its name states.

    A content with one name has it beside it.  Only those with several are joined to them.
    """
    kind = F.col("feed_type")
    known = kind.isNull() | kind.isin(VEHICLE_POSITIONS, TRIP_UPDATES)
    unknown = F.concat(F.lit("ValueError: no parser for feed type "), kind)

    def of_kind(entity: Column) -> Column:
        vehicle = F.when(~kind.eqNullSafe(F.lit(TRIP_UPDATES)), entity["vehicle"])
        update = F.when(~kind.eqNullSafe(F.lit(VEHICLE_POSITIONS)), entity["trip_update"])
        return F.struct(entity["id"].alias("id"), vehicle.alias("vehicle"), update.alias("trip_update"))

    def named(rows: DataFrame) -> DataFrame:
        return rows.select(
            *[field.name for field in _FILE + _NAMES],
            F.when(known, F.col("header")).alias("header"),
            F.when(known, F.transform("entities", of_kind)).alias("entities"),
            F.when(known, F.col("decode_error")).otherwise(unknown).alias("decode_error"),
            *DAY,
        )

    alone = named(decoded.where("names = 1"))
    if not several:
        return alone
    contents = decoded.where("names > 1").select("digest", *DECODED.names)
    return alone.unionByName(named(raw.drop("content").join(contents, "digest")).hint("rebalance", *DAY))


def _read(spark: SparkSession, path: str, table: str, folders: str = "") -> DataFrame:
    schema = T.StructType(SCHEMAS[table].fields + _fields(batch_id=T.LongType()))
    found = f"{path}/{folders}".rstrip("/")
    source = "json" if table in _JSON else "parquet"
    return spark.read.schema(schema).option("basePath", path).format(source).load(found)


def read_ingested(
    spark: SparkSession, target: str, table: str, day: tuple[str, str, str] | None = None
) -> DataFrame:
    """All micro-batches of one table written by :func:`ingest_snapshots`.

    With ``day`` (year, month, day as in the folder names), only the folders of that day
    are listed and read.
    """
    folders = "/".join(f"{name}={value}" for name, value in zip(DAY, day or ()))
    return _read(spark, f"{target}/{table}", table, folders)


def compact_day(
    spark: SparkSession, target: str, compacted: str, table: str, day: tuple[str, str, str]
) -> None:
    """Join the micro-batches of a finished day into files of full size below ``compacted``.

    A repeated run replaces that day and no other.  The batches stay where they are, so
    readers are not disturbed; whoever moves readers over removes them.
    """
    rows = read_ingested(spark, target, table, day).drop("batch_id")
    path = f"{compacted}/{table}"
    source = "json" if table in _JSON else "parquet"
    write_daily(rows, path, mode="overwrite", source=source, partitionOverwriteMode="dynamic")
