"""Raw snapshots to typed entities.

The wire decode is the one step without a built-in expression in a plain Spark
distribution.  It runs in ``mapInArrow`` on whichever partitions the scan
produced, so it adds no shuffle, and it hands nested Arrow columns back, built
column by column from the schema.  What an absent field means is decided
afterwards, in projections.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate, chain

import pyarrow as pa
from google.protobuf.message import DecodeError
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from headway.lookups import TRIP_UPDATES, VEHICLE_POSITIONS
from headway.schemas import DECODED, ENTITY, HEADER
from headway.sources.wire import feed_message_class

# An output batch is closed once it holds this many entities.
ENTITIES_PER_BATCH = 20_000

_HEADER, _ENTITY = to_arrow_type(HEADER), to_arrow_type(ENTITY)
_NO_HEADER, _NO_ENTITIES = pa.nulls(1, _HEADER), pa.nulls(0, _ENTITY)
_OTHER_PAYLOAD = {VEHICLE_POSITIONS: "trip_update", TRIP_UPDATES: "vehicle"}


def decode(df: DataFrame, content: str = "content", feed_type: Column | None = None) -> DataFrame:
    """Replace the ``content`` column by ``header``, ``entities`` and ``decode_error``.

    A snapshot that cannot be decoded, null and empty ones included, keeps its row, with the
    reason in ``decode_error``.  Numbers beyond a BIGINT become null.  Where ``feed_type`` is
    given, only entities of that kind are read and a kind without a parser is an error; null
    reads both kinds.
    """
    kept = [name for name in df.columns if name != content]
    kind = F.lit(None).cast("string") if feed_type is None else feed_type
    narrow = df.select(*kept, F.col(content).alias("_content"), kind.alias("_kind"))
    schema = T.StructType([df.schema[name] for name in kept] + DECODED.fields)
    return narrow.mapInArrow(_decode_batches, schema)


def good(decoded: DataFrame) -> DataFrame:
    """Snapshots that were decoded."""
    return decoded.filter(F.col("decode_error").isNull())


def quarantine(decoded: DataFrame) -> DataFrame:
    """Snapshots that were not, with the reason; their bytes stay in the raw table."""
    return decoded.filter(F.col("decode_error").isNotNull()).drop("header", "entities")


def headers(decoded: DataFrame, *keys: str) -> DataFrame:
    """Header fields, one row per decoded snapshot."""
    return good(decoded).select(
        *keys,
        F.col("header.gtfs_realtime_version").alias("gtfs_realtime_version"),
        F.col("header.timestamp").alias("header_timestamp"),
    )


def entities(decoded: DataFrame, *keys: str) -> DataFrame:
    """One row per entity: ``keys``, ``entity_pos`` in feed order, ``id`` and both payloads."""
    exploded = good(decoded).select(*keys, F.posexplode("entities").alias("entity_pos", "entity"))
    return exploded.select(
        *keys, "entity_pos", "entity.id", "entity.vehicle", "entity.trip_update"
    )


def _decode_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    feed_message = feed_message_class()
    for batch in batches:
        carried = batch.drop_columns(["_content", "_kind"])
        kinds = batch.column("_kind").to_pylist()
        start, snapshots, held = 0, [], 0
        for index, content in enumerate(batch.column("_content")):
            snapshots.append(_decode_one(feed_message, content.as_py(), kinds[index]))
            held += len(snapshots[-1][1])
            if held >= ENTITIES_PER_BATCH:
                yield _to_batch(carried.slice(start, len(snapshots)), snapshots)
                start, snapshots, held = index + 1, [], 0
        if snapshots:
            yield _to_batch(carried.slice(start, len(snapshots)), snapshots)


def _decode_one(feed_message: type, content: bytes | None, kind: str | None) -> tuple:
    """One snapshot as Arrow: its header (length 1), its entities, and an error text."""
    try:
        if kind not in (None, VEHICLE_POSITIONS, TRIP_UPDATES):
            raise ValueError(f"no parser for feed type {kind}")
        feed = feed_message()
        if not content:
            raise ValueError("no content")
        feed.ParseFromString(content)
        # The stored header has the wire defaults where a field is unset.
        for name in _HEADER.names:
            setattr(feed.header, name, getattr(feed.header, name))
        skipped = _OTHER_PAYLOAD.get(kind)
        return _struct([feed.header], _HEADER), _struct(feed.entity, _ENTITY, skipped), None
    # A bad snapshot is a row; anything else, such as a lack of memory, fails the task.
    except (DecodeError, UnicodeError, ValueError) as problem:
        return _NO_HEADER, _NO_ENTITIES, f"{type(problem).__name__}: {problem}"


def _struct(messages: Sequence, kind: pa.StructType, skipped: str | None = None) -> pa.Array:
    """Messages, or ``None`` for absent ones, to one Arrow struct array, field by field.

    Field names of the schema are field names of the wire.
    """
    columns = []
    for field in kind:
        name = field.name
        if name == skipped:
            columns.append(pa.nulls(len(messages), field.type))
        elif pa.types.is_list(field.type):
            lists = [() if message is None else getattr(message, name) for message in messages]
            offsets = pa.array(accumulate(map(len, lists), initial=0), pa.int32())
            items = _struct(list(chain.from_iterable(lists)), field.type.value_type)
            columns.append(pa.ListArray.from_arrays(offsets, items, type=field.type))
        else:
            values = [
                getattr(message, name) if message is not None and message.HasField(name) else None
                for message in messages
            ]
            if values.count(None) == len(values):
                columns.append(pa.nulls(len(values), field.type))
            elif pa.types.is_struct(field.type):
                columns.append(_struct(values, field.type))
            else:
                columns.append(_leaves(values, field.type))
    absent = pa.array([message is None for message in messages], pa.bool_())
    return pa.StructArray.from_arrays(columns, fields=list(kind), mask=absent)


def _leaves(values: list, kind: pa.DataType) -> pa.Array:
    """Values of a leaf; an unsigned number that a BIGINT cannot hold becomes null."""
    if pa.types.is_int64(kind) and any(value is not None and value >= 2**63 for value in values):
        values = [value if value is None or value < 2**63 else None for value in values]
    return pa.array(values, kind)


def _to_batch(carried: pa.RecordBatch, snapshots: list[tuple]) -> pa.RecordBatch:
    headers, entity_lists, errors = zip(*snapshots)
    offsets = pa.array(accumulate(map(len, entity_lists), initial=0), pa.int32())
    bad = pa.array([error is not None for error in errors], pa.bool_())
    entity_column = pa.ListArray.from_arrays(
        offsets, pa.concat_arrays(entity_lists), type=pa.list_(_ENTITY), mask=bad
    )
    columns = [pa.concat_arrays(headers), entity_column, pa.array(errors, pa.string())]
    return pa.RecordBatch.from_arrays(
        carried.columns + columns, carried.schema.names + DECODED.names
    )
