"""A snapshot decoded by several tasks.

A message is length-delimited fields one behind the other, so one cheap pass finds where
its entities lie without decoding any.  The index cuts the message into frames of a bounded
size, each a valid message of its own: the header and some of the entities, or, of an entity
beyond that size, the entity with some of its stop times.  Frames, not messages, are dealt
to tasks and decoded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.operators.decode import decode
from headway.session import stored

FRAME_BYTES = 1 << 18
# Up to this many bad snapshots are named to every task; beyond, they are joined by shuffles.
FEW_BAD = 10_000

# Where the public definition puts what is cut.
_ENTITY, _ID, _TRIP_UPDATE, _STOP_TIME = 2, 1, 3, 2
_DELIMITED = 2

INDEX = T.StructType(
    [
        T.StructField("frame_no", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("frame_length", T.LongType()),
        T.StructField("first_entity", T.IntegerType()),
        T.StructField("first_update", T.IntegerType()),
    ]
)

Field = tuple[int, int, int, int]  # number, start, start of the value, end


class _Uncut(ValueError):
    """Bytes whose fields cannot be told apart."""


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while shift < 70:
        if at >= len(data):
            raise _Uncut
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7
    raise _Uncut


def _fields(data: bytes, start: int, end: int) -> Iterator[Field]:
    """The fields between two places; what is no field there cannot be cut."""
    at = start
    while at < end:
        tag, body = _varint(data, at)
        kind = tag & 7
        if kind == _DELIMITED:
            size, body = _varint(data, body)
            after = body + size
        elif kind == 0:
            _, after = _varint(data, body)
        elif kind in (1, 5):
            after = body + (8 if kind == 1 else 4)
        else:
            raise _Uncut
        if after > end:
            raise _Uncut
        yield (tag >> 3 if kind == _DELIMITED else 0), at, body, after
        at = after


def _size(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _delimited(number: int, value: bytes) -> bytes:
    return _size(number << 3 | _DELIMITED) + _size(len(value)) + value


def _grouped(fields: Iterable[Field], limit: int) -> Iterator[list[Field]]:
    """Runs of fields of about ``limit`` bytes, one field at least."""
    held, size = [], 0
    for field in fields:
        if held and size + field[3] - field[1] > limit:
            yield held
            held, size = [], 0
        held.append(field)
        size += field[3] - field[1]
    if held:
        yield held


def _entity_pieces(data: bytes, entity: Field, limit: int) -> Iterator[tuple[int, Field, bytes]]:
    """An entity as several with its id and trip, each with some of the stop times.

    What else it holds goes with the first of them only.
    """
    own, named, update = [], [], []
    for field in _fields(data, entity[2], entity[3]):
        if field[0] == _TRIP_UPDATE:
            # A field that occurs again is joined to its first occurrence.
            update += _fields(data, field[2], field[3])
        else:
            own.append(data[field[1] : field[3]])
            named += own[-1:] if field[0] == _ID else []
    stops = [field for field in update if field[0] == _STOP_TIME]
    rest = b"".join(data[f[1] : f[3]] for f in update if f[0] != _STOP_TIME)
    if len(stops) < 2:
        yield 0, entity, data[entity[1] : entity[3]]
        return
    at = 0
    for group in _grouped(stops, limit):
        times = b"".join(data[f[1] : f[3]] for f in group)
        value = b"".join(named if at else own) + _delimited(_TRIP_UPDATE, rest + times)
        yield at, (0, group[0][1], 0, group[-1][3]), _delimited(_ENTITY, value)
        at += len(group)


def cut(data: bytes, limit: int) -> list[tuple[int, int, int, int, bytes]]:
    """Offset, length, first entity, first stop time and content of every frame.

    What is not made of fields is one frame, as it is; the decode says what is wrong with it.
    """
    whole = [(0, len(data), 0, 0, data)]
    if len(data) <= limit:
        return whole
    try:
        fields = list(_fields(data, 0, len(data)))
        entities = [field for field in fields if field[0] == _ENTITY]
        head = b"".join(data[f[1] : f[3]] for f in fields if f[0] != _ENTITY)
        found, place = [], 0
        for group in _grouped(entities, limit):
            if len(group) == 1 and group[0][3] - group[0][1] > limit:
                pieces = _entity_pieces(data, group[0], limit)
            else:
                pieces = [(0, (0, group[0][1], 0, group[-1][3]), b"".join(data[f[1] : f[3]] for f in group))]
            for update, span, content in pieces:
                found.append((span[1], span[3] - span[1], place, update, head + content))
            place += len(group)
    except _Uncut:
        return whole
    return found or whole


def frames(df: DataFrame, content: str = "content", limit: int = FRAME_BYTES) -> DataFrame:
    """Cut snapshots into frames: the other columns, the index, and the frame's ``content``.

    Index: ``frame_no``; ``offset`` and ``frame_length`` in the snapshot; ``first_entity``,
    the place of the frame's first entity in the feed; ``first_update``, the place of its
    first stop time in that entity, above 0 where an entity goes on.  A snapshot up to the
    limit, and one that cannot be cut, is one frame; null stays null.  No shuffle.
    """
    kept = [name for name in df.columns if name != content]
    schema = T.StructType([df.schema[name] for name in kept] + INDEX.fields + [df.schema[content]])
    return df.select(*kept, content).mapInArrow(_framed(limit), schema)


def _framed(limit: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = batch.column(batch.num_columns - 1)
            others = batch.drop_columns([batch.schema.names[-1]])
            names = [*batch.schema.names[:-1], *INDEX.names, batch.schema.names[-1]]
            for row in range(batch.num_rows):
                data = contents[row].as_py()
                found = [(None, None, 0, 0, None)] if data is None else cut(data, limit)
                carried = others.take(pa.array([row] * len(found), pa.int32()))
                offsets, lengths, places, updates, parts = zip(*found)
                columns = [
                    pa.array(range(len(found)), pa.int32()),
                    pa.array(offsets, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(places, pa.int32()),
                    pa.array(updates, pa.int32()),
                    pa.array(parts, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(carried.columns + columns, names)

    return run


def deal(framed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Frames spread evenly over all shuffle partitions.

    The number is given, as adaptive execution would join partitions by their bytes, and
    frames are small for the work they make.
    """
    partitions = int(framed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return framed.repartition(partitions, *keys, "frame_no")


def decode_in_frames(
    df: DataFrame,
    keys: Sequence[str],
    content: str = "content",
    feed_type: Column | None = None,
    limit: int = FRAME_BYTES,
) -> DataFrame:
    """Decode snapshots frame by frame: the other columns, the index and the decoded columns.

    ``keys`` name a snapshot.  Frames are dealt by snapshot and number, so a large message
    is decoded by many tasks, and stored in the shared folder.  A snapshot of which any frame
    is bad is bad as a whole: every frame of it carries the error, and no entities.  Decoded
    frames are shuffled for that only where there are many bad ones.
    """
    kind = "_frame_kind"
    asked = F.lit(None).cast("string") if feed_type is None else feed_type
    framed = frames(df.withColumn(kind, asked), content, limit)
    decoded = stored(decode(deal(framed, keys), content, F.col(kind)).drop(kind), "frames")
    bad = (
        decoded.where("decode_error IS NOT NULL")
        .groupBy(*(F.col(key).alias(f"_bad_{key}") for key in keys))
        .agg(F.min("decode_error").alias("_error"))
    )
    few = bad.limit(FEW_BAD + 1).count()
    if not few:
        return decoded
    same = [F.col(key).eqNullSafe(F.col(f"_bad_{key}")) for key in keys]
    told = decoded.join(F.broadcast(bad) if few <= FEW_BAD else bad, same, "left")
    return told.select(
        *(F.col(name) for name in decoded.columns if name not in ("entities", "decode_error")),
        F.when(F.col("_error").isNull(), F.col("entities")).alias("entities"),
        F.col("_error").alias("decode_error"),
    )


def one_per_snapshot(decoded: DataFrame) -> DataFrame:
    """The first frame of every snapshot, for its header or its error."""
    return decoded.where("frame_no = 0")


def framed_entities(decoded: DataFrame, *keys: str) -> DataFrame:
    """Entities of the good snapshots, at their places in the feed.

    An entity that was cut has a row for each piece; ``first_update`` says how many stop
    times lie before a piece.
    """
    exploded = decoded.where("decode_error IS NULL").select(
        *keys, "first_entity", "first_update", F.posexplode("entities").alias("_at", "_entity")
    )
    return exploded.select(
        *keys,
        (F.col("first_entity") + F.col("_at")).alias("entity_pos"),
        F.when(F.col("_at") == 0, F.col("first_update")).otherwise(0).alias("first_update"),
        "_entity.id",
        "_entity.vehicle",
        "_entity.trip_update",
    )
