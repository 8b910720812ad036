"""The part of the public GTFS-Realtime message definition that is read here.

Fields that are not listed stay in the message as unknown fields.
"""

from __future__ import annotations

# Field numbers, labels and types of the public definition (proto2).
MESSAGES = """
message FeedMessage       1 header required FeedHeader
                          2 entity repeated FeedEntity
message FeedHeader        1 gtfs_realtime_version required string
                          3 timestamp optional uint64
message FeedEntity        1 id required string
                          3 trip_update optional TripUpdate
                          4 vehicle optional VehiclePosition
message TripUpdate        1 trip required TripDescriptor
                          2 stop_time_update repeated StopTimeUpdate
                          4 timestamp optional uint64
message StopTimeEvent     1 delay optional int32
                          2 time optional int64
message StopTimeUpdate    1 stop_sequence optional uint32
                          2 arrival optional StopTimeEvent
                          3 departure optional StopTimeEvent
                          4 stop_id optional string
message VehiclePosition   1 trip optional TripDescriptor
                          2 position optional Position
                          3 current_stop_sequence optional uint32
                          4 current_status optional VehicleStopStatus
                          5 timestamp optional uint64
                          7 stop_id optional string
                          8 vehicle optional VehicleDescriptor
message Position          1 latitude required float
                          2 longitude required float
                          3 bearing optional float
                          5 speed optional float
message TripDescriptor    1 trip_id optional string
                          5 route_id optional string
message VehicleDescriptor 1 id optional string
"""
STOP_STATUS = ("INCOMING_AT", "STOPPED_AT", "IN_TRANSIT_TO")



def feed_message_class() -> type:
    """Message class for a whole feed; built inside each task, as it cannot be shipped."""
    try:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    except ImportError as missing:
        raise ImportError("decoding snapshots needs the public 'protobuf' package") from missing

    kinds = descriptor_pb2.FieldDescriptorProto
    package = "transit_realtime"
    file = descriptor_pb2.FileDescriptorProto(
        name="feed.proto", package=package, syntax="proto2"
    )
    status = file.enum_type.add(name="VehicleStopStatus")
    for number, name in enumerate(STOP_STATUS):
        status.value.add(name=name, number=number)

    message = None
    for line in MESSAGES.strip().splitlines():
        words = line.split()
        if words[0] == "message":
            message = file.message_type.add(name=words[1])
            words = words[2:]
        number, name, label, kind = words
        field = message.field.add(
            name=name, number=int(number), label=kinds.Label.Value(f"LABEL_{label.upper()}")
        )
        if kind[0].isupper():
            named = kinds.TYPE_ENUM if kind == "VehicleStopStatus" else kinds.TYPE_MESSAGE
            field.type, field.type_name = named, f".{package}.{kind}"
        else:
            field.type = kinds.Type.Value(f"TYPE_{kind.upper()}")

    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{package}.FeedMessage"))
