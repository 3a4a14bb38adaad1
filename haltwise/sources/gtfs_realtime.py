"""The parts of the public GTFS-Realtime message definition that are read here.

Built at run time for the protobuf runtime, so no generated module is needed.
Enumerations are read as plain numbers.
"""

from __future__ import annotations

from functools import lru_cache

try:
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
except ImportError:  # the decoder says so when it is used
    descriptor_pb2 = None

# message: {field name: (number, type, repeated)}; fixed values of the specification
MESSAGES = {
    "TripDescriptor": {
        "trip_id": (1, "string"),
        "start_time": (2, "string"),
        "start_date": (3, "string"),
        "schedule_relationship": (4, "int32"),
        "route_id": (5, "string"),
        "direction_id": (6, "uint32"),
    },
    "VehicleDescriptor": {
        "id": (1, "string"),
        "label": (2, "string"),
        "license_plate": (3, "string"),
    },
    "StopTimeEvent": {
        "delay": (1, "int32"),
        "time": (2, "int64"),
        "uncertainty": (3, "int32"),
    },
    "StopTimeUpdate": {
        "stop_sequence": (1, "uint32"),
        "arrival": (2, "StopTimeEvent"),
        "departure": (3, "StopTimeEvent"),
        "stop_id": (4, "string"),
        "schedule_relationship": (5, "int32"),
    },
    "TripUpdate": {
        "trip": (1, "TripDescriptor"),
        "stop_time_update": (2, "StopTimeUpdate", True),
        "vehicle": (3, "VehicleDescriptor"),
        "timestamp": (4, "uint64"),
    },
    "Position": {
        "latitude": (1, "float"),
        "longitude": (2, "float"),
        "bearing": (3, "float"),
        "odometer": (4, "double"),
        "speed": (5, "float"),
    },
    "VehiclePosition": {
        "trip": (1, "TripDescriptor"),
        "position": (2, "Position"),
        "timestamp": (5, "uint64"),
        "stop_id": (7, "string"),
        "vehicle": (8, "VehicleDescriptor"),
    },
    "EntitySelector": {
        "agency_id": (1, "string"),
        "route_id": (2, "string"),
        "trip": (4, "TripDescriptor"),
        "stop_id": (5, "string"),
    },
    "Translation": {"text": (1, "string"), "language": (2, "string")},
    "TranslatedString": {"translation": (1, "Translation", True)},
    "Alert": {
        "informed_entity": (5, "EntitySelector", True),
        "cause": (6, "int32"),
        "effect": (7, "int32"),
        "header_text": (10, "TranslatedString"),
        "description_text": (11, "TranslatedString"),
    },
    "FeedHeader": {
        "gtfs_realtime_version": (1, "string"),
        "timestamp": (3, "uint64"),
    },
    "FeedEntity": {
        "id": (1, "string"),
        "is_deleted": (2, "bool"),
        "trip_update": (3, "TripUpdate"),
        "vehicle": (4, "VehiclePosition"),
        "alert": (5, "Alert"),
    },
    "FeedMessage": {"header": (1, "FeedHeader"), "entity": (2, "FeedEntity", True)},
}


@lru_cache(maxsize=1)
def feed_message_class():
    """Message class of a whole feed."""
    if descriptor_pb2 is None:
        raise RuntimeError("decoding feeds needs the protobuf Python runtime on the executors")
    package = "transit_realtime"
    f = descriptor_pb2.FileDescriptorProto(
        name="transit_realtime.proto", package=package, syntax="proto2"
    )
    kinds = descriptor_pb2.FieldDescriptorProto
    for name, fields in MESSAGES.items():
        message = f.message_type.add(name=name)
        for field, (number, kind, *repeated) in fields.items():
            d = message.field.add(name=field, number=number)
            d.label = kinds.LABEL_REPEATED if repeated else kinds.LABEL_OPTIONAL
            if kind in MESSAGES:
                d.type, d.type_name = kinds.TYPE_MESSAGE, f".{package}.{kind}"
            else:
                d.type = getattr(kinds, f"TYPE_{kind.upper()}")
    pool = descriptor_pool.DescriptorPool()
    pool.Add(f)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{package}.FeedMessage"))
