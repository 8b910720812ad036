"""Hand-made feed messages."""


def feed(feed_message, entities=(), timestamp=1763494684):
    message = feed_message()
    message.header.gtfs_realtime_version = "2.0"
    if timestamp is not None:
        message.header.timestamp = timestamp
    for fill in entities:
        fill(message.entity.add())
    return message.SerializePartialToString()


def full_vehicle(entity):
    """The sample record of the public guide, and more."""
    entity.id = "000003"
    vehicle = entity.vehicle
    vehicle.trip.trip_id, vehicle.trip.route_id = "081750_1..N03R", "1"
    vehicle.vehicle.id = "V1"
    vehicle.position.latitude, vehicle.position.longitude = 40.7589, -73.9851
    vehicle.timestamp, vehicle.current_stop_sequence = 1763494684, 38
    vehicle.current_status, vehicle.stop_id = 1, "127N"


def bare_vehicle(entity):
    entity.id = "bare"
    entity.vehicle.SetInParent()


def hollow_vehicle(entity):
    """All parents present, no leaf set."""
    entity.id = "hollow"
    for name in ("trip", "vehicle", "position"):
        getattr(entity.vehicle, name).SetInParent()


def trip(entity):
    entity.id = "trip"
    update = entity.trip_update
    update.trip.trip_id, update.trip.route_id, update.timestamp = "092000_A..S02R", "A", 5
    first = update.stop_time_update.add(stop_sequence=1, stop_id="A01S")
    first.arrival.time, first.arrival.delay = 100, -3
    second = update.stop_time_update.add()
    second.departure.SetInParent()


def trip_without_stops(entity):
    entity.id = "empty"
    entity.trip_update.trip.SetInParent()


def neither(entity):
    entity.id = "neither"
