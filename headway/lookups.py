"""Values fixed by the feeds and by the outputs that users already read."""

# Route identifiers and their display names.
ROUTE_NAMES = {
    "1": "1 Train",
    "2": "2 Train",
    "3": "3 Train",
    "4": "4 Train",
    "5": "5 Train",
    "6": "6 Train",
    "7": "7 Train",
    "A": "A Train",
    "B": "B Train",
    "C": "C Train",
    "D": "D Train",
    "E": "E Train",
    "F": "F Train",
    "G": "G Train",
    "J": "J Train",
    "L": "L Train",
    "M": "M Train",
    "N": "N Train",
    "Q": "Q Train",
    "R": "R Train",
    "W": "W Train",
    "Z": "Z Train",
    "GS": "S Train (Franklin Avenue Shuttle)",
    "FS": "S Train (Rockaway Park Shuttle)",
    "H": "S Train (Rockaway Park Shuttle - alternate)",
    "SI": "SIR (Staten Island Railway)",
}

# Direction letters inside a trip id.
DIRECTION_NAMES = {
    "N": "Northbound",
    "S": "Southbound",
    "E": "Eastbound",
    "W": "Westbound",
}

# Error texts of the trip-id parse.
BAD_TRIP_ID = "Invalid trip ID format"
BAD_ROUTE_DIRECTION = "Invalid route/direction format"

# Feed kinds.  Alerts are a known kind that nothing parses.
VEHICLE_POSITIONS = "vehicle_positions"
TRIP_UPDATES = "trip_updates"
ALERTS = "alerts"

# Limits.
FIRST_VEHICLES = 50
LATEST_FILES = 20
POLL_SECONDS_MIN, POLL_SECONDS_DEFAULT, POLL_SECONDS_MAX = 10, 20, 30

# How often a fetch is tried, and the wait after its first failure.
MAX_ATTEMPTS = 3
FIRST_WAIT_SECONDS = 5
