"""Fixed values of the domain: results depend on them, so they are stated plainly."""

from __future__ import annotations

# --- fixed values: city box and zone grid -----------------------------------
CITY = "Casablanca"
LAT_MIN, LAT_MAX = 33.47, 33.63
LON_MIN, LON_MAX = -7.73, -7.51
GRID_SIDE = 4
N_ZONES = GRID_SIDE * GRID_SIDE
BBOX_MARGIN_DEG = 0.01

# --- fixed values: GPS cleaning ---------------------------------------------
MAX_SPEED_KMH = 70.0
MIN_REALISTIC_SPEED_KMH = 20.0
MOVING_ABOVE_KMH = 2.0
GPS_INTERVAL_SECONDS = 15
EARTH_RADIUS_KM = 6371.0

# --- fixed values: event time -----------------------------------------------
LATENESS_MS = 180_000  # bounded out-of-orderness, 3 minutes
DEMAND_WINDOW = "30 seconds"

# --- fixed values: trips, fares, requests -----------------------------------
AVG_SPEED_KMH = 25.0
MIN_TRIP_MINUTES = 2.0
ZERO_DISTANCE_MINUTES = 5.0
MAX_TRIP_MINUTES = 60.0
BASE_FARE = 2.50
PRICE_PER_KM = 3.20
FARE_JITTER = (0.90, 1.10)
REQUEST_INTERVAL_SECONDS = 30.0
MIN_REQUEST_DELAY_SECONDS = 0.05
MAX_TRIPS_PER_CYCLE = 500

# --- fixed values: demand multiplier by hour of day, index 0 = midnight ------
DEMAND_CURVE = [
    0.2, 0.15, 0.1, 0.1, 0.15, 0.3, 0.7, 1.5, 2.5, 1.8, 1.0, 0.8,
    0.7, 0.6, 0.7, 0.9, 1.2, 2.0, 2.8, 2.0, 1.3, 1.0, 0.7, 0.4,
]
FRIDAY_LUNCH_REDUCTION = 0.5
FRIDAY_LUNCH_HOURS = (12, 14)  # start inclusive, end exclusive

# --- fixed values: demand features ------------------------------------------
SLOT_SECONDS = 1800
SLOTS_PER_DAY = 48
SLOTS_PER_WEEK = 336
TRAIN_MONTHS = 10
FEATURE_COLUMNS = [
    "hour", "day_of_week", "is_weekend", "is_friday",
    "demand_lag_1d", "demand_lag_7d", "rolling_7d_mean",
]
GBT_PARAMS = {"maxDepth": 5, "maxIter": 50, "stepSize": 0.1, "seed": 42}

# --- fixed values: demand spikes and blackouts --------------------------------
SPIKE_FACTOR = 3.0
BLACKOUT_ALERT_SECONDS = 120

# --- fixed values: representative points of the named zones (lat, lon) --------
ZONE_POINTS = {
    1: (33.5893, -7.6114),
    2: (33.5731, -7.5898),
    3: (33.5950, -7.6311),
    4: (33.5800, -7.6200),
    5: (33.6050, -7.5500),
    6: (33.5480, -7.6830),
    7: (33.5200, -7.6100),
    8: (33.6150, -7.5750),
    9: (33.5650, -7.6550),
    10: (33.5900, -7.6600),
}
DEFAULT_ZONE_POINT = (33.5731, -7.5898)

# --- fixed values: GeoJSON property names, in order of preference --------------
NAME_KEYS = ["Arrondissement", "arrondissement", "ARRONDISSEMENT", "name", "Name", "NOM", "nom"]
ID_KEYS = ["zone_id", "ZONE_ID", "Zone_ID", "zone", "ZONE", "id_zone", "ID_ZONE", "id", "ID"]
PREFECTURE_KEYS = ["Prefecture", "PREFECTURE", "prefecture"]
POPULATION_KEYS = ["Population", "POPULATION", "population"]
IGNORED_ZONE_NAMES = ["mechouar casablanca"]
ZONE_NAME_PREFIXES = [
    "arrondissement d'",
    "arrondissement de ",
    "arrondissement des ",
    "arrondissement du ",
    "arrondissement ",
]

# --- fixed values: labels of vehicle states ------------------------------------
STATUS_LABELS = {
    "moving": "🚕 MOVING",
    "idle": "🅿️  IDLE",
    "blackout_recovered": "⚠️  BLACKOUT RECOVERED",
    "blackout": "🔴 BLACKOUT",
}

# --- fixed values: days in report order ------------------------------------------
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
