"""Schemas and fixed values shared by batch, streaming and tests."""

from __future__ import annotations

from pyspark.sql import types as T

# Labelled ride history (CSV with header). Read with an explicit schema so no
# inference pass over the data is needed.
RIDES = T.StructType(
    [
        T.StructField("ride_id", T.LongType()),
        T.StructField("time_stamp", T.LongType()),  # epoch milliseconds
        T.StructField("cab_type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("distance", T.DoubleType()),
        T.StructField("surge_multiplier", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
    ]
)

# ---------------------------------------------------------------------------
# Fixed values. These must equal the original application's values for the
# results to agree; they are stated as given, in their original order.
# ---------------------------------------------------------------------------

# A ride request: the message contract of the scoring stream, the request CSV
# and the in-memory quote record.
REQUEST = T.StructType(
    [
        T.StructField("cab_type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("distance", T.DoubleType()),
        T.StructField("surge_multiplier", T.DoubleType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

# Directed route -> distance lookup.
DISTANCE_MAP = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("destination", T.StringType(), False),
        T.StructField("max_distance", T.DoubleType(), False),
    ]
)

SOURCE_LOCATIONS = [
    "Back Bay", "Beacon Hill", "Boston University", "Fenway",
    "Haymarket Square", "North End", "North Station",
    "South Station", "Theatre District", "West End",
]

DESTINATION_LOCATIONS = [
    "Beacon Hill", "Back Bay", "Fenway", "Haymarket Square",
    "North End", "North Station", "Northeastern University",
    "South Station", "Theatre District", "West End",
]

# Provider -> the five services offered by it.
SERVICES = {
    "Uber": ["UberX", "UberXL", "UberPool", "Black", "Black SUV"],
    "Lyft": ["Lyft", "Lyft XL", "Lux", "Lux Black", "Shared"],
}

# Day number (1 = Sunday) -> short name.
DAY_NAMES = {1: "Sun", 2: "Mon", 3: "Tue", 4: "Wed", 5: "Thu", 6: "Fri", 7: "Sat"}

# Fare scenarios: name -> multiplier applied to the linear tariff.
SCENARIOS = [
    ("Early Morning (3 AM)", 0.8),
    ("Morning Rush (8 AM)", 1.8),
    ("Midday (12 PM)", 1.0),
    ("Afternoon (3 PM)", 1.1),
    ("Evening Rush (6 PM)", 2.0),
    ("Night (10 PM)", 1.3),
    ("Weekend Morning", 0.9),
    ("Weekend Night", 1.7),
]

# Tariff inputs: default distance (miles), rate ($/mile) and fee ($).
DEFAULT_TARIFF_DISTANCE = 10.0
DEFAULT_BASE_RATE = 2.5
DEFAULT_BASE_FEE = 5.0

# Model features, in assembly order: one-hot blocks first, then numerics.
CATEGORICAL_FEATURES = [
    "cab_type", "name", "source", "destination", "time_of_day", "distance_category",
]
NUMERIC_FEATURES = [
    "distance", "surge_multiplier", "hour", "day_of_week", "month", "is_weekend", "is_surge",
]

# Elastic-net regression settings.
LR_MAX_ITER = 100
LR_REG_PARAM = 0.1
LR_ELASTIC_NET_PARAM = 0.5

# Message topic of the request stream.
REQUEST_TOPIC = "cab_price_features"

# Fraction (in percent of the hash space) kept for training, and for the
# dashboard's distance/price sample; the sample's hash is salted so that it is
# drawn from training and test rows alike.
TRAIN_PERCENT = 80
SAMPLE_PERCENT = 10
SPLIT_SEED = 42
SAMPLE_SALT = "sample "
