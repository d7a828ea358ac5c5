"""Declared schemas of the venue entities (JSON-lines layout). No inference pass is needed.

Types follow the data: identifiers and text stamps are strings, counters are bigint, ratings
double, the venue attributes an open map of texts (the price tier is one of its members).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D = T.StringType(), T.LongType(), T.DoubleType()


# Every field name below is a key of the venue data's JSON records (and of the
# relational targets' columns); they must match the data as written.


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The opening-hours members of a venue record.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

BUSINESS_RAW = _struct(
    ("business_id", S),
    ("name", S),
    ("address", S),
    ("city", S),
    ("state", S),
    ("postal_code", S),
    ("latitude", D),
    ("longitude", D),
    ("stars", D),
    ("review_count", L),
    ("is_open", L),
    ("attributes", T.MapType(S, S, True)),
    ("categories", S),
    ("hours", _struct(*[(d, S) for d in WEEKDAYS])),
)

REVIEW = _struct(
    ("review_id", S),
    ("user_id", S),
    ("business_id", S),
    ("stars", D),
    ("useful", L),
    ("funny", L),
    ("cool", L),
    ("text", S),
    ("date", S),
)

USER_RAW = _struct(
    ("user_id", S),
    ("name", S),
    ("review_count", L),
    ("yelping_since", S),
    ("useful", L),
    ("funny", L),
    ("cool", L),
    ("elite", S),
    ("friends", S),
    ("fans", L),
    ("average_stars", D),
)

CHECKIN = _struct(("business_id", S), ("date", S))

TIP = _struct(("user_id", S), ("business_id", S), ("text", S), ("date", S), ("compliment_count", L))

# Column of the curated layers that holds a record's fields beyond the declared ones.
CARRIED = "other_fields"

# Columns dropped by the curation's trimming step.
USER_DROP = ("friends",)
USER_DROP_PREFIX = "compliment_"
BUSINESS_DROP = ("address", "postal_code", "latitude", "longitude")

# Columns of the relational targets (absent fields load as NULL).
USER_TARGET = _struct(
    ("user_id", S),
    ("name", S),
    ("review_count", L),
    ("yelping_since", S),
    ("useful", L),
    ("funny", L),
    ("cool", L),
    ("elite", S),
    ("fans", L),
    ("average_stars", D),
)
REVIEW_TARGET = REVIEW

ENTITY_SCHEMAS = {
    "business": BUSINESS_RAW,
    "review": REVIEW,
    "user": USER_RAW,
    "checkin": CHECKIN,
    "tip": TIP,
}
