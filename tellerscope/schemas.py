"""Explicit schemas of every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """Schema from "name type, ..." without needing a session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Landing files carry text only; types are set when silver is built.
BRONZE = _struct(
    "id string, step string, type string, amount string, customer_id string, "
    "nameOrig string, nameDest string, countryOrig string, countryDest string, "
    "oldBalanceOrig string, newBalanceOrig string, oldBalanceDest string, newBalanceDest string"
)

FRAUD_REPORTS = _struct("id string, is_fraud int")

CUSTOMERS = _struct("id string, firstname string, lastname string, email string, country string")

COUNTRIES = _struct(
    "country string, alpha2_code string, alpha3_code string, numeric_code int, "
    "lat_avg double, long_avg double"
)

# The message id is text on the wire in some producers and a number in others; text
# takes both. ``parse_messages`` turns it into the number the table is keyed by.
RAW_MESSAGE = _struct(
    "id string, timestamp string, type string, amount double, customer_id int, "
    "firstname string, lastname string, country_orig string, country_dest string, "
    "old_balance_orig double, new_balance_orig double, "
    "old_balance_dest double, new_balance_dest double, diff_orig double, diff_dest double"
)

SCORED = _struct(
    "id bigint, timestamp timestamp, type string, amount double, customer_id int, "
    "firstname string, lastname string, country_orig string, country_dest string, "
    "old_balance_orig double, new_balance_orig double, "
    "old_balance_dest double, new_balance_dest double, "
    "fraud_prediction boolean, fraud_probability double, scored_at timestamp"
)
