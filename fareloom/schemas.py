"""Table contracts: the landed trips, the star schema and the imputation sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONTH_KEY = "_month_key"  # month of the file a trip came in; the raw table is stored by it
PICKUP_MONTH = "pickup_month"  # first day of the pickup month; the fact table is stored by it

def table(**columns: DataType) -> StructType:
    return StructType([StructField(name, data_type) for name, data_type in columns.items()])


INT, LONG, DOUBLE, TEXT, FLAG, MOMENT = (
    IntegerType(),
    LongType(),
    DoubleType(),
    StringType(),
    BooleanType(),
    TimestampNTZType(),
)

RAW = table(
    vendorid=LONG,
    tpep_pickup_datetime=MOMENT,
    tpep_dropoff_datetime=MOMENT,
    passenger_count=DOUBLE,
    trip_distance=DOUBLE,
    ratecodeid=DOUBLE,
    store_and_fwd_flag=TEXT,
    pulocationid=LONG,
    dolocationid=LONG,
    payment_type=LONG,
    fare_amount=DOUBLE,
    extra=DOUBLE,
    mta_tax=DOUBLE,
    tip_amount=DOUBLE,
    tolls_amount=DOUBLE,
    improvement_surcharge=DOUBLE,
    total_amount=DOUBLE,
    congestion_surcharge=DOUBLE,
    airport_fee=DOUBLE,
)

DIM_VENDOR = table(vendor_key=INT, vendor_name=TEXT)
DIM_PAYMENT_TYPE = table(payment_type_key=INT, payment_type_name=TEXT)
DIM_PICKUP_LOCATION = table(pu_location_key=INT, location_id=INT, zone=TEXT)
DIM_DROPOFF_LOCATION = table(do_location_key=INT, location_id=INT, zone=TEXT)
DIM_DATETIME = table(
    datetime_key=INT,
    datetime_hour=MOMENT,
    year=INT,
    month=INT,
    day=INT,
    hour=INT,
    weekday=TEXT,
    is_weekend=FLAG,
)
FACT_TRIPS = table(
    trip_id=LONG,
    vendor_key=INT,
    payment_type_key=INT,
    pu_location_key=INT,
    do_location_key=INT,
    datetime_key=INT,
    pickup_datetime=MOMENT,
    dropoff_datetime=MOMENT,
    passenger_count=INT,
    trip_distance=DOUBLE,
    trip_duration_min=DOUBLE,
    fare_amount=DOUBLE,
    tip_amount=DOUBLE,
    tolls_amount=DOUBLE,
    total_amount=DOUBLE,
)

# Load order: every dimension before the fact table that points at it.
DIMENSIONS = {
    "dim_vendor": DIM_VENDOR,
    "dim_payment_type": DIM_PAYMENT_TYPE,
    "dim_pickup_location": DIM_PICKUP_LOCATION,
    "dim_dropoff_location": DIM_DROPOFF_LOCATION,
    "dim_datetime": DIM_DATETIME,
}
STAR = {**DIMENSIONS, "fact_trips": FACT_TRIPS}

PRIMARY_KEYS = {
    "dim_vendor": "vendor_key",
    "dim_payment_type": "payment_type_key",
    "dim_pickup_location": "pu_location_key",
    "dim_dropoff_location": "do_location_key",
    "dim_datetime": "datetime_key",
    "fact_trips": "trip_id",
}
REQUIRED_COLUMNS = {
    "dim_vendor": ["vendor_key", "vendor_name"],
    "dim_payment_type": ["payment_type_key", "payment_type_name"],
    "dim_pickup_location": ["pu_location_key", "location_id"],
    "dim_dropoff_location": ["do_location_key", "location_id"],
    "dim_datetime": ["datetime_key"],
    "fact_trips": ["trip_id"],
}

PEOPLE = table(Age=DOUBLE, Fare=DOUBLE, Parch=INT, Pclass=INT, SibSp=INT, Survived=INT)

# Label tables and the unknown member.
UNKNOWN_KEY = -1
UNKNOWN_LABEL = "Unknown"
VENDOR_LABELS = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc",
}
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the contract's columns, in order, cast to its types."""
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields])
