"""The five dimensions of the star schema, each from a one-column scan of the landed trips."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fareloom.operators.lookups import code_dimension, datetime_dimension, location_dimension
from fareloom.schemas import DIMENSIONS, PAYMENT_LABELS, VENDOR_LABELS


def build_dim(raw: DataFrame, name: str) -> DataFrame:
    match name:
        case "dim_vendor":
            return code_dimension(raw, "vendorid", "vendor_key", "vendor_name", VENDOR_LABELS, "Vendor")
        case "dim_payment_type":
            return code_dimension(raw, "payment_type", "payment_type_key", "payment_type_name", PAYMENT_LABELS, "Type")
        case "dim_pickup_location":
            return location_dimension(raw, "pulocationid", "pu_location_key")
        case "dim_dropoff_location":
            return location_dimension(raw, "dolocationid", "do_location_key")
        case "dim_datetime":
            return datetime_dimension(raw, "tpep_pickup_datetime")
    raise KeyError(name)


def build_dims(raw: DataFrame) -> dict[str, DataFrame]:
    return {name: build_dim(raw, name) for name in DIMENSIONS}
