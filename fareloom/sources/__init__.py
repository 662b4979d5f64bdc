from fareloom.sources.months import month_path, nan_to_null, normalise_names, read_months, with_missing_columns
from fareloom.sources.tables import lookup_trips, query_tables, read_csv, read_raw, read_star, read_trips

__all__ = [
    "lookup_trips",
    "month_path",
    "nan_to_null",
    "normalise_names",
    "query_tables",
    "read_csv",
    "read_months",
    "read_raw",
    "read_star",
    "read_trips",
    "with_missing_columns",
]
