from fareloom.operators.cleaning import POLICIES, CleaningPolicy, clean_trips, rejected_trips
from fareloom.operators.keys import dense_key, natural_key, number_hours
from fareloom.operators.lookups import code_dimension, datetime_dimension, distinct_codes, distinct_hours, location_dimension
from fareloom.operators.medians import impute_upper_median, upper_medians
from fareloom.operators.quality import (
    expectations,
    fk_orphans,
    key_violations,
    member_checks,
    null_violations,
    star_checks,
    table_counts,
)

__all__ = [
    "POLICIES",
    "CleaningPolicy",
    "clean_trips",
    "code_dimension",
    "datetime_dimension",
    "dense_key",
    "distinct_codes",
    "distinct_hours",
    "expectations",
    "fk_orphans",
    "impute_upper_median",
    "key_violations",
    "location_dimension",
    "member_checks",
    "natural_key",
    "null_violations",
    "number_hours",
    "rejected_trips",
    "star_checks",
    "table_counts",
    "upper_medians",
]
