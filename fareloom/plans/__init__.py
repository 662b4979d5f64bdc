from fareloom.plans.audits import month_audit, reject_reasons
from fareloom.plans.dimensions import build_dim, build_dims
from fareloom.plans.fact import build_fact, earliest_trips, trip_measures
from fareloom.plans.reports import average_by_payment, spelled_out, trip_detail
from fareloom.plans.warehouse import land_raw, refresh_star

__all__ = [
    "average_by_payment",
    "build_dim",
    "build_dims",
    "build_fact",
    "earliest_trips",
    "land_raw",
    "month_audit",
    "refresh_star",
    "reject_reasons",
    "spelled_out",
    "trip_detail",
    "trip_measures",
]
