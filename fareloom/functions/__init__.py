from fareloom.functions.exprs import (
    elapsed_micros,
    hour_floor,
    moment,
    non_negative_or_null,
    round_cents,
    rounded_int,
    truncated_int,
)

__all__ = ["elapsed_micros", "hour_floor", "moment", "non_negative_or_null", "round_cents", "rounded_int", "truncated_int"]
