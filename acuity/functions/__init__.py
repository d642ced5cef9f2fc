from acuity.functions.expressions import (
    DOSE,
    after_exclusions,
    billionths,
    case,
    exact_number,
    exact_quotient,
    like_any,
    one_of,
    points,
    strict_or_lenient_number,
)
from acuity.functions.timeline import hour_of, minute_key

__all__ = [
    "DOSE",
    "after_exclusions",
    "billionths",
    "case",
    "exact_number",
    "exact_quotient",
    "hour_of",
    "like_any",
    "minute_key",
    "one_of",
    "points",
    "strict_or_lenient_number",
]
