"""Column-expression builders.

Everything here returns a ``Column`` made only of built-in Spark functions,
so the expressions run JVM-side inside whole-stage codegen.
"""

from racelake.functions.names import to_snake_case
from racelake.functions.race import (
    age_at_event,
    club_without_marker,
    event_end_date,
    event_start_date,
    event_type,
    is_km_performance,
    is_realistic_performance,
    normalized_age_category,
    performance_km,
    performance_seconds,
    positive_hash,
    speed_as_double,
    unit_verdict,
    year_as_int,
)

__all__ = [
    "to_snake_case",
    "age_at_event",
    "club_without_marker",
    "event_end_date",
    "event_start_date",
    "event_type",
    "is_km_performance",
    "is_realistic_performance",
    "normalized_age_category",
    "performance_km",
    "performance_seconds",
    "positive_hash",
    "speed_as_double",
    "unit_verdict",
    "year_as_int",
]
