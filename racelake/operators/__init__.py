"""DataFrame -> DataFrame operators.

Each operator is a plain function usable with ``DataFrame.transform``. Column
names are parameters whose defaults are the race-results feed's names.
"""

from racelake.operators.shape import (
    rename_to_snake_case,
    select_by_type,
    union_by_name,
)
from racelake.operators.clean import (
    drop_null_rows,
    fill_unknown,
    filter_athlete_age,
    filter_athlete_speed,
    filter_realistic_performance,
    require_any_not_null,
    unit_validity_audit,
    validate_performance_units,
)
from racelake.operators.parse import (
    parse_event_dates,
    parse_event_type,
    parse_performance,
)
from racelake.operators.enrich import (
    clean_club_names,
    generate_ids,
    normalize_age_category,
)
from racelake.operators.joins import join_lookup, semi_join_on_group_count

__all__ = [
    "rename_to_snake_case", "select_by_type", "union_by_name",
    "drop_null_rows", "fill_unknown", "filter_athlete_age",
    "filter_athlete_speed", "filter_realistic_performance",
    "require_any_not_null", "unit_validity_audit", "validate_performance_units",
    "parse_event_dates", "parse_event_type", "parse_performance",
    "clean_club_names", "generate_ids", "normalize_age_category",
    "join_lookup", "semi_join_on_group_count",
]
