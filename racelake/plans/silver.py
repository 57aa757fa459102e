"""Silver layer: the cleaned one-big-table of race results.

``silver_steps`` lists the cleaning chain in its fixed order; ``clean_results``
applies it. The whole chain is narrow (Project / Filter only) and runs in
the scan's tasks, as a few codegen stages split at the parse steps' row
count observations (see ``operators.parse``); the only exchange is the
lookup join, a broadcast when the lookup is proven small. Nothing shuffles
the results themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from racelake.operators import clean, enrich, parse, shape
from racelake.operators.joins import join_lookup

# The columns whose NULL makes a result useless (dropped after
# the speed step), and those where NULL means "not known" (kept as Unknown).
REQUIRED_COLUMNS = [
    "athlete_performance", "athlete_id", "athlete_gender",
    "athlete_age_category", "event_distance/length", "event_start_date",
    "athlete_year_of_birth",
]
UNKNOWN_FILLED = ["athlete_club", "athlete_country"]
LOOKUP_KEY = "athlete_country"


def combine_feeds(main_raw: DataFrame, *others_raw: DataFrame) -> DataFrame:
    """Snake-case every feed and union them by column name."""
    out = shape.rename_to_snake_case(main_raw)
    for other in others_raw:
        out = shape.union_by_name(out, shape.rename_to_snake_case(other))
    return out


# (name, step) in chain order. Names are the query keys of the waterfall.
Step = tuple[str, Callable[[DataFrame], DataFrame]]

silver_steps: list[Step] = [
    ("filter_fill_unknown", lambda df: clean.fill_unknown(df, UNKNOWN_FILLED)),
    ("clean_validate_units", clean.validate_performance_units),
    ("parse_event_type", parse.parse_event_type),
    ("parse_event_dates", parse.parse_event_dates),
    ("parse_performance", parse.parse_performance),
    ("clean_realistic_performance", clean.filter_realistic_performance),
    ("clean_speed", clean.filter_athlete_speed),
    ("filter_drop_nulls", lambda df: clean.drop_null_rows(df, REQUIRED_COLUMNS)),
    ("filter_any_not_null",
     lambda df: clean.require_any_not_null(df, ["performance_seconds", "performance_km"])),
    ("clean_age", clean.filter_athlete_age),
    ("enrich_age_category", enrich.normalize_age_category),
    ("enrich_surrogate_keys", enrich.generate_ids),
    ("enrich_club_names", enrich.clean_club_names),
]
STEP_NAMES = [n for n, _ in silver_steps]


def _counted(df: DataFrame, name: str, observations: dict | None) -> DataFrame:
    if observations is None:
        return df
    obs = Observation(f"rows_after_{name}_{uuid.uuid4().hex[:8]}")
    observations[name] = obs
    return df.observe(obs, F.count(F.lit(1)).alias("rows"))


def clean_until(df: DataFrame, last_step: str | None = None,
                observations: dict | None = None) -> DataFrame:
    """Apply the cleaning chain up to and including ``last_step`` (all
    steps when None).

    With an ``observations`` dict, each step's output row count is observed
    under the step name (``observations[name].get["rows"]`` after an action):
    the whole cleaning waterfall from the one pass that writes silver, instead
    of one counting job per step."""
    if last_step is not None and last_step not in STEP_NAMES:
        raise KeyError(last_step)
    for name, step in silver_steps:
        df = _counted(df.transform(step), name, observations)
        if name == last_step:
            break
    return df


def clean_results(combined: DataFrame, lookup: DataFrame,
                  observations: dict | None = None) -> DataFrame:
    """The full silver table: cleaning chain, then the inner lookup join
    (rows whose country is not in the lookup are dropped)."""
    out = attach_lookup(clean_until(combined, observations=observations), lookup)
    return _counted(out, "join_country_lookup", observations)


def attach_lookup(cleaned: DataFrame, lookup: DataFrame) -> DataFrame:
    """Cleaned rows with their country's name; rows of no known country go."""
    return join_lookup(cleaned, lookup, on=LOOKUP_KEY, how="inner")
