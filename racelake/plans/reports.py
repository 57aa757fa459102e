"""Report queries over the gold tables: business questions, sanity checks,
and the data sets behind the dashboards.

Every top-k sorts by its measure and then by its key, so ties give the same
rows on every run (Spark plans ``orderBy().limit(k)`` as a per-partition
top-k followed by a k-row merge; nothing is sorted globally).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from racelake.functions.bitmaps import distinct_ids, id_bitmaps
from racelake.plans.gold import Gold, event_side


def _topk(df: DataFrame, k: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(k)


# --------------------------------------------------------------------------
# Business questions (answered on the marts)
# --------------------------------------------------------------------------

def athletes_by_country(mart: DataFrame, k: int = 5) -> DataFrame:
    """Q1: countries with the most distinct athletes."""
    out = (mart.filter(F.col("country_name").isNotNull()).groupBy("country_name")
               .agg(F.count_distinct("athlete_id").alias("num_athletes")))
    return _topk(out, k, F.desc("num_athletes"), F.asc("country_name"))


def gender_share(mart: DataFrame) -> DataFrame:
    """Q2: distinct athletes per gender and their share of all, in percent
    with one decimal. The window runs over the few aggregated rows only."""
    per = (mart.filter(F.col("gender").isNotNull()).groupBy("gender")
               .agg(F.count_distinct("athlete_id").alias("num_athletes")))
    total = F.sum("num_athletes").over(Window.partitionBy())
    share = F.expr("num_athletes * 100.0") / total
    return (per.withColumn("percentage", F.round(share, 1).cast("double"))
               .orderBy(F.desc("num_athletes"), F.asc("gender")))


def events_by_year(mart: DataFrame, k: int = 10) -> DataFrame:
    """Q3: distinct event names per event year."""
    out = (mart.filter(F.col("event_year").isNotNull()).groupBy("event_year")
               .agg(F.count_distinct("event_name").alias("num_events")))
    return _topk(out, k, F.desc("num_events"), F.asc("event_year"))


def max_finishers(overview: DataFrame, k: int = 5) -> DataFrame:
    """Q4: events with the largest number of finishers."""
    out = overview.groupBy("event_name").agg(F.max("number_finishers").alias("finishers"))
    return _topk(out, k, F.desc("finishers"), F.asc("event_name"))


def speed_by_gender(mart: DataFrame) -> DataFrame:
    """Q5: average speed per gender, ignoring the 0.0 fills."""
    return (mart.filter(F.col("average_speed") > 0).groupBy("gender")
                .agg(F.round(F.avg("average_speed"), 2).alias("avg_speed")))


def popular_events(overview: DataFrame, k: int = 10) -> DataFrame:
    """Q6: events with the most distinct participants (grouped by name and
    type; the type is not shown)."""
    out = (overview.groupBy("event_name", "event_type")
                   .agg(F.count_distinct("athlete_id").alias("unique_participants")))
    return _topk(out, k, F.desc("unique_participants"), F.asc("event_name"),
                 F.asc("event_type")).select("event_name", "unique_participants")


def finisher_sum(mart: DataFrame, k: int = 10) -> DataFrame:
    """Summed finisher counts per event. The mart has one row per
    result, so the sum multiplies the count by the results — kept as the
    question defines it."""
    out = (mart.filter(F.col("event_name").isNotNull() & F.col("number_finishers").isNotNull())
               .groupBy("event_name")
               .agg(F.sum("number_finishers").alias("total_participants"),
                    F.count_distinct("event_year").alias("years_held"),
                    F.round(F.avg("number_finishers"), 0).alias("avg_participants_per_year")))
    return _topk(out, k, F.desc("total_participants"), F.asc("event_name"))


# --------------------------------------------------------------------------
# Sanity checks on the gold layer
# --------------------------------------------------------------------------

def layer_row_counts(gold: Gold) -> DataFrame:
    """Rows per gold table, one output row per table."""
    parts = [(name, df) for name, df in (
        ("fct_results", gold.fact), ("dim_event", gold.dim_event),
        ("dim_athlete", gold.dim_athlete), ("dim_date", gold.dim_date))]
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.lit(name).alias("table_name"), "num_rows")
        out = one if out is None else out.unionByName(one)
    return out


def metric_coverage(fact: DataFrame) -> DataFrame:
    """Total rows, non-NULL metric counts, zero-second results."""
    return fact.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("performance_seconds").alias("seconds_count"),
        F.count("performance_km").alias("km_count"),
        F.sum(F.when(F.col("performance_seconds") == 0, 1).otherwise(0)).alias("zero_seconds"),
    )


def min_max_by_type(fact: DataFrame, events: DataFrame) -> DataFrame:
    """Fastest / slowest time per event type (left join keeps results
    without an event)."""
    f, e = fact.alias("f"), event_side(events).alias("e")
    return (f.join(e, F.col("e.event_id") == F.col("f.event_id"), "left")
             .filter(F.col("f.performance_seconds") > 0)
             .groupBy(F.col("e.event_type").alias("event_type"))
             .agg(F.min("f.performance_seconds").alias("min_seconds"),
                  F.max("f.performance_seconds").alias("max_seconds")))


def speed_by_country(fact: DataFrame, athletes: DataFrame, k: int = 20) -> DataFrame:
    """C4: average speed per country (0.0 fills included), top k."""
    out = (fact.join(athletes, "athlete_id").groupBy("country_name")
               .agg(F.round(F.avg("average_speed"), 2).alias("avg_speed")))
    return _topk(out, k, F.desc("avg_speed"), F.asc("country_name"))


def results_by_year_type(fact: DataFrame, events: DataFrame) -> DataFrame:
    """Results per event year and type."""
    return (fact.join(event_side(events), "event_id").groupBy("event_year", "event_type")
                .agg(F.count(F.lit(1)).alias("num_results"))
                .orderBy(F.desc("event_year"), F.asc("event_type")))


def gender_by_type(fact: DataFrame, athletes: DataFrame, events: DataFrame) -> DataFrame:
    """Results per event type and gender (named athletes, counts results)."""
    return (fact.join(athletes, "athlete_id").join(event_side(events), "event_id")
                .groupBy("event_type", "gender")
                .agg(F.count(F.lit(1)).alias("num_athletes")))


def country_year_slice(fact: DataFrame, athletes: DataFrame, events: DataFrame,
                       country: str, first_year: int, last_year: int) -> DataFrame:
    """Results of one country's athletes in a range of event years.

    Written as athlete LEFT JOIN fact LEFT JOIN event; the year condition
    on the event side makes both joins inner, which Catalyst applies, so the
    country filter is pushed to dim_athlete before any shuffle."""
    a, f, e = athletes.alias("a"), fact.alias("f"), events.alias("e")
    return (a.join(f, F.col("a.athlete_id") == F.col("f.athlete_id"), "left")
             .join(e, F.col("f.event_id") == F.col("e.event_id"), "left")
             .filter((F.col("a.country_name") == country)
                     & F.col("e.event_year").between(first_year, last_year))
             .select(F.col("a.athlete_id"), F.col("f.age_category"), F.col("a.birth_year"),
                     F.col("f.club"), F.col("a.gender"), F.col("e.event_name"),
                     F.col("e.event_type"), F.col("e.event_year"), F.col("e.start_date"),
                     F.col("e.end_date"), F.col("e.distance"), F.col("f.performance_seconds"),
                     F.col("f.performance_km"), F.col("f.average_speed"))
             .orderBy("event_year", "athlete_id", "event_name", "performance_seconds",
                      "performance_km"))


def hours_by_age_category(fact: DataFrame, athletes: DataFrame, digits: int = 4) -> DataFrame:
    """Results and average hours per age category (age category is a
    fact column)."""
    f, a = fact.alias("f"), athletes.alias("a")
    return (a.join(f, F.col("a.athlete_id") == F.col("f.athlete_id"))
             .groupBy(F.col("f.age_category").alias("age_category"))
             .agg(F.count(F.lit(1)).alias("total_rows"),
                  F.round(F.avg(F.col("f.performance_seconds") / F.lit(3600.0)), digits)
                   .alias("avg_performance_hours"))
             .orderBy("age_category"))


def event_names_like(silver: DataFrame, text: str) -> DataFrame:
    """Distinct event names containing ``text``."""
    return (silver.filter(F.col("event_name").like(f"%{text}%"))
                  .select("event_name").distinct())


def event_row(events: DataFrame, event_name: str) -> DataFrame:
    """The dimension row of one event, without its hash key."""
    return events.filter(F.col("event_name") == event_name).drop("event_id")


def event_results_sample(fact: DataFrame, events: DataFrame, event_name: str,
                         n: int = 5) -> DataFrame:
    """First ``n`` results of one event (ordered so the sample is stable)."""
    f, e = fact.alias("f"), events.alias("e")
    return (f.join(e, F.col("f.event_id") == F.col("e.event_id"))
             .filter(F.col("e.event_name") == event_name)
             .select("f.athlete_id", "f.performance_seconds", "f.performance_km",
                     "f.average_speed", "f.club", "f.age_category", "e.event_name",
                     "e.event_type", "e.event_year", "e.start_date", "e.end_date",
                     "e.distance", "e.number_finishers")
             .orderBy("athlete_id", "performance_seconds", "performance_km",
                      "average_speed", "club", "age_category")
             .limit(n))


def duplicate_keys(dim: DataFrame, key: str, k: int = 10) -> DataFrame:
    """Keys that occur more than once in a dimension."""
    out = (dim.groupBy(key).agg(F.count(F.lit(1)).alias("num_rows"))
              .filter(F.col("num_rows") > 1))
    return _topk(out, k, F.asc(key))


def duplicate_results(fact: DataFrame, k: int = 10) -> DataFrame:
    """C10 on the fact: results that share an event and an athlete (their
    ``result_id`` is the same, see SURVEY 2.13), by name."""
    out = (fact.groupBy("event_name", "athlete_id").agg(F.count(F.lit(1)).alias("num_rows"))
               .filter(F.col("num_rows") > 1))
    return _topk(out, k, F.desc("num_rows"), F.asc("event_name"), F.asc("athlete_id"))


def unmatched_countries(cleaned: DataFrame, lookup: DataFrame) -> DataFrame:
    """What the lookup join drops: per country code that the lookup lacks,
    the number of results and of athletes."""
    lost = cleaned.join(lookup, "athlete_country", "left_anti")
    return id_bitmaps(lost, "athlete_id", ["athlete_country"], F.count(F.lit(1)).alias("n")).groupBy(
        "athlete_country").agg(F.sum("n").alias("num_results"), distinct_ids().alias("num_athletes"))


def distinct_clubs(fact: DataFrame) -> DataFrame:
    """C11: distinct club names."""
    return fact.select("club").distinct()


# --------------------------------------------------------------------------
# Dashboard data sets
# --------------------------------------------------------------------------

def kpis(overview: DataFrame) -> DataFrame:
    """Counts of results, athletes, events and countries. Athletes are
    counted in bitmaps and names as groups, each from a scan of its one
    column, so no row of the mart is multiplied."""
    per_name = (overview.groupBy(F.col("event_name").alias("name")).agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit("event").alias("kind"), "name", "n")
                .unionAll(overview.select("country_name").distinct().select(
                    F.lit("country"), "country_name", F.lit(0).cast("bigint"))))
    counted = per_name.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("num_results"),
        F.count_if((F.col("kind") == "event") & F.col("name").isNotNull()).alias("num_events"),
        F.count_if((F.col("kind") == "country") & F.col("name").isNotNull()).alias("num_countries"))
    athletes = id_bitmaps(overview, "athlete_id").agg(distinct_ids().alias("num_athletes"))
    return counted.join(athletes, how="cross").select("num_results", "num_athletes", "num_events", "num_countries")


def growth(overview: DataFrame) -> DataFrame:
    return (overview.groupBy("event_year").agg(F.count(F.lit(1)).alias("num_results"))
                    .orderBy("event_year"))


def gender_distribution(overview: DataFrame) -> DataFrame:
    return overview.groupBy("gender").agg(
        F.count_distinct("athlete_id").alias("num_athletes"),
        F.count(F.lit(1)).alias("num_results"))


def top_countries(overview: DataFrame, k: int = 10) -> DataFrame:
    out = overview.groupBy("country_name").agg(
        F.count_distinct("athlete_id").alias("num_athletes"),
        F.count(F.lit(1)).alias("num_results"))
    return _topk(out, k, F.desc("num_athletes"), F.asc("country_name"))


def average_by(mart: DataFrame, key: str, value, name: str, digits: int = 2) -> DataFrame:
    """Average of ``value`` per ``key`` with the sample size, so thin
    categories can be flagged."""
    return (mart.groupBy(key)
                .agg(F.round(F.avg(value), digits).alias(name),
                     F.count(F.lit(1)).alias("num_results"))
                .orderBy(key))
