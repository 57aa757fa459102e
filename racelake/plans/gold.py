"""Gold layer: fact, dimensions and marts of the star schema.

Scale notes (the fact is the only table that grows with every result):

* Dimensions are keyed aggregates over silver. ``groupBy`` runs a partial
  aggregate before the shuffle, so a hot key (an athlete or event holding a
  third of all rows) costs one row per map task, not one per result.
* ``dim_athlete`` grows with the athletes and is never broadcast. Marts
  should join written fact / dimension tables (``Gold(persist=...)``):
  both sides are then plain shuffles, which AQE's skew join can split when
  one athlete or event holds a large share of the results.
* ``dim_event`` and ``dim_date`` are small in practice but have no proven
  bound, so no broadcast hint is given. Joins with results hash the events
  (``event_side``); dates AQE broadcasts from the measured shuffle size, or
  keeps a sort-merge join when they are big.
* The "countries with enough athletes" subquery is a semi join on an
  aggregate with one row per country.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Fixed value: a country enters the distance / time marts when it has at
# least this many athletes in dim_athlete.
MIN_ATHLETES_PER_COUNTRY = 100


# Silver columns of what the fact and the dimensions say beside their keys.
FACT_FROM = {"performance_seconds": "performance_seconds", "performance_km": "performance_km",
             "average_speed": "athlete_average_speed", "club": "athlete_club", "age_category": "athlete_age_category"}
ATHLETE_FROM = {"country_code": "athlete_country", "country_name": "country_name",
                "birth_year": "athlete_year_of_birth", "gender": "athlete_gender"}
EVENT_FROM = {"event_name": "event_name", "event_type": "event_type", "event_year": "year_of_event",
              "start_date": "event_start_date", "end_date": "event_end_date", "distance": "event_distance/length",
              "number_finishers": "event_number_of_finishers"}


def fct_results(silver: DataFrame, natural_keys: bool = False) -> DataFrame:
    """One row per result. With ``natural_keys`` the hash ids are replaced by
    the names they are computed from (event_name; result = event_name +
    athlete_id), which is how results are compared with other engines. Of a
    silver with fewer columns (``silver_for``) it has those that are there."""
    keys = ([F.col("event_name"), F.col("athlete_id")] if natural_keys
            else [F.col(c) for c in ("result_id", "event_id", "athlete_id") if c in silver.columns])
    return silver.select(*keys, *[F.col(c).alias(name) for name, c in FACT_FROM.items() if c in silver.columns])


def _least(silver: DataFrame, key: str, attributes: dict[str, str], merged: dict) -> DataFrame:
    """One row per key: of each attribute (name: silver column) its MIN, or
    the function that ``merged`` names for it.

    Spark cannot hash-aggregate MIN over strings (its buffer is not
    fixed-width) and would sort every result row by the key instead. So the
    string attributes are first grouping keys of a hash aggregate (one row
    per key and attribute variant, map-side combined), and the string
    MINs then run over that dimension-sized remainder. MIN of MINs is the
    MIN, so the result is the same."""
    here = {name: f"`{c}`" for name, c in attributes.items() if c in silver.columns}
    texts = [F.col(c).alias(name) for name, c in here.items() if name not in merged]
    numbers = [merged[name](c).alias(name) for name, c in here.items() if name in merged]
    keyed = silver.groupBy(key, *texts)
    variants = keyed.agg(*numbers) if numbers else silver.select(key, *texts).distinct()
    return variants.groupBy(key).agg(*[merged.get(name, F.min)(name).alias(name) for name in here])


def dim_athlete(silver: DataFrame) -> DataFrame:
    """One row per athlete; every attribute is its own MIN, so values may
    come from different rows of a person (aggregated in two steps, see
    ``_least``)."""
    return _least(silver, "athlete_id", ATHLETE_FROM, {"birth_year": F.min})


def dim_event(silver: DataFrame, natural_keys: bool = False) -> DataFrame:
    """One row per event id (= per event name, all editions together): the
    first year and dates, the largest number of finishers. Aggregated in two
    steps for the same reason as ``dim_athlete``."""
    out = _least(silver, "event_id", EVENT_FROM, {"event_year": F.min, "start_date": F.min, "end_date": F.min,
                                                  "number_finishers": F.max})
    return out.drop("event_id") if natural_keys else out


def dim_date(silver: DataFrame) -> DataFrame:
    """Every distinct start date with its calendar parts. The distinct runs
    on the date alone (a partial aggregate); the parts are derived after."""
    d = F.col("date")
    return (silver.select(F.col("event_start_date").alias("date"))
                  .filter(d.isNotNull()).distinct()
                  .select(d,
                          F.year(d).alias("year"),
                          F.month(d).alias("month"),
                          F.dayofmonth(d).alias("day"),
                          F.quarter(d).alias("quarter"),
                          F.dayofweek(d).alias("day_of_week"),
                          F.date_format(d, "MMMM").alias("month_name"),
                          F.date_format(d, "EEEE").alias("day_name")))


def star_results(fact: DataFrame, events: DataFrame, athletes: DataFrame) -> DataFrame:
    """Every result with the event and athlete attributes the marts use.

    The three marts share this join; when it is materialized once (see
    ``Gold``), the fact is shuffled for the athlete join once instead of once
    per mart, and each mart is a filter (``country_athletes`` counts the
    athletes of the row's country) or a join with the small date dimension."""
    return with_athletes(with_events(fact, events), with_country_athletes(athletes))


def with_events(fact: DataFrame, events: DataFrame) -> DataFrame:
    """The fact's columns the marts use, with those of its event."""
    f, e = fact.alias("f"), event_side(events).alias("e")
    return f.join(e, F.col("f.event_id") == F.col("e.event_id")).select(
        *_there(fact, "f", RESULT_COLUMNS), *_there(events, "e", EVENT_COLUMNS))


# What the marts use of a result and its event.
RESULT_COLUMNS = ["result_id", "athlete_id", "performance_seconds", "performance_km", "average_speed", "age_category"]
EVENT_COLUMNS = ["event_name", "event_type", "distance", "start_date", "end_date", "event_year", "number_finishers"]


def _there(df: DataFrame, alias: str | None, columns: list[str]) -> list[str]:
    """Those of the columns that ``df`` has, under its alias."""
    return [f"{alias}.{c}" if alias else c for c in columns if c in df.columns]


def event_side(events: DataFrame) -> DataFrame:
    """The event dimension as the hashed side of a join with the results.

    One event can hold a third of all results. Sorted, they would be held by
    one task as long as their compressed size is too small for AQE to split
    them; hashed, a task holds its part of the dimension and results stream
    past it."""
    return events.hint("shuffle_hash")


def with_country_athletes(athletes: DataFrame) -> DataFrame:
    """The dimension with the number of athletes of each row's country:
    counted and attached here, so that the fact never moves by country."""
    per_country = athletes.groupBy("country_name").agg(F.count(F.lit(1)).alias("country_athletes"))
    return athletes.join(per_country, "country_name", "left")


def with_athletes(results: DataFrame, athletes: DataFrame) -> DataFrame:
    """``with_events`` rows with the attributes of their athlete."""
    r, a = results.alias("r"), athletes.alias("a")
    return r.join(a, F.col("r.athlete_id") == F.col("a.athlete_id")).select(
        *_there(results, "r", [c for c in RESULT_COLUMNS if c != "athlete_id"] + EVENT_COLUMNS),
        *_there(athletes, "a", ["athlete_id", "gender", "country_name", "country_athletes", "birth_year"]))


def _key(natural_keys: bool) -> list:
    return [] if natural_keys else ["result_id"]


# What a mart of a kind joins and filters by, whatever is read of it.
MART_NEEDS = {"distance": ["event_type", "country_name"], "time": ["event_type", "country_name"],
              "overview": ["start_date", "country_name"]}
MADE_FROM = {"performance_hours": "performance_seconds"}  # of a mart's columns that are no silver column


def silver_for(silver: DataFrame, kind: str, reads: list[str]) -> DataFrame:
    """The columns of silver that the mart of a kind is made from, for a
    report that reads ``reads`` of it: the keys, what the mart is joined and
    filtered by, and what is read. Rows are silver's."""
    sources = FACT_FROM | ATHLETE_FROM | EVENT_FROM
    wanted = ["athlete_id", "event_id"]
    for name in [*MART_NEEDS[kind], *reads]:
        wanted.append(sources.get(MADE_FROM.get(name, name), name))
    return silver.select(*[F.col(f"`{c}`") for c in silver.columns if c in wanted])


def mart_distance_events(fact: DataFrame, events: DataFrame, athletes: DataFrame,
                         min_athletes: int = MIN_ATHLETES_PER_COUNTRY,
                         natural_keys: bool = False, star: DataFrame | None = None) -> DataFrame:
    """Distance results with event and athlete attributes, for countries
    with at least ``min_athletes`` athletes. ``star`` is a materialized
    ``star_results`` to reuse (built from the tables when None)."""
    s = star if star is not None else star_results(fact, events, athletes)
    s = s.filter((F.col("event_type") == "distance") & (F.col("country_athletes") >= min_athletes))
    if "performance_seconds" in s.columns:
        s = s.withColumn("performance_hours", F.col("performance_seconds") / F.lit(3600.0))
    return s.select(*_there(s, None, [
        *_key(natural_keys), "performance_seconds", "performance_hours",
        "average_speed", "age_category", "event_name", "distance", "start_date", "end_date",
        "event_year", "number_finishers", "athlete_id", "gender", "country_name", "birth_year"]))


def mart_time_events(fact: DataFrame, events: DataFrame, athletes: DataFrame,
                     min_athletes: int = MIN_ATHLETES_PER_COUNTRY,
                     natural_keys: bool = False, star: DataFrame | None = None) -> DataFrame:
    """Time results (km covered) with event and athlete attributes, for
    countries with at least ``min_athletes`` athletes."""
    s = star if star is not None else star_results(fact, events, athletes)
    s = s.filter((F.col("event_type") == "time") & (F.col("country_athletes") >= min_athletes))
    return s.select(*_there(s, None, [
        *_key(natural_keys), "performance_km", "average_speed", "age_category", "event_name",
        "distance", "start_date", "event_year", "number_finishers", "athlete_id", "gender",
        "country_name", "birth_year"]))


def mart_overview(fact: DataFrame, events: DataFrame, athletes: DataFrame,
                  dates: DataFrame, natural_keys: bool = False,
                  star: DataFrame | None = None) -> DataFrame:
    """All results with event, athlete and calendar attributes."""
    s = star if star is not None else star_results(fact, events, athletes)
    return (s.alias("s").join(dates.alias("d"), F.col("s.start_date") == F.col("d.date"))
             .select(*_there(s, "s", [
                 *_key(natural_keys), "event_name", "event_type", "start_date", "event_year", "distance",
                 "number_finishers", "performance_seconds", "performance_km", "average_speed",
                 "age_category", "athlete_id", "gender", "country_name", "birth_year"]),
                     "d.month_name", "d.quarter", "d.day_name"))


class Gold:
    """The gold tables over one silver DataFrame. Marts are built on demand
    with a given country threshold.

    Without ``persist`` everything is lazy. With it (``persist(df, name) ->
    DataFrame``, e.g. a layer writer) each of the fact and the dimensions is
    materialized the first time it is used, as the reference's materialized
    views are, and the marts join the written tables. That is the path to use
    at scale: both sides of the fact-dimension joins are then plain scans, so
    AQE can split the partition of a hot key (its skew-join rule needs a
    shuffle directly under each side; a lazy aggregate's output partitioning
    removes it from the dimension side and leaves the hot partition to one
    task).
    """

    def __init__(self, silver: DataFrame,
                 persist: Callable[[DataFrame, str], DataFrame] | None = None,
                 kept: dict[str, DataFrame] | None = None):
        self.silver = silver
        self.persist = persist
        # Tables maintained elsewhere (``fact``, ``dim_event``,
        # ``dim_athlete``), used as they are.
        self.__dict__.update(kept or {})

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return self.persist(df, name) if self.persist else df

    @cached_property
    def fact(self) -> DataFrame:
        return self._keep(fct_results(self.silver), "fct_results")

    @cached_property
    def dim_event(self) -> DataFrame:
        return self._keep(dim_event(self.silver), "dim_event")

    @cached_property
    def dim_athlete(self) -> DataFrame:
        return self._keep(dim_athlete(self.silver), "dim_athlete")

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._keep(dim_date(self.silver), "dim_date")

    @cached_property
    def star(self) -> DataFrame:
        """The join the marts share, materialized with ``persist``."""
        return self._keep(star_results(self.fact, self.dim_event, self.dim_athlete), "star_results")

    def mart_distance(self, min_athletes: int = MIN_ATHLETES_PER_COUNTRY, natural_keys=False):
        return mart_distance_events(self.fact, self.dim_event, self.dim_athlete,
                                    min_athletes, natural_keys, star=self.star)

    def mart_time(self, min_athletes: int = MIN_ATHLETES_PER_COUNTRY, natural_keys=False):
        return mart_time_events(self.fact, self.dim_event, self.dim_athlete,
                                min_athletes, natural_keys, star=self.star)

    def mart_overview(self, natural_keys=False):
        return mart_overview(self.fact, self.dim_event, self.dim_athlete,
                             self.dim_date, natural_keys, star=self.star)

    def mart_for(self, kind: str, reads: list[str], min_athletes: int = MIN_ATHLETES_PER_COUNTRY) -> DataFrame:
        """The mart of a kind (``distance``, ``time`` or ``overview``) with
        the columns a report reads, for a report that is the only reader: the
        joins carry no other column and only results of the mart's type,
        where ``star`` writes every result with all of them. Materialized
        with ``persist``, so that no report's grouping takes over the join's
        partitions (it would keep AQE from splitting a hot athlete's)."""
        tables = (self.fact, self.dim_event, self.dim_athlete)
        if kind == "overview":
            mart = mart_overview(*tables, self.dim_date, natural_keys=True)
        else:
            build = {"distance": mart_distance_events, "time": mart_time_events}[kind]
            mart = build(*tables, min_athletes, natural_keys=True)
        return self._keep(mart.select(*reads), f"mart_{kind}_{'_'.join(reads)}")
