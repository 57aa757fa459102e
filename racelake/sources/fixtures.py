"""Race-result feeds derived from the driver's TPC-H-style tables.

Mapping: a customer is an athlete, ``l_partkey`` is an event, one
lineitem is one result. The main feed and the second feed carry the raw
(title-case) column names of the real feeds, so the whole cleaning path is
exercised; the lookup maps 3-character country codes to names.

Everything is a lazy DataFrame over the driver tables, so its size grows
with them. The joins are ordered so that the largest table (lineitem) is
shuffled once: orders join customers first (both far smaller), then
lineitem joins that result on the order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Raw column names of the main results feed, in file order.
MAIN_COLUMNS = [
    "Year of event", "Event dates", "Event name", "Event distance/length",
    "Event number of finishers", "Athlete performance", "Athlete club",
    "Athlete country", "Athlete year of birth", "Athlete gender",
    "Athlete age category", "Athlete average speed", "Athlete ID",
]
# The second feed has no date text and no club, but real start/end dates.
SECOND_COLUMNS = [
    "Year of event", "Event name", "Event distance/length",
    "Event number of finishers", "Athlete performance", "Athlete country",
    "Athlete year of birth", "Athlete gender", "Athlete age category",
    "Athlete average speed", "Athlete ID", "Event start date", "Event end date",
]

# Fixed values of the test mapping.
COUNTRIES_IN_LOOKUP = 23          # nation keys 0..22; two nations left out
LARGE_COUNTRIES = (7, 3)
FIRST_YEARS = 6                   # events' first years are spread by that many
SECOND_FEED_EVENT = "Trail Classic (C07)"
SECOND_FEED_DATE = "2024-06-15"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad2(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def _dmy(ts: Column) -> Column:
    return F.concat_ws(".", _pad2(F.dayofmonth(ts)), _pad2(F.month(ts)),
                       F.year(ts).cast("string"))


def _home(nationkey: Column, custkey: Column) -> Column:
    """Half of the athletes come from two countries, so that at small scales
    too some countries pass the marts' threshold and others do not."""
    known = nationkey < COUNTRIES_IN_LOOKUP
    return (F.when(known & (custkey % 4 == 1), F.lit(LARGE_COUNTRIES[0]))
             .when(known & (custkey % 4 == 2), F.lit(LARGE_COUNTRIES[1])).otherwise(nationkey))


def _country_code(nationkey: Column) -> Column:
    return F.concat(F.lit("C"), _pad2(nationkey))


def athletes_with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customer, orders.o_custkey == customer.c_custkey)


def main_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main feed: one row per lineitem, raw column names."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", F.col("l_shipdate").cast("date").alias("l_shipdate"))  # one cast for all its parts
    # lineitem and orders are both fact-sized: shuffle both on the order key
    # (sort-merge, spill-safe). Left to itself the planner broadcasts
    # lineitem at small scales, which runs the whole feed in one task.
    j = li.join(athletes_with_orders(spark, sf_dir).hint("merge"),
                F.col("l_orderkey") == F.col("o_orderkey"))

    ship = F.col("l_shipdate")
    nxt = F.date_add(ship, 1)
    ok, pk, sk, ck = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "c_custkey"))

    iso = F.concat_ws("-", F.year(ship).cast("string"), _pad2(F.month(ship)),
                      _pad2(F.dayofmonth(ship)))
    ranged = F.concat(_pad2(F.dayofmonth(ship)), F.lit(".-"), _dmy(nxt))
    dates = (F.when(ok % 11 == 0, iso).when(ok % 11 == 1, ranged)
              .when(ok % 11 == 2, F.concat(F.lit("31.04."), F.year(ship).cast("string")))
              .when(ok % 11 == 3, F.lit(None).cast("string"))
              .otherwise(_dmy(ship)))

    length = (F.when(pk % 8 == 0, "50km").when(pk % 8 == 1, "100km")
               .when(pk % 8 == 2, "50mi").when(pk % 8 == 3, "6h")
               .when(pk % 8 == 4, "24h").when(pk % 8 == 5, "6d")
               .when(pk % 8 == 6, "173km/2Etappen").otherwise("12h"))

    total = F.floor(F.col("l_extendedprice") * 2.5).cast("int")
    hms = F.concat(
        F.when(sk % 20 == 7, F.lit("1d ")).otherwise(F.lit("")),
        F.floor(total / 3600).cast("int").cast("string"), F.lit(":"),
        _pad2(F.floor(total / 60).cast("int") % 60), F.lit(":"),
        _pad2(total % 60), F.lit(" h"))
    km = F.concat((F.col("l_quantity") * 12.5).cast("string"), F.lit(" km"))
    distance_event = (pk % 8).isin(0, 1, 2, 5, 6)
    performance = (F.when(sk % 50 == 0, F.lit(None).cast("string"))
                    .when(distance_event == (F.col("l_linenumber") < 7), hms)
                    .otherwise(km))

    club = (F.when(ck % 5 == 0, F.lit(None).cast("string"))
             .when(ck % 5 == 1, F.concat(F.lit("*"), F.col("c_mktsegment")))
             .otherwise(F.col("c_mktsegment")))
    country = F.when(ck % 53 == 0, F.lit(None).cast("string")).otherwise(
        _country_code(_home(F.col("c_nationkey"), ck)))
    birth = F.when(ck % 41 == 0, F.lit(None).cast("double")).otherwise(
        (F.lit(1890) + (ck * 13) % 100).cast("double"))
    gender = (F.when(ck % 37 == 0, F.lit(None).cast("string"))
               .when(ck % 4 == 0, "F").otherwise("M"))
    category = F.concat(
        F.when(ck % 4 != 0, "M").when(ok % 2 == 0, "F").otherwise("W"),
        (F.lit(20) + (ck % 10) * 5).cast("string"))
    speed = (F.when(sk % 10 == 0, F.lit(None).cast("string"))
              .when(sk % 10 == 1, "18:00:00").when(sk % 10 == 2, "1.5")
              .when(sk % 10 == 3, "25.0")
              .otherwise((F.lit(3.0) + F.col("l_quantity") / 4).cast("string")))

    cols = [
        (F.year(ship) - pk % FIRST_YEARS).cast("int"), dates,
        F.concat(F.lit("Ultra "), pk.cast("string"), F.lit(" ("),
                 _country_code(pk % 25), F.lit(")")),
        length, (F.lit(1) + (pk * 7) % 900).cast("int"), performance, club,
        country, birth, gender, category, speed, ck,
    ]
    return j.select(*[c.alias(n) for c, n in zip(cols, MAIN_COLUMNS)])


def second_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small second feed of one event, with real dates and no club."""
    j = athletes_with_orders(spark, sf_dir)
    ok, ck = F.col("o_orderkey"), F.col("c_custkey")
    even = ck % 2 == 0
    day = F.to_date(F.lit(SECOND_FEED_DATE))
    cols = [
        F.lit(2024).cast("int"), F.lit(SECOND_FEED_EVENT), F.lit("50km"),
        F.lit(84).cast("int"),
        F.concat((F.lit(5) + ok % 9).cast("string"), F.lit(":30:00 h")),
        _country_code(_home(F.col("c_nationkey"), ck)),
        (F.lit(1950) + ck % 50).cast("double"),
        F.when(even, "F").otherwise("M"), F.when(even, "F40").otherwise("M40"),
        F.lit("7.5"), ck, day, day,
    ]
    return j.select(*[c.alias(n) for c, n in zip(cols, SECOND_COLUMNS)])


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country code -> name, with two nations deliberately missing."""
    n = load(spark, sf_dir, "nation")
    return (n.filter(F.col("n_nationkey") < COUNTRIES_IN_LOOKUP)
             .select(_country_code(F.col("n_nationkey")).alias("athlete_country"),
                     F.col("n_name").alias("country_name")))
