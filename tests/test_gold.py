
import datetime as dt


from racelake.operators import fill_unknown, generate_ids, join_lookup
from racelake.plans import gold as G

SILVER = ("athlete_id bigint, athlete_country string, country_name string, "
          "athlete_year_of_birth int, athlete_gender string, event_name string, event_type string, "
          "year_of_event int, event_start_date date, event_end_date date, `event_distance/length` string, "
          "event_number_of_finishers int")


def _silver(spark, rows):
    return generate_ids(spark.createDataFrame(rows, SILVER))


def test_dim_athlete_takes_min_per_column(spark):
    d = dt.date(2018, 1, 1)
    s = _silver(spark, [
        (1, "SWE", "Sweden", 1980, "M", "A", "distance", 2018, d, d, "50km", 10),
        (1, "NOR", "Norway", 1979, None, "B", "distance", 2018, d, d, "50km", 10),
    ])
    r = G.dim_athlete(s).collect()
    assert len(r) == 1
    # Country code and name come from different rows; NULL gender is ignored.
    assert (r[0].country_code, r[0].country_name, r[0].birth_year, r[0].gender) == ("NOR", "Norway", 1979, "M")


def test_dim_event_one_row_per_name_across_editions(spark):
    s = _silver(spark, [
        (1, "C", "N", 1980, "M", "Ultra", "distance", 2019, dt.date(2019, 5, 1), dt.date(2019, 5, 2), "100km", 50),
        (2, "C", "N", 1980, "M", "Ultra", "distance", 2017, dt.date(2017, 6, 1), dt.date(2017, 6, 1), "50km", 80),
    ])
    r = G.dim_event(s).collect()
    assert len(r) == 1
    assert (r[0].event_year, r[0].start_date, r[0].end_date, r[0].distance, r[0].number_finishers) == \
        (2017, dt.date(2017, 6, 1), dt.date(2017, 6, 1), "100km", 80)


def test_unknown_country_drops_at_lookup_join(spark):
    df = spark.createDataFrame([(1, None), (2, "SWE"), (3, "XXX")], "athlete_id int, athlete_country string")
    lk = spark.createDataFrame([("SWE", "Sweden")], "athlete_country string, country_name string")
    out = join_lookup(fill_unknown(df, ["athlete_country"]), lk, "athlete_country")
    assert [r.athlete_id for r in out.collect()] == [2]
