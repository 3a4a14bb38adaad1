"""Column helpers and their SQL forms."""

import pytest
from pyspark.sql import functions as F

from haltwise.functions import transit as t


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(
    "delay, code, text",
    [
        (-120, 1, "Early"), (-61, 1, "Early"), (-60, 2, "OnTime"), (0, 2, "OnTime"),
        (30, 2, "OnTime"), (180, 2, "OnTime"), (181, 3, "SlightlyLate"), (240, 3, "SlightlyLate"),
        (360, 3, "SlightlyLate"), (361, 4, "Late"), (500, 4, "Late"), (None, None, None),
    ],
)
def test_punctuality(spark, delay, code, text):
    df = spark.createDataFrame([(delay,)], "d bigint")
    row = df.select(t.punctuality_code_col("d"), t.punctuality_col(F.col("d"))).first()
    assert tuple(row) == (code, text)


def test_delay_minutes(spark):
    assert values(spark, t.delay_minutes_col("s"), [(180,), (-90,), (None,)], "s bigint") == [
        3.0, -1.5, None]


def test_delay_and_duration_seconds(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-01 10:00:00' a, timestamp'2024-01-01 10:01:30' b, "
        "cast(null as timestamp) c"
    )
    row = df.select(
        t.delay_seconds_col("b", "a"), t.duration_seconds_col("b", "a"), t.delay_seconds_col("b", "c")
    ).first()
    assert tuple(row) == (90, -90, None)


def test_haversine(spark):
    rows = [(55.6093, 13.0003, 55.6093, 13.0003), (55.6093, 13.0003, 55.7058, 13.1872),
            (0.0, 0.0, 0.0, 180.0), (None, None, 55.0, 13.0)]
    same, far, turn, unknown = values(
        spark, t.haversine_col("a", "b", "c", "d"), rows, "a double, b double, c double, d double"
    )
    assert unknown is None and same < 0.01 and 15_000 < far < 20_000 and turn == pytest.approx(20_015_086.8, abs=1)


def test_speed(spark):
    rows = [(1000, 120), (1000, 0), (1000, None)]
    assert values(spark, t.speed_kph_col("m", "s"), rows, "m bigint, s bigint") == [30.0, None, None]


def test_first_and_last_stop(spark):
    rows = [(1, 10), (5, 10), (10, 10), (10, None)]
    df = spark.createDataFrame(rows, "seq int, last int")
    got = df.select(t.is_first_stop_col("seq"), t.is_last_stop_col("seq", "last")).collect()
    assert [tuple(r) for r in got] == [("Yes", "No"), ("No", "No"), ("No", "Yes"), ("No", "No")]


def test_detection(spark):
    rows = [("ARRIVED", "DEPARTED"), ("ARRIVED", "SCHEDULED"), ("", None)]
    df = spark.createDataFrame(rows, "a string, d string")
    share = t.detection_completeness_col("a", "d")
    got = df.select(share, t.detection_completeness_state_col(share)).collect()
    assert [tuple(r) for r in got] == [(1.0, "Full"), (0.5, "Partial"), (0.0, "None")]


def test_service_day(spark):
    rows = [("20240229",), ("2024-02-29",), ("20230229",), ("x",), (None,)]
    days = values(spark, t.service_date_col("d").cast("string"), rows, "d string")
    assert days == ["2024-02-29", "2024-02-29", None, None, None]
    df = spark.sql("SELECT date'2024-02-29' d, '25:10:05' s, '9:05' m, 'soon' x")
    row = df.select(
        t.weekday_col("d"),
        t.service_time_col("d", "s").cast("string"),
        t.joined_date_time_col("d", "s"),
        t.service_seconds_col("m"),
        t.service_seconds_col("x"),
    ).first()
    assert tuple(row) == ("Thursday", "2024-03-01 01:10:05", "2024-02-29 25:10:05", 32700, None)


def test_utc_offset_follows_the_zone(spark):
    rows = [("2024-01-15",), ("2024-03-31",), ("2024-10-26",), ("2024-10-27",)]
    col = t.utc_offset_minutes_col(F.col("d").cast("date"), "Europe/Stockholm")
    assert values(spark, col, rows, "d string") == [60, 120, 120, 60]


def test_ids(spark):
    df = spark.createDataFrame([("9022012000001001", 3), (None, 3), ("90220", 3)], "s string, q int")
    got = df.select(
        t.pattern_point_gid_col("s", "q"), t.stop_area_gid_col("s"), t.stop_id_part_col("s", 6, 2),
        t.stop_id_part_col("s", 8, 6), t.stop_id_part_col("s", 14, 3),
    ).collect()
    whole, none, short = (tuple(r) for r in got)
    assert whole[:2] == ("JPP_9022012000001001_3", "SA_9022012000001001")
    assert none == (None,) * 5
    assert short == ("JPP_90220_3", "SA_90220", None, None, None)
    stop = "9022012000001001"
    assert whole[2:] == (stop[5:7], stop[7:13], stop[13:16])


def test_sql_functions_match_columns(spark):
    t.register_sql_functions(spark)
    spark.createDataFrame(
        [(d, 55.0 + (d or 0) / 1000) for d in (-61, -60, 0, 180, 181, 360, 361, None)] + [(5, None)],
        "d bigint, lat double",
    ).createOrReplaceTempView("delays")
    df = spark.sql(
        "SELECT *, punctuality_code(d) c, punctuality_text(d) p, delay_minutes(d) m, "
        "speed_kph(500D, d) v, haversine_m(lat, 13D, 55D, 13D) h FROM delays"
    )
    differs = df.filter(
        ~(
            F.col("c").eqNullSafe(t.punctuality_code_col("d"))
            & F.col("p").eqNullSafe(t.punctuality_col("d"))
            & F.col("m").eqNullSafe(t.delay_minutes_col("d"))
            & F.col("v").eqNullSafe(t.speed_kph_col(F.lit(500.0), "d"))
            & F.round("h", 6).eqNullSafe(
                F.round(t.haversine_col("lat", F.lit(13.0), F.lit(55.0), F.lit(13.0)), 6)
            )
        )
    )
    assert differs.count() == 0
