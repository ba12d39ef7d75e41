import datetime as dt

from pyspark.sql import functions as F

from orderlake.functions.timeparts import (epoch_to_text, parse_event_time, text_to_epoch,
                                           time_parts_by_substring)
from orderlake.plans.silver import add_time_parts


def test_time_parts_good_and_bad_dates(spark):
    rows = [("05/06/2024 10:11:12",), ("2024-06-05",), ("",), (None,), ("31/02/2024 00:00:00",)]
    df = spark.createDataFrame(rows, "date string")
    out = add_time_parts(df).collect()
    assert "date" not in add_time_parts(df).columns
    good = out[0]
    assert good.event_date == dt.datetime(2024, 6, 5, 10, 11, 12)
    assert good.partition_date == "05062024"
    assert (good.event_day, good.event_hour, good.event_minute, good.event_month,
            good.event_second, good.event_year) == (5, 10, 11, 6, 12, 2024)
    for bad in out[1:]:
        assert bad.event_date is None and bad.partition_date is None and bad.event_year is None


def test_epoch_roundtrip_and_substring_parts(spark):
    df = spark.createDataFrame([("05/06/2024 10:11:12",), ("bad",)], "date string")
    e = text_to_epoch("date")
    out = df.select(e.alias("e"), epoch_to_text(e).alias("t"), epoch_to_text(e, "yyyyMMdd").alias("d"),
                    *[c.alias(n) for n, c in time_parts_by_substring(parse_event_time("date")).items()]
                    ).collect()
    assert out[0].e == 1717582272 and out[0].t == "2024-06-05 10:11:12" and out[0].d == "20240605"
    assert (out[0].event_year, out[0].event_month, out[0].event_day) == (2024, 6, 5)
    assert (out[0].event_hour, out[0].event_minute, out[0].event_second) == (10, 11, 12)
    assert out[1].e is None and out[1].event_year is None


def test_substr_start_zero_acts_like_one(spark):
    out = spark.range(1).select(F.lit("2024-06-05").substr(0, 4).alias("y")).first()
    assert out.y == "2024"


def test_time_parts_property(spark):
    """Random wall times written as feed text parse back to the same calendar parts."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.datetimes(min_value=dt.datetime(1950, 1, 1), max_value=dt.datetime(2100, 12, 31)),
                    min_size=1, max_size=20))
    def check(times):
        texts = [t.replace(microsecond=0) for t in times]
        df = spark.createDataFrame([(t.strftime("%d/%m/%Y %H:%M:%S"),) for t in texts], "date string")
        got = [(r.event_year, r.event_month, r.event_day, r.event_hour, r.event_minute, r.event_second,
                r.partition_date) for r in add_time_parts(df).collect()]
        assert got == [(t.year, t.month, t.day, t.hour, t.minute, t.second, t.strftime("%d%m%Y"))
                       for t in texts]

    check()
