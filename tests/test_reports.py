import datetime as dt

from conftest import plan_text
from orderlake.operators import count_rows, latest, latest_first, qty_by_event_time, qty_by_neighborhood


def _gold(spark):
    rows = [("a", 5, dt.datetime(2024, 1, 1, 0, 0, 1)), ("a", None, dt.datetime(2024, 1, 1, 0, 0, 1)),
            ("b", None, dt.datetime(2024, 1, 1, 0, 0, 2)), (None, 7, None), (None, 1, None)]
    return spark.createDataFrame(rows, "neighborhood string, quantity_products int, event_date timestamp")


def test_qty_by_neighborhood_pandas_semantics(spark):
    out = [tuple(r) for r in qty_by_neighborhood(_gold(spark)).collect()]
    assert out == [("a", 5), ("b", 0)]  # null key dropped, all-null group sums to 0, sorted


def test_qty_by_event_time(spark):
    out = [tuple(r) for r in qty_by_event_time(_gold(spark)).collect()]
    assert out == [(None, 8), ("2024-01-01 00:00:01", 5), ("2024-01-01 00:00:02", 0)]


def test_count_sort_topk(spark):
    df = spark.createDataFrame([("b",), ("c",), (None,), ("a",)], "order_id string")
    assert count_rows(df).first().n == 4
    assert [r.order_id for r in latest_first(df).collect()] == ["c", "b", "a", None]
    assert [r.order_id for r in latest(df, 2).collect()] == ["c", "b"]
    assert "TakeOrderedAndProject" in plan_text(latest(df, 2))


def test_sort_with_map_column(spark):
    df = spark.createDataFrame([("b", {"k": 1}), ("a", {"k": 2})], "order_id string, props map<string,int>")
    assert [r.order_id for r in latest_first(df).collect()] == ["b", "a"]


def test_qty_by_event_time_pandas_text(spark):
    out = [tuple(r) for r in qty_by_event_time(_gold(spark), missing="NaT").collect()]
    assert out == [("2024-01-01 00:00:01", 5), ("2024-01-01 00:00:02", 0), ("NaT", 8)]
    midnights = spark.createDataFrame([(3, dt.datetime(2024, 1, 1)), (4, dt.datetime(2024, 1, 2)), (1, None)],
                                      "quantity_products int, event_date timestamp")
    out = [tuple(r) for r in qty_by_event_time(midnights, "yyyy-MM-dd", "NaT").collect()]
    assert out == [("2024-01-01", 3), ("2024-01-02", 4), ("NaT", 1)]
