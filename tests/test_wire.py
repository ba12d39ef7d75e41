from pyspark.sql import functions as F

from orderlake import testfeed as tf
from orderlake.streaming import parse_orders, quarantine, to_wire


def test_parse_table_of_bad_lines(spark):
    lines = spark.createDataFrame([(v,) for v in tf.BAD_WIRE_LINES] + [(None,)], "value string")
    rows = {r.order_id: r for r in parse_orders(lines).collect()}
    assert set(rows) == {"single", "badtypes", "missing", "first"}   # '[]', blank, junk, null vanish
    assert rows["badtypes"].object_id is None and rows["badtypes"].customer_id is None
    assert rows["badtypes"].employee_id is None and rows["badtypes"].quantity_products == 4
    assert rows["missing"].latitude is None
    bad = sorted(r.value for r in quarantine(lines).collect())
    assert bad == ["", "not json at all"]


def test_wire_roundtrip(spark):
    feed = tf.feed(spark, "/root/testdata/sf0.001")
    wire = tf.wire_lines(spark, "/root/testdata/sf0.001")
    assert wire.count() == -(-feed.count() // 7)
    back = parse_orders(wire)
    assert back.exceptAll(feed).count() == 0 and feed.exceptAll(back).count() == 0


def test_to_wire_packs_batches(spark):
    orders = tf.feed(spark, "/root/testdata/sf0.001").limit(10).withColumn("b", F.lit(1))
    line = to_wire(orders, "b").first().value
    assert line.startswith("[{") and line.count("order_id") == 10


def test_wire_roundtrip_property(spark):
    """Random orders (nulls, unicode, extreme values) survive pack -> JSON -> parse."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from orderlake.schemas import ORDER_SCHEMA

    ints = st.one_of(st.none(), st.integers(-2**31, 2**31 - 1))
    dbls = st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64))
    text = st.one_of(st.none(), st.text(max_size=12))
    order = st.tuples(ints, dbls, dbls, text, ints, ints, ints, text)

    @settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(st.integers(0, 3), order), min_size=1, max_size=12))
    def check(rows):
        df = spark.createDataFrame([(b, *o) for b, o in rows],
                                   "b int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}"
                                                         for f in ORDER_SCHEMA.fields))
        back = parse_orders(to_wire(df, "b").select("value"))
        orig = df.drop("b")
        assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0

    check()
