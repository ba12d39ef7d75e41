def test_flush_ready_threshold(spark):
    from orderlake.operators.flush import flush_ready
    out = spark.range(49, 53).select("id", flush_ready("id", 50).alias("ready")).collect()
    assert [r.ready for r in out] == [False, False, True, True]


def test_ledger_matches_a_sequential_fold(spark, scratch):
    """Sizes from nothing to far over the threshold, which may be huge: the gate holds levels, not rows."""
    import random

    from orderlake.streaming import flush_ledger, gated_batch_handler
    random.seed(7)
    for threshold in (3, 10_000_000):
        staging, sizes = f"{scratch}/{threshold}", [random.choice([0, 1, 2, 3, 9]) for _ in range(9)]
        handle = gated_batch_handler(staging, threshold)
        expect, held, flush, opened = [], 0, 1, []
        for i, n in enumerate(sizes):
            handle(spark.range(n).selectExpr("concat('[{\"order_id\": \"', id, '\"}]') AS value"), i)
            held += n
            closes = held > threshold
            opened.append(i)
            if closes:
                expect += [(b, sizes[b], flush, b == i) for b in opened]
                held, flush, opened = 0, flush + 1, []
        expect += [(b, sizes[b], None, False) for b in opened]
        assert sorted(map(tuple, flush_ledger(spark, staging).collect())) == expect
