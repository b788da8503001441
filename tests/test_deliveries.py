import datetime as dt
import random

from quirewright.operators.deliveries import exactly_once, repeated_deliveries

SCHEMA = "message_id string, delivered_at timestamp, delivery_id bigint, message string, dropped string"
T = lambda s: dt.datetime(2025, 1, 1) + dt.timedelta(seconds=s)


def brute(rows):
    best = {}
    for m, t, d, *_ in rows:
        m = (m or "").strip().lower()
        if m and d is not None:
            k = (t or dt.datetime.max, d)
            best[m] = min(best.get(m, k), k)
    return {d for m, t, d, *_ in rows if d is not None and (k := (m or "").strip().lower()) and (t or dt.datetime.max, d) != best[k]}


def test_against_brute_force_with_a_hot_identifier(spark):
    r = random.Random(5)
    rows = [((f" M{r.randrange(400)}" if r.random() > 0.33 else "hot\n") if r.random() > 0.02 else None, T(r.randrange(10**6)) if r.random() > 0.01 else None, i, "x", "y") for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [x.delivery_id for x in repeated_deliveries(df, slice_rows=300, bucket_seconds=7200).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert exactly_once(df, slice_rows=300).count() == 3000 - len(got)


def test_ties_nulls_blanks_repeated_rows_and_empty(spark):
    rows = [("A", T(1), 2, None, None), ("a ", T(1), 1, None, None), ("a", T(1), 1, None, None), ("B", None, 4, None, None), ("b", T(9), 5, None, None), (None, T(1), 6, None, None), (None, T(1), 7, None, None), (" ", T(1), 8, None, None), ("", T(1), 9, None, None), ("x" * 100_000, T(2), 10, None, None), ("X" * 100_000, T(3), 11, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {x.delivery_id for x in repeated_deliveries(df).collect()} == {2, 4, 11}
    assert repeated_deliveries(df.limit(0)).count() == 0
