import datetime
import random

from pyspark.sql import functions as F

from lexloom.operators.orphans import hot_keys, orphans_by_period, reference_status

D = datetime.datetime


def status(spark, refs, parents, **kw):
    r = spark.createDataFrame(refs, "n int, ref_key string, ref_ts timestamp_ntz, key string")
    p = spark.createDataFrame(parents, "key string, start_ts timestamp_ntz, end_ts timestamp_ntz, n int")
    return {x.n: x.status for x in reference_status(r, p, **kw).collect()}


def test_cases(spark):
    parents = [("a", D(2025, 1, 1), D(2025, 2, 1), 1), ("a", D(2025, 3, 1), None, 1), ("a", D(2025, 3, 1), None, 1), ("b", D(2025, 5, 1), None, 1), ("c", None, D(2025, 1, 1), 1), (None, D(2025, 1, 1), None, 1)]
    refs = [
        (1, "a", D(2025, 1, 1), "x"), (2, "a", D(2025, 2, 1), "x"), (3, "a", D(2025, 3, 1), "x"), (4, "a", D(2024, 1, 1), "x"), (5, "b", D(2025, 4, 1), "x"), (6, "z", D(2025, 4, 1), "x"),
        (7, None, D(2025, 4, 1), "x"), (8, "a", None, "x"), (9, "z", None, "x"), (10, "c", D(2024, 1, 1), "x"), (11, "c", D(2026, 1, 1), "x"), (12, "", D(2026, 1, 1), "x"),
    ]
    want = {1: "ok", 2: "deleted", 3: "ok", 4: "late", 5: "late", 6: "missing", 8: "ok", 9: "missing", 10: "ok", 11: "deleted", 12: "missing"}
    assert status(spark, refs, parents) == want
    assert status(spark, refs, parents, hot_rows=1) == want
    assert set(status(spark, refs, []).values()) == {"missing"}
    assert status(spark, [], parents) == {}


def test_against_brute_force(spark):
    rnd = random.Random(4)
    day = lambda n: D(2025, 1, 1) + datetime.timedelta(days=n)
    parents = [(f"k{rnd.randrange(12)}", day(s := rnd.randrange(60)), day(s + rnd.randrange(1, 30)) if rnd.random() < 0.7 else None, 0) for _ in range(25)]
    refs = [(i, "k0" if rnd.random() < 0.4 else f"k{rnd.randrange(16)}", day(rnd.randrange(90)), "") for i in range(600)]

    def brute(k, t):
        own = [p for p in parents if p[0] == k]
        if not own:
            return "missing"
        if any(s <= t and (e is None or t < e) for _, s, e, _ in own):
            return "ok"
        return "deleted" if any(s <= t for _, s, _, _ in own) else "late"

    want = {i: brute(k, t) for i, k, t, _ in refs}
    assert status(spark, refs, parents) == want
    assert status(spark, refs, parents, hot_rows=20) == want


def test_report(spark):
    df = spark.createDataFrame([("src", D(2025, 1, 5), "ok"), ("src", D(2025, 1, 6), "late"), ("src", D(2025, 1, 7), "late"), ("target", None, "missing")], "side string, ref_ts timestamp_ntz, status string")
    assert {tuple(r) for r in orphans_by_period(df, "edge").collect()} == {("edge", "src", "2025-01", "late", 2), ("edge", "target", None, "missing", 1)}


def test_many_hot_keys(spark):
    """No key is left whole, however many are hot, and the bound of the table holds."""
    refs = spark.range(2000 * 12).select((F.col("id") % 2000).cast("string").alias("ref_key"), F.lit(D(2025, 1, 1)).cast("timestamp_ntz").alias("ref_ts"))
    hot = hot_keys(refs, "ref_key", rows=5)
    assert hot.count() == 2000 and {r.salts for r in hot.collect()} == {3}
    assert hot_keys(refs, "ref_key", keys=500, rows=5).count() == 0  # none holds a 500th of all rows
    parents = spark.createDataFrame([("1", D(2024, 1, 1), None), ("2", D(2024, 1, 1), D(2024, 6, 1)), ("3", D(2026, 1, 1), None)], "key string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    got = {(r.status, r["count"]) for r in reference_status(refs, parents, hot_rows=5).groupBy("status").count().collect()}
    assert got == {("ok", 12), ("deleted", 12), ("late", 12), ("missing", 1997 * 12)}
