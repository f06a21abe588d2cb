import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.operators.reconcile import P, add, latest, mul, reconcile, recover, sub


def test_field():
    rnd = random.Random(1)
    a, b = ([rnd.randrange(P) for _ in range(500)] + [0, 1, P - 1] for _ in range(2))
    x, y = np.array(a, np.uint64), np.array(b, np.uint64)
    assert mul(x, y).tolist() == [p * q % P for p, q in zip(a, b)]
    assert add(x, y).tolist() == [(p + q) % P for p, q in zip(a, b)]
    assert sub(x, y).tolist() == [(p - q) % P for p, q in zip(a, b)]


@pytest.mark.parametrize("only_a,only_b,both", [(0, 0, 0), (0, 0, 50), (1, 0, 50), (0, 7, 40), (13, 5, 100), (40, 45, 10), (9, 0, 0), (0, 3, 0)])
def test_recover(only_a, only_b, both):
    rnd = random.Random(only_a * 100 + only_b)
    h = [rnd.randrange(P) for _ in range(only_a + only_b + both)]
    a, b = np.array(h[:both] + h[both : both + only_a], np.uint64), np.array(h[:both] + h[both + only_a :], np.uint64)
    in_a, in_b, bound = recover(a, b)
    assert set(a[in_a].tolist()) == set(h[both : both + only_a]) and set(b[in_b].tolist()) == set(h[both + only_a :])
    if both > 50:
        assert bound < len(a) + len(b)  # the work follows the difference


def test_reconcile(spark):
    s = "k string, j string, f string, g string, extra int"
    a = spark.createDataFrame([("1", "x", "p", "q", 1), ("2", "x", None, "q", 1), ("3", "x", "p", None, 1), ("4", "x", "p", "q", 1), ("5", "", "p", "q", 1)], s)
    b = spark.createDataFrame([("1", "x", "p", "q", 2), ("2", "x", None, "q", 2), ("3", "x", "r", "q", 2), ("6", "x", "p", "q", 2), ("5", "", None, "q", 1)], s)
    copies = lambda x, y: x.withColumn("side", F.lit("a")).unionByName(y.withColumn("side", F.lit("b"))).unionByName(a.withColumn("side", F.lit("c")))
    found = lambda x, y, **kw: reconcile(copies(x, y), "side", ["k", "j"], ["f", "g"], ("a", "b"), **kw)
    got = {(r.k, r.finding) for r in found(a, b).collect()}
    assert got == {("3", "f"), ("3", "g"), ("4", "only_a"), ("6", "only_b"), ("5", "f")}
    none = a.where("false")
    assert {r.finding for r in found(none, b).collect()} == {"only_b"}
    assert found(none, none).count() == 0
    assert found(a, a).count() == 0


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "x"), ("b", 2, None)], "k string, id int, v string")
    assert {(r.k, r.v) for r in latest(df, ["k"], "id", ["v"]).collect()} == {("a", "z"), ("b", None)}


def test_many_buckets(spark):
    """Several buckets in one task, also over the ends of batches, against the plain difference."""
    rnd = random.Random(5)
    rows = {(s, str(k)): str(int(rnd.random() < 0.03)) for k in range(1500) for s in "ab" if rnd.random() < 0.97}
    df = spark.createDataFrame([(s, k, v) for (s, k), v in rows.items()], "side string, k string, f string")
    want = set()
    for k in map(str, range(1500)):
        a, b = rows.get(("a", k)), rows.get(("b", k))
        if a != b:
            want.add((k, "only_b" if a is None else "only_a" if b is None else "f"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        for kw in ({}, {"bucket_rows": 400}, {"buckets": 1}):
            assert {(r.k, r.finding) for r in reconcile(df, "side", ["k"], ["f"], ("a", "b"), **kw).collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
