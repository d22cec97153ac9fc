import random

from pyspark.sql import functions as F

from conftest import seconds
from holdshort.operators import joins, spread


def naive_nearest(left, right, tolerance):
    out = {}
    for i, (key, t) in enumerate(left):
        found = [(round(abs(t - u), 3), u, c) for k, u, c in right if k == key and abs(int(t) - int(u)) <= tolerance]
        if found:
            out[i] = min(found)[2]
    return out


def test_nearest_within_equals_brute_force(table):
    rnd = random.Random(3)
    left = [(rnd.choice("ab"), round(rnd.uniform(0, 500), 3)) for _ in range(200)]
    right = [(rnd.choice("ab"), round(rnd.uniform(0, 500), 3), rnd.choice("xyz")) for _ in range(60)]
    for tolerance in (0, 1, 7, 60):
        l = table([(i, k, t) for i, (k, t) in enumerate(left)], "i int, k string, ts ts")
        r = table(right, "k string, ts ts, c string")
        got = {x.i: x.c for x in joins.nearest_within(l, r, ["k"], tolerance, ["c"]).collect()}
        assert got == naive_nearest(left, right, tolerance)


def test_nearest_ties_go_to_the_earlier_then_smaller(table):
    left = table([("a", 100.0)], "k string, ts ts")
    right = table([("a", 110.0, "x"), ("a", 90.0, "z"), ("a", 90.0, "y")], "k string, ts ts, c string")
    assert joins.nearest_within(left, right, ["k"], 10, ["c"]).first().c == "y"


def test_nearest_uses_the_closest_time_within_a_second(table):
    left = table([("a", 10.002)], "k string, ts ts")
    right = table([("a", 10.0, "x"), ("a", 10.001, "y")], "k string, ts ts, c string")
    assert joins.nearest_within(left, right, ["k"], 1, ["c"]).first().c == "y"


def test_nearest_checks_the_tolerance_on_each_side(table):
    left = table([("a", 10.0)], "k string, ts ts")
    right = table([("a", 8.99, "two seconds before"), ("a", 11.5, "one second after")], "k string, ts ts, c string")
    assert joins.nearest_within(left, right, ["k"], 1, ["c"]).first().c == "one second after"


def test_labels_within_equals_brute_force(table):
    rnd = random.Random(4)
    left = [(i, rnd.choice("ab"), round(rnd.uniform(0, 300), 3)) for i in range(100)]
    right = [(rnd.choice("ab"), round(rnd.uniform(0, 300), 3), rnd.choice("xyzw")) for _ in range(60)]
    for tolerance in (1, 10, 50):
        got = {(r.i, r.c) for r in joins.labels_within(table(left, "i int, k string, ts ts"), table(right, "k string, ts ts, c string"), ["k"], tolerance, "c").collect()}
        want = {(i, c) for i, k, t in left for k2, u, c in right if k == k2 and abs(int(t) - int(u)) <= tolerance}
        assert got == want


def test_labels_within_gives_each_pair_once(table):
    left = table([("a", 5.0)], "k string, ts ts")
    right = table([("a", float(t), "x") for t in range(30)], "k string, ts ts, c string")
    assert joins.labels_within(left, right, ["k"], 10, "c").count() == 1


def asof(table, rows, events):
    r = table(rows, "runway string, ts ts")
    e = table(events, "runway string, ts ts, wake_category string, event string")
    return sorted(joins.asof_last_event(r, e).collect(), key=lambda x: (x.runway, x.ts))


def test_asof_is_strict_and_drops_rows_with_only_later_events(table):
    out = asof(table, [("A", 50.0), ("A", 100.0), ("A", 5000.0), ("B", 70.0)], [("A", 60.0, "H", "takeoff"), ("A", 100.0, "M", "landing")])
    assert [(r.runway, seconds(r, "ts")) for r in out] == [("A", 100.0), ("A", 5000.0), ("B", 70.0)]
    assert [r.last_event_turb_cat for r in out] == ["H", "M", "N/C"]
    assert [r.time_since_last_event_seconds for r in out] == [40, 4900, 65]
    assert out[2].last_event is None


def test_asof_carries_over_slots(table):
    out = asof(table, [("A", 80000.0)], [("A", 10.0, "H", "takeoff")])
    assert out[0].time_since_last_event_seconds == 79990


def test_occupancy_describes_the_finished_interval(table):
    from holdshort.operators.movements import occupancy
    seen = table([(101.0, "Z1", None)], "ts ts, designator string, runway_from_position string")
    occ = occupancy(seen, 10)
    rows = table([(109.9,), (110.0,), (119.0,), (120.0,)], "ts ts")
    got = joins.join_occupancy(rows, occ, 10).collect()
    assert sorted(seconds(r, "ts") for r in got) == [110.0, 119.0]
    assert all(r.Z1 and not r.KA6 for r in got)


def test_spread_join_without_adaptive_execution(spark):
    big = spark.range(1000).select(F.lit(1).alias("k"), "id")
    small = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    expected = {"inner": 1000, "left": 1000, "left_semi": 1000, "left_anti": 0}
    for enabled in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", enabled)
        try:
            assert {how: spread.spread_join(big, small, ["k"], how).count() for how in expected} == expected
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_oversized_key_is_split(spark):
    """With small limits adaptive execution splits the hot key of a join with an aggregate on the same keys."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"), "id")
        small = rows.groupBy("k").agg(F.max("id").alias("top"))
        out = spread.spread_join(rows, small, ["k"])
        assert out.count() == 200_000
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
