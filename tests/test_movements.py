import random

from conftest import seconds
from pyspark.sql import functions as F

from holdshort.functions import geo, labels, timing
from holdshort.operators import movements, prior_waits, spread


def test_previous_and_next_equal_plain_windows(spark, table):
    from pyspark.sql import Window
    rnd = random.Random(1)
    rows = sorted({(rnd.choice("abc"), float(rnd.randrange(0, 40_000))) for _ in range(300)})
    df = table([(k, t, int(t) % 7) for k, t in rows], "k string, ts ts, v int")
    got = spread.next_in_time(spread.previous_in_time(df, ["k"], ["v"], ["p"]), ["k"], ["v"], ["n"])
    w = Window.partitionBy("k").orderBy("ts")
    want = df.withColumns({"p": F.lag("v").over(w), "n": F.lead("v").over(w)})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_number_rows_is_exact_for_hot_keys_and_nulls(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, F.col("id").cast("string")).alias("k"), "id")
    rows = spread.number_rows(df, ["id"], ["k"], parts=7).collect()
    hot = sorted((r.id, r.seq) for r in rows if r.k == "hot")
    none = sorted((r.id, r.seq) for r in rows if r.k is None)
    assert len(rows) == 5000
    assert [s for _, s in hot] == list(range(1, 3501)) and [s for _, s in none] == list(range(1, 501))


def test_sequences_cross_blocks(spark, monkeypatch):
    df = spark.range(50).select(F.lit("a").alias("k"), "id")
    original = spread.with_halo
    monkeypatch.setattr(movements, "with_halo", lambda n, before, seq="seq": original(n, before, seq, 8))
    out = movements.sequences(df, 3, ["id"], ["k"], ["id"]).orderBy("id").collect()
    assert [(r.id, r.steps) for r in out] == [(i, [i - 3, i - 2, i - 1]) for i in range(3, 50)]
    own = movements.sequences(df, 3, ["id"], ["k"], ["id"], include_self=True).orderBy("id").collect()
    assert [(r.id, r.steps) for r in own] == [(i, [i - 2, i - 1, i]) for i in range(2, 50)]


POS = "ts ts, icao string, callsign string, flight_status string, designator string, runway string, speed double"


def test_flight_phases(table):
    rows = table([
        (10.0, "A", "X1", "on-ground", None, None, 5.0),
        (20.0, "A", "X1", "on-ground", "Z1", "36L/18R", 3.0),
        (30.0, "A", "X1", "on-ground", "Z1", "36L/18R", 0.0),
        (40.5, "A", "X1", "on-ground", "Z1", "36L/18R", 0.0),
        (90.0, "A", "X1", "airborne", None, None, None),
        (95.0, "A", "X1", "airborne", None, None, None),
        (10.0, "B", "Y1", "on-ground", None, None, 0.0),      # never at a holding point
        (10.0, "C", "W1", "on-ground", "Z2", "36L/18R", 0.0),  # never airborne
    ], POS)
    segment = movements.flight_window(rows)
    assert sorted(map(str, segment.collect())) == sorted(map(str, movements.takeoff_segment(movements.first_times(rows)).select(segment.columns).collect()))
    assert sorted(seconds(r, "ts") for r in segment.collect()) == [20.0, 30.0, 40.5, 90.0]
    held = sorted(movements.stopped_waits(segment).collect(), key=lambda r: r.ts)
    assert [(r.takeoff_time, r.time_before_holding_point, r.time_at_holding_point) for r in held] == [(60.0, 20.0, 0.0), (50.0, 20.0, 10.0)]
    scenario = movements.flight_window(rows, scenario=True)
    assert {r.callsign for r in scenario.collect()} == {"X1", "W1"}


def test_days_are_separate(table):
    day = 86400.0
    rows = table([(10.0, "A", "X", "on-ground", "Z1", "r", 0.0), (day + 5, "A", "X", "airborne", None, None, None)], POS)
    assert movements.flight_window(rows).count() == 0
    assert movements.flight_window(rows, per_day=False).count() == 2


def test_runway_events(table):
    rows = table([
        (1.0, "A", "on-ground", "H", "r1", None), (2.0, "A", "airborne", "H", None, "r2"), (3.0, "A", None, "H", None, "r2"),
        (4.0, "A", "on-ground", "H", None, "r2"), (5.0, "A", "airborne", "H", None, None), (9000.0, "A", "on-ground", "H", "r3", None),
    ], "ts ts, icao string, flight_status string, wake_category string, runway string, runway_from_position string")
    got = sorted((seconds(r, "ts"), r.runway, r.event) for r in movements.runway_events(rows).collect())
    # the status lost at 3 hides the landing at 4; the take-off at 5 has no runway
    assert got == [(2.0, "r2", "takeoff"), (9000.0, "r3", "landing")]


def naive_prior_mean(rows):
    out = []
    for t, c, r, w in rows:
        seen = {}
        for u, c2, r2, w2 in sorted(rows):
            if r2 == r and c2 != c and u < t and u + w2 < t and int(u // 86400) == int(t // 86400):
                seen.setdefault(c2, (u, w2))
        best = sorted(((u, c2, w2) for c2, (u, w2) in seen.items()), reverse=True)[:3]
        out.append(round(sum(x[2] for x in best) / len(best), 6) if best else 170.0)
    return out


def test_rolling_prior_mean_equals_brute_force(table):
    rnd = random.Random(8)
    for spread_s, waits in ((4000, (10, 300)), (90_000, (20, 900)), (300, (1, 200))):
        rows, used = [], set()
        for _ in range(250):
            t = round(rnd.uniform(0, spread_s), 1)
            row = (t, f"C{rnd.randrange(25)}", rnd.choice(["r1", "r2"]))
            if row in used:
                continue
            used.add(row)
            rows.append((*row, float(rnd.randint(*waits))))
        df = table(rows, "ts ts, callsign string, runway string, takeoff_time double")
        got = {(round(seconds(r, "ts"), 1), r.callsign, r.runway): round(r.prediction, 6) for r in prior_waits.rolling_prior_mean(df, slot_s=600).collect()}
        assert [got[row[:3]] for row in rows] == naive_prior_mean(rows)


def test_rolling_prior_mean_makes_lists_only_where_entries_change(table, monkeypatch):
    """Many messages of few flights: what is numbered is bounded by the flights' entries, not by the messages."""
    numbered, original = [], spread.number_rows

    def counted(df, *args, **kwargs):
        numbered.append(df.count())
        return original(df, *args, **kwargs)

    monkeypatch.setattr(prior_waits, "number_rows", counted)
    for standins in (False, True):
        # with stand-ins, the sixth message counts first, then the fifth, and so on up to the first
        rows = [(80.0 * i + 3 * f, f"C{f}", "r", 600.0 - 100 * i if standins and i < 5 else 60.0) for f in range(6) for i in range(200)]
        df = table(rows, "ts ts, callsign string, runway string, takeoff_time double")
        got = {(round(seconds(r, "ts"), 1), r.callsign): round(r.prediction, 6) for r in prior_waits.rolling_prior_mean(df).collect()}
        assert [got[row[:2]] for row in rows] == naive_prior_mean(rows)
        entries = 36 if standins else 6
        assert numbered.pop() <= 3 * entries < len(rows) / 10


def brute_prior_mean(rows, last):
    out = []
    for t, c, r, _ in rows:
        seen = {}
        for u, c2, r2, w2 in sorted(rows):
            if r2 == r and c2 != c and u < t and u + w2 < t and u // 86400 == t // 86400:
                seen.setdefault(c2, (u, c2, w2))
        best = sorted(seen.values(), reverse=True)[:last]
        out.append(round(sum(x[2] for x in best) / len(best), 6) if best else 170.0)
    return out


def test_rolling_prior_mean_spans_slots_days_and_ties(table):
    """Stand-ins over many slots, waits past midnight, equal instants, repeated rows and waits below zero."""
    rnd = random.Random(5)
    for flights, waits in ((4, (1, 20_000)), (12, (-300, 900)), (3, (1, 200))):
        rows = [(float(rnd.randrange(70_000, 110_000, 50)), f"C{rnd.randrange(flights)}", rnd.choice(["r1", "r2"]), float(rnd.randint(*waits)))
                for _ in range(300)]
        rows += rows[:20]
        df = table(rows, "ts ts, callsign string, runway string, takeoff_time double")
        for last in (1, 3):
            out = prior_waits.rolling_prior_mean(df, last=last, slot_s=600)
            got = sorted((seconds(r, "ts"), r.callsign, r.runway, r.takeoff_time, round(r.prediction, 6)) for r in out.collect())
            assert got == sorted((*row, mean) for row, mean in zip(rows, brute_prior_mean(rows, last)))


def test_rolling_prior_mean_keeps_rows_without_keys(table):
    rows = [(10.0, "A", "r", 5.0), (100.0, "B", "r", None), (100.0, None, "r", 1.0), (100.0, "A", "r", 50.0),
            (100.0, "B", None, 1.0), (None, "B", "r", 1.0), (200.0, "C", "r", 9.0)]
    df = table(rows, "ts ts, callsign string, runway string, takeoff_time double")
    got = [r.prediction for r in prior_waits.rolling_prior_mean(df, slot_s=60).orderBy("ts", "runway", "callsign").collect()]
    # no time; A at 10; no runway; no callsign, A at 100, B at 100; C
    assert got == [170.0, 170.0, 170.0, 5.0, 170.0, 5.0, 5.0]


def test_centre_of_the_airport_is_inside(spark):
    from holdshort import airport
    row = spark.createDataFrame([airport.CENTRE], "lat double, lon double").select(geo.within_airport("lat", "lon").alias("x"), geo.great_circle_m("lat", "lon", "lat", "lon").alias("d")).first()
    assert row.x and row.d < 1


def test_holding_point_first_in_list(spark):
    from holdshort import airport
    rows = spark.createDataFrame([(p[3], p[2], p[0]) for p in airport.HOLDING_POINTS], "lat double, lon double, name string")
    assert all(r.name == r.hp.designator for r in rows.withColumn("hp", geo.holding_point("lat", "lon")).collect())
    none = rows.select((F.col("lat") + 0.0002).alias("lat"), "lon").limit(1).select(geo.holding_point("lat", "lon")["designator"].alias("hp")).first()
    assert none.hp is None


def test_buckets_on_the_boundary(table):
    row = table([(120.0,), (120.5,), (121.0,)], "ts ts").select(F.unix_seconds(timing.ceil_s("ts", 60)).alias("c"), F.unix_seconds(timing.floor_s("ts", 60)).alias("f")).collect()
    assert [tuple(r) for r in row] == [(120, 120), (120, 120), (180, 120)]


def test_labels(spark):
    row = spark.range(1).select(
        labels.strip_parenthesised(F.lit("Heavy (a) b (c)")).alias("a"), labels.strip_parenthesised(F.lit("Heavy (a) b (c)"), greedy=False).alias("b"),
        labels.wait_class(F.lit(29.9)).alias("c"), labels.wait_class(F.lit(500)).alias("d"), labels.wait_class(F.lit(None).cast("double")).alias("e")).first()
    assert tuple(row) == ("Heavy", "Heavy b", 0, 6, 6)
    assert spark.range(1).select(geo.runway_label(F.lit("14L/32R"))).first()[0] == "32R/14L"


def test_thin_trajectory(table):
    rows = table([("X", float(i), 10.0, 40.51, -3.53) for i in range(60)], "callsign string, ts ts, speed double, lat double, lon double")
    assert sorted(seconds(r, "ts") for r in movements.thin_trajectory(rows).collect()) == [0.0, 10.0, 20.0, 30.0, 40.0, 50.0]


def test_state_durations(table):
    rows = table([("A", 0.0, "on-ground"), ("A", 10.0, "airborne"), ("B", 5.0, "on-ground"), ("B", 7200.0, None)], "icao string, ts ts, flight_status string")
    got = {r.icao: (r.ground_s, r.airborne_s) for r in movements.state_durations(rows).collect()}
    assert got == {"A": (10.0, 7190.0), "B": (7195.0, 0.0)}


def test_time_slices_share_edges(table):
    rows = table([(0.0,), (30.0,), (31.0,), (120.0,)], "ts ts")
    got = sorted((seconds(r, "slice_ts"), seconds(r, "ts")) for r in movements.position_time_slices(rows, 1).collect())
    assert got == [(0.0, 0.0), (0.0, 30.0), (60.0, 30.0), (60.0, 31.0), (120.0, 120.0)]


def test_sequences_longer_than_a_block(spark, monkeypatch):
    real = spread.with_halo
    monkeypatch.setattr(movements, "with_halo", lambda *a, **k: real(*a, **(k | {"block_rows": 8})))
    rows = spark.range(40).select(F.lit("a").alias("k"), F.col("id").alias("t"))
    got = {r.t: list(r.steps) for r in movements.sequences(rows, 20, ["t"], ["k"], ["t"]).collect()}
    assert got == {t: list(range(t - 20, t)) for t in range(20, 40)}


def test_rows_at_one_time_have_one_order(spark):
    rows = spark.createDataFrame([("a", 5, i * 7 % 30) for i in range(30)], "icao string, ts int, x int")
    for parts in (1, 7):
        got = movements.sequence_number(rows.repartition(parts)).collect()
        assert {r.x: r.row_num for r in got} == {x: x + 1 for x in range(30)}
