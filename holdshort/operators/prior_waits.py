"""Mean wait of the last flights that left the same runway earlier on the same day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdshort.operators.spread import number_rows, spread_join
from holdshort.session import freeze

GROUP = ["runway", "_day"]
SLOT_S = 3600


def _registers(window, item: str, count: int):
    """Running top-`count` of the items in a window as nested running maxima.

    Whatever loses against the running maximum, on arrival or when displaced, moves on to the next register, so the
    next register's running maximum is the next largest item so far.
    """
    tops, steps, current = [], [], item
    for level in range(count):
        top = f"_top{level}"
        steps.append((top, F.max(current).over(window.rowsBetween(Window.unboundedPreceding, 0)),
                      F.max(current).over(window.rowsBetween(Window.unboundedPreceding, -1)), current, f"_lost{level}"))
        tops.append(top)
        current = f"_lost{level}"
    return tops, steps


def _with_registers(df: DataFrame, window, item: str, count: int) -> tuple[DataFrame, list[str]]:
    tops, steps = _registers(window, item, count)
    for top, running, before, current, lost in steps:
        df = df.withColumns({top: running, "_before": before})
        # the smaller of newcomer and old maximum; least() would skip a missing side
        loser = F.when(F.col(current).isNotNull() & F.col("_before").isNotNull(), F.least(current, "_before"))
        df = df.withColumn(lost, loser).drop("_before")
    return df, tops


def rolling_prior_mean(rows: DataFrame, last: int = 3, default: float = 170.0, slot_s: int = SLOT_S) -> DataFrame:
    """Add `prediction`: mean wait of the `last` most recent other flights on the same runway and day.

    A message counts once its take-off instant (time plus wait) has passed; each flight counts once, by its earliest
    message that counts; the most recent flights are those with the latest such message. Needs ts, runway, callsign
    and takeoff_time (seconds).

    The list of latest flights changes only where a flight's entry does, so it is made at those instants and not at
    every row; a row reads the last list before it. Flights enter a running top list when their earliest message counts,
    so no pairs of rows are formed. Messages of one flight may disagree about the instant: until the earliest message
    counts, a later one may stand in for it. Those spans are matched through canonical nodes and merged at the end.
    """
    keep = last + 1  # the row's own flight may be among them
    dated = rows.withColumns({"_day": F.to_date("ts"), "_t": F.unix_micros(F.col("ts").cast("timestamp"))})
    # both are read by several branches
    records = freeze(_records(dated, slot_s))
    tops = freeze(_top_settled(_changes(records, slot_s), keep))
    covered = tops.where("_covered")
    extra = _standins_at(covered.select(*GROUP, "_t"), records.where("_to IS NOT NULL"), keep)
    both = F.slice(F.sort_array(F.concat("_tops", "_extra"), asc=False), 1, keep)
    merged = covered.join(extra, [*GROUP, "_t"], "left").withColumn("_tops", F.coalesce(both, "_tops")).select(tops.columns)
    lists = tops.where("NOT _covered").unionByName(merged).select(*GROUP, "_t", _means(last).alias("_list"))
    own = F.coalesce(F.array_position("_list.flights", F.col("callsign")), F.lit(0)).cast("int")
    mean = F.coalesce(F.element_at("_list.means", own + 1), F.lit(float(default)))
    return _last_list(dated, lists, slot_s).withColumn("prediction", mean).select(*rows.columns, "prediction")


def _means(last):
    """The mean of the first `last` entries of a list, and behind it the means that leave out the first, second … flight."""
    entries = [F.get("_tops", F.lit(i)) for i in range(last + 1)]

    def mean(of):
        count = sum((e.isNotNull().cast("int") for e in of), F.lit(0))
        return F.when(count > 0, sum((F.coalesce(e["wait"], F.lit(0.0)) for e in of), F.lit(0.0)) / count)

    without = [mean(entries[:i] + entries[i + 1:]) for i in range(last)]
    return F.struct(F.array(*[e["callsign"] for e in entries[:last]]).alias("flights"),
                    F.array(mean(entries[:last]), *without).alias("means"))


def _slot_at(t, slot_s):
    return F.floor(t / F.lit(slot_s * 1_000_000)).cast("long")


def _day_end():
    return F.unix_micros(F.date_add("_day", 1).cast("timestamp"))


def _records(dated, slot_s):
    """Each flight's entries: the earliest of the messages that count, in the span (from, to] in which it is that.

    The last entry of a flight, its earliest message of all, has no end. A message is an entry if it is earlier than all
    messages that counted before; this is decided within time slots first, and then among what these leave.
    """
    wait_us = (F.col("takeoff_time") * 1_000_000).cast("long")
    said = dated.select(*GROUP, "callsign", "_t", "takeoff_time", F.greatest(F.col("_t"), F.col("_t") + wait_us).alias("_from"))
    said = said.where("runway IS NOT NULL AND _t IS NOT NULL AND takeoff_time IS NOT NULL AND callsign IS NOT NULL")
    said = said.withColumn("_slot", _slot_at(F.col("_from"), slot_s))
    flight = [*GROUP, "callsign"]
    for keys in ([*flight, "_slot"], flight):
        order = Window.partitionBy(*keys).orderBy("_from", "_t", "takeoff_time")
        earliest = F.min("_t").over(order.rowsBetween(Window.unboundedPreceding, -1))
        said = said.withColumn("_best", earliest).where("_best IS NULL OR _t < _best")
    spans = said.select(*flight, "_from", F.lead("_from").over(order).alias("_to"), _entry("_t", "takeoff_time").alias("_item"))
    return spans.where(F.col("_from") < _day_end())


def _changes(records, slot_s):
    """Instants from which on a list holds: behind each entry's beginning, and at the slots after a group's first one.

    A flight's last entry is there to stay and comes along as `_item`; the others come with the end of their span.
    """
    behind = records.select(*GROUP, (F.col("_from") + 1).alias("_t"), F.when(F.col("_to").isNull(), F.col("_item")).alias("_item"), "_to")
    first = records.groupBy(*GROUP).agg(F.min("_from").alias("_first"))
    slots = F.sequence(_slot_at(F.col("_first"), slot_s) + 1, _slot_at(_day_end(), slot_s) + 1)
    starts = first.select(*GROUP, F.explode(F.transform(slots, lambda n: (n * F.lit(slot_s * 1_000_000)).cast("long"))).alias("_t"))
    return behind.unionByName(starts, allowMissingColumns=True).withColumn("_slot", _slot_at(F.col("_t"), slot_s))


def _last_list(dated, lists, slot_s):
    """Add `_list`, the last list at or before each row; each slot has one at its beginning unless none is earlier."""
    # rows without a time have no list and may be anywhere
    slot = F.coalesce(_slot_at(F.col("_t"), slot_s), F.spark_partition_id())
    # at one instant a list sorts before the rows
    merged = dated.withColumn("_kind", F.lit(1)).unionByName(lists.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    order = Window.partitionBy(*GROUP, "_slot").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return merged.withColumn("_slot", slot).withColumn("_list", F.last("_list", ignorenulls=True).over(order)).where("_kind = 1")


def _entry(t, wait):
    return F.struct(F.col(t).alias("t"), F.col("callsign").alias("callsign"), F.col(wait).cast("double").alias("wait"))


def _top_settled(changes, keep):
    """Top list of settled flights at each instant of change: per slot, with the list of earlier slots carried in.

    Adds whether the instant is within the span of a stand-in: whether the latest end of those begun is not before it.
    """
    # the largest arrivals of each slot
    order = Window.partitionBy(*GROUP, "_slot").orderBy(F.desc("_item"))
    ends = changes.where("_item IS NOT NULL").withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= keep)
    # the list before each slot: the same running list over at most `keep` items per slot
    slots = changes.groupBy(*GROUP, "_slot").agg(F.max("_to").alias("_to")).withColumn("_kind", F.lit(0))
    steps = slots.unionByName(ends.select(*GROUP, "_slot", "_item", F.lit(1).alias("_kind")), allowMissingColumns=True)
    over_slots = Window.partitionBy(*GROUP).orderBy("_slot", "_kind", "_item")
    earlier = F.max("_to").over(over_slots.rowsBetween(Window.unboundedPreceding, -1))
    before, names = _with_registers(steps.withColumn("_to", earlier), over_slots, "_item", keep)
    carried = before.where("_kind = 0").select(
        *GROUP, "_slot", "_to", F.explode(F.array(*names)).alias("_item"), F.lit(-(2**62)).cast("long").alias("_t")).where(
        "_item IS NOT NULL OR _to IS NOT NULL")

    in_slot = Window.partitionBy(*GROUP, "_slot").orderBy("_t", "_item")
    until = F.max("_to").over(in_slot.rowsBetween(Window.unboundedPreceding, 0))
    merged = changes.unionByName(carried).withColumns({"_until": until, "_next": F.lead("_t").over(in_slot)})
    full, names = _with_registers(merged, in_slot, "_item", keep)
    # the last row of an instant has all that enters there
    full = full.where(f"_t > {-(2**62)} AND (_next IS NULL OR _next > _t)")
    return full.select(*GROUP, "_t", F.array(*names).alias("_tops"), F.coalesce(F.col("_until") >= F.col("_t"), F.lit(False)).alias("_covered"))


#: Nodes of an interval tree over places 0, 1, 2 … that together cover the places from `_lo` to below `_hi`: at each level
#: at most one at either end, so twice the logarithm of the number of places.
CANONICAL = """filter(flatten(transform(sequence(0, cast(ceil(log2(_hi + 1)) AS int)), k -> transform(
  array(named_struct('lo', shiftright(_lo + shiftleft(1L, k) - 1, k), 'hi', shiftright(_hi, k))), e -> array(
    if(e.lo < e.hi AND e.lo % 2 = 1, named_struct('level', k, 'node', e.lo), NULL),
    if(e.lo < e.hi AND e.hi % 2 = 1, named_struct('level', k, 'node', e.hi - 1), NULL)))[0])), x -> x IS NOT NULL)"""


def _standins_at(points, standins, keep):
    """The `keep` latest stand-ins at each point (from < point <= to), by canonical nodes instead of a range join.

    Points are numbered within their group, and a span becomes a range of numbers; both come from one running count.
    A span goes to the few nodes that cover its range, each node keeps its latest `keep` spans, and a point reads the
    nodes above it. Rows grow with the logarithm of the group, whatever number of spans is open at one time.
    """
    ends = standins.select(*GROUP, F.explode(F.array("_from", "_to")).alias("_t"), F.lit(0).alias("_n")).distinct()
    # at one instant points come first: a span begins behind and ends with the points of its instant
    places = number_rows(points.select(*GROUP, "_t", F.lit(1).alias("_n")).unionByName(ends), ["_t", F.col("_n").desc()], GROUP,
                         name="_place", weight="_n")
    at_end = places.where("_n = 0").select(*GROUP, "_t", F.col("_place").cast("long").alias("_place"))
    spans = standins.select(*GROUP, "_from", "_to", "_item")
    low = at_end.withColumnsRenamed({"_t": "_from", "_place": "_lo"})
    high = at_end.withColumnsRenamed({"_t": "_to", "_place": "_hi"})
    ranged = spread_join(spread_join(spans, low, [*GROUP, "_from"]), high, [*GROUP, "_to"]).where("_lo < _hi")
    noded = ranged.select(*GROUP, "_item", F.explode(F.expr(CANONICAL)).alias("_at")).select(
        *GROUP, F.col("_at.level").alias("_level"), F.col("_at.node").alias("_node"), "_item")
    node = [*GROUP, "_level", "_node"]
    latest = noded.withColumn("_r", F.row_number().over(Window.partitionBy(*node).orderBy(F.desc("_item")))).where(
        F.col("_r") <= keep)
    tops = freeze(latest.groupBy(*node).agg(F.collect_list("_item").alias("_items")))
    height = tops.groupBy(*GROUP).agg(F.max("_level").alias("_height"))
    numbered = places.where("_n = 1").select(*GROUP, "_t", (F.col("_place") - 1).cast("long").alias("_place"))
    above = spread_join(numbered, height, GROUP).select(
        *GROUP, "_t", "_place", F.explode(F.sequence(F.lit(0), F.col("_height"))).alias("_level")).select(
        *GROUP, "_t", "_level", F.expr("shiftright(_place, _level)").alias("_node"))
    hit = spread_join(above, tops, node)
    latest_of = F.slice(F.sort_array(F.flatten(F.collect_list("_items")), asc=False), 1, keep)
    return hit.groupBy(*GROUP, "_t").agg(latest_of.alias("_extra"))
