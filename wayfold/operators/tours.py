"""Tours: runs of trips from an anchor (home, work) and back to it, and what is known of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.clock import midpoint
from ..functions.recode import cases
from ..sources.diary import CHANGE, HOME, PERSON, WORK

#: Purposes that are counted: work, school, escort, personal business, shop, meal, social.
PURPOSES = {1: "wk", 2: "sc", 3: "es", 4: "pb", 5: "sh", 6: "ml", 7: "so"}

TOUR = [*PERSON, "tour"]


def leaves(anchor: int) -> Column:
    return (F.col("opurp") == anchor) & (F.col("dpurp") != anchor)


def returns(anchor: int) -> Column:
    return (F.col("opurp") != anchor) & (F.col("dpurp") == anchor)


def leaves_type(kind: int) -> Column:
    """Trips from a place of the kind (1 home, 2 usual work) to another one, by the types of settled ends."""
    return (F.col("otype") == kind) & (F.col("dtype") != kind)


def returns_type(kind: int) -> Column:
    return (F.col("otype") != kind) & (F.col("dtype") == kind)


def with_tours(trips: DataFrame, departs: Column, arrives: Column, keys: list[str] = PERSON, day: str = "day_ix", max_gap: int = 1, name: str = "tour") -> DataFrame:
    """trips with tour (from 1), start and end (seq) of the tour they belong to, null outside of tours.

    A tour goes from the last departure to the first arrival after it. Tours that take more than max_gap days don't
    count, and departures without an arrival neither. Windows only: trips that are dealt by household stay where they are.
    """
    p = W.partitionBy(*keys)
    w = p.orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    rows = trips.withColumns({"_d": departs, "_s": F.last(F.when(departs, F.col("seq")), ignorenulls=True).over(w), "_a": arrives})
    t = W.partitionBy(*keys, "_s")
    back = F.col("_a") & F.col("_s").isNotNull()
    rows = rows.withColumns({"_e": F.min(F.when(back, F.col("seq"))).over(t), "_from": F.min_by(day, "seq").over(t), "_to": F.min_by(F.when(back, F.col(day)), F.when(back, F.col("seq"))).over(t)})
    member = F.coalesce((F.col("seq") <= F.col("_e")) & (F.col("_to") - F.col("_from") <= max_gap), F.lit(False))
    rows = rows.withColumn("_m", member)
    number = F.sum((F.col("_m") & (F.col("seq") == F.col("_s"))).cast("int")).over(w).cast("int")
    only = lambda c: F.when(F.col("_m"), c)
    return rows.withColumns({name: only(number), "start": only(F.col("_s")), "end": only(F.col("_e"))}).drop("_d", "_s", "_a", "_e", "_from", "_to", "_m")


def extract_tours(trips: DataFrame, departs: Column, arrives: Column, keys: list[str] = PERSON, day: str = "day_ix", max_gap: int = 1) -> DataFrame:
    """keys, tour, start, end: one row per tour of with_tours."""
    return with_tours(trips, departs, arrives, keys, day, max_gap).where("seq = start").select(*keys, "tour", "start", "end")


def tour_trips(trips: DataFrame, departs: Column, arrives: Column, keys: list[str] = PERSON, day: str = "day_ix", max_gap: int = 1) -> DataFrame:
    """The trips of tours, with tour, start and end."""
    return with_tours(trips, departs, arrives, keys, day, max_gap).where("tour IS NOT NULL")


def priority(purpose: Column, student: Column | None = None) -> Column:
    """1 for work, 2 for school, 3 for escort, 4 for others; students put school before work."""
    student = F.lit(False) if student is None else student
    return cases((purpose == 1, F.when(student, 2).otherwise(1)), (purpose == 2, F.when(student, 1).otherwise(2)), (purpose == 3, 3), default=4)


def with_primary(members: DataFrame, keys: list[str] = TOUR, student: Column | None = None, usual: bool = False, extend: bool = True) -> DataFrame:
    """The trips of tours with pseq and pdpurp, the primary destination, and arrive and leave (seq).

    Of all trips but the one that closes the tour: the most important purpose, then the longest stay (act_dur), then
    the earliest. On work tours arrive and leave are the first arrival at work and the last departure from it, else
    the primary destination and the trip after it. With usual they are so at the usual workplace only (types of settled
    ends): the first arrival there up to the primary destination, the last departure after it. Without extend, no tour's
    stay is longer than its primary destination.
    """
    t = W.partitionBy(*keys)
    inner = F.col("seq") < F.col("end")
    order = F.struct(priority(F.col("dpurp"), student), -F.coalesce("act_dur", F.lit(0)), F.col("seq"))
    best = F.min_by(F.when(inner, F.struct("seq", "dpurp")), F.when(inner, order)).over(t)
    rows = members.withColumns({"_p": best, "_a": F.min(F.when(F.col("dpurp") == WORK, F.col("seq"))).over(t), "_l": F.max(F.when(F.col("opurp") == WORK, F.col("seq"))).over(t)})
    rows = rows.withColumns({"pseq": F.col("_p.seq"), "pdpurp": F.col("_p.dpurp")})
    work = F.col("pdpurp") == WORK
    if usual:
        seq = F.col("seq")
        first, last = F.min(F.when((F.col("dtype") == 2) & (seq <= F.col("pseq")), seq)).over(t), F.max(F.when((F.col("otype") == 2) & (seq > F.col("pseq")), seq)).over(t)
        rows = rows.withColumns({"_a": first, "_l": last, "_there": F.coalesce(F.max((seq == F.col("pseq")) & (F.col("dtype") == 2)).over(t), F.lit(False))})
        work &= F.col("_there")
    work &= F.lit(extend)
    return rows.withColumns({"arrive": F.when(work, F.col("_a")).otherwise(F.col("pseq")), "leave": F.when(work, F.coalesce("_l", F.col("pseq") + 1)).otherwise(F.col("pseq") + 1)}).drop("_p", "_a", "_l", "_there")


def primary_destination(members: DataFrame, keys: list[str] = TOUR, student: Column | None = None) -> DataFrame:
    """keys, pseq, pdpurp: one row per tour."""
    return with_primary(members, keys, student).where("seq = pseq").select(*keys, "pseq", "pdpurp")


def work_anchor(members: DataFrame, keys: list[str] = TOUR) -> DataFrame:
    """keys, pseq, pdpurp, arrive, leave: one row per tour."""
    return with_primary(members, keys).where("seq = pseq").select(*keys, "pseq", "pdpurp", "arrive", "leave")


def subtour_trips(members: DataFrame, keys: list[str] = TOUR, student: Column | None = None, usual: bool = False, max_gap: int = 1) -> DataFrame:
    """The trips of tours from work and back to it between the arrival at work and the last departure, with subtour, start, end.

    With usual, they go from the usual workplace (types of settled ends) and back to it.
    """
    rows = with_primary(members, keys, student, usual).where((F.col("pdpurp") == WORK) & (F.col("leave") > F.col("arrive") + 1))
    inside = rows.where("seq > arrive AND seq <= leave").drop("start", "end", "pseq", "pdpurp", "arrive", "leave")
    out, back = (leaves_type(2), returns_type(2)) if usual else (leaves(WORK), returns(WORK))
    return with_tours(inside, out, back, keys=keys, name="subtour", max_gap=max_gap).where("subtour IS NOT NULL")


def work_subtours(members: DataFrame, keys: list[str] = TOUR) -> DataFrame:
    """keys, subtour, start, end: one row for each of subtour_trips."""
    return subtour_trips(members, keys).where("seq = start").select(*keys, "subtour", "start", "end")


def with_halves(members: DataFrame, keys: list[str] = TOUR, student: Column | None = None, usual: bool = False, extend: bool = True) -> DataFrame:
    """with_primary, and half (1 out, 2 back, null for the stay at the primary destination) and tseg (from 1) in it."""
    rows = with_primary(members, keys, student, usual, extend).withColumn("half", F.when(F.col("seq") <= F.col("arrive"), 1).when(F.col("seq") >= F.col("leave"), 2))
    return rows.withColumn("tseg", F.row_number().over(W.partitionBy(*keys, "half").orderBy("seq")))


def half_tours(members: DataFrame, max_stops: int = 20, keys: list[str] = TOUR) -> DataFrame:
    """The trips outside the stay at the primary destination, at most max_stops each way."""
    return with_halves(members, keys).where((F.col("half").isNotNull()) & (F.col("tseg") <= max_stops))


def tour_summary(halved: DataFrame, max_stops: int = 20, keys: list[str] = TOUR) -> DataFrame:
    """One row per tour of with_halves: start, end, pseq, pdpurp, day, mode1, mode2, stops1, stops2, tmode, tpath.

    The mode of a half is its largest, with the path of the first such trip; the tour has the larger one, of equal ones
    the outbound one. The day is the one that most trips have, of equal ones the first. Of trips with settled ends and
    unwrapped clocks the ends come, too: leave_home, arrived, left, returned (structs of minute, type, parcel, zone, x, y).
    """
    rows = halved.withColumn("_k", F.count("*").over(W.partitionBy(*keys, "day")))
    on = lambda h: (F.col("half") == h) & (F.col("tseg") <= max_stops)
    out = rows.groupBy(*keys).agg(
        *(F.first(c).alias(c) for c in ("start", "end", "pseq", "pdpurp")), F.max_by("day", F.struct("_k", -F.col("day"))).alias("day"),
        *(F.max_by(F.when(on(h), F.struct("mode", "path")), F.when(on(h), F.struct("mode", -F.col("tseg")))).alias(f"_{h}") for h in (1, 2)),
        *(F.greatest(F.count_if(on(h)) - 1, F.lit(0)).alias(f"stops{h}") for h in (1, 2)), *_ends(halved.columns),
    )
    first = F.coalesce(F.col("_1.mode") >= F.col("_2.mode"), F.col("_2.mode").isNull())
    pick = lambda c: F.when(first, F.col(f"_1.{c}")).otherwise(F.col(f"_2.{c}"))
    return out.withColumns({"mode1": F.col("_1.mode"), "mode2": F.col("_2.mode"), "tmode": pick("mode"), "tpath": pick("path")}).drop("_1", "_2")


def _ends(columns: list[str]) -> list[Column]:
    """The four ends of a tour, each taken from the one trip that has it, in one aggregation."""
    if not {"otype", "dtype", "dep_min", "arr_min", "opcl", "dpcl", "otaz", "dtaz"} <= set(columns):
        return []
    of = lambda *names: F.struct(*(F.col(c).alias(n) for c, n in zip(names, ("minute", "type", "parcel", "zone", "x", "y"), strict=True)))
    origin, destination = of("dep_min", "otype", "opcl", "otaz", "ox", "oy"), of("arr_min", "dtype", "dpcl", "dtaz", "x", "y")
    ends = (("leave_home", "start", origin), ("arrived", "arrive", destination), ("left", "leave", origin), ("returned", "end", destination))
    return [F.max(F.when(F.col("seq") == F.col(at), place)).alias(name) for name, at, place in ends]


def order_tours(tours: DataFrame) -> DataFrame:
    """tour_no within the person: work tours, subtours, other purposes in their order, and those without one last.

    tours: pdpurp, subtour (0 for none), start. With a column tour, parent is the number of a subtour's tour (else 0),
    and subtrs counts a tour's subtours; of a subtour it is its number among them.
    """
    rank = cases((F.col("subtour") > 0, 2), (F.col("pdpurp") == WORK, 1), (F.col("pdpurp") > 0, 3), default=4)
    order = [rank, F.when(rank == 3, F.col("pdpurp")), "start", "subtour"]
    rows = tours.withColumn("tour_no", F.row_number().over(W.partitionBy(*PERSON).orderBy(*order)))
    if "tour" not in tours.columns:
        return rows
    own, sub = W.partitionBy(*TOUR), F.col("subtour") > 0
    return rows.withColumns({"parent": F.when(sub, F.max(F.when(~sub, F.col("tour_no"))).over(own)).otherwise(0), "subtrs": F.when(sub, F.col("subtour")).otherwise(F.count_if(sub).over(own).cast("int"))})


def person_day_pattern(trips: DataFrame, max_stops: int = 20, subtours: DataFrame | None = None) -> DataFrame:
    """Per person: beghom, endhom, and for each purpose tours and intermediate stops.

    trips: all trips of persons, as with_tours returns them. beghom and endhom are 1 unless a first origin or a last
    destination is known to be elsewhere. One pass over the trips of each person. A subtour (PERSON, pdpurp) counts as
    a stop of its purpose.
    """
    rows = with_primary(trips, TOUR)
    inside = F.col("tour").isNotNull()
    half = F.when(inside & (F.col("seq") <= F.col("arrive")), 1).when(inside & (F.col("seq") >= F.col("leave")), 2)
    rows = rows.withColumn("half", half)
    h = W.partitionBy(*TOUR, "half")
    rows = rows.withColumns({"_n": F.row_number().over(h.orderBy("seq")), "_all": F.least(F.count("*").over(h), F.lit(max_stops))})
    tour, stop = inside & (F.col("seq") == F.col("pseq")), F.col("half").isNotNull() & (F.col("_n") < F.col("_all"))
    counts = [F.count_if(kind & (F.col("dpurp") == p)).alias(f"{n}{name}") for name, kind in (("tours", tour), ("stops", stop)) for p, n in PURPOSES.items()]
    first, last = F.min_by("opurp", "seq"), F.max_by("dpurp", "seq")
    out = rows.groupBy(*PERSON).agg(F.coalesce((first == HOME).cast("int"), F.lit(1)).alias("beghom"), F.coalesce((last == HOME).cast("int"), F.lit(1)).alias("endhom"), *counts)
    if subtours is None:
        return out
    more = subtours.groupBy(*PERSON).agg(*(F.count_if(F.col("pdpurp") == p).alias(f"_{n}") for p, n in PURPOSES.items()))
    out = out.join(more, PERSON, "left")
    return out.withColumns({f"{n}stops": F.col(f"{n}stops") + F.coalesce(f"_{n}", F.lit(0)) for n in PURPOSES.values()}).drop(*(f"_{n}" for n in PURPOSES.values()))


def intermediate_stops(halves: DataFrame, keys: list[str] = TOUR) -> DataFrame:
    """The trips of half tours that end at a stop: all but the last one out and the last one back."""
    last = F.max("tseg").over(W.partitionBy(*keys, "half"))
    return halves.withColumn("_last", last).where("tseg < _last").drop("_last")


def split_drive_transit(halves: DataFrame, keys: list[str] = TOUR) -> DataFrame:
    """The first drive-transit trip of each half as two legs: drive and transit on the way out, the reverse back.

    The legs meet halfway in time at a change of mode; the second one begins a minute later if that is before it
    arrives. Later trips of the half move up by one. Of the columns path, tpath, otype, dtype, otaz, dtaz and role,
    those that are there are filled: the drive has path 0 and the transit leg the tour's (tpath, else its own), the
    change of mode has the type 6 and no zone or parcel (-1), and who drives is a driver (1). end_min of the first leg is
    when the second one begins.
    """
    w = W.partitionBy(*keys, "half")
    first = F.min(F.when(F.col("mode") == 7, F.col("tseg"))).over(w)
    rows = halves.withColumn("_first", first)
    half_way = midpoint(F.col("dep"), F.col("arr"))
    drive, transit, here = F.lit(3), F.lit(6), F.col("tseg") == F.col("_first")
    out = F.col("half") == 1
    leg = lambda n, mode, o, d, dep, arr: F.struct(F.lit(n).alias("n"), mode.alias("mode"), o.alias("opurp"), d.alias("dpurp"), dep.alias("dep"), arr.alias("arr"))
    change = F.lit(CHANGE)
    again = F.when(half_way + 1 < F.col("arr"), half_way + 1).otherwise(half_way)
    legs = F.when(
        here,
        F.array(
            leg(0, F.when(out, drive).otherwise(transit), F.col("opurp"), change, F.col("dep"), half_way),
            leg(1, F.when(out, transit).otherwise(drive), change, F.col("dpurp"), again, F.col("arr")),
        ),
    ).otherwise(F.array(leg(0, F.col("mode"), F.col("opurp"), F.col("dpurp"), F.col("dep"), F.col("arr"))))
    first_leg, second_leg, split = F.col("_leg.n") == 0, F.col("_leg.n") == 1, F.col("tseg") == F.col("_first")
    ride = F.col("tpath" if "tpath" in halves.columns else "path") if "path" in halves.columns else None
    known = {
        "path": lambda: F.when(split, F.when(F.col("_leg.mode") == transit, ride).otherwise(0)), "role": lambda: F.when(split, 1),
        "dtype": lambda: F.when(split & first_leg, 6), "otype": lambda: F.when(split & second_leg, 6), "dtaz": lambda: F.when(split & first_leg, -1), "otaz": lambda: F.when(split & second_leg, -1),
        "dpcl": lambda: F.when(split & first_leg, -1), "opcl": lambda: F.when(split & second_leg, -1), "end_min": lambda: F.when(split & first_leg, again),
    }
    rest = [c for c in halves.columns if c not in ("mode", "opurp", "dpurp", "dep", "arr", "tseg")]
    rest = [F.coalesce(known[c](), F.col(c)).alias(c) if c in known else F.col(c) for c in rest]
    shift = F.when(F.coalesce(F.col("tseg") > F.col("_first"), F.lit(False)), 1).otherwise(0) + F.col("_leg.n")
    return rows.withColumn("_leg", F.explode(legs)).select(*rest, (F.col("tseg") + shift).alias("tseg"), *(F.col(f"_leg.{c}").alias(c) for c in ("mode", "opurp", "dpurp", "dep", "arr")))


def relink_drive_transit(legs: DataFrame, keys: list[str] = TOUR) -> DataFrame:
    """Join a leg that ends at a change of mode with the next one of its half; the pair is drive-transit (7)."""
    w = W.partitionBy(*keys, "half").orderBy("tseg")
    joins = (F.lag("dpurp").over(w) == CHANGE) & (F.lag("tseg").over(w) == F.col("tseg") - 1) & (F.col("opurp") == CHANGE)
    rows = legs.withColumns({"_second": F.coalesce(joins, F.lit(False)), "_after": F.coalesce(F.lead(F.struct("opurp", "tseg")).over(w)["opurp"] == CHANGE, F.lit(False))})
    rows = rows.withColumn("_both", (F.col("dpurp") == CHANGE) & F.col("_after"))
    rows = rows.withColumns({c: F.when(F.col("_both"), F.lead(c).over(w)).otherwise(F.col(c)) for c in ("dpurp", "arr")})
    rows = rows.withColumn("mode", F.when(F.col("_both"), 7).otherwise(F.col("mode"))).where(~F.col("_second"))
    return rows.withColumn("tseg", F.row_number().over(w)).drop("_second", "_after", "_both")


def number_segments(rows: DataFrame, anchor: Column, keys: list[str] = PERSON, order: str = "seq", min_rows: int = 3, need_anchors: int = 1) -> DataFrame:
    """Segments between rows at an anchor: seg 1, 2, ..., and idx from 1 in each; a row at the anchor between two
    segments belongs to both and is doubled.

    seg is -2 for rows before the first anchor and -1 for segments under min_rows rows and for one that never returns.
    Groups with fewer than need_anchors rows at the anchor are left out.
    """
    w = W.partitionBy(*keys).orderBy(order)
    at = F.when(anchor, 1).otherwise(0)
    rows = rows.withColumns({"_at": at, "_n": F.sum(at).over(w.rowsBetween(W.unboundedPreceding, 0)), "_all": F.sum(at).over(W.partitionBy(*keys))})
    begins = F.when(F.col("_n") == 0, F.lit(-2)).otherwise(F.col("_n")).cast("int")
    both = F.when((F.col("_at") == 1) & (F.col("_n") > 1), F.array((F.col("_n") - 1).cast("int"), F.col("_n").cast("int"))).otherwise(F.array(begins))
    rows = rows.where(F.col("_all") >= need_anchors).withColumn("_seg", F.explode(both))
    s = W.partitionBy(*keys, "_seg")
    # the segment after the last anchor is open, and is only that one row if the last row is at the anchor
    rows = rows.withColumns({"_rows": F.count("*").over(s), "idx": F.row_number().over(s.orderBy(order))})
    open_end = (F.col("_seg") == F.col("_all")) & (F.col("_seg") > 0)
    seg = cases((F.col("_seg") == -2, -2), (open_end | (F.col("_rows") < min_rows), -1), default=F.col("_seg"))
    # a lone row at the last anchor closes the segment before and begins none
    lone = open_end & (F.col("_rows") == 1) & (F.col("_all") > 1)
    return rows.where(~lone).withColumn("seg", seg).drop("_at", "_n", "_all", "_seg", "_rows")
