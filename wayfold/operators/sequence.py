"""Ordered trips of persons: neighbours, durations, linked chains and unwrapped clocks.

Windows are partitioned by the household first, so that one shuffle serves person and household operators. Where a
result depends on itself, a running value says so (clocks), or rows are cut into blocks that are composed as functions
of what they are entered with (chains).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.clock import DAY
from ..functions.numeric import near_equal
from ..functions.recode import cases
from ..sources.diary import CHANGE, HOME, PERSON, WORK

WALK, DRIVE, TRANSIT, DRIVE_TRANSIT = (0, 1, 2), (3, 4, 5, 9), 6, 7
OTHER = 4
#: Rows of a block, and blocks of a group, that linked chains are worked through in. Modes are numbers below MODES.
BLOCK, MODES = 128, 16


def by_person(order: str = "seq", keys: list[str] = PERSON) -> W:
    return W.partitionBy(*keys).orderBy(order)


def flag_ends(trips: DataFrame, keys: list[str], order: str = "seq", prefix: str = "") -> DataFrame:
    """1 for the first and the last row of each group, as columns first and last with a prefix."""
    w = W.partitionBy(*keys)
    return trips.withColumns({f"{prefix}first": (F.col(order) == F.min(order).over(w)).cast("int"), f"{prefix}last": (F.col(order) == F.max(order).over(w)).cast("int")})


def next_if_consecutive(trips: DataFrame, columns: list[str], order: str = "seq", keys: list[str] = PERSON) -> DataFrame:
    """next_<column> of the following row if its number is one higher, else null; has_next 1 or 0."""
    w = by_person(order, keys)
    after = F.when(F.lead(order).over(w) == F.col(order) + 1, F.lead(F.struct(*columns)).over(w))
    out = trips.withColumn("_next", after)
    return out.withColumns({**{f"next_{c}": F.col(f"_next.{c}") for c in columns}, "has_next": F.col("_next").isNotNull().cast("int")}).drop("_next")


def activity_duration(trips: DataFrame) -> DataFrame:
    """act_dur: minutes from arrival to the next departure; past midnight if the next trip is the next day's first."""
    out = next_if_consecutive(trips, ["dep", "day_ix"])
    gap = F.col("next_dep") - F.col("arr")
    return out.withColumn("act_dur", F.when((F.col("next_day_ix") > F.col("day_ix")) & (gap < 0), gap + DAY).otherwise(gap)).drop("next_dep", "next_day_ix")


def linked_mode(a: Column, b: Column, minutes: Column, limit: int, short: int) -> Column:
    """The mode of two segments as one, null if they aren't linked."""
    walk, drive, transit = (lambda c: c.isin(*WALK)), (lambda c: c.isin(*DRIVE)), (lambda c: c.isin(TRANSIT, DRIVE_TRANSIT))
    soon = minutes <= limit
    feeder = lambda x, y: (walk(x) | drive(x)) & transit(y)
    return cases(
        (soon & ((walk(a) & (b == TRANSIT)) | ((a == TRANSIT) & walk(b))), TRANSIT),
        (soon & (feeder(a, b) | feeder(b, a)), DRIVE_TRANSIT),
        ((soon & transit(a) & transit(b)) | (minutes <= short), F.greatest(a, b)),
    )


def chain_heads(trips: DataFrame, limit: int = 35, short: int = 15) -> DataFrame:
    """trips (with act_dur, has_next) with chain (the head's seq), chain_mode so far, and linked_on: 1 if the next joins.

    A row whose purpose is a change of mode can be linked to the next one. Rows up to the first one that cannot are an
    island. Whether a row joins depends on the mode that its chain has come to, so an island's rows depend on each
    other; they are worked through in blocks of BLOCK rows. A block is a function of the mode that it is entered with,
    held as an array over MODES. Functions of blocks are composed within groups of BLOCK blocks and these over the
    island, which tells every block its mode; only then are the rows of a block, all blocks alike, looked at one by one.
    """
    w = by_person()
    so_far = w.rowsBetween(W.unboundedPreceding, 0)
    can = (F.col("dpurp") == CHANGE) & (F.col("has_next") == 1)
    rows = trips.withColumns({"_in": F.lag(F.when(can, F.coalesce("act_dur", F.lit(DAY * 10)))).over(w), "_block": F.expr(f"cast((row_number() OVER (PARTITION BY {', '.join(PERSON)} ORDER BY seq) - 1) div {BLOCK} AS int)")})
    rows = rows.withColumn("_island", F.sum(F.col("_in").isNull().cast("int")).over(so_far))
    rest = [c for c in rows.columns if c not in (*PERSON, "seq", "_island", "_block")]
    blocks = rows.groupBy(*PERSON, "_island", "_block").agg(F.array_sort(F.collect_list(F.struct("seq", *rest))).alias("rows"))

    join = lambda mode, r: linked_mode(mode, r["mode"], r["_in"], limit, short)
    same = F.array(*map(F.lit, range(MODES)), F.lit(None).cast("int"))
    at = lambda f, mode: F.get(f, F.when(mode.between(0, MODES - 1), mode).otherwise(MODES))
    then = lambda f, g: F.transform(f, lambda mode: at(g, mode))
    of_island, of_group = (W.partitionBy(*PERSON, "_island", *more) for more in ([], ["_group"]))
    before = lambda v: v.rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("_group", F.expr(f"_block div {BLOCK}")).withColumn("_more", F.count("*").over(of_island) > 1)
    blocks = blocks.withColumn("_f", F.when(F.col("_more"), F.aggregate("rows", same, lambda f, r: F.transform(f, lambda mode: F.coalesce(join(mode, r), r["mode"]).cast("int")))))
    in_group = of_group.orderBy("_block")
    blocks = blocks.withColumns({"_before": F.collect_list("_f").over(before(in_group)), "_last": F.lead("_block").over(in_group).isNull()})
    blocks = blocks.withColumn("_to", F.when(F.col("_more"), F.aggregate("_before", same, then))).drop("_before")
    blocks = blocks.withColumn("_groups", F.collect_list(F.when(F.col("_last"), then(F.col("_to"), F.col("_f")))).over(before(of_island.orderBy("_group", "_block"))))
    entered = F.when(F.col("_more"), at(F.col("_to"), F.aggregate("_groups", F.lit(None).cast("int"), lambda mode, f: at(f, mode))))

    entry = "array<struct<chain:int,chain_mode:int>>"
    state = F.struct(F.lit(None).cast("int").alias("chain"), F.col("_entered").alias("mode"), F.array().cast(entry).alias("out"))

    def step(s: Column, r: Column) -> Column:
        both = join(s["mode"], r)
        chain, mode = F.when(both.isNotNull(), s["chain"]).otherwise(r["seq"]).cast("int"), F.coalesce(both, r["mode"]).cast("int")
        return F.struct(chain.alias("chain"), mode.alias("mode"), F.concat(s["out"], F.array(F.struct(chain.alias("chain"), mode.alias("chain_mode")))).alias("out"))

    # rows and results go on together, so nothing is joined back; a chain that an earlier block began is filled in
    done = blocks.withColumn("_entered", entered).select(*PERSON, "rows", F.aggregate("rows", state, step, lambda s: s["out"]).alias("out"))
    out = done.select(*PERSON, F.explode(F.arrays_zip("rows", "out")).alias("z")).select(*PERSON, "z.rows.*", "z.out.*").select(*trips.columns, "chain", "chain_mode")
    out = out.withColumn("chain", F.last("chain", ignorenulls=True).over(so_far))
    return out.withColumn("linked_on", F.coalesce((F.lead("chain").over(w) == F.col("chain")).cast("int"), F.lit(0)))


def link_chains(trips: DataFrame, limit: int = 35, short: int = 15, recode_dangling: bool = False) -> DataFrame:
    """journeys() of the chains of trips."""
    return journeys(chain_heads(trips, limit, short), recode_dangling)


def journeys(chains: DataFrame, recode_dangling: bool = False) -> DataFrame:
    """One row per journey: origin of its first segment, destination of its last, mode, largest path, segments.

    A journey that ends at a change of mode gets the purpose 4, unless segments were linked and no next one exists
    (then it stays 10, or becomes 4 with recode_dangling). Zones, parcels and role are taken along if there are any. A single segment that is no change of mode and begins at
    one gets the origin purpose 4 if it is the person's first or the last trip was the same day or the day before.
    """
    w = by_person()
    rows = chains.withColumn("_gap", F.col("day_ix") - F.lag("day_ix").over(w))
    at = lambda c, f: f(c, "seq").alias(c)
    heads, tails = ["day", "day_ix", "dep", "opurp", "ox", "oy", "_gap"], ["arr", "dpurp", "x", "y", "has_next"]
    heads, tails = heads + [c for c in ("otaz", "opcl", "role") if c in chains.columns], tails + [c for c in ("dtaz", "dpcl") if c in chains.columns]
    out = rows.groupBy(*PERSON, "chain").agg(
        *(at(c, F.min_by) for c in heads), *(at(c, F.max_by) for c in tails), F.max_by("chain_mode", "seq").alias("mode"), F.max("path").alias("path"), F.count("*").alias("segments")
    )
    stays = (F.col("segments") > 1) & (F.col("has_next") == 0) & F.lit(not recode_dangling)
    renamed = (F.col("segments") == 1) & (F.col("dpurp") != CHANGE) & (F.col("opurp") == CHANGE) & (F.coalesce("_gap", F.lit(0)) <= 1)
    out = out.withColumns({"opurp": F.when(renamed, OTHER).otherwise(F.col("opurp")), "dpurp": F.when((F.col("dpurp") == CHANGE) & ~stays, OTHER).otherwise(F.col("dpurp"))})
    return out.withColumn("trip", F.row_number().over(by_person("chain"))).drop("_gap", "has_next")


def access_egress(chains: DataFrame) -> DataFrame:
    """Of each journey whose first link made it transit: how it was reached and left, and where it led from and to.

    chains: rows of chain_heads with mode_type.
    """
    second = F.row_number().over(W.partitionBy(*PERSON, "chain").orderBy("seq"))
    rows = chains.withColumn("_n", second)
    out = rows.groupBy(*PERSON, "chain").agg(
        F.min_by("mode_type", "seq").alias("acc_mode"), F.max_by("mode_type", "seq").alias("egr_mode"),
        F.min_by("ox", "seq").alias("otaz"), F.max_by("x", "seq").alias("dtaz"),
        F.max(F.when(F.col("_n") == 2, F.col("chain_mode"))).alias("_first_link"),
    )
    return out.where(F.col("_first_link").isin(TRANSIT, DRIVE_TRANSIT)).drop("_first_link")


def linked_detail(chains: DataFrame) -> DataFrame:
    """Every segment with del_flag: 1 if it was absorbed by the one before."""
    return chains.withColumn("del_flag", (F.col("seq") != F.col("chain")).cast("int"))


def classify_ends(trips: DataFrame) -> DataFrame:
    """otype, dtype: 1 home, 2 work, 4 other, 5 missing, by purpose and by places (hx, hy, wx, wy; -1 is missing).

    An origin is the last destination, unless the trip is the first or more than a day passed; then what was reported
    counts (rpurp, rx, ry), and an origin of no known kind gets the purpose 4.
    """
    same = lambda a, b, c, d: near_equal(F.col(a), F.col(c)) & near_equal(F.col(b), F.col(d))
    known = lambda a, b: (F.col(a) != -1) & (F.col(b) != -1)
    dtype = cases(
        ((F.col("dpurp") == HOME) | (same("x", "y", "hx", "hy") & known("x", "y")), 1),
        ((F.col("dpurp") == WORK) | (same("x", "y", "wx", "wy") & known("x", "y")), 2),
        (known("x", "y"), 4),
        default=5,
    )
    w = by_person()
    rows = trips.withColumn("dtype", dtype)
    chained = F.coalesce(F.col("day_ix") - F.lag("day_ix").over(w) <= 1, F.lit(False))
    reported = cases(((F.col("rpurp") == HOME) | (same("rx", "ry", "hx", "hy") & known("rx", "ry")), 1), (F.col("rpurp") == WORK, 2), default=5)
    otype = F.when(chained, F.lag("dtype").over(w)).otherwise(reported)
    rows = rows.withColumns({"otype": otype, "chained": chained.cast("int")})
    return rows.withColumn("opurp", cases((F.col("chained") == 1, F.col("opurp")), (F.col("otype") == 1, HOME), (F.col("otype") == 2, WORK), default=OTHER))


def settle_ends(trips: DataFrame) -> DataFrame:
    """trips with otype and dtype (1 home, 2 usual work, 4 other, 5 missing) and both ends written over by what is known.

    trips: both ends (ox, oy, otaz, opcl; x, y, dtaz, dpcl) as reported, and the person's places (hx, hy, htaz, hpcl;
    wx, wy, wtaz, wpcl); -1 is missing. A destination at home gets the zone and parcel of the home. An origin is the
    last destination, with its purpose; of the first trip, and after a day without trips, it is home or work with all
    of their columns if it was reported so (home also by its place), else an unknown place of purpose 4.
    """
    c = F.col
    same = lambda a, b, d, e: near_equal(c(a), c(d)) & near_equal(c(b), c(e))
    known = lambda a, b: (c(a) != -1) & (c(b) != -1)
    at_home = (c("dpurp") == HOME) | (same("x", "y", "hx", "hy") & known("x", "y"))
    at_work = (c("dpurp") == WORK) | (same("x", "y", "wx", "wy") & known("x", "y"))
    rows = trips.withColumn("dtype", cases((at_home, 1), (at_work, 2), (known("x", "y"), 4), default=5))
    home = c("dtype") == 1
    rows = rows.withColumns({"dtaz": F.when(home, c("htaz")).otherwise(c("dtaz")), "dpcl": F.when(home, c("hpcl")).otherwise(c("dpcl"))})
    w = by_person()
    ends = {"ox": ("x", "hx", "wx", -1), "oy": ("y", "hy", "wy", -1), "otaz": ("dtaz", "htaz", "wtaz", 0), "opcl": ("dpcl", "hpcl", "wpcl", 0), "otype": ("dtype", None, None, 5), "opurp": ("dpurp", None, None, OTHER)}
    rows = rows.withColumns({"_before": F.lag(F.struct(*(e[0] for e in ends.values()))).over(w), "_chained": F.coalesce(c("day_ix") - F.lag("day_ix").over(w) <= 1, F.lit(False))})
    from_home = (c("opurp") == HOME) | (same("ox", "oy", "hx", "hy") & known("ox", "oy"))
    rows = rows.withColumn("_from", cases((c("_chained"), 0), (from_home, 1), (c("opurp") == WORK, 2), default=3))
    at = {"otype": (1, 2), "opurp": (HOME, WORK)}
    value = lambda n: cases((c("_from") == 0, c(f"_before.{ends[n][0]}")), (c("_from") == 1, c(ends[n][1]) if ends[n][1] else at[n][0]), (c("_from") == 2, c(ends[n][2]) if ends[n][2] else at[n][1]), default=ends[n][3])
    return rows.withColumns({n: value(n) for n in ends}).drop("_before", "_chained", "_from")


def unwrap_clock(trips: DataFrame, last_end: int = 1680) -> DataFrame:
    """dep and arr as minutes that don't fall within a contiguous run, and end: the next departure, or last_end.

    A departure before the last arrival, and an arrival before the departure, are a day later. Runs end where more
    than a day passes between trips.

    All that a trip hands on is whether its arrival was moved by a day. Its clock times say what becomes of that: it
    is set anew, kept, or turned round. So the last trip that sets it and the turns since tell it for every trip, with
    windows alone, however long a run is.
    """
    w = by_person()
    so_far = w.rowsBetween(W.unboundedPreceding, 0)
    reset = F.coalesce(F.col("day_ix") - F.lag("day_ix").over(w) > 1, F.lit(True))
    rows = trips.withColumns({"run": F.sum(reset.cast("int")).over(so_far), "_before": F.when(~reset, F.lag("arr").over(w))})
    dep = lambda moved: F.when(F.col("dep") < F.coalesce(F.col("_before") + moved * DAY, F.lit(0)), F.col("dep") + DAY).otherwise(F.col("dep")).cast("int")
    moves = lambda moved: (F.col("arr") < dep(moved)).cast("int")
    rows = rows.withColumns({"_0": moves(F.lit(0)), "_1": moves(F.lit(1))})
    rows = rows.withColumn("_turns", F.sum(F.when(F.col("_0") > F.col("_1"), 1).otherwise(0)).over(so_far))
    sets = F.last(F.when(F.col("_0") == F.col("_1"), F.struct(F.col("_0").alias("to"), F.col("_turns").alias("turns"))), ignorenulls=True).over(so_far)
    rows = rows.withColumn("_set", sets).withColumn("_moved", F.pmod(F.col("_set.to") + F.col("_turns") - F.col("_set.turns"), F.lit(2)).cast("int"))
    rows = rows.withColumn("_was", F.when(F.col("_before").isNull(), 0).otherwise(F.lag("_moved").over(w)))
    rows = rows.withColumns({"dep_min": dep(F.col("_was")), "arr_min": (F.col("arr") + F.col("_moved") * DAY).cast("int")})
    after = F.lead("dep_min").over(W.partitionBy(*PERSON, "run").orderBy("seq"))
    return rows.select(*trips.columns, "run", "dep_min", "arr_min").withColumn("end_min", F.coalesce(after, F.lit(last_end)))
