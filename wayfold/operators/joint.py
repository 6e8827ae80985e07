"""Joint travel of the members of a household."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.recode import cases
from ..sources.diary import PERSON

ADULTS = ("FW", "PW", "US", "NW", "RE")
MANDATORY = ("School", "University", "Work", "WorkRelated")


def detect_parties(trips: DataFrame, minutes: int = 4, times: tuple[str, str] = ("dep", "arr"), places: tuple[str, ...] = ("ox", "oy", "x", "y"), day: str | None = None) -> DataFrame:
    """trips with party: the person first, then the other members with a trip between the same places at the same times.

    Members are matched within the household by equal places, on the same day if its column is named; times may differ
    by `minutes`. Several matching trips of one member count once; a trip without places has no company.

    This is a band join: a member's times are listed in the cell of both times, `minutes` wide, and in the cells around
    it, and a trip looks up its own cell. Trip and listings meet in a window by household, place and cell, so that trips
    which are dealt by household stay where they are: neither side is dealt or broadcast. A cell's list has each member's
    distinct times in 3 x 3 cells, however many trips there are; the window's rows can be spilled.
    """
    width = max(1, minutes)
    keys = ["hh", *([day] if day else []), *places]
    cell = lambda t: F.floor(F.col(t) / width).cast("long")
    known = F.lit(True)
    for c in (*times, "pno", *keys):
        known &= F.col(c).isNotNull()
    at = lambda i, j: F.struct((cell(times[0]) + i).alias("_0"), (cell(times[1]) + j).alias("_1"), F.lit(i == j == 0).alias("_own"))
    around = F.when(known, F.array(*(at(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)))).otherwise(F.array(at(0, 0)))
    entry = F.when(known, F.struct("pno", *times))
    rows = trips.select(*keys, entry.alias("_entry"), F.struct(*trips.columns).alias("_row"), F.explode(around).alias("_at"))
    rows = rows.select(*keys, "_at.*", "_entry", F.when(F.col("_at._own"), F.col("_row")).alias("_row"))
    listed = F.collect_set("_entry").over(W.partitionBy(*keys, "_0", "_1"))
    rows = rows.withColumn("_all", listed).where("_own").select("_row.*", "_all")
    close = lambda o: (o["pno"] != F.col("pno")) & (F.abs(o[times[0]] - F.col(times[0])) <= minutes) & (F.abs(o[times[1]] - F.col(times[1])) <= minutes)
    others = F.array_sort(F.array_distinct(F.transform(F.filter("_all", close), lambda o: o["pno"])))
    party = F.concat(F.array("pno"), F.coalesce(others, F.array().cast("array<int>")))
    return rows.select(*trips.columns, F.when(known, party).otherwise(F.array("pno")).alias("party")).withColumn("party_text", F.array_join("party", "."))


def classify_joint_tours(trips: DataFrame, keys: list[str] = [*PERSON, "tour"]) -> DataFrame:  # noqa: B006
    """keys, fully_joint, partly_joint, party (of fully joint tours): one and the same party on all trips, or several."""
    out = trips.groupBy(*keys).agg(F.count_distinct("party_text").alias("_n"), F.min("party").alias("_p"))
    full = (F.col("_n") == 1) & (F.size("_p") > 1)
    return out.select(*keys, full.cast("int").alias("fully_joint"), (F.col("_n") > 1).cast("int").alias("partly_joint"), F.when(full, F.col("_p")).alias("party"))


def party_fields(tours: DataFrame, persons: DataFrame, most: int = 9) -> DataFrame:
    """tours with size, person_1 ... person_<most>, type_1 ..., and composition: 1 all adults, 2 all children, 3 both.

    persons: hh, pno, ptype; of a person with several types the smallest counts.
    """
    types = persons.groupBy("hh", "pno").agg(F.min("ptype").alias("ptype")).groupBy("hh").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("pno", "ptype")))).alias("_t"))
    rows = tours.join(types, "hh", "left")
    kinds = F.transform("party", lambda p: F.try_element_at("_t", p))
    adults = F.size(F.filter(kinds, lambda k: k.isin(*ADULTS)))
    composition = F.when(F.col("party").isNotNull(), cases((adults == F.size("party"), 1), (adults == 0, 2), default=3))
    return rows.withColumns({"size": F.size("party"), "composition": composition, **{f"person_{i + 1}": F.get("party", F.lit(i)) for i in range(most)}, **{f"type_{i + 1}": F.get(kinds, F.lit(i)) for i in range(most)}}).drop("_t")


def identified(tours: DataFrame, ends: list[str], same_row: bool = True) -> DataFrame:
    """tours with identify: 1 if another fully joint tour of the household has the same ends, else 0; null if not fully joint.

    With same_row=False each of the ends may be found in another tour.
    """
    full = F.col("fully_joint") == 1
    others = lambda *keys: F.count_if(full).over(W.partitionBy("hh", *keys)) > 1
    found = others(*ends)
    if not same_row:
        found = others(ends[0])
        for e in ends[1:]:
            found &= others(e)
    return tours.withColumn("identify", F.when(full, found.cast("int")))


def split_joint(tours: DataFrame, same: list[str], exclude: DataFrame | None = None, keep_mandatory: bool = True, identify: bool = False) -> tuple[DataFrame, DataFrame]:
    """(individual, joint) tours; joint ones once for the whole party, numbered by household.

    tours: fully_joint, purpose, subtour. Mandatory tours that are no subtours stay individual. same: columns that
    tell that two members report one tour; the first person's stays. exclude: keys of tours to leave out. identify:
    tours whose column identify is 0 stay individual, too, and are partly joint.
    """
    back = F.col("purpose").isin(*MANDATORY) & (F.col("subtour") == 0) if keep_mandatory else F.lit(False)
    joint = (F.col("fully_joint") == 1) & ~F.coalesce(back, F.lit(False))
    if identify:
        known = F.coalesce(F.col("identify") == 1, F.lit(False))
        tours = tours.withColumns({"fully_joint": (joint & known).cast("int"), "partly_joint": F.when(joint & ~known, 1).otherwise(F.col("partly_joint"))})
        joint &= known
    rows = tours.withColumn("_joint", joint)
    if exclude is not None:
        rows = rows.join(exclude.distinct(), exclude.columns, "left_anti")
    individual = rows.where(~F.col("_joint")).drop("_joint")
    once = rows.where("_joint").withColumn("_n", F.row_number().over(W.partitionBy("hh", *same).orderBy("pno", "tour"))).where("_n = 1").drop("_n", "_joint")
    return individual, once.withColumn("joint_no", F.dense_rank().over(W.partitionBy("hh").orderBy("pno", "tour")))


def number_joint_trips(trips: DataFrame, joint_tours: DataFrame) -> DataFrame:
    """trips with joint_no of their joint tour, null for individual trips; of a party, only the tour kept has one."""
    return trips.join(joint_tours.select(*PERSON, "tour", "joint_no"), [*PERSON, "tour"], "left")


def split_joint_trips(trips: DataFrame, joint_tours: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(individual, joint) trips: those of joint tours once for each party, with the tour's number."""
    rows = number_joint_trips(trips, joint_tours)
    return rows.where("joint_no IS NULL").drop("joint_no"), rows.where("joint_no IS NOT NULL")
