"""The week pipeline: reported persons, households and trips of several days become linked trips, tours and person-days."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.clock import clock_text, hm_to_hhmm, min_to_hhmm
from ..functions.recode import any_of, cases, gate, positive_or, recode
from ..operators import sequence, tours, weights
from ..operators.relational import first_by, of_household
from ..sources.diary import HOME, PERSON, WORK
from ..sources.tables import Config, Stages

# fixed values: codes of the survey and what they become
AGES = {1: 3, 2: 10, 3: 16, 4: 21, 5: 30, 6: 40, 7: 50, 8: 60, 9: 70, 10: 80, 11: 90}
GENDERS = {1: 2, 2: 1, 4: 3, 997: 3, 995: 9, 999: 9}
STUDENTS = {0: 1, 1: 2, 2: 0, 3: 2, 4: 1, 995: -1}
PARKING = {1: 0, 2: 0, 3: 1, 4: 1, 995: -1, 996: -1, 997: -1, 998: -1}
OWNERS = {1: 1, 2: 2, 3: 3, 4: 3, 997: 3, 995: 9, 999: 9}
HOMES = {1: 1, 2: 2, 3: 3, 4: 3, 5: 3, 6: 3, 7: 4, 9: 5, 995: 9, 997: 6}
INCOMES = {999: -1, 1: 7500, 2: 20000, 3: 30000, 4: 42500, 5: 62500, 6: 87500, 7: 125000, 8: 175000, 9: 225000, 10: 350000}
INCOMES_AGAIN = {999: -1, 1: 12500, 2: 37500, 3: 62500, 4: 87500, 5: 150000, 6: 250000}
PURPOSES = {1: 0, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3, 7: 5, 8: 6, 9: 7, 10: 4, 11: 10, 12: 0, 13: 4}

ENROLLED, FULL_TIME, PART_TIME = (0, 1, 3, 4), (1, 3, 8), (2, 3, 7)
HALF_WAYS = (6, 7, 8, 9, 10)


def person_type(age: Column, employment: Column, student: Column, school: Column) -> Column:
    """1 full-time, 2 part-time, 3 retired, 4 other adult, 5 university, 6 high school, 7 aged 5 to 15, 8 under 5."""
    enrolled = student.isin(*ENROLLED)
    return cases(
        (age < 5, 8), (age < 16, 7), (employment.isin(*FULL_TIME), 1), (enrolled & ((age < 18) | ((age < 25) & school.isin(4, 7))), 6),
        (enrolled, 5), (employment.isin(*PART_TIME), 2), (age < 65, 4), default=3,
    )


def worker_type(ptype: Column, employment: Column) -> Column:
    return cases((ptype.isin(1, 2), ptype), (ptype.isin(5, 6) & employment.isin(1, 2, 3), 2), default=0)


def reformat_persons(persons: DataFrame, complete: DataFrame, config: Config) -> DataFrame:
    """Persons with recoded attributes, types, usual places within the counties, and complete days."""
    filled = {c: F.coalesce(c, F.lit(-1.0)) for c in ("work_x", "work_y", "school_x", "school_y")}
    rows = persons.withColumns(filled).withColumns(
        {
            "age": recode(F.col("age"), AGES), "gender": recode(F.col("gender"), GENDERS), "student_type": F.coalesce(recode(F.col("student"), STUDENTS), F.lit(0)),
            "free_parking": recode(F.col("work_park"), PARKING), "owner": recode(F.col("residence_rent_own"), OWNERS), "home_type": recode(F.col("residence_type"), HOMES),
        }
    )
    rows = rows.withColumn("ptype", person_type(*(F.col(c) for c in ("age", "employment", "student", "school_type"))))
    rows = rows.withColumn("worker", worker_type(F.col("ptype"), F.col("employment")))
    usual = {"work": F.col("worker") > 0, "school": F.col("student_type") > 0}
    rows = rows.withColumns({f"{p}_{z}": gate(F.col(f"{p}_{z}"), F.col(f"{p}_county"), list(config.counties), active) for p, active in usual.items() for z in ("zone", "parcel")})
    return rows.join(complete, PERSON, "left")


def reformat_households(households: DataFrame, persons: DataFrame) -> DataFrame:
    """Households with income (the detailed answer, else the follow-up), and the first member's tenure and kind of home."""
    first = first_by(persons.select("hh", "pno", "owner", "home_type"), ["hh"], ["pno"]).drop("pno")
    detailed, again = recode(F.col("income_detailed"), INCOMES), recode(F.col("income_followup"), INCOMES_AGAIN)
    return households.withColumn("income", positive_or(detailed, again)).join(first, "hh", "left")


def trip_mode(kind: Column, travelers: Column, first: Column, access: Column, egress: Column) -> Column:
    """0 other, 1 walk, 2 bike, 3 to 5 car by persons, 6 transit on foot, 7 transit by car, 8 school bus, 9 hired car."""
    transit = kind.isin(12, 13) | ((kind == 14) & (first == 41))
    by_car = F.coalesce(access.isin(*HALF_WAYS), F.lit(False)) | F.coalesce(egress.isin(*HALF_WAYS), F.lit(False))
    car = cases((travelers == 1, 3), (travelers == 2, 4), (travelers > 2, 5))
    return cases((kind == 1, 1), (kind.isin(2, 3, 4), 2), (kind.isin(8, 9), car), (kind.isin(5, 6), 9), (kind == 10, 8), (kind == 11, 5), (transit, F.when(by_car, 7).otherwise(6)), default=0)


def trip_path(kind: Column, mode: Column, modes: list[Column]) -> Column:
    """0 none, 1 road, 3 bus, 4 light rail, 5 premium, 6 metro, 7 ferry."""
    ride = cases((any_of(modes, [78]), 7), (any_of(modes, [30]), 6), (any_of(modes, [41, 42, 55]), 5), (any_of(modes, [53, 105, 68]), 4), default=3)
    return cases((kind == 8, 1), (mode.isin(6, 7), ride), default=0)


def trip_role(mode: Column, driver: Column, travelers: Column) -> Column:
    """1 driver, 2 passenger, 9 unknown in cars; 11 to 13 by persons in hired cars; 3 elsewhere."""
    hired = cases((travelers == 1, 11), (travelers == 2, 12), (travelers > 2, 13))
    return cases((mode.isin(3, 4, 5), cases((driver.isin(1, 3), 1), (driver == 2, 2), default=9)), (mode == 9, hired), default=3)


def reformat_trips(trips: DataFrame, config: Config, purposes: dict = PURPOSES) -> DataFrame:
    """Trips of complete days with purposes, modes, paths, roles, clock times and zones within the counties."""
    rows = trips.where("day_is_complete = 1")
    c = F.col
    mode = trip_mode(c("mode_type"), c("num_travelers"), c("mode_1"), c("transit_access"), c("transit_egress"))
    rows = rows.withColumns({"opurp": recode(c("o_purpose_category"), purposes), "dpurp": recode(c("d_purpose_category"), purposes), "mode": mode})
    rows = rows.withColumns(
        {
            "path": trip_path(c("mode_type"), c("mode"), [c(f"mode_{i}") for i in range(1, 5)]),
            "role": trip_role(c("mode"), c("driver"), c("num_travelers")),
            "dep_hhmm": hm_to_hhmm(c("depart_hour"), c("depart_minute")), "arr_hhmm": hm_to_hhmm(c("arrive_hour"), c("arrive_minute")),
            "dep": c("depart_hour") * 60 + c("depart_minute"), "arr": c("arrive_hour") * 60 + c("arrive_minute"),
            "depart_time": clock_text(c("depart_hour"), c("depart_minute"), c("depart_second")), "arrive_time": clock_text(c("arrive_hour"), c("arrive_minute"), c("arrive_second")),
            **{f"{e}_{z}": gate(c(f"{e}_{z}"), c(f"{e}_county"), list(config.counties)) for e in "od" for z in ("zone", "parcel")},
        }
    )
    return rows.where("opurp >= 0 OR dpurp >= 0")


def attach_person(locations: DataFrame, trips: DataFrame) -> DataFrame:
    """locations with the person of their trip."""
    return locations.join(trips.select("trip_id", *PERSON), "trip_id", "left")


def household_counts(persons: DataFrame, households: DataFrame | None = None) -> DataFrame:
    """Members by type, and workers, of each household; with households (hh), zeros for those without persons."""
    names = {1: "hhftw", 2: "hhptw", 3: "hhret", 4: "hhoad", 5: "hhuni", 6: "hhhsc", 7: "hh515", 8: "hhcu5"}
    counts = [F.count_if(F.col("ptype") == t).alias(n) for t, n in names.items()]
    out = persons.groupBy("hh").agg(F.count("*").alias("members"), *counts, F.count_if(F.col("ptype").isin(1, 2)).alias("hhwkrs"))
    if households is None:
        return out
    return households.select("hh").distinct().join(out, "hh", "left").fillna(0, ["members", *names.values(), "hhwkrs"])


#: What a person's record has a column for, but no survey an answer.
UNKNOWN = ("work_auto_minutes", "work_auto_miles", "school_auto_minutes", "school_auto_miles", "transit_pass", "paid_parking", "paper_diary", "proxy")


def person_output(persons: DataFrame, weight: str = "weight") -> DataFrame:
    """One record per person of reformat_persons: type, age, gender, usual places, weight; -1 for what is not known."""
    places = [f"{p}_{c}" for p in ("work", "school") for c in ("parcel", "zone", "x", "y")]
    known = ["ptype", "age", "gender", "worker", *places[:4], "student_type", *places[4:]]
    expansion = F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight in persons.columns else F.lit(1.0)
    return persons.select(*PERSON, *(F.coalesce(c, F.lit(-1)).alias(c) for c in known), *(F.lit(-1).alias(c) for c in UNKNOWN), expansion.alias("expansion"))


def person_day_records(trips: DataFrame, complete: DataFrame, tour_records: DataFrame | None = None, stops: DataFrame | None = None) -> DataFrame:
    """A row for each complete day of each person: trips, and whether the day begins and ends at home (1 without trips).

    tour_records (subtour, pdpurp, day) and stops (dpurp, day) add tours and stops by purpose, and wbtours, subtours.
    """
    g = W.partitionBy(*PERSON, "day")
    rows = trips.withColumns({"_f": F.min("seq").over(g), "_l": F.max("seq").over(g)})
    begins = F.coalesce((F.col("seq") == F.col("_f")) & F.col("opurp").eqNullSafe(F.lit(HOME)), F.lit(False))
    ends = (F.col("seq") == F.col("_l")) & (F.col("dpurp") == HOME)
    found = rows.groupBy(*PERSON, "day").agg(F.count("*").alias("trips"), F.max(begins.cast("int")).alias("beghom"), F.max(ends.cast("int")).alias("endhom"))
    out = weights.complete_person_days(complete, PERSON).join(found, [*PERSON, "day"], "left").fillna({"trips": 0, "beghom": 1, "endhom": 1})
    if tour_records is None:
        return out
    main, of_tour = F.col("subtour") == 0, F.col("pdpurp")
    by_tour = tour_records.groupBy(*PERSON, "day").agg(*(F.count_if(main & (of_tour == p)).alias(f"{n}tours") for p, n in tours.PURPOSES.items()), F.count_if(~main).alias("wbtours"))
    by_stop = stops.groupBy(*PERSON, "day").agg(*(F.count_if(F.col("dpurp") == p).alias(f"{n}stops") for p, n in tours.PURPOSES.items()))
    out = out.join(by_tour, [*PERSON, "day"], "left").join(by_stop, [*PERSON, "day"], "left")
    return out.fillna(0, [*(f"{n}{k}" for k in ("tours", "stops") for n in tours.PURPOSES.values()), "wbtours"])


class WeekTables:
    """What the pipeline makes; nothing is computed before a table is used.

    With stages, the linked trips, the halves of tours and the tours' records are written once, when a table that is
    made from them first needs them, and every table reads them; without, each table is a plan of its own.
    """

    def __init__(self, trips: DataFrame, config: Config, max_gap: int, days: DataFrame | None, persons: DataFrame | None, stages: Stages | None):
        name = config.weight("weight")
        self.rows = trips.withColumn("weight", F.col(name) if name in trips.columns and config.weighted else F.lit(1.0))
        self.config, self.max_gap, self.persons, self.stages = config, max_gap, persons, stages
        self.days = days if days is not None else self.rows.select(*PERSON, "day", F.lit(1).alias("is_complete"))
        self.settled = persons is not None

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return self.stages.keep(df, name) if self.stages else df

    @cached_property
    def heads(self) -> DataFrame:
        return sequence.chain_heads(sequence.activity_duration(self.rows), self.config.link_minutes, self.config.short_link_minutes)

    @cached_property
    def linked(self) -> DataFrame:
        return sequence.journeys(self.heads)

    @cached_property
    def access(self) -> DataFrame:
        return sequence.access_egress(self.heads)

    @cached_property
    def walked(self) -> DataFrame:
        """Linked trips with the time spent at their ends; with persons, settled ends and minutes that don't fall."""
        rows = self.linked.withColumnRenamed("trip", "seq")
        if not self.settled:
            return self._keep(sequence.activity_duration(rows), "walked")
        missing = [c for c in ("otaz", "opcl", "dtaz", "dpcl") if c not in rows.columns]
        rows = rows.withColumns({c: F.lit(-1) for c in missing}) if missing else rows
        rows = rows if "role" in rows.columns else rows.withColumn("role", F.lit(3))
        known = [c for c in PLACES if c in self.persons.columns]
        places = self.persons.select(*PERSON, *known, "ptype" if "ptype" in self.persons.columns else F.lit(None).cast("int").alias("ptype"))
        rows = of_household(rows, places)
        rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(-1)) if c in known else F.lit(-1) for c in PLACES})
        rows = sequence.unwrap_clock(sequence.settle_ends(rows).drop(*PLACES))
        return self._keep(rows.withColumn("act_dur", F.col("end_min") - F.col("arr_min")), "walked")

    @cached_property
    def toured(self) -> DataFrame:
        out, back = (tours.leaves_type(1), tours.returns_type(1)) if self.settled else (tours.leaves(HOME), tours.returns(HOME))
        return tours.with_tours(self.walked, out, back, max_gap=self.max_gap)

    @cached_property
    def halved(self) -> DataFrame:
        members = self.toured.where("tour IS NOT NULL")
        student = F.coalesce(F.col("ptype") > 4, F.lit(False)) if self.settled else None
        halved = tours.with_halves(members, student=student, usual=self.settled).withColumn("subtour", F.lit(0))
        below = tours.with_halves(tours.subtour_trips(members, student=student, usual=self.settled), BELOW, student, extend=not self.settled)
        return self._keep(halved.unionByName(below, allowMissingColumns=True), "halved")

    @cached_property
    def complete(self) -> DataFrame:
        return weights.day_completeness(self.days, PERSON)

    @cached_property
    def person(self) -> DataFrame:
        return self.rows.groupBy(*PERSON).agg(F.max("weight").alias("weight")).join(self.complete, PERSON, "full")

    def _weigh(self, df: DataFrame) -> DataFrame:
        return weights.expansion_weights(df, "weight", "num_days_complete_5dayweekday", F.col("day"), self.config.analysis_days, self.config.weight_cap)

    @cached_property
    def _tour_records(self) -> DataFrame:
        record = tours.order_tours(tours.tour_summary(self.halved, self.config.max_stops, BELOW))
        return self._weigh(record.join(self.person, PERSON, "left"))

    @cached_property
    def kept_tours(self) -> DataFrame:
        """The tours' records for tables that read them."""
        return self._keep(self._tour_records, "tours")

    @property
    def tours(self) -> DataFrame:
        """The tours' records: those that are kept already, else the plan that makes them, as nothing else reads them yet."""
        return self.kept_tours if "kept_tours" in self.__dict__ else self._tour_records

    @cached_property
    def halves(self) -> DataFrame:
        halves = self.halved.where(F.col("half").isNotNull() & (F.col("tseg") <= self.config.max_stops))
        of_tour = self.kept_tours.select(*BELOW, "tour_no", "tpath", F.col("day").alias("_day"), "expansion")
        return halves.join(of_tour, BELOW).withColumn("day", F.col("_day")).drop("_day")

    @cached_property
    def trips(self) -> DataFrame:
        return tours.split_drive_transit(self.halves, BELOW)

    @cached_property
    def person_days(self) -> DataFrame:
        rows = person_day_records(self.walked, self.complete, self.kept_tours, tours.intermediate_stops(self.halves, BELOW))
        rows = rows.join(self.person.select(*PERSON, "weight", "num_days_complete_5dayweekday"), PERSON, "left").fillna({"weight": 1.0})
        return self._weigh(rows).drop("weight", "num_days_complete_5dayweekday")

    @cached_property
    def patterns(self) -> DataFrame:
        return tours.person_day_pattern(self.toured, self.config.max_stops, self.kept_tours.where("subtour > 0"))

    @cached_property
    def tour_output(self) -> DataFrame:
        """The tour file: one record per tour and subtour with its four times, both ends, modes and trips each way."""
        self._need_persons()
        at, clock = (lambda end, field: F.col(f"{end}.{field}")), (lambda end: min_to_hhmm(F.col(f"{end}.minute")))
        return self.tours.select(
            *PERSON, "day", F.col("tour_no").alias("tour"), "parent", "subtrs", "pdpurp",
            clock("leave_home").alias("tlvorig"), clock("arrived").alias("tardest"), clock("left").alias("tlvdest"), clock("returned").alias("tarorig"),
            at("leave_home", "type").alias("toadtyp"), at("arrived", "type").alias("tdadtyp"),
            at("leave_home", "parcel").alias("topcl"), at("leave_home", "zone").alias("totaz"), at("arrived", "parcel").alias("tdpcl"), at("arrived", "zone").alias("tdtaz"),
            at("leave_home", "x").alias("toxco"), at("leave_home", "y").alias("toyco"), at("arrived", "x").alias("tdxco"), at("arrived", "y").alias("tdyco"),
            F.col("tmode").alias("tmodetp"), F.col("tpath").alias("tpathtp"), (F.col("stops1") + 1).alias("tripsh1"), (F.col("stops2") + 1).alias("tripsh2"), F.col("expansion").alias("toexpfac"),
        )

    @cached_property
    def trip_output(self) -> DataFrame:
        """The trip file: the trips of all tours in their halves, drive-transit ones split, with ends and clock times."""
        self._need_persons()
        timed = self.halves.withColumns({"dep": F.col("dep_min"), "arr": F.col("arr_min")}).drop("dep_min", "arr_min")
        legs = tours.split_drive_transit(timed, BELOW)
        names = {"tour_no": "tour", "half": "half", "tseg": "tseg", "chain": "tsvid", "opurp": "opurp", "dpurp": "dpurp", "otype": "oadtyp", "dtype": "dadtyp", "opcl": "opcl", "otaz": "otaz", "dpcl": "dpcl", "dtaz": "dtaz", "ox": "oxco", "oy": "oyco", "x": "dxco", "y": "dyco", "mode": "mode", "path": "pathtype", "role": "dorp"}
        times = {"dep": "deptm", "arr": "arrtm", "end_min": "endacttm"}
        return legs.select(*PERSON, "day", *(F.col(c).alias(n) for c, n in names.items()), *(min_to_hhmm(F.col(c)).alias(n) for c, n in times.items()), F.col("expansion").alias("trexpfac"))

    @cached_property
    def day_output(self) -> DataFrame:
        """The person-day file: each complete day with its tours (from home, work, to the usual workplace, by purpose), stops and weight."""
        self._need_persons()
        main, usual = F.col("subtour") == 0, (F.col("pdpurp") == WORK) & (F.col("arrived.type") == 2)
        more = self.kept_tours.groupBy(*PERSON, "day").agg(F.count_if(main).alias("hbtours"), F.count_if(main & usual).alias("uwtours"))
        rows = self.person_days.join(more, [*PERSON, "day"], "left").fillna(0, ["hbtours", "uwtours"])
        counts = [f"{n}{k}" for k in ("tours", "stops") for n in tours.PURPOSES.values()]
        return rows.select(*PERSON, "day", "beghom", "endhom", "hbtours", "wbtours", "uwtours", *counts, F.col("expansion").alias("pdexpfac"))

    def _need_persons(self) -> None:
        if not self.settled:
            raise ValueError("records of ends need the persons' places: week_pipeline(..., persons=)")


#: A tour or subtour, and the columns of a person's places: home and usual work.
BELOW = [*tours.TOUR, "subtour"]
PLACES = ("hx", "hy", "htaz", "hpcl", "wx", "wy", "wtaz", "wpcl")


def week_pipeline(trips: DataFrame, config: Config = Config(), max_gap: int = 1, days: DataFrame | None = None, persons: DataFrame | None = None, stages: Stages | None = None) -> WeekTables:  # noqa: B008
    """From trips (hh, pno, seq, day, day_ix, dep, arr, opurp, dpurp, ox, oy, x, y, mode, mode_type, path) to tables.

    days (hh, pno, day, is_complete) tells which days of a week are complete, also those without trips; without it,
    days with trips are. Without a column weight, or if the config says so, every person weighs 1.

    persons (hh, pno, ptype; hx, hy, htaz, hpcl; wx, wy, wtaz, wpcl; each but the first two may be missing) tells where
    home and usual work are. With it, ends of linked trips are settled and clocks unwrapped before tours are cut: tours
    go from home and back by the types of ends, work tours are taken apart at the usual workplace only, and students put
    school first. Trips may have otaz, dtaz, opcl, dpcl and role. stages: where to keep what several tables read.

    tours: home tours and their work subtours (subtour > 0), with tour_no, parent, subtrs, modes, stops, day and
    expansion. trips: the segments of both, drive-transit ones split, with tour_no, half, tseg, day and expansion.
    person_days: complete days with trips, tours and stops by purpose. patterns: the same over all days of a person.
    tour_output, trip_output, day_output (with persons): the records of the three files.
    """
    return WeekTables(trips, config, max_gap, days, persons, stages)


@dataclass(frozen=True)
class ReportedWeek:
    """What a survey's reported tables become: the files of persons and households, and the tables of the week."""

    persons: DataFrame
    households: DataFrame
    week: WeekTables


def week_from_reported(trips: DataFrame, persons: DataFrame, households: DataFrame, days: DataFrame, config: Config = Config(), max_gap: int = 1, stages: Stages | None = None) -> ReportedWeek:  # noqa: B008
    """From the reported tables of a survey to all outputs of the week.

    trips: hh, pno, trip_num, travel_dow, ends (o_x, o_y, d_x, d_y) and the columns of reformat_trips. persons: those of
    reformat_persons, and person_weight (with the suffix that config asks for; 1 without it). households: hh, home_x,
    home_y, home_zone, home_parcel, and those of reformat_households. days: hh, pno, day, is_complete. Trips are read by
    their day of the week and number; those of a day that isn't complete are left out.
    """
    people = reformat_persons(persons, weights.day_completeness(days, PERSON), config)
    homes = reformat_households(households, people)
    name = config.weight("person_weight")
    weight = (F.col(name) if name in persons.columns else F.lit(1.0)).cast("double").alias(config.weight("weight"))
    ends = {"ox": "o_x", "oy": "o_y", "x": "d_x", "y": "d_y", "otaz": "o_zone", "dtaz": "d_zone", "opcl": "o_parcel", "dpcl": "d_parcel", "day": "travel_dow", "day_ix": "travel_dow"}
    rows = reformat_trips(trips, config).withColumns({n: F.coalesce(F.col(c), F.lit(-1)) for n, c in ends.items()})
    rows = rows.withColumn("seq", F.row_number().over(W.partitionBy(*PERSON).orderBy("travel_dow", "trip_num")))
    rows = rows.join(people.select(*PERSON, weight), PERSON, "left").select(*PERSON, "seq", *ends, "dep", "arr", "opurp", "dpurp", "mode", "mode_type", "path", "role", config.weight("weight"))
    work = people.select(*PERSON, "ptype", F.col("work_x").alias("wx"), F.col("work_y").alias("wy"), F.col("work_zone").alias("wtaz"), F.col("work_parcel").alias("wpcl"))
    home = homes.select("hh", F.col("home_x").alias("hx"), F.col("home_y").alias("hy"), F.col("home_zone").alias("htaz"), F.col("home_parcel").alias("hpcl"))
    week = week_pipeline(rows, config, max_gap, days, work.join(home, "hh", "left"), stages)
    counts = household_counts(people, homes)
    return ReportedWeek(person_output(people, name), homes.join(counts, "hh", "left"), week)
