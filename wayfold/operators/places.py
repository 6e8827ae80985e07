"""Place diaries: visited places of one day, linked over changes of mode, cut into tours and written as records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.clock import wrapped
from ..functions.numeric import great_circle_miles, lerp_score
from ..functions.recode import cases
from ..functions.text import contains_any
from ..sources.diary import PERSON
from .relational import dedupe_first, small
from .sequence import by_person
from .tours import number_segments

HOME, WORK, CHANGE = "Home", "Work", "ChangeMode"
TRANSIT = ("LOCALBUS", "EXPRESSBUS", "RAIL")
NOT_DRIVEN = (*TRANSIT, "SCHOOLBUS", "WALK", "PASSENGER")

# fixed values: purposes of activities, modes, and person types
ACTIVITIES = {
    "Home": (1, 2, 3), "ChangeMode": (4,), "Escorting": (5, 6), "Maintenance": (7, 14, 18, 19, 20), "Work": (8, 9), "WorkRelated": (13,),
    "School/University": (11, 12), "Shopping": (15, 16, 17), "EatOut": (21,), "Discretionary": (10, 22, 23, 24), "Social/Visit": (25,), "NA": (96, 97),
}
MODES = {"WALK": (1,), "BIKE/MOPED": (2, 11), "DRIVER": (3,), "PASSENGER": (4,), "LOCALBUS": (5,), "EXPRESSBUS": (6,), "RAIL": (7,), "TAXI": (8, 9), "SCHOOLBUS": (10,), "OTHER": (97,)}
# fixed values: what a purpose in the person's own words is
OWN_WORDS = {
    "Maintenance": ("ACCOMPANY", "ACCOMPANY PARENT", "AUTO ACCIDENT", "HOUSE HUNTING", "LOCATING/FINDING THIS PLACE", "PRACTICE"),
    "School/University": ("ADULT DAYCARE", "AFTER SCHOOL PROGRAM", "ATTEND CLASS", "BEFORE SCHOOL PROGRAM", "DAYCARE", "GRADUATION", "ORIENTATION", "SCHOOL FUNCTION", "SCHOOL RELATED", "STUDYING"),
    "Shopping": ("CARPOOL",),
    "Escorting": (
        "DROP OFF CHILD", "DROP OFF CHILDREN", "DROP OFF GRANDCHILDREN", "DROP OFF HH MEMBER", "PICK UP CHILD", "PICK UP CHILDREN", "PICK UP GRANDCHILD",
        "PICK UP GRANDCHILDREN", "PICK UP HH MEMBER",
    ),
    "EatOut": ("EAT",),
    "Home": ("HOMESCHOOLED",),
    "Discretionary": (
        "CLARINET LESSON", "CUB SCOUTS", "BALLET LESSON", "ENTERTAINMENT", "GIRL SCOUTS", "GUITAR LESSON", "HORSEBACK LESSONS", "MUSIC LESSON", "MUSIC REHEARSAL",
        "PIANO LESSONS", "VACATION", "VIOLIN LESSON", "ZITHER LESSON", "ROAD TRIP", "SIGHTSEEING", "TRAVELING", "AIRPORT", "ASKING FOR DIRECTIONS", "BABYSITTER",
        "BABYSITTING", "BATHROOM STOP", "BEING BABYSAT", "BEING DROPPED OFF", "BEING PICKED UP", "CELL PHONE CALL-STOPPED", "CO-OP PICK UP", "CO-OP PICKUP", "HOTEL",
        "LEFT-CHANGED MIND", "LEFT-CLOSED", "LEFT-FORGOT PHONE", "LEFT-NO ONE HOME", "LEFT-TOO CROWDED", "LEFT-WRONG OFFICE", "OUT OF AREA", "OUT OF TOWN",
        "SECOND HOME", "VOLUNTEERING", "WAITING", "SLEEP", "FUNERAL", "GRAVE", "",
    ),
}
# fixed values: the level of a school in the person's own words: 5 after high school, 4 high school and the like
SCHOOLS = {
    5: (
        "CONTINUING EDUCATION", "FRESHMAN IN COLLEGE", "BIBLE COLLEGE", "SPANISH CLASS", "TAX PROFESSIONAL COURSE", "REAL ESTATE CLASS", "TRAINING PROGRAM",
        "ENGLISH CLASSES", "PHOTOGRAPHY CLASSES", "INSTITUTE", "UNION CLASS", "ADULT EDUCATION", "CNA TRAINING", "ART SCHOOL",
    ),
    4: (
        "GED", "CERTIFICATE PROGRAM", "CERTIFICATION", "MENTAL HEALTH SCHOOL", "SPECIAL", "DISABILITY SUPPORT GROUP", "MINISTERIAL SCHOOL", "MENTAL HEALTH PROGRAM",
        "SPECIAL NEEDS PROGRAM",
    ),
}
# fixed values: words that tell a stop
STOP_WORDS = ["BUS STOP", "TRANSIT STOP", "STATION"]
# fixed values: mode codes of tours from the most to the least important
MODE_ORDER = (14, 13, 12, 17, 16, 15, 18, 8, 19, 6, 5, 4, 3, 2, 1, 11, 10, 9, 7, 20)


def labelled(c: Column, table: dict[str, tuple]) -> Column:
    """The label whose values include c; null for none."""
    return cases(*((c.isin(*values), label) for label, values in table.items()))


def clean_persons(persons: DataFrame, households: DataFrame, places: DataFrame) -> DataFrame:
    """works, jobs, hours, work place and student of persons, with what is missing filled in.

    persons: hh, pno, age, ageb, works, jobs, hours, wloc, wtaz, wx, wy, stude, and, if there, hours2 and hours3 of
    further jobs, 0 for those who lack them; households: hh, htaz, hx, hy; places: hh, pno, tpurp, and, if there,
    o_tpurp. Home workers work at home; persons of unknown status are students if they visit a school.
    """
    school = F.col("tpurp").isin(11, 12)
    if "o_tpurp" in places.columns:
        school |= F.coalesce(F.upper(F.trim("o_tpurp")).isin(*OWN_WORDS["School/University"]), F.lit(False))
    seen = places.groupBy(*PERSON).agg(F.max(school).alias("_school"), F.max(~school).alias("_other"))
    homes = households.select("hh", F.col("htaz").alias("_ht"), F.col("hx").alias("_hx"), F.col("hy").alias("_hy"))
    rows = persons.join(seen, PERSON, "left").join(homes, "hh", "left")
    rows = rows.withColumn("works", cases((F.col("age") < 16, 2), ((F.col("ageb") == 1) & F.col("works").isNull(), 2), default=F.col("works")))
    idle, at_home = F.col("works") == 2, F.coalesce(F.col("wloc") == 2, F.lit(False))
    nowhere = F.col("wx").isNull() & F.col("wy").isNull()
    student = cases((F.col("stude").isin(1, 2), 1), (F.col("stude") == 3, 0), (F.col("_school"), 1), (F.col("stude").isin(8, 9) & F.col("_other"), 0), default=-1)
    place = lambda c, home: F.when(nowhere, F.coalesce(F.when(at_home, F.col(home)), F.lit(0))).otherwise(F.col(c))
    rows = rows.withColumns(
        {
            **{c: F.when(F.col("jobs").isNull() & idle, 0).otherwise(F.col(c)) for c in ("hours", "jobs")},
            "wloc": F.when(F.col("wloc").isNull() & idle, 0).otherwise(F.col("wloc")), "student": student,
            "wtaz": F.coalesce(F.col("wtaz"), F.when(at_home, F.col("_ht")), F.lit(9999)), "wx": place("wx", "_hx"), "wy": place("wy", "_hy"),
        }
    )
    no_job = {"hours2": F.lit(1), "hours3": F.lit(2)}
    for c, most in no_job.items():
        if c in persons.columns:
            without = ((F.col("works") == 1) & F.col("jobs").between(1, most)) | ((F.col("works") == 2) & (F.col("jobs") == 0))
            rows = rows.withColumn(c, F.when(without, 0).otherwise(F.col(c)))
    return rows.drop("_school", "_other", "_ht", "_hx", "_hy")


def hours_of_jobs(jobs: Column, hours: Column, hours2: Column, hours3: Column) -> Column:
    """The hours of as many jobs as a person has, three at most; null without a job."""
    return cases((jobs == 1, hours), (jobs == 2, hours + hours2), (jobs >= 3, hours + hours2 + hours3))


def school_level(level: Column, own_words: Column, student: Column, age: Column) -> Column:
    """The level of a student's school: other ones (97) by their words, missing ones by age; others keep theirs."""
    words = F.upper(F.trim(own_words))
    told = cases(*((words.isin(*texts), code) for code, texts in SCHOOLS.items()))
    missing = level.isNull() | level.isin(98, 99)
    return cases(((student == 1) & (level == 97), F.coalesce(told, F.when(age >= 19, 5).otherwise(4))), ((student == 1) & missing, F.when(age >= 19, 5).otherwise(4)), default=level)


def person_type_8(age: Column, ageb: Column, works: Column, hours: Column, student: Column, school: Column, first_job: Column | None = None) -> Column:
    """US, DS, FW, PW, NW, RE, ND or PS by the first rule that holds, else NA.

    hours are those of all jobs (hours_of_jobs); the rules for persons of unknown kind ask for those of the first job.
    """
    first_job = hours if first_job is None else first_job
    known, adult = (age < 998), ((age >= 16) & (age < 998)) | ageb.isin(1, 2)
    worker, idle = works == 1, works == 2
    return cases(
        ((((age >= 17) & known) | (ageb == 2)) & (student == 1) & school.between(5, 8), "US"),
        ((student == 1) & age.between(16, 19) & school.between(1, 4), "DS"),
        (worker & adult & (student == 0) & (hours >= 35), "FW"),
        (worker & adult & (student == 0) & (hours < 35), "PW"),
        (idle & (student == 0) & (age.between(16, 64) | (ageb == 2)), "NW"),
        (idle & (student == 0) & (((age >= 65) & known) | (ageb == 1)), "RE"),
        (age.between(6, 15), "ND"),
        (age < 6, "PS"),
        ((age >= 19) & worker & (first_job >= 35), "FW"),
        ((age >= 19) & worker & (first_job < 35), "PW"),
        ((age <= 30) & idle & (student == 1), "US"),
        (age.between(30, 64) & idle, "NW"),
        ((age >= 65) & known & idle, "RE"),
        (age.isin(998, 999) & idle, "ND"),
        default="NA",
    )


def clean_places(places: DataFrame, persons: DataFrame, households: DataFrame) -> DataFrame:
    """aggact and modename of places: hh, pno, tpurp, pname, o_tpurp, mode, riders, taz, x, y.

    Places at home's coordinates and zone are home; waiting at a stop is a change of mode; work is work at the usual
    work place and related to it elsewhere; other purposes (NA) go by the person's own words; a driver is whoever
    rides alone.
    """
    home = households.select("hh", F.col("hx").alias("_hx"), F.col("hy").alias("_hy"), F.col("htaz").alias("_ht"))
    usual = persons.select(*PERSON, F.col("wx").alias("_wx"), F.col("wy").alias("_wy"))
    rows = places.join(home, "hh", "left").join(usual, PERSON, "left")
    at_home = (F.col("x") == F.col("_hx")) & (F.col("y") == F.col("_hy")) & (F.col("taz") == F.col("_ht"))
    at_work = (F.col("x") == F.col("_wx")) & (F.col("y") == F.col("_wy"))
    away = (F.col("x") != F.col("_wx")) & (F.col("y") != F.col("_wy"))
    p = F.col("tpurp")
    named_home = F.upper(F.trim("pname")) == "HOME"
    waiting = (p == 96) & contains_any(F.col("pname"), STOP_WORDS) | (p == 97) & (F.upper("o_tpurp") == "WAITING") & contains_any(F.col("pname"), ["BUS STOP", "STATION"])
    rows = rows.withColumn("tpurp", cases((at_home & (~p.isin(1, 2, 3, 96, 97) | ((p == 96) & named_home)), 3), (waiting, 4), default=p))
    label = labelled(F.col("tpurp"), ACTIVITIES)
    rows = rows.withColumn("aggact", cases((F.coalesce(at_work, F.lit(False)) & F.col("tpurp").isin(10, 13), WORK), (F.coalesce(away, F.lit(False)) & F.col("tpurp").isin(8, 9), "WorkRelated"), default=label))
    told = labelled(F.upper(F.trim("o_tpurp")), OWN_WORDS)
    rows = rows.withColumn("aggact", F.when(F.col("aggact") == "NA", F.coalesce(told, F.col("aggact"))).otherwise(F.col("aggact")))
    rows = rows.withColumn("mode", F.when((F.col("riders") == 1) & (F.col("mode") == 4), 3).otherwise(F.col("mode")))
    return rows.withColumn("modename", labelled(F.col("mode"), MODES)).drop("_hx", "_hy", "_ht", "_wx", "_wy")


def place_legs(places: DataFrame) -> DataFrame:
    """places with leg: a run of changes of mode and the place that closes it; 0 is a person's first place.

    Places after the last activity have no leg that is closed and are left out.
    """
    w = by_person()
    first = F.row_number().over(w) == 1
    closes = (F.col("aggact") != CHANGE) & ~first
    rows = places.withColumns({"_first": first, "_closes": closes})
    before = F.sum(F.col("_closes").cast("int")).over(w.rowsBetween(W.unboundedPreceding, -1))
    leg = F.when(F.col("_first"), 0).otherwise(F.coalesce(before, F.lit(0)) + 1).cast("int")
    rows = rows.withColumn("leg", leg)
    closed = F.max((F.col("_closes") | F.col("_first")).cast("int")).over(W.partitionBy(*PERSON, "leg"))
    return rows.withColumn("_ok", closed).where("_ok = 1").drop("_ok", "_first", "_closes")


def link_places(places: DataFrame) -> DataFrame:
    """One row per leg: first origin, summed minutes and miles, least toll, most riders, modes, boarding, alighting, parking.

    places: seq, aggact, modename, ox, oy, x, y, odep, minutes, miles, toll, riders. Parking is where driving ends
    before another mode, or where it begins again after one.
    """
    rows = place_legs(places)
    w = W.partitionBy(*PERSON, "leg").orderBy("seq")
    transit, ridden = F.col("modename").isin(*TRANSIT), F.col("modename").isin(*NOT_DRIVEN)
    rows = rows.withColumns({"_before": F.lag(F.struct("modename", "seq")).over(w), "_after": F.lead("modename").over(w)})
    park_out = F.when(ridden & (F.col("_before.modename") == "DRIVER"), F.col("_before.seq"))
    park_back = F.when(ridden & (F.col("_after") == "DRIVER"), F.col("seq"))
    pairs = F.array_sort(F.collect_list(F.struct("seq", "modename")))
    out = rows.groupBy(*PERSON, "leg").agg(
        F.max("seq").alias("seq"), F.max_by("aggact", "seq").alias("aggact"), F.max_by("x", "seq").alias("x"), F.max_by("y", "seq").alias("y"),
        F.min_by("ox", "seq").alias("ox"), F.min_by("oy", "seq").alias("oy"), F.min_by("odep", "seq").alias("odep"),
        F.sum("minutes").alias("minutes"), F.sum("miles").alias("miles"), F.min(F.coalesce("toll", F.lit(999))).alias("toll"), F.max(F.coalesce("riders", F.lit(0))).alias("riders"),
        F.transform(pairs, lambda p: p["modename"]).alias("modes"), F.count("*").alias("rows"),
        F.min(F.when(transit, F.col("seq"))).alias("board"), F.max(F.when(transit, F.col("seq"))).alias("alight"),
        F.coalesce(F.min(park_out), F.max(park_back)).alias("park"),
    )
    return out.withColumn("board", F.col("board") - 1).withColumn("mode_text", F.array_join("modes", "-"))


def parking_rule(legs: DataFrame) -> DataFrame:
    """park of persons none of whose legs has a change of mode: where the first ride follows driving, and the last ride."""
    p, w = W.partitionBy(*PERSON), by_person("leg")
    ridden = F.array_contains("modes", "PASSENGER") | F.arrays_overlap("modes", F.array(*map(F.lit, TRANSIT)))
    rows = legs.withColumns({"_ride": ridden, "_plain": F.max("rows").over(p) == 1, "_drove": F.lag(F.array_contains("modes", "DRIVER")).over(w), "_at": F.lag("seq").over(w)})
    first = F.min(F.when(F.col("_ride"), F.col("seq"))).over(p)
    last = F.max(F.when(F.col("_ride"), F.col("seq"))).over(p)
    rows = rows.withColumns({"_first": first, "_last": last})
    here = cases(((F.col("seq") == F.col("_first")) & F.coalesce("_drove", F.lit(False)), F.col("_at")), (F.col("seq") == F.col("_last"), F.col("seq")))
    return rows.withColumn("park", F.when(F.col("_plain"), here).otherwise(F.col("park"))).drop("_ride", "_plain", "_drove", "_at", "_first", "_last")


def transit_defaults(legs: DataFrame) -> DataFrame:
    """Legs of one transit mode only are boarded at the place before and left at their end."""
    one = (F.size("modes") == 1) & F.get("modes", F.lit(0)).isin(*TRANSIT)
    before = F.lag("seq").over(by_person("leg"))
    return legs.withColumns({"board": F.when(one, F.coalesce(before, F.col("seq") - 1)).otherwise(F.col("board")), "alight": F.when(one, F.col("seq")).otherwise(F.col("alight"))})


def mode_code(modes: Column, toll: Column, riders: Column, bike_first: bool = False) -> Column:
    """1 to 20 for a list of modes, a toll answer (1 paid, 2 or 9 free) and the persons in the vehicle.

    School bus wins, then taxi; without transit a car counts by its persons and toll, the rest is walking; transit is
    reached on foot, by a driver or by a passenger. bike_first tells bikes and others from walking.
    """
    has = lambda m: F.array_contains(modes, m)
    driver, passenger = has("DRIVER"), has("PASSENGER")
    rail, express, local = has("RAIL"), has("EXPRESSBUS"), has("LOCALBUS")
    transit = rail | express | local
    free, paid = toll.isin(2, 9), toll == 1
    alone = driver & (riders == 1)
    shared = lambda n: (driver | passenger) & (n)
    ride = lambda foot, drive, drop: cases((driver, drive), (passenger, drop), default=foot)
    bikes = [(modes == F.array(F.lit("BIKE/MOPED")), 8), (has("OTHER") & ~driver & ~passenger & ~transit, 20)] if bike_first else []
    return cases(
        (has("SCHOOLBUS"), 18),
        (has("TAXI"), 19),
        *[(~transit & who & how, code) for who, codes in ((alone, (1, 2)), (shared(riders == 2), (3, 4)), (shared(riders >= 3), (5, 6))) for how, code in zip((free, paid), codes, strict=True)],
        *bikes,
        (~transit & ~driver & ~passenger, 7),
        (rail, ride(11, 14, 17)),
        (express, ride(10, 13, 16)),
        (local, ride(9, 12, 15)),
    )


def number_tours(places: DataFrame) -> DataFrame:
    """Segments between homes, as number_segments: tour, idx."""
    return number_segments(places, F.col("aggact") == HOME).withColumnsRenamed({"seg": "tour", "idx": "tour_idx"})


def number_work_subtours(tours: DataFrame) -> DataFrame:
    """Segments between work places of one tour that has two or more; rows before the first and after the last are -1."""
    rows = number_segments(tours.where("tour > 0"), F.col("aggact") == WORK, keys=[*PERSON, "tour"], order="tour_idx", need_anchors=2)
    return rows.withColumn("subtour", F.greatest("seg", F.lit(-1))).drop("seg").withColumnRenamed("idx", "subtour_idx")


def score_primary_destination(tours: DataFrame, scores: DataFrame, keys: list[str] = [*PERSON, "tour"], order: str = "tour_idx", digits: int = 2) -> DataFrame:  # noqa: B006
    """tours with score and primary (1 or 0; null for the anchors) of the places between them.

    The score looks up twice the travel time from the anchor (half a mile a minute) and the time spent in the table of
    the activity (label, d0, d60, ... d480); the least one wins, 99 for none, and of equal ones the first. If it is
    work, all work at that place is primary. scores is a lookup table with one row per activity, broadcast by size.
    """
    s = W.partitionBy(*keys)
    rows = tours.withColumns({"_n": F.count("*").over(s), "_a": F.min_by(F.struct("x", "y"), order).over(s), "_i": F.row_number().over(s.orderBy(order))})
    knots = [f"d{k}" for k in range(0, 481, 60)]
    table = dedupe_first(scores, ["label"], [F.col("tpurp")]).select(F.col("label").alias("aggact"), *knots)
    rows = rows.join(small(table), "aggact", "left")
    minutes = F.round(great_circle_miles(F.col("_a.x").cast("double"), F.col("_a.y").cast("double"), F.col("x").cast("double"), F.col("y").cast("double")) / 0.5, digits)
    inner = (F.col("_i") > 1) & (F.col("_i") < F.col("_n"))
    score = F.coalesce(lerp_score(2 * minutes + F.col("act_dur"), [F.col(k) for k in knots]), F.lit(99.0))
    rows = rows.withColumn("score", F.when(inner, F.round(score, 6)))
    rows = rows.withColumn("_best", F.min(F.when(inner, F.struct("score", F.col(order).alias("o"), "aggact", "x", "y"))).over(s))
    same = (F.col("_best.aggact") == WORK) & (F.col("aggact") == WORK) & (F.col("x") == F.col("_best.x")) & (F.col("y") == F.col("_best.y"))
    primary = F.when(inner, ((F.col(order) == F.col("_best.o")) | same).cast("int"))
    return rows.withColumn("primary", primary).drop("_n", "_a", "_i", "_best", *knots)


def stop_fields(tours: DataFrame, fields: list[str], keys: list[str] = [*PERSON, "tour"], order: str = "tour_idx", most: int = 4) -> DataFrame:  # noqa: B006
    """One row per tour: out_stops, in_stops, and the fields of the first `most` stops each way (out1_x, ..., in4_y).

    tours: places with primary, null at the anchors. Stops out lie before the first primary place, stops in after the
    last one.
    """
    s = W.partitionBy(*keys)
    at = F.when(F.col("primary") == 1, F.col(order))
    rows = tours.withColumns({"_f": F.min(at).over(s), "_l": F.max(at).over(s)}).where("primary IS NOT NULL AND _f IS NOT NULL")
    stops = lambda side: F.array_sort(F.collect_list(F.when(side, F.struct(F.col(order).alias("o"), *fields))))
    out = rows.groupBy(*keys).agg(stops(F.col(order) < F.col("_f")).alias("_out"), stops(F.col(order) > F.col("_l")).alias("_in"))
    spread = [F.get(f"_{d}", F.lit(i))[f].alias(f"{d}{i + 1}_{f}") for d in ("out", "in") for i in range(most) for f in fields]
    return out.select(*keys, F.size("_out").alias("out_stops"), F.size("_in").alias("in_stops"), *spread)


def tour_mode(codes: Column) -> Column:
    """An aggregate: the first code of MODE_ORDER that a tour has."""
    rank = cases(*((codes == c, k) for k, c in enumerate(MODE_ORDER)))
    return F.get(F.array(*map(F.lit, MODE_ORDER)), F.min(rank))


def with_subtour_rows(tours: DataFrame, keys: list[str] = [*PERSON, "tour"], order: str = "tour_idx") -> DataFrame:  # noqa: B006
    """tours with aside (1 for rows of a subtour and the last return to work) and subtours (the last one's number).

    A subtour lies between two work places of a tour with a row between them; its number is that of the first of the two.
    """
    s = W.partitionBy(*keys)
    w = s.orderBy(order)
    work = F.coalesce(F.col("aggact") == WORK, F.lit(False))
    rows = tours.withColumns({"_w": work, "_b": F.coalesce(F.sum(work.cast("int")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)), "_t": F.sum(work.cast("int")).over(s), "_p": F.coalesce(F.lag(work).over(w), F.lit(False))})
    between = (F.col("_b") >= 1) & (F.col("_b") < F.col("_t"))
    aside = between & (~F.col("_w") | ~F.col("_p") | (F.col("_b") == F.col("_t") - 1))
    closes = between & F.col("_w") & ~F.col("_p")
    return rows.withColumns({"aside": aside.cast("int"), "subtours": F.coalesce(F.max(F.when(closes, F.col("_b"))).over(s), F.lit(0)).cast("int")}).drop("_w", "_b", "_t", "_p")


def tour_records(tours: DataFrame, keys: list[str] = [*PERSON, "tour"], order: str = "tour_idx") -> DataFrame:  # noqa: B006
    """One row per tour: ends, primary purpose, times, minutes, mode, driver, and tour_id in the person.

    tours: places with tour > 0, aggact, modename, x, y, arr, dep, code, primary. The anchor's own row, the rows of
    subtours and the last return to work don't count for the mode. driver is 1 if any place was reached as a driver.
    Ids number a person's tours, each followed by its subtours.
    """
    first = F.row_number().over(W.partitionBy(*keys).orderBy(order)) == 1
    rows = with_subtour_rows(tours, keys, order) if keys[-1] == "tour" else tours.withColumns({"aside": F.lit(0), "subtours": F.lit(0)})
    rows = rows.withColumn("_anchor", first)
    drove = F.array_contains("modes", "DRIVER") if "modes" in tours.columns else F.col("modename") == "DRIVER"
    out = rows.groupBy(*keys).agg(
        F.min_by(F.struct("x", "y", "dep"), order).alias("_o"), F.max_by(F.struct("x", "y", "arr"), order).alias("_e"),
        F.min_by(F.when(F.col("primary") == 1, F.struct("aggact", "x", "y")), F.when(F.col("primary") == 1, F.col(order))).alias("_p"),
        tour_mode(F.when(~F.col("_anchor") & (F.col("aside") == 0), F.col("code"))).alias("tour_mode"), F.count("*").alias("places"),
        F.coalesce(F.max(drove.cast("int")), F.lit(0)).alias("driver"), F.max("subtours").alias("subtours"),
    )
    out = out.select(*keys, F.col("_p.aggact").alias("purpose"), F.col("_o.x").alias("ox"), F.col("_o.y").alias("oy"), F.col("_p.x").alias("dx"), F.col("_p.y").alias("dy"), F.col("_o.dep").alias("dep"), F.col("_e.arr").alias("arr"), "tour_mode", "places", "driver", "subtours")
    out = out.withColumn("minutes", wrapped(F.col("arr") - F.col("dep")))
    if keys[-1] != "tour":
        return out.drop("subtours")
    before = F.coalesce(F.sum("subtours").over(W.partitionBy(*PERSON).orderBy("tour").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    out = out.withColumn("tour_id", (F.col("tour") + before).cast("int"))
    return out.drop("subtours")


def subtour_records(records: DataFrame, subtours: DataFrame, scores: DataFrame) -> DataFrame:
    """One row per subtour, as tour_records: tour_id after its tour's, parent_tour_id and parent_mode.

    subtours: rows of number_work_subtours with the columns of tour_records but primary, which is found here.
    """
    keys = [*PERSON, "tour", "subtour"]
    rows = score_primary_destination(subtours.where("subtour > 0").drop("score", "primary"), scores, keys, "subtour_idx")
    parents = records.select(*PERSON, "tour", F.col("tour_id").alias("parent_tour_id"), F.col("tour_mode").alias("parent_mode"))
    out = tour_records(rows, keys, "subtour_idx").join(parents, [*PERSON, "tour"], "left")
    return out.withColumn("tour_id", F.col("parent_tour_id") + F.col("subtour"))


def child_tours(records: DataFrame, subtours: DataFrame) -> DataFrame:
    """records with child_ids: the ids of their subtours, as text with commas; empty if there are none."""
    found = subtours.where("subtour > 0").groupBy(*PERSON, "tour").agg(F.array_sort(F.collect_set("subtour")).alias("_s"))
    rows = records.join(found, [*PERSON, "tour"], "left")
    ids = F.array_join(F.transform("_s", lambda n: n + F.col("tour_id")), ",")
    return rows.withColumn("child_ids", F.coalesce(ids, F.lit(""))).drop("_s")


def trip_records(tours: DataFrame, keys: list[str] = [*PERSON, "tour"], order: str = "tour_idx", more: tuple[str, ...] = ()) -> DataFrame:  # noqa: B006
    """One row per trip of a tour: trip, ends, inbound (0 or 1), trips on the journey and the tour, persons in the car; and columns in more."""
    s = W.partitionBy(*keys)
    w = s.orderBy(order)
    last = F.max(F.when(F.col("primary") == 1, F.col(order))).over(s)
    first = F.min(F.when(F.col("primary") == 1, F.col(order))).over(s)
    rows = tours.withColumns({"_l": last, "_f": first, "_n": F.count("*").over(s), "_i": F.row_number().over(w), "ox": F.lag("x").over(w), "oy": F.lag("y").over(w), "opurp": F.lag("aggact").over(w)}).where("_i > 1")
    inbound = F.coalesce((F.col(order) > F.col("_l")).cast("int"), F.lit(0))
    side = F.when(inbound == 1, F.col("_n") - F.col("_l")).otherwise(F.coalesce(F.col("_f"), F.col("_n")) - 1)
    return rows.select(
        *keys, (F.col("_i") - 1).alias("trip"), "opurp", F.col("aggact").alias("dpurp"), "ox", "oy", "x", "y", "code", inbound.alias("inbound"),
        side.cast("long").alias("trips_on_journey"), (F.col("_n") - 1).alias("trips_on_tour"), F.when(F.col("code").between(1, 6), F.col("riders")).alias("auto_occ"), *more,
    )


def finish_tours(records: DataFrame, persons: DataFrame, weight: str = "weight") -> DataFrame:
    """records with the person's type and weight; school of university students is University."""
    rows = records.join(persons.select(*PERSON, "ptype", weight), PERSON, "left")
    return rows.withColumn("purpose", F.when(F.col("purpose") == "School/University", F.when(F.col("ptype") == "US", "University").otherwise("School")).otherwise(F.col("purpose")))
