import pytest
from pyspark.sql import functions as F

from wayfold.operators import weights
from wayfold.plans import week
from wayfold.sources.tables import Config

CONFIG = Config(counties=(1, 75))


def test_persons_are_recoded_and_their_places_gated(spark):
    data = [(1, 1, 5, 1, 2, 1, 0, 1, 1, 1, 1, 2, 10, 20, 30, 40), (1, 2, 2, 2, 0, 9, 4, 995, 1, 3, 99, 1, 11, 21, 31, 41)]
    names = "hh pno age gender student employment school_type work_park residence_rent_own residence_type work_county school_county work_zone work_parcel school_zone school_parcel"
    people = spark.createDataFrame(data, ", ".join(f"{n} int" for n in names.split())).withColumns({c: F.lit(None).cast("double") for c in ("work_x", "work_y", "school_x", "school_y")})
    days = spark.createDataFrame([(1, 1, 2, 1)], "hh int, pno int, day int, is_complete int")
    out = {r.pno: r for r in week.reformat_persons(people, weights.day_completeness(days, ["hh", "pno"]), CONFIG).collect()}
    assert (out[1].age, out[1].gender, out[1].ptype, out[1].worker, out[1].work_zone, out[1].school_zone) == (30, 2, 1, 1, 10, -1)
    assert (out[2].age, out[2].ptype, out[2].worker, out[2].work_zone, out[2].school_zone, out[2].free_parking) == (10, 7, 0, -1, 31, -1)
    assert (out[1].tue_complete, out[2].tue_complete, out[1].work_x) == (1, None, -1.0)
    homes = spark.createDataFrame([(1, 999, 3), (2, 4, 1), (3, 995, 1)], "hh int, income_detailed int, income_followup int")
    hh = {r.hh: r for r in week.reformat_households(homes, week.reformat_persons(people, weights.day_completeness(days, ["hh", "pno"]), CONFIG)).collect()}
    assert (hh[1].income, hh[2].income, hh[3].income, hh[1].owner, hh[2].owner) == (62500, 42500, 995, 1, None)


def test_trips_are_recoded(spark):
    names = "trip_id hh pno day_is_complete o_purpose_category d_purpose_category mode_type num_travelers mode_1 mode_2 mode_3 mode_4 transit_access transit_egress driver depart_hour depart_minute depart_second arrive_hour arrive_minute arrive_second o_county d_county o_zone d_zone o_parcel d_parcel"
    data = [(1, 1, 1, 1, 1, 2, 13, 1, 30, None, None, None, 7, 1, 1, 7, 5, 9, 8, 30, 0, 1, 2, 5, 6, 7, 8), (2, 1, 1, 0, *[1] * 23), (3, 1, 1, 1, -1, -1, *[1] * 21)]
    trips = week.reformat_trips(spark.createDataFrame(data, ", ".join(f"{n} int" for n in names.split())), CONFIG)
    out = trips.collect()
    assert len(out) == 1
    r = out[0]
    assert (r.opurp, r.dpurp, r.mode, r.path, r.role, r.dep_hhmm, r.arr, r.depart_time, r.o_zone, r.d_zone, r.d_parcel) == (0, 1, 7, 6, 3, 705, 510, "07:05:09", 5, -1, -1)
    places = spark.createDataFrame([(1, "a"), (9, "b")], "trip_id int, v string")
    assert sorted((p.v, p.pno) for p in week.attach_person(places, trips).collect()) == [("a", 1), ("b", None)]


def test_further_jobs_and_own_words(spark):
    from wayfold.operators import places

    c = F.col
    df = spark.createDataFrame([(1, 30, 20, 20), (2, 30, 20, 20), (3, 10, 10, 20), (0, 5, 5, 5)], "j int, a int, b int, c int")
    assert [r[0] for r in df.select(places.hours_of_jobs(c("j"), c("a"), c("b"), c("c"))).collect()] == [30, 50, 40, None]
    kinds = spark.createDataFrame([(97, " union class", 1, 40), (97, "GED", 1, 40), (97, "?", 1, 17), (None, None, 1, 20), (99, None, 1, 10), (97, "GED", 0, 40), (3, "GED", 1, 9)], "l int, w string, s int, a int")
    assert [r[0] for r in kinds.select(places.school_level(c("l"), c("w"), c("s"), c("a"))).collect()] == [5, 4, 4, 5, 4, 97, 3]
    df = spark.createDataFrame([(40, 2, 30, 40), (40, 2, 40, 10)], "age int, jobs int, first int, all int").withColumns({"ageb": F.lit(0), "works": F.lit(1), "student": F.lit(0), "school": F.lit(0)})
    kind = places.person_type_8(c("age"), c("ageb"), c("works"), c("all"), c("student"), c("school"), c("first"))
    assert [r[0] for r in df.select(kind).collect()] == ["FW", "PW"]
    homes = spark.createDataFrame([(1, 9, 5, 5)], "hh int, htaz int, hx int, hy int")
    people = spark.createDataFrame([(1, p, 40, None, 1, jobs, 10, 3, None, 7, 7, 8, 5, 6) for p, jobs in ((1, 1), (2, 2), (3, 3))], "hh int, pno int, age int, ageb int, works int, jobs int, hours int, wloc int, wtaz int, wx int, wy int, stude int, hours2 int, hours3 int")
    seen = spark.createDataFrame([(1, 1, 97, "studying"), (1, 2, 5, None), (1, 3, 97, None)], "hh int, pno int, tpurp int, o_tpurp string")
    out = places.clean_persons(people, homes, seen)
    assert sorted((r.pno, r.hours2, r.hours3, r.student) for r in out.collect()) == [(1, 0, 0, 1), (2, 5, 0, 0), (3, 5, 6, 0)]
    spots = spark.createDataFrame([(1, 1, 97, "x", w, 1, 2, 1, 1, 1) for w in ("eat", "Studying", "", "?", None)], "hh int, pno int, tpurp int, pname string, o_tpurp string, mode int, riders int, taz int, x int, y int")
    got = places.clean_places(spots, people.select("hh", "pno", "wx", "wy"), homes)
    assert [r.aggact for r in got.collect()] == ["EatOut", "School/University", "Discretionary", "NA", "NA"]


def reported(spark):
    """Home, out to work by way of a change, lunch, back to work, home over midnight; then a day without trips and one from elsewhere."""
    data = [(1, 0, 480, 485, 0, 10, 1, 1), (2, 0, 490, 520, 10, 1, 6, 0), (3, 0, 720, 725, 1, 6, 1, 0), (4, 0, 780, 785, 6, 1, 1, 0), (5, 0, 1420, 20, 1, 0, 7, 4), (6, 1, 600, 630, 0, 5, 3, 1), (7, 1, 700, 730, 5, 0, 3, 1), (8, 4, 100, 130, 7, 5, 3, 1)]
    spots = {0: (3, 4), 1: (5, 6), 10: (9, 9), 6: (7, 7), 5: (8, 8)}
    rows = [(1, 1, s, 1 + ix % 7, ix, dep, arr, o, d, m, path, *spots.get(o, (-1, -1)), *spots[d]) for s, ix, dep, arr, o, d, m, path in data]
    out = spark.createDataFrame(rows, "hh int, pno int, seq int, day int, day_ix int, dep int, arr int, opurp int, dpurp int, mode int, path int, ox int, oy int, x int, y int")
    return out.withColumns({"mode_type": F.col("mode"), "otaz": F.col("ox") * 10, "opcl": F.col("oy") * 100, "dtaz": F.col("x") * 10, "dpcl": F.col("y") * 100, "role": F.lit(2)})


def test_records_of_tours_and_trips_have_their_ends(spark):
    persons = spark.createDataFrame([(1, 1, 1, 3, 4, 31, 41, 5, 6, 51, 61)], "hh int, pno int, ptype int, hx int, hy int, htaz int, hpcl int, wx int, wy int, wtaz int, wpcl int")
    out = week.week_pipeline(reported(spark), persons=persons)
    tours = sorted(tuple(r)[3:] for r in out.tour_output.collect())
    assert tours == [
        (1, 0, 1, 1, 800, 840, 2340, 20, 1, 2, 41, 31, 600, 50, 3, 4, 5, 6, 7, 4, 1, 1, 0.3333333333333333),
        (2, 1, 1, 6, 1200, 1205, 1300, 1305, 2, 4, 600, 50, 700, 70, 5, 6, 7, 7, 1, 0, 1, 1, 0.3333333333333333),
        (3, 0, 0, 5, 1000, 1030, 1140, 1210, 1, 4, 41, 31, 800, 80, 3, 4, 8, 8, 3, 1, 1, 1, 0.3333333333333333),
    ]
    legs = {(r.tour, r.half, r.tseg): r for r in out.trip_output.collect()}
    assert sorted(legs) == [(1, 1, 1), (1, 2, 1), (1, 2, 2), (2, 1, 1), (2, 2, 1), (3, 1, 1), (3, 2, 1)]
    first, ride, car = legs[1, 1, 1], legs[1, 2, 1], legs[1, 2, 2]
    assert (first.opurp, first.dpurp, first.oadtyp, first.dadtyp, first.otaz, first.dtaz, first.deptm, first.arrtm, first.endacttm, first.dorp) == (0, 1, 1, 2, 31, 50, 800, 840, 1200, 2)
    assert (ride.mode, ride.pathtype, ride.dpurp, ride.dadtyp, ride.dpcl, ride.deptm, ride.arrtm, ride.endacttm, ride.dorp) == (6, 4, 10, 6, -1, 2340, 0, 1, 1)
    assert (car.mode, car.opurp, car.oadtyp, car.otaz, car.dpcl, car.dtaz, car.deptm, car.arrtm) == (3, 10, 6, -1, 41, 31, 1, 20)
    days = {r.day: r for r in out.day_output.collect()}
    assert [(days[d].hbtours, days[d].wbtours, days[d].uwtours, days[d].wktours, days[d].shtours, days[d].beghom, days[d].endhom) for d in (1, 2, 5)] == [(1, 1, 1, 1, 0, 1, 1), (1, 0, 0, 0, 1, 1, 1), (0, 0, 0, 0, 0, 0, 0)]
    late = next(r for r in out.walked.where("day_ix = 4").collect())
    assert (late.otype, late.ox, late.otaz, late.opcl, late.opurp) == (5, -1, 0, 0, 4)  # no trip the day before, and from elsewhere
    with pytest.raises(ValueError, match="persons"):
        week.week_pipeline(reported(spark)).tour_output.count()


def test_stages_save_the_work_of_a_week(spark):
    from wayfold.sources.tables import Stages

    with Stages(spark) as stages:
        out = week.week_pipeline(reported(spark), stages=stages)
        plain = week.week_pipeline(reported(spark))
        for name in ("tours", "person_days"):
            one, two = getattr(out, name), getattr(plain, name)
            assert sorted(map(tuple, one.select(two.columns).collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)
            plan = one._jdf.queryExecution().executedPlan().toString()
            assert "collect_list" not in plan  # chains aren't linked again
        scans = out.person_days._jdf.queryExecution().optimizedPlan().toString().count("Relation spark_catalog")
        assert scans <= 8  # of stages; none of the trips
        assert len(stages.kept) == 3


def test_reported_tables_become_all_outputs(spark):
    persons = spark.createDataFrame([(1, 1, 6, 1, 1, 2, 0, 1, 1, 1, 1, 1, 51, 61, 0, 0, 5.0, 6.0, None, None, 2.5)], "hh int, pno int, age int, gender int, employment int, student int, school_type int, work_park int, residence_rent_own int, residence_type int, work_county int, school_county int, work_zone int, work_parcel int, school_zone int, school_parcel int, work_x double, work_y double, school_x double, school_y double, person_weight double")
    homes = spark.createDataFrame([(1, 999, 3, 3.0, 4.0, 31, 41), (2, 4, 1, 0.0, 0.0, 9, 9)], "hh int, income_detailed int, income_followup int, home_x double, home_y double, home_zone int, home_parcel int")
    days = spark.createDataFrame([(1, 1, d, 1) for d in (2, 3)], "hh int, pno int, day int, is_complete int")
    names = "trip_id hh pno trip_num travel_dow day_is_complete o_purpose_category d_purpose_category mode_type num_travelers mode_1 mode_2 mode_3 mode_4 transit_access transit_egress driver depart_hour depart_minute depart_second arrive_hour arrive_minute arrive_second o_county d_county o_zone d_zone o_parcel d_parcel o_x o_y d_x d_y"
    trip = lambda i, dow, ok, o, d, h, ends: (i, 1, 1, i, dow, ok, o, d, 8, 1, None, None, None, None, None, None, 1, h, 0, 0, h, 30, 0, 1, 1, *ends)
    out_, back = (31, 99, 41, 98, 3, 4, 5, 6), (99, 31, 98, 41, 5, 6, 3, 4)
    trips = spark.createDataFrame([trip(2, 2, 1, 2, 1, 17, back), trip(1, 2, 1, 1, 2, 8, out_), trip(3, 4, 0, 1, 2, 8, out_)], ", ".join(f"{n} int" for n in names.split()))
    got = week.week_from_reported(trips, persons, homes, days, Config(counties=(1,)))
    assert [(r.pno, r.ptype, r.work_zone, r.expansion) for r in got.persons.collect()] == [(1, 1, 51, 2.5)]
    assert sorted((r.hh, r.income, r.members, r.hhftw) for r in got.households.collect()) == [(1, 62500, 1, 1), (2, 42500, 0, 0)]
    (tour,) = got.week.tour_output.collect()
    assert (tour.pdpurp, tour.day, tour.tlvorig, tour.tardest, tour.tlvdest, tour.tarorig, tour.toadtyp, tour.tdadtyp, tour.totaz, tour.topcl, tour.tdtaz, tour.tmodetp, tour.tpathtp, tour.toexpfac) == (1, 2, 800, 830, 1700, 1730, 1, 2, 31, 41, 99, 3, 1, 1.25)
    assert sorted((r.half, r.otaz, r.dtaz, r.dorp) for r in got.week.trip_output.collect()) == [(1, 31, 99, 1), (2, 99, 31, 1)]
    assert sorted((r.day, r.hbtours, r.uwtours, r.pdexpfac) for r in got.week.day_output.collect()) == [(2, 1, 1, 1.25), (3, 0, 0, 1.25)]


def test_joint_tours_of_the_place_pipeline(spark):
    from wayfold.plans import place

    def day(pno, acts, late=0):
        return [(1, pno, i + 1, a, "DRIVER", i % 3, 0, (i - 1) % 3, 0, i * 60 + late, i * 60 + 10 + late, (i - 1) * 60 + 10 + late) for i, a in enumerate(acts)]

    rows = day(1, ["Home", "Shopping", "Home", "Work", "Home"]) + day(2, ["Home", "Shopping", "Home"], 3) + day(3, ["Home", "Shopping", "Home"], 30)
    df = spark.createDataFrame(rows, "hh int, pno int, seq int, aggact string, modename string, x int, y int, ox int, oy int, arr int, dep int, odep int").withColumns({"minutes": F.lit(5), "miles": F.lit(1), "toll": F.lit(2), "riders": F.lit(2), "act_dur": F.lit(10)})
    scores = spark.createDataFrame([(a, k, *range(10, 1, -1)) for k, a in enumerate(("Work", "Shopping"))], "label string, tpurp int, " + ", ".join(f"d{k} int" for k in range(0, 481, 60)))
    people = spark.createDataFrame([(1, 1, "FW"), (1, 2, "PS"), (1, 3, "FW")], "hh int, pno int, ptype string")
    out = place.place_pipeline(df, scores, people)
    # the two leave three minutes apart; records differ in the minute of leaving, so each of them is kept
    assert sorted((r.pno, r.tour, r.purpose, r.joint_no, r.size, r.person_1, r.person_2, r.composition) for r in out.joint_tours.collect()) == [(1, 1, "Shopping", 1, 2, 1, 2, 3), (2, 1, "Shopping", 2, 2, 2, 1, 3)]
    once = place.place_pipeline(df, scores, people, place.Joint(same=("ox", "oy", "dx", "dy")))
    assert sorted((r.pno, r.tour, r.joint_no) for r in once.joint_tours.collect()) == [(1, 1, 1)]
    assert sorted((r.pno, r.tour) for r in once.individual_tours.collect()) == [(1, 2), (3, 1)]
    assert sorted((r.pno, r.tour, r.party_text, r.joint_no) for r in once.trips.where("pno = 1").collect()) == [(1, 1, "1.2", 1), (1, 1, "1.2", 1), (1, 2, "1", None), (1, 2, "1", None)]
