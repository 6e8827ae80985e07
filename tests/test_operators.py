from pyspark.sql import functions as F

from wayfold.operators import joint, places, relational, sequence, spatial, tours, weights
from wayfold.plans import place, week


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def trips(spark, purposes, modes=None, acts=None):
    n = len(purposes)
    data = [(1, 1, i + 1, 1 + i // 4, i // 4, (60 * i) % 1440, (60 * i + 20) % 1440, purposes[i - 1] if i else None, purposes[i], (modes or [3] * n)[i], (acts or [10] * n)[i], int(i + 1 < n)) for i in range(n)]
    return spark.createDataFrame(data, "hh int, pno int, seq int, day int, day_ix int, dep int, arr int, opurp int, dpurp int, mode int, act_dur int, has_next int").withColumns({"path": F.lit(0), "ox": F.col("seq"), "oy": F.lit(0), "x": F.col("seq") + 1, "y": F.lit(0), "mode_type": F.col("mode")})


def test_update_from_takes_the_first_match_and_keeps_unmatched(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    s = spark.createDataFrame([(1, "z"), (1, "y"), (3, "n"), (2, None)], "k int, w string")
    assert rows(relational.update_from(t, s, ["k"], {"v": "w"}), "k", "v") == [(1, "y"), (2, "b"), (3, "n")]


def test_modal_value_prefers_the_smallest_of_equal_ones(spark):
    t = spark.createDataFrame([(1, 5), (1, 3), (1, 5), (1, 3), (2, 7)], "k int, v int")
    assert rows(relational.modal_value(t, ["k"], "v"), "k", "v") == [(1, 3), (2, 7)]


def test_pivot_has_a_fixed_schema(spark):
    t = spark.createDataFrame([(1, 2)], "k int, d int")
    out = relational.pivot_fixed(t, ["k"], "d", {1: "a", 2: "b", 3: "c"}, F.count(F.lit(1)))
    assert out.columns == ["k", "a", "b", "c"]
    assert rows(out, "a", "b", "c") == [(0, 1, 0)]


def test_completeness_and_weights(spark):
    days = spark.createDataFrame([(1, 1, 2, 1), (1, 1, 3, 1), (1, 1, 6, 1), (1, 1, 5, 0)], "hh int, pno int, day int, is_complete int")
    out = weights.day_completeness(days, ["hh", "pno"])
    assert rows(out, "num_days_complete_3dayweekday", "num_days_complete_5dayweekday", "sat_complete") == [(2, 2, 1)]
    assert rows(weights.complete_person_days(out, ["hh", "pno"]), "day") == [(2,), (3,), (6,)]
    w = weights.expansion_weights(out.withColumns({"w": F.lit(10.0), "day": F.lit(2)}), "w", "num_days_complete_5dayweekday", F.col("day"))
    assert rows(w, "expansion") == [(5.0,)]


def test_chain_mode_accumulates(spark):
    # walk, bus, car over short changes: the bus is reached on foot first (6), then the car makes it drive-transit (7)
    t = trips(spark, [10, 10, 1], modes=[1, 6, 3], acts=[30, 30, 500])
    heads = sequence.chain_heads(t)
    assert rows(heads, "seq", "chain", "chain_mode", "linked_on") == [(1, 1, 1, 1), (2, 1, 6, 1), (3, 1, 7, 0)]
    assert rows(sequence.link_chains(t), "chain", "mode", "dpurp", "segments", "ox", "x") == [(1, 7, 1, 3, 1, 4)]
    assert rows(sequence.access_egress(heads), "chain", "acc_mode", "egr_mode") == [(1, 1, 3)]
    assert rows(sequence.linked_detail(heads), "seq", "del_flag") == [(1, 0), (2, 1), (3, 1)]


def test_chain_needs_a_short_stay_and_rows_are_conserved(spark):
    t = trips(spark, [10, 5, 10, 10], modes=[3, 3, 1, 1], acts=[20, 10, 10, None])
    out = sequence.link_chains(t)
    assert rows(out, "chain", "segments", "dpurp") == [(1, 1, 4), (2, 1, 5), (3, 2, 10)]
    assert out.agg(F.sum("segments")).collect()[0][0] == 4
    assert rows(sequence.link_chains(t, recode_dangling=True).where("chain = 3"), "dpurp") == [(4,)]
    assert sequence.link_chains(t.where("false")).count() == 0


def test_unwrap_clock(spark):
    t = spark.createDataFrame([(1, 1, 1, 0, 600, 610), (1, 1, 2, 0, 1430, 5), (1, 1, 3, 1, 30, 50), (1, 1, 4, 5, 10, 20)], "hh int, pno int, seq int, day_ix int, dep int, arr int")
    assert rows(sequence.unwrap_clock(t), "seq", "dep_min", "arr_min", "end_min") == [(1, 600, 610, 1430), (2, 1430, 1445, 1470), (3, 1470, 1490, 1680), (4, 10, 20, 1680)]


def test_home_tours_and_their_parts(spark):
    t = trips(spark, [5, 0, 1, 5, 1, 7, 0, 5])
    found = tours.extract_tours(t, tours.leaves(0), tours.returns(0))
    assert rows(found, "tour", "start", "end") == [(1, 3, 7)]
    members = tours.tour_trips(t, tours.leaves(0), tours.returns(0))
    assert rows(members, "seq") == [(3,), (4,), (5,), (6,), (7,)]
    primary = tours.primary_destination(members)
    assert rows(primary, "pseq", "pdpurp") == [(3, 1)]
    assert rows(tours.work_anchor(members), "arrive", "leave") == [(3, 6)]
    assert rows(tours.work_subtours(members), "subtour", "start", "end") == [(1, 4, 5)]
    halves = tours.half_tours(members)
    assert rows(halves, "half", "tseg", "seq") == [(1, 1, 3), (2, 1, 6), (2, 2, 7)]
    assert rows(tours.intermediate_stops(halves), "seq") == [(6,)]


def test_tour_over_too_many_days_is_left_out(spark):
    t = trips(spark, [0, 5, 7, 7, 7, 7, 7, 7, 7, 0])
    assert tours.extract_tours(t, tours.leaves(0), tours.returns(0)).count() == 0
    assert tours.extract_tours(t, tours.leaves(0), tours.returns(0), max_gap=9).count() == 1


def test_drive_transit_splits_and_joins_again(spark):
    t = trips(spark, [0, 1, 0], modes=[3, 7, 7])
    halves = tours.half_tours(tours.tour_trips(t, tours.leaves(0), tours.returns(0)))
    legs = tours.split_drive_transit(halves)
    assert rows(legs, "half", "tseg", "mode", "dpurp") == [(1, 1, 3, 10), (1, 2, 6, 1), (2, 1, 6, 10), (2, 2, 3, 0)]
    assert rows(tours.relink_drive_transit(legs), "half", "mode", "dpurp", "dep", "arr") == rows(halves, "half", "mode", "dpurp", "dep", "arr")


def visited(spark, acts, modes=None):
    data = [(1, 1, i + 1, a, (modes or ["DRIVER"] * len(acts))[i], i, 0, i - 1, 0) for i, a in enumerate(acts)]
    df = spark.createDataFrame(data, "hh int, pno int, seq int, aggact string, modename string, x int, y int, ox int, oy int")
    return df.withColumns({"odep": F.lit(0), "minutes": F.lit(5), "miles": F.lit(1), "toll": F.lit(2), "riders": F.lit(1), "dep": F.col("seq") * 10 + 5, "arr": F.col("seq") * 10, "act_dur": F.lit(30)})


GOLDEN = ["Home", "ChangeMode", "ChangeMode", "Discretionary", "ChangeMode", "Work", "ChangeMode", "ChangeMode", "Home"]


def test_changes_of_mode_are_linked_away(spark):
    legs = places.link_places(visited(spark, GOLDEN + ["ChangeMode"]))
    assert [r.aggact for r in legs.orderBy("leg").collect()] == ["Home", "Discretionary", "Work", "Home"]
    assert rows(legs.where("leg = 1"), "minutes", "rows", "ox", "x", "mode_text") == [(15, 3, 0, 3, "DRIVER-DRIVER-DRIVER")]
    assert legs.agg(F.sum("rows")).collect()[0][0] == len(GOLDEN)


def test_boarding_and_parking(spark):
    legs = places.link_places(visited(spark, ["Home", "ChangeMode", "ChangeMode", "Work"], ["WALK", "DRIVER", "RAIL", "WALK"]))
    assert rows(legs.where("leg = 1"), "board", "alight", "park") == [(2, 3, 2)]


def test_tours_double_the_home_between(spark):
    out = places.number_tours(visited(spark, ["Work", "Home", "Shopping", "Home", "Work", "Shopping", "Work", "Home", "Shopping"]))
    assert rows(out, "seq", "tour", "tour_idx") == sorted([(1, -2, 1), (2, 1, 1), (3, 1, 2), (4, 1, 3), (4, 2, 1), (5, 2, 2), (6, 2, 3), (7, 2, 4), (8, 2, 5), (8, -1, 1), (9, -1, 2)], key=repr)
    sub = places.number_work_subtours(out)
    assert rows(sub, "seq", "subtour") == sorted([(4, -1), (5, 1), (6, 1), (7, 1), (7, -1), (8, -1)], key=repr)


def test_parties_are_symmetric_and_begin_with_the_person(spark):
    data = [(1, 1, 1, 100, 110), (2, 1, 2, 103, 113), (3, 1, 3, 108, 118), (4, 2, 1, 100, 110)]
    df = spark.createDataFrame(data, "event_id int, hh int, pno int, dep int, arr int").withColumns({c: F.lit(1) for c in ("ox", "oy", "x", "y")})
    out = joint.detect_parties(df)
    assert rows(out, "event_id", "party_text") == [(1, "1.2"), (2, "2.1"), (3, "3"), (4, "1")]


def test_joint_tours_are_told_apart(spark):
    df = spark.createDataFrame([(1, 1, 1, [1, 2]), (1, 1, 1, [1, 2]), (1, 2, 1, [2, 1]), (1, 3, 1, [3]), (1, 3, 1, [3, 1])], "hh int, pno int, tour int, party array<int>").withColumn("party_text", F.array_join("party", "."))
    out = joint.classify_joint_tours(df)
    assert rows(out, "pno", "fully_joint", "partly_joint") == [(1, 1, 0), (2, 1, 0), (3, 0, 1)]
    people = spark.createDataFrame([(1, 1, "FW"), (1, 2, "ND"), (1, 3, "PW")], "hh int, pno int, ptype string")
    assert rows(joint.party_fields(out, people, 2), "pno", "size", "composition", "person_1", "person_2")[0] == (1, 2, 3, 1, 2)
    named = out.withColumns({"purpose": F.lit("Shopping"), "subtour": F.lit(0), "day": F.lit(1)})
    alone, together = joint.split_joint(named, ["day"])
    assert rows(alone, "pno") == [(3,)]
    assert rows(together, "pno", "joint_no") == [(1, 1)]


def test_nearest_zone(spark):
    zones = spatial.zones_from_wkt(spark.createDataFrame([(1, "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"), (2, "POLYGON ((2 0, 3 0, 3 1, 2 1, 2 0))")], "zone_id int, wkt string"))
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 0.5), (3, 1.2, 0.5), (4, 9.0, 9.0), (5, None, 1.0)], "point_id int, x double, y double")
    out = spatial.nearest_zone_join(points, zones, 0.6)
    assert [(r.point_id, r.zone_id) for r in out.orderBy("point_id").collect()] == [(1, 1), (2, 1), (3, 1), (4, None), (5, None)]


def test_person_types(spark):
    df = spark.createDataFrame([(3, 1, 0, 1), (40, 1, 2, 0), (17, 9, 0, 4), (20, 9, 0, 4), (30, 9, 1, 0), (50, 2, 2, 0), (70, 9, 2, 0), (50, 9, 2, 0)], "a int, e int, s int, t int")
    out = df.select(week.person_type(*(F.col(c) for c in "aest")).alias("p"), week.worker_type(F.lit(6), F.col("e")).alias("w"))
    assert [r.p for r in out.collect()] == [8, 1, 6, 6, 5, 2, 3, 4]


def test_week_pipeline(spark):
    t = trips(spark, [0, 10, 1, 5, 0, 7, 0]).drop("act_dur", "has_next")
    out = week.week_pipeline(t, max_gap=9)
    assert rows(out.tours, "tour", "pdpurp", "expansion") == [(1, 1, 0.5), (2, 7, 0.5)]
    assert out.linked.agg(F.sum("segments")).collect()[0][0] == 7
    assert out.patterns.count() == 1
    assert out.trips.count() > 0
    assert out.person_days.count() == 2
    assert rows(week.week_pipeline(t.where("false")).tours, "tour") == []


def test_place_pipeline(spark):
    scores = spark.createDataFrame([("Work", 1, *range(10, 1, -1)), ("Discretionary", 2, *range(30, 21, -1))], "label string, tpurp int, " + ", ".join(f"d{k} double" for k in range(0, 481, 60)).replace("double", "int"))
    out = place.place_pipeline(visited(spark, GOLDEN), scores)
    assert rows(out.records, "tour", "purpose", "tour_mode", "places") == [(1, "Work", 1, 4)]
    assert rows(out.trips, "trip", "inbound", "dpurp") == [(1, 0, "Discretionary"), (2, 0, "Work"), (3, 1, "Home")]
    assert rows(out.stops, "out_stops", "in_stops", "out1_aggact") == [(1, 0, "Discretionary")]


def test_result_does_not_depend_on_the_order_of_rows(spark):
    t = trips(spark, [0, 10, 1, 5, 10, 10, 0, 7, 0], modes=[3, 1, 6, 3, 2, 7, 6, 1, 1])
    a, b = sequence.link_chains(t), sequence.link_chains(t.orderBy(F.rand(1)).repartition(3))
    assert rows(a, *a.columns) == rows(b, *a.columns)


def test_short_drive_transit_trips_change_at_the_midpoint(spark):
    data = [(1, 1, 1, h, 1, 7, 0, 1, 600, 600 + m, 2, 2) for h, m in ((1, 1), (2, 2))] + [(1, 1, 1, 3, 1, 7, 0, 1, 600, 603, 2, 2)]
    halves = spark.createDataFrame(data, "hh int, pno int, tour int, half int, tseg int, mode int, opurp int, dpurp int, dep int, arr int, path int, tpath int")
    halves = halves.withColumns({"otaz": F.lit(5), "dtaz": F.lit(6), "otype": F.lit(1), "dtype": F.lit(2)})
    out = tours.split_drive_transit(halves)
    assert rows(out, "half", "tseg", "dep", "arr") == [(1, 1, 600, 600), (1, 2, 600, 601), (2, 1, 600, 601), (2, 2, 601, 602), (3, 1, 600, 601), (3, 2, 602, 603)]
    assert rows(out.where("half = 1"), "tseg", "mode", "path", "otaz", "dtaz", "otype", "dtype") == [(1, 3, 0, 5, -1, 1, 6), (2, 6, 2, -1, 6, 6, 2)]
    assert rows(out.where("half = 2"), "tseg", "mode", "path") == [(1, 6, 2), (2, 3, 0)]


def test_subtours_in_the_week_pipeline_and_a_complete_day_without_trips(spark):
    t = trips(spark, [0, 1, 5, 1, 0]).drop("act_dur", "has_next")
    days = spark.createDataFrame([(1, 1, d, int(d != 4)) for d in range(1, 6)] + [(1, 2, 1, 1)], "hh int, pno int, day int, is_complete int")
    out = week.week_pipeline(t, max_gap=9, days=days)
    assert rows(out.tours, "tour", "subtour", "pdpurp", "tour_no", "parent", "subtrs", "expansion") == [(1, 0, 1, 1, 0, 1, 0.25), (1, 1, 5, 2, 1, 1, 0.25)]
    assert rows(out.trips, "tour_no", "half", "tseg", "dpurp") == [(1, 1, 1, 1), (1, 2, 1, 0), (2, 1, 1, 5), (2, 2, 1, 1)]
    assert rows(out.person_days, "pno", "day", "trips", "wktours", "wbtours", "shstops") == [(1, 1, 4, 1, 1, 0), (1, 2, 1, 0, 0, 0), (1, 3, 0, 0, 0, 0), (1, 5, 0, 0, 0, 0), (2, 1, 0, 0, 0, 0)]
    assert rows(out.patterns, "wktours", "shstops") == [(1, 1)]
    people = spark.createDataFrame([(1, 1, 1)], "hh int, pno int, ptype int")
    homes = spark.createDataFrame([(1,), (2,)], "hh int")
    assert rows(week.household_counts(people, homes), "hh", "members", "hhftw", "hhwkrs") == [(1, 1, 1, 1), (2, 0, 0, 0)]


def test_a_person_with_very_many_trips(spark):
    import time

    n = 50_000
    t = spark.range(n).select(F.lit(1).alias("hh"), F.lit(1).alias("pno"), (F.col("id") + 1).cast("int").alias("seq"), F.expr("cast(id div 40 as int)").alias("day_ix"), (F.col("id") % 40 * 30).cast("int").alias("dep"), (F.col("id") % 40 * 30 + 20).cast("int").alias("arr"))
    t = t.withColumns({"day": F.lit(1), "opurp": F.lit(10), "dpurp": F.lit(10), "mode": F.lit(1), "path": F.lit(0), "ox": F.lit(0), "oy": F.lit(0), "x": F.lit(0), "y": F.lit(0)})
    began = time.time()
    linked = sequence.link_chains(sequence.activity_duration(t))
    assert linked.agg(F.sum("segments")).collect()[0][0] == n
    assert sequence.unwrap_clock(t).where("arr_min < dep_min").count() == 0
    same = t.withColumns({"ox": F.lit(1), "pno": (F.col("seq") % 3).cast("int")})
    assert joint.detect_parties(same).where("size(party) = 3").count() == n  # times of day, whatever the day
    assert time.time() - began < 90


def test_unwrapped_clocks_equal_a_loop(spark):
    import random

    r = random.Random(5)
    data, want = [], []
    for pno in range(30):
        day, t, before = 0, 0, None
        for seq in range(r.randint(1, 30)):
            day += r.choice([0, 0, 0, 1, 2])
            dep, arr = r.randrange(1440), r.randrange(1440)
            t = 0 if before is None or day - before > 1 else t
            d = dep + 1440 if dep < t else dep
            a = arr + 1440 if arr < d else arr
            data.append((1, pno, seq, day, dep, arr))
            want.append((pno, seq, d, a))
            t, before = a, day
    out = sequence.unwrap_clock(spark.createDataFrame(data, "hh int, pno int, seq int, day_ix int, dep int, arr int"))
    assert rows(out, "pno", "seq", "dep_min", "arr_min") == sorted(want, key=repr)


def test_joint_tours_need_a_partner_in_the_file(spark):
    df = spark.createDataFrame([(1, 1, 1, 1, 0, 5, 6), (1, 2, 1, 1, 0, 5, 6), (1, 3, 1, 1, 0, 5, 9), (1, 4, 1, 1, 0, 7, 6), (1, 5, 1, 0, 1, 5, 6)], "hh int, pno int, tour int, fully_joint int, partly_joint int, o int, d int")
    df = df.withColumns({"purpose": F.lit("Shopping"), "subtour": F.lit(0)})
    out = joint.identified(df, ["o", "d"])
    assert rows(out, "pno", "identify") == [(1, 1), (2, 1), (3, 0), (4, 0), (5, None)]
    assert rows(joint.identified(df, ["o", "d"], same_row=False), "pno", "identify")[:4] == [(1, 1), (2, 1), (3, 0), (4, 0)]
    alone, together = joint.split_joint(out, ["o", "d"], identify=True)
    assert rows(alone, "pno", "fully_joint", "partly_joint") == [(3, 0, 1), (4, 0, 1), (5, 0, 1)]
    assert rows(together, "pno", "joint_no") == [(1, 1)]


def test_a_person_listed_with_two_types(spark):
    tours_ = spark.createDataFrame([(1, 1, 1, [1, 2])], "hh int, pno int, tour int, party array<int>")
    people = spark.createDataFrame([(1, 1, "PW"), (1, 1, "FW"), (1, 2, "ND")], "hh int, pno int, ptype string")
    assert rows(joint.party_fields(tours_, people, 2), "type_1", "type_2", "composition") == [("FW", "ND", 3)]


def test_zones_of_several_roles(spark):
    zones = spatial.zones_from_wkt(spark.createDataFrame([(1, "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"), (2, "MULTIPOLYGON (((2 0, 3 0, 3 1, 2 1, 2 0)), ((8 0, 9 0, 9 1, 8 1, 8 0)))")], "zone_id int, wkt string"))
    assert [len(r.edges) for r in zones.orderBy("zone_id").collect()] == [4, 8]
    points = spark.createDataFrame([(1, 0.5, 0.5, 8.5, 0.5), (2, None, None, 5.0, 5.0)], "point_id int, hx double, hy double, wx double, wy double")
    out = spatial.nearest_zones(points, zones, 0.6, {"home": ("hx", "hy"), "work": ("wx", "wy")})
    assert rows(out, "point_id", "home_zone", "work_zone") == [(1, 1, 2), (2, None, None)]


def test_subtour_records_follow_their_tour(spark):
    scores = spark.createDataFrame([("Work", 1, *range(10, 1, -1)), ("EatOut", 2, *range(30, 21, -1))], "label string, tpurp int, " + ", ".join(f"d{k} int" for k in range(0, 481, 60)))
    out = place.place_pipeline(visited(spark, ["Home", "Work", "EatOut", "Work", "Home", "Shopping", "Home"], ["DRIVER", "DRIVER", "WALK", "WALK", "DRIVER", "WALK", "WALK"]), scores)
    assert rows(out.records, "tour", "tour_id", "tour_mode", "driver", "child_ids") == [(1, 1, 1, 1, "2"), (2, 3, 7, 1, "")]
    assert rows(out.subtour_records, "tour", "subtour", "tour_id", "purpose", "tour_mode", "parent_tour_id", "parent_mode") == [(1, 1, 2, "EatOut", 7, 1, 1)]


def plain_link(a, b, minutes, limit=35, short=15):
    """The mode of two segments as one, or None; what linked_mode says, for numbers."""
    walk, drive, transit = {0, 1, 2}, {3, 4, 5, 9}, {6, 7}
    if minutes is None:
        return None
    if minutes <= limit and ((a in walk and b == 6) or (a == 6 and b in walk)):
        return 6
    if minutes <= limit and ((a in walk | drive and b in transit) or (b in walk | drive and a in transit)):
        return 7
    return max(a, b) if (minutes <= limit and a in transit and b in transit) or minutes <= short else None


def test_chains_equal_a_loop_whatever_the_blocks(spark, monkeypatch):
    import random

    r = random.Random(11)
    data, want = [], []
    for pno in range(12):
        n = r.choice([1, 2, 5, 40, 90])
        chain, mode, into = None, None, None
        for seq in range(1, n + 1):
            purpose, m, stay, more = r.choice([10, 10, 10, 10, 10, 10, 1]), r.randrange(10), r.choice([5, 15, 16, 30, 35, 36, None]), int(seq < n)
            both = plain_link(mode, m, into) if mode is not None else None
            chain, mode = (chain, both) if both is not None else (seq, m)
            data.append((1, pno, seq, purpose, m, stay, more))
            want.append((pno, seq, chain, mode))
            into = (14400 if stay is None else stay) if purpose == 10 and more else None
    t = spark.createDataFrame(data, "hh int, pno int, seq int, dpurp int, mode int, act_dur int, has_next int").repartition(3)
    for block in (2, 3, 128):
        monkeypatch.setattr(sequence, "BLOCK", block)
        assert rows(sequence.chain_heads(t), "pno", "seq", "chain", "chain_mode") == sorted(want, key=repr)


def test_parties_equal_brute_force(spark):
    import random

    r = random.Random(4)
    data = [(i, r.choice([1, 1, 2]), r.choice([1, 2]), r.randrange(5), r.choice([None, *range(90, 130)]), r.randrange(100, 112), r.choice([1, 1, None]), r.choice([1, 2])) for i in range(300)]
    names = "event_id int, hh int, day int, pno int, dep int, arr int, ox int, x int"
    df = spark.createDataFrame(data, names)
    for minutes, day in ((4, None), (4, "day"), (0, None), (7, "day")):
        got = rows(joint.detect_parties(df, minutes, places=("ox", "x"), day=day), "event_id", "party_text")
        want = []
        for i, hh, d, p, dep, arr, ox, x in data:
            mates = {q for _, h2, d2, q, e2, a2, o2, x2 in data if h2 == hh and (day is None or d2 == d) and None not in (ox, dep, e2) and (o2, x2) == (ox, x) and q != p and abs(e2 - dep) <= minutes and abs(a2 - arr) <= minutes}
            want.append((i, ".".join(map(str, [p, *sorted(mates)]))))
        assert got == sorted(want, key=repr)


def test_long_chains_and_crowded_departures_take_time_in_proportion(spark):
    import time

    def seconds(n):
        t = spark.range(n).select(F.lit(1).alias("hh"), F.lit(1).alias("pno"), (F.col("id") + 1).cast("int").alias("seq"), F.lit(10).alias("dpurp"), (F.col("id") % 9).cast("int").alias("mode"), F.lit(5).alias("act_dur"), F.lit(1).alias("has_next"))
        began = time.time()
        assert sequence.chain_heads(t).where("linked_on = 1").count() > 0
        crowd = t.select("hh", "seq", (F.col("seq") % 4).alias("pno"), (F.col("seq") % 7).alias("dep"), (F.col("seq") % 11).alias("arr"), F.lit(1).alias("ox"))
        assert joint.detect_parties(crowd, places=("ox",)).where("size(party) = 4").count() == n
        return time.time() - began

    seconds(20_000)
    small, large = (min(seconds(n) for _ in range(2)) for n in (50_000, 200_000))
    assert large < 2.3**2 * small


def square(x, y, side):
    c = [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]
    return [(*a, *b) for a, b in zip(c, c[1:], strict=False)]


def test_zones_of_unlike_sizes_are_listed_in_few_cells(spark):
    squares = [(i, i % 30 * 2.0, i // 30 * 2.0, 1.0) for i in range(600)] + [(1000, -500.3, -400.7, 1000.0), (1001, 3.0, 3.0, 0.0)]
    zones = spark.createDataFrame([(z, square(x, y, s)) for z, x, y, s in squares], "zone_id int, edges array<struct<x1:double,y1:double,x2:double,y2:double>>")
    cells = spatial.zone_cells(zones, 0.25).groupBy("zone_id").count()
    assert cells.agg(F.max("count")).first()[0] <= 4 and cells.count() == len(squares)
    spots = [(p, (p * 37 % 700) / 10.0 - 5, (p * 91 % 500) / 10.0 - 4) for p in range(400)] + [(900, -499.0, 590.0), (901, 5000.0, 0.0), (902, None, 1.0)]
    out = spatial.nearest_zone_join(spark.createDataFrame(spots, "point_id int, x double, y double"), zones, 0.25)
    gap = lambda v, a, s: max(a - v, 0.0, v - a - s)
    want = {}
    for p, x, y in spots:
        near = [] if x is None else [(round((gap(x, a, s) ** 2 + gap(y, b, s) ** 2) ** 0.5, 9), z) for z, a, b, s in squares]
        best = min(near, default=None)
        want[p] = best[1] if best and best[0] <= 0.25 else None
    assert {r.point_id: r.zone_id for r in out.collect()} == want


def test_dense_numbers_of_a_whole_table_need_no_single_task(spark):
    rows_ = [(i * 7 % 50, "ab"[i % 2] if i % 5 else None) for i in range(300)]
    df = spark.createDataFrame(rows_, "k int, s string")
    out = relational.dense_numbers(df, ["s", "k"], "n")
    keys = sorted(set(rows_), key=lambda r: (r[1] is not None, r[1] or "", r[0]))
    number = {key: i + 1 for i, key in enumerate(keys)}
    assert sorted((r.k, r.s or "", r.n) for r in out.collect()) == sorted((k, s or "", number[k, s]) for k, s in rows_)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" in plan
    assert relational.dense_numbers(df.limit(0), ["k"], "n").count() == 0
