"""Queries over the driver tables, one or more for each operator, with their DuckDB SQL."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import clock, numeric, recode, text
from ..operators import joint, places, relational, sequence, spatial, tours, weights
from ..sources import diary as source
from ..sources.diary import PERSON
from ..sources.tables import alias_columns, append_batch, bulk_load_counted, empty_like, read_csv, shared_folder, tables, with_fallback, write_csv

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str = ""):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# trips: the diary with departures, durations, paths and detailed modes
T = source.SQL + """, t AS (
  SELECT *, ((arr - 5 - k % 30 + 1440) % 1440)::INT AS dep, (k // 25)::INT AS path, (k % 15)::INT AS mode_type FROM d
), u AS (
  SELECT *, (lead(seq) OVER p IS NOT NULL)::INT AS has_next,
    (lead(dep) OVER p - arr + CASE WHEN lead(day_ix) OVER p > day_ix AND lead(dep) OVER p < arr THEN 1440 ELSE 0 END)::INT AS act_dur
  FROM t WINDOW p AS (PARTITION BY hh, pno ORDER BY seq)
)"""


def trips(spark: SparkSession, folder: str) -> DataFrame:
    rows = source.diary(spark, folder)
    return sequence.activity_duration(rows.withColumns({"dep": ((F.col("arr") - 5 - F.col("k") % 30 + 1440) % 1440), "path": F.expr("cast(k div 25 as int)"), "mode_type": F.col("k") % 15}))


# tours from home, their members, primary destinations and halves
TOURS = T + """, h AS (
  SELECT *, max(CASE WHEN opurp = 0 AND dpurp <> 0 THEN seq END) OVER w AS s FROM u
  WINDOW w AS (PARTITION BY hh, pno ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), c AS (SELECT hh, pno, s AS start, min(seq) AS "end" FROM h WHERE s IS NOT NULL AND opurp <> 0 AND dpurp = 0 GROUP BY hh, pno, s),
tour AS (
  SELECT c.hh, c.pno, c.start, c."end", row_number() OVER (PARTITION BY c.hh, c.pno ORDER BY c.start) AS tour
  FROM c JOIN u a ON a.hh = c.hh AND a.pno = c.pno AND a.seq = c.start JOIN u b ON b.hh = c.hh AND b.pno = c.pno AND b.seq = c."end" WHERE b.day_ix - a.day_ix <= 30
), m AS (SELECT u.*, tour.tour, tour.start, tour."end" FROM u JOIN tour ON u.hh = tour.hh AND u.pno = tour.pno AND u.seq BETWEEN tour.start AND tour."end"),
prim AS (
  SELECT hh, pno, tour, seq AS pseq, dpurp AS pdpurp FROM (
    SELECT *, row_number() OVER (PARTITION BY hh, pno, tour ORDER BY CASE dpurp WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 4 END, coalesce(act_dur, 0) DESC, seq) AS n FROM m WHERE seq < "end"
  ) WHERE n = 1
), anchor AS (
  SELECT p.hh, p.pno, p.tour, pseq, pdpurp, CASE WHEN pdpurp = 1 THEN a ELSE pseq END AS arrive, CASE WHEN pdpurp = 1 THEN coalesce(l, pseq + 1) ELSE pseq + 1 END AS leave
  FROM prim p JOIN (SELECT hh, pno, tour, min(CASE WHEN dpurp = 1 THEN seq END) AS a, max(CASE WHEN opurp = 1 THEN seq END) AS l FROM m GROUP BY hh, pno, tour) e
    ON p.hh = e.hh AND p.pno = e.pno AND p.tour = e.tour
), half AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hh, pno, tour, half ORDER BY seq) AS tseg FROM (
    SELECT m.*, pseq, pdpurp, arrive, leave, CASE WHEN seq <= arrive THEN 1 WHEN seq >= leave THEN 2 END AS half
    FROM m JOIN anchor a ON m.hh = a.hh AND m.pno = a.pno AND m.tour = a.tour) WHERE half IS NOT NULL) WHERE tseg <= 20
)"""
#: Events are hours apart, so tours may take days here.
GAP = 30


def toured(spark, folder) -> DataFrame:
    return tours.with_tours(trips(spark, folder), tours.leaves(source.HOME), tours.returns(source.HOME), max_gap=GAP)


def members_of(spark, folder) -> DataFrame:
    return toured(spark, folder).where("tour IS NOT NULL")


@query(TOURS + " SELECT t.hh, t.pno, t.tour, t.start, t.\"end\", pseq, pdpurp FROM tour t JOIN prim p ON t.hh = p.hh AND t.pno = p.pno AND t.tour = p.tour")
def home_tours(spark, folder):
    rows = tours.with_primary(members_of(spark, folder))
    return rows.where("seq = pseq").select(*PERSON, "tour", "start", "end", "pseq", "pdpurp")


@query("SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 10 WHEN 2 THEN 20 WHEN 3 THEN 30 ELSE l_linenumber END AS passed, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 END AS strict FROM lineitem")
def recode_passthrough(spark, folder):
    (items,) = tables(spark, folder, "lineitem")
    return items.select("l_orderkey", "l_linenumber", recode.recode(F.col("l_linenumber"), {1: 10, 2: 20, 3: 30}).alias("passed"), recode.recode(F.col("l_returnflag"), {"A": 1, "R": 2}, strict=True).alias("strict"))


# persons of the week diary: age, employment, student and school type made from keys
_P = "SELECT c_custkey, (c_custkey % 90)::INT AS age, (c_custkey % 9)::INT AS employment, (c_custkey % 5)::INT AS student, (c_custkey % 8)::INT AS school_type FROM customer"


def persons(spark, folder):
    k = F.col("c_custkey")
    (c,) = tables(spark, folder, "customer")
    return c.select("c_custkey", (k % 90).cast("int").alias("age"), (k % 9).cast("int").alias("employment"), (k % 5).cast("int").alias("student"), (k % 8).cast("int").alias("school_type"))


@query(f"""SELECT *, CASE WHEN ptype IN (1, 2) THEN ptype WHEN ptype IN (5, 6) AND employment IN (1, 2, 3) THEN 2 ELSE 0 END AS worker FROM (
  SELECT *, CASE WHEN age < 5 THEN 8 WHEN age < 16 THEN 7 WHEN employment IN (1, 3, 8) THEN 1 WHEN age < 18 AND student IN (0, 1, 3, 4) THEN 6
    WHEN age < 25 AND school_type IN (4, 7) AND student IN (0, 1, 3, 4) THEN 6 WHEN student IN (0, 1, 3, 4) THEN 5 WHEN employment IN (2, 3, 7) THEN 2 WHEN age < 65 THEN 4 ELSE 3 END AS ptype FROM ({_P}))""")
def person_type_case(spark, folder):
    from .week import person_type, worker_type

    p = persons(spark, folder)
    p = p.withColumn("ptype", person_type(*(F.col(c) for c in ("age", "employment", "student", "school_type"))))
    return p.withColumn("worker", worker_type(F.col("ptype"), F.col("employment")))


@query("""WITH p AS (SELECT c_custkey, (c_custkey % 110)::INT AS age, (c_custkey % 3)::INT AS ageb, (c_custkey % 2 + 1)::INT AS works, (c_custkey % 60)::INT AS hours, (c_custkey % 7 % 2)::INT AS student, (c_custkey % 9)::INT AS school FROM customer)
SELECT *, CASE WHEN ((age >= 17 AND age < 998) OR ageb = 2) AND student = 1 AND school BETWEEN 5 AND 8 THEN 'US' WHEN student = 1 AND age BETWEEN 16 AND 19 AND school BETWEEN 1 AND 4 THEN 'DS'
  WHEN works = 1 AND ((age >= 16 AND age < 998) OR ageb IN (1, 2)) AND student = 0 AND hours >= 35 THEN 'FW' WHEN works = 1 AND ((age >= 16 AND age < 998) OR ageb IN (1, 2)) AND student = 0 THEN 'PW'
  WHEN works = 2 AND student = 0 AND (age BETWEEN 16 AND 64 OR ageb = 2) THEN 'NW' WHEN works = 2 AND student = 0 AND ((age >= 65 AND age < 998) OR ageb = 1) THEN 'RE'
  WHEN age BETWEEN 6 AND 15 THEN 'ND' WHEN age < 6 THEN 'PS' WHEN age >= 19 AND works = 1 AND hours >= 35 THEN 'FW' WHEN age >= 19 AND works = 1 THEN 'PW'
  WHEN age <= 30 AND works = 2 AND student = 1 THEN 'US' WHEN age BETWEEN 30 AND 64 AND works = 2 THEN 'NW' WHEN age >= 65 AND age < 998 AND works = 2 THEN 'RE' ELSE 'NA' END AS ptype FROM p""")
def person_type_place(spark, folder):
    k = F.col("c_custkey")
    (c,) = tables(spark, folder, "customer")
    p = c.select("c_custkey", *(e.cast("int").alias(n) for n, e in {"age": k % 110, "ageb": k % 3, "works": k % 2 + 1, "hours": k % 60, "student": k % 7 % 2, "school": k % 9}.items()))
    return p.withColumn("ptype", places.person_type_8(*(F.col(n) for n in ("age", "ageb", "works", "hours", "student", "school"))))


@query(T + " SELECT event_id, printf('%02d:%02d:%02d', arr // 60, arr % 60, k % 60) AS clock, arr // 60 * 100 + arr % 60 AS hhmm, arr AS back, (dep // 60 * 100 + dep % 60) AS dep_hhmm, CASE WHEN arr < dep THEN arr - dep + 1440 ELSE arr - dep END AS minutes, dep + CASE WHEN arr < dep THEN floor((arr - dep) / 2)::INT ELSE (arr - dep) // 2 END AS middle FROM u")
def clock_format(spark, folder):
    hhmm = clock.min_to_hhmm(F.col("arr"))
    return trips(spark, folder).select(
        "event_id", clock.clock_text(clock.div(F.col("arr"), 60), F.col("arr") % 60, F.col("k") % 60).alias("clock"), hhmm.alias("hhmm"), clock.hhmm_to_min(hhmm).alias("back"),
        clock.min_to_hhmm(F.col("dep")).alias("dep_hhmm"), clock.wrapped(F.col("arr") - F.col("dep")).alias("minutes"), clock.midpoint(F.col("dep"), F.col("arr")).alias("middle"),
    )


@query("SELECT o_orderkey, o_orderkey // 100 AS household, (o_orderkey % 100)::INT AS person, o_orderstatus AS status, -1 AS parcel FROM orders")
def key_split(spark, folder):
    (o,) = tables(spark, folder, "orders")
    o = alias_columns(with_fallback(o, "o_status", "o_orderstatus"), {"o_status": "status", "absent": "nothing"})
    household, person = recode.split_key(F.col("o_orderkey"))
    return o.select("o_orderkey", household.alias("household"), person.alias("person"), "status", F.lit(-1).alias("parcel"))


# the SQL states values by itself, so that a wrong one in the library is seen
_WEEKDAYS = {1: "mon", 2: "tue", 3: "wed", 4: "thu", 5: "fri", 6: "sat", 7: "sun"}
_DAYS = ", ".join(f"max(CASE WHEN day = {d} THEN 1 ELSE 0 END) AS {n}_complete" for d, n in _WEEKDAYS.items())
_WEEKS = """tue_complete + wed_complete + thu_complete AS num_days_complete_3dayweekday, mon_complete + tue_complete + wed_complete + thu_complete AS num_days_complete_4dayweekday,
  mon_complete + tue_complete + wed_complete + thu_complete + fri_complete AS num_days_complete_5dayweekday"""
COMPLETE = source.SQL + f", pd AS (SELECT hh, pno, {_DAYS} FROM d GROUP BY hh, pno), comp AS (SELECT *, {_WEEKS} FROM pd)"


def completeness(rows):
    return weights.day_completeness(rows.select(*PERSON, "day", F.lit(1).alias("is_complete")), PERSON)


@query(COMPLETE + " SELECT * FROM comp")
def pivot_completeness(spark, folder):
    return completeness(source.diary(spark, folder))


@query(COMPLETE + " SELECT hh, pno, day::INT AS day FROM (" + " UNION ALL ".join(f"SELECT hh, pno, {d} AS day FROM comp WHERE {n}_complete = 1" for d, n in _WEEKDAYS.items()) + ")")
def unpivot_person_days(spark, folder):
    return weights.complete_person_days(completeness(source.diary(spark, folder)), PERSON)


@query(COMPLETE + """, n AS (SELECT hh, pno, day, count(*) AS trips, arg_min(opurp, seq) AS o, arg_max(dpurp, seq) AS z FROM d GROUP BY hh, pno, day),
e AS (SELECT hh, pno, day, bool_or(seq = f AND opurp IS NOT DISTINCT FROM 0) AS b, bool_or(seq = l AND dpurp = 0) AS e FROM (SELECT *, min(seq) OVER g AS f, max(seq) OVER g AS l FROM d WINDOW g AS (PARTITION BY hh, pno, day)) GROUP BY ALL)
SELECT n.hh, n.pno, n.day, trips, b::INT AS beghom, e::INT AS endhom FROM n JOIN e USING (hh, pno, day)""")
def person_days(spark, folder):
    from .week import person_day_records

    return person_day_records(source.diary(spark, folder), completeness(source.diary(spark, folder)))


@query(source.SQL + ", n AS (SELECT hh, pno, day, count(*) AS c FROM d GROUP BY ALL) SELECT hh, pno, day FROM (SELECT *, row_number() OVER (PARTITION BY hh, pno ORDER BY c DESC, day) AS r FROM n) WHERE r = 1")
def modal_day(spark, folder):
    return relational.modal_value(source.diary(spark, folder), PERSON, "day")


@query("SELECT o_custkey, o_orderkey, o_orderpriority, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n = 1")
def first_by_group(spark, folder):
    (o,) = tables(spark, folder, "orders")
    return relational.first_by(o.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus"), ["o_custkey"], ["o_orderkey"])


@query("""SELECT c_custkey, c_mktsegment, o_orderpriority AS first_priority, CASE WHEN c_custkey % 11 > 0 THEN (c_custkey % 11) * 1000 ELSE (c_custkey % 7) * 500 END AS income
FROM customer LEFT JOIN (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def household_attributes(spark, folder):
    c, o = tables(spark, folder, "customer", "orders")
    first = relational.first_by(o.select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], ["o_orderkey"])
    k = F.col("c_custkey")
    rows = c.join(first.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("first_priority")), "c_custkey", "left")
    return rows.select("c_custkey", "c_mktsegment", "first_priority", recode.positive_or((k % 11) * 1000, (k % 7) * 500).alias("income"))


@query(source.SQL + ", p AS (SELECT hh, pno, (max(k) % 8 + 1)::INT AS ptype FROM d GROUP BY ALL) SELECT hh, count(*) AS members, " + ", ".join(f"count(*) FILTER (ptype = {t}) AS {n}" for t, n in {1: "hhftw", 2: "hhptw", 3: "hhret", 4: "hhoad", 5: "hhuni", 6: "hhhsc", 7: "hh515", 8: "hhcu5"}.items()) + ", count(*) FILTER (ptype IN (1, 2)) AS hhwkrs FROM p GROUP BY hh")
def household_summary(spark, folder):
    from .week import household_counts

    p = source.diary(spark, folder).groupBy(*PERSON).agg((F.max("k") % 8 + 1).alias("ptype"))
    return household_counts(p, p.select("hh").distinct())


@query("SELECT c_custkey, CASE WHEN n_regionkey IN (1, 3) AND c_acctbal > 0 THEN c_nationkey ELSE -1 END AS zone FROM customer JOIN nation ON c_nationkey = n_nationkey")
def county_gate(spark, folder):
    c, n = tables(spark, folder, "customer", "nation")
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", recode.gate(F.col("c_nationkey"), F.col("n_regionkey"), [1, 3], F.col("c_acctbal") > 0).alias("zone"))


@query("SELECT l_orderkey, l_linenumber, (l_returnflag = 'A' OR l_linestatus = 'A') AS has_a FROM lineitem WHERE (l_quantity >= 10 OR l_tax > 0.05) AND l_discount BETWEEN 0.02 AND 0.08 AND l_shipdate IS NOT NULL")
def any_of_columns(spark, folder):
    (items,) = tables(spark, folder, "lineitem")
    rows = items.where(((F.col("l_quantity") >= 10) | (F.col("l_tax") > 0.05)) & F.col("l_discount").between(0.02, 0.08) & F.col("l_shipdate").isNotNull())
    return rows.select("l_orderkey", "l_linenumber", recode.any_of([F.col("l_returnflag"), F.col("l_linestatus")], ["A"]).alias("has_a"))


@query("SELECT s_suppkey, abs(s_acctbal - (s_acctbal + (s_suppkey % 3) * 5e-7)) <= greatest(1e-9 * greatest(abs(s_acctbal), abs(s_acctbal + (s_suppkey % 3) * 5e-7)), 1e-6) AS near FROM supplier")
def near_equal(spark, folder):
    (s,) = tables(spark, folder, "supplier")
    return s.select("s_suppkey", numeric.near_equal(F.col("s_acctbal"), F.col("s_acctbal") + (F.col("s_suppkey") % 3) * 5e-7).alias("near"))


@query("SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def natural_left(spark, folder):
    d, labels = tables(spark, folder, "documents", "labels")
    return relational.natural_left_join(d.select("doc_id", "lang"), labels)


@query("SELECT d.doc_id, coalesce(l.q, -1) AS quality, lang FROM (SELECT doc_id, lang FROM documents) d LEFT JOIN (SELECT doc_id, min(quality) AS q FROM labels WHERE toxic = 0 GROUP BY 1) l ON d.doc_id = l.doc_id")
def update_from(spark, folder):
    d, labels = tables(spark, folder, "documents", "labels")
    target = d.select("doc_id", F.lit(-1).alias("quality"), "lang")
    return relational.update_from(target, labels.where("toxic = 0"), ["doc_id"], {"quality": "quality"})


@query("SELECT doc_id, source, (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))::INT AS good FROM documents")
def semi_flag(spark, folder):
    d, labels = tables(spark, folder, "documents", "labels")
    return relational.flag_exists(d.select("doc_id", "source"), labels.where("quality = 1"), ["doc_id"], "good")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def exclude_keys(spark, folder):
    d, labels = tables(spark, folder, "documents", "labels")
    return relational.exclude_keys(d.select("doc_id", "source"), labels.select("doc_id"))


@query("SELECT l_returnflag, l_linestatus, min(l_quantity) AS least, max(l_quantity) AS most, round(sum(l_quantity), 2) AS total, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' OR l_returnflag <> 'N' GROUP BY ALL")
def group_min_max_sum_count(spark, folder):
    (items,) = tables(spark, folder, "lineitem")
    rows = items.where("l_linestatus = 'O' OR l_returnflag <> 'N'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.min("l_quantity").alias("least"), F.max("l_quantity").alias("most"), F.round(F.sum("l_quantity"), 2).alias("total"), F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS n FROM lineitem) WHERE n = 1")
def sorted_top1(spark, folder):
    (items,) = tables(spark, folder, "lineitem")
    return relational.dedupe_first(items, ["l_orderkey"], [F.desc("l_extendedprice"), F.asc("l_linenumber")]).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS rank FROM orders")
def renumber(spark, folder):
    (o,) = tables(spark, folder, "orders")
    return relational.renumber(relational.renumber(o.select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderkey"], "n"), ["o_custkey"], ["o_orderstatus"], "rank", dense=True).drop("o_orderstatus")


@query(source.SQL + " SELECT event_id, (seq = max(seq) OVER (PARTITION BY hh, pno))::INT AS last, (seq = 1)::INT AS first, (seq = min(seq) OVER g)::INT AS day_first, (seq = max(seq) OVER g)::INT AS day_last FROM d WINDOW g AS (PARTITION BY hh, pno, day_ix)")
def flag_first_last(spark, folder):
    rows = sequence.flag_ends(source.diary(spark, folder), PERSON)
    return sequence.flag_ends(rows, [*PERSON, "day_ix"], prefix="day_").select("event_id", "first", "last", "day_first", "day_last")


@query(source.SQL + """, s AS (SELECT * REPLACE (seq + sum((k % 7 = 0)::INT) OVER (PARTITION BY hh, pno ORDER BY seq ROWS UNBOUNDED PRECEDING) AS seq) FROM d)
SELECT a.event_id, b.dpurp AS next_dpurp, b.mode AS next_mode, (b.seq IS NOT NULL)::INT AS has_next FROM s a LEFT JOIN s b ON a.hh = b.hh AND a.pno = b.pno AND b.seq = a.seq + 1""")
def next_if_consecutive(spark, folder):
    # gaps in the numbers before some of the events, as if trips were missing there
    missing = F.sum((F.col("k") % 7 == 0).cast("int")).over(sequence.by_person().rowsBetween(W.unboundedPreceding, 0))
    rows = source.diary(spark, folder).withColumn("seq", F.col("seq") + missing)
    return sequence.next_if_consecutive(rows, ["dpurp", "mode"]).select("event_id", "next_dpurp", "next_mode", "has_next")


@query(T + " SELECT event_id, act_dur, has_next FROM u")
def activity_duration(spark, folder):
    return trips(spark, folder).select("event_id", "act_dur", "has_next")


LIMIT, SHORT = 900, 500
CHAINS = T.replace("WITH b AS", "WITH RECURSIVE b AS", 1) + f""", r AS (
  SELECT hh, pno, seq, seq AS chain, mode AS acc, dpurp = 10 AND has_next = 1 AS can, act_dur FROM u WHERE seq = 1
  UNION ALL
  SELECT hh, pno, seq, CASE WHEN l IS NULL THEN seq ELSE chain END, coalesce(l, mode), can, act_dur FROM (
    SELECT u.hh, u.pno, u.seq, r.chain, u.mode, u.dpurp = 10 AND u.has_next = 1 AS can, u.act_dur,
      CASE WHEN NOT r.can THEN NULL
        WHEN r.act_dur <= {LIMIT} AND ((r.acc IN (0, 1, 2) AND u.mode = 6) OR (r.acc = 6 AND u.mode IN (0, 1, 2))) THEN 6
        WHEN r.act_dur <= {LIMIT} AND ((r.acc IN (0, 1, 2, 3, 4, 5, 9) AND u.mode IN (6, 7)) OR (r.acc IN (6, 7) AND u.mode IN (0, 1, 2, 3, 4, 5, 9))) THEN 7
        WHEN (r.act_dur <= {LIMIT} AND r.acc IN (6, 7) AND u.mode IN (6, 7)) OR r.act_dur <= {SHORT} THEN greatest(r.acc, u.mode) END AS l
    FROM r JOIN u ON u.hh = r.hh AND u.pno = r.pno AND u.seq = r.seq + 1)
)"""


def chains(spark, folder):
    return sequence.chain_heads(trips(spark, folder), LIMIT, SHORT)


@query(CHAINS + """, j AS (SELECT u.*, r.chain, r.acc, u.day_ix - lag(u.day_ix) OVER (PARTITION BY u.hh, u.pno ORDER BY u.seq) AS gap FROM u JOIN r ON u.hh = r.hh AND u.pno = r.pno AND u.seq = r.seq),
g AS (SELECT hh, pno, chain, arg_min(dep, seq) AS dep, arg_min(coalesce(opurp, -9), seq) AS o, arg_min(coalesce(gap, 0), seq) AS gap, arg_max(arr, seq) AS arr, arg_max(dpurp, seq) AS z, arg_max(has_next, seq) AS has_next, arg_max(acc, seq) AS mode, max(path) AS path, count(*) AS segments FROM j GROUP BY ALL)
SELECT hh, pno, chain, dep, arr, CASE WHEN segments = 1 AND z <> 10 AND o = 10 AND gap <= 1 THEN 4 WHEN o = -9 THEN NULL ELSE o END AS opurp,
  CASE WHEN z = 10 AND NOT (segments > 1 AND has_next = 0) THEN 4 ELSE z END AS dpurp, mode, path, segments, row_number() OVER (PARTITION BY hh, pno ORDER BY chain) AS trip FROM g""")
def link_chains(spark, folder):
    out = sequence.link_chains(trips(spark, folder), LIMIT, SHORT)
    return out.select(*PERSON, "chain", "dep", "arr", "opurp", "dpurp", "mode", "path", "segments", "trip")


@query(CHAINS + """, j AS (SELECT u.*, r.chain, r.acc, row_number() OVER (PARTITION BY u.hh, u.pno, chain ORDER BY u.seq) AS n FROM u JOIN r ON u.hh = r.hh AND u.pno = r.pno AND u.seq = r.seq)
SELECT hh, pno, chain, arg_min(mode_type, seq) AS acc_mode, arg_max(mode_type, seq) AS egr_mode, first(ox ORDER BY seq) AS otaz, arg_max(x, seq) AS dtaz FROM j GROUP BY hh, pno, chain HAVING max(CASE WHEN n = 2 THEN acc END) IN (6, 7)""")
def access_egress(spark, folder):
    return sequence.access_egress(chains(spark, folder))


@query(CHAINS + " SELECT u.event_id, r.chain, (r.chain <> r.seq)::INT AS del_flag FROM u JOIN r ON u.hh = r.hh AND u.pno = r.pno AND u.seq = r.seq")
def linked_detail(spark, folder):
    return sequence.linked_detail(chains(spark, folder)).select("event_id", "chain", "del_flag")


_ENDS = """, z AS (SELECT *, (hh % 10)::INT AS hx, (pno % 10)::INT AS hy, (pno % 10)::INT AS wx, (hh % 10)::INT AS wy, (k % 4)::INT AS rpurp, ((k + 3) % 10)::INT AS rx, (k % 5 - 1)::INT AS ry FROM u),
y AS (SELECT *, CASE WHEN dpurp = 0 OR (x = hx AND y = hy AND x <> -1 AND y <> -1) THEN 1 WHEN dpurp = 1 OR (x = wx AND y = wy AND x <> -1 AND y <> -1) THEN 2 WHEN x <> -1 AND y <> -1 THEN 4 ELSE 5 END AS dtype FROM z),
v AS (SELECT *, coalesce(day_ix - lag(day_ix) OVER p <= 1, false) AS ch, lag(dtype) OVER p AS pt FROM y WINDOW p AS (PARTITION BY hh, pno ORDER BY seq)),
o AS (SELECT *, CASE WHEN ch THEN pt WHEN rpurp = 0 OR (rx = hx AND ry = hy AND rx <> -1 AND ry <> -1) THEN 1 WHEN rpurp = 1 THEN 2 ELSE 5 END AS otype FROM v)"""


@query(T + _ENDS + " SELECT event_id, dtype, otype, ch::INT AS chained, CASE WHEN ch THEN opurp WHEN otype = 1 THEN 0 WHEN otype = 2 THEN 1 ELSE 4 END AS opurp FROM o")
def classify_ends(spark, folder):
    hh, pno, k = (F.col(c) for c in ("hh", "pno", "k"))
    made = {"hx": hh % 10, "hy": pno % 10, "wx": pno % 10, "wy": hh % 10, "rpurp": k % 4, "rx": (k + 3) % 10, "ry": k % 5 - 1}
    rows = trips(spark, folder).withColumns({n: e.cast("int") for n, e in made.items()})
    return sequence.classify_ends(rows).select("event_id", "dtype", "otype", "chained", "opurp")


@query(T.replace("WITH b AS", "WITH RECURSIVE b AS", 1) + """, q AS (SELECT *, sum(CASE WHEN day_ix - g <= 1 THEN 0 ELSE 1 END) OVER (PARTITION BY hh, pno ORDER BY seq ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, lag(day_ix) OVER (PARTITION BY hh, pno ORDER BY seq) AS g FROM u)),
r AS (
  SELECT hh, pno, seq, run, dep AS dm, CASE WHEN arr < dep THEN arr + 1440 ELSE arr END AS am FROM q WHERE seq = 1
  UNION ALL
  SELECT hh, pno, seq, run, dm, CASE WHEN arr < dm THEN arr + 1440 ELSE arr END FROM (
    SELECT q.hh, q.pno, q.seq, q.run, q.arr, CASE WHEN q.dep < CASE WHEN q.run = r.run THEN r.am ELSE 0 END THEN q.dep + 1440 ELSE q.dep END AS dm FROM r JOIN q ON q.hh = r.hh AND q.pno = r.pno AND q.seq = r.seq + 1)
) SELECT q.event_id, r.run::INT AS run, dm AS dep_min, am AS arr_min, coalesce(lead(dm) OVER (PARTITION BY r.hh, r.pno, r.run ORDER BY r.seq), 1680) AS end_min FROM r JOIN q ON q.hh = r.hh AND q.pno = r.pno AND q.seq = r.seq""")
def unwrap_clock(spark, folder):
    return sequence.unwrap_clock(trips(spark, folder)).select("event_id", F.col("run").cast("int"), "dep_min", "arr_min", "end_min")


@query(TOURS + " SELECT * FROM prim")
def primary_destination(spark, folder):
    return tours.primary_destination(members_of(spark, folder))


@query(TOURS + " SELECT * FROM anchor")
def work_anchor(spark, folder):
    return tours.work_anchor(members_of(spark, folder))


SUBTOURS = TOURS + """, si AS (SELECT m.*, max(CASE WHEN opurp = 1 AND dpurp <> 1 THEN seq END) OVER (PARTITION BY m.hh, m.pno, m.tour ORDER BY seq ROWS UNBOUNDED PRECEDING) AS s
  FROM m JOIN anchor a ON m.hh = a.hh AND m.pno = a.pno AND m.tour = a.tour WHERE pdpurp = 1 AND leave > arrive + 1 AND seq > arrive AND seq <= leave),
sc AS (SELECT hh, pno, tour, s AS start, min(seq) AS "end", arg_min(day_ix, seq) AS last_day FROM si WHERE s IS NOT NULL AND opurp <> 1 AND dpurp = 1 GROUP BY hh, pno, tour, s),
sub AS (SELECT sc.hh, sc.pno, sc.tour, row_number() OVER (PARTITION BY sc.hh, sc.pno, sc.tour ORDER BY start) AS subtour, start, "end" FROM sc JOIN u ON u.hh = sc.hh AND u.pno = sc.pno AND u.seq = sc.start WHERE last_day - u.day_ix <= 1)"""


# their primary destinations
SUBTOURS += """, sp AS (SELECT hh, pno, tour, subtour, dpurp AS pdpurp FROM (SELECT s.*, u.dpurp, row_number() OVER (PARTITION BY s.hh, s.pno, s.tour, s.subtour
    ORDER BY CASE u.dpurp WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 4 END, coalesce(u.act_dur, 0) DESC, u.seq) AS n FROM sub s JOIN u ON u.hh = s.hh AND u.pno = s.pno AND u.seq >= s.start AND u.seq < s."end") WHERE n = 1)"""


@query(SUBTOURS + " SELECT * FROM sub")
def work_subtours(spark, folder):
    return tours.work_subtours(members_of(spark, folder))


def halves_of(spark, folder):
    return tours.half_tours(members_of(spark, folder))


@query(TOURS + """, x AS (SELECT hh, pno, tour, half, count(*) - 1 AS stops, arg_max(mode, mode * 1000 - tseg) AS mode, arg_max(path, mode * 1000 - tseg) AS path FROM half GROUP BY ALL)
SELECT hh, pno, tour, a.mode AS mode1, b.mode AS mode2, coalesce(a.stops, 0) AS stops1, coalesce(b.stops, 0) AS stops2, CASE WHEN b.mode IS NULL OR a.mode >= b.mode THEN a.mode ELSE b.mode END AS tmode, CASE WHEN b.mode IS NULL OR a.mode >= b.mode THEN a.path ELSE b.path END AS tpath
FROM (SELECT * FROM x WHERE half = 1) a FULL JOIN (SELECT * FROM x WHERE half = 2) b USING (hh, pno, tour)""")
def half_tour_mode(spark, folder):
    out = tours.tour_summary(tours.with_halves(members_of(spark, folder)))
    return out.select(*PERSON, "tour", "mode1", "mode2", "stops1", "stops2", "tmode", "tpath")


@query(SUBTOURS + """, al AS (SELECT p.hh, p.pno, p.tour, 0 AS subtour, t.start, pdpurp FROM prim p JOIN tour t USING (hh, pno, tour) UNION ALL SELECT hh, pno, tour, subtour, start, pdpurp FROM sub JOIN sp USING (hh, pno, tour, subtour))
SELECT hh, pno, tour, subtour, row_number() OVER (PARTITION BY hh, pno ORDER BY r, CASE WHEN r = 3 THEN pdpurp END NULLS FIRST, start, subtour) AS tour_no FROM (SELECT *, CASE WHEN subtour > 0 THEN 2 WHEN pdpurp = 1 THEN 1 WHEN pdpurp > 0 THEN 3 ELSE 4 END AS r FROM al)""")
def order_tours(spark, folder):
    members = members_of(spark, folder)
    main = tours.with_primary(members).where("seq = pseq").select(*PERSON, "tour", F.lit(0).alias("subtour"), "start", "pdpurp")
    inside = tours.with_primary(tours.subtour_trips(members), [*PERSON, "tour", "subtour"])
    sub = inside.where("seq = pseq").select(*PERSON, "tour", "subtour", "start", "pdpurp")
    return tours.order_tours(relational.union_all(main, sub)).select(*PERSON, "tour", "subtour", "tour_no")


@query(TOURS + ", st AS (SELECT * FROM (SELECT *, max(tseg) OVER (PARTITION BY hh, pno, tour, half) AS l FROM half) WHERE tseg < l), e AS (SELECT hh, pno, coalesce((first(opurp ORDER BY seq) = 0)::INT, 1) AS beghom, (arg_max(dpurp, seq) = 0)::INT AS endhom FROM u GROUP BY hh, pno) SELECT e.*, " + ", ".join(f"(SELECT count(*) FROM prim p WHERE p.hh = e.hh AND p.pno = e.pno AND pdpurp = {p}) AS {n}tours, (SELECT count(*) FROM st s WHERE s.hh = e.hh AND s.pno = e.pno AND dpurp = {p}) AS {n}stops" for p, n in {1: "wk", 2: "sc", 3: "es", 4: "pb", 5: "sh", 6: "ml", 7: "so"}.items()) + " FROM e")
def person_day_pattern(spark, folder):
    return tours.person_day_pattern(toured(spark, folder))


@query(TOURS + " SELECT hh, pno, tour, half, tseg, dpurp FROM (SELECT *, max(tseg) OVER (PARTITION BY hh, pno, tour, half) AS l FROM half) WHERE tseg < l")
def intermediate_stops(spark, folder):
    return tours.intermediate_stops(halves_of(spark, folder)).select(*PERSON, "tour", "half", "tseg", "dpurp")


LEGS = TOURS + """, f AS (SELECT *, min(CASE WHEN mode = 7 THEN tseg END) OVER (PARTITION BY hh, pno, tour, half) AS f, dep + floor((arr - dep) / 2)::INT AS mid FROM half),
leg AS (
  SELECT hh, pno, tour, half, tseg + CASE WHEN tseg > f THEN 1 ELSE 0 END AS tseg, mode, opurp, dpurp, dep, arr FROM f WHERE tseg <> coalesce(f, -1)
  UNION ALL SELECT hh, pno, tour, half, tseg, CASE half WHEN 1 THEN 3 ELSE 6 END, opurp, 10, dep, mid FROM f WHERE tseg = f
  UNION ALL SELECT hh, pno, tour, half, tseg + 1, CASE half WHEN 1 THEN 6 ELSE 3 END, 10, dpurp, CASE WHEN mid + 1 < arr THEN mid + 1 ELSE mid END, arr FROM f WHERE tseg = f
)"""


@query(LEGS + " SELECT * FROM leg")
def split_drive_transit(spark, folder):
    return tours.split_drive_transit(halves_of(spark, folder)).select(*PERSON, "tour", "half", "tseg", "mode", "opurp", "dpurp", "dep", "arr")


@query(LEGS + """, l AS (SELECT *, coalesce(lag(dpurp) OVER w = 10 AND lag(tseg) OVER w = tseg - 1 AND opurp = 10, false) AS second, coalesce(lead(opurp) OVER w = 10, false) AND dpurp = 10 AS paired, lead(dpurp) OVER w AS nd, lead(arr) OVER w AS na FROM leg WINDOW w AS (PARTITION BY hh, pno, tour, half ORDER BY tseg))
SELECT hh, pno, tour, half, row_number() OVER (PARTITION BY hh, pno, tour, half ORDER BY tseg) AS tseg, CASE WHEN paired THEN 7 ELSE mode END AS mode, opurp, CASE WHEN paired THEN nd ELSE dpurp END AS dpurp, dep, CASE WHEN paired THEN na ELSE arr END AS arr FROM l WHERE NOT second""")
def relink_drive_transit(spark, folder):
    legs = tours.split_drive_transit(halves_of(spark, folder))
    return tours.relink_drive_transit(legs).select(*PERSON, "tour", "half", "tseg", "mode", "opurp", "dpurp", "dep", "arr")


@query(COMPLETE + ", w AS (SELECT d.event_id, day, 1.0 * (hh % 50) + 10 AS weight, num_days_complete_5dayweekday AS n FROM d JOIN comp USING (hh, pno)) SELECT event_id, weight, round(CASE WHEN day BETWEEN 1 AND 5 AND n > 0 THEN least(weight, 40) / n ELSE 0 END, 6) AS expansion FROM w")
def expansion_weights(spark, folder):
    rows = source.diary(spark, folder)
    rows = rows.join(completeness(rows), PERSON).withColumn("weight", 1.0 * (F.col("hh") % 50) + 10)
    out = weights.expansion_weights(rows, "weight", "num_days_complete_5dayweekday", F.col("day"), most=40.0)
    return out.select("event_id", "weight", F.round("expansion", 6).alias("expansion"))


# places of the one-day diary
PLACES = T + """, pl AS (
  SELECT event_id, hh, pno, seq, day_ix, dep, arr, coalesce(act_dur, 0) AS act_dur, CASE dpurp WHEN 0 THEN 'Home' WHEN 1 THEN 'Work' WHEN 5 THEN 'Shopping' WHEN 7 THEN 'Social/Visit' ELSE 'ChangeMode' END AS aggact,
    CASE mode WHEN 1 THEN 'WALK' WHEN 2 THEN 'BIKE/MOPED' WHEN 3 THEN 'DRIVER' WHEN 4 THEN 'PASSENGER' WHEN 5 THEN 'LOCALBUS' WHEN 6 THEN 'EXPRESSBUS' WHEN 7 THEN 'RAIL' WHEN 8 THEN 'TAXI' WHEN 9 THEN 'TAXI' ELSE 'OTHER' END AS modename,
    x, y, ox, oy, lag(dep) OVER (PARTITION BY hh, pno ORDER BY seq) AS odep, 5 + k % 30 AS minutes, k % 13 AS miles, CASE k % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 9 END AS toll, k % 5 AS riders FROM u
)"""


def visited(spark, folder):
    rows = trips(spark, folder)
    k = F.col("k")
    act = recode.recode(F.col("dpurp"), {0: "Home", 1: "Work", 5: "Shopping", 7: "Social/Visit"}, strict=True, default="ChangeMode")
    name = places.labelled(F.when(F.col("mode") == 0, 97).otherwise(F.col("mode")), places.MODES)
    rows = rows.withColumns({"aggact": act, "modename": name, "odep": F.lag("dep").over(sequence.by_person()), "minutes": 5 + k % 30, "miles": k % 13, "toll": recode.recode(k % 4, {0: 1, 1: 2, 2: 9}, strict=True), "riders": k % 5})
    return rows.withColumn("act_dur", F.coalesce("act_dur", F.lit(0)))


LINKED = PLACES + """, g AS (SELECT *, CASE WHEN seq = 1 THEN 0 ELSE 1 + coalesce(sum(CASE WHEN aggact <> 'ChangeMode' AND seq > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY hh, pno ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS leg FROM pl),
g2 AS (SELECT *, lag(modename) OVER w AS pm, lag(seq) OVER w AS ps, lead(modename) OVER w AS nm, max(CASE WHEN aggact <> 'ChangeMode' OR seq = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY hh, pno, leg) AS ok FROM g WINDOW w AS (PARTITION BY hh, pno, leg ORDER BY seq)),
lk AS (SELECT hh, pno, leg, max(seq) AS seq, arg_max(aggact, seq) AS aggact, arg_max(x, seq) AS x, arg_max(y, seq) AS y, first(ox ORDER BY seq) AS ox, first(oy ORDER BY seq) AS oy, first(odep ORDER BY seq) AS odep, sum(minutes) AS minutes, sum(miles) AS miles,
  min(coalesce(toll, 999)) AS toll, max(coalesce(riders, 0)) AS riders, list(modename ORDER BY seq) AS modes, count(*) AS rows, min(CASE WHEN modename IN ('LOCALBUS', 'EXPRESSBUS', 'RAIL') THEN seq END) - 1 AS board, max(CASE WHEN modename IN ('LOCALBUS', 'EXPRESSBUS', 'RAIL') THEN seq END) AS alight,
  coalesce(min(CASE WHEN modename IN ('LOCALBUS', 'EXPRESSBUS', 'RAIL', 'SCHOOLBUS', 'WALK', 'PASSENGER') AND pm = 'DRIVER' THEN ps END), max(CASE WHEN modename IN ('LOCALBUS', 'EXPRESSBUS', 'RAIL', 'SCHOOLBUS', 'WALK', 'PASSENGER') AND nm = 'DRIVER' THEN seq END)) AS park
  FROM g2 WHERE ok = 1 GROUP BY hh, pno, leg)"""


@query(LINKED + " SELECT hh, pno, leg, seq, aggact, x, y, ox, oy, odep, minutes::BIGINT AS minutes, miles::BIGINT AS miles, toll, riders, array_to_string(modes, '-') AS mode_text, rows, board, alight, park FROM lk")
def link_places(spark, folder):
    return places.link_places(visited(spark, folder)).drop("modes")


@query(LINKED + """, a AS (SELECT *, list_contains(modes, 'PASSENGER') OR list_has_any(modes, ['LOCALBUS', 'EXPRESSBUS', 'RAIL']) AS ride, max(rows) OVER (PARTITION BY hh, pno) = 1 AS plain, lag(list_contains(modes, 'DRIVER')) OVER w AS drove, lag(seq) OVER w AS seq0 FROM lk WINDOW w AS (PARTITION BY hh, pno ORDER BY leg)),
c AS (SELECT *, min(CASE WHEN ride THEN seq END) OVER (PARTITION BY hh, pno) AS f, max(CASE WHEN ride THEN seq END) OVER (PARTITION BY hh, pno) AS l FROM a)
SELECT hh, pno, leg, CASE WHEN plain THEN CASE WHEN seq = f AND coalesce(drove, false) THEN seq0 WHEN seq = l THEN seq END ELSE park END AS park FROM c""")
def parking_rule(spark, folder):
    return places.parking_rule(places.link_places(visited(spark, folder))).select(*PERSON, "leg", "park")


@query(LINKED + " SELECT hh, pno, leg, CASE WHEN len(modes) = 1 AND modes[1] IN ('LOCALBUS', 'EXPRESSBUS', 'RAIL') THEN coalesce(lag(seq) OVER (PARTITION BY hh, pno ORDER BY leg), seq - 1) ELSE board END AS board, CASE WHEN len(modes) = 1 AND modes[1] IN ('LOCALBUS', 'EXPRESSBUS', 'RAIL') THEN seq ELSE alight END AS alight FROM lk")
def transit_defaults(spark, folder):
    return places.transit_defaults(places.link_places(visited(spark, folder))).select(*PERSON, "leg", "board", "alight")


_TR = "(list_contains(modes, 'RAIL') OR list_contains(modes, 'EXPRESSBUS') OR list_contains(modes, 'LOCALBUS'))"
_DR, _PA = "list_contains(modes, 'DRIVER')", "list_contains(modes, 'PASSENGER')"
MODE_CODE = f"""CASE WHEN list_contains(modes, 'SCHOOLBUS') THEN 18 WHEN list_contains(modes, 'TAXI') THEN 19
  WHEN NOT {_TR} AND {_DR} AND riders = 1 AND toll IN (2, 9) THEN 1 WHEN NOT {_TR} AND {_DR} AND riders = 1 AND toll = 1 THEN 2
  WHEN NOT {_TR} AND ({_DR} OR {_PA}) AND riders = 2 AND toll IN (2, 9) THEN 3 WHEN NOT {_TR} AND ({_DR} OR {_PA}) AND riders = 2 AND toll = 1 THEN 4
  WHEN NOT {_TR} AND ({_DR} OR {_PA}) AND riders >= 3 AND toll IN (2, 9) THEN 5 WHEN NOT {_TR} AND ({_DR} OR {_PA}) AND riders >= 3 AND toll = 1 THEN 6
  WHEN NOT {_TR} AND NOT {_DR} AND NOT {_PA} THEN 7
  WHEN list_contains(modes, 'RAIL') THEN CASE WHEN {_DR} THEN 14 WHEN {_PA} THEN 17 ELSE 11 END
  WHEN list_contains(modes, 'EXPRESSBUS') THEN CASE WHEN {_DR} THEN 13 WHEN {_PA} THEN 16 ELSE 10 END
  WHEN list_contains(modes, 'LOCALBUS') THEN CASE WHEN {_DR} THEN 12 WHEN {_PA} THEN 15 ELSE 9 END END"""


@query(LINKED + f" SELECT hh, pno, leg, {MODE_CODE} AS code FROM lk")
def mode_code(spark, folder):
    legs = places.link_places(visited(spark, folder))
    return legs.select(*PERSON, "leg", places.mode_code(F.col("modes"), F.col("toll"), F.col("riders")).alias("code"))


NUMBERED = PLACES + """, q AS (SELECT *, sum((aggact = 'Home')::INT) OVER (PARTITION BY hh, pno ORDER BY seq ROWS UNBOUNDED PRECEDING) AS n, sum((aggact = 'Home')::INT) OVER (PARTITION BY hh, pno) AS al FROM pl),
e AS (SELECT *, CASE WHEN n = 0 THEN -2 ELSE n END AS s FROM q WHERE al >= 1 UNION ALL SELECT *, n - 1 FROM q WHERE al >= 1 AND aggact = 'Home' AND n > 1),
i AS (SELECT *, count(*) OVER (PARTITION BY hh, pno, s) AS c, row_number() OVER (PARTITION BY hh, pno, s ORDER BY seq) AS tour_idx FROM e),
nt AS (SELECT *, (CASE WHEN s = -2 THEN -2 WHEN s = al OR c < 3 THEN -1 ELSE s END)::INT AS tour FROM i WHERE NOT (s = al AND c = 1 AND al > 1))"""


@query(NUMBERED + " SELECT event_id, hh, pno, tour, tour_idx FROM nt")
def number_tours(spark, folder):
    return places.number_tours(visited(spark, folder)).select("event_id", *PERSON, "tour", "tour_idx")


WORKSUB = NUMBERED + """, wq AS (SELECT *, sum((aggact = 'Work')::INT) OVER (PARTITION BY hh, pno, tour ORDER BY tour_idx ROWS UNBOUNDED PRECEDING) AS wn, sum((aggact = 'Work')::INT) OVER (PARTITION BY hh, pno, tour) AS wal FROM nt WHERE tour > 0),
we AS (SELECT *, CASE WHEN wn = 0 THEN -2 ELSE wn END AS ws FROM wq WHERE wal >= 2 UNION ALL SELECT *, wn - 1 FROM wq WHERE wal >= 2 AND aggact = 'Work' AND wn > 1),
wi AS (SELECT *, count(*) OVER (PARTITION BY hh, pno, tour, ws) AS wc, row_number() OVER (PARTITION BY hh, pno, tour, ws ORDER BY tour_idx) AS subtour_idx FROM we),
ws AS (SELECT *, (CASE WHEN ws = -2 OR ws = wal OR wc < 3 THEN -1 ELSE ws END)::INT AS subtour FROM wi WHERE NOT (ws = wal AND wc = 1 AND wal > 1))"""


@query(WORKSUB + " SELECT event_id, hh, pno, tour, subtour, subtour_idx FROM ws")
def number_work_subtours(spark, folder):
    out = places.number_work_subtours(places.number_tours(visited(spark, folder)))
    return out.select("event_id", *PERSON, "tour", "subtour", "subtour_idx")


@query("SELECT c_custkey, round(acos(greatest(-1.0, least(1.0, sin(radians(c_custkey % 60)) * sin(radians(c_nationkey)) + cos(radians(c_custkey % 60)) * cos(radians(c_nationkey)) * cos(radians(c_nationkey) - radians(c_custkey % 90))))) * 3963.1676, 3) AS miles FROM customer")
def great_circle(spark, folder):
    (c,) = tables(spark, folder, "customer")
    k, n = F.col("c_custkey").cast("double"), F.col("c_nationkey").cast("double")
    return c.select("c_custkey", F.round(numeric.great_circle_miles(k % 90, k % 60, n, n), 3).alias("miles"))


_KNOTS = {"Work": 10, "Shopping": 30, "Social/Visit": 40}
SCORES = "VALUES " + ", ".join(f"('{a}', {t}, " + ", ".join(str(float(b - 2 * i + (i % 3))) for i in range(9)) + ")" for t, (a, b) in enumerate(_KNOTS.items()))
_D = [f"d{k}" for k in range(0, 481, 60)]


def scores_table(spark):
    rows = ", ".join(f"('{a}', {t}, " + ", ".join(f"{float(b - 2 * i + (i % 3))}D" for i in range(9)) + ")" for t, (a, b) in enumerate(_KNOTS.items()))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(label, tpurp, {', '.join(_D)})")


@query(T + f", sc(label, tpurp, {', '.join(_D)}) AS ({SCORES}), z AS (SELECT event_id, label, 1.0 * least(480, act_dur) AS m, [{', '.join(_D)}] AS d, act_dur FROM u JOIN sc ON tpurp = u.k % 3) SELECT event_id, label, round(CASE WHEN act_dur >= 480 THEN d[9] WHEN act_dur >= 0 THEN d[floor(m / 60)::INT + 1] + (d[floor(m / 60)::INT + 2] - d[floor(m / 60)::INT + 1]) * (m - 60 * floor(m / 60)) / 60 END, 6) AS score FROM z")
def lerp_score(spark, folder):
    rows = trips(spark, folder).join(F.broadcast(scores_table(spark)), F.col("tpurp") == F.col("k") % 3)
    return rows.select("event_id", "label", F.round(numeric.lerp_score(F.col("act_dur"), [F.col(d) for d in _D]), 6).alias("score"))


PRIMARY = NUMBERED + f""", sc(label, tpurp, {', '.join(_D)}) AS ({SCORES}),
pa AS (SELECT nt.*, first(x) OVER w AS ax, first(y) OVER w AS ay, count(*) OVER (PARTITION BY hh, pno, tour) AS tn FROM nt WHERE tour > 0 WINDOW w AS (PARTITION BY hh, pno, tour ORDER BY tour_idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
pm AS (SELECT pa.*, [{', '.join(_D)}] AS d, 2 * round(acos(greatest(-1.0, least(1.0, sin(radians(ay)) * sin(radians(y)) + cos(radians(ay)) * cos(radians(y)) * cos(radians(x) - radians(ax))))) * 3963.1676 / 0.5, 2) + act_dur AS m FROM pa LEFT JOIN sc ON label = aggact),
ps AS (SELECT *, CASE WHEN tour_idx > 1 AND tour_idx < tn THEN round(coalesce(CASE WHEN m >= 480 THEN d[9] WHEN m >= 0 THEN d[floor(m / 60)::INT + 1] + (d[floor(m / 60)::INT + 2] - d[floor(m / 60)::INT + 1]) * (m - 60 * floor(m / 60)) / 60 END, 99.0), 6) END AS score FROM pm),
pb AS (SELECT hh, pno, tour, tour_idx AS bi, aggact AS ba, x AS bx, y AS b_y FROM (SELECT *, row_number() OVER (PARTITION BY hh, pno, tour ORDER BY score, tour_idx) AS r FROM ps WHERE score IS NOT NULL) WHERE r = 1),
pr AS (SELECT ps.*, CASE WHEN score IS NOT NULL THEN (tour_idx = bi OR (ba = 'Work' AND aggact = 'Work' AND x = bx AND y = b_y))::INT END AS "primary" FROM ps LEFT JOIN pb USING (hh, pno, tour))"""


def scored(spark, folder):
    return places.score_primary_destination(places.number_tours(visited(spark, folder)).where("tour > 0"), scores_table(spark))


@query(PRIMARY + ' SELECT hh, pno, tour, tour_idx, aggact, score, "primary" FROM pr')
def score_primary_destination(spark, folder):
    return scored(spark, folder).select(*PERSON, "tour", "tour_idx", "aggact", "score", "primary")


@query(PRIMARY + ', fl AS (SELECT *, min(CASE WHEN "primary" = 1 THEN tour_idx END) OVER g AS f, max(CASE WHEN "primary" = 1 THEN tour_idx END) OVER g AS l FROM pr WINDOW g AS (PARTITION BY hh, pno, tour)), ss AS (SELECT hh, pno, tour, list({a: aggact, x: x} ORDER BY tour_idx) FILTER (tour_idx < f) AS o, list({a: aggact, x: x} ORDER BY tour_idx) FILTER (tour_idx > l) AS i FROM fl WHERE "primary" IS NOT NULL AND f IS NOT NULL GROUP BY hh, pno, tour) SELECT hh, pno, tour, coalesce(len(o), 0) AS out_stops, coalesce(len(i), 0) AS in_stops, ' + ", ".join(f"{c}[{n}].{v} AS {d}{n}_{name}" for d, c in (("out", "o"), ("in", "i")) for n in range(1, 5) for v, name in (("a", "aggact"), ("x", "x"))) + " FROM ss")
def stop_fields(spark, folder):
    return places.stop_fields(scored(spark, folder), ["aggact", "x"])


_ORDER = "[14, 13, 12, 17, 16, 15, 18, 8, 19, 6, 5, 4, 3, 2, 1, 11, 10, 9, 7, 20]"
_RANK = f"list_position({_ORDER}, code) - 1"
CODED = PRIMARY + f", cd AS (SELECT *, {MODE_CODE} AS code FROM (SELECT *, [modename] AS modes FROM pr))"
RECORDS = CODED + f""", tr AS (SELECT hh, pno, tour, arg_min(CASE WHEN "primary" = 1 THEN aggact END, CASE WHEN "primary" = 1 THEN tour_idx END) AS purpose, arg_min(x, tour_idx) AS ox, arg_min(y, tour_idx) AS oy, arg_min(CASE WHEN "primary" = 1 THEN x END, CASE WHEN "primary" = 1 THEN tour_idx END) AS dx,
  arg_min(CASE WHEN "primary" = 1 THEN y END, CASE WHEN "primary" = 1 THEN tour_idx END) AS dy, arg_min(dep, tour_idx) AS dep, arg_max(arr, tour_idx) AS arr, {_ORDER}[min(CASE WHEN tour_idx > 1 AND NOT aside THEN {_RANK} END) + 1] AS tour_mode, count(*) AS places, coalesce(max((modename = 'DRIVER')::INT), 0) AS driver, max(coalesce(k, 0)) AS k FROM (
    -- a row between the first and the last work place, or the return to work that closes such rows, or the last one, is of no account for the mode
    SELECT c.*, (tour_idx > first_work AND tour_idx <= last_work AND (aggact <> 'Work' OR p <> 'Work' OR tour_idx = last_work)) IS TRUE AS aside, CASE WHEN aggact = 'Work' AND p <> 'Work' AND tour_idx > first_work THEN works - 1 END AS k
    FROM (SELECT *, min(CASE WHEN aggact = 'Work' THEN tour_idx END) OVER g AS first_work, max(CASE WHEN aggact = 'Work' THEN tour_idx END) OVER g AS last_work, lag(aggact) OVER o AS p, count(*) FILTER (aggact = 'Work') OVER (PARTITION BY hh, pno, tour ORDER BY tour_idx ROWS UNBOUNDED PRECEDING) AS works
      FROM cd WINDOW g AS (PARTITION BY hh, pno, tour), o AS (PARTITION BY hh, pno, tour ORDER BY tour_idx)) c) GROUP BY hh, pno, tour),
rec AS (SELECT * EXCLUDE (k), (tour + coalesce(sum(k) OVER (PARTITION BY hh, pno ORDER BY tour ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::INT AS tour_id, CASE WHEN arr < dep THEN arr - dep + 1440 ELSE arr - dep END AS minutes FROM tr)"""


def coded(spark, folder):
    return scored(spark, folder).withColumn("code", places.mode_code(F.array("modename"), F.col("toll"), F.col("riders")))


@query(RECORDS + " SELECT * FROM rec")
def tour_record(spark, folder):
    return places.tour_records(coded(spark, folder))


@query(RECORDS.replace(NUMBERED, WORKSUB, 1) + " SELECT r.hh, r.pno, r.tour, tour_id, coalesce(c, '') AS child_ids FROM rec r LEFT JOIN (SELECT hh, pno, tour, string_agg(subtour + tour_id, ',' ORDER BY subtour) AS c FROM (SELECT DISTINCT hh, pno, tour, subtour FROM ws WHERE subtour > 0) JOIN rec USING (hh, pno, tour) GROUP BY ALL) s ON r.hh = s.hh AND r.pno = s.pno AND r.tour = s.tour")
def child_tours(spark, folder):
    numbered = places.number_tours(visited(spark, folder))
    return places.child_tours(places.tour_records(coded(spark, folder)), places.number_work_subtours(numbered)).select(*PERSON, "tour", "tour_id", "child_ids")


# the same for subtours, whose rows lie between two work places
_BELOW = re.sub(r"\b(pa|pm|ps|pb|pr)\b", lambda m: f"q{m[1][1]}", PRIMARY[PRIMARY.index("pa AS (SELECT nt.*") :])
for _old, _new in {"FROM nt WHERE tour > 0": "FROM ws WHERE subtour > 0", "nt.*": "ws.*", "PARTITION BY hh, pno, tour": "PARTITION BY hh, pno, tour, subtour", "tour_idx": "subtour_idx", "USING (hh, pno, tour)": "USING (hh, pno, tour, subtour)", "SELECT hh, pno, tour, subtour_idx AS bi": "SELECT hh, pno, tour, subtour, subtour_idx AS bi"}.items():
    _BELOW = _BELOW.replace(_old, _new)


@query(RECORDS.replace(NUMBERED, WORKSUB, 1) + ", " + _BELOW + f""", qc AS (SELECT *, {MODE_CODE} AS code FROM (SELECT *, [modename] AS modes FROM qr)),
sr AS (SELECT hh, pno, tour, subtour, arg_min(CASE WHEN "primary" = 1 THEN aggact END, CASE WHEN "primary" = 1 THEN subtour_idx END) AS purpose, {_ORDER}[min(CASE WHEN subtour_idx > 1 THEN {_RANK} END) + 1] AS tour_mode, count(*) AS places, coalesce(max((modename = 'DRIVER')::INT), 0) AS driver FROM qc GROUP BY hh, pno, tour, subtour)
SELECT sr.*, rec.tour_id + sr.subtour AS tour_id, rec.tour_id AS parent_tour_id, rec.tour_mode AS parent_mode FROM sr LEFT JOIN rec ON rec.hh = sr.hh AND rec.pno = sr.pno AND rec.tour = sr.tour""")
def subtour_record(spark, folder):
    code = places.mode_code(F.array("modename"), F.col("toll"), F.col("riders"))
    below = places.number_work_subtours(places.number_tours(visited(spark, folder))).withColumn("code", code)
    out = places.subtour_records(places.tour_records(coded(spark, folder)), below, scores_table(spark))
    return out.select(*PERSON, "tour", "subtour", "purpose", "tour_mode", "places", "driver", "tour_id", "parent_tour_id", "parent_mode")


@query(CODED + """, tw AS (SELECT *, max(CASE WHEN "primary" = 1 THEN tour_idx END) OVER g AS l, min(CASE WHEN "primary" = 1 THEN tour_idx END) OVER g AS f, count(*) OVER g AS cn, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(aggact) OVER w AS pa FROM cd WINDOW g AS (PARTITION BY hh, pno, tour), w AS (PARTITION BY hh, pno, tour ORDER BY tour_idx))
SELECT hh, pno, tour, tour_idx - 1 AS trip, pa AS opurp, aggact AS dpurp, px AS ox, py AS oy, x, y, code, coalesce((tour_idx > l)::INT, 0) AS inbound, CASE WHEN tour_idx > l THEN cn - l ELSE coalesce(f, cn) - 1 END AS trips_on_journey, cn - 1 AS trips_on_tour, CASE WHEN code BETWEEN 1 AND 6 THEN riders END AS auto_occ FROM tw WHERE tour_idx > 1""")
def trip_record(spark, folder):
    return places.trip_records(coded(spark, folder))


_TYPES = "['FW', 'PW', 'US', 'NW', 'RE', 'DS', 'ND', 'PS']"
@query(RECORDS + f", pt AS (SELECT hh, pno, {_TYPES}[max(k) % 8 + 1] AS ptype, 1.0 * (hh % 9) AS weight FROM u GROUP BY hh, pno) SELECT rec.hh, rec.pno, tour, CASE purpose WHEN 'School/University' THEN CASE WHEN ptype = 'US' THEN 'University' ELSE 'School' END ELSE purpose END AS purpose, ptype, weight FROM (SELECT * REPLACE (CASE WHEN purpose = 'Shopping' THEN 'School/University' ELSE purpose END AS purpose) FROM rec) rec LEFT JOIN pt ON rec.hh = pt.hh AND rec.pno = pt.pno")
def finish_tours(spark, folder):
    records = places.tour_records(coded(spark, folder)).withColumn("purpose", F.when(F.col("purpose") == "Shopping", "School/University").otherwise(F.col("purpose")))
    return places.finish_tours(records, member_types(spark, folder)).select(*PERSON, "tour", "purpose", "ptype", "weight")


def member_types(spark, folder):
    kinds = F.array(*map(F.lit, ["FW", "PW", "US", "NW", "RE", "DS", "ND", "PS"]))
    return source.diary(spark, folder).groupBy(*PERSON).agg(F.get(kinds, F.max("k") % 8).alias("ptype")).withColumn("weight", 1.0 * (F.col("hh") % 9))


# joint travel: members with the same purposes and, widely, the same times
JOINT = T + """, pt AS (SELECT a.event_id, list_sort(list(DISTINCT b.pno)) AS ms FROM u a JOIN u b ON a.hh = b.hh AND a.pno <> b.pno AND a.dpurp = b.dpurp AND a.mode = b.mode AND abs(a.dep - b.dep) <= 240 AND abs(a.arr - b.arr) <= 240 GROUP BY 1),
jt AS (SELECT u.*, list_concat([u.pno], coalesce(ms, [])) AS party FROM u LEFT JOIN pt ON u.event_id = pt.event_id)"""
SAME = {"minutes": 240, "places": ("dpurp", "mode")}


@query(JOINT + " SELECT event_id, hh, pno, array_to_string(party, '.') AS party_text FROM jt")
def detect_joint_trips(spark, folder):
    return joint.detect_parties(trips(spark, folder), **SAME).select("event_id", *PERSON, "party_text")


@query(T + """, pt AS (SELECT a.event_id, list_sort(list(DISTINCT b.pno)) AS ms FROM u a JOIN u b ON a.hh = b.hh AND a.pno <> b.pno AND a.day_ix = b.day_ix AND a.dpurp = b.dpurp AND abs(a.dep - b.dep) <= 300 AND abs(a.arr - b.arr) <= 300 GROUP BY 1)
SELECT u.event_id, hh, pno, day_ix, array_to_string(list_concat([pno], coalesce(ms, [])), '.') AS party_text FROM u LEFT JOIN pt ON u.event_id = pt.event_id""")
def joint_trips_of_a_day(spark, folder):
    out = joint.detect_parties(trips(spark, folder), 300, places=("dpurp",), day="day_ix")
    return out.select("event_id", *PERSON, "day_ix", "party_text")


@query(JOINT + " SELECT event_id, len(party) AS tokens, party[2] AS second, CASE WHEN len(party) > 1 THEN length(party[1]::VARCHAR) + 1 ELSE 0 END AS first_dot, 7 AS golden FROM jt")
def party_text_fields(spark, folder):
    t = F.col("party_text")
    rows = joint.detect_parties(trips(spark, folder), **SAME)
    return rows.select("event_id", text.token_count(t).alias("tokens"), text.nth_token(t, 2).cast("int").alias("second"), text.nth_instr(".", t, 1).alias("first_dot"), text.nth_instr("S", F.lit("PARSONS"), 2).alias("golden"))


JTOURS = JOINT + """, jd AS (SELECT hh, pno, day_ix, count(DISTINCT array_to_string(party, '.')) AS n, min(party) AS p, min(dep) AS dep, min(arr) AS arr FROM jt GROUP BY hh, pno, day_ix),
jc AS (SELECT hh, pno, day_ix AS tour, (n = 1 AND len(p) > 1)::INT AS fully_joint, (n > 1)::INT AS partly_joint, CASE WHEN n = 1 AND len(p) > 1 THEN p END AS party FROM jd)"""


def joint_days(spark, folder):
    rows = joint.detect_parties(trips(spark, folder), **SAME).withColumn("tour", F.col("day_ix"))
    return rows, joint.classify_joint_tours(rows)


@query(JTOURS + " SELECT hh, pno, tour, fully_joint, partly_joint, array_to_string(party, '.') AS party_text FROM jc")
def classify_joint_tours(spark, folder):
    _, out = joint_days(spark, folder)
    return out.select(*PERSON, "tour", "fully_joint", "partly_joint", F.array_join("party", ".").alias("party_text"))


PARTY = JTOURS + f", mt AS (SELECT hh, pno, {_TYPES}[max(k) % 8 + 1] AS ptype FROM u GROUP BY hh, pno), pc AS (SELECT hh, pno, tour, count(*) AS n, count(*) FILTER (ptype IN ('FW', 'PW', 'US', 'NW', 'RE')) AS adults FROM (SELECT hh, pno, tour, unnest(party) AS p FROM jc) z JOIN (SELECT hh, pno AS p, ptype FROM mt) USING (hh, p) GROUP BY hh, pno, tour), ty AS (SELECT hh, pno AS p, ptype FROM mt)"


@query(PARTY + " SELECT jc.hh, jc.pno, jc.tour, len(party) AS size, CASE WHEN adults = n THEN 1 WHEN adults = 0 THEN 2 WHEN n IS NOT NULL THEN 3 END AS composition, party[1] AS person_1, party[2] AS person_2, party[3] AS person_3, (SELECT ptype FROM ty WHERE ty.hh = jc.hh AND p = party[1]) AS type_1, (SELECT ptype FROM ty WHERE ty.hh = jc.hh AND p = party[2]) AS type_2 FROM jc LEFT JOIN pc ON jc.hh = pc.hh AND jc.pno = pc.pno AND jc.tour = pc.tour")
def party_fields(spark, folder):
    _, out = joint_days(spark, folder)
    return joint.party_fields(out, member_types(spark, folder), most=3).select(*PERSON, "tour", "size", "composition", "person_1", "person_2", "person_3", "type_1", "type_2")


SPLIT = JTOURS + """, sj AS (SELECT jc.*, jd.dep, jd.arr, CASE WHEN jc.tour % 2 = 0 THEN 'Work' ELSE 'Shopping' END AS purpose FROM jc JOIN jd ON jc.hh = jd.hh AND jc.pno = jd.pno AND jc.tour = jd.day_ix WHERE jc.hh % 10 <> 3),
jo AS (SELECT *, dense_rank() OVER (PARTITION BY hh ORDER BY pno, tour) AS joint_no FROM (SELECT *, row_number() OVER (PARTITION BY hh, tour ORDER BY pno, tour) AS r FROM sj WHERE fully_joint = 1 AND purpose <> 'Work') WHERE r = 1)"""


def split_tours(spark, folder):
    rows, out = joint_days(spark, folder)
    out = out.withColumns({"purpose": F.when(F.col("tour") % 2 == 0, "Work").otherwise("Shopping"), "subtour": F.lit(0), "day": F.col("tour")})
    return rows, *joint.split_joint(out, ["day"], exclude=out.where("hh % 10 = 3").select("hh"))


@query(SPLIT + " SELECT 'joint' AS kind, hh, pno, tour, joint_no FROM jo UNION ALL SELECT 'individual', hh, pno, tour, NULL FROM sj WHERE NOT (fully_joint = 1 AND purpose <> 'Work')")
def split_joint_tours(spark, folder):
    _, alone, together = split_tours(spark, folder)
    cols = [*PERSON, "tour"]
    return relational.union_all(together.select(F.lit("joint").alias("kind"), *cols, "joint_no"), alone.select(F.lit("individual").alias("kind"), *cols, F.lit(None).cast("int").alias("joint_no")))


@query(SPLIT + " SELECT jt.event_id, joint_no FROM jt LEFT JOIN jo ON jt.hh = jo.hh AND jt.pno = jo.pno AND jt.day_ix = jo.tour")
def split_joint_trips(spark, folder):
    rows, _, together = split_tours(spark, folder)
    return joint.number_joint_trips(rows, together).select("event_id", "joint_no")


# the place pipeline: tours of linked legs; members travel together if purposes and, widely, times agree
_LEGS_RECORDS = RECORDS.replace(NUMBERED, LINKED + ", lp AS (SELECT * FROM (SELECT *, " + MODE_CODE + " AS code FROM lk) JOIN (SELECT hh, pno, seq, dep, arr, act_dur FROM pl) USING (hh, pno, seq))" + NUMBERED[len(PLACES) :].replace("FROM pl)", "FROM lp)"), 1)
_LEGS_RECORDS = _LEGS_RECORDS.replace(f", cd AS (SELECT *, {MODE_CODE} AS code FROM (SELECT *, [modename] AS modes FROM pr))", ", cd AS (SELECT * FROM pr)", 1).replace("max((modename = 'DRIVER')::INT)", "max(list_contains(modes, 'DRIVER')::INT)", 1)
PLACE = _LEGS_RECORDS + """, tq AS (SELECT *, tour_idx - 1 AS trip FROM cd WHERE tour_idx > 1),
pt AS (SELECT a.hh, a.pno, a.tour, a.trip, list_sort(list(DISTINCT b.pno)) AS ms FROM tq a JOIN tq b ON a.hh = b.hh AND a.pno <> b.pno AND a.aggact = b.aggact AND abs(a.odep - b.odep) <= 500 AND abs(a.arr - b.arr) <= 500 GROUP BY ALL),
jt AS (SELECT tq.*, list_concat([tq.pno], coalesce(ms, [])) AS party FROM tq LEFT JOIN pt USING (hh, pno, tour, trip)),
jc AS (SELECT hh, pno, tour, (n = 1 AND len(p) > 1)::INT AS fully, (n > 1)::INT AS partly, p FROM (SELECT hh, pno, tour, count(DISTINCT array_to_string(party, '.')) AS n, min(party) AS p FROM jt GROUP BY ALL)),
ji AS (SELECT rec.*, fully, partly, p, fully = 1 AND purpose NOT IN ('School', 'University', 'Work', 'WorkRelated') AS social, count(*) FILTER (fully = 1) OVER (PARTITION BY rec.hh, purpose) > 1 AS known FROM rec JOIN jc USING (hh, pno, tour)),
jo AS (SELECT *, dense_rank() OVER (PARTITION BY hh ORDER BY pno, tour) AS joint_no FROM (SELECT *, row_number() OVER (PARTITION BY hh, purpose, dep ORDER BY pno, tour) AS r FROM ji WHERE social AND known) WHERE r = 1),
ty AS (SELECT hh, pno AS member, (['FW', 'PW', 'US', 'NW', 'RE', 'DS', 'ND', 'PS'])[max(k) % 8 + 1] AS ptype FROM u GROUP BY hh, pno)"""


def placed(spark, folder):
    from .place import Joint, place_pipeline

    together = Joint(minutes=500, places=("dpurp",), ends=("purpose",), same=("purpose", "dep"))
    return place_pipeline(visited(spark, folder), scores_table(spark), member_types(spark, folder), together)


@query(PLACE + """ SELECT 'joint' AS kind, hh, pno, tour, tour_id, purpose, tour_mode, driver, minutes, 1 AS fully_joint, 0 AS partly_joint, joint_no, len(p) AS size, p[1] AS person_1, p[2] AS person_2, p[3] AS person_3,
  (SELECT CASE count(*) FILTER (ptype IN ('FW', 'PW', 'US', 'NW', 'RE')) WHEN count(*) THEN 1 WHEN 0 THEN 2 ELSE 3 END FROM ty WHERE ty.hh = jo.hh AND list_contains(jo.p, member)) AS composition FROM jo
UNION ALL SELECT 'individual', hh, pno, tour, tour_id, purpose, tour_mode, driver, minutes, 0, CASE WHEN fully = 1 AND social THEN 1 ELSE partly END, NULL, NULL, NULL, NULL, NULL, NULL FROM ji WHERE NOT (social AND known) AND NOT (fully = 1 AND NOT social)
UNION ALL SELECT 'individual', hh, pno, tour, tour_id, purpose, tour_mode, driver, minutes, 0, partly, NULL, NULL, NULL, NULL, NULL, NULL FROM ji WHERE fully = 1 AND NOT social""")
def place_pipeline_joint_tours(spark, folder):
    out = placed(spark, folder)
    cols = [*PERSON, "tour", "tour_id", "purpose", "tour_mode", "driver", "minutes", "fully_joint", "partly_joint"]
    members = ["joint_no", "size", "person_1", "person_2", "person_3", "composition"]
    together = out.joint_tours.select(F.lit("joint").alias("kind"), *cols, *members)
    return together.unionByName(out.individual_tours.select(F.lit("individual").alias("kind"), *cols), allowMissingColumns=True)


@query(PLACE + """, tw AS (SELECT *, max(CASE WHEN "primary" = 1 THEN tour_idx END) OVER g AS l, lag(aggact) OVER w AS pa FROM cd WINDOW g AS (PARTITION BY hh, pno, tour), w AS (PARTITION BY hh, pno, tour ORDER BY tour_idx))
SELECT hh, pno, tour, jt.trip, pa AS opurp, jt.aggact AS dpurp, jt.code, coalesce((jt.tour_idx > l)::INT, 0) AS inbound, jt.odep, jt.arr, array_to_string(party, '.') AS party_text, joint_no
FROM jt JOIN (SELECT hh, pno, tour, tour_idx - 1 AS trip, l, pa FROM tw) USING (hh, pno, tour, trip) LEFT JOIN (SELECT hh, pno, tour, joint_no FROM jo) USING (hh, pno, tour)""")
def place_pipeline_trips(spark, folder):
    return placed(spark, folder).trips.select(*PERSON, "tour", "trip", "opurp", "dpurp", "code", "inbound", "odep", "arr", "party_text", "joint_no")


# nations as unit squares of a grid with five columns, customers as points by their keys
@query("""WITH p AS (SELECT c_custkey AS point_id, (c_custkey % 131) / 20.0 - 0.5 AS x, (c_custkey % 97) / 16.0 - 0.5 AS y FROM customer),
z AS (SELECT n_nationkey AS zone_id, n_nationkey % 5 + 0.1 AS x1, n_nationkey % 5 + 0.8 AS x2, n_nationkey // 5 + 0.1 AS y1, n_nationkey // 5 + 0.8 AS y2 FROM nation),
n AS (SELECT point_id, zone_id, sqrt(greatest(x1 - x, 0, x - x2) ** 2 + greatest(y1 - y, 0, y - y2) ** 2) AS d FROM p, z),
b AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY round(d, 9), zone_id) AS r FROM n WHERE d <= 0.3)
SELECT p.point_id, zone_id, round(d, 6) AS distance FROM p LEFT JOIN b ON p.point_id = b.point_id AND r = 1""")
def nearest_zone_join(spark, folder):
    c, n = tables(spark, folder, "customer", "nation")
    k = F.col("c_custkey")
    points = c.select(k.alias("point_id"), ((k % 131) / 20.0 - 0.5).alias("x"), ((k % 97) / 16.0 - 0.5).alias("y"))
    a, b = F.col("n_nationkey") % 5, F.expr("n_nationkey div 5")
    at = lambda i, j: F.concat_ws(" ", F.format_string("%d.%d", a.cast("int"), F.lit(i)), F.format_string("%d.%d", b.cast("int"), F.lit(j)))
    ring = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", at(1, 1), at(8, 1), at(8, 8), at(1, 8), at(1, 1)), F.lit("))"))
    zones = spatial.zones_from_wkt(n.select(F.col("n_nationkey").alias("zone_id"), ring.alias("wkt")))
    out = spatial.nearest_zone_join(points, zones, 0.3)
    return out.select("point_id", "zone_id", F.round("distance", 6).alias("distance"))


@query("""WITH h AS (SELECT n_nationkey AS hh, n_nationkey * 10 AS htaz, (n_nationkey % 3)::INT AS hx, (n_nationkey % 4)::INT AS hy FROM nation),
p AS (SELECT c_custkey AS pno, c_nationkey AS hh, (c_custkey % 70)::INT AS age, (c_custkey % 3)::INT AS ageb, nullif(c_custkey % 3, 0)::INT AS works, nullif(c_custkey % 4, 0)::INT AS jobs, nullif(c_custkey % 50, 0)::INT AS hours, nullif(c_custkey % 3, 0)::INT AS wloc, nullif(c_custkey % 5, 0)::INT AS wtaz, nullif(c_custkey % 6, 0)::INT AS wx, nullif(c_custkey % 6, 0)::INT AS wy, (c_custkey % 10)::INT AS stude FROM customer),
w AS (SELECT *, CASE WHEN age < 16 THEN 2 WHEN ageb = 1 AND works IS NULL THEN 2 ELSE works END AS works2 FROM p),
v AS (SELECT w.*, bool_or(o_orderkey % 20 IN (11, 12)) AS school, bool_or(o_orderkey % 20 NOT IN (11, 12)) AS other FROM w LEFT JOIN orders ON o_custkey = pno GROUP BY ALL)
SELECT v.pno, v.hh, works2 AS works, CASE WHEN jobs IS NULL AND works2 = 2 THEN 0 ELSE jobs END AS jobs, CASE WHEN jobs IS NULL AND works2 = 2 THEN 0 ELSE hours END AS hours, CASE WHEN wloc IS NULL AND works2 = 2 THEN 0 ELSE wloc END AS wloc,
  coalesce(CASE WHEN wloc = 2 THEN coalesce(wtaz, htaz) ELSE wtaz END, 9999) AS wtaz, coalesce(CASE WHEN wloc = 2 THEN coalesce(wx, hx) ELSE wx END, 0) AS wx, coalesce(CASE WHEN wloc = 2 THEN coalesce(wy, hy) ELSE wy END, 0) AS wy,
  CASE WHEN stude IN (1, 2) THEN 1 WHEN stude = 3 THEN 0 WHEN coalesce(school, false) THEN 1 WHEN stude IN (8, 9) AND coalesce(other, false) THEN 0 ELSE -1 END AS student FROM v LEFT JOIN h ON h.hh = v.hh""")
def clean_persons(spark, folder):
    c, n, o = tables(spark, folder, "customer", "nation", "orders")
    k, some = F.col("c_custkey"), (lambda e: F.when(e != 0, e))
    made = {"age": k % 70, "ageb": k % 3, "works": some(k % 3), "jobs": some(k % 4), "hours": some(k % 50), "wloc": some(k % 3), "wtaz": some(k % 5), "wx": some(k % 6), "wy": some(k % 6), "stude": k % 10}
    people = c.select(F.col("c_nationkey").alias("hh"), k.alias("pno"), *(e.cast("int").alias(m) for m, e in made.items()))
    h = F.col("n_nationkey")
    homes = n.select(h.alias("hh"), (h * 10).alias("htaz"), (h % 3).alias("hx"), (h % 4).alias("hy"))
    seen = o.join(c, F.col("o_custkey") == k).select(F.col("c_nationkey").alias("hh"), F.col("o_custkey").alias("pno"), (F.col("o_orderkey") % 20).alias("tpurp"))
    return places.clean_persons(people, homes, seen).select("pno", "hh", "works", "jobs", "hours", "wloc", "wtaz", "wx", "wy", "student")


_CP = """WITH p AS (SELECT o_orderkey AS id, o_custkey // 3 AS hh, (o_custkey % 3)::INT AS pno, ([1, 4, 5, 8, 10, 13, 15, 21, 25, 96, 97])[o_orderkey % 11 + 1] AS tpurp, (['HOME', 'Main St bus stop', 'station road', 'shop', NULL])[o_orderkey % 5 + 1] AS pname, CASE WHEN o_orderkey % 2 = 0 THEN 'waiting' END AS o_tpurp, (o_orderkey % 11 + 1)::INT AS mode, (o_orderkey % 3)::INT AS riders, (o_orderkey % 2)::INT AS taz, (o_orderkey % 3)::INT AS x, (o_orderkey % 4)::INT AS y FROM orders),
j AS (SELECT *, x = hh % 3 AND y = hh % 4 AND taz = hh % 2 AS home, x = pno AND y = hh % 4 AS work, x <> pno AND y <> hh % 4 AS away, upper(pname) AS pn FROM p),
q AS (SELECT *, CASE WHEN home AND (tpurp NOT IN (1, 2, 3, 96, 97) OR (tpurp = 96 AND coalesce(pn = 'HOME', false))) THEN 3 WHEN (tpurp = 96 AND coalesce(pn LIKE '%BUS STOP%' OR pn LIKE '%TRANSIT STOP%' OR pn LIKE '%STATION%', false)) OR (tpurp = 97 AND upper(o_tpurp) = 'WAITING' AND coalesce(pn LIKE '%BUS STOP%' OR pn LIKE '%STATION%', false)) THEN 4 ELSE tpurp END AS t, CASE WHEN riders = 1 AND mode = 4 THEN 3 ELSE mode END AS m FROM j)
SELECT id, t AS tpurp, CASE WHEN work AND t IN (10, 13) THEN 'Work' WHEN away AND t IN (8, 9) THEN 'WorkRelated' WHEN t IN (1, 2, 3) THEN 'Home' WHEN t = 4 THEN 'ChangeMode' WHEN t IN (5, 6) THEN 'Escorting' WHEN t IN (8, 9) THEN 'Work' WHEN t = 13 THEN 'WorkRelated' WHEN t IN (15, 16, 17) THEN 'Shopping' WHEN t = 21 THEN 'EatOut' WHEN t = 10 THEN 'Discretionary' WHEN t = 25 THEN 'Social/Visit' WHEN t IN (96, 97) THEN CASE WHEN upper(o_tpurp) = 'WAITING' THEN 'Discretionary' ELSE 'NA' END END AS aggact,
  CASE WHEN m = 1 THEN 'WALK' WHEN m IN (2, 11) THEN 'BIKE/MOPED' WHEN m = 3 THEN 'DRIVER' WHEN m = 4 THEN 'PASSENGER' WHEN m = 5 THEN 'LOCALBUS' WHEN m = 6 THEN 'EXPRESSBUS' WHEN m = 7 THEN 'RAIL' WHEN m IN (8, 9) THEN 'TAXI' WHEN m = 10 THEN 'SCHOOLBUS' END AS modename FROM q"""


@query(_CP)
def clean_places(spark, folder):
    (o,) = tables(spark, folder, "orders")
    k = F.col("o_orderkey")
    pick = lambda values, n: F.get(F.array(*map(F.lit, values)), (k % n).cast("int"))
    rows = o.select(
        k.alias("id"), F.expr("o_custkey div 3").alias("hh"), (F.col("o_custkey") % 3).cast("int").alias("pno"), pick([1, 4, 5, 8, 10, 13, 15, 21, 25, 96, 97], 11).alias("tpurp"),
        pick(["HOME", "Main St bus stop", "station road", "shop", None], 5).alias("pname"), F.when(k % 2 == 0, "waiting").alias("o_tpurp"),
        *(e.cast("int").alias(n) for n, e in {"mode": k % 11 + 1, "riders": k % 3, "taz": k % 2, "x": k % 3, "y": k % 4}.items()),
    )
    h = F.col("hh")
    homes = rows.select("hh").distinct().select("hh", (h % 2).alias("htaz"), (h % 3).alias("hx"), (h % 4).alias("hy"))
    people = rows.select(*PERSON).distinct().select(*PERSON, F.col("pno").alias("wx"), (h % 4).alias("wy"))
    return places.clean_places(rows, people, homes).select("id", "tpurp", "aggact", "modename")


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, (l_orderkey % 15)::INT AS kind, l_linenumber AS n, ([41, 78, 30, 53, 55, 1, NULL])[l_orderkey % 7 + 1] AS m1, ([42, 105, 68, 2, NULL])[l_partkey % 5 + 1] AS m2, (l_suppkey % 12)::INT AS acc, (l_partkey % 13)::INT AS egr, (l_partkey % 4)::INT AS driver FROM lineitem),
q AS (SELECT *, CASE WHEN kind = 1 THEN 1 WHEN kind IN (2, 3, 4) THEN 2 WHEN kind IN (8, 9) THEN CASE WHEN n = 1 THEN 3 WHEN n = 2 THEN 4 ELSE 5 END WHEN kind IN (5, 6) THEN 9 WHEN kind = 10 THEN 8 WHEN kind = 11 THEN 5
  WHEN kind IN (12, 13) OR (kind = 14 AND m1 = 41) THEN CASE WHEN acc BETWEEN 6 AND 10 OR egr BETWEEN 6 AND 10 THEN 7 ELSE 6 END ELSE 0 END AS mode FROM p)
SELECT l_orderkey, l_linenumber, mode, CASE WHEN kind = 8 THEN 1 WHEN mode IN (6, 7) THEN CASE WHEN m1 = 78 OR m2 = 78 THEN 7 WHEN m1 = 30 OR m2 = 30 THEN 6 WHEN m1 IN (41, 42, 55) OR m2 IN (41, 42, 55) THEN 5 WHEN m1 IN (53, 105, 68) OR m2 IN (53, 105, 68) THEN 4 ELSE 3 END ELSE 0 END AS path,
  CASE WHEN mode IN (3, 4, 5) THEN CASE WHEN driver IN (1, 3) THEN 1 WHEN driver = 2 THEN 2 ELSE 9 END WHEN mode = 9 THEN CASE WHEN n = 1 THEN 11 WHEN n = 2 THEN 12 ELSE 13 END ELSE 3 END AS role FROM q""")
def trip_codes(spark, folder):
    from .week import trip_mode, trip_path, trip_role

    (items,) = tables(spark, folder, "lineitem")
    k, part = F.col("l_orderkey"), F.col("l_partkey")
    pick = lambda values, e: F.get(F.array(*map(F.lit, values)), (e % len(values)).cast("int"))
    rows = items.select("l_orderkey", "l_linenumber", (k % 15).cast("int").alias("kind"), F.col("l_linenumber").alias("n"), pick([41, 78, 30, 53, 55, 1, None], k).alias("m1"), pick([42, 105, 68, 2, None], part).alias("m2"), (F.col("l_suppkey") % 12).alias("acc"), (part % 13).alias("egr"), (part % 4).alias("driver"))
    rows = rows.withColumn("mode", trip_mode(*(F.col(c) for c in ("kind", "n", "m1", "acc", "egr"))))
    return rows.select("l_orderkey", "l_linenumber", "mode", trip_path(F.col("kind"), F.col("mode"), [F.col("m1"), F.col("m2")]).alias("path"), trip_role(F.col("mode"), F.col("driver"), F.col("n")).alias("role"))


_LINKED = """, j AS (SELECT u.*, r.chain, r.acc, u.day_ix - lag(u.day_ix) OVER (PARTITION BY u.hh, u.pno ORDER BY u.seq) AS gap FROM u JOIN r ON u.hh = r.hh AND u.pno = r.pno AND u.seq = r.seq),
g AS (SELECT hh, pno, chain, arg_min(day, seq) AS day, arg_min(day_ix, seq) AS day_ix, arg_min(dep, seq) AS dep, arg_min(coalesce(opurp, -9), seq) AS o, arg_min(coalesce(gap, 0), seq) AS gap, arg_max(arr, seq) AS arr, arg_max(dpurp, seq) AS z, arg_max(has_next, seq) AS hn, arg_max(acc, seq) AS mode, max(path) AS path, count(*) AS segments FROM j GROUP BY hh, pno, chain),
lt AS (SELECT hh, pno, day, day_ix, dep, arr, CASE WHEN segments = 1 AND z <> 10 AND o = 10 AND gap <= 1 THEN 4 WHEN o = -9 THEN NULL ELSE o END AS opurp, CASE WHEN z = 10 AND NOT (segments > 1 AND hn = 0) THEN 4 ELSE z END AS dpurp, mode, path, row_number() OVER (PARTITION BY hh, pno ORDER BY chain) AS seq FROM g)"""
_FIVE = "max((day = 1)::INT) + max((day = 2)::INT) + max((day = 3)::INT) + max((day = 4)::INT) + max((day = 5)::INT)"


#: Two of a person's days in seven are incomplete.
_IS_COMPLETE = "((hh + g) % 4 <> 0)::INT"
_SUB = "(hh, pno, tour, subtour)"
# modes, stops, days, weights and numbers of tours and subtours
_SUMMARY = f"""x AS (SELECT hh, pno, tour, subtour, half, count(*) - 1 AS stops, arg_max(mode, mode * 1000 - tseg) AS mode, arg_max(path, mode * 1000 - tseg) AS path FROM ah GROUP BY hh, pno, tour, subtour, half),
tm AS (SELECT hh, pno, tour, subtour, CASE WHEN b.mode IS NULL OR a.mode >= b.mode THEN a.mode ELSE b.mode END AS tmode, CASE WHEN b.mode IS NULL OR a.mode >= b.mode THEN a.path ELSE b.path END AS tpath, coalesce(a.stops, 0) AS stops1, coalesce(b.stops, 0) AS stops2 FROM (SELECT * FROM x WHERE half = 1) a FULL JOIN (SELECT * FROM x WHERE half = 2) b USING {_SUB}),
md AS (SELECT hh, pno, tour, subtour, day FROM (SELECT *, row_number() OVER (PARTITION BY hh, pno, tour, subtour ORDER BY c DESC, day) AS n FROM (SELECT hh, pno, tour, subtour, day, count(*) AS c FROM (SELECT hh, pno, tour, 0 AS subtour, day FROM m UNION ALL SELECT hh, pno, tour, subtour, day FROM sm) GROUP BY ALL)) WHERE n = 1),
al AS (SELECT hh, pno, tour, 0 AS subtour, start, "end", pdpurp FROM tour JOIN prim USING (hh, pno, tour) UNION ALL SELECT hh, pno, tour, subtour, start, "end", pdpurp FROM sub JOIN sq USING {_SUB}),
pd AS (SELECT DISTINCT hh, pno FROM d), fl AS (SELECT hh, pno, g AS day FROM pd, range(1, 8) AS r(g) WHERE {_IS_COMPLETE} = 1), wk AS (SELECT hh, pno, count(*) FILTER (day <= 5) AS n FROM fl GROUP BY hh, pno),
rc AS (SELECT al.*, tmode, tpath, stops1, stops2, md.day, CASE WHEN md.day <= 5 AND wk.n > 0 THEN 1.0 / wk.n ELSE 0 END AS expansion,
    row_number() OVER (PARTITION BY hh, pno ORDER BY CASE WHEN subtour > 0 THEN 2 WHEN pdpurp = 1 THEN 1 WHEN pdpurp > 0 THEN 3 ELSE 4 END, CASE WHEN subtour = 0 AND pdpurp > 1 THEN pdpurp END NULLS FIRST, start, subtour) AS tour_no
  FROM al JOIN tm USING {_SUB} JOIN md USING {_SUB} JOIN wk USING (hh, pno))"""


# the week pipeline; two of a person's days in seven are incomplete
WEEK = CHAINS + _LINKED + """ SELECT * FROM (WITH u AS (SELECT *, (lead(dep) OVER p - arr + CASE WHEN lead(day_ix) OVER p > day_ix AND lead(dep) OVER p < arr THEN 1440 ELSE 0 END)::INT AS act_dur FROM lt WINDOW p AS (PARTITION BY hh, pno ORDER BY seq))""" + SUBTOURS[len(T) :] + f""",
sm AS (SELECT u.*, s.tour, s.subtour, s.start, s."end" FROM u JOIN sub s ON u.hh = s.hh AND u.pno = s.pno AND u.seq BETWEEN s.start AND s."end"),
sq AS (SELECT hh, pno, tour, subtour, seq AS pseq, dpurp AS pdpurp FROM (SELECT *, row_number() OVER (PARTITION BY hh, pno, tour, subtour ORDER BY CASE dpurp WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 4 END, coalesce(act_dur, 0) DESC, seq) AS n FROM sm WHERE seq < "end") WHERE n = 1),
ah AS (SELECT hh, pno, tour, 0 AS subtour, seq, dep, arr, opurp, dpurp, mode, path, half, tseg FROM half
  UNION ALL SELECT * FROM (SELECT hh, pno, tour, subtour, seq, dep, arr, opurp, dpurp, mode, path, half, row_number() OVER (PARTITION BY hh, pno, tour, subtour, half ORDER BY seq) AS tseg FROM (SELECT sm.*, CASE WHEN seq <= pseq THEN 1 ELSE 2 END AS half FROM sm JOIN sq USING {_SUB})) WHERE tseg <= 20),
""" + _SUMMARY


def week_of(spark, folder):
    from ..sources.tables import Config, Stages
    from .week import week_pipeline

    days = source.diary(spark, folder).select(*PERSON).distinct().select(*PERSON, F.explode(F.sequence(F.lit(1), F.lit(7))).alias("day"))
    days = days.withColumn("is_complete", ((F.col("hh") + F.col("day")) % 4 != 0).cast("int"))
    return week_pipeline(trips(spark, folder).drop("has_next", "act_dur"), Config(link_minutes=LIMIT, short_link_minutes=SHORT), max_gap=GAP, days=days, stages=Stages(spark, buckets=source.dealt(spark, folder)))


@query(WEEK + """ SELECT hh, pno, tour, subtour, start, "end", pdpurp, tmode, tpath, stops1, stops2, day, round(expansion, 6) AS expansion, tour_no,
  CASE WHEN subtour > 0 THEN max(CASE WHEN subtour = 0 THEN tour_no END) OVER (PARTITION BY hh, pno, tour) ELSE 0 END AS parent, CASE WHEN subtour > 0 THEN subtour ELSE count(*) FILTER (subtour > 0) OVER (PARTITION BY hh, pno, tour) END AS subtrs FROM rc)""")
def week_pipeline_tours(spark, folder):
    out = week_of(spark, folder).tours
    return out.select(*PERSON, "tour", "subtour", "start", "end", "pdpurp", "tmode", "tpath", "stops1", "stops2", "day", F.round("expansion", 6).alias("expansion"), "tour_no", "parent", "subtrs")


@query(WEEK + """, f AS (SELECT ah.*, tour_no, tpath, day, expansion, min(CASE WHEN mode = 7 THEN tseg END) OVER (PARTITION BY ah.hh, ah.pno, ah.tour, ah.subtour, half) AS f, dep + floor((arr - dep) / 2)::INT AS mid FROM ah JOIN rc USING (hh, pno, tour, subtour)),
leg AS (
  SELECT hh, pno, tour_no, half, tseg + CASE WHEN tseg > f THEN 1 ELSE 0 END AS tseg, mode, path, opurp, dpurp, dep, arr, day, expansion FROM f WHERE tseg <> coalesce(f, -1)
  UNION ALL SELECT hh, pno, tour_no, half, tseg, CASE half WHEN 1 THEN 3 ELSE 6 END, CASE half WHEN 1 THEN 0 ELSE tpath END, opurp, 10, dep, mid, day, expansion FROM f WHERE tseg = f
  UNION ALL SELECT hh, pno, tour_no, half, tseg + 1, CASE half WHEN 1 THEN 6 ELSE 3 END, CASE half WHEN 1 THEN tpath ELSE 0 END, 10, dpurp, CASE WHEN mid + 1 < arr THEN mid + 1 ELSE mid END, arr, day, expansion FROM f WHERE tseg = f
) SELECT * REPLACE (round(expansion, 6) AS expansion) FROM leg)""")
def week_pipeline_trips(spark, folder):
    out = week_of(spark, folder).trips
    return out.select(*PERSON, "tour_no", "half", "tseg", "mode", "path", "opurp", "dpurp", "dep", "arr", "day", F.round("expansion", 6).alias("expansion"))


_N = {1: "wk", 2: "sc", 3: "es", 4: "pb", 5: "sh", 6: "ml", 7: "so"}.items()


@query(WEEK + f""", st AS (SELECT * FROM (SELECT ah.*, day, max(tseg) OVER (PARTITION BY ah.hh, ah.pno, ah.tour, ah.subtour, half) AS l FROM ah JOIN rc USING {_SUB}) WHERE tseg < l),
bt AS (SELECT hh, pno, day, count(*) FILTER (subtour > 0) AS wbtours, {", ".join(f"count(*) FILTER (subtour = 0 AND pdpurp = {p}) AS {n}tours" for p, n in _N)} FROM rc GROUP BY hh, pno, day),
bs AS (SELECT hh, pno, day, {", ".join(f"count(*) FILTER (dpurp = {p}) AS {n}stops" for p, n in _N)} FROM st GROUP BY hh, pno, day),
dt AS (SELECT hh, pno, day, count(*) AS trips, coalesce((first(opurp ORDER BY seq) = 0)::INT, 0) AS beghom, coalesce((arg_max(dpurp, seq) = 0)::INT, 0) AS endhom FROM u GROUP BY hh, pno, day)
SELECT fl.hh, fl.pno, fl.day, coalesce(trips, 0) AS trips, coalesce(beghom, 1) AS beghom, coalesce(endhom, 1) AS endhom, coalesce(wbtours, 0) AS wbtours, {", ".join(f"coalesce({n}{k}, 0) AS {n}{k}" for k in ("tours", "stops") for _, n in _N)}, round(CASE WHEN fl.day <= 5 AND wk.n > 0 THEN 1.0 / wk.n ELSE 0 END, 6) AS expansion
FROM fl JOIN wk USING (hh, pno) LEFT JOIN dt USING (hh, pno, day) LEFT JOIN bt USING (hh, pno, day) LEFT JOIN bs USING (hh, pno, day))""")
def week_pipeline_person_days(spark, folder):
    return week_of(spark, folder).person_days.withColumn("expansion", F.round("expansion", 6))


# the same with persons' places: settled ends, minutes that don't fall, tours by the types of their ends
_PLACES = """, pe AS (SELECT DISTINCT hh, pno, ((hh + pno) % 8 + 1)::INT AS ptype, (hh % 10)::INT AS hx, (hh // 7 % 10)::INT AS hy, (500 + hh % 20)::INT AS htaz, (600 + hh)::INT AS hpcl,
  ((hh + pno) % 10)::INT AS wx, ((hh + 2 * pno) % 10)::INT AS wy, 700 + pno AS wtaz, 800 + pno AS wpcl FROM d WHERE hh % 5 <> 0)"""
SETTLED = CHAINS + _PLACES + f""", j AS (SELECT u.*, r.chain, r.acc, u.day_ix - lag(u.day_ix) OVER (PARTITION BY u.hh, u.pno ORDER BY u.seq) AS gap FROM u JOIN r ON u.hh = r.hh AND u.pno = r.pno AND u.seq = r.seq),
g AS (SELECT hh, pno, chain, arg_min(day, seq) AS day, arg_min(day_ix, seq) AS day_ix, arg_min(dep, seq) AS dep, arg_min(coalesce(opurp, -9), seq) AS o, arg_min(coalesce(gap, 0), seq) AS gap,
  arg_min(coalesce(ox, -1), seq) AS ox, arg_min(coalesce(oy, -1), seq) AS oy, arg_min(k % 3 + 1, seq) AS role, arg_max(arr, seq) AS arr, arg_max(dpurp, seq) AS z, arg_max(x, seq) AS x, arg_max(y, seq) AS y,
  arg_max(has_next, seq) AS hn, arg_max(acc, seq) AS mode, max(path) AS path, count(*) AS segments FROM j GROUP BY hh, pno, chain),
l1 AS (SELECT g.hh, g.pno, chain, day, day_ix, dep, arr, CASE WHEN segments = 1 AND z <> 10 AND o = 10 AND gap <= 1 THEN 4 WHEN o = -9 THEN NULL ELSE o END AS opurp, CASE WHEN z = 10 AND NOT (segments > 1 AND hn = 0) THEN 4 ELSE z END AS dpurp,
  mode, path, role, ox, oy, CASE WHEN ox < 0 THEN -1 ELSE 100 + ox END AS otaz, CASE WHEN oy < 0 THEN -1 ELSE 200 + oy END AS opcl, x, y, 100 + x AS dtaz, 200 + y AS dpcl, ptype,
  coalesce(hx, -1) AS hx, coalesce(hy, -1) AS hy, coalesce(htaz, -1) AS htaz, coalesce(hpcl, -1) AS hpcl, coalesce(wx, -1) AS wx, coalesce(wy, -1) AS wy, coalesce(wtaz, -1) AS wtaz, coalesce(wpcl, -1) AS wpcl,
  row_number() OVER (PARTITION BY g.hh, g.pno ORDER BY chain) AS seq FROM g LEFT JOIN pe ON g.hh = pe.hh AND g.pno = pe.pno),
l2 AS (SELECT *, CASE WHEN dpurp = 0 OR (x = hx AND y = hy AND x <> -1 AND y <> -1) THEN 1 WHEN dpurp = 1 OR (x = wx AND y = wy AND x <> -1 AND y <> -1) THEN 2 WHEN x <> -1 AND y <> -1 THEN 4 ELSE 5 END AS dtype FROM l1),
l3 AS (SELECT * REPLACE (CASE WHEN dtype = 1 THEN htaz ELSE dtaz END AS dtaz, CASE WHEN dtype = 1 THEN hpcl ELSE dpcl END AS dpcl) FROM l2),
l4 AS (SELECT *, coalesce(day_ix - lag(day_ix) OVER p <= 1, false) AS ch, lag(x) OVER p AS px, lag(y) OVER p AS py, lag(dtype) OVER p AS pt, lag(dtaz) OVER p AS pz, lag(dpcl) OVER p AS pp, lag(dpurp) OVER p AS pd FROM l3 WINDOW p AS (PARTITION BY hh, pno ORDER BY seq)),
l5 AS (SELECT *, CASE WHEN ch THEN 1 WHEN opurp = 0 OR (ox = hx AND oy = hy AND ox <> -1 AND oy <> -1) THEN 2 WHEN opurp = 1 THEN 3 ELSE 4 END AS f FROM l4),
l6 AS MATERIALIZED (SELECT * REPLACE (([px, hx, wx, -1])[f] AS ox, ([py, hy, wy, -1])[f] AS oy, ([pz, htaz, wtaz, 0])[f] AS otaz, ([pp, hpcl, wpcl, 0])[f] AS opcl, ([pd, 0, 1, 4])[f] AS opurp), ([pt, 1, 2, 5])[f] AS otype,
  sum(CASE WHEN ch THEN 0 ELSE 1 END) OVER (PARTITION BY hh, pno ORDER BY seq ROWS UNBOUNDED PRECEDING) AS run FROM l5),
ck AS (
  SELECT hh, pno, seq, run, dep AS dm, CASE WHEN arr < dep THEN arr + 1440 ELSE arr END AS am FROM l6 WHERE seq = 1
  UNION ALL
  SELECT hh, pno, seq, run, dm, CASE WHEN arr < dm THEN arr + 1440 ELSE arr END FROM (
    SELECT q.hh, q.pno, q.seq, q.run, q.arr, CASE WHEN q.dep < CASE WHEN q.run = ck.run THEN ck.am ELSE 0 END THEN q.dep + 1440 ELSE q.dep END AS dm FROM ck JOIN l6 q ON q.hh = ck.hh AND q.pno = ck.pno AND q.seq = ck.seq + 1)
),
l7 AS MATERIALIZED (SELECT l6.*, dm, am, coalesce(lead(dm) OVER (PARTITION BY l6.hh, l6.pno, l6.run ORDER BY l6.seq), 1680) AS em FROM l6 JOIN ck ON l6.hh = ck.hh AND l6.pno = ck.pno AND l6.seq = ck.seq),
h AS (SELECT *, max(CASE WHEN otype = 1 AND dtype <> 1 THEN seq END) OVER (PARTITION BY hh, pno ORDER BY seq ROWS UNBOUNDED PRECEDING) AS s FROM l7),
c AS (SELECT hh, pno, s AS start, min(seq) AS "end" FROM h WHERE s IS NOT NULL AND otype <> 1 AND dtype = 1 GROUP BY hh, pno, s),
tour AS (SELECT c.hh, c.pno, c.start, c."end", row_number() OVER (PARTITION BY c.hh, c.pno ORDER BY c.start) AS tour FROM c JOIN l7 a ON a.hh = c.hh AND a.pno = c.pno AND a.seq = c.start JOIN l7 b ON b.hh = c.hh AND b.pno = c.pno AND b.seq = c."end" WHERE b.day_ix - a.day_ix <= 30),
m AS (SELECT l7.*, tour, start, "end" FROM l7 JOIN tour ON l7.hh = tour.hh AND l7.pno = tour.pno AND seq BETWEEN start AND "end"),
prim AS (SELECT hh, pno, tour, seq AS pseq, dpurp AS pdpurp, dtype AS ptyp FROM (SELECT *, row_number() OVER (PARTITION BY hh, pno, tour ORDER BY CASE dpurp WHEN 1 THEN CASE WHEN ptype > 4 THEN 2 ELSE 1 END WHEN 2 THEN CASE WHEN ptype > 4 THEN 1 ELSE 2 END WHEN 3 THEN 3 ELSE 4 END, em - am DESC, seq) AS n FROM m WHERE seq < "end") WHERE n = 1),
anchor AS (SELECT hh, pno, tour, any_value(pseq) AS pseq, any_value(pdpurp) AS pdpurp,
  CASE WHEN any_value(pdpurp = 1 AND ptyp = 2) THEN min(CASE WHEN dtype = 2 AND seq <= pseq THEN seq END) ELSE any_value(pseq) END AS arrive,
  CASE WHEN any_value(pdpurp = 1 AND ptyp = 2) THEN coalesce(max(CASE WHEN otype = 2 AND seq > pseq THEN seq END), any_value(pseq) + 1) ELSE any_value(pseq) + 1 END AS leave FROM m JOIN prim USING (hh, pno, tour) GROUP BY hh, pno, tour),
si AS (SELECT m.*, max(CASE WHEN otype = 2 AND dtype <> 2 THEN seq END) OVER (PARTITION BY m.hh, m.pno, m.tour ORDER BY seq ROWS UNBOUNDED PRECEDING) AS s FROM m JOIN anchor USING (hh, pno, tour) WHERE pdpurp = 1 AND leave > arrive + 1 AND seq > arrive AND seq <= leave),
sc AS (SELECT hh, pno, tour, s AS start, min(seq) AS "end", arg_min(day_ix, seq) AS last_day FROM si WHERE s IS NOT NULL AND otype <> 2 AND dtype = 2 GROUP BY hh, pno, tour, s),
sub AS (SELECT sc.hh, sc.pno, sc.tour, row_number() OVER (PARTITION BY sc.hh, sc.pno, sc.tour ORDER BY start) AS subtour, start, "end" FROM sc JOIN l7 ON l7.hh = sc.hh AND l7.pno = sc.pno AND l7.seq = sc.start WHERE last_day - l7.day_ix <= 1),
sm AS (SELECT l7.*, tour, subtour, start, "end" FROM l7 JOIN sub ON l7.hh = sub.hh AND l7.pno = sub.pno AND seq BETWEEN start AND "end"),
sq AS (SELECT hh, pno, tour, subtour, seq AS pseq, dpurp AS pdpurp FROM (SELECT *, row_number() OVER (PARTITION BY hh, pno, tour, subtour ORDER BY CASE dpurp WHEN 1 THEN CASE WHEN ptype > 4 THEN 2 ELSE 1 END WHEN 2 THEN CASE WHEN ptype > 4 THEN 1 ELSE 2 END WHEN 3 THEN 3 ELSE 4 END, em - am DESC, seq) AS n FROM sm WHERE seq < "end") WHERE n = 1),
an AS (SELECT hh, pno, tour, 0 AS subtour, arrive, leave FROM anchor UNION ALL SELECT hh, pno, tour, subtour, pseq, pseq + 1 FROM sq),
ah AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hh, pno, tour, subtour, half ORDER BY seq) AS tseg FROM (SELECT a.*, CASE WHEN seq <= arrive THEN 1 WHEN seq >= leave THEN 2 END AS half
  FROM (SELECT *, 0 AS subtour FROM m UNION ALL BY NAME SELECT * FROM sm) a JOIN an USING {_SUB}) WHERE half IS NOT NULL) WHERE tseg <= 20),
""" + _SUMMARY


def settled_week(spark, folder):
    from ..sources.tables import Config, Stages
    from .week import week_pipeline

    rows = trips(spark, folder).drop("has_next", "act_dur")
    days = rows.select(*PERSON).distinct().select(*PERSON, F.explode(F.sequence(F.lit(1), F.lit(7))).alias("day"))
    days = days.withColumn("is_complete", ((F.col("hh") + F.col("day")) % 4 != 0).cast("int"))
    hh, pno = F.col("hh"), F.col("pno")
    made = {"ptype": (hh + pno) % 8 + 1, "hx": hh % 10, "hy": F.expr("hh div 7 % 10"), "htaz": 500 + hh % 20, "hpcl": 600 + hh, "wx": (hh + pno) % 10, "wy": (hh + 2 * pno) % 10, "wtaz": 700 + pno, "wpcl": 800 + pno}
    persons = rows.where("hh % 5 <> 0").select(*PERSON).distinct().withColumns({n: e.cast("int") for n, e in made.items()})
    ox, oy = F.coalesce("ox", F.lit(-1)), F.coalesce("oy", F.lit(-1))
    ends = {"ox": ox, "oy": oy, "otaz": F.when(ox < 0, -1).otherwise(100 + ox), "opcl": F.when(oy < 0, -1).otherwise(200 + oy), "dtaz": 100 + F.col("x"), "dpcl": 200 + F.col("y"), "role": F.col("k") % 3 + 1}
    return week_pipeline(rows.withColumns(ends), Config(link_minutes=LIMIT, short_link_minutes=SHORT), max_gap=GAP, days=days, persons=persons, stages=Stages(spark, buckets=source.dealt(spark, folder)))


_CLOCK = "({0} % 1440 // 60 * 100 + {0} % 60)::INT"


@query(SETTLED + f""" SELECT hh, pno, rc.day, tour_no AS tour, CASE WHEN subtour > 0 THEN max(CASE WHEN subtour = 0 THEN tour_no END) OVER (PARTITION BY hh, pno, tour) ELSE 0 END AS parent, CASE WHEN subtour > 0 THEN subtour ELSE count(*) FILTER (subtour > 0) OVER (PARTITION BY hh, pno, tour) END AS subtrs, pdpurp,
  {_CLOCK.format("a.dm")} AS tlvorig, {_CLOCK.format("b.am")} AS tardest, {_CLOCK.format("e.dm")} AS tlvdest, {_CLOCK.format("z.am")} AS tarorig, a.otype AS toadtyp, b.dtype AS tdadtyp, a.opcl AS topcl, a.otaz AS totaz, b.dpcl AS tdpcl, b.dtaz AS tdtaz, a.ox AS toxco, a.oy AS toyco, b.x AS tdxco, b.y AS tdyco,
  tmode AS tmodetp, tpath AS tpathtp, stops1 + 1 AS tripsh1, stops2 + 1 AS tripsh2, round(expansion, 6) AS toexpfac
FROM rc JOIN an USING {_SUB} JOIN (SELECT hh, pno, seq AS start, dm, otype, opcl, otaz, ox, oy FROM l7) a USING (hh, pno, start) JOIN (SELECT hh, pno, seq AS arrive, am, dtype, dpcl, dtaz, x, y FROM l7) b USING (hh, pno, arrive)
  JOIN (SELECT hh, pno, seq AS leave, dm FROM l7) e USING (hh, pno, leave) JOIN (SELECT hh, pno, seq AS "end", am FROM l7) z USING (hh, pno, "end")""")
def tour_output(spark, folder):
    return settled_week(spark, folder).tour_output.withColumn("toexpfac", F.round("toexpfac", 6))


_LEG = "hh, pno, day, tour_no AS tour, half, chain AS tsvid"
_FROM, _TO = "opurp, otype AS oadtyp, opcl, otaz", "dpurp, dtype AS dadtyp, dpcl, dtaz"


@query(SETTLED + f""", f AS (SELECT ah.* EXCLUDE (day), rc.day, tour_no, tpath, expansion, min(CASE WHEN mode = 7 THEN tseg END) OVER (PARTITION BY ah.hh, ah.pno, ah.tour, ah.subtour, half) AS first, dm + floor((am - dm) / 2)::INT AS mid FROM ah JOIN rc USING {_SUB}),
f2 AS (SELECT *, CASE WHEN mid + 1 < am THEN mid + 1 ELSE mid END AS again FROM f),
leg AS (
  SELECT {_LEG}, tseg + CASE WHEN tseg > first THEN 1 ELSE 0 END AS tseg, {_FROM}, {_TO}, ox, oy, x, y, mode, path, role, dm, am, em, expansion FROM f2 WHERE tseg <> coalesce(first, -1)
  UNION ALL SELECT {_LEG}, tseg, {_FROM}, 10, 6, -1, -1, ox, oy, x, y, CASE half WHEN 1 THEN 3 ELSE 6 END, CASE half WHEN 1 THEN 0 ELSE tpath END, 1, dm, mid, again, expansion FROM f2 WHERE tseg = first
  UNION ALL SELECT {_LEG}, tseg + 1, 10, 6, -1, -1, {_TO}, ox, oy, x, y, CASE half WHEN 1 THEN 6 ELSE 3 END, CASE half WHEN 1 THEN tpath ELSE 0 END, 1, again, am, em, expansion FROM f2 WHERE tseg = first
) SELECT hh, pno, day, tour, half, tseg, tsvid, opurp, dpurp, oadtyp, dadtyp, opcl, otaz, dpcl, dtaz, ox AS oxco, oy AS oyco, x AS dxco, y AS dyco, mode, path AS pathtype, role AS dorp, {_CLOCK.format("dm")} AS deptm, {_CLOCK.format("am")} AS arrtm, {_CLOCK.format("em")} AS endacttm, round(expansion, 6) AS trexpfac FROM leg""")
def trip_output(spark, folder):
    return settled_week(spark, folder).trip_output.withColumn("trexpfac", F.round("trexpfac", 6))


_KINDS = {1: "wk", 2: "sc", 3: "es", 4: "pb", 5: "sh", 6: "ml", 7: "so"}


@query(SETTLED + f""", st AS (SELECT * FROM (SELECT ah.* EXCLUDE (day), rc.day, max(tseg) OVER (PARTITION BY ah.hh, ah.pno, ah.tour, ah.subtour, half) AS l FROM ah JOIN rc USING {_SUB}) WHERE tseg < l),
bt AS (SELECT hh, pno, rc.day, count(*) FILTER (subtour = 0) AS hbtours, count(*) FILTER (subtour > 0) AS wbtours, count(*) FILTER (subtour = 0 AND pdpurp = 1 AND b.dtype = 2) AS uwtours, {", ".join(f"count(*) FILTER (subtour = 0 AND pdpurp = {p}) AS {n}tours" for p, n in _KINDS.items())}
  FROM rc JOIN an USING {_SUB} JOIN (SELECT hh, pno, seq AS arrive, dtype FROM l7) b USING (hh, pno, arrive) GROUP BY hh, pno, rc.day),
bs AS (SELECT hh, pno, day, {", ".join(f"count(*) FILTER (dpurp = {p}) AS {n}stops" for p, n in _KINDS.items())} FROM st GROUP BY hh, pno, day),
dt AS (SELECT hh, pno, day, coalesce((first(opurp ORDER BY seq) = 0)::INT, 0) AS beghom, coalesce((arg_max(dpurp, seq) = 0)::INT, 0) AS endhom FROM l7 GROUP BY hh, pno, day)
SELECT fl.hh, fl.pno, fl.day, coalesce(beghom, 1) AS beghom, coalesce(endhom, 1) AS endhom, {", ".join(f"coalesce({n}, 0) AS {n}" for n in ["hbtours", "wbtours", "uwtours", *(f"{n}{k}" for k in ("tours", "stops") for n in _KINDS.values())])}, round(CASE WHEN fl.day <= 5 AND wk.n > 0 THEN 1.0 / wk.n ELSE 0 END, 6) AS pdexpfac
FROM fl JOIN wk USING (hh, pno) LEFT JOIN dt USING (hh, pno, day) LEFT JOIN bt USING (hh, pno, day) LEFT JOIN bs USING (hh, pno, day)""")
def person_day_output(spark, folder):
    return settled_week(spark, folder).day_output.withColumn("pdexpfac", F.round("pdexpfac", 6))


def _case(e: str, table: dict, default: str | None = None) -> str:
    return f"CASE {e} " + " ".join(f"WHEN {k} THEN {v}" for k, v in table.items()) + f" ELSE {default or e} END"


def _week_persons_sql() -> str:
    ids = "c_custkey // 3 AS hh, (c_custkey % 3 + 1)::INT AS pno"
    made = {"age0": "c_custkey % 12", "gender0": "c_custkey % 5", "employment": "c_custkey % 9", "student": "c_custkey % 6", "school_type": "c_custkey % 8", "work_county": "c_custkey % 4", "school_county": "c_custkey % 5"}
    zones = ", ".join(f"CASE WHEN {p}_county IN (1, 3) AND {act} THEN hh::INT + {k} ELSE -1 END AS {p}_{z}" for p, act in (("work", "worker > 0"), ("school", "student_type > 0")) for k, z in enumerate(("zone", "parcel")))
    unknown = "-1 AS work_auto_minutes, -1 AS work_auto_miles, -1 AS school_auto_minutes, -1 AS school_auto_miles, -1 AS transit_pass, -1 AS paid_parking, -1 AS paper_diary, -1 AS proxy"
    ages = {1: 3, 2: 10, 3: 16, 4: 21, 5: 30, 6: 40, 7: 50, 8: 60, 9: 70, 10: 80, 11: 90}
    genders, students = {1: 2, 2: 1, 4: 3, 997: 3, 995: 9, 999: 9}, {0: 1, 1: 2, 2: 0, 3: 2, 4: 1, 995: -1}
    return f"""WITH p AS (SELECT {ids}, {", ".join(f"({e})::INT AS {n}" for n, e in made.items())}, (c_custkey % 7)::DOUBLE AS weight FROM customer),
q AS (SELECT *, {_case("age0", ages)} AS age, {_case("gender0", genders)} AS gender, {_case("student", students)} AS student_type FROM p),
t AS (SELECT *, CASE WHEN age < 5 THEN 8 WHEN age < 16 THEN 7 WHEN employment IN (1, 3, 8) THEN 1 WHEN student IN (0, 1, 3, 4) AND (age < 18 OR (age < 25 AND school_type IN (4, 7))) THEN 6 WHEN student IN (0, 1, 3, 4) THEN 5 WHEN employment IN (2, 3, 7) THEN 2 WHEN age < 65 THEN 4 ELSE 3 END AS ptype FROM q),
w AS (SELECT *, CASE WHEN ptype IN (1, 2) THEN ptype WHEN ptype IN (5, 6) AND employment IN (1, 2, 3) THEN 2 ELSE 0 END AS worker FROM t)
SELECT hh, pno, ptype, age, gender, worker, student_type, {zones}, -1.0 AS work_x, -1.0 AS work_y, 1.0 * pno AS school_x, -1.0 AS school_y, {unknown}, weight AS expansion FROM w"""


@query(_week_persons_sql())
def week_pipeline_persons(spark, folder):
    from ..sources.tables import Config
    from .week import person_output, reformat_persons

    (c,) = tables(spark, folder, "customer")
    k = F.col("c_custkey")
    made = {"age": k % 12, "gender": k % 5, "employment": k % 9, "student": k % 6, "school_type": k % 8, "work_county": k % 4, "school_county": k % 5, "work_park": F.lit(1), "residence_rent_own": F.lit(1), "residence_type": F.lit(1)}
    rows = c.select(F.expr("c_custkey div 3").alias("hh"), (k % 3 + 1).cast("int").alias("pno"), *(e.cast("int").alias(n) for n, e in made.items()), (k % 7).cast("double").alias("weight"))
    none = F.lit(None).cast("double")
    rows = rows.withColumns({**{f"{p}_{z}": (F.col("hh") + n).cast("int") for p in ("work", "school") for n, z in enumerate(("zone", "parcel"))}, "work_x": none, "work_y": none, "school_x": 1.0 * F.col("pno"), "school_y": none})
    return person_output(reformat_persons(rows, completeness(source.diary(spark, folder)), Config(counties=(1, 3))))


# joint tours of a household whose ends another one shares
@query("SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN (count(*) FILTER (c_custkey % 3 > 0) OVER (PARTITION BY c_nationkey, c_custkey % 11, c_custkey % 7) > 1)::INT END AS identify FROM customer")
def identify_joint_tours(spark, folder):
    (c,) = tables(spark, folder, "customer")
    k = F.col("c_custkey")
    rows = c.select(k, F.col("c_nationkey").alias("hh"), (k % 3 > 0).cast("int").alias("fully_joint"), (k % 11).alias("o"), (k % 7).alias("d"))
    return joint.identified(rows, ["o", "d"]).select("c_custkey", "identify")


@query("""WITH p AS (SELECT c_custkey AS point_id, 'home' AS role, (c_custkey % 131) / 20.0 - 0.5 AS x, (c_custkey % 97) / 16.0 - 0.5 AS y FROM customer
  UNION ALL SELECT c_custkey, 'work', (c_custkey % 89) / 15.0 - 0.5, (c_custkey % 113) / 18.0 - 0.5 FROM customer),
z AS (SELECT n_nationkey AS zone_id, n_nationkey % 5 + 0.1 AS x1, n_nationkey % 5 + 0.8 AS x2, n_nationkey // 5 + 0.1 AS y1, n_nationkey // 5 + 0.8 AS y2 FROM nation),
n AS (SELECT point_id, role, zone_id, sqrt(greatest(x1 - x, 0, x - x2) ** 2 + greatest(y1 - y, 0, y - y2) ** 2) AS d FROM p, z),
b AS (SELECT *, row_number() OVER (PARTITION BY point_id, role ORDER BY round(d, 9), zone_id) AS r FROM n WHERE d <= 0.3)
SELECT point_id, max(zone_id) FILTER (role = 'home' AND r = 1) AS home_zone, max(zone_id) FILTER (role = 'work' AND r = 1) AS work_zone FROM (SELECT DISTINCT point_id FROM p) LEFT JOIN b USING (point_id) GROUP BY point_id""")
def zones_of_roles(spark, folder):
    c, n = tables(spark, folder, "customer", "nation")
    k = F.col("c_custkey")
    points = c.select(k.alias("point_id"), ((k % 131) / 20.0 - 0.5).alias("hx"), ((k % 97) / 16.0 - 0.5).alias("hy"), ((k % 89) / 15.0 - 0.5).alias("wx"), ((k % 113) / 18.0 - 0.5).alias("wy"))
    a, b = (F.col("n_nationkey") % 5).cast("double"), F.expr("cast(n_nationkey div 5 as double)")
    corner = [(a + i, b + j) for i, j in ((0.1, 0.1), (0.8, 0.1), (0.8, 0.8), (0.1, 0.8), (0.1, 0.1))]
    edges = F.array(*(F.struct(p[0].alias("x1"), p[1].alias("y1"), q[0].alias("x2"), q[1].alias("y2")) for p, q in zip(corner, corner[1:], strict=False)))
    zones = n.select(F.col("n_nationkey").alias("zone_id"), edges.alias("edges"))
    return spatial.nearest_zones(points, zones, 0.3, {"home": ("hx", "hy"), "work": ("wx", "wy")}).select("point_id", "home_zone", "work_zone")


# blocks beside a zone that is two thousand times as wide
@query("""WITH p AS (SELECT c_custkey AS point_id, (c_custkey % 1310) / 7.0 - 20.0 AS x, (c_custkey % 97) / 5.0 - 3.0 AS y FROM customer),
z AS (SELECT n_nationkey AS zone_id, n_nationkey % 5 + 0.1 AS x1, n_nationkey % 5 + 0.8 AS x2, n_nationkey // 5 + 0.1 AS y1, n_nationkey // 5 + 0.8 AS y2 FROM nation
  UNION ALL SELECT 100 + r_regionkey, 10.0 + r_regionkey * 4, 10.0 + r_regionkey * 4 + 4.0 ** r_regionkey, r_regionkey + 6.0, r_regionkey + 6.0 + 6.0 ** r_regionkey FROM region),
n AS (SELECT point_id, zone_id, sqrt(greatest(x1 - x, 0, x - x2) ** 2 + greatest(y1 - y, 0, y - y2) ** 2) AS d FROM p, z),
b AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY round(d, 9), zone_id) AS r FROM n WHERE d <= 0.3)
SELECT p.point_id, zone_id, round(d, 6) AS distance FROM p LEFT JOIN b ON p.point_id = b.point_id AND r = 1""")
def zones_of_unlike_sizes(spark, folder):
    c, n, r = tables(spark, folder, "customer", "nation", "region")
    k, key = F.col("c_custkey"), F.col("r_regionkey")
    points = c.select(k.alias("point_id"), ((k % 1310) / 7.0 - 20.0).alias("x"), ((k % 97) / 5.0 - 3.0).alias("y"))
    a, b = (F.col("n_nationkey") % 5).cast("double"), F.expr("cast(n_nationkey div 5 as double)")
    blocks = n.select(F.col("n_nationkey").cast("long").alias("zone_id"), _rectangle(a + 0.1, b + 0.1, a + 0.8, b + 0.8))
    x, y = 10.0 + key * 4, key + 6.0
    wide = r.select((100 + key).cast("long").alias("zone_id"), _rectangle(x, y, x + F.pow(F.lit(4.0), key), y + F.pow(F.lit(6.0), key)))
    return spatial.nearest_zone_join(points, blocks.unionByName(wide), 0.3).select("point_id", "zone_id", F.round("distance", 6).alias("distance"))


def _rectangle(x1, y1, x2, y2):
    corner = [(x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1)]
    return F.array(*(F.struct(p[0].alias("x1"), p[1].alias("y1"), q[0].alias("x2"), q[1].alias("y2")) for p, q in zip(corner, corner[1:], strict=False))).alias("edges")


# places in degrees, and a limit in feet
@query("""WITH p AS (SELECT c_custkey AS point_id, (c_custkey % 131) / 2000.0 - 122.5 AS lon, (c_custkey % 97) / 1500.0 + 37.7 AS lat FROM customer),
z AS (SELECT n_nationkey AS zone_id, n_nationkey % 5 / 80.0 - 122.499 AS x1, n_nationkey % 5 / 80.0 - 122.493 AS x2, n_nationkey // 5 / 80.0 + 37.701 AS y1, n_nationkey // 5 / 80.0 + 37.707 AS y2 FROM nation),
f AS (SELECT 3963.1676 * 5280 AS r, cos(radians(37.75)) AS c),
n AS (SELECT point_id, zone_id, sqrt((r * c * radians(greatest(x1 - lon, 0, lon - x2))) ** 2 + (r * radians(greatest(y1 - lat, 0, lat - y2))) ** 2) AS d FROM p, z, f),
b AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY round(d, 6), zone_id) AS r FROM n WHERE d <= 1320)
SELECT p.point_id, zone_id, round(d, 2) AS feet FROM p LEFT JOIN b ON p.point_id = b.point_id AND r = 1""")
def nearest_zone_feet(spark, folder):
    c, n = tables(spark, folder, "customer", "nation")
    k = F.col("c_custkey")
    points = c.select(k.alias("point_id"), ((k % 131) / 2000.0 - 122.5).alias("x"), ((k % 97) / 1500.0 + 37.7).alias("y"))
    a, b = F.col("n_nationkey") % 5 / 80.0, F.expr("cast(n_nationkey div 5 as double)") / 80.0
    zones = n.select(F.col("n_nationkey").alias("zone_id"), _rectangle(a - 122.499, b + 37.701, a - 122.493, b + 37.707))
    return spatial.nearest_zone_join(points, zones, 1320.0, latitude=37.75).select("point_id", "zone_id", F.round("distance", 2).alias("feet"))


@query("SELECT o_custkey, string_agg(o_orderpriority, '-' ORDER BY o_orderkey) AS priorities, string_agg(o_orderstatus, '' ORDER BY o_orderkey) AS statuses FROM orders GROUP BY o_custkey")
def ordered_text(spark, folder):
    (o,) = tables(spark, folder, "orders")
    return o.groupBy("o_custkey").agg(relational.joined_text("o_orderkey", F.col("o_orderpriority")).alias("priorities"), relational.joined_text("o_orderkey", F.col("o_orderstatus"), "").alias("statuses"))


def _scratch(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# what is written as text is read again with the types and columns asked for
@query("SELECT c_custkey, c_nationkey::BIGINT AS c_nationkey, c_mktsegment, round(c_acctbal, 2) AS c_acctbal FROM customer WHERE c_custkey % 10 > 0 UNION ALL SELECT c_custkey, c_nationkey, c_mktsegment, round(c_acctbal, 2) FROM customer WHERE c_custkey % 10 = 0")
def csv_round_trip(spark, folder):
    (c,) = tables(spark, folder, "customer")
    rows, path = c.select("c_custkey", "c_name", "c_nationkey", F.round("c_acctbal", 2).alias("c_acctbal"), "c_mktsegment"), _scratch(spark, "customers")
    write_csv(rows.where("c_custkey % 10 > 0"), path)
    write_csv(relational.union_all(empty_like(rows), rows.where("c_custkey % 10 = 0")), path, "append")
    return read_csv(spark, path, "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string", ["c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"])


@query("SELECT l_orderkey, l_linenumber::INTEGER AS l_linenumber, l_comment_like FROM (SELECT l_orderkey, l_linenumber, l_returnflag || '\"' || l_linestatus AS l_comment_like FROM lineitem) WHERE l_orderkey % 997 > 0")
def bulk_load(spark, folder):
    (items,) = tables(spark, folder, "lineitem")
    key = F.when(F.col("l_orderkey") % 997 > 0, F.col("l_orderkey").cast("string")).otherwise(F.lit("none"))
    path = _scratch(spark, "lines")
    write_csv(items.select(key.alias("key"), "l_linenumber", F.concat("l_returnflag", F.lit('"'), "l_linestatus").alias("flags")), path, quote="")
    rows, _ = bulk_load_counted(spark, path, "l_orderkey long, l_linenumber int, l_comment_like string", max_errors=1 << 40)
    return rows


@query("SELECT o_orderkey, o_custkey, year(o_orderdate)::VARCHAR AS batch FROM orders")
def appended_batches(spark, folder):
    (o,) = tables(spark, folder, "orders")
    rows, table = o.select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("string").alias("year")), f"batches_{uuid.uuid4().hex}"
    years = sorted(r.year for r in rows.select("year").distinct().collect())
    for year in [*years, years[0]]:  # one of them twice, as a job that was tried again
        append_batch(rows.where(F.col("year") == year).drop("year"), table, year, bucket_by=("o_custkey",))
    return spark.table(table)


@query("SELECT l_orderkey, l_linenumber, o_custkey AS hh, (o_orderkey % 7)::INTEGER AS pno FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 5 > 0) ON l_orderkey = o_orderkey")
def located_trips(spark, folder):
    from .week import attach_person

    items, o = tables(spark, folder, "lineitem", "orders")
    made = o.where("o_orderkey % 5 > 0").select(F.col("o_orderkey").alias("trip_id"), F.col("o_custkey").alias("hh"), (F.col("o_orderkey") % 7).cast("int").alias("pno"))
    return attach_person(items.select(F.col("l_orderkey").alias("trip_id"), "l_linenumber"), made).withColumnRenamed("trip_id", "l_orderkey")


@query(T + " SELECT event_id, ((CASE WHEN arr < dep THEN arr - dep + 1440 ELSE arr - dep END) // 60)::INT AS hours, (CASE WHEN arr < dep THEN arr - dep + 1440 ELSE arr - dep END) % 60 AS minutes, arr // 60 * 100 + arr % 60 AS hhmm FROM u")
def hours_and_minutes(spark, folder):
    hours, minutes = clock.hours_and_minutes(F.col("arr") - F.col("dep"))
    return trips(spark, folder).select("event_id", hours.alias("hours"), minutes.alias("minutes"), clock.hm_to_hhmm(clock.div(F.col("arr"), 60), F.col("arr") % 60).alias("hhmm"))


@query("""WITH p AS (SELECT c_custkey // 3 AS hh, c_custkey % 3 + 1 AS pno, c_custkey % 4 AS rent, c_custkey % 10 AS kind FROM customer),
f AS (SELECT hh, arg_min(CASE rent WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE rent END, pno) AS owner, arg_min(CASE kind WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 3 WHEN 5 THEN 3 WHEN 6 THEN 3 WHEN 7 THEN 4 WHEN 9 THEN 5 ELSE kind END, pno) AS home_type FROM p GROUP BY hh),
h AS (SELECT DISTINCT hh, ([999, 1, 4, 10])[hh % 4 + 1] AS d, ([999, 1, 3, 6])[hh % 3 + 1] AS a FROM p)
SELECT h.hh, (CASE d WHEN 999 THEN CASE a WHEN 999 THEN -1 WHEN 1 THEN 12500 WHEN 3 THEN 62500 WHEN 6 THEN 250000 END WHEN 1 THEN 7500 WHEN 4 THEN 42500 WHEN 10 THEN 350000 END)::INTEGER AS income, owner::INTEGER AS owner, home_type::INTEGER AS home_type FROM h JOIN f ON h.hh = f.hh""")
def reported_households(spark, folder):
    from ..sources.tables import Config
    from .week import reformat_households, reformat_persons

    (c,) = tables(spark, folder, "customer")
    k, hh = F.col("c_custkey"), F.expr("c_custkey div 3")
    names = ("age", "gender", "employment", "student", "school_type", "work_park", "work_county", "school_county", "work_zone", "work_parcel", "school_zone", "school_parcel")
    rows = c.select(hh.alias("hh"), (k % 3 + 1).cast("int").alias("pno"), (k % 4).cast("int").alias("residence_rent_own"), (k % 10).cast("int").alias("residence_type"), *(F.lit(1).alias(n) for n in names), *(F.lit(0.0).alias(n) for n in ("work_x", "work_y", "school_x", "school_y")))
    pick = lambda *values: F.get(F.array(*map(F.lit, values)), (F.col("hh") % len(values)).cast("int"))
    homes = rows.select("hh").distinct().select("hh", pick(999, 1, 4, 10).alias("income_detailed"), pick(999, 1, 3).alias("income_followup"))
    people = reformat_persons(rows, rows.select(*PERSON), Config(counties=(1,)))
    return reformat_households(homes, people).select("hh", "income", "owner", "home_type")


@query("SELECT event_id, dense_rank() OVER (ORDER BY user_id // 3)::BIGINT AS household_no, dense_rank() OVER (ORDER BY event_type, user_id // 3)::BIGINT AS kind_no FROM events")
def household_numbers(spark, folder):
    (events,) = tables(spark, folder, "events")
    rows = events.select("event_id", "event_type", F.expr("user_id div 3").alias("hh"))
    out = relational.dense_numbers(relational.dense_numbers(rows, ["hh"], "household_no"), ["event_type", "hh"], "kind_no")
    return out.select("event_id", "household_no", "kind_no")


@query("""SELECT c_custkey, CASE jobs WHEN 1 THEN h WHEN 2 THEN h + h % 7 WHEN 3 THEN h + h % 7 + h % 5 END AS hours,
  CASE WHEN student = 1 AND level = 97 THEN CASE word WHEN 'GED' THEN 4 WHEN 'INSTITUTE' THEN 5 ELSE CASE WHEN age >= 19 THEN 5 ELSE 4 END END WHEN student = 1 AND (level IS NULL OR level IN (98, 99)) THEN CASE WHEN age >= 19 THEN 5 ELSE 4 END ELSE level END AS level
FROM (SELECT c_custkey, (c_custkey % 4)::INT AS jobs, (c_custkey % 50)::INT AS h, (c_custkey % 2)::INT AS student, (c_custkey % 30)::INT AS age, ([97, 98, NULL, 3, 97])[c_custkey % 5 + 1] AS level, (['GED', 'INSTITUTE', 'elsewhere'])[c_custkey % 3 + 1] AS word FROM customer)""")
def jobs_and_schools(spark, folder):
    (c,) = tables(spark, folder, "customer")
    k, of = F.col("c_custkey"), (lambda e: e.cast("int"))
    h = of(k % 50)
    pick = lambda values: F.get(F.array(*map(F.lit, values)), of(k % len(values)))
    level = places.school_level(pick([97, 98, None, 3, 97]), pick(["GED", "INSTITUTE", "elsewhere"]), of(k % 2), of(k % 30))
    return c.select("c_custkey", places.hours_of_jobs(of(k % 4), h, h % 7, h % 5).alias("hours"), level.alias("level"))
