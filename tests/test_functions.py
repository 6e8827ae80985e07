import pytest
from pyspark.sql import functions as F

from wayfold.functions import clock, numeric, recode, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


def test_clock(spark):
    v = lambda c: value(spark, c)
    assert v(clock.hhmm_to_min(F.lit(1345))) == 825
    assert v(clock.min_to_hhmm(F.lit(1500))) == 100
    assert v(clock.clock_text(F.lit(7), F.lit(5), F.lit(0))) == "07:05:00"
    assert v(clock.wrapped(F.lit(-30))) == 1410
    assert v(clock.midpoint(F.lit(10), F.lit(15))) == 12
    assert [v(c) for c in clock.hours_and_minutes(F.lit(-15))] == [23, 45]


def test_text(spark):
    v = lambda c: value(spark, c)
    assert v(text.nth_instr("S", F.lit("PARSONS"), 2)) == 7
    assert v(text.nth_instr("S", F.lit("PARSONS"), 3)) == 0
    assert v(text.nth_instr("S", F.lit("PARSONS"), 9)) == 0
    assert v(text.nth_token(F.lit("1.2.4"), 3)) == "4"
    assert v(text.nth_token(F.lit("1.2.4"), 4)) is None
    assert v(text.token_count(F.lit("1.2.4"))) == 3
    assert v(text.contains_any(F.lit("Main st Station"), ["BUS STOP", "STATION"])) is True
    assert v(text.contains_any(F.lit(None).cast("string"), ["A"])) is False


def test_numbers(spark):
    v = lambda c: value(spark, c)
    zero, one = F.lit(0.0), F.lit(1.0)
    assert v(numeric.great_circle_miles(zero, zero, zero, zero)) == 0
    assert v(numeric.great_circle_miles(zero, zero, one, zero, 2)) == 69.17
    knots = [F.lit(float(10 - k)) for k in range(9)]
    assert v(numeric.lerp_score(F.lit(90), knots)) == 8.5
    assert v(numeric.lerp_score(F.lit(900), knots)) == 2.0
    assert v(numeric.lerp_score(F.lit(-1), knots)) is None
    assert v(numeric.share(F.lit(6.0), F.lit(0), F.lit(True))) == 0
    assert v(numeric.share(F.lit(6.0), F.lit(4), F.lit(True))) == 1.5
    assert v(numeric.near_equal(F.lit(1.0), F.lit(1.0000005))) is True
    assert v(numeric.cap(F.lit(9.0), 4.0)) == 4


def test_recode(spark):
    v = lambda c: value(spark, c)
    assert v(recode.recode(F.lit(995), {1: 10})) == 995
    assert v(recode.recode(F.lit(995), {1: 10}, strict=True)) is None
    assert v(recode.cases((F.lit(False), 1), (F.lit(True), 2), (F.lit(True), 3))) == 2
    assert v(recode.gate(F.lit(7), F.lit(None).cast("int"), [1])) == -1
    assert v(recode.any_of([F.lit(None).cast("int"), F.lit(3)], [3])) is True
    assert v(recode.sentinel_to_null(F.lit(998), [998, 999])) is None
    assert v(recode.null_to_sentinel(F.lit(None).cast("int"))) == -1


@pytest.mark.parametrize(("modes", "toll", "riders", "code"), [
    (["SCHOOLBUS", "TAXI"], 1, 1, 18), (["TAXI", "WALK"], 1, 1, 19), (["DRIVER"], 2, 1, 1), (["DRIVER", "WALK"], 1, 1, 2), (["PASSENGER"], 9, 2, 3), (["DRIVER"], 1, 4, 6),
    (["WALK"], 2, 0, 7), (["BIKE/MOPED"], 2, 0, 7), (["WALK", "RAIL"], 2, 1, 11), (["DRIVER", "RAIL"], 2, 1, 14), (["PASSENGER", "EXPRESSBUS"], 2, 1, 16), (["LOCALBUS"], 2, 1, 9), (["DRIVER"], 999, 1, None),
])
def test_mode_code(spark, modes, toll, riders, code):
    from wayfold.operators.places import mode_code

    assert value(spark, mode_code(F.array(*map(F.lit, modes)), F.lit(toll), F.lit(riders))) == code
