"""The place pipeline: visited places of a day become linked legs, tours, subtours, trips and joint travel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joint, places


@dataclass(frozen=True)
class PlaceTables:
    """What the pipeline makes; nothing is computed before a table is used.

    individual_tours and joint_tours are the records of tours taken apart, joint ones once for each party, with
    joint_no, members, their types and composition; trips have the party and, of joint tours, the tour's joint_no.
    """

    legs: DataFrame
    tours: DataFrame
    subtours: DataFrame
    stops: DataFrame
    records: DataFrame
    subtour_records: DataFrame
    trips: DataFrame
    parties: DataFrame
    individual_tours: DataFrame
    joint_tours: DataFrame


@dataclass(frozen=True)
class Joint:
    """When members travel together: how far times may be apart, which places must be the same, and on which day.

    ends: what another fully joint tour of the household must have in common for a tour to count as joint. same: what
    tells that two members report one tour.
    """

    minutes: int = 4
    places: tuple[str, ...] = ("ox", "oy", "x", "y")
    day: str | None = None
    ends: tuple[str, ...] = ("ox", "oy", "dx", "dy")
    same: tuple[str, ...] = ("dep", "ox", "oy", "dx", "dy")


def place_pipeline(visited: DataFrame, scores: DataFrame, persons: DataFrame | None = None, together: Joint = Joint()) -> PlaceTables:  # noqa: B008
    """From places (hh, pno, seq, aggact, modename, x, y, ox, oy, dep, arr, odep, act_dur, minutes, miles, toll, riders).

    persons (hh, pno, ptype) tells the types of a party's members; without it they are unknown. A tour is joint if all
    its trips have one and the same party, it isn't mandatory, and another member's tour confirms it.
    """
    legs = places.transit_defaults(places.parking_rule(places.link_places(visited)))
    times = visited.select("hh", "pno", "seq", "dep", "arr", "act_dur", *([together.day] if together.day else []))
    linked = legs.join(times, ["hh", "pno", "seq"]).withColumn("code", places.mode_code(F.col("modes"), F.col("toll"), F.col("riders")))
    numbered = places.number_tours(linked)
    scored = places.score_primary_destination(numbered.where("tour > 0"), scores)
    subtours = places.number_work_subtours(numbered)
    records = places.child_tours(places.tour_records(scored), subtours)
    below = places.subtour_records(records, subtours, scores)
    more = ("odep", "arr", *([together.day] if together.day else []))
    trips = joint.detect_parties(places.trip_records(scored, more=more), together.minutes, ("odep", "arr"), together.places, together.day)
    found = joint.classify_joint_tours(trips)
    tours = joint.identified(records.join(found, ["hh", "pno", "tour"]).withColumn("subtour", F.lit(0)), list(together.ends), same_row=False)
    alone, shared = joint.split_joint(tours, list(together.same), identify=True)
    kinds = persons if persons is not None else visited.select("hh", "pno", F.lit(None).cast("string").alias("ptype"))
    shared = joint.party_fields(shared, kinds)
    trips = joint.number_joint_trips(trips, shared)
    return PlaceTables(legs, numbered, subtours, places.stop_fields(scored, ["aggact", "x", "y"]), records, below, trips, joint.detect_parties(linked.where("leg > 0")), alone.drop("subtour"), shared.drop("subtour"))
