"""Recodes and ordered conditions."""

from __future__ import annotations

from functools import reduce
from itertools import chain
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def recode(c: Column, mapping: dict, strict: bool = False, default=None) -> Column:
    """Values by a mapping; others pass through, or become default if strict."""
    if not mapping:
        return F.lit(default) if strict else c
    table = F.create_map(*(F.lit(x) for x in chain.from_iterable(mapping.items())))
    found = F.try_element_at(table, c)
    return F.coalesce(found, F.lit(default) if strict else c)


def cases(*branches: tuple[Column, object], default=None) -> Column:
    """The value of the first condition that holds."""
    value = lambda v: v if isinstance(v, Column) else F.lit(v)
    first, *rest = branches
    out = F.when(first[0], value(first[1]))
    for condition, v in rest:
        out = out.when(condition, value(v))
    return out.otherwise(value(default))


def any_of(columns: list[Column], values: list) -> Column:
    """Whether one of the columns has one of the values; nulls don't count."""
    return reduce(or_, (F.coalesce(c.isin(*values), F.lit(False)) for c in columns))


def gate(value: Column, area: Column, areas: list, active: Column | None = None, outside=-1) -> Column:
    """value where the area is one of areas and active holds, else outside; a null area is outside."""
    inside = area.isin(*areas) if active is None else area.isin(*areas) & active
    return F.when(inside, value).otherwise(F.lit(outside))


def positive_or(first: Column, second: Column) -> Column:
    """The first value if it is above 0, else the second: a detailed answer and its follow-up."""
    return F.when(first > 0, first).otherwise(second)


def split_key(key: Column, base: int = 100) -> tuple[Column, Column]:
    """A joint key as its household and its person: hh * base + pno."""
    return F.floor(key / F.lit(base)).cast("long"), (key % base).cast("int")


def null_to_sentinel(c: Column, sentinel=-1) -> Column:
    return F.coalesce(c, F.lit(sentinel))


def sentinel_to_null(c: Column, sentinels: list) -> Column:
    return F.when(~c.isin(*sentinels), c)
