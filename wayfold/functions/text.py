"""Delimited strings and the places of substrings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nth_instr(sub: str, s: Column, n: int) -> Column:
    """Where the nth occurrence of sub begins, from 1; 0 if there are fewer."""
    found = F.size(F.split(s, f"\\Q{sub}\\E", -1)) > n
    return F.when(found, F.char_length(F.substring_index(s, sub, n)) + 1).when(s.isNotNull(), 0)


def tokens(s: Column, sep: str = ".") -> Column:
    return F.split(s, f"\\Q{sep}\\E", -1)


def nth_token(s: Column, n: int, sep: str = ".") -> Column:
    """The nth token, from 1; null if there are fewer."""
    return F.try_element_at(tokens(s, sep), F.lit(n))


def token_count(s: Column, sep: str = ".") -> Column:
    return F.size(tokens(s, sep))


def contains_any(s: Column, parts: list[str]) -> Column:
    """Whether s contains one of the parts; letter case doesn't count, and null contains none."""
    found = F.lit(False)
    for p in parts:
        found = found | (F.instr(F.upper(s), p.upper()) > 0)
    return F.coalesce(found, F.lit(False))
