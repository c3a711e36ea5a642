"""Severity colours of map cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.functions.timeops import col

# Colours for two or more, one and no flagged trips.
DARK = ("#910606", "#FFFF00", "#086e1f")
LIGHT = ("#FF0000", "#FFFF00", "#00FF00")
# Rank of every colour either palette can hold.
RANKS = {"#910606": 2, "#FF0000": 2, "#FFFF00": 1, "#086e1f": 0, "#00FF00": 0}


def severity_colour(count: str | Column, palette: tuple[str, str, str] = DARK) -> Column:
    many, one, none = palette
    return F.when(col(count) > 1, many).when(col(count) == 1, one).otherwise(none)


def colour_rank(colour: str | Column) -> Column:
    """2, 1 or 0; an unknown colour counts as 0."""
    out = F.lit(0)
    for name, rank in RANKS.items():
        if rank:
            out = F.when(col(colour) == name, rank).otherwise(out)
    return out


def rank_colour(rank: str | Column, palette: tuple[str, str, str] = DARK) -> Column:
    return severity_colour(rank, palette)
