"""Signal-name expressions."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.functions.timeops import col


def clean_alias(alias: str | Column) -> Column:
    """Lower-case, without digits and underscores."""
    return F.regexp_replace(F.lower(F.replace(col(alias), F.lit("_"), F.lit(""))), r"\d", "")


def clean_name(name: str) -> str:
    """The same cleaning for a literal."""
    return "".join(ch for ch in name.lower() if ch != "_" and not ch.isdigit())


def strip_prefix(alias: str | Column, times: int = 2) -> Column:
    """Drop everything up to and including the first underscore, ``times`` times over."""
    out = col(alias)
    for _ in range(times):
        out = F.regexp_replace(out, r"^[^_]*_", "")
    return out


def levenshtein_ratio(left: str | Column, right: str | Column) -> Column:
    """1 - edit distance / longer length, all inside the JVM."""
    longest = F.greatest(F.length(col(left)), F.length(col(right)))
    return F.when(longest == 0, F.lit(1.0)).otherwise(
        F.lit(1.0) - F.levenshtein(col(left), col(right)) / longest
    )


def closest_key(cleaned: str | Column, keys: Sequence[str], cutoff: float) -> Column:
    """Most similar key by matching-block ratio, null below the cutoff.

    The ratio has no JVM counterpart, so this runs as an Arrow UDF. Feed it
    distinct names, not rows.
    """
    options = list(keys)

    @F.pandas_udf("string")
    def closest(names: pd.Series) -> pd.Series:
        import difflib

        def best(name):
            if name is None:
                return None
            found = difflib.get_close_matches(name, options, n=1, cutoff=cutoff)
            return found[0] if found else None

        return names.map(best)

    return closest(col(cleaned))
