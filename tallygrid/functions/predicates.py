"""Row predicates and NULL rules."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
RECENT_DAYS = 7
LIVE_SLACK = "30 minutes"
# -----------------------------------------------------------------------------

_NUMBER = r"\s*(-?\d+(?:\.\d+)?)\s*"


def interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def recent(as_of: Column, end: str = "end_time_utc", days: int = RECENT_DAYS) -> Column:
    return F.col(end) > as_of - interval(f"{days} days")


def live(as_of: Column, slack: str = LIVE_SLACK, start: str = "start_time_utc",
         end: str = "end_time_utc") -> Column:
    """Running at ``as_of``, give or take ``slack``, borders included."""
    return ((F.col(start) <= as_of + interval(slack))
            & (F.col(end) >= as_of - interval(slack)))


def has_position(lat: str = "latitude", lng: str = "longitude") -> Column:
    return F.col(lat).isNotNull() & F.col(lng).isNotNull()


def match_number(c: Column, text: str | None) -> Column:
    """Search box for numbers: ``""``, ``<`` and ``>`` match all; ``>n``, ``<n``,
    ``>=n``, ``<=n``; ``a>>b`` means a > x > b; ``a<<b`` means a < x < b; ``n``
    means equal. Anything else is an error."""
    text = (text or "").strip()
    if text in ("", "<", ">"):
        return F.lit(True)
    m = re.fullmatch(_NUMBER + r"(>>|<<)" + _NUMBER, text)
    if m:
        a, b = float(m[1]), float(m[3])
        high, low = (a, b) if m[2] == ">>" else (b, a)
        return (c < F.lit(high)) & (c > F.lit(low))
    m = re.fullmatch(r"(>=|<=|>|<)" + _NUMBER, text)
    if m:
        n = F.lit(float(m[2]))
        return {">": c > n, "<": c < n, ">=": c >= n, "<=": c <= n}[m[1]]
    m = re.fullmatch(_NUMBER, text)
    if m:
        return c == F.lit(float(m[1]))
    raise ValueError(f"not a number filter: {text!r}")


def falsy_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """0, false and blank text become NULL, in the listed columns only."""
    types = dict(df.dtypes)

    def rule(name: str) -> Column:
        c, kind = F.col(name), types[name]
        if kind == "string":
            return F.when(c != "", c)
        if kind == "boolean":
            return F.when(c, c)
        if kind.startswith(("timestamp", "date")):
            return c
        return F.when(c != 0, c)

    return df.withColumns({name: rule(name) for name in cols})


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Values shown in place of NULL."""
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()
    })
