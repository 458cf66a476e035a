"""Suggested surge multiplier from (hour, day_of_week), as one SQL
expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabmeter.functions.columns import ident, sql_literal

# Fixed values of the surge rules.
SURGE_BY_HOUR = [  # (first hour, last hour, base multiplier), first match wins
    (7, 9, 1.75),
    (17, 19, 2.0),
    (0, 4, 1.5),
    (10, 16, 1.0),
]
SURGE_OTHER_HOURS = 1.25
SURGE_WEEKEND_DAYS = (1, 6, 7)  # Sunday, Friday, Saturday
SURGE_WEEKEND_NIGHT = (22, 3, 1.4, 3.0)  # hour >= 22 or hour <= 3: x1.4, capped at 3.0
SURGE_WEEKEND_BRUNCH = (10, 14, 1.2, 2.5)  # hours 10-14: x1.2, capped at 2.5
SURGE_STEP = 0.25
SURGE_MIN, SURGE_MAX = 1.0, 3.0


def clamp_sql(x: str, low: float, high: float) -> str:
    """F8."""
    return f"greatest({sql_literal(low)}, least({sql_literal(high)}, {x}))"


def round_to_step_sql(x: str, step: float) -> str:
    """nearest multiple of ``step``, ties to even (as Python's round)."""
    return f"bround(({x}) / {sql_literal(step)}, 0) * {sql_literal(step)}"


def suggested_surge(hour: str, day: str) -> Column:
    """base by hour, weekend adjustment, round to 0.25, clamp to [1, 3]."""
    h, d = ident(hour), ident(day)
    base = "CASE " + " ".join(
        f"WHEN {h} BETWEEN {first} AND {last} THEN {sql_literal(mult)}"
        for first, last, mult in SURGE_BY_HOUR
    ) + f" ELSE {sql_literal(SURGE_OTHER_HOURS)} END"
    weekend = f"{d} IN ({', '.join(str(x) for x in SURGE_WEEKEND_DAYS)})"
    night_from, night_to, night_mult, night_cap = SURGE_WEEKEND_NIGHT
    brunch_from, brunch_to, brunch_mult, brunch_cap = SURGE_WEEKEND_BRUNCH
    adjusted = (
        f"CASE WHEN {weekend} AND ({h} >= {night_from} OR {h} <= {night_to})"
        f" THEN least(({base}) * {sql_literal(night_mult)}, {sql_literal(night_cap)})"
        f" WHEN {weekend} AND {h} BETWEEN {brunch_from} AND {brunch_to}"
        f" THEN least(({base}) * {sql_literal(brunch_mult)}, {sql_literal(brunch_cap)})"
        f" ELSE {base} END"
    )
    return F.expr(clamp_sql(round_to_step_sql(adjusted, SURGE_STEP), SURGE_MIN, SURGE_MAX))


def fill_suggested_surge(requests: DataFrame, surge: str = "surge_multiplier",
                         hour: str = "hour", day: str = "day_of_week") -> DataFrame:
    """Requests whose surge is not given get the suggested one; a given one
    stays. Without an hour or day the base for other hours is suggested."""
    return requests.withColumn(surge, F.coalesce(F.col(surge), suggested_surge(hour, day)))
