"""Epoch milliseconds to calendar fields, always in UTC.

The timestamp is built as ``TIMESTAMP_NTZ`` arithmetic, so hour, weekday and
month do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cabmeter.functions.columns import ident, sql_literal
from cabmeter.schemas import DAY_NAMES

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def timestamp_from_millis(ms: str) -> Column:
    """epoch milliseconds -> UTC wall-clock timestamp (timestamp_ntz)."""
    return F.expr(f"timestampadd(MILLISECOND, {ident(ms)}, {_EPOCH_NTZ})")


def millis_from_wall_clock(ts: str) -> Column:
    """Inverse of F1: a UTC wall-clock ``TIMESTAMP_NTZ`` -> epoch
    milliseconds (microseconds truncated). Pure field arithmetic (days since
    the epoch, then the time of day), so no session time zone is involved,
    not even for wall-clock times that fall in a daylight-saving gap."""
    t = ident(ts)
    return F.expr(
        f"CAST(unix_date(to_date({t})) AS BIGINT) * 86400000"
        f" + CAST(hour({t}) AS BIGINT) * 3600000"
        f" + CAST(minute({t}) AS BIGINT) * 60000"
        f" + CAST(floor(date_part('SECOND', {t}) * 1000) AS BIGINT)"
    )


def hour_of_day(ts: str) -> Column:
    """0-23."""
    return F.expr(f"hour({ident(ts)})")


def day_of_week(ts: str) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.expr(f"dayofweek({ident(ts)})")


def month_of_year(ts: str) -> Column:
    """1-12."""
    return F.expr(f"month({ident(ts)})")


def day_name(day: str) -> Column:
    """day number (1 = Sunday) -> short name; other values give null."""
    whens = " ".join(f"WHEN {n} THEN {sql_literal(name)}" for n, name in DAY_NAMES.items())
    return F.expr(f"CASE CAST({ident(day)} AS INT) {whens} END")
