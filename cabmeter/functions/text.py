"""Key normalisation and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cabmeter.functions.columns import as_column, ident


def normalize_key(c: str) -> Column:
    """trim + lower-case, for route keys on both sides of a look-up."""
    return F.expr(f"lower(trim({ident(c)}))")


def _whole_cents(x: Column) -> Column:
    """A double to print with two decimals: rounded by its exact binary value
    (2.675 is below its name and gives 2.67; an exact tie goes to the even
    cent), as C and Python print it; ``format_string`` alone rounds the
    shortest decimal text. x * 100 is taken apart by Dekker's splitting, so
    that what the product rounds away decides; each part is used once, to
    keep the generated code small."""
    a = F.abs(x)
    high = a * 134217729.0 - (a * 134217729.0 - a)
    n = F.floor(a * 100.0)
    rest = (high * 100.0 - (n + F.lit(0.5))) + (a - high) * 100.0
    # n, n + 1/2 or n + 1; rint takes a half to the even neighbour.
    cents = F.rint(n + (F.signum(rest) + 1.0) * 0.5)
    return F.when((x == 0) | (a >= 1e13), x).otherwise(F.signum(x) * cents / 100.0)


def currency(x: Column | str) -> Column:
    """``$12.34``."""
    v = as_column(x).cast("double")
    return F.when(v.isNotNull(), F.format_string("$%.2f", _whole_cents(v)))


def savings_text(x: Column | str) -> Column:
    """currency when positive, ``-`` otherwise."""
    return F.when(as_column(x) > 0, currency(x)).otherwise(F.lit("-"))


def multiplier_text(x: Column | str) -> Column:
    """F16: ``0.8x`` (the double's shortest text, as Python prints it)."""
    return F.concat(as_column(x).cast("string"), F.lit("x"))


def hour_text(h: Column | str) -> Column:
    """F16: ``17:00``."""
    return F.concat(as_column(h).cast("string"), F.lit(":00"))


def miles_text(x: Column | str) -> Column:
    """F16: ``1.71 miles``."""
    v = as_column(x).cast("double")
    return F.when(v.isNotNull(), F.format_string("%.2f miles", _whole_cents(v)))


def thousands(x: Column | str) -> Column:
    """F16: integer with thousands separators, ``9,705``."""
    return F.format_number(as_column(x), 0)
