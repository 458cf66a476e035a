"""Price arithmetic. Divisions use ``try_divide`` so that a zero
surge or distance yields null instead of an ANSI error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cabmeter.functions.columns import as_column


def base_price(prediction: Column | str, surge: Column | str) -> Column:
    """price before surge."""
    return F.try_divide(as_column(prediction), as_column(surge))


def price_per_mile(prediction: Column | str, distance: Column | str) -> Column:
    """F13."""
    return F.try_divide(as_column(prediction), as_column(distance))


def linear_tariff(distance: Column | str, rate: Column | str, fee: Column | str) -> Column:
    """fee + distance x rate."""
    return as_column(fee) + as_column(distance) * as_column(rate)
