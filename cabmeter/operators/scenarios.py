"""Fare scenarios (J2, F14, W1, T3): every tariff priced under every
scenario, with its savings against the tariff's peak and its rank.

The scenario table is a fixed literal, so the expansion is a generator over a
literal array (one input row -> one output row per scenario) inside the same
stage: no join, no shuffle. The per-tariff peak (W1) and the price order (T3)
are computed on that same array before it is exploded, so no window shuffle
over the expanded rows is needed either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmeter.functions.pricing import linear_tariff
from cabmeter.functions.text import currency, multiplier_text, savings_text
from cabmeter.schemas import DEFAULT_BASE_FEE, DEFAULT_BASE_RATE, SCENARIOS


def scenario_prices(tariffs: DataFrame, scenarios: list[tuple[str, float]] = SCENARIOS,
                    id_col: str = "tariff_id") -> DataFrame:
    """``tariffs`` has ``id_col``, ``distance``, ``base_rate``, ``base_fee``.
    Output: one row per tariff and scenario with ``base_price`` (F14),
    ``estimated_price``, ``savings`` (peak price of the tariff minus this
    price, W1) and ``price_rank`` (1 = cheapest; ties by scenario name, T3)."""
    base = tariffs.withColumn(
        "base_price", linear_tariff("distance", "base_rate", "base_fee")
    )
    def options(chosen):
        return F.array(
            *[
                F.struct(
                    (F.col("base_price") * F.lit(mult)).alias("estimated_price"),
                    F.lit(name).alias("scenario"),
                    F.lit(mult).alias("multiplier"),
                )
                for name, mult in chosen
            ]
        )

    # Structs compare field by field: price first, then scenario name. For an
    # ordinary positive base price that is the order of the multipliers, so
    # only other tariffs are sorted; the last price is the peak.
    given = sorted(scenarios, key=lambda s: (s[1], s[0]))
    ordinary = (F.col("base_price") > 1e-100) & (F.col("base_price") < 1e100)
    ranked = base.withColumn(
        "_opts", F.when(ordinary, options(given)).otherwise(F.array_sort(options(scenarios))))
    ranked = ranked.withColumn("_peak", F.element_at("_opts", -1)["estimated_price"])
    out = ranked.select(
        "*", F.posexplode("_opts").alias("_pos", "_opt")
    )
    return out.select(
        id_col, "distance", "base_rate", "base_fee", "base_price",
        F.col("_opt.scenario").alias("scenario"),
        F.col("_opt.multiplier").alias("multiplier"),
        F.col("_opt.estimated_price").alias("estimated_price"),
        (F.col("_peak") - F.col("_opt.estimated_price")).alias("savings"),
        (F.col("_pos") + 1).cast("int").alias("price_rank"),
    )


def tariffs_from_rides(rides: DataFrame, base_rate: float = DEFAULT_BASE_RATE,
                       base_fee: float = DEFAULT_BASE_FEE) -> DataFrame:
    """One tariff per ride: its distance with the default rate and fee."""
    return rides.select(
        F.col("ride_id").alias("tariff_id"), "distance",
        F.lit(base_rate).alias("base_rate"), F.lit(base_fee).alias("base_fee"),
    )


def scenario_display(prices: DataFrame) -> DataFrame:
    """F15/F16 text columns for the scenario table."""
    return prices.withColumns(
        {
            "multiplier_text": multiplier_text("multiplier"),
            "estimated_price_text": currency("estimated_price"),
            "savings_text": savings_text("savings"),
        }
    )
