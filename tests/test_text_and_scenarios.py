import pytest
from pyspark.sql import functions as F

from cabmeter.functions import text
from cabmeter.operators.scenarios import scenario_display, scenario_prices
from cabmeter.schemas import SCENARIOS


def test_text_formats(spark):
    df = spark.createDataFrame([(12.3, 0.0, 0.8, 17, 9705, 1.71)],
                               "p double, s double, m double, h int, n long, d double")
    r = df.select(text.currency("p").alias("a"), text.savings_text("s").alias("b"),
                  text.multiplier_text("m").alias("c"), text.hour_text("h").alias("e"),
                  text.thousands("n").alias("f"), text.miles_text("d").alias("g"),
                  text.savings_text("p").alias("k")).collect()[0]
    assert (r.a, r.b, r.c, r.e, r.f, r.g, r.k) == ("$12.30", "-", "0.8x", "17:00", "9,705",
                                                   "1.71 miles", "$12.30")


def test_key_normalisation(spark):
    df = spark.createDataFrame([("  Back Bay ",)], "s string")
    assert df.select(text.normalize_key("s")).first()[0] == "back bay"


def test_default_tariff_scenarios(spark):
    tariffs = spark.createDataFrame([(1, 10.0, 2.5, 5.0)],
                                    "tariff_id long, distance double, base_rate double, base_fee double")
    rows = scenario_display(scenario_prices(tariffs)).orderBy("price_rank").collect()
    assert len(rows) == len(SCENARIOS) == 8
    assert rows[0].base_price == pytest.approx(30.0)
    assert rows[-1].estimated_price == pytest.approx(60.0) and rows[-1].multiplier == 2.0
    assert rows[0].estimated_price == pytest.approx(24.0) and rows[0].multiplier == 0.8
    assert rows[0].savings == pytest.approx(36.0)
    assert rows[-1].savings == 0.0 and rows[-1].savings_text == "-"
    assert rows[0].estimated_price_text == "$24.00" and rows[0].savings_text == "$36.00"
    assert rows[0].multiplier_text == "0.8x"
    prices = [r.estimated_price for r in rows]
    assert prices == sorted(prices)
    assert [r.price_rank for r in rows] == list(range(1, 9))


def test_scenarios_plan_has_no_shuffle(spark, capsys):
    tariffs = spark.range(100).select(F.col("id").alias("tariff_id"), F.lit(3.0).alias("distance"),
                                      F.lit(2.5).alias("base_rate"), F.lit(5.0).alias("base_fee"))
    capsys.readouterr()
    scenario_prices(tariffs).explain()
    plan = capsys.readouterr().out
    assert "Generate" in plan and "Exchange" not in plan


def test_currency_rounds_the_binary_value(spark):
    """As Python prints it: half cents, tiny and large values, both signs."""
    import random

    from cabmeter.functions.text import currency, miles_text

    rng = random.Random(6)
    values = [2.675, 1.005, 0.125, 0.375, -2.675, 0.0, -0.0, -0.004, 0.005, 1e-300, 123456789.125, 9.995, 99.995]
    values += [rng.randint(0, 200_000) / 1000 for _ in range(2000)]
    values += [rng.uniform(-1e6, 1e6) for _ in range(500)] + [rng.uniform(0, 1e12) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", currency("v").alias("c"), miles_text("v").alias("m")).collect()
    assert [r.c for r in got] == [f"${r.v:.2f}" for r in got]
    assert [r.m for r in got] == [f"{r.v:.2f} miles" for r in got]
    assert spark.createDataFrame([(None,)], "v double").select(currency("v")).first()[0] is None
