"""Loosely typed records, ranks over range partitions, and the fare model
recomputed from its terms."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cabmeter.operators import model as m
from cabmeter.operators.ranking import range_ranks
from cabmeter.schemas import REQUEST
from cabmeter.sources.requests import coerce_requests


def _float(text):
    """What a number in a record means, in plain Python."""
    try:
        value = float(text.strip(" \t\r\n")) if isinstance(text, str) else float(text)
    except ValueError:
        return None
    if isinstance(text, str) and ("_" in text or not math.isfinite(value)):
        return None
    return value


@pytest.mark.parametrize("text", [
    "7", " 7 ", "+7", "-7.9", "7.", ".5", "1e2", "1E+2", "1.5e-3", "", " ", "seven", "1_000", "0x10", "nan", "Infinity",
    "1.5d", "2f", "1e", "e1", "--1", "1 2", "3e9", "-2147483648", "2147483648", None])
def test_text_numbers(spark, text):
    df = spark.createDataFrame([(text, text)], "distance string, hour string")
    got = coerce_requests(df).first()
    want = None if text is None else _float(text)
    assert got.distance == want
    whole = None if want is None or abs(want) >= 2 ** 31 else int(want)
    assert got.hour == whole
    bad = [n for n, v in (("distance", want), ("hour", whole)) if text is not None and v is None]
    assert got.bad_fields == (",".join(bad) or None)


def test_other_types_missing_and_extra_columns(spark):
    df = spark.createDataFrame(
        [(1, 7, 2.9, True, [1], "x"), (2, None, float("nan"), None, None, "y")],
        "id long, name long, hour double, month boolean, distance array<int>, bad_fields string")
    rows = {r.id: r for r in coerce_requests(df, keep=["id"]).collect()}
    assert list(rows[1].asDict()) == ["id", *REQUEST.fieldNames(), "bad_fields"]
    a, b = rows[1], rows[2]
    assert (a.name, a.hour, a.month, a.distance, a.cab_type, a.bad_fields) == ("7", 2, 1, None, None, "distance")
    assert (b.name, b.hour, b.month, b.distance, b.bad_fields) == (None, None, None, None, "hour")
    assert coerce_requests(df.limit(0)).count() == 0


def test_records_plan_is_one_projection(spark, capsys):
    df = spark.range(10).selectExpr("cast(id as string) AS distance", "id AS hour")
    coerce_requests(df).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan


def test_records_query_covers_every_ride(spark, sf_small):
    import __spark_entry__ as E

    assert E.queries()["requests_from_records"](spark, sf_small).count() == 1000


def test_range_ranks_match_sorting(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(40)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(6)
    got = {(r.g, r.v, r.i): r["rank"] for r in range_ranks(df, "g", ["v", "i"]).collect()}
    for g in ("a", "b", None):
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [got[r] for r in order] == list(range(len(order)))
    assert range_ranks(df.limit(0), "g", ["v"]).count() == 0


def test_a_large_vocabulary_is_ranked_by_many_tasks(spark):
    """One feature with 20,000 labels: the indexer's order, and no task sorts
    or ranks more than a share of it."""
    df = spark.range(20_000).selectExpr("concat('l', id % 19000) AS name")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = m.label_index(df, ["name"])
        rows = ranked.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    order = sorted(rows, key=lambda r: (-r.label_count, r.label))
    assert [r.label_index for r in order] == list(range(19_000))
    # The written ranks: the Parquet files are what the tasks sorted.
    files = [f for f in ranked.inputFiles() if "/ranks/" in f]
    sizes = [spark.read.parquet(f).count() for f in files]
    assert sum(sizes) == 19_000 and len(sizes) >= 6 and max(sizes) < 19_000 / 3


def test_terms_give_the_models_predictions(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["u", "v", "w"]), rng.choice(["p", "q"]), rng.random() * 9, 1 + rng.randrange(4) / 4, 3)
            for i in range(400)]
    ddl = "ride_id long, cab_type string, name string, distance double, surge_multiplier double, month int"
    df = spark.createDataFrame(rows, ddl).withColumn(
        "price", F.col("distance") * 2 + F.when(F.col("cab_type") == "u", 5.0).otherwise(1.0))
    model = m.fit_fare_model(df)
    numeric = ["distance", "surge_multiplier", "month"]
    new = df.unionByName(spark.createDataFrame(
        [(901, "new", "p", 1.0, 1.0, 3, 0.0), (902, None, None, 2.0, 1.5, 4, 0.0), (903, "u", "p", None, 1.0, 3, 0.0),
         (904, "u", "q", float("nan"), 1.0, 3, 0.0)], ddl + ", price double"))
    want = {r.ride_id: r.prediction for r in model.transform(new).collect()}
    terms = m.model_terms(model, numeric)
    got = {r.ride_id: r.prediction for r in m.predict_by_terms(terms, new).collect()}
    assert set(got) == set(want) == {*range(400), 901, 902}
    assert max(abs(got[i] - want[i]) for i in want) < 1e-9
    # A constant feature is scaled to 0.
    assert {r.feature: r.weight for r in terms.collect()}["month"] == 0.0
