"""The passes of ``model_invariants`` over many rides: rows derived once and
spread over all cores, no ride multiplied by its features, no ids broadcast."""

import pytest

from cabmeter.operators import model as m
from cabmeter.plans.common import stored


def _plan(df, mode="simple") -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def test_stored_rows_are_the_same_and_spread(spark):
    rows = [(i % 300, None if i % 7 == 0 else f"t{i}") for i in range(1000)] + [(None, "x")] * 3
    df = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    kept = stored(df)
    assert kept.schema == df.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, df.collect()))
    assert len(kept.inputFiles()) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_terms_are_looked_up_without_multiplying_rows(spark):
    terms = spark.createDataFrame(
        [("cab_type", "u", 2.0), ("name", "p", 0.5), ("name", "q", -1.0), ("distance", None, 3.0), (None, None, 10.0)],
        "feature string, label string, weight double")
    df = spark.createDataFrame(
        [(1, "u", "p", 1.0), (2, "u", "new", 2.0), (3, None, "q", 0.0), (4, "u", "p", None), (5, "u", "p", float("nan")),
         (6, "distance", None, 1.0), (7, "u", "p", 1.0), (7, "u", "q", 2.0), (None, "u", "p", 1.0)],
        "ride_id long, cab_type string, name string, distance double")
    out = m.predict_by_terms(terms, df)
    # Repeated ids are summed, as they were: one row an id.
    assert {r.ride_id: r.prediction for r in out.collect()} == {
        1: 15.5, 2: 18.0, 3: 9.0, 6: 13.0, 7: 10.0 + 5.5 + 7.0, None: 15.5}
    plan = _plan(m.predict_by_terms(terms, df))
    assert "Generate" not in plan and "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2


def test_the_fit_over_vectors_kept_once_is_the_pipelines_fit(spark, sf_small):
    from cabmeter.plans.common import Rides
    from cabmeter.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES

    train, _ = m.split_train_test(Rides(spark, sf_small).featured)
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    ours = m.fit_fare_model(train)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached
    with m.fitted_fare_model(train) as (model, assembled):
        assert assembled.count() == train.count()
        assert m.elastic_net_violation(model, assembled) == pytest.approx(m.elastic_net_violation(model, train), abs=1e-6)
    whole = m.fare_model(CATEGORICAL_FEATURES, NUMERIC_FEATURES).fit(train)
    assert [type(s) for s in ours.stages] == [type(s) for s in whole.stages]
    assert ours.stages[0].labelsArray == whole.stages[0].labelsArray
    assert list(ours.stages[3].std) == pytest.approx(list(whole.stages[3].std), rel=1e-9)
    assert list(ours.stages[-1].coefficients) == pytest.approx(list(whole.stages[-1].coefficients), rel=1e-6, abs=1e-9)
    assert ours.stages[-1].intercept == pytest.approx(whole.stages[-1].intercept, rel=1e-9)


def test_invariants_read_stored_rides_and_broadcast_no_ids(spark, sf_small):
    import __spark_entry__ as E

    df = E.queries()["model_invariants"](spark, sf_small)
    plan = _plan(df, "extended").split("== Physical Plan ==")[1]
    # The source is derived once, not by every leg.
    assert "events.parquet" not in plan and "json_tuple" not in plan
    # Only the labels of the six categorical features are broadcast.
    assert plan.count("BroadcastHashJoin") == 6
    rows = {r.invariant: (r.holds, r.lost) for r in df.collect()}
    assert len(rows) == 5 and all(holds for holds, _ in rows.values())
    assert all(lost == 0 for name, (_, lost) in rows.items() if name != "rows_without_a_number_are_skipped")
