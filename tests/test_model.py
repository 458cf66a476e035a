import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabmeter.functions.hashing import hash_bucket
from cabmeter.operators import dashboard
from cabmeter.operators import model as m
from cabmeter.plans.common import Rides


@pytest.fixture(scope="module")
def feats(spark, sf_small):
    return Rides(spark, sf_small).featured.persist()


@pytest.fixture(scope="module")
def fitted(feats):
    train, test = m.split_train_test(feats)
    return m.fit_fare_model(train), train, test


def test_split_and_sample_are_layout_independent(feats):
    def ids(df):
        return sorted(r.ride_id for r in df.select("ride_id").collect())

    base_train = ids(m.split_train_test(feats)[0])
    base_sample = sorted(map(tuple, dashboard.distance_price_sample(feats).collect()))
    for n in (1, 4, 7):
        re = feats.repartition(n)
        assert ids(m.split_train_test(re)[0]) == base_train
        assert sorted(map(tuple, dashboard.distance_price_sample(re).collect())) == base_sample
    train, test = m.split_train_test(feats)
    assert train.count() + test.count() == feats.count()


def test_label_index_equals_string_indexer(fitted):
    model, train, _ = fitted
    indexer = model.stages[0]
    table = m.label_index(train).collect()
    for col, labels in zip(indexer.getInputCols(), indexer.labelsArray):
        mine = sorted((r.label_index, r.label) for r in table if r.feature == col)
        assert [l for _, l in mine] == list(labels)


def test_unseen_categories_score_finitely(spark, fitted):
    from cabmeter.sources.requests import requests_from_records
    from cabmeter.streaming.scoring import score_requests

    model, _, _ = fitted
    reqs = requests_from_records(spark, [dict(cab_type="Uber", name="UberX", source="MIT",
                                              destination="Harvard", distance=3.1, surge_multiplier=1.0,
                                              hour=14, day_of_week=4, month=5)])
    out = score_requests(model, reqs).collect()
    assert len(out) == 1 and math.isfinite(out[0].predicted_price)
    enc = model.transform(__import__("cabmeter.functions.features", fromlist=["x"]).add_ride_features(reqs))
    assert enc.first()["source_idx_vec"].numNonzeros() == 0


def test_model_round_trip(spark, fitted):
    from cabmeter.session import fresh_dir

    model, _, test = fitted
    path = fresh_dir(spark, "models")
    m.save_model(model, path)
    loaded = m.load_model(path)
    a = {r.ride_id: r.prediction for r in model.transform(test).select("ride_id", "prediction").collect()}
    b = {r.ride_id: r.prediction for r in loaded.transform(test).select("ride_id", "prediction").collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_ols_matches_numpy(feats):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    cols = ["distance", "surge_multiplier", "hour"]
    data = VectorAssembler(inputCols=cols, outputCol="features").transform(feats)
    lr = LinearRegression(featuresCol="features", labelCol="price", regParam=0.0).fit(data)
    pdf = feats.select(*cols, "price").toPandas()
    X = np.column_stack([np.ones(len(pdf))] + [pdf[c].to_numpy(float) for c in cols])
    beta, *_ = np.linalg.lstsq(X, pdf["price"].to_numpy(float), rcond=None)
    assert lr.intercept == pytest.approx(beta[0], rel=1e-6, abs=1e-6)
    assert list(lr.coefficients) == pytest.approx(list(beta[1:]), rel=1e-6, abs=1e-6)


def test_single_feature_closed_form(feats):
    train, _ = m.split_train_test(feats)
    got = m.fit_single_feature(train).first()
    pdf = train.select("distance", "price").toPandas()
    x, y = pdf["distance"].to_numpy(float), pdf["price"].to_numpy(float)
    sx, sy, r = x.std(), y.std(), np.corrcoef(x, y)[0, 1]
    lam, alpha = 0.1 / sy, 0.5
    beta = np.sign(r) * max(abs(r) - lam * alpha, 0) / (1 + lam * (1 - alpha))
    slope = beta * sy / sx
    assert got.slope == pytest.approx(slope, rel=1e-6)
    assert got.intercept == pytest.approx(y.mean() - slope * x.mean(), rel=1e-6)


def test_metrics_match_regression_evaluator(fitted):
    from pyspark.ml.evaluation import RegressionEvaluator

    model, _, test = fitted
    preds, metrics = m.evaluate(model, test)
    row = metrics.first()
    for name in ("rmse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol="price", predictionCol="prediction", metricName=name)
        assert row[name] == pytest.approx(ev.evaluate(preds), rel=1e-9)
    prev = m.prediction_preview(preds).collect()
    assert len(prev) == 10 and [r.ride_id for r in prev] == sorted(r.ride_id for r in prev)


def test_batch_equals_stream(spark, fitted):
    from cabmeter.session import fresh_dir
    from cabmeter.sources.kafka import message_file_stream, to_messages, write_message_files
    from cabmeter.sources.requests import requests_from_rides
    from cabmeter.streaming.decode import decode_requests, split_requests
    from cabmeter.streaming.scoring import run_to_table, score_requests

    model, _, test = fitted
    reqs = requests_from_rides(test)
    batch = {r.ride_id: r.predicted_price
             for r in score_requests(model, reqs, extra=("ride_id",)).collect()}
    base = fresh_dir(spark, "streams")
    write_message_files(to_messages(reqs, key_col="ride_id"), f"{base}/in")
    ok, _ = split_requests(decode_requests(message_file_stream(spark, f"{base}/in")))
    streamed = run_to_table(score_requests(model, ok, extra=("key",)), f"{base}/out", f"{base}/ck")
    stream = {int(r.key.decode()): r.predicted_price for r in streamed.collect()}
    assert stream.keys() == batch.keys()
    assert all(abs(stream[k] - batch[k]) < 1e-9 for k in batch)


def test_elastic_net_kkt_conditions(fitted):
    """Optimality of the fitted elastic net, checked in numpy in the space
    the solver works in: features and label standardised with population
    deviations, penalty lambda' = regParam / std(label)."""
    from cabmeter.schemas import LR_ELASTIC_NET_PARAM, LR_REG_PARAM

    model, train, _ = fitted
    lr = model.stages[-1]
    rows = model.transform(train).select("features", "price").collect()
    X = np.array([r.features.toArray() for r in rows])
    y = np.array([r.price for r in rows])
    sx, sy = X.std(axis=0), y.std()
    keep = sx > 0
    Xs = (X[:, keep] - X[:, keep].mean(axis=0)) / sx[keep]
    ys = (y - y.mean()) / sy
    w = np.asarray(lr.coefficients)[keep] * sx[keep] / sy
    lam = LR_REG_PARAM / sy
    l1, l2 = lam * LR_ELASTIC_NET_PARAM, lam * (1 - LR_ELASTIC_NET_PARAM)
    grad = Xs.T @ (ys - Xs @ w) / len(ys)
    tol = 1e-3 * max(l1, 1e-12) + 1e-6
    active = np.abs(w) > 1e-9
    assert np.all(np.abs(grad[active] - (l1 * np.sign(w[active]) + l2 * w[active])) < tol)
    assert np.all(np.abs(grad[~active]) <= l1 + tol)
    # the intercept makes the mean residual zero
    pred = np.array([r.prediction for r in model.transform(train).select("prediction").collect()])
    assert abs((y - pred).mean()) < 1e-6 * max(1.0, abs(y.mean()))
    assert active.sum() < len(w)  # the L1 part zeroes some coefficients
    # The distributed check agrees.
    from cabmeter.operators.model import elastic_net_violation

    assert elastic_net_violation(model, train) < 1e-3


def test_aggregates_are_layout_independent(feats):
    base = {r.hour: (r.ride_count, r.avg_price) for r in dashboard.hourly_stats(feats).collect()}
    for n in (1, 4, 7):
        got = {r.hour: (r.ride_count, r.avg_price) for r in dashboard.hourly_stats(feats.repartition(n)).collect()}
        assert got.keys() == base.keys()
        for h in base:
            assert got[h][0] == base[h][0] and abs(got[h][1] - base[h][1]) < 1e-9


def test_two_directory_model_layout(spark, fitted):
    """Preprocessing and regressor saved separately load back as one model."""
    from pyspark.ml import PipelineModel

    from cabmeter.session import fresh_dir

    model, _, test = fitted
    base = fresh_dir(spark, "models")
    m.save_model(PipelineModel(stages=model.stages[:-1]), f"{base}/preprocessing_pipeline")
    m.save_model(model.stages[-1], f"{base}/linear_regression_model")
    pair = m.load_model_pair(f"{base}/preprocessing_pipeline", f"{base}/linear_regression_model")
    a = {r.ride_id: r.prediction for r in model.transform(test).select("ride_id", "prediction").collect()}
    b = {r.ride_id: r.prediction for r in pair.transform(test).select("ride_id", "prediction").collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
