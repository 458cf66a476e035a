"""Fare model (M1-M12, A9, A14, A15, R2, S9, S10) on MLlib.

The preprocessing is one multi-column ``StringIndexer`` (frequency order,
unseen -> extra index), one multi-column ``OneHotEncoder`` (last slot
dropped, so an unseen value is an all-zero block), a ``VectorAssembler`` that
skips rows with null/NaN inputs and a ``StandardScaler`` without centring;
the regressor is an elastic-net ``LinearRegression``. Fitting is distributed
by MLlib (per-partition counts and moments merged by tree aggregation); only
the vocabularies and coefficients reach the driver.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmeter.functions.hashing import hash_bucket, row_key
from cabmeter.functions.pricing import base_price, price_per_mile
from cabmeter.operators.ranking import range_ranks
from cabmeter.schemas import (
    CATEGORICAL_FEATURES, LR_ELASTIC_NET_PARAM, LR_MAX_ITER, LR_REG_PARAM,
    NUMERIC_FEATURES, SPLIT_SEED, TRAIN_PERCENT,
)

LABEL = "price"


# -- R2 -------------------------------------------------------------------------

def train_mask(id_col: str | Column = "ride_id", percent: int = TRAIN_PERCENT,
               seed: int = SPLIT_SEED) -> Column:
    return hash_bucket(id_col, seed) < F.lit(percent)


def split_train_test(df: DataFrame, id_col: str | None = "ride_id", percent: int = TRAIN_PERCENT,
                     seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """R2: a hash split by row id; unlike ``randomSplit`` it gives the same
    rows whatever the partitioning, and needs no shuffle."""
    m = train_mask(row_key(df, id_col), percent, seed)
    return df.filter(m), df.filter(~m)


# -- M1-M5 ----------------------------------------------------------------------

def available_features(df: DataFrame, categorical=CATEGORICAL_FEATURES,
                       numeric=NUMERIC_FEATURES) -> tuple[list[str], list[str]]:
    """Keep only the feature columns present in ``df``."""
    cols = set(df.columns)
    return [c for c in categorical if c in cols], [c for c in numeric if c in cols]


def preprocessing_stages(categorical: list[str], numeric: list[str]) -> list:
    """M1-M4: indexer and encoder (multi-column), assembler, scaler."""
    idx = [f"{c}_idx" for c in categorical]
    vec = [f"{c}_idx_vec" for c in categorical]
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="keep",
                                    stringOrderType="frequencyDesc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=vec, dropLast=True))
    stages.append(VectorAssembler(inputCols=vec + numeric, outputCol="features_raw", handleInvalid="skip"))
    stages.append(StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=False))
    return stages


def preprocessing(categorical: list[str], numeric: list[str]) -> Pipeline:
    """M5: the preprocessing stages as one pipeline."""
    return Pipeline(stages=preprocessing_stages(categorical, numeric))


def regressor() -> LinearRegression:
    """M8: elastic-net linear regression of the price."""
    return LinearRegression(featuresCol="features", labelCol=LABEL, maxIter=LR_MAX_ITER,
                            regParam=LR_REG_PARAM, elasticNetParam=LR_ELASTIC_NET_PARAM)


def fare_model(categorical: list[str], numeric: list[str]) -> Pipeline:
    """Preprocessing and regressor as one pipeline, so one saved model holds
    both (S9/S10)."""
    return Pipeline(stages=preprocessing_stages(categorical, numeric) + [regressor()])


@contextmanager
def fitting_input(train: DataFrame, categorical: list[str], numeric: list[str]):
    """The training rows, projected to the columns the fit reads and
    persisted (memory, spilling to disk) for the fit's passes: indexer
    counts, scaler moments and the regressor's statistics. The cache is
    released when the eager fit returns; lost blocks are recomputed from
    lineage, so an executor loss costs time, not results."""
    cols = [c for c in [*categorical, *numeric, LABEL] if c in train.columns]
    data = train.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield data
    finally:
        data.unpersist()


@contextmanager
def fitted_fare_model(train: DataFrame, categorical: list[str] = CATEGORICAL_FEATURES,
                      numeric: list[str] = NUMERIC_FEATURES):
    """M6 + M8: fit preprocessing and regressor on the training split only,
    on those of the given features that it has; the model and the assembled
    training rows (``features_raw`` and label), persisted until the block ends
    for checks on the rows of the fit. The indexer's vocabularies reach the
    driver, as MLlib's always do: they are meant for columns with up to some
    100,000 labels. Up to 4,096 assembled features the regressor needs one
    distributed pass (normal equations); beyond, MLlib iterates.

    Encoding and assembling cost more than the passes after them (scaler's
    moments, regressor's statistics and summary), so it is done once for all."""
    cats, nums = available_features(train, categorical, numeric)
    *to_vector, scaler = preprocessing_stages(cats, nums)
    assembled = None
    try:
        with fitting_input(train, cats, nums) as data:
            vectors = Pipeline(stages=to_vector).fit(data)
            assembled = vectors.transform(data).select("features_raw", LABEL).persist(StorageLevel.MEMORY_AND_DISK)
            fitted = Pipeline(stages=[scaler, regressor()]).fit(assembled)
        yield PipelineModel(stages=[*vectors.stages, *fitted.stages]), assembled
    finally:
        if assembled is not None:
            assembled.unpersist()


def fit_fare_model(train: DataFrame, categorical: list[str] = CATEGORICAL_FEATURES,
                   numeric: list[str] = NUMERIC_FEATURES) -> PipelineModel:
    """The model of ``fitted_fare_model``; nothing stays persisted."""
    with fitted_fare_model(train, categorical, numeric) as (model, _):
        return model


# -- M9, M10, A9 ----------------------------------------------------------------

def regression_metrics(predictions: DataFrame, label: str = LABEL,
                       prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE and R^2 (about the label's mean) in one aggregate."""
    err = F.col(prediction) - F.col(label)
    out = predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop(label) * F.count(F.lit(1))).alias("_sst"),
    )
    return out.select("n", "rmse", "mae",
                      (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M7 + M9: rows whose numeric features are null or NaN are skipped by
    the assembler."""
    return model.transform(df)


def evaluate(model: PipelineModel, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Predictions on the test split and their metrics."""
    preds = score(model, test)
    return preds, regression_metrics(preds)


def quote_prices(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """M12 + F12 + F13: score a request table of any size; base price is the
    prediction without surge, and price per mile divides by the distance."""
    preds = score(model, requests)
    return preds.withColumns(
        {
            "predicted_price": F.col("prediction"),
            "base_price": base_price("prediction", "surge_multiplier"),
            "price_per_mile": price_per_mile("prediction", "distance"),
        }
    )


def prediction_preview(predictions: DataFrame, n: int = 10, id_col: str = "ride_id") -> DataFrame:
    """T5: the first ``n`` (price, prediction) pairs by id; a bounded top-k."""
    return predictions.orderBy(id_col).limit(n).select(id_col, LABEL, "prediction")


# -- S9, S10 --------------------------------------------------------------------

def save_model(model: PipelineModel, path: str) -> None:
    """Overwrite ``path`` (a folder every executor can reach)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """The combined preprocessing + regressor pipeline."""
    return PipelineModel.load(path)


def load_model_pair(preprocessing_path: str, regressor_path: str) -> PipelineModel:
    """S10 for the two-directory layout: a saved preprocessing
    ``PipelineModel`` and a saved ``LinearRegressionModel``, combined into
    one model that scores in a single ``transform``."""
    from pyspark.ml.regression import LinearRegressionModel

    prep = PipelineModel.load(preprocessing_path)
    return PipelineModel(stages=[*prep.stages, LinearRegressionModel.load(regressor_path)])


# -- A14 / M1 fit side ------------------------------------------------------------

def label_index(df: DataFrame, categorical: list[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Per categorical feature, each label's frequency and the index the
    string indexer gives it (descending count, ties by label). Labels are
    counted with partial aggregates and ranked over range partitions, so no
    task holds a whole vocabulary."""
    cats = [c for c in categorical if c in df.columns]
    long = df.select(*cats).unpivot([], cats, "feature", "label").filter(F.col("label").isNotNull())
    counts = long.groupBy("feature", "label").agg(F.count(F.lit(1)).alias("label_count"))
    ranked = range_ranks(counts.withColumn("__down", -F.col("label_count")), "feature", ["__down", "label"], "label_index")
    return ranked.select("feature", "label", "label_count", F.col("label_index").cast("int"))


def onehot_slot_counts(model: PipelineModel, df: DataFrame,
                       categorical: list[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """M2 check: rows per one-hot slot and the block size, from the encoder's
    real output: the non-zero entries of every sparse block are counted in
    one tree-aggregated pass. An unseen label has no slot."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    cats = [c for c in categorical if c in df.columns]
    counts = model.transform(df).agg(*[
        vector_to_array(Summarizer.numNonZeros(F.col(f"{c}_idx_vec"))).alias(c) for c in cats])
    blocks = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("n")) for c in cats])).alias("b"))
    slots = blocks.select(F.col("b.feature").alias("feature"), F.size("b.n").alias("block_size"),
                          F.posexplode("b.n").alias("slot", "row_count"))
    return slots.where("row_count > 0").select(
        "feature", F.col("slot").cast("int"), F.col("block_size").cast("int"), F.col("row_count").cast("bigint"))


def feature_slots(model: PipelineModel, numeric: list[str]) -> list[tuple[int, str, str | None]]:
    """(position, feature, label) of every entry of the assembled vector:
    one slot per label of each one-hot block (the indexer's vocabulary, which
    the fitted model holds), then the numeric features."""
    names: list[tuple[str, str | None]] = []
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            for feature, labels in zip(stage.getInputCols(), stage.labelsArray):
                names += [(feature, label) for label in labels]
    names += [(name, None) for name in numeric]
    return [(pos, feature, label) for pos, (feature, label) in enumerate(names)]


def feature_std(model: PipelineModel, df: DataFrame,
                numeric: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Of every assembled feature the sample standard deviation that
    the fitted scaler holds and divides by, and that of the scaled feature (1,
    or 0 for a constant one), from one distributed Summarizer pass. One-hot
    slots are named by (feature, label); numeric features have a null label."""
    from pyspark.ml.feature import StandardScalerModel
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    # As long as the vocabulary, which the model holds on the driver anyway.
    slots = [(pos, feature, label, float(sd))
             for (pos, feature, label), sd in zip(feature_slots(model, numeric), scaler.std)]
    names = df.sparkSession.createDataFrame(slots, "pos int, feature string, label string, raw_std double")
    scaled = model.transform(df).select(vector_to_array(Summarizer.std(F.col("features"))).alias("s")).select(
        F.posexplode("s").alias("pos", "scaled_std"))
    return scaled.join(names, "pos").select("feature", "label", "raw_std", "scaled_std")


def model_terms(model: PipelineModel, numeric: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """The fitted model as a table (feature, label, weight): what one unit of
    a numeric feature (label null), or a row having that label of a
    categorical one, adds to the prediction; and the intercept (feature
    null). A feature without spread adds nothing, as the scaler makes it 0."""
    from pyspark.ml.feature import StandardScalerModel

    scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    lr = model.stages[-1]
    rows = [(feature, label, float(lr.coefficients[pos]) / float(scaler.std[pos]) if scaler.std[pos] else 0.0)
            for pos, feature, label in feature_slots(model, numeric)]
    # As long as the vocabulary, which the model holds on the driver anyway.
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([*rows, (None, None, float(lr.intercept))],
                                 "feature string, label string, weight double")


def predict_by_terms(terms: DataFrame, df: DataFrame, id_col: str = "ride_id",
                     categorical: list[str] = CATEGORICAL_FEATURES,
                     numeric: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """(id_col, prediction) of every row whose numeric features are neither
    null nor NaN, without MLlib: each categorical feature looks its weight up
    in its own labels, a numeric one is multiplied by its weight, and the row
    adds them up. A label that the fit has not seen, or a null one, adds
    nothing. Ids must be unique.

    The labels are broadcast, as long as the vocabulary that the model holds
    on the driver anyway; rows are never multiplied by their features and are
    dealt once, as (id_col, sum)."""
    cats, nums = available_features(df, categorical, numeric)
    # One small task: no shuffle of its own for each look-up.
    weights = terms.coalesce(1).groupBy("feature", "label").agg(F.sum("weight").alias("weight"))
    slopes = {w.feature: w.weight for w in weights.where(
        F.col("feature").isin(nums) & F.col("label").isNull()).collect()}
    whole, total = F.lit(True), F.lit(0.0)
    for c in nums:
        value = F.col(c).cast("double")
        whole = whole & F.col(c).isNotNull() & ~F.isnan(value)
        if slopes.get(c) is not None:
            total = total + value * F.lit(slopes[c])
    rows = df.where(whole).select(
        id_col, total.alias("__total"), *[F.col(c).cast("string").alias(f"__{i}") for i, c in enumerate(cats)])
    for i, c in enumerate(cats):
        labels = weights.where((F.col("feature") == c) & F.col("label").isNotNull()).select(
            F.col("label").alias(f"__{i}"), F.col("weight").alias(f"__w{i}"))
        rows = rows.join(F.broadcast(labels), f"__{i}", "left")
    total = F.col("__total")
    for i in range(len(cats)):
        total = total + F.coalesce(F.col(f"__w{i}"), F.lit(0.0))
    sums = rows.select(id_col, total.alias("total")).groupBy(id_col).agg(F.sum("total").alias("total"))
    intercept = terms.where("feature IS NULL").agg(F.first("weight")).first()[0]
    return sums.select(id_col, (F.col("total") + F.lit(intercept)).alias("prediction"))


def fit_single_feature(train: DataFrame, feature: str = "distance") -> DataFrame:
    """M8 on one raw feature: (n, intercept, slope). MLlib standardises
    internally, so this has a closed form, used by the SQL check. Only the two
    fitted coefficients and the row count come back through the driver."""
    assembler = VectorAssembler(inputCols=[feature], outputCol="features", handleInvalid="skip")
    with fitting_input(train, [], [feature]) as data:
        rows = assembler.transform(data)
        model = regressor().fit(rows)
        n = rows.count()
    return train.sparkSession.createDataFrame(
        [(n, float(model.intercept), float(model.coefficients[0]))], "n long, intercept double, slope double")


def elastic_net_violation(model: PipelineModel, train: DataFrame) -> float:
    """How far the fitted coefficients are from the elastic net's optimality
    conditions on the rows they were fitted on, relative to the L1 penalty: 0
    is optimal. ``train`` has the features or, as ``fitted_fare_model`` gives
    it, the assembled vectors. The gradient comes from one distributed
    Summarizer pass over the residuals' positive and negative parts; only
    vectors as long as the coefficients reach the driver."""
    import numpy as np
    from pyspark.ml.stat import Summarizer

    lr = model.stages[-1]
    r = F.col(LABEL) - F.col("prediction")
    stages = model.stages[-2:] if "features_raw" in train.columns else model.stages
    scored = PipelineModel(stages=stages).transform(train).select(
        "features", LABEL, F.greatest(r, F.lit(0.0)).alias("up"), F.greatest(-r, F.lit(0.0)).alias("down"))
    s = scored.agg(
        F.count(F.lit(1)).alias("n"), F.stddev_pop(LABEL).alias("sy"),
        F.sum("up").alias("su"), F.sum("down").alias("sd"),
        Summarizer.metrics("mean", "std").summary(F.col("features")).alias("moments"),
        Summarizer.mean(F.col("features"), F.col("up")).alias("up"),
        Summarizer.mean(F.col("features"), F.col("down")).alias("down")).first()
    mean, up, down = (v.toArray() for v in (s["moments"]["mean"], s["up"], s["down"]))
    sx = s["moments"]["std"].toArray() * np.sqrt((s["n"] - 1) / s["n"])
    keep = sx > 0
    # In the space the solver works in: features and label standardised.
    grad = ((up * s["su"] - down * s["sd"] - mean * (s["su"] - s["sd"]))[keep] / (s["n"] * sx[keep] * s["sy"]))
    w = lr.coefficients.toArray()[keep] * sx[keep] / s["sy"]
    penalty = LR_REG_PARAM / s["sy"]
    l1, l2 = penalty * LR_ELASTIC_NET_PARAM, penalty * (1 - LR_ELASTIC_NET_PARAM)
    active = np.abs(w) > 1e-9
    off = np.where(active, np.abs(grad - l1 * np.sign(w) - l2 * w), np.maximum(np.abs(grad) - l1, 0))
    return float(off.max(initial=0) / l1)
