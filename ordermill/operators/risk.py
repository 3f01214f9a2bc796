"""Delivery risk: a logistic regression for late delivery, trained and applied with Spark ML.

The fitted model is one ``PipelineModel``: a projection that imputes and scales, a vector assembler
and the regression. It is saved, loaded and applied to any DataFrame with the feature columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Matrices, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.columns import share
from ordermill.operators.quantiles import exact_quantiles
from ordermill.operators.ranks import sums_before
from ordermill.session import cut_lineage
from ordermill.sources.files import write_json

# The features, the target and the operating threshold of the published model.
FEATURES = [
    "order_item_count",
    "order_total_price",
    "order_total_freight",
    "purchase_hour",
    "purchase_day_of_week",
    "estimated_delivery_duration_days",
]
TARGET = "is_late"
THRESHOLD = 0.07
MAX_ITERATIONS = 2000
RANDOM_STATE = 42
# L-BFGS ends at about the seventh digit of the weights; each Newton step from there doubles the digits.
NEWTON_STEPS = 6

ORDER_TIME = "order_purchase_timestamp"


# --- training set ---------------------------------------------------------------------------------


def training_candidates(features: DataFrame, orders: DataFrame) -> DataFrame:
    """Feature rows with their purchase time; the left join keeps orders that have none."""
    times = orders.select("order_id", ORDER_TIME)
    return features.join(times, "order_id", "left").select("order_id", *FEATURES, TARGET, ORDER_TIME)


def training_set(features: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders with a known outcome and a purchase time. The time is for audit and splits only."""
    labelled = training_candidates(features, orders).na.drop(subset=[TARGET, ORDER_TIME])
    return labelled.withColumn(TARGET, F.col(TARGET).cast("int"))


def training_summary(candidates: DataFrame) -> DataFrame:
    """One row: rows kept and removed, class counts and period. One pass over the candidates."""
    labelled = F.col(TARGET).isNotNull()
    usable = labelled & F.col(ORDER_TIME).isNotNull()
    rows = F.count_if(usable)
    late = F.count_if(usable & (F.col(TARGET) == 1))
    return candidates.agg(
        rows.alias("rows"),
        F.count_if(~labelled).alias("removed_missing_target"),
        F.count_if(labelled & F.col(ORDER_TIME).isNull()).alias("removed_missing_timestamp"),
        late.alias("late_orders"),
        F.count_if(usable & (F.col(TARGET) == 0)).alias("on_time_orders"),
        share(late, rows).alias("late_rate"),
        F.min(F.when(usable, F.col(ORDER_TIME))).alias("start_date"),
        F.max(F.when(usable, F.col(ORDER_TIME))).alias("end_date"),
    )


# --- preparation ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Preparation:
    """Fitted imputation, optional missing-value indicators and optional scaling, as one projection."""

    stage: SQLTransformer
    outputs: list[str]


def fit_preparation(
    df: DataFrame, columns: list[str] = FEATURES, indicators: bool = False, scale: bool = True
) -> Preparation:
    """Median imputation, then 0/1 indicators for columns that had NULLs, then mean 0 and std 1.

    Medians are exact. Scaling divides by the population standard deviation; a constant column is
    only centred. A column without any value is imputed with 0. ``df`` is read a few times: pass a
    stored table or a checkpoint.
    """
    medians = {c: q[0] if q[0] is not None else 0.0 for c, q in exact_quantiles(df, columns, [0.5]).items()}
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    flagged = [c for c in columns if indicators and gaps[c]]

    expressions = {f"{c}_prepared": f"coalesce(cast(`{c}` as double), {medians[c]!r}D)" for c in columns}
    expressions |= {f"{c}_missing": f"cast(`{c}` is null as double)" for c in flagged}
    if scale:
        moments = df.agg(
            *[
                f(F.expr(text)).alias(f"{label}_{name}")
                for name, text in expressions.items()
                for label, f in (("mean", F.avg), ("std", F.stddev_pop))
            ]
        ).first()
        expressions = {
            name: f"({text} - ({moments[f'mean_{name}']!r}D)) / {(moments[f'std_{name}'] or 1.0)!r}D"
            for name, text in expressions.items()
        }
    projection = ", ".join(f"{text} AS `{name}`" for name, text in expressions.items())
    return Preparation(SQLTransformer(statement=f"SELECT *, {projection} FROM __THIS__"), list(expressions))


def imputed_features(df: DataFrame) -> DataFrame:
    """The training rows with exact medians in place of missing features."""
    stored = cut_lineage(df)
    medians = exact_quantiles(stored, FEATURES, [0.5])
    return stored.select(
        "order_id",
        *[F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0]).cast("double")).alias(c) for c in FEATURES],
        TARGET,
    )


# --- training and scoring -------------------------------------------------------------------------


def _newton_step(prepared: DataFrame, columns: list[str], weights: np.ndarray) -> np.ndarray:
    """The step from ``weights``, the intercept first, towards the least summed loss with unit penalty."""
    d = len(weights)
    x = [F.lit(1.0), *[F.col(c) for c in columns]]
    margin = sum((F.lit(float(w)) * c for w, c in zip(weights[1:], x[1:])), F.lit(float(weights[0])))
    rows = prepared.select(
        *[c.alias(f"x{i}") for i, c in enumerate(x)], F.col(TARGET).alias("y"), (1 / (1 + F.exp(-margin))).alias("p")
    ).withColumn("q", F.col("p") * (1 - F.col("p")))
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = rows.agg(
        *[F.sum((F.col("y") - F.col("p")) * F.col(f"x{i}")).alias(f"g{i}") for i in range(d)],
        *[F.sum(F.col("q") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    penalty = np.append(0.0, np.ones(d - 1))
    curvature = np.diag(penalty)
    for i, j in pairs:
        curvature[i, j] += sums[f"c{i}_{j}"]
        curvature[j, i] = curvature[i, j]
    return np.linalg.solve(curvature, [sums[f"g{i}"] for i in range(d)] - penalty * weights)


def _optimum(prepared: DataFrame, columns: list[str], fitted: LogisticRegressionModel) -> np.ndarray:
    """Weights, the intercept first, at the optimum near the fitted ones: Newton steps until they stop getting shorter."""
    weights = np.append(fitted.intercept, fitted.coefficients.toArray())
    before = np.inf
    for _ in range(NEWTON_STEPS):
        step = _newton_step(prepared, columns, weights)
        length = np.abs(step).max()
        if not length < before:
            break
        weights, before = weights + step, length
        if length <= 1e-14 * np.abs(weights).max():
            break
    return weights


def train(training: DataFrame, indicators: bool = False, stored: bool = False) -> PipelineModel:
    """L2-regularised logistic regression with unit inverse strength and no class weights.

    Spark averages the loss over rows, so an inverse strength of 1 is a penalty of 1 / rows. Preparation and
    every optimiser step read the training set again, so it is checkpointed unless it is ``stored`` already.

    Spark's optimiser stops at a gradient of 1e-8, which leaves errors in the seventh digit, enough to round some
    scores otherwise. Newton steps go on from there, and a second fit without steps takes their weights as its bounds.
    """
    rows = training.select(*FEATURES, F.col(TARGET).cast("double").alias(TARGET))
    rows = rows if stored else cut_lineage(rows)
    preparation = fit_preparation(rows, FEATURES, indicators=indicators)
    assembler = VectorAssembler(inputCols=preparation.outputs, outputCol="features")
    columns = preparation.stage.transform(rows)
    prepared = assembler.transform(columns).select("features", TARGET)
    estimator = LogisticRegression(
        labelCol=TARGET,
        maxIter=MAX_ITERATIONS,
        tol=1e-12,
        regParam=1.0 / max(rows.count(), 1),
        elasticNetParam=0.0,
        standardization=False,
    )
    regression = estimator.fit(prepared)
    # With one class only there is no finite optimum.
    if np.isfinite(regression.intercept):
        weights = _optimum(columns, preparation.outputs, regression)
        regression = _with_weights(estimator, prepared, weights)
    return PipelineModel(stages=[preparation.stage, assembler, regression])


def _with_weights(estimator: LogisticRegression, prepared: DataFrame, weights: np.ndarray) -> LogisticRegressionModel:
    """A model of these weights, the intercept first."""
    intercept, slopes = Vectors.dense(weights[:1]), Matrices.dense(1, len(weights) - 1, weights[1:].tolist())
    bounds = {
        estimator.lowerBoundsOnIntercepts: intercept,
        estimator.upperBoundsOnIntercepts: intercept,
        estimator.lowerBoundsOnCoefficients: slopes,
        estimator.upperBoundsOnCoefficients: slopes,
    }
    return estimator.copy(bounds | {estimator.maxIter: 0}).fit(prepared)


def score(model: PipelineModel, df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Adds the late probability, the 0/1 prediction (inclusive threshold) and its label."""
    added = {c for stage in model.stages[:1] for c in stage.transform(df).columns} - set(df.columns)
    scored = model.transform(df).withColumn("late_probability", vector_to_array("probability")[1])
    prediction = (F.col("late_probability") >= threshold).cast("int")
    return (
        scored.withColumn("late_prediction", prediction)
        .withColumn("risk_label", F.when(F.col("late_prediction") == 1, "HIGH").otherwise("LOW"))
        .drop(*added, "features", "rawPrediction", "probability", "prediction")
    )


def regression_of(model: PipelineModel) -> LogisticRegressionModel:
    return model.stages[-1]


def coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Scaled-feature coefficients, strongest first."""
    names = [c.removesuffix("_prepared") for c in model.stages[1].getInputCols()]
    pairs = [(name, float(value)) for name, value in zip(names, regression_of(model).coefficients)]
    return spark.createDataFrame(pairs, "feature string, coefficient double").orderBy(
        F.abs("coefficient").desc(), "feature"
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Raises if there is no model at ``path``."""
    return PipelineModel.load(path)


# --- evaluation -----------------------------------------------------------------------------------


def split_by_time(training: DataFrame, earlier_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Orders up to the time quantile, and the orders after it."""
    timed = training.withColumn("_seconds", F.unix_micros(F.col(ORDER_TIME).cast("timestamp")) / F.lit(1e6))
    stored = cut_lineage(timed)
    cut = exact_quantiles(stored, ["_seconds"], [earlier_share])["_seconds"][0]
    early = F.col("_seconds") <= F.lit(cut).cast("double")
    return stored.filter(early).drop("_seconds"), stored.filter(~early).drop("_seconds")


def areas(scored: DataFrame) -> DataFrame:
    """``roc_auc`` and ``pr_auc`` of rows with ``label`` (0 or 1) and ``late_probability``; NULL where undefined.

    Every different probability is one step of both curves, from the highest down; all rows that share it are
    taken at once. Both areas are trapezoids between steps; precision before the first step is that of the first.
    """
    steps = scored.groupBy("late_probability").agg(
        F.count_if(F.col("label") == 1).alias("late"), F.count_if(F.col("label") == 0).alias("rest")
    )
    placed = sums_before(steps, F.col("late_probability").desc(), ["late", "rest"])
    late_before, rest_before = F.col("before_late").cast("double"), F.col("before_rest").cast("double")
    late_after, rest_after = late_before + F.col("late"), rest_before + F.col("rest")
    precision = late_after / (late_after + rest_after)
    precision_before = F.coalesce(F.try_divide(late_before, late_before + rest_before), precision)
    sums = placed.agg(
        F.sum(F.col("rest") * (late_before + late_after) / 2).alias("wins"),
        F.sum(F.col("late") * (precision_before + precision) / 2).alias("held"),
        F.sum("late").cast("double").alias("late"),
        F.sum("rest").cast("double").alias("rest"),
    )
    return sums.select(
        F.try_divide(F.col("wins"), F.col("late") * F.col("rest")).alias("roc_auc"),
        F.try_divide(F.col("held"), F.col("late")).alias("pr_auc"),
    )


def evaluate(scored: DataFrame, threshold: float = THRESHOLD, stored: bool = False) -> DataFrame:
    """One row of metrics for scored rows with a label.

    Threshold metrics are one aggregate; the areas under the curves come from exact ranks. Both read the rows,
    which are checkpointed unless what they were scored from is ``stored`` already.
    """
    rows = scored.select(F.col(TARGET).cast("double").alias("label"), "late_probability")
    rows = rows if stored else cut_lineage(rows)
    flagged = F.col("late_probability") >= threshold
    late = F.col("label") == 1
    total, positives = F.count(F.lit(1)), F.count_if(late)
    hits, raised = F.count_if(flagged & late), F.count_if(flagged)
    precision, recall = share(hits, raised), share(hits, positives)
    counted = rows.agg(
        total.alias("rows"),
        positives.alias("late_orders"),
        precision.alias("precision"),
        recall.alias("recall"),
        share(2 * hits, raised + positives).alias("f1"),
        F.avg(F.pow(F.col("late_probability") - F.col("label"), 2)).alias("brier_score"),
        share(raised, total).alias("flagged_rate"),
        F.try_divide(precision, share(positives, total)).alias("lift"),
    )
    # Two tables of one row each, put side by side.
    order = ["rows", "late_orders", "roc_auc", "pr_auc", "precision", "recall", "f1", "brier_score", "flagged_rate", "lift"]
    both = counted.unionByName(areas(rows), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in order])


# --- metadata -------------------------------------------------------------------------------------


def model_metadata(
    spark: SparkSession,
    model: PipelineModel,
    summary: DataFrame,
    evaluation: DataFrame | None = None,
    model_path: str | None = None,
) -> DataFrame:
    """One row describing the model: configuration, training summary, metrics, coefficients."""
    described = summary.select(
        F.lit("delivery_risk_model").alias("model_name"),
        F.lit("LogisticRegression").alias("model_type"),
        F.lit("binary_classification").alias("task"),
        F.lit(TARGET).alias("target"),
        F.lit(THRESHOLD).alias("threshold"),
        F.array(*[F.lit(c) for c in FEATURES]).alias("features"),
        F.struct(
            F.lit("median_imputation").alias("missing_values"), F.lit("standard_scaler").alias("scaling")
        ).alias("preprocessing"),
        F.lit(None).cast("string").alias("class_weight"),
        F.lit(RANDOM_STATE).alias("random_state"),
        F.struct(*summary.columns).alias("training"),
        F.lit(model_path).cast("string").alias("model_path"),
        F.array(
            *[
                F.struct(F.lit(row["feature"]).alias("feature"), F.lit(row["coefficient"]).alias("coefficient"))
                for row in coefficients(spark, model).collect()
            ]
        ).alias("coefficients"),
    )
    if evaluation is None:
        return described
    metrics = evaluation.first().asDict()
    return described.withColumn("validation", F.struct(*[F.lit(v).alias(k) for k, v in metrics.items()]))


def save_metadata(metadata: DataFrame, path: str) -> None:
    write_json(metadata, path)
