import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.catalog import QUERIES
from ordermill.operators import risk
from rows import dicts, item, order, star


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6)) * [2, 50, 9, 1, 1, 4] + [2, 120, 20, 12, 4, 20]
    x[:, 3] = 5.0  # a constant feature
    p = 1 / (1 + np.exp(-(-1.5 + 0.4 * (x[:, 0] - 2) - 0.3 * (x[:, 5] - 20))))
    y = (rng.random(400) < p).astype(int)
    rows = [
        (f"o{i}", *[float(v) if (i + j) % 29 or j != 1 else None for j, v in enumerate(r)], int(t))
        for i, (r, t) in enumerate(zip(x, y))
    ]
    columns = ", ".join(f"{c} double" for c in risk.FEATURES)
    df = spark.createDataFrame(rows, f"order_id string, {columns}, {risk.TARGET} int")
    return df.withColumn(risk.ORDER_TIME, F.expr("timestamp'2018-01-01' + make_dt_interval(cast(substr(order_id, 2) as int))"))


def prepared(training, indicators=False):
    """Imputed, scaled matrix and labels in numpy."""
    pdf = training.toPandas()
    x = pdf[risk.FEATURES].to_numpy(float)
    gaps = np.isnan(x)
    x = np.where(gaps, np.nanmedian(x, axis=0), x)
    if indicators:
        x = np.hstack([x, gaps[:, gaps.any(axis=0)].astype(float)])
    std = x.std(axis=0)
    return (x - x.mean(axis=0)) / np.where(std == 0, 1, std), pdf[risk.TARGET].to_numpy(float)


def newton(x, y, steps=60):
    """Unpenalised intercept, unit L2 penalty on the coefficients."""
    design = np.hstack([np.ones((len(x), 1)), x])
    penalty = np.diag([0.0] + [1.0] * x.shape[1])
    w = np.zeros(design.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (p - y) + penalty @ w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        w -= np.linalg.solve(hessian, gradient)
    return w[0], w[1:]


@pytest.mark.parametrize("indicators", [False, True])
def test_fit_reaches_the_penalised_optimum(training, indicators):
    model = risk.regression_of(risk.train(training, indicators))
    intercept, weights = newton(*prepared(training, indicators))
    assert model.intercept == pytest.approx(intercept, abs=1e-4)
    assert list(model.coefficients) == pytest.approx(list(weights), abs=1e-4)


@pytest.mark.parametrize("indicators", [False, True])
def test_fit_is_exact_to_the_eleventh_digit(training, indicators):
    """Errors in the seventh digit of the weights round one score in some tens of thousands otherwise."""
    model = risk.regression_of(risk.train(training, indicators))
    intercept, weights = newton(*prepared(training, indicators))
    assert model.intercept == pytest.approx(intercept, abs=1e-11)
    assert list(model.coefficients) == pytest.approx(list(weights), abs=1e-11)


def test_one_class_only_is_no_error(training):
    model = risk.train(training.filter(f"{risk.TARGET} = 0"))
    assert {r["late_prediction"] for r in dicts(risk.score(model, training))} == {0}


def test_refit_and_reload_give_the_same_scores(spark, training, tmp_path):
    model = risk.train(training)
    path = str(tmp_path / "model")
    risk.save_model(model, path)
    first = {r["order_id"]: r["late_probability"] for r in dicts(risk.score(model, training))}
    again = {r["order_id"]: r["late_probability"] for r in dicts(risk.score(risk.load_model(path), training))}
    refit = {r["order_id"]: r["late_probability"] for r in dicts(risk.score(risk.train(training.repartition(3)), training))}
    assert first == again
    assert refit == pytest.approx(first, abs=1e-6)
    assert all(0 <= p <= 1 for p in first.values())
    with pytest.raises(Exception):
        risk.load_model(str(tmp_path / "nothing"))


def test_threshold_is_inclusive(training):
    model = risk.train(training)
    scored = risk.score(model, training)
    assert scored.columns == [*training.columns, "late_probability", "late_prediction", "risk_label"]
    edge = scored.orderBy("order_id").first()["late_probability"]
    row = risk.score(model, training, threshold=edge).orderBy("order_id").first()
    assert (row["late_prediction"], row["risk_label"]) == (1, "HIGH")
    row = risk.score(model, training, threshold=np.nextafter(edge, 1)).orderBy("order_id").first()
    assert (row["late_prediction"], row["risk_label"]) == (0, "LOW")


def test_indicators_without_scaling(training):
    preparation = risk.fit_preparation(training, indicators=True, scale=False)
    assert preparation.outputs == [f"{c}_prepared" for c in risk.FEATURES] + ["order_total_price_missing"]
    row = preparation.stage.transform(training).filter("order_total_price is null").first()
    median = np.nanmedian(training.toPandas()["order_total_price"].to_numpy(float))
    assert (row["order_total_price_prepared"], row["order_total_price_missing"]) == (median, 1.0)


def test_evaluation_matches_a_plain_count(spark):
    rows = [(1, 0.9), (1, 0.06), (0, 0.07), (0, 0.01), (0, 0.5), (0, 0.02)]
    scored = spark.createDataFrame(rows, "is_late int, late_probability double")
    got = dicts(risk.evaluate(scored))[0]
    assert (got["rows"], got["late_orders"]) == (6, 2)
    assert got["precision"] == pytest.approx(1 / 3) and got["recall"] == 0.5 and got["f1"] == pytest.approx(0.4)
    assert got["flagged_rate"] == 0.5 and got["lift"] == pytest.approx(1.0)
    assert got["brier_score"] == pytest.approx(sum((p - y) ** 2 for y, p in rows) / 6)
    wins = sum(a > b for y, a in rows if y for z, b in rows if not z)
    assert got["roc_auc"] == pytest.approx(wins / 8)


def test_areas_take_equal_scores_at_once(spark):
    rng = np.random.default_rng(4)
    rows = [(int(y), float(p)) for y, p in zip(rng.random(3000) < 0.2, rng.integers(0, 40, 3000) / 40)]
    got = risk.areas(spark.createDataFrame(rows, "label int, late_probability double").repartition(7)).first()
    late, rest = [p for y, p in rows if y], [p for y, p in rows if not y]
    wins = sum((a > b) + (a == b) / 2 for a in late for b in rest)
    assert got["roc_auc"] == pytest.approx(wins / len(late) / len(rest), abs=1e-12)
    points, area = [], 0.0
    for p in sorted({p for _, p in rows}, reverse=True):
        hits, raised = sum(x >= p for x in late), sum(x >= p for _, x in rows)
        points.append((hits / len(late), hits / raised))
    for (r0, p0), (r1, p1) in zip([(0.0, points[0][1]), *points], points):
        area += (r1 - r0) * (p0 + p1) / 2
    assert got["pr_auc"] == pytest.approx(area, abs=1e-12)


@pytest.mark.parametrize("rows", [[], [(1, 0.5)], [(0, 0.5), (0, 0.5)]])
def test_areas_without_both_outcomes_are_unknown(spark, rows):
    got = risk.areas(spark.createDataFrame(rows, "label int, late_probability double")).first()
    assert got["roc_auc"] is None and (got["pr_auc"] is None) == (not rows or not rows[0][0])


def test_time_split_keeps_every_row_once(training):
    early, late = risk.split_by_time(training, 0.75)
    assert (early.count(), late.count()) == (300, 100)
    assert early.agg(F.max(risk.ORDER_TIME)).first()[0] < late.agg(F.min(risk.ORDER_TIME)).first()[0]


def test_metadata(spark, training, tmp_path):
    model = risk.train(training)
    summary = risk.training_summary(training)
    evaluation = risk.evaluate(risk.score(model, training))
    risk.save_metadata(risk.model_metadata(spark, model, summary, evaluation, "m"), str(tmp_path / "meta"))
    row = spark.read.json(str(tmp_path / "meta")).first().asDict(recursive=True)
    assert row["threshold"] == 0.07 and row["features"] == risk.FEATURES and row["training"]["rows"] == 400
    sizes = [abs(c["coefficient"]) for c in row["coefficients"]]
    assert len(sizes) == 6 and sizes == sorted(sizes, reverse=True)
    assert 0 <= row["validation"]["roc_auc"] <= 1


def test_training_set_keeps_known_outcomes_only(spark):
    tables = star(spark, [order("a", delay=1), order("b", delay=0), order("open")], [item("a")])
    candidates = risk.training_candidates(tables.delivery_features, tables.fact_orders)
    rows = dicts(risk.training_set(tables.delivery_features, tables.fact_orders), "order_id")
    assert [(r["order_id"], r["is_late"], r["order_item_count"]) for r in rows] == [("a", 1, 1), ("b", 0, None)]
    summary = dicts(risk.training_summary(candidates))[0]
    assert (summary["rows"], summary["removed_missing_target"], summary["late_rate"]) == (2, 1, 0.5)


def test_every_order_is_scored(spark, tiny):
    scores = QUERIES["risk_scores"](spark, tiny)
    assert scores.count() == 1500
    assert scores.filter("late_probability < 0 or late_probability > 1 or late_probability is null").count() == 0
