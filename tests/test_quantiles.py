import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 0.8, 1.0]


def test_even_count_gives_the_midpoint(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]) == {"x": [2.5]}


def test_no_values_and_one_value(spark):
    df = spark.createDataFrame([(None, 7)], "x double, y int")
    assert exact_quantiles(df, ["x", "y"], [0.5]) == {"x": [None], "y": [7.0]}


@pytest.mark.parametrize("bins", [2, 7, 2048])
def test_skewed_values_match_numpy(spark, bins):
    rng = np.random.default_rng(7)
    values = np.concatenate([np.full(300, 5.0), rng.lognormal(3, 4, 300), -rng.lognormal(1, 2, 100)])
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(5)
    got = exact_quantiles(df, ["x"], PROBABILITIES, bins=bins)["x"]
    assert got == pytest.approx(list(np.quantile(values, PROBABILITIES)), rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-5, 5), st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_any_values_match_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_quantiles(df, ["x"], PROBABILITIES, bins=4)["x"]
    assert got == pytest.approx(list(np.quantile([float(v) for v in values], PROBABILITIES)), rel=1e-9, abs=1e-9)


INF = float("inf")


@pytest.mark.parametrize("bins", [2, 2048])
@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, 3.0, 4.0, INF],
        [-INF, -INF, 5.0, INF],
        [-1.7e308, 1.0, 2.0, 3.0, 1.7e308],
        [5e-324, 1e-323, 0.0, -5e-324, 1.0, 1e300, -2.2250738585072014e-308],
        [-0.0, 0.0, 1e-310, 2e-310],
    ],
)
def test_wide_and_infinite_ranges_end(spark, values, bins, monkeypatch):
    from ordermill.operators import quantiles

    rounds = []
    monkeypatch.setattr(quantiles, "_histograms", lambda *a, f=quantiles._histograms: rounds.append(1) or f(*a))
    df = spark.createDataFrame([(v,) for v in values], "x double")
    # Each value is a quantile of its own rank.
    ranks = [i / (len(values) - 1) for i in range(len(values))]
    assert exact_quantiles(df, ["x"], ranks, bins=bins)["x"] == sorted(values)
    assert len(rounds) <= quantiles.WIDTH_ROUNDS + (7 if bins > 2 else 65)


def _rounds(monkeypatch):
    from ordermill.operators import quantiles

    rounds = []
    monkeypatch.setattr(quantiles, "_histograms", lambda *a, f=quantiles._histograms: rounds.append(1) or f(*a))
    return rounds


@pytest.mark.parametrize(
    "kind", ["normal", "lognormal", "whole numbers", "money", "with infinities", "one value mostly", "heavy tail"]
)
def test_ordinary_data_settles_in_two_scans(spark, kind, monkeypatch):
    rng = np.random.default_rng(11)
    n = 60_000
    values = {
        "normal": rng.normal(0, 1, n),
        "lognormal": rng.lognormal(3, 2, n),
        "whole numbers": rng.integers(0, 100_000, n).astype(float),
        "money": np.round(rng.gamma(2, 60, n), 2),
        "with infinities": np.concatenate([rng.normal(0, 1, n), [INF, -INF]]),
        "one value mostly": np.where(rng.random(n) < 0.9, 5.0, rng.normal(5, 1, n)),
        "heavy tail": rng.standard_cauchy(n),
    }[kind]
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(6)
    rounds = _rounds(monkeypatch)
    wanted = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0] if kind != "with infinities" else [0.25, 0.5, 0.75]
    got = exact_quantiles(df, ["x"], wanted)["x"]
    assert got == pytest.approx(list(np.quantile(values, wanted)), rel=1e-12)
    # One scan for extent and sketch comes before the histograms.
    assert len(rounds) == 1


def test_wrong_splitters_cost_a_round_only(spark, monkeypatch):
    values = [float(v) for v in np.random.default_rng(5).normal(0, 1, 500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    # Every splitter at the largest value.
    largest = lambda value, sides, accuracy: F.array(*[F.max(value) for _ in sides])
    monkeypatch.setattr(F, "percentile_approx", largest)
    got = exact_quantiles(df, ["x"], PROBABILITIES)["x"]
    assert got == pytest.approx(list(np.quantile(values, PROBABILITIES)), rel=1e-12)


def test_ordinals_follow_the_order_of_doubles(spark):
    from ordermill.operators.quantiles import _ordinal, _ordinal_of

    r = np.random.default_rng(3)
    bits = r.integers(-(2**63), 2**63, 2000)
    values = [float(v) for v in bits.view(np.float64) if not np.isnan(v)]
    values += [s * 2.0**e * f for s in (1, -1) for e in (-1074, -1073, -1022, -1023, -1, 0, 1, 1023) for f in (1.0, 1 - 2**-53, 1 + 2**-52)]
    values += [0.0, -0.0, INF, -INF]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", _ordinal_of(F.col("x")).alias("o"))
    assert [row["o"] for row in df.collect()] == [_ordinal(v) for v in values]
