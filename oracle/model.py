"""The risk model in SQL: imputation, scaling, Newton steps as a recursive query, scores, ranks."""

from __future__ import annotations

from oracle.tables import with_tables

# The features and the operating threshold of the published model.
FEATURES = [
    "order_item_count",
    "order_total_price",
    "order_total_freight",
    "purchase_hour",
    "purchase_day_of_week",
    "estimated_delivery_duration_days",
]
THRESHOLD = 0.07
_STEPS = 15


def _behind_tables(ctes: list[str], body: str) -> str:
    tables = with_tables("SELECT * FROM training JOIN features")
    tables = tables[: tables.rindex("\nSELECT")].removeprefix("WITH ")
    return "WITH RECURSIVE " + ",\n".join([tables, *ctes]) + "\n" + body


def _fit(rows: str, indicators: bool) -> tuple[list[str], list[str]]:
    """Tables up to ``fit`` (the weights, intercept first) and the names of the weights."""
    names = FEATURES
    columns = [f"coalesce({f}::DOUBLE, (SELECT median({f}::DOUBLE) FROM {rows}))" for f in FEATURES]
    if indicators:
        names = FEATURES + [f"{f}_missing" for f in FEATURES]
        columns += [f"({f} IS NULL)::INTEGER::DOUBLE" for f in FEATURES]
    d = len(names) + 1
    moments = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(columns))
    scaled = ", ".join(f"({c} - m{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END" for i, c in enumerate(columns))
    gradient = [f"sum((y - p) * x[{i + 1}]) - {int(i > 0)} * any_value(w[{i + 1}])" for i in range(d)]

    def curvature(i: int, j: int) -> str:
        i, j = sorted((i, j))
        return f"c{i}_{j} + {int(i == j and i > 0)}"

    sums = [f"sum(q * x[{i + 1}] * x[{j + 1}]) AS c{i}_{j}" for i in range(d) for j in range(i, d)]
    matrix = ", ".join(f"[{', '.join(curvature(i, j) for j in range(d))}, g{i}]" for i in range(d))
    # Elimination with one pivot after another; the pivots' numbers are matrices of one number.
    pivots = ", ".join(f"[[{k}::DOUBLE]]" for k in range(1, d + 1))
    row = "list_transform(r, lambda v, j: v - r[k[1][1]::INTEGER] / m[k[1][1]::INTEGER][k[1][1]::INTEGER] * m[k[1][1]::INTEGER][j])"
    unit = "list_transform(r, lambda v: v / r[k[1][1]::INTEGER])"
    solved = (
        f"list_reduce([{pivots}], lambda m, k: list_transform(m, lambda r, i: "
        f"CASE WHEN i = k[1][1]::INTEGER THEN {unit} ELSE {row} END), matrix)"
    )
    steps = f"""fit AS (
  SELECT 0 AS step, list_transform(range({d}), lambda i: 0::DOUBLE) AS w
  UNION ALL
  SELECT step + 1, list_transform(w, lambda v, i: v + ({solved})[i][{d + 1}])
  FROM (SELECT step, w, [{matrix}] AS matrix FROM (
    SELECT step, any_value(w) AS w, {', '.join(f'{g} AS g{i}' for i, g in enumerate(gradient))}, {', '.join(sums)}
    FROM (SELECT *, p * (1 - p) AS q FROM (
      SELECT step, w, x, y, 1 / (1 + exp(-list_inner_product(w, x))) AS p FROM fit, prepared WHERE step < {_STEPS}))
    GROUP BY step)))"""
    tables = [
        f"moments AS (SELECT {moments} FROM {rows})",
        f"scaled AS (SELECT f.*, [1, {scaled}]::DOUBLE[] AS x FROM {{scored}} f, moments)",
        f"prepared AS (SELECT [1, {scaled}]::DOUBLE[] AS x, is_late::DOUBLE AS y FROM {rows}, moments)",
        steps,
        f"weights AS (SELECT w FROM fit WHERE step = {_STEPS})",
    ]
    return tables, names


LABELLED = "labelled AS (SELECT * FROM training WHERE is_late IS NOT NULL AND order_purchase_timestamp IS NOT NULL)"


def coefficients(indicators: bool) -> str:
    tables, names = _fit("labelled", indicators)
    tables = [t for t in tables if not t.startswith("scaled")]
    gaps = {f"{f}_missing": f"(SELECT count(*) > count({f}) FROM labelled)" for f in FEATURES}
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS feature, round(w[{i + 2}], 4) AS coefficient FROM weights WHERE {gaps.get(n, 'true')}"
        for i, n in enumerate(names)
    )
    return _behind_tables([LABELLED, *tables], rows)


def _scored(tables: list[str], source: str) -> list[str]:
    late = "scored AS (SELECT *, 1 / (1 + exp(-list_inner_product(w, x))) AS late_probability FROM scaled, weights)"
    return [t.replace("{scored}", source) for t in tables] + [late]


def scores() -> str:
    tables, _ = _fit("labelled", False)
    body = f"""SELECT order_id, round(late_probability, 4) AS late_probability,
  (late_probability >= {THRESHOLD})::INTEGER AS late_prediction,
  CASE WHEN late_probability >= {THRESHOLD} THEN 'HIGH' ELSE 'LOW' END AS risk_label FROM scored"""
    return _behind_tables([LABELLED, *_scored(tables, "features")], body)


def evaluation() -> str:
    tables, _ = _fit("earlier", False)
    split = [
        "timed AS (SELECT *, epoch_us(order_purchase_timestamp) / 1000000 AS seconds FROM labelled)",
        "cut AS (SELECT quantile_cont(seconds, 0.8) AS last_second FROM timed)",
        "earlier AS (SELECT timed.* FROM timed, cut WHERE seconds <= last_second)",
        "later AS (SELECT timed.* FROM timed, cut WHERE seconds > last_second)",
    ]
    curve = """steps AS (
  SELECT late, rest, sum(late) OVER w AS late_sum, sum(rest) OVER w AS rest_sum,
         row_number() OVER (ORDER BY late_probability DESC) AS place
  FROM (SELECT late_probability, count(*) FILTER (is_late = 1) AS late, count(*) FILTER (is_late = 0) AS rest
        FROM scored GROUP BY late_probability)
  WINDOW w AS (ORDER BY late_probability DESC)),
curve AS (
  SELECT *, late_sum / (late_sum + rest_sum) AS precise,
         lag(late_sum / (late_sum + rest_sum)) OVER (ORDER BY place) AS precise_before FROM steps)"""
    raised = f"late_probability >= {THRESHOLD}"
    body = f"""SELECT rows, late_orders, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc,
  hits / raised AS precision, hits / late_orders AS recall, 2.0 * hits / (raised + late_orders) AS f1,
  round(brier_score, 6) AS brier_score, raised / rows AS flagged_rate,
  (hits / raised) / (late_orders / rows) AS lift
FROM (SELECT count(*) AS rows, count(*) FILTER (is_late = 1) AS late_orders,
             count(*) FILTER ({raised}) AS raised, count(*) FILTER ({raised} AND is_late = 1) AS hits,
             avg((late_probability - is_late) ** 2) AS brier_score FROM scored),
     (SELECT sum(rest * (late_sum - late / 2)) / (sum(late) * sum(rest)) AS roc_auc,
             sum(late * (precise + coalesce(precise_before, precise)) / 2) / sum(late) AS pr_auc FROM curve)"""
    return _behind_tables([LABELLED, *split, *_scored(tables, "later"), curve], body)


ORACLE = {
    "risk_scores": scores(),
    "risk_coefficients": coefficients(False),
    "risk_coefficients_with_indicators": coefficients(True),
    "risk_evaluation": evaluation(),
}
