"""SQL twins of the queries on slices and formula models."""

from __future__ import annotations

from cartwheel.operators.learning import DAILY_FEATURES
from cartwheel.plans import oracle
from cartwheel.plans.oracle import _day, _with

_CARTS = "CAST(add_to_cart_count_3d AS DOUBLE) / CAST(add_to_cart_count_3d + view_count_3d + 1 AS DOUBLE)"
_MODELS = {
    "habit": "CAST((user_id * 37 + day(prediction_date) * 11) % 100 AS DOUBLE) / CAST(100 AS DOUBLE)",
    "carts": _CARTS,
    "constant": "CAST(0.5 AS DOUBLE)",
}
_SCORED = " UNION ALL ".join(
    f"SELECT '{name}' AS model, label_purchase_tomorrow AS label, {score} AS score FROM ft" for name, score in _MODELS.items()
)


def _counted(scored: str) -> str:
    """Rows per model and score, with those below and in all."""
    below = "(PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
        SELECT model, score, p, n, sum(p) OVER (PARTITION BY model) AS ps, sum(n) OVER (PARTITION BY model) AS ns,
               coalesce(sum(p) OVER {below}, 0) AS p_below, coalesce(sum(n) OVER {below}, 0) AS n_below
        FROM (SELECT model, score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n
              FROM ({scored}) GROUP BY model, score)"""


def _auc(scored: str) -> str:
    return f"""
        SELECT model, CAST(max(ps) AS BIGINT) AS positives, CAST(max(ns) AS BIGINT) AS negatives,
               CAST(sum(p * (2 * n_below + n)) AS DOUBLE) / (2 * CAST(max(ps) AS DOUBLE) * CAST(max(ns) AS DOUBLE)) AS auc
        FROM ({_counted(scored)}) GROUP BY model"""


_SWEEP = f"""
    SELECT model, score AS threshold, CAST(ps - p_below AS BIGINT) AS hits, CAST(ns - n_below AS BIGINT) AS false_alarms,
           CAST(ps - p_below AS DOUBLE) / CAST(ps - p_below + ns - n_below AS DOUBLE) AS precision,
           CAST(ps - p_below AS DOUBLE) / CAST(ps AS DOUBLE) AS recall,
           2 * CAST(ps - p_below AS DOUBLE) / CAST(ps - p_below + ns - n_below + ps AS DOUBLE) AS f1
    FROM ({_counted(_SCORED)})"""
_BEST_THRESHOLD = f"""
    SELECT model, threshold, hits, false_alarms, f1 FROM ({_SWEEP})
    QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1 DESC, threshold) = 1"""
_CELLS = f"""
    SELECT model, CAST(label AS INTEGER) AS label, CAST(score >= 0.4 AS INTEGER) AS prediction, count(*) AS rows
    FROM ({_SCORED}) GROUP BY ALL"""
_METRICS = f"""
    SELECT a.model, auc, accuracy, f1 FROM ({_auc(_SCORED)}) a JOIN (
        SELECT model, CAST(sum(CASE WHEN label = prediction THEN rows ELSE 0 END) AS DOUBLE) / CAST(sum(rows) AS DOUBLE) AS accuracy,
               2 * CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN rows ELSE 0 END) AS DOUBLE)
                 / CAST(sum(CASE WHEN prediction = 1 THEN rows ELSE 0 END) + sum(CASE WHEN label = 1 THEN rows ELSE 0 END) AS DOUBLE) AS f1
        FROM ({_CELLS}) GROUP BY model) b ON a.model = b.model
    ORDER BY auc DESC, a.model LIMIT 1"""
_CLASS_METRICS = f"""
    SELECT label, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
    FROM (SELECT label, coalesce(CAST(sum(rows) FILTER (WHERE label = prediction) AS DOUBLE), 0) / CAST(any_value(named) AS DOUBLE) AS precision,
                 coalesce(CAST(sum(rows) FILTER (WHERE label = prediction) AS DOUBLE), 0) / CAST(sum(rows) AS DOUBLE) AS recall
          FROM ({_CELLS}) c LEFT JOIN (SELECT prediction AS k, sum(rows) AS named FROM ({_CELLS}) WHERE model = 'carts' GROUP BY 1) ON k = label
          WHERE model = 'carts' GROUP BY label)"""


def _permuted(column: str) -> str:
    """The cart model over features with one column dealt anew."""
    deal = f"md5('42:{column}|' || user_id || '|' || {_day('prediction_date')})"
    return f"""
        SELECT '{column}' AS model, label_purchase_tomorrow AS label, {_CARTS} AS score FROM (
            SELECT d.* REPLACE (t.{column} AS {column}) FROM
                (SELECT *, row_number() OVER (ORDER BY {deal}, user_id, prediction_date) AS at FROM ft) d
                JOIN (SELECT {column}, row_number() OVER (ORDER BY user_id, prediction_date) AS at FROM ft) t ON d.at = t.at)"""


_PERMUTED_INPUTS = ("add_to_cart_count_3d", "view_count_3d", "sessions_3d")
_WHOLE = f"SELECT '' AS model, label_purchase_tomorrow AS label, {_CARTS} AS score FROM ft"
_IMPORTANCE = f"""
    SELECT m.model AS feature, w.auc - m.auc AS importance
    FROM ({_auc(" UNION ALL ".join(_permuted(c) for c in _PERMUTED_INPUTS))}) m, ({_auc(_WHOLE)}) w"""
_INPUTS = f"""
    SELECT user_id, prediction_date, {", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in DAILY_FEATURES)},
           CAST(label_purchase_tomorrow AS INTEGER) AS label
    FROM ft WHERE prediction_date < DATE '2024-01-25' AND label_purchase_tomorrow IS NOT NULL"""


def _clamped(column: str, low: str, high: str) -> str:
    at = "(SELECT {c} FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS r, count(*) OVER () AS n FROM sf) WHERE r = greatest(1, ceil({q} * n)))"
    low, high = (at.format(c=column, q=q) for q in (low, high))
    return f"CAST(greatest(least({column}, {high}), {low}) AS DOUBLE) AS {column}"


def statements() -> dict[str, str]:
    other = oracle.statements()
    scaled = ", ".join(f"round({c} / stddev_samp({c}) OVER (), 6) AS {c}" for c in DAILY_FEATURES)
    return {
        "silver_orders_month": f"SELECT * FROM ({other['silver_orders']}) WHERE year = 1998 AND month = 12",
        "session_actions_day": f"SELECT * FROM ({other['session_actions']}) WHERE year = 2024 AND month = 1 AND day = 15",
        "daily_sales_30d": f"SELECT * FROM ({other['daily_sales']}) WHERE calendar_date BETWEEN '2001-07-02' AND '2001-08-01'",
        "winsorised_sessions": _with(
            f"SELECT session_id, {_clamped('duration_seconds', '0.05', '0.95')}, {_clamped('avg_product_price', '0.05', '0.95')} FROM sf", "sf"
        ),
        "auc_formula": _with(_auc(_SCORED), "ft"),
        "threshold_sweep_formula": _with(_SWEEP, "ft"),
        "best_threshold_formula": _with(_BEST_THRESHOLD, "ft"),
        "confusion_counts": _with(_CELLS, "ft"),
        "best_model": _with(_METRICS, "ft"),
        "class_metrics_formula": _with(_CLASS_METRICS, "ft"),
        "permutation_importance": _with(_IMPORTANCE, "ft"),
        "model_inputs": _with(f"SELECT * REPLACE ({_day('prediction_date')} AS prediction_date) FROM ({_INPUTS})", "ft"),
        "scaled_inputs": _with(f"SELECT user_id, {_day('prediction_date')} AS prediction_date, {scaled} FROM ({_INPUTS})", "ft"),
        "class_weights": _with(
            f"""SELECT label, CASE label WHEN 1 THEN 0.5 / share ELSE 0.5 / (1 - share) END AS class_weight, count(*) AS rows
                FROM (SELECT label, avg(CAST(label AS DOUBLE)) OVER () AS share FROM ({_INPUTS})) GROUP BY ALL""",
            "ft",
        ),
        "score_outside_model_day": f"SELECT * FROM ({other['score_outside_model']}) WHERE prediction_date = '2024-01-15'",
    }
