"""DuckDB text that several plans' twins share."""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.operators.bootstrap import resampled_sql, z_of_p_sql


def corrected_sql(keys: Sequence[str], partition: Sequence[str] = (), rows: str = "compared") -> str:
    """From ``rows`` (keys, delta, n, n_eff, p_value) to ``judged``: with the correction, the tests in it, the verdict by ``metric`` and the observations needed."""
    by = ", ".join([*partition, "f"])
    return f"""
    by_family AS (SELECT *, CASE WHEN horizon IN (5, 20, 60) THEN 'core' ELSE 'extended' END AS f FROM {rows}),
    ordered AS (
        SELECT *, count(*) OVER (PARTITION BY {by}) AS n_tests,
               p_value * count(p_value) OVER (PARTITION BY {by}) / row_number() OVER (PARTITION BY {by}, p_value IS NULL ORDER BY p_value) AS raw FROM by_family),
    bh AS (
        SELECT *, CASE WHEN p_value IS NOT NULL THEN least(1.0, min(raw) OVER (
                   PARTITION BY {by}, p_value IS NULL ORDER BY p_value RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) END AS p_value_fdr FROM ordered),
    scored AS (SELECT *, CASE WHEN metric IN ('brier', 'rmse') THEN -delta ELSE delta END AS better, {z_of_p_sql("p_value")} AS z FROM bh),
    judged AS (
        SELECT *, CASE WHEN n < 30 THEN 'too_early'
                       WHEN metric = 'coverage' THEN CASE WHEN abs(delta) <= 0.02 THEN 'same' ELSE 'worse' END
                       WHEN better > 0 AND coalesce(p_value_fdr < 0.05 AND n_eff >= 30, false) THEN 'better_significant'
                       WHEN abs(better) < 0.005 THEN 'same' WHEN better >= 0.005 THEN 'better_not_significant' ELSE 'worse' END AS verdict,
               CASE WHEN delta = 0 OR n_eff < 2 THEN 0 ELSE
                    ceil(power((1.959963985e0 + 0.841621234e0) * (abs(delta) / greatest(z, 1e-6) * sqrt(n_eff)) / abs(delta), 2)) END::BIGINT AS observations_needed FROM scored)"""


def records_sql(rows: str, keys: Sequence[str], partition: Sequence[str] = (), day: str = "session", judged: bool = True) -> str:
    """CTEs and the query of a table of records over ``rows`` (keys with metric and horizon, day, m, b)."""
    numbers = "round(value, 6) AS value, round(baseline_value, 6) AS baseline_value, round(delta, 6) + 0.0 AS delta, n, round(n_eff, 2) AS n_eff, round(p_value, 6) AS p_value"
    more = ", round(p_value_fdr, 6) AS p_value_fdr, n_tests" + (", verdict, observations_needed" if judged else ", verdict")
    own = [k for k in keys if judged or k != "metric"]
    return f"{resampled_sql(rows, keys, day=day)}, {corrected_sql(keys, partition)} SELECT {', '.join(own)}, {numbers}{more} FROM judged"
