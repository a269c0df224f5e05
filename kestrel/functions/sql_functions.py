"""The statistics and the session rule as SQL functions of the catalog (``CREATE FUNCTION ... RETURN``).

``register(spark)`` makes them temporary, ``register(spark, "db")`` permanent in that database (the table functions then need permanent views). They are SQL expressions, so the optimiser
inlines them and a query that calls them has the plan of built-in functions.

two_proportion_z(n_a, x_a, n_b, x_b), two_proportion_p(...), chi_square_p(x, dof), normal_p(z), p_label(p), opens_session(previous, this, gap_minutes) and the
table functions arm_tests(alpha), over a view ``arm_totals``, and customer_sessions(gap_minutes), over a view ``fct_events``. The latter is
plain SQL with a window per customer, for data of ordinary customers; ``operators.sessions`` splits hot ones.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

from kestrel.functions.labels import P_FLOOR
from kestrel.functions.stats import erfc_coefficients


def _horner() -> str:
    text = "0D"
    for a in reversed(erfc_coefficients()):
        text = f"({text} * t + ({a!r}D))"
    return text


_DOUBLES = "n_a DOUBLE, x_a DOUBLE, n_b DOUBLE, x_b DOUBLE"
#: name -> (parameters, type, body), each using those before it.
SCALARS = {
    "erfc_polynomial": ("t DOUBLE", "DOUBLE", _horner()),
    "erfc_at": ("x DOUBLE, t DOUBLE", "DOUBLE", "t * exp(-(x * x) + {erfc_polynomial}(t))"),
    "erfc_tail": ("x DOUBLE", "DOUBLE", "{erfc_at}(x, 1D / (1D + 0.5D * x))"),
    "normal_p": ("z DOUBLE", "DOUBLE", f"{{erfc_tail}}(abs(z) / {math.sqrt(2.0)!r}D)"),
    "pooled_rate": (_DOUBLES, "DOUBLE", "try_divide(x_a + x_b, n_a + n_b)"),
    "pooled_error": ("pool DOUBLE, n_a DOUBLE, n_b DOUBLE", "DOUBLE", "sqrt(pool * (1D - pool) * (try_divide(1D, n_a) + try_divide(1D, n_b)))"),
    "z_of": ("difference DOUBLE, error DOUBLE", "DOUBLE", "CASE WHEN error > 0 THEN difference / error WHEN error = 0 THEN 0D END"),
    "two_proportion_z": (_DOUBLES, "DOUBLE", "{z_of}(try_divide(x_b, n_b) - try_divide(x_a, n_a), {pooled_error}({pooled_rate}(n_a, x_a, n_b, x_b), n_a, n_b))"),
    "two_proportion_p": (_DOUBLES, "DOUBLE", "{normal_p}({two_proportion_z}(n_a, x_a, n_b, x_b))"),
    "chi_square_series": ("h DOUBLE, first DOUBLE, terms INT, shift DOUBLE", "DOUBLE",
                          "aggregate(sequence(0, terms), named_struct('total', 0D, 'term', first), "
                          "(s, i) -> named_struct('total', s.total + if(i < terms, s.term, 0D), 'term', s.term * h / (i + 1 + shift)), s -> s.total)"),
    "chi_square_p": ("x DOUBLE, dof INT", "DOUBLE",
                     "CASE WHEN dof % 2 = 0 THEN exp(-x / 2) * {chi_square_series}(x / 2, 1D, dof div 2, 0D) "
                     f"ELSE {{erfc_tail}}(sqrt(x / 2)) + exp(-x / 2) * {{chi_square_series}}(x / 2, sqrt(x / 2) / {math.gamma(1.5)!r}D, dof div 2, 0.5D) END"),
    # a double whose shortest text ends in a 5 after the last kept digit: its exact value times 2**66 decides (see labels)
    "tie_rest": ("p DOUBLE, scale DECIMAL(10,0), digits BIGINT", "DECIMAL(38,0)",
                 f"CAST((CAST(floor(p * {2.0 ** 40!r}D) AS DECIMAL(20,0)) * {2 ** 26} + CAST(floor((p * {2.0 ** 40!r}D - floor(p * {2.0 ** 40!r}D)) * {2.0 ** 26!r}D) AS DECIMAL(20,0))) "
                 f"AS DECIMAL(27,0)) * scale - CAST(digits AS DECIMAL(10,0)) * CAST('{2 ** 66}' AS DECIMAL(20,0))"),
    "tie_broken": ("p DOUBLE, decimals INT, digits BIGINT, scale DECIMAL(10,0)", "DOUBLE",
                   "CASE WHEN pmod(digits, 10) = 5 AND CAST(digits AS DOUBLE) / CAST(scale AS DOUBLE) = p AND "
                   "({tie_rest}(p, scale, digits) < 0 OR {tie_rest}(p, scale, digits) = 0 AND pmod(digits div 10, 2) = 0) "
                   "THEN CAST(digits div 10 AS DOUBLE) / pow(10D, decimals) ELSE p END"),
    "p_digits": ("p DOUBLE, decimals INT", "STRING",
                 "format_string(concat('%.', decimals, 'f'), {tie_broken}(p, decimals, CAST(rint(p * pow(10D, decimals + 1)) AS BIGINT), CAST(pow(10D, decimals + 1) AS DECIMAL(10,0))))"),
    "p_label": ("p DOUBLE", "STRING",
                f"CASE WHEN p < {P_FLOOR!r}D THEN '< 0.0001' WHEN p IS NOT NULL THEN "
                r"regexp_replace(regexp_replace({p_digits}(p, CAST(3 - floor(log10(p)) AS INT)), '(\\.\\d*?)0+$', '$1'), '\\.$', '') END"),
    "opens_session": ("previous TIMESTAMP_NTZ, this TIMESTAMP_NTZ, gap_minutes DOUBLE", "BOOLEAN",
                      "coalesce(timestampdiff(MICROSECOND, previous, this) > gap_minutes * 60000000, false)"),
}
TABLES = {
    "arm_tests": ("alpha DOUBLE", "pair_idx INT, group_a STRING, group_b STRING, rate_a DOUBLE, rate_b DOUBLE, absolute_lift_pp DOUBLE, z_stat DOUBLE, "
                  "p_value DOUBLE, bonferroni_alpha DOUBLE, significant BOOLEAN", """
        SELECT CAST(pair_idx AS INT), a.name, b.name, try_divide(a.x, a.n), try_divide(b.x, b.n), (try_divide(b.x, b.n) - try_divide(a.x, a.n)) * 100D,
               round({two_proportion_z}(a.n, a.x, b.n, b.x), 9), round({two_proportion_p}(a.n, a.x, b.n, b.x), 12), arm_tests.alpha / pairs,
               {two_proportion_p}(a.n, a.x, b.n, b.x) < arm_tests.alpha / pairs
        FROM (SELECT size(pair_list) AS pairs, posexplode(pair_list) AS (pair_idx, pair)
              FROM (SELECT flatten(transform(arms, (p, i) -> transform(filter(arms, (q, j) -> j > i), q -> named_struct('a', p, 'b', q)))) AS pair_list
                    FROM (SELECT array_sort(collect_list(named_struct('i', arm_idx, 'name', experiment_group, 'n', CAST(total_events AS DOUBLE),
                                                                      'x', CAST(purchase_events AS DOUBLE)))) AS arms FROM arm_totals)))
        LATERAL VIEW inline(array(pair)) AS a, b"""),
    "customer_sessions": ("gap_minutes DOUBLE", "event_id BIGINT, customer_id BIGINT, `timestamp` TIMESTAMP_NTZ, derived_session_id STRING", """
        SELECT event_id, customer_id, `timestamp`, concat_ws('-', CAST(customer_id AS STRING),
               CAST(1 + count_if({opens_session}(previous, `timestamp`, customer_sessions.gap_minutes)) OVER (PARTITION BY customer_id ORDER BY `timestamp`, event_id) AS STRING))
        FROM (SELECT *, lag(`timestamp`) OVER (PARTITION BY customer_id ORDER BY `timestamp`, event_id) AS previous FROM fct_events)"""),
}


def statements(database: str | None = None, tables: bool = True) -> list[str]:
    """The CREATE statements, in order."""
    prefix = f"{database}." if database else ""
    kind = "FUNCTION" if database else "TEMPORARY FUNCTION"
    names = {n: prefix + n for n in (*SCALARS, *TABLES)}
    fill = lambda body: _named(body, names)
    out = [f"CREATE OR REPLACE {kind} {names[n]}({p}) RETURNS {t} RETURN {fill(b)}" for n, (p, t, b) in SCALARS.items()]
    return out + [f"CREATE OR REPLACE {kind} {names[n]}({p}) RETURNS TABLE ({t}) RETURN {fill(b)}" for n, (p, t, b) in TABLES.items() if tables]


def _named(body: str, names: dict[str, str]) -> str:
    for name, full in names.items():
        body = body.replace("{" + name + "}", full)
    return body


def register(spark: SparkSession, database: str | None = None, tables: bool = True) -> None:
    """Create the functions. The table functions need their views to exist."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for text in statements(database, tables):
        spark.sql(text)
