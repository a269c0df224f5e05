"""DuckDB SQL for every registered query (the correctness oracle).

The driver registers the raw tables as DuckDB views. Each oracle string starts
with CTEs that derive the star schema from them with the FIXTURES.md §4 rules,
written directly in DuckDB SQL (not generated from the Spark plans). Two things
are shared with the code under test, because SQL has no other source for them: the
fitted ``erfc`` coefficients (so p-values rest on the unit tests against
``math.erfc``) and the constants of the bootstrap's draw hash.
"""

from __future__ import annotations

import math

from kestrel.config import DRIVER
from kestrel.sources.schemas import TABLES
from kestrel.functions.stats import erfc_coefficients

STAR = {
    "fct_events": """
fct_events AS (
  SELECT event_id,
         ts AS "timestamp",
         user_id AS customer_id,
         event_id % 1000 AS session_id,
         CASE WHEN event_type = 'error' THEN 'bounce' ELSE event_type END AS event_type,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE (event_id * 31) % 200 END AS product_id,
         CASE event_id % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' WHEN 2 THEN 'tablet' END AS device_type,
         CASE event_id % 6 WHEN 0 THEN 'Organic' WHEN 1 THEN 'ORGANIC' WHEN 2 THEN 'paid search'
              WHEN 3 THEN 'Social' WHEN 4 THEN 'EMAIL' ELSE 'Partner' END AS traffic_source,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 25 AS campaign_id,
         CASE event_id % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'product' ELSE 'checkout' END AS page_category,
         CAST("value" AS DECIMAL(8,2)) AS session_duration_sec,
         CASE WHEN event_id % 5 < 3 THEN 'Control' WHEN event_id % 5 = 3 THEN 'Variant_A'
              ELSE 'Variant_B' END AS experiment_group
  FROM events)""",
    "dim_customers": """
dim_customers AS (
  SELECT c_custkey AS customer_id,
         CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS signup_date,
         n.n_name AS country,
         CAST(18 + c_custkey % 60 AS INTEGER) AS age,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN c_acctbal < 2500 THEN 'Bronze' WHEN c_acctbal < 6000 THEN 'Silver' ELSE 'Gold' END AS loyalty_tier,
         c_mktsegment AS acquisition_channel
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    "valid_customers": """
valid_customers AS (SELECT c_custkey AS customer_id FROM customer WHERE c_acctbal > 0)""",
    "dim_products": """
dim_products AS (
  SELECT p_partkey AS product_id, p_type AS category, p_brand AS brand,
         CAST(p_retailprice AS DECIMAL(10,2)) AS base_price,
         CAST(DATE '2020-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS DATE) AS launch_date,
         CAST(p_retailprice >= 1500 AS INTEGER) AS is_premium
  FROM part)""",
    "dim_campaigns": """
dim_campaigns AS (
  SELECT CAST(n_nationkey AS BIGINT) AS campaign_id, r_name AS channel, n_name AS objective,
         CAST(DATE '2024-01-01' + n_nationkey AS DATE) AS start_date,
         CAST(DATE '2024-01-01' + n_nationkey + 6 AS DATE) AS end_date,
         'tier-' || CAST(n_regionkey AS VARCHAR) AS target_segment,
         CAST((n_nationkey % 5) / 100 AS DECIMAL(6,4)) AS expected_uplift
  FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "fct_transactions": """
fct_transactions AS (
  SELECT o_orderkey AS transaction_id, o_orderdate AS "timestamp", o_custkey AS customer_id,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey % 200 END AS product_id,
         CAST(1 + o_orderkey % 5 AS INTEGER) AS quantity,
         CAST((o_orderkey % 4) * 0.05 AS DECIMAL(5,4)) AS discount_applied,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(10,2)) END AS gross_revenue,
         o_orderkey % 25 AS campaign_id,
         CAST(o_orderstatus = 'P' AS INTEGER) AS refund_flag
  FROM orders)""",
}


def with_star(body: str, *tables: str, extra_ctes: tuple[str, ...] = ()) -> str:
    ctes = [STAR[t].strip() for t in tables] + [c.strip() for c in extra_ctes]
    return ("WITH " + ",\n".join(ctes) + "\n" + body.strip()) if ctes else body.strip()


def rnp(expr: str, nd: int = 2) -> str:
    """numpy-style rounding (ties to even on the scaled value)."""
    s = 10 ** nd
    return f"(round_even(({expr}) * {s}.0, 0) / {s}.0)"


def pct(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * 100.0)"


def erfc_sql(x: str) -> str:
    z = f"abs({x})"
    t = f"(1.0 / (1.0 + 0.5 * {z}))"
    acc = "0.0"
    for a in reversed(erfc_coefficients()):
        acc = f"({acc} * {t} + ({a!r}))"
    v = f"({t} * exp(-({z} * {z}) + {acc}))"
    return f"(CASE WHEN {x} >= 0 THEN {v} ELSE 2.0 - {v} END)"


def norm_p_sql(z: str) -> str:
    return erfc_sql(f"(abs({z}) / {math.sqrt(2.0)!r})")


def chi2_sf_sql(x: str, dof: int) -> str:
    h = f"(({x}) / 2.0)"
    if dof % 2 == 0:
        terms = " + ".join(f"pow({h}, {float(i)!r}) / {float(math.factorial(i))!r}" for i in range(dof // 2))
        return f"(exp(-{h}) * ({terms}))"
    terms = " + ".join(f"pow({h}, {i - 0.5!r}) / {math.gamma(i + 0.5)!r}"
                       for i in range(1, (dof - 1) // 2 + 1)) or "0.0"
    return f"({erfc_sql(f'sqrt({h})')} + exp(-{h}) * ({terms}))"


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


STEPS = DRIVER.steps


def reach_cte(steps=STEPS) -> str:
    cols = ",\n         ".join(f"bool_or(event_type = '{s}') AS \"{s}\"" for s in steps)
    return f"""
reach AS (
  SELECT customer_id,
         {cols}
  FROM fct_events WHERE event_type IN ({_in_list(steps)})
  GROUP BY customer_id)"""


def _overall_body(steps=STEPS) -> str:
    counts = ", ".join(f"count_if(\"{s}\") AS c{i}" for i, s in enumerate(steps))
    rows = " UNION ALL ".join(
        f"SELECT {i} AS step_idx, '{s}' AS step_name, c{i} AS reached, "
        f"{'NULL' if i == 0 else f'c{i - 1}'} AS prev, total FROM w" for i, s in enumerate(steps))
    return f"""
w AS (SELECT count(*) AS total, {counts} FROM reach),
s AS ({rows}),
o AS (
  SELECT CAST(step_idx AS INTEGER) AS step_idx, step_name, CAST(reached AS BIGINT) AS customers_reached,
         {rnp(pct('reached', 'total'))} AS pct_of_customers,
         CASE WHEN step_idx = 0 THEN 100.0 ELSE {rnp(pct('reached', 'prev'))} END AS step_over_step_pct
  FROM s)"""


def overall_cte(steps=STEPS) -> tuple[str, ...]:
    return (reach_cte(steps), _overall_body(steps).strip())


Q = {}

Q["funnel_overall"] = with_star(
    f"SELECT *, {rnp('100.0 - step_over_step_pct')} AS drop_off_pct FROM o",
    "fct_events", extra_ctes=overall_cte())

Q["scan_project"] = with_star("SELECT customer_id, event_type FROM fct_events", "fct_events")

Q["funnel_reach"] = with_star("SELECT * FROM reach", "fct_events", extra_ctes=(reach_cte(),))

Q["bounce_rate"] = with_star(
    f"SELECT {rnp(pct('count_if(event_type = ' + chr(39) + 'bounce' + chr(39) + ')', 'count(*)'))} "
    "AS bounce_rate_pct FROM fct_events", "fct_events")


def _by_channel_ctes(steps=STEPS):
    counts = ", ".join(f"count_if(\"{s}\") AS c{i}" for i, s in enumerate(steps))
    rows = " UNION ALL ".join(
        f"SELECT acquisition_channel, {i} AS step_idx, '{s}' AS step_name, c{i} AS reached, total FROM w"
        for i, s in enumerate(steps))
    return (reach_cte(steps), f"""
w AS (SELECT c_mktsegment AS acquisition_channel, count(*) AS total, {counts}
      FROM reach JOIN customer ON reach.customer_id = customer.c_custkey GROUP BY c_mktsegment),
bc AS (
  SELECT acquisition_channel, CAST(step_idx AS INTEGER) AS step_idx, step_name,
         CAST(reached AS BIGINT) AS customers_reached, {rnp(pct('reached', 'total'))} AS pct_of_signups
  FROM ({rows}) x)""".strip())


Q["funnel_by_channel"] = with_star("SELECT * FROM bc", "fct_events", extra_ctes=_by_channel_ctes())

Q["channel_conversion"] = with_star(
    f"SELECT acquisition_channel, customers_reached, pct_of_signups FROM bc WHERE step_name = '{STEPS[-1]}' "
    "ORDER BY pct_of_signups DESC, acquisition_channel", "fct_events", extra_ctes=_by_channel_ctes())

Q["biggest_drop_off"] = with_star(
    f"SELECT step_name, {rnp('100.0 - step_over_step_pct')} AS drop_off_pct FROM o WHERE step_idx > 0 "
    "ORDER BY drop_off_pct DESC NULLS LAST, step_idx LIMIT 1", "fct_events", extra_ctes=overall_cte())

Q["revenue_per_converted"] = with_star(f"""
SELECT {rnp('CAST(avg(customer_total) AS DOUBLE)')} AS avg_revenue_per_converted_customer
FROM (SELECT customer_id, sum(gross_revenue) AS customer_total FROM fct_transactions
      WHERE refund_flag = 0 AND gross_revenue IS NOT NULL GROUP BY customer_id) t""", "fct_transactions")


def _sessions_cte(gap_minutes: int) -> str:
    return f"""
g AS (SELECT *, lag("timestamp") OVER (PARTITION BY customer_id ORDER BY "timestamp", event_id) AS prev_ts
      FROM fct_events),
f AS (SELECT *, CASE WHEN prev_ts IS NULL
                       OR date_diff('microsecond', prev_ts, "timestamp") > {gap_minutes * 60_000_000}
                     THEN 1 ELSE 0 END AS new_s FROM g),
sq AS (SELECT * EXCLUDE (prev_ts, new_s),
              CAST(sum(new_s) OVER (PARTITION BY customer_id ORDER BY "timestamp", event_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_seq
       FROM f),
sess AS (SELECT *, CAST(customer_id AS VARCHAR) || '-' || CAST(session_seq AS VARCHAR) AS derived_session_id
         FROM sq)""".strip()


def _summary_cte() -> str:
    return f"""
summ AS (
  SELECT CAST(customer_id AS VARCHAR) || '-' || CAST(session_seq AS VARCHAR) AS derived_session_id,
         customer_id, min("timestamp") AS start_ts, max("timestamp") AS end_ts,
         CAST(count(event_id) AS BIGINT) AS n_events,
         {rnp("CAST(date_diff('microsecond', min(" + '"timestamp"' + "), max(" + '"timestamp"' + ")) AS DOUBLE) / 1e6 / 60.0")}
           AS duration_minutes
  FROM sess GROUP BY customer_id, session_seq)""".strip()


Q["sessionize"] = with_star("SELECT * FROM sess", "fct_events", extra_ctes=(_sessions_cte(30),))
Q["sessionize_gap360"] = with_star("SELECT * FROM sess", "fct_events", extra_ctes=(_sessions_cte(360),))

Q["event_gaps"] = with_star("""
SELECT event_id, customer_id, "timestamp",
       CAST(date_diff('microsecond', lag("timestamp") OVER (PARTITION BY customer_id ORDER BY "timestamp", event_id),
                      "timestamp") AS DOUBLE) / 60000000.0 AS gap_minutes
FROM fct_events""", "fct_events")

Q["session_summary"] = with_star("SELECT * FROM summ", "fct_events",
                                 extra_ctes=(_sessions_cte(30), _summary_cte()))
Q["stream_session_numbers"] = Q["session_summary"]  # the batch form's sessions and numbers
Q["session_summary_gap360"] = with_star("SELECT * FROM summ", "fct_events",
                                        extra_ctes=(_sessions_cte(360), _summary_cte()))

Q["session_counts"] = with_star("""
SELECT CAST((SELECT count(*) FROM fct_events) AS BIGINT) AS n_events,
       CAST((SELECT count(DISTINCT session_id) FROM fct_events) AS BIGINT) AS n_source_session_ids,
       CAST((SELECT count(*) FROM summ) AS BIGINT) AS n_derived_sessions""", "fct_events",
    extra_ctes=(_sessions_cte(30), _summary_cte()))

Q["session_describe"] = with_star("""
SELECT metric, CAST(count(v) AS BIGINT) AS "count", round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
       min(v) AS "min", round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50,
       round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS "max"
FROM (SELECT 'duration_minutes' AS metric, CAST(duration_minutes AS DOUBLE) AS v FROM summ
      UNION ALL SELECT 'n_events', CAST(n_events AS DOUBLE) FROM summ) x
GROUP BY metric""", "fct_events", extra_ctes=(_sessions_cte(360), _summary_cte()))


def _share_multi_sql(key: str, member: str, label: str) -> str:
    return f"""
SELECT CAST(count(*) AS BIGINT) AS n_{label}, CAST(count_if(n > 1) AS BIGINT) AS n_{label}_multi,
       round({pct('count_if(n > 1)', 'count(*)')}, 6) AS pct_{label}_multi
FROM (SELECT {key}, count(DISTINCT {member}) AS n FROM fct_events GROUP BY {key}) t"""


Q["dq_session_sharing"] = with_star(_share_multi_sql("session_id", "customer_id", "session_ids"), "fct_events")
Q["dq_group_stickiness"] = with_star(_share_multi_sql("customer_id", "experiment_group", "customers"),
                                     "fct_events")

Q["dq_gap_profile"] = with_star("""
SELECT CAST(count(gap_minutes) AS BIGINT) AS n_gaps,
       round(CAST(count_if(gap_minutes < 30) AS DOUBLE) / count(gap_minutes) * 100.0, 6) AS pct_gaps_under_threshold,
       round(quantile_cont(gap_minutes, 0.5), 6) AS median_gap_minutes,
       round(quantile_cont(gap_minutes, 0.5) / 1440.0, 6) AS median_gap_days
FROM (SELECT CAST(date_diff('microsecond',
                  lag("timestamp") OVER (PARTITION BY customer_id ORDER BY "timestamp", event_id), "timestamp")
             AS DOUBLE) / 60000000.0 AS gap_minutes FROM fct_events) t""", "fct_events")

GROUPS = DRIVER.groups
COUNTS_CTE = """
counts AS (SELECT customer_id, experiment_group, CAST(count(*) AS BIGINT) AS total_events,
                  CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchase_events
           FROM fct_events GROUP BY customer_id, experiment_group)"""


def _totals_ctes(groups=GROUPS):
    arms = " UNION ALL ".join(f"SELECT {i} AS arm_idx, '{g}' AS experiment_group" for i, g in enumerate(groups))
    wide = ", ".join(f"max(CASE WHEN experiment_group = '{g}' THEN total_events END) AS n{i}, "
                     f"max(CASE WHEN experiment_group = '{g}' THEN purchase_events END) AS x{i}"
                     for i, g in enumerate(groups))
    return (COUNTS_CTE, f"""
sums AS (SELECT experiment_group, CAST(sum(total_events) AS BIGINT) AS total_events,
                CAST(sum(purchase_events) AS BIGINT) AS purchase_events
         FROM counts WHERE experiment_group IN ({_in_list(groups)}) GROUP BY experiment_group),
totals AS (SELECT a.arm_idx, a.experiment_group, s.total_events, s.purchase_events,
                  CAST(s.purchase_events AS DOUBLE) / s.total_events AS purchase_rate
           FROM ({arms}) a LEFT JOIN sums s ON a.experiment_group = s.experiment_group),
wd AS (SELECT {wide} FROM totals)""".strip())


def _chi2_sql(k: int) -> str:
    n = [f"CAST(n{i} AS DOUBLE)" for i in range(k)]
    x = [f"CAST(x{i} AS DOUBLE)" for i in range(k)]
    big_n, big_x = "(" + " + ".join(n) + ")", "(" + " + ".join(x) + ")"
    succ = [f"power({x[i]} - {big_x} * {n[i]} / {big_n}, 2) / ({big_x} * {n[i]} / {big_n})" for i in range(k)]
    fail = [f"power(({n[i]} - {x[i]}) - ({big_n} - {big_x}) * {n[i]} / {big_n}, 2) / "
            f"(({big_n} - {big_x}) * {n[i]} / {big_n})" for i in range(k)]
    return "(" + " + ".join(succ + fail) + ")"


Q["customer_group_counts"] = with_star("SELECT * FROM counts", "fct_events", extra_ctes=(COUNTS_CTE,))
Q["group_totals"] = with_star("SELECT * FROM totals", "fct_events", extra_ctes=_totals_ctes())
Q["chi_square"] = with_star(f"""
SELECT round(c, 9) AS chi2, round({chi2_sf_sql('c', len(GROUPS) - 1)}, 12) AS p_value,
       {len(GROUPS) - 1} AS dof
FROM (SELECT {_chi2_sql(len(GROUPS))} AS c FROM wd) t""", "fct_events", extra_ctes=_totals_ctes())


def _ztest_cols(na, xa, nb, xb) -> str:
    pa, pb = f"(CAST({xa} AS DOUBLE) / {na})", f"(CAST({xb} AS DOUBLE) / {nb})"
    pool = f"(CAST({xa} + {xb} AS DOUBLE) / ({na} + {nb}))"
    se = f"sqrt({pool} * (1 - {pool}) * (1.0 / {na} + 1.0 / {nb}))"
    z = f"(CASE WHEN {se} > 0 THEN ({pb} - {pa}) / {se} ELSE 0.0 END)"
    return f"{pa} AS rate_a, {pb} AS rate_b, {z} AS z_raw"


_PAIRS = [(a, b) for a in range(len(GROUPS)) for b in range(a + 1, len(GROUPS))]
_PAIR_ROWS = " UNION ALL ".join(
    f"SELECT {i} AS pair_idx, '{GROUPS[a]}' AS group_a, '{GROUPS[b]}' AS group_b, "
    f"n{a} AS n_a, x{a} AS x_a, n{b} AS n_b, x{b} AS x_b FROM wd" for i, (a, b) in enumerate(_PAIRS))
_BALPHA = DRIVER.alpha / len(_PAIRS)
PAIRWISE_CTE = f"""
pw AS (
  SELECT pair_idx, group_a, group_b, rate_a, rate_b, (rate_b - rate_a) * 100.0 AS absolute_lift_pp,
         round(z_raw, 9) AS z_stat, round({norm_p_sql('z_raw')}, 12) AS p_value,
         CAST({_BALPHA!r} AS DOUBLE) AS bonferroni_alpha, {norm_p_sql('z_raw')} < {_BALPHA!r} AS significant
  FROM (SELECT *, {_ztest_cols('n_a', 'x_a', 'n_b', 'x_b')} FROM ({_PAIR_ROWS}) p) q)"""

Q["pairwise_z"] = with_star("SELECT * FROM pw", "fct_events", extra_ctes=_totals_ctes() + (PAIRWISE_CTE,))

Q["two_proportion_z"] = with_star(f"""
SELECT '{GROUPS[0]}' AS group_a, '{GROUPS[-1]}' AS group_b, rate_a, rate_b, round(z_raw, 9) AS z_stat,
       round({norm_p_sql('z_raw')}, 12) AS p_value
FROM (SELECT {_ztest_cols('n0', 'x0', f'n{len(GROUPS) - 1}', f'x{len(GROUPS) - 1}')} FROM wd) t""",
    "fct_events", extra_ctes=_totals_ctes())

Q["experiment_report"] = with_star(f"""
SELECT pair_idx, group_a || ' vs ' || group_b AS comparison, {rnp('absolute_lift_pp')} AS lift_pp,
       CASE WHEN p_value IS NULL THEN NULL WHEN p_value < 0.0001 THEN '< 0.0001'
            ELSE printf('%.4g', p_value) END AS p_value_label,
       CASE WHEN significant THEN 'Yes' ELSE 'No' END AS significant_bonferroni
FROM pw""", "fct_events", extra_ctes=_totals_ctes() + (PAIRWISE_CTE,))


def _srm_sql(k: int, shares) -> str:
    tot = sum(shares)
    n = [f"CAST(n{i} AS DOUBLE)" for i in range(k)]
    big_n = "(" + " + ".join(n) + ")"
    terms = [f"power({n[i]} - {big_n} * {s / tot!r}, 2) / ({big_n} * {s / tot!r})" for i, s in enumerate(shares)]
    return "(" + " + ".join(terms) + ")"


Q["srm_test"] = with_star(f"""
SELECT round(c, 9) AS chi2, round({chi2_sf_sql('c', len(GROUPS) - 1)}, 12) AS p_value, {len(GROUPS) - 1} AS dof
FROM (SELECT {_srm_sql(len(GROUPS), DRIVER.expected_shares)} AS c FROM wd) t""",
    "fct_events", extra_ctes=_totals_ctes())


def mix_hash_sql(source: str) -> str:
    """``source`` (a query with ``sid``) with the draw hash ``h``: the same two chains of affine maps
    modulo primes, one staged subquery per round (the constants are those of the operator)."""
    from kestrel.operators.bootstrap import DRAW_CHAINS
    q = source
    for c, (p, (a, a_hi, b), rounds) in enumerate(DRAW_CHAINS):
        q = f"SELECT *, ((sid % {p}) * {a} + (sid // {p}) * {a_hi} + {b}) % {p} AS h{c}_0 FROM ({q}) s{c}0"
        for r, (k, a_r, b_r) in enumerate(rounds, start=1):
            q = f"SELECT *, (xor(h{c}_{r - 1}, {k}) * {a_r} + {b_r}) % {p} AS h{c}_{r} FROM ({q}) s{c}{r}"
    return f"SELECT *, h0_2 * {2 ** 31} + h1_2 AS h FROM ({q}) h"


def mix_draws_sql(seed: int, n_boot: int) -> str:
    """Draw table (rep, idx)."""
    ids = f"SELECT r.range AS id, r.range + {seed * 7919} AS sid, nn.n AS n FROM nn, range({n_boot} * nn.n) r"
    return f"SELECT id // n AS rep, h % n AS idx FROM ({mix_hash_sql(ids)}) d"


def poisson_weights_sql(seed: int, n_boot: int) -> str:
    """Weight table (customer_id, rep, w): the Poisson(1) quantile of the hash."""
    ids = f"SELECT customer_id, r.range AS rep, customer_id * {n_boot} + r.range + {seed * 7919} AS sid FROM mat, range({n_boot}) r"
    steps, below = [], 0.0
    for m in range(21):
        below += math.exp(-1.0) / math.factorial(m)
        steps.append(f"CAST(h >= {math.floor(below * 2.0 ** 62)} AS INTEGER)")
    return f"SELECT customer_id, rep, {' + '.join(steps)} AS w FROM ({mix_hash_sql(ids)}) p"


def _boot_ctes(groups=GROUPS, n_boot=DRIVER.n_boot, seed=DRIVER.seed):
    k = len(groups)
    mat = ", ".join(f"CAST(sum(CASE WHEN experiment_group = '{g}' THEN total_events ELSE 0 END) AS BIGINT) AS n{i}, "
                    f"CAST(sum(CASE WHEN experiment_group = '{g}' THEN purchase_events ELSE 0 END) AS BIGINT) AS x{i}"
                    for i, g in enumerate(groups))
    sums = ", ".join(f"sum(n{i}) AS n{i}, sum(x{i}) AS x{i}" for i in range(k))
    lifts = ", ".join(f"(CAST(x{i} AS DOUBLE) / NULLIF(n{i}, 0) - CAST(x0 AS DOUBLE) / NULLIF(n0, 0)) * 100.0 "
                      f"AS lift_{i}" for i in range(1, k))
    return (COUNTS_CTE, f"""
mat AS (SELECT customer_id, {mat} FROM counts WHERE experiment_group IN ({_in_list(groups)}) GROUP BY customer_id),
mi AS (SELECT *, row_number() OVER (ORDER BY customer_id) - 1 AS idx FROM mat),
nn AS (SELECT count(*) AS n FROM mat),
draws AS ({mix_draws_sql(seed, n_boot)}),
reps AS (SELECT rep, {lifts} FROM (SELECT rep, {sums} FROM draws JOIN mi USING (idx) GROUP BY rep) s)""".strip())


Q["bootstrap_replicates"] = with_star("SELECT * FROM reps", "fct_events", extra_ctes=_boot_ctes())


def _poisson_ctes(groups=GROUPS, n_boot=DRIVER.n_boot, seed=DRIVER.seed):
    counts, chain = _boot_ctes(groups, n_boot, seed)
    k = len(groups)
    sums = ", ".join(f"sum(n{i} * w) AS n{i}, sum(x{i} * w) AS x{i}" for i in range(k))
    lifts = ", ".join(f"(CAST(x{i} AS DOUBLE) / NULLIF(n{i}, 0) - CAST(x0 AS DOUBLE) / NULLIF(n0, 0)) * 100.0 AS lift_{i}" for i in range(1, k))
    return (counts, chain.split("\nmi AS")[0].rstrip().rstrip(",") + f""",
weights AS ({poisson_weights_sql(seed, n_boot)}),
reps AS (SELECT rep, {lifts} FROM (SELECT rep, {sums} FROM weights JOIN mat USING (customer_id) GROUP BY rep) s)""")


Q["bootstrap_poisson"] = with_star("SELECT * FROM reps", "fct_events", extra_ctes=_poisson_ctes())

Q["dense_index_orders"] = """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx, count(*) OVER () AS n_rows FROM orders"""

Q["bootstrap_ci"] = with_star(" UNION ALL ".join(f"""
SELECT {i} AS cmp_idx, '{GROUPS[i]} vs {GROUPS[0]}' AS comparison,
       round(quantile_cont(lift_{i}, 0.5), 9) AS median_lift_pp,
       round(quantile_cont(lift_{i}, 0.025), 9) AS ci_2_5pct,
       round(quantile_cont(lift_{i}, 0.975), 9) AS ci_97_5pct,
       CAST(count(lift_{i}) AS BIGINT) AS n_valid_replicates
FROM reps""" for i in range(1, len(GROUPS))), "fct_events", extra_ctes=_boot_ctes())

LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
           "l_linestatus", "l_shipdate"]
Q["dedupe_by_key"] = ("SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
                      "ORDER BY " + ", ".join(f"{c} ASC NULLS FIRST" for c in LI_REST) + ") = 1")

Q["drop_any_null"] = with_star("""
SELECT * FROM fct_events
WHERE event_id IS NOT NULL AND "timestamp" IS NOT NULL AND customer_id IS NOT NULL AND session_id IS NOT NULL
  AND event_type IS NOT NULL AND product_id IS NOT NULL AND device_type IS NOT NULL AND traffic_source IS NOT NULL
  AND campaign_id IS NOT NULL AND page_category IS NOT NULL AND session_duration_sec IS NOT NULL
  AND experiment_group IS NOT NULL""", "fct_events")

Q["clean_customers"] = with_star("""
SELECT * FROM dim_customers WHERE customer_id IS NOT NULL
  AND signup_date IS NOT NULL AND country IS NOT NULL AND age IS NOT NULL AND gender IS NOT NULL
  AND loyalty_tier IS NOT NULL AND acquisition_channel IS NOT NULL""", "dim_customers")

Q["orphan_semi_join"] = with_star(
    "SELECT * FROM fct_transactions WHERE customer_id IN (SELECT customer_id FROM valid_customers)",
    "fct_transactions", "valid_customers")

Q["orphan_anti_count"] = with_star("""
SELECT 'fct_transactions' AS table_name, CAST(count(*) AS BIGINT) AS orphan_rows FROM fct_transactions
 WHERE customer_id NOT IN (SELECT customer_id FROM valid_customers)
UNION ALL
SELECT 'fct_events', CAST(count(*) AS BIGINT) FROM fct_events
 WHERE customer_id NOT IN (SELECT customer_id FROM valid_customers)""",
    "fct_transactions", "fct_events", "valid_customers")

Q["domain_violations"] = with_star("""
SELECT event_type AS value, CAST(count(*) AS BIGINT) AS n_rows FROM fct_events
WHERE event_type IS NULL OR event_type NOT IN ('view', 'click', 'add_to_cart', 'bounce', 'purchase')
GROUP BY event_type""", "fct_events")

Q["flag_missing"] = with_star("""
SELECT transaction_id, CAST(product_id IS NULL OR gross_revenue IS NULL AS INTEGER) AS has_missing_product_or_revenue
FROM fct_transactions""", "fct_transactions")

Q["flag_refund_sign"] = with_star("""
SELECT transaction_id,
       CASE WHEN refund_flag = 1 AND coalesce(gross_revenue, 0) >= 0 THEN 1 ELSE 0 END AS revenue_sign_mismatch
FROM fct_transactions""", "fct_transactions")

_SOURCE_CASE = ("CASE upper(traffic_source) WHEN 'ORGANIC' THEN 'Organic' WHEN 'PAID SEARCH' THEN 'Paid Search' "
                "WHEN 'SOCIAL' THEN 'Social' WHEN 'EMAIL' THEN 'Email' WHEN 'DIRECT' THEN 'Direct' "
                "ELSE traffic_source END")
Q["normalize_source"] = with_star(f"SELECT event_id, {_SOURCE_CASE} AS traffic_source FROM fct_events",
                                  "fct_events")
Q["fill_unknown"] = with_star("SELECT event_id, coalesce(device_type, 'unknown') AS device_type FROM fct_events",
                              "fct_events")

Q["pk_violations"] = with_star("""
SELECT table_name, CAST(sum(c) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_keys,
       CAST(count_if(c > 1) AS BIGINT) AS duplicate_keys
FROM (
  SELECT 'dim_customers' AS table_name, count(*) AS c FROM dim_customers GROUP BY customer_id
  UNION ALL SELECT 'dim_products', count(*) FROM dim_products GROUP BY product_id
  UNION ALL SELECT 'dim_campaigns', count(*) FROM dim_campaigns GROUP BY campaign_id
  UNION ALL SELECT 'fct_transactions', count(*) FROM fct_transactions GROUP BY transaction_id
  UNION ALL SELECT 'fct_events', count(*) FROM fct_events GROUP BY event_id
  UNION ALL SELECT 'lineitem', count(*) FROM lineitem GROUP BY l_orderkey, l_linenumber) t
GROUP BY table_name""", "dim_customers", "dim_products", "dim_campaigns", "fct_transactions", "fct_events")

Q["fk_violations"] = with_star("""
SELECT 'fct_transactions' AS table_name, 'customer_id' AS column_name, CAST(count(*) AS BIGINT) AS violations
  FROM fct_transactions WHERE customer_id IS NOT NULL
   AND customer_id NOT IN (SELECT customer_id FROM valid_customers)
UNION ALL SELECT 'fct_transactions', 'product_id', CAST(count(*) AS BIGINT)
  FROM fct_transactions WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM dim_products)
UNION ALL SELECT 'fct_events', 'customer_id', CAST(count(*) AS BIGINT)
  FROM fct_events WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM valid_customers)
UNION ALL SELECT 'fct_events', 'product_id', CAST(count(*) AS BIGINT)
  FROM fct_events WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM dim_products)""",
    "fct_transactions", "fct_events", "valid_customers", "dim_products")


def _nn(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(count_if(\"{c}\" IS NULL) AS BIGINT) AS null_rows "
        f"FROM {table}" for c in cols)


Q["not_null_violations"] = with_star(" UNION ALL ".join([
    _nn("dim_customers", ["customer_id", "signup_date", "country", "age", "gender", "loyalty_tier",
                          "acquisition_channel"]),
    _nn("dim_products", ["product_id", "category", "brand", "base_price", "launch_date", "is_premium"]),
    _nn("dim_campaigns", ["campaign_id", "channel", "objective", "start_date", "end_date", "target_segment",
                          "expected_uplift"]),
    _nn("fct_transactions", ["transaction_id", "timestamp", "customer_id", "quantity", "discount_applied",
                             "campaign_id", "refund_flag"]),
    _nn("fct_events", ["event_id", "timestamp", "customer_id", "session_id", "event_type", "traffic_source",
                       "campaign_id", "page_category", "session_duration_sec", "experiment_group"])]),
    "dim_customers", "dim_products", "dim_campaigns", "fct_transactions", "fct_events")

_VALID_DRIVER = _in_list(DRIVER.valid_event_types)
Q["load_audit"] = with_star(f"""
SELECT table_name, metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'dim_products' AS table_name, 'rows_in' AS metric, count(*) AS value FROM dim_products
  UNION ALL SELECT 'dim_products', 'rows_out', count(*) FROM (SELECT DISTINCT product_id FROM dim_products)
  UNION ALL SELECT 'dim_campaigns', 'rows_in', count(*) FROM dim_campaigns
  UNION ALL SELECT 'dim_campaigns', 'rows_out', count(*) FROM (SELECT DISTINCT campaign_id FROM dim_campaigns)
  UNION ALL SELECT 'dim_customers', 'rows_in', count(*) FROM dim_customers
  UNION ALL SELECT 'dim_customers', 'rows_out', count(*) FROM cust
  UNION ALL SELECT 'fct_transactions', 'rows_in', count(*) FROM fct_transactions
  UNION ALL SELECT 'fct_transactions', 'rows_after_dedupe', count(*) FROM tx
  UNION ALL SELECT 'fct_transactions', 'orphan_rows', count_if(NOT ok) FROM tx
  UNION ALL SELECT 'fct_transactions', 'rows_out', count_if(ok) FROM tx
  UNION ALL SELECT 'fct_transactions', 'has_missing_product_or_revenue',
                   count_if(ok AND (product_id IS NULL OR gross_revenue IS NULL)) FROM tx
  UNION ALL SELECT 'fct_transactions', 'revenue_sign_mismatch',
                   count_if(ok AND refund_flag = 1 AND coalesce(gross_revenue, 0) >= 0) FROM tx
  UNION ALL SELECT 'fct_events', 'rows_in', count(*) FROM fct_events
  UNION ALL SELECT 'fct_events', 'rows_after_dedupe', count(*) FROM ev
  UNION ALL SELECT 'fct_events', 'domain_violations',
                   count_if(event_type IS NULL OR event_type NOT IN ({_VALID_DRIVER})) FROM ev
  UNION ALL SELECT 'fct_events', 'orphan_rows', count_if(NOT ok) FROM ev
  UNION ALL SELECT 'fct_events', 'rows_out', count_if(ok) FROM ev
  UNION ALL SELECT 'fct_events', 'device_type_filled', count_if(ok AND device_type IS NULL) FROM ev
  UNION ALL SELECT 'fct_events', 'traffic_source_normalized', count_if(ok AND {_SOURCE_CASE} <> traffic_source)
            FROM ev) t""",
    "dim_customers", "dim_products", "dim_campaigns", "fct_transactions", "fct_events",
    extra_ctes=("""
cust AS (SELECT DISTINCT customer_id FROM dim_customers WHERE customer_id IS NOT NULL
         AND signup_date IS NOT NULL AND country IS NOT NULL AND age IS NOT NULL AND gender IS NOT NULL
         AND loyalty_tier IS NOT NULL AND acquisition_channel IS NOT NULL)""",
                "tx AS (SELECT *, customer_id IN (SELECT customer_id FROM cust) AS ok FROM fct_transactions)",
                "ev AS (SELECT *, customer_id IN (SELECT customer_id FROM cust) AS ok FROM fct_events)"))

Q["sql_lifecycle_funnel"] = with_star("""
SELECT CAST(sum(rv) AS BIGINT) AS view_count, CAST(sum(rc) AS BIGINT) AS click_count,
       CAST(sum(ra) AS BIGINT) AS add_to_cart_count, CAST(sum(rp) AS BIGINT) AS purchase_count,
       CAST(count(*) AS BIGINT) AS total_customers
FROM (SELECT customer_id, max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS rv,
             max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS rc,
             max(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS ra,
             max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS rp
      FROM fct_events GROUP BY customer_id) t""", "fct_events")

Q["sql_channel_purchase"] = with_star("""
SELECT c.acquisition_channel, CAST(count(*) AS BIGINT) AS customers, CAST(sum(p.purchased) AS BIGINT) AS ever_purchased,
       round(100.0 * sum(p.purchased) / count(*), 2) AS pct_ever_purchased
FROM dim_customers c
JOIN (SELECT customer_id, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS purchased
      FROM fct_events GROUP BY customer_id) p ON p.customer_id = c.customer_id
GROUP BY c.acquisition_channel ORDER BY pct_ever_purchased DESC""", "fct_events", "dim_customers")

Q["sql_group_purchase_rate"] = with_star("""
SELECT experiment_group, CAST(count(*) AS BIGINT) AS total_events,
       CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchase_events,
       round(100.0 * count_if(event_type = 'purchase') / count(*), 3) AS purchase_rate_pct
FROM fct_events GROUP BY experiment_group ORDER BY experiment_group""", "fct_events")

Q["sql_revenue_per_converted"] = with_star("""
SELECT round(CAST(avg(customer_total) AS DOUBLE), 2) AS avg_revenue_per_converted_customer
FROM (SELECT customer_id, sum(gross_revenue) AS customer_total FROM fct_transactions
      WHERE refund_flag = 0 AND gross_revenue IS NOT NULL GROUP BY customer_id) t""", "fct_transactions")

_CAMP_SELECT = """
SELECT c.campaign_id, c.channel, c.objective, CAST(c.expected_uplift AS DOUBLE) AS expected_uplift,
       CAST(count(*) AS BIGINT) AS attributed_events,
       CAST(count_if(e.event_type = 'purchase') AS BIGINT) AS attributed_purchases,
       round(100.0 * count_if(e.event_type = 'purchase') / count(*), 3) AS purchase_rate_pct"""
Q["sql_campaign_performance"] = with_star(_CAMP_SELECT + """
FROM fct_events e JOIN dim_campaigns c ON c.campaign_id = e.campaign_id
WHERE e.campaign_id <> 0
GROUP BY c.campaign_id, c.channel, c.objective, c.expected_uplift
ORDER BY purchase_rate_pct DESC, c.campaign_id LIMIT 10""", "fct_events", "dim_campaigns")

Q["campaign_active_window"] = with_star(_CAMP_SELECT + """,
       round(100.0 * count_if(e.event_type = 'purchase') / count(*) - 100.0 * CAST(c.expected_uplift AS DOUBLE), 3)
         AS rate_minus_target_pp
FROM fct_events e JOIN dim_campaigns c
  ON c.campaign_id = e.campaign_id AND CAST(e."timestamp" AS DATE) BETWEEN c.start_date AND c.end_date
WHERE e.campaign_id <> 0
GROUP BY c.campaign_id, c.channel, c.objective, c.expected_uplift""", "fct_events", "dim_campaigns")

Q["kpi_summary"] = with_star(f"""
SELECT ch.chi2, ch.p_value AS chi2_p_value, ch.dof AS chi2_dof,
       (SELECT {rnp(pct("count_if(event_type = 'bounce')", 'count(*)'))} FROM fct_events) AS bounce_rate_pct,
       (SELECT {rnp('CAST(avg(customer_total) AS DOUBLE)')}
          FROM (SELECT customer_id, sum(gross_revenue) AS customer_total FROM fct_transactions
                WHERE refund_flag = 0 AND gross_revenue IS NOT NULL GROUP BY customer_id) t)
         AS avg_revenue_per_converted_customer,
       (SELECT customers_reached FROM o WHERE step_idx = 0) AS total_customers,
       (SELECT customers_reached FROM o WHERE step_idx = {len(STEPS) - 1}) AS ever_purchased,
       (SELECT pct_of_customers FROM o WHERE step_idx = {len(STEPS) - 1}) AS ever_purchased_pct,
       (SELECT CAST(count(*) AS BIGINT) FROM reach) AS denominator_customers,
       (SELECT step_name FROM o WHERE step_idx > 0
         ORDER BY {rnp('100.0 - step_over_step_pct')} DESC NULLS LAST, step_idx LIMIT 1) AS worst_step,
       (SELECT {rnp('100.0 - step_over_step_pct')} AS d FROM o WHERE step_idx > 0
         ORDER BY d DESC NULLS LAST, step_idx LIMIT 1) AS worst_drop_off_pct
FROM (SELECT round(c, 9) AS chi2, round({chi2_sf_sql('c', len(GROUPS) - 1)}, 12) AS p_value,
             {len(GROUPS) - 1} AS dof
      FROM (SELECT {_chi2_sql(len(GROUPS))} AS c FROM wd) t0) ch""",
    "fct_events", "fct_transactions", extra_ctes=overall_cte() + _totals_ctes())


def _regression_sql(steps=STEPS, threshold=2.0) -> str:
    bools = ", ".join(f"bool_or(event_type = '{s}') AS \"{s}\"" for s in steps)
    counts = ", ".join(f"count_if(\"{s}\") AS c{i}" for i, s in enumerate(steps))
    rows = " UNION ALL ".join(f"SELECT week_start, total, {i} AS step_idx, '{s}' AS step_name, c{i} AS reached "
                              f"FROM weekly" for i, s in enumerate(steps))
    return f"""
wr AS (SELECT CAST(date_trunc('week', "timestamp") AS DATE) AS week_start, customer_id, {bools},
              min(CAST("timestamp" AS DATE)) AS d0, max(CAST("timestamp" AS DATE)) AS d1
       FROM fct_events WHERE event_type IN ({_in_list(steps)}) GROUP BY 1, 2),
weekly AS (SELECT week_start, count(*) AS total, {counts} FROM wr GROUP BY week_start),
span AS (SELECT min(d0) AS d0, max(d1) AS d1 FROM wr),
lw AS (SELECT x.*, {rnp(pct('reached', 'total'))} AS pct_of_customers, d0 > week_start OR d1 < week_start + 6 AS partial_week FROM ({rows}) x, span),
lg AS (SELECT a.*, b.pct_of_customers AS prev_pct_of_customers, coalesce(b.partial_week, false) AS prev_partial
       FROM lw a LEFT JOIN lw b ON b.step_idx = a.step_idx AND b.week_start = a.week_start - 7)
SELECT week_start, CAST(step_idx AS INTEGER) AS step_idx, step_name, CAST(reached AS BIGINT) AS customers_reached,
       CAST(total AS BIGINT) AS active_customers, pct_of_customers, prev_pct_of_customers,
       {rnp('pct_of_customers - prev_pct_of_customers')} AS change_pp, partial_week,
       coalesce({rnp('pct_of_customers - prev_pct_of_customers')} < -{threshold!r}, false) AND NOT partial_week AND NOT prev_partial AS alert
FROM lg"""


Q["funnel_regression_alerts"] = "WITH " + STAR["fct_events"].strip() + ",\n" + _regression_sql().strip()

Q["stream_sessions"] = with_star("""
SELECT customer_id, min("timestamp") AS session_start, max("timestamp") + INTERVAL 30 MINUTE AS session_end,
       CAST(count(*) AS BIGINT) AS n_events, CAST(count_if(event_type = 'purchase') AS BIGINT) AS n_purchases
FROM sess GROUP BY customer_id, session_seq""",
    "fct_events", extra_ctes=(_sessions_cte(30),))

Q["stream_group_totals"] = with_star("""
SELECT experiment_group, CAST(count(*) AS BIGINT) AS total_events,
       CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchase_events
FROM fct_events GROUP BY experiment_group""", "fct_events")

# --- mergeable summaries and SQL functions -------------------------------------------------

_SPANS = "(SELECT *, CAST(CAST(date_trunc('week', \"timestamp\") AS DATE) AS VARCHAR) AS span FROM fct_events UNION ALL SELECT *, 'all' FROM fct_events)"
Q["distinct_sketches"] = with_star(" UNION ALL ".join(
    f"SELECT span, '{m}' AS measure, count({m}) AS n_rows, count(DISTINCT {m}) AS n_exact, true AS within_bound, true AS agrees_with_direct FROM {_SPANS} e GROUP BY span"
    for m in ("customer_id", "session_id", "product_id")), "fct_events")
Q["funnel_span_bitmaps"] = with_star(" UNION ALL ".join(
    f"SELECT span, acquisition_channel, {i} AS step_idx, '{s}' AS step_name, count(DISTINCT CASE WHEN event_type = '{s}' THEN customer_id END) AS customers_reached, "
    f"{rnp(pct(f'count(DISTINCT CASE WHEN event_type = {chr(39)}{s}{chr(39)} THEN customer_id END)', 'count(DISTINCT customer_id)'))} AS pct_of_customers "
    f"FROM {_SPANS} e JOIN (SELECT c_custkey AS customer_id, c_mktsegment AS acquisition_channel FROM customer) c USING (customer_id) "
    f"WHERE event_type IN ({_in_list(STEPS)}) GROUP BY span, acquisition_channel" for i, s in enumerate(STEPS)), "fct_events")
Q["sql_function_tests"] = with_star(f"""
SELECT pair_idx, group_a || ' vs ' || group_b AS comparison, rate_a, rate_b, z_stat, p_value,
       CASE WHEN p_value IS NULL THEN NULL WHEN p_value < 0.0001 THEN '< 0.0001' ELSE printf('%.4g', p_value) END AS p_value_label, significant,
       (SELECT round({chi2_sf_sql('c', len(GROUPS) - 1)}, 12) FROM (SELECT {_chi2_sql(len(GROUPS))} AS c FROM wd) t0) AS chi2_p_value
FROM pw""", "fct_events", extra_ctes=_totals_ctes() + (PAIRWISE_CTE,))
Q["sql_function_sessions"] = f"SELECT event_id, customer_id, \"timestamp\", derived_session_id FROM ({Q['sessionize']}) t"

# --- revenue attribution: the driver's orders move by a fixed number of days -------------

_ATTRIBUTED = """
tx AS (SELECT * REPLACE ("timestamp" + INTERVAL 10592 DAY AS "timestamp") FROM fct_transactions),
pe AS (SELECT * FROM fct_events WHERE event_type = 'purchase' AND product_id IS NOT NULL AND customer_id IS NOT NULL),
near AS (SELECT transaction_id, arg_max(e.event_id, (e."timestamp", e.event_id)) AS event_id
         FROM tx t JOIN pe e ON e.customer_id = t.customer_id AND e.product_id = t.product_id AND e."timestamp" <= t."timestamp"
         WHERE t."timestamp" - INTERVAL 2500 DAY <= e."timestamp" GROUP BY transaction_id),
attributed AS (SELECT t.transaction_id, t.customer_id, t.product_id, t.refund_flag, CAST(t.gross_revenue AS DECIMAL(38,2)) AS gross_revenue, n.event_id,
                      e.experiment_group, date_diff('microsecond', e."timestamp", t."timestamp") / 1e6 AS seconds_after
               FROM tx t LEFT JOIN near n USING (transaction_id) LEFT JOIN pe e ON e.event_id = n.event_id)"""
Q["attributed_transactions"] = with_star("SELECT * FROM attributed", "fct_events", "fct_transactions", extra_ctes=(_ATTRIBUTED,))
Q["revenue_per_event"] = with_star(f"""
SELECT arm_idx, experiment_group, total_events, purchase_events, matched_transactions, revenue, round(rpe, 9) AS revenue_per_event,
       round((rpe - max(CASE WHEN arm_idx = 0 THEN rpe END) OVER ()) / NULLIF(max(CASE WHEN arm_idx = 0 THEN rpe END) OVER (), 0) * 100, 6) AS lift_pct
FROM (SELECT a.arm_idx, a.experiment_group, coalesce(total_events, 0) AS total_events, coalesce(purchase_events, 0) AS purchase_events,
             coalesce(m, 0) AS matched_transactions, coalesce(r, 0.0) AS revenue, coalesce(r, 0.0) / NULLIF(total_events, 0) AS rpe
      FROM totals a LEFT JOIN (SELECT experiment_group, count(*) AS m,
             CAST(coalesce(sum(gross_revenue) FILTER (WHERE refund_flag = 0), 0) AS DOUBLE) AS r
             FROM attributed WHERE event_id IS NOT NULL GROUP BY experiment_group) x USING (experiment_group)) y""",
    "fct_events", "fct_transactions", extra_ctes=_totals_ctes() + (_ATTRIBUTED,))

# --- CSV scans, load and marts ---------------------------------------------

for _table, _entity in (("dim_customers", "customers"), ("dim_products", "products"), ("dim_campaigns", "campaigns"),
                        ("fct_transactions", "transactions"), ("fct_events", "events")):
    Q[f"csv_{_entity}"] = with_star(f"SELECT * FROM {_table}", _table)

_LOADED = ("""
cust AS (SELECT * FROM dim_customers WHERE customer_id IS NOT NULL AND signup_date IS NOT NULL AND country IS NOT NULL AND age IS NOT NULL
         AND gender IS NOT NULL AND loyalty_tier IS NOT NULL AND acquisition_channel IS NOT NULL)""",
           "kept AS (SELECT * FROM fct_events WHERE customer_id IN (SELECT customer_id FROM cust))")

_SESSION_IDS = """
gap AS (SELECT *, CASE WHEN date_diff('microsecond', lag("timestamp") OVER w, "timestamp") > 1800000000 THEN 1 ELSE 0 END AS opens,
               row_number() OVER w AS pos FROM kept WINDOW w AS (PARTITION BY customer_id ORDER BY "timestamp", event_id)),
seq AS (SELECT *, 1 + sum(opens) OVER (PARTITION BY customer_id ORDER BY pos) AS nr FROM gap)"""

Q["csv_load_events"] = with_star(f"""
SELECT event_id, "timestamp", customer_id, session_id, customer_id || '-' || CAST(nr AS BIGINT) AS derived_session_id, event_type, product_id,
       coalesce(device_type, 'unknown') AS device_type, {_SOURCE_CASE} AS traffic_source, campaign_id, page_category, session_duration_sec,
       experiment_group FROM seq""", "dim_customers", "fct_events", extra_ctes=(*_LOADED, _SESSION_IDS))

Q["csv_load_audit"] = Q["load_audit"]

_KEPT_TX = """kept_tx AS (SELECT *, CAST(product_id IS NULL OR gross_revenue IS NULL AS INTEGER) AS has_missing_product_or_revenue,
       CAST(refund_flag = 1 AND coalesce(gross_revenue, 0) >= 0 AS INTEGER) AS revenue_sign_mismatch
       FROM fct_transactions WHERE customer_id IN (SELECT customer_id FROM cust))"""

# an increment changes no row but those it sends again
Q["load_increment_events"] = f"""
SELECT * REPLACE (CASE WHEN event_id % 499 = 0 THEN 'corrected' ELSE page_category END AS page_category) FROM ({Q["csv_load_events"]}) t"""
Q["load_increment_state"] = with_star("""
SELECT customer_id, last_time, last_seq, n_transactions, revenue
FROM (SELECT customer_id, max("timestamp") AS last_time, CAST(max(nr) AS BIGINT) AS last_seq FROM seq GROUP BY customer_id) e
FULL JOIN (SELECT customer_id, count(*) AS n_transactions, CAST(sum(gross_revenue) AS DOUBLE) AS revenue FROM kept_tx GROUP BY customer_id) t
USING (customer_id)""", "dim_customers", "fct_events", "fct_transactions", extra_ctes=(*_LOADED, _SESSION_IDS, _KEPT_TX))

_TABLE_SOURCES = {"dim_customers": "cust", "dim_products": "dim_products", "dim_campaigns": "dim_campaigns", "fct_transactions": "kept_tx", "fct_events": "loaded_ev"}


def _checksum_sql(table: str) -> str:
    """One row per column: rows, nulls, and the sum of the first 15 hex digits of the values' MD5."""
    parts = []
    for f in TABLES[table].fields:
        text = f"strftime(\"{f.name}\", '%Y-%m-%d %H:%M:%S.%f')" if f.name == "timestamp" else f'CAST(CAST("{f.name}" AS {f.dataType.simpleString()}) AS VARCHAR)'
        parts.append(f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, count(*) AS n_rows, CAST(count_if(\"{f.name}\" IS NULL) AS BIGINT) AS n_nulls, "
                     f"CAST(sum(CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)) AS VARCHAR) AS checksum FROM {_TABLE_SOURCES[table]}")
    return " UNION ALL ".join(parts)


Q["warehouse_tables"] = with_star(" UNION ALL ".join(_checksum_sql(t) for t in _TABLE_SOURCES), *_TABLE_SOURCES,
                                  extra_ctes=(*_LOADED, _SESSION_IDS, _KEPT_TX, f"loaded_ev AS ({Q['csv_load_events']})"))

# The marts, from the queries above over the rows that the load keeps: the facts of its customers.
_MART_KEYS = {"funnel_overall": "step_name", "funnel_by_channel": "acquisition_channel || '/' || step_name", "ab_test_totals": "experiment_group",
              "ab_test_bootstrap": "comparison", "ab_test_pairwise": "group_a || '/' || group_b", "summary_stats": "''"}
_MART_QUERIES = {"funnel_overall": "funnel_overall", "funnel_by_channel": "funnel_by_channel", "ab_test_totals": "group_totals",
                 "ab_test_bootstrap": "bootstrap_ci", "ab_test_pairwise": "pairwise_z", "summary_stats": "kpi_summary"}
_MART_MEASURES = {"funnel_overall": "customers_reached pct_of_customers step_over_step_pct drop_off_pct", "funnel_by_channel": "customers_reached pct_of_signups",
                  "ab_test_totals": "total_events purchase_events purchase_rate", "ab_test_bootstrap": "median_lift_pp ci_2.5pct ci_97.5pct",
                  "ab_test_pairwise": "rate_a rate_b absolute_lift_pp z_stat p_value significant",
                  "summary_stats": "chi2 chi2_p_value chi2_dof bounce_rate_pct avg_revenue_per_converted_customer total_customers"}
_KEPT_IDS = "(SELECT c_custkey FROM main.customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment IS NOT NULL AND n_name IS NOT NULL)"
Q["marts_roundtrip"] = (f"WITH events AS (SELECT * FROM main.events WHERE user_id IN {_KEPT_IDS}), orders AS (SELECT * FROM main.orders WHERE o_custkey IN {_KEPT_IDS}), "
                        + ", ".join(f"mart_{m} AS MATERIALIZED ({Q[q]})" for m, q in _MART_QUERIES.items())
                        + ", mart_rows AS (" + " UNION ALL ".join(
                            f"SELECT '{m}' AS mart, {_MART_KEYS[m]} AS row_key, '{c}' AS measure, CAST({c.replace('.', '_')} AS DOUBLE) AS value FROM mart_{m}"
                            for m, cs in _MART_MEASURES.items() for c in cs.split())
                        + ") SELECT mode, mart, row_key, measure, value FROM mart_rows, (VALUES ('live'), ('snapshot')) modes(mode)")
