"""The five analytical questions as SQL text, run by ``spark.sql`` over temp views
of the star schema (``star.register_views``), and the campaign-window variant (E4).

Percents are computed in DOUBLE (``100D``) so the rounded value does not depend on
an engine's DECIMAL rules; the campaign top ten breaks ties by ``campaign_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.config import Profile
from kestrel.functions import sql_functions
from kestrel.sources.star import register_views

LIFECYCLE_FUNNEL = """
SELECT count_if(viewed) AS view_count, count_if(clicked) AS click_count, count_if(added) AS add_to_cart_count,
       count_if(bought) AS purchase_count, count(*) AS total_customers
FROM (SELECT customer_id, bool_or(event_type <=> 'view') AS viewed, bool_or(event_type <=> 'click') AS clicked,
             bool_or(event_type <=> 'add_to_cart') AS added, bool_or(event_type <=> 'purchase') AS bought
      FROM fct_events GROUP BY customer_id)
"""

CHANNEL_PURCHASE = """
SELECT acquisition_channel, customers, ever_purchased,
       round(100D * ever_purchased / customers, 2) AS pct_ever_purchased
FROM (SELECT acquisition_channel, count(*) AS customers, count_if(buyer) AS ever_purchased
      FROM (SELECT customer_id, bool_or(event_type <=> 'purchase') AS buyer FROM fct_events GROUP BY customer_id)
      JOIN dim_customers USING (customer_id)
      GROUP BY acquisition_channel)
ORDER BY pct_ever_purchased DESC, acquisition_channel
"""

GROUP_PURCHASE_RATE = """
SELECT arm.experiment_group, arm.total_events, arm.purchase_events,
       round(100D * arm.purchase_events / arm.total_events, 3) AS purchase_rate_pct
FROM (SELECT experiment_group, count(1) AS total_events, count(1) FILTER (WHERE event_type = 'purchase') AS purchase_events
      FROM fct_events GROUP BY ALL) arm
ORDER BY 1
"""

REVENUE_PER_CONVERTED = """
WITH paid AS (SELECT customer_id AS who, gross_revenue AS amount FROM fct_transactions WHERE refund_flag = 0),
     lifetime AS (SELECT who, sum(amount) AS amount FROM paid WHERE amount IS NOT NULL GROUP BY who)
SELECT round(double(avg(amount)), 2) AS avg_revenue_per_converted_customer FROM lifetime
"""

# events counted per campaign first, so the join meets one row per campaign
CAMPAIGN_PERFORMANCE = """
WITH hits AS (SELECT campaign_id, count(*) AS n, count_if(event_type = 'purchase') AS bought
              FROM fct_events WHERE campaign_id <> 0 GROUP BY campaign_id)
SELECT campaign_id, d.channel, d.objective, double(d.expected_uplift) AS expected_uplift,
       hits.n AS attributed_events, hits.bought AS attributed_purchases,
       round(100D * hits.bought / hits.n, 3) AS purchase_rate_pct
FROM hits JOIN dim_campaigns d USING (campaign_id)
ORDER BY round(100D * hits.bought / hits.n, 3) DESC, campaign_id
LIMIT 10
"""

CAMPAIGN_ACTIVE_WINDOW = """
WITH daily AS (SELECT campaign_id, to_date(`timestamp`) AS day, count(*) AS n, count_if(event_type = 'purchase') AS bought
               FROM fct_events WHERE campaign_id <> 0 GROUP BY ALL),
     live AS (SELECT d.campaign_id, any_value(d.channel) AS channel, any_value(d.objective) AS objective,
                     double(any_value(d.expected_uplift)) AS target, sum(n) AS n, sum(bought) AS bought
              FROM daily JOIN dim_campaigns d ON d.campaign_id = daily.campaign_id AND day >= d.start_date AND day <= d.end_date
              GROUP BY d.campaign_id)
SELECT campaign_id, channel, objective, target AS expected_uplift, n AS attributed_events, bought AS attributed_purchases,
       round(100D * bought / n, 3) AS purchase_rate_pct, round(100D * bought / n - 100D * target, 3) AS rate_minus_target_pp
FROM live
ORDER BY purchase_rate_pct DESC, campaign_id
"""

QUERIES = {
    "sql_lifecycle_funnel": LIFECYCLE_FUNNEL,
    "sql_channel_purchase": CHANNEL_PURCHASE,
    "sql_group_purchase_rate": GROUP_PURCHASE_RATE,
    "sql_revenue_per_converted": REVENUE_PER_CONVERTED,
    "sql_campaign_performance": CAMPAIGN_PERFORMANCE,
    "campaign_active_window": CAMPAIGN_ACTIVE_WINDOW,
}


def run_sql(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register_views(spark, sf_dir)
    return spark.sql(QUERIES[name])


FUNCTION_TESTS = """
SELECT pair_idx, concat_ws(' vs ', group_a, group_b) AS comparison, rate_a, rate_b, z_stat, p_value, p_label(p_value) AS p_value_label, significant,
       (SELECT round(chi_square_p(chi2, dof), 12)
        FROM (SELECT sum(pow(x - e, 2) / e + pow(x - e, 2) / (n - e)) AS chi2, CAST(count(*) - 1 AS INT) AS dof
              FROM (SELECT n, x, n * sum(x) OVER () / sum(n) OVER () AS e
                    FROM (SELECT CAST(total_events AS DOUBLE) AS n, CAST(purchase_events AS DOUBLE) AS x FROM arm_totals)))) AS chi2_p_value
FROM arm_tests(:alpha)
"""

FUNCTION_SESSIONS = "SELECT event_id, customer_id, `timestamp`, derived_session_id FROM customer_sessions(:gap_minutes)"


def _with_functions(spark: SparkSession, totals: DataFrame, events: DataFrame) -> None:
    totals.createOrReplaceTempView("arm_totals")
    events.createOrReplaceTempView("fct_events")
    sql_functions.register(spark)


def run_function_tests(spark: SparkSession, totals: DataFrame, events: DataFrame, profile: Profile) -> DataFrame:
    _with_functions(spark, totals, events)
    return spark.sql(FUNCTION_TESTS, args={"alpha": profile.alpha})


def run_function_sessions(spark: SparkSession, totals: DataFrame, events: DataFrame, profile: Profile) -> DataFrame:
    _with_functions(spark, totals, events)
    return spark.sql(FUNCTION_SESSIONS, args={"gap_minutes": float(profile.gap_minutes)})
