"""Experiment statistics: hand-derived cases, published goldens and traps."""

import math

import pytest

from kestrel.operators import experiment

GROUPS = ("Control", "Variant_A", "Variant_B")
SCHEMA = "customer_id long, experiment_group string, total_events long, purchase_events long"
#: (arm, events, purchases) over uneven customers; pooled rates chosen so that the statistics are short fractions.
ARMS = [(11, "Control", 30, 3), (12, "Control", 370, 37), (11, "Variant_A", 400, 40), (13, "Variant_B", 1, 1), (14, "Variant_B", 399, 79)]


def totals_of(spark, rows):
    return experiment.group_totals(spark.createDataFrame(rows, SCHEMA), GROUPS)


def test_totals_add_up_over_customers_in_several_arms(spark):
    got = [(r.experiment_group, r.total_events, r.purchase_events, r.purchase_rate) for r in totals_of(spark, ARMS).orderBy("arm_idx").collect()]
    assert got == [("Control", 400, 40, 0.1), ("Variant_A", 400, 40, 0.1), ("Variant_B", 400, 80, 0.2)]


def test_pairs_by_hand(spark):
    """10 % against 20 % of 400 each: pool 0.15, se = sqrt(0.15 * 0.85 / 200), z = 0.1 / se."""
    z = 0.1 / math.sqrt(0.15 * 0.85 / 200)
    got = {(r.group_a, r.group_b): r for r in experiment.pairwise_tests(totals_of(spark, ARMS), GROUPS, alpha=0.03).collect()}
    same, up = got[("Control", "Variant_A")], got[("Variant_A", "Variant_B")]
    assert (same.z_stat, same.p_value, same.significant) == (0.0, pytest.approx(1.0), False)
    assert up.z_stat == pytest.approx(z, abs=1e-8) and up.p_value == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-6)
    assert up.significant and up.absolute_lift_pp == pytest.approx(10.0) and up.bonferroni_alpha == pytest.approx(0.01)
    back = experiment.two_proportion_test(totals_of(spark, ARMS), "Variant_B", "Control").first()
    assert back.z_stat == pytest.approx(-z, abs=1e-8)


def test_chi_square_by_hand(spark):
    """Expected 160/3 purchases and 1040/3 others per arm: chi2 = 9600/9 * (3/160 + 3/1040) * ... = 24 + 48/13."""
    e, f = 160 / 3, 1040 / 3
    chi2 = sum((x - e) ** 2 * (1 / e + 1 / f) for x in (40, 40, 80))
    r = experiment.chi_square_test(totals_of(spark, ARMS), GROUPS).first()
    assert (r.dof, r.chi2, r.p_value) == (2, pytest.approx(chi2, abs=1e-8), pytest.approx(math.exp(-chi2 / 2), rel=1e-5))


PUBLISHED = [(1, "Control", 1198404, 56855), (2, "Variant_A", 401413, 21045), (3, "Variant_B", 400183, 25227)]


def test_published_goldens(spark):
    """The six published arm totals reproduce the published chi-square and z statistics."""
    t = totals_of(spark, PUBLISHED)
    chi = experiment.chi_square_test(t, GROUPS).collect()[0]
    assert chi.chi2 == pytest.approx(1499.8498794507525, abs=1e-6)
    assert chi.p_value == pytest.approx(0.0, abs=1e-12)
    z = {(r.group_a, r.group_b): r.z_stat for r in experiment.pairwise_tests(t, GROUPS).collect()}
    assert z[("Control", "Variant_A")] == pytest.approx(12.70096015595637, abs=1e-6)
    assert z[("Control", "Variant_B")] == pytest.approx(38.70592198657145, abs=1e-6)
    assert z[("Variant_A", "Variant_B")] == pytest.approx(20.367984007933906, abs=1e-6)
    rates = {r.experiment_group: r.purchase_rate for r in t.collect()}
    assert rates["Control"] == pytest.approx(0.04744226487895568, rel=1e-12)


@pytest.mark.parametrize("purchases", [0, 100])
def test_no_variation_in_the_outcome(spark, purchases):
    t = totals_of(spark, [(i, g, 100, purchases) for i, g in enumerate(GROUPS)])
    for r in experiment.pairwise_tests(t, GROUPS).collect():
        assert r.z_stat == 0.0 and r.p_value == pytest.approx(1.0) and not r.significant
    chi = experiment.chi_square_test(t, GROUPS).first()
    assert chi.chi2 is None and chi.p_value is None and chi.dof == 2


def test_unlisted_and_missing_arms(spark):
    t = totals_of(spark, [(1, "Control", 100, 5), (2, "Variant_A", 100, 7), (3, "Mystery", 100, 50)])
    rows = {r.experiment_group: r for r in t.collect()}
    assert set(rows) == set(GROUPS) and rows["Variant_B"].total_events is None
    chi = experiment.chi_square_test(t, GROUPS).first()
    assert chi.chi2 is None and chi.p_value is None
    pairs = {(r.group_a, r.group_b): r for r in experiment.pairwise_tests(t, GROUPS).collect()}
    assert pairs[("Control", "Variant_A")].z_stat is not None
    for pair in (("Control", "Variant_B"), ("Variant_A", "Variant_B")):
        assert (pairs[pair].z_stat, pairs[pair].p_value, pairs[pair].significant) == (None, None, None)


def test_an_arm_without_events(spark):
    t = totals_of(spark, [(1, "Control", 0, 0), (2, "Variant_A", 10, 7), (3, "Variant_B", 10, 2)])
    assert [r.purchase_rate for r in t.orderBy("arm_idx").collect()] == [None, 0.7, 0.2]
    assert experiment.chi_square_test(t, GROUPS).first().chi2 is None
    assert experiment.two_proportion_test(t, "Control", "Variant_A").first().z_stat is None


def test_report_labels(spark):
    rep = {r.comparison: r for r in experiment.experiment_report(experiment.pairwise_tests(totals_of(spark, ARMS), GROUPS)).collect()}
    assert (rep["Control vs Variant_A"].p_value_label, rep["Control vs Variant_A"].significant_bonferroni) == ("1", "No")
    assert (rep["Control vs Variant_B"].p_value_label, rep["Control vs Variant_B"].lift_pp) == ("< 0.0001", 10.0)


def test_sample_ratio(spark):
    t = totals_of(spark, [(1, "Control", 600, 1), (2, "Variant_A", 200, 1), (3, "Variant_B", 200, 1)])
    r = experiment.sample_ratio_test(t, GROUPS, (0.6, 0.2, 0.2)).first()
    assert r.chi2 == 0.0 and r.p_value == pytest.approx(1.0)
    r = experiment.sample_ratio_test(t, GROUPS, (1, 1, 1)).first()
    assert r.chi2 == pytest.approx(320.0)  # (600 - 1000/3)^2 and twice (200 - 1000/3)^2, over 1000/3


def test_kpi_row_without_purchases(spark):
    from kestrel.plans import reports
    ev = spark.createDataFrame([(1, "view", "Control"), (2, "bounce", "Variant_A"), (2, "view", "Variant_B")],
                               "customer_id long, event_type string, experiment_group string")
    tx = spark.createDataFrame([], "customer_id long, refund_flag int, gross_revenue decimal(10,2)")
    r = reports.kpi_summary(ev, tx).first()
    assert r.chi2 is None and r.bounce_rate_pct == pytest.approx(33.33) and r.ever_purchased == 0 and r.avg_revenue_per_converted_customer is None
