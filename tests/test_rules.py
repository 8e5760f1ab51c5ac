"""Each business rule on rows that break it."""

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tieout.plans import Lending, Revenue, Visits, Workforce


def more(rows, **tables):
    return {**rows, **{name: [*rows[name], *extra] for name, extra in tables.items()}}


def revenue(spark, **tables):
    return Revenue(fx.feeds(spark, "revenue", more(fx.REVENUE, **tables)))


def lending(spark, **tables):
    return Lending(fx.feeds(spark, "lending", more(fx.LENDING, **tables)))


def visits(spark):
    return Visits(fx.feeds(spark, "visits", fx.VISITS))


def workforce(spark):
    return Workforce(fx.feeds(spark, "workforce", fx.WORKFORCE))


def changed(project, model, **columns):
    """The project with a model as a faulty build might have left it."""
    project.pin(model, project.model(model).withColumns(columns))
    return project


def test_refunds_above_their_payment(spark):
    assert revenue(spark).no_over_refunding.count() == 0
    got = revenue(spark, refunds=[fx.refund(2, 4, "p4", 31, "2025-02-04")]).no_over_refunding.collect()
    assert [(r.payment_id, r.payment_amount, r.total_refunded) for r in got] == [("p4", fx.money(50), fx.money(51))]


def test_repeated_settlements_that_count(spark):
    faulty = changed(revenue(spark), "int_payments_deduped", is_duplicate_settlement=F.lit(False))
    got = faulty.no_duplicate_settlements_counted_in_revenue.collect()
    assert [(r.order_id, r.non_duplicate_succeeded_payments) for r in got] == [("5", 2)]


def test_a_mart_off_the_ledger(spark):
    assert revenue(spark).net_revenue_ties_to_raw_ledger.count() == 0
    one_off = F.when(F.col("order_id") == "1", F.col("net_revenue") + 7).otherwise(F.col("net_revenue")).cast("decimal(38,2)")
    row = changed(revenue(spark), "fct_revenue", net_revenue=one_off).net_revenue_ties_to_raw_ledger.first()
    assert row.mart_net_revenue - row.ledger_net_revenue == 7 == row["diff"]


def test_instalments_paid_above_their_amount(spark):
    over = fx.posting("F1", "F", 1, "posted", "2025-02-01", 150, "2025-02-01")
    within = fx.posting("F2", "F", 2, "posted", "2025-03-01", 101, "2025-03-01")
    got = lending(spark, repayments=[over, within]).no_overpayment_per_instalment.collect()
    assert [(r.loan_id, r.instalment_no, r.amount_paid) for r in got] == [("F", 1, fx.money(150))]


def test_postings_counted_twice(spark):
    faulty = changed(lending(spark), "int_repayments_deduped", is_duplicate_posting=F.lit(False))
    got = faulty.no_duplicate_postings_counted_twice.collect()
    assert [(r.loan_id, r.instalment_no, r.non_duplicate_postings) for r in got] == [("E", 1, 2)]


def test_a_risk_bridge_that_does_not_tie(spark):
    for side in ("bridged_par30_loans", "true_par90_loans"):
        faulty = changed(lending(spark), "fct_par_reconciliation_bridge", **{side: F.col(side) + 1})
        assert {r.product_type for r in faulty.bridge_ties_to_true_par.collect()} == {"personal", "ALL"}


def test_more_risk_reported_than_true(spark):
    faulty = changed(lending(spark), "fct_par_reconciliation_bridge", reported_par_loans=F.col("true_par30_loans") + 1)
    got = faulty.true_par_meets_or_exceeds_reported_par.collect()
    assert [(r.product_type, r.reported_par_loans - r.true_par30_loans) for r in got] == [("ALL", 1)]


@pytest.mark.parametrize("status", [None, "lost"])
def test_rows_without_a_known_outcome(spark, status):
    odd = F.when(F.col("appointment_id") == "4", F.lit(status)).otherwise(F.col("canonical_status"))
    got = changed(visits(spark), "int_appointments_canonical", canonical_status=odd).every_row_has_one_canonical_status.collect()
    assert [(r.appointment_id, r.canonical_status) for r in got] == [("4", status)]


def test_departments_that_do_not_add_up(spark):
    assert workforce(spark).department_headcount_sums_to_company_total.count() == 0
    total = F.col("active_headcount") + F.when(F.col("department_name") == "ALL", 1).otherwise(0)
    row = changed(workforce(spark), "fct_department_workforce", active_headcount=total).department_headcount_sums_to_company_total.first()
    assert row.company_headcount - row.dept_sum == 1


def test_headcount_off_the_person_mart(spark):
    assert workforce(spark).department_headcount_matches_workforce.count() == 0
    total = F.col("active_headcount") + 1
    row = changed(workforce(spark), "fct_department_workforce", active_headcount=total).department_headcount_matches_workforce.first()
    assert row.company_headcount != row.active_people


def test_exits_that_do_not_tie(spark):
    assert workforce(spark).bridge_ties_to_true_genuine_exits.count() == 0
    off = F.col("bridged_true_genuine_exits") - 1
    row = changed(workforce(spark), "fct_attrition_tenure_reconciliation_bridge", bridged_true_genuine_exits=off)
    row = row.bridge_ties_to_true_genuine_exits.first()
    assert row.true_genuine_exit_count - row.bridged_true_genuine_exits == 1
