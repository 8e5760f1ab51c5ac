"""The four projects on hand-written feeds."""

import datetime as dt
from decimal import Decimal

import pytest

from tests import fixtures as fx
from tieout.operators import resolve_chains
from tieout.plans import Lending, Revenue, Visits, Workforce

D = Decimal


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def revenue(spark):
    return Revenue(fx.feeds(spark, "revenue", fx.REVENUE))


@pytest.fixture(scope="module")
def lending(spark):
    return Lending(fx.feeds(spark, "lending", fx.LENDING))


@pytest.fixture(scope="module")
def visits(spark):
    return Visits(fx.feeds(spark, "visits", fx.VISITS))


@pytest.fixture(scope="module")
def workforce(spark):
    return Workforce(fx.feeds(spark, "workforce", fx.WORKFORCE))


def test_payment_repeats_are_flagged_and_kept(revenue):
    rows = by(revenue.int_payments_deduped, "payment_id")
    assert len(rows) == 7
    assert [p for p, r in rows.items() if r["is_duplicate_settlement"]] == ["p5b"]


def test_revenue_per_order(revenue):
    rows = by(revenue.fct_revenue, "order_id")
    money = {o: (r["gross_revenue"], r["net_revenue"], r["cancellation_leakage_amount"]) for o, r in rows.items()}
    assert money == {
        "1": (100, 100, 0),
        "2": (80, 80, 0),
        "3": (60, 60, 60),
        "4": (50, 30, 30),
        "5": (40, 40, 0),
        "6": (0, 0, 0),
    }
    assert rows["5"]["duplicate_payment_amount"] == 40
    assert rows["6"]["revenue_recognition_month"] is None and rows["6"]["was_delivered"] is None


def test_monthly_revenue(revenue):
    (row,) = revenue.fct_revenue_monthly.collect()
    assert row.report_month == dt.date(2025, 1, 1)
    assert (row.gross_revenue, row.net_revenue, row.refunds_same_month) == (330, 310, 0)
    assert row.refund_rate == pytest.approx(20 / 330)
    assert (row.orders_with_payment_activity, row.leakage_order_count) == (5, 2)


def test_revenue_bridge_and_its_residual(revenue):
    (row,) = revenue.fct_revenue_reconciliation_bridge.collect()
    assert (row.ops_number, row.wip_charged_not_shipped, row.cancellation_leakage) == (140, 80, 90)
    assert (row.duplicate_payments_excluded, row.cohort_lifetime_refunds) == (40, 20)
    assert (row.refunds_recognized_in_later_month, row.finance_reconciled_number) == (20, 250)
    assert row.unexplained_residual == 60
    assert revenue.bridge_ties_to_fct_revenue.first().diff == 60
    assert revenue.net_revenue_ties_to_raw_ledger.isEmpty()
    assert revenue.no_over_refunding.isEmpty()
    assert revenue.no_duplicate_settlements_counted_in_revenue.isEmpty()


def test_loans(lending):
    rows = by(lending.fct_loan_performance, "loan_id")
    seen = {
        k: (r["true_dpd"], r["risk_bucket"], r["outstanding_balance_estimate"], r["is_hidden_restructure_risk"])
        for k, r in rows.items()
    }
    assert seen == {
        "A": (0, "current", 900, False),
        "B": (121, "90_plus_dpd", 900, True),
        "C": (46, "30-89_dpd", 1000, False),
        "D": (0, "current", 940, False),
        "E": (0, "current", 900, False),
    }
    assert rows["D"]["cumulative_partial_shortfall"] == 40 and rows["D"]["is_reported_defaulted"]


def test_par_bridge_is_an_identity(lending):
    rows = by(lending.fct_par_reconciliation_bridge, "product_type")
    assert set(rows) == {"personal", "ALL"}
    for row in rows.values():
        assert (row["active_loan_count"], row["reported_par_loans"]) == (5, 1)
        assert (row["bridged_par30_loans"], row["true_par30_loans"]) == (2, 2)
        assert (row["bridged_par90_loans"], row["true_par90_loans"]) == (1, 1)
        assert (row["true_par30_rate"], row["reported_par_rate"]) == (0.4, 0.2)
        assert row["par30_understatement_pct"] == 1.0
    metrics = by(lending.fct_portfolio_metrics, "product_type")["ALL"]
    assert metrics["partial_payment_rate"] == pytest.approx(1 / 6)
    assert lending.bridge_ties_to_true_par.isEmpty()
    assert lending.true_par_meets_or_exceeds_reported_par.isEmpty()


def test_register_takes_the_latest_entry(spark):
    entries = [
        fx.flagged("d1", "L", "2025-03-01", "open"),
        fx.flagged("d3", "L", "2025-04-01", "In_Recovery", "fraud", 300),
        fx.flagged("d2", "L", "2025-04-01", "written_off"),
        fx.flagged("d9", "L", None, "lost"),
    ]
    (row,) = Lending(fx.feeds(spark, "lending", {"defaults": entries})).int_loan_register_status.collect()
    assert (row.register_entry_count, row.most_recent_default_status) == (4, "in_recovery")
    assert (row.most_recent_default_reason, row.outstanding_at_default) == ("fraud", 300)


def test_unknown_posting_status_is_kept_unflagged(spark):
    rows = [
        fx.posting("1", "L", 1, None, "2025-01-01", 5, "2025-01-01"),
        fx.posting("2", "L", 1, "reversed", "2025-01-02", 5, "2025-01-01"),
        fx.posting("3", "L", 1, "posted", "2025-01-01", 100, None),
        fx.posting("4", "L", 1, "partial", "2025-01-01", 50, "2025-01-09"),
    ]
    lending = Lending(fx.feeds(spark, "lending", {"repayments": rows}))
    flags = {r.repayment_id: r.is_duplicate_posting for r in lending.int_repayments_deduped.collect()}
    assert flags == {"1": False, "2": False, "3": True, "4": False}  # a missing time sorts last
    (loan,) = lending.int_loan_delinquency.collect()
    assert (loan.instalments_due_count, loan.instalments_partial_count) == (1, 1)
    assert (loan.cumulative_amount_paid, loan.cumulative_scheduled_amount) == (50, 300)


def test_visits(visits):
    rows = by(visits.int_appointments_canonical, "appointment_id")
    outcome = {k: (r["canonical_status"], r["is_duplicate_booking"]) for k, r in rows.items()}
    assert outcome == {
        "1": ("rescheduled", False),
        "2": ("attended", False),
        "3": ("cancelled", False),
        "4": ("no_show", False),
        "5": ("no_show", True),
        "6": ("unresolved", False),
    }
    chains = {
        r.logical_visit_id: (r.final_appointment_id, r.final_canonical_status, r.reschedule_count)
        for r in visits.int_appointment_chains.collect()
    }
    assert chains == {
        "1": ("2", "attended", 1),
        "3": ("3", "cancelled", 0),
        "4": ("4", "no_show", 0),
        "6": ("6", "unresolved", 0),
    }


def test_noshow_bridge(visits):
    rows = by(visits.fct_noshow_reconciliation_bridge, "location")
    assert set(rows) == {"main", "ALL"}
    for row in rows.values():
        assert (row["naive_all_rows"], row["naive_no_show_count"]) == (6, 4)
        assert (row["duplicate_no_show_rows"], row["reschedule_misflags"], row["cancel_misflags"]) == (1, 1, 1)
        assert (row["bridged_true_no_show_count"], row["true_no_show_count"]) == (1, 1)
        assert row["naive_no_show_rate"] == pytest.approx(4 / 6) and row["true_no_show_rate"] == 0.5
    assert visits.bridge_ties_to_fct_appointments.isEmpty()


def test_billing_flags(visits):
    rows = by(visits.billing_lines_flagged, "billing_id")
    assert {k: (r["is_unmatched_billing"], r["is_orphaned_billing"]) for k, r in rows.items()} == {
        "b1": (False, False),
        "b2": (False, True),
        "b3": (True, False),
    }
    assert [r.appointment_id for r in visits.int_billing_agg.collect()] == ["2"]
    visit = by(visits.fct_appointments, "logical_visit_id")["1"]
    assert visit["office_visit_billed"] == 90 and visit["has_no_show_fee_charge"] is False


def chain_of(n, first=1, patient="p9"):
    """Rows first..first+n-1, each moved to the next; the last is attended."""
    ids = range(first, first + n)
    return [
        fx.slot(
            i,
            patient,
            1 + i - first,
            "attended" if i == ids[-1] else "rescheduled",
            to=str(i + 1) if i != ids[-1] else None,
            back=str(i - 1) if i != first else None,
        )
        for i in ids
    ]


@pytest.mark.parametrize("n", [1, 2, 4, 5, 10, 14, 1000])
def test_chains_of_every_length(spark, n):
    visits = Visits(fx.feeds(spark, "visits", {"appointments": chain_of(n, 1000)}))
    (row,) = visits.int_appointment_chains.collect()
    assert (row.logical_visit_id, row.final_appointment_id) == ("1000", str(999 + n))
    assert (row.reschedule_count, row.final_canonical_status) == (n - 1, "attended")
    slots = sorted((r.hop_number, r.appointment_id) for r in visits.chain_membership.collect())
    assert slots == [(i + 1, str(1000 + i)) for i in range(n)]
    assert visits.no_double_counted_visit_intent.isEmpty()
    literal = {r.appointment_id for r in visits.no_double_counted_visit_intent_literal.collect()}
    assert literal == {str(1000 + i) for i in range(1, n - 1)}  # only middle rows


def test_chain_anomalies(spark):
    rows = chain_of(12, 100, "pa")
    rows += [fx.slot(1, "pb", 1, "rescheduled", to="2", back="2"), fx.slot(2, "pb", 2, "rescheduled", to="1", back="1")]
    rows += [fx.slot(3, "pc", 1, "rescheduled")]
    rows += [fx.slot(4, "pd", 1, "rescheduled", to="6"), fx.slot(5, "pd", 2, "rescheduled", to="6")]
    rows += [fx.slot(6, "pd", 3, "attended", back="4")]
    rows += [fx.slot(7, "pe", 1, "rescheduled", to="8"), fx.slot(8, "pe", 2, "rescheduled", to="9", back="9")]
    rows += [fx.slot(9, "pe", 3, "rescheduled", to="10", back="8"), fx.slot(10, "pe", 4, "rescheduled", to="8", back="9")]
    visits = Visits(fx.feeds(spark, "visits", {"appointments": rows}))
    found = {(r.appointment_id, r.anomaly) for r in visits.chain_anomalies.collect()}
    assert found == {
        ("7", "chain_ends_in_loop"),
        ("1", "not_in_any_chain"),
        ("2", "not_in_any_chain"),
        ("3", "unlinked_rescheduled"),
        ("6", "in_several_positions"),
    }
    places = {r.id: r.slot for r in visits.chains.members.collect() if r.root == "7"}
    assert places == {"7": 1, "8": 2, "9": 3, "10": 4}
    ends = {r.logical_visit_id: (r.final_appointment_id, r.reschedule_count) for r in visits.int_appointment_chains.collect()}
    assert (ends["7"], ends["100"]) == (("10", 3), ("111", 11))


def test_loops_entered_at_any_row(spark):
    """Two ways into one loop, a root that is part of a loop, a row that follows itself."""
    links = {"a": "c", "b": "e", "c": "d", "d": "e", "e": "c", "r": "s", "s": "r", "x": "x", "z": None}
    roots = {"a", "b", "r", "x", "z"}
    nodes = spark.createDataFrame([(k, v, k in roots) for k, v in links.items()], "id string, to string, root boolean")
    chains = resolve_chains(nodes, "id", "to", "root")
    paths = {}
    for r in sorted(chains.members.collect(), key=lambda r: r.slot):
        paths.setdefault(r.root, []).append(r.id)
    assert paths == {"a": list("acde"), "b": list("becd"), "r": list("rs"), "x": ["x"], "z": ["z"]}
    last = {r.root: (r.last, r.hops) for r in chains.terminal.collect()}
    assert last == {k: (p[-1], len(p) - 1) for k, p in paths.items()}
    assert {r.root for r in chains.looped.collect()} == {"a", "b", "r", "x"}


def test_linked_copy_wins_its_slot(spark):
    rows = [fx.slot(1, "p", 1, "no_show"), fx.slot(2, "p", 1, "no_show", to="3"), fx.slot(3, "p", 2, "attended", back="2")]
    visits = Visits(fx.feeds(spark, "visits", {"appointments": rows}))
    flags = {r.appointment_id: r.is_duplicate_booking for r in visits.int_appointments_deduped.collect()}
    assert flags == {"1": True, "2": False, "3": False}


def test_workforce_people(workforce):
    rows = by(workforce.fct_workforce, "person_id")
    days = {
        k: (r["tenure_time_in_seat_days"], r["tenure_since_first_hire_days"], r["current_stint_span_days"])
        for k, r in rows.items()
    }
    assert days == {"X": (730, 730, 305), "Y": (914, 1095, 152), "Z": (365, 365, 365)}
    assert rows["Y"]["rehire_gap_days_excluded"] == 181 and rows["Y"]["had_rehire"]
    assert rows["X"]["had_transfer"] and not rows["X"]["had_rehire"]
    assert rows["X"]["tenure_time_in_seat_years"] == D("2.00")
    assert workforce.rehire_rate.first().rehire_rate == pytest.approx(1 / 3)
    states = by(workforce.int_employment_chain_classified, "employee_id")
    assert states["2"]["is_status_date_conflict"] and states["2"]["resolved_state"] == "open"
    assert (states["4"]["gap_days_before"], states["1"]["resolved_state"]) == (181, "transferred_out")


def test_attrition_bridge(workforce):
    (row,) = workforce.fct_attrition_tenure_reconciliation_bridge.collect()
    assert (row.naive_record_closures, row.duplicate_closed_records, row.transfer_closure_count) == (4, 1, 1)
    assert (row.bridged_true_genuine_exits, row.true_genuine_exit_count) == (2, 2)
    assert (row.headcount_at_window_start, row.headcount_at_window_end, row.avg_headcount) == (3, 2, D("2.5"))
    assert (row.naive_finance_attrition_rate, row.true_attrition_rate) == (1.6, 0.8)
    assert workforce.bridge_ties_to_true_genuine_exits.isEmpty()


def test_departments(workforce):
    rows = by(workforce.fct_department_workforce, "department_name")
    flows = {k: (r["transfers_in"], r["transfers_out"], r["genuine_exits"], r["active_headcount"]) for k, r in rows.items()}
    assert flows == {"Dept D1": (0, 1, 1, 1), "Dept D2": (1, 0, 1, 1), "ALL": (1, 1, 2, 2)}
    for rule in (
        "transfers_net_to_zero_across_departments",
        "department_headcount_sums_to_company_total",
        "department_headcount_matches_workforce",
        "headcount_reconciles_to_distinct_active_people",
        "dangling_transfer",
    ):
        assert workforce.model(rule).isEmpty()


def test_payroll_and_reviews(workforce):
    rows = by(workforce.int_payroll_deduped, "payroll_id")
    assert {k: (r["is_duplicate_period"], r["is_orphaned_payroll"]) for k, r in rows.items()} == {
        "y1": (False, False),
        "y2": (True, False),
        "y3": (False, True),
        "y4": (False, True),
    }
    reviews = by(workforce.int_reviews_deduped, "review_id")
    assert [r["is_duplicate_review"] for _, r in sorted(reviews.items())] == [False, True]
    assert all(r["is_missing_review_date"] for r in reviews.values())


@pytest.mark.parametrize("cls", [Revenue, Lending, Visits, Workforce])
def test_empty_feeds(spark, cls):
    project = cls(fx.feeds(spark, cls.name, {}))
    rows = {m: project.model(m).count() for m in project.marts}
    totals = {"fct_portfolio_metrics", "fct_par_reconciliation_bridge", "fct_noshow_reconciliation_bridge"}
    totals |= {"fct_department_workforce", "fct_attrition_tenure_reconciliation_bridge"}
    assert rows == {m: int(m in totals) for m in project.marts}


def test_empty_book_has_a_zero_total(spark):
    lending = Lending(fx.feeds(spark, "lending", {}))
    (row,) = lending.fct_par_reconciliation_bridge.collect()
    assert (row.product_type, row.active_loan_count, row.true_par30_rate) == ("ALL", 0, None)


def test_risk_segments(spark):
    rows, i = [], 0
    plan = {"steady": "a" * 3, "one_of_three": "aan", "one_of_two": "an", "twice": "nnaaaaaa", "none": "c"}
    for patient, visits in plan.items():
        for day, kind in enumerate(visits, 1):
            i += 1
            status = {"a": "attended", "n": "missed", "c": "cancelled"}[kind]
            rows.append(fx.slot(i, patient, day, status))
    out = by(Visits(fx.feeds(spark, "visits", {"appointments": rows})).fct_patient_engagement, "patient_id")
    assert {p: r["no_show_risk_segment"] for p, r in out.items()} == {
        "steady": "low_risk",
        "one_of_three": "moderate_risk",
        "one_of_two": "high_risk",
        "twice": "high_risk",
        "none": "no_kept_intent_history",
    }
    assert out["none"]["true_no_show_rate"] is None and out["none"]["cancellation_rate"] == 1.0


def test_ties_and_missing_times_end_with_the_id(spark):
    pays = [fx.payment("b", 1, 10), fx.payment("a", 1, 20), fx.payment("0", 1, 30, at=None)]
    pays[2]["attempted_at"] = None
    project = Revenue(fx.feeds(spark, "revenue", {"orders": [fx.order(1, 10, "completed")], "payments": pays}))
    flags = {r.payment_id: r.is_duplicate_settlement for r in project.int_payments_deduped.collect()}
    assert flags == {"a": False, "b": True, "0": True}
    (row,) = project.int_order_financials.collect()
    assert (row.settlement_payment_id, row.settled_amount, row.duplicate_payment_amount) == ("a", 20, 40)


def test_latest_record_tie_and_dangling_transfer(spark):
    records = [
        fx.record(1, "P", "D1", "2024-01-01", "2024-06-01", "transferred"),
        fx.record(2, "P", "D2", "2024-01-01", "2024-07-01", "transferred"),
        fx.record(3, "Q", "D9", "2024-01-01", None, None),
    ]
    project = Workforce(fx.feeds(spark, "workforce", {"employees": records}))
    assert [(r.person_id, r.current_employee_id) for r in project.dangling_transfer.collect()] == [("P", "2")]
    people = by(project.fct_workforce, "person_id")
    assert people["P"]["tenure_since_first_hire_days"] is None
    assert people["Q"]["department_name"] is None and people["Q"]["is_currently_active"]
