"""Check summaries, freshness and the publish gate as SQL.

The catalogue is written out here a second time, from the contract of each model,
so a check that the Spark side forgets or adds is seen.
"""

from collections import namedtuple

Check = namedtuple("Check", "project relation column kind values parent severity", defaults=((), None, "error"))

# The columns of each model that must be unique and filled, by project.
KEYS = {
    "revenue": {
        "stg_orders": "order_id", "stg_payments": "payment_id", "stg_refunds": "refund_id", "stg_shipping": "shipment_id",
        "fct_revenue": "order_id", "fct_revenue_monthly": "report_month", "fct_revenue_reconciliation_bridge": "order_cohort_month",
    },
    "lending": {
        "stg_applications": "application_id", "stg_loans": "loan_id", "stg_repayments": "repayment_id", "stg_defaults": "default_id",
        "fct_loan_performance": "loan_id", "fct_portfolio_metrics": "product_type", "fct_par_reconciliation_bridge": "product_type",
    },
    "visits": {
        "stg_patients": "patient_id", "stg_doctors": "doctor_id", "stg_appointments": "appointment_id", "stg_billing": "billing_id",
        "fct_appointments": "logical_visit_id", "fct_patient_engagement": "patient_id", "fct_noshow_reconciliation_bridge": "location",
    },
    "workforce": {
        "stg_departments": "department_id", "stg_employees": "employee_id", "stg_performance_reviews": "review_id",
        "stg_payroll": "payroll_id", "fct_workforce": "person_id", "fct_department_workforce": "department_name",
    },
}

# What else must be filled.
FILLED = {
    "revenue": {"stg_payments": ["order_id"]},
    "lending": {"stg_loans": ["application_id"], "stg_repayments": ["loan_id"]},
    "visits": {"stg_appointments": ["patient_id", "doctor_id"], "stg_billing": ["appointment_id"]},
    "workforce": {
        "stg_employees": ["person_id"], "stg_performance_reviews": ["employee_id"], "stg_payroll": ["employee_id"],
        "fct_attrition_tenure_reconciliation_bridge": ["window_start"],
    },
}

# The values that a column may have.
VALUES = {
    ("revenue", "stg_orders", "order_status"): ("completed", "confirmed", "cancelled", "placed"),
    ("revenue", "stg_payments", "payment_status"): ("succeeded", "failed"),
    ("revenue", "stg_refunds", "refund_status"): ("completed",),
    ("revenue", "stg_shipping", "shipment_status"): ("delivered", "in_transit"),
    ("lending", "stg_applications", "decision"): ("approved", "declined", "pending"),
    ("lending", "stg_loans", "loan_status"): ("active", "delinquent", "restructured", "closed"),
    ("lending", "stg_repayments", "payment_status"): ("posted", "partial", "missed"),
    ("lending", "stg_defaults", "default_status"): ("open", "in_recovery", "written_off"),
    ("visits", "stg_patients", "sex"): ("F", "M", "X"),
    ("visits", "stg_appointments", "raw_status"): ("attended", "no_show", "missed", "no-show", "cancelled", "rescheduled"),
    ("visits", "stg_billing", "line_type"): ("office_visit", "no_show_fee", "late_cancel_fee"),
    ("visits", "fct_appointments", "final_canonical_status"): ("attended", "no_show", "cancelled", "unresolved"),
    ("visits", "fct_patient_engagement", "no_show_risk_segment"): (
        "high_risk", "moderate_risk", "low_risk", "no_kept_intent_history",
    ),
    ("workforce", "stg_employees", "raw_employment_status"): ("active", "terminated", "transferred"),
    ("workforce", "stg_performance_reviews", "rating"): ("outstanding", "exceeds", "meets", "below"),
    ("workforce", "stg_payroll", "currency_code"): ("USD", "GBP", "EUR", "SGD"),
}

# References and the model that holds what they refer to.
PARENTS = {
    ("revenue", "stg_payments", "order_id"): "stg_orders",
    ("revenue", "stg_refunds", "order_id"): "stg_orders",
    ("revenue", "stg_refunds", "payment_id"): "stg_payments",
    ("revenue", "stg_shipping", "order_id"): "stg_orders",
    ("lending", "stg_loans", "application_id"): "stg_applications",
    ("lending", "stg_repayments", "loan_id"): "stg_loans",
    ("lending", "stg_defaults", "loan_id"): "stg_loans",
    ("visits", "stg_appointments", "patient_id"): "stg_patients",
    ("visits", "stg_appointments", "doctor_id"): "stg_doctors",
    ("workforce", "stg_employees", "department_id"): "stg_departments",
}

# Columns with a least value of zero, and whether zero itself is allowed.
FLOORS = {
    ("revenue", "stg_orders", "order_amount"): False,
    ("revenue", "fct_revenue", "net_revenue"): True,
    ("revenue", "fct_revenue", "cancellation_leakage_amount"): True,
    ("lending", "stg_loans", "principal_amount"): False,
    ("lending", "fct_loan_performance", "true_dpd"): True,
    ("lending", "fct_loan_performance", "outstanding_balance_estimate"): True,
    ("workforce", "fct_workforce", "tenure_time_in_seat_days"): True,
}

# Rules that must return no row; those after the bar only warn.
RULES = {
    "revenue": "no_over_refunding no_duplicate_settlements_counted_in_revenue bridge_ties_to_fct_revenue "
    "net_revenue_ties_to_raw_ledger | non_base_currency_volume",
    "lending": "no_overpayment_per_instalment no_duplicate_postings_counted_twice bridge_ties_to_true_par "
    "true_par_meets_or_exceeds_reported_par |",
    "visits": "every_row_has_one_canonical_status no_double_counted_visit_intent bridge_ties_to_fct_appointments "
    "billing_never_contradicts_canonical_status |",
    "workforce": "headcount_reconciles_to_distinct_active_people transfers_net_to_zero_across_departments "
    "department_headcount_sums_to_company_total bridge_ties_to_true_genuine_exits department_headcount_matches_workforce | "
    "dangling_transfer",
}

# Load time of each feed, and after how many hours it is late and too late.
FRESHNESS = {
    "revenue": {"orders": ("updated_at", 36, 48), "payments": ("attempted_at", 36, 48), "refunds": ("processed_at",), "shipping": ("shipped_at",)},
    "lending": {"applications": ("decided_at", 36, 48), "loans": ("originated_at", 36, 48), "repayments": ("due_date",), "defaults": ("flagged_at",)},
    "visits": {
        "patients": ("registered_at",), "doctors": ("hired_at",), "appointments": ("booked_at", 36, 48), "billing": ("posted_at", 48, 72),
    },
    "workforce": {
        "employees": ("hire_date", 36, 48), "departments": (None,), "performance_reviews": ("review_date", 30 * 24, 45 * 24),
        "payroll": ("paid_at", 36, 48),
    },
}

# The clock at which the supplied feeds are judged.
CLOCK = {
    "revenue": "2001-08-05 20:00:00",
    "lending": "2001-08-02 14:30:00",
    "visits": "2024-01-25 05:00:00",
    "workforce": "2001-11-06 04:00:00",
}


def catalogue() -> list[Check]:
    out = []
    for project, keys in KEYS.items():
        out += [Check(project, r, c, kind) for r, c in keys.items() for kind in ("unique", "not_null")]
        out += [Check(project, r, c, "not_null") for r, columns in FILLED[project].items() for c in columns]
        must, _, warn = RULES[project].partition("|")
        out += [Check(project, r, "", "business_rule") for r in must.split()]
        out += [Check(project, r, "", "business_rule", severity="warn") for r in warn.split()]
    out += [Check(*at, "accepted_values", values) for at, values in VALUES.items()]
    out += [Check(*at, "relationships", parent=parent) for at, parent in PARENTS.items()]
    return out + [Check(*at, "accepted_range", "<" if zero else "<=") for at, zero in FLOORS.items()]


MARTS = {
    "revenue": ("fct_revenue", "fct_revenue_monthly", "fct_revenue_reconciliation_bridge"),
    "lending": ("fct_loan_performance", "fct_portfolio_metrics", "fct_par_reconciliation_bridge"),
    "visits": ("fct_appointments", "fct_patient_engagement", "fct_noshow_reconciliation_bridge"),
    "workforce": ("fct_workforce", "fct_department_workforce", "fct_attrition_tenure_reconciliation_bridge"),
}


def name(check: Check) -> str:
    return f"{check.relation}.{check.column}.{check.kind}" if check.column else check.relation


def failures(check: Check) -> str:
    rel, col = check.relation, check.column
    if check.kind == "business_rule":
        return f"SELECT count(*) FROM {rel}"
    if check.kind == "unique":
        return f"SELECT count(*) FROM (SELECT {col} FROM {rel} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)"
    if check.kind == "not_null":
        return f"SELECT count(*) - count({col}) FROM {rel}"
    if check.kind == "accepted_values":
        allowed = ", ".join(f"'{v}'" for v in check.values)
        return f"SELECT count({col}) - count(CASE WHEN {col} IN ({allowed}) THEN 1 END) FROM {rel}"
    if check.kind == "relationships":
        return (
            f"SELECT count(*) FROM {rel} k WHERE k.{col} IS NOT NULL AND NOT EXISTS "
            f"(FROM {check.parent} q WHERE q.{col} = k.{col})"
        )
    return f"SELECT count(CASE WHEN {col} {check.values} 0 THEN 1 END) FROM {rel}"


def outcomes(kinds: tuple[str, ...] | None = None, project: str | None = None) -> str:
    rows = [
        f"SELECT '{k.project}' AS project, '{name(k)}' AS check_name, '{k.kind}' AS kind, '{k.severity}' AS severity, "
        f"CAST(({failures(k)}) AS BIGINT) AS failures"
        for k in catalogue()
        if (kinds is None or k.kind in kinds) and project in (None, k.project)
    ]
    counted = "\nUNION ALL\n".join(rows)
    return (
        "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status "
        f"FROM ({counted})"
    )


def freshness() -> str:
    rows = []
    for project, feeds in FRESHNESS.items():
        now = f"TIMESTAMP '{CLOCK[project]}'"
        for feed, (column, *limits) in feeds.items():
            at = f"CAST(max({column}) AS TIMESTAMP)" if column else "max(CAST(NULL AS TIMESTAMP))"
            field = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
            warn, error = (3600 * hours for hours in limits) if limits else ("NULL", "NULL")
            rows.append(
                f"SELECT '{project}' AS project, '{feed}' AS source_table, {field} AS loaded_at_field, "
                f"{at} AS max_loaded_at, {now} AS checked_at, {warn} AS w, {error} AS e FROM raw_{feed}"
            )
    listed = "\nUNION ALL\n".join(rows)
    return f"""
        WITH aged AS (SELECT *, CAST(date_sub('second', max_loaded_at, checked_at) AS BIGINT) AS s FROM ({listed}))
        SELECT project, source_table, loaded_at_field, max_loaded_at, s / 3600 AS age_hours,
               CASE WHEN e IS NULL THEN 'no_sla' WHEN coalesce(s > e, true) THEN 'error'
                    WHEN s > w THEN 'warn' ELSE 'pass' END AS status
        FROM aged"""


def gate() -> str:
    listed = ", ".join(f"('{p}', '{m}')" for p, marts in MARTS.items() for m in marts)
    return f"""
        WITH failed AS (SELECT project, {count_failed()} AS checks_failed FROM ({outcomes()}) GROUP BY project)
        SELECT project, mart, checks_failed, checks_failed = 0 AS published
        FROM (VALUES {listed}) v(project, mart) JOIN failed USING (project)"""


def count_failed() -> str:
    return "count(*) FILTER (WHERE severity = 'error' AND failures > 0)"


CHECK_QUERIES = {
    **{
        f"check_{kind}": outcomes((kind,))
        for kind in ("unique", "not_null", "accepted_values", "relationships", "accepted_range")
    },
    "check_summary": outcomes(),
    "source_freshness": freshness(),
    "publish_gate": gate(),
}
