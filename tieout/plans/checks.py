"""The data checks of every project and the runner that summarises them.

Fixed values: which columns are keys, what they refer to, and the accepted
values are the contract of each model.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..operators import checks as generic
from ..operators.dedup import LARGE, estimated_bytes
from ..session import shuffles_deleted
from .base import Project

UNIQUE, NOT_NULL = "unique", "not_null"
ACCEPTED_VALUES, RELATIONSHIPS, ACCEPTED_RANGE = "accepted_values", "relationships", "accepted_range"
BUSINESS_RULE = "business_rule"
GENERIC_KINDS = (UNIQUE, NOT_NULL, ACCEPTED_VALUES, RELATIONSHIPS, ACCEPTED_RANGE)
ALL_KINDS = (*GENERIC_KINDS, BUSINESS_RULE)


@dataclass(frozen=True)
class Check:
    relation: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""
    minimum: int = 0
    inclusive: bool = True
    severity: str = "error"

    @property
    def name(self) -> str:
        return self.relation if self.kind == BUSINESS_RULE else f"{self.relation}.{self.column}.{self.kind}"


#: Columns of ``check_outcomes``.
OUTCOME = "project string, check_name string, kind string, severity string, failures bigint, status string"


def key(relation: str, column: str) -> list[Check]:
    return [Check(relation, column, UNIQUE), Check(relation, column, NOT_NULL)]


def filled(relation: str, *columns: str) -> list[Check]:
    return [Check(relation, c, NOT_NULL) for c in columns]


def listed(relation: str, column: str, *values: str) -> list[Check]:
    return [Check(relation, column, ACCEPTED_VALUES, values=values)]


def refers(relation: str, column: str, parent: str, parent_column: str = "") -> list[Check]:
    return [Check(relation, column, RELATIONSHIPS, parent=parent, parent_column=parent_column or column)]


def at_least_zero(relation: str, *columns: str) -> list[Check]:
    return [Check(relation, c, ACCEPTED_RANGE) for c in columns]


def positive(relation: str, column: str) -> list[Check]:
    return [Check(relation, column, ACCEPTED_RANGE, inclusive=False)]


def rules(*names: str, severity: str = "error") -> list[Check]:
    return [Check(name, "", BUSINESS_RULE, severity=severity) for name in names]


# Relations, columns and accepted values of the checks.
CHECKS: dict[str, list[Check]] = {
    "revenue": [
        *key("stg_orders", "order_id"),
        *listed("stg_orders", "order_status", "completed", "confirmed", "cancelled", "placed"),
        *positive("stg_orders", "order_amount"),
        *key("stg_payments", "payment_id"),
        *filled("stg_payments", "order_id"),
        *refers("stg_payments", "order_id", "stg_orders"),
        *listed("stg_payments", "payment_status", "succeeded", "failed"),
        *key("stg_refunds", "refund_id"),
        *refers("stg_refunds", "order_id", "stg_orders"),
        *refers("stg_refunds", "payment_id", "stg_payments"),
        *listed("stg_refunds", "refund_status", "completed"),
        *key("stg_shipping", "shipment_id"),
        *refers("stg_shipping", "order_id", "stg_orders"),
        *listed("stg_shipping", "shipment_status", "delivered", "in_transit"),
        *key("fct_revenue", "order_id"),
        *at_least_zero("fct_revenue", "net_revenue", "cancellation_leakage_amount"),
        *key("fct_revenue_monthly", "report_month"),
        *key("fct_revenue_reconciliation_bridge", "order_cohort_month"),
        *rules(
            "no_over_refunding",
            "no_duplicate_settlements_counted_in_revenue",
            "bridge_ties_to_fct_revenue",
            "net_revenue_ties_to_raw_ledger",
        ),
        *rules("non_base_currency_volume", severity="warn"),
    ],
    "lending": [
        *key("stg_applications", "application_id"),
        *listed("stg_applications", "decision", "approved", "declined", "pending"),
        *key("stg_loans", "loan_id"),
        *filled("stg_loans", "application_id"),
        *refers("stg_loans", "application_id", "stg_applications"),
        *listed("stg_loans", "loan_status", "active", "delinquent", "restructured", "closed"),
        *positive("stg_loans", "principal_amount"),
        *key("stg_repayments", "repayment_id"),
        *filled("stg_repayments", "loan_id"),
        *refers("stg_repayments", "loan_id", "stg_loans"),
        *listed("stg_repayments", "payment_status", "posted", "partial", "missed"),
        *key("stg_defaults", "default_id"),
        *refers("stg_defaults", "loan_id", "stg_loans"),
        *listed("stg_defaults", "default_status", "open", "in_recovery", "written_off"),
        *key("fct_loan_performance", "loan_id"),
        *at_least_zero("fct_loan_performance", "true_dpd", "outstanding_balance_estimate"),
        *key("fct_portfolio_metrics", "product_type"),
        *key("fct_par_reconciliation_bridge", "product_type"),
        *rules(
            "no_overpayment_per_instalment",
            "no_duplicate_postings_counted_twice",
            "bridge_ties_to_true_par",
            "true_par_meets_or_exceeds_reported_par",
        ),
    ],
    "visits": [
        *key("stg_patients", "patient_id"),
        *listed("stg_patients", "sex", "F", "M", "X"),
        *key("stg_doctors", "doctor_id"),
        *key("stg_appointments", "appointment_id"),
        *filled("stg_appointments", "patient_id", "doctor_id"),
        *refers("stg_appointments", "patient_id", "stg_patients"),
        *refers("stg_appointments", "doctor_id", "stg_doctors"),
        *listed(
            "stg_appointments",
            "raw_status",
            "attended",
            "no_show",
            "missed",
            "no-show",
            "cancelled",
            "rescheduled",
        ),
        *key("stg_billing", "billing_id"),
        *filled("stg_billing", "appointment_id"),
        *listed("stg_billing", "line_type", "office_visit", "no_show_fee", "late_cancel_fee"),
        *key("fct_appointments", "logical_visit_id"),
        *listed("fct_appointments", "final_canonical_status", "attended", "no_show", "cancelled", "unresolved"),
        *key("fct_patient_engagement", "patient_id"),
        *listed(
            "fct_patient_engagement",
            "no_show_risk_segment",
            "high_risk",
            "moderate_risk",
            "low_risk",
            "no_kept_intent_history",
        ),
        *key("fct_noshow_reconciliation_bridge", "location"),
        *rules(
            "every_row_has_one_canonical_status",
            "no_double_counted_visit_intent",
            "bridge_ties_to_fct_appointments",
            "billing_never_contradicts_canonical_status",
        ),
    ],
    "workforce": [
        *key("stg_departments", "department_id"),
        *key("stg_employees", "employee_id"),
        *filled("stg_employees", "person_id"),
        *refers("stg_employees", "department_id", "stg_departments"),
        *listed("stg_employees", "raw_employment_status", "active", "terminated", "transferred"),
        *key("stg_performance_reviews", "review_id"),
        *filled("stg_performance_reviews", "employee_id"),
        *listed("stg_performance_reviews", "rating", "outstanding", "exceeds", "meets", "below"),
        *key("stg_payroll", "payroll_id"),
        *filled("stg_payroll", "employee_id"),
        *listed("stg_payroll", "currency_code", "USD", "GBP", "EUR", "SGD"),
        *key("fct_workforce", "person_id"),
        *at_least_zero("fct_workforce", "tenure_time_in_seat_days"),
        *key("fct_department_workforce", "department_name"),
        *filled("fct_attrition_tenure_reconciliation_bridge", "window_start"),
        *rules(
            "headcount_reconciles_to_distinct_active_people",
            "transfers_net_to_zero_across_departments",
            "department_headcount_sums_to_company_total",
            "bridge_ties_to_true_genuine_exits",
            "department_headcount_matches_workforce",
        ),
        *rules("dangling_transfer", severity="warn"),
    ],
}


def violations(project: Project, check: Check, hashes_first: bool = False) -> DataFrame:
    """The rows (or repeated / unknown values) that break one check; with ``hashes_first`` large feeds are hashed by a job before."""
    df = project.model(check.relation)
    if check.kind == BUSINESS_RULE:
        return df
    if check.kind == UNIQUE:
        return generic.unique(df, check.column, hashes_first and estimated_bytes(df) > LARGE)
    if check.kind == NOT_NULL:
        return generic.not_null(df, check.column)
    if check.kind == ACCEPTED_VALUES:
        return generic.accepted_values(df, check.column, check.values)
    if check.kind == RELATIONSHIPS:
        if (unknown := project.unknown_references(check.relation, check.column)) is not None:
            return unknown
        return generic.relationships(df, check.column, project.model(check.parent), check.parent_column)
    return generic.accepted_range(df, check.column, check.minimum, check.inclusive)


def _row_condition(check: Check) -> Column | None:
    if check.kind == NOT_NULL:
        return generic.is_missing(check.column)
    if check.kind == ACCEPTED_VALUES:
        return generic.is_unlisted(check.column, check.values)
    if check.kind == ACCEPTED_RANGE:
        return generic.is_below(check.column, check.minimum, check.inclusive)
    return None


def _outcome(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.kind).alias("kind"),
        F.lit(check.severity).alias("severity"),
        failures.cast("long").alias("failures"),
    )


def row_checks(project: Project, relation: str, kinds: tuple[str, ...] = ALL_KINDS) -> dict[str, Column]:
    """Of a relation's row-wise checks, the count of failures by name, to be taken while it is written."""
    wanted = [k for k in CHECKS[project.name] if k.relation == relation and k.kind in kinds]
    return {k.name: F.count(F.when(met, 1)) for k in wanted if (met := _row_condition(k)) is not None}


def _outcomes(
    project: Project, checks: list[Check], counted: Mapping[str, int], hashes_first: bool = False
) -> list[DataFrame]:
    """One frame per scan: all row-wise checks of a relation share a single one, and none if they are counted already."""
    frames, known = [], []
    by_relation: dict[str, list[Check]] = {}
    for check in checks:
        if check.name in counted:
            known.append(_outcome(check, F.lit(counted[check.name])))
            continue
        if _row_condition(check) is not None:
            by_relation.setdefault(check.relation, []).append(check)
            continue
        bad = violations(project, check, hashes_first)
        # a repeated value is one failure, an unknown reference one per child row
        failures = F.coalesce(F.sum("n_rows"), F.lit(0)) if check.kind == RELATIONSHIPS else F.count(F.lit(1))
        frames.append(bad.agg(failures.alias("n")).select(F.array(_outcome(check, F.col("n"))).alias("o")))
    for relation, group in by_relation.items():
        counts = [F.count(F.when(_row_condition(check), 1)).alias(f"n{i}") for i, check in enumerate(group)]
        one_row = project.model(relation).agg(*counts)
        frames.append(one_row.select(F.array(*[_outcome(k, F.col(f"n{i}")) for i, k in enumerate(group)]).alias("o")))
    if known:
        spark = project.model(checks[0].relation).sparkSession
        frames.append(spark.range(1).select(F.array(*known).alias("o")))
    return frames


def check_outcomes(
    project: Project, kinds: tuple[str, ...] = ALL_KINDS, counted: Mapping[str, int] | None = None
) -> DataFrame:
    """Name, kind, severity, failures and status of every check of the given kinds.

    ``counted`` holds the failures of row-wise checks, by name, that were counted
    while their relation was written; those read nothing again.
    """
    wanted = [check for check in CHECKS[project.name] if check.kind in kinds]
    return _judged(project, _outcomes(project, wanted, counted or {}))


def _judged(project: Project, frames: list[DataFrame]) -> DataFrame:
    rows = reduce(DataFrame.unionByName, frames).select(F.explode("o").alias("o"))
    failed = F.when(F.col("severity") == "warn", "warn").otherwise("fail")
    return rows.select(F.lit(project.name).alias("project"), "o.*").withColumn(
        "status", F.when(F.col("failures") > 0, failed).otherwise("pass")
    )


def outcome_rows(project: Project, counted: Mapping[str, int], kinds: tuple[str, ...] = ALL_KINDS) -> list[Row]:
    """The rows of ``check_outcomes``, worked out relation by relation: of one query's shuffles none are left for the next."""
    by_relation: dict[str, list[Check]] = {}
    for check in CHECKS[project.name]:
        if check.kind in kinds:
            by_relation.setdefault(check.relation, []).append(check)
    rows: list[Row] = []
    for relation, checks in by_relation.items():
        with shuffles_deleted(project.model(relation).sparkSession):
            rows += _judged(project, _outcomes(project, checks, counted, hashes_first=True)).collect()
    return rows
