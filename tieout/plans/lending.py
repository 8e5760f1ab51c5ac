"""Loan book: reported against ledger-true portfolio at risk."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ANY_MONEY, MONEY, clean_lower, clean_upper, days_from, nulls_last, one_of, ratio
from ..operators import (
    TOTAL,
    disagree,
    flag_duplicates,
    latest_by_key,
    left_join_all,
    rows_where,
    segment_rollup,
    total_of,
    walk,
)
from ..params import LendingParams, day
from ..sources.raw import Raw
from .base import Project

CASH_STATUSES = ("posted", "partial")
POSTING_ORDER = ("paid_at",)


class Lending(Project):
    name = "lending"
    staging = ("stg_applications", "stg_loans", "stg_repayments", "stg_defaults")
    intermediate = ("int_repayments_deduped", "int_loan_delinquency", "int_loan_register_status")
    marts = ("fct_loan_performance", "fct_portfolio_metrics", "fct_par_reconciliation_bridge")
    by_segment = {"fct_portfolio_metrics": "product_type", "fct_par_reconciliation_bridge": "product_type"}

    def __init__(self, raw: Raw, params: LendingParams = LendingParams()) -> None:
        super().__init__(raw)
        self.params = params

    # -- staging ---------------------------------------------------------

    @cached_property
    def stg_applications(self) -> DataFrame:
        return self.raw["applications"].select(
            "application_id",
            "customer_id",
            "product_type",
            "channel",
            "requested_amount",
            clean_upper("currency").alias("currency_code"),
            clean_lower("decision").alias("decision"),
            "decline_reason",
            "submitted_at",
            "decided_at",
            (F.col("decided_at") < F.col("submitted_at")).alias("has_clock_skew"),
        )

    @cached_property
    def stg_loans(self) -> DataFrame:
        return self.raw["loans"].select(
            "loan_id",
            "application_id",
            "customer_id",
            "product_type",
            "principal_amount",
            clean_upper("currency").alias("currency_code"),
            "interest_rate_apr",
            "term_months",
            clean_lower("loan_status").alias("loan_status"),
            "originated_at",
            F.col("first_due_date").alias("current_schedule_first_due_date"),
            "restructured_at",
            F.col("restructured_at").isNotNull().alias("is_restructured"),
        )

    @cached_property
    def stg_repayments(self) -> DataFrame:
        return self.raw["repayments"].select(
            "repayment_id",
            "loan_id",
            "instalment_no",
            "scheduled_amount",
            "amount_paid",
            clean_upper("currency").alias("currency_code"),
            clean_lower("payment_status").alias("payment_status"),
            "due_date",
            "paid_at",
        )

    @cached_property
    def stg_defaults(self) -> DataFrame:
        return self.raw["defaults"].select(
            "default_id",
            "loan_id",
            "default_reason",
            "outstanding_at_default",
            clean_upper("currency").alias("currency_code"),
            clean_lower("default_status").alias("default_status"),
            "flagged_at",
        )

    # -- intermediate ----------------------------------------------------

    @cached_property
    def int_repayments_deduped(self) -> DataFrame:
        """Every posting; repeats of a cash posting per instalment are flagged."""
        return flag_duplicates(
            self.stg_repayments,
            keys=["loan_id", "instalment_no"],
            order=POSTING_ORDER,
            row_id="repayment_id",
            flag="is_duplicate_posting",
            subset=one_of("payment_status", CASH_STATUSES),
        )

    @cached_property
    def instalments(self) -> DataFrame:
        """One row per (loan, instalment): its counted cash posting and the rest.

        The rest are missed rows and rows of unknown status, which are never
        duplicates. Reducing to instalments first turns every later distinct
        count into a plain one and combines a huge loan on the map side.

        Where the counted postings are written already they are not elected again,
        so no posting's order and id have to be moved.
        """
        if "counted_postings" in self.pinned:
            return self.instalments_of(self.counted_postings)
        cash = F.coalesce(one_of("payment_status", CASH_STATUSES), F.lit(False))
        missed = F.col("payment_status") == "missed"
        posting = F.struct("payment_status", "amount_paid", "scheduled_amount", "due_date")
        first = F.when(cash, nulls_last(*POSTING_ORDER, "repayment_id"))
        grouped = self.stg_repayments.groupBy("loan_id", "instalment_no").agg(
            F.min_by(posting, first).alias("cash"),
            F.count(F.when(~cash, 1)).alias("other_rows"),
            F.sum(F.when(~cash, F.col("scheduled_amount"))).alias("other_scheduled"),
            F.max(F.when(~cash, F.col("due_date"))).alias("other_last_due"),
            F.bool_or(F.coalesce(missed, F.lit(False))).alias("was_missed"),
            F.min(F.when(missed, F.col("due_date"))).alias("oldest_missed"),
        )
        zero_beside = F.when(F.col("other_rows") > 0, F.lit(0))
        partial = F.col("cash.payment_status") == "partial"
        short = F.when(partial, F.col("cash.scheduled_amount") - F.col("cash.amount_paid")).when(
            F.col("cash").isNotNull(), F.lit(0)
        )
        scheduled = F.col("cash.scheduled_amount")
        return grouped.select(
            "loan_id",
            "instalment_no",
            "was_missed",
            "oldest_missed",
            F.coalesce(partial, F.lit(False)).alias("was_partial"),
            F.coalesce("cash.amount_paid", zero_beside).alias("paid"),
            F.coalesce(scheduled + F.col("other_scheduled"), scheduled, "other_scheduled").alias("scheduled"),
            F.coalesce(short, zero_beside).alias("shortfall"),
            F.greatest("cash.due_date", "other_last_due").alias("last_due"),
        )

    def instalments_of(self, counted: DataFrame) -> DataFrame:
        """``instalments`` from the one counted cash posting of each, and the rows that are no cash postings."""
        zero, missed = F.lit(0), F.col("payment_status") == "missed"
        partial = F.coalesce(F.col("payment_status") == "partial", F.lit(False))
        key, due = ["loan_id", "instalment_no"], F.col("due_date")
        none = F.lit(None).cast(MONEY)
        postings = counted.select(
            *key,
            F.lit(False).alias("is_other"),
            F.lit(False).alias("missed"),
            partial.alias("partial"),
            F.col("amount_paid").alias("cash"),
            F.when(partial, F.col("scheduled_amount") - F.col("amount_paid")).otherwise(zero).alias("short"),
            "scheduled_amount",
            F.lit(None).cast("date").alias("missed_due"),
            "due_date",
        )
        other = ~F.coalesce(one_of("payment_status", CASH_STATUSES), F.lit(False))
        others = self.stg_repayments.filter(other).select(
            *key,
            F.lit(True).alias("is_other"),
            F.coalesce(missed, F.lit(False)).alias("missed"),
            F.lit(False).alias("partial"),
            none.alias("cash"),
            none.alias("short"),
            "scheduled_amount",
            F.when(missed, due).alias("missed_due"),
            "due_date",
        )
        beside = F.when(F.bool_or("is_other"), zero)
        return postings.unionByName(others).groupBy(*key).agg(
            F.bool_or("missed").alias("was_missed"),
            F.min("missed_due").alias("oldest_missed"),
            F.bool_or("partial").alias("was_partial"),
            F.coalesce(F.max("cash"), beside).alias("paid"),
            F.sum("scheduled_amount").alias("scheduled"),
            F.coalesce(F.max("short"), beside).alias("shortfall"),
            F.max("due_date").alias("last_due"),
        )

    @cached_property
    def int_loan_delinquency(self) -> DataFrame:
        number = F.col("instalment_no")
        per_loan = self.instalments.groupBy("loan_id").agg(
            F.count(number).alias("instalments_due_count"),
            F.count(F.when(F.col("was_missed"), number)).alias("instalments_missed_count"),
            F.count(F.when(F.col("was_partial"), number)).alias("instalments_partial_count"),
            F.sum("paid").cast(ANY_MONEY).alias("cumulative_amount_paid"),
            F.sum("scheduled").cast(ANY_MONEY).alias("cumulative_scheduled_amount"),
            F.sum("shortfall").cast(ANY_MONEY).alias("cumulative_partial_shortfall"),
            F.min("oldest_missed").alias("oldest_missed_due_date"),
            F.max("last_due").alias("most_recent_due_date"),
        )
        overdue = days_from("oldest_missed_due_date", day(self.params.as_of))
        return per_loan.withColumns(
            {
                "true_dpd": F.coalesce(overdue, F.lit(0)),
                "partial_rate": ratio("instalments_partial_count", "instalments_due_count"),
            }
        )

    @cached_property
    def int_loan_register_status(self) -> DataFrame:
        latest = latest_by_key(
            self.stg_defaults,
            keys=["loan_id"],
            at="flagged_at",
            row_id="default_id",
            picks={
                "most_recent_default_status": "default_status",
                "most_recent_default_reason": "default_reason",
                "outstanding_at_default": "outstanding_at_default",
            },
            aggs=[
                F.count(F.lit(1)).alias("register_entry_count"),
                F.max("flagged_at").alias("most_recent_flagged_at"),
            ],
        )
        return latest.select(
            "loan_id",
            "register_entry_count",
            F.lit(True).alias("is_reported_defaulted"),
            "most_recent_flagged_at",
            "most_recent_default_status",
            "most_recent_default_reason",
            "outstanding_at_default",
        )

    # -- marts -----------------------------------------------------------

    @cached_property
    def fct_loan_performance(self) -> DataFrame:
        p = self.params
        active = self.stg_loans.filter(F.col("loan_status") != "closed")
        sides = [self.int_loan_delinquency, self.int_loan_register_status]
        joined = left_join_all(active, "loan_id", sides)
        zero, no = F.lit(0), F.lit(False)
        paid = F.coalesce("cumulative_amount_paid", zero)
        owed = F.col("principal_amount") - paid
        book = joined.select(
            *self.stg_loans.columns,
            F.coalesce("instalments_due_count", zero).alias("instalments_due_count"),
            F.coalesce("instalments_missed_count", zero).alias("instalments_missed_count"),
            F.coalesce("instalments_partial_count", zero).alias("instalments_partial_count"),
            paid.cast(ANY_MONEY).alias("cumulative_amount_paid"),
            F.coalesce("cumulative_partial_shortfall", zero).cast(ANY_MONEY).alias("cumulative_partial_shortfall"),
            "oldest_missed_due_date",
            F.coalesce("true_dpd", zero).alias("true_dpd"),
            F.coalesce("partial_rate", F.lit(0.0)).alias("partial_rate"),
            F.when(owed < 0, zero).otherwise(owed).cast(ANY_MONEY).alias("outstanding_balance_estimate"),
            F.coalesce("is_reported_defaulted", no).alias("is_reported_defaulted"),
            "most_recent_default_status",
            "most_recent_default_reason",
            "outstanding_at_default",
            "register_entry_count",
        )
        dpd = F.col("true_dpd")
        bucket = (
            F.when(dpd == 0, "current")
            .when(dpd < p.par30_days, "1-29_dpd")
            .when(dpd < p.par90_days, "30-89_dpd")
            .otherwise("90_plus_dpd")
        )
        hidden = F.col("is_restructured") & (dpd >= p.par30_days) & ~F.col("is_reported_defaulted")
        return book.withColumns(
            {
                "is_true_par30": dpd >= p.par30_days,
                "is_true_par90": dpd >= p.par90_days,
                "risk_bucket": bucket,
                "is_hidden_restructure_risk": hidden,
            }
        )

    @cached_property
    def fct_portfolio_metrics(self) -> DataFrame:
        value = F.col("outstanding_balance_estimate")
        measures = {
            "active_loan_count": rows_where(),
            "active_outstanding_value": total_of(value),
            "par30_loan_count": rows_where(F.col("is_true_par30")),
            "par30_outstanding_value": total_of(F.when(F.col("is_true_par30"), value).otherwise(0)),
            "par90_loan_count": rows_where(F.col("is_true_par90")),
            "par90_outstanding_value": total_of(F.when(F.col("is_true_par90"), value).otherwise(0)),
            "reported_default_loan_count": rows_where(F.col("is_reported_defaulted")),
            "restructured_loan_count": rows_where(F.col("is_restructured")),
            "hidden_restructure_risk_count": rows_where(F.col("is_hidden_restructure_risk")),
            "partial_instalments": total_of("instalments_partial_count"),
            "due_instalments": total_of("instalments_due_count"),
        }
        rolled = segment_rollup(self.fct_loan_performance, "product_type", measures)
        loans, amount = "active_loan_count", "active_outstanding_value"
        return rolled.select(
            "product_type",
            loans,
            amount,
            "par30_loan_count",
            ratio("par30_loan_count", loans).alias("par30_rate_by_count"),
            "par30_outstanding_value",
            ratio("par30_outstanding_value", amount).alias("par30_rate_by_value"),
            "par90_loan_count",
            ratio("par90_loan_count", loans).alias("par90_rate_by_count"),
            "par90_outstanding_value",
            ratio("par90_outstanding_value", amount).alias("par90_rate_by_value"),
            "reported_default_loan_count",
            ratio("reported_default_loan_count", loans).alias("reported_default_rate"),
            "restructured_loan_count",
            ratio("restructured_loan_count", loans).alias("restructure_rate"),
            "hidden_restructure_risk_count",
            ratio("partial_instalments", "due_instalments").alias("partial_payment_rate"),
        )

    @cached_property
    def fct_par_reconciliation_bridge(self) -> DataFrame:
        """Register-reported loans walked to ledger-true ones, an exact identity."""
        reported, restructured = F.col("is_reported_defaulted"), F.col("is_restructured")
        measures = {"active_loan_count": rows_where(), "reported_par_loans": rows_where(reported)}
        for cut in ("par30", "par90"):
            late = F.col(f"is_true_{cut}")
            measures[f"hidden_restructure_risk_{cut}"] = rows_where(restructured & late & ~reported)
            measures[f"unregistered_delinquents_{cut}"] = rows_where(~restructured & late & ~reported)
            measures[f"stale_register_entries_{cut}"] = rows_where(reported & ~late)
            measures[f"true_{cut}_loans"] = rows_where(late)
        rolled = segment_rollup(self.fct_loan_performance, "product_type", measures)

        def leg(cut: str) -> list:
            found = [f"hidden_restructure_risk_{cut}", f"unregistered_delinquents_{cut}"]
            stale = f"stale_register_entries_{cut}"
            return [
                *found,
                stale,
                walk("reported_par_loans", found, [stale]).alias(f"bridged_{cut}_loans"),
                f"true_{cut}_loans",
                ratio(f"true_{cut}_loans", "active_loan_count").alias(f"true_{cut}_rate"),
            ]

        return rolled.select(
            "product_type",
            "active_loan_count",
            "reported_par_loans",
            ratio("reported_par_loans", "active_loan_count").alias("reported_par_rate"),
            *leg("par30"),
            *leg("par90"),
            ratio(F.col("true_par30_loans") - F.col("reported_par_loans"), "reported_par_loans").alias(
                "par30_understatement_pct"
            ),
        )

    # -- business rules --------------------------------------------------

    @cached_property
    def counted_postings(self) -> DataFrame:
        """What the rules and the instalments read of the cash postings that count."""
        cash = one_of("payment_status", CASH_STATUSES)
        counted = self.int_repayments_deduped.filter(cash & ~F.col("is_duplicate_posting"))
        return counted.select(
            "loan_id", "instalment_no", "payment_status", "scheduled_amount", "amount_paid", "due_date"
        )

    @cached_property
    def no_overpayment_per_instalment(self) -> DataFrame:
        limit = F.col("scheduled_amount") * F.lit("1.01").cast("decimal(3,2)")
        over = self.counted_postings.filter(F.col("amount_paid") > limit)
        return over.select("loan_id", "instalment_no", "scheduled_amount", "amount_paid")

    @cached_property
    def no_duplicate_postings_counted_twice(self) -> DataFrame:
        counted = self.counted_postings.groupBy("loan_id", "instalment_no").agg(
            F.count(F.lit(1)).alias("non_duplicate_postings")
        )
        return counted.filter(F.col("non_duplicate_postings") > 1)

    @cached_property
    def bridge_ties_to_true_par(self) -> DataFrame:
        off = disagree("bridged_par30_loans", "true_par30_loans") | disagree(
            "bridged_par90_loans", "true_par90_loans"
        )
        return self.fct_par_reconciliation_bridge.filter(off).select(
            "product_type", "bridged_par30_loans", "true_par30_loans", "bridged_par90_loans", "true_par90_loans"
        )

    @cached_property
    def true_par_meets_or_exceeds_reported_par(self) -> DataFrame:
        below = (F.col("product_type") == TOTAL) & (F.col("true_par30_loans") < F.col("reported_par_loans"))
        return self.fct_par_reconciliation_bridge.filter(below).select(
            "product_type", "reported_par_loans", "true_par30_loans"
        )
