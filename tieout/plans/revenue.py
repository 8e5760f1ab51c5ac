"""Online retail: why the operations and finance revenue figures differ."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ANY_MONEY, clean_lower, clean_upper, month_of, ratio
from ..operators import disagree, first_per_key, flag_duplicates, left_join_all, walk
from ..operators.checks import references
from ..params import RevenueParams
from ..sources.raw import Raw
from .base import Project

SETTLED_ORDER = ("processed_at",)


def settled(status: str = "payment_status"):
    return F.col(status) == "succeeded"


class Revenue(Project):
    name = "revenue"
    staging = ("stg_orders", "stg_payments", "stg_refunds", "stg_shipping")
    intermediate = ("int_payments_deduped", "int_order_financials")
    marts = ("fct_revenue", "fct_revenue_monthly", "fct_revenue_reconciliation_bridge")
    by_period = {"fct_revenue_monthly": "report_month", "fct_revenue_reconciliation_bridge": "order_cohort_month"}

    def __init__(self, raw: Raw, params: RevenueParams = RevenueParams()) -> None:
        super().__init__(raw)
        self.params = params

    # -- staging ---------------------------------------------------------

    @cached_property
    def stg_orders(self) -> DataFrame:
        return self.raw["orders"].select(
            "order_id",
            "customer_id",
            clean_lower("order_status").alias("order_status"),
            "order_amount",
            clean_upper("currency").alias("currency_code"),
            "created_at",
            "updated_at",
            (F.col("updated_at") < F.col("created_at")).alias("has_clock_skew"),
        )

    @cached_property
    def stg_payments(self) -> DataFrame:
        return self.raw["payments"].select(
            "payment_id",
            "order_id",
            clean_lower("payment_status").alias("payment_status"),
            "amount",
            clean_upper("currency").alias("currency_code"),
            "payment_method",
            "gateway_fee",
            "attempted_at",
            "processed_at",
        )

    @cached_property
    def stg_refunds(self) -> DataFrame:
        return self.raw["refunds"].select(
            "refund_id",
            "order_id",
            "payment_id",
            "refund_amount",
            clean_upper("currency").alias("currency_code"),
            "refund_reason",
            clean_lower("refund_status").alias("refund_status"),
            "requested_at",
            F.col("processed_at").alias("refund_processed_at"),
        )

    @cached_property
    def stg_shipping(self) -> DataFrame:
        return self.raw["shipping"].select(
            "shipment_id",
            "order_id",
            "carrier",
            "shipping_cost",
            clean_lower("status").alias("shipment_status"),
            "shipped_at",
            "delivered_at",
        )

    # -- intermediate ----------------------------------------------------

    @cached_property
    def int_payments_deduped(self) -> DataFrame:
        """Every attempt, with repeated settlements of an order flagged."""
        return flag_duplicates(
            self.stg_payments,
            keys=["order_id"],
            order=SETTLED_ORDER,
            row_id="payment_id",
            flag="is_duplicate_settlement",
            subset=settled(),
        )

    @cached_property
    def settlement_per_order(self) -> DataFrame:
        """The one settlement that counts, and what its repeats carried.

        The repeats are all settlements less the counted one, so no row needs
        to be ranked and an order with a huge number of repeats stays cheap.
        """
        won = first_per_key(
            self.stg_payments.filter(settled()).select(
                "order_id", "payment_id", "amount", "gateway_fee", "processed_at"
            ),
            keys=["order_id"],
            order=SETTLED_ORDER,
            row_id="payment_id",
            sums={"all_settled": F.sum("amount")},
        )
        repeats = F.coalesce("all_settled", F.lit(0)) - F.coalesce("amount", F.lit(0))
        return won.select(
            "order_id",
            F.col("payment_id").alias("settlement_payment_id"),
            F.col("amount").alias("settled_amount"),
            "gateway_fee",
            F.col("processed_at").alias("payment_processed_at"),
            repeats.alias("duplicate_amount"),
        )

    @cached_property
    def refunds_per_order(self) -> DataFrame:
        done = self.stg_refunds.filter(F.col("refund_status") == "completed")
        return done.groupBy("order_id").agg(
            F.sum("refund_amount").alias("refund_sum"),
            F.min("refund_processed_at").alias("first_refund_processed_at"),
            F.max("refund_processed_at").alias("last_refund_processed_at"),
            F.count(F.lit(1)).alias("refund_rows"),
        )

    @cached_property
    def shipment_per_order(self) -> DataFrame:
        return self.stg_shipping.groupBy("order_id").agg(
            F.min("shipment_status").alias("shipment_status"),
            F.min("shipped_at").alias("shipped_at"),
            F.max("delivered_at").alias("delivered_at"),
        )

    @cached_property
    def int_order_financials(self) -> DataFrame:
        sides = [self.settlement_per_order, self.refunds_per_order, self.shipment_per_order]
        joined = left_join_all(self.stg_orders, "order_id", sides)
        zero = F.lit(0)
        return joined.select(
            *self.stg_orders.columns,
            "settlement_payment_id",
            "settled_amount",
            "gateway_fee",
            "payment_processed_at",
            F.col("settlement_payment_id").isNotNull().alias("was_charged"),
            F.coalesce("duplicate_amount", zero).cast(ANY_MONEY).alias("duplicate_payment_amount"),
            F.coalesce("refund_sum", zero).cast(ANY_MONEY).alias("total_refunded"),
            "first_refund_processed_at",
            "last_refund_processed_at",
            F.coalesce("refund_rows", zero).alias("refund_count"),
            "shipment_status",
            "shipped_at",
            "delivered_at",
            (F.col("shipment_status") == "delivered").alias("was_delivered"),
        )

    # -- marts -----------------------------------------------------------

    @cached_property
    def fct_revenue(self) -> DataFrame:
        gross = F.coalesce("settled_amount", F.lit(0)).cast(ANY_MONEY)
        net = (gross - F.col("total_refunded")).cast(ANY_MONEY)
        fulfilled = F.col("shipped_at").isNotNull()
        leaked = F.coalesce(
            (F.col("order_status") == "cancelled") & F.col("was_charged") & (net > 0), F.lit(False)
        )
        return self.int_order_financials.select(
            "order_id",
            "customer_id",
            "order_status",
            "currency_code",
            "created_at",
            "updated_at",
            "has_clock_skew",
            "order_amount",
            "was_charged",
            "settled_amount",
            "gateway_fee",
            "payment_processed_at",
            "duplicate_payment_amount",
            "total_refunded",
            "refund_count",
            "first_refund_processed_at",
            "last_refund_processed_at",
            "shipment_status",
            "shipped_at",
            "delivered_at",
            "was_delivered",
            fulfilled.alias("was_fulfilled"),
            gross.alias("gross_revenue"),
            net.alias("net_revenue"),
            month_of("payment_processed_at").alias("revenue_recognition_month"),
            F.when(fulfilled, F.col("order_amount")).otherwise(0).alias("fulfilled_amount"),
            month_of("created_at").alias("fulfillment_month"),
            F.when(leaked, net).otherwise(0).cast(ANY_MONEY).alias("cancellation_leakage_amount"),
            leaked.alias("is_unrefunded_cancellation_leakage"),
        )

    @cached_property
    def fct_revenue_monthly(self) -> DataFrame:
        paid = self.fct_revenue.filter(F.col("revenue_recognition_month").isNotNull())
        same_month = month_of("last_refund_processed_at") == F.col("revenue_recognition_month")
        return paid.groupBy(F.col("revenue_recognition_month").alias("report_month")).agg(
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum(F.when(same_month, F.col("total_refunded")).otherwise(0)).alias("refunds_same_month"),
            F.sum("net_revenue").alias("net_revenue"),
            ratio(F.sum("total_refunded"), F.sum("gross_revenue")).alias("refund_rate"),
            F.sum("cancellation_leakage_amount").alias("cancellation_leakage"),
            F.sum("duplicate_payment_amount").alias("duplicate_payment_amount_excluded"),
            F.count(F.lit(1)).alias("orders_with_payment_activity"),
            F.count(F.when(F.col("is_unrefunded_cancellation_leakage"), 1)).alias("leakage_order_count"),
        )

    @cached_property
    def fct_revenue_reconciliation_bridge(self) -> DataFrame:
        """Operations' figure walked to finance's, per month of order creation.

        The published walk subtracts repeats that its start never contained and
        counts a partly refunded cancellation twice, so it is not an identity;
        ``unexplained_residual`` shows by how much it misses the ledger.
        """
        waiting = F.col("was_charged") & ~F.col("was_fulfilled") & (F.col("order_status") != "cancelled")
        later = month_of("last_refund_processed_at") > month_of("created_at")
        cohorts = self.fct_revenue.groupBy(month_of("created_at").alias("order_cohort_month")).agg(
            F.sum(F.when(F.col("was_fulfilled"), F.col("order_amount")).otherwise(0)).alias("ops_number"),
            F.sum(F.when(waiting, F.col("settled_amount")).otherwise(0)).alias("wip_charged_not_shipped"),
            F.sum("cancellation_leakage_amount").alias("cancellation_leakage"),
            F.sum("duplicate_payment_amount").alias("duplicate_payments_excluded"),
            F.sum("total_refunded").alias("cohort_lifetime_refunds"),
            F.sum(F.when(later, F.col("total_refunded")).otherwise(0)).alias("refunds_recognized_in_later_month"),
            F.sum("net_revenue").alias("_ledger"),
        )
        minus = ["duplicate_payments_excluded", "cohort_lifetime_refunds"]
        finance = walk("ops_number", ["wip_charged_not_shipped", "cancellation_leakage"], minus)
        adjustment = walk("wip_charged_not_shipped", ["cancellation_leakage"], minus)
        return cohorts.select(
            "order_cohort_month",
            "ops_number",
            "wip_charged_not_shipped",
            "cancellation_leakage",
            "duplicate_payments_excluded",
            "cohort_lifetime_refunds",
            "refunds_recognized_in_later_month",
            finance.cast(ANY_MONEY).alias("finance_reconciled_number"),
            adjustment.cast(ANY_MONEY).alias("total_bridge_adjustment"),
            ratio(adjustment, "ops_number").alias("gap_pct_of_ops_number"),
            (F.col("_ledger") - finance).cast(ANY_MONEY).alias("unexplained_residual"),
        )

    # -- business rules: each returns the violating rows ---------------------

    @cached_property
    def no_over_refunding(self) -> DataFrame:
        """Refunds of any status never exceed the payment they belong to."""
        if "refund_faults" in self.pinned:
            over = self.refund_faults.filter(F.col("total_refunded") > F.col("payment_amount"))
            return over.select("payment_id", "payment_amount", "total_refunded")
        refunded = self.stg_refunds.groupBy("payment_id").agg(F.sum("refund_amount").alias("total_refunded"))
        paid = self.stg_payments.select("payment_id", F.col("amount").alias("payment_amount"))
        both = refunded.join(paid, "payment_id").filter(F.col("total_refunded") > F.col("payment_amount"))
        return both.select("payment_id", "payment_amount", "total_refunded")

    @cached_property
    def refund_faults(self) -> DataFrame:
        """Payments that refunds exceed, and ids that refunds refer to and no payment has.

        Both need every refund and every payment by its id: they are moved once for the two.
        """
        refunded = references(self.stg_refunds, "payment_id", total_refunded=F.sum("refund_amount"))
        paid = self.stg_payments.select("payment_id", F.col("amount").alias("payment_amount"), F.lit(True).alias("is_known"))
        over = F.col("total_refunded") > F.col("payment_amount")
        return refunded.join(paid, "payment_id", "left").filter(F.col("is_known").isNull() | over)

    def unknown_references(self, relation: str, column: str) -> DataFrame | None:
        if (relation, column) != ("stg_refunds", "payment_id") or "refund_faults" not in self.pinned:
            return None
        unknown = self.refund_faults.filter(F.col("is_known").isNull() & F.col("payment_id").isNotNull())
        return unknown.select("payment_id", "n_rows")

    @cached_property
    def counted_settlements(self) -> DataFrame:
        """What the rules read of the settlements that count."""
        counted = self.int_payments_deduped.filter(settled() & ~F.col("is_duplicate_settlement"))
        return counted.select("order_id", "amount")

    @cached_property
    def no_duplicate_settlements_counted_in_revenue(self) -> DataFrame:
        per_order = self.counted_settlements.groupBy("order_id").agg(F.count(F.lit(1)).alias("non_duplicate_succeeded_payments"))
        return per_order.filter(F.col("non_duplicate_succeeded_payments") > 1)

    @cached_property
    def bridge_ties_to_fct_revenue(self) -> DataFrame:
        mart = self.fct_revenue.groupBy(month_of("created_at").alias("order_cohort_month")).agg(
            F.sum("net_revenue").alias("mart_net_revenue")
        )
        bridge = self.fct_revenue_reconciliation_bridge.select("order_cohort_month", "finance_reconciled_number")
        gap = F.abs(F.col("finance_reconciled_number") - F.col("mart_net_revenue"))
        off = disagree("finance_reconciled_number", "mart_net_revenue", self.params.tie_tolerance)
        return bridge.join(mart, "order_cohort_month").filter(off).withColumn("diff", gap.cast(ANY_MONEY))

    @cached_property
    def net_revenue_ties_to_raw_ledger(self) -> DataFrame:
        """Net revenue against payments less refunds, recounted from staging."""
        paid = self.counted_settlements.agg(F.sum("amount").alias("_paid"))
        back = self.stg_refunds.filter(F.col("refund_status") == "completed").agg(
            F.sum("refund_amount").alias("_refunded")
        )
        mart = self.fct_revenue.agg(F.sum("net_revenue").alias("mart_net_revenue"))
        both = paid.crossJoin(back).crossJoin(mart)
        both = both.withColumn("ledger_net_revenue", (F.col("_paid") - F.col("_refunded")).cast(ANY_MONEY))
        gap = F.abs(F.col("ledger_net_revenue") - F.col("mart_net_revenue"))
        off = disagree("ledger_net_revenue", "mart_net_revenue", self.params.tie_tolerance)
        return both.filter(off).select("ledger_net_revenue", "mart_net_revenue", gap.cast(ANY_MONEY).alias("diff"))

    @cached_property
    def non_base_currency_volume(self) -> DataFrame:
        """Orders outside the base currency, per month (carried, never converted)."""
        foreign = self.stg_orders.filter(F.col("currency_code") != self.params.base_currency)
        return foreign.groupBy(month_of("created_at").alias("order_month")).agg(
            F.count(F.lit(1)).alias("non_base_orders"), F.sum("order_amount").alias("non_base_amount")
        )
