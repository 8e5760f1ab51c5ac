"""Each reusable operator on its own, over the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import MONEY, active_on, clean_lower, clean_upper, days_from, in_window, ratio
from ..operators import (
    distinct_counts,
    first_per_key,
    flag_duplicates,
    flag_orphans,
    join_one_row_frames,
    latest_by_key,
    latest_record_per_key,
    left_join_all,
    lookup,
    rows_where,
    segment_rollup,
    total_of,
    totals_last,
    weighted_mean,
)
from ..params import LendingParams, WorkforceParams, day
from ..sources.driver_tables import (
    LENDING_AS_OF,
    WORKFORCE_AS_OF,
    WORKFORCE_WINDOW_START,
    feeds,
    line_key,
    table,
)
from .lending import Lending
from .revenue import Revenue
from .visits import Visits
from .workforce import Workforce

c = F.col

def price() -> Column:
    return c("l_extendedprice").cast(MONEY)


def total_price() -> Column:
    return c("o_totalprice").cast(MONEY)


def revenue(spark: SparkSession, folder: str) -> Revenue:
    return Revenue(feeds(spark, folder, "revenue"))


def lending(spark: SparkSession, folder: str) -> Lending:
    return Lending(feeds(spark, folder, "lending"), LendingParams(LENDING_AS_OF))


def visits(spark: SparkSession, folder: str) -> Visits:
    return Visits(feeds(spark, folder, "visits"))


def workforce(spark: SparkSession, folder: str) -> Workforce:
    return Workforce(feeds(spark, folder, "workforce"), WorkforceParams(WORKFORCE_AS_OF, WORKFORCE_WINDOW_START))


# -- projections and predicates ----------------------------------------------


def normalize_project(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        c("c_custkey").alias("customer_id"),
        clean_lower("c_mktsegment").alias("segment"),
        clean_upper("c_name").alias("customer_name"),
        c("c_acctbal").cast(MONEY).alias("balance"),
    )


def flag_clock_skew(spark: SparkSession, folder: str) -> DataFrame:
    return revenue(spark, folder).stg_orders.select("order_id", "created_at", "updated_at", "has_clock_skew")


def date_window_filter(spark: SparkSession, folder: str) -> DataFrame:
    shipped = table(spark, folder, "lineitem").filter(
        in_window(c("l_shipdate").cast("date"), day("1997-01-01"), day("1997-12-31"))
    )
    return shipped.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"), F.sum(price()).alias("amount"))


def point_in_time_headcount(spark: SparkSession, folder: str) -> DataFrame:
    records = workforce(spark, folder).int_employment_records_resolved
    present = records.filter(active_on("hire_date", "termination_date", day(WORKFORCE_WINDOW_START)))
    return distinct_counts(present, ["department_id"], "person_id", {"headcount": None})


def priority_classify(spark: SparkSession, folder: str) -> DataFrame:
    kind = (
        F.when(c("l_returnflag") == "R", "returned")
        .when(c("l_linestatus") == "O", "open")
        .when(c("l_discount") >= 0.05, "discounted")
        .otherwise("plain")
    )
    return table(spark, folder, "lineitem").groupBy(kind.alias("line_kind")).agg(F.count(F.lit(1)).alias("lines"))


def bucketize_dpd(spark: SparkSession, folder: str) -> DataFrame:
    loans = lending(spark, folder).fct_loan_performance
    return loans.groupBy("risk_bucket").agg(
        F.count(F.lit(1)).alias("loans"), F.min("true_dpd").alias("least_dpd"), F.max("true_dpd").alias("most_dpd")
    )


# -- joins -------------------------------------------------------------------


def left_join_preagg(spark: SparkSession, folder: str) -> DataFrame:
    """Two fact tables reduced to the customer before either is joined."""
    orders = table(spark, folder, "orders")
    spent = orders.groupBy(c("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(total_price()).alias("spent")
    )
    seen = (
        table(spark, folder, "events")
        .groupBy(c("user_id").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("events"), F.max("ts").alias("last_event_at"))
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return left_join_all(customers, "c_custkey", [spent, seen]).select(
        "c_custkey",
        "c_mktsegment",
        F.coalesce("orders", F.lit(0)).alias("orders"),
        F.coalesce("spent", F.lit(0).cast(MONEY)).alias("spent"),
        F.coalesce("events", F.lit(0)).alias("events"),
        "last_event_at",
    )


def inner_join(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    return orders.join(customers, c("o_custkey") == c("c_custkey")).select(
        "o_orderkey", "c_custkey", "c_mktsegment", total_price().alias("amount")
    )


def prior_record_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return workforce(spark, folder).int_employment_chain_classified.select(
        "employee_id", "prior_employee_id", "prior_resolved_state", "prior_termination_date"
    )


def validate_links(spark: SparkSession, folder: str) -> DataFrame:
    return visits(spark, folder).int_appointments_canonical.select(
        "appointment_id", "rescheduled_to_id", "has_validated_reschedule_link", "has_orphaned_reschedule_link"
    )


def anti_join_roots(spark: SparkSession, folder: str) -> DataFrame:
    """Slots nobody was moved into: no backward link, or one to a lost row."""
    return visits(spark, folder).live_slots.filter("is_root").select(c("appointment_id").alias("root_appointment_id"))


def resolve_chains(spark: SparkSession, folder: str) -> DataFrame:
    return visits(spark, folder).chains.terminal


def cross_join_scalars(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").agg(F.sum(price()).alias("line_amount"), F.count(F.lit(1)).alias("lines"))
    orders = table(spark, folder, "orders").agg(F.sum(total_price()).alias("order_amount"))
    events = table(spark, folder, "events").agg(F.count(F.lit(1)).alias("events"))
    return join_one_row_frames(lines, orders, events).withColumn("line_share", ratio("line_amount", "order_amount"))


def dimension_lookup(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation")
    return lookup(customers, nations, "c_nationkey", "n_nationkey", "c_custkey", {"nation_name": "n_name"})


def orphan_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose customer has no positive balance count as orphaned."""
    live = table(spark, folder, "customer").filter(c("c_acctbal") > 0).select("c_custkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return flag_orphans(orders, live, "o_custkey", "c_custkey", "o_orderkey", "is_orphaned_order")


# -- aggregates ----------------------------------------------------------------


def grouped_basic_agg(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.sum(price()).alias("amount"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.count(F.lit(1)).alias("lines"),
    )


def conditional_sum(spark: SparkSession, folder: str) -> DataFrame:
    returned = F.when(c("l_returnflag") == "R", price()).otherwise(0)
    return table(spark, folder, "lineitem").groupBy("l_linenumber").agg(
        F.sum(price()).alias("amount"), F.sum(returned).cast("decimal(38,2)").alias("returned_amount")
    )


def conditional_count(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").groupBy("o_orderpriority").agg(
        F.count(F.when(c("o_orderstatus") == "F", 1)).alias("filled"),
        F.count(F.when(c("o_totalprice") > 200000, 1)).alias("large"),
    )


def conditional_count_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_counts(
        table(spark, folder, "lineitem"),
        ["l_suppkey"],
        "l_partkey",
        {
            "parts": None,
            "returned_parts": c("l_returnflag") == "R",
            "open_parts": c("l_linestatus") == "O",
        },
    )


def latest_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    return latest_by_key(
        table(spark, folder, "orders"),
        ["o_custkey"],
        at="o_orderdate",
        row_id="o_orderkey",
        picks={"latest_orderkey": "o_orderkey", "latest_status": "o_orderstatus"},
        aggs=[F.count(F.lit(1)).alias("orders")],
    )


def any_flag(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.bool_or(c("l_returnflag") == "R").alias("any_returned"), F.bool_or(c("l_linestatus") == "O").alias("any_open")
    )


def weighted_mean_total(spark: SparkSession, folder: str) -> DataFrame:
    """Mean balance per segment, and the weighted mean of those means."""
    per_segment = table(spark, folder, "customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.avg(c("c_acctbal").cast(MONEY)), 2).cast(MONEY).alias("mean_balance"),
    )
    return per_segment.agg(
        F.sum("customers").alias("customers"),
        F.round(weighted_mean("mean_balance", "customers"), 2).cast(MONEY).alias("mean_balance"),
    )


def having_filter(spark: SparkSession, folder: str) -> DataFrame:
    per_customer = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(total_price()).alias("spent")
    )
    return per_customer.filter(c("spent") > 3_000_000)


def _priority_rollup(spark: SparkSession, folder: str) -> DataFrame:
    large = c("o_totalprice") > 200000
    return segment_rollup(
        table(spark, folder, "orders"),
        "o_orderpriority",
        {"orders": rows_where(), "large_orders": rows_where(large), "amount": total_of(total_price())},
    )


def rollup_by_priority(spark: SparkSession, folder: str) -> DataFrame:
    return _priority_rollup(spark, folder).withColumn("large_share", ratio("large_orders", "orders"))


def totals_last_sort(spark: SparkSession, folder: str) -> DataFrame:
    return totals_last(_priority_rollup(spark, folder), "o_orderpriority")


# -- one row per key -------------------------------------------------------------


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").withColumn("line_id", line_key())


def repeated_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder).select("line_id", "l_orderkey", "l_linenumber", "l_shipdate")
    return flag_duplicates(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"], "line_id", "is_duplicate")


def repeated_events_preferring_value(spark: SparkSession, folder: str) -> DataFrame:
    """Per user, type and day the first event of at least 10 is kept, else the first."""
    events = table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", c("ts").cast("date").alias("event_day"), "value"
    )
    small = F.when(c("value") >= 10, 0).otherwise(1)
    return flag_duplicates(events, ["user_id", "event_type", "event_day"], [small], "event_id", "is_duplicate")


def repeated_returns_only(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder).select("line_id", "l_orderkey", "l_returnflag", "l_shipdate")
    return flag_duplicates(
        lines, ["l_orderkey"], ["l_shipdate"], "line_id", "is_duplicate", subset=c("l_returnflag") == "R"
    )


def first_line_per_order(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder).select("line_id", "l_orderkey", "l_shipdate", "l_partkey", price().alias("amount"))
    return first_per_key(lines, ["l_orderkey"], ["l_shipdate"], "line_id")


def latest_event_per_user(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return latest_record_per_key(events, ["user_id"], "ts", "event_id")


def days_overdue(spark: SparkSession, folder: str) -> DataFrame:
    due = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").cast("date").alias("due"))
    return due.select("l_orderkey", days_from("due", day(LENDING_AS_OF)).alias("days_overdue"))


OPERATOR_QUERIES = {
    "normalize_project": normalize_project,
    "flag_clock_skew": flag_clock_skew,
    "date_window_filter": date_window_filter,
    "point_in_time_headcount": point_in_time_headcount,
    "priority_classify": priority_classify,
    "bucketize_dpd": bucketize_dpd,
    "days_overdue": days_overdue,
    "left_join_preagg": left_join_preagg,
    "inner_join": inner_join,
    "prior_record_lookup": prior_record_lookup,
    "validate_links": validate_links,
    "anti_join_roots": anti_join_roots,
    "resolve_chains": resolve_chains,
    "cross_join_scalars": cross_join_scalars,
    "dimension_lookup": dimension_lookup,
    "flag_orphans": orphan_orders,
    "grouped_basic_agg": grouped_basic_agg,
    "conditional_sum": conditional_sum,
    "conditional_count": conditional_count,
    "conditional_count_distinct": conditional_count_distinct,
    "latest_by_key": latest_per_customer,
    "any_flag": any_flag,
    "weighted_mean_total": weighted_mean_total,
    "having_filter": having_filter,
    "segment_rollup": rollup_by_priority,
    "totals_last_sort": totals_last_sort,
    "flag_duplicates": repeated_lines,
    "flag_duplicates_preferred": repeated_events_preferring_value,
    "flag_duplicates_subset": repeated_returns_only,
    "first_per_key": first_line_per_order,
    "latest_record_per_key": latest_event_per_user,
}
