"""The supplied star-schema tables, reshaped as the sixteen raw feeds.

Every feed is a row-wise projection of the whole table it comes from: each line is
a payment attempt, a refund request, a shipment and a repayment, each order a loan
and an entry of the default register. Payments and refunds also look up their
order; patients and doctors are the distinct ids of the events. The dirt that the
models must cope with - padding, case, repeats, lost links, misflags, clock
skew - follows from the data and from remainders of its keys.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import MONEY
from ..session import cut_lineage, forget
from .raw import Raw

LENDING_AS_OF = "2001-11-30"
WORKFORCE_AS_OF, WORKFORCE_WINDOW_START = "2001-12-31", "2001-01-01"
FRESHNESS_NOW = {
    "revenue": "2001-08-05 20:00:00",
    "lending": "2001-08-02 14:30:00",
    "visits": "2024-01-25 05:00:00",
    "workforce": "2001-11-06 04:00:00",
}

# The columns of the supplied tables that the feeds use.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

c = F.col


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A supplied table, in the splits that its files have."""
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def every(column: str | Column, n: int, at: int = 0) -> Column:
    col = c(column) if isinstance(column, str) else column
    return F.pmod(col, F.lit(n)) == at


def plus_days(ts: str, days: int | Column) -> Column:
    n = F.lit(days) if isinstance(days, int) else days
    return c(ts) + F.make_dt_interval(days=n.cast("int"))


def cents(x: Column) -> Column:
    return F.rint(x * 100).cast("long")


def money(x: Column) -> Column:
    """A double amount as an exact decimal, by way of its cents."""
    return (cents(x).cast("decimal(15,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def share(x: Column, part: str) -> Column:
    return (money(x) * F.lit(part).cast("decimal(3,2)")).cast(MONEY)


def text(x: str) -> Column:
    return c(x).cast("string")


def line_key() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents(c("l_extendedprice")))


def null_unless(condition: Column, value: Column) -> Column:
    return F.when(condition, value)


# -- revenue ---------------------------------------------------------------


def currency() -> Column:
    return F.when(every("o_custkey", 7), " eur").otherwise("usd ")


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    order_status = (
        F.when(every("o_orderkey", 9), " Cancelled ")
        .when(c("o_orderstatus") == "F", "COMPLETED")
        .when(c("o_orderstatus") == "O", "confirmed")
        .otherwise("placed")
    )
    return table(spark, folder, "orders").select(
        text("o_orderkey").alias("order_id"),
        text("o_custkey").alias("customer_id"),
        order_status.alias("order_status"),
        money(c("o_totalprice")).alias("order_amount"),
        currency().alias("currency"),
        c("o_orderdate").alias("created_at"),
        F.when(every("o_orderkey", 500), plus_days("o_orderdate", -1))
        .otherwise(plus_days("o_orderdate", 3))
        .alias("updated_at"),
    )


def ordered_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.join(table(spark, folder, "orders"), c("l_orderkey") == c("o_orderkey"))


def raw_payments(spark: SparkSession, folder: str) -> DataFrame:
    return payments_of(ordered_lines(spark, folder))


def payments_of(lines: DataFrame) -> DataFrame:
    first_line = c("l_linenumber") == 1
    return lines.select(
        line_key().alias("payment_id"),
        text("l_orderkey").alias("order_id"),
        F.when(first_line, "Succeeded").otherwise(" failed").alias("payment_status"),
        money(c("o_totalprice")).alias("amount"),
        currency().alias("currency"),
        F.when(every("l_partkey", 2), "card").otherwise("wallet").alias("payment_method"),
        share(c("o_totalprice"), "0.02").alias("gateway_fee"),
        c("l_shipdate").alias("attempted_at"),
        null_unless(first_line, c("l_shipdate")).alias("processed_at"),
    )


def raw_refunds(spark: SparkSession, folder: str) -> DataFrame:
    return refunds_of(ordered_lines(spark, folder))


def refunds_of(lines: DataFrame) -> DataFrame:
    whole = c("l_returnflag") == "R"
    half = (c("l_returnflag") == "A") & every("l_partkey", 3)
    paid_back = (c("l_linenumber") == 1) & (whole | half)
    return lines.select(
        line_key().alias("refund_id"),
        text("l_orderkey").alias("order_id"),
        line_key().alias("payment_id"),
        F.when(whole, money(c("o_totalprice"))).otherwise(share(c("o_totalprice"), "0.50")).alias("refund_amount"),
        currency().alias("currency"),
        F.when(whole, "returned").otherwise("damaged").alias("refund_reason"),
        F.when(paid_back, "Completed ").otherwise(" pending").alias("refund_status"),
        plus_days("l_shipdate", 30).alias("requested_at"),
        null_unless(paid_back, plus_days("l_shipdate", 40)).alias("processed_at"),
    )


def raw_shipping(spark: SparkSession, folder: str) -> DataFrame:
    done = c("l_linestatus") == "F"
    return table(spark, folder, "lineitem").select(
        line_key().alias("shipment_id"),
        text("l_orderkey").alias("order_id"),
        F.when(every("l_suppkey", 2), "post").otherwise("courier").alias("carrier"),
        share(c("l_extendedprice"), "0.01").alias("shipping_cost"),
        F.when(done, " Delivered").otherwise("in_transit").alias("status"),
        null_unless(~every("l_suppkey", 10), c("l_shipdate")).alias("shipped_at"),
        null_unless(done, plus_days("l_shipdate", 5)).alias("delivered_at"),
    )


# -- lending ---------------------------------------------------------------


def raw_applications(spark: SparkSession, folder: str) -> DataFrame:
    declined = every("o_orderkey", 13)
    return table(spark, folder, "orders").select(
        text("o_orderkey").alias("application_id"),
        text("o_custkey").alias("customer_id"),
        c("o_orderpriority").alias("product_type"),
        F.when(every("o_custkey", 2), "web").otherwise("branch").alias("channel"),
        money(c("o_totalprice")).alias("requested_amount"),
        F.lit("usd ").alias("currency"),
        F.when(declined, " Declined").when(c("o_orderstatus") == "P", "PENDING").otherwise("approved ").alias("decision"),
        null_unless(declined, F.lit("affordability")).alias("decline_reason"),
        c("o_orderdate").alias("submitted_at"),
        F.when(every("o_orderkey", 500), plus_days("o_orderdate", -1))
        .otherwise(plus_days("o_orderdate", 2))
        .alias("decided_at"),
    )


def raw_loans(spark: SparkSession, folder: str) -> DataFrame:
    restructured = every("o_orderkey", 5)
    loan_status = (
        F.when(c("o_orderstatus") == "F", "CLOSED")
        .when(restructured, " restructured")
        .when(c("o_orderstatus") == "O", "active")
        .otherwise("delinquent")
    )
    return table(spark, folder, "orders").select(
        text("o_orderkey").alias("loan_id"),
        text("o_orderkey").alias("application_id"),
        text("o_custkey").alias("customer_id"),
        c("o_orderpriority").alias("product_type"),
        money(c("o_totalprice")).alias("principal_amount"),
        F.lit(" usd").alias("currency"),
        ((F.pmod("o_custkey", F.lit(10)) + 5).cast("double") / 100).alias("interest_rate_apr"),
        ((F.pmod("o_orderkey", F.lit(5)) + 1) * 12).cast("int").alias("term_months"),
        loan_status.alias("loan_status"),
        c("o_orderdate").alias("originated_at"),
        F.date_add(c("o_orderdate").cast("date"), 30).alias("first_due_date"),
        null_unless(restructured, plus_days("o_orderdate", 200)).alias("restructured_at"),
    )


def raw_repayments(spark: SparkSession, folder: str) -> DataFrame:
    missed = every("l_partkey", 4) & (c("l_shipdate") > F.lit("1999-01-01").cast("timestamp_ntz"))
    short = c("l_returnflag") == "N"
    return table(spark, folder, "lineitem").select(
        line_key().alias("repayment_id"),
        text("l_orderkey").alias("loan_id"),
        c("l_linenumber").alias("instalment_no"),
        money(c("l_extendedprice")).alias("scheduled_amount"),
        F.when(missed, F.lit(0).cast(MONEY))
        .when(short, share(c("l_extendedprice"), "0.60"))
        .otherwise(money(c("l_extendedprice")))
        .alias("amount_paid"),
        F.lit("usd").alias("currency"),
        F.when(missed, "missed").when(short, " Partial").otherwise("POSTED").alias("payment_status"),
        c("l_shipdate").cast("date").alias("due_date"),
        null_unless(~missed, plus_days("l_shipdate", 2)).alias("paid_at"),
    )


def raw_defaults(spark: SparkSession, folder: str) -> DataFrame:
    copies = F.when(every("o_orderkey", 60), F.array(F.lit("D"), F.lit("E"))).otherwise(F.array(F.lit("D")))
    second = c("entry") == "E"
    kind = F.pmod("o_orderkey", F.lit(36))
    return (
        table(spark, folder, "orders")
        .withColumn("entry", F.explode(copies))
        .select(
            F.concat(c("entry"), text("o_orderkey")).alias("default_id"),
            # twelve orders in a row report on one loan
            (c("o_orderkey") - F.pmod("o_orderkey", F.lit(12))).cast("string").alias("loan_id"),
            F.when(second, "arrears").when(kind == 0, "fraud").when(kind == 12, "arrears").otherwise("deceased").alias("default_reason"),
            F.when(second, share(c("o_totalprice"), "0.40")).otherwise(share(c("o_totalprice"), "0.50")).alias("outstanding_at_default"),
            F.lit("usd").alias("currency"),
            F.when(second, "Written_Off").when(kind == 0, " open").when(kind == 12, "IN_RECOVERY").otherwise("open").alias("default_status"),
            F.when(second, plus_days("o_orderdate", 400)).otherwise(plus_days("o_orderdate", 300)).alias("flagged_at"),
        )
    )


# -- visits ----------------------------------------------------------------

# Reschedule links, by remainder of the event id: forward to the next id from
# these remainders of 40, and back to the previous id from those.
FORWARD_40 = (1, 5, 6, 10, 11, 12, 13, 14, 15, 22, 25, 30)
BACKWARD_40 = (2, 6, 7, 11, 12, 13, 14, 15, 16, 26)
LONG_CHAIN_2000 = (1000, 1013)  # forward from 1000..1012, back from 1001..1013


def raw_appointments(spark: SparkSession, folder: str) -> DataFrame:
    kind, event = c("event_type"), c("event_id")
    by40, by2000 = F.pmod(event, F.lit(40)), F.pmod(event, F.lit(2000))
    first, last = LONG_CHAIN_2000
    forward = (
        F.when(by40.isin(*FORWARD_40) | by2000.between(first, last - 1), event + 1)
        .when(by40 == 20, F.lit(-1))  # points nowhere
        .when(by40 == 27, event - 1)  # a second way into the same slot
        .when(by40 == 31, event - 1)  # closes a loop
    )
    backward = F.when(by40.isin(*BACKWARD_40) | by2000.between(first + 1, last), event - 1).when(
        (by40 == 30) | (by40 == 31), F.when(by40 == 30, event + 1).otherwise(event - 1)
    )
    status = (
        F.when(kind == "view", "Attended")
        .when(kind == "click", "no_show ")
        .when(kind == "error", "Missed")
        .when(kind == "purchase", "cancelled")
        .when(every(event, 2), "no-show")
        .otherwise("rescheduled")
    )
    reason = F.when(
        (kind == "purchase") | ((kind == "click") & every(event, 6)) | ((kind == "signup") & every(event, 70)), "Patient "
    )
    attended = kind == "view"
    return table(spark, folder, "events").select(
        text("event_id").alias("appointment_id"),
        text("user_id").alias("patient_id"),
        F.pmod(event, F.lit(4)).cast("string").alias("doctor_id"),
        F.concat(F.lit("Loc"), F.pmod("user_id", F.lit(5))).alias("location"),
        F.when(every("user_id", 3), " New").otherwise("Follow_Up").alias("appointment_type"),
        status.alias("status"),
        c("ts").cast("date").cast("timestamp_ntz").alias("scheduled_for"),
        plus_days("ts", -7).alias("booked_at"),
        null_unless(attended, c("ts")).alias("checked_in_at"),
        null_unless(attended, plus_days("ts", 1)).alias("checkout_at"),
        reason.alias("cancel_reason"),
        forward.cast("string").alias("rescheduled_to_id"),
        backward.cast("string").alias("rescheduled_from_id"),
    )


def raw_billing(spark: SparkSession, folder: str) -> DataFrame:
    kind, event = c("event_type"), c("event_id")
    line_type = (
        F.when(kind == "view", "Office_Visit")
        .when(kind == "purchase", " late_cancel_fee")
        .when((kind == "signup") & every(event, 3), "office_visit")
        .otherwise("no_show_fee ")
    )
    billed_to = F.when(every(event, 97), -event - 1).when(every(event, 11, 1), event - 1).otherwise(event)
    return table(spark, folder, "events").select(
        F.concat(F.lit("B"), event).alias("billing_id"),
        billed_to.cast("string").alias("appointment_id"),
        text("user_id").alias("patient_id"),
        line_type.alias("line_type"),
        money(c("value")).alias("billed_amount"),
        share(c("value"), "0.80").alias("insurance_covered"),
        (money(c("value")) - share(c("value"), "0.80")).cast(MONEY).alias("patient_responsibility"),
        c("ts").alias("service_at"),
        plus_days("ts", F.pmod(event, F.lit(45))).alias("posted_at"),
    )


def raw_patients(spark: SparkSession, folder: str) -> DataFrame:
    user = c("user_id")
    return (
        table(spark, folder, "events")
        .groupBy("user_id")
        .agg(F.min("ts").alias("seen"))
        .select(
            text("user_id").alias("patient_id"),
            (F.pmod(user, F.lit(70)) + 1930).cast("int").alias("birth_year"),
            F.when(every(user, 3), " f").when(every(user, 3, 1), "m").otherwise("X ").alias("sex"),
            F.when(every(user, 2), "Gold ").otherwise("basic").alias("insurance_plan"),
            F.concat(F.lit(" Loc"), F.pmod(user, F.lit(5))).alias("home_location"),
            c("seen").alias("registered_at"),
        )
    )


def raw_doctors(spark: SparkSession, folder: str) -> DataFrame:
    doctor = c("doctor")
    return (
        table(spark, folder, "events")
        .groupBy(F.pmod("event_id", F.lit(4)).alias("doctor"))
        .agg(F.min("ts").alias("seen"))
        .select(
            text("doctor").alias("doctor_id"),
            F.concat(F.lit("Dr "), doctor).alias("provider_name"),
            F.when(every(doctor, 2), "Cardiology ").otherwise("gp").alias("specialty"),
            F.concat(F.lit("LOC"), doctor).alias("primary_location"),
            c("seen").alias("hired_at"),
            (doctor != 3).alias("is_active"),
        )
    )


# -- workforce -------------------------------------------------------------


def raw_departments(spark: SparkSession, folder: str) -> DataFrame:
    regions, nations = table(spark, folder, "region"), table(spark, folder, "nation")
    return nations.join(regions, c("n_regionkey") == c("r_regionkey"), "left").select(
        text("n_nationkey").alias("department_id"),
        F.concat(F.lit("D"), c("n_nationkey")).alias("department_code"),
        c("n_name").alias("department_name"),
        c("r_name").alias("division"),
        F.concat(F.lit("CC"), c("n_regionkey")).alias("cost_center"),
    )


def raw_employees(spark: SparkSession, folder: str) -> DataFrame:
    """Four consecutive orders are one person's employment records.

    A move follows another record without a gap, a rehire after 45 days. One
    person in four has three stints and a double-loaded copy of the last.
    """
    key = c("o_orderkey")
    person = F.floor(key / 4).cast("long")
    p = c("p")
    stints = F.when(every(p, 4), 3).otherwise(4)
    stint = F.least(F.pmod(key, F.lit(4)).cast("int"), stints - 1)
    e = c("e")

    def rehired_after(j: int | Column) -> Column:
        return F.pmod(p + j, F.lit(3)) == 0

    gaps = sum((F.when((e > j) & rehired_after(j), 45).otherwise(0) for j in range(3)), F.lit(0))
    length = F.pmod(p * 31, F.lit(350)) + 150
    anchor = F.date_add(F.lit("1995-01-01").cast("date"), F.pmod(p * 97, F.lit(1000)).cast("int"))
    hire = F.date_add(anchor, (e * length + gaps).cast("int"))
    is_last = e == stints - 1
    leaves = every(p, 4, 1) | every(p, 8)
    end = F.when(~is_last | leaves, F.date_add(hire, length.cast("int")))
    status = (
        F.when(~is_last & rehired_after(e), " Terminated")
        .when(~is_last | (leaves & every(p, 20, 1)), "transferred ")
        .when(leaves | every(p, 10, 3), "terminated")
        .otherwise("Active")
    )
    return (
        table(spark, folder, "orders")
        .withColumn("p", person)
        .withColumn("e", stint)
        .select(
            text("o_orderkey").alias("employee_id"),
            text("p").alias("person_id"),
            F.concat(F.lit("Person "), p).alias("full_name"),
            F.pmod(p + e, F.lit(25)).cast("string").alias("department_id"),
            F.concat(F.lit("L"), F.substring("o_orderpriority", 1, 1)).alias("job_level"),
            F.when(every("o_custkey", 7), " Contract").otherwise("Full_Time ").alias("employment_type"),
            F.concat(F.lit("Site "), F.pmod("o_custkey", F.lit(6))).alias("location"),
            hire.alias("hire_date"),
            end.alias("termination_date"),
            status.alias("employment_status"),
            F.when(e >= 1, p * 4 + e - 1).cast("string").alias("prior_employee_id"),
        )
    )


def paid_employee() -> Column:
    unknown = -c("l_orderkey") - 1
    return F.when(every("l_suppkey", 50), unknown).otherwise(c("l_orderkey")).cast("string")


def line_person() -> Column:
    return F.floor(c("l_orderkey") / 4).cast("long").cast("string")


def raw_payroll(spark: SparkSession, folder: str) -> DataFrame:
    pay_in = F.pmod("l_suppkey", F.lit(4))
    return table(spark, folder, "lineitem").select(
        line_key().alias("payroll_id"),
        paid_employee().alias("employee_id"),
        line_person().alias("person_id"),
        F.concat(F.lit("2001-0"), c("l_linenumber")).alias("pay_period"),
        money(c("l_extendedprice")).alias("gross_pay"),
        F.when(pay_in == 0, "usd ").when(pay_in == 1, " gbp").when(pay_in == 2, "eur").otherwise("sgd").alias("currency"),
        (c("l_quantity") < 5).alias("is_partial_period"),
        c("l_shipdate").alias("paid_at"),
    )


def raw_performance_reviews(spark: SparkSession, folder: str) -> DataFrame:
    quantity = c("l_quantity")
    graded = F.when(quantity > 37, "Outstanding ").when(quantity > 25, "exceeds").when(quantity > 12, " Meets")
    score = F.when(quantity > 37, "4.50").when(quantity > 25, "3.75").when(quantity > 12, "3.00").otherwise("1.50")
    return table(spark, folder, "lineitem").select(
        line_key().alias("review_id"),
        paid_employee().alias("employee_id"),
        line_person().alias("person_id"),
        F.concat(F.lit("H"), F.pmod("l_linenumber", F.lit(3))).alias("review_period"),
        graded.otherwise("below").alias("rating"),
        score.cast("decimal(4,2)").alias("review_score"),
        F.concat(F.lit("R"), F.pmod("l_suppkey", F.lit(20))).alias("reviewer_id"),
        null_unless(~every("l_suppkey", 10), c("l_shipdate").cast("date")).alias("review_date"),
    )


#: The feeds that are made of lines and their orders, and the columns that they read.
OF_ORDERED_LINES = {"payments": payments_of, "refunds": refunds_of}
ORDERED_LINE = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_returnflag",
    "l_shipdate",
    "o_custkey",
    "o_totalprice",
)

FEEDS = {
    "revenue": {"orders": raw_orders, "payments": raw_payments, "refunds": raw_refunds, "shipping": raw_shipping},
    "lending": {
        "applications": raw_applications,
        "loans": raw_loans,
        "repayments": raw_repayments,
        "defaults": raw_defaults,
    },
    "visits": {
        "patients": raw_patients,
        "doctors": raw_doctors,
        "appointments": raw_appointments,
        "billing": raw_billing,
    },
    "workforce": {
        "departments": raw_departments,
        "employees": raw_employees,
        "payroll": raw_payroll,
        "performance_reviews": raw_performance_reviews,
    },
}


class Feeds(Mapping):
    """The feeds of one project, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str, project: str) -> None:
        self.spark, self.folder, self.makers = spark, folder, FEEDS[project]
        self.built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            self.built[name] = self.makers[name](self.spark, self.folder)
        return self.built[name]

    @contextmanager
    def kept(self) -> Iterator[None]:
        """In here, lines are joined with their orders once, written, and read by the feeds made of them."""
        if not OF_ORDERED_LINES.keys() <= self.makers.keys():
            yield
            return
        before = self.built
        lines = cut_lineage(ordered_lines(self.spark, self.folder).select(*ORDERED_LINE), "zstd")
        self.built = {name: make(lines) for name, make in OF_ORDERED_LINES.items()}
        try:
            yield
        finally:
            self.built = before
            forget(lines)

    def __iter__(self) -> Iterator[str]:
        return iter(self.makers)

    def __len__(self) -> int:
        return len(self.makers)


def feeds(spark: SparkSession, folder: str, project: str) -> Raw:
    return Feeds(spark, folder, project)
