"""Workforce: naive against true attrition, and three tenures side by side."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    active_on,
    clean_lower,
    clean_upper,
    days_from,
    in_window,
    ratio,
    years_of,
)
from ..operators import (
    TOTAL,
    disagree,
    first_per_key,
    flag_duplicates,
    flag_orphans,
    join_one_row_frames,
    lookup,
    walk,
    weighted_mean,
    winning_ids,
)
from ..params import WorkforceParams, day
from ..sources.raw import Raw
from .base import Project

EPISODE = ["person_id", "department_id", "hire_date", "termination_date"]


def resolved_state() -> Column:
    """The end date decides whether a record is open; the status only says how it closed."""
    return (
        F.when(F.col("termination_date").isNull(), "open")
        .when(F.col("raw_employment_status") == "transferred", "transferred_out")
        .otherwise("terminated")
    )


class Workforce(Project):
    name = "workforce"
    staging = ("stg_departments", "stg_employees", "stg_payroll", "stg_performance_reviews")
    intermediate = (
        "int_employees_deduped",
        "int_employment_records_resolved",
        "int_employment_chain_classified",
        "int_person_employment_summary",
        "int_payroll_deduped",
        "int_reviews_deduped",
    )
    marts = ("fct_workforce", "fct_department_workforce", "fct_attrition_tenure_reconciliation_bridge")
    by_segment = {"fct_department_workforce": "department_name"}

    def __init__(self, raw: Raw, params: WorkforceParams = WorkforceParams()) -> None:
        super().__init__(raw)
        self.params = params
        self.as_of = day(params.as_of)
        self.window_start = day(params.window_start)

    def closed_in_window(self) -> Column:
        return in_window("termination_date", self.window_start, self.as_of)

    # -- staging ---------------------------------------------------------

    @cached_property
    def stg_departments(self) -> DataFrame:
        return self.raw["departments"].select(
            "department_id", "department_code", "department_name", "division", "cost_center"
        )

    @cached_property
    def stg_employees(self) -> DataFrame:
        return self.raw["employees"].select(
            "employee_id",
            "person_id",
            "full_name",
            "department_id",
            "job_level",
            clean_lower("employment_type").alias("employment_type"),
            "location",
            "hire_date",
            "termination_date",
            clean_lower("employment_status").alias("raw_employment_status"),
            "prior_employee_id",
        )

    @cached_property
    def stg_payroll(self) -> DataFrame:
        return self.raw["payroll"].select(
            "payroll_id",
            "employee_id",
            "person_id",
            "pay_period",
            "gross_pay",
            clean_upper("currency").alias("currency_code"),
            "is_partial_period",
            "paid_at",
        )

    @cached_property
    def stg_performance_reviews(self) -> DataFrame:
        return self.raw["performance_reviews"].select(
            "review_id",
            "employee_id",
            "person_id",
            "review_period",
            clean_lower("rating").alias("rating"),
            "review_score",
            "reviewer_id",
            "review_date",
        )

    # -- intermediate ----------------------------------------------------

    @cached_property
    def episodes(self) -> DataFrame:
        """The records that survive the double load, and how many copies of each there were."""
        return first_per_key(self.stg_employees, EPISODE, [], "employee_id", sums={"copies": F.count(F.lit(1))})

    @cached_property
    def live_ids(self) -> DataFrame:
        """Ids of the records that survive the double load."""
        if "episodes" in self.pinned:
            return self.episodes.select("employee_id")
        return winning_ids(self.stg_employees, EPISODE, [], "employee_id")

    @cached_property
    def int_employees_deduped(self) -> DataFrame:
        return flag_duplicates(self.stg_employees, EPISODE, [], "employee_id", "is_duplicate_record")

    @cached_property
    def int_employment_records_resolved(self) -> DataFrame:
        kept = self.episodes.drop("copies")
        is_open = F.col("termination_date").isNull()
        return kept.withColumns(
            {
                "is_duplicate_record": F.lit(False),
                "is_open": is_open,
                "is_status_date_conflict": is_open & (F.col("raw_employment_status") == "terminated"),
                "resolved_state": resolved_state(),
            }
        )

    @cached_property
    def int_employment_chain_classified(self) -> DataFrame:
        records = self.int_employment_records_resolved
        earlier = records.select("employee_id", "resolved_state", "termination_date")
        linked = lookup(
            records,
            earlier,
            link="prior_employee_id",
            parent_id="employee_id",
            row_id="employee_id",
            take={"prior_resolved_state": "resolved_state", "prior_termination_date": "termination_date"},
        )
        succeeds, before = F.col("prior_employee_id").isNotNull(), F.col("prior_resolved_state")
        rehired = succeeds & (before == "terminated")
        return linked.withColumns(
            {
                "is_transfer_successor": succeeds & (before == "transferred_out"),
                "is_rehire_successor": rehired,
                "gap_days_before": F.when(rehired, days_from("prior_termination_date", "hire_date")).otherwise(0),
                "record_span_days": days_from("hire_date", F.coalesce("termination_date", self.as_of)),
            }
        )

    @cached_property
    def int_person_employment_summary(self) -> DataFrame:
        """One row per person in one shuffle: totals and the latest record together."""
        latest = F.max_by(
            F.struct(
                F.col("employee_id").alias("current_employee_id"),
                F.col("department_id").alias("current_department_id"),
                F.col("job_level").alias("current_job_level"),
                F.col("employment_type").alias("current_employment_type"),
                F.col("location").alias("current_location"),
                F.col("hire_date").alias("most_recent_hire_date"),
                F.col("termination_date").alias("most_recent_termination_date"),
                F.col("resolved_state").alias("latest_record_state"),
                F.col("record_span_days").alias("current_stint_span_days"),
            ),
            F.struct(F.col("hire_date").isNull(), F.col("hire_date"), F.col("employee_id")),
        )
        genuine_end = F.when(F.col("resolved_state") == "terminated", F.col("termination_date"))
        people = (
            self.int_employment_chain_classified.groupBy("person_id")
            .agg(
                F.min("hire_date").alias("first_ever_hire_date"),
                F.count(F.lit(1)).alias("employment_record_count"),
                F.sum("record_span_days").alias("total_time_in_seat_days"),
                F.bool_or("is_transfer_successor").alias("had_transfer"),
                F.bool_or("is_rehire_successor").alias("had_rehire"),
                F.max(genuine_end).alias("_last_genuine_end"),
                latest.alias("_latest"),
            )
            .select("*", "_latest.*")
        )
        state = F.col("latest_record_state")
        until = (
            F.when(state == "open", self.as_of)
            .when(state == "terminated", F.col("most_recent_termination_date"))
            .otherwise(F.col("_last_genuine_end"))
        )
        return people.withColumns(
            {
                "is_currently_active": state == "open",
                "has_dangling_transfer": state == "transferred_out",
                "tenure_reference_end_date": until,
                "tenure_since_first_hire_days": days_from("first_ever_hire_date", until),
            }
        ).drop("_latest", "_last_genuine_end")

    @cached_property
    def int_payroll_deduped(self) -> DataFrame:
        """Every payroll line; repeats per period and lines of lost records flagged."""
        flagged = flag_duplicates(
            self.stg_payroll, ["employee_id", "pay_period"], [], "payroll_id", "is_duplicate_period"
        )
        return flag_orphans(
            flagged, self.live_ids, "employee_id", "employee_id", "payroll_id", "is_orphaned_payroll", self.stg_payroll
        )

    @cached_property
    def int_reviews_deduped(self) -> DataFrame:
        reviews = self.stg_performance_reviews
        same = ["employee_id", "review_period", "rating", "review_score"]
        flagged = flag_duplicates(reviews, same, [], "review_id", "is_duplicate_review")
        known = flag_orphans(
            flagged, self.live_ids, "employee_id", "employee_id", "review_id", "is_orphaned_review", reviews
        )
        return known.withColumn("is_missing_review_date", F.col("review_date").isNull())

    # -- marts -----------------------------------------------------------

    @cached_property
    def fct_workforce(self) -> DataFrame:
        unit = self.stg_departments.select(
            F.col("department_id").alias("current_department_id"), "department_name", "division", "cost_center"
        )
        people = lookup(
            self.int_person_employment_summary,
            unit,
            link="current_department_id",
            parent_id="current_department_id",
            row_id="person_id",
            take={c: c for c in ("department_name", "division", "cost_center")},
        )
        seat, since, stint = "total_time_in_seat_days", "tenure_since_first_hire_days", "current_stint_span_days"
        return people.select(
            "person_id",
            "first_ever_hire_date",
            "most_recent_hire_date",
            "most_recent_termination_date",
            "employment_record_count",
            "is_currently_active",
            "has_dangling_transfer",
            "had_transfer",
            "had_rehire",
            "current_department_id",
            "department_name",
            "division",
            "cost_center",
            "current_job_level",
            "current_employment_type",
            "current_location",
            F.col(seat).alias("tenure_time_in_seat_days"),
            years_of(seat).alias("tenure_time_in_seat_years"),
            since,
            years_of(since).alias("tenure_since_first_hire_years"),
            stint,
            years_of(stint).alias("current_stint_span_years"),
            (F.col(since) - F.col(seat)).alias("rehire_gap_days_excluded"),
        )

    @cached_property
    def active_people(self) -> DataFrame:
        return self.fct_workforce.filter(F.col("is_currently_active"))

    @cached_property
    def fct_department_workforce(self) -> DataFrame:
        """Headcount and flows per department, then a total over those rows."""
        staffed = self.active_people.groupBy(F.col("current_department_id").alias("department_id")).agg(
            F.count("person_id").alias("_heads"),
            F.round(F.avg("tenure_time_in_seat_years"), 2).alias("avg_tenure_time_in_seat_years"),
        )
        # "hired by then" is part of each count, not a filter: pushed below the
        # deduplication a filter would make this a second pass over the feed
        state, known = F.col("resolved_state"), F.col("hire_date") <= self.as_of
        closed = known & self.closed_in_window()
        arrived = F.col("is_transfer_successor") & in_window("hire_date", self.window_start, self.as_of)
        flows = self.int_employment_chain_classified.groupBy("department_id").agg(
            F.count(F.when(arrived, 1)).alias("_in"),
            F.count(F.when(closed & (state == "transferred_out"), 1)).alias("_out"),
            F.count(F.when(closed & (state == "terminated"), 1)).alias("_exits"),
        )
        zero = F.lit(0)
        units = (
            self.stg_departments.join(staffed, "department_id", "left")
            .join(flows, "department_id", "left")
            .select(
                "department_id",
                "department_name",
                "division",
                "cost_center",
                F.coalesce("_heads", zero).alias("active_headcount"),
                F.col("avg_tenure_time_in_seat_years").cast("decimal(12,2)").alias("avg_tenure_time_in_seat_years"),
                F.coalesce("_in", zero).alias("transfers_in"),
                F.coalesce("_out", zero).alias("transfers_out"),
                F.coalesce("_exits", zero).alias("genuine_exits"),
            )
        )
        mean = F.round(weighted_mean("avg_tenure_time_in_seat_years", "active_headcount"), 2)
        total = units.agg(
            F.sum("active_headcount").alias("active_headcount"),
            mean.cast("decimal(12,2)").alias("avg_tenure_time_in_seat_years"),
            F.sum("transfers_in").alias("transfers_in"),
            F.sum("transfers_out").alias("transfers_out"),
            F.sum("genuine_exits").alias("genuine_exits"),
        ).withColumns(
            {
                "department_id": F.lit(None).cast(self.stg_departments.schema["department_id"].dataType),
                **{c: F.lit(TOTAL) for c in ("department_name", "division", "cost_center")},
            }
        )
        return units.unionByName(total).withColumn(
            "naive_department_attrition_rate", ratio("genuine_exits", "active_headcount")
        )

    @cached_property
    def fct_attrition_tenure_reconciliation_bridge(self) -> DataFrame:
        """Record closures walked to genuine exits, with average headcount.

        One pass groups the raw records into episodes (whose copies are the
        duplicates), a second into people, a third into the single row; no
        distinct count over all rows is needed.
        """
        p, closed = self.params, self.closed_in_window()
        found = self.episodes
        if "episodes" not in self.pinned:
            found = first_per_key(
                self.stg_employees.select(*EPISODE, "employee_id", "raw_employment_status"),
                EPISODE,
                [],
                "employee_id",
                sums={"copies": F.count(F.lit(1))},
            )
        episodes = found.withColumn("state", resolved_state())

        def present(at: Column) -> Column:
            return F.bool_or(F.coalesce(active_on("hire_date", "termination_date", at), F.lit(False)))

        per_person = episodes.groupBy("person_id").agg(
            F.sum(F.when(closed, F.col("copies")).otherwise(0)).alias("closures"),
            F.sum(F.when(closed, F.col("copies") - 1).otherwise(0)).alias("repeats"),
            F.count(F.when(closed & (F.col("state") == "transferred_out"), 1)).alias("moves"),
            F.count(F.when(closed & (F.col("state") == "terminated"), 1)).alias("exits"),
            present(self.window_start).alias("at_start"),
            present(self.as_of).alias("at_end"),
        )

        def summed(c: str) -> Column:
            return F.coalesce(F.sum(c), F.lit(0))

        flows = per_person.agg(
            summed("closures").alias("naive_record_closures"),
            summed("repeats").alias("duplicate_closed_records"),
            summed("moves").alias("transfer_closure_count"),
            summed("exits").alias("true_genuine_exit_count"),
            F.count(F.when(F.col("at_start"), F.col("person_id"))).alias("headcount_at_window_start"),
            F.count(F.when(F.col("at_end"), F.col("person_id"))).alias("headcount_at_window_end"),
        )
        seat, since, stint = (
            "tenure_time_in_seat_years",
            "tenure_since_first_hire_years",
            "current_stint_span_years",
        )
        tenures = self.active_people.agg(
            *[F.round(F.avg(c), 2).cast("decimal(12,2)").alias(f"avg_{c}") for c in (seat, since, stint)]
        )
        both = F.col("headcount_at_window_start") + F.col("headcount_at_window_end")
        average = both.cast("double") / 2
        return join_one_row_frames(flows, tenures).select(
            F.lit(p.window_start).alias("window_start"),
            F.lit(p.as_of).alias("window_end"),
            "naive_record_closures",
            "duplicate_closed_records",
            "transfer_closure_count",
            walk(
                "naive_record_closures", minus=["duplicate_closed_records", "transfer_closure_count"]
            ).alias("bridged_true_genuine_exits"),
            "true_genuine_exit_count",
            "headcount_at_window_start",
            "headcount_at_window_end",
            (both.cast("decimal(20,1)") / F.lit(2)).cast("decimal(20,1)").alias("avg_headcount"),
            ratio("naive_record_closures", average).alias("naive_finance_attrition_rate"),
            ratio("true_genuine_exit_count", average).alias("true_attrition_rate"),
            f"avg_{seat}",
            f"avg_{since}",
            f"avg_{stint}",
            (F.col(f"avg_{since}") - F.col(f"avg_{stint}")).cast("decimal(12,2)").alias("approx_tenure_spread_years"),
        )

    @cached_property
    def rehire_rate(self) -> DataFrame:
        return self.share_of_people("had_rehire", "rehire_rate")

    @cached_property
    def internal_mobility_rate(self) -> DataFrame:
        return self.share_of_people("had_transfer", "internal_mobility_rate")

    def share_of_people(self, flag: str, name: str) -> DataFrame:
        having = F.count(F.when(F.col(flag), 1))
        return self.fct_workforce.agg(
            F.count(F.lit(1)).alias("people"), having.alias("people_with"), ratio(having, F.count(F.lit(1))).alias(name)
        )

    # -- business rules --------------------------------------------------

    @cached_property
    def headcount_reconciles_to_distinct_active_people(self) -> DataFrame:
        """Two rules of "active" that part ways on future-dated hires and exits."""
        mart = self.active_people.agg(F.count(F.lit(1)).alias("mart_active_headcount"))
        open_now = self.int_employment_records_resolved.filter(
            active_on("hire_date", "termination_date", self.as_of)
        )
        recount = open_now.agg(F.countDistinct("person_id").alias("recount_active_headcount"))
        off = disagree("mart_active_headcount", "recount_active_headcount")
        return join_one_row_frames(mart, recount).filter(off)

    @cached_property
    def department_rows(self) -> DataFrame:
        return self.fct_department_workforce.filter(F.col("department_name") != TOTAL)

    @cached_property
    def company_row(self) -> DataFrame:
        """One row whatever the departments are called: the last total of that name."""
        total = self.fct_department_workforce.filter(F.col("department_name") == TOTAL)
        return total.agg(F.max("active_headcount").alias("company_headcount"))

    @cached_property
    def transfers_net_to_zero_across_departments(self) -> DataFrame:
        sums = self.department_rows.agg(
            F.sum("transfers_in").alias("total_transfers_in"), F.sum("transfers_out").alias("total_transfers_out")
        )
        return sums.filter(disagree("total_transfers_in", "total_transfers_out"))

    @cached_property
    def department_headcount_sums_to_company_total(self) -> DataFrame:
        parts = self.department_rows.agg(F.sum("active_headcount").alias("dept_sum"))
        both = join_one_row_frames(parts, self.company_row)
        return both.filter(disagree("dept_sum", "company_headcount"))

    @cached_property
    def department_headcount_matches_workforce(self) -> DataFrame:
        """The company row against the person mart itself."""
        people = self.active_people.agg(F.count(F.lit(1)).alias("active_people"))
        both = join_one_row_frames(people, self.company_row)
        return both.filter(disagree("active_people", "company_headcount"))

    @cached_property
    def bridge_ties_to_true_genuine_exits(self) -> DataFrame:
        off = disagree("bridged_true_genuine_exits", "true_genuine_exit_count")
        return self.fct_attrition_tenure_reconciliation_bridge.filter(off).select(
            "bridged_true_genuine_exits", "true_genuine_exit_count"
        )

    @cached_property
    def dangling_transfer(self) -> DataFrame:
        """People whose latest record left for another department and never arrived."""
        lost = self.int_person_employment_summary.filter(F.col("has_dangling_transfer"))
        return lost.select("person_id", "current_employee_id", "most_recent_termination_date")
