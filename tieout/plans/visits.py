"""Clinic visits: naive against true no-show rate."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ANY_MONEY, clean_lower, clean_upper, one_of, ratio
from ..operators import (
    TOTAL,
    Chains,
    disagree,
    first_per_key,
    flag_duplicates,
    link_hits,
    lookup,
    resolve_chains,
    validate_links,
    walk,
    winning_ids,
)
from ..session import cut_lineage
from ..sources.raw import Raw
from .base import Project

# Front-desk spellings of a miss, and the resolved outcomes.
MISSED_SPELLINGS = ("no_show", "missed", "no-show")
OUTCOMES = ("attended", "no_show", "cancelled", "rescheduled", "unresolved")
BILLING_LINES = ("office_visit", "no_show_fee", "late_cancel_fee")
CHARGES = [f"has_{k}_charge" for k in BILLING_LINES] + [f"{k}_billed" for k in BILLING_LINES]

SLOT = ["patient_id", "doctor_id", "scheduled_for"]


def carries_link() -> Column:
    """0 for a row with a reschedule link, 1 without: linked copies win a slot."""
    linked = F.col("rescheduled_to_id").isNotNull() | F.col("rescheduled_from_id").isNotNull()
    return F.when(linked, 0).otherwise(1)


def with_outcome(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Judge links against the surviving rows, then settle one status per row.

    Structured evidence outranks the keyed status: a cancel reason first, then
    a valid forward link, then the status itself.
    """
    rows = validate_links(
        rows,
        hits,
        row_id="appointment_id",
        link="rescheduled_to_id",
        valid="has_validated_reschedule_link",
        orphaned="has_orphaned_reschedule_link",
    )
    status = F.col("raw_status")
    missed = one_of(status, MISSED_SPELLINGS)
    cancelled, moved = F.col("cancel_reason").isNotNull(), F.col("has_validated_reschedule_link")
    outcome = (
        F.when(cancelled, "cancelled")
        .when(moved, "rescheduled")
        .when(missed, "no_show")
        .when(one_of(status, ["attended", "cancelled"]), status)
        .when((status == "rescheduled") & ~F.col("has_orphaned_reschedule_link"), status)
        .otherwise("unresolved")
    )
    return rows.withColumns(
        {
            "canonical_status": outcome,
            "is_cancel_misflag": cancelled & missed,
            "is_reschedule_misflag": moved & missed,
            "is_naive_no_show": missed,
        }
    )


class Visits(Project):
    name = "visits"
    staging = ("stg_patients", "stg_doctors", "stg_appointments", "stg_billing")
    intermediate = (
        "int_appointments_deduped",
        "int_appointments_canonical",
        "int_appointment_chains",
        "chain_membership",
        "chain_anomalies",
        "unrooted_chains",
        "chain_loops",
        "int_billing_agg",
        "billing_lines_flagged",
    )
    marts = ("fct_appointments", "fct_patient_engagement", "fct_noshow_reconciliation_bridge")
    by_segment = {"fct_noshow_reconciliation_bridge": "location"}

    # -- staging ---------------------------------------------------------

    @cached_property
    def stg_patients(self) -> DataFrame:
        return self.raw["patients"].select(
            "patient_id",
            "birth_year",
            clean_upper("sex").alias("sex"),
            clean_lower("insurance_plan").alias("insurance_plan"),
            clean_lower("home_location").alias("home_location"),
            "registered_at",
        )

    @cached_property
    def stg_doctors(self) -> DataFrame:
        return self.raw["doctors"].select(
            "doctor_id",
            "provider_name",
            clean_lower("specialty").alias("specialty"),
            clean_lower("primary_location").alias("primary_location"),
            "hired_at",
            "is_active",
        )

    @cached_property
    def stg_appointments(self) -> DataFrame:
        return self.raw["appointments"].select(
            "appointment_id",
            "patient_id",
            "doctor_id",
            clean_lower("location").alias("location"),
            clean_lower("appointment_type").alias("appointment_type"),
            clean_lower("status").alias("raw_status"),
            "scheduled_for",
            "booked_at",
            "checked_in_at",
            "checkout_at",
            clean_lower("cancel_reason").alias("cancel_reason"),
            "rescheduled_to_id",
            "rescheduled_from_id",
        )

    @cached_property
    def stg_billing(self) -> DataFrame:
        return self.raw["billing"].select(
            "billing_id",
            "appointment_id",
            "patient_id",
            clean_lower("line_type").alias("line_type"),
            "billed_amount",
            "insurance_covered",
            "patient_responsibility",
            "service_at",
            "posted_at",
        )

    # -- intermediate: every raw row, flagged ----------------------------------

    @cached_property
    def live_ids(self) -> DataFrame:
        """Ids of the rows that survive double submission."""
        return winning_ids(self.stg_appointments, SLOT, [carries_link()], "appointment_id")

    @cached_property
    def link_hits(self) -> DataFrame:
        """Per row, whether its forward and backward links reach a surviving row."""
        links = ["rescheduled_to_id", "rescheduled_from_id"]
        return link_hits(self.stg_appointments, "appointment_id", links, self.live_ids, "appointment_id")

    @cached_property
    def int_appointments_deduped(self) -> DataFrame:
        return flag_duplicates(
            self.stg_appointments, SLOT, [carries_link()], "appointment_id", "is_duplicate_booking"
        )

    @cached_property
    def int_appointments_canonical(self) -> DataFrame:
        judged = with_outcome(self.int_appointments_deduped, self.link_hits)
        return judged.drop("rescheduled_to_id_lives", "rescheduled_from_id_lives")

    @cached_property
    def billing_lines_flagged(self) -> DataFrame:
        """Every line, with "no such booking" and "billed to a repeated booking"."""
        bookings = self.int_appointments_deduped.select("appointment_id", "is_duplicate_booking")
        found = lookup(
            self.stg_billing,
            bookings,
            link="appointment_id",
            parent_id="appointment_id",
            row_id="billing_id",
            take={"_repeat": "is_duplicate_booking"},
        )
        return found.select(
            *self.stg_billing.columns,
            F.col("_repeat").isNull().alias("is_unmatched_billing"),
            F.coalesce("_repeat", F.lit(False)).alias("is_orphaned_billing"),
        )

    @cached_property
    def charges_per_booking(self) -> DataFrame:
        kind, amount = F.col("line_type"), F.col("billed_amount")
        return self.stg_billing.groupBy("appointment_id").agg(
            *[F.sum(F.when(kind == k, amount).otherwise(0)).alias(f"{k}_billed") for k in BILLING_LINES],
            *[F.bool_or(F.coalesce(kind == k, F.lit(False))).alias(f"has_{k}_charge") for k in BILLING_LINES],
            F.min("service_at").alias("service_at"),
            F.max("posted_at").alias("last_posted_at"),
        )

    @cached_property
    def int_billing_agg(self) -> DataFrame:
        """Charges per surviving booking.

        Lines are added up per booking before the survivors are looked up, so
        a booking with very many lines is one row in the join.
        """
        return self.charges_per_booking.join(self.live_ids, "appointment_id", "left_semi")

    # -- intermediate: surviving rows and their chains ---------------------------

    @cached_property
    def live_slots(self) -> DataFrame:
        """Surviving rows with their outcome, place in a chain and charges, written once.

        Everything below reads this table, each time only the columns it needs.
        Charges are joined here, on the row's own id: many chains may end on one
        row, so the lookup of last rows has to be the only join on that key.
        ``next_id`` is set only by a valid forward link; a root is a row that no
        surviving row was moved into.
        """
        kept = first_per_key(self.stg_appointments, SLOT, [carries_link()], "appointment_id")
        onward = F.when(F.col("has_validated_reschedule_link"), F.col("rescheduled_to_id"))
        moved_in = F.coalesce("rescheduled_from_id_lives", F.lit(False))
        placed = with_outcome(kept, self.link_hits).withColumns({"next_id": onward, "is_root": ~moved_in})
        billed = self.charges_per_booking.select("appointment_id", *CHARGES)
        return cut_lineage(
            placed.drop("rescheduled_to_id_lives", "rescheduled_from_id_lives").join(billed, "appointment_id", "left")
        )

    @cached_property
    def chains(self) -> Chains:
        return resolve_chains(self.live_slots, "appointment_id", "next_id", "is_root")

    @cached_property
    def int_appointment_chains(self) -> DataFrame:
        status = self.live_slots.select(
            "appointment_id", F.col("canonical_status").alias("final_canonical_status")
        )
        alone = self.chains.alone.join(status, F.col("root") == F.col("appointment_id")).select(
            "root", F.col("root").alias("last"), "final_canonical_status", F.lit(0).alias("hops")
        )
        walked = self.chains.walked.join(status, F.col("last") == F.col("appointment_id")).select(*alone.columns)
        return alone.unionByName(walked).select(
            F.col("root").alias("logical_visit_id"),
            F.col("last").alias("final_appointment_id"),
            "final_canonical_status",
            F.col("hops").alias("reschedule_count"),
        )

    @cached_property
    def chain_membership(self) -> DataFrame:
        """Every (chain, row, position), middle rows included."""
        return self.chains.members.select(
            F.col("root").alias("logical_visit_id"), F.col("id").alias("appointment_id"), F.col("slot").alias("hop_number")
        )

    @cached_property
    def unrooted_chains(self) -> DataFrame:
        """Every (first row, row, position) of chains that no link leads into and whose first row is no root.

        Such a row names a surviving row that it was moved from, but that one does
        not lead to it.
        """
        return self.chains.unrooted.select(
            F.col("root").alias("first_appointment_id"), F.col("id").alias("appointment_id"), F.col("slot").alias("hop_number")
        )

    @cached_property
    def chain_loops(self) -> DataFrame:
        """The rows that lead round in a loop, which bears its smallest id."""
        return self.chains.loops.select(
            F.col("loop").alias("loop_id"), F.col("id").alias("appointment_id"), "place", F.col("size").alias("loop_size")
        )

    @cached_property
    def rows_without_place(self) -> DataFrame:
        """Surviving rows in no chain, no unrooted chain and no loop."""
        placed = reduce(
            DataFrame.union, [df.select("appointment_id") for df in (self.chain_membership, self.unrooted_chains, self.chain_loops)]
        )
        return self.live_slots.select("appointment_id").join(placed, "appointment_id", "left_anti")

    @cached_property
    def coverage(self) -> DataFrame:
        """How many chain positions each surviving row fills."""
        seen = self.chain_membership.groupBy("appointment_id").agg(F.count(F.lit(1)).alias("_n"))
        return self.live_slots.join(seen, "appointment_id", "left").select(
            "appointment_id", "canonical_status", "next_id", F.coalesce("_n", F.lit(0)).alias("times_covered")
        )

    @cached_property
    def chain_anomalies(self) -> DataFrame:
        """Rows the walk cannot place cleanly, one row per row and reason."""
        loose = F.when((F.col("canonical_status") == "rescheduled") & F.col("next_id").isNull(), "unlinked_rescheduled")
        place = F.when(F.col("times_covered") == 0, "not_in_any_chain").when(
            F.col("times_covered") > 1, "in_several_positions"
        )
        per_row = self.coverage.select(
            "appointment_id", F.explode(F.array_compact(F.array(loose, place))).alias("anomaly")
        )
        looped = self.chains.looped.select(
            F.col("root").alias("appointment_id"), F.lit("chain_ends_in_loop").alias("anomaly")
        )
        return per_row.unionByName(looped)

    # -- marts -----------------------------------------------------------

    @cached_property
    def fct_appointments(self) -> DataFrame:
        """One row per logical visit: its first row, its last row and the charges.

        A visit that was never moved starts and ends on the same row and needs
        no join for that; only walked chains look both rows up.
        """
        first = {
            "logical_visit_id": "appointment_id",
            "patient_id": "patient_id",
            "originating_doctor_id": "doctor_id",
            "originating_location": "location",
            "appointment_type": "appointment_type",
            "originally_scheduled_for": "scheduled_for",
            "booked_at": "booked_at",
        }
        last = {
            "final_appointment_id": "appointment_id",
            "final_canonical_status": "canonical_status",
            "final_doctor_id": "doctor_id",
            "final_location": "location",
            "final_scheduled_for": "scheduled_for",
            "checked_in_at": "checked_in_at",
            "checkout_at": "checkout_at",
            "final_raw_status": "raw_status",
        }

        def named(columns: dict[str, str]) -> list[Column]:
            return [F.col(source).alias(name) for name, source in columns.items()]

        unmoved = self.live_slots.filter(F.col("is_root") & F.col("next_id").isNull()).select(
            *named(first), *named(last), *CHARGES, F.lit(0).alias("reschedule_count")
        )
        moved = (
            self.chains.walked.withColumnsRenamed(
                {"root": "logical_visit_id", "last": "final_appointment_id", "hops": "reschedule_count"}
            )
            # many chains may end on one row: that join comes first, while rows are narrow
            .join(self.live_slots.select(*named(last), *CHARGES), "final_appointment_id")
            .join(self.live_slots.select(*named(first)), "logical_visit_id")
        )
        visits = unmoved.unionByName(moved)
        outcome = F.col("final_canonical_status")
        return visits.select(
            "logical_visit_id",
            "final_appointment_id",
            "final_canonical_status",
            "reschedule_count",
            *list(first)[1:],
            *list(last)[2:],
            *CHARGES,
            (outcome == "attended").alias("is_attended"),
            (outcome == "no_show").alias("is_true_no_show"),
            (outcome == "cancelled").alias("is_cancelled"),
            (outcome == "unresolved").alias("is_unresolved"),
            (F.col("reschedule_count") > 0).alias("was_rescheduled"),
            one_of(outcome, ["attended", "no_show"]).alias("is_kept_intent_visit"),
        )

    @cached_property
    def fct_patient_engagement(self) -> DataFrame:
        def visits_where(flag: str) -> Column:
            return F.count(F.when(F.col(flag), 1))

        per_patient = self.fct_appointments.groupBy("patient_id").agg(
            F.count(F.lit(1)).alias("total_logical_visits"),
            visits_where("is_kept_intent_visit").alias("kept_intent_visit_count"),
            visits_where("is_true_no_show").alias("true_no_show_count"),
            visits_where("is_attended").alias("attended_count"),
            visits_where("is_cancelled").alias("cancelled_count"),
            visits_where("was_rescheduled").alias("visits_with_reschedule_count"),
            F.sum("reschedule_count").alias("total_reschedule_hops"),
            F.max("final_scheduled_for").alias("most_recent_visit_date"),
        )
        kept, misses = F.col("kept_intent_visit_count"), F.col("true_no_show_count")
        segment = (
            F.when(kept == 0, "no_kept_intent_history")
            .when((misses >= 2) | (misses * 100 >= kept * 34), "high_risk")
            .when(misses == 1, "moderate_risk")
            .otherwise("low_risk")
        )
        return per_patient.withColumns(
            {
                "true_no_show_rate": ratio(misses, kept),
                "attended_rate": ratio("attended_count", kept),
                "reschedule_rate": ratio("visits_with_reschedule_count", "total_logical_visits"),
                "cancellation_rate": ratio("cancelled_count", "total_logical_visits"),
                "no_show_risk_segment": segment,
            }
        )

    @cached_property
    def fct_noshow_reconciliation_bridge(self) -> DataFrame:
        """Naive no-shows walked to true ones, per location of the row.

        Repeated no-show rows are all no-show rows less the surviving ones, so
        the naive side is one scan of staging and ranks nothing. A location
        without any visit drops out, also from the total.
        """
        missed = one_of("raw_status", MISSED_SPELLINGS)
        naive = self.stg_appointments.groupBy("location").agg(
            F.count(F.lit(1)).alias("naive_all_rows"), F.count(F.when(missed, 1)).alias("naive_no_show_count")
        )
        surviving = self.live_slots.groupBy("location").agg(
            F.count(F.when(F.col("is_naive_no_show"), 1)).alias("_surviving"),
            F.count(F.when(F.col("is_reschedule_misflag"), 1)).alias("reschedule_misflags"),
            F.count(F.when(F.col("is_cancel_misflag"), 1)).alias("cancel_misflags"),
        )
        true = self.fct_appointments.groupBy(F.col("originating_location").alias("location")).agg(
            F.count(F.when(F.col("is_true_no_show"), 1)).alias("true_no_show_count"),
            F.count(F.when(F.col("is_kept_intent_visit"), 1)).alias("kept_intent_visit_count"),
        )
        repeats = F.col("naive_no_show_count") - F.coalesce("_surviving", F.lit(0))
        counts = [
            "naive_all_rows",
            "naive_no_show_count",
            "duplicate_no_show_rows",
            "reschedule_misflags",
            "cancel_misflags",
            "true_no_show_count",
            "kept_intent_visit_count",
        ]
        located = (
            naive.join(surviving, "location", "left")
            .join(true, "location")
            .withColumn("duplicate_no_show_rows", repeats)
            .fillna(0, ["reschedule_misflags", "cancel_misflags"])
            .select("location", *counts)
        )
        total = located.agg(*[F.sum(c).alias(c) for c in counts]).withColumn("location", F.lit(TOTAL))
        removed = ["duplicate_no_show_rows", "reschedule_misflags", "cancel_misflags"]
        return located.unionByName(total).select(
            "location",
            "naive_all_rows",
            "naive_no_show_count",
            ratio("naive_no_show_count", "naive_all_rows").alias("naive_no_show_rate"),
            *removed,
            walk("naive_no_show_count", minus=removed).alias("bridged_true_no_show_count"),
            "true_no_show_count",
            "kept_intent_visit_count",
            ratio("true_no_show_count", "kept_intent_visit_count").alias("true_no_show_rate"),
        )

    # -- business rules --------------------------------------------------

    @cached_property
    def every_row_has_one_canonical_status(self) -> DataFrame:
        status = F.col("canonical_status")
        bad = status.isNull() | ~one_of(status, OUTCOMES)
        return self.int_appointments_canonical.filter(bad).select("appointment_id", "raw_status", "canonical_status")

    @cached_property
    def no_double_counted_visit_intent(self) -> DataFrame:
        """Surviving rows that do not fill exactly one chain position."""
        return self.coverage.filter(F.col("times_covered") != 1).select("appointment_id", "times_covered")

    @cached_property
    def no_double_counted_visit_intent_literal(self) -> DataFrame:
        """The published form, which counts only first and last rows of a chain
        and therefore reports the middle rows of longer ones."""
        chains = self.int_appointment_chains
        ends = chains.select(
            F.explode(
                F.when(
                    F.col("final_appointment_id") == F.col("logical_visit_id"), F.array("logical_visit_id")
                ).otherwise(F.array("logical_visit_id", "final_appointment_id"))
            ).alias("appointment_id")
        )
        seen = ends.groupBy("appointment_id").agg(F.count(F.lit(1)).alias("_n"))
        counted = self.live_slots.join(seen, "appointment_id", "left").select(
            "appointment_id", F.coalesce("_n", F.lit(0)).alias("times_covered")
        )
        return counted.filter(F.col("times_covered") != 1)

    @cached_property
    def bridge_ties_to_fct_appointments(self) -> DataFrame:
        off = disagree("bridged_true_no_show_count", "true_no_show_count")
        return self.fct_noshow_reconciliation_bridge.filter(off).select(
            "location", "bridged_true_no_show_count", "true_no_show_count"
        )

    @cached_property
    def billing_never_contradicts_canonical_status(self) -> DataFrame:
        outcome = F.col("final_canonical_status")
        clash = ((outcome == "no_show") & F.col("has_office_visit_charge")) | (
            (outcome == "attended") & F.col("has_no_show_fee_charge")
        )
        return self.fct_appointments.filter(clash).select(
            "final_appointment_id", "final_canonical_status", "has_office_visit_charge", "has_no_show_fee_charge"
        )
