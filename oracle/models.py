"""Every model as SQL. Repeats are ranked with windows here, independently of
the aggregate-based election that the Spark side uses."""


def low(c: str, name: str | None = None) -> str:
    return f"lower(trim({c})) AS {name or c}"


def up(c: str, name: str) -> str:
    return f"upper(trim({c})) AS {name}"


def rate(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)"


def n(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def month(c: str) -> str:
    return f"CAST(date_trunc('month', {c}) AS DATE)"


def years(c: str) -> str:
    return f"CAST(round({c} / 365.25, 2) AS DECIMAL(10,2))"


AS_OF, H_START, H_END = "DATE '2001-11-30'", "DATE '2001-01-01'", "DATE '2001-12-31'"
MISS = "raw_status IN ('no_show', 'missed', 'no-show')"
CLOSED = f"termination_date BETWEEN {H_START} AND {H_END}"
M38 = "DECIMAL(38,2)"

REVENUE = {
    "stg_orders": f"""
        SELECT order_id, customer_id, {low('order_status')}, order_amount, {up('currency', 'currency_code')},
               created_at, updated_at, updated_at < created_at AS has_clock_skew FROM raw_orders""",
    "stg_payments": f"""
        SELECT payment_id, order_id, {low('payment_status')}, amount, {up('currency', 'currency_code')},
               payment_method, gateway_fee, attempted_at, processed_at FROM raw_payments""",
    "stg_refunds": f"""
        SELECT refund_id, order_id, payment_id, refund_amount, {up('currency', 'currency_code')}, refund_reason,
               {low('refund_status')}, requested_at, processed_at AS refund_processed_at FROM raw_refunds""",
    "stg_shipping": f"""
        SELECT shipment_id, order_id, carrier, shipping_cost, {low('status', 'shipment_status')}, shipped_at,
               delivered_at FROM raw_shipping""",
    "int_payments_deduped": """
        SELECT *, payment_status IS NOT DISTINCT FROM 'succeeded' AND row_number() OVER (
                   PARTITION BY order_id, payment_status ORDER BY processed_at NULLS LAST, payment_id NULLS LAST) > 1
                   AS is_duplicate_settlement
        FROM stg_payments""",
    "int_order_financials": f"""
        SELECT o.*, s.payment_id AS settlement_payment_id, s.amount AS settled_amount, s.gateway_fee,
               s.processed_at AS payment_processed_at, s.payment_id IS NOT NULL AS was_charged,
               CAST(coalesce(d.extra, 0) AS {M38}) AS duplicate_payment_amount,
               CAST(coalesce(r.total, 0) AS {M38}) AS total_refunded, r.lo AS first_refund_processed_at,
               r.hi AS last_refund_processed_at, coalesce(r.k, 0) AS refund_count, h.shipment_status, h.shipped_at,
               h.delivered_at, h.shipment_status = 'delivered' AS was_delivered
        FROM stg_orders o
        LEFT JOIN (SELECT * FROM int_payments_deduped
                   WHERE payment_status = 'succeeded' AND NOT is_duplicate_settlement) s USING (order_id)
        LEFT JOIN (SELECT order_id, sum(amount) AS extra FROM int_payments_deduped
                   WHERE is_duplicate_settlement GROUP BY ALL) d USING (order_id)
        LEFT JOIN (SELECT order_id, sum(refund_amount) AS total, min(refund_processed_at) AS lo,
                          max(refund_processed_at) AS hi, count(*) AS k
                   FROM stg_refunds WHERE refund_status = 'completed' GROUP BY ALL) r USING (order_id)
        LEFT JOIN (SELECT order_id, min(shipment_status) AS shipment_status, min(shipped_at) AS shipped_at,
                          max(delivered_at) AS delivered_at FROM stg_shipping GROUP BY ALL) h USING (order_id)""",
    "fct_revenue": f"""
        WITH f AS (SELECT * EXCLUDE (currency_code, settlement_payment_id), currency_code,
                          CAST(coalesce(settled_amount, 0) AS {M38}) AS gross_revenue,
                          CAST(coalesce(settled_amount, 0) - total_refunded AS {M38}) AS net_revenue
                   FROM int_order_financials)
        SELECT * EXCLUDE (currency_code), currency_code, shipped_at IS NOT NULL AS was_fulfilled,
               {month('payment_processed_at')} AS revenue_recognition_month,
               if(shipped_at IS NULL, 0, order_amount) AS fulfilled_amount, {month('created_at')} AS fulfillment_month,
               CAST(if(order_status = 'cancelled' AND was_charged AND total_refunded < gross_revenue,
                       net_revenue, 0) AS {M38}) AS cancellation_leakage_amount,
               coalesce(order_status = 'cancelled' AND was_charged AND total_refunded < gross_revenue, false)
                   AS is_unrefunded_cancellation_leakage
        FROM f""",
    "fct_revenue_monthly": f"""
        SELECT revenue_recognition_month AS report_month, sum(gross_revenue) AS gross_revenue,
               sum(if({month('last_refund_processed_at')} = revenue_recognition_month, total_refunded, 0))
                   AS refunds_same_month,
               sum(net_revenue) AS net_revenue, {rate('sum(total_refunded)', 'sum(gross_revenue)')} AS refund_rate,
               sum(cancellation_leakage_amount) AS cancellation_leakage,
               sum(duplicate_payment_amount) AS duplicate_payment_amount_excluded,
               count(*) AS orders_with_payment_activity,
               {n('is_unrefunded_cancellation_leakage')} AS leakage_order_count
        FROM fct_revenue WHERE revenue_recognition_month IS NOT NULL GROUP BY 1""",
    "fct_revenue_reconciliation_bridge": f"""
        WITH legs AS (
            SELECT fulfillment_month AS order_cohort_month, sum(fulfilled_amount) AS ops_number,
                   sum(if(was_charged AND NOT was_fulfilled AND order_status <> 'cancelled', settled_amount, 0))
                       AS wip_charged_not_shipped,
                   sum(cancellation_leakage_amount) AS cancellation_leakage,
                   sum(duplicate_payment_amount) AS duplicate_payments_excluded,
                   sum(total_refunded) AS cohort_lifetime_refunds,
                   sum(if({month('last_refund_processed_at')} > fulfillment_month, total_refunded, 0))
                       AS refunds_recognized_in_later_month,
                   sum(net_revenue) AS ledger
            FROM fct_revenue GROUP BY 1),
        moved AS (SELECT *, CAST(wip_charged_not_shipped + cancellation_leakage - duplicate_payments_excluded
                                 - cohort_lifetime_refunds AS {M38}) AS total_bridge_adjustment FROM legs)
        SELECT * EXCLUDE (ledger), CAST(ops_number + total_bridge_adjustment AS {M38}) AS finance_reconciled_number,
               {rate('total_bridge_adjustment', 'ops_number')} AS gap_pct_of_ops_number,
               CAST(ledger - ops_number - total_bridge_adjustment AS {M38}) AS unexplained_residual
        FROM moved""",
    "no_over_refunding": """
        SELECT p.payment_id, p.amount AS payment_amount, sum(r.refund_amount) AS total_refunded
        FROM stg_payments p JOIN stg_refunds r USING (payment_id) GROUP BY ALL
        HAVING sum(r.refund_amount) > p.amount""",
    "no_duplicate_settlements_counted_in_revenue": """
        SELECT order_id, count(*) AS non_duplicate_succeeded_payments FROM int_payments_deduped
        WHERE NOT is_duplicate_settlement AND payment_status = 'succeeded' GROUP BY ALL HAVING count(*) > 1""",
    "bridge_ties_to_fct_revenue": f"""
        SELECT order_cohort_month, finance_reconciled_number,
               CAST(finance_reconciled_number + unexplained_residual AS {M38}) AS mart_net_revenue,
               CAST(abs(unexplained_residual) AS {M38}) AS diff
        FROM fct_revenue_reconciliation_bridge WHERE abs(unexplained_residual) > 1""",
    "net_revenue_ties_to_raw_ledger": f"""
        SELECT *, CAST(abs(ledger_net_revenue - mart_net_revenue) AS {M38}) AS diff
        FROM (SELECT (SELECT sum(amount) FROM int_payments_deduped
                      WHERE payment_status = 'succeeded' AND NOT is_duplicate_settlement)
                     - (SELECT sum(refund_amount) FROM stg_refunds WHERE refund_status = 'completed')
                         AS ledger_net_revenue,
                     (SELECT sum(net_revenue) FROM fct_revenue) AS mart_net_revenue)
        WHERE abs(ledger_net_revenue - mart_net_revenue) > 1""",
    "non_base_currency_volume": f"""
        SELECT {month('created_at')} AS order_month, count(*) AS non_base_orders, sum(order_amount) AS non_base_amount
        FROM stg_orders WHERE currency_code <> 'USD' GROUP BY 1""",
}

CASH = "payment_status IN ('posted', 'partial')"

LENDING = {
    "stg_applications": f"""
        SELECT application_id, customer_id, product_type, channel, requested_amount, {up('currency', 'currency_code')},
               {low('decision')}, decline_reason, submitted_at, decided_at, decided_at < submitted_at AS has_clock_skew
        FROM raw_applications""",
    "stg_loans": f"""
        SELECT loan_id, application_id, customer_id, product_type, principal_amount, {up('currency', 'currency_code')},
               interest_rate_apr, term_months, {low('loan_status')}, originated_at,
               first_due_date AS current_schedule_first_due_date, restructured_at,
               restructured_at IS NOT NULL AS is_restructured FROM raw_loans""",
    "stg_repayments": f"""
        SELECT repayment_id, loan_id, instalment_no, scheduled_amount, amount_paid, {up('currency', 'currency_code')},
               {low('payment_status')}, due_date, paid_at FROM raw_repayments""",
    "stg_defaults": f"""
        SELECT default_id, loan_id, default_reason, outstanding_at_default, {up('currency', 'currency_code')},
               {low('default_status')}, flagged_at FROM raw_defaults""",
    "int_repayments_deduped": f"""
        SELECT *, coalesce({CASH}, false) AND row_number() OVER (
                   PARTITION BY loan_id, instalment_no, coalesce({CASH}, false)
                   ORDER BY paid_at NULLS LAST, repayment_id NULLS LAST) > 1 AS is_duplicate_posting
        FROM stg_repayments""",
    "int_loan_delinquency": f"""
        WITH sums AS (
            SELECT loan_id, count(DISTINCT instalment_no) AS instalments_due_count,
                   count(DISTINCT instalment_no) FILTER (WHERE payment_status = 'missed') AS instalments_missed_count,
                   count(DISTINCT instalment_no) FILTER (WHERE payment_status = 'partial') AS instalments_partial_count,
                   sum(if({CASH}, amount_paid, 0)) AS cumulative_amount_paid,
                   sum(scheduled_amount) AS cumulative_scheduled_amount,
                   sum(if(payment_status = 'partial', scheduled_amount - amount_paid, 0)) AS cumulative_partial_shortfall,
                   min(due_date) FILTER (WHERE payment_status = 'missed') AS oldest_missed_due_date,
                   max(due_date) AS most_recent_due_date
            FROM int_repayments_deduped WHERE NOT is_duplicate_posting GROUP BY loan_id)
        SELECT *, CAST(coalesce({AS_OF} - oldest_missed_due_date, 0) AS INTEGER) AS true_dpd,
               {rate('instalments_partial_count', 'instalments_due_count')} AS partial_rate
        FROM sums""",
    "int_loan_register_status": """
        SELECT loan_id, count(*) OVER loan AS register_entry_count, true AS is_reported_defaulted,
               flagged_at AS most_recent_flagged_at, default_status AS most_recent_default_status,
               default_reason AS most_recent_default_reason, outstanding_at_default
        FROM stg_defaults WINDOW loan AS (PARTITION BY loan_id)
        QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY flagged_at DESC NULLS LAST, default_id DESC) = 1""",
    "fct_loan_performance": f"""
        WITH book AS (
            SELECT l.*, coalesce(d.instalments_due_count, 0) AS instalments_due_count,
                   coalesce(d.instalments_missed_count, 0) AS instalments_missed_count,
                   coalesce(d.instalments_partial_count, 0) AS instalments_partial_count,
                   CAST(coalesce(d.cumulative_amount_paid, 0) AS {M38}) AS cumulative_amount_paid,
                   CAST(coalesce(d.cumulative_partial_shortfall, 0) AS {M38}) AS cumulative_partial_shortfall,
                   d.oldest_missed_due_date, coalesce(d.true_dpd, 0) AS true_dpd,
                   coalesce(d.partial_rate, 0) AS partial_rate,
                   CAST(greatest(l.principal_amount - coalesce(d.cumulative_amount_paid, 0), 0) AS {M38})
                       AS outstanding_balance_estimate,
                   r.loan_id IS NOT NULL AS is_reported_defaulted, r.most_recent_default_status,
                   r.most_recent_default_reason, r.outstanding_at_default, r.register_entry_count
            FROM stg_loans l LEFT JOIN int_loan_delinquency d USING (loan_id)
                 LEFT JOIN int_loan_register_status r USING (loan_id)
            WHERE l.loan_status <> 'closed')
        SELECT *, true_dpd >= 30 AS is_true_par30, true_dpd >= 90 AS is_true_par90,
               CASE WHEN true_dpd >= 90 THEN '90_plus_dpd' WHEN true_dpd >= 30 THEN '30-89_dpd'
                    WHEN true_dpd <> 0 THEN '1-29_dpd' ELSE 'current' END AS risk_bucket,
               is_restructured AND true_dpd >= 30 AND NOT is_reported_defaulted AS is_hidden_restructure_risk
        FROM book""",
    "fct_portfolio_metrics": f"""
        WITH cut AS (
            SELECT if(grouping(product_type) = 1, 'ALL', product_type) AS product_type, count(*) AS active_loan_count,
                   sum(outstanding_balance_estimate) AS active_outstanding_value,
                   {n('is_true_par30')} AS par30_loan_count, {n('is_true_par90')} AS par90_loan_count,
                   sum(if(is_true_par30, outstanding_balance_estimate, 0)) AS par30_outstanding_value,
                   sum(if(is_true_par90, outstanding_balance_estimate, 0)) AS par90_outstanding_value,
                   {n('is_reported_defaulted')} AS reported_default_loan_count,
                   {n('is_restructured')} AS restructured_loan_count,
                   {n('is_hidden_restructure_risk')} AS hidden_restructure_risk_count,
                   {rate('sum(instalments_partial_count)', 'sum(instalments_due_count)')} AS partial_payment_rate
            FROM fct_loan_performance GROUP BY GROUPING SETS ((product_type), ()))
        SELECT *, {rate('par30_loan_count', 'active_loan_count')} AS par30_rate_by_count,
               {rate('par90_loan_count', 'active_loan_count')} AS par90_rate_by_count,
               {rate('par30_outstanding_value', 'active_outstanding_value')} AS par30_rate_by_value,
               {rate('par90_outstanding_value', 'active_outstanding_value')} AS par90_rate_by_value,
               {rate('reported_default_loan_count', 'active_loan_count')} AS reported_default_rate,
               {rate('restructured_loan_count', 'active_loan_count')} AS restructure_rate
        FROM cut""",
    "fct_par_reconciliation_bridge": f"""
        WITH cut AS (
            SELECT if(grouping(product_type) = 1, 'ALL', product_type) AS product_type, count(*) AS active_loan_count,
                   {n('is_reported_defaulted')} AS reported_par_loans,
                   {n('NOT is_reported_defaulted AND is_restructured AND is_true_par30')} AS hidden_restructure_risk_par30,
                   {n('NOT is_reported_defaulted AND is_restructured AND is_true_par90')} AS hidden_restructure_risk_par90,
                   {n('NOT is_reported_defaulted AND NOT is_restructured AND is_true_par30')} AS unregistered_delinquents_par30,
                   {n('NOT is_reported_defaulted AND NOT is_restructured AND is_true_par90')} AS unregistered_delinquents_par90,
                   {n('is_reported_defaulted AND NOT is_true_par30')} AS stale_register_entries_par30,
                   {n('is_reported_defaulted AND NOT is_true_par90')} AS stale_register_entries_par90,
                   {n('is_true_par30')} AS true_par30_loans, {n('is_true_par90')} AS true_par90_loans
            FROM fct_loan_performance GROUP BY GROUPING SETS ((product_type), ()))
        SELECT *, {rate('reported_par_loans', 'active_loan_count')} AS reported_par_rate,
               reported_par_loans + hidden_restructure_risk_par30 + unregistered_delinquents_par30
                   - stale_register_entries_par30 AS bridged_par30_loans,
               reported_par_loans + hidden_restructure_risk_par90 + unregistered_delinquents_par90
                   - stale_register_entries_par90 AS bridged_par90_loans,
               {rate('true_par30_loans', 'active_loan_count')} AS true_par30_rate,
               {rate('true_par90_loans', 'active_loan_count')} AS true_par90_rate,
               {rate('true_par30_loans - reported_par_loans', 'reported_par_loans')} AS par30_understatement_pct
        FROM cut""",
    "no_overpayment_per_instalment": f"""
        SELECT loan_id, instalment_no, scheduled_amount, amount_paid FROM int_repayments_deduped
        WHERE {CASH} AND NOT is_duplicate_posting AND amount_paid > scheduled_amount * 1.01""",
    "no_duplicate_postings_counted_twice": f"""
        SELECT loan_id, instalment_no, count(*) AS non_duplicate_postings FROM int_repayments_deduped
        WHERE {CASH} AND NOT is_duplicate_posting GROUP BY ALL HAVING count(*) > 1""",
    "bridge_ties_to_true_par": """
        SELECT product_type, bridged_par30_loans, true_par30_loans, bridged_par90_loans, true_par90_loans
        FROM fct_par_reconciliation_bridge
        WHERE (bridged_par30_loans, bridged_par90_loans) <> (true_par30_loans, true_par90_loans)""",
    "true_par_meets_or_exceeds_reported_par": """
        SELECT product_type, reported_par_loans, true_par30_loans FROM fct_par_reconciliation_bridge
        WHERE true_par30_loans < reported_par_loans AND product_type = 'ALL'""",
}

VISITS = {
    "stg_patients": f"""
        SELECT patient_id, birth_year, {up('sex', 'sex')}, {low('insurance_plan')}, {low('home_location')},
               registered_at FROM raw_patients""",
    "stg_doctors": f"""
        SELECT doctor_id, provider_name, {low('specialty')}, {low('primary_location')}, hired_at, is_active
        FROM raw_doctors""",
    "stg_appointments": f"""
        SELECT appointment_id, patient_id, doctor_id, {low('location')}, {low('appointment_type')},
               {low('status', 'raw_status')}, scheduled_for, booked_at, checked_in_at, checkout_at,
               {low('cancel_reason')}, rescheduled_to_id, rescheduled_from_id FROM raw_appointments""",
    "stg_billing": f"""
        SELECT billing_id, appointment_id, patient_id, {low('line_type')}, billed_amount, insurance_covered,
               patient_responsibility, service_at, posted_at FROM raw_billing""",
    "int_appointments_deduped": """
        SELECT *, row_number() OVER (
                   PARTITION BY patient_id, doctor_id, scheduled_for
                   ORDER BY coalesce(rescheduled_to_id, rescheduled_from_id) IS NULL, appointment_id) > 1
                   AS is_duplicate_booking
        FROM stg_appointments""",
    "int_appointments_canonical": f"""
        WITH judged AS (
            SELECT a.*, a.rescheduled_to_id IS NOT NULL AND t.appointment_id IS NOT NULL AS has_validated_reschedule_link,
                   a.rescheduled_to_id IS NOT NULL AND t.appointment_id IS NULL AS has_orphaned_reschedule_link
            FROM int_appointments_deduped a LEFT JOIN int_appointments_deduped t
                 ON t.appointment_id = a.rescheduled_to_id AND NOT t.is_duplicate_booking)
        SELECT *, CASE WHEN cancel_reason IS NOT NULL OR (NOT has_validated_reschedule_link AND raw_status = 'cancelled')
                            THEN 'cancelled'
                       WHEN has_validated_reschedule_link THEN 'rescheduled'
                       WHEN {MISS} THEN 'no_show' WHEN raw_status = 'attended' THEN 'attended'
                       WHEN raw_status = 'rescheduled' AND rescheduled_to_id IS NULL THEN 'rescheduled'
                       ELSE 'unresolved' END AS canonical_status,
               cancel_reason IS NOT NULL AND {MISS} AS is_cancel_misflag,
               has_validated_reschedule_link AND {MISS} AS is_reschedule_misflag, {MISS} AS is_naive_no_show
        FROM judged""",
    "live_rows": "SELECT * FROM int_appointments_canonical WHERE NOT is_duplicate_booking",
    "walked": """
        SELECT appointment_id AS root, appointment_id AS node, 1 AS hop,
               if(has_validated_reschedule_link, rescheduled_to_id, NULL) AS onward, canonical_status,
               [appointment_id] AS path
        FROM live_rows l
        WHERE NOT EXISTS (FROM live_rows o WHERE o.appointment_id = l.rescheduled_from_id)
        UNION ALL
        SELECT w.root, l.appointment_id, w.hop + 1,
               if(l.has_validated_reschedule_link, l.rescheduled_to_id, NULL), l.canonical_status,
               list_append(w.path, l.appointment_id)
        FROM walked w JOIN live_rows l ON l.appointment_id = w.onward
        WHERE NOT list_contains(w.path, w.onward)""",
    "int_appointment_chains": """
        SELECT root AS logical_visit_id, arg_max(node, hop) AS final_appointment_id,
               arg_max(canonical_status, hop) AS final_canonical_status, max(hop) - 1 AS reschedule_count
        FROM walked GROUP BY root""",
    "chain_membership": "SELECT root AS logical_visit_id, node AS appointment_id, hop AS hop_number FROM walked",
    "covered": """
        SELECT l.appointment_id, l.canonical_status, l.has_validated_reschedule_link, count(w.node) AS times_covered
        FROM live_rows l LEFT JOIN walked w ON w.node = l.appointment_id GROUP BY ALL""",
    "chain_anomalies": """
        SELECT appointment_id, 'unlinked_rescheduled' AS anomaly FROM covered
        WHERE canonical_status = 'rescheduled' AND NOT has_validated_reschedule_link
        UNION ALL SELECT appointment_id, 'not_in_any_chain' FROM covered WHERE times_covered = 0
        UNION ALL SELECT appointment_id, 'in_several_positions' FROM covered WHERE times_covered > 1
        UNION ALL SELECT root, 'chain_ends_in_loop' FROM walked WHERE list_contains(path, onward)""",
    "gone_round": """
        SELECT appointment_id AS node, rescheduled_to_id AS onward, [appointment_id] AS path
        FROM live_rows WHERE has_validated_reschedule_link
        UNION ALL
        SELECT g.node, if(l.has_validated_reschedule_link, l.rescheduled_to_id, NULL), list_append(g.path, l.appointment_id)
        FROM gone_round g JOIN live_rows l ON l.appointment_id = g.onward
        WHERE NOT list_contains(g.path, g.onward)""",
    "chain_loops": """
        SELECT list_min(path) AS loop_id, node AS appointment_id,
               CAST((len(path) + 1 - list_position(path, list_min(path))) % len(path) AS INTEGER) AS place,
               CAST(len(path) AS INTEGER) AS loop_size
        FROM gone_round WHERE onward = node""",
    "strayed": """
        SELECT appointment_id AS first, appointment_id AS node, 1 AS hop,
               if(has_validated_reschedule_link, rescheduled_to_id, NULL) AS onward, [appointment_id] AS path
        FROM live_rows l
        WHERE EXISTS (FROM live_rows o WHERE o.appointment_id = l.rescheduled_from_id)
          AND NOT EXISTS (FROM live_rows o WHERE o.has_validated_reschedule_link AND o.rescheduled_to_id = l.appointment_id)
        UNION ALL
        SELECT s.first, l.appointment_id, s.hop + 1,
               if(l.has_validated_reschedule_link, l.rescheduled_to_id, NULL), list_append(s.path, l.appointment_id)
        FROM strayed s JOIN live_rows l ON l.appointment_id = s.onward
        WHERE NOT list_contains(s.path, s.onward)""",
    "unrooted_chains": """
        SELECT first AS first_appointment_id, node AS appointment_id, hop AS hop_number FROM strayed""",
    "billing_lines_flagged": """
        SELECT b.*, a.appointment_id IS NULL AS is_unmatched_billing,
               a.appointment_id IS NOT NULL AND a.is_duplicate_booking AS is_orphaned_billing
        FROM stg_billing b LEFT JOIN int_appointments_deduped a USING (appointment_id)""",
    "int_billing_agg": """
        SELECT appointment_id, sum(if(line_type = 'office_visit', billed_amount, 0)) AS office_visit_billed,
               sum(if(line_type = 'no_show_fee', billed_amount, 0)) AS no_show_fee_billed,
               sum(if(line_type = 'late_cancel_fee', billed_amount, 0)) AS late_cancel_fee_billed,
               bool_or(line_type = 'office_visit') AS has_office_visit_charge,
               bool_or(line_type = 'no_show_fee') AS has_no_show_fee_charge,
               bool_or(line_type = 'late_cancel_fee') AS has_late_cancel_fee_charge,
               min(service_at) AS service_at, max(posted_at) AS last_posted_at
        FROM billing_lines_flagged WHERE NOT is_unmatched_billing AND NOT is_orphaned_billing GROUP BY 1""",
    "fct_appointments": """
        SELECT c.*, r.patient_id, r.doctor_id AS originating_doctor_id, r.location AS originating_location,
               r.appointment_type, r.scheduled_for AS originally_scheduled_for, r.booked_at,
               f.doctor_id AS final_doctor_id, f.location AS final_location, f.scheduled_for AS final_scheduled_for,
               f.checked_in_at, f.checkout_at, f.raw_status AS final_raw_status,
               b.* EXCLUDE (appointment_id, service_at, last_posted_at),
               c.final_canonical_status = 'attended' AS is_attended,
               c.final_canonical_status = 'no_show' AS is_true_no_show,
               c.final_canonical_status = 'cancelled' AS is_cancelled,
               c.final_canonical_status = 'unresolved' AS is_unresolved, c.reschedule_count > 0 AS was_rescheduled,
               c.final_canonical_status IN ('attended', 'no_show') AS is_kept_intent_visit
        FROM int_appointment_chains c JOIN live_rows r ON r.appointment_id = c.logical_visit_id
             JOIN live_rows f ON f.appointment_id = c.final_appointment_id
             LEFT JOIN int_billing_agg b ON b.appointment_id = c.final_appointment_id""",
    "fct_patient_engagement": f"""
        WITH tally AS (
            SELECT patient_id, count(*) AS total_logical_visits, {n('is_kept_intent_visit')} AS kept_intent_visit_count,
                   {n('is_true_no_show')} AS true_no_show_count, {n('is_attended')} AS attended_count,
                   {n('is_cancelled')} AS cancelled_count, {n('was_rescheduled')} AS visits_with_reschedule_count,
                   CAST(sum(reschedule_count) AS BIGINT) AS total_reschedule_hops,
                   max(final_scheduled_for) AS most_recent_visit_date
            FROM fct_appointments GROUP BY patient_id)
        SELECT *, {rate('true_no_show_count', 'kept_intent_visit_count')} AS true_no_show_rate,
               {rate('attended_count', 'kept_intent_visit_count')} AS attended_rate,
               {rate('visits_with_reschedule_count', 'total_logical_visits')} AS reschedule_rate,
               {rate('cancelled_count', 'total_logical_visits')} AS cancellation_rate,
               CASE WHEN kept_intent_visit_count = 0 THEN 'no_kept_intent_history'
                    WHEN true_no_show_count = 0 THEN 'low_risk'
                    WHEN true_no_show_count = 1 AND true_no_show_count / kept_intent_visit_count < 0.34
                        THEN 'moderate_risk' ELSE 'high_risk' END AS no_show_risk_segment
        FROM tally""",
    "fct_noshow_reconciliation_bridge": f"""
        WITH rows_at AS (
            SELECT location, count(*) AS naive_all_rows, {n('is_naive_no_show')} AS naive_no_show_count,
                   {n('is_naive_no_show AND is_duplicate_booking')} AS duplicate_no_show_rows,
                   {n('is_reschedule_misflag AND NOT is_duplicate_booking')} AS reschedule_misflags,
                   {n('is_cancel_misflag AND NOT is_duplicate_booking')} AS cancel_misflags
            FROM int_appointments_canonical GROUP BY location),
        visits_at AS (
            SELECT originating_location AS location, {n('is_true_no_show')} AS true_no_show_count,
                   {n('is_kept_intent_visit')} AS kept_intent_visit_count
            FROM fct_appointments GROUP BY originating_location),
        summed AS (
            SELECT if(grouping(location) = 1, 'ALL', location) AS location,
                   CAST(sum(naive_all_rows) AS BIGINT) AS naive_all_rows,
                   CAST(sum(naive_no_show_count) AS BIGINT) AS naive_no_show_count,
                   CAST(sum(duplicate_no_show_rows) AS BIGINT) AS duplicate_no_show_rows,
                   CAST(sum(reschedule_misflags) AS BIGINT) AS reschedule_misflags,
                   CAST(sum(cancel_misflags) AS BIGINT) AS cancel_misflags,
                   CAST(sum(true_no_show_count) AS BIGINT) AS true_no_show_count,
                   CAST(sum(kept_intent_visit_count) AS BIGINT) AS kept_intent_visit_count
            FROM rows_at JOIN visits_at USING (location) GROUP BY GROUPING SETS ((location), ()))
        SELECT *, {rate('naive_no_show_count', 'naive_all_rows')} AS naive_no_show_rate,
               naive_no_show_count - duplicate_no_show_rows - reschedule_misflags - cancel_misflags
                   AS bridged_true_no_show_count,
               {rate('true_no_show_count', 'kept_intent_visit_count')} AS true_no_show_rate
        FROM summed""",
    "every_row_has_one_canonical_status": """
        SELECT appointment_id, raw_status, canonical_status FROM int_appointments_canonical
        WHERE coalesce(canonical_status, '') NOT IN
              ('no_show', 'attended', 'rescheduled', 'cancelled', 'unresolved')""",
    "no_double_counted_visit_intent": "SELECT appointment_id, times_covered FROM covered WHERE times_covered <> 1",
    "no_double_counted_visit_intent_literal": """
        WITH ends AS (SELECT logical_visit_id AS id FROM int_appointment_chains
                      UNION ALL SELECT final_appointment_id FROM int_appointment_chains WHERE reschedule_count > 0
                                AND final_appointment_id <> logical_visit_id)
        SELECT appointment_id, count(id) AS times_covered FROM live_rows LEFT JOIN ends ON id = appointment_id
        GROUP BY 1 HAVING count(id) <> 1""",
    "bridge_ties_to_fct_appointments": """
        SELECT location, bridged_true_no_show_count, true_no_show_count FROM fct_noshow_reconciliation_bridge
        WHERE true_no_show_count <> bridged_true_no_show_count""",
    "billing_never_contradicts_canonical_status": """
        SELECT final_appointment_id, final_canonical_status, has_office_visit_charge, has_no_show_fee_charge
        FROM fct_appointments
        WHERE CASE final_canonical_status WHEN 'no_show' THEN has_office_visit_charge
                   WHEN 'attended' THEN has_no_show_fee_charge END""",
}

WORKFORCE = {
    "stg_departments": "SELECT department_id, department_code, department_name, division, cost_center FROM raw_departments",
    "stg_employees": f"""
        SELECT employee_id, person_id, full_name, department_id, job_level, {low('employment_type')}, location, hire_date,
               termination_date, {low('employment_status', 'raw_employment_status')}, prior_employee_id
        FROM raw_employees""",
    "stg_payroll": f"""
        SELECT payroll_id, employee_id, person_id, pay_period, gross_pay, {up('currency', 'currency_code')},
               is_partial_period, paid_at FROM raw_payroll""",
    "stg_performance_reviews": f"""
        SELECT review_id, employee_id, person_id, review_period, {low('rating')}, review_score, reviewer_id, review_date
        FROM raw_performance_reviews""",
    "int_employees_deduped": """
        SELECT *, row_number() OVER (PARTITION BY person_id, department_id, hire_date, termination_date
                                     ORDER BY employee_id) > 1 AS is_duplicate_record
        FROM stg_employees""",
    "int_employment_records_resolved": """
        SELECT *, termination_date IS NULL AS is_open,
               termination_date IS NULL AND raw_employment_status = 'terminated' AS is_status_date_conflict,
               if(termination_date IS NULL, 'open',
                  if(raw_employment_status = 'transferred', 'transferred_out', 'terminated')) AS resolved_state
        FROM int_employees_deduped WHERE NOT is_duplicate_record""",
    "int_employment_chain_classified": f"""
        SELECT r.*, p.resolved_state AS prior_resolved_state, p.termination_date AS prior_termination_date,
               r.prior_employee_id IS NOT NULL AND p.resolved_state = 'transferred_out' AS is_transfer_successor,
               r.prior_employee_id IS NOT NULL AND p.resolved_state = 'terminated' AS is_rehire_successor,
               CAST(if(p.resolved_state = 'terminated', r.hire_date - p.termination_date, 0) AS INTEGER) AS gap_days_before,
               CAST(coalesce(r.termination_date, {H_END}) - r.hire_date AS INTEGER) AS record_span_days
        FROM int_employment_records_resolved r
             LEFT JOIN int_employment_records_resolved p ON p.employee_id = r.prior_employee_id""",
    "int_person_employment_summary": f"""
        WITH life AS (
            SELECT *, min(hire_date) OVER who AS first_ever_hire_date, count(*) OVER who AS employment_record_count,
                   CAST(sum(record_span_days) OVER who AS BIGINT) AS total_time_in_seat_days,
                   bool_or(is_transfer_successor) OVER who AS had_transfer,
                   bool_or(is_rehire_successor) OVER who AS had_rehire,
                   max(if(resolved_state = 'terminated', termination_date, NULL)) OVER who AS gone
            FROM int_employment_chain_classified WINDOW who AS (PARTITION BY person_id)
            QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY hire_date DESC NULLS FIRST, employee_id DESC) = 1),
        ended AS (SELECT *, CASE resolved_state WHEN 'open' THEN {H_END} WHEN 'terminated' THEN termination_date
                                 ELSE gone END AS until FROM life)
        SELECT person_id, first_ever_hire_date, employment_record_count, total_time_in_seat_days, had_transfer, had_rehire,
               employee_id AS current_employee_id, department_id AS current_department_id,
               job_level AS current_job_level, employment_type AS current_employment_type,
               location AS current_location, hire_date AS most_recent_hire_date,
               termination_date AS most_recent_termination_date, resolved_state AS latest_record_state,
               record_span_days AS current_stint_span_days, resolved_state = 'open' AS is_currently_active,
               resolved_state = 'transferred_out' AS has_dangling_transfer, until AS tenure_reference_end_date,
               CAST(until - first_ever_hire_date AS INTEGER) AS tenure_since_first_hire_days
        FROM ended""",
    "int_payroll_deduped": """
        SELECT p.*, row_number() OVER (PARTITION BY p.employee_id, p.pay_period ORDER BY p.payroll_id) > 1
                   AS is_duplicate_period,
               coalesce(e.is_duplicate_record, true) AS is_orphaned_payroll
        FROM stg_payroll p LEFT JOIN int_employees_deduped e USING (employee_id)""",
    "int_reviews_deduped": """
        SELECT r.*, row_number() OVER (PARTITION BY r.employee_id, r.review_period, r.rating, r.review_score
                                       ORDER BY r.review_id) > 1 AS is_duplicate_review,
               coalesce(e.is_duplicate_record, true) AS is_orphaned_review,
               r.review_date IS NULL AS is_missing_review_date
        FROM stg_performance_reviews r LEFT JOIN int_employees_deduped e USING (employee_id)""",
    "fct_workforce": f"""
        SELECT s.* EXCLUDE (current_employee_id, latest_record_state, tenure_reference_end_date, total_time_in_seat_days),
               d.department_name, d.division, d.cost_center, total_time_in_seat_days AS tenure_time_in_seat_days,
               {years('total_time_in_seat_days')} AS tenure_time_in_seat_years,
               {years('tenure_since_first_hire_days')} AS tenure_since_first_hire_years,
               {years('current_stint_span_days')} AS current_stint_span_years,
               tenure_since_first_hire_days - total_time_in_seat_days AS rehire_gap_days_excluded
        FROM int_person_employment_summary s LEFT JOIN stg_departments d ON d.department_id = s.current_department_id""",
    "fct_department_workforce": f"""
        WITH flow AS (
            SELECT department_id,
                   {n(f'is_transfer_successor AND hire_date BETWEEN {H_START} AND {H_END}')} AS arrivals,
                   {n(f"resolved_state = 'transferred_out' AND {CLOSED}")} AS departures,
                   {n(f"resolved_state = 'terminated' AND {CLOSED}")} AS exits
            FROM int_employment_chain_classified WHERE hire_date <= {H_END} GROUP BY 1),
        staff AS (SELECT current_department_id AS department_id, count(*) AS heads,
                         CAST(round(avg(tenure_time_in_seat_years), 2) AS DECIMAL(12,2)) AS seat
                  FROM fct_workforce WHERE is_currently_active GROUP BY 1),
        unit AS (SELECT d.department_id, d.department_name, d.division, d.cost_center, coalesce(heads, 0) AS heads, seat,
                        coalesce(arrivals, 0) AS arrivals, coalesce(departures, 0) AS departures,
                        coalesce(exits, 0) AS exits
                 FROM stg_departments d LEFT JOIN staff USING (department_id) LEFT JOIN flow USING (department_id)),
        listed AS (SELECT * FROM unit UNION ALL
                   SELECT NULL, 'ALL', 'ALL', 'ALL', CAST(sum(heads) AS BIGINT),
                          CAST(round(sum(seat * heads) / nullif(sum(heads), 0), 2) AS DECIMAL(12,2)),
                          CAST(sum(arrivals) AS BIGINT), CAST(sum(departures) AS BIGINT), CAST(sum(exits) AS BIGINT)
                   FROM unit)
        SELECT department_id, department_name, division, cost_center, heads AS active_headcount,
               seat AS avg_tenure_time_in_seat_years, arrivals AS transfers_in, departures AS transfers_out,
               exits AS genuine_exits, {rate('exits', 'heads')} AS naive_department_attrition_rate
        FROM listed""",
    "fct_attrition_tenure_reconciliation_bridge": f"""
        WITH raw_side AS (SELECT {n(CLOSED)} AS naive_record_closures,
                                 {n(f'is_duplicate_record AND {CLOSED}')} AS duplicate_closed_records
                          FROM int_employees_deduped),
        kept_side AS (
            SELECT {n(f"resolved_state = 'transferred_out' AND {CLOSED}")} AS transfer_closure_count,
                   {n(f"resolved_state = 'terminated' AND {CLOSED}")} AS true_genuine_exit_count,
                   count(DISTINCT person_id) FILTER (WHERE hire_date <= {H_START}
                       AND coalesce(termination_date, DATE '9999-01-01') > {H_START}) AS headcount_at_window_start,
                   count(DISTINCT person_id) FILTER (WHERE hire_date <= {H_END}
                       AND coalesce(termination_date, DATE '9999-01-01') > {H_END}) AS headcount_at_window_end
            FROM int_employment_records_resolved),
        tenure AS (SELECT CAST(round(avg(tenure_time_in_seat_years), 2) AS DECIMAL(12,2)) AS avg_tenure_time_in_seat_years,
                          CAST(round(avg(tenure_since_first_hire_years), 2) AS DECIMAL(12,2))
                              AS avg_tenure_since_first_hire_years,
                          CAST(round(avg(current_stint_span_years), 2) AS DECIMAL(12,2)) AS avg_current_stint_span_years
                   FROM fct_workforce WHERE is_currently_active)
        SELECT '2001-01-01' AS window_start, '2001-12-31' AS window_end, *,
               naive_record_closures - duplicate_closed_records - transfer_closure_count AS bridged_true_genuine_exits,
               CAST((headcount_at_window_start + headcount_at_window_end) / 2 AS DECIMAL(20,1)) AS avg_headcount,
               {rate('naive_record_closures', '(headcount_at_window_start + headcount_at_window_end) / 2')}
                   AS naive_finance_attrition_rate,
               {rate('true_genuine_exit_count', '(headcount_at_window_start + headcount_at_window_end) / 2')}
                   AS true_attrition_rate,
               CAST(avg_tenure_since_first_hire_years - avg_current_stint_span_years AS DECIMAL(12,2))
                   AS approx_tenure_spread_years
        FROM raw_side, kept_side, tenure""",
    "rehire_rate": f"""
        SELECT count(*) AS people, {n('had_rehire')} AS people_with, {rate(n('had_rehire'), 'count(*)')} AS rehire_rate
        FROM fct_workforce""",
    "internal_mobility_rate": f"""
        SELECT count(*) AS people, {n('had_transfer')} AS people_with,
               {rate(n('had_transfer'), 'count(*)')} AS internal_mobility_rate
        FROM fct_workforce""",
    "headcount_reconciles_to_distinct_active_people": f"""
        SELECT * FROM (SELECT {n('is_currently_active')} AS mart_active_headcount FROM fct_workforce),
             (SELECT headcount_at_window_end AS recount_active_headcount
              FROM fct_attrition_tenure_reconciliation_bridge)
        WHERE mart_active_headcount <> recount_active_headcount""",
    "transfers_net_to_zero_across_departments": """
        SELECT CAST(sum(transfers_in) AS BIGINT) AS total_transfers_in,
               CAST(sum(transfers_out) AS BIGINT) AS total_transfers_out
        FROM fct_department_workforce WHERE department_name <> 'ALL' HAVING sum(transfers_in - transfers_out) <> 0""",
    "department_headcount_sums_to_company_total": """
        SELECT CAST(sum(active_headcount) FILTER (WHERE department_name <> 'ALL') AS BIGINT) AS dept_sum,
               max(active_headcount) FILTER (WHERE department_name = 'ALL') AS company_headcount
        FROM fct_department_workforce HAVING dept_sum <> company_headcount""",
    "department_headcount_matches_workforce": f"""
        SELECT * FROM (SELECT {n('is_currently_active')} AS active_people FROM fct_workforce),
             (SELECT active_headcount AS company_headcount FROM fct_department_workforce WHERE department_name = 'ALL')
        WHERE active_people <> company_headcount""",
    "bridge_ties_to_true_genuine_exits": """
        SELECT bridged_true_genuine_exits, true_genuine_exit_count FROM fct_attrition_tenure_reconciliation_bridge
        WHERE bridged_true_genuine_exits <> true_genuine_exit_count""",
    "dangling_transfer": """
        SELECT person_id, current_employee_id, most_recent_termination_date FROM int_person_employment_summary
        WHERE has_dangling_transfer""",
}

MODELS = {**REVENUE, **LENDING, **VISITS, **WORKFORCE}
