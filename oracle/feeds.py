"""The raw feeds as SQL over the supplied tables."""

MONEY = "DECIMAL(18,2)"


def money(x: str) -> str:
    return f"CAST({x} AS {MONEY})"


def share(x: str, part: str) -> str:
    return f"CAST({money(x)} * CAST({part} AS DECIMAL(3,2)) AS {MONEY})"


def text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


LK = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT))"
CCY = "if(o_custkey % 7 = 0, ' eur', 'usd ')"
EMPLOYEE = f"{text('if(l_suppkey % 50 = 0, -l_orderkey - 1, l_orderkey)')}"
OWNER = text("l_orderkey // 4")

FEEDS = {
    "raw_orders": f"""
        SELECT {text('o_orderkey')} AS order_id, {text('o_custkey')} AS customer_id,
               CASE WHEN o_orderkey % 9 = 0 THEN ' Cancelled ' WHEN o_orderstatus = 'F' THEN 'COMPLETED'
                    WHEN o_orderstatus = 'O' THEN 'confirmed' ELSE 'placed' END AS order_status,
               {money('o_totalprice')} AS order_amount, {CCY} AS currency, o_orderdate AS created_at,
               o_orderdate + if(o_orderkey % 500 = 0, -1, 3) * INTERVAL 1 DAY AS updated_at
        FROM orders""",
    "raw_payments": f"""
        SELECT {LK} AS payment_id, {text('l_orderkey')} AS order_id,
               if(l_linenumber = 1, 'Succeeded', ' failed') AS payment_status,
               {money('o_totalprice')} AS amount, {CCY} AS currency,
               if(l_partkey % 2 = 0, 'card', 'wallet') AS payment_method,
               {share('o_totalprice', '0.02')} AS gateway_fee, l_shipdate AS attempted_at,
               if(l_linenumber = 1, l_shipdate, NULL) AS processed_at
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "raw_refunds": f"""
        SELECT {LK} AS refund_id, {text('l_orderkey')} AS order_id, {LK} AS payment_id,
               if(l_returnflag = 'R', {money('o_totalprice')}, {share('o_totalprice', '0.50')}) AS refund_amount,
               {CCY} AS currency, if(l_returnflag = 'R', 'returned', 'damaged') AS refund_reason,
               if(done, 'Completed ', ' pending') AS refund_status, l_shipdate + INTERVAL 30 DAY AS requested_at,
               if(done, l_shipdate + INTERVAL 40 DAY, NULL) AS processed_at
        FROM (SELECT *, l_linenumber = 1 AND (l_returnflag = 'R' OR (l_returnflag = 'A' AND l_partkey % 3 = 0)) AS done
              FROM lineitem) JOIN orders ON o_orderkey = l_orderkey""",
    "raw_shipping": f"""
        SELECT {LK} AS shipment_id, {text('l_orderkey')} AS order_id,
               if(l_suppkey % 2 = 0, 'post', 'courier') AS carrier, {share('l_extendedprice', '0.01')} AS shipping_cost,
               if(l_linestatus = 'F', ' Delivered', 'in_transit') AS status,
               if(l_suppkey % 10 = 0, NULL, l_shipdate) AS shipped_at,
               if(l_linestatus = 'F', l_shipdate + INTERVAL 5 DAY, NULL) AS delivered_at
        FROM lineitem""",
    "raw_applications": f"""
        SELECT {text('o_orderkey')} AS application_id, {text('o_custkey')} AS customer_id,
               o_orderpriority AS product_type, if(o_custkey % 2 = 0, 'web', 'branch') AS channel,
               {money('o_totalprice')} AS requested_amount, 'usd ' AS currency,
               CASE WHEN o_orderkey % 13 = 0 THEN ' Declined' WHEN o_orderstatus = 'P' THEN 'PENDING'
                    ELSE 'approved ' END AS decision,
               if(o_orderkey % 13 = 0, 'affordability', NULL) AS decline_reason, o_orderdate AS submitted_at,
               o_orderdate + if(o_orderkey % 500 = 0, -1, 2) * INTERVAL 1 DAY AS decided_at
        FROM orders""",
    "raw_loans": f"""
        SELECT {text('o_orderkey')} AS loan_id, {text('o_orderkey')} AS application_id,
               {text('o_custkey')} AS customer_id, o_orderpriority AS product_type,
               {money('o_totalprice')} AS principal_amount, ' usd' AS currency,
               CAST(o_custkey % 10 + 5 AS DOUBLE) / 100 AS interest_rate_apr,
               CAST((o_orderkey % 5 + 1) * 12 AS INTEGER) AS term_months,
               CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' WHEN o_orderkey % 5 = 0 THEN ' restructured'
                    WHEN o_orderstatus = 'O' THEN 'active' ELSE 'delinquent' END AS loan_status,
               o_orderdate AS originated_at, CAST(o_orderdate AS DATE) + 30 AS first_due_date,
               if(o_orderkey % 5 = 0, o_orderdate + INTERVAL 200 DAY, NULL) AS restructured_at
        FROM orders""",
    "raw_repayments": f"""
        SELECT repayment_id, loan_id, instalment_no, scheduled_amount,
               CASE WHEN miss THEN CAST(0 AS {MONEY}) WHEN short THEN {share('l_extendedprice', '0.60')}
                    ELSE scheduled_amount END AS amount_paid, 'usd' AS currency,
               CASE WHEN miss THEN 'missed' WHEN short THEN ' Partial' ELSE 'POSTED' END AS payment_status,
               due_date, if(miss, NULL, l_shipdate + INTERVAL 2 DAY) AS paid_at
        FROM (SELECT {LK} AS repayment_id, {text('l_orderkey')} AS loan_id, l_linenumber AS instalment_no,
                     {money('l_extendedprice')} AS scheduled_amount, l_extendedprice, l_shipdate,
                     CAST(l_shipdate AS DATE) AS due_date, l_returnflag = 'N' AS short,
                     l_partkey % 4 = 0 AND l_shipdate > TIMESTAMP '1999-01-01' AS miss FROM lineitem)""",
    "raw_defaults": f"""
        SELECT 'D' || o_orderkey AS default_id, {text('o_orderkey // 12 * 12')} AS loan_id,
               CASE o_orderkey % 36 WHEN 0 THEN 'fraud' WHEN 12 THEN 'arrears' ELSE 'deceased' END AS default_reason,
               {share('o_totalprice', '0.50')} AS outstanding_at_default, 'usd' AS currency,
               CASE o_orderkey % 36 WHEN 0 THEN ' open' WHEN 12 THEN 'IN_RECOVERY' ELSE 'open' END AS default_status,
               o_orderdate + INTERVAL 300 DAY AS flagged_at
        FROM orders
        UNION ALL
        SELECT 'E' || o_orderkey, {text('o_orderkey // 12 * 12')}, 'arrears', {share('o_totalprice', '0.40')}, 'usd',
               'Written_Off', o_orderdate + INTERVAL 400 DAY
        FROM orders WHERE o_orderkey % 60 = 0""",
    "raw_patients": f"""
        SELECT {text('user_id')} AS patient_id, CAST(user_id % 70 + 1930 AS INTEGER) AS birth_year,
               CASE user_id % 3 WHEN 0 THEN ' f' WHEN 1 THEN 'm' ELSE 'X ' END AS sex,
               if(user_id % 2 = 0, 'Gold ', 'basic') AS insurance_plan, ' Loc' || (user_id % 5) AS home_location,
               min(ts) AS registered_at
        FROM events GROUP BY user_id""",
    "raw_doctors": f"""
        SELECT {text('d')} AS doctor_id, 'Dr ' || d AS provider_name,
               if(d % 2 = 0, 'Cardiology ', 'gp') AS specialty, 'LOC' || d AS primary_location,
               min(ts) AS hired_at, d <> 3 AS is_active
        FROM (SELECT event_id % 4 AS d, ts FROM events) GROUP BY d""",
    "raw_appointments": f"""
        SELECT {text('event_id')} AS appointment_id, {text('user_id')} AS patient_id,
               {text('event_id % 4')} AS doctor_id, 'Loc' || (user_id % 5) AS location,
               if(user_id % 3 = 0, ' New', 'Follow_Up') AS appointment_type,
               CASE event_type WHEN 'view' THEN 'Attended' WHEN 'click' THEN 'no_show ' WHEN 'error' THEN 'Missed'
                    WHEN 'purchase' THEN 'cancelled' ELSE if(event_id % 2 = 0, 'no-show', 'rescheduled') END AS status,
               date_trunc('day', ts)::TIMESTAMP AS scheduled_for, ts - INTERVAL 7 DAY AS booked_at,
               if(event_type = 'view', ts, NULL) AS checked_in_at,
               if(event_type = 'view', ts + INTERVAL 1 DAY, NULL) AS checkout_at,
               if(event_type = 'purchase' OR (event_type = 'click' AND event_id % 6 = 0)
                  OR (event_type = 'signup' AND event_id % 70 = 0), 'Patient ', NULL) AS cancel_reason,
               {text('''CASE WHEN event_id % 40 IN (1, 5, 6, 10, 11, 12, 13, 14, 15, 22, 25, 30)
                               OR event_id % 2000 BETWEEN 1000 AND 1012 THEN event_id + 1
                             WHEN event_id % 40 = 20 THEN -1
                             WHEN event_id % 40 IN (27, 31) THEN event_id - 1 END''')} AS rescheduled_to_id,
               {text('''CASE WHEN event_id % 40 IN (2, 6, 7, 11, 12, 13, 14, 15, 16, 26)
                               OR event_id % 2000 BETWEEN 1001 AND 1013 THEN event_id - 1
                             WHEN event_id % 40 = 30 THEN event_id + 1
                             WHEN event_id % 40 = 31 THEN event_id - 1 END''')} AS rescheduled_from_id
        FROM events""",
    "raw_billing": f"""
        SELECT 'B' || event_id AS billing_id,
               {text('CASE WHEN event_id % 97 = 0 THEN -event_id - 1 WHEN event_id % 11 = 1 THEN event_id - 1 ELSE event_id END')}
                   AS appointment_id,
               {text('user_id')} AS patient_id,
               CASE WHEN event_type = 'view' THEN 'Office_Visit' WHEN event_type = 'purchase' THEN ' late_cancel_fee'
                    WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 'office_visit' ELSE 'no_show_fee ' END AS line_type,
               {money('value')} AS billed_amount, {share('value', '0.80')} AS insurance_covered,
               CAST({money('value')} - {share('value', '0.80')} AS {MONEY}) AS patient_responsibility,
               ts AS service_at, ts + (event_id % 45) * INTERVAL 1 DAY AS posted_at
        FROM events""",
    "raw_departments": f"""
        SELECT {text('n_nationkey')} AS department_id, 'D' || n_nationkey AS department_code,
               n_name AS department_name, r_name AS division, 'CC' || n_regionkey AS cost_center
        FROM nation LEFT JOIN region ON r_regionkey = n_regionkey""",
    "stints": """
        SELECT *, o_orderkey // 4 AS p, least(o_orderkey % 4, if((o_orderkey // 4) % 4 = 0, 2, 3)) AS e,
               if((o_orderkey // 4) % 4 = 0, 2, 3) AS final_e, 150 + ((o_orderkey // 4) * 31) % 350 AS span
        FROM orders""",
    "dated_stints": """
        SELECT *, DATE '1995-01-01' + CAST((p * 97) % 1000 + e * span
                  + 45 * (if(e > 0 AND p % 3 = 0, 1, 0) + if(e > 1 AND (p + 1) % 3 = 0, 1, 0)
                          + if(e > 2 AND (p + 2) % 3 = 0, 1, 0)) AS INTEGER) AS hired,
               p % 4 = 1 OR p % 8 = 0 AS leaves
        FROM stints""",
    "raw_employees": f"""
        SELECT {text('o_orderkey')} AS employee_id, {text('p')} AS person_id, 'Person ' || p AS full_name,
               {text('(p + e) % 25')} AS department_id, 'L' || substr(o_orderpriority, 1, 1) AS job_level,
               if(o_custkey % 7 = 0, ' Contract', 'Full_Time ') AS employment_type,
               'Site ' || (o_custkey % 6) AS location, hired AS hire_date,
               if(e < final_e OR leaves, hired + CAST(span AS INTEGER), NULL) AS termination_date,
               CASE WHEN e < final_e AND (p + e) % 3 = 0 THEN ' Terminated'
                    WHEN e < final_e OR (leaves AND p % 20 = 1) THEN 'transferred '
                    WHEN leaves OR p % 10 = 3 THEN 'terminated' ELSE 'Active' END AS employment_status,
               if(e > 0, {text('p * 4 + e - 1')}, NULL) AS prior_employee_id
        FROM dated_stints""",
    "raw_payroll": f"""
        SELECT {LK} AS payroll_id, {EMPLOYEE} AS employee_id, {OWNER} AS person_id,
               '2001-0' || l_linenumber AS pay_period, {money('l_extendedprice')} AS gross_pay,
               CASE l_suppkey % 4 WHEN 0 THEN 'usd ' WHEN 1 THEN ' gbp' WHEN 2 THEN 'eur' ELSE 'sgd' END AS currency,
               l_quantity < 5 AS is_partial_period, l_shipdate AS paid_at
        FROM lineitem""",
    "raw_performance_reviews": f"""
        SELECT {LK} AS review_id, {EMPLOYEE} AS employee_id, {OWNER} AS person_id,
               'H' || (l_linenumber % 3) AS review_period,
               CASE WHEN l_quantity > 37 THEN 'Outstanding ' WHEN l_quantity > 25 THEN 'exceeds'
                    WHEN l_quantity > 12 THEN ' Meets' ELSE 'below' END AS rating,
               CAST(CASE WHEN l_quantity > 37 THEN 4.50 WHEN l_quantity > 25 THEN 3.75
                         WHEN l_quantity > 12 THEN 3.00 ELSE 1.50 END AS DECIMAL(4,2)) AS review_score,
               'R' || (l_suppkey % 20) AS reviewer_id,
               if(l_suppkey % 10 = 0, NULL, CAST(l_shipdate AS DATE)) AS review_date
        FROM lineitem""",
}
