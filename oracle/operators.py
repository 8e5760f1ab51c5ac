"""The stand-alone operator queries as SQL."""

from .feeds import LK, MONEY
from .models import H_START, month, n, rate  # noqa: F401

PRIORITY_CUT = f"""
    SELECT coalesce(o_orderpriority, 'ALL') AS o_orderpriority, count(*) AS orders,
           {n('o_totalprice > 200000')} AS large_orders, sum(CAST(o_totalprice AS {MONEY})) AS amount
    FROM orders GROUP BY CUBE (o_orderpriority)"""

OPERATORS = {
    "normalize_project": f"""
        SELECT c_custkey AS customer_id, lower(trim(c_mktsegment)) AS segment, upper(trim(c_name)) AS customer_name,
               CAST(c_acctbal AS {MONEY}) AS balance FROM customer""",
    "flag_clock_skew": "SELECT order_id, created_at, updated_at, has_clock_skew FROM stg_orders",
    "date_window_filter": f"""
        SELECT l_returnflag, count(*) AS lines, sum(CAST(l_extendedprice AS {MONEY})) AS amount
        FROM lineitem WHERE year(l_shipdate) = 1997 GROUP BY 1""",
    "point_in_time_headcount": f"""
        SELECT department_id, count(DISTINCT person_id) AS headcount FROM int_employment_records_resolved
        WHERE hire_date <= {H_START} AND (is_open OR termination_date > {H_START}) GROUP BY 1""",
    "priority_classify": """
        SELECT if(l_returnflag = 'R', 'returned', if(l_linestatus = 'O', 'open',
                  if(l_discount >= 0.05::DOUBLE, 'discounted', 'plain'))) AS line_kind, count(*) AS lines
        FROM lineitem GROUP BY 1""",
    "bucketize_dpd": """
        SELECT risk_bucket, count(*) AS loans, min(true_dpd) AS least_dpd, max(true_dpd) AS most_dpd
        FROM fct_loan_performance GROUP BY 1""",
    "days_overdue": """
        SELECT l_orderkey, CAST(DATE '2001-11-30' - min(CAST(l_shipdate AS DATE)) AS INTEGER) AS days_overdue
        FROM lineitem GROUP BY 1""",
    "left_join_preagg": f"""
        SELECT c_custkey, c_mktsegment, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS orders,
               coalesce((SELECT sum(CAST(o_totalprice AS {MONEY})) FROM orders WHERE o_custkey = c_custkey), 0) AS spent,
               (SELECT count(*) FROM events WHERE user_id = c_custkey) AS events,
               (SELECT max(ts) FROM events WHERE user_id = c_custkey) AS last_event_at
        FROM customer""",
    "inner_join": f"""
        SELECT o_orderkey, c_custkey, c_mktsegment, CAST(o_totalprice AS {MONEY}) AS amount
        FROM customer JOIN orders ON c_custkey = o_custkey""",
    "prior_record_lookup": """
        SELECT employee_id, prior_employee_id, prior_resolved_state, prior_termination_date
        FROM int_employment_chain_classified""",
    "validate_links": """
        SELECT appointment_id, rescheduled_to_id, has_validated_reschedule_link, has_orphaned_reschedule_link
        FROM int_appointments_canonical""",
    "anti_join_roots": """
        SELECT appointment_id AS root_appointment_id FROM live_rows
        WHERE coalesce(rescheduled_from_id, '') NOT IN (SELECT appointment_id FROM live_rows)""",
    "resolve_chains": """
        SELECT logical_visit_id AS root, final_appointment_id AS last, reschedule_count AS hops
        FROM int_appointment_chains""",
    "cross_join_scalars": f"""
        SELECT *, {rate('line_amount', 'order_amount')} AS line_share
        FROM (SELECT sum(CAST(l_extendedprice AS {MONEY})) AS line_amount, count(*) AS lines FROM lineitem),
             (SELECT sum(CAST(o_totalprice AS {MONEY})) AS order_amount FROM orders),
             (SELECT count(*) AS events FROM events)""",
    "dimension_lookup": """
        SELECT c_custkey, c_nationkey, n_name AS nation_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "flag_orphans": """
        SELECT o_orderkey, o_custkey,
               NOT EXISTS (FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0) AS is_orphaned_order
        FROM orders""",
    "grouped_basic_agg": f"""
        SELECT l_suppkey, sum(CAST(l_extendedprice AS {MONEY})) AS amount, min(l_shipdate) AS first_ship,
               max(l_shipdate) AS last_ship, count(*) AS lines FROM lineitem GROUP BY 1""",
    "conditional_sum": f"""
        SELECT l_linenumber, sum(CAST(l_extendedprice AS {MONEY})) AS amount,
               coalesce(sum(CAST(l_extendedprice AS {MONEY})) FILTER (WHERE l_returnflag = 'R'), 0) AS returned_amount
        FROM lineitem GROUP BY 1""",
    "conditional_count": f"""
        SELECT o_orderpriority, {n("o_orderstatus = 'F'")} AS filled, {n('o_totalprice > 200000')} AS large
        FROM orders GROUP BY 1""",
    "conditional_count_distinct": """
        SELECT l_suppkey, count(DISTINCT l_partkey) AS parts,
               count(DISTINCT if(l_returnflag = 'R', l_partkey, NULL)) AS returned_parts,
               count(DISTINCT if(l_linestatus = 'O', l_partkey, NULL)) AS open_parts
        FROM lineitem GROUP BY 1""",
    "latest_by_key": """
        SELECT o_custkey, o_orderkey AS latest_orderkey, o_orderstatus AS latest_status,
               count(*) OVER (PARTITION BY o_custkey) AS orders
        FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1""",
    "marts_by_period": """
        SELECT 'fct_revenue_monthly' AS mart, row_number() OVER (ORDER BY report_month) AS position,
               CAST(report_month AS VARCHAR) AS label FROM fct_revenue_monthly
        UNION ALL
        SELECT 'fct_revenue_reconciliation_bridge', row_number() OVER (ORDER BY order_cohort_month),
               CAST(order_cohort_month AS VARCHAR) FROM fct_revenue_reconciliation_bridge""",
    "marts_totals_last": "\n        UNION ALL\n".join(
        f"""        SELECT '{mart}' AS mart, row_number() OVER (ORDER BY {s} = 'ALL', {s}) AS position, {s} AS label FROM {mart}"""
        for mart, s in (
            ("fct_portfolio_metrics", "product_type"),
            ("fct_par_reconciliation_bridge", "product_type"),
            ("fct_noshow_reconciliation_bridge", "location"),
            ("fct_department_workforce", "department_name"),
        )
    ),
    "catalog_bucket_join": """
        SELECT shipment_status, count(*) AS orders, sum(net_revenue) AS net_revenue, sum(total_refunded) AS refunded,
               sum(cancellation_leakage_amount) AS leakage
        FROM fct_revenue GROUP BY shipment_status""",
    "any_flag": """
        SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') > 0 AS any_returned,
               count(*) FILTER (WHERE l_linestatus = 'O') > 0 AS any_open FROM lineitem GROUP BY 1""",
    "weighted_mean_total": f"""
        SELECT CAST(sum(k) AS BIGINT) AS customers, CAST(round(sum(mean * k) / sum(k), 2) AS {MONEY}) AS mean_balance
        FROM (SELECT count(*) AS k, CAST(round(avg(CAST(c_acctbal AS {MONEY})), 2) AS {MONEY}) AS mean
              FROM customer GROUP BY c_mktsegment)""",
    "having_filter": f"""
        SELECT o_custkey, count(*) AS orders, sum(CAST(o_totalprice AS {MONEY})) AS spent FROM orders
        GROUP BY 1 HAVING spent > 3000000""",
    "segment_rollup": f"SELECT *, {rate('large_orders', 'orders')} AS large_share FROM ({PRIORITY_CUT})",
    "totals_last_sort": f"SELECT * FROM ({PRIORITY_CUT}) ORDER BY o_orderpriority = 'ALL', o_orderpriority",
    "flag_duplicates": f"""
        SELECT {LK} AS line_id, l_orderkey, l_linenumber, l_shipdate,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, {LK}) > 1 AS is_duplicate
        FROM lineitem""",
    "flag_duplicates_preferred": """
        SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS event_day, value,
               row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                                  ORDER BY value < 10, event_id) > 1 AS is_duplicate
        FROM events""",
    "flag_duplicates_subset": f"""
        SELECT {LK} AS line_id, l_orderkey, l_returnflag, l_shipdate,
               l_returnflag = 'R' AND row_number() OVER (PARTITION BY l_orderkey, l_returnflag
                                                         ORDER BY l_shipdate, {LK}) > 1 AS is_duplicate
        FROM lineitem""",
    "first_per_key": f"""
        SELECT {LK} AS line_id, l_orderkey, l_shipdate, l_partkey, CAST(l_extendedprice AS {MONEY}) AS amount
        FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, line_id) = 1""",
    "latest_record_per_key": """
        SELECT event_id, user_id, event_type, ts, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) = 1""",
}
