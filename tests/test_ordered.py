"""Written order, catalog tables, and reading them back."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tieout.operators import (
    files_in_order,
    read_ordered,
    totals_last_order,
    with_position,
    write_ordered,
)
from tieout.operators.ordered import place_of
from tieout.plans import Lending, Revenue, Visits, Workforce, catalog
from tieout.plans import operator_queries as ops
from tieout.plans.publish import build, write_mart
from tieout.session import scratch_path
from tieout.sources import raw_tables


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test-ordered")


@pytest.fixture(scope="module")
def shuffled(spark):
    rows = [(i // 3, f"v{i}") for i in range(3_000)] + [(None, "none")] * 3
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "k int, v string").repartition(7)


def test_rows_come_back_in_the_order_they_were_written_in(spark, shuffled, path):
    write_ordered(shuffled, path, [F.col("k").asc_nulls_last(), F.col("v")], files=5)
    assert len(files_in_order(spark, path)) == 5
    got = read_ordered(spark, path).collect()
    want = sorted((tuple(r) for r in shuffled.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [tuple(r) for r in got] == want
    plan = read_ordered(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert [r.v for r in read_ordered(spark, path).limit(4).collect()] == [r[1] for r in want[:4]]
    placed = with_position(spark, path)
    assert [(r.k, r.v) for r in sorted(placed.collect(), key=lambda r: r.position)] == want
    assert sorted(r.position for r in placed.collect()) == list(range(1, len(want) + 1))


def test_falling_order_and_empty_rows(spark, shuffled, path):
    write_ordered(shuffled, path, [F.col("k").desc_nulls_first()], files=4)
    got = [r.k for r in read_ordered(spark, path).collect()]
    assert got == sorted(got, key=lambda k: (k is not None, -(k or 0))) and got[0] is None
    write_ordered(shuffled.limit(0), path, [F.col("k")], files=4)
    assert read_ordered(spark, path).count() == 0 and with_position(spark, path).count() == 0


def test_files_of_another_kind_are_refused():
    with pytest.raises(ValueError, match="order"):
        place_of("data.parquet")
    assert place_of("part-00012-a1-c003.snappy.parquet") == (12, 3) and place_of("part-123456-a.parquet") == (123456, 0)


MARTS = {
    "fct_revenue_monthly": (ops.revenue, "report_month"),
    "fct_revenue_reconciliation_bridge": (ops.revenue, "order_cohort_month"),
    "fct_portfolio_metrics": (ops.lending, "product_type"),
    "fct_par_reconciliation_bridge": (ops.lending, "product_type"),
    "fct_noshow_reconciliation_bridge": (ops.visits, "location"),
    "fct_department_workforce": (ops.workforce, "department_name"),
}


@pytest.mark.parametrize("mart", MARTS)
def test_marts_are_written_in_order_over_several_files(spark, tiny, path, mart):
    make, column = MARTS[mart]
    project = make(spark, tiny)
    order = project.order(mart)
    write_mart(project.model(mart), path, order, files=3)
    assert len(files_in_order(spark, path)) > 1
    got = [r[column] for r in read_ordered(spark, path).collect()]
    label = lambda v: (v == "ALL", v is None, str(v))
    assert got == sorted(got, key=label) and len(got) > 2
    if mart in project.by_segment:
        assert got[-1] == "ALL"


def test_every_mart_with_a_final_sort_has_one():
    listed = {name for cls in (Revenue, Lending, Visits, Workforce) for name in (*cls.by_period, *cls.by_segment)}
    assert listed == set(MARTS)
    assert all(name in cls.marts for cls in (Revenue, Lending, Visits, Workforce) for name in (*cls.by_period, *cls.by_segment))


def test_a_build_writes_marts_in_order(spark, path):
    project = Revenue(fx.feeds(spark, "revenue", fx.REVENUE))
    build(project, path, ["fct_revenue_reconciliation_bridge"])
    months = [r.order_cohort_month for r in read_ordered(spark, f"{path}/fct_revenue_reconciliation_bridge").collect()]
    assert months == sorted(months)


def test_totals_come_last_whatever_segments_are_called(spark, path):
    rows = spark.createDataFrame([(s,) for s in ("b", "ALL", None, "Z", "AAA")], "s string")
    write_ordered(rows, path, totals_last_order("s"), files=2)
    # a missing segment is no total; the label sorts behind every other value
    assert [r.s for r in read_ordered(spark, path).collect()][-1] == "ALL"


@pytest.fixture
def database(spark, path):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_marts_on_one_key_join_without_a_shuffle(spark, tiny, database):
    project = ops.revenue(spark, tiny)
    want = project.fct_revenue.join(project.int_order_financials.select("order_id", "shipped_at"), "order_id").count()
    catalog.save_project(project, spark, database, ["int_order_financials", "fct_revenue"], buckets=5)
    joined = spark.sql(f"SELECT r.order_id, o.refund_count FROM {database}.fct_revenue r JOIN {database}.int_order_financials o USING (order_id)")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
        per_order = spark.table(f"{database}.fct_revenue").groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == want > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Exchange" not in per_order


def test_a_mart_is_replaced_as_a_whole_and_read_by_name(spark, database):
    name = f"{database}.fct"
    catalog.save_table(spark.range(10).withColumn("v", F.lit("old")), name, ["id"], buckets=3)
    catalog.save_table(spark.range(4).withColumn("w", F.lit("new")), name, ["id"], buckets=3)
    assert spark.table(name).columns == ["id", "w"] and spark.table(name).count() == 4
    assert [t.name for t in spark.catalog.listTables(database)] == ["fct"]


def test_a_failed_write_leaves_the_old_table(spark, database):
    name = f"{database}.fct"
    catalog.save_table(spark.range(10), name)
    bad = spark.range(10).select(F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        catalog.save_table(bad, name)
    assert spark.table(name).count() == 10 and [t.name for t in spark.catalog.listTables(database)] == ["fct"]


def test_a_run_that_died_between_the_renames_is_undone(spark, database):
    name = f"{database}.fct"
    catalog.save_table(spark.range(3), name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {catalog.retired(name)}")
    catalog.recover(spark, name)
    assert spark.table(name).count() == 3
    # and after them, before the old one was dropped
    spark.range(9).write.saveAsTable(catalog.retired(name))
    catalog.save_table(spark.range(5), name)
    assert spark.table(name).count() == 5 and not spark.catalog.tableExists(catalog.retired(name))


def test_a_swap_that_fails_puts_the_old_table_back(spark, database):
    name = f"{database}.fct"
    catalog.save_table(spark.range(3), name)
    with pytest.raises(Exception):
        catalog.swap(spark, f"{database}.nothing", name)
    assert spark.table(name).count() == 3


def test_projects_read_their_feeds_from_the_catalog(spark, database):
    for table, df in fx.feeds(spark, "lending", fx.LENDING).items():
        df.write.saveAsTable(f"{database}.raw_{table}")
    project = Lending(raw_tables(spark, "lending", database))
    assert project.fct_loan_performance.count() == 5
    catalog.save_project(project, spark, database, buckets=2)
    assert spark.table(f"{database}.fct_loan_performance").count() == 5
    project.register_views(["fct_portfolio_metrics", "stg_loans"])
    assert spark.sql("SELECT count(*) AS n FROM fct_portfolio_metrics WHERE product_type = 'ALL'").first().n == 1
