"""Readers of the sixteen raw tables: by path and by name, with other types, and with columns missing."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tieout.plans import Lending, Revenue, Visits, Workforce
from tieout.session import scratch_path
from tieout.sources import RAW_COLUMNS, MissingColumns, checked_feed, raw_schema, raw_tables, read_raw

ROWS = {"revenue": fx.REVENUE, "lending": fx.LENDING, "visits": fx.VISITS, "workforce": fx.WORKFORCE}
MARTS = {
    "revenue": (Revenue, "fct_revenue_monthly"),
    "lending": (Lending, "fct_par_reconciliation_bridge"),
    "visits": (Visits, "fct_noshow_reconciliation_bridge"),
    "workforce": (Workforce, "fct_department_workforce"),
}


@pytest.fixture
def folder(spark):
    return scratch_path(spark, "test-raw")


@pytest.fixture
def database(spark, folder):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/tables'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("project", RAW_COLUMNS)
def test_a_project_reads_its_feeds_by_path_and_by_name(spark, folder, database, project):
    plain = fx.feeds(spark, project, ROWS[project])
    for table, df in plain.items():
        df.withColumn("loaded_by", F.lit("x")).write.parquet(f"{folder}/raw_{table}")  # columns nobody declared
        df.write.saveAsTable(f"{database}.raw_{table}")
    make, mart = MARTS[project]
    want = rows_of(make(plain).model(mart))
    assert want
    for feeds in (read_raw(spark, project, folder), raw_tables(spark, project, database)):
        assert {t: df.schema.simpleString() for t, df in feeds.items()} == {t: raw_schema(project, t).simpleString() for t in plain}
        assert feeds.rejected == {} and all(rows_of(feeds[t]) == rows_of(plain[t]) for t in plain)
        assert rows_of(make(feeds).model(mart)) == want


@pytest.mark.parametrize("project", RAW_COLUMNS)
def test_a_project_reads_feeds_of_text(spark, folder, project):
    plain = fx.feeds(spark, project, ROWS[project])
    for table, df in plain.items():
        df.select(*[F.col(c).cast("string") for c in df.columns]).write.option("header", "true").csv(
            f"{folder}/raw_{table}", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    feeds = read_raw(spark, project, folder, "csv")
    make, mart = MARTS[project]
    assert rows_of(make(feeds).model(mart)) == rows_of(make(plain).model(mart))
    assert feeds.write_rejected(f"{folder}/side") == {}


@pytest.mark.parametrize("project", RAW_COLUMNS)
def test_missing_columns_stop_the_read_and_are_all_named(spark, folder, database, project):
    tables = list(RAW_COLUMNS[project])
    for i, (table, df) in enumerate(fx.feeds(spark, project, ROWS[project]).items()):
        df = df.drop(df.columns[0], df.columns[2]) if i < 2 else df
        df.write.parquet(f"{folder}/raw_{table}")
        df.write.saveAsTable(f"{database}.raw_{table}")
    for read in (lambda: read_raw(spark, project, folder), lambda: raw_tables(spark, project, database)):
        with pytest.raises(MissingColumns) as lacking:
            read()
        for table in tables[:2]:
            names = raw_schema(project, table).names
            assert f"{project}.raw_{table} lacks {names[0]}, {names[2]}" in str(lacking.value)
        assert f"raw_{tables[2]}" not in str(lacking.value)


def test_rows_that_do_not_parse_are_kept_aside(spark, folder):
    feeds = fx.feeds(spark, "revenue", fx.REVENUE)
    orders = feeds["orders"].withColumns({"order_amount": F.col("order_amount").cast("string"), "order_id": F.col("order_id").cast("int")})
    broken = F.when(F.col("order_id") == 3, F.lit("sixty")).when(F.col("order_id") == 6, F.lit(None)).otherwise(F.col("order_amount"))
    feeds["orders"] = orders.withColumn("order_amount", broken)
    for table, df in feeds.items():
        df.write.parquet(f"{folder}/raw_{table}")
    read = read_raw(spark, "revenue", folder)
    assert set(read.rejected) == {"orders"}
    assert read["orders"].schema == raw_schema("revenue", "orders")
    assert sorted(r.order_id for r in read["orders"].collect()) == ["1", "2", "4", "5", "6"]  # a missing amount is no bad one
    lost = read.rejected["orders"].collect()
    assert len(lost) == 1 and lost[0].unparsed == ["order_amount"]
    assert json.loads(lost[0].row)["order_amount"] == "sixty" and json.loads(lost[0].row)["order_id"] == 3
    assert read.write_rejected(f"{folder}/side") == {"orders": 1}
    assert spark.read.parquet(f"{folder}/side/rejected_orders").count() == 1


def test_every_row_of_a_feed_is_accepted_or_rejected(spark):
    rows = [(str(i), "2025-01-01" if i % 3 else "soon", "x" if i % 5 == 0 else "1.50") for i in range(60)]
    have = spark.createDataFrame(rows, "refund_id string, processed_at string, refund_amount string")
    declared = raw_schema("revenue", "refunds")
    for f in declared:
        if f.name not in have.columns:
            have = have.withColumn(f.name, F.lit(None).cast(f.dataType))
    good, lost = checked_feed(have, "revenue", "refunds")
    assert good.count() + lost.count() == 60 and good.schema == declared
    assert {r.refund_id for r in good.collect()} == {i for i, day, amount in rows if day != "soon" and amount != "x"}
    both = [r for r in lost.collect() if len(r.unparsed) == 2]
    assert {json.loads(r.row)["refund_id"] for r in both} == {str(i) for i in range(0, 60, 15)}
