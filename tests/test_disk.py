"""What the checks and the gated publish leave on disk, and the steps that keep it small."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tieout.operators import checks, dedup
from tieout.plans import Lending, Revenue, Workforce
from tieout.plans import checks as catalogue
from tieout.plans import publish as publishing
from tieout.plans.checks import check_outcomes
from tieout.plans.publish import build, checked, publish, read_published
from tieout.session import cut_lineage, reliable_dir, scratch_deleted
from tieout.sources.driver_tables import TABLES, feeds


@pytest.fixture
def root(spark):
    return f"{reliable_dir(spark)}/{uuid.uuid4().hex}"


def scratch(spark):
    """The tables and folders written for a while."""
    top = f"{reliable_dir(spark).removeprefix('file:')}/tieout"
    return {d for d in os.listdir(top) if d.startswith(("cut-", "checks-"))} if os.path.isdir(top) else set()


def shuffles(spark):
    """Shuffle files in Spark's own folder."""
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().toIndexedSeq()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def doubled():
    """Two loads of a repayment, one row twice, and an instalment with cash, missed and unknown rows."""
    rows = [
        *fx.LENDING["repayments"],
        fx.posting("x1", "A", 7, "posted", "2025-02-01", 60, "2025-02-03"),
        fx.posting("x2", "A", 7, "Partial", "2025-02-02", 40, "2025-02-03"),
        fx.posting("x3", "A", 7, "missed", "2025-01-15", 0),
        fx.posting("x4", "A", 7, "bounced", "2025-03-15", 9, "2025-02-01"),
        fx.posting("y1", "B", 8, "partial", "2025-02-01", 40, "2025-02-03"),
        fx.posting("y1", "B", 8, "partial", "2025-02-01", 40, "2025-02-03"),
        fx.posting("z1", None, None, "posted", "2025-02-01", 10, "2025-02-03"),
        fx.posting("z2", None, None, "partial", "2025-02-01", None, None),
        fx.posting("u1", "C", 9, None, "2025-02-01", 10, "2025-02-03"),
        fx.posting("v1", "C", 10, "partial", "2025-02-01", None, "2025-02-03"),
        fx.posting("v2", "C", 10, "missed", None, 0),
        fx.posting("w1", "C", 11, "partial", None, None, "2025-02-03", scheduled=None),
    ]
    return {**fx.LENDING, "repayments": rows}


def test_publish_leaves_only_marts(spark, root):
    book = Lending(fx.feeds(spark, "lending", doubled()))
    before, moved = scratch(spark), shuffles(spark)
    publish(book, spark, root).collect()
    assert scratch(spark) - before == set()
    assert shuffles(spark) - moved == set()
    (run,) = os.listdir(f"{root.removeprefix('file:')}/_building/lending")
    assert set(os.listdir(f"{root.removeprefix('file:')}/_building/lending/{run}")) == set(Lending.marts)
    # models that read a deleted table are made anew, marts are read as published
    assert book.int_repayments_deduped.count() == len(doubled()["repayments"])
    assert run in book.fct_loan_performance.inputFiles()[0]


def test_summary_leaves_nothing(spark):
    book = Lending(fx.feeds(spark, "lending", doubled()))
    lazily = {tuple(r) for r in check_outcomes(Lending(fx.feeds(spark, "lending", doubled()))).collect()}
    before, moved = scratch(spark), shuffles(spark)
    out = checked(book, spark)
    # nothing is left to be worked out
    assert scratch(spark) - before == set() and shuffles(spark) - moved == set()
    assert {tuple(r) for r in out.collect()} == lazily and len(lazily) == 30
    assert book.pinned == frozenset() and book.int_loan_delinquency.count() > 0


def test_a_failed_run_leaves_no_scratch(spark, root, monkeypatch):
    def fails(*args, **kwargs):
        raise RuntimeError("no checks")

    monkeypatch.setattr(publishing, "outcome_rows", fails)
    for run in (lambda b: checked(b, spark), lambda b: publish(b, spark, root)):
        before, book = scratch(spark), Lending(fx.feeds(spark, "lending", doubled()))
        with pytest.raises(RuntimeError):
            run(book)
        assert scratch(spark) - before == set()
        assert book.int_repayments_deduped.count() == len(doubled()["repayments"])


def test_scopes_delete_their_own_tables(spark):
    with scratch_deleted(spark):
        outer = cut_lineage(spark.range(3))
        with scratch_deleted(spark):
            inner = cut_lineage(spark.range(4))
        assert outer.count() == 3
        gone = inner.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
        assert not os.path.exists(gone)
    kept = cut_lineage(spark.range(5))
    assert kept.count() == 5
    dedup.forget(kept)


def test_instalments_of_written_postings(spark, root):
    plain = Lending(fx.feeds(spark, "lending", doubled()))
    book = Lending(fx.feeds(spark, "lending", doubled()))
    build(book, root, ["counted_postings"])
    assert sorted(map(str, book.instalments.select(plain.instalments.columns).collect())) == sorted(
        map(str, plain.instalments.collect())
    )
    rows = lambda b: sorted(map(str, b.int_loan_delinquency.collect()))
    assert rows(book) == rows(plain)
    # postings are not elected again
    plan = lambda b: b.instalments._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" in plan(plain) and "min_by" not in plan(book)


@pytest.mark.parametrize("repeats", [0, 3])
def test_unique_by_hashes_first(spark, monkeypatch, repeats):
    ids = [f"id{i}" for i in range(200)] + [None, None] + [f"id{i}" for i in range(repeats)] * 2
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    found = {tuple(r) for r in checks.unique(df, "id", hashes_first=True).collect()}
    assert found == {tuple(r) for r in checks.unique(df, "id").collect()} == {(f"id{i}", 3) for i in range(repeats)}
    # a hash that two values share is no repeat
    monkeypatch.setattr(checks, "among_repeated", lambda rows, keys: rows)
    assert {tuple(r) for r in checks.unique(df, "id", hashes_first=True).collect()} == found


def test_large_feeds_are_hashed_first_when_checked(spark, monkeypatch):
    asked = []
    real = checks.unique

    def unique(df, column, hashes_first=False):
        asked.append(hashes_first)
        return real(df, column, hashes_first)

    monkeypatch.setattr(catalogue.generic, "unique", unique)
    monkeypatch.setattr(catalogue, "LARGE", -1)
    book = Lending(fx.feeds(spark, "lending", doubled()))
    rows = {r.check_name: r.failures for r in catalogue.outcome_rows(book, {})}
    assert asked and all(asked) and rows["stg_repayments.repayment_id.unique"] == 1


def driver_tables(spark, folder):
    day = dt.datetime(1997, 1, 1)
    orders = [(1, 11, "O", 100.0, day, "1-URGENT"), (2, 14, "F", 250.55, day, None), (None, 3, "P", 1.0, day, None)]
    orders.append((2, 15, "F", 9.0, day, None))  # a key that occurs twice
    lines = [
        (1, 6, 5, 1, 1.0, 10.01, 0.0, 0.0, "R", "F", day),
        (1, 7, 5, 2, 1.0, None, 0.0, 0.0, "A", "O", None),
        (2, None, 10, 1, 4.0, 33.33, 0.0, 0.0, None, "F", day),
        (9, 1, 1, 1, 1.0, 5.0, 0.0, 0.0, "N", "O", day),  # no such order
        (None, 1, 1, 1, 1.0, 5.0, 0.0, 0.0, "N", "O", day),
    ]
    spark.createDataFrame(orders, TABLES["orders"]).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, TABLES["lineitem"]).write.parquet(f"{folder}/lineitem.parquet")


def test_lines_meet_their_orders_once(spark, root):
    driver_tables(spark, root)
    raw, before = feeds(spark, root, "revenue"), scratch(spark)
    rows = lambda name: sorted(map(str, raw[name].collect()))
    plan = lambda name: raw[name]._jdf.queryExecution().optimizedPlan().toString()
    joined = {name: rows(name) for name in raw}
    assert len(joined["payments"]) == 4 and "Join" in plan("payments") and "Join" in plan("refunds")
    with raw.kept():
        assert {name: rows(name) for name in raw} == joined
        assert "Join" not in plan("payments") and "Join" not in plan("refunds")
    assert scratch(spark) - before == set() and rows("refunds") == joined["refunds"]
    with feeds(spark, root, "lending").kept():
        assert scratch(spark) - before == set()


def test_published_marts_are_whole(spark, root):
    publish(Lending(fx.feeds(spark, "lending", fx.LENDING)), spark, root)
    plain = Lending(fx.feeds(spark, "lending", fx.LENDING))
    for mart in Lending.marts:
        found = read_published(spark, root, "lending", mart).select(*plain.model(mart).columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.model(mart).collect()))
        assert found.filter(F.lit(True)).count() > 0


def over_refunded():
    """Refunds of no payment, of a payment that comes twice, and beyond their payment."""
    more = [
        fx.refund(2, 1, "p1", 60, "2025-02-03"),
        fx.refund(3, 1, "p1", 60, "2025-02-04"),
        fx.refund(4, 2, "nobody", 5, "2025-02-03"),
        fx.refund(5, 2, "nobody", None, "2025-02-03"),
        fx.refund(6, 2, None, 500, "2025-02-03"),
        fx.refund(7, 3, "p3", 99, "2025-02-03"),
        fx.refund(8, 5, "free", 1, "2025-02-03"),
    ]
    payments = [*fx.REVENUE["payments"], fx.payment("p3", 3, 60), fx.payment("free", 5, None), fx.payment(None, 5, 1)]
    return {**fx.REVENUE, "refunds": [*fx.REVENUE["refunds"], *more], "payments": payments}


def test_refunds_meet_their_payments_once(spark, root, monkeypatch):
    plain = Revenue(fx.feeds(spark, "revenue", over_refunded()))
    book = Revenue(fx.feeds(spark, "revenue", over_refunded()))
    build(book, root, ["refund_faults"])
    rows = lambda b: sorted(map(str, b.no_over_refunding.collect()))
    assert rows(book) == rows(plain) and len(rows(plain)) == 3
    check = next(c for c in catalogue.CHECKS["revenue"] if c.name == "stg_refunds.payment_id.relationships")
    unknown = lambda b: [tuple(r) for r in catalogue.violations(b, check).collect()]
    assert unknown(book) == unknown(plain) == [("nobody", 2)]
    for relation, column in (("stg_refunds", "order_id"), ("stg_payments", "order_id")):
        assert book.unknown_references(relation, column) is None
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan(book.no_over_refunding) and "Join" not in plan(catalogue.violations(book, check))
    assert "refund_faults" in publishing.SHARED["revenue"]


def test_records_are_grouped_into_episodes_once(spark, root):
    record = fx.WORKFORCE["employees"][0]
    twice = {**fx.WORKFORCE, "employees": [*fx.WORKFORCE["employees"], {**record, "employee_id": "zz"}, {**record, "employee_id": None}]}
    plain, book = (Workforce(fx.feeds(spark, "workforce", twice)) for _ in range(2))
    build(book, root, ["episodes"])
    for name in ("live_ids", "int_employment_records_resolved", "fct_attrition_tenure_reconciliation_bridge"):
        made = book.model(name).select(*plain.model(name).columns)
        assert sorted(map(str, made.collect())) == sorted(map(str, plain.model(name).collect()))
    assert book.live_ids.columns == plain.live_ids.columns
    assert "Aggregate" not in book.live_ids._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("copies", [False, True])
def test_ranks_are_counted_only_where_rows_may_share_one(spark, monkeypatch, copies):
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", None, "z"), (None, 2, "n"), (None, 1, "m"), ("b", 1, "o"), ("c", 3, "p")]
    rows += [("a", 1, "x"), ("c", 3, "p")] if copies else []
    df = spark.createDataFrame(rows, "k string, at int, id string")
    counted = []
    real = dedup.hashes_again
    monkeypatch.setattr(dedup, "hashes_again", lambda d, keys: counted.append(list(keys)) or real(d, keys))
    out = dedup.flag_duplicates(df, ["k"], ["at"], "id", "lost", hashes_first=True)
    assert counted == [["k"], ["k", "_rank"]]
    plain = dedup.flag_duplicates(df, ["k"], ["at"], "id", "lost", hashes_first=False)
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    assert out.filter("lost").count() == (5 if copies else 3)
