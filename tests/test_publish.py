"""Freshness, check summaries and the gated publish."""

import datetime as dt
import re
import uuid

import pytest

from tests import fixtures as fx
from tieout.plans import Lending, Revenue
from tieout.plans.checks import CHECKS, check_outcomes
from pyspark.sql import functions as F

from tieout.files import create_once, names_in, read_text
from tieout.plans import publish as publishing
from tieout.plans.checks import row_checks
from tieout.plans.publish import build, checked, current_run, ledger, make_current, publish, read_published, reasons
from tieout.session import reliable_dir
from tieout.sources import read_raw, source_freshness


@pytest.fixture
def root(spark):
    return f"{reliable_dir(spark)}/{uuid.uuid4().hex}"


def test_catalogue_is_complete():
    counts = {p: {} for p in CHECKS}
    for project, listed in CHECKS.items():
        for check in listed:
            counts[project][check.kind] = counts[project].get(check.kind, 0) + 1
    generic = {p: sum(n for k, n in c.items() if k != "business_rule") for p, c in counts.items()}
    assert generic == {"revenue": 26, "lending": 26, "visits": 24, "workforce": 21}
    per_kind = {k: sum(c.get(k, 0) for c in counts.values()) for k in counts["revenue"]}
    assert per_kind == {
        "unique": 27,
        "not_null": 37,
        "accepted_values": 16,
        "relationships": 10,
        "accepted_range": 7,
        "business_rule": 16 + 3,
    }


def test_outcomes_of_a_clean_book(spark):
    rows = check_outcomes(Lending(fx.feeds(spark, "lending", fx.LENDING))).collect()
    assert len(rows) == 30 and {r.status for r in rows} == {"pass"}


def test_outcomes_find_bad_rows(spark):
    bad = {**fx.LENDING, "loans": [*fx.LENDING["loans"], fx.loan("A", "sold"), fx.loan(None, "active")]}
    bad["defaults"] = [*fx.LENDING["defaults"], fx.flagged("d7", "nobody", "2025-01-01")]
    rows = {r.check_name: r.failures for r in check_outcomes(Lending(fx.feeds(spark, "lending", bad))).collect()}
    assert rows["stg_loans.loan_id.unique"] == 1
    assert rows["stg_loans.loan_id.not_null"] == 1
    assert rows["stg_loans.loan_status.accepted_values"] == 1
    assert rows["stg_loans.application_id.relationships"] == 1
    assert rows["stg_defaults.loan_id.relationships"] == 1


def test_publish_swaps_only_when_clean(spark, root):
    good = publish(Lending(fx.feeds(spark, "lending", fx.LENDING)), spark, root).collect()
    assert {(r.checks_failed, r.published) for r in good} == {(0, True)} and len(good) == 3
    before = read_published(spark, root, "lending", "fct_loan_performance").count()

    worse = {**fx.LENDING, "loans": [*fx.LENDING["loans"], fx.loan("G", "sold")]}
    refused = publish(Lending(fx.feeds(spark, "lending", worse)), spark, root).collect()
    assert {r.published for r in refused} == {False} and refused[0].checks_failed > 0
    assert read_published(spark, root, "lending", "fct_loan_performance").count() == before == 5

    more = {**fx.LENDING, "loans": [*fx.LENDING["loans"], fx.loan("G", "active")]}
    more["applications"] = [*fx.LENDING["applications"], {"application_id": "aG", "decision": "approved"}]
    assert publish(Lending(fx.feeds(spark, "lending", more)), spark, root).first().published
    assert read_published(spark, root, "lending", "fct_loan_performance").count() == 6


def test_nothing_published(spark, root):
    publish(Revenue(fx.feeds(spark, "revenue", fx.REVENUE)), spark, root)  # the bridge does not tie
    publish(Lending(fx.feeds(spark, "lending", fx.LENDING)), spark, root)
    with pytest.raises(LookupError):
        read_published(spark, root, "revenue", "fct_revenue")


def test_stale_feed_blocks(spark, root):
    project = Lending(fx.feeds(spark, "lending", fx.LENDING))
    assert not publish(project, spark, root, now="2025-06-30 00:00:00").first().published


def test_freshness(spark):
    raw = fx.feeds(spark, "revenue", fx.REVENUE)
    rows = source_freshness(raw, "revenue", "2025-01-10 13:00:00").collect()
    status = {r.source_table: (r.status, r.age_hours) for r in rows}
    assert status["orders"] == ("warn", 37.0)
    assert status["payments"] == ("pass", 13.0)
    assert status["refunds"][0] == "no_sla"
    late = {r.source_table: r.status for r in source_freshness(raw, "revenue", "2025-01-11 13:00:00").collect()}
    assert (late["orders"], late["payments"]) == ("error", "warn")
    empty = fx.feeds(spark, "revenue", {})
    none = {r.source_table: r.status for r in source_freshness(empty, "revenue", "2025-01-10 00:00:00").collect()}
    assert none == {"orders": "error", "payments": "error", "refunds": "no_sla", "shipping": "no_sla"}


def test_feeds_can_be_read_from_files(spark, root):
    raw = fx.feeds(spark, "revenue", fx.REVENUE)
    for name, df in raw.items():
        df.write.parquet(f"{root}/raw_{name}")
    project = Revenue(read_raw(spark, "revenue", root))
    assert project.fct_revenue_monthly.first().report_month == dt.date(2025, 1, 1)


def clean(spark):
    return Lending(fx.feeds(spark, "lending", fx.LENDING))


def worse(spark):
    return Lending(fx.feeds(spark, "lending", {**fx.LENDING, "loans": [*fx.LENDING["loans"], fx.loan("G", "sold")]}))


def test_a_refused_run_leaves_its_reasons(spark, root):
    publish(clean(spark), spark, root)
    publish(worse(spark), spark, root)
    rows = ledger(spark, root, "lending")
    assert {(r.outcome, r.n) for r in rows.groupBy("outcome").agg(F.count("*").alias("n")).collect()} == {("published", 30), ("refused", 30)}
    refused = rows.filter("outcome = 'refused'").first().run
    why = {r.check_name: r.failures for r in reasons(spark, root, "lending", refused).collect()}
    assert why["stg_loans.loan_status.accepted_values"] == 1 and why["stg_loans.application_id.relationships"] == 1
    published = rows.filter("outcome = 'published'").first().run
    assert current_run(spark, root, "lending") == published and reasons(spark, root, "lending", published).count() == 0
    with pytest.raises(LookupError):
        ledger(spark, root, "revenue")


def test_a_stale_feed_is_among_the_reasons(spark, root):
    publish(clean(spark), spark, root, now="2025-06-30 00:00:00")
    run = ledger(spark, root, "lending").first().run
    assert {r.check_name for r in reasons(spark, root, "lending", run).collect()} == {"freshness.applications", "freshness.loans"}


def test_of_two_runs_at_once_one_wins(spark, root, monkeypatch):
    assert make_current(spark, root, "lending", "a", 0) and not make_current(spark, root, "lending", "b", 0)
    assert make_current(spark, root, "lending", "c", 1) and current_run(spark, root, "lending") == "c"
    # another run publishes while this one builds
    inner = publishing.build

    def slow(project, *args, **kwargs):
        monkeypatch.setattr(publishing, "build", inner)
        publish(clean(spark), spark, root)
        return inner(project, *args, **kwargs)

    monkeypatch.setattr(publishing, "build", slow)
    late = publish(clean(spark), spark, root).collect()
    assert {(r.checks_failed, r.published) for r in late} == {(0, False)}
    outcomes = [r.outcome for r in ledger(spark, root, "lending").select("run", "outcome").distinct().collect()]
    assert sorted(outcomes) == ["overtaken", "published"]
    assert read_published(spark, root, "lending", "fct_loan_performance").count() == 5


def test_a_marker_is_written_once_and_read_when_whole(spark, root):
    assert create_once(spark, f"{root}/_current/lending/0000000001", "one")
    assert not create_once(spark, f"{root}/_current/lending/0000000001", "two")
    assert read_text(spark, f"{root}/_current/lending/0000000001") == "one"
    assert create_once(spark, f"{root}/_current/lending/0000000002", "")  # its run died
    assert current_run(spark, root, "lending") == "one" and names_in(spark, f"{root}/nothing") == []
    assert publish(clean(spark), spark, root).first().published


def test_old_runs_are_deleted(spark, root):
    for make in (clean, worse, clean, worse, clean):
        publish(make(spark), spark, root, keep=1, keep_refused=1)
    left = names_in(spark, f"{root}/_building/lending")
    runs = {r.run: r.outcome for r in ledger(spark, root, "lending").select("run", "outcome").distinct().collect()}
    assert len(runs) == 5 and sorted(runs[run] for run in left) == ["published", "refused"]
    assert left == [sorted(r for r in runs if runs[r] == "refused")[-1], sorted(runs)[-1]]
    assert len(names_in(spark, f"{root}/_current/lending")) == 1
    assert read_published(spark, root, "lending", "fct_loan_performance").count() == 5


def test_row_checks_are_counted_while_marts_are_written(spark, root):
    project = worse(spark)
    wanted = row_checks(project, "fct_loan_performance")
    assert set(wanted) == {
        "fct_loan_performance.loan_id.not_null", "fct_loan_performance.true_dpd.accepted_range",
        "fct_loan_performance.outstanding_balance_estimate.accepted_range",
    }
    # three rows without a key, one below the least value
    bad = project.fct_loan_performance.withColumn("loan_id", F.when(F.col("loan_id") < "D", F.lit(None)).otherwise(F.col("loan_id")))
    bad = bad.withColumn("true_dpd", F.when(F.col("loan_id") == "E", F.lit(-1)).otherwise(F.col("true_dpd")))
    project.pin("fct_loan_performance", bad)
    scanned = {r.check_name: r.failures for r in check_outcomes(project).collect()}
    counted = build(project, f"{root}/counted", kinds=publishing.ALL_KINDS)
    assert counted["fct_loan_performance.loan_id.not_null"] == 3 and counted["fct_loan_performance.true_dpd.accepted_range"] == 1
    again = check_outcomes(project, counted=counted)
    assert {r.check_name: r.failures for r in again.collect()} == scanned
    # what is left to read of the marts are keys, for the checks of unique values
    read = lambda df: set(re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().executedPlan().toString()))
    left = read(check_outcomes(project, counted=counted))
    assert "true_dpd" in " ".join(read(check_outcomes(project))) and "true_dpd" not in " ".join(left)


@pytest.mark.parametrize("kind", ["unique", "not_null"])
def test_generic_checks_write_no_marts(spark, monkeypatch, kind):
    found = {r.check_name: r.failures for r in check_outcomes(worse(spark), (kind,)).collect()}

    def no_writes(*args, **kwargs):
        raise AssertionError("a mart was written for a check of a few columns")

    monkeypatch.setattr(publishing, "build", no_writes)
    assert {r.check_name: r.failures for r in checked(worse(spark), spark, (kind,)).collect()} == found
    assert len(found) == sum(check.kind == kind for check in CHECKS["lending"])
