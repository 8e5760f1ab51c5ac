"""Operators against brute force, including hot keys."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tieout.functions import ratio, years_of
from tieout.operators import (
    distinct_counts,
    first_per_key,
    flag_duplicates,
    flag_orphans,
    latest_record_per_key,
    link_hits,
    lookup,
    rows_where,
    segment_rollup,
    total_of,
    totals_last,
    winning_ids,
)
from tieout.operators import checks, dedup
from tieout.plans.operator_queries import workforce


def skewed(n=4000, seed=7):
    """A third of the rows share one key; some keys and times are missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice([None, *[f"k{j}" for j in range(n // 8)]])
        at = rng.choice([None, *range(50)])
        rows.append((f"id{i:05d}", key, at, rng.choice(["ok", "bad", None]), rng.randint(0, 20)))
    return rows


@pytest.fixture(scope="module")
def rows():
    return skewed()


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id string, k string, at int, status string, v int").repartition(7).cache()


def first_ids(rows, subset=lambda r: True):
    best = {}
    for r in rows:
        if subset(r):
            rank = (r[2] is None, r[2] or 0, r[0])
            best[r[1]] = min(best.get(r[1], (rank, r[0])), (rank, r[0]))
    return {winner for _, winner in best.values()}


def test_flag_duplicates_equals_brute_force(df, rows):
    got = {r.id: r.dup for r in flag_duplicates(df, ["k"], ["at"], "id", "dup").collect()}
    winners = first_ids(rows)
    assert got == {r[0]: r[0] not in winners for r in rows}


def test_flag_duplicates_in_a_subset(df, rows):
    ok = F.col("status") == "ok"
    got = {r.id: r.dup for r in flag_duplicates(df, ["k"], ["at"], "id", "dup", subset=ok).collect()}
    winners = first_ids(rows, lambda r: r[3] == "ok")
    assert got == {r[0]: r[3] == "ok" and r[0] not in winners for r in rows}


def test_copies_with_one_id_are_flagged_but_one(spark):
    rows = [("p1", "o1", 1)] * 4 + [("p2", "o1", 2), ("p3", "o2", 1), ("p3", "o2", 3), ("p4", None, 1), ("p4", None, 1)]
    rows += [("p5", "o3", 1), ("p6", "o4", None), ("p6", "o4", None)]
    df = spark.createDataFrame(rows, "id string, k string, v int").repartition(3)
    got = sorted((r.id, r.v or 0, r.dup) for r in flag_duplicates(df, ["k"], [], "id", "dup").collect())
    want = [("p1", 1, False)] + [("p1", 1, True)] * 3 + [("p2", 2, True), ("p3", 1, False), ("p3", 3, True)]
    want += [("p4", 1, False), ("p4", 1, True), ("p5", 1, False), ("p6", 0, False), ("p6", 0, True)]
    assert got == want


def test_copies_outside_the_subset_stay(spark):
    rows = [("a", "k", 1, "ok"), ("a", "k", 1, "ok"), ("a", "k", 1, "bad"), ("a", "k", 1, None)]
    df = spark.createDataFrame(rows, "id string, k string, v int, status string")
    got = flag_duplicates(df, ["k"], ["v"], "id", "dup", subset=F.col("status") == "ok").collect()
    assert sorted((r.status or "", r.dup) for r in got) == [("", False), ("bad", False), ("ok", False), ("ok", True)]


def test_a_written_out_stretch_is_whole(spark, monkeypatch):
    monkeypatch.setattr(dedup, "STRETCH", 7)
    df = spark.createDataFrame([("a", "k")] * 50 + [("b", "k")] * 3, "id string, k string")
    got = flag_duplicates(df, ["k"], [], "id", "dup").groupBy("id", "dup").count().collect()
    assert {(r.id, r.dup): r["count"] for r in got} == {("a", False): 1, ("a", True): 49, ("b", True): 3}


def test_no_window_gathers_a_key(df, monkeypatch):
    plans = []
    write = dedup.counted_write
    monkeypatch.setattr(dedup, "counted_write", lambda f, **n: plans.append(f._jdf.queryExecution().toString()) or write(f, **n))
    plans.append(flag_duplicates(df, ["k"], ["at"], "id", "dup", hashes_first=True)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 3 and not any("Window" in p.replace("Windows", "") for p in plans)
    assert "partial_count" in plans[0] and "partial_min" in plans[1]


@pytest.mark.parametrize("bits", [64, 1 << 24])
@pytest.mark.parametrize("split", [0, 1_000_000])
@pytest.mark.parametrize("hashes", [True, False])
def test_flags_are_the_same_at_any_filter_size(df, rows, bits, split, hashes):
    ok = F.col("status") == "ok"
    winners, some = first_ids(rows), first_ids(rows, lambda r: r[3] == "ok")
    got = flag_duplicates(df, ["k"], ["at"], "id", "dup", filter_bits=bits, split_above=split, hashes_first=hashes).collect()
    assert {r.id: r.dup for r in got} == {r[0]: r[0] not in winners for r in rows} and len(got) == len(rows)
    got = flag_duplicates(df, ["k"], ["at"], "id", "dup", subset=ok, filter_bits=bits, split_above=split, hashes_first=hashes).collect()
    assert {r.id: r.dup for r in got} == {r[0]: r[3] == "ok" and r[0] not in some for r in rows} and len(got) == len(rows)


def test_a_feed_without_repeats_is_not_shuffled(spark):
    wide = spark.range(0, 50_000, 1, 8).select(F.sha1(F.col("id").cast("string")).alias("id"), F.repeat(F.lit("x"), 200).alias("v"))
    assert dedup.repeated_hashes(wide, ["id"]) is None
    out = flag_duplicates(wide, ["id"], [], "id", "dup", hashes_first=True)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.filter("dup").count() == 0 and out.count() == 50_000


def test_rows_that_the_filter_stops_are_not_shuffled(spark):
    """Only rows of repeated keys, and a few by chance, are in the join beyond the split."""
    rows = spark.range(0, 40_000, 1, 8).select(
        F.col("id").cast("string").alias("id"), F.when(F.col("id") < 100, F.lit("same")).otherwise(F.col("id").cast("string")).alias("k")
    )
    again = dedup.repeated_hashes(rows, ["k"])
    assert again.count() == 1
    sieve = dedup.key_filter(again, 1 << 20)
    assert sieve.count() == 1 and 100 <= dedup.passing(rows, ["k"], sieve, 1 << 20).count() <= 102
    out = flag_duplicates(rows, ["k"], [], "id", "dup", filter_bits=1 << 20, split_above=0)
    assert out.filter("dup").count() == 99 and out.count() == 40_000


def test_a_feed_of_some_size_shuffles_only_rows_that_the_filter_lets_through(spark, monkeypatch):
    """From 32 MB on hashes are counted first, and few repeated keys are no reason to shuffle every row."""
    rows = spark.range(0, 40_000, 1, 8).select(
        F.col("id").cast("string").alias("id"), F.when(F.col("id") < 100, F.lit("same")).otherwise(F.col("id").cast("string")).alias("k")
    )
    monkeypatch.setattr(dedup, "estimated_bytes", lambda df: 1 << 26)
    out = flag_duplicates(rows, ["k"], [], "id", "dup")
    assert "Union" in out._jdf.queryExecution().executedPlan().toString()
    assert out.filter("dup").count() == 99 and out.count() == 40_000


def test_the_filter_grows_with_the_keys_between_two_sizes():
    assert [dedup.bits_for(n) for n in (1, 1 << 20, 1 << 23, 1 << 40)] == [1 << 24, 1 << 24, 1 << 26, 1 << 27]


def test_first_per_key(df, rows):
    got = first_per_key(df, ["k"], ["at"], "id", sums={"n": F.count(F.lit(1))}).collect()
    assert {r.id for r in got} == first_ids(rows)
    assert sum(r.n for r in got) == len(rows)
    by_id = {r[0]: r for r in rows}
    assert all((r.k, r.at, r.status, r.v) == by_id[r.id][1:] for r in got)


def test_latest_record_puts_missing_times_first(df, rows):
    best = {}
    for r in rows:
        best[r[1]] = max(best.get(r[1], ((False, -1, ""), None)), ((r[2] is None, r[2] or 0, r[0]), r[0]))
    got = {r.k: r.id for r in latest_record_per_key(df, ["k"], "at", "id").collect()}
    assert got == {k: winner for k, (_, winner) in best.items()}


def test_distinct_counts(df, rows):
    out = distinct_counts(df, ["k"], "v", {"all_v": None, "ok_v": F.col("status") == "ok"}).collect()
    for r in out:
        mine = [x for x in rows if x[1] == r.k]
        assert r.all_v == len({x[4] for x in mine})
        assert r.ok_v == len({x[4] for x in mine if x[3] == "ok"})


def test_lookup_keeps_every_row_and_spreads_missing_links(spark, df, rows):
    parent = spark.createDataFrame([("hot", 1), ("k1", 2)], "pk string, x int")
    got = lookup(df, parent, "k", "pk", "id", {"x": "x"})
    want = {r[0]: {"hot": 1, "k1": 2}.get(r[1]) for r in rows}
    assert {r.id: r.x for r in got.collect()} == want
    assert got.columns == [*df.columns, "x"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lookup(df, parent, "k", "pk", "id", {"x": "x"})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB")
    assert re.search(r"hashpartitioning\(k#\d+, _slot", plan)  # rows without a link are spread by their id


def test_payroll_rows_are_not_moved_for_orphans_twice(spark, tiny):
    """One join of the rows on their own id, whatever the two branches of the duplicate flag do."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = workforce(spark, tiny).int_payroll_deduped
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB")
    wide = [line for line in plan.splitlines() if "SortMergeJoin [payroll_id" in line]
    assert len(wide) == 1 and "Window" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(payroll_id", plan)) == 2


def test_flag_orphans(spark, df, rows):
    live = spark.createDataFrame([("hot",)], "pk string")
    got = flag_orphans(df, live, "k", "pk", "id", "orphan")
    assert {r.id: r.orphan for r in got.collect()} == {r[0]: r[1] != "hot" for r in rows}


def test_rollup_totals_and_null_segment(df, rows):
    out = totals_last(
        segment_rollup(df, "status", {"n": rows_where(), "big": rows_where(F.col("v") > 10), "v": total_of("v")}), "status"
    ).collect()
    assert out[-1].status == "ALL" and {r.status for r in out} == {"ok", "bad", None, "ALL"}
    assert out[-1].n == len(rows) and out[-1].v == sum(r[4] for r in rows)
    assert sum(r.big for r in out[:-1]) == out[-1].big


def test_rollup_reads_its_base_once(spark, tiny):
    base = spark.read.parquet(f"{tiny}/orders.parquet")
    out = segment_rollup(base, "o_orderpriority", {"n": rows_where(), "s": total_of("o_orderkey")})
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan and "Expand" not in plan


def test_ratio_and_years(spark):
    row = spark.range(1).select(
        ratio(F.lit(1), F.lit(0)).alias("none"), ratio(F.lit(1), F.lit(4)).alias("r"), years_of(F.lit(731)).alias("y")
    ).first()
    assert (row.none, row.r, str(row.y)) == (None, 0.25, "2.00")


def test_checks_return_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z"), (3, None)], "n int, s string")
    parent = spark.createDataFrame([(1,)], "p int")
    assert [tuple(r) for r in checks.unique(df, "n").collect()] == [(1, 2)]
    assert [r.s for r in checks.not_null(df, "n").collect()] == ["z"]
    assert [r.s for r in checks.accepted_values(df, "s", ["a", "b"]).collect()] == ["z"]
    assert [tuple(r) for r in checks.relationships(df, "n", parent, "p").collect()] == [(3, 1)]
    assert checks.accepted_range(df, "n", 1).count() == 0
    assert checks.accepted_range(df, "n", 1, inclusive=False).count() == 2


HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.mark.parametrize("operator", ["link_hits", "flag_orphans", "lookup", "flag_duplicates"])
def test_hot_links_can_be_split(spark, operator):
    """A third of the links point at one row: AQE must be able to split that join."""
    before = {k: spark.conf.get(k, None) for k in HOT}
    for k, v in HOT.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60000, 1, 8).select(
            F.sha1(F.col("id").cast("string")).alias("id"),
            F.col("id").cast("string").alias("slot"),
            F.when(F.col("id") % 3 == 0, "7").otherwise(F.col("id").cast("string")).alias("link"),
        )
        live = winning_ids(rows.select(F.col("slot").alias("pk"), F.pmod(F.hash("slot"), F.lit(30000)).alias("k")), ["k"], [], "pk")
        if operator == "link_hits":
            out = link_hits(rows, "id", ["link"], live, "pk")
        elif operator == "flag_orphans":
            out = flag_orphans(rows, live, "link", "pk", "id", "orphan")
        elif operator == "flag_duplicates":
            out = flag_duplicates(rows, ["link"], [], "id", "dup")
        else:
            out = lookup(rows, live.withColumn("x", F.lit(1)), "link", "pk", "id", {"x": "x"})
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
