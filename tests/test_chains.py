"""Chains, loops and places against a walk row by row."""

import random

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tieout.operators import links, resolve_chains
from tieout.plans import Visits
from tieout.plans import operator_queries as ops

SCHEMA = "id string, next_id string, is_root boolean"


def brute(rows):
    """(ways by root, loops, ways of unrooted first rows) of (id, next_id, is_root)."""
    onward = {i: n for i, n, _ in rows}

    def way(i):
        path = [i]
        while onward[path[-1]] is not None and onward[path[-1]] not in path:
            path.append(onward[path[-1]])
        return path

    ways = {i: way(i) for i, _, root in rows if root}
    loops = {}
    for i in onward:
        path = way(i)
        if onward[path[-1]] == i:
            least = path.index(min(path))
            for at, j in enumerate(path):
                loops[j] = (min(path), (at - least) % len(path), len(path))
    met = set(onward.values())
    unrooted = {i: way(i) for i, _, root in rows if not root and i not in met}
    return ways, loops, unrooted


def spots(ways):
    return {(root, i, at + 1) for root, path in ways.items() for at, i in enumerate(path)}


def compare(spark, rows):
    chains = resolve_chains(spark.createDataFrame(rows, SCHEMA).repartition(3), "id", "next_id", "is_root")
    ways, loops, unrooted = brute(rows)
    onward = {i: n for i, n, _ in rows}
    assert {(r.root, r["last"], r.hops) for r in chains.terminal.collect()} == {(k, p[-1], len(p) - 1) for k, p in ways.items()}
    assert {r.root for r in chains.looped.collect()} == {k for k, p in ways.items() if onward[p[-1]] is not None}
    members = [tuple(r) for r in chains.members.collect()]
    assert len(members) == len(set(members)) and set(members) == spots(ways)
    assert {r.id: (r.loop, r.place, r.size) for r in chains.loops.collect()} == loops
    assert {tuple(r) for r in chains.unrooted.collect()} == spots(unrooted)


def linked(n, seed, loops):
    """Rows whose links lead to later rows only, or anywhere; some rows share a target."""
    rng = random.Random(seed)
    ids = [f"r{i:03d}" for i in range(n)]
    rng.shuffle(ids)
    rows = []
    for at, i in enumerate(ids):
        to = rng.choice(ids) if loops else rng.choice(ids[at + 1 :] or [None])
        to = to if rng.random() < 0.8 else None
        rows.append((i, to, rng.random() < 0.4))
    return rows


@pytest.mark.parametrize("seed, loops", [(1, False), (2, True), (3, True)])
def test_chains_equal_a_walk(spark, seed, loops):
    compare(spark, linked(60, seed, loops))


def test_long_chains_rings_and_rows_that_lead_to_themselves(spark):
    rows = [(f"a{i:03d}", f"a{i + 1:03d}" if i < 69 else None, i == 0) for i in range(70)]  # one path
    rows += [(f"b{i:02d}", f"b{(i + 1) % 13:02d}", i == 5) for i in range(13)]  # a ring with a root on it
    rows += [(f"c{i}", f"c{i + 1}" if i < 4 else "b03", i == 0) for i in range(5)]  # a tail into the ring
    rows += [("d", "d", True), ("e", "d", True), ("f", None, True), ("g", None, False)]
    rows += [(f"h{i}", "a030", True) for i in range(6)]  # many roots into one tail
    compare(spark, rows)


def test_rows_without_links(spark):
    compare(spark, [("a", None, True), ("b", None, False)])
    empty = resolve_chains(spark.createDataFrame([], SCHEMA), "id", "next_id", "is_root")
    assert empty.terminal.count() == empty.members.count() == empty.loops.count() == empty.unrooted.count() == 0


def test_state_is_one_row_per_link_where_roots_share_a_tail(spark, monkeypatch):
    written = []

    def counting(write):
        def wrapped(df, *args, **counts):
            out = write(df, *args, **counts)
            written.append((out[0] if isinstance(out, tuple) else out).count())
            return out

        return wrapped

    for name in ("cut_lineage", "counted_write"):
        monkeypatch.setattr(links, name, counting(getattr(links, name)))
    roots, tail = 10_000, 50
    heads = spark.range(roots).select(F.concat(F.lit("r"), "id").alias("id"), F.lit("t0").alias("next_id"), F.lit(True).alias("is_root"))
    rest = [(f"t{i}", f"t{i + 1}" if i < tail - 1 else None, False) for i in range(tail)]
    nodes = heads.union(spark.createDataFrame(rest, SCHEMA))
    walked = resolve_chains(nodes, "id", "next_id", "is_root").walked
    ends = walked.agg(F.min("hops"), F.max("hops"), F.min("last"), F.max("last"), F.count("*")).first()
    assert tuple(ends) == (tail, tail, f"t{tail - 1}", f"t{tail - 1}", roots)
    assert max(written) <= roots + tail and sum(written) <= 8 * (roots + tail)


def test_marts_do_not_touch_membership(spark, monkeypatch):
    monkeypatch.setattr(links.Chains, "_members", lambda self, roots: pytest.fail("membership was worked out"))
    project = Visits(fx.feeds(spark, "visits", fx.VISITS))
    for mart in project.marts:
        project.model(mart).count()


def test_every_surviving_row_has_a_place(spark):
    for project in (Visits(fx.feeds(spark, "visits", fx.VISITS)), ops.visits(spark, "/root/testdata/sf0.01")):
        assert project.rows_without_place.count() == 0


HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    # several map tasks, also for tables this small: a partition is split by the tasks that wrote it
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.openCostInBytes": "1",
}


def test_visits_that_end_on_one_row_can_be_split(spark):
    """Twenty thousand visits moved into one row: the lookup of last rows is split by AQE."""
    columns = dict(f.simpleString().split(":", 1) for f in ops.visits(spark, "/root/testdata/sf0.001").raw["appointments"].schema)
    n = 20_000
    at = F.expr("timestamp_ntz'2024-01-01 08:00:00' + make_interval(0, 0, 0, 0, 0, CAST(id AS INT))")
    own = {
        "appointment_id": F.sha1(F.col("id").cast("string")), "patient_id": F.col("id").cast("string"), "doctor_id": F.lit("d"),
        "location": F.lit("x"), "appointment_type": F.lit("t"), "status": F.lit("rescheduled"), "scheduled_for": at, "booked_at": at,
        "rescheduled_to_id": F.when(F.col("id") > 0, F.sha1(F.lit("0"))),
    }
    rows = spark.range(n).select(*[own.get(c, F.lit(None)).cast(t).alias(c) for c, t in columns.items()])
    raw = {**fx.feeds(spark, "visits", {}), "appointments": rows}
    before = {k: spark.conf.get(k, None) for k in HOT}
    for k, v in HOT.items():
        spark.conf.set(k, v)
    try:
        mart = Visits(raw).fct_appointments
        assert mart.filter("reschedule_count = 1").count() == n - 1
        mart.collect()
        plan = mart._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
