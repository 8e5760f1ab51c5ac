"""Choosing one row per key without gathering a key's rows in one task.

A window over the key would sort every copy of a hot key in a single task. Both
operators here elect the winner with an ordinary aggregate instead, which Spark
combines on the map side: a key with billions of copies reaches its reducer as
one candidate per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import nulls_last
from ..session import counted_write, cut_lineage, forget, shuffles_deleted

OrderBy = Sequence[Column | str]

#: Copies of one row that a task writes out at a time.
STRETCH = 1 << 16
#: Least bits of the filter of repeated keys: two million bytes, less than a broadcast's default limit.
FILTER_BITS = 1 << 24
#: Most bits of that filter, whatever the input: 16 million bytes.
MOST_FILTER_BITS = 1 << 27
#: Bits for each repeated key, between these two.
BITS_PER_KEY = 8
#: Repeated keys above which rows that the filter stops are kept out of the join's shuffle.
SPLIT_ABOVE = 1_000_000
#: Bytes above which a pass over hashes pays for itself: 8 bytes a row are less than keys, order and id.
LARGE = 1 << 25


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: OrderBy, row_id: str, sums: dict[str, Column] | None = None
) -> DataFrame:
    """The first row of each key by ``order`` then ``row_id`` (nulls last).

    ``sums`` adds further aggregates over the whole group, so that "the winner,
    and how much the losers carried" costs one shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    winner = F.min_by(F.struct(*rest), nulls_last(*order, row_id)).alias("winner")
    extra = [agg.alias(name) for name, agg in (sums or {}).items()]
    won = df.groupBy(*keys).agg(winner, *extra)
    picked = [F.col(c) if c in keys else F.col(f"winner.{c}").alias(c) for c in df.columns]
    return won.select(*picked, *(sums or {}))


def winning_ids(
    df: DataFrame, keys: Sequence[str], order: OrderBy, row_id: str, subset: Column | None = None
) -> DataFrame:
    """Ids of the rows that come first within their key.

    Left as they come: a distinct here would sit between the shuffle and a later
    join on the id, and AQE splits a hot partition only of a bare shuffle.
    """
    candidates = df if subset is None else df.filter(subset)
    best = candidates.groupBy(*keys).agg(F.min(nulls_last(*order, row_id)).alias("best"))
    return best.select(F.col(f"best.v{len(order)}").alias(row_id))


def flag_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    order: OrderBy,
    row_id: str,
    flag: str,
    subset: Column | None = None,
    filter_bits: int | None = None,
    split_above: int = SPLIT_ABOVE,
    hashes_first: bool | None = None,
) -> DataFrame:
    """Add ``flag``: true on every row of a key but its first. No row is dropped.

    Exactly rows - 1 are flagged per key, also where a feed was loaded twice and
    rows share an id or are alike in every column. Null key values form one
    group, as in a window. Rows outside ``subset`` are neither ranked nor flagged.

    What a key's first row is, is elected on narrow columns, written once for the keys
    that repeat, and joined to the rows: as it is up to ``split_above`` keys, beyond
    that only to rows that a broadcast filter of ``filter_bits`` bits lets through -
    repeated keys, and by chance a few others - so the rest is never shuffled. The
    filter grows with the number of repeated keys between two fixed sizes.

    Large feeds (``hashes_first``; by default those that read more than
    LARGE bytes) are read once more before: a pass over the key columns moves 8 bytes
    a row, the hashes that occur more than once. A feed without any is done, and only
    rows that the filter of those lets through are ranked and joined. Neither the pass
    nor the filter's size changes the result.
    """
    rank = nulls_last(*order, row_id)
    ranked = df if subset is None else df.filter(subset)
    candidates, sieve = ranked.select(*keys, rank.alias("_rank")), None
    if hashes_first is None:
        hashes_first = estimated_bytes(df) > LARGE
    if hashes_first:
        again = repeated_hashes(ranked, keys)
        if again is None:
            return df.withColumn(flag, F.lit(False))
        filter_bits = filter_bits or bits_for(again.count())
        sieve = key_filter(again, filter_bits)
        forget(again)
        candidates = passing(candidates, keys, sieve, filter_bits)
    first, n = elected(candidates, keys, hashes_first)
    if not n["keys"]:
        return df.withColumn(flag, F.lit(False))

    inside = F.lit(True) if subset is None else F.coalesce(subset, F.lit(False))
    rows = df.withColumns({"_hash": F.xxhash64(*keys), "_mine": F.when(inside, rank)})
    leads = F.col("_mine").eqNullSafe(F.col("_rank"))
    alike = F.col("_mine").isNotNull() & leads & (F.col("_copies") > 1)
    lost = F.col("_mine").isNotNull() & F.col("_copies").isNotNull() & ~leads
    if sieve is not None or n["keys"] > split_above:
        if sieve is None:
            filter_bits = filter_bits or bits_for(n["keys"])
            sieve = key_filter(first.select(F.col("_key_hash").alias("hash")), filter_bits)
        seen = passing(rows, keys, sieve, filter_bits, among=F.col("_mine").isNotNull(), keep=True)
        once = seen.filter("_pass").drop("_pass").join(first, _same_key(keys), "left")
        spared = seen.filter("NOT _pass").select(*df.columns, F.lit(False).alias(flag))
    else:
        once, spared = rows.join(first, _same_key(keys), "left"), None
    if n["copied"]:
        once = once.filter(~F.coalesce(alike, F.lit(False)))
    out = once.select(*df.columns, lost.alias(flag))
    if spared is not None:
        out = spared.unionByName(out)
    if not n["copied"]:
        return out
    many = rows.join(first.filter(F.col("_copies") > 1), _same_key(keys)).filter(alike)
    return out.unionByName(_all_but_one(many.select(*df.columns), keys, flag))


def estimated_bytes(df: DataFrame) -> int:
    """The bytes that a plan reads, by what Spark knows of its files; estimates of joins would be their product."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def bits_for(repeated: int) -> int:
    """The size of the filter for so many repeated keys: a power of two between the least and the most."""
    return min(MOST_FILTER_BITS, max(FILTER_BITS, 1 << (BITS_PER_KEY * repeated - 1).bit_length()))


def hashes_again(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The 64-bit hashes of keys that occur more than once."""
    counted = df.select(F.xxhash64(*keys).alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > 1).select("hash")


def repeated_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """``hashes_again`` as a written table; None if there are none."""
    out, n = counted_write(hashes_again(df, keys), rows=F.lit(True))
    return out if n["rows"] else None


def among_repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the keys that occur more than once, and by chance a few others; runs a job over the hashes of the keys."""
    again = repeated_hashes(df, keys)
    if again is None:
        return df.limit(0)
    bits = bits_for(again.count())
    sieve = key_filter(again, bits)
    forget(again)
    return passing(df, keys, sieve, bits)


def key_filter(hashes: DataFrame, bits: int) -> DataFrame:
    """A bitmap of hashes, as (word, mask) of its non-empty 64-bit words: a table of at most ``bits`` / 64 rows."""
    slot = F.pmod("hash", F.lit(bits))
    mask = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("_slot", F.lit(64)).cast("int")))
    return cut_lineage(
        hashes.select(slot.alias("_slot")).groupBy(F.shiftright("_slot", 6).alias("_word")).agg(mask.alias("_mask"))
    )


def passing(
    df: DataFrame, keys: Sequence[str], sieve: DataFrame, bits: int, among: Column | None = None, keep: bool = False
) -> DataFrame:
    """The rows whose key may be among the hashes of a filter; with ``keep`` all rows, and whether they pass.

    The filter is broadcast: its size is fixed by ``bits``, whatever the input. Rows
    outside ``among`` do not pass.
    """
    slot = F.pmod(F.xxhash64(*keys), F.lit(bits))
    probed = df.withColumns({"_at": F.shiftright(slot, 6), "_bit": F.pmod(slot, F.lit(64)).cast("int")})
    joined = probed.join(F.broadcast(sieve), F.col("_at") == F.col("_word"), "left")
    hit = F.coalesce(F.getbit("_mask", F.col("_bit")) == 1, F.lit(False))
    hit = hit if among is None else hit & among
    return joined.select(*df.columns, hit.alias("_pass")) if keep else joined.filter(hit).select(*df.columns)


def elected(ranked: DataFrame, keys: Sequence[str], hashes_first: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """Per repeated key its first rank and how many rows share it, as a written table, and counts.

    ``ranked`` holds the keys and ``_rank``. The keys come with a hash beside them:
    the written table is not partitioned by that hash, so beyond broadcast size both
    sides of a join on it are bare shuffles and AQE splits a hot key.

    With ``hashes_first``, ranks are counted only if a pass over hashes finds two rows
    that may share key and rank.
    """
    if hashes_first:
        with shuffles_deleted(ranked.sparkSession):
            alike = hashes_again(ranked, [*keys, "_rank"]).count()
        if not alike:
            firsts = ranked.groupBy(*keys).agg(F.min("_rank").alias("_rank"), F.count(F.lit(1)).alias("_rows"))
            again = firsts.filter(F.col("_rows") > 1).withColumn("_copies", F.lit(1).cast("long"))
            return counted_write(_renamed(again, keys, "_rank", "_copies"), keys=F.lit(True), copied=F.lit(False))
    copies = ranked.groupBy(*keys, "_rank").agg(F.count(F.lit(1)).alias("_copies"))
    firsts = copies.groupBy(*keys).agg(
        F.min(F.struct("_rank", "_copies")).alias("_first"), F.sum("_copies").alias("_rows")
    )
    out = _renamed(firsts.filter(F.col("_rows") > 1), keys, "_first._rank", "_first._copies")
    return counted_write(out, keys=F.lit(True), copied=F.col("_copies") > 1)


def _renamed(df: DataFrame, keys: Sequence[str], *others: str) -> DataFrame:
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    return df.select(F.xxhash64(*keys).alias("_key_hash"), *named, *others)


def _same_key(keys: Sequence[str]) -> Column:
    same = F.col("_hash") == F.col("_key_hash")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return same


def _all_but_one(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Flag all rows of a key but one: one copy of its smallest row.

    Rows alike in every column cannot be told apart, so they are counted and
    written out again, in stretches that spread over tasks.
    """
    whole = F.struct(*df.columns)
    counted = cut_lineage(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")))
    smallest = _renamed(counted.groupBy(*keys).agg(F.min(whole).alias("_smallest")), keys, "_smallest")
    marked = counted.withColumn("_hash", F.xxhash64(*keys)).join(smallest, _same_key(keys))
    stretches = marked.select(
        *df.columns,
        "_copies",
        whole.eqNullSafe(F.col("_smallest")).alias("_leads"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(STRETCH).cast("long"))).alias("_from"),
    ).repartition("_from", *keys)
    upto = F.least(F.col("_from") + STRETCH, F.col("_copies")) - 1
    again = stretches.select(*df.columns, "_leads", F.explode(F.sequence("_from", upto)).alias("_copy"))
    return again.select(*df.columns, (~(F.col("_leads") & (F.col("_copy") == 0))).alias(flag))


def latest_by_key(
    df: DataFrame, keys: Sequence[str], at: str, row_id: str, picks: dict[str, str], aggs: Sequence[Column] = ()
) -> DataFrame:
    """Per key, ``picks`` (output name -> column) of the row with the latest ``at``.

    Rows without ``at`` never win; equal times go to the greatest ``row_id``.
    Other aggregates ride along in the same shuffle.
    """
    newest = F.when(F.col(at).isNotNull(), F.struct(F.col(at), F.col(row_id)))
    chosen = F.max_by(F.struct(*[F.col(c).alias(name) for name, c in picks.items()]), newest).alias("_latest")
    out = df.groupBy(*keys).agg(chosen, *aggs)
    return out.select("*", "_latest.*").drop("_latest")


def latest_record_per_key(df: DataFrame, keys: Sequence[str], at: str, row_id: str) -> DataFrame:
    """The whole latest row of each key: a missing ``at`` counts as latest."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.struct(F.col(at).isNull(), F.col(at), F.col(row_id))
    won = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), newest).alias("winner"))
    return won.select(*[F.col(c) if c in keys else F.col(f"winner.{c}").alias(c) for c in df.columns])


def distinct_counts(df: DataFrame, group: Sequence[str], item: str, counts: dict[str, Column | None]) -> DataFrame:
    """Distinct non-null ``item`` per group, overall (None) or where a condition holds.

    Reducing to (group, item) first means one pass for any number of counts;
    ``count(DISTINCT ...)`` would copy every row once per condition.
    """
    met = {name: F.bool_or(F.coalesce(cond, F.lit(False))) for name, cond in counts.items() if cond is not None}
    items = df.groupBy(*group, item).agg(*[flag.alias(f"_{name}") for name, flag in met.items()]) if met else (
        df.select(*group, item).distinct()
    )
    out = [
        F.count(F.col(item) if cond is None else F.when(F.col(f"_{name}"), F.col(item))).alias(name)
        for name, cond in counts.items()
    ]
    return items.groupBy(*group).agg(*out)
