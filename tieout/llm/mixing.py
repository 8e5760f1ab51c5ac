"""Mixing sources to target weights: Sainte-Laguë quotas, then seeded blocks.

Sources get a share of all words by weight, at most a multiple of what they
have. Blocks of equal size are allocated by highest quotients twice: to the
sources, and within each source to its shards, so the quotas are integers. A
shard then lays its documents out in a seeded order, as a ring, and takes as
many consecutive blocks as its quota says from a seeded start; going round the
ring more than once repeats documents. A source that needs more than the whole
blocks of its shards also takes the words left below a block.

DataFrame operations only. Highest quotients need no list of all blocks: seats
that are certain follow from a division, and only the seats around the last
quotient, at most two per party, are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Words of a block; shards of a source; most repeats of a document.
BLOCK, SHARDS, MOST = 16, 1024, 3
#: Weights of the sources in the order of their names, repeating. Fixed values.
WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str, *cols: Column) -> Column:
    """A seeded 60-bit number per row that any SQL engine can compute too."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def fill_level(weight: Column, room: Column, total: Column, own: W, ties: list[Column]) -> tuple[Column, Column]:
    """Per row, and its minimum over the window ``own`` is the common level x with
    sum(least(room, x * weight)) = total.

    Taken in the order of room per weight, a party is full exactly if it is full
    when all before it are; the level is the one at the first that is not. Null
    when all are full.
    """
    order = own.orderBy(F.try_divide(room, weight).asc_nulls_first(), *ties)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    left = total - F.coalesce(F.sum(room).over(before), F.lit(0))
    weight_left = F.sum(weight).over(own) - F.coalesce(F.sum(weight).over(before), F.lit(0))
    level = F.when(weight_left > 0, left / weight_left)
    full = (room < level * weight) | (weight <= 0)
    # of equal ones the first has the highest level
    return F.when(~full, F.struct(F.try_divide(room, weight).alias("at"), (-level).alias("down"), level.alias("level"))), level


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Targets share the total by weight; one that is above ``most`` times its
    source is cut, and the rest is shared among the others again, until none is
    above.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    turns = F.array(*[F.lit(w) for w in weights])
    all_of_them = W.partitionBy()
    weighed = each.withColumn("weight", turns[rank % len(weights)].cast("long")).withColumn(
        "room", F.col("source_size") * most
    ).withColumn("total", F.sum("source_size").over(all_of_them))
    first, _ = fill_level(F.col("weight"), F.col("room"), F.col("total"), all_of_them, [F.col("source").asc_nulls_last()])
    level = F.min("first").over(all_of_them)["level"]
    target = F.least(F.col("room").cast("double"), level * F.col("weight"))
    return weighed.withColumn("first", first).select(
        "source", "source_size", F.coalesce(target, F.col("room").cast("double")).alias("target")
    )


def apportion(parties: DataFrame, house: list[str], party: list[str], votes: str, seats: str, cap: str) -> DataFrame:
    """``parties`` with a column ``quota``: Sainte-Laguë, at most ``cap`` seats each.

    Seat k of a party has the quotient votes / (2k - 1); of the seats within the
    caps, the ``seats`` highest quotients of a house win, ties by ``party``. Null
    or zero votes give no seat.

    Rounding each party's share at a level changes it by half a seat at most, so
    the level of n / 2 seats less gives seats that are certain and that of n / 2
    more all that are possible: about n seats are between and get ranked.
    """
    own = W.partitionBy(*house) if house else W.partitionBy()
    ties = [F.col(p).asc_nulls_last() for p in party]
    v, room = F.col("__v"), F.col("__room")
    base = parties.select(
        "*",
        F.greatest(F.coalesce(F.col(votes), F.lit(0)), F.lit(0)).cast("double").alias("__v"),
        F.when(F.col(votes) > 0, F.col(cap)).otherwise(F.lit(0)).cast("long").alias("__room"),
    ).withColumn("__n", F.count("*").over(own))
    for name, shift in (("low", -0.5), ("high", 0.5)):
        first, _ = fill_level(v, room, F.col(seats) + shift * F.col("__n"), own, ties)
        base = base.withColumn(f"__{name}", first).withColumn(f"__{name}", F.min(f"__{name}").over(own)["level"])
    sure = F.floor(v * F.greatest(F.col("__low"), F.lit(0.0)) + 0.5) - 1
    upto = F.floor(v * F.col("__high") + 0.5) + 1
    close = (
        base.withColumn("__sure", F.least(F.greatest(F.coalesce(sure, room - 1), F.lit(0)), room).cast("long"))
        .withColumn("__upto", F.least(F.coalesce(upto, room), room).cast("long"))
        .withColumn("__left", F.col(seats) - F.sum("__sure").over(own))
        .withColumn("__k", F.explode_outer(F.when(F.col("__upto") > F.col("__sure"), F.sequence(F.col("__sure") + 1, F.col("__upto")))))
    )
    order = own.orderBy((v / (2 * F.col("__k") - 1)).desc_nulls_last(), *ties)
    wins = (F.row_number().over(order) <= F.col("__left")) & F.col("__k").isNotNull()
    return close.withColumn("__win", wins.cast("long")).groupBy(*parties.columns).agg(
        (F.max("__sure") + F.sum("__win")).alias("quota")
    )


def quotas(sizes: DataFrame, targets: DataFrame, block: int = BLOCK, most: int = MOST) -> DataFrame:
    """(source, shard, shard_size, words) from (source, shard, size) rows.

    A shard takes whole blocks. Where the whole blocks of all shards of a source
    are less than the source is to take, the shards in order also take what is
    left of them below a block; a source at ``most`` times its size takes all.
    """
    shards = sizes.groupBy("source", "shard").agg(F.sum("size").alias("shard_size")).withColumn(
        "room", F.floor(F.col("shard_size") * most / block)
    )
    house = targets.withColumn("seats", F.floor(F.sum("source_size").over(W.partitionBy()) / block + 0.5)).withColumn(
        "source_room", F.floor(F.col("source_size") * most / block)
    )
    full = F.col("source_size") * most
    by_source = apportion(house, [], ["source"], "target", "seats", "source_room").select(
        F.col("source").alias("__source"),
        F.when(F.col("target") >= full, full).otherwise(F.col("quota") * block).cast("long").alias("source_words"),
    )
    own = W.partitionBy("source")
    joined = shards.join(by_source, F.col("source").eqNullSafe(F.col("__source"))).drop("__source").withColumn(
        "seats", F.least(F.floor(F.col("source_words") / block), F.sum("room").over(own))
    )
    out = apportion(joined, ["source"], ["shard"], "shard_size", "seats", "room")
    # words are left only if every shard has all its blocks
    left = F.when(F.sum("quota").over(own) == F.sum("room").over(own), F.col("source_words") - F.sum("room").over(own) * block)
    below = F.col("shard_size") * most - F.col("room") * block
    before = F.coalesce(F.sum(below).over(own.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.greatest(F.least(below, F.coalesce(left, F.lit(0)) - before), F.lit(0))
    return out.select("source", "shard", "shard_size", (F.col("quota") * block + rest).cast("long").alias("words"))


def mix_rows(docs: DataFrame, seed: str = "mix-1", block: int = BLOCK, shards: int = SHARDS, most: int = MOST) -> DataFrame:
    """All rows and columns of ``docs`` with a struct ``__mix``.

    Fields: size, source_size, target, rounds (full passes over the document),
    a_from, a_to, b_from, b_to (the words, counted from 0, that the last partial
    pass takes; the ring's end may cut it in two), taken.
    """
    # what decides is computed from narrow columns and written once; the wide
    # rows are read again and moved a single time, by shard
    own = [word_count(F.col("text")).alias("__size"), F.col("source").alias("__source")]
    wide = docs.select("*", *own).withColumn("__draw", draw(seed, F.col("doc_id")))
    wide = wide.withColumn("__shard", F.pmod("__draw", F.lit(shards)).cast("int"))
    narrow = wide.groupBy(F.col("__source").alias("source"), F.col("__shard").alias("shard")).agg(
        F.sum("__size").alias("size")
    )
    narrow = cut_lineage(narrow)
    targets = cut_lineage(source_targets(narrow))
    plan = cut_lineage(quotas(narrow, targets, block, most)).alias("q")
    t = targets.alias("t")
    # a key that is never null: the join and the window then share one exchange
    key = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    plan = plan.join(t, F.col("q.source").eqNullSafe(F.col("t.source"))).select(
        key(F.col("q.source")).alias("__key"), F.col("shard").alias("__shard"), "shard_size", "words", "source_size", "target"
    )
    plan = cut_lineage(
        plan.select("__key", "__shard", *[F.col(c).alias(f"__{c}") for c in ("shard_size", "words", "source_size", "target")])
    )
    rows = wide.withColumn("__key", key(F.col("__source"))).join(plan, ["__key", "__shard"])
    ring = W.partitionBy("__key", "__shard").orderBy("__draw", F.col("doc_id").asc_nulls_last(), "__size")
    size, total = F.col("__size"), F.col("__shard_size")
    start = F.sum(size).over(ring.rowsBetween(W.unboundedPreceding, W.currentRow)) - size
    words = F.col("__words")
    rounds = F.when(total > 0, F.floor(words / total)).otherwise(F.lit(0)).cast("long")
    part = (words - rounds * total).cast("long")
    begin = F.when(total > 0, F.pmod(draw(seed, F.lit("start"), F.col("__source"), F.col("__shard")), total)).otherwise(F.lit(0))
    rows = rows.select("*", start.alias("__start"), rounds.alias("__rounds"), part.alias("__part"), begin.alias("__begin"))
    # the interval [begin, begin + part) of the ring, cut at the ring's end
    inside = lambda x: F.least(F.greatest(x - F.col("__start"), F.lit(0)), size)
    end = F.col("__begin") + F.col("__part")
    a_from, a_to = inside(F.col("__begin")), inside(F.least(end, total))
    b_to = inside(F.greatest(end - total, F.lit(0)))
    taken = F.col("__rounds") * size + (a_to - a_from) + b_to
    mixed = F.struct(
        size.alias("size"), F.col("__source_size").cast("long").alias("source_size"), F.col("__target").alias("target"),
        F.col("__rounds").alias("rounds"), a_from.cast("long").alias("a_from"), a_to.cast("long").alias("a_to"),
        F.lit(0).cast("long").alias("b_from"), b_to.cast("long").alias("b_to"), taken.cast("long").alias("taken"),
    )
    return rows.select(*[F.col(c) for c in docs.columns], mixed.alias("__mix"))


def mixture(docs: DataFrame, seed: str = "mix-1", block: int = BLOCK, shards: int = SHARDS, most: int = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per row of ``docs``.

    A null text has size 0; a null source is a source of its own, last in order.
    Repeated rows are separate rows. Reruns agree. No rows give no rows.
    """
    return mix_rows(docs.select("doc_id", "source", "text"), seed, block, shards, most).select("doc_id", "__mix.*").select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def mixed_documents(docs: DataFrame, seed: str = "mix-1", block: int = BLOCK, shards: int = SHARDS, most: int = MOST) -> DataFrame:
    """The mixture itself: ``docs`` rows as often as they are taken.

    Full passes are the row as it is. A partial pass is a row whose text is the
    words taken, joined by one space. Documents without a word are not taken.
    """
    rows = mix_rows(docs, seed, block, shards, most)
    m = F.col("__mix")
    whole = F.array_repeat(F.col("text"), m["rounds"].cast("int"))
    words = F.split(F.regexp_replace(F.col("text"), r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    cut = lambda a, b: F.slice(words, (a + 1).cast("int"), (b - a).cast("int"))
    rest = F.concat(cut(m["b_from"], m["b_to"]), cut(m["a_from"], m["a_to"]))
    extra = (m["a_to"] - m["a_from"]) + (m["b_to"] - m["b_from"])
    whole = F.when(extra == m["size"], F.array_repeat(F.col("text"), m["rounds"].cast("int") + 1)).otherwise(whole)
    partial = F.when((extra > 0) & (extra < m["size"]), F.array(F.array_join(rest, " "))).otherwise(F.array().cast("array<string>"))
    parts = F.when(m["size"] > 0, F.concat(whole, partial)).otherwise(F.array().cast("array<string>"))
    out = rows.withColumn("__text", F.explode(parts))
    cols = [
        F.col("__text").alias("text") if c == "text" else F.length("__text").cast(dict(docs.dtypes)[c]).alias(c) if c == "n_chars" else F.col(c)
        for c in docs.columns
    ]
    return out.select(*cols)
