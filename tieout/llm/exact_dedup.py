"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame operations only.

Each input partition first reduces its rows to one run: per text digest, the
winning id and how many rows it stands for. Runs then meet in binomial rounds: in
round r, run i takes in the runs whose number agrees with its own apart from the
lowest digits. What meets is exchanged by run and by slice of the digests, so the last
run, too, lies in many partitions; each partition is sorted by digest, which puts the
equal digests of the runs side by side, and one pass over the sorted rows (Spark's
sort-based aggregate) merges them, keeping the winner. A digest that a third of all
rows share is one row per run from the first round on, so no round sees a hot key.
What counts as one text is verified at each level: SHA-256, a second independent hash
and the length all have to agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

RUNS, FAN_IN = 64, 4
#: Slices of the digests that a run is cut into.
SLICES = 1 << 16
KEY = ["sha", "check", "length"]


def digested(text: Column) -> list[Column]:
    body = F.coalesce(text, F.lit(""))
    return [
        F.unhex(F.sha2(body, 256)).alias("sha"), F.xxhash64(body).alias("check"), F.length(body).alias("length")
    ]


def merged(level: DataFrame, largest: bool) -> DataFrame:
    """Runs sorted by digest, equal digests of one run reduced to the winner and the sum of rows.

    The rows of a partition come sorted by (run, slice, digest). The winner is taken
    from a struct, which Spark aggregates by sorted rows and not by a hash table, so
    the order that is there is the one that it merges in.
    """
    pick = F.max if largest else F.min
    # a null id wins only where there is no other
    ranked = F.struct((F.col("doc_id").isNotNull() if largest else F.col("doc_id").isNull()).alias("known"), "doc_id")
    rows = level.repartition("run", "slice").sortWithinPartitions("run", "slice", *KEY)
    won = rows.groupBy("run", "slice", *KEY).agg(pick(ranked).alias("w"), F.sum("n").alias("n"))
    return won.select("run", "slice", *KEY, F.col("w.doc_id").alias("doc_id"), "n")


def merge_runs(rows: DataFrame, runs: int = RUNS, fan_in: int = FAN_IN, largest: bool = True) -> DataFrame:
    """(sha, check, length, keep_id, group_size) per distinct text, from rows with doc_id, sha, check, length.

    Null ids never win against others.
    """
    winner = F.max("doc_id") if largest else F.min("doc_id")
    slice_of = F.conv(F.hex(F.substring("sha", 1, 4)), 16, 10).cast("long") % SLICES
    # reduced by each task before anything moves
    level = (
        rows.withColumn("run", F.pmod(F.spark_partition_id(), F.lit(runs)))
        .groupBy("run", *KEY).agg(winner.alias("doc_id"), F.count("*").alias("n"))
        .withColumn("slice", slice_of)
    )
    while runs > 1:
        runs = -(-runs // fan_in)
        level = merged(level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")), largest)
    return level.select(*KEY, F.col("doc_id").alias("keep_id"), F.col("n").alias("group_size"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    The row with the largest id of each text stays. A null text counts as empty;
    empty texts equal each other. Repeated rows of the winning id are all marked
    kept; a null id wins only where no other id has the text. No rows give no rows.
    """
    rows = cut_lineage(docs.select(F.col(id_col).alias("doc_id"), *digested(F.col(text_col))))
    groups = cut_lineage(merge_runs(rows).filter("group_size > 1"))
    same = reduce(Column.__and__, [F.col(f"d.{c}") == F.col(f"g.{c}") for c in KEY])
    # texts that occur once need no partner; the others may share one key, which
    # AQE splits: both sides are plain exchanges of written tables
    found = rows.alias("d").join(groups.alias("g"), same, "left")
    keep = F.when(F.col("g.sha").isNull(), F.col("d.doc_id")).otherwise(F.col("g.keep_id"))
    return found.select(
        F.col("d.doc_id"),
        keep.alias("keep_id"),
        F.coalesce(F.col("g.group_size"), F.lit(1)).cast("long").alias("group_size"),
        F.col("d.doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("d.sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per text, with all its columns; of repeated winners one stays.

    Only the keys of texts that occur more than once take part in the join.
    """
    names, same = docs.columns, [f"__{c}" for c in KEY]
    rows = cut_lineage(docs.select(F.col(id_col).alias("doc_id"), *digested(F.col(text_col))))
    groups = cut_lineage(
        merge_runs(rows).filter("group_size > 1").select(
            *[F.col(c).alias(f"__{c}") for c in KEY], F.col("keep_id").alias("__keep"), F.lit(True).alias("__found")
        )
    )
    # winners whose id has the same text more than once
    winners = rows.select(F.col("doc_id").alias("__keep"), *[F.col(c).alias(f"__{c}") for c in KEY])
    again = cut_lineage(
        winners.join(groups.withColumnRenamed("__keep", "__kept"), same)
        .filter(F.col("__keep").eqNullSafe(F.col("__kept")))
        .groupBy(*same).agg(F.count("*").alias("__n")).filter("__n > 1").select(*same, F.lit(True).alias("__again"))
    )
    wide = docs.select("*", *[c.alias(f"__{n}") for n, c in zip(KEY, digested(F.col(text_col)))])
    kept = wide.join(groups.join(again, same, "left"), same, "left").filter(
        F.col("__found").isNull() | F.col(id_col).eqNullSafe(F.col("__keep"))
    )
    once = kept.filter(F.col("__again").isNull()).select(*names)
    if again.isEmpty():
        return once
    return once.unionByName(kept.filter(F.col("__again")).dropDuplicates(same).select(*names))
