"""Join shapes. No broadcast hints: Spark compares each side with
``spark.sql.autoBroadcastJoinThreshold`` (and again at run time with the real
shuffle sizes), and splits oversized partitions of the rest (AQE skew join)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    rows: DataFrame, parent: DataFrame, link: str, parent_id: str, row_id: str, take: dict[str, str]
) -> DataFrame:
    """Left join ``rows.link`` to ``parent.parent_id`` (unique), adding ``take``.

    ``take`` maps output names to parent columns. A link that is mostly null
    would send all those rows to one reducer, so the join has a second key, the
    slot: 0 for a linked row and the hash of its own id for one without a link,
    which cannot match anyway. The parent's slot is always 0, but written so
    that the optimizer does not fold it into a filter and drop the key.
    """
    right = parent.select(
        F.col(parent_id).alias("_ref"),
        F.pmod(F.xxhash64(parent_id), F.lit(1)).alias("_zero"),
        *[F.col(c).alias(name) for name, c in take.items()],
    )
    left = rows.withColumn("_slot", F.when(F.col(link).isNull(), F.xxhash64(row_id)).otherwise(F.lit(0)))
    joined = left.join(right, (F.col(link) == F.col("_ref")) & (F.col("_slot") == F.col("_zero")), "left")
    return joined.select(*[left[c] for c in rows.columns], *take)


def flag_orphans(
    child: DataFrame,
    live_ids: DataFrame,
    link: str,
    live_id: str,
    row_id: str,
    flag: str,
    links_from: DataFrame | None = None,
) -> DataFrame:
    """Add ``flag``: true where the child's parent is missing or was deduplicated away.

    The parent is looked up with (id, link) pairs only; the wide child rows
    join the outcome on their own id. ``links_from`` may name a cheaper frame
    with the same ids and links, such as the rows before other flags were added.
    """
    live = live_ids.select(F.col(live_id).alias("_ref"))
    source = child if links_from is None else links_from
    pairs = source.select(row_id, F.col(link).alias("_ref")).filter(F.col("_ref").isNotNull())
    found = pairs.join(live, "_ref", "left_semi").groupBy(row_id).agg(F.lit(True).alias("_live"))
    out = child.join(found, row_id, "left").withColumn(flag, F.col("_live").isNull())
    return out.select(*child.columns, flag)


def link_hits(
    refs: DataFrame, row_id: str, links: Sequence[str], targets: DataFrame, target_id: str, suffix: str = "_lives"
) -> DataFrame:
    """Per row id, which of its links point at an existing target.

    Only (id, link) pairs that carry a link are shuffled, for all the links in
    one join; rows with no hit at all are absent from the result.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("which"), F.col(c).alias("ref")) for i, c in enumerate(links)])
    given = refs.select(row_id, F.explode(pairs).alias("p")).select(
        row_id, F.col("p.which").alias("which"), F.col("p.ref").alias("_ref")
    )
    known = targets.select(F.col(target_id).alias("_ref"))
    found = given.filter(F.col("_ref").isNotNull()).join(known, "_ref", "left_semi")
    flags = [F.bool_or(F.col("which") == i).alias(f"{c}{suffix}") for i, c in enumerate(links)]
    return found.groupBy(row_id).agg(*flags)


def validate_links(
    rows: DataFrame, hits: DataFrame, row_id: str, link: str, valid: str, orphaned: str, suffix: str = "_lives"
) -> DataFrame:
    """Add ``valid`` / ``orphaned``: the link exists and its target survives / does not.

    ``hits`` comes from ``link_hits``. The wide rows join on their own unique
    id, so neither a popular target nor a mostly-null link concentrates them.
    """
    present, lives = F.col(link).isNotNull(), F.coalesce(F.col(f"{link}{suffix}"), F.lit(False))
    joined = rows.join(hits, row_id, "left")
    return joined.withColumns({valid: present & lives, orphaned: present & ~lives})


def join_one_row_frames(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Put one-row summaries side by side. Each side is a global aggregate."""
    for other in others:
        first = first.crossJoin(other)
    return first


def left_join_all(base: DataFrame, key: str, sides: Sequence[DataFrame]) -> DataFrame:
    """Left join several one-row-per-key sides on the same key."""
    for side in sides:
        base = base.join(side, key, "left")
    return base


def disagree(a: str, b: str, tolerance: str | None = None) -> Column:
    """True where two figures differ (by more than ``tolerance`` when given)."""
    if tolerance is None:
        return F.col(a) != F.col(b)
    return F.abs(F.col(a) - F.col(b)) > F.lit(tolerance).cast("decimal(18,2)")
