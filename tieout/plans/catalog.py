"""Marts as catalog tables: replaced as a whole, bucketed by the key that they share.

A table is written under a name of its own and takes the place of the old one by
two renames, so a write that fails leaves the old table as it is and readers never
see half a table. Between the renames the name is missing for a moment; a run that
dies there leaves the old table under its retired name, and the next one (or
``recover``) puts it back.

Tables on one key have equal buckets, and each bucket is one sorted file, so a join
or an aggregate on that key reads them without a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from .base import Project

#: The key of the models with one row per key. Models with equal keys join without a shuffle.
KEYS: dict[str, dict[str, tuple[str, ...]]] = {
    "revenue": {"int_order_financials": ("order_id",), "fct_revenue": ("order_id",)},
    "lending": {
        "int_loan_delinquency": ("loan_id",),
        "int_loan_register_status": ("loan_id",),
        "fct_loan_performance": ("loan_id",),
    },
    "visits": {"fct_appointments": ("logical_visit_id",), "fct_patient_engagement": ("patient_id",)},
    "workforce": {"int_person_employment_summary": ("person_id",), "fct_workforce": ("person_id",)},
}


def save_table(df: DataFrame, name: str, keys: Sequence[str] = (), buckets: int | None = None) -> None:
    """Full refresh of the catalog table ``name``, bucketed and sorted by ``keys`` if there are any.

    ``buckets`` defaults to the session's shuffle partitions; tables that are to be
    joined need the same number. A key with very many rows fills one bucket: give
    keys only to tables with few rows per key.
    """
    spark = df.sparkSession
    recover(spark, name)
    staged = f"{name}__staged_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        # a partition holds exactly one bucket, so each bucket is one file
        rows = df.repartition(buckets, *keys) if keys else df
        writer = rows.write.format("parquet")
        if keys:
            writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
        writer.saveAsTable(staged)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    swap(spark, staged, name)


def retired(name: str) -> str:
    return f"{name}__retired"


def swap(spark: SparkSession, staged: str, name: str) -> None:
    """Put the table ``staged`` in the place of ``name`` and drop what was there."""
    old = spark.catalog.tableExists(name)
    if old:
        spark.sql(f"ALTER TABLE {name} RENAME TO {retired(name)}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        recover(spark, name)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {retired(name)}")


def recover(spark: SparkSession, name: str) -> None:
    """Undo a swap that a dying run left half-way."""
    if not spark.catalog.tableExists(retired(name)):
        return
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE {retired(name)}")
    else:
        spark.sql(f"ALTER TABLE {retired(name)} RENAME TO {name}")


def save_project(
    project: Project, spark: SparkSession, database: str, names: Iterable[str] | None = None, buckets: int | None = None
) -> Project:
    """Write models (all marts unless named) as tables of ``database`` and pin the project to them."""
    for name in project.marts if names is None else names:
        table = f"{database}.{name}"
        save_table(project.model(name), table, KEYS[project.name].get(name, ()), buckets)
        project.pin(name, spark.table(table))
    return project


def joined_by_bucket(project: Project, spark: SparkSession, database: str) -> DataFrame:
    """Leakage and refunds per shipment state, from two revenue tables joined by name and bucket."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{scratch_path(spark, 'catalog')}'")
    save_project(project, spark, database, ["int_order_financials", "fct_revenue"])
    return spark.sql(
        f"""
        SELECT o.shipment_status, count(*) AS orders, sum(r.net_revenue) AS net_revenue,
               sum(o.total_refunded) AS refunded, sum(r.cancellation_leakage_amount) AS leakage
        FROM {database}.int_order_financials o JOIN {database}.fct_revenue r USING (order_id)
        GROUP BY o.shipment_status"""
    )
