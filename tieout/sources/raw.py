"""Reading the raw feeds with declared types.

What is stored is compared with what is declared before any row is read. A missing
column stops the read and names all that are missing. A column of another type is
parsed, and rows with a value that does not parse go to a side table, whole, so that
none is lost and none is silently null. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .schemas import RAW_COLUMNS, raw_schema

Raw = Mapping[str, DataFrame]
#: Formats whose files say nothing of types: every column is text.
UNTYPED = {"csv": {"header": "true"}, "json": {"primitivesAsString": "true"}}


class MissingColumns(ValueError):
    """A feed lacks declared columns."""


class Feeds(dict[str, DataFrame]):
    """The feeds of a project by name, and the rows of each that do not parse."""

    def __init__(self, project: str) -> None:
        super().__init__()
        self.project = project
        #: (row, unparsed): the stored row as JSON and the names of its bad columns.
        self.rejected: dict[str, DataFrame] = {}

    def write_rejected(self, folder: str) -> dict[str, int]:
        """Keep the rows that do not parse below ``folder``; how many there are, per feed that has any."""
        found = {}
        for table, df in self.rejected.items():
            path = f"{folder}/rejected_{table}"
            df.write.mode("overwrite").parquet(path)
            n = df.sparkSession.read.parquet(path).count()
            if n:
                found[table] = n
        return found


def differences(stored: StructType, declared: StructType) -> tuple[list[str], dict[str, str]]:
    """The declared columns that are missing, and the stored type of those that have another."""
    have = {f.name: f.dataType for f in stored}
    missing = [f.name for f in declared if f.name not in have]
    other = {f.name: have[f.name].simpleString() for f in declared if f.name in have and have[f.name] != f.dataType}
    return missing, other


def checked_feed(df: DataFrame, project: str, table: str) -> tuple[DataFrame, DataFrame | None]:
    """The feed in declared types, and the rows that do not parse (None where every type is as declared)."""
    declared = raw_schema(project, table)
    missing, other = differences(df.schema, declared)
    if missing:
        raise MissingColumns(f"{project}.raw_{table} lacks {', '.join(missing)}")
    if not other:
        return df.select(*declared.names), None
    parsed = {f.name: F.col(f.name).try_cast(f.dataType) if f.name in other else F.col(f.name) for f in declared}
    bad = F.array_compact(
        F.array(*[F.when(F.col(name).isNotNull() & parsed[name].isNull(), F.lit(name)) for name in other])
    )
    rows = df.select("*", bad.alias("_unparsed"))
    good = rows.filter(F.size("_unparsed") == 0).select(*[parsed[name].alias(name) for name in declared.names])
    lost = rows.filter(F.size("_unparsed") > 0)
    return good, lost.select(F.to_json(F.struct(*df.columns)).alias("row"), F.col("_unparsed").alias("unparsed"))


def _feeds(project: str, read) -> Feeds:
    feeds, missing = Feeds(project), []
    for table in RAW_COLUMNS[project]:
        try:
            feeds[table], lost = checked_feed(read(table), project, table)
        except MissingColumns as lacking:
            missing.append(str(lacking))
            continue
        if lost is not None:
            feeds.rejected[table] = lost
    if missing:
        raise MissingColumns("; ".join(missing))
    return feeds


def read_raw(spark: SparkSession, project: str, folder: str, fmt: str = "parquet") -> Feeds:
    """Every feed of a project from ``<folder>/raw_<table>``."""
    options = UNTYPED.get(fmt, {})
    return _feeds(project, lambda table: spark.read.format(fmt).options(**options).load(f"{folder}/raw_{table}"))


def raw_tables(spark: SparkSession, project: str, database: str) -> Feeds:
    """Every feed of a project from catalog tables ``<database>.raw_<table>``."""
    return _feeds(project, lambda table: spark.table(f"{database}.raw_{table}"))
