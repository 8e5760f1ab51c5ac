"""Session settings and the reliable folder that lineage cuts go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .files import remove

# Settings the plans were tuned with. The adaptive ones are Spark's defaults,
# spelled out so that a cluster profile which turns one off is seen.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a wide side is hashed, not sorted, against a side this small per partition
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # do not walk the Python stack for every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


#: Where ``scratch_deleted`` lists the tables that are written in it.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)

#: Spark deletes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tieout")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        # local tables are small enough for most sides to pass the default 10 MB
        # by estimate; keep the shuffle joins that a cluster would run
        .config("spark.sql.autoBroadcastJoinThreshold", "1MB")
        .getOrCreate()
    )


def reliable_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (local tests) a folder of our own is used.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if configured:
        return configured
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tieout-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the reliable folder; nothing exists there yet."""
    return f"{reliable_dir(spark)}/tieout/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffles of queries that run in here go when the query ends, and not when the driver next collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def scratch_deleted(spark: SparkSession) -> Iterator[None]:
    """Tables that ``cut_lineage`` writes in here are deleted at the end; nothing that is read later may need them."""
    paths: list[str] = []
    outer = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(outer)
        for path in paths:
            remove(spark, path)


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write the rows to the reliable folder and continue from that table.

    Used only where a loop would otherwise replay its whole history. The table
    is in shared storage, so a lost executor costs a re-read and nothing more;
    being columnar files, it is read pruned and with a known size. The shuffles behind
    it are deleted at once, as nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    if (written := _written.get()) is not None:
        written.append(path)
    with shuffles_deleted(spark):
        df.write.options(**({"compression": compression} if compression else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted_write(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``cut_lineage``, and how many of the rows meet each condition, counted while they are written."""
    seen = Observation()
    out = cut_lineage(df.observe(seen, *[F.count(F.when(met, 1)).alias(name) for name, met in counts.items()]))
    return out, seen.get


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``cut_lineage`` wrote and that nothing reads any more."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/tieout/cut-" in path:
                remove(df.sparkSession, path)
