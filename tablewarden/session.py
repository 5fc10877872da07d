"""Session set-up and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SPREAD_ROWS = 1 << 19  # most rows of a part that training reads, on average


def local_session(cpus: int = 8, app: str = "tablewarden", **conf: str) -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where unset, a temporary one, in local sessions only."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder for this cluster")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tablewarden-"))
    return named or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def parts_for(spark: SparkSession, rows: int) -> int:
    """Partitions for ``rows`` rows: the shuffle partitions, and more where one would hold over ``SPREAD_ROWS`` rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // SPREAD_ROWS))


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """For jobs with hundreds of expressions in one stage: HotSpot leaves methods beyond 8,000 bytes uncompiled.

    Spark then generates smaller ones. Results don't change.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialize(
    df: DataFrame, name: str, partition_by: tuple[str, ...] = (), spread_by: str | None = None, rows: int = 0
) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    For tables that several later jobs read: it cuts the lineage and survives
    the loss of executors, which a cache does not. ``spread_by`` names a
    column to spread the rows by over all shuffle partitions, for iterative
    jobs that would otherwise run on the few partitions a small table has. ``rows`` is how many there may be:
    beyond ``SPREAD_ROWS`` for each partition there are more of them, so that what one task reads has a bound.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    out = df
    if spread_by:
        out = df.repartition(parts_for(spark, rows), spread_by)
    out.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def in_pools(spark: SparkSession, run: Callable, items: Iterable, threads: int = 5) -> list:
    """``run(item)`` for every item, their Spark jobs side by side, each item in a scheduler pool of its own.

    For independent sequences of short jobs, such as the fits of several folds. The pools share the cluster evenly
    where ``spark.scheduler.mode`` is FAIR; else earlier jobs go first. The first error is raised.
    """
    def pooled(job: tuple[int, object]):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"pool-{job[0]}")
        return run(job[1])

    jobs = list(enumerate(items))
    with ThreadPool(min(threads, len(jobs) or 1)) as pool:
        return pool.map(inheritable_thread_target(pooled), jobs, chunksize=1)
