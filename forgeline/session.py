"""Session settings and the shared working folder."""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # What a query shuffled goes when it has ended, not when the driver collects garbage; a DataFrame that is run
    # a second time works it out again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

_local_base: str | None = None
_made: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("made", default=None)


def build_session(app_name: str = "forgeline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on. Memory, cores and shuffle
    width stay with the caller (pass them as ``conf``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the SQL settings on a session somebody else built."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the executors
    would each see a different one.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="forgeline-")
        base = _local_base
    path = f"{base.rstrip('/')}/forgeline/{label}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def noted_work() -> Iterator[list[str]]:
    """The working folders made inside the block, for a caller who knows when they are no longer read."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)


def remove_work(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


@contextmanager
def temporary_work(spark: SparkSession) -> Iterator[None]:
    """Remove the working folders made inside the block at its end. For jobs that write
    their result elsewhere; a DataFrame that leaves the block must not read from them."""
    with noted_work() as made:
        try:
            yield
        finally:
            remove_work(spark, made)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a working folder and read it back.

    This cuts the lineage in a way that survives the loss of executors, lets what follows
    use it several times at the price of a scan, and gives the planner its true size.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_alone(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """`materialize` of what ``build`` returns; the working folders which building it made go once it is written."""
    path = work_dir(spark, label)
    with temporary_work(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_together(spark: SparkSession, jobs: list[Callable[[], object]]) -> list:
    """Run independent Spark jobs at the same time, so that small ones share the cluster
    instead of queueing; returns their results in order, or raises what one raised."""

    def start(pool: ThreadPoolExecutor, job: Callable[[], object]):
        context = contextvars.copy_context()
        return pool.submit(inheritable_thread_target(spark)(lambda: context.run(job)))

    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        return [future.result() for future in [start(pool, job) for job in jobs]]
