"""Tables replaced as a whole without a moment at which a reader finds them empty.

A table root holds ``version=N`` directories. A version counts once its write job has
committed (Spark then leaves a ``_SUCCESS`` file), and readers take the highest such one.

A table that is replaced by parts has versions that hold some of its parts only, and beside them
``parts/version=N``, written last: which parts a version replaced. Readers take each part from the last
version that did.
"""

from __future__ import annotations

import json
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.quality import key_violations
from ..session import materialize, run_together
from .contents import contents


def _versions(spark: SparkSession, root: str, committed: bool) -> list[int]:
    jvm = spark._jvm.org.apache.hadoop.fs
    pattern = jvm.Path(f"{root}/version=*/_SUCCESS" if committed else f"{root}/version=*")
    found = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(pattern) or []
    paths = [status.getPath().getParent() if committed else status.getPath() for status in found]
    return sorted(int(p.getName().split("=")[1]) for p in paths)


def current_version(spark: SparkSession, root: str) -> int | None:
    versions = _versions(spark, root, committed=True)
    return versions[-1] if versions else None


def full_refresh(df: DataFrame, root: str, keep: int | None = None) -> int:
    """Publish ``df`` as the next version and return its number. ``df`` may read the version
    it replaces; a failed write leaves the old one in place. With ``keep``, only so many of the
    newest versions stay; a reader has as long to finish as it takes to publish them."""
    spark = df.sparkSession
    version = max(_versions(spark, root, committed=False), default=0) + 1
    df.write.mode("errorifexists").parquet(f"{root}/version={version}")
    if keep is not None:
        for old in _versions(spark, root, committed=True)[:-keep]:
            _delete(spark, f"{root}/version={old}")
    return version


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


class Refused(ValueError):
    """A table was not published; ``path`` holds the violations."""

    def __init__(self, root: str, path: str, found: list):
        super().__init__(f"{root} keeps its version, see {path}: {[row.asDict() for row in found]}")
        self.path = path


def checked_refresh(df: DataFrame, root: str, required: list[str], key: list[str] | None = None, refuse: bool = True) -> int:
    """Publish ``df`` as `full_refresh` does once its columns ``required`` hold no NULL and its rows tell
    ``key`` apart.

    The rows are staged and checked as they were written. Violations go to ``violations`` of the same number
    beside the versions: (check, key, rows), one row per column with NULLs and per repeated key. With
    ``refuse`` any of them raises `Refused` and readers keep the version they have; otherwise they are
    only noted.
    """
    spark = df.sparkSession
    staged = materialize(df, "staged")
    version = max(_versions(spark, root, committed=False), default=0) + 1
    path = f"{root}/violations/version={version}"
    key_violations(staged, required, key).write.mode("overwrite").parquet(path)
    found = spark.read.parquet(path).limit(5).collect()
    if found and refuse:
        raise Refused(root, path, found)
    return full_refresh(staged, root)


def checked_load(tables: dict[str, DataFrame], root: str, refuse: bool = True) -> dict[str, int]:
    """`checked_refresh` of reporting tables with the keys they declare, dimensions first: a table that is
    refused keeps the later ones from being published."""
    names = [n for n in schemas.TABLE_NAMES if n in tables]
    return {n: checked_refresh(tables[n], f"{root}/{n}", schemas.KEYS[n], schemas.KEYS[n], refuse) for n in names}


def read_violations(spark: SparkSession, root: str) -> DataFrame:
    """All violations noted for a table, with the version they were found in."""
    return spark.read.option("basePath", f"{root}/violations").parquet(f"{root}/violations")


PARTS = schemas.struct("part int, column string, schema string")


def replace_parts(df: DataFrame, root: str, column: str, parts: list[int] | None = None, rebalance: bool = True) -> int:
    """Publish ``df`` in place of the ``parts`` of a table, which are the values of ``column`` (an integer) it
    may hold; a part of which it has no row is then empty. Without ``parts`` all that it holds are
    replaced, as for the first version. Without ``rebalance`` a task's rows are of few parts already. Returns the
    number of the version."""
    spark = df.sparkSession
    version = max(_versions(spark, root, committed=False), default=0) + 1
    rows = df.hint("rebalance", column) if rebalance else df
    rows.write.mode("errorifexists").partitionBy(column).parquet(f"{root}/version={version}")
    if parts is None:
        written = spark.read.schema(df.schema).parquet(f"{root}/version={version}")
        parts = [r[0] for r in written.select(column).distinct().collect()]
    rows = [(part, column, df.schema.json()) for part in parts]
    spark.createDataFrame(rows, PARTS).coalesce(1).write.mode("overwrite").parquet(f"{root}/parts/version={version}")
    return version


def _read_parts(spark: SparkSession, root: str) -> DataFrame | None:
    """The table replaced by parts below ``root``; None when there is none."""
    versions = _versions(spark, f"{root}/parts", committed=True)
    if not versions:
        return None
    paths = [f"{root}/parts/version={v}" for v in versions]
    noted = spark.read.schema(T.StructType([*PARTS.fields, T.StructField("version", T.IntegerType())])).option("basePath", f"{root}/parts").parquet(*paths)
    newest = noted.groupBy("part").agg(F.max(F.struct("version", "column", "schema")).alias("m")).select("part", "m.*").collect()
    by_version: dict[int, list[int]] = {}
    for row in newest:  # a row per part
        by_version.setdefault(row["version"], []).append(row["part"])
    latest = max(newest, key=lambda row: row["version"])
    column, schema = latest["column"], T.StructType.fromJson(json.loads(latest["schema"]))
    placed = T.StructType([*schema.fields, T.StructField("version", T.IntegerType())])
    rows = spark.read.schema(placed).option("basePath", root).parquet(*[f"{root}/version={v}" for v in sorted(by_version)])
    places = [(F.col("version") == v) & F.col(column).isin(parts) for v, parts in sorted(by_version.items())]
    return rows.filter(reduce(lambda a, b: a | b, places)).select(*[c for c in schema.fieldNames() if c != column])


def read_published(spark: SparkSession, root: str) -> DataFrame:
    by_parts = _read_parts(spark, root)
    if by_parts is not None:
        return by_parts
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing published below {root}")
    return spark.read.parquet(f"{root}/version={version}")


def load_star_schema(tables: dict[str, DataFrame], root: str, replace: bool = False) -> None:
    """Write the tables below ``root``: the dimensions together, then the facts."""

    def write(name: str) -> None:
        tables[name].write.mode("overwrite" if replace else "errorifexists").parquet(f"{root}/{name}")

    for kind in ("dim_", "fact_"):
        names = [n for n in schemas.TABLE_NAMES if n.startswith(kind) and n in tables]
        if names:
            run_together(tables[names[0]].sparkSession, [partial(write, n) for n in names])


def snapshot_tables(tables: dict[str, DataFrame], root: str, label: str) -> DataFrame:
    """Copy tables to ``root/label`` with a manifest of their contents, taken from what was written."""
    spark = next(iter(tables.values())).sparkSession
    base = f"{root}/{label}"
    run_together(
        spark, [partial(df.write.mode("errorifexists").parquet, f"{base}/{n}") for n, df in tables.items()]
    )
    contents({n: spark.read.parquet(f"{base}/{n}") for n in tables}).write.parquet(f"{base}/_manifest")
    return spark.read.parquet(f"{base}/_manifest")


def verify_snapshot(spark: SparkSession, root: str, label: str, names: list[str]) -> DataFrame:
    """(table, rows, intact) of a snapshot: what is there against what was noted, column by column."""
    base = f"{root}/{label}"
    noted = spark.read.parquet(f"{base}/_manifest")
    now = contents({n: spark.read.parquet(f"{base}/{n}") for n in names})
    same = (F.col("n.rows") == F.col("m.rows")) & (F.col("n.checksum") == F.col("m.checksum"))
    both = noted.alias("m").join(now.alias("n"), ["table", "column"], "full")
    return both.groupBy("table").agg(F.max("m.rows").alias("rows"), F.min(F.coalesce(same, F.lit(False))).alias("intact"))


def restore_snapshot(spark: SparkSession, root: str, label: str, names: list[str], target: str) -> DataFrame:
    """Publish every table of a snapshot below ``target``, after checking all of them."""
    # Stored: a caller who reads the report does not have the snapshot verified once more.
    report = materialize(verify_snapshot(spark, root, label, names), "report")
    broken = [row["table"] for row in report.filter(~F.col("intact")).collect()]
    if broken:
        raise ValueError(f"snapshot {label} does not match its manifest: {broken}")
    run_together(
        spark,
        [partial(full_refresh, spark.read.parquet(f"{root}/{label}/{n}"), f"{target}/{n}") for n in names],
    )
    return report
