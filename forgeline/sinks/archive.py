"""Keep a copy of every input file, once, whatever its size.

Layout below the archive: ``files/run=N`` holds the files of a run as rows (name, chunk, chunks, length,
modificationTime, content), ``reports/run=N`` what the run did with each file. The report is written last: a
run without one does not count, and the next run takes its number and writes over it.

Files of at most a chunk are read by Spark, larger ones in ranges by the tasks, one range at a time. Nothing
is opened before it is known to be new.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.files import open_file, relative_path, scan_files

#: Bytes of a chunk.
CHUNK = 64 << 20
FILES = "name string, chunk bigint, chunks bigint, length bigint, modificationTime timestamp, content binary"


def archive_new_files(spark: SparkSession, root: str, archive: str, chunk: int = CHUNK) -> DataFrame:
    """Add the files below ``root`` which the archive does not hold yet, by relative path, and report
    every file as ``archived`` or ``kept`` (there before). Spark lists no empty files, so these are left out."""
    runs = _runs(spark, archive)
    run = max(runs, default=0) + 1
    listing = scan_files(spark, root).select("path", "length", "modificationTime", relative_path(root).alias("name"))
    known = _names(spark, archive, runs).withColumn("_known", F.lit(True))
    status = F.when(F.col("_known"), "kept").otherwise("archived")
    found = materialize(listing.join(known, "name", "left").withColumn("status", status).drop("_known"), "listing")
    new = found.filter("status = 'archived'")
    chunks = F.greatest(F.ceil(F.col("length") / chunk), F.lit(1)).cast("bigint")
    whole = _read_whole(spark, new.filter(F.col("length") <= chunk), root)
    ranges = new.filter(F.col("length") > chunk).withColumn("chunks", chunks)
    ranges = ranges.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    parts = _read_ranges(ranges.select("path", "name", "chunk", "chunks", "length", "modificationTime"), chunk)
    whole.unionByName(parts).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{archive}/files/run={run}")
    found.select("name", "length", "status").write.mode("overwrite").parquet(f"{archive}/reports/run={run}")
    return spark.read.parquet(f"{archive}/reports/run={run}")


def read_archive(spark: SparkSession, archive: str) -> DataFrame:
    """The chunks of all archived files."""
    return _files(spark, archive, _runs(spark, archive))


def _files(spark: SparkSession, archive: str, runs: list[int]) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], FILES)
    return spark.read.schema(FILES).parquet(*[f"{archive}/files/run={run}" for run in runs])


def _names(spark: SparkSession, archive: str, runs: list[int]) -> DataFrame:
    return _files(spark, archive, runs).filter("chunk = 0").select("name")


def _runs(spark: SparkSession, archive: str) -> list[int]:
    """The runs whose report is there."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{archive}/reports/run=*/_SUCCESS")
    system = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in system.globStatus(pattern) or [])


def _read_whole(spark: SparkSession, new: DataFrame, root: str) -> DataFrame:
    # Only the new files are listed for reading; the scan's file index has held every path already.
    paths = [re.sub(r"([\\*?\[\]{}])", r"\\\1", row["path"]) for row in new.select("path").toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], FILES)
    one = F.lit(1).cast("bigint")
    files = spark.read.format("binaryFile").load(paths)
    return files.select(relative_path(root).alias("name"), (one - 1).alias("chunk"), one.alias("chunks"), "length", "modificationTime", "content")


def _read_ranges(ranges: DataFrame, chunk: int) -> DataFrame:
    """The bytes of each (path, chunk). Ranges are dealt out evenly, whatever files they are of."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                path, first = row.column("path")[0].as_py(), row.column("chunk")[0].as_py() * chunk
                with open_file(path) as file:
                    content = file.read_at(min(chunk, row.column("length")[0].as_py() - first), first)
                names = [c for c in row.schema.names if c != "path"]
                yield pa.RecordBatch.from_arrays(
                    [*[row.column(c) for c in names], pa.array([content], pa.binary())], names=[*names, "content"]
                )

    return ranges.repartition("path", "chunk").mapInArrow(read, FILES)


def line_breaks(content: Column) -> Column:
    """How many line breaks some bytes hold."""
    text = F.decode(content, "ISO-8859-1")
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
