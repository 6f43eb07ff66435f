"""Delimited and Parquet files."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_line"


def _csv_files(spark: SparkSession, path: str) -> DataFrame:
    """The non-empty ``.csv`` files directly in a directory, without reading them: (file_path)."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    return listing.filter("length > 0").select(F.col("_metadata.file_path").alias("file_path"))


def open_file(path: str):
    """A file opened for reading at any place, by whatever task needs a range of it."""
    from pyarrow import fs

    if re.match(r"(file:)?/", path):
        system, path = fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    else:
        system, path = fs.FileSystem.from_uri(path)
    return system.open_input_file(path)


def _reads_ranges(path: str) -> bool:
    """Whether `open_file` knows the store that a path is in."""
    from pyarrow import fs

    if re.match(r"(file:)?/", path):
        return True
    try:
        fs.FileSystem.from_uri(path)
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def _csv_headers(spark: SparkSession, path: str, skip_unreadable: bool = False) -> DataFrame:
    """The first line of every ``.csv`` file: (file_path, header), without a file that has no readable
    one. Tasks read the first bytes of each file; a store that only Spark can open costs a pass over
    all lines instead."""
    listing = _csv_files(spark, path)
    sample = listing.limit(1).collect()
    if sample and not _reads_ranges(sample[0]["file_path"]):
        return _headers_by_scan(spark, path, skip_unreadable)

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for name in batch.column("file_path").to_pylist():
                try:
                    found.append((name, _first_line(unquote(name))))
                except (OSError, UnicodeDecodeError):
                    if not skip_unreadable:
                        raise
            columns = [pa.array([f[k] for f in found], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["file_path", "header"])

    # Dealt out evenly: a listing may come in a few partitions.
    return listing.repartition("file_path").mapInArrow(first_lines, "file_path string, header string")


def _first_line(path: str, step: int = 4096) -> str:
    held = b""
    with open_file(path) as file:
        while b"\n" not in held:
            more = file.read(step)
            if not more:
                break
            held += more
    return held.split(b"\n", 1)[0].removesuffix(b"\r").decode("utf-8")


def _headers_by_scan(spark: SparkSession, path: str, skip_unreadable: bool) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", "*.csv").option("ignoreCorruptFiles", skip_unreadable)
    lines = reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    return lines.filter("start = 0").groupBy("file_path").agg(F.min_by("value", "at").alias("header"))


def _plain_path(column: str) -> Column:
    """A path as readers take it: the metadata column escapes it as in a URL."""
    return F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B")))


def _by_header(headers: DataFrame, delimiter: str) -> list[tuple[list[str], list[str]]]:
    """(columns, paths) per distinct header. The paths fit the driver, whose file index holds
    them already."""
    grouped: dict[str, list[str]] = {}
    for header, path in headers.select("header", _plain_path("file_path")).toLocalIterator():
        grouped.setdefault(header, []).append(path)
    result = []
    for header, paths in sorted(grouped.items()):
        cells = next(csv.reader([header.lstrip("\ufeff").rstrip("\r")], delimiter=delimiter), [])
        result.append(([cell.strip() for cell in cells], sorted(paths)))
    return result


def _in_file_order(schema: T.StructType, columns: list[str]) -> T.StructType:
    """The schema as a file with these columns has it; a column the schema lacks is text."""
    known = {f.name: f for f in schema}
    return T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in columns])


def _to_schema(df: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    """The columns of the schema, NULL where a file has none."""
    values = [
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ]
    return df.select(*values, *more)


def scan_csv_dir(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    delimiter: str = ",",
    header: bool = True,
    with_origin: bool = False,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """Every ``.csv`` file of a directory as one table. With a header, columns are matched by name, file
    by file: one that a file lacks is NULL, one that the schema lacks is left out. Without a
    schema the types are inferred over all files of a header, which reads the data once more
    (less with ``sampling_ratio``), and the table has the columns of all files."""

    def read(columns: T.StructType | None, paths: list[str]) -> DataFrame:
        reader = (
            spark.read.option("header", header).option("sep", delimiter).option("pathGlobFilter", "*.csv")
        )
        if columns is None:
            reader = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
        else:
            reader = reader.schema(columns)
        df = reader.csv(paths)
        return df.select("*", _plain_path("_metadata.file_name").alias("file_name")) if with_origin else df

    groups = _by_header(_csv_headers(spark, path), delimiter) if header else []
    if len(groups) <= 1 and (not groups or schema is None or groups[0][0] == schema.fieldNames()):
        return read(schema, [path])
    origin = ["file_name"] if with_origin else []
    if schema is None:
        tables = [read(None, paths) for _, paths in groups]
    else:
        tables = [
            _to_schema(read(_in_file_order(schema, columns), paths), schema, *origin) for columns, paths in groups
        ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def scan_csv_quarantine(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantined lines)``: lines that do not fit the schema are set aside, all lines
    of a file whose header has other columns too (in another order they are matched by
    name), and a file that gives no line at all is named with a NULL line, so the rest of the
    directory still loads."""
    with_corrupt = T.StructField(CORRUPT, T.StringType())
    names = schema.fieldNames()
    headers = _csv_headers(spark, path, skip_unreadable=True)
    groups = _by_header(headers, delimiter) if header else [(names, [path])]
    goods, bads = [], []
    for columns, paths in groups:
        if sorted(columns) != sorted(names):
            lines = spark.read.option("ignoreCorruptFiles", True).text(paths)
            bads.append(lines.select(_plain_path("_metadata.file_name").alias("file_name"), F.col("value").alias("line")))
            continue
        df = (
            spark.read.schema(_in_file_order(schema, columns).add(with_corrupt))
            .option("header", header)
            .option("sep", delimiter)
            .option("pathGlobFilter", "*.csv")
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("ignoreCorruptFiles", True)
            .csv(paths)
        )
        # The filters look at every column: a scan which prunes columns does not notice a bad
        # value in one it skips, and Spark refuses to read nothing but the corrupt-line column.
        all_read = F.concat_ws(",", *names) != F.lit("\0")
        goods.append(df.filter(F.col(CORRUPT).isNull() & all_read).select(*names))
        bads.append(
            df.filter(F.col(CORRUPT).isNotNull() & all_read).select(
                _plain_path("_metadata.file_name").alias("file_name"), F.col(CORRUPT).alias("line")
            )
        )
    silent = _csv_files(spark, path).join(headers, "file_path", "left_anti")
    bads.append(
        silent.select(
            F.substring_index(_plain_path("file_path"), "/", -1).alias("file_name"),
            F.lit(None).cast("string").alias("line"),
        )
    )
    good = reduce(DataFrame.unionByName, goods) if goods else spark.createDataFrame([], schema)
    return good, reduce(DataFrame.unionByName, bads)


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def scan_parquet_union(spark: SparkSession, root: str, output: str | None = None) -> DataFrame:
    """All Parquet files below a directory as one table, columns matched by name, those that
    stand in directory names (``k=v``) included. ``output``,
    where the caller is about to write, must lie outside of ``root``."""
    if output is not None and (output.rstrip("/") + "/").startswith(root.rstrip("/") + "/"):
        raise ValueError(f"output {output} lies inside the input {root}")
    folder = F.regexp_replace("path", "/[^/]*$", "")
    table = F.regexp_replace(folder, "/[^/=]+=[^/]*(/[^/=]+=[^/]*)*$", "")
    # One row per table directory; the driver's file index holds every file.
    found = scan_files(spark, root).select(table.alias("table"), (table != folder).alias("cut")).distinct().collect()
    plain = sorted(r.table for r in found if not r.cut)
    # Where a directory has directories of its own, only the files right in it are meant.
    outer = {t for t in plain if any(r.table.startswith(t + "/") or (r.cut and r.table == t) for r in found)}
    paths = [f"{t}/*.parquet" if t in outer else t for t in plain]
    reader = spark.read.option("mergeSchema", True)
    tables = [reader.parquet(*(paths or [root]))] if paths or not found else []
    for at in sorted(r.table for r in found if r.cut):
        tables.append(spark.read.option("mergeSchema", True).option("basePath", at).parquet(f"{at}/*=*"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def scan_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """A directory tree as rows (path, modificationTime, length, content). Selecting without
    ``content`` lists the tree and reads no file."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root)


def relative_path(root: str):
    """The path of a scanned file below ``root``. Both are compared without scheme and
    leading slashes, as file systems spell them differently."""
    bare = F.regexp_replace(F.lit(root.rstrip("/") + "/"), r"^([a-zA-Z0-9+.-]+:)?/+", "")
    path = F.regexp_replace("path", r"^([a-zA-Z0-9+.-]+:)?/+", "")
    return F.when(F.startswith(path, bare), F.substring(path, F.length(bare) + 1, F.length(path))).otherwise(path)
