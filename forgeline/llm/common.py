"""Words, folds and row packing shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space and the ASCII controls 09 to 0D.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Texts are worked on in slices of about this many characters, so that a task's memory
#: follows its largest text and not the number of rows in an Arrow batch.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB in this session: a batch is held on both sides of the pipe to
    Python, several times over while it grows, and Spark's own bound is 64 MB."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def tidy(spark: SparkSession) -> None:
    """Shuffle files go when the job that wrote them ends, and Arrow batches are small. For operators
    that write what they use again, so that no later job needs the shuffles of an earlier one."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    small_batches(spark)


def words(text: Column) -> Column:
    """The words of a text; none for null and blank texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; a null id counts as an empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def packed(docs: DataFrame, **columns: str) -> DataFrame:
    """The rows of ``docs`` as one struct ``row`` beside the named columns.

    Whatever other columns the input has, their names can then meet none of an operator's.
    A column that the input lacks is null.
    """
    have = set(docs.columns)
    picked = [
        (F.col(f"`{source}`") if source in have else F.lit(None).cast(kind)).alias(name)
        for name, (source, kind) in ((n, (c.split(":") + ["string"])[:2]) for n, c in columns.items())
    ]
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *picked)


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def slices(texts: pa.Array, chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """The texts of an Arrow array, null as empty, in lists of about ``chars`` characters."""
    held: list[str] = []
    size = 0
    for value in texts:
        text = value.as_py() or ""
        held.append(text)
        size += len(text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def by_slices(function: Callable[[list[str]], pa.Array], empty: pa.DataType) -> Callable[[pa.Array], pa.Array]:
    """An Arrow function over an array of texts from one over a list of texts."""

    def call(texts: pa.Array) -> pa.Array:
        parts = [function(part) for part in slices(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], empty)

    return call
