"""Mixing sources to target weights by exponential-key sampling without replacement.

Every document gets the key ``-ln(u) / weight`` (Efraimidis and Spirakis), with ``u`` drawn
from its id and ``weight`` from its quality. A source whose target is e times its size and a
rest takes every document e times (complete epochs); the rest goes to its documents in the
order of their keys, up to the budget of words, the last of them in part.

A source may hold a third of all rows, so nothing sorts a whole source. Keys are cut into
buckets whose word sums are aggregated on the map side; only the one bucket in which a
source's budget ends is sorted, and a source's decision comes down to one row: epochs, bucket,
key, id and share of the document at the cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import packed, unpacked, words

#: Weights dealt to the sources by name, again and again.
WEIGHTS = (5, 2, 1)
#: The mix as a share of all words, in halves: 3 stands for 150 %.
HALVES = 3
#: No source gives more than this many times its words.
MOST_EPOCHS = 2
#: Key buckets of a source. Of 10^10 documents about 10^6 are sorted for the cut.
BUCKETS = 16384
#: Characters that count against a document's quality.
SYMBOLS = "#*$%&|<>"
#: By byte: 1 for a gap between words, 2 for a symbol.
KINDS = np.zeros(256, np.uint8)
KINDS[[0x20, *range(0x09, 0x0E)]] = 1
KINDS[[ord(c) for c in SYMBOLS]] = 2
COUNTS = pa.struct([("words", pa.int64()), ("symbols", pa.int64())])


def _counts(texts: pa.Array) -> pa.Array:
    """Words and symbols of the texts, counted on the bytes of the Arrow buffer. The characters
    that matter are ASCII, which never occurs inside a longer UTF-8 character."""
    n = len(texts)
    if not n:
        return pa.array([], COUNTS)
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    kinds = KINDS[data]
    starts = kinds != 1  # neither a gap nor after a character of the same text that is none
    starts[1:] &= kinds[:-1] == 1
    firsts = (ends[:-1] - ends[0])[ends[1:] > ends[:-1]]
    starts[firsts] = kinds[firsts] != 1

    def per_text(flags: np.ndarray) -> pa.Array:
        at = np.flatnonzero(flags)
        return pa.array(np.diff(np.searchsorted(at, ends - ends[0])), pa.int64())

    return pa.StructArray.from_arrays([per_text(starts), per_text(kinds == 2)], fields=list(COUNTS))


def quality_weight(size: Column, symbols: Column) -> Column:
    """Words over words and ten times the symbols: 1 for plain text, near 0 for symbol junk."""
    return F.when(size > 0, size / (size + 10 * symbols)).otherwise(F.lit(1.0))


def uniform(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in (0, 1) from 52 bits of the MD5 of seed and id; rows without an id use their text."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), text, F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) to (source, source_size, target): one row per source.

    Water filling: with the sources in the order of cap over weight, a source is held at its
    cap when its share of what is left would be above it, and the held ones are the first of
    that order. All sums are integers; the division comes last. The windows see one row per
    source, which is the configuration of the mix and not its data.
    """
    named = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weights = F.array(*[F.lit(w).cast("bigint") for w in WEIGHTS])
    rows = sizes.select("source", "source_size", F.get(weights, (F.row_number().over(named) - 1) % len(WEIGHTS)).alias("w"))
    filled = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*",
        F.sum("source_size").over(everything).alias("all_size"),
        F.sum("w").over(everything).alias("all_w"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w_before"),
    )
    cap = 2 * MOST_EPOCHS
    rows = rows.withColumn(
        "held",
        cap * F.col("source_size") * (F.col("all_w") - F.col("w_before"))
        < (HALVES * F.col("all_size") - cap * F.col("size_before")) * F.col("w"),
    )
    rows = rows.select(
        "*",
        F.coalesce(F.sum(F.when(F.col("held"), F.col("source_size"))).over(everything), F.lit(0)).alias("held_size"),
        F.coalesce(F.sum(F.when(F.col("held"), F.col("w"))).over(everything), F.lit(0)).alias("held_w"),
    )
    shared = (HALVES * F.col("all_size") - cap * F.col("held_size")) * F.col("w")
    target = F.when(F.col("held"), (MOST_EPOCHS * F.col("source_size")).cast("double")).otherwise(
        shared.cast("double") / (2 * (F.col("all_w") - F.col("held_w"))).cast("double")
    )
    return rows.select("source", "source_size", target.alias("target"))


def _cuts(keyed: DataFrame) -> DataFrame:
    """One row per source: where its order of keys ends."""
    sums = materialize(keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    goal = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    goal = goal.withColumn("epochs", epochs).withColumn(
        "rest", (F.floor("target") - F.col("epochs") * F.col("source_size")).cast("bigint")
    )
    goal = materialize(goal, "mix-targets")
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    at = sums.withColumn("upto", F.sum("words").over(upto)).withColumnRenamed("source", "s")
    ends = at.join(goal.withColumnRenamed("source", "g"), F.col("s").eqNullSafe(F.col("g"))).where(
        (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest")) & (F.col("words") > 0)
    )
    ends = ends.select("s", F.col("bucket").alias("b"), (F.col("rest") - F.col("upto") + F.col("words")).alias("left"))
    # The rows of the bucket at the end, equal rows as one, in the order of their keys.
    inside = keyed.join(ends, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    groups = inside.groupBy("s", "b", "left", "key", "id", "size").agg(F.count("*").alias("n"))
    order = Window.partitionBy("s").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    groups = groups.withColumn("upto", F.sum(F.col("size") * F.col("n")).over(order))
    of_group = F.col("size") * F.col("n")
    cut = groups.where((F.col("upto") > F.col("left")) & (F.col("upto") - of_group <= F.col("left")) & (of_group > 0)).select(
        "s",
        F.col("b").alias("cut_bucket"),
        F.struct("key", "id", "size").alias("cut"),
        F.floor((F.col("left") - F.col("upto") + of_group) / F.col("n")).cast("bigint").alias("part"),
    )
    return materialize(goal.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "mix-cuts")


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", seed: str = "mix-1:") -> DataFrame:
    """Every row of ``docs`` as ``row`` with size, source_size, target and taken.

    ``taken`` is the number of words the mix takes of the row: ``taken div size`` whole copies
    and a part of ``taken mod size`` words. It never exceeds twice the size, and a source's
    words come to its target rounded down (equal rows at the cut share the rest, rounded down
    each).

    Null and blank texts have size 0 and are taken 0 times; a source without words has target
    0. A null source is a source of its own, after all others. Rows without an id draw from
    their text; repeated rows draw the same key and are treated alike. An empty table gives no
    rows. Extra columns stay in ``row``.
    """
    base = packed(docs, id=f"{doc_id}:string", text=text, source=source)
    count = F.arrow_udf(_counts, "words bigint, symbols bigint")
    base = base.withColumn("counts", count("text")).withColumn("size", F.col("counts.words"))
    key = -F.ln(uniform(F.col("id"), F.col("text"), seed)) / quality_weight(F.col("size"), F.col("counts.symbols"))
    base = base.select("row", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "source", "size", key.alias("key"))
    base = base.withColumn("bucket", F.floor(F.col("key") / (F.col("key") + 1) * BUCKETS).cast("int"))
    keyed = materialize(base.select("id", "source", "size", "key", "bucket"), "mix-keys")
    cuts = _cuts(keyed).withColumnRenamed("source", "s")
    joined = base.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left")
    here, cut = F.struct("key", "id", "size"), F.col("cut")
    extra = (
        F.when(cut.isNull(), F.lit(0))
        .when((F.col("bucket") < F.col("cut_bucket")) | ((F.col("bucket") == F.col("cut_bucket")) & (here < cut)), F.col("size"))
        .when((F.col("bucket") == F.col("cut_bucket")) & (here == cut), F.col("part"))
        .otherwise(F.lit(0))
    )
    # A source that takes all of its rest has epochs only; then nothing lies past the cut.
    return joined.select("row", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + extra).alias("taken"))


def mixed_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: whole copies as the rows they are, the part at a cut with its first words
    joined by spaces. Columns are those of ``docs``; rows taken 0 times are left out."""
    rows = mix(docs, text).where(F.col("taken") > 0)
    whole, part = F.floor(F.col("taken") / F.col("size")).cast("int"), F.col("taken") % F.col("size")
    copies = F.sequence(F.lit(1), whole + F.when(part > 0, 1).otherwise(0))
    rows = rows.withColumn("whole", whole).withColumn("part", part.cast("int")).withColumn("copy", F.explode(copies))
    body = F.col("row").getField(text)
    cut = F.array_join(F.slice(words(body), F.lit(1), F.greatest(F.col("part"), F.lit(1))), " ")
    changed = F.when(F.col("copy") > F.col("whole"), cut).otherwise(body)
    return unpacked(rows.withColumn("row", F.col("row").withField(f"`{text}`", changed)))


def op5(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every document."""
    return mix(docs).select(F.col("row.doc_id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


#: The same by whole-table windows.
OP5_SQL = f"""
WITH d AS (
  SELECT doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]+', '', 'g')) AS symbols
  FROM documents
), k AS (
  SELECT *, -ln((('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, text, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
      / {1 << 52}::DOUBLE)
    / (CASE WHEN size > 0 THEN size::DOUBLE / (size + 10 * symbols) ELSE 1.0 END) AS key
  FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w
  FROM k GROUP BY source
), f AS (
  SELECT *, sum(source_size) OVER () AS all_size, sum(w) OVER () AS all_w,
    coalesce(sum(source_size) OVER before, 0) AS size_before, coalesce(sum(w) OVER before, 0) AS w_before
  FROM s WINDOW before AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), h AS (
  SELECT *, 4 * source_size * (all_w - w_before) < (3 * all_size - 4 * size_before) * w AS held FROM f
), g AS (
  SELECT source, source_size, CASE WHEN held THEN (2 * source_size)::DOUBLE ELSE
    ((3 * all_size - 4 * coalesce(sum(source_size) FILTER (held) OVER (), 0)) * w)::DOUBLE
    / (2 * (all_w - coalesce(sum(w) FILTER (held) OVER (), 0)))::DOUBLE END AS target
  FROM h
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM g
), r AS (
  SELECT k.doc_id, k.source, k.size, e.source_size, e.target, e.epochs,
    (floor(e.target) - e.epochs * e.source_size)::BIGINT AS rest,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, coalesce(k.doc_id::VARCHAR, ''), k.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, source, size, source_size, target,
  (epochs * size + greatest(0, least(size, rest - done)))::BIGINT AS taken
FROM r
"""
