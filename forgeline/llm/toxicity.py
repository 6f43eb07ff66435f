"""Toxic passages by maximum-scoring segments of token log-odds.

Counts of words in toxic and other labelled documents give log-odds under an informative Dirichlet
prior (Monroe et al., 2008). Words that are significantly more frequent in toxic documents make the
lexicon; every other word has one small negative score, the log-likelihood ratio of being
outside it. The linear-time scan of Ruzzo and Tompa finds all maximal segments of a text. A
segment's expected number among clean texts of that length is K n exp(-lambda s), the
extreme-value law of Karlin and Altschul, with lambda solved from the clean word frequencies and K
fitted to clean texts; all segments add to the document's evidence by how little they are expected, and
isotonic regression over the labelled documents turns evidence into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import by_slices, fold, packed, table, tidy

WORD = re.compile(r"[^\W\d_]+")
#: Segments expected at most so often in a clean text of that length are reported as passages.
E_VALUE = 0.05
THRESHOLD = 0.3


@dataclass(frozen=True)
class Learning:
    prior: float = 0.02  #: share of all occurrences that the corpus frequencies count for besides
    z: float = 3.5  #: deviations above 0 from which a word is in the lexicon
    labelled: int = 20_000  #: documents of each label to learn from at most, by a hash of the id
    steps: int = 200  #: evidence is calibrated in steps of a quarter, up to this many


@dataclass(frozen=True)
class Model:
    scores: dict[str, float]
    other: float  #: score of every word outside the lexicon
    scale: float  #: lambda
    k: float
    evidence: tuple[float, ...] = (0.0,)
    probability: tuple[float, ...] = (0.0,)


_SIDES = [f"{what}{half}{side}" for half in (0, 1) for side in (0, 1) for what in ("docs", "words")]


def _counted(labelled: DataFrame) -> DataFrame:
    """Per word, half of the documents and label: in how many documents it occurs, and how often. Tasks add
    up what they read before it is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}

        def out() -> pa.RecordBatch:
            sides = [pa.array([v[k] for v in found.values()], pa.int64()) for k in range(len(_SIDES))]
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *sides], names=["word", *_SIDES])

        for batch in batches:
            for text, toxic, half in zip(batch.column("text"), batch.column("toxic"), batch.column("half")):
                at = 4 * half.as_py() + 2 * int(toxic.as_py())
                for word, n in Counter(WORD.findall(text.as_py().lower())).items():
                    entry = found.get(word)
                    if entry is None:
                        entry = found[word] = [0] * len(_SIDES)
                    entry[at] += 1
                    entry[at + 1] += n
                if len(found) > 200_000:
                    yield out()
                    found.clear()
        yield out()

    each = labelled.select("text", "toxic", "half").mapInArrow(count, "word string, " + ", ".join(f"{c} bigint" for c in _SIDES))
    return each.groupBy("word").agg(*[F.sum(c).alias(c) for c in _SIDES])


def _lexicon(counts: DataFrame, how: Learning, halves: tuple[int, ...] = (0, 1)) -> Model | None:
    """The words whose documents are toxic significantly more often than others. A word counts once per
    document, so one document that repeats a word does not make it significant."""
    names = {"t": "docs{}1", "o": "docs{}0", "wt": "words{}1", "wo": "words{}0"}
    counts = counts.select("word", *[reduce(lambda a, b: a + b, [F.col(c.format(h)) for h in halves]).alias(n) for n, c in names.items()])
    total = counts.agg(*[F.sum(n).alias(n) for n in names]).first()
    if not total["t"] or not total["o"]:
        return None
    t, o = float(total["t"]), float(total["o"])
    prior = how.prior * (t + o)
    a = how.prior * (F.col("t") + F.col("o"))
    odds = lambda y, n: F.ln((y + a) / (n + prior - y - a))
    rows = counts.where("t + o > 0").withColumn("s", odds(F.col("t"), t) - odds(F.col("o"), o))
    rows = rows.withColumn("z", F.col("s") / F.sqrt(1 / (F.col("t") + a) + 1 / (F.col("o") + a)))
    # As many words as the labelled documents, whose number is bounded, make significant.
    top = rows.where(F.col("z") >= how.z).orderBy("word").collect()
    wt, wo = float(total["wt"]), float(total["wo"])
    scores = {r["word"]: r["s"] for r in top}
    in_t, in_o = sum(r["wt"] for r in top) / wt, sum(r["wo"] for r in top) / wo
    other = min(math.log(max(1 - in_t, 1e-9) / max(1 - in_o, 1e-9)), -1e-3)
    # lambda: the clean words' mean of exp(lambda score) is 1; unseen ones count as half a word.
    weights = [((r["wo"] + 0.5) / (wo + 0.5 * len(top)), r["s"]) for r in top]
    rest = 1 - sum(w for w, _ in weights)

    def excess(x: float) -> float:
        return rest * math.exp(x * other) + sum(w * math.exp(min(x * s, 700)) for w, s in weights) - 1

    low, high = 1e-3, 5.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return Model(scores, other, max(low, 0.05), 1.0)


def _fitted(clean: DataFrame, model: Model) -> Model:
    """The model with K fitted to texts without toxic passages: their segments of at least 1 / lambda are
    expected to be K exp(-1) per word."""
    shared = clean.sparkSession.sparkContext.broadcast(model)

    def tally(texts: list[str]) -> pa.Array:
        model, out = shared.value, []
        for body in texts:
            found = WORD.findall(body.lower())
            scored = [(i, model.scores[w]) for i, w in enumerate(found) if w in model.scores]
            many = sum(s * model.scale >= 1 for *_, s in segments(scored, len(found), model.other))
            out.append({"words": len(found), "segments": many})
        return pa.array(out, pa.struct([("words", pa.int64()), ("segments", pa.int64())]))

    kind = pa.struct([("words", pa.int64()), ("segments", pa.int64())])
    each = clean.select(F.arrow_udf(by_slices(tally, kind), "words bigint, segments bigint")("text").alias("f"))
    sums = each.agg(F.sum("f.words").alias("words"), F.sum("f.segments").alias("segments")).first()
    return replace(model, k=((sums["segments"] or 0) + 0.5) / max(sums["words"] or 0, 1) * math.e)


def segments(scored: list[tuple[int, float]], n: int, other: float) -> list[tuple[int, int, float]]:
    """All maximal segments (first word, end word, score) of n words, of which ``scored`` have
    positive scores and the rest the negative ``other``.

    Ruzzo and Tompa, 1999: candidates are kept with the sums before and after them; a new one is joined
    to the nearest earlier one that starts lower, if that one ends lower too.
    """
    kept: list[tuple[int, int, float, float]] = []
    total, after = 0.0, 0
    for at, score in scored:
        total += other * (at - after)
        first, end, left, right = at, at + 1, total, total + score
        total, after = right, at + 1
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j -= 1
            if j < 0 or kept[j][3] >= right:
                kept.append((first, end, left, right))
                break
            first, left = kept[j][0], kept[j][2]
            del kept[j:]
    return [(first, end, right - left) for first, end, left, right in kept]


PASSAGES = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))
FOUND = pa.struct([("evidence", pa.float64()), ("passages", PASSAGES)])
FOUND_DDL = "evidence double, passages array<struct<first bigint, end bigint, score double, expected double>>"


def scanned(spark: SparkSession, text: Column, model: Model) -> Column:
    """struct<evidence, passages> of a whole text: its significant segments in words, and the sum of
    ln(1 + 1 / expected number) of all segments, to which weak ones add little. Texts without words have
    none and evidence 0."""
    shared = spark.sparkContext.broadcast(model)

    def scan(texts: list[str]) -> pa.Array:
        model, out = shared.value, []
        lookup = model.scores
        for body in texts:
            found = WORD.findall(body.lower())
            scored = [(i, lookup[w]) for i, w in enumerate(found) if w in lookup]
            passages, evidence = [], 0.0
            for first, end, score in segments(scored, len(found), model.other):
                expected = model.k * len(found) * math.exp(-min(model.scale * score, 600))
                evidence += math.log1p(1 / expected)
                if expected <= E_VALUE:
                    passages.append((first, end, score, expected))
            out.append((evidence, passages))
        names = [f.name for f in PASSAGES.value_type]
        return pa.array([{"evidence": e, "passages": [dict(zip(names, p)) for p in ps]} for e, ps in out], FOUND)

    return F.arrow_udf(by_slices(scan, FOUND), FOUND_DDL)(text)


def _isotonic(steps: list[tuple[int, int, int]]) -> list[float]:
    """Pool adjacent violators: (step, toxic, all) in order to probabilities that never fall."""
    pools: list[list[float]] = []
    for _, toxic, total in steps:
        pools.append([toxic, total, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            a, b, c = pools.pop()
            pools[-1] = [pools[-1][0] + a, pools[-1][1] + b, pools[-1][2] + c]
    return [p[0] / p[1] for p in pools for _ in range(int(p[2]))]


def _sample(known: DataFrame, how: Learning) -> DataFrame:
    """At most ``how.labelled`` documents of each label, by a hash of the id."""
    order = [F.xxhash64("id"), F.col("id")]
    sides = [known.where(F.col("toxic") == toxic).orderBy(*order).limit(how.labelled) for toxic in (0, 1)]
    return sides[0].unionByName(sides[1])


def learn(docs: DataFrame, labels: DataFrame, how: Learning = Learning(), teach: Column | None = None) -> Model | None:
    """The model of labelled documents for which ``teach`` holds (over ``id``); None without toxic or
    without other words. A document is toxic if any of its labels says so.

    Evidence is calibrated on each half of the documents by a lexicon of the other half, so that words
    which are significant by chance do not count as evidence there.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    known = known.where(teach) if teach is not None else known
    rows = packed(docs, id="doc_id:bigint", text="text").drop("row").where(F.col("text").isNotNull())
    # The sample's size is bounded; the texts stay where they are.
    taken = rows.join(F.broadcast(_sample(known, how)), "id")
    half = F.pmod(F.xxhash64(F.lit(3), F.col("id")), F.lit(2)).cast("int").alias("half")
    labelled = materialize(taken.select("text", "toxic", half), "toxic-labelled")
    counts = materialize(_counted(labelled), "toxic-words")
    model = _lexicon(counts, how)
    if model is None:
        return None
    clean = labelled.where("toxic = 0")
    model = _fitted(clean, model)
    tallies: dict[int, list[int]] = {}
    for own in (0, 1):
        judge = _lexicon(counts, how, (1 - own,))
        judge = _fitted(clean.where(F.col("half") == 1 - own), judge) if judge else model
        evidence = scanned(docs.sparkSession, F.col("text"), judge)
        step = F.least(F.ceil(F.col("f.evidence") * 4), F.lit(how.steps))
        sums = (
            labelled.where(F.col("half") == own)
            .select("toxic", evidence.alias("f"))
            .groupBy(step.alias("step"))
            .agg(F.sum("toxic").alias("toxic"), F.count("*").alias("total"))
        )
        for r in sums.collect():  # one row per step
            found = tallies.setdefault(r["step"], [0, 0])
            found[0] += r["toxic"]
            found[1] += r["total"]
    counted = [(step, *tallies[step]) for step in sorted(tallies)]
    return replace(model, evidence=tuple(step / 4 for step, *_ in counted), probability=tuple(_isotonic(counted)))


def scored(docs: DataFrame, model: Model | None, text: str = "text", doc_id: str = "doc_id", keep_rows: bool = True) -> DataFrame:
    """Every document (``row``, or only ``id``) with score, passages and predicted.

    Null and empty texts, and all texts when there is no model, have no passages; they score as
    texts without evidence, or 0. Repeated rows score alike. An empty table gives no rows.
    """
    base = packed(docs, id=f"{doc_id}:bigint", text=text)
    base = base if keep_rows else base.drop("row")
    model = model or Model({}, -1.0, 1.0, 1.0)
    spark = docs.sparkSession
    rows = base.withColumn("f", scanned(spark, F.col("text"), model)).drop("text").select("*", "f.*").drop("f")
    score = F.lit(model.probability[0])
    for k in range(1, len(model.evidence)):  # linear between the calibrated steps
        low, high = model.evidence[k - 1], model.evidence[k]
        part = (F.col("evidence") - low) / (high - low) * (model.probability[k] - model.probability[k - 1])
        score = F.when(F.col("evidence") > low, model.probability[k - 1] + F.least(part, F.lit(model.probability[k] - model.probability[k - 1]))).otherwise(score)
    rows = rows.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), score.cast("double"))))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    tidy(spark)
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"), teach=fold(F.col("id"), 4) != 2)
    rows = scored(docs, model, keep_rows=False)
    return rows.select(
        F.col("id").alias("doc_id"), (fold(F.col("id"), 4) == 2).alias("held_out"), "score", "predicted", F.size("passages").alias("passages")
    )
