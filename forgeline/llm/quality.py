"""Quality rules: learned decision lists over document statistics, as Spark expressions.

The statistics of a text are DataFrame expressions. From labelled rows, sequential covering
grows one conjunction of thresholds after the other for the rejected class (the condition with
the best FOIL gain each time), prunes it on rows held back for that, and stops when no rule
is precise enough. What comes out is an ordered list of conditions, used as one CASE expression.

The driver sees histograms only: for each statistic, the labelled rows per threshold bin
and class. Their size depends on the number of thresholds and not on the rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import fold, packed, table, unpacked, words

#: Base rules: fewer words, or a larger percentage of them in repeated windows, fail.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
#: Bits for a window's place within its text.
INDEX_BITS = 12

#: Statistics the rules may use, by name, from the base columns and a few more counts.
STATISTICS = {
    "symbol_share": ("n_symbols", "word_chars"),
    "upper_share": ("n_upper", "word_chars"),
    "duplicate_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "word_length": ("word_chars", "n_words"),
    "line_words": ("n_words", "n_lines"),
}


@dataclass(frozen=True)
class Learning:
    """Parameters of the rule learner."""

    thresholds: int = 31  #: cut points per statistic and class, at its quantiles
    max_conditions: int = 4
    max_rules: int = 12
    min_covered: int = 5  #: rejected rows of the growing part that a rule has to cover
    min_precision: float = 0.95  #: share of rejected rows among those a rule covers, on the pruning part
    prune_folds: int = 3  #: every third labelled row prunes


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    covered: int  #: rejected rows of the pruning part it covers
    wrong: int  #: other rows of the pruning part it covers

    def column(self) -> Column:
        out = F.lit(True)
        for condition in self.conditions:
            out = out & condition.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def _outside(text: Column, characters: str) -> Column:
    """How many characters of the class occur."""
    return (F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", ""))).cast("bigint")


def text_statistics(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with the counts of their texts in place of the column ``text``.

    A null text counts as empty. Words of repeated windows are found by sorting the text's own
    window hashes (64 bits), so a text of n words takes n log n and no shuffle; texts in which all
    windows differ are not sorted.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("w", words(body)).withColumn("lines", lines)
    rows = rows.withColumn("n_words", F.size("w").cast("bigint"))
    rows = rows.select(
        "*",
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        _outside(body, "#*$%&|<>").alias("n_symbols"),
        _outside(body, "A-Z").alias("n_upper"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")),
                lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]),
            ),
        ).alias("windows"),
    ).drop(text, "w", "lines")
    # Up to 2^INDEX_BITS windows, hash and place share one long, and longs sort several times
    # faster than structs; 64 - INDEX_BITS bits tell the windows of such a text apart.
    low = (1 << INDEX_BITS) - 1
    short = F.size("windows") <= low + 1
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    in_one = F.sort_array(F.transform("windows", lambda h, i: h.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("bigint"))))
    in_two = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("repeats", repeats).select(
        "*", F.when(F.col("repeats") & short, in_one).alias("longs"), F.when(F.col("repeats") & ~short, in_two).alias("pairs")
    ).drop("windows", "repeats")

    def start_of_long(x: Column, k: Column) -> Column:
        same = lambda other: F.shiftright(other, INDEX_BITS) == F.shiftright(x, INDEX_BITS)
        return F.when(same(F.get("longs", k - 1)) | same(F.get("longs", k + 1)), x.bitwiseAND(F.lit(low)).cast("int"))

    def start_of_pair(x: Column, k: Column) -> Column:
        return F.when((F.get("pairs", k - 1)["h"] == x["h"]) | (F.get("pairs", k + 1)["h"] == x["h"]), x["i"])

    starts = F.coalesce(F.transform("longs", start_of_long), F.transform("pairs", start_of_pair))
    rows = rows.withColumn("starts", F.array_compact(starts)).drop("longs", "pairs")
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda i: F.array(*[i + k for k in range(WINDOW)]))))
    rows = rows.withColumn("n_repeat_words", F.coalesce(F.size(covered), F.lit(0)).cast("bigint")).drop("starts")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    shares = [(F.col(a) / F.greatest(F.col(b), F.lit(1))).alias(name) for name, (a, b) in STATISTICS.items()]
    return rows.select("*", failed.alias("base_failed"), *shares)


def _labelled(statistics: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of labelled rows that pass the base rules, with ``rejected`` and the part
    they belong to. A document is rejected if any of its labels says quality 0."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg((F.min("quality") == 0).alias("rejected"))
    )
    rows = statistics.where(~F.col("base_failed")).join(known, F.col("id") == F.col("label_id"))
    return rows.select(*STATISTICS, "rejected", fold(F.col("id"), Learning.prune_folds).alias("part"))


def _thresholds(rows: DataFrame, how: Learning) -> dict[str, list[float]]:
    points = [k / (how.thresholds + 1) for k in range(1, how.thresholds + 1)] + [0.0, 1.0]
    asked = [
        F.percentile_approx(F.when(F.col("rejected") == side, F.col(s)), points, 10000).alias(f"{s}:{side}")
        for s in STATISTICS
        for side in (True, False)
    ]
    found = rows.agg(*asked).first()
    return {s: sorted({float(v) for side in (True, False) for v in found[f"{s}:{side}"] or []}) for s in STATISTICS}


def learn(statistics: DataFrame, labels: DataFrame, how: Learning = Learning()) -> list[Rule]:
    """The decision list for ``statistics`` (of ``text_statistics``, with the column ``id``).

    Without labelled rows of both classes the list is empty.
    """
    rows = materialize(_labelled(statistics, labels), "quality-labelled")
    cuts = _thresholds(rows, how)
    # The bin of a value is the number of thresholds below it: "<= cuts[k]" holds for bins up to k.
    def bin_of(i: int, s: str) -> Column:
        below = F.filter(F.array(*[F.lit(c) for c in cuts[s]]).cast("array<double>"), lambda c: c < F.col(s))
        return F.struct(F.lit(i).alias("s"), F.size(below).alias("bin"))

    bins = F.array(*[bin_of(i, s) for i, s in enumerate(STATISTICS)])
    binned = materialize(rows.withColumn("bins", bins), "quality-bins")
    grown, pruned = binned.where(F.col("part") != 0), binned.where(F.col("part") == 0)
    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < how.max_rules:
        conditions = _grow(grown.where(left), cuts, how)
        rule = _prune(pruned.where(left), conditions) if conditions else None
        if rule is None or (rule.covered + 1) < how.min_precision * (rule.covered + rule.wrong + 1):
            break
        rules.append(rule)
        left = left & ~rule.column()
    return rules


def _grow(rows: DataFrame, cuts: dict[str, list[float]], how: Learning) -> list[Condition]:
    """Conditions added one at a time, each with the best FOIL gain over what is covered so far."""
    conditions: list[Condition] = []
    while len(conditions) < how.max_conditions:
        counts = (
            rows.select("rejected", F.explode("bins").alias("b"))
            .groupBy("b.s", "b.bin")
            .agg(F.count_if("rejected").alias("p"), F.count_if(~F.col("rejected")).alias("n"))
            .collect()  # thresholds x statistics rows at most
        )
        names = list(STATISTICS)
        table_of = {s: [[0, 0] for _ in range(len(cuts[s]) + 1)] for s in names}
        for r in counts:
            table_of[names[r["s"]]][r["bin"]] = [r["p"], r["n"]]
        p0, n0 = (sum(x[k] for x in table_of[names[0]]) for k in (0, 1))
        if p0 < how.min_covered or n0 == 0:
            break
        best, gain = None, 1e-9
        for s in names:
            p, n = 0, 0
            for k, cut in enumerate(cuts[s]):
                p, n = p + table_of[s][k][0], n + table_of[s][k][1]
                for above, (a, b) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                    if a < how.min_covered or a + b == p0 + n0:
                        continue
                    value = a * (math.log2(a / (a + b)) - math.log2(p0 / (p0 + n0)))
                    if value > gain:
                        best, gain = Condition(s, above, cut), value
        if best is None:
            break
        conditions.append(best)
        rows = rows.where(best.column())
    return conditions


def _prune(rows: DataFrame, conditions: list[Condition]) -> Rule | None:
    """The shortest beginning of the conditions that does best on rows it was not grown on."""
    begins = [Rule(tuple(conditions[: k + 1]), 0, 0) for k in range(len(conditions))]
    asked = []
    for k, rule in enumerate(begins):
        asked += [F.count_if(rule.column() & F.col("rejected")).alias(f"p{k}"), F.count_if(rule.column() & ~F.col("rejected")).alias(f"n{k}")]
    found = rows.agg(*asked).first()
    best = None
    for k, rule in enumerate(begins):
        p, n = found[f"p{k}"], found[f"n{k}"]
        value = (p - n) / (p + n) if p + n else -1.0
        if p and (best is None or value > best[0]):
            best = (value, Rule(rule.conditions, p, n))
    return best[1] if best else None


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """``kept`` and the 1-based number of the rule that rejects (null if none does), as ordered
    conditions over the statistics."""
    kept, number = F.when(F.col("base_failed"), False), F.when(F.col("base_failed"), 0)
    for k, rule in enumerate(rules, 1):
        kept, number = kept.when(rule.column(), False), number.when(rule.column(), k)
    return kept.otherwise(True), number


def judged(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", keep_rows: bool = True) -> DataFrame:
    """Every document with its statistics, ``base_failed``, ``kept`` and ``rule``.

    With ``keep_rows`` the whole input row is in ``row``, else only ``id``. Null and empty
    texts have no words and fail the base rules. Rows without an id are judged like others and never
    teach. Repeated rows are judged alike. Without usable labels the base rules alone
    decide. An empty table gives no rows.
    """
    base = packed(docs, id=f"{doc_id}:bigint", text=text)
    # Texts are counted once, and only numbers are joined to the labels.
    statistics = materialize(text_statistics(base if keep_rows else base.drop("row")), "quality-statistics")
    kept, number = verdict(learn(statistics, labels))
    return statistics.withColumn("kept", kept).withColumn("rule", number)


def good_documents(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents the rules keep, with the columns of ``docs``."""
    return unpacked(judged(docs, labels, text, doc_id).where("kept"))


def op6(spark, sf_dir: str) -> DataFrame:
    rows = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep_rows=False)
    return rows.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule",
    )
