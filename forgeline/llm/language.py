"""Language identification with a blended-spectrum string kernel.

A text is cut into windows. A window's features say which character n-grams of 1 to 4 letters
occur in it (presence, not counts), hashed to a fixed number of places and scaled to length one;
a text's features are the mean over its windows, scaled again. The kernel of two texts is their
inner product. Nyström landmarks are texts of a bounded sample; kernel ridge regression, one
class against the rest, is solved in their span on the driver. Scoring multiplies batches of
feature rows with the landmarks and their weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_slices, fold, packed, unpacked

UNKNOWN = "und"


@dataclass(frozen=True)
class Kernel:
    """Parameters of features and learner."""

    places: int = 4096
    longest: int = 4  #: letters of an n-gram
    window: int = 1024  #: code points
    per_language: int = 1000  #: expected documents of each language in the sample
    landmarks: int = 160  #: over all languages
    ridge: float = 1e-3


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    landmarks: np.ndarray  #: landmark features, one row each
    weights: np.ndarray  #: landmarks x languages


_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter; built once per process."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def features(texts: list[str], how: Kernel) -> tuple[np.ndarray, np.ndarray]:
    """One row of features per text, and whether the text has a letter."""
    points = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    out, lettered = np.zeros((len(texts), how.places), np.float32), np.zeros(len(texts), bool)
    is_letter = letters()
    for k, whole in enumerate(points):
        known = is_letter[np.minimum(whole, 0x10FFFF)]
        lettered[k] = known.any()
        if not lettered[k]:
            continue
        # Everything but letters is a gap, and gaps in a row are one.
        cleaned = np.where(known, whole, 32).astype(np.uint64)
        cleaned = cleaned[np.r_[True, known[1:] | known[:-1]]]
        total, windows = out[k], -(-len(cleaned) // how.window)
        for first in range(0, windows, 256):
            part = cleaned[first * how.window : (first + 256) * how.window + how.longest - 1]
            many = min(256, windows - first)
            present = np.zeros((many, how.places), np.float32)
            code = np.zeros(len(part), np.uint64)
            for n in range(1, how.longest + 1):
                code = code[: len(part) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1 :]
                starts = code[: many * how.window]
                hashed = (starts * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - how.places.bit_length() + 1)
                present.reshape(-1)[np.arange(len(starts)) // how.window * how.places + hashed.astype(np.int64)] = 1
            total += (present / np.sqrt(np.maximum(present.sum(1, keepdims=True), 1))).sum(0)
        total /= np.linalg.norm(total)
    return out, lettered


def _sample(docs: DataFrame, lang: str, doc_id: str, text: str, how: Kernel) -> DataFrame:
    """About ``per_language`` documents of each language, by a hash of their id."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id), F.lit("landmarks")).alias("h")
    )
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()  # one row per language
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], min(1.0, how.per_language / r["n"])).otherwise(share)
    unit = F.pmod("h", F.lit(1 << 20)) / float(1 << 20)
    return rows.where(unit < share)


def learn(docs: DataFrame, how: Kernel = Kernel(), text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model | None:
    """The model of labelled ``docs``; None if no text with a letter has a language.

    What comes to the driver is bounded by the parameters times the number of languages: the
    features of the landmarks, and one row of kernel values per sampled document.
    """
    sample = _sample(docs, lang, doc_id, text, how).persist()
    try:
        languages = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
        if not languages:
            return None
        each = max(1, how.landmarks // len(languages))
        ranked = sample.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text")))
        wanted = ranked.where(F.col("k") <= each)

        def rows_of(texts: list[str]) -> pa.Array:
            found, lettered = features(texts, how)
            return pa.array([f.tobytes() if ok else None for f, ok in zip(found, lettered)], pa.binary())

        got = wanted.select("lang", "k", F.arrow_udf(by_slices(rows_of, pa.binary()), "binary")("text").alias("f"))
        marks = [np.frombuffer(r["f"], np.float32) for r in sorted(got.collect(), key=lambda r: (r["lang"], r["k"])) if r["f"]]
        if not marks:
            return None
        marks = np.unique(np.stack(marks), axis=0)

        def kernel_rows(texts: list[str]) -> pa.Array:
            found, lettered = features(texts, how)
            values = found @ marks.T
            return pa.array([v.tobytes() if ok else None for v, ok in zip(values, lettered)], pa.binary())

        taught = sample.select("lang", "h", F.arrow_udf(by_slices(kernel_rows, pa.binary()), "binary")("text").alias("k"))
        taught = sorted(((r["lang"], r["h"], bytes(r["k"])) for r in taught.collect() if r["k"]))
    finally:
        sample.unpersist()
    kernel = np.stack([np.frombuffer(k, np.float32) for _, _, k in taught]).astype(float)
    which = np.array([languages.index(lang) for lang, _, _ in taught])
    # Nyström: features K_nm W^(-1/2), where W is the kernel of the landmarks.
    values, vectors = np.linalg.eigh(marks.astype(float) @ marks.T)
    root = vectors / np.sqrt(np.maximum(values, 1e-6 * values[-1]))
    mapped = kernel @ root
    # Each language weighs the same, however many documents it has.
    weight = 1 / np.bincount(which, minlength=len(languages))[which]
    goal = np.where(which[:, None] == np.arange(len(languages)), 1.0, -1.0)
    normal = mapped.T @ (mapped * weight[:, None]) + how.ridge * np.eye(mapped.shape[1])
    weights = root @ np.linalg.solve(normal, mapped.T @ (goal * weight[:, None]))
    return Model(tuple(languages), marks, weights.astype(np.float32))


def predicted(spark: SparkSession, text: Column, model: Model | None, how: Kernel = Kernel()) -> Column:
    """struct<lang string, score double> of a whole text.

    ``score`` is (f + 1) / 2 of the largest of the regressions f, cut to 0 to 1: 0.5 is the border
    between the language and all others. Null texts, texts without a letter, and all texts
    when there is no model are ``und`` with score 0.
    """
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])
    shared = spark.sparkContext.broadcast(model)  # landmarks x places floats, 2.6 MB as set

    def predict(texts: list[str]) -> pa.Array:
        model = shared.value
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for first in range(0, len(texts) if model else 0, 1024):
            rows, lettered = features(texts[first : first + 1024], how)
            value = (rows @ model.landmarks.T) @ model.weights
            best = value.argmax(1)
            top = np.clip((value[np.arange(len(best)), best] + 1) / 2, 0, 1)
            for i in np.flatnonzero(lettered):
                langs[first + i], scores[first + i] = model.languages[best[i]], float(top[i])
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], fields=list(kind))

    return F.arrow_udf(by_slices(predict, kind), "lang string, score double")(text)


def identified(docs: DataFrame, training: DataFrame, how: Kernel = Kernel(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` as ``row`` with id, lang_pred and score. Rows without text or id are
    scored like others; rows without text, language or id never teach. Repeated rows get the same. An
    empty table gives no rows, and one without labelled rows makes all texts ``und``."""
    model = learn(training, how)
    base = packed(docs, id=f"{doc_id}:bigint", text=text)
    rows = base.withColumn("p", predicted(docs.sparkSession, F.col("text"), model, how)).drop("text")
    return rows.select("row", "id", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def learnable(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """The documents that may teach: an id outside the held-out fold, a text and a language."""
    return docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id"), folds) != held))


#: A document goes when no language comes near it: all regressions are below -0.2.
CLAIMED = 0.4


def understood_documents(docs: DataFrame) -> DataFrame:
    """The documents that have letters and that some language comes near, with the columns of ``docs``."""
    rows = identified(docs, learnable(docs))
    return unpacked(rows.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= CLAIMED)))


def op9(docs: DataFrame) -> DataFrame:
    rows = identified(docs.select("doc_id", "text"), learnable(docs))
    return rows.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 3) == 1).alias("held_out"), "lang_pred", "score")
