"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Training: follow the regularised leader with elastic-net penalties, then a temperature fitted on rows kept aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiq.llm.common import code_points, draw, letter_table

UNDETERMINED = "und"
_BITS = 16
_FACTORS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


@dataclass(frozen=True)
class LanguageModel:
    """Languages, weights (feature × language), inverse document frequencies and temperature."""

    languages: tuple[str, ...]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float
    letters: np.ndarray


def gram_counts(text: str | None, letters: np.ndarray) -> np.ndarray | None:
    """Counts of hashed n-grams of one to three characters over lower-cased letters; None without a letter."""
    if not text:
        return None
    chars = letters[code_points(text)]
    word = chars != 32
    if not word.any():
        return None
    keep = word.copy()
    keep[1:] |= word[:-1]
    padded = np.concatenate(([32], chars[keep], [32])).astype(np.uint32)
    grams, hashed = np.zeros(len(padded), np.uint32), []
    for order, factor in enumerate(_FACTORS):
        grams = grams[: len(padded) - order] * np.uint32(31) + padded[order:] * np.uint32(factor)
        hashed.append((grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - _BITS))
    return np.bincount(np.concatenate(hashed), minlength=1 << _BITS)


def _document_frequencies(letters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(1 << _BITS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts = gram_counts(text, letters.value)
                if counts is not None:
                    seen += counts > 0
                    rows += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(seen[at], rows))], ["feature", "rows"])

    return run


def _vectors(letters, idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                at, x = weigh(gram_counts(text, letters.value), idf.value)
                out.append((at.astype(np.int32).tobytes(), x.astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays([
                batch.column("lang"), batch.column("draw"), pa.array([x[0] for x in out], pa.binary()),
                pa.array([x[1] for x in out], pa.binary())], ["lang", "draw", "features", "amounts"])

    return run


def weigh(counts: np.ndarray | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and their TF-IDF amounts, of unit length."""
    if counts is None:
        return np.zeros(0, np.int64), np.zeros(0)
    at = np.flatnonzero(counts)
    x = np.log1p(counts[at]) * idf[at]
    return at, x / (np.linalg.norm(x) or 1.0)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          rows_per_language: int = 800, epochs: int = 3, alpha: float = 1.0, beta: float = 1.0,
          l1: float = 0.02, l2: float = 0.002) -> LanguageModel:
    """Fit the model on labelled rows; rows with a null label or no letter teach nothing.

    Document frequencies count all labelled rows. The regression is fitted on at most ``rows_per_language`` rows of
    each language, drawn by a hash of the key, so what reaches the driver doesn't grow with the input: rows that share key
    and language count once there, with the least of their texts. Without
    labelled rows the model knows no language and every prediction is undetermined.
    """
    spark = labelled.sparkSession
    letters = spark.sparkContext.broadcast(letter_table())
    rows = labelled.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    seen = (rows.select("text").mapInArrow(_document_frequencies(letters), "feature int, rows long")
            .groupBy("feature").agg(F.sum("rows").alias("rows")).collect())
    total = sum(r["rows"] for r in seen if r["feature"] < 0)
    frequency = np.zeros(1 << _BITS)
    for r in seen:
        if r["feature"] >= 0:
            frequency[r["feature"]] = r["rows"]
    idf = np.log((1.0 + total) / (1.0 + frequency)) + 1.0
    drawn = draw(rows.select("id", "lang"), "lang", "id", rows_per_language).distinct()
    # The drawn rows are bounded by rows_per_language × languages, so they are broadcast against the texts.
    picked = rows.join(F.broadcast(drawn), ["id", "lang"]).groupBy("id", "lang", F.col("drawn").alias("draw")).agg(
        F.min("text").alias("text")).select("lang", "draw", "text")
    vectors = picked.mapInArrow(_vectors(letters, spark.sparkContext.broadcast(idf)),
                                "lang string, draw long, features binary, amounts binary").collect()
    samples = sorted(((r["draw"], r["lang"], np.frombuffer(r["features"], np.int32), np.frombuffer(r["amounts"], np.float32))
                      for r in vectors if r["features"]), key=lambda s: (s[0], s[1]))
    languages = tuple(sorted({s[1] for s in samples}))
    aside = [s for i, s in enumerate(samples) if i % 5 == 4]
    fitted = [s for i, s in enumerate(samples) if i % 5 != 4]
    weights = _follow_regularised_leader(fitted, languages, epochs, alpha, beta, l1, l2)
    return LanguageModel(languages, weights, idf, _temperature(aside, languages, weights), letters.value)


def _follow_regularised_leader(samples, languages, epochs, alpha, beta, l1, l2) -> np.ndarray:
    shape = (1 << _BITS, len(languages))
    z, n = np.zeros(shape), np.zeros(shape)

    def weights(at):
        zs = z[at]
        return np.where(np.abs(zs) <= l1, 0.0, (np.sign(zs) * l1 - zs) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for _, language, at, x in samples:
            w = weights(at)
            gap = _softmax(x @ w)
            gap[languages.index(language)] -= 1.0
            gradient = np.outer(x, gap)
            squares = n[at]
            grown = squares + gradient ** 2
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(squares)) / alpha * w
            n[at] = grown
    return weights(np.arange(1 << _BITS))


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max()) if len(logits) else logits
    return e / (e.sum() or 1.0)


def _temperature(samples, languages, weights) -> float:
    """The temperature with the least log loss on rows kept aside, by golden-section search over its logarithm."""
    if not samples or len(languages) < 2:
        return 1.0
    logits = np.stack([x @ weights[at] for _, _, at, x in samples])
    truth = np.array([languages.index(s[1]) for s in samples])

    def loss(log_t):
        scaled = logits / np.exp(log_t)
        scaled = scaled - scaled.max(axis=1, keepdims=True)
        return float((np.log(np.exp(scaled).sum(axis=1)) - scaled[np.arange(len(truth)), truth]).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def predict(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) for every row. A null text, or one without a letter, is ``und`` with score 0."""
    state = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.weights, model.idf, model.temperature, model.letters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, weights, idf, temperature, letters = state.value
        for batch in batches:
            names, scores = [], []
            for value in batch.column(1).to_pylist():
                at, x = weigh(gram_counts(value, letters), idf)
                if len(at) and languages:
                    p = _softmax(x @ weights[at] / temperature)
                    best = int(p.argmax())
                    names.append(languages[best])
                    scores.append(float(p[best]))
                else:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], [key, "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, least: float, text: str = "text") -> DataFrame:
    """The rows, all columns unchanged, whose language is determined with a score of at least ``least``."""
    state = docs.sparkSession.sparkContext.broadcast((model.weights, model.idf, model.temperature, model.letters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, idf, temperature, letters = state.value
        for batch in batches:
            keep = []
            for value in batch.column(batch.schema.get_field_index(text)).to_pylist():
                at, x = weigh(gram_counts(value, letters), idf)
                keep.append(bool(len(at)) and weights.shape[1] > 0
                            and float(_softmax(x @ weights[at] / temperature).max()) >= least)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
