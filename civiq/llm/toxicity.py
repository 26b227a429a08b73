"""Toxicity by a weighted lexicon: Aho-Corasick over folded text, exception phrases, normalised by length."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiq.llm.common import draw

# Letters of other scripts that look like Latin ones, then digits and signs that stand for letters.
_HOMOGLYPHS = dict(zip("аеорсухіјѕһԁԛԝкмнтвгαορυνιτκχε", "aeopcyxijshdqwkmhtbraopuvitkxe"))
_SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
_SIGNS = {"@": "a", "$": "s", "!": "i", "€": "e"}

_FOLD = str.maketrans({**_HOMOGLYPHS, **_SUBSTITUTES, **{chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}})
_SIGN_RUN = re.compile("[@$!€]+(?=[^\\W\\d_])")
_WORD = re.compile("[^\\W\\d_]+")
_PREFIXES = range(3, 8)


def folded_words(text: str | None) -> list[str]:
    """Words of letters in lower case, look-alikes and digits read as the letters they stand for."""
    low = (text or "").lower()
    if _SIGN_RUN.search(low):
        low = _SIGN_RUN.sub(lambda m: "".join(_SIGNS[c] for c in m[0]), low)
    return _WORD.findall(low.translate(_FOLD))


def entries_of(word: str) -> list[str]:
    """What of a word may be an entry: the whole, written `` word ``, and its beginnings, written `` wor``."""
    return [f" {word} ", *(f" {word[:n]}" for n in _PREFIXES if n < len(word))]


def compile_lexicon(weights: dict[str, float], exceptions: list[str]):
    """An automaton over words joined by blanks; exceptions have no weight."""
    automaton = ahocorasick.Automaton()
    for entry, weight in weights.items():
        automaton.add_word(entry, (len(entry), weight))
    for phrase in exceptions:
        automaton.add_word(f" {phrase} ", (len(phrase) + 2, None))
    if len(automaton):
        automaton.make_automaton()
    return automaton


def hits(words: list[str], automaton) -> dict[int, float]:
    """The largest weight of each matched word, by where it starts in the joined words; none inside an exception."""
    found: dict[int, float] = {}
    if not words or not len(automaton):
        return found
    spared = []
    for end, (length, weight) in automaton.iter(f" {' '.join(words)} "):
        start = end - length + 1
        if weight is None:
            spared.append((start, end))
        elif weight > found.get(start, 0.0):
            found[start] = weight
    for low, high in spared:
        for start in [s for s in found if low <= s < high]:
            del found[start]
    return found


def features(words: list[str], found: dict[int, float]) -> list[float]:
    """Of a text: total weight, the largest weight, and total by length, all damped; and a constant."""
    total = sum(found.values())
    return [math.log1p(total), max(found.values(), default=0.0), total / math.sqrt(1 + len(words)), 1.0]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          rows_per_label: int = 6000, least_uses: int = 3) -> dict:
    """Learn entries, weights, exception phrases and the scale of the score from labelled rows.

    Only the fit is bounded: at most ``rows_per_label`` rows of each label, drawn by a hash of the key; documents that share
    a key count once there, with the least of their texts, and one labelled both ways counts for both. All entries and exceptions
    that this sample bears out are kept. A quarter of it is kept aside for the scale. An entry's weight is its log odds, less the error of so many counts. A phrase of an entry
    and its neighbour that only harmless texts use is an exception. Without labelled rows of both kinds every score
    is the share of toxic rows, or 0.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("y")).where(
        F.col("id").isNotNull() & F.col("y").isin(0, 1)).distinct()
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    drawn = draw(known, "y", "id", rows_per_label).select(
        "id", "y", (F.pmod(F.xxhash64("id", F.lit("aside")), F.lit(4)) == 0).alias("aside"))
    # Bounded by twice rows_per_label, so broadcast against the texts.
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(drawn), "id").groupBy(
        "id", "y", "aside").agg(F.min("text").alias("text"))
    taught = rows.where(~F.col("aside"))
    counted = (taught.select("text", "y").mapInArrow(_candidates(), "entry string, y int").groupBy("entry")
               .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q")).where(F.col("p") >= least_uses))
    sizes = {r["y"]: r["count"] for r in taught.groupBy("y").count().collect()}
    p_all, q_all = sizes.get(1, 0), sizes.get(0, 0)
    gain = F.log((F.col("p") + 0.5) / (p_all + 1.0)) - F.log((F.col("q") + 0.5) / (q_all + 1.0))
    weight = gain - 1.96 * F.sqrt(1.0 / (F.col("p") + 0.5) + 1.0 / (F.col("q") + 0.5))
    best = counted.withColumn("weight", weight).where("weight > 0.8")
    weights = {r["entry"]: r["weight"] for r in best.collect()}
    state = spark.sparkContext.broadcast(compile_lexicon(weights, []))
    phrases = (taught.select("text", "y").mapInArrow(_phrases(state), "phrase string, y int").groupBy("phrase")
               .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q")).where((F.col("p") == 0) & (F.col("q") >= least_uses)))
    exceptions = sorted(r["phrase"] for r in phrases.collect())
    state = spark.sparkContext.broadcast(compile_lexicon(weights, exceptions))
    seen = rows.where("aside").select("text", "y").mapInArrow(_measured(state), "x array<double>, y int").collect()
    scale = _scale([(r["x"], r["y"]) for r in seen], totals)
    return {"weights": weights, "exceptions": exceptions, "scale": scale}


def _candidates():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = sorted({e for w in set(folded_words(text)) for e in entries_of(w)})
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([y] * len(found), pa.int32())], ["entry", "y"])

    return run


def _phrases(state):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases, labels = [], []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = folded_words(text)
                found, start, near = hits(words, state.value), 0, set()
                for i, word in enumerate(words):
                    if start in found:
                        near |= {" ".join(words[a:a + 2]) for a in (i - 1, i) if 0 <= a < len(words) - 1}
                    start += len(word) + 1
                phrases += sorted(near)
                labels += [y] * len(near)
            yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.string()), pa.array(labels, pa.int32())], ["phrase", "y"])

    return run


def _measured(state):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(w, hits(w, state.value)) for w in map(folded_words, batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])

    return run


def _scale(rows: list, totals: dict[int, int]) -> list[float]:
    """A logistic regression on the rows kept aside, each label counting as much as it has rows in all."""
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    prior = [0.0, 0.0, 0.0, math.log((share + 1e-9) / (1 - share + 1e-9))]
    x, y = np.array([r[0] for r in rows]).reshape(-1, 4), np.array([r[1] for r in rows], float)
    if not (0 < y.sum() < len(y)):
        return prior
    importance = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w, ridge = np.zeros(4), np.diag([0.5, 0.5, 0.5, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (importance * (p - y)) + ridge @ w
        w -= np.linalg.solve((x * (importance * p * (1 - p))[:, None]).T @ x + ridge, gradient)
    return w.tolist()


def score(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, hits) for every row: 0 to 1, and how many words matched. Null and empty texts score as texts without a match."""
    state = docs.sparkSession.sparkContext.broadcast((compile_lexicon(model["weights"], model["exceptions"]), model["scale"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, scale = state.value
        for batch in batches:
            scores, counts = [], []
            for value in batch.column(1):
                words = folded_words(value.as_py())
                found = hits(words, automaton)
                z = sum(a * b for a, b in zip(features(words, found), scale))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())],
                                             [key, "score", "hits"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double, hits long")
