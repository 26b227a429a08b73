"""Periodic runs of words inside documents, by seeds on diagonals.

A run of period q is a stretch of matches on the diagonal of lag q, and a run long enough to count has at least so many of
them that a k-gram stands at its start and again q words on. Lags are taken in classes; the k of a class is the least overlap
guaranteed in it, and no lag of a class exceeds its k. Then the k-gram at the start of a run occurs nowhere between its two
places: an earlier repetition would give the run a smaller period, by Fine and Wilf. So only neighbouring occurrences of a
k-gram have to be paired, at most one pair for each word, and whatever stretch a pair seeds has its lag as smallest period.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH = 6  # words of a run
LEAST_PERIODS = 4  # repetitions of a run
_BYTES = 4 << 20  # texts whose words are numbered together


def lag_classes(words: int) -> Iterator[tuple[int, int, int]]:
    """(first lag, last lag, k): k is the least overlap of a run's two copies for the lags of the class, and no lag exceeds k."""
    low = 1
    while LEAST_PERIODS * low <= words:
        overlap = max(LEAST_LENGTH, LEAST_PERIODS * low) - low
        yield low, overlap, overlap
        low = overlap + 1


def gram_numbers(words: np.ndarray, k: int) -> np.ndarray:
    """A number for each k-gram, equal for equal ones only: grams of doubled lengths are numbered until two cover k words."""
    numbers, size = words, 1
    while size < k:
        step = min(size, k - size)
        count = len(numbers) - step
        if count <= 0:
            return numbers[:0]
        pairs = numbers[:count] * np.int64(numbers.max() + 1) + numbers[step:step + count]
        numbers, size = pd.factorize(pairs)[0].astype(np.int64), size + step
    return numbers


def seeds(words: np.ndarray, low: int, high: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, lags), by place: k-grams whose next occurrence is ``low`` to ``high`` words on."""
    numbers = gram_numbers(words, k)
    order = np.argsort(numbers, kind="stable")
    here, following = order[:-1], order[1:]
    lags = following - here
    fits = (numbers[here] == numbers[following]) & (lags >= low) & (lags <= high)
    here, lags = here[fits], lags[fits]
    order = np.argsort(here, kind="stable")
    return here[order], lags[order]


def _reach(words: np.ndarray, place: int, lag: int, step: int) -> int:
    """How many words from ``place`` on, forwards or backwards, equal those ``lag`` words later; galloping."""
    covered, chunk = 0, 16
    while True:
        if step > 0:
            at = place + covered
            size = min(chunk, len(words) - lag - at)
        else:
            at = place - covered
            size = min(chunk, at + 1)
        if size <= 0:
            return covered
        begin = at if step > 0 else at - size + 1
        same = words[begin:begin + size] == words[begin + lag:begin + lag + size]
        if not same.all():
            return covered + int(np.argmin(same if step > 0 else same[::-1]))
        covered, chunk = covered + size, chunk * 2


def periodic_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run, by start, then period.

    For each lag stands how far its diagonal is covered; seeds within are not extended again.
    """
    runs = []
    for low, high, k in lag_classes(len(words)):
        covered: dict[int, int] = {}
        places, lags = seeds(words, low, high, k)
        for place, lag in zip(places.tolist(), lags.tolist()):
            if place < covered.get(lag, 0):
                continue
            start = place - (_reach(words, place - 1, lag, -1) if place else 0)
            end = place + k + _reach(words, place + k, lag, 1)
            covered[lag] = end
            length = end + lag - start
            if length >= max(LEAST_LENGTH, LEAST_PERIODS * lag):
                runs.append((start, length, lag))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(runs: list[tuple[int, int, int]], words: int) -> np.ndarray:
    """True for the words that stay: all but those of a run behind its first period."""
    change = np.zeros(words + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def _summary(spelled: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    stay = collapsed(runs, len(spelled))
    kept = spelled if not runs else [spelled[i] for i in np.flatnonzero(stay).tolist()]
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
    longest = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return len(runs), *longest, hashlib.sha256(listed).hexdigest(), b" ".join(kept), runs


_KINDS = [("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
          ("runs_sha256", pa.string()), ("collapsed", pa.string()),
          ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))]
_SHAPE = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed string, "
          "runs array<struct<start: long, length: long, period: long>>")


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows in slices of about ``_BYTES`` bytes; a longer text is a slice of its own."""
    begin, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > begin and held + size > _BYTES:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def _worth_a_look(numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each document whether any of its shortest seeds occurs twice in it; others have no run."""
    _, high, k = next(lag_classes(LEAST_PERIODS))
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    own = pd.factorize(owner * np.int64(numbers.max(initial=0) + 1) + numbers)[0].astype(np.int64)
    grams = gram_numbers(own, k)
    inside = owner[:len(grams)] == owner[k - 1:k - 1 + len(grams)]  # across a border a gram is no seed
    grams, owner = grams[inside], owner[:len(inside)][inside]
    twice = np.bincount(grams, minlength=1)[grams] > 1
    found = np.zeros(len(bounds) - 1, bool)
    found[owner[twice]] = True
    return found


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text",
              rearranged: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """Runs of every document, and its text with each run collapsed to its first period.

    Columns: key, n_runs, start, length, period and exponent_milli of the longest run (ties: smallest start, then period; null
    where there is none), runs_sha256 of all runs' lines "start,length,period", collapsed (the kept words joined by blanks), and
    runs. Words are what stands between ASCII white space, unchanged. A run has at least six words and four periods.

    ``rearranged`` gives, for a key and a number of words, the numbers of the words to read instead, or None for the text as it is.
    Null and empty texts, and texts without a word, have no run and collapse to an empty text. Rows are treated one by one:
    repeated rows and keys stay, null keys are kept, an empty table gives none, other columns are not looked at. Texts are never cut;
    the work on one grows with its words times their logarithm.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for begin, end in _slices(lengths):
                part = batch.slice(begin, end - begin)
                rows = _look(part.column(0).to_pylist(), part.column(1).to_pylist(), rearranged)
                columns = [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(_KINDS)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], [key, *(n for n, _ in _KINDS)])

    return docs.select(key, F.col(text).cast("binary").alias("text")).mapInArrow(run, f"`{key}` {kind}, {_SHAPE}")


def _look(keys: list, texts: list[bytes | None], rearranged) -> list[tuple]:
    spelled = []
    for name, value in zip(keys, texts):
        words = (value or b"").split()
        order = rearranged(name, len(words)) if rearranged and words else None
        spelled.append(words if order is None else [words[i] for i in order.tolist()])
    bounds = np.cumsum([0] + [len(w) for w in spelled])
    flat = np.empty(bounds[-1], object)
    flat[:] = [w for words in spelled for w in words]
    numbers = pd.factorize(flat)[0].astype(np.int64)
    looked = _worth_a_look(numbers, bounds)
    out = []
    for i, words in enumerate(spelled):
        own = numbers[bounds[i]:bounds[i + 1]]
        out.append(_summary(words, periodic_runs(own) if looked[i] else []))
    return out
