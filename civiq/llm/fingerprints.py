"""Order MinHash fingerprints: signatures that follow edit distance.

The k-mers of a text are numbered by occurrence and hashed once; the upper bits of the hash deal them to bins. Of each
bin the few with the least hashes are taken, put in text order, and their sequence is hashed to the bin's entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiq.llm.common import code_points, shuffle_partitions

BINS = 64
CHOSEN = 2     # k-mers of a bin
_STEPS = 4     # k is 2 to this power
_BATCH = 256


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def kmer_hashes(text: str) -> np.ndarray:
    """Hashes of the text's k-mers of 16 code points, in order, each with its occurrence number; a shorter text is one."""
    h = code_points(text).astype(np.uint64) + np.uint64(1)
    if not len(h):
        return h
    if len(h) < 1 << _STEPS:
        h = np.concatenate((h, np.zeros((1 << _STEPS) - len(h), np.uint64)))
    for step in range(_STEPS):
        width = 1 << step
        h = h[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + h[width:]
    h = _mix(h)
    ordered = np.sort(h)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(again):
        at = np.flatnonzero(np.isin(h, again))
        order = at[np.argsort(h[at], kind="stable")]
        values = h[order]
        first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
        number = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        h[order] = np.where(number > 0, _mix(values + number.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), values)
    return h


def fingerprint(text: str | None) -> np.ndarray:
    """An entry of 16 bits for each bin; zero for a bin without k-mers. A null or empty text has only zeros."""
    entries = np.zeros(BINS, np.uint16)
    h = kmer_hashes(text or "")
    if not len(h):
        return entries
    shift = np.uint64(64 - BINS.bit_length() + 1)
    order = _least(h, shift)
    bins = (h[order] >> shift).astype(np.int64)
    place = np.arange(len(order)) - np.searchsorted(bins, bins)
    taken, bins = order[place < CHOSEN], bins[place < CHOSEN]
    by_text = np.lexsort((taken, bins))
    taken, bins = taken[by_text], bins[by_text]
    place = np.arange(len(taken)) - np.searchsorted(bins, bins)
    sums = np.zeros(BINS, np.uint64)
    for i in range(CHOSEN):
        here = place == i
        sums[bins[here]] = _mix(sums[bins[here]] * np.uint64(31) + h[taken[here]])
    found = np.unique(bins)
    entries[found] = np.maximum(sums[found] >> np.uint64(48), np.uint64(1))
    return entries


def _least(h: np.ndarray, shift: np.uint64) -> np.ndarray:
    """Indices of the hashes by (bin, hash), of long texts only so many of the least of each bin as are surely enough."""
    if len(h) > 16 * BINS * CHOSEN:
        share = 8 * BINS * CHOSEN / len(h)
        low = h & ((np.uint64(1) << shift) - np.uint64(1))
        at = np.flatnonzero(low < np.uint64(share * 2.0 ** int(shift)))
        if np.bincount((h[at] >> shift).astype(np.int64), minlength=BINS).min() >= CHOSEN:
            return at[np.argsort(h[at], kind="stable")]
    return np.argsort(h, kind="stable")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal entries among bins that at least one of the texts fills; 1 for two empty texts."""
    used = (a > 0) | (b > 0)
    return float((a[used] == b[used]).mean()) if used.any() else 1.0


def edited(text: str, other: str) -> str:
    """The text with its last third (rounded down) replaced by as much of the start of the other."""
    third = len(text) // 3
    return text[:len(text) - third] + other[:third]


def with_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, extra, key, text): documents in runs of descending keys, null keys last.

    At the end of a run stands, marked ``extra``, the first document of the next run, of the first behind the last. Bounds
    of the runs are quantiles of the keys; there are a few for each shuffle partition, whatever the size of the input.
    Rows that share a key are ordered by a digest of the text.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shares = [i / (4 * parts) for i in range(1, 4 * parts)]
    found = rows.agg(F.percentile_approx("key", shares, max(10_000, 40 * parts)).alias("q")).first()["q"]
    bounds = np.array(sorted(set(found or [])), np.int64)

    def bucket_of(keys: pa.Array) -> np.ndarray:
        values = keys.fill_null(0).to_numpy(zero_copy_only=False)
        at = len(bounds) - np.searchsorted(bounds, values, "right")
        return np.where(keys.is_null().to_numpy(zero_copy_only=False), len(bounds) + 1, at).astype(np.int32)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(batch.column(0))), *batch.columns], ["bucket", "key", "digest"])

    heads = {r["bucket"]: (r["head"]["key"], r["head"]["digest"]) for r in rows.select("key", F.xxhash64("text").alias("digest"))
             .mapInArrow(numbered, "bucket int, key long, digest long").groupBy("bucket")
             .agg(F.max(F.struct("key", "digest")).alias("head")).collect()}
    order = sorted(heads)
    before = {b: order[i - 1] for i, b in enumerate(order)}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = bucket_of(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets), pa.array(np.zeros(len(buckets), bool)), *batch.columns],
                ["bucket", "extra", "key", "text", "digest"])
            keys, digests = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            first = [i for i, b in enumerate(buckets.tolist()) if heads[b] == (keys[i], digests[i])]
            if first:
                at = pa.array(first, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([before[b] for b in buckets[first].tolist()], pa.int32()), pa.array([True] * len(first)),
                     *(c.take(at) for c in batch.columns)], ["bucket", "extra", "key", "text", "digest"])

    dealt = rows.withColumn("digest", F.xxhash64("text")).mapInArrow(
        spread, "bucket int, extra boolean, key long, text string, digest long")
    return dealt.repartition(parts, "bucket").sortWithinPartitions(
        "bucket", "extra", F.col("key").desc_nulls_last(), F.col("digest").desc()).drop("digest")


def compare_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint, its edited text's, and how like they and the next document's are.

    Columns: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null texts count as
    empty; a single document is its own next; equal rows stay rows of their own; an empty table gives none.
    """

    def finished(key_value, value, mark, following, following_mark):
        changed = edited(value, following)
        other = fingerprint(changed)
        return (key_value, len(value), hashlib.sha256(changed.encode()).hexdigest(), mark.astype(">u2").tobytes().hex(),
                other.astype(">u2").tobytes().hex(), likeness(mark, other), likeness(mark, following_mark))

    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []
        for batch in batches:
            for bucket, extra, number, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                    batch.column(2).to_pylist(), batch.column(3)):
                if extra and (held is None or held[0] != bucket):
                    continue  # one of several equal first rows of the next run
                value = value.as_py()
                mark = fingerprint(value)
                if held is not None and held[0] == bucket:
                    out.append(finished(*held[1:], value, mark))
                held = None if extra else (bucket, number, value, mark)
                if len(out) >= _BATCH:
                    yield packed(out)
                    out = []
        yield packed(out)

    return with_neighbours(docs, key, text).mapInArrow(
        run, f"`{key}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
