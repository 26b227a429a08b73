"""All pairs of texts whose sets of word shingles have a Jaccard similarity of at least a threshold.

An exact set-similarity join. Shingles are ordered by rarity, and two sets that are similar enough share one among the
first few of both: the prefix filter. Length and position filters thin the candidates, and each one left is verified on
the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiq.llm.common import discard, materialize
from civiq.llm.components import connected_components

_BUCKETS = 1 << 18       # entries of the rarity table, which orders shingles and never decides
_CACHED = 4_000_000      # shingles of verified texts that a worker keeps at hand
THRESHOLD = (4, 5)       # Jaccard similarity as a fraction


def tokens_of(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def text_id(text: str | None) -> int:
    """Signed 64 bits of the words in order; texts without words share theirs."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(b" ".join(tokens_of(text)))).view(np.int64))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """64 bits of each different shingle, ascending; a text of fewer words is one shingle, one without words has none."""
    tokens = tokens_of(text)
    if not tokens:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(tokens))
    mixed = np.zeros(len(tokens) - width + 1, np.uint64)
    for i in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + values[i:i + len(mixed)]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return np.unique(mixed ^ (mixed >> np.uint64(31)))


def _rarity(texts: DataFrame, words: int) -> np.ndarray:
    """How many shingles of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                counts += np.bincount((shingle_set(text.as_py(), words) % np.uint64(_BUCKETS)).astype(np.int64), minlength=_BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "uses"])

    found = texts.select("text").mapInArrow(run, "bucket long, uses long").groupBy("bucket").agg(F.sum("uses").alias("uses")).toArrow()
    table = np.zeros(_BUCKETS, np.int64)
    table[found.column("bucket").to_numpy()] = found.column("uses").to_numpy()
    return table


def _prefixes(texts: DataFrame, words: int, threshold: tuple[int, int]) -> DataFrame:
    """(shingle, node, n, spot): of each text's n shingles the rarest few, with their places in the order by rarity."""
    rarity = _rarity(texts, words)
    numerator, denominator = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, nodes, counts = [np.zeros(0, np.uint64)], [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = shingle_set(text.as_py(), words)
                n = len(values)
                if n:
                    head = n - (n * numerator + denominator - 1) // denominator + 1
                    uses = rarity[(values % np.uint64(_BUCKETS)).astype(np.int64)]
                    parts.append(values[np.lexsort((values, uses))[:head]])
                    nodes.append(node)
                    counts.append(n)
            heads = [len(p) for p in parts[1:]]
            spots = np.concatenate([np.arange(h, dtype=np.int32) for h in heads]) if heads else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), heads)),
                 pa.array(np.repeat(np.array(counts, np.int32), heads)), pa.array(spots)], ["shingle", "node", "n", "spot"])

    return texts.select("node", "text").mapInArrow(run, "shingle long, node long, n int, spot int")


def _may_be_similar(a: Column, b: Column, threshold: tuple[int, int]) -> Column:
    """Whether two texts (n, spot) whose first common shingle stands at these places can be similar enough."""
    numerator, denominator = threshold
    most = F.least(a["n"] - a["spot"], b["n"] - b["spot"])
    return ((a["n"] * denominator >= b["n"] * numerator) & (b["n"] * denominator >= a["n"] * numerator)
            & (most.cast("long") * (numerator + denominator) >= (a["n"] + b["n"]).cast("long") * numerator))


def _verified(pairs: DataFrame, texts: DataFrame, words: int, threshold: tuple[int, int]) -> DataFrame:
    """Those of the pairs (a, b) that are similar enough, stored."""
    numerator, denominator = threshold
    pairs = materialize(pairs.distinct(), "candidates")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    used = materialize(texts.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "compared")
    left, right = (used.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        held = 0
        for batch in batches:
            hits = []
            for i, both in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                sets = []
                for node, text in zip(both, (batch.column(2), batch.column(3))):
                    found = known.get(node)
                    if found is None:
                        found = shingle_set(text[i].as_py(), words)
                        if held > _CACHED:
                            known.clear()
                            held = 0
                        known[node] = found
                        held += len(found)
                    sets.append(found)
                common = len(np.intersect1d(*sets, assume_unique=True))
                if common * denominator >= (len(sets[0]) + len(sets[1]) - common) * numerator:
                    hits.append(i)
            at = pa.array(hits, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], ["a", "b"])

    near = materialize(pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"), "edges")
    discard(pairs, used)
    return near


def similar_components(texts: DataFrame, words: int = 5, threshold: tuple[int, int] = THRESHOLD,
                       candidates: DataFrame | None = None) -> DataFrame:
    """(node, component) of all texts (node, text) that are similar to another: the components of all similar pairs.

    ``candidates`` (a, b) found by other means are verified first, with these: of the texts that share a rare shingle, each
    first meets the least one; groups of near copies are joined by that. Then all meet that share one and are not yet in the
    same component, so no similar pair is left out. Repeated nodes count once. ``texts`` is read more than once.
    """
    prefixes = _prefixes(texts, words, threshold)
    member = F.struct("node", "n", "spot")
    shared = materialize(prefixes.groupBy("shingle").agg(
        F.count("*").alias("size"), F.min(member).alias("x"), F.max(member).alias("y")).where("x.node <> y.node"), "shared")
    pair = F.col("x.node").alias("a"), F.col("y.node").alias("b")
    two = shared.where("size = 2").where(_may_be_similar(F.col("x"), F.col("y"), threshold)).select(*pair)
    members = materialize(prefixes.join(shared.where("size > 2").select("shingle", "x"), "shingle").select(
        "shingle", "x", member.alias("y")).where("x.node <> y.node"), "members")
    stars = members.where(_may_be_similar(F.col("x"), F.col("y"), threshold)).select(*pair)
    met = two.unionByName(stars)
    if candidates is not None:
        met = met.unionByName(candidates)
    edges = _verified(met, texts, words, threshold)
    discard(shared)

    found = connected_components(edges)
    named = members.withColumn("node", F.col("y.node")).join(found, "node", "left").select(
        "shingle", "y", F.coalesce("component", "node").alias("component"))
    open_ = named.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    named = materialize(named.join(open_.select("shingle"), "shingle", "left_semi"), "open")
    discard(members)
    one = named.select("shingle", F.col("y").alias("x"), F.col("component").alias("other"))
    met = one.join(named, "shingle").where((F.col("other") != F.col("component")) & (F.col("x.node") < F.col("y.node"))
                                           & _may_be_similar(F.col("x"), F.col("y"), threshold)).select(*pair)
    more = _verified(met, texts, words, threshold)
    discard(named)
    found = connected_components(edges.unionByName(more))
    discard(edges, more)
    return found
