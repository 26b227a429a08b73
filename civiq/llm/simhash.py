"""SimHash near-duplicates: fingerprints of word shingles, linked by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiq.llm import shingles
from civiq.llm.common import discard, free_name, materialize, shuffle_partitions
from civiq.llm.components import connected_components

_BLOCK = 2048  # fingerprints of one bucket that are compared in one place
_NEAR = 16     # bits by which fingerprints of similar texts differ, with few exceptions


def fingerprint(text: str | None, words: int = 3) -> int:
    """64 bits: bit i is set where over half of the shingles' XXH64 values (seed 42) have it set.

    Words are runs without ASCII white space, A-Z lower-cased; repeated shingles count each time; a text of fewer
    words is one shingle; a null text, or one without words, gives zero.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(s, 42) for s in shingles], dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(values), 65536):  # bounded memory for very long texts
        part = values[start:start + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(values)).tolist())


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(key, fp): the fingerprint as a signed bigint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], [key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, fp long")


def variants(fps: DataFrame) -> DataFrame:
    """(signature, fp): both halves of each fingerprint, whole and with each of their bits in turn left out.

    Two fingerprints that differ in three bits or fewer have a half that differs in at most one, so they meet in that
    half's whole value, or in the variant without the bit in question, where they stand on different sides.
    """
    half = F.element_at(F.array(F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(0xFFFFFFFF)), F.col("part") + 1)
    masks = F.array(*[F.lit(0xFFFFFFFF ^ (1 << i)) for i in range(32)], F.lit(0xFFFFFFFF))
    spread = fps.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("part"))
    spread = spread.select("fp", "part", half.alias("half"), F.posexplode(masks).alias("spot", "mask"))
    head = F.shiftleft((F.col("part") * 33 + F.col("spot")).cast("long"), 32)
    return spread.select(head.bitwiseOR(F.col("half").bitwiseAND(F.col("mask"))).alias("signature"), "fp")


def _forest(distance: int):
    """Of the fingerprints in a bucket: edges that join all that are linked, one fewer than there are in a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for members in batch.column(0):
                rest = np.unique(members.values.to_numpy(zero_copy_only=False)).view(np.uint64)
                while len(rest):
                    queue, rest = [rest[0]], rest[1:]
                    while queue and len(rest):
                        at = queue.pop()
                        near = np.bitwise_count(rest ^ at) <= distance
                        if near.any():
                            found, rest = rest[near], rest[~near]
                            queue.extend(found)
                            left.append(np.full(len(found), at, np.uint64))
                            right.append(found)
            a = np.concatenate(left) if left else np.zeros(0, np.uint64)
            b = np.concatenate(right) if right else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b): edges between distinct fingerprints whose components are those of all links of ``distance`` bits or fewer.

    ``distance`` is three at most: beyond that, two halves don't suffice. Buckets of two, nearly all there are, give
    their pair straight from the aggregate. Of larger ones the members are gathered, in blocks of bounded size and each
    block with each other one of its bucket, and only a spanning forest of the links leaves a block.
    """
    if not 0 <= distance <= 3:
        raise ValueError("distance must be 0 to 3")
    return met_links(fps, distance)


def met_links(fps: DataFrame, distance: int) -> DataFrame:
    """(a, b): as ``links``, of those fingerprints that agree in a half but for one bit; beyond three bits these are not all."""
    # A fingerprint becomes 66 rows, so the few bytes of many are spread before.
    keyed = variants(fps.repartition(shuffle_partitions(fps.sparkSession)))
    buckets = materialize(keyed.groupBy("signature").agg(
        F.count("*").alias("size"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("size > 1"), "buckets")
    pairs = buckets.where("size = 2").select("a", "b").where(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    blocks = F.ceil(F.col("size") / _BLOCK).cast("int")
    large = buckets.where("size > 2").select("signature", blocks.alias("blocks"))
    members = (keyed.join(large, "signature")
               .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
               .select("signature", "fp", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")))
    gathered = members.groupBy("signature", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")).agg(
        F.collect_list("fp").alias("members"))
    return pairs.unionByName(gathered.select("members").mapInArrow(_forest(distance), "a long, b long")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, distance: int = 3) -> DataFrame:
    """(key, fp, component): every row with its fingerprint and the least key reachable over links.

    Rows with equal fingerprints are one node, so copies cost nothing. Rows with a null key are linked like others,
    and null is never the least key unless a component has no other; an empty table gives an empty table.
    """
    marked = materialize(fingerprints(docs, key, text, words), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min(key).alias("least"))
    found = connected_components(links(nodes.select("fp"), distance)).select(F.col("node").alias("fp"), "component")
    linked = nodes.join(found, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    roots = linked.groupBy("root").agg(F.min("least").alias("component"))
    labels = linked.join(roots, "root").select("fp", "component")
    return marked.join(labels, "fp").select(key, "fp", "component")


def _linked_pairs(texts: DataFrame, words: int) -> DataFrame:
    """(a, b): for the texts (node, text), pairs of nodes that join all whose fingerprints are equal or linked: they agree in a
    half but for one bit, and in as many bits as those of texts at the lower end of similarity do (they differ in about ten)."""
    marked = materialize(fingerprints(texts, "node", "text", words).distinct(), "fingerprints")
    least = marked.groupBy("fp").agg(F.min("node").alias("least"))
    equal = marked.join(least, "fp").where("least <> node").select(F.col("least").alias("a"), F.col("node").alias("b"))
    one, other = (least.select(F.col("fp").alias(c), F.col("least").alias(f"node_{c}")) for c in "ab")
    linked = met_links(least.select("fp"), _NEAR).join(one, "a").join(other, "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    pairs = materialize(equal.unionByName(linked), "linked")
    discard(marked)
    return pairs


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
               threshold: tuple[int, int] = shingles.THRESHOLD) -> DataFrame:
    """The rows, all columns unchanged, without those linked to a row with a smaller key.

    Two rows are linked if the sets of their shingles have a Jaccard similarity of at least ``threshold``; links count across
    others. Texts whose fingerprints are linked are compared by it first; the similar ones that fingerprints of 64 bits don't
    show (at 0.8 they differ in about ten bits) meet by rare shingles after that.
    Of rows that share key and words one stays. A component whose keys are all null keeps one row.
    """
    mark = free_name(docs, "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [shingles.text_id(t.as_py()) for t in batch.column(batch.schema.get_field_index(text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.int64())], [*batch.schema.names, mark])

    schema = T.StructType([*docs.schema.fields, T.StructField(mark, T.LongType())])
    marked = docs.mapInArrow(run, schema)
    one = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"))
    nodes = materialize(docs.select(key, text).mapInArrow(run, T.StructType([docs.schema[key], docs.schema[text], schema[mark]])).groupBy(
        F.col(mark).alias("node")).agg(F.count("*").alias("rows"), F.min(one).alias("least")), "nodes")
    # Of copies only one is compared. What is compared is read several times, so it is stored instead of shuffled each time.
    copied = nodes.where("rows > 1").select(F.col("node").alias("copied"), "least")
    texts = materialize(marked.join(copied, marked[mark] == copied["copied"], "left").where(
        F.col("copied").isNull() | marked[key].eqNullSafe(F.col("least.key"))).select(F.col(mark).alias("node"), F.col(text).alias("text")), "texts")
    linked = _linked_pairs(texts, words)
    found = shingles.similar_components(texts, words, threshold, linked)
    roots = nodes.join(found, "node", "left").groupBy(F.coalesce("component", "node")).agg(
        F.min(F.struct("least", "node", "rows")).alias("first"))
    first = materialize(roots.select(F.col("first.node").alias("first_node"), F.col("first.least.key").alias("first_key"), (
        F.col("first.rows") > 1).alias("first_copied")), "first")
    discard(nodes, texts, linked)
    kept = marked.join(first, (marked[mark] == first["first_node"]) & marked[key].eqNullSafe(first["first_key"]))
    # Only rows with copies can repeat their key and words, so the others aren't shuffled once more.
    single, copies = (kept.where(which).select(mark, *(marked[c] for c in docs.columns)) for which in (~first["first_copied"], first["first_copied"]))
    return single.unionByName(copies.dropDuplicates([mark, key])).drop(mark)
