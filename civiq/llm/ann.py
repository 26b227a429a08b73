"""Nearest vectors by inner product through randomly rotated one-bit codes.

A vector is stored as its cell, its distance from the cell's centre, one bit for each component of the randomly rotated
residual, and the inner product of that code with the residual. A query estimates all inner products of a cell from the
bits and the two scalars; an error bound on each estimate tells which vectors can be among the nearest, and only these
are computed from the vectors themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiq.llm.common import materialize
from civiq.llm.vectors import is_finite, matrix

_CHUNK = 256  # queries estimated at once against a block of the index


@dataclass(frozen=True)
class Index:
    """``rows``: (cell, rep, v, ids, bits, norm, cosine), one for each different vector; ``sizes``: rows by cell."""

    rows: DataFrame
    centres: np.ndarray
    spreads: np.ndarray
    rotation: np.ndarray
    sizes: dict[int, int]
    k: int

    @property
    def dim(self) -> int:
        return self.centres.shape[1]


def rotation_matrix(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, its size rounded up to whole bytes."""
    size = -(-dim // 8) * 8
    turned, scale = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return turned * np.sign(np.diag(scale))


def _turn(rows: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    return rows @ rotation[:, :rows.shape[1]].T


def encode(residuals: np.ndarray, rotation: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, lengths, cosines of code and residual); a residual of length zero has the cosine 1."""
    turned = _turn(residuals, rotation)
    norms = np.linalg.norm(turned, axis=1)
    signs = turned >= 0
    spread = np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])
    cosines = np.divide(spread, norms, out=np.ones_like(norms), where=norms > 0)
    return np.packbits(signs, axis=1), norms, np.clip(cosines, 0.0, 1.0)


def estimate(queries: np.ndarray, centre: np.ndarray, rotation: np.ndarray, bits: np.ndarray, norms: np.ndarray,
             cosines: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """(estimates, upper bounds) of the inner products of every query with every encoded vector.

    With t the inner product of query and code, t / cosine is an unbiased estimate for the residual's direction. It is off by
    more than ``epsilon`` standard deviations as rarely as a normal variable; by the angles between query, code and vector
    it cannot exceed cosine · t + sin · sqrt(|q|² - t²) at all. The lesser of the two bounds counts.
    """
    size = rotation.shape[0]
    codes = np.unpackbits(bits, axis=1)[:, :size].astype(np.float64) * 2 - 1
    t = _turn(queries, rotation) @ codes.T / math.sqrt(size)
    length = np.linalg.norm(queries, axis=1)[:, None]
    sine = np.sqrt(1 - cosines**2)
    direct = t / cosines
    likely = direct + length * epsilon * sine / (cosines * math.sqrt(max(size - 1, 1)))
    certain = cosines * t + sine * np.sqrt(np.maximum(length**2 - t**2, 0))
    base = (queries @ centre)[:, None]
    slack = 1e-9 * length * (norms + np.linalg.norm(centre))
    return base + norms * direct, base + norms * np.minimum(likely, certain) + slack


def _usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part; -0 counts as 0."""
    value = F.col(vector)
    ok = F.col(key).isNotNull() & is_finite(value) & F.exists(value, lambda x: x != 0)
    return rows.where(ok).select(F.col(key).cast("long").alias("id"), F.transform(value, lambda x: F.when(x == 0, F.abs(x)).otherwise(x)).alias("v"))


def _centres(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's centres of the sample, started from its first rows; a centre without rows stays."""
    centres = sample[:cells].copy()
    for _ in range(rounds if cells > 1 else 1):
        at = _nearest_centre(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, sample)
        counts = np.bincount(at, minlength=len(centres))
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _nearest_centre(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * rows @ centres.T, axis=1)


def build(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20, cell_rows: int = 8192,
          fit_rows: int = 32768, seed: int = 7) -> Index | None:
    """Index every usable row; None if there is none.

    Equal vectors share one entry with their ``k + 1`` smallest keys, as no search can return more of them; a vector that a
    third of all rows hold is thinned on the map side. Centres, one for about ``cell_rows`` entries, are fitted on at most
    ``fit_rows`` different vectors, those of the least hashes; there are ``fit_rows / 16`` at most.
    """
    usable = _usable(rows, key, vector)
    place = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    few = usable.withColumn("place", place).where(F.col("place") <= k + 1)
    entries = materialize(few.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids")), "ann-entries")
    count, dim = entries.agg(F.count("*"), F.max(F.size("v"))).first()
    if not count:
        return None
    drawn = entries.select("v", F.pmod(F.xxhash64("v"), F.lit(1 << 40)).alias("drawn"))
    thinned = drawn.where(F.col("drawn") * float(count) < 2.0 * (fit_rows + 100) * (1 << 40))
    sample = matrix(thinned.orderBy("drawn", "v").limit(fit_rows).select("v").toArrow()["v"], dim)
    cells = max(1, min(-(-count // cell_rows), fit_rows // 16, len(sample)))
    centres, rotation = _centres(sample, cells), rotation_matrix(dim, seed)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column(0), dim)
            at = _nearest_centre(values, centres)
            bits, norms, cosines = encode(values - centres[at], rotation)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), *batch.columns, pa.array([b.tobytes() for b in bits], pa.binary()),
                 pa.array(norms), pa.array(cosines)], ["cell", "v", "ids", "bits", "norm", "cosine"])

    kind = entries.schema["v"].dataType.simpleString()
    rows = materialize(entries.mapInArrow(
        coded, f"cell int, v {kind}, ids array<long>, bits binary, norm double, cosine double"), "ann-index")
    found = rows.groupBy("cell").agg(F.count("*").alias("n"), F.avg(F.col("norm") ** 2).alias("spread")).collect()
    spreads = np.zeros(len(centres))
    for r in found:
        spreads[r["cell"]] = math.sqrt(r["spread"])
    return Index(rows, centres, spreads, rotation, {r["cell"]: r["n"] for r in found}, k)


def _order_of_cells(queries: np.ndarray, centres: np.ndarray, spreads: np.ndarray) -> np.ndarray:
    """For each query the cells, first those whose upper members promise the largest inner products."""
    reach = np.linalg.norm(queries, axis=1)[:, None] * spreads * 2 / math.sqrt(centres.shape[1])
    return np.argsort(-(queries @ centres.T + reach), axis=1, kind="stable")


def exact_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed component after component, whatever stands beside them."""
    return (np.ascontiguousarray(vectors.T) * query[:, None]).sum(axis=0)


def _best(scores: np.ndarray, ids: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``most`` (score, id): largest scores first, smaller ids among equal ones."""
    flat = np.concatenate(ids)
    spread = np.repeat(scores, [len(i) for i in ids])
    order = np.lexsort((flat, -spread))[:most]
    return spread[order], flat[order]


def calibrate(index: Index, queries: DataFrame, recall: float = 0.99, sample: int = 64) -> int:
    """How many cells a query visits: as many as hold ``recall`` of the true nearest vectors of a sample of queries.

    The sample, at most ``sample`` queries of the least hashes, is compared with every row of the index.
    """
    rows = queries.orderBy(F.xxhash64("v"), "rep").limit(sample).select("v").toArrow()
    if len(index.centres) == 1 or not rows.num_rows:
        return 1
    dim, centres, most = index.dim, index.centres, index.k + 1
    asked = matrix(rows["v"], dim)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, home = np.zeros((len(asked), 0)), np.zeros((len(asked), 0), np.int32)
        for batch in batches:
            scores = asked @ matrix(batch.column(1), dim).T
            cell = np.broadcast_to(batch.column(0).to_numpy(), scores.shape)
            best, home = np.hstack([best, scores]), np.hstack([home, cell])
            if best.shape[1] > most:
                at = np.argpartition(-best, most - 1, axis=1)[:, :most]
                best, home = np.take_along_axis(best, at, 1), np.take_along_axis(home, at, 1)
        number = np.repeat(np.arange(len(asked), dtype=np.int32), best.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(home.ravel()), pa.array(best.ravel())],
                                         ["query", "cell", "score"])

    first = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    found = (index.rows.select("cell", "v").mapInArrow(scan, "query int, cell int, score double")
             .withColumn("place", first).where(F.col("place") <= most).select("query", "cell").collect())
    order = _order_of_cells(asked, centres, index.spreads)
    spots = np.sort([int(np.flatnonzero(order[r["query"]] == r["cell"])[0]) for r in found])
    return int(spots[max(0, math.ceil(recall * len(spots)) - 1)]) + 1


def _visits(index: Index, queries: DataFrame, visits: int) -> DataFrame:
    """(cell, rep, v): each query once for each cell it visits."""
    dim, centres, spreads = index.dim, index.centres, index.spreads

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = _order_of_cells(matrix(batch.column(1), dim), centres, spreads)[:, :visits]
            again = pa.array(np.repeat(np.arange(batch.num_rows), cells.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells.ravel().astype(np.int32)), *(c.take(again) for c in batch.columns)], ["cell", "rep", "v"])

    kind = queries.schema["v"].dataType.simpleString()
    return queries.mapInArrow(spread, f"cell int, rep long, v {kind}")


def _search_block(index: Index, epsilon: float):
    """Queries against one block of a cell: at most k + 1 (rep, id, score) for each query."""
    centres, rotation, most, dim = index.centres, index.rotation, index.k + 1, index.dim
    schema = pa.schema([("rep", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        reps, found, scores = [], [], []
        if block.num_rows and asked.num_rows:
            centre = centres[block["cell"][0].as_py()]
            vectors = matrix(block["v"], dim)
            bits = np.frombuffer(b"".join(block["bits"].to_pylist()), np.uint8).reshape(block.num_rows, -1)
            norms, cosines = block["norm"].to_numpy(), block["cosine"].to_numpy()
            lists = block["ids"].combine_chunks()
            starts, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
            queries, names = matrix(asked["v"], dim), asked["rep"].to_numpy()
            for begin in range(0, len(queries), _CHUNK):
                part = queries[begin:begin + _CHUNK]
                estimates, uppers = estimate(part, centre, rotation, bits, norms, cosines, epsilon)
                for query, name, guess, upper in zip(part, names[begin:begin + _CHUNK], estimates, uppers):
                    at = np.arange(len(vectors))
                    if len(vectors) > most:
                        leading = np.argpartition(-guess, most - 1)[:most]
                        at = np.flatnonzero(~(upper < (vectors[leading] @ query).min()))
                        rough = vectors[at] @ query
                        if len(at) > most:
                            edge = -np.partition(-rough, most - 1)[most - 1]
                            at = at[~(rough < edge - 1e-9 * max(abs(edge), np.abs(rough).max()))]
                    exact = exact_products(vectors[at], query)
                    score, one = _best(exact, [ids[starts[i]:starts[i + 1]] for i in at], most)
                    reps.append(np.full(len(one), name))
                    found.append(one)
                    scores.append(score)
        columns = [np.concatenate(x) if x else [] for x in (reps, found, scores)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def nearest(rows: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20,
            epsilon: float = 3.0, recall: float = 0.99, cell_rows: int = 8192, block_queries: int = 8192) -> DataFrame:
    """(query_id, rank, key, score): for each query its ``k`` nearest rows but its own, by inner product.

    ``key`` is an integer. Rows and queries without a key, and vectors that are null, zero or hold null or non-finite
    components, take no part; a vector shorter than the longest counts as filled up with zeros. Equal rows count once;
    different vectors under one key are rows, and queries, of their own. Ties go to the smaller key. Fewer rows than ``k``
    give all; an empty table gives none. Other columns are not looked at.

    Work is dealt in blocks of about ``cell_rows`` entries of a cell and ``block_queries`` queries that visit it, so no
    cell and no query vector, however common, fills a task; equal queries are searched once.
    """
    index = build(rows, key, vector, k, cell_rows)
    if index is None:
        return rows.sparkSession.createDataFrame([], f"query_id long, rank int, `{key}` long, score double")
    asked = _usable(queries, key, vector)
    reps = materialize(asked.groupBy("v").agg(F.min("id").alias("rep")).select("rep", "v"), "ann-queries")
    visiting = _visits(index, reps, calibrate(index, reps, recall))
    asks = {r["cell"]: r["count"] for r in visiting.groupBy("cell").count().collect()}
    deal = rows.sparkSession.createDataFrame(
        [(c, -(-n // cell_rows), -(-asks.get(c, 0) // block_queries)) for c, n in index.sizes.items()],
        "cell int, shards int, blocks int").where("blocks > 0")
    # One row for each cell, so this broadcast is bounded by the number of centres.
    stored = index.rows.join(F.broadcast(deal), "cell").select(
        "cell", F.pmod(F.xxhash64("v"), "shards").cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "v", "ids", "bits", "norm", "cosine")
    sent = visiting.join(F.broadcast(deal), "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
        F.pmod(F.xxhash64("rep"), "blocks").cast("int").alias("block"), "rep", "v")
    place = ["cell", "shard", "block"]
    hits = stored.groupBy(*place).cogroup(sent.groupBy(*place)).applyInArrow(
        _search_block(index, epsilon), "rep long, id long, score double")
    # No two hits of a query differ in nothing but the block: an entry is in one cell and shard.
    order = F.row_number().over(Window.partitionBy("rep").orderBy(F.desc("score"), "id"))
    best = hits.withColumn("place", order).where(F.col("place") <= k + 1).groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("best"))
    names = asked.join(reps, "v").select(F.col("id").alias("query_id"), "rep").distinct()
    others = F.slice(F.filter("best", lambda b: b["id"] != F.col("query_id")), 1, k)
    return names.join(best, "rep").select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias(key), F.col("hit.score").alias("score"))
