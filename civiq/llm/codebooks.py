"""Product codes of vectors with integer codebooks, by dictionaries of the values in each dimension.

Components become integers. In every dimension the different integers of a batch form a dictionary; their squared differences
to all entries of the codebook are tabulated once, and a part's distances are gathered from its dimensions' tables and added.
All arithmetic is on integers, so neither partitioning nor order of the rows can change a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiq.llm.common import free_name, materialize
from civiq.llm.vectors import is_finite, matrix

_LARGEST = 1 << 26  # beyond it squared distances could leave 64 bits
_ROWS = 4096        # rows whose distances are held at once


def to_integers(values: np.ndarray, scale: int = 256) -> np.ndarray:
    """floor(scale × x); an integer of 2^26 or more raises, as distances would leave 64 bits."""
    whole = np.floor(values * scale)
    if len(whole) and np.abs(whole).max(initial=0) >= _LARGEST:
        raise ValueError("a component is too large for codes of 64-bit distances")
    return whole.astype(np.int64)


def assign(integers: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared distances), a column a part: the nearest entry of each part's codebook, ties to the lower index.

    ``books`` is part × entry × position.
    """
    parts, entries, width = books.shape
    codes = np.zeros((len(integers), parts), np.uint8)
    errors = np.zeros((len(integers), parts), np.int64)
    span = max(np.abs(integers).max(initial=0), np.abs(books).max(initial=0))
    kind = np.int32 if (2 * int(span)) ** 2 * width < 2**31 else np.int64
    for part in range(parts):
        total = np.zeros((len(integers), entries), kind)
        for spot in range(width):
            values, place = np.unique(integers[:, part * width + spot], return_inverse=True)
            table = (values[:, None] - books[part, :, spot]).astype(kind) ** 2
            total += table[place]
        codes[:, part] = total.argmin(axis=1)
        errors[:, part] = np.take_along_axis(total, codes[:, part, None].astype(np.intp), 1)[:, 0]
    return codes, errors


def _pieces(batches: Iterator[pa.RecordBatch], dim: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with their last column's vectors as integers."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            piece = batch.slice(start, _ROWS)
            yield piece, to_integers(matrix(piece.column(piece.num_columns - 1), dim), scale)


def refine(rows: DataFrame, vector: str, books: np.ndarray, scale: int = 256) -> np.ndarray:
    """The codebooks with every entry replaced by the floored mean of the parts nearest to it; unused entries stay.

    Every task sums what it has; one row for each entry comes to the driver, whatever the size of the input.
    """
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for _, integers in _pieces(batches, parts * width, scale):
            codes, _ = assign(integers, books)
            for part in range(parts):
                own = np.column_stack([integers[:, part * width:(part + 1) * width], np.ones(len(integers), np.int64)])
                np.add.at(total[part], codes[:, part], own)
        used = total[..., width].ravel() > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.flatnonzero(used).astype(np.int32)), pa.array(list(total.reshape(-1, width + 1)[used]), pa.list_(pa.int64()))],
            ["entry", "total"])

    each = [F.sum(F.get("total", F.lit(i))).alias(f"s{i}") for i in range(width + 1)]
    found = rows.select(vector).mapInArrow(sums, "entry int, total array<long>").groupBy("entry").agg(*each).collect()
    new = books.copy().reshape(parts * entries, width)
    for r in found:
        new[r["entry"]] = [r[f"s{i}"] // r[f"s{width}"] for i in range(width)]
    return new.reshape(books.shape)


def train(rows: DataFrame, key: str, vector: str, parts: int = 16, entries: int = 64, rounds: int = 2,
          scale: int = 256) -> np.ndarray | None:
    """Codebooks started from the vectors with the smallest keys (repeated keys by vector, null keys last) and refined on all rows.

    Fewer rows give fewer entries, none give None.
    """
    first = rows.orderBy(F.asc_nulls_last(key), vector).limit(entries).select(vector).toArrow()[vector]
    if not len(first):
        return None
    longest = rows.agg(F.max(F.size(vector))).first()[0]
    width = max(1, -(-longest // parts))
    books = to_integers(matrix(first, parts * width), scale).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = refine(rows, vector, books, scale)
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 16,
             entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """(key, label, code, error, label_error, codebooks_sha256) for every row with a finite vector.

    ``code`` has two hex digits a part, ``error`` is the squared distance to the entries coded, ``label_error`` its sum over
    the rows of the same label, nulls being one label. Rows whose vector is null or holds null or non-finite components are
    left out; shorter vectors, and lengths that ``parts`` doesn't divide, are filled up with zeros. Repeated rows stay
    and count each; an empty table gives none. Other columns are not looked at. At most 256 entries.
    """
    kept = rows.where(is_finite(F.col(vector))).select(key, label, vector)
    names = {c: kept.schema[c].dataType.simpleString() for c in (key, label)}
    shape = "".join(f"`{c}` {t}, " for c, t in names.items())
    books = train(kept.select(key, vector), key, vector, parts, entries, rounds, scale)
    if books is None:
        return rows.sparkSession.createDataFrame(
            [], f"{shape} code string, error long, label_error long, codebooks_sha256 string")
    dim = books.shape[0] * books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, integers in _pieces(batches, dim, scale):
            codes, errors = assign(integers, books)
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:2], pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors.sum(axis=1))],
                [key, label, "code", "error"])

    coded = materialize(kept.mapInArrow(run, f"{shape} code string, error long"), "codes")
    same = free_name(coded, "same_label")
    sums = coded.groupBy(F.col(label).alias(same)).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col(label).eqNullSafe(F.col(same)), "left").drop(same).withColumn(
        "codebooks_sha256", F.lit(digest(books)))
