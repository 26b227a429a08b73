"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of k edits is cut into k + 1 pieces: an occurrence within the budget leaves one
piece whole. Pieces are found by one automaton; each hit is verified with Myers' bit-parallel distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiq.llm.common import code_points, free_name

ERROR_RATE = 0.1
BLOCK_CHARS = 1_000_000
_RUN = 4
_BLANKS = bytes(32 if i < 128 and not chr(i).isalnum() else i for i in range(256))

MATCHES = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("errors", T.IntegerType()),
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def normal_form(text: str | None) -> str:
    """Lower case, every ASCII character that is no letter or digit a blank, one blank between words and around them."""
    words = (text or "").lower().encode("utf-8", "replace").translate(_BLANKS).split()
    return (b" " + b" ".join(words) + b" ").decode() if words else ""


def budget(length: int, rate: float = ERROR_RATE) -> int:
    """Edits allowed against an item whose normal form, without the outer blanks, has ``length`` characters."""
    return int(length * rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """The item cut into ``errors`` + 1 pieces of like length, with their offsets."""
    n = len(item)
    cuts = [n * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_end(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of the item to any substring of the text, and where the first such substring ends.

    Myers' bit-parallel columns; one integer of any length holds a whole column.
    """
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    where: dict[str, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    up, down, score = full, 0, len(item)
    best, end = score, 0
    for at, c in enumerate(text, 1):
        eq = where.get(c, 0)
        diagonal = ((((eq & up) + up) ^ up) | eq | down) & full
        plus, minus = (down | ~(diagonal | up)) & full, up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = (minus | ~(diagonal | plus)) & full, plus & diagonal
        if score < best:
            best, end = score, at
    return best, end


def compile_items(rows, rate: float = ERROR_RATE):
    """The items' normal forms and an automaton of their pieces; each piece knows its items and offsets."""
    items, automaton = [], ahocorasick.Automaton()
    for item_id, text in rows:
        form = normal_form(text)
        if not form:
            continue
        errors = budget(len(form) - 2, rate)
        at = len(items)
        items.append((item_id, form, errors, np.unique(spelling(form))))
        for offset, piece in pieces(form, errors):
            known = automaton.get(piece, ())
            automaton.add_word(piece, (*known, (at, offset, len(piece))))
    if items:
        automaton.make_automaton()
    return items, automaton


def spelling(form: str) -> np.ndarray:
    """The hashed runs of four characters of a text, in order."""
    c = code_points(form)
    n = max(0, len(c) - _RUN + 1)
    out = np.zeros(n, np.uint32)
    for i in range(_RUN):
        out = out * np.uint32(31) + c[i:i + n]
    return ((out * np.uint32(0x9E3779B1)) >> np.uint32(18)).astype(np.int64)


def find(text: str | None, items: list, automaton) -> list[tuple[int, int, int, int]]:
    """(item_id, errors, start, end) of the closest occurrence of each item within its budget, in the text's normal form."""
    form = normal_form(text)
    if not form or not items:
        return []
    starts: dict[int, set[int]] = {}
    for end, owners in automaton.iter(form):
        for at, offset, length in owners:
            starts.setdefault(at, set()).add(end + 1 - length - offset)
    found, spelled = [], spelling(form)
    for at, places in starts.items():
        item_id, item, errors, grams = items[at]
        best = None
        for low, high in _merged(sorted(places), errors):
            low, high = max(0, low - errors), high + len(item) + errors
            # An edit spoils four runs of four at most; hashing can only hide that one is missing.
            there = np.bincount(spelled[low:max(low, high - _RUN + 1)], minlength=1 << 14)[grams]
            if np.count_nonzero(there) < len(grams) - _RUN * errors:
                continue
            window = form[low:high]
            distance, end = best_end(item, window)
            if distance <= errors and (best is None or distance < best[0]):
                back = best_end(item[::-1], window[:end][::-1])[1]
                best = (distance, low + end - back, low + end)
        if best:
            found.append((item_id, *best))
    return sorted(found)


def _merged(places: list[int], errors: int) -> list[tuple[int, int]]:
    """Runs of possible starts, each no wider than the budget."""
    runs = [[places[0], places[0]]]
    for place in places[1:]:
        if place - runs[-1][0] <= errors:
            runs[-1][1] = place
        else:
            runs.append([place, place])
    return [tuple(r) for r in runs]


def item_blocks(benchmark: DataFrame, item: str, text: str, block_chars: int) -> Iterator[list]:
    """The benchmark's rows in blocks of bounded size, one at a time on the driver; rows with null text are left out."""
    block, size = [], 0
    for row in benchmark.select(F.col(item).cast("long"), text).where(F.col(text).isNotNull()).toLocalIterator():
        block.append(tuple(row))
        size += len(row[1])
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def mark(docs: DataFrame, rows: list, name: str, text: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """All rows and columns with ``name``: the occurrences in the text of the given items, an empty list where none."""
    context = docs.sparkSession.sparkContext
    state = context.broadcast(compile_items(rows, rate))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("errors", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, automaton = state.value
        for batch in batches:
            found = [[dict(zip(("item_id", "errors", "start", "end"), m)) for m in find(t, items, automaton)]
                     for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, MATCHES)]))


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
            item_text: str = "text", rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(key, item_id, errors, start, end): a row for each document and test item within the item's error budget.

    The benchmark is the query set: it is taken in blocks of about ``block_chars``, and each block passes over all
    documents. Empty and null texts match nothing, nor do items without a letter or digit. Repeated documents and
    items each give their own rows. Positions count in the text's normal form.
    """
    found = None
    for rows in item_blocks(benchmark, item, item_text, block_chars):
        part = mark(docs.select(key, text), rows, "found", text, rate).select(key, F.explode("found").alias("m")).select(
            key, "m.item_id", "m.errors", "m.start", "m.end")
        found = part if found is None else found.unionByName(part)
    if found is None:
        kind = docs.schema[key].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"`{key}` {kind}, item_id long, errors int, start int, end int")
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
               rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows, all columns unchanged, that hold no test item within its error budget."""
    name, columns = free_name(docs, "found"), docs.columns
    for rows in item_blocks(benchmark, item, item_text, block_chars):
        docs = mark(docs, rows, name, text, rate).where(F.size(name) == 0).select(*columns)
    return docs
