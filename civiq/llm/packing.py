"""Best-two-fit packing of token pieces into sequences.

Pieces of one length are interchangeable, so bins are planned on the counts per length, of which there are no more
than the capacity: a bin's pattern is repeated as often as its lengths last. Each piece then finds its place by its
rank among those of its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civiq.llm import tokens
from civiq.llm.common import materialize

_SHARE = 50_000  # pieces whose ranks are found in one place


def token_pieces(docs: DataFrame, capacity: int = 2048, end: int = 0, vocabulary: str | None = None,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids_crc32): each document's ids and the end id, cut only where over ``capacity``.

    A null or empty text is a piece of one token, the end id.
    """
    state = docs.sparkSession.sparkContext.broadcast(tokens.load(vocabulary or tokens.default_vocabulary()))
    encode, id_array, crc32 = tokens.encode, tokens.id_array, tokens.crc32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, value in enumerate(batch.column(1)):
                ids = id_array(encode(value.as_py(), state.value), state.value, end)
                for at in range(0, len(ids), capacity):
                    part = ids[at:at + capacity]
                    row.append(i)
                    piece.append(at // capacity)
                    start.append(at)
                    length.append(len(part))
                    crc.append(crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], [key, "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long")


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(how often, lengths) of the bins for so many pieces of each length.

    A bin takes the longest piece that fits until none does. Then its shortest piece makes way for the two unpacked
    ones that fill the gap it leaves best, if they fill more than it did; and again, as long as that helps.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    plan = []
    while left.any():
        longest = np.maximum.accumulate(np.where(left > 0, np.arange(capacity + 1), 0))
        free, chosen, gap = left.copy(), [], capacity
        while gap and (take := _longest(free, longest, gap)):
            chosen.append(take)
            free[take] -= 1
            gap -= take
        while gap:
            shortest = min(chosen)
            pair = _tightest_pair(free, gap + shortest)
            if sum(pair) <= shortest:
                break
            chosen.remove(shortest)
            free[shortest] += 1
            for length in pair:
                chosen.append(length)
                free[length] -= 1
            gap -= sum(pair) - shortest
        uses = left - free
        at = np.flatnonzero(uses)
        times = int((left[at] // uses[at]).min())
        left -= times * uses
        plan.append((times, sorted(chosen, reverse=True)))
    return plan


def _longest(free: np.ndarray, longest: np.ndarray, most: int) -> int:
    """The longest length of at most ``most`` with a piece left; 0 if none."""
    length = int(longest[most])
    while length and not free[length]:
        length = int(longest[length - 1])
    return length


def _tightest_pair(free: np.ndarray, room: int) -> tuple[int, int]:
    """Two unpacked lengths with the largest sum of at most ``room``; zeros if there are none."""
    room = min(room, len(free) - 1)
    first = np.flatnonzero(free[:room])
    if not len(first):
        return 0, 0
    longest = np.maximum.accumulate(np.where(free > 0, np.arange(len(free)), 0))
    second = longest[np.minimum(room - first, first)]
    alone = (second == first) & (free[first] < 2)
    second = np.where(alone, longest[np.maximum(second - 1, 0)], second)
    sums = np.where(second > 0, first + second, 0)
    best = int(sums.argmax())
    return (int(first[best]), int(second[best])) if sums[best] else (0, 0)


def pack(pieces: DataFrame, capacity: int = 2048, key: str = "doc_id") -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; sequences are numbered from 0 and gapless inside.

    ``pieces`` has (key, piece, length) and should be stored, as it is read twice. The counts per length and the plan
    have a size bounded by the capacity; ranks are found in shares of bounded size, so a length that very many
    pieces have is no bottleneck. Equal rows are pieces of their own; an empty table gives an empty table.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    state = spark.sparkContext.broadcast(_slots(best_two_fit(counts, capacity)))
    shares = max(1, -(-sum(counts.values()) // _SHARE))
    dealt = pieces.withColumn("share", F.pmod(F.xxhash64(key, "piece"), F.lit(shares)).cast("int"))
    before = dealt.groupBy("length", "share").count().select("length", "share", (
        F.sum("count").over(Window.partitionBy("length").orderBy("share")) - F.col("count")).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "share").orderBy(key, "piece")) - 1
    ranked = dealt.withColumn("within", within).join(before, ["length", "share"]).withColumn(
        "rank", F.col("within") + F.col("before")).select(*pieces.columns, "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, base, offset = state.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            wanted = (length.astype(np.int64) << 44) + rank
            slot = np.searchsorted(starts, wanted, "right") - 1
            sequence = base[slot] + wanted - starts[slot]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(n)) for n in names), pa.array(sequence), pa.array(offset[slot])],
                [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(run, kinds + ", sequence_id long, offset long")


def _slots(plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each run of ranks of a length: its start (length in the upper bits), its first sequence, the place in it."""
    used, rows, sequence = {}, [], 0
    for times, lengths in plan:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            rows.append(((length << 44) + rank, sequence, offset))
            used[length] = rank + times
            offset += length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()


def pack_documents(docs: DataFrame, capacity: int = 2048, end: int = 0, vocabulary: str | None = None,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """``token_pieces``, stored, then ``pack``."""
    return pack(materialize(token_pieces(docs, capacity, end, vocabulary, key, text), "pieces"), capacity, key)
