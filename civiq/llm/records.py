"""Token ids as length-delimited binary records with masked checksums, and an offset index beside each file.

A record is framed as: length (8 bytes), masked CRC-32 of those bytes (4), payload, masked CRC-32 of the payload (4),
all little-endian. The payload is a flag byte (bit 0: the key is present, bit 1: ids take four bytes, else two), the
key (8), the number of ids (4) and the ids. The index holds each record's offset in 8 bytes, so that records can be
read in any order.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civiq.llm import tokens
from civiq.llm.common import materialize, shuffle_partitions
from civiq.session import scratch_dir

_HEAD, _PAYLOAD = "<QI", "<BqI"
_BATCH = 1000


def masked(data: bytes) -> int:
    """CRC-32 rotated right by 15 bits plus a constant, so that a checksum of stored checksums is no fixed point."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def read_frame(stream) -> bytes | None:
    """The next payload, None at the end; damaged or cut-off records raise."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12:
        raise ValueError("cut-off record")
    size, check = struct.unpack(_HEAD, head)
    if masked(head[:8]) != check:
        raise ValueError("damaged record length")
    payload, tail = stream.read(size), stream.read(4)
    if len(payload) < size or len(tail) < 4:
        raise ValueError("cut-off record")
    if masked(payload) != struct.unpack("<I", tail)[0]:
        raise ValueError("damaged record")
    return payload


def to_payload(key: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) >= 1 << 16
    return struct.pack(_PAYLOAD, (key is not None) | wide << 1, key or 0, len(ids)) + ids.astype("<u4" if wide else "<u2").tobytes()


def from_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, key, count = struct.unpack_from(_PAYLOAD, payload)
    ids = np.frombuffer(payload, "<u4" if flags & 2 else "<u2", count, struct.calcsize(_PAYLOAD))
    return key if flags & 1 else None, ids.astype("<u4")


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path within it."""
    local = re.fullmatch(r"(?:file:)?/+(.*)", path)
    return (fs.LocalFileSystem(), f"/{local[1]}") if local else fs.FileSystem.from_uri(path)


def read_at(path: str, places: list[int]) -> Iterator[tuple[int | None, np.ndarray]]:
    """The records of one file with these numbers, in this order, by its index."""
    store, inner = open_store(path)
    with store.open_input_file(f"{inner}.idx") as index, store.open_input_file(inner) as data:
        for place in places:
            data.seek(struct.unpack("<Q", index.read_at(8, 8 * place))[0])
            yield from_payload(read_frame(data))


def write_records(docs: DataFrame, folder: str, end: int = 1, vocabulary: str | None = None, key: str = "doc_id",
                  text: str = "text", parts: int | None = None) -> DataFrame:
    """Encode, append the end id and write in ascending key order (null keys first); return the manifest.

    Each task writes one file of a key range and its index under a name of its own attempt, and renames both when
    whole, so a task that is run again leaves no half file. The manifest (part, path, records, ids) is stored.
    A null or empty text is a record of the end id alone; an empty table writes no file.
    """
    spark = docs.sparkSession
    state = spark.sparkContext.broadcast(tokens.load(vocabulary or tokens.default_vocabulary()))
    encode, id_array = tokens.encode, tokens.id_array

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, inner = open_store(folder)
        final = f"{inner}/part-{task.partitionId():06d}.rec"
        store.create_dir(inner, recursive=True)
        trial = f"{final}.{task.taskAttemptId()}"
        count = total = at = 0
        with store.open_output_stream(trial) as data, store.open_output_stream(f"{trial}.idx") as index:
            for batch in batches:
                for number, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = id_array(encode(value.as_py(), state.value), state.value, end)
                    framed = frame(to_payload(number, ids))
                    data.write(framed)
                    index.write(struct.pack("<Q", at))
                    at, count, total = at + len(framed), count + 1, total + len(ids)
        if not count:
            store.delete_file(trial)
            store.delete_file(f"{trial}.idx")
            return
        store.move(f"{trial}.idx", f"{final}.idx")
        store.move(trial, final)
        yield pa.RecordBatch.from_arrays(
            [pa.array([task.partitionId()], pa.int32()), pa.array([f"{folder}/part-{task.partitionId():06d}.rec"]),
             pa.array([count], pa.int64()), pa.array([total], pa.int64())], ["part", "path", "records", "ids"])

    ordered = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).repartitionByRange(
        parts or shuffle_partitions(spark), F.col("key").asc_nulls_first()).sortWithinPartitions(
        F.col("key").asc_nulls_first(), F.xxhash64("text"))
    return materialize(ordered.mapInArrow(run, "part int, path string, records long, ids long"), "manifest")


def read_records(spark: SparkSession, manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every record, read from the files; ``start`` counts the ids before it."""
    before = manifest.select("part", "path", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    crc32 = tokens.crc32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, inner = open_store(row["path"])
                start, out = row["before"], []
                with store.open_input_stream(inner, buffer_size=1 << 20) as stream:
                    while (payload := read_frame(stream)) is not None:
                        number, ids = from_payload(payload)
                        out.append((number, start, len(ids), crc32(ids)))
                        start += len(ids)
                        if len(out) == _BATCH:
                            yield _rows(out, key)
                            out = []
                yield _rows(out, key)

    files = before.repartition(shuffle_partitions(spark), "part")
    return files.mapInArrow(run, f"`{key}` long, start long, n_tokens long, ids_crc32 long")


def _rows(out: list[tuple], key: str) -> pa.RecordBatch:
    columns = zip(*out) if out else ([], [], [], [])
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], [key, "start", "n_tokens", "ids_crc32"])


def round_trip(docs: DataFrame, end: int = 1, vocabulary: str | None = None) -> DataFrame:
    """Write the documents to a fresh folder that all executors share, and read the files back."""
    spark = docs.sparkSession
    return read_records(spark, write_records(docs, scratch_dir(spark, "records"), end, vocabulary))
