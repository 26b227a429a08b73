"""Substring deduplication by repeated-phrase automata.

A window of 13 words has an anchor, the least of its runs of seven words by hash, which only depends on the window.
Anchors that occur in several documents point at the passages that may recur; these are cut out as segments. Windows of
segments that several documents share are confirmed by their words. Sharded Aho-Corasick automata of the
confirmed windows then run over all segments and locate every occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiq.llm.common import free_name, materialize, shuffle_partitions

WINDOW = 13
_ANCHOR = 7
_CHUNK = 1 << 20     # bytes of text that are hashed at once
_MOST_BITS = 30      # of the pre-filter: 2 to this power at most
_HOT_SHARE = 10_000  # an anchor with a larger share of all occurrences than one in so many is spread
_HOT_ROWS = 2000     # and one with fewer rows never is
_FEW = 1 << 20       # keys of 16 or 40 bytes that are broadcast at most


def split_words(text: str | None) -> list[bytes]:
    """Words are runs without ASCII white space."""
    return (text or "").encode("utf-8").split()


def _byte_codes() -> np.ndarray:
    """An odd 64-bit number for each byte; blanks count nothing."""
    codes = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0xD1B54A32D192ED03)
    codes = (codes ^ (codes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    codes = (codes ^ (codes >> np.uint64(27))) | np.uint64(1)
    codes[list(_BLANKS)] = 0
    return codes


_BLANKS = b" \t\n\x0b\x0c\r"
_IS_BLANK = np.isin(np.arange(256), list(_BLANKS))
_CODES = _byte_codes()


class Chunk:
    """The words of some texts: their bytes with one blank after each, where each starts, and 64 bits of each."""

    def __init__(self, texts: list[bytes]):
        joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        blank = _IS_BLANK[joined]
        follows = np.concatenate(([True], blank[:-1]))
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        kept = joined[~(blank & follows)]
        kept[_IS_BLANK[kept]] = 32
        ends = np.flatnonzero(kept == 32)
        self.bytes = kept.tobytes()
        self.starts = np.concatenate(([0], ends + 1))
        # The words of text i are those from first[i] to first[i + 1].
        self.first = np.searchsorted(np.flatnonzero(~blank & follows), begins)
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.hashes = self._hashes(kept)

    def _hashes(self, kept: np.ndarray) -> np.ndarray:
        if not len(kept):
            return np.zeros(0, np.uint64)
        sizes = np.diff(self.starts)
        powers = np.full(int(sizes.max()), 0x9FB21C651E98DF25, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        place = np.arange(len(kept)) - np.repeat(self.starts[:-1], sizes)
        return np.add.reduceat(_CODES[kept] * powers[place], self.starts[:-1])

    def passages(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows of one text with one anchor: (text, first window, last window, hash of the anchor)."""
        at, runs = anchors(self.hashes)
        none = np.zeros(0, np.int64)
        if not len(at):
            return none, none, none, none.view(np.uint64)
        windows = np.flatnonzero(self.text_of[:len(at)] == self.text_of[WINDOW - 1:])
        at = at[windows]
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else none
        last = np.append(first[1:], len(at))[:len(first)] - 1
        return self.text_of[windows[first]], windows[first], windows[last], runs[at[first]]

    def words(self, start: int, stop: int) -> bytes:
        return self.bytes[self.starts[start]:self.starts[stop] - 1]


def chunks(column: pa.Array) -> Iterator[tuple[int, Chunk]]:
    """(row of the first text, chunk) of a column of texts; a longer text is a chunk of its own."""
    held, size, begin = [], 0, 0
    for i, value in enumerate(column.cast(pa.binary())):
        text = value.as_py() or b""
        if held and size + len(text) > _CHUNK:
            yield begin, Chunk(held)
            held, size, begin = [], 0, i
        held.append(text)
        size += len(text)
    if held:
        yield begin, Chunk(held)


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window the place of its anchor, and the hashes of all runs of seven words."""
    n = len(hashes) - _ANCHOR + 1
    if len(hashes) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    runs = np.zeros(n, np.uint64)
    for i in range(_ANCHOR):
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n]
    runs = (runs ^ (runs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    runs ^= runs >> np.uint64(32)
    windows = len(hashes) - WINDOW + 1
    best, at = runs[:windows].copy(), np.arange(windows)
    for i in range(1, WINDOW - _ANCHOR + 1):
        nearer = runs[i:i + windows] < best
        best = np.where(nearer, runs[i:i + windows], best)
        at = np.where(nearer, np.arange(windows) + i, at)
    return at, runs


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, digest): each anchor of a text once."""
    for batch in batches:
        for begin, chunk in chunks(batch.column(1)):
            text, _, _, anchor = chunk.passages()
            order = np.lexsort((anchor, text))
            text, anchor = text[order], anchor[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[new].view(np.int64)), batch.column(0).take(pa.array(begin + text[new]))], ["anchor", "digest"])


def _segment_rows(state):
    """(anchor, salts, salt, id, digest, starts, words): runs of windows with one anchor that may recur.

    What a text repeats is one row with all its starts. The rows of a hot anchor are dealt to its salts by their number,
    so that rows repeated in the input part too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, hot_anchors, hot_salts = state.value
        shift = np.uint64(64 - (len(bits) * 8).bit_length() + 1)
        turn = 0
        for batch in batches:
            for begin, chunk in chunks(batch.column(1)):
                text, first, last, anchor = chunk.passages()
                place = anchor >> shift
                likely = (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
                chosen = np.flatnonzero(likely)
                if not len(chosen):
                    continue
                words, starts, kept = [], [], []
                seen: dict[tuple[int, bytes], list[int]] = {}
                for i, t, a, b in zip(chosen.tolist(), text[chosen].tolist(), first[chosen].tolist(), last[chosen].tolist()):
                    passage = chunk.words(a, b + WINDOW)
                    places = seen.get((t, passage))
                    if places is None:
                        places = seen[t, passage] = []
                        words.append(passage)
                        starts.append(places)
                        kept.append(i)
                    places.append(a - int(chunk.first[t]))
                text, signed = text[kept], anchor[kept].view(np.int64)
                salts = np.ones(len(kept), np.int64)
                if len(hot_anchors):
                    spot = np.minimum(np.searchsorted(hot_anchors, signed), len(hot_anchors) - 1)
                    salts = np.where(hot_anchors[spot] == signed, hot_salts[spot], 1)
                number = np.arange(turn, turn + len(kept), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
                dealt = number.astype(np.int64) % salts
                turn += len(kept)
                at = pa.array(begin + text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed), pa.array(salts.astype(np.int32)), pa.array(dealt.astype(np.int32)),
                     batch.column(0).take(at), batch.column(2).take(at),
                     pa.array(starts, pa.list_(pa.int32())), pa.array(words, pa.binary()).cast(pa.string())],
                    ["anchor", "salts", "salt", "id", "digest", "starts", "words"])

    return run


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, salts, first, last, phrase) of the windows of different segments (anchor, salts, first, last, words)."""
    for batch in batches:
        row, phrases = [], []
        for i, text in enumerate(batch.column(4).to_pylist()):
            words = text.encode("utf-8").split()
            found = {b" ".join(words[a:a + WINDOW]) for a in range(len(words) - WINDOW + 1)}
            phrases += found
            row += [i] * len(found)
        at = pa.array(row, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(at) for c in range(4)), pa.array(phrases, pa.binary()).cast(pa.string())],
            ["anchor", "salts", "first", "last", "phrase"])


class _Shard:
    """The automaton of a shard's phrases. Each word is spelled as one letter, so a phrase has thirteen."""

    def __init__(self):
        self.letters: dict[str, str] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        self.made = False

    def spell(self, words: str) -> str:
        letters = self.letters
        return "".join([letters.get(w) or letters.setdefault(w, chr(len(letters) + 1)) for w in words.split(" ")])

    def add(self, spelled: str, first: int) -> None:
        self.automaton.add_word(spelled, first)

    def find(self, spelled: str) -> list[tuple[int, int]]:
        """Where phrases start in the spelled words, each with the least key that has it."""
        if not len(self.automaton):
            return []
        if not self.made:
            self.automaton.make_automaton()
            self.made = True
        return [(end - WINDOW + 1, first) for end, first in self.automaton.iter(spelled)]


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (shard, kind, id, digest, starts, words) in order of shards: starts of windows to remove.

    Kind 0 is a phrase confirmed elsewhere, with the least key that has it; kind 1 a segment. A shard's segments are held
    until all are there, since any two of them may confirm a phrase.
    """
    now, ready, held = None, {}, {}
    for batch in batches:
        for number, kind, own, digest, starts, words in zip(*(c.to_pylist() for c in batch.columns)):
            if number != now:
                if held:
                    yield _located(ready, held)
                now, ready, held = number, {}, {}
            if kind == 0:
                ready[words] = own
            else:
                held.setdefault(words, []).append((own, digest, starts))
    if held:
        yield _located(ready, held)


def _located(ready: dict[str, int], held: dict[str, list[tuple]]) -> pa.RecordBatch:
    """Confirm what two documents of the shard share, compile it with what is ready, and run it over the segments.

    ``held`` has each different segment once, with (key, digest, starts) of all texts that have it.
    """
    shard = _Shard()
    first: dict[str, int] = {}
    shared = set()
    spelled_of = []
    for text, places in held.items():
        own = min(places)[0]
        several = max(places)[0] != own
        spelled = shard.spell(text)
        spelled_of.append(spelled)
        for a in range(len(spelled) - WINDOW + 1):
            phrase = spelled[a:a + WINDOW]
            known = first.setdefault(phrase, own)
            if several or known != own:
                shared.add(phrase)
                if own < known:
                    first[phrase] = own
    ahead = {shard.spell(phrase): own for phrase, own in ready.items()}
    for phrase in shared:
        shard.add(phrase, min(first[phrase], ahead.pop(phrase, first[phrase])))
    for phrase, own in ahead.items():
        shard.add(phrase, own)
    rows = []
    for spelled, places in zip(spelled_of, held.values()):
        if found := shard.find(spelled):
            for own, digest, starts in places:
                if ats := [at for at, least in found if least < own]:
                    rows.append((own, digest, [start + at for start in starts for at in ats]))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.list_(pa.int32()))], ["id", "digest", "starts"])


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, digest, starts): for each (key, digest of the text) where windows start that a smaller key's other text has too.

    Rows with a null key have no place in the order: nothing is removed from them, and they remove nothing. Rows that share
    a key don't repeat each other.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where(
        F.col("id").isNotNull() & F.col("text").isNotNull())
    # Copies of one whole text don't make an anchor recur; remove_repeats knows them by their texts.
    recurring = materialize(
        rows.select(F.xxhash64("text").alias("digest"), "text").mapInArrow(_anchor_rows, "anchor long, digest long")
        .groupBy("anchor").agg(F.count("*").alias("uses"), F.min("digest").alias("low"), F.max("digest").alias("high"))
        .where("low < high").select("anchor", "uses"), "anchors")
    totals = recurring.agg(F.count("*").alias("n"), F.sum("uses").alias("uses")).first()
    bits = _bits(recurring, totals["n"])
    level = max(_HOT_ROWS, (totals["uses"] or 0) // _HOT_SHARE)
    # No more than _HOT_SHARE anchors can exceed that share of all occurrences.
    hot = sorted((r["anchor"], -(-r["uses"] // level)) for r in recurring.where(F.col("uses") > level).collect())
    spread = (np.array([h[0] for h in hot], np.int64), np.array([h[1] for h in hot], np.int64))
    segments = materialize(rows.withColumn("digest", F.xxhash64("text")).mapInArrow(
        _segment_rows(spark.sparkContext.broadcast((bits, *spread))),
        "anchor long, salts int, salt int, id long, digest long, starts array<int>, words string"), "segments")
    # Only the phrases of spread anchors are confirmed ahead of the shards, and handed to each of theirs.
    dealt = (segments.where("salts > 1").groupBy("anchor", "salts", "words").agg(F.min("id").alias("first"), F.max("id").alias("last"))
             .select("anchor", "salts", "first", "last", "words")
             .mapInArrow(_window_rows, "anchor long, salts int, first long, last long, phrase string").groupBy("anchor", "salts", "phrase")
             .agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first < last").select(
        "anchor", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.lit(0).alias("kind"), F.col("first").alias("id"), F.lit(0).cast("long").alias("digest"),
        F.lit(None).cast("array<int>").alias("starts"), F.col("phrase").alias("words")))
    streamed = segments.select("anchor", "salt", F.lit(1).alias("kind"), "id", "digest", "starts", "words")
    parts = shuffle_partitions(spark)
    sharded = dealt.unionByName(streamed).select(
        F.pmod(F.xxhash64("anchor", "salt"), F.lit(16 * parts)).cast("int").alias("shard"), "kind", "id", "digest", "starts", "words")
    return sharded.repartition(parts, "shard").sortWithinPartitions("shard", "kind").mapInArrow(
        _locate, "id long, digest long, starts array<int>")


def _small(keys: DataFrame) -> DataFrame:
    """Stored keys, broadcast up to ``_FEW`` of them; more are joined by a shuffle, which the adaptive skew join splits."""
    return F.broadcast(keys) if keys.count() <= _FEW else keys


def _bits(recurring: DataFrame, rows: int) -> np.ndarray:
    """A bit for each value of the upper bits of a recurring anchor; it only ever lets too much through."""
    power = min(_MOST_BITS, max(16, (16 * max(1, rows) - 1).bit_length()))
    place = F.shiftrightunsigned("anchor", 64 - power)
    packed = (recurring.select(F.shiftrightunsigned(place, 6).alias("at"), place.bitwiseAND(63).cast("int").alias("spot"))
              .select("at", F.expr("shiftleft(1L, spot)").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())
    table = np.zeros(1 << (power - 6), np.int64)
    table[packed.column("at").to_numpy()] = packed.column("bits").to_numpy()
    return table.view(np.uint8)


def cover(starts, words: int) -> np.ndarray:
    """Which of so many words a window from one of the starts covers."""
    change = np.zeros(words + 1, np.int64)
    at = np.unique(np.asarray(starts, np.int64))
    np.add.at(change, at, 1)
    np.add.at(change, at + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept, spans) for every row: the words left, joined by a blank, and the word ranges removed.

    A word goes if a window over it also starts in a document with a smaller key; windows are judged on the input.
    All windows of a copy of a whole earlier text are repeats. A null or empty text has no words; a text of fewer than 13 words keeps them all; repeated rows each have their row.
    """
    texts = docs.select(F.col(key).cast("long").alias("id"), F.sha2(text, 256).alias("sha"), F.xxhash64(text).alias("digest")).where(
        F.col("id").isNotNull() & F.col(text).isNotNull())
    firsts = _small(materialize(texts.groupBy("sha").agg(
        F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("sha", "first"), "firsts"))
    copies = materialize(texts.join(firsts, "sha").where(F.col("id") > F.col("first")).select("id", "digest").distinct(), "copies")
    # A copy has no window that the first of its text lacks, and all of its own are known to repeat.
    place = free_name(docs, "place_of")
    told = _small(copies.select(F.struct("id", "digest").alias(place)))
    own = F.struct(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("digest"))
    once = docs.join(told, own == F.col(place), "left_anti")
    found = (repeated_windows(once, key, text).withColumn("copy", F.lit(False)).unionByName(
                 copies.withColumn("starts", F.lit(None).cast("array<int>")).withColumn("copy", F.lit(True)))
             .groupBy("id", "digest").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.max("copy").alias("copy"))
             .select(F.col("id").alias("found_id"), F.col("digest").alias("found_digest"), "starts", "copy"))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).withColumn("digest", F.xxhash64("text"))
    joined = rows.join(found, (F.col("id") == F.col("found_id")) & (F.col("digest") == F.col("found_digest")), "left").select(
        "id", "text", "starts", "copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, kept, spans = [], [], [], []
            for value, starts, copy in zip(batch.column(1), batch.column(2), batch.column(3).to_pylist()):
                words, starts = split_words(value.as_py()), starts.as_py() or []
                if copy:
                    starts = range(len(words) - WINDOW + 1)
                covered = cover(starts, len(words))
                edges = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
                sizes.append(len(words))
                gone.append(int(covered.sum()))
                left = [w for w, c in zip(words, covered.tolist()) if not c] if len(starts) else words
                kept.append(b" ".join(left).decode())
                spans.append(edges.reshape(-1, 2).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(spans, pa.list_(pa.list_(pa.int64())))], [key, "n_words", "n_removed", "kept", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return joined.mapInArrow(
        run, f"`{key}` {kind}, n_words long, n_removed long, kept string, spans array<array<bigint>>")

