"""Line deduplication by an exact set-similarity join, in DataFrame functions only.

A line is the set of its lower-cased words, each known by 64 bits: its length up to 63 and 58 bits of its hash. Words are
ordered, frequent ones last and long ones first, and two lines with a Jaccard similarity of at least the threshold share a
word among the first few of both: the prefix filter. Lengths and parities thin the candidates, and what is left is verified
on all words. Later matches are removed.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiq.llm.common import discard, free_name, materialize

_BUCKETS = 1 << 16  # entries of the table of frequent words
_FREQUENT = 16      # times the mean of the entries
_BITS = 1 << 22     # bits of the pre-filter of lines to verify, and of the table of hot words
_PARTS = 4          # parts of the words that sets meet by, one after the other
_HOT = 256          # prefixes of open sets from which a word is hot: sets don't meet by it alone
_IDS = 200_000      # ids of sets that are broadcast
THRESHOLD = (4, 5)  # Jaccard similarity as a fraction


def _constant(values: list[int], kind: str) -> Column:
    """A list as one constant of the plan; text that the optimizer folds into an array."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def _spaced(text: Column, blanks: str = "\t\r\x0b\x0c") -> Column:
    for blank in blanks:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return text


def _lines(text: Column) -> Column:
    """A text's lines, ASCII blanks as spaces; null counts as empty. Every text has at least one line."""
    return F.split(_spaced(F.coalesce(text, F.lit(""))), "\n")


def _prefix(n: Column, numerator: int, denominator: int) -> Column:
    """n - ceil(n × numerator / denominator) + 1"""
    return n - F.floor((n * numerator + denominator - 1) / F.lit(denominator)).cast("int") + 1


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(id, digest, n_lines, removed): for each different (key, text) its number of lines and the removed ones' indices.

    A line is removed where an earlier one, by (key, digest of the text, place in it), is at least as similar as the
    threshold, whether that one is removed or not. Null keys come last. Lines without a word are never removed.
    Rows that share key and text share their result. Null and empty texts have one line, which stays.
    """
    return _removed_lines(docs, key, text, threshold)[0]


def _removed_lines(docs: DataFrame, key: str, text: str, threshold: tuple[int, int]) -> tuple[DataFrame, list[DataFrame]]:
    """``removed_lines``, and the stored rows that it reads."""
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).withColumn(
        "digest", F.xxhash64("text", F.lit(7)))
    lines = materialize(_coded(source), "lines")
    sets = _sets(lines, threshold)
    found = _near_sets(sets, lines, threshold)
    near = reduce(DataFrame.unionByName, found)
    # Where a set has a near one before it all its lines go, else all but the first.
    repeated = sets.select("id", "parity", "hash", "first", "uses").join(
        near.select(F.col("l").alias("id"), F.lit(True).alias("near")).distinct(), "id", "left").where(
        "near or uses > 1").select("parity", "hash", F.when(F.col("near").isNull(), F.col("first")).alias("stays"))
    gone = lines.where("n > 0").select("doc", "line", "parity", "hash").join(repeated, ["parity", "hash"]).where(
        F.col("stays").isNull() | (F.struct("doc", "line") > F.col("stays"))).select("doc", F.col("line").alias("gone"))
    marks = lines.where("line = 0").select("doc", "n_lines", F.lit(None).cast("int").alias("gone")).unionByName(
        gone.select("doc", F.lit(None).cast("int").alias("n_lines"), "gone"))
    removed = marks.groupBy("doc").agg(F.max("n_lines").alias("n_lines"), F.sort_array(F.collect_set("gone")).alias("removed")).select(
        "doc.id", "doc.digest", "n_lines", "removed")
    return removed, [lines, sets, *found]


def _coded(source: DataFrame) -> DataFrame:
    """Each line with its words in order, as numbers, and their hash and parity: the one pass over the texts."""
    split = source.select(F.struct(F.col("id").isNull().alias("none"), "id", "digest").alias("doc"), _lines(F.col("text")).alias("lines"))
    lines = split.select("doc", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("line", "content"))
    coded = lines.select("doc", "n_lines", "line", F.sort_array(F.array_remove(F.array_distinct(F.transform(
        F.split(F.lower(F.col("content")), " "), _code)), _code(F.lit("")))).alias("codes"))
    return coded.select("doc", "n_lines", "line", F.size("codes").alias("n"), F.xxhash64("codes").alias("hash"),
                        _parity(F.col("codes")).alias("parity"), "codes")


def _code(word: Column) -> Column:
    """The longer the word, the less its number."""
    length = F.shiftleft((F.lit(31) - F.least(F.octet_length(word), F.lit(63))).cast("long"), 58)
    return length.bitwiseOR(F.shiftrightunsigned(F.xxhash64(word), 6))


def _parity(codes: Column) -> Column:
    return F.aggregate(codes, F.lit(0).cast("long"), lambda bits, c: bits.bitwiseXOR(F.call_function(
        "shiftleft", F.lit(1).cast("long"), c.bitwiseAND(63).cast("int"))))


def _sets(lines: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The different word sets: parity and hash, size, prefix and one word more, lines that have it and the first of these.
    The ids follow the first lines, so that the earlier set has the lesser id."""
    counts = _frequent(lines)

    def uses(code: Column) -> Column:
        return F.element_at(counts, (code.bitwiseAND(_BUCKETS - 1) + 1).cast("int"))

    few = _prefix(F.col("n"), *threshold) + 1
    by_use = F.transform(F.array_sort(F.transform("codes", lambda c: F.struct(uses(c).alias("uses"), c.alias("code")))), lambda c: c["code"])
    ordered = F.slice(F.when(F.exists(F.slice("codes", 1, few), lambda c: uses(c) > 0), by_use).otherwise(F.col("codes")), 1, few)
    # A word of a prefix is kept as 32 bits of its hash: enough to meet by, as all that meet are verified.
    prefix = F.transform(ordered, lambda c: (c.bitwiseAND(0xFFFFFFFF) - 0x80000000).cast("int"))
    half = _parity(F.filter("codes", lambda c: c.bitwiseAND(64) == 0))
    grouped = materialize(lines.where("n > 0").select(
        "doc", "line", "n", "parity", "hash", half.alias("half"), prefix.alias("prefix")).groupBy("parity", "hash").agg(
        F.min(F.struct("doc", "line")).alias("first"), F.count("*").alias("uses"), F.first("n").alias("n"),
        F.first("half").alias("half"), F.first("prefix").alias("prefix")), "grouped")
    sets = materialize(grouped.orderBy("first.doc.none", "first.doc.id", "first.doc.digest", "first.line").withColumn(
        "id", F.monotonically_increasing_id()), "sets")
    discard(grouped)
    return sets


def _frequent(lines: DataFrame) -> Column:
    """For each bucket of words in how many lines they are, or zero if not far more often than the mean: a constant of fixed size."""
    counts = {r["bucket"]: r["count"] for r in lines.select(F.explode("codes").alias("code")).groupBy(
        F.col("code").bitwiseAND(_BUCKETS - 1).alias("bucket")).count().collect()}
    least = _FREQUENT * max(1, sum(counts.values()) / _BUCKETS)
    return _constant([c if c > least else 0 for c in (counts.get(b, 0) for b in range(_BUCKETS))], "bigint")


def _bit_table(spots: DataFrame) -> Callable[[Column], Column]:
    """For the rows (spot), numbers below ``_BITS``: whether a spot may be among them. The bits are a constant of fixed size."""
    bits = {r["at"]: r["bits"] for r in spots.select(
        F.shiftright("spot", 6).cast("int").alias("at"), F.expr("shiftleft(1L, cast(spot & 63 as int))").alias("bit")).groupBy("at").agg(
        F.bit_or("bit").alias("bits")).collect()}
    filled = _constant([bits.get(i, 0) for i in range(_BITS // 64)], "bigint")
    return lambda spot: F.getbit(F.element_at(filled, (F.shiftright(spot, 6) + 1).cast("int")), F.pmod(spot, F.lit(64))) == 1


def _near_sets(sets: DataFrame, lines: DataFrame, threshold: tuple[int, int]) -> list[DataFrame]:
    """(l, e), ids: for every set that is as similar as the threshold to an earlier one, at least one such; two stored tables.

    Groups of near copies have very many pairs, so a set first meets few sets alone: the earliest of those that share two
    of the words of least hash in the prefixes. Only sets that this leaves open meet all of their candidates, for a part
    of the words at a time, whose shuffle is freed before the next.
    """
    met = materialize(_leaders(sets, threshold), "leaders")
    near = _verified(met, sets, lines, threshold)
    settled = near.select(F.col("l").alias("id")).distinct()
    if settled.count() <= _IDS:
        settled = F.broadcast(settled)
    left = materialize(sets.select("id", "n", "parity", "half", "prefix").join(settled, "id", "left_anti"), "open")
    hot = _hot_words(left)
    parts = [materialize(_candidates(left, sets, threshold, part, hot).distinct(), "candidates") for part in range(_PARTS)]
    discard(met, left)
    more = _verified(reduce(DataFrame.unionByName, parts), sets, lines, threshold)
    discard(*parts)
    return [near, more]


def _hot_words(left: DataFrame) -> Callable[[Column], Column]:
    """Whether very many of the sets have this word of a prefix; of other words some may count as hot, which changes no result."""
    often = left.select(F.explode("prefix").alias("word")).groupBy("word").count().where(F.col("count") > _HOT)
    table = _bit_table(often.select(_spot(F.col("word")).alias("spot")))
    return lambda word: table(_spot(word))


def _spot(word: Column) -> Column:
    return word.cast("long").bitwiseAND(_BITS - 1)


def _alike(n: Column, m: Column, bits: Column, threshold: tuple[int, int]) -> Column:
    """Whether sizes n, m and the bits that parities differ by allow the threshold: a word of only one of the sets turns one at most."""
    top, bottom = threshold
    return (n * bottom >= m * top) & (m * bottom >= n * top) & (bits * (top + bottom) <= (n + m) * (bottom - top))


def _leaders(sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(l, e): each set and the earliest ones of the slots it has, if lengths and parities allow a match.

    The slots of a set are the pairs among the three words of least hash in its prefix. Every set of a slot meets its
    earliest one alone, so the rows are as many as the slots at most, whatever the size of a group.
    """
    least = F.col("least")
    word = [F.try_element_at(least, F.lit(i)) for i in (1, 2, 3)]
    slots = F.when(F.size(least) < 3, F.array(F.xxhash64(*word[:2]))).otherwise(
        F.array(*[F.xxhash64(word[i], word[j]) for i, j in ((0, 1), (0, 2), (1, 2))]))
    held = sets.select("id", "n", "parity", F.slice(F.sort_array("prefix"), 1, 3).alias("least")).select(
        F.explode(slots).alias("slot"), "id", "n", "parity")
    earliest = held.groupBy("slot").agg(
        F.count("*").alias("members"), F.min("id").alias("e"), F.min_by("n", "id").alias("m"),
        F.min_by("parity", "id").alias("q")).where("members > 1").drop("members")
    return held.join(earliest, "slot").where((F.col("e") < F.col("id")) & _alike(
        F.col("n"), F.col("m"), F.bit_count(F.col("parity").bitwiseXOR(F.col("q"))), threshold)).select(F.col("id").alias("l"), "e").distinct()


def _candidates(left: DataFrame, right: DataFrame, threshold: tuple[int, int], part: int, hot: Callable[[Column], Column]) -> DataFrame:
    """(l, e): ids of a set among ``left`` and of an earlier one among ``right`` that share a prefix word of this part of
    the words and pass the filters.

    Similar sets have at least two words in common, and the first two of these stand in the prefixes with one word more.
    So sets don't meet by a hot word alone, whose pairs would be as the square of its uses: where the first common word is
    hot, they meet by the second, or by both if that is hot too.
    """
    top, bottom = threshold

    def spread(sets: DataFrame, side: str) -> DataFrame:
        # The shorter set of a pair is sure of a common word among fewer.
        short = _prefix(F.col("n"), 2 * top, top + bottom)
        spelled = sets.select("id", "n", "parity", "half", "prefix", F.posexplode("prefix").alias("place", "word")).where(
            F.pmod("word", F.lit(_PARTS)) == part).withColumn("hot", hot(F.col("word")))
        paired = spelled.select("id", "n", "parity", "half", "place", "word", "hot", F.posexplode(F.when(
            F.col("hot"), F.slice("prefix", F.col("place") + 2, F.size("prefix"))).otherwise(F.array("word"))).alias("step", "other"))
        words = paired.where(~F.col("hot") | hot(F.col("other"))).select(
            "id", "n", "parity", "half", F.when(F.col("hot"), F.col("place") + F.col("step") + 1).otherwise(F.col("place")).alias("at"),
            F.when(F.col("hot"), F.hash("word", "other")).otherwise(F.col("word")).alias("word"))
        return words.select(
            F.shiftleft(F.col("word").cast("long"), 32).bitwiseOR(F.shiftleft(F.col("n").cast("long"), 1)).bitwiseOR(
                (F.col("at") <= short).cast("long")).alias(f"packed_{side}"), F.col("half").alias(f"half_{side}"),
            F.col("parity").bitwiseXOR(F.col("half")).alias(f"rest_{side}"), F.col("id").alias(side))

    packed = {side: F.col(f"packed_{side}") for side in "le"}
    word = {side: F.shiftright(packed[side], 32).cast("int") for side in "le"}
    n, m = (F.shiftright(packed[side].bitwiseAND(0xFFFFFFFF), 1) for side in "le")
    head, tail = (packed[side].bitwiseAND(1) == 1 for side in "le")
    bits = sum(F.bit_count(F.col(f"{name}_l").bitwiseXOR(F.col(f"{name}_e"))) for name in ("half", "rest"))
    return spread(left, "l").join(spread(right, "e"), (word["l"] == word["e"]) & (F.col("e") < F.col("l")) & _alike(
        n, m, bits, threshold) & (((n <= m) & head) | ((m <= n) & tail))).select("l", "e")


def _verified(pairs: DataFrame, sets: DataFrame, lines: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Those of the pairs (l, e), stored, that are as similar as the threshold by the hashes of their words."""
    top, bottom = threshold
    wanted = pairs.select(F.explode(F.array("l", "e")).alias("id")).distinct()
    places = materialize(sets.select("id", "first").join(wanted, "id", "left_semi"), "places")

    def spot(place: str) -> Column:
        return F.xxhash64(f"{place}doc.id", f"{place}doc.digest", f"{place}line").bitwiseAND(_BITS - 1)

    wanted_line = _bit_table(places.select(spot("first.").alias("spot")))
    words = lines.select("doc", "line", "codes").where(wanted_line(spot("")))
    known = places.join(words, places["first.doc.id"].eqNullSafe(words["doc.id"]) & (places["first.doc.digest"] == words["doc.digest"])
                        & (places["first.line"] == words["line"]))
    # Repeated rows have a line more than once.
    known = materialize(known.select("id", "codes").dropDuplicates(["id"]), "verifiable")
    later, earlier = (known.select(F.col("id").alias(side), F.col("codes").alias(f"codes_{side}")) for side in "le")
    checked = pairs.join(later, "l").join(earlier, "e")
    near = materialize(checked.where(F.size(F.array_intersect("codes_l", "codes_e")) * (top + bottom) >= (
        F.size("codes_l") + F.size("codes_e")) * top).select("l", "e"), "near")
    discard(places, known)
    return near


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", size: str | None = "n_chars",
                threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows, all columns kept, with removed lines taken out of the text and ``size``, if there, counted anew.

    A row that loses every line, or every one with a word, goes; a row without words to begin with stays as it is.
    """
    found, read = _removed_lines(docs, key, text, threshold)
    found = materialize(found.where(F.size("removed") > 0), "removed")
    discard(*read)
    digest, other, lines = (free_name(docs, n) for n in ("digest", "digest_of", "removed"))
    marked = docs.withColumn(digest, F.xxhash64(F.col(text), F.lit(7)))
    found = found.select(F.col("id").alias(free_name(docs, "id_of")), F.col("digest").alias(other), F.col("removed").alias(lines))
    joined = marked.join(found, marked[key].eqNullSafe(found[free_name(docs, "id_of")]) & (marked[digest] == found[other]), "left")
    kept = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda _, i: ~F.array_contains(F.col(lines), i)), "\n")
    mended = joined.withColumn(text, F.when(F.col(lines).isNull(), F.col(text)).otherwise(kept))
    whole = F.col(lines).isNull() | (F.length(F.trim(_spaced(F.col(text), "\n\t\r\x0b\x0c"))) > 0)
    out = mended.where(whole)
    if size and size in docs.columns:
        out = out.withColumn(size, F.when(F.col(lines).isNull(), F.col(size)).otherwise(
            F.length(text).cast(docs.schema[size].dataType)))
    return out.select(*docs.columns)
