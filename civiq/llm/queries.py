"""The operators applied to the given tables: name → query, and name → SQL where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiq.llm import (
    ann, codebooks, decontam, fingerprints, langid, linededup, packing, periodic, records, simhash, substrings, toxicity, wrappers,
)
from civiq.llm.common import read_table, remainder
from civiq.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(apply_settings(spark), sf_dir)
        if sql:
            ORACLE[name] = sql
        return fn

    return wrap


@_query("op1_fingerprints")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(read_table(spark, sf_dir, "documents"))


@_query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


@_query("op3_records")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(read_table(spark, sf_dir, "documents"))


_LINES = """
lines AS (
  SELECT doc_id, unnest(generate_series(0, len(parts) - 1)) AS line, unnest(parts) AS content
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
worded AS (
  SELECT doc_id, line, content, list_sort(list_distinct(list_filter(string_split(lower(translate(
    content, chr(9) || chr(13) || chr(11) || chr(12), '    ')), ' '), lambda x: x <> ''))) AS words FROM lines),
sets AS (
  SELECT row_number() OVER () AS id, words, len(words) AS n, first FROM (
    SELECT words, min({'d': doc_id, 'l': line}) AS first FROM worded WHERE len(words) > 0 GROUP BY words)),
spelled AS (SELECT id, n, unnest(words) AS word FROM sets),
used AS (SELECT word, count(*) AS uses FROM spelled GROUP BY word),
ranked AS (
  SELECT id, n, word, row_number() OVER (PARTITION BY id ORDER BY uses, word) AS spot FROM spelled JOIN used USING (word)),
heads AS (SELECT * FROM ranked WHERE spot <= n - (n * 4 + 4) // 5 + 1),
pairs AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM heads a JOIN heads b USING (word)
  WHERE a.id <> b.id AND a.n * 5 >= b.n * 4 AND b.n * 5 >= a.n * 4),
near AS (
  SELECT a, sb.first AS other FROM pairs JOIN sets sa ON sa.id = a JOIN sets sb ON sb.id = b
  WHERE len(list_intersect(sa.words, sb.words)) * 9 >= (sa.n + sb.n) * 4),
best AS (
  SELECT words, least(first, coalesce(min(other), first)) AS best FROM sets LEFT JOIN near ON a = id GROUP BY words, first),
marked AS (
  SELECT doc_id, line, content, len(w.words) AS n_words, coalesce({'d': doc_id, 'l': line} > best, false) AS gone
  FROM worded w LEFT JOIN best b ON w.words = b.words)
"""


@_query("op4_linededup", f"""WITH {_LINES}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  coalesce(string_agg(CASE WHEN gone THEN line::VARCHAR END, ',' ORDER BY line), '') AS removed_lines
FROM marked GROUP BY doc_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.removed_lines(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"),
                        F.size("removed").cast("long").alias("n_removed"),
                        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"))


@_query("op5_decontam")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@_query("op6_wrappers")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrappers.extract(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held = remainder(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, labels.where(~held))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query("op8_langid")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = remainder(F.col("doc_id"), 3) == 1
    model = langid.train(docs.where(~held))
    return langid.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@_query("op9_substrings", r"""
WITH listed AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
spelled AS (
  SELECT doc_id, len(words) AS n, unnest(words) AS word, unnest(generate_series(1, len(words))) AS spot FROM listed WHERE len(words) > 0),
windowed AS (
  SELECT *, CASE WHEN spot <= n - 12 THEN string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY spot ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) END AS phrase FROM spelled),
firsts AS (SELECT phrase, min(doc_id) AS first FROM windowed WHERE phrase IS NOT NULL GROUP BY phrase),
marked AS (SELECT w.*, coalesce(f.first < w.doc_id, false) AS repeats FROM windowed w LEFT JOIN firsts f ON w.phrase = f.phrase),
covered AS (
  SELECT doc_id, spot, word, bool_or(repeats) OVER (
    PARTITION BY doc_id ORDER BY spot ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM marked),
counted AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY spot) FILTER (NOT gone) AS kept
  FROM covered GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN counted USING (doc_id)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


@_query("op11_nearest", """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_reduce([0::DOUBLE] || [q.v[i] * c.v[i] for i in generate_series(1, least(len(q.v), len(c.v)))], lambda x, y: x + y) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM scored) WHERE rank <= 20""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.where(F.col("vec_id") % 20 == 0))


def made_periodic(doc_id, words: int) -> np.ndarray | None:
    """The order of words that makes every tenth document, by its number's hash, periodic from some word on."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10:
        return None
    g = h // 10
    a = g % words
    p = 1 + (words - a) // (3 + g % 8)
    at = np.arange(words)
    return np.where(at < a, at, a + (at - a) % p)


@_query("op12_periodic")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(read_table(spark, sf_dir, "documents"), rearranged=made_periodic)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _rounds_sql(rounds: int) -> str:
    """Assignment and update as often as there are rounds; the last assignment stands alone."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (
  SELECT vec_id, p, any_value(x.c) AS c, min(list_sum([(x.c[i] - b.c[i]) ** 2 for i in generate_series(1, len(x.c))])::HUGEINT * 64 + e) AS best
  FROM pieces x JOIN b{r} b USING (p) GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
  SELECT p, (best % 64)::INT AS e, i, floor(sum(c[i])::DOUBLE / count(*))::BIGINT AS m
  FROM a{r}, generate_series(1, 16) g(i) WHERE i <= len(c) GROUP BY ALL),
b{r + 1} AS (
  SELECT p, e, coalesce(any_value(n.c), any_value(b.c)) AS c FROM b{r} b
  LEFT JOIN (SELECT p, e, list(m ORDER BY i) AS c FROM m{r} GROUP BY p, e) n USING (p, e) GROUP BY p, e)""")
    return ",\n".join(steps)


@_query("op13_codebooks", f"""
WITH kept AS (
  SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS (SELECT vec_id, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS c FROM kept, generate_series(0, 15) g(p)),
firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64),
b0 AS (SELECT p, e, c FROM pieces JOIN firsts USING (vec_id)),
{_rounds_sql(2)},
coded AS (SELECT vec_id, string_agg(format('{{:02x}}', (best % 64)::INT), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error FROM a2 GROUP BY vec_id),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), books""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.compress(read_table(spark, sf_dir, "embeddings")).drop("label")
