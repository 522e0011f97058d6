"""One registered query per operator, on the whole of its table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    exact_search,
    fingerprints,
    language,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    pseudonyms,
    sharding,
    spelling,
    toxicity,
    vector_search,
)
from .tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


# The walk of every document, one row per jump; the last jumps below 24 and 25 are its shards.
# The checksum goes byte by byte through the table of the reflected polynomial 0xEDB88320.
_SHARD_SQL = """
WITH RECURSIVE walk AS (
  SELECT doc_id, CAST(doc_id AS HUGEINT) AS state, CAST(0 AS BIGINT) AS jump FROM documents
  UNION ALL
  SELECT doc_id, grown, CAST(floor(CAST(jump + 1 AS DOUBLE)
           * (CAST(2147483648 AS DOUBLE) / CAST((grown >> 33) + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT doc_id, jump,
          (state * CAST(2862933555777941757 AS HUGEINT) + 1)
            % CAST('18446744073709551616' AS HUGEINT) AS grown
        FROM walk WHERE jump < 25)),
shards AS (
  SELECT doc_id, max(jump) FILTER (jump < 24) AS shard, max(jump) FILTER (jump < 25) AS grown_shard
  FROM walk GROUP BY doc_id),
bits(i, c, k) AS (
  SELECT CAST(i AS BIGINT), CAST(i AS BIGINT), 0 FROM range(256) AS t(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
  FROM bits WHERE k < 8),
lookup AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
sums AS (
  SELECT doc_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
        lambda b: CAST('0x' || b AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM documents, lookup)
SELECT d.doc_id, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size,
       CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY md5('0:' || d.doc_id)) - 1 AS BIGINT) AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM documents d JOIN shards USING (doc_id) JOIN sums USING (doc_id)
"""


@_query("op1_sharding", _SHARD_SQL)
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"), shards=24)


# One frame slot by slot: of the sources that may start, the one with the earliest deadline.
_MIXING_SQL = """
WITH RECURSIVE counts AS (
  SELECT coalesce('=' || source, 'null') AS s, count(*) AS rows FROM documents GROUP BY 1),
spare AS (
  SELECT s, (1024 - count(*) OVER ()) * (pow(rows, 0.7e0) / sum(pow(rows, 0.7e0)) OVER ()) AS x,
         count(*) OVER () AS sources FROM counts),
units AS (
  SELECT s, CAST(1 + floor(x) AS BIGINT) + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, s)
           <= 1024 - sources - sum(CAST(floor(x) AS BIGINT)) OVER () THEN 1 ELSE 0 END AS u FROM spare),
lists AS (SELECT list(s ORDER BY s) AS names, list(u ORDER BY s) AS u FROM units),
frame AS (
  SELECT -1 AS slot, list_transform(u, lambda x: CAST(0 AS BIGINT)) AS used, CAST(0 AS BIGINT) AS pick FROM lists
  UNION ALL
  SELECT slot + 1, list_transform(used, lambda x, i: x + CASE WHEN i = next THEN 1 ELSE 0 END), next
  FROM (SELECT slot, used, list_min(list_transform(u, lambda x, i:
          CASE WHEN used[i] < x AND used[i] * 1024 // x <= slot + 1
               THEN ((used[i] + 1) * 1024 + x - 1) // x * 100000 + i END)) % 100000 AS next
        FROM frame, lists WHERE slot < 1023)),
slots AS (
  SELECT names[pick] AS s, u[pick] AS u, slot, row_number() OVER (PARTITION BY pick ORDER BY slot) - 1 AS turn
  FROM frame, lists WHERE slot >= 0),
rows AS (
  SELECT doc_id, source, coalesce('=' || source, 'null') AS s,
         row_number() OVER (PARTITION BY source ORDER BY md5('0:' || doc_id)) - 1 AS n FROM documents),
placed AS (
  SELECT doc_id, source, n, n // 8 AS source_block, (n // 8) // u * 1024 + slot AS slot
  FROM rows JOIN slots USING (s) WHERE (n // 8) % u = turn)
SELECT doc_id, source, CAST(source_block AS BIGINT) AS source_block, CAST(slot AS BIGINT) AS slot,
       CAST(row_number() OVER (ORDER BY slot, n) - 1 AS BIGINT) AS position FROM placed
"""


@_query("op8_mixing", _MIXING_SQL)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "source_block", "slot", "position")


@_query("op8_mixing_by_weight")
def op8_mixing_by_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op8_mixing, but the schedule keeps to the target weights themselves."""
    mixed = mixing.mix(read(spark, sf_dir, "documents"), law="weights")
    return mixed.select("doc_id", "source", "source_block", "slot", "position")


@_query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), capacity=2048)


# Distinct lines meet where they agree on one half, and are then compared character by character.
_LINES_SQL = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
         unnest(string_split(text, chr(10))) AS raw FROM documents),
trimmed AS (
  SELECT doc_id, pos, raw, trim(raw, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS line FROM lines),
firsts AS (SELECT line, min({'doc': doc_id, 'pos': pos}) AS place FROM trimmed WHERE line <> '' GROUP BY line),
halves AS (
  SELECT line, place, len(line) = size AS own, size, half,
         CASE half WHEN 0 THEN right(line, size - size // 2) ELSE left(line, size // 2) END AS piece
  FROM (SELECT *, unnest([len(line), len(line) - 1]) AS size FROM firsts), (VALUES (0), (1)) AS h(half)
  WHERE size >= 1),
pairs AS (
  SELECT DISTINCT a.line AS a, a.place AS a_place, b.line AS b, b.place AS b_place, b.own AS same_size
  FROM halves a JOIN halves b USING (size, half, piece) WHERE a.own AND a.line <> b.line),
near AS (
  SELECT a, a_place, b, b_place FROM pairs
  WHERE len(list_filter(range(0, len(a) + 1), lambda p: left(a, p) = left(b, p)
        AND substr(a, p + CASE WHEN same_size THEN 2 ELSE 1 END) = substr(b, p + 2))) > 0),
gone AS (
  SELECT b AS line FROM near WHERE a_place < b_place UNION SELECT a FROM near WHERE b_place < a_place),
kept AS (
  SELECT t.doc_id, t.pos, t.raw FROM trimmed t LEFT JOIN firsts f USING (line)
  WHERE t.line = '' OR (f.place = {'doc': t.doc_id, 'pos': t.pos} AND t.line NOT IN (SELECT line FROM gone)))
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS INTEGER) AS n_lines,
       CAST(coalesce(len(string_split(d.text, chr(10))) - coalesce(k.n, 0), 0) AS INTEGER) AS n_dropped
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(raw, chr(10) ORDER BY pos) AS text, count(*) AS n FROM kept GROUP BY 1) k USING (doc_id)
"""


@_query("op6_line_dedup", _LINES_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "n_lines", "n_dropped")


@_query("op5_pseudonyms")
def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = pseudonyms.pseudonymise(read(spark, sf_dir, "documents"), key="corpus release 1")
    return named.select("doc_id", "text", "n_pseudonyms")


@_query("op3_ngram_join")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    similar = ngram_join.similar_documents(read(spark, sf_dir, "documents"), n=5, threshold=0.8)
    return similar.select("doc_id", "class_id", "n_links")


@_query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit_severity(docs, read(spark, sf_dir, "labels"))
    return toxicity.score_severity(docs, model, keep=["doc_id"])


@_query("op10_language")
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.predict_language(docs, language.fit_languages(docs))


@_query("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(read(spark, sf_dir, "documents"))


@_query("op9_vector_search")
def op9_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "embeddings")
    return vector_search.nearest_vectors(table, F.col("vec_id") % 50 == 0, k=5)


# Checksums byte by byte as above; near words meet where they agree after one deletion or as they
# are, and are then compared symbol by symbol.
_SPELLING_SQL = """
WITH RECURSIVE bits(i, c, k) AS (
  SELECT CAST(i AS BIGINT), CAST(i AS BIGINT), 0 FROM range(256) AS t(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
  FROM bits WHERE k < 8),
lookup AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY 1, 2),
sums AS (
  SELECT run, times, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(regexp_extract_all(hex(encode(doc_id || ':' || run)), '..'),
        lambda b: CAST('0x' || b AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM runs, lookup WHERE len(run) >= 6),
words AS (
  SELECT word, sum(times) AS n FROM (
    SELECT times, CASE WHEN h % 199 = 0
      THEN left(run, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word FROM sums)
  WHERE len(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
variants AS (
  SELECT word, n, word AS variant FROM words
  UNION
  SELECT word, n, left(word, p) || substr(word, p + 2)
  FROM (SELECT word, n, unnest(range(len(word))) AS p FROM words)),
pairs AS (
  SELECT DISTINCT a.word, b.word AS near, b.n AS near_n
  FROM variants a JOIN variants b USING (variant) WHERE a.word <> b.word),
near AS (
  SELECT word, near, near_n FROM pairs
  WHERE (len(word) <> len(near) AND abs(len(word) - len(near)) = 1)
     OR (len(word) = len(near) AND len(list_filter(range(1, len(word) + 1),
           lambda p: substr(word, p, 1) <> substr(near, p, 1))) = 1)),
firsts AS (
  SELECT word, count(*) AS n_near, max(near_n) AS most,
         min(near) FILTER (near_n = top) AS first
  FROM (SELECT *, max(near_n) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN first END AS form,
         CASE WHEN most >= 5 * n THEN most END AS form_n
  FROM words LEFT JOIN firsts USING (word)),
chains AS (
  SELECT word, word AS root FROM forms WHERE form IS NULL
  UNION ALL
  SELECT f.word, c.root FROM forms f JOIN chains c ON f.form = c.word)
SELECT word, form, root, CAST(n AS BIGINT) AS n, CAST(n_near AS BIGINT) AS n_near,
       CAST(form_n AS BIGINT) AS form_n
FROM forms JOIN chains USING (word)
"""

# Every query row against every other row.
_PRODUCTS_SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""


@_query("op11_spelling", _SPELLING_SQL)
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(read(spark, sf_dir, "documents"))


@_query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(read(spark, sf_dir, "documents"))


@_query("op13_exact_search", _PRODUCTS_SQL)
def op13_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "embeddings")
    return exact_search.largest_products(table, F.col("vec_id") % 100 == 0, k=10)
