"""The registered queries of the text operators; each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm import (
    align,
    decontaminate,
    embeddings,
    language,
    mining,
    mixing,
    shards,
    simhash,
    substrings,
    surrogates,
    token_counts,
    token_files,
    urls,
)
from fareflow.llm.common import table
from fareflow.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document's whole text."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary)


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids to sequence files, and read each document's ids back."""
    docs, folder = table(spark, sf_dir, "documents"), work_dir(spark, "token-files")
    files = token_files.write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_digests(spark, files)


@query
def op7_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and group of every vector."""
    return embeddings.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near-duplicates of every document."""
    groups = simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of them."""
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot of every document in the mixture of sources."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), mixing.TARGETS, mixing.REST_TARGET)
    return mixed.select("doc_id", "source", "grp", "block", "row_in_block", "release", "deadline", "slot")


def mixing_sql(weights: dict[str, int], rest: int, block_rows: int) -> str:
    """The mixture stated slot by slot: each slot takes the open block with the earliest deadline."""
    shares = ", ".join(f"('{g}', {w})" for g, w in [*weights.items(), (mixing.REST, rest)])
    return f"""
WITH RECURSIVE share(grp, w) AS (VALUES {shares}),
doc AS (
  SELECT doc_id, source, coalesce(s.grp, '{mixing.REST}') AS grp,
    row_number() OVER (PARTITION BY coalesce(s.grp, '{mixing.REST}') ORDER BY md5('0:' || doc_id)) - 1 AS k
  FROM documents LEFT JOIN share s ON s.grp = source),
placed AS (SELECT *, k // {block_rows} AS block, CAST(k % {block_rows} AS INTEGER) AS row_in_block FROM doc),
blk AS (
  SELECT grp, block, block // w AS rnd, block % w AS i, count(*) OVER (PARTITION BY grp, block // w) AS m
  FROM (SELECT DISTINCT grp, block FROM placed) JOIN share USING (grp)),
rnd AS (
  SELECT rnd, count(*) AS slots, coalesce(sum(count(*)) OVER (ORDER BY rnd ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base
  FROM blk GROUP BY rnd),
win AS (
  SELECT grp, block, CAST(base AS BIGINT) AS base, CAST(i * slots // m AS INTEGER) AS release,
    CAST(((i + 1) * slots + m - 1) // m AS INTEGER) AS deadline
  FROM blk JOIN rnd USING (rnd)),
open AS (
  SELECT grp, block, base + release AS free, {{'due': base + deadline, 'free': base + release, 'grp': grp, 'block': block}} AS id
  FROM win),
sim(t, done, pick) AS (
  SELECT CAST(-1 AS BIGINT), CAST([] AS STRUCT(due BIGINT, free BIGINT, grp VARCHAR, block BIGINT)[]),
    CAST(NULL AS STRUCT(due BIGINT, free BIGINT, grp VARCHAR, block BIGINT))
  UNION ALL
  SELECT t + 1, list_append(done, next), next
  FROM (SELECT t, done, (SELECT min(id) FROM open WHERE free <= t + 1 AND NOT list_contains(done, id)) AS next FROM sim)
  WHERE next IS NOT NULL)
SELECT doc_id, source, grp, placed.block, row_in_block, release, deadline, t AS slot
FROM placed JOIN win USING (grp, block) JOIN sim ON pick.grp = grp AND pick.block = placed.block"""


ORACLE["op1_mixing"] = mixing_sql(mixing.TARGETS, mixing.REST_TARGET, block_rows=64)


#: The rules of the contract, in their own notation.
RULES = ("block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/")


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and verdict of every page's url."""
    return urls.judge(table(spark, sf_dir, "pages"), urls.parse_rules(RULES))


@query
def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's whole text with personal data replaced, and how many entities it had."""
    made = surrogates.with_surrogates(table(spark, sf_dir, "documents"), key="the key of this corpus")
    n = F.aggregate(F.map_values("entities"), F.lit(0).cast("long"), lambda a, b: a + b)
    return made.select("doc_id", "text", n.alias("n_entities"), F.to_json("entities").alias("entities"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Stated from the rule alone: all runs of as many words as a window has, looked up as whole strings.
ORACLE["op4_decontaminate"] = r"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS n FROM item WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
run AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT r, i, run.n, item_id FROM run JOIN win USING (n, s)),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT r, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN named USING (r)"""


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    placed = shards.with_shards(table(spark, sf_dir, "documents"), shards=8)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return placed.select("doc_id", "size", crc.alias("text_crc32"), "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every hundredth vector within score windows of its positives; every seventh label is off by one."""
    off = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", off)
    return mining.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


#: Stated from the definition: every anchor against every row.
ORACLE["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS p
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, o.vec_id, o.label, CAST(list_inner_product(a.p, o.p) AS BIGINT) AS score
  FROM v a JOIN v o ON o.vec_id <> a.vec_id AND len(o.p) = len(a.p) WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.own
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10"""


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 13 words that a smaller document has too."""
    cleaned = substrings.remove_repeated(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: Stated from the rule alone: all windows as whole strings, and the smallest document of each.
ORACLE["op12_substring_dedup"] = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM doc WHERE len(w) >= 13)),
least AS (SELECT s, min(doc_id) AS smallest FROM win GROUP BY s),
hit AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN least USING (s) WHERE smallest < doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM doc),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)"""


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two vocabularies, grouped where both end."""
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.align(table(spark, sf_dir, "documents"), a, b)
