"""The queries of the corpus operators, one for each, over whole tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe_codec, embedding_neardup, fill_in_middle, line_dedup, media_copies, mixing, ngram_join, packing, secret_scan, sharding, spelling, token_count, toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_documents(spark, sf_dir), 24)


def op2_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_neardup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("audit_recall")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeats(_documents(spark, sf_dir).select("doc_id", "text"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(_documents(spark, sf_dir), n=3, percent=90)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(_documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_documents(spark, sf_dir))


def op7_media_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_copies.copies(media_copies.drawn(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_codec.digests(bpe_codec.encode_documents(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.transform(_documents(spark, sf_dir)))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.vocabulary(_documents(spark, sf_dir), slip=31))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_embedding_neardup": op2_embedding_neardup,
    "op3_line_dedup": op3_line_dedup,
    "op4_ngram_join": op4_ngram_join,
    "op5_secret_scan": op5_secret_scan,
    "op6_mixing": op6_mixing,
    "op7_media_copies": op7_media_copies,
    "op8_token_count": op8_token_count,
    "op9_bpe_codec": op9_bpe_codec,
    "op10_toxicity": op10_toxicity,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_packing": op12_packing,
    "op13_spelling": op13_spelling,
}

_WORDS = r"'[^\x20\x09-\x0D]+'"
#: node, component over the CTEs nodes (node) and links (u, v, both ways): every node takes the smallest that it reaches.
_REACH = "reach AS (SELECT node, node AS c FROM nodes UNION SELECT l.v, r.c FROM reach r JOIN links l ON l.u = r.node), found AS (SELECT node, min(c) AS component FROM reach GROUP BY node)"

_OP2 = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
          WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
nodes AS (SELECT vec_id AS node FROM embeddings), {_REACH}
SELECT vec_id, CAST((SELECT count(*) FROM links WHERE u = vec_id) AS BIGINT) AS n_links, component AS component_id, component = vec_id AS kept FROM embeddings JOIN found ON node = vec_id
"""

_OP4 = f"""
WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2]))) END AS s FROM worded),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
met AS (SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n GROUP BY a.doc_id, b.doc_id),
links AS (SELECT u, v FROM met WHERE 100 * common >= 90 * (n + m - common)), nodes AS (SELECT doc_id AS node FROM documents), {_REACH}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component AS component_id FROM sets JOIN found ON node = doc_id
"""

#: Kind, pattern, group and least length; a quote is doubled for SQL.
_KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
)


def _spans_sql(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""SELECT line, '{kind}' AS kind, {rank} AS rank, length(p) >= {least} AS counts, length(w) AS size, sum(length(g) + length(w)) OVER (PARTITION BY line ORDER BY turn) AS until
      FROM (SELECT line, unnest(regexp_extract_all(body, '{pattern}')) AS w, unnest(regexp_extract_all(body, '{pattern}', {group})) AS p,
                   unnest(list_slice(string_split_regex(body, '{pattern}'), 1, len(regexp_extract_all(body, '{pattern}')))) AS g, unnest(range(len(regexp_extract_all(body, '{pattern}')))) AS turn
            FROM bodies WHERE regexp_matches(body, '{pattern}'))"""


_OP5 = f"""
WITH bodies AS (SELECT row_number() OVER () AS line, doc_id, coalesce(text, '') AS body FROM documents),
spans AS ({' UNION ALL '.join(_spans_sql(k, *kind) for k, kind in enumerate(_KINDS))}),
joined AS (SELECT line, count_if(kind = 'assign') AS a, count_if(kind = 'access') AS b, count_if(kind = 'hex') AS h, string_agg(concat(kind, ':', CAST(until - size AS BIGINT), ':', CAST(until AS BIGINT)), ',' ORDER BY until - size, rank) AS s FROM spans WHERE counts GROUP BY line)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(s, '')) AS base_sha256, coalesce(s, '') AS spans FROM bodies LEFT JOIN joined USING (line)
"""

_OP6 = f"""
WITH sized AS (SELECT row_number() OVER () AS row, doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORDS})) AS size,
    (CAST('0x' || substr(sha1(concat('{mixing.SEED}|', doc_id, '|', coalesce(text, ''))), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM documents),
have AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM sized GROUP BY source),
caps AS (SELECT *, source_size * 3.0::DOUBLE AS cap, source_size * 3.0::DOUBLE / weight AS bend FROM have),
upto AS (SELECT *, row_number() OVER o AS turn, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM caps WINDOW o AS (ORDER BY bend, source NULLS LAST)),
goals AS (SELECT source, source_size, coalesce(least(cap, (SELECT arg_min(level, turn) FROM upto WHERE level < bend) * weight), cap) AS target FROM upto),
digit AS (SELECT *, length(bin(size))::DOUBLE AS digits FROM sized),
words AS (SELECT source, digits, sum(size)::DOUBLE AS words FROM digit GROUP BY source, digits),
bent AS (SELECT w.*, target, source_size, (target - 3 * coalesce(sum(words) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / nullif(sum(digits * words) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS c
         FROM words w JOIN goals g ON w.source IS NOT DISTINCT FROM g.source WINDOW f AS (PARTITION BY w.source ORDER BY digits DESC)),
fixed AS (SELECT * REPLACE (max_by(c, CASE WHEN c * digits < 3 THEN digits END) OVER (PARTITION BY source) AS c) FROM bent),
mean AS (SELECT *, CASE WHEN source_size = 0 THEN 0 WHEN c IS NULL THEN 3.0::DOUBLE ELSE greatest(0, least(3.0::DOUBLE, c * digits)) END AS mean FROM fixed),
certain AS (SELECT *, floor(mean + 1e-9::DOUBLE) AS certain, target - sum(floor(mean + 1e-9::DOUBLE) * words) OVER (PARTITION BY source) AS rest FROM mean),
ranked AS (SELECT d.*, certain, target, source_size, rest, CASE WHEN mean - certain > 0 AND size > 0 THEN (u / (1.0::DOUBLE - u)) / ((mean - certain) / (1.0::DOUBLE - (mean - certain))) END AS rank
           FROM digit d JOIN certain c ON d.source IS NOT DISTINCT FROM c.source AND d.digits = c.digits),
run AS (SELECT *, CASE WHEN rank IS NOT NULL THEN sum(size) OVER (PARTITION BY source, rank IS NULL ORDER BY rank, doc_id, u) END AS run FROM ranked),
gaps AS (SELECT *, run <= rest AS taken, rest - coalesce(max(CASE WHEN run <= rest THEN run END) OVER (PARTITION BY source), 0) AS gap FROM run),
close AS (SELECT source, arg_min(struct_pack(r := rank, d := doc_id, u := u), struct_pack(m := abs(size - gap), r := rank, d := doc_id, u := u)) AS best FROM gaps WHERE rank IS NOT NULL AND NOT taken AND abs(size - gap) < gap GROUP BY source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies
FROM (SELECT g.*, certain + CASE WHEN rank IS NOT NULL AND (taken OR (best.r = rank AND best.d IS NOT DISTINCT FROM g.doc_id AND best.u = g.u)) THEN 1 ELSE 0 END AS copies FROM gaps g LEFT JOIN close c ON g.source IS NOT DISTINCT FROM c.source)
"""

_OP11 = """
WITH hashed AS (SELECT doc_id, coalesce(text, '') AS t, sha256(concat('1:', doc_id)) AS g FROM documents),
drawn AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || substr(g, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(g, 9, 8) AS BIGINT) AS h2,
                 CAST('0x' || substr(g, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(g, 25, 8) AS BIGINT) AS h4 FROM hashed),
cut AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle) ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

ORACLE_SQL: dict[str, str] = {"op2_embedding_neardup": _OP2, "op4_ngram_join": _OP4, "op5_secret_scan": _OP5, "op6_mixing": _OP6, "op11_fill_in_middle": _OP11}
