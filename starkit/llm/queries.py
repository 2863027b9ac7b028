"""The registered queries of the package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.llm import (
    capture_index,
    decontamination,
    hard_negatives,
    html_extraction,
    language_id,
    near_duplicates,
    packing,
    personal_data,
    quality,
    secret_scan,
    token_counts,
    token_output,
    vector_codes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLE[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_tag_path_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


@query()
def op2_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = packing.Limits(tokens=2048, segments=128, loss_tokens=2048)
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), limits, end_id=1)


@query()
def op3_isolation_forest_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = rf"""
WITH doc AS (
  SELECT row_number() OVER (ORDER BY doc_id, text) AS k, doc_id,
         regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), phrase AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS p
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)
), place AS (
  SELECT k, n, i, array_to_string(w[i : i + n - 1], ' ') AS p
  FROM (SELECT k, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM doc, (SELECT DISTINCT n FROM phrase) WHERE len(w) >= n)
), hit AS (
  SELECT k, item_id, i, place.n AS n FROM place JOIN phrase ON place.p = phrase.p AND place.n = phrase.n
), summed AS (
  SELECT k, count(DISTINCT pos) AS n_hit, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT k, item_id, unnest(generate_series(i, i + n - 1)) AS pos FROM hit) GROUP BY k
), item_text AS (
  SELECT row_number() OVER (ORDER BY item_id, w) AS tid, item_id, w FROM (SELECT DISTINCT item_id, w FROM item WHERE item_id IS NOT NULL AND len(w) > 0)
), occurrence AS (
  SELECT k, word, pos FROM (SELECT k, unnest(w) AS word, unnest(generate_series(1, len(w))) AS pos FROM doc)
  WHERE word IN (SELECT unnest(w) FROM item_text)
), rare AS (
  SELECT tid, item_id, word, row_number() OVER (PARTITION BY tid ORDER BY coalesce(n, 0), word) AS i
  FROM (SELECT DISTINCT tid, item_id, unnest(w) AS word FROM item_text) LEFT JOIN (SELECT word, count(*) AS n FROM occurrence GROUP BY word) USING (word)
  QUALIFY i <= 4
), close_by AS (
  SELECT a.tid, a.item_id, o.k, o.pos, count(DISTINCT b.word) AS n
  FROM rare a JOIN occurrence o ON a.i = 1 AND a.word = o.word
  JOIN rare b ON a.tid = b.tid JOIN occurrence p ON p.k = o.k AND p.word = b.word AND abs(p.pos - o.pos) <= 20
  GROUP BY ALL
), near AS (
  SELECT k, count(DISTINCT item_id) AS n_near
  FROM close_by JOIN (SELECT tid, count(*) AS terms FROM rare GROUP BY tid) USING (tid) WHERE n = terms GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN summed USING (k) LEFT JOIN near USING (k)
"""


@query(OP4_SQL)
def op4_positional_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated",
        F.size("near").cast("long").alias("n_near"),
    )


def _cut_sql(kind: str, rank: int, value: str) -> str:
    pattern = secret_scan.PATTERNS[kind].replace("'", "''")
    return f"""SELECT k, owner, '{kind}' AS kind, {rank} AS rank, {secret_scan.LEAST[kind]} AS least, i, f[i] AS m, g[i] AS gap,
       {value.format(pattern=pattern)} AS value
  FROM (SELECT k, owner, f, g, unnest(generate_series(1, len(f))) AS i
        FROM (SELECT k, owner, regexp_extract_all(t, '{pattern}') AS f, regexp_split_to_array(t, '{pattern}') AS g FROM doc))"""


_CUTS = "\n  UNION ALL ".join(
    _cut_sql(kind, rank, "regexp_extract(f[i], '{pattern}', 2)" if kind == "assign" else "f[i]")
    for rank, kind in enumerate(secret_scan.PATTERNS)
)

OP5_SQL = f"""
WITH doc AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS k, doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents
), cut AS (
  {_CUTS}
), placed AS (
  SELECT *, sum(length(gap)) OVER w + sum(length(m)) OVER w - length(m) AS a FROM cut
  WINDOW w AS (PARTITION BY k, kind ORDER BY i ROWS UNBOUNDED PRECEDING)
), held AS (
  SELECT k, owner, kind, rank, value, CAST(a AS BIGINT) AS a, CAST(a + length(m) AS BIGINT) AS b FROM placed WHERE length(value) >= least
), found AS (
  SELECT * FROM held h WHERE kind <> 'key'
     OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
         AND NOT EXISTS (SELECT 1 FROM held o WHERE o.k = h.k AND o.kind <> 'key' AND o.a < h.b AND h.a < o.b))
), known AS (
  SELECT value, count(DISTINCT found.owner) >= {secret_scan.EXAMPLE_OWNERS}
                OR count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) >= {secret_scan.EXAMPLE_REPOSITORIES} AS example
  FROM found JOIN doc USING (k) GROUP BY value
), judged AS (
  SELECT found.*, example, NOT example AND regexp_matches(value, '[0-9]')
           AND len(list_distinct(regexp_extract_all(value, '.'))) >= {secret_scan.LIVE_CHARS} AS live
  FROM found JOIN known USING (value)
), summed AS (
  SELECT k, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) FILTER (kind <> 'key') AS base,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) FILTER (kind <> 'key' OR live) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (example) AS n_example
  FROM judged GROUP BY k
)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       CAST(coalesce(n_live, 0) AS BIGINT) AS n_live, CAST(coalesce(n_example, 0) AS BIGINT) AS n_example
FROM doc LEFT JOIN summed USING (k)
"""


@query(OP5_SQL)
def op5_ownership_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    counts = [secret_scan.n_of("base", kind).alias(f"n_{kind}") for kind in secret_scan.BASE]
    digest = F.sha2(secret_scan.listing("base"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secret_scan.listing("spans").alias("spans"), "n_live", "n_example")


@query()
def op6_elias_fano_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_output.write(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), end_id=0)
    return token_output.read(files)


@query()
def op7_two_tier_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE), limit=4096)


@query()
def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.is_held_out(F.col("doc_id"))
    model = language_id.learn(docs.where(~held_out).select("text", "lang"))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages", "proportions")


@query()
def op9_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(table(spark, sf_dir, "documents"))
    counts = [secret_scan.n_of("base", kind).alias(f"n_{kind}") for kind in personal_data.BASE]
    digest = F.sha2(secret_scan.listing("base"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secret_scan.listing("spans").alias("spans"))


@query()
def op10_bottom_k_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.group(table(spark, sf_dir, "documents"), percent=85)


OP11_SQL = r"""
WITH page AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), judged AS (
  SELECT *, count(*) OVER w AS n, row_number() OVER (w ORDER BY page_id, url) AS i, first_value(page_id) OVER (w ORDER BY page_id, url) AS first
  FROM page WINDOW w AS (PARTITION BY payload_digest)
), split AS (
  SELECT *, regexp_extract(regexp_replace(coalesce(url, ''), '#.*$', ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?]*)(.*)$', ['host', 'rest']) AS p FROM judged
), keyed AS (
  SELECT *, array_to_string(list_reverse(string_split(regexp_replace(lower(regexp_replace(p.host, '^.*@', '')), ':(80|443)$', ''), '.')), ',')
            || ')' || CASE WHEN p.rest = '' THEN '/' ELSE p.rest END AS url_key FROM split
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND i > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND i > 1 THEN first END AS refers_to,
       url_key, CAST(row_number() OVER (ORDER BY url_key, page_id) - 1 AS BIGINT) AS position
FROM keyed
"""


@query(OP11_SQL)
def op11_loser_tree_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = capture_index.write(table(spark, sf_dir, "pages"))
    found = capture_index.histories(capture_index.read(spark, archives))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "position")


@query()
def op12_gnat_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.encode(table(spark, sf_dir, "embeddings"))
    return coded.withColumn("codebooks_sha256", F.lit(vector_codes.digest(books)))


OP13_SQL = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM kept a, kept b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


@query(OP13_SQL)
def op13_secondary_sort_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)
