"""One query for each operator of this package, over whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusweave.llm import exact_dedup, hard_negatives, html_extract, license_scan, line_dedup, lm_score, minhash_dedup, ogg_media, secret_scan, sentencepiece_codec, source_mix, token_alignment, toxicity
from locusweave.llm.common import read_table

SQL_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op2_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg_media.digests(read_table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(read_table(spark, sf_dir, "documents"), sentencepiece_codec.model_bytes(tokenizer_path()))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(read_table(spark, sf_dir, "documents")).drop("text_id")


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read_table(spark, sf_dir, "documents"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.classes(read_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    repository = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    return secret_scan.scan(read_table(spark, sf_dir, "documents"), F.col("source"), repository)


def _matches(kind: str, rank: int, pattern: str) -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT rid, '{kind}' AS kind, {rank} AS rank, unnest(v) AS val, unnest(s[1:len(v)]) AS gap, generate_subscripts(v, 1) AS i
      FROM (SELECT rid, regexp_extract_all(t, '{p}') AS v, string_split_regex(t, '{p}') AS s FROM texts WHERE regexp_matches(t, '{p}'))"""


_KINDS = [*((k, p) for k, p, _ in secret_scan.BASE), ("other", secret_scan.OTHER)]
_LIVE = f"""length(secret) >= {secret_scan.LIVE_LENGTH} AND regexp_matches(secret, '[A-Za-z]') AND regexp_matches(secret, '[0-9]')
    AND len(list_distinct(string_split(secret, ''))) >= {secret_scan.LIVE_CHARACTERS} AND NOT regexp_matches(secret, '{secret_scan.PLACEHOLDER}')"""
OP9_SQL = f"""
WITH texts AS (SELECT row_number() OVER (ORDER BY doc_id) AS rid, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner,
    coalesce(source, '') || '/' || coalesce(lang, '') AS repository FROM documents),
found AS ({" UNION ALL ".join(_matches(k, r, p) for r, (k, p) in enumerate(_KINDS))}),
placed AS (SELECT rid, kind, rank, CASE WHEN rank = 0 THEN regexp_extract(val, '{secret_scan.ASSIGN.replace("'", "''")}', 2) ELSE val END AS secret,
    CAST(sum(length(gap)) OVER w + sum(length(val)) OVER w - length(val) AS BIGINT) AS a, length(val) AS n FROM found
    WINDOW w AS (PARTITION BY rid, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
good AS (SELECT p.*, t.owner, t.repository, kind || ':' || a || ':' || (a + n) AS span FROM placed p JOIN texts t USING (rid)
    WHERE length(secret) >= CASE rank WHEN 0 THEN 6 WHEN 1 THEN 20 WHEN 2 THEN 24 ELSE 1 END),
holders AS (SELECT secret, count(DISTINCT owner) AS o, count(DISTINCT repository) AS r FROM good GROUP BY secret),
judged AS (SELECT g.*, h.o || '/' || h.r AS held, h.o >= {secret_scan.EXAMPLE_OWNERS} OR h.r >= {secret_scan.EXAMPLE_REPOSITORIES} AS example,
    h.o = 1 AND h.r < {secret_scan.EXAMPLE_REPOSITORIES} AND {_LIVE.replace("secret", "g.secret")} AS live FROM good g JOIN holders h ON g.secret = h.secret),
per AS (SELECT rid, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(span, ',' ORDER BY a, rank) FILTER (rank < 3) AS base, string_agg(span, ',' ORDER BY a, rank) FILTER (rank < 3 OR NOT example) AS spans,
    string_agg(held, ',' ORDER BY a, rank) FILTER (rank < 3 OR NOT example) AS held,
    count(*) FILTER (live) AS n_live, count(*) FILTER (example) AS n_example FROM judged GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(held, '') AS holders, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM texts LEFT JOIN per USING (rid)
"""


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_table(read_table(spark, sf_dir, "documents")).drop("copies")


OP10_SQL = f"""
WITH sizes AS (SELECT doc_id, source, {SQL_WORDS} AS size,
    substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 9) AS h FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
    2 * source_size AS cap FROM sources),
levels AS (SELECT *, cap * 6 // weight AS o FROM weighed),
running AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY o, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
    sum(weight) OVER (ORDER BY o, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w,
    sum(source_size) OVER () AS s FROM levels),
capped AS (SELECT *, cap * 100 * w <= weight * (150 * s - 100 * c) AS full_up FROM running),
lowest AS (SELECT 150 * s - 100 * c AS rest, w FROM capped WHERE NOT full_up ORDER BY o, source NULLS LAST LIMIT 1),
aims AS (SELECT source, source_size,
    CASE WHEN full_up THEN CAST(cap AS DOUBLE) ELSE CAST(weight * (SELECT rest FROM lowest) AS DOUBLE) / CAST((SELECT w FROM lowest) * 100 AS DOUBLE) END AS target
  FROM capped),
budgets AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM aims),
hashes AS (SELECT source, h, sum(size) AS n FROM sizes GROUP BY source, h),
cumulated AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY h) AS upto FROM hashes),
edges AS (SELECT c.source, c.h, c.upto, c.upto - c.n AS below, b.target - b.whole * b.source_size AS rest
  FROM cumulated c JOIN budgets b ON c.source IS NOT DISTINCT FROM b.source),
cuts AS (SELECT source, CASE WHEN upto - rest < rest - below THEN h || 'g' ELSE h END AS cut FROM edges WHERE below <= rest AND rest < upto),
plan AS (SELECT b.*, coalesce(c.cut, '') AS cut FROM budgets b LEFT JOIN cuts c ON b.source IS NOT DISTINCT FROM c.source)
SELECT d.doc_id, d.size, p.source_size, p.target, CAST((p.whole + CASE WHEN d.h < p.cut THEN 1 ELSE 0 END) * d.size AS BIGINT) AS taken
FROM sizes d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
"""

def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = tokenizer_path("byte_bpe_50k.json"), tokenizer_path()
    return token_alignment.align(read_table(spark, sf_dir, "documents"), sentencepiece_codec.model_bytes(a), sentencepiece_codec.model_bytes(b))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"), "label")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", changed), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH plain AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM plain a JOIN plain b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) QUALIFY rank <= 10
"""


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(read_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS nth FROM docs),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (SELECT k, max(doc_id) AS keeps FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) >= 5),
judged AS (SELECT q.*, c.k IS NOT NULL AND q.doc_id IS DISTINCT FROM c.keeps AS goes FROM keyed q LEFT JOIN common c ON q.k = c.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT goes), '')) AS kept_sha256 FROM judged GROUP BY rid
"""

QUERIES = {
    "op1_html_extract": op1_html_extract,
    "op2_ogg_media": op2_ogg_media,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_license_scan": op4_license_scan,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_lm_score": op6_lm_score,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_secret_scan": op9_secret_scan,
    "op10_source_mix": op10_source_mix,
    "op11_token_alignment": op11_token_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_line_dedup": op13_line_dedup,
}
SQL = {
    "op5_exact_dedup": OP5_SQL,
    "op9_secret_scan": OP9_SQL,
    "op10_source_mix": OP10_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_line_dedup": OP13_SQL,
}
