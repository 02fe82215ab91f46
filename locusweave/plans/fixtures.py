"""Stand-in genomic views over the given tables, in SQL that Spark and DuckDB both run.

Table names stand in braces: Spark replaces them by DataFrames, the oracle by the names of its views.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx_reads": """SELECT concat('r', l_orderkey, '_', l_linenumber) AS read_name, concat('s', l_suppkey % 10) AS sample,
  concat('chr', 1 + l_suppkey % 5) AS chrom, (l_partkey % 200) * 40 AS ref_start, CAST(floor(l_discount * 600) AS INT) AS mapq,
  CASE WHEN l_returnflag = 'R' THEN concat(60 + l_linenumber, 'M', 1 + l_linenumber % 4, 'D', 90 - l_linenumber, 'M')
       WHEN l_returnflag = 'A' THEN concat(50 + l_linenumber, 'M', 1 + l_linenumber % 3, 'I', 90 - l_linenumber, 'M')
       WHEN l_linestatus = 'O' THEN '40S110M' ELSE '150M' END AS cigar,
  CAST(l_linenumber = 7 AS INT) AS is_dup, CASE WHEN l_tax < 0.03 THEN 'control' ELSE 'edited' END AS arm FROM {lineitem}""",
    "fx_frags": """SELECT concat('chr', CAST(1 + floor(p_partkey / 400) AS INT)) AS chrom, (p_partkey % 400) * 2000 + 1 AS st,
  (p_partkey % 400) * 2000 + 501 + p_size * 25 AS en, p_partkey AS frag_id, p_name AS annotation, CAST(p_partkey % 10 = 3 AS INT) AS is_bait FROM {part}""",
    "fx_pairs": """SELECT o_orderkey AS pair_id, concat('chr', 1 + o_orderkey % 5) AS chr1, (o_custkey * 37 % 400) * 2000 + 1 + o_orderkey % 300 AS st1,
  (o_custkey * 37 % 400) * 2000 + 151 + o_orderkey % 300 AS en1, concat('chr', 1 + o_orderkey % 5 % 4) AS chr2,
  (o_custkey * 41 % 400) * 2000 + 1 + o_orderkey % 300 AS st2, (o_custkey * 41 % 400) * 2000 + 151 + o_orderkey % 300 AS en2 FROM {orders}""",
    "fx_genes": """SELECT concat('GENE', s_suppkey) AS symbol, concat('ENST', s_suppkey) AS trx, concat('chr', 1 + s_suppkey % 5) AS chrom,
  s_suppkey * 70 AS st, s_suppkey * 70 + 100 + CAST(floor(abs(s_acctbal)) AS BIGINT) % 900 AS en, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE -1 END AS strand FROM {supplier}""",
    "fx_variants": """SELECT concat('v', o_orderkey) AS id, concat('v', CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey + 1 ELSE o_orderkey - 1 END) AS mate_id,
  concat('s', o_custkey % 10) AS sample, concat('chr', 1 + o_custkey % 5) AS chrom, o_orderkey % 8000 AS pos,
  CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'weak_evidence;MaxDepth' ELSE 'base_quality' END AS filter,
  o_custkey % 40 AS ref_reads, o_orderkey % 13 AS alt_reads,
  CASE o_orderkey % 4 WHEN 0 THEN 'DEL' WHEN 1 THEN 'DUP' WHEN 2 THEN 'INS' ELSE 'BND' END AS svtype,
  (o_orderkey * 7919) % 60000 AS svlen,
  concat('A|GENE', o_custkey % 100, '|ENST', o_custkey % 100, '|missense_variant&splice_region_variant|1,A|GENE', o_custkey % 7, '|ENST', o_custkey % 7, '|intron_variant|') AS csq FROM {orders}""",
    "fx_segments": """SELECT concat('chr', 1 + c_nationkey % 5) AS chrom, c_custkey * 900 AS st, c_custkey * 900 + 200 + CAST(floor(abs(c_acctbal)) AS BIGINT) AS en,
  CASE c_mktsegment WHEN 'FURNITURE' THEN '<DEL>' WHEN 'BUILDING' THEN '<DUP>' ELSE '<LOH>' END AS alt,
  CASE WHEN c_custkey % 3 = 0 THEN 'segmentMean' ELSE 'PASS' END AS filter, c_custkey % 4 AS cn, abs(c_acctbal) / 10000.0 AS sm,
  (c_custkey % 100) / 200.0 AS maf, c_custkey AS seg_id FROM {customer}""",
    "fx_metrics": """SELECT concat('s', user_id % 10) AS sample, event_type AS metric, value, ts, event_id FROM {events}""",
    "fx_sites": """SELECT DISTINCT concat('chr', 1 + s_suppkey % 5) AS chrom, s_suppkey * 70 AS pos, concat('G', s_nationkey % 5) AS guide,
  CAST(s_suppkey % 9 = 0 AS INT) AS is_target FROM {supplier}""",
    "fx_contacts": """SELECT concat('c', o_custkey % 3) AS chrom, o_custkey % 40 AS i, o_orderkey % 40 AS j, count(*) AS n FROM {orders} GROUP BY 1, 2, 3""",
    "fx_interactions": """SELECT o_custkey % 20 AS bait_id, o_orderkey % 40 AS other_id, concat('s', CAST(floor(o_custkey / 20) AS BIGINT) % 4) AS sample, count(*) AS n,
  round(sum(o_totalprice) / 100000.0, 4) AS score, -round(sum(o_totalprice) / 50000.0, 4) AS log_p FROM {orders} GROUP BY 1, 2, 3""",
}


def tables_of(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of VIEWS as a DataFrame over the tables in sf_dir."""
    sql = VIEWS[name]
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables_of(sql)})


def oracle(sql: str) -> str:
    """SQL for DuckDB: the views that it names become common table expressions before it."""
    used = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    heads = [f"{n} AS ({re.sub(r'[{}]', '', VIEWS[n])})" for n in used]
    sql = sql.strip()
    if sql[:5].upper() == "WITH ":
        return "WITH " + ", ".join(heads) + (", " if heads else "") + sql[5:]
    return ("WITH " + ", ".join(heads) + " " if heads else "") + sql
