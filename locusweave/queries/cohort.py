"""Queries of QC and cohort tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusweave.operators import cohort as co
from locusweave.operators import hic
from locusweave.operators import variants as vr
from locusweave.queries import query

_TYPES = ["click", "view", "purchase", "signup", "error", "refund"]


def _metrics(g):
    return g.metrics.select("sample", "metric", "value")


@query(
    "t21_normalize_metric_labels",
    """WITH x AS (SELECT concat('Number of ', event_type) AS metric, 'MAP' AS category, floor(value) * 1000000 AS value, CASE WHEN event_id % 2 = 0 THEN floor(value) END AS percent FROM events),
    b AS (SELECT concat(category, ': ', metric) AS metric, value, percent FROM x)
    SELECT metric, CAST(value AS DOUBLE) AS value FROM b UNION ALL SELECT concat(replace(metric, 'Number of', 'Percent'), ' (%)'), CAST(percent AS DOUBLE) FROM b WHERE percent IS NOT NULL
    UNION ALL SELECT concat(metric, CASE WHEN value > 5e9 THEN ' (G)' ELSE ' (M)' END), round(value / CASE WHEN value > 5e9 THEN 1e9 ELSE 1e6 END, 2) FROM b WHERE value > 5e6""",
)
def _(g):
    e = g.table("events")
    rows = e.select(
        F.lit("MAP").alias("category"), F.concat(F.lit("Number of "), "event_type").alias("metric"), (F.floor("value") * 1_000_000).cast("double").alias("value"),
        F.when(F.col("event_id") % 2 == 0, F.floor("value").cast("double")).alias("percent"),
    )
    return co.normalize_metric_labels(rows)


_COVER = "x AS (SELECT concat('g', p_size % 10) AS gene, p_partkey AS region, p_size AS st, p_size + p_partkey % 90 AS en, p_partkey * 3 AS total, p_size AS low, p_size * 4 AS high, p_partkey % 101 AS pct FROM part)"


@query(
    "a20_gene_coverage_rollup",
    f"""WITH {_COVER}, l AS (SELECT *, en - st + 1 AS length FROM x), u AS (
      SELECT gene, region, 'region' AS level, sum(total) AS total, sum(length) AS length, min(low) AS low, max(high) AS high, sum(pct * length) AS w FROM l GROUP BY 1, 2
      UNION ALL SELECT gene, NULL, 'gene', sum(total), sum(length), min(low), max(high), sum(pct * length) FROM l GROUP BY 1
      UNION ALL SELECT NULL, NULL, 'assay', sum(total), sum(length), min(low), max(high), sum(pct * length) FROM l)
    SELECT gene, region, level, CAST(total AS BIGINT) AS total, CAST(length AS BIGINT) AS length, low, high, round(CAST(w AS DOUBLE) / CAST(length AS DOUBLE), 1) AS pct, CAST(floor(total / length) AS BIGINT) AS mean FROM u""",
)
def _(g):
    p = g.table("part")
    size, key = F.col("p_size"), F.col("p_partkey")
    rows = p.select(F.concat(F.lit("g"), (size % 10).cast("string")).alias("gene"), key.alias("region"), size.alias("st"), (size + key % 90).alias("en"), (key * 3).alias("total"), size.alias("low"), (size * 4).alias("high"), (key % 101).alias("pct"))
    return co.gene_coverage_rollup(rows).select("gene", "region", "level", "total", "length", "low", "high", "pct", "mean")


@query("a21_assay_coverage", f"WITH {_COVER} SELECT round(CAST(sum(pct * (en - st + 1)) AS DOUBLE) / sum(en - st + 1), 1) AS pct FROM x")
def _(g):
    p = g.table("part")
    size, key = F.col("p_size"), F.col("p_partkey")
    rows = p.select(F.lit("g").alias("gene"), key.alias("region"), size.alias("st"), (size + key % 90).alias("en"), key.alias("total"), size.alias("low"), size.alias("high"), (key % 101).alias("pct"))
    return co.gene_coverage_rollup(rows).where("level = 'assay'").select("pct")


@query(
    "a22_coverage_curve",
    """WITH h AS (SELECT CAST(l_quantity AS INT) AS depth, count(*) AS n FROM lineitem GROUP BY 1), c AS (SELECT depth + 1 AS depth, 100 - 100.0 * sum(n) OVER (ORDER BY depth) / sum(n) OVER () AS share FROM h QUALIFY depth < max(depth) OVER ())
    SELECT depth, round(share, 6) AS share, concat('>=', depth, 'x') AS label FROM c WHERE depth IN (10, 20, 30, 50, 51)""",
)
def _(g):
    hist = g.table("lineitem").groupBy(F.col("l_quantity").cast("int").alias("depth")).agg(F.count(F.lit(1)).alias("n"))
    return co.coverage_curve(hist, [10, 20, 30, 50, 51]).withColumn("share", F.round("share", 6))


@query(
    "a24_genotype_string",
    """WITH h AS (SELECT concat('s', o_custkey % 10) AS sample, concat('chr', 9 + o_orderkey % 4) AS chrom, 123456700 + o_orderkey % 5 * 1000 AS snp1,
      CASE WHEN o_orderkey % 11 < 5 THEN 'AC' WHEN o_orderkey % 11 < 10 THEN 'GC' ELSE 'TT' END AS hap FROM orders),
    c AS (SELECT sample, chrom, snp1, hap, count(*) / CAST(sum(count(*)) OVER (PARTITION BY sample, chrom, snp1) AS DOUBLE) AS share FROM h GROUP BY 1, 2, 3, 4),
    s AS (SELECT sample, chrom, snp1 AS pos, hap[1] AS allele FROM c WHERE share > 0.4 UNION SELECT sample, chrom, snp1 + 31, hap[2] FROM c WHERE share > 0.4),
    g AS (SELECT sample, chrom, pos, CASE WHEN count(*) = 2 THEN string_agg(allele, '' ORDER BY allele) ELSE min(allele) || min(allele) END AS gt FROM s GROUP BY 1, 2, 3)
    SELECT sample, string_agg(concat_ws(',', chrom, pos, gt), '|' ORDER BY CAST(substr(chrom, 4) AS INT), pos) AS genotype FROM g GROUP BY 1""",
)
def _(g):
    k = F.col("o_orderkey")
    haps = g.table("orders").select(
        F.concat(F.lit("s"), (F.col("o_custkey") % 10).cast("string")).alias("sample"), F.concat(F.lit("chr"), (9 + k % 4).cast("string")).alias("chrom"), (123456700 + k % 5 * 1000).alias("snp1"),
        F.when(k % 11 < 5, "AC").when(k % 11 < 10, "GC").otherwise("TT").alias("hap"),
    )
    counts = haps.groupBy("sample", "chrom", "snp1", "hap").agg(F.count(F.lit(1)).alias("n"))
    loci = counts.groupBy("sample", "chrom", "snp1").agg(F.sum("n").alias("total_reads"), F.concat(F.array_join(F.collect_list(F.concat("hap", F.lit(":"), F.col("n").cast("string"))), ";"), F.lit(";")).alias("haplotype_counts"))
    return co.genotype_string(loci.withColumn("snp2", F.col("snp1") + 31))


@query(
    "a18_recall_by_bin",
    """WITH x AS (SELECT alt_reads / CAST(alt_reads + ref_reads AS DOUBLE) AS vaf, CAST(filter = 'PASS' AS INT) AS detected FROM fx_variants WHERE alt_reads + ref_reads > 0),
    b AS (SELECT CASE WHEN vaf >= 0.5 THEN 4 WHEN vaf >= 0.2 THEN 3 WHEN vaf >= 0.1 THEN 2 WHEN vaf >= 0.05 THEN 1 ELSE 0 END AS bin, detected FROM x WHERE vaf < 1.01),
    r AS (SELECT bin, count(*) AS n, CAST(sum(detected) AS BIGINT) AS found, CAST(sum(detected) AS DOUBLE) / count(*) AS recall FROM b WHERE bin > 0 GROUP BY 1)
    SELECT *, coalesce(bin = (SELECT min(bin) FROM r WHERE recall >= 0.8), false) AS first_good FROM r""",
)
def _(g):
    total = F.col("alt_reads") + F.col("ref_reads")
    rows = g.variants.where(total > 0).select((F.col("alt_reads") / total).alias("vaf"), (F.col("filter") == "PASS").cast("int").alias("detected"))
    return co.recall_by_bin(rows, [0.05, 0.1, 0.2, 0.5, 1.01])


@query("u06_pivot_metrics", "SELECT sample, " + ", ".join(f"round(avg(value) FILTER (metric = '{m}'), 6) AS {m}" for m in _TYPES) + " FROM fx_metrics GROUP BY 1")
def _(g):
    return co.metric_table(_metrics(g), "sample", _TYPES)


@query("u06_unpivot_metrics", "SELECT sample, metric, round(avg(value), 6) AS value FROM fx_metrics WHERE metric IN (" + ", ".join(f"'{m}'" for m in _TYPES) + ") GROUP BY 1, 2")
def _(g):
    return co.unpivot_metrics(co.metric_table(_metrics(g), "sample", _TYPES), "sample", _TYPES)


@query(
    "a23_derived_qc",
    """WITH m AS (SELECT sample, max(value) FILTER (metric = 'click') / 50 AS ploidy, max(value) FILTER (metric = 'view') AS pairs, max(value) FILTER (metric = 'purchase') AS n, max(value) FILTER (metric = 'signup') AS hit,
      max(value) FILTER (metric = 'error') AS mapped FROM fx_metrics GROUP BY 1), k AS (SELECT *, CAST(round(ploidy * 23, 0) AS INT) AS c, round(pairs * 2 / nullif(n, 0) * 100, 1) AS consensus FROM m)
    SELECT sample, CASE WHEN abs(c - 46) > 2 THEN c ELSE greatest(46, c) END AS chromosome_number, consensus AS consensus_pct, round(100 - consensus, 1) AS duplicate_pct, round(hit / nullif(mapped, 0) * 100, 1) AS on_target_pct FROM k""",
)
def _(g):
    rows = g.metrics.select("sample", "metric", F.when(F.col("metric") == "click", F.col("value") / 50).otherwise(F.col("value")).alias("value"))
    return co.derived_qc(rows, "sample", {"ploidy": "click", "consensus_pairs": "view", "reads": "purchase", "on_target": "signup", "mapped": "error"})


@query("a32_label_crosstab", "SELECT sample, count(*) FILTER (arm = 'edited') AS label_edited, count(*) FILTER (arm = 'control') AS label_control FROM fx_reads GROUP BY 1")
def _(g):
    return co.label_crosstab(g.reads, "sample", "arm", ["edited", "control"])


@query(
    "a33_feature_histogram",
    """WITH b AS (SELECT min(mapq) AS lo, quantile_cont(mapq, 0.9) AS hi FROM fx_reads), c AS (SELECT arm, CAST(least(floor((mapq - lo) / ((hi - lo) / 10)), 9) AS BIGINT) AS bin, count(*) AS n, round(avg(mapq), 6) AS mean, (max(hi) - max(lo)) / 10 AS w FROM fx_reads, b GROUP BY 1, 2)
    SELECT arm, bin, n, mean, round(n / (sum(n) OVER (PARTITION BY arm) * w), 9) AS density FROM c""",
)
def _(g):
    return co.feature_histogram(g.reads, "mapq", "arm", 10, 0.9).withColumn("density", F.round("density", 9))


@query("w06_number_replicates", "SELECT o_orderkey, concat('c', o_custkey, '_T', row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)) AS replicate FROM orders")
def _(g):
    rows = g.table("orders").select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("sample"))
    return co.number_replicates(rows, "sample", "o_orderkey").select("o_orderkey", "replicate")


@query("w07_spans_to_next", """WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders GROUP BY 1, 2)
    SELECT o_custkey, CAST(d AS VARCHAR) AS d, CAST(CAST(lead(d) OVER w - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS until, lead(d) OVER w IS NULL AS latest FROM d WINDOW w AS (PARTITION BY o_custkey ORDER BY d)""")
def _(g):
    rows = g.table("orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("d")).distinct()
    out = co.spans_to_next(rows, "o_custkey", "d")
    return out.select("o_custkey", F.col("d").cast("string").alias("d"), F.col("until").cast("string").alias("until"), "latest")


@query("w08_fill_upward", """WITH x AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS s FROM orders)
    SELECT o_orderkey, (SELECT y.s FROM x y WHERE y.o_custkey = x.o_custkey AND y.o_orderkey >= x.o_orderkey AND y.s IS NOT NULL ORDER BY y.o_orderkey LIMIT 1) AS s FROM x""")
def _(g):
    rows = g.table("orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).alias("s"))
    return co.fill_upward(rows, "o_custkey", "o_orderkey", "s").select("o_orderkey", "s")


@query("w09_slice_with_ties", "WITH m AS (SELECT chrom, max(alt_reads) AS alt_reads FROM fx_variants GROUP BY 1) SELECT m.chrom, m.alt_reads, string_agg(DISTINCT svtype, ',' ORDER BY svtype) AS tags FROM fx_variants v JOIN m ON v.chrom = m.chrom AND v.alt_reads = m.alt_reads GROUP BY 1, 2")
def _(g):
    return co.slice_with_ties(g.variants, "chrom", "alt_reads", "svtype")


@query("w10_pair_rows", """WITH n AS (SELECT o_custkey, o_orderpriority AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n FROM orders)
    SELECT o_custkey, n // 2 AS pair, max(CASE WHEN n % 2 = 0 THEN v END) AS name, max(CASE WHEN n % 2 = 1 THEN v END) AS content FROM n GROUP BY 1, 2""")
def _(g):
    return co.pair_rows(g.table("orders"), "o_custkey", "o_orderkey", "o_orderpriority")


@query("d14_supported_versions", "WITH v AS (SELECT DISTINCT p_size AS minor, p_partkey % 9 AS patch FROM part) SELECT minor, patch FROM (SELECT *, max(patch) OVER (PARTITION BY minor) AS l, dense_rank() OVER (ORDER BY minor DESC) AS r FROM v) WHERE patch = l OR r <= 2")
def _(g):
    rows = g.table("part").select(F.col("p_size").alias("minor"), (F.col("p_partkey") % 9).alias("patch")).distinct()
    return co.supported_versions(rows)


_SHEET = "x AS (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN ' ' ELSE s_name END AS name, CASE WHEN s_suppkey % 7 <> 0 THEN concat('a_', s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN '.bam' ELSE '.fastq.gz' END) END AS one, CASE WHEN s_suppkey % 2 = 0 THEN concat('b_', s_suppkey, '.fastq.gz') END AS two FROM supplier)"


@query(
    "d16_validate_sheet",
    f"""WITH {_SHEET} SELECT s_suppkey, concat_ws(',', CASE WHEN trim(name) = '' THEN 'no name' END, CASE WHEN one IS NULL THEN 'no first file' END, CASE WHEN one LIKE '%.bam' THEN 'unknown suffix' END,
    CASE WHEN two IS NOT NULL AND one LIKE '%.bam' THEN 'suffixes differ' END) AS errors, two IS NULL AS single_end FROM x""",
)
def _(g):
    k = F.col("s_suppkey")
    rows = g.table("supplier").select(
        "s_suppkey", F.when(k % 5 == 0, " ").otherwise(F.col("s_name")).alias("name"),
        F.when(k % 7 != 0, F.concat(F.lit("a_"), k.cast("string"), F.when(k % 3 == 0, ".bam").otherwise(".fastq.gz"))).alias("one"), F.when(k % 2 == 0, F.concat(F.lit("b_"), k.cast("string"), F.lit(".fastq.gz"))).alias("two"),
    )
    return co.validate_sheet(rows, "name", "one", "two", (".fastq.gz", ".fq.gz")).select("s_suppkey", F.array_join("errors", ",").alias("errors"), "single_end")


@query("t32_read_group_ids", "WITH x AS (SELECT read_name, concat_ws('.', sample, chrom, CASE WHEN mapq > 30 THEN arm END) AS rgid FROM fx_reads) SELECT rgid, count(*) AS n, count(*) > 1 AS repeated FROM x GROUP BY 1")
def _(g):
    rows = co.read_group_ids(g.reads.withColumn("arm", F.when(F.col("mapq") > 30, F.col("arm"))), "sample", "chrom", "arm")
    return rows.groupBy("rgid").agg(F.count(F.lit(1)).alias("n"), F.bool_or("repeated").alias("repeated"))


@query(
    "t33_normalize_samples",
    """WITH x AS (SELECT c_custkey, regexp_replace(trim(c_name), '\\s+', '_', 'g') AS code, lower(c_mktsegment[1]) AS s, CASE WHEN c_nationkey % 3 = 0 THEN 'BM' WHEN c_nationkey % 3 = 1 THEN 'PB' ELSE 'Skin_punch' END AS specimen, c_custkey % 4 = 0 AS marked FROM customer)
    SELECT c_custkey, CASE WHEN s IN ('m', 'f') THEN s END AS sex, CASE WHEN marked THEN concat('W', c_custkey, '-7') END AS accession,
      concat_ws('-', code, CASE WHEN marked THEN concat('W', c_custkey, '-7') END, 10 + c_custkey, specimen) AS id FROM x""",
)
def _(g):
    kind = F.when(F.col("c_nationkey") % 3 == 0, "Bone Marrow-WML").when(F.col("c_nationkey") % 3 == 1, " Whole Blood").otherwise("Skin punch")
    code = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("W"), F.col("c_custkey").cast("string"), F.lit("-7 "), F.col("c_name"))).otherwise(F.col("c_name"))
    rows = g.table("customer").select("c_custkey", code.alias("code"), F.col("c_mktsegment").alias("sex"), kind.alias("specimen"), (10 + F.col("c_custkey")).alias("mrn"))
    return co.normalize_samples(rows, "code", "sex", "specimen", "mrn").select("c_custkey", "sex", "accession", "id")


@query("t35_coalesce_columns", "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, o_orderpriority) AS status FROM orders")
def _(g):
    rows = g.table("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("s"), F.col("o_orderpriority").alias("status"))
    return co.coalesce_columns(rows, "s", "status")


@query("t36_wide_to_long_pairs", "SELECT s_suppkey, 'tumor' AS sample_type, s_name AS file, s_nationkey AS lane FROM supplier UNION ALL SELECT s_suppkey, 'normal', concat('n', s_suppkey), s_suppkey % 4 FROM supplier")
def _(g):
    k = F.col("s_suppkey")
    rows = g.table("supplier").select("s_suppkey", F.col("s_name").alias("tumor_file"), F.col("s_nationkey").cast("long").alias("tumor_lane"), F.concat(F.lit("n"), k.cast("string")).alias("normal_file"), (k % 4).cast("long").alias("normal_lane"))
    return co.wide_to_long_pairs(rows, "s_suppkey", ("tumor", "normal"), ("file", "lane"))


@query("d12_min_non_null", f"WITH {_SHEET} SELECT s_suppkey FROM x WHERE CAST(one IS NOT NULL AS INT) + CAST(two IS NOT NULL AS INT) >= 2")
def _(g):
    k = F.col("s_suppkey")
    rows = g.table("supplier").select("s_suppkey", F.when(k % 7 != 0, F.lit("a")).alias("one"), F.when(k % 2 == 0, F.lit("b")).alias("two"))
    return co.min_non_null(rows, ["one", "two"], 2).select("s_suppkey")


@query("d13_drop_empty_columns", "SELECT n_nationkey, n_name FROM nation")
def _(g):
    rows = g.table("nation").select("n_nationkey", "n_name", F.lit(None).cast("string").alias("gone"), F.lit("").alias("blank"))
    return co.drop_empty_columns(rows)


@query("j21_mate_files", "SELECT l_orderkey, min(l_partkey) FILTER (l_linenumber = 1) AS R1, min(l_partkey) FILTER (l_linenumber = 2) AS R2 FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1")
def _(g):
    rows = g.table("lineitem").where("l_linenumber <= 2").select("l_orderkey", F.concat(F.lit("R"), F.col("l_linenumber").cast("string")).alias("r"), "l_partkey")
    return co.mate_files(rows, ["l_orderkey"], "r", "l_partkey")


@query("j11_case_summary", "SELECT c.sample, v.n, m.n AS events FROM (SELECT DISTINCT sample FROM fx_variants) c LEFT JOIN (SELECT sample, count(*) AS n FROM fx_variants WHERE filter = 'PASS' GROUP BY 1) v USING (sample) LEFT JOIN (SELECT sample, count(*) AS n FROM fx_metrics GROUP BY 1) m USING (sample)")
def _(g):
    cases = g.variants.select("sample").distinct()
    v = g.variants.where("filter = 'PASS'").groupBy("sample").agg(F.count(F.lit(1)).alias("n"))
    m = g.metrics.groupBy("sample").agg(F.count(F.lit(1)).alias("events"))
    return co.case_summary(cases, {"variants": v, "metrics": m}, "sample")


@query("u01_union_loose", "SELECT n_nationkey AS key, n_name AS name, NULL AS comment FROM nation UNION ALL SELECT r_regionkey, NULL, r_name FROM region")
def _(g):
    return co.union_loose(g.table("nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")), g.table("region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("comment"))).select("key", "name", "comment")


@query("u03_distinct_rows", "SELECT DISTINCT chrom, pos, svtype FROM fx_variants")
def _(g):
    return co.distinct_rows(g.variants, "chrom", "pos", "svtype")


@query("u05_set_operations", "SELECT id, list_has_any(string_split(filter, ';'), ['MaxDepth']) AS deep, len([x FOR x IN string_split(filter, ';') IF x NOT IN ('PASS', 'MaxDepth', 'MinSomaticScore')]) AS others FROM fx_variants")
def _(g):
    names = F.split("filter", ";")
    return g.variants.select("id", (F.size(co.names_in(names, ["MaxDepth"])) > 0).alias("deep"), F.size(co.names_besides(names, ["PASS", "MaxDepth", "MinSomaticScore"])).cast("long").alias("others"))


@query(
    "t37_codon_range",
    """WITH ex AS (SELECT trx, st, st + 40 AS en, strand FROM fx_genes UNION ALL SELECT trx, st + 60, st + 101, strand FROM fx_genes),
    r AS (SELECT trx, st + 10 AS st, st + 70 AS en FROM fx_genes),
    p AS (SELECT *, coalesce(sum(en - st) OVER (PARTITION BY trx ORDER BY st * strand ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ex),
    m AS (SELECT r.trx, r.st, r.en, p.before + CASE WHEN strand > 0 THEN greatest(r.st, p.st) - p.st ELSE p.en - least(r.en, p.en) END AS a, p.before + CASE WHEN strand > 0 THEN least(r.en, p.en) - p.st ELSE p.en - greatest(r.st, p.st) END AS b
      FROM r JOIN p ON r.trx = p.trx AND r.st < p.en AND p.st < r.en)
    SELECT trx, st, en, CAST(min(floor(a / 3) + 1) AS BIGINT) AS first_codon, CAST(max(ceil(b / 3)) AS BIGINT) AS last_codon FROM m GROUP BY 1, 2, 3""",
)
def _(g):
    t = g.genes.select("trx", "st", "strand")
    exons = t.select("trx", "st", (F.col("st") + 40).alias("en"), "strand").unionByName(t.select("trx", (F.col("st") + 60).alias("st"), (F.col("st") + 101).alias("en"), "strand"))
    return co.codon_range(t.select("trx", (F.col("st") + 10).alias("st"), (F.col("st") + 70).alias("en")), exons)


@query("j09_label_join", "SELECT e.vec_id, e.label, l.toxic FROM embeddings e JOIN labels l ON e.vec_id = l.doc_id")
def _(g):
    return co.label_join(g.table("embeddings"), g.table("labels"), "vec_id", "doc_id").select("vec_id", "label", "toxic")


@query("j10_attach_metadata", "SELECT v.id, g.symbol FROM fx_variants v LEFT JOIN fx_genes g ON g.symbol = split_part(v.csq, '|', 2) AND regexp_matches(g.chrom, '^chr[12]$')")
def _(g):
    info = g.genes.where(F.col("chrom").rlike("^chr[12]$")).select("symbol")
    return g.variants.withColumn("symbol_of", F.get(F.split("csq", r"[|]"), F.lit(1))).transform(lambda v: co.attach_metadata(v, info, "symbol_of", "symbol")).select("id", "symbol")


@query("j16_panel_by_sample", "SELECT s.guide, s.chrom, s.pos, p.sample FROM fx_sites s JOIN (SELECT DISTINCT concat('G', pos % 5) AS guide, sample FROM fx_variants) p USING (guide)")
def _(g):
    sheet = g.variants.select(F.concat(F.lit("G"), (F.col("pos") % 5).cast("string")).alias("guide"), "sample").distinct()
    return co.panel_by_sample(g.sites, sheet).select("guide", "chrom", "pos", "sample")


@query("d10_candidate_gate", "WITH x AS (SELECT id, alt_reads / 13.0 AS fraction, ref_reads / 400.0 AS control_fraction, pos % 5 AS mm, pos % 3 AS t FROM fx_variants) SELECT id FROM x WHERE fraction > 0.05 AND fraction <= 1 AND control_fraction < 0.02 AND mm <= 2 AND t = 0")
def _(g):
    rows = g.variants.select("id", (F.col("alt_reads") / 13.0).alias("fraction"), (F.col("ref_reads") / 400.0).alias("control_fraction"), (F.col("pos") % 5).alias("min_mismatches"), (F.col("pos") % 3).alias("is_target"))
    return vr.candidate_gate(rows, most_mismatches=2, off_target=True).select("id")


@query("d17_false_positive_sites", "SELECT DISTINCT chrom, pos FROM fx_sites WHERE is_target = 0 AND pos % 3 > 0 AND pos % 7 = 0")
def _(g):
    rows = g.sites.withColumn("indel", F.col("pos") % 3).withColumn("control_indel", F.col("pos") % 5).withColumn("predicted", F.col("pos") % 7)
    return vr.false_positive_sites(rows)[1].select("chrom", "pos").distinct()


@query("d07_mnv_component_filter", "SELECT id FROM fx_variants WHERE svtype = CASE WHEN pos % 2 = 0 THEN 'DEL' ELSE 'INS' END")
def _(g):
    tag = F.concat(F.lit("A>"), F.when(F.col("pos") % 2 == 0, "DEL").otherwise("INS"))
    return vr.mnv_component_filter(g.variants.withColumn("tag", tag), "tag", "svtype").select("id")


@query("o04_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(g):
    return co.top_k(g.table("orders").select("o_orderkey", "o_totalprice"), 25, F.desc("o_totalprice"), "o_orderkey")


@query("o02_reference_order", "SELECT symbol, row_number() OVER (ORDER BY CASE chrom WHEN 'chr3' THEN 0 WHEN 'chr1' THEN 1 ELSE 2 END, st) AS place FROM fx_genes WHERE chrom IN ('chr3', 'chr1', 'chr2')")
def _(g):
    contigs = g.spark.createDataFrame([("chr3", 0), ("chr1", 1), ("chr2", 2)], "chrom string, ord int")
    return hic.genome_order(g.genes, contigs, "st").select("symbol", "place")


@query("a34_group_matrix", "SELECT p_brand AS version, count(DISTINCT p_type) AS groups FROM part GROUP BY 1")
def _(g):
    return g.table("part").groupBy(F.col("p_brand").alias("version")).agg(F.count_distinct("p_type").alias("groups"))
