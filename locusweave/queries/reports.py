"""Queries of sources, sinks and reports: lines are made from the tables, then read or written."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusweave.functions import variants as fn
from locusweave.plans.scratch import fresh_folder
from locusweave.queries import query
from locusweave.sources import sinks, text


def _vcf(g):
    info = F.concat(F.lit("SVTYPE="), "svtype", F.lit(";PRECISE;END="), (F.col("pos") + F.col("svlen")).cast("string"))
    return g.variants.select(F.concat_ws("\t", "chrom", F.col("pos").cast("string"), "id", F.lit("N"), F.concat(F.lit("<"), "svtype", F.lit(">")), F.lit("."), "filter", info, F.lit("PR:SR"), F.concat("ref_reads", F.lit(":"), "alt_reads")).alias("value"))


@query(
    "s01_read_variants",
    """SELECT chrom, pos, id, concat('<', svtype, '>') AS alt, filter, svtype, CAST(pos + svlen AS VARCHAR) AS last, 'tumor' AS sample, CAST(alt_reads AS VARCHAR) AS sr FROM fx_variants
    UNION ALL SELECT chrom, pos, id, concat('<', svtype, '>'), filter, svtype, CAST(pos + svlen AS VARCHAR), 'normal', NULL FROM fx_variants""",
)
def _(g):
    head = g.variants.select(F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ttumor\tnormal").alias("value")).limit(1)
    rows = head.unionByName(_vcf(g).select(F.concat("value", F.lit("\t7")).alias("value")))
    v = text.calls_by_sample(text.variants_of(rows), text.sample_names(rows))
    return v.select("chrom", "pos", "id", F.get("alts", F.lit(0)).alias("alt"), F.array_join("filters", ";").alias("filter"), F.col("info")["SVTYPE"].alias("svtype"), F.col("info")["END"].alias("last"), "sample", F.col("call")["SR"].alias("sr"))


@query("s02_header_fields", "SELECT n_nationkey, 'Allele,Consequence,' || n_name AS fields FROM nation")
def _(g):
    about = F.concat(F.lit('"Annotations. Format: Allele|Consequence|'), "n_name", F.lit('"'))
    return g.table("nation").select("n_nationkey", F.array_join(fn.header_fields(about), ",").alias("fields"))


@query("s03_target_variants", "SELECT chrom, pos - 1 AS start0, pos, CAST(svtype = 'DEL' AS INT) AS on_target FROM fx_variants")
def _(g):
    info = F.when(F.col("svtype") == "DEL", "TARGET;A=1").otherwise("A=1")
    rows = g.variants.select(F.concat_ws("\t", "chrom", F.col("pos").cast("string"), "id", F.lit("N"), F.lit("."), F.lit("."), "filter", info).alias("value"))
    return text.target_variants_of(rows)


@query("s05_labelled_reads", "SELECT CAST(arm = 'edited' AS INT) AS label, chrom, ref_start + 5 AS pos, read_name, ref_start, mapq, cigar, '2' AS nm FROM fx_reads")
def _(g):
    r = g.reads
    mark = F.when(F.col("arm") == "edited", "TP").otherwise("TN")
    sam = F.concat_ws("\t", mark, "chrom", (F.col("ref_start") + 5).cast("string"), "read_name", F.lit("0"), "chrom", (F.col("ref_start") + 1).cast("string"), F.col("mapq").cast("string"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGT"), F.lit("IIII"), F.lit("NM:i:2"))
    out = text.labelled_reads_of(r.select(sam.alias("value")))
    return out.select("label", "chrom", "pos", "read_name", "ref_start", "mapq", "cigar", F.col("tags")["NM"].alias("nm"))


@query("s06_target_bed", "SELECT DISTINCT chrom, st, en, symbol AS gene, 'gene' AS type, trx, CAST(strand AS VARCHAR) AS strand FROM fx_genes WHERE st % 2 = 0")
def _(g):
    info = F.concat_ws("|", F.when(F.col("st") % 2 == 0, "gene").otherwise("other"), F.lit("r"), "symbol", F.lit("id"), "trx", F.lit(""), F.lit(""), F.col("strand").cast("string"))
    rows = g.genes.select(F.concat_ws("\t", "chrom", F.col("st").cast("string"), F.col("en").cast("string"), "symbol", info).alias("value"))
    return text.targets_of(rows.unionByName(rows)).select("chrom", "st", "en", "gene", "type", "trx", "strand")


@query("s07_bedgraph", "SELECT chrom, pos AS st, pos + 1 AS en, alt_reads / 2.0 AS v FROM fx_variants WHERE pos % 2 = 0")
def _(g):
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), (F.col("pos") + 1).cast("string"), F.when(F.col("pos") % 2 == 0, (F.col("alt_reads") / 2.0).cast("string")))
    return text.bedgraph_of(g.variants.select(line.alias("value")))


@query("s09_contacts", "SELECT chrom AS chr1, i AS mid1, chrom AS chr2, j AS mid2, CAST(n AS DOUBLE) AS n FROM fx_contacts")
def _(g):
    return text.contacts_of(g.contacts.select(F.concat_ws(" ", "chrom", F.col("i").cast("string"), "chrom", F.col("j").cast("string"), F.col("n").cast("string")).alias("value")))


@query("s12_split_json", "SELECT chrom AS name, symbol AS cell FROM fx_genes")
def _(g):
    docs = sinks.split_json(g.genes, "chrom", ["symbol", "st"]).select(F.col("chrom").alias("name"), F.concat(F.lit('{"VARIANTS":'), "document", F.lit("}")).alias("value"))
    return text.split_json_of(docs, "VARIANTS").where("column = 'symbol'").select("name", "cell")


@query("s14_sections", "SELECT concat('s', s_suppkey) AS name, 'GENES' AS section, s_name AS text FROM supplier UNION ALL SELECT concat('s', s_suppkey), 'CNV', 'none' FROM supplier WHERE s_suppkey % 2 = 1")
def _(g):
    cnv = F.when(F.col("s_suppkey") % 2 == 1, "none").otherwise("None Detected")
    report = F.concat(F.lit("head\n*** GENES ***\n"), "s_name", F.lit("\n\n*** CNV ***\n"), cnv, F.lit("\n"))
    rows = g.table("supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("name"), report.alias("value"))
    return text.sections_of(rows).select("name", "section", "text")


@query("s17_manifest", "SELECT CASE WHEN s_suppkey % 2 = 0 THEN concat('n', s_suppkey) ELSE concat('f', s_suppkey, '.tar') END AS name, concat('/a/f', s_suppkey, '.tar.gz') AS path FROM supplier")
def _(g):
    path = F.concat(F.lit("/a/f"), F.col("s_suppkey").cast("string"), F.lit(".tar.gz"))
    line = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("n"), F.col("s_suppkey").cast("string"), F.lit("\t"), path)).otherwise(path)
    return text.manifest_of(g.table("supplier").select(line.alias("value")))


@query(
    "s18_candidates",
    """SELECT id, sample, CAST(svtype = 'DEL' AS INT) AS truth, CASE WHEN pos % 2 = 0 THEN alt_reads / 4.0 END AS indel_fraction, CAST(pos % 3 = 0 OR pos % 5 = 0 AS INT) AS target,
    CASE WHEN pos % 4 = 0 THEN 99 ELSE least(pos % 6, ref_reads % 6) END AS min_mismatches FROM fx_variants""",
)
def _(g):
    pos, best = F.col("pos"), F.concat_ws(",", (F.col("pos") % 6).cast("string"), (F.col("ref_reads") % 6).cast("string"))
    info = F.concat_ws(";", F.lit("SRC=a"), F.when(pos % 5 == 0, F.lit("TARGET")), F.when(pos % 4 > 0, F.concat(F.lit("MISMATCHES="), best)))
    rows = g.variants.select(
        "id", F.concat(F.lit("/data/"), "sample", F.lit(".tagged.csv")).alias("file"), F.when(F.col("svtype") == "DEL", "Edit").otherwise("no").alias("manual_review"),
        F.when(pos % 2 == 0, (F.col("alt_reads") / 4.0).cast("string")).otherwise("NA").alias("indel_fraction"), (pos % 3 == 0).cast("int").alias("is_target"), info.alias("target_info"),
    )
    return text.candidates_of(rows, F.col("file")).select("id", "sample", "truth", "indel_fraction", "target", "min_mismatches")


@query("s20_read_group_probe", "SELECT concat('f', o_custkey % 5) AS file, 'FC1' AS flowcell, '2' AS lane, 'ACGT' AS index, 50 AS length FROM orders GROUP BY 1")
def _(g):
    o = g.table("orders").select(F.concat(F.lit("f"), (F.col("o_custkey") % 5).cast("string")).alias("file"), "o_orderkey")
    from pyspark.sql import Window as W

    n = (F.row_number().over(W.partitionBy("file").orderBy("o_orderkey")) - 1).cast("long")
    head = F.when(F.col("n") % 12 == 0, "@M:1:FC1:2:1:1:1 1:N:0:ANGT").otherwise("@M:1:FC1:2:1:1:1 1:N:0:ACGT")
    value = F.when(F.col("n") % 4 == 0, head).when(F.col("n") % 4 == 1, F.repeat(F.lit("A"), F.when(F.col("n") % 20 == 1, 40).otherwise(50))).otherwise("+")
    return text.read_group_probe_of(o.withColumn("n", n).withColumn("value", value))


@query("s21_read_features", "SELECT vec_id, label FROM embeddings WHERE label IS NOT NULL")
def _(g):
    return text.read_features(g.spark, [f"{g.sf_dir}/embeddings.parquet"], ["vec_id", "label"])


@query("s22_reference_bases", "SELECT p_partkey, rpad(substr(repeat(upper(p_name), 40), (p_partkey % 300) + 1, 7), 7, 'N') AS bases FROM part")
def _(g):
    parts = g.table("part")
    contigs = parts.select(F.col("p_partkey").cast("string").alias("chrom"), F.repeat(F.upper("p_name"), F.lit(40)).alias("seq"))
    sites = parts.select("p_partkey", F.col("p_partkey").cast("string").alias("chrom"), (F.col("p_partkey") % 300 + 3).cast("long").alias("pos"))
    return text.bases_at(sites, text.reference_chunks(contigs, 64), 3, 3, 64).select("p_partkey", "bases")


@query("k02_variant_lines", "SELECT concat_ws(chr(9), chrom, pos, concat_ws('_', chrom, pos, svtype, row_number() OVER (PARTITION BY chrom, pos, svtype ORDER BY id)), 'N', id, '.', filter, concat('LEN=', svlen, ';PRECISE;SVTYPE=', svtype)) AS value FROM fx_variants")
def _(g):
    info = F.create_map(F.lit("SVTYPE"), F.col("svtype"), F.lit("PRECISE"), F.lit(""), F.lit("LEN"), F.col("svlen").cast("string"))
    return sinks.variant_lines(g.variants.select("chrom", "pos", F.lit("N").alias("ref"), F.col("id").alias("alt"), "filter", "svtype", info.alias("info")))


@query("k03_split_json", """SELECT chrom, concat('{"columns":["symbol"],"data":[', string_agg(concat('["', symbol, '"]'), ',' ORDER BY symbol), ']}') AS document FROM fx_genes GROUP BY 1""")
def _(g):
    return sinks.split_json(g.genes, "chrom", ["symbol"])


@query("k05_circos", "SELECT concat_ws(chr(9), replace(chrom, 'chr', 'hs'), st, en, concat('annotation=', symbol)) AS value FROM fx_genes")
def _(g):
    return sinks.circos_lines(g.genes.withColumnRenamed("symbol", "annotation"))


@query("k06_interaction_track", "SELECT chr1 AS chrom, st1 AS st, en1 AS en, concat(chr2, ':', st2, '-', en2, ',', pair_id) AS target, '.' AS strand FROM fx_pairs")
def _(g):
    names = {"chr1": "bait_chrom", "st1": "bait_st", "en1": "bait_en", "chr2": "other_chrom", "st2": "other_st", "en2": "other_en"}
    return sinks.interaction_track(g.pairs.select(*[F.col(a).alias(b) for a, b in names.items()], F.col("pair_id").alias("score")))


@query("k08_sites_as_variants", "SELECT chrom, pos, CASE WHEN svtype <> 'BND' THEN concat('<', svtype, '>') WHEN pos % 2 = 0 THEN concat('N]chr9:', pos + 7, ']') ELSE concat('N[chr9:', pos + 7, '[') END AS alt, 'PASS' AS filter FROM fx_variants")
def _(g):
    rows = g.variants.withColumn("mate_chrom", F.lit("chr9")).withColumn("mate_pos", F.col("pos") + 7).withColumn("forward", F.col("pos") % 2 == 0)
    return sinks.sites_as_variants(rows).select("chrom", "pos", "alt", "filter")


# Sources and sinks by files: written to a fresh folder, then read from it.


@query("s04_target_csv", "SELECT DISTINCT chrom, pos AS start0, is_target AS on_target FROM fx_sites")
def _(g):
    path = fresh_folder(g.spark, "targets")
    rows = g.sites.select(F.col("chrom").alias("Chromosome"), (F.col("pos") + 1).alias("Start"), F.col("is_target").alias("On_target")).distinct()
    rows.write.option("header", True).csv(path)
    return text.read_target_csv(g.spark, path)


@query(
    "s10_caller_metrics",
    "SELECT event_id, 'QC ' || sample AS category, CASE WHEN event_id % 3 = 0 THEN sample END AS readgroup, metric, CAST(event_id % 1000 AS VARCHAR) AS value, CASE WHEN event_id % 2 = 0 THEN event_id % 100 / 4.0 END AS percent FROM fx_metrics",
)
def _(g):
    path, k = fresh_folder(g.spark, "metrics"), F.col("event_id")
    rows = g.metrics.select(
        F.concat(F.lit("QC "), "sample").alias("category"), F.when(k % 3 == 0, F.col("sample")).alias("readgroup"), F.concat_ws("#", "metric", k.cast("string")).alias("metric"),
        (k % 1000).cast("string").alias("value"), F.when(k % 2 == 0, k % 100 / 4.0).alias("percent"),
    )
    rows.write.csv(path)
    m = F.split("metric", "#")
    return text.read_caller_metrics(g.spark, path).select(m[1].cast("long").alias("event_id"), "category", "readgroup", m[0].alias("metric"), "value", "percent")


@query("s11_coverage_report", "SELECT chrom, CAST(st AS VARCHAR) AS start, CAST(en AS VARCHAR) AS end_, symbol AS gene, CAST(st % 50 AS DOUBLE) AS mean_cvg, CAST(CASE WHEN st % 3 = 0 THEN 0 ELSE st % 7 END AS DOUBLE) AS min_cvg FROM fx_genes")
def _(g):
    path = fresh_folder(g.spark, "coverage")
    rows = g.genes.select(F.col("chrom").alias("#chrom"), F.col("st").alias("start"), F.col("en").alias("end_"), F.col("symbol").alias("gene"), (F.col("st") % 50).alias("mean_cvg"), F.when(F.col("st") % 3 > 0, F.col("st") % 7).alias("min_cvg"))
    rows.write.option("header", True).option("sep", "\t").csv(path)
    return text.read_coverage_report(g.spark, path)


@query("s13_nested_catalog", "SELECT 'image' || n_nationkey AS image, '4.' || n_regionkey AS version, unnest(['latest', 'v' || n_nationkey]) AS tag FROM nation WHERE n_nationkey % 5 > 0 UNION ALL SELECT 'image' || n_nationkey, '4.' || n_regionkey, NULL FROM nation WHERE n_nationkey % 5 = 0")
def _(g):
    path, n = fresh_folder(g.spark, "catalog"), F.col("n_nationkey").cast("string")
    tags = F.when(F.col("n_nationkey") % 5 > 0, F.array(F.lit("latest"), F.concat(F.lit("v"), n)))
    image = F.struct(F.concat(F.lit("image"), n).alias("IMAGE"), F.create_map(F.lit("R_VERSION"), F.concat(F.lit("4."), F.col("n_regionkey").cast("string"))).alias("ENV"), tags.alias("tags"))
    files = g.table("nation").groupBy("n_regionkey").agg(F.to_json(F.struct(F.collect_list(image).alias("stack"))).alias("value"))
    files.repartition(1).write.partitionBy("n_regionkey").text(path)
    return text.read_nested_catalog(g.spark, f"{path}/*").select("image", "version", "tag")


@query("s16_sample_sheet", "SELECT 's' || c_custkey AS id, c_mktsegment AS sex, CASE WHEN c_custkey % 4 = 0 THEN 'late' END AS exception FROM customer")
def _(g):
    path, k = fresh_folder(g.spark, "sheet"), F.col("c_custkey")
    name = F.concat(F.lit("s"), k.cast("string"))
    rows = g.table("customer").select(F.when(k % 2 == 0, name).alias("ID "), F.when(k % 2 > 0, name).alias("Content_Desc"), F.col("c_mktsegment").alias("Sex"), F.when(k % 4 == 0, "late").alias("Exceptions"))
    rows.write.option("header", True).csv(path)
    return text.read_sample_sheet(g.spark, path)


@query("k01_write_table", "SELECT symbol || chr(9) || CASE WHEN st % 2 = 0 THEN 'NA' ELSE chrom END || chr(9) || st AS line, count(*) AS n FROM fx_genes GROUP BY 1 UNION ALL SELECT 'symbol' || chr(9) || 'chrom' || chr(9) || 'st', 1")
def _(g):
    path = fresh_folder(g.spark, "table")
    rows = g.genes.withColumn("chrom", F.when(F.col("st") % 2 > 0, F.col("chrom")))
    sinks.write_table(rows.coalesce(1), path, ["symbol", "chrom", "st"])
    return g.spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query("k04_training_chunks", "SELECT sample AS sample_id, count(*) AS n, CAST(sum(CASE WHEN mapq % 7 = 0 THEN 0 ELSE mapq END) AS BIGINT) AS mapq FROM fx_reads GROUP BY 1")
def _(g):
    path = fresh_folder(g.spark, "chunks")
    rows = g.reads.select(F.col("sample").alias("sample_id"), "ref_start", F.when(F.col("mapq") % 7 > 0, F.col("mapq")).alias("mapq"))
    sinks.write_training_chunks(rows, path, ["sample_id", "ref_start", "mapq"])
    return g.spark.read.parquet(path).groupBy("sample_id").agg(F.count("mapq").alias("n"), F.sum("mapq").alias("mapq"))


@query(
    "k09_case_tables",
    """SELECT 'qc' AS part, sample AS name, CAST(count(*) AS VARCHAR) AS value FROM fx_metrics GROUP BY 2 UNION ALL SELECT 'variants', id, CASE WHEN filter = 'PASS' THEN 'PASS' ELSE 'NA' END FROM fx_variants WHERE svtype = 'INS'
    UNION ALL SELECT 'svs', id, svtype FROM fx_variants WHERE svtype <> 'INS' UNION ALL SELECT 'summary', sample, CAST(count(*) AS VARCHAR) FROM fx_variants GROUP BY 2""",
)
def _(g):
    path, v = fresh_folder(g.spark, "case"), g.variants
    counts = lambda df: df.groupBy(F.col("sample").alias("name")).agg(F.count(F.lit(1)).alias("value"))
    ins = v.where("svtype = 'INS'").select(F.col("id").alias("name"), F.when(F.col("filter") == "PASS", "PASS").alias("value"))
    tables = {"variants": ins, "svs": v.where("svtype <> 'INS'").select(F.col("id").alias("name"), F.col("svtype").alias("value")), "qc": counts(g.metrics), "summary": counts(v)}
    sinks.write_case_tables(path, **tables)
    out = [g.spark.read.option("header", True).csv(f"{path}/{t}").select(F.lit(t).alias("part"), "name", "value") for t in tables]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("k10_sample_lists", "SELECT 'demux' AS list, 's' || c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS lane FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'align', 's' || c_custkey, NULL FROM customer WHERE c_custkey % 3 = 0")
def _(g):
    path, k = fresh_folder(g.spark, "lists"), F.col("c_custkey")
    sheet = g.table("customer").select(F.concat(F.lit("s"), k.cast("string")).alias("id"), F.when(k % 2 == 0, F.col("c_nationkey")).alias("lane"), F.when(k % 3 == 0, "x").alias("cram"), F.lit(None).cast("string").alias("empty"))
    sinks.write_sample_lists(sheet, path, {"demux": ["id", "lane"], "align": ["id", "cram"]})
    demux, align = (g.spark.read.option("header", True).csv(f"{path}/{t}") for t in ("demux", "align"))
    assert "empty" not in demux.columns and "empty" not in align.columns
    return demux.select(F.lit("demux").alias("list"), "id", "lane").unionByName(align.select(F.lit("align").alias("list"), "id", F.lit(None).cast("string").alias("lane")))
