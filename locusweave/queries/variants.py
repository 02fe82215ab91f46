"""Queries of variant tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusweave.functions import variants as fn
from locusweave.operators import ranks
from locusweave.operators import variants as vr
from locusweave.queries import query

_ANN = """raw AS (SELECT v.*, unnest(string_split(csq, ',')) AS x, generate_subscripts(string_split(csq, ','), 1) - 1 AS ann FROM fx_variants v),
    anns AS (SELECT *, nullif(split_part(x, '|', 1), '') AS allele, nullif(split_part(x, '|', 2), '') AS symbol, nullif(split_part(x, '|', 3), '') AS trx, nullif(split_part(x, '|', 4), '') AS consequence, coalesce(TRY_CAST(split_part(x, '|', 5) AS INT), 0) AS pick FROM raw)"""
_PCT = "CASE WHEN ref_reads + alt_reads > 0 THEN round(100.0 * alt_reads / (ref_reads + alt_reads), 1) ELSE 0.0 END"


@query(
    "t01_explode_annotations",
    f"""WITH {_ANN}, r AS (SELECT *, pos % 3 = 0 AS bare FROM anns)
    SELECT id, ann, allele, CASE WHEN bare THEN 'ENSG' || (pos % 7) ELSE symbol END AS symbol, trx, consequence, pick, CASE WHEN bare THEN -1 ELSE 0 END AS strand, CASE WHEN pos % 2 = 0 THEN pos ELSE 0 END AS distance, pos AS ann_st, CASE WHEN bare THEN pos + 9 END AS ann_en FROM r""",
)
def _(g):
    pos, bare = F.col("pos"), F.col("pos") % 3 == 0
    more = F.concat(F.lit("|"), F.concat(F.lit("ENSG"), (pos % 7).cast("string")), F.lit("|"), F.when(bare, "-1").otherwise(""), F.lit("|"), F.when(pos % 2 == 0, pos.cast("string")).otherwise(""), F.lit("|"), pos.cast("string"), F.lit("|"), F.when(bare, (pos + 9).cast("string")).otherwise("x"))
    full = lambda x: F.concat(F.regexp_replace(F.when(bare, F.regexp_replace(x, r"^A\|[^|]*", "..A.|")).otherwise(x), r"\|$", "|0"), more)
    rows = g.variants.withColumn("csq", F.array_join(F.transform(F.split("csq", ","), full), ","))
    fields = ("allele", "symbol", "trx", "consequence", "pick", "gene", "strand", "distance", "ann_st", "ann_en")
    return vr.explode_annotations(rows, fields).select("id", "ann", "allele", "symbol", "trx", "consequence", "pick", "strand", "distance", "ann_st", "ann_en")


@query("t02_annotation_values", f"WITH {_ANN} SELECT v.id, coalesce(string_agg(symbol, ',' ORDER BY ann), '') AS symbols FROM fx_variants v LEFT JOIN (SELECT id, symbol, min(ann) AS ann FROM anns WHERE NOT (id IN (SELECT id FROM fx_variants WHERE pos % 4 = 0)) GROUP BY 1, 2) a USING (id) GROUP BY 1")
def _(g):
    allele = F.when(F.col("pos") % 4 == 0, "T").otherwise("A")
    return g.variants.select("id", F.array_join(vr.annotation_values(F.col("csq"), 1, allele), ",").alias("symbols"))


@query("t08_abundance_pct", f"SELECT id, {_PCT} AS pct FROM fx_variants")
def _(g):
    return g.variants.select("id", fn.abundance_pct(F.col("ref_reads"), F.col("alt_reads")).alias("pct"))


@query(
    "t09_cell_fraction",
    """WITH x AS (SELECT seg_id, cn, sm, CASE WHEN maf > 0 THEN round(maf * 200, 2) END AS m, alt = '<LOH>' AS loh, CASE WHEN chrom = 'chr5' AND cn <> 1 THEN 1 WHEN cn <> 2 THEN 2 END AS nl FROM fx_segments),
    s AS (SELECT *, CASE WHEN NOT loh THEN round(nl * (sm - 1) / (cn - nl) * 100, 2) END AS s FROM x), k AS (SELECT seg_id, CASE WHEN m >= 0 THEN m END AS m, CASE WHEN s >= 0 THEN s END AS s FROM s),
    v AS (SELECT seg_id, CASE WHEN abs(s - m) > 0.25 THEN s ELSE least(s, m) END AS v FROM k) SELECT seg_id, CASE WHEN v > 100 THEN 99.0 ELSE v END AS fraction FROM v""",
)
def _(g):
    single = F.col("chrom") == "chr5"  # stands for X of a male
    return g.segments.select("seg_id", fn.cell_fraction(F.col("cn"), F.col("sm").cast("double"), F.col("maf").cast("double"), single, F.col("alt") == "<LOH>").alias("fraction"))


@query("t10_one_letter_protein", "SELECT id, concat('p.', CASE pos % 3 WHEN 0 THEN 'V' WHEN 1 THEN 'G' ELSE 'K' END, pos, CASE WHEN pos % 2 = 0 THEN '=' ELSE '*' END) AS protein FROM fx_variants")
def _(g):
    three = F.when(F.col("pos") % 3 == 0, "Val").when(F.col("pos") % 3 == 1, "Gly").otherwise("Lys")
    return g.variants.select("id", fn.one_letter_protein(F.concat(F.lit("p."), three, F.col("pos"), F.when(F.col("pos") % 2 == 0, "%3D").otherwise("Ter"))).alias("protein"))


@query("t12_reverse_complement", "SELECT o_orderkey, reverse(translate(upper(o_orderpriority), 'ACGTUN', 'TGCAAN')) AS rc FROM orders")
def _(g):
    return g.table("orders").select("o_orderkey", fn.reverse_complement(F.upper("o_orderpriority")).alias("rc"))


@query(
    "t13_parse_region",
    """WITH x AS (SELECT id, concat(chrom, ':', pos, CASE WHEN alt_reads = 3 THEN '' ELSE concat('-', pos + ref_reads - 5) END) AS r FROM fx_variants),
    y AS (SELECT id, nullif(regexp_extract(r, '^(.+):(\\d+)-(\\d+)$', 1), '') AS chrom, TRY_CAST(nullif(regexp_extract(r, '^(.+):(\\d+)-(\\d+)$', 2), '') AS BIGINT) AS st, TRY_CAST(nullif(regexp_extract(r, '^(.+):(\\d+)-(\\d+)$', 3), '') AS BIGINT) AS en FROM x)
    SELECT *, CASE WHEN st IS NULL OR en IS NULL THEN 'bad format' WHEN st > en THEN 'start after end' END AS problem FROM y""",
)
def _(g):
    end = F.when(F.col("alt_reads") == 3, "").otherwise(F.concat(F.lit("-"), F.col("pos") + F.col("ref_reads") - 5))
    region = F.concat("chrom", F.lit(":"), F.format_number("pos", 0), end)
    return g.variants.select("id", fn.parse_region(region).alias("x")).select("id", "x.*")


@query("t18_breakend_round_trip", "SELECT id, concat('N[', chrom, ':', pos, '[') AS alt, chrom, pos FROM fx_variants")
def _(g):
    alt = fn.format_breakend(F.col("chrom"), F.col("pos"), F.lit("["), F.lit(False), F.lit("N"))
    return g.variants.select("id", alt.alias("alt")).withColumn("x", fn.parse_breakend(F.col("alt"))).select("id", "alt", "x.chrom", "x.pos")


@query("t22_parse_target_info", "SELECT id, least(ref_reads, alt_reads) AS min_mismatches, 2 AS tools, 'NGG' AS pam FROM fx_variants")
def _(g):
    info = F.concat(F.lit("MISMATCHES="), "ref_reads", F.lit(","), "alt_reads", F.lit(";SRC=a,b;PAM=NGG"))
    return g.variants.select("id", fn.parse_target_info(info).alias("x")).select("id", "x.*")


@query(
    "t23_merge_info_maps",
    """WITH k AS (SELECT sample, string_agg(CAST(alt_reads AS VARCHAR), ',' ORDER BY CAST(alt_reads AS VARCHAR)) AS a, string_agg(svtype, ',' ORDER BY svtype) AS t FROM fx_variants GROUP BY 1)
    SELECT sample, concat('AD=', a, ';PRECISE;SVTYPE=', t) AS info FROM k""",
)
def _(g):
    rows = g.variants.select("sample", F.concat(F.lit("SVTYPE="), "svtype", F.lit(";PRECISE;AD="), "alt_reads").alias("info"))
    return vr.merge_info_maps(rows, "sample", "info")


@query("t27_truncate_alleles", "SELECT p_partkey, CASE WHEN length(p_name) > 20 THEN 'DEL' || length(p_name) ELSE p_name END AS allele FROM part")
def _(g):
    return g.table("part").select("p_partkey", fn.truncate_allele(F.col("p_name"), "DEL").alias("allele"))


@query("t30_range_flag", "SELECT id, concat(ref_reads, CASE WHEN ref_reads < 5 OR ref_reads > 30 THEN ' (!)' ELSE '' END) AS flagged FROM fx_variants")
def _(g):
    return g.variants.select("id", fn.range_flag(F.col("ref_reads"), F.lit(5), F.lit(30)).alias("flagged"))


@query("t04_effect_label", "SELECT symbol, CASE WHEN st % 3 = 0 THEN concat('exon', st % 7) WHEN st % 3 = 1 THEN concat('intron', st % 5) WHEN st % 4 > 0 THEN concat(st % 4, CASE WHEN strand > 0 THEN 'bp upstream' ELSE 'bp downstream' END) ELSE 'intragenic' END AS label FROM fx_genes")
def _(g):
    s = F.col("st")
    exon = F.when(s % 3 == 0, F.concat((s % 7).cast("string"), F.lit("/9"))).otherwise("")
    intron = F.when(s % 3 == 1, F.concat((s % 5).cast("string"), F.lit("/8"))).otherwise("")
    return g.genes.select("symbol", fn.effect_label(exon, intron, s % 4, F.col("strand") > 0).alias("label"))


@query(
    "t03_known_gene_effects",
    """SELECT v.id, g.symbol, CASE WHEN v.pos <= g.en AND g.st <= v.pos + v.svlen THEN 0 ELSE least(abs(v.pos - g.st), abs(v.pos - g.en), abs(v.pos + v.svlen - g.st), abs(v.pos + v.svlen - g.en)) END AS distance,
    CASE WHEN v.pos <= g.st AND v.pos + v.svlen >= g.en AND svtype = 'DEL' THEN 'transcript_ablation' WHEN v.pos <= g.st AND v.pos + v.svlen >= g.en AND svtype = 'DUP' THEN 'transcript_amplification'
      WHEN v.pos <= g.en AND g.st <= v.pos + v.svlen AND svtype = 'DEL' THEN 'feature_truncation' WHEN v.pos <= g.en AND g.st <= v.pos + v.svlen THEN 'feature_elongation'
      WHEN (v.pos + v.svlen < g.st) = (g.strand > 0) THEN 'upstream_gene_variant' ELSE 'downstream_gene_variant' END AS consequence
    FROM fx_variants v JOIN fx_genes g ON g.symbol = split_part(v.csq, '|', 2) AND g.chrom = v.chrom""",
)
def _(g):
    v = g.variants.withColumn("symbol", F.get(F.split("csq", r"[|]"), F.lit(1)))
    both = v.join(g.genes.select("symbol", "chrom", "st", "en", "strand"), ["symbol", "chrom"])
    effect = fn.known_gene_effect(F.col("pos"), F.col("pos") + F.col("svlen"), F.col("st"), F.col("en"), F.col("strand"), F.col("svtype"))
    return both.select("id", "symbol", effect.alias("x")).select("id", "symbol", "x.*")


#: Cytobands of the views' chromosomes, the same SQL in both engines.
_BANDS = """SELECT concat('chr', 1 + n_nationkey % 5) AS chrom, CAST(floor(n_nationkey / 5) * 14000 AS BIGINT) AS st, CAST(floor(n_nationkey / 5) * 14000 + 14000 AS BIGINT) AS en,
  CASE CAST(floor(n_nationkey / 5) AS INT) WHEN 0 THEN 'pter' WHEN 1 THEN 'p12' WHEN 2 THEN 'acen_q11' WHEN 3 THEN 'q21' ELSE 'qter' END AS name FROM {nation}"""


def _bands(g):
    return g.spark.sql(_BANDS, nation=g.table("nation"))


@query(
    "t06_event_syntax",
    f"""WITH cb AS ({_BANDS.replace("{nation}", "nation")}), e AS (SELECT id, chrom, svtype, CAST(pos * 3 AS BIGINT) AS st, CAST(pos * 3 + svlen + 1 AS BIGINT) AS en FROM fx_variants WHERE svtype <> 'BND'),
    b AS (SELECT e.*, string_agg(replace(name, 'acen_', ''), ',' ORDER BY cb.st) AS bands FROM e LEFT JOIN cb ON e.chrom = cb.chrom AND e.st < cb.en AND cb.st < e.en GROUP BY ALL),
    x AS (SELECT *, split_part(bands, ',', 1) AS f, split_part(bands, ',', -1) AS l, replace(chrom, 'chr', '') AS num, bands LIKE '%,%' AS many FROM b)
    SELECT id, concat(chrom, ':g.', st, '_', en, lower(svtype)) AS csyntax, CASE WHEN many THEN concat(f, l) ELSE coalesce(f, 'None') END AS bandstring,
      CASE WHEN bands IS NULL THEN '' WHEN f LIKE '%p%' AND l LIKE '%q%' THEN concat('seq[GRCh38] ', CASE svtype WHEN 'DEL' THEN '-' ELSE '+' END, num) ELSE concat('seq[GRCh38] ', lower(svtype), '(', num, ')(', f, l, ')') END AS psyntax FROM x""",
)
def _(g):
    start = (F.col("pos") * 3).cast("long")
    events = g.variants.where("svtype <> 'BND'").select("id", "chrom", "svtype", start.alias("st"), (start + F.col("svlen") + 1).alias("en"))
    x = fn.event_syntax(F.col("chrom"), F.col("st"), F.col("en"), F.col("svtype"), F.col("bands"))
    return vr.with_bands(events, _bands(g)).select("id", x.alias("x")).select("id", "x.*")


_MATE = "m AS (SELECT a.*, b.chrom AS mate_chrom, b.pos AS mate_pos FROM fx_variants a JOIN fx_variants b ON a.mate_id = b.id AND a.id < b.id)"


_ALT = "CASE {0} % 4 WHEN 0 THEN 'N[c:1[' WHEN 1 THEN 'N]c:1]' WHEN 2 THEN '[c:1[N' ELSE ']c:1]N' END"


@query(
    "t07_breakend_syntax",
    f"""WITH {_MATE}, c AS (SELECT id, CASE WHEN chrom = mate_chrom THEN 'INV' ELSE 'BND' END AS kind, chrom AS ca, pos AS pa, {_ALT.format("pos")} AS aa, CASE WHEN pos < 3000 THEN 'p12' ELSE 'q21' END AS ba,
        mate_chrom AS cb, mate_pos AS pb, {_ALT.format("mate_pos")} AS ab, CASE WHEN mate_pos < 3000 THEN 'p12' ELSE 'q21' END AS bb FROM m),
    t AS (SELECT id, kind, CASE WHEN w THEN cb ELSE ca END AS c1, CASE WHEN w THEN pb ELSE pa END AS p1, CASE WHEN w THEN bb ELSE ba END AS b1, CASE WHEN w THEN ab ELSE aa END AS a1,
        CASE WHEN w THEN ca ELSE cb END AS c2, CASE WHEN w THEN pa ELSE pb END AS p2, CASE WHEN w THEN ba ELSE bb END AS b2 FROM (SELECT *, aa LIKE '[%' OR aa LIKE ']%' AS w FROM c)),
    s AS (SELECT *, CASE WHEN a1 LIKE '[%' OR strpos(a1, ']') > 1 THEN '-' ELSE '+' END AS sign, CASE kind WHEN 'INV' THEN p1 <= p2 ELSE CAST(replace(c1, 'chr', '') AS INT) < CAST(replace(c2, 'chr', '') AS INT) END AS k FROM t),
    o AS (SELECT id, kind, sign, CASE WHEN k THEN c1 ELSE c2 END AS x, CASE WHEN k THEN p1 ELSE p2 END AS px, CASE WHEN k THEN b1 ELSE b2 END AS bx, CASE WHEN k THEN c2 ELSE c1 END AS y, CASE WHEN k THEN p2 ELSE p1 END AS py, CASE WHEN k THEN b2 ELSE b1 END AS by_ FROM s),
    z AS (SELECT *, CASE WHEN kind = 'BND' THEN concat(bx, ';', by_) WHEN bx LIKE 'p%' AND by_ LIKE 'p%' THEN concat(by_, bx) ELSE concat(bx, by_) END AS bandstring FROM o)
    SELECT id, concat(x, ':g.', px, '(+)::', y, ':g.', py, '(', sign, ')') AS csyntax, bandstring,
      concat('seq[GRCh38] ', CASE kind WHEN 'INV' THEN concat('inv(', replace(x, 'chr', '')) ELSE concat('t(', replace(x, 'chr', ''), ';', replace(y, 'chr', '')) END, ')(', bandstring, ')') AS psyntax FROM z""",
)
def _(g):
    band = lambda c: F.when(F.col(c) < 3000, "p12").otherwise("q21")
    end = lambda chrom, pos: F.struct(F.col(chrom).alias("chrom"), F.col(pos).cast("long").alias("pos"), band(pos).alias("band"), F.expr(_ALT.format(pos)).alias("alt"))
    x = fn.breakend_syntax(end("chrom", "pos"), end("mate_chrom", "mate_pos"), F.when(F.col("chrom") == F.col("mate_chrom"), "INV").otherwise("BND"))
    return vr.mate_join(g.variants).select("id", x.alias("x")).select("id", "x.*")


@query("j06_mate_join", f"WITH {_MATE} SELECT id, mate_id, mate_chrom, mate_pos FROM m")
def _(g):
    return vr.mate_join(g.variants).select("id", "mate_id", "mate_chrom", "mate_pos")




@query(
    "d01_soft_filters",
    """WITH x AS (SELECT id, filter, ref_reads AS pr_ref, alt_reads AS pr_alt, pos % 4 AS sr_ref, pos % 5 AS sr_alt, pos % 7 = 0 AS imprecise, CASE WHEN svtype = 'INS' THEN 'x' END AS hits FROM fx_variants)
    SELECT id, coalesce(nullif(concat_ws(';', nullif(filter, 'PASS'), CASE WHEN imprecise THEN 'Imprecise' END, CASE WHEN pr_alt < 2 OR sr_alt < 2 THEN 'MinSvReads' END, CASE WHEN hits IS NOT NULL THEN 'SvInsertion' END,
      CASE WHEN pr_ref + sr_ref > 0 AND 100.0 * (pr_alt + sr_alt) / (pr_ref + sr_ref + pr_alt + sr_alt) < 5 THEN 'MinSvAbundance' END), ''), 'PASS') AS filter FROM x""",
)
def _(g):
    pos = F.col("pos")
    rows = g.variants.select(
        "id", "filter", F.col("ref_reads").alias("pr_ref"), F.col("alt_reads").alias("pr_alt"), (pos % 4).alias("sr_ref"), (pos % 5).alias("sr_alt"), (pos % 7 == 0).alias("imprecise"), F.when(F.col("svtype") == "INS", "x").alias("insertion_hits")
    )
    return vr.soft_filters(rows).select("id", "filter")


_HARD_ROWS = """hard AS (SELECT id, mate_id, svtype, filter, svlen, alt_reads AS pr_alt, pos % 5 AS sr_alt, pos % 9 = 0 AS both_arms, pos % 6 > 0 AS gene, pos % 10 = 0 AS known, pos % 4 > 0 AS effect, pos % 3 > 0 AS contig FROM fx_variants),
    kept AS (SELECT * FROM hard WHERE (pr_alt > 0 OR sr_alt > 0) AND NOT (svtype IN ('DEL', 'DUP') AND (pr_alt = 0 OR sr_alt = 0 OR both_arms))
      AND NOT (svtype = 'BND' AND NOT known AND (NOT contig OR (filter <> 'PASS' AND NOT gene))) AND NOT (svtype <> 'BND' AND (svlen < 1000 OR svlen > 20000000 OR NOT gene OR NOT effect)))"""


def _hard_rows(g):
    pos = F.col("pos")
    return g.variants.select(
        "id", "mate_id", "svtype", "filter", "svlen", F.col("alt_reads").alias("pr_alt"), (pos % 5).alias("sr_alt"), F.when(pos % 9 == 0, F.array(F.lit("p11"), F.lit("q12"))).otherwise(F.array(F.lit("q12"))).alias("bands"),
        F.when(pos % 6 > 0, F.array(F.lit("GENE1"))).alias("genes"), F.when(pos % 10 == 0, F.array(F.lit("GENE1"))).alias("known_genes"), F.when(pos % 4 > 0, F.array(F.lit("frameshift_variant"))).alias("effects"), F.when(pos % 3 > 0, "ACGT").alias("contig"),
    )


@query("d02_hard_filters", f"WITH {_HARD_ROWS} SELECT id FROM kept")
def _(g):
    return vr.hard_filters(_hard_rows(g)).select("id")


@query("d03_keep_with_mate", f"WITH {_HARD_ROWS} SELECT id FROM fx_variants WHERE id IN (SELECT id FROM kept) OR id IN (SELECT mate_id FROM kept)")
def _(g):
    return vr.keep_with_mate(g.variants, vr.hard_filters(_hard_rows(g))).select("id")


@query(
    "d04_small_variant_filter",
    f"""WITH x AS (SELECT id, ref_reads, alt_reads, CASE WHEN pos % 11 = 0 THEN 'PASS' ELSE filter END AS filter, pos % 6 = 0 AS known, {_PCT} AS vaf FROM fx_variants)
    SELECT id, vaf, coalesce(nullif(concat_ws(';', nullif(filter, 'PASS'), CASE WHEN alt_reads < 3 THEN 'LowReads' END, CASE WHEN vaf < 2 THEN 'MinVAF' END), ''), 'PASS') AS filter
    FROM x WHERE known OR (alt_reads >= 3 AND vaf >= 1 AND (filter = 'PASS' OR vaf >= 2))""",
)
def _(g):
    pos = F.col("pos")
    rows = g.variants.withColumn("filter", F.when(pos % 11 == 0, "multiallelic").otherwise(F.col("filter"))).withColumn("tags", F.when(pos % 6 == 0, F.array(F.lit("OLD"), F.lit("PRIOR"))))
    return vr.small_variant_filter(rows, allowed=("PRIOR", "FORCED")).select("id", "vaf", "filter")


@query("d05_size_gate", "SELECT id, round(alt_reads / CAST(ref_reads + alt_reads AS DOUBLE), 4) AS af FROM fx_variants WHERE svtype <> 'BND' AND svlen <= 1000 AND alt_reads > 0")
def _(g):
    return vr.size_gate(g.variants).select("id", "af")


@query(
    "d06_reportable_variants",
    f"""WITH {_ANN}, t AS (SELECT *, CASE WHEN symbol IN (SELECT symbol FROM fx_genes WHERE st % 3 = 0) AND contains(consequence, 'splice_region_variant') THEN 'splice_region_variant'
      WHEN contains(consequence, 'missense_variant') THEN 'missense_variant' WHEN consequence = 'intron_variant' THEN 'intron_variant' END AS told FROM anns WHERE trx IN (SELECT trx FROM fx_genes WHERE strand = 1) AND NOT (pick = 1 AND pos % 4 = 0)),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ann DESC) AS k FROM t WHERE told IS NOT NULL) SELECT id, symbol, trx, told AS consequence FROM r WHERE k = 1""",
)
def _(g):
    noncoding = g.genes.where("st % 3 = 0").select("symbol", F.array(F.lit("splice_region_variant")).alias("effects"))
    marked = F.when(F.col("pos") % 4 == 0, F.regexp_replace("csq", r"\|1,", "|1|known artifact,")).otherwise(F.col("csq"))
    fields = (*vr.FIELDS, "blacklist")
    return vr.reportable_variants(g.variants.withColumn("csq", marked), g.genes.where("strand = 1").select("trx"), ["missense_variant", "intron_variant"], noncoding, fields)


@query("d11_somatic_indel_gate", f"SELECT id FROM fx_variants WHERE (filter = 'PASS' OR list_contains(string_split(filter, ';'), 'weak_evidence')) AND svtype IN ('DEL', 'INS', 'DUP') AND {_PCT} >= 5")
def _(g):
    return vr.somatic_indel_gate(g.variants, weak=True).select("id")


@query("w01_keep_best", f"WITH {_ANN}, k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY pick DESC, alt_reads DESC, id, ann) AS k FROM anns) SELECT symbol, id, ann FROM k WHERE k = 1")
def _(g):
    rows = vr.explode_annotations(g.variants)
    return vr.keep_best(rows, ["symbol"], F.desc("pick"), F.desc("alt_reads"), F.col("id"), F.col("ann")).select("symbol", "id", "ann")


_SIDES = f"""{_ANN}, l AS (SELECT a.id, g.symbol, g.strand FROM anns a JOIN fx_genes g USING (symbol) WHERE ann = 0), r AS (SELECT a.id, g.symbol, g.strand FROM anns a JOIN fx_genes g USING (symbol) WHERE ann = 1),
    pairs AS (SELECT coalesce(l.id, r.id) AS id, coalesce(l.symbol, 'INTERGENIC') AS gene_a, coalesce(r.symbol, 'INTERGENIC') AS gene_b, l.strand * r.strand AS orientation FROM l FULL JOIN r ON l.id = r.id)"""


def _pairs(g):
    rows = vr.explode_annotations(g.variants).join(g.genes.select("symbol", "strand"), "symbol")
    return vr.candidate_gene_pairs(rows.where("ann = 0"), rows.where("ann = 1"))


@query("j07_candidate_gene_pairs", f"WITH {_SIDES} SELECT * FROM pairs")
def _(g):
    return _pairs(g)


@query(
    "j08_recurrent_lookup",
    f"""WITH {_SIDES}, listed AS (SELECT symbol AS gene1, CASE WHEN st % 3 = 0 THEN '*' ELSE concat('GENE', st % 7) END AS gene2, CAST(st % 2 AS INT) AS require_strand, CASE WHEN st % 4 = 0 THEN '*' WHEN st % 4 = 1 THEN 'DEL' END AS type FROM fx_genes WHERE strand = 1),
    rules AS (SELECT gene1, gene2, require_strand, coalesce(type, 'BND') AS type, true AS direct FROM listed UNION ALL SELECT gene2, gene1, require_strand, coalesce(type, 'BND'), false FROM listed),
    hit AS (SELECT p.id, p.gene_a, p.gene_b, min(CASE WHEN r.gene2 = '*' THEN 1 ELSE 0 END) AS w FROM pairs p JOIN fx_variants v USING (id) JOIN rules r ON r.gene1 <> '*' AND (r.require_strand = 0 OR p.orientation = 1)
      AND ((r.gene1 = p.gene_a AND r.gene2 IN (p.gene_b, '*') AND r.type IN (v.svtype, '*')) OR (r.gene1 = p.gene_b AND r.gene2 IN (p.gene_a, '*') AND r.type = v.svtype)) GROUP BY 1, 2, 3)
    SELECT p.id, p.gene_a, p.gene_b, CASE w WHEN 0 THEN 'exact' WHEN 1 THEN 'wildcard' END AS recurrent FROM pairs p LEFT JOIN hit h ON p.id = h.id AND p.gene_a = h.gene_a AND p.gene_b = h.gene_b""",
)
def _(g):
    s = F.col("st")
    listed = g.genes.where("strand = 1").select(
        F.col("symbol").alias("gene1"), F.when(s % 3 == 0, "*").otherwise(F.concat(F.lit("GENE"), (s % 7).cast("string"))).alias("gene2"),
        (s % 2).cast("int").alias("require_strand"), F.when(s % 4 == 0, "*").when(s % 4 == 1, "DEL").alias("type"),
    )
    pairs = _pairs(g).join(g.variants.select("id", "svtype"), "id")
    return vr.recurrent_lookup(pairs, listed).select("id", "gene_a", "gene_b", "recurrent")


#: Masks between segments of the views, as cytobands would give them.
_MASKS = "SELECT chrom, st + 60000 AS st, st + 75000 AS en FROM fx_segments WHERE seg_id % 50 = 0"


@query(
    "a26_merge_segments",
    f"""WITH masks AS ({_MASKS}), kinds AS (SELECT DISTINCT alt FROM fx_segments), u AS (SELECT seg_id, chrom, st, en, alt, filter, cn, sm, maf FROM fx_segments
      UNION ALL SELECT NULL, chrom, st, en, alt, NULL, NULL, NULL, NULL FROM masks, kinds),
    f AS (SELECT *, CASE WHEN st - max(en) OVER (PARTITION BY chrom, alt ORDER BY st, en ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 5000 THEN 0 ELSE 1 END AS fresh FROM u),
    c AS (SELECT *, sum(fresh) OVER (PARTITION BY chrom, alt ORDER BY st, en RANGE UNBOUNDED PRECEDING) AS cluster FROM f),
    k AS (SELECT chrom, alt, cluster, count(*) AS k, max(en) - min(st) AS span, count(*) FILTER (filter = 'PASS') AS p FROM c GROUP BY 1, 2, 3 HAVING bool_or(coalesce(filter IN ('PASS', 'segmentMean'), false)) AND max(en) - min(st) >= 5000),
    o AS (SELECT c.chrom, c.alt, min(st) AS st, arg_max(en, (st, en)) AS en, 'PASS' AS filter, CAST(floor(avg(cn)) AS BIGINT) AS cn, avg(sm) AS sm, avg(maf) AS maf, count(*) AS n
        FROM c JOIN k USING (chrom, alt, cluster) WHERE k.k > 1 AND filter = 'PASS' GROUP BY c.chrom, c.alt, c.cluster
      UNION ALL SELECT c.chrom, c.alt, st, en, filter, cn, sm, maf, 1 FROM c JOIN k USING (chrom, alt, cluster) WHERE filter IS NOT NULL AND (k.k = 1 OR filter <> 'PASS'))
    SELECT chrom, alt, st, en, filter, cn, round(sm, 9) AS sm, round(maf, 9) AS maf, n, CASE WHEN alt = '<DEL>' THEN st - en - 1 ELSE en - st + 1 END AS svlen, CASE WHEN alt = '<DUP>' THEN st - en - 1 ELSE en - st + 1 END AS reflen FROM o""",
)
def _(g):
    masks = g.segments.where("seg_id % 50 = 0").select("chrom", (F.col("st") + 60_000).alias("st"), (F.col("st") + 75_000).alias("en"))
    out = vr.merge_segments(g.segments, 5000, 5000, masks)
    return out.withColumn("sm", F.round(F.col("sm").cast("double"), 9)).withColumn("maf", F.round(F.col("maf").cast("double"), 9))


@query("a27_event_gene_summary", f"WITH {_ANN} SELECT id, count(DISTINCT symbol) AS n_genes, CASE WHEN count(DISTINCT symbol) > 1 THEN concat(count(DISTINCT symbol), ' genes') ELSE string_agg(DISTINCT symbol, ',' ORDER BY symbol) END AS genes FROM anns GROUP BY 1")
def _(g):
    return vr.event_gene_summary(g.variants, 1)


#: Genes, regions and bands of the events of the views, by their numbers; the same text in both engines.
_EVENTS = {
    "gene_a": "CASE alt_reads % 5 WHEN 0 THEN 'INTERGENIC' WHEN 1 THEN 'ENSG7' ELSE 'GENE1' END", "gene_b": "CASE ref_reads % 4 WHEN 0 THEN 'INTERGENIC' ELSE concat('GENE', ref_reads % 3) END",
    "region_a": "CASE WHEN pos % 3 = 0 THEN 'intron4' ELSE 'exon2' END", "region_b": "CASE WHEN pos % 2 = 0 THEN 'intron4' ELSE 'exon2' END",
    "distance_a": "CAST(pos % 4 AS INT)", "distance_b": "CAST(pos % 5 AS INT)", "known": "pos % 7 < 4", "band_a": "CASE WHEN pos % 11 < 6 THEN 'pter' ELSE 'q21' END", "band_b": "CASE WHEN pos % 13 < 6 THEN 'qter' ELSE 'p1' END",
    "kind": "CASE WHEN svtype = 'BND' AND pos % 3 = 1 THEN 'INV' WHEN svtype = 'INS' AND pos % 3 = 1 THEN 'SEG' ELSE svtype END", "impact": "pos % 5 < 2", "cnloh": "CASE WHEN pos % 4 = 0 THEN pos % 8 = 0 END",
    "filters": "CASE WHEN filter LIKE 'weak%' AND pos % 2 = 0 THEN 'MaxDepth;MinSomaticScore' WHEN filter LIKE 'weak%' THEN 'MinCNVAbundance' ELSE filter END",
}


@query(
    "a28_event_category",
    f"""WITH e AS (SELECT id, alt_reads > 6 AS listed, {", ".join(f"{v} AS {k}" for k, v in _EVENTS.items())} FROM fx_variants),
    r AS (SELECT *, NOT ((kind = 'INV' AND ((gene_a = gene_b AND ((region_a = region_b AND region_a LIKE '%intron%') OR (distance_a > 0 AND distance_b > 0))) OR NOT known))
        OR ((gene_a = 'INTERGENIC' OR gene_a LIKE '%ENS%' OR gene_b = 'INTERGENIC' OR gene_b LIKE '%ENS%') AND NOT known) OR (band_a = 'pter' AND band_b = 'qter')) AS reportable,
      CASE WHEN listed AND kind IN ('DEL', 'DUP', 'INS') AND filters = 'MaxDepth;MinSomaticScore' THEN 'PASS' ELSE filters END AS filter FROM e)
    SELECT id, filter, reportable, CASE WHEN kind = 'SEG' THEN CASE WHEN filter = 'PASS' AND coalesce(cnloh, true) THEN 'CNV' WHEN filter = 'PASS' OR filter = 'MinCNVAbundance' OR gene_a <> 'INTERGENIC' THEN 'OTHERSV' END
      WHEN kind IN ('DEL', 'DUP', 'INS') THEN CASE WHEN listed THEN CASE WHEN filter = 'PASS' THEN 'CNV' ELSE 'OTHERSV' END WHEN filter = 'PASS' AND impact THEN 'OTHERSV' END
      WHEN listed THEN CASE WHEN filter = 'PASS' AND gene_a = 'GENE1' AND gene_b <> 'INTERGENIC' THEN 'RECURRENTSV' ELSE 'OTHERSV' END WHEN filter = 'PASS' AND reportable THEN 'OTHERSV' END AS category FROM r""",
)
def _(g):
    rows = g.variants.select("id", F.when(F.col("alt_reads") > 6, "exact").alias("recurrent"), *[F.expr(v).alias(k) for k, v in _EVENTS.items()])
    rows = rows.withColumnsRenamed({"kind": "svtype", "filters": "filter"}).withColumn("genes", F.when(F.col("gene_a") != "INTERGENIC", F.array("gene_a")))
    return vr.event_category(vr.reportable_events(rows)).select("id", "filter", "reportable", "category")


@query(
    "a30_gene_status",
    f"""WITH {_ANN}, e AS (SELECT symbol, unnest(string_split(consequence, '&')) AS effect FROM anns WHERE filter = 'PASS'), p AS (SELECT symbol, string_agg(DISTINCT effect, '; ' ORDER BY effect) AS status FROM e GROUP BY 1),
    g AS (SELECT concat('GENE', s_suppkey * 2) AS symbol FROM supplier) SELECT g.symbol, coalesce(status, 'no mutations identified') AS status FROM g LEFT JOIN p USING (symbol)""",
)
def _(g):
    genes = g.table("supplier").select(F.concat(F.lit("GENE"), (F.col("s_suppkey") * 2).cast("string")).alias("symbol"))
    return vr.gene_status(g.variants, genes)


@query("a19_truth_panel", "SELECT s.guide, v.chrom, v.pos, max(v.alt_reads) AS best, count(*) AS replicates, max(v.alt_reads) >= 6 AS is_edit FROM fx_variants v LEFT JOIN fx_sites s ON v.chrom = s.chrom AND v.pos = s.pos GROUP BY 1, 2, 3")
def _(g):
    rows = g.variants.join(g.sites.select("chrom", "pos", "guide"), ["chrom", "pos"], "left").withColumnRenamed("alt_reads", "value")
    return vr.truth_panel(rows, 6)


@query("a25_case_strings", f"WITH {_ANN}, p AS (SELECT *, {_PCT} AS pct FROM anns WHERE filter = 'PASS' AND pick = 1) SELECT sample, count(*) AS n, string_agg(concat(symbol, '[', printf('%.1f', pct), '%]'), ',' ORDER BY concat(symbol, '[', printf('%.1f', pct), '%]')) AS variants FROM p GROUP BY 1")
def _(g):
    return vr.case_strings(g.variants).select("sample", "n", "variants")


@query("w05_rank_candidates", "SELECT id, alt_reads, row_number() OVER (ORDER BY svtype, alt_reads DESC, id) AS rank FROM fx_variants")
def _(g):
    return vr.rank_candidates(g.variants, "svtype", "alt_reads", "id").select("id", "alt_reads", "rank")


@query("u02_symmetric_pairs", "SELECT symbol AS gene1, trx AS gene2, 'BND' AS type FROM fx_genes UNION ALL SELECT trx, symbol, 'BND' FROM fx_genes")
def _(g):
    listed = g.genes.select(F.col("symbol").alias("gene1"), F.col("trx").alias("gene2"), F.lit(0).alias("require_strand"), F.lit(None).cast("string").alias("type"))
    return vr.symmetric_pairs(listed).select("gene1", "gene2", "type")


@query("o01_natural_order", "SELECT symbol, row_number() OVER (ORDER BY CAST(replace(symbol, 'GENE', '') AS INT)) AS place FROM fx_genes")
def _(g):
    return ranks.numbered(g.genes.select("symbol"), [fn.natural_key(F.col("symbol"))])


_CONTIG = "CASE st % 7 WHEN 0 THEN 'chrX' WHEN 1 THEN 'Y' WHEN 2 THEN 'chrM' WHEN 3 THEN 'chrUn_gl' ELSE chrom END"


@query(
    "o03_chromosome_key",
    "SELECT symbol, CAST(CASE st % 7 WHEN 0 THEN '23' WHEN 1 THEN '24' WHEN 2 THEN '25' WHEN 3 THEN 'inf' ELSE replace(chrom, 'chr', '') END AS DOUBLE) AS key FROM fx_genes",
)
def _(g):
    return g.genes.select("symbol", fn.chromosome_key(F.expr(_CONTIG)).alias("key"))
