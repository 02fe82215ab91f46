"""Queries of reads at loci."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusweave.functions import cigar as cg
from locusweave.operators import reads as rd
from locusweave.queries import query


def _sum(op: str) -> str:
    return f"coalesce(list_sum([CAST(x AS BIGINT) FOR x IN regexp_extract_all(cigar, '(\\d+){op}', 1)]), 0)"


_LEN = f"({_sum('M')} + {_sum('D')})"
_LOCI = "(SELECT DISTINCT chrom, pos FROM fx_sites)"


_PRIMARY = "AND r.is_dup = 0"


def _met(pad: int, extra: str = "", length: int = 1) -> str:
    return f"""met AS (SELECT r.*, s.pos, {_sum('I')} AS ins, {_sum('D')} AS del, {_sum('S')} AS clip, {_sum('M')} AS mat FROM fx_reads r JOIN {_LOCI} s
      ON r.chrom = s.chrom AND r.ref_start < s.pos + {length} + {pad} AND s.pos - {pad} < r.ref_start + {_LEN} {extra})"""


#: Reads of the views have one indel at most, right after their first match.
_EVENT = "CASE WHEN ins + del > 0 AND abs(ref_start + CAST(regexp_extract(cigar, '^(\\d+)M', 1) AS BIGINT) - pos) <= 25 THEN ref_start + CAST(regexp_extract(cigar, '^(\\d+)M', 1) AS BIGINT) END"


@query("t14_parse_cigar", r"SELECT read_name, cigar, len(regexp_extract_all(cigar, '(\d+)([MIDS])')) AS ops, regexp_extract(cigar, '^(\d+)([MIDS])', 2) AS first_op FROM fx_reads")
def _(g):
    return g.reads.select("read_name", "cigar", F.size(cg.parse_cigar(F.col("cigar"))).cast("long").alias("ops"), F.get(cg.parse_cigar(F.col("cigar")), F.lit(0))["op"].alias("first_op"))


@query("t15_cigar_totals", f"SELECT read_name, ref_start, {_sum('M')} AS m, {_sum('I')} AS i, {_sum('D')} AS d, {_sum('S')} AS s FROM fx_reads")
def _(g):
    return g.reads.select("read_name", "ref_start", *[cg.cigar_total(F.col("cigar"), o).alias(o.lower()) for o in "MIDS"])


@query("t16_reference_span", f"SELECT read_name, cigar, CASE WHEN cigar LIKE '40S%' THEN 40 ELSE 0 END AS query_start, CASE WHEN cigar LIKE '40S%' THEN 40 ELSE 0 END + {_sum('M')} + {_sum('I')} AS query_end, ref_start + {_LEN} AS ref_end FROM fx_reads")
def _(g):
    return g.reads.withColumn("x", cg.reference_span(F.col("cigar"), F.col("ref_start"))).select("read_name", "cigar", "x.*")


@query("t17_aligned_overlap")
def _(g):
    return g.reads.select("read_name", cg.aligned_overlap(F.col("cigar"), F.col("ref_start"), F.lit("100M"), F.col("ref_start") + 20).alias("shared"))


@query("t25_softclip_distance", "SELECT read_name, cigar, CASE WHEN cigar LIKE '40S%' THEN least(abs(ref_start - 2000), abs(ref_start - 5000)) ELSE 999 END AS distance FROM fx_reads")
def _(g):
    return g.reads.select("read_name", "cigar", cg.softclip_distance(F.col("cigar"), F.col("ref_start"), F.array(F.lit(2000), F.lit(5000))).alias("distance"))


@query(
    "t28_indel_size_class",
    f"""WITH x AS (SELECT *, {_sum('I')} AS i, {_sum('D')} AS d, len(regexp_extract_all(cigar, '(\\d+)([MIDS])')) AS ops FROM fx_reads)
    SELECT read_name, cigar, CASE WHEN i + d <= 0 THEN 0 WHEN i + d <= 3 THEN 1 WHEN i + d <= 10 THEN 2 ELSE 3 END AS size_class,
    least(ops + (i + d) / 10.0, 10.0) AS complexity, CASE WHEN d > 0 THEN i / CAST(d AS DOUBLE) WHEN i > 0 THEN 10.0 ELSE 0.0 END AS ratio FROM x""",
)
def _(g):
    i, d = cg.cigar_total(F.col("cigar"), "I"), cg.cigar_total(F.col("cigar"), "D")
    return g.reads.select("read_name", "cigar", cg.size_class(i + d).alias("size_class"), cg.complexity(F.size(cg.parse_cigar(F.col("cigar"))), i + d).alias("complexity"), cg.ins_del_ratio(i, d).alias("ratio"))


@query("d08_usable_reads", "SELECT read_name, mapq FROM fx_reads WHERE is_dup = 0 AND mapq >= 20")
def _(g):
    return rd.usable_reads(g.reads).select("read_name", "mapq")


_LABEL = f"""WITH {_met(150, _PRIMARY + " AND r.mapq >= 1", 0)}, x AS (SELECT chrom, pos, coalesce(avg(CASE WHEN arm = 'edited' THEN CAST(ins + del > 0 AS INT) END), 0.0) AS edited,
    coalesce(avg(CASE WHEN arm = 'control' THEN CAST(ins + del > 0 AS INT) END), 0.0) AS control FROM met GROUP BY 1, 2)
    SELECT *, CASE WHEN edited >= 0.05 AND control <= 0.01 THEN 1 WHEN edited <= 0.01 THEN 0 ELSE -1 END AS label FROM x"""


@query("a13_site_labels", _LABEL)
def site_labels(g):
    return rd.site_labels(g.reads, g.sites)


#: A mismatch tag for the views' reads, the same in both engines.
_MD = "CASE WHEN mapq % 4 = 0 THEN '10A5' ELSE '150' END"


@query("a12_control_fractions", f"""WITH {_met(50, _PRIMARY + " AND r.arm = 'control'", 0)} SELECT chrom, pos, count(*) AS reads, avg(CAST(del > 0 AS INT)) AS del_share, avg(CAST(ins > 0 AS INT)) AS ins_share, avg(CAST(clip > 0 AS INT)) AS clip_share, avg(CAST(mapq % 4 = 0 AS INT)) AS mismatch_share FROM met GROUP BY 1, 2""")
def _(g):
    return rd.control_fractions(g.reads.withColumn("md", F.expr(_MD)), g.sites)


@query("j20_control_overlap", f"""WITH {_met(50, _PRIMARY + " AND r.arm = 'control'")} SELECT chrom, pos, bool_or(ins > 0) AS control_ins, bool_or(del > 0) AS control_del FROM met GROUP BY 1, 2""")
def _(g):
    return rd.control_overlap(g.reads, g.sites)


@query(
    "a09_allele_counts",
    f"""WITH {_met(25, _PRIMARY + " AND r.mapq >= 20")}, e AS (SELECT *, {_EVENT} AS ep FROM met),
    a AS (SELECT chrom, pos, read_name, ref_start, CASE WHEN ep IS NULL THEN 'REF' ELSE concat(CASE WHEN ins > 0 THEN 'I' ELSE 'D' END, ':', ins + del, '@', ep) END AS allele FROM e),
    k AS (SELECT *, row_number() OVER (PARTITION BY chrom, pos, read_name ORDER BY allele = 'REF', ref_start, allele) AS k FROM a)
    SELECT chrom, pos, allele, count(*) AS n FROM k WHERE k = 1 GROUP BY 1, 2, 3""",
)
def _(g):
    return rd.allele_counts(g.reads, g.sites)


@query(
    "a10_locus_edit_summary",
    f"""WITH {_met(50, _PRIMARY + " AND r.mapq >= 20")}, x AS (SELECT chrom, pos, count(*) FILTER (arm = 'edited') AS total, count(*) FILTER (arm = 'edited' AND ins + del > 0) AS indel,
    count(*) FILTER (arm <> 'edited') AS control_total, count(*) FILTER (arm <> 'edited' AND ins + del > 0) AS control_indel,
    coalesce(string_agg(DISTINCT CASE WHEN arm = 'edited' AND ins + del > 0 THEN regexp_replace(cigar, '\\d+M', '', 'g') END, ';' ORDER BY CASE WHEN arm = 'edited' AND ins + del > 0 THEN regexp_replace(cigar, '\\d+M', '', 'g') END), '') AS events FROM met GROUP BY 1, 2)
    SELECT *, round(CASE WHEN total > 0 THEN indel / CAST(total AS DOUBLE) ELSE 0.0 END, 4) AS fraction, round(CASE WHEN control_total > 0 THEN control_indel / CAST(control_total AS DOUBLE) ELSE 0.0 END, 4) AS control_fraction FROM x""",
)
def _(g):
    return rd.locus_edit_summary(g.reads, g.sites)


def _evidence(name: str, fetch: int, reach: int, extra: str = "") -> str:
    """Reads around loci with the place and length of their indel within reach, and whether they span the locus."""
    at = "ref_start + CAST(nullif(regexp_extract(cigar, '^(\\d+)M\\d+[ID]', 1), '') AS BIGINT)"
    return f"""{_met(fetch, _PRIMARY + extra, 0).replace("met AS", f"met_{name} AS")}, {name} AS (SELECT chrom, pos, sample, mapq, CASE WHEN abs({at} - pos) <= {reach} THEN {at} END AS ep,
      CASE WHEN abs({at} - pos) <= {reach} THEN ins + del END AS len, CAST(ref_start <= pos AND pos <= ref_start + mat + del AS BIGINT) AS spans, CASE WHEN clip > 0 AND abs(ref_start - pos) <= {reach} THEN ref_start END AS cp FROM met_{name})"""


def _shape(least: int) -> str:
    return f"""{_evidence("e", 200, 25)}, s AS (SELECT chrom, pos, CAST(sum(spans) AS BIGINT) AS spanning, count(ep) AS indels FROM e GROUP BY 1, 2 HAVING sum(spans) >= {least}),
    mp AS (SELECT chrom, pos, ep, row_number() OVER (PARTITION BY chrom, pos ORDER BY count(*) DESC, ep) AS k FROM e WHERE ep IS NOT NULL GROUP BY 1, 2, 3),
    n AS (SELECT e.*, abs(e.ep - mp.ep) AS apart FROM e JOIN mp ON e.chrom = mp.chrom AND e.pos = mp.pos AND mp.k = 1 WHERE e.ep IS NOT NULL),
    ml AS (SELECT chrom, pos, len, row_number() OVER (PARTITION BY chrom, pos ORDER BY count(*) DESC, len) AS k FROM n WHERE apart <= 2 GROUP BY 1, 2, 3),
    c AS (SELECT chrom, pos, count(*) FILTER (apart <= 2) AS close, median(apart) AS spread, median(mapq) FILTER (apart <= 2) AS median_mapq FROM n GROUP BY 1, 2),
    cl AS (SELECT chrom, pos, max(n) AS clips FROM (SELECT chrom, pos, cp, count(*) AS n FROM e WHERE cp IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2),
    shape AS (SELECT s.chrom, s.pos, spanning, indels, indels / CAST(spanning AS DOUBLE) AS indel_share, mp.ep AS modal_pos, coalesce(ml.len, 0) AS modal_len,
      coalesce(close / CAST(nullif(indels, 0) AS DOUBLE), 0.0) AS concentration, coalesce(close / CAST(spanning AS DOUBLE), 0.0) AS cut_share, coalesce(spread, 0.0) AS spread,
      coalesce(median_mapq, 0.0) AS median_mapq, coalesce(clips / CAST(spanning AS DOUBLE), 0.0) AS clip_share
      FROM s LEFT JOIN mp ON s.chrom = mp.chrom AND s.pos = mp.pos AND mp.k = 1 LEFT JOIN ml ON s.chrom = ml.chrom AND s.pos = ml.pos AND ml.k = 1
      LEFT JOIN c ON s.chrom = c.chrom AND s.pos = c.pos LEFT JOIN cl ON s.chrom = cl.chrom AND s.pos = cl.pos)"""


@query("a14_pileup_shape", f"WITH {_shape(8)} SELECT * FROM shape")
def _(g):
    return rd.pileup_shape(g.reads, g.sites)


@query(
    "a16_verdict",
    f"""WITH {_shape(1)}, {_evidence("o", 200, 25, " AND r.arm = 'control'")}, ctl AS (SELECT chrom, pos, count(ep) / CAST(sum(spans) AS DOUBLE) AS control_share FROM o GROUP BY 1, 2 HAVING sum(spans) >= 4)
    SELECT shape.chrom, shape.pos, CASE WHEN spanning < 8 THEN 'INSUFFICIENT COVERAGE' WHEN median_mapq < 20 AND indel_share > 0 THEN 'ARTIFACT (low-MAPQ repeat)' WHEN control_share >= 0.03 OR indel_share < 3 * control_share THEN 'GERMLINE/ARTIFACT (in normal)'
      WHEN shape.pos % 100 / 100.0 >= 0.6 AND concentration >= 0.5 THEN 'LIKELY EDIT' WHEN shape.pos % 100 / 100.0 >= 0.25 THEN 'POSSIBLE - review' ELSE 'ARTIFACT (shape)' END AS verdict
    FROM shape LEFT JOIN ctl ON shape.chrom = ctl.chrom AND shape.pos = ctl.pos""",
)
def _(g):
    scores = g.sites.select("chrom", "pos", (F.col("pos") % 100 / 100).alias("score")).distinct()
    control = rd.pileup_shape(g.reads.where("arm = 'control'"), g.sites, least=4)
    return rd.verdicts(rd.pileup_shape(g.reads, g.sites, least=1), control, scores).select("chrom", "pos", "verdict")


@query(
    "a15_panel_of_normals",
    f"""WITH cand AS (SELECT DISTINCT chrom, pos, concat('s', pos % 10) AS sample FROM fx_sites), {_evidence("e", 201, 26, " AND r.arm = 'control'")},
    n AS (SELECT chrom, pos, sample AS normal, sum(spans) AS n, count(*) FILTER (abs(ep - pos) <= 3) AS k FROM e GROUP BY 1, 2, 3 HAVING sum(spans) >= 4),
    m AS (SELECT c.chrom, c.pos, c.sample, n.n, n.k, n.k / CAST(n.n AS DOUBLE) AS share FROM cand c JOIN n ON c.chrom = n.chrom AND c.pos = n.pos AND n.normal <> c.sample),
    o AS (SELECT chrom, pos, sample, count(*) AS normals, count(*) FILTER (share >= 0.03) AS hits, CAST(sum(k) AS DOUBLE) / sum(n) AS pooled_share, max(share) AS worst_share FROM m GROUP BY 1, 2, 3)
    SELECT *, hits > 0 OR pooled_share >= 0.02 AS demote FROM o""",
)
def _(g):
    return rd.panel_of_normals(g.reads, g.sites.select("chrom", "pos", F.concat(F.lit("s"), F.col("pos") % 10).alias("sample")))


@query(
    "a17_recurrence_tiers",
    """WITH x AS (SELECT v.chrom, v.pos, count(DISTINCT regexp_replace(v.sample, '_[12]$', '')) AS samples, count(DISTINCT s.guide) AS guides FROM fx_variants v JOIN fx_sites s ON v.chrom = s.chrom AND v.pos = s.pos GROUP BY 1, 2)
    SELECT *, CASE WHEN guides >= 3 THEN 'artifact' WHEN samples > 1 THEN 'recurrent' ELSE 'private' END AS tier FROM x""",
)
def _(g):
    return rd.recurrence_tiers(g.variants.join(g.sites.select("chrom", "pos", "guide"), ["chrom", "pos"]))


_FEATURES = f"""WITH {_met(150, _PRIMARY + " AND r.arm = 'edited'", 0)}, {_met(100, _PRIMARY + " AND r.arm = 'control'", 0).replace("met AS", "ctl AS")},
    shares AS (SELECT chrom, pos, avg(CAST(del > 0 AS INT)) AS d, avg(CAST(ins > 0 AS INT)) AS i, avg(CAST(mapq % 4 = 0 AS INT)) AS m FROM ctl WHERE ref_start < pos + 50 AND pos - 50 < ref_start + mat + del GROUP BY 1, 2),
    dels AS (SELECT DISTINCT chrom, pos, ref_start AS cs, ref_start + mat + del AS ce FROM ctl WHERE del > 0),
    x AS (SELECT met.*, ref_start + mat + del AS en, del + CASE WHEN clip >= 3 THEN 2 * clip ELSE 0 END AS dele, s.is_target FROM met JOIN fx_sites s ON met.chrom = s.chrom AND met.pos = s.pos)
    SELECT x.chrom, x.pos, read_name, ref_start, cigar, CASE WHEN mapq % 2 = 0 THEN abs(ref_start % 500 - 250) ELSE -1 END AS pair_gap, clip AS softclip,
      CAST(dele > 0 AS INT) - coalesce(d, 0.0) AS del_vs_control, CAST(ins > 0 AS INT) - coalesce(i, 0.0) AS ins_vs_control, CAST(mapq % 4 = 0 AS INT) - coalesce(m, 0.0) AS mismatch_vs_control,
      CAST(del > 0 AND NOT EXISTS (SELECT 1 FROM dels c WHERE c.chrom = x.chrom AND c.pos = x.pos AND x.en >= c.cs AND c.ce >= x.ref_start) AS INT) AS deletion_exclusive, is_target AS on_target,
      CAST(ref_start <= x.pos + 32 AND en >= x.pos - 18 OR ref_start <= x.pos + 65 AND en >= x.pos + 15 AS INT) AS at_target, 7 AS pam_distance, ins + dele AS indel_size,
      CASE WHEN ins + dele <= 0 THEN 0 WHEN ins + dele <= 3 THEN 1 WHEN ins + dele <= 10 THEN 2 ELSE 3 END AS size_class, least(len(regexp_extract_all(cigar, '\\d+[ID]')) + (ins + dele) / 10.0, 10.0) AS complexity,
      CASE WHEN clip > 0 THEN least(abs(ref_start - x.pos - 7), abs(ref_start - x.pos - 40)) ELSE 999 END AS clip_distance, 0 AS homopolymer, 999 AS repeat_distance
    FROM x LEFT JOIN shares ON x.chrom = shares.chrom AND x.pos = shares.pos"""


@query("l01_read_features", _FEATURES)
def _(g):
    reads = g.reads.withColumn("md", F.expr(_MD)).withColumn("flag", F.when(F.col("mapq") % 2 == 0, 3).otherwise(1)).withColumn("tlen", F.col("ref_start") % 500 - 250)
    return rd.read_features(reads, g.sites.select("chrom", "pos", F.col("is_target").alias("on_target"), F.array(F.col("pos") + 7, F.col("pos") + 40).alias("pams")))


@query(
    "l11_downsample_depth",
    f"""WITH {_met(0)}, d AS (SELECT chrom, pos, count(*) AS depth FROM met GROUP BY 1, 2)
    SELECT m.chrom, m.pos, m.read_name, m.ref_start FROM met m JOIN d ON m.chrom = d.chrom AND m.pos = d.pos WHERE CAST(('0x' || substr(md5(read_name), 1, 8)) AS UBIGINT) / 4294967296.0 < 20.0 / depth""",
)
def _(g):
    return rd.downsample_depth(g.reads, g.sites, 20).select("chrom", "pos", "read_name", "ref_start")


@query(
    "a29_indel_spectrum",
    f"""WITH x AS (SELECT cigar, {_sum('M')} + {_sum('I')} AS aligned FROM fx_reads), m AS (SELECT aligned AS modal FROM x GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    c AS (SELECT CASE WHEN regexp_matches(cigar, '[ID]') THEN regexp_extract(cigar, '^(\\d+)M(\\d+[ID])', 1) || ':' || regexp_extract(cigar, '^(\\d+)M(\\d+[ID])', 2) ELSE 'wt' END AS allele, count(*) AS n FROM x, m WHERE aligned >= 0.9 * modal GROUP BY 1)
    SELECT allele, n, round(100.0 * n / sum(n) OVER (), 4) AS percent FROM c""",
)
def _(g):
    return rd.indel_spectrum(g.reads)
