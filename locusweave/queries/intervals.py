"""Queries of interval algebra."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusweave.operators import intervals as iv
from locusweave.queries import query


def _spans(g):
    return g.reads.select("read_name", "chrom", F.col("ref_start").alias("st"), (F.col("ref_start") + 150).alias("en"))


@query("j01_overlap_join", "SELECT r.read_name, r.chrom, r.ref_start AS st, g.symbol FROM fx_reads r JOIN fx_genes g ON r.chrom = g.chrom AND r.ref_start < g.en AND g.st < r.ref_start + 150")
def _(g):
    return iv.overlap_join(_spans(g), g.genes.select("chrom", "st", "en", "symbol")).select("read_name", "chrom", "st", F.col("symbol_b").alias("symbol"))


@query(
    "j02_overlap_fraction",
    """SELECT p.pair_id, f.frag_id FROM fx_pairs p LEFT JOIN fx_frags f ON p.chr1 = f.chrom AND p.st1 < f.en AND f.st < p.en1
    AND CAST(least(p.en1, f.en) - greatest(p.st1, f.st) AS DOUBLE) / (p.en1 - p.st1) >= 0.6""",
)
def _(g):
    ends = g.pairs.select("pair_id", F.col("chr1").alias("chrom"), F.col("st1").alias("st"), F.col("en1").alias("en"))
    frags = g.frags.select("chrom", "st", "en", "frag_id")
    return iv.overlap_fraction_join(ends, frags, 0.6, how="left").select("pair_id", F.col("frag_id_b").alias("frag_id"))


@query(
    "j03_nearest_within",
    """WITH near AS (SELECT v.id, s.pos AS site_pos, abs(v.pos - s.pos) AS distance, row_number() OVER (PARTITION BY v.id ORDER BY abs(v.pos - s.pos), s.pos) AS k
    FROM fx_variants v JOIN fx_sites s ON v.chrom = s.chrom AND abs(v.pos - s.pos) <= 25)
    SELECT v.id, v.pos, n.site_pos, n.distance FROM fx_variants v LEFT JOIN near n ON v.id = n.id AND n.k = 1""",
)
def _(g):
    return iv.nearest_within(g.variants, g.sites, 25, "id").select("id", "pos", "site_pos", "distance")


@query(
    "j04_min_distance",
    """WITH d AS (SELECT v.id, min(abs(v.pos - s.pos)) AS distance FROM fx_variants v JOIN fx_sites s ON v.chrom = s.chrom GROUP BY v.id)
    SELECT v.id, d.distance FROM fx_variants v LEFT JOIN d USING (id)""",
)
def _(g):
    return iv.min_distance(g.variants.select("id", "chrom", "pos"), g.sites, 2000).select("id", "distance")


_BAND = """f AS (SELECT chrom, frag_id, is_bait, en - st AS length, (st + en) / 2.0 AS mid, row_number() OVER (PARTITION BY chrom ORDER BY st, frag_id) AS k FROM fx_frags),
    band AS (SELECT b.frag_id AS bait_id, o.frag_id AS other_id, o.mid - b.mid AS distance FROM f b JOIN f o ON b.chrom = o.chrom AND b.is_bait = 1 AND o.is_bait = 0
      AND abs(o.mid - b.mid) < 150000 AND abs(o.k - b.k) > 1 AND o.length >= 600 AND o.length <= 1600)"""


@query("j05_distance_band", f"WITH {_BAND} SELECT bait_id, other_id, CAST(distance AS DOUBLE) AS distance FROM band")
def _(g):
    return iv.distance_band_join(g.frags, 150_000, 600, 1600).select("bait_id", "other_id", F.col("distance").cast("double").alias("distance"))


_CLUSTERS = """flagged AS (SELECT seg_id, chrom, alt, st, en, CASE WHEN st - max(en) OVER (PARTITION BY chrom, alt ORDER BY st, en ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 5000 THEN 0 ELSE 1 END AS fresh FROM fx_segments),
    clusters AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY chrom, alt ORDER BY st, en RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cluster FROM flagged)"""


@query("w02_cluster_intervals", f"WITH {_CLUSTERS} SELECT seg_id, chrom, alt, cluster FROM clusters")
def _(g):
    return iv.cluster_intervals(g.segments, 5000, ("chrom", "alt")).select("seg_id", "chrom", "alt", "cluster")


@query("w03_merge_intervals", f"WITH {_CLUSTERS} SELECT chrom, alt, cluster, min(st) AS st, max(en) AS en, count(*) AS n FROM clusters GROUP BY 1, 2, 3")
def _(g):
    return iv.merge_intervals(g.segments, 5000, ("chrom", "alt")).select("chrom", "alt", "cluster", "st", "en", "n")


@query(
    "j18_point_in_fragment",
    """SELECT f.frag_id, count(*) AS n_probes, max_by(p.pair_id, p.pair_id) AS feature FROM fx_pairs p JOIN fx_frags f
    ON p.chr1 = f.chrom AND floor((p.st1 + p.en1) / 2) BETWEEN f.st AND f.en GROUP BY 1""",
)
def _(g):
    probes = g.pairs.select(F.col("chr1").alias("chrom"), F.col("st1").alias("st"), F.col("en1").alias("en"), F.col("pair_id").alias("feature"), F.col("pair_id").alias("ord"))
    return iv.point_in_fragment(probes, g.frags)


@query("j19_reads_at_loci", "SELECT s.chrom, s.pos, r.read_name FROM fx_reads r JOIN fx_sites s ON r.chrom = s.chrom AND r.ref_start < s.pos + 51 AND s.pos - 50 < r.ref_start + 150")
def _(g):
    loci = g.sites.select("chrom", "pos", F.col("pos").alias("st"), (F.col("pos") + 1).alias("en"))
    return iv.overlap_join(_spans(g), loci, 50).select("chrom", F.col("pos_b").alias("pos"), "read_name")


@query(
    "j23_names_per_bin",
    """WITH bins AS (SELECT DISTINCT chrom, st - st % 10000 AS st, st - st % 10000 + 10000 AS en FROM fx_frags)
    SELECT b.chrom, b.st, b.en, string_agg(DISTINCT g.symbol, ',' ORDER BY g.symbol) AS names FROM bins b JOIN fx_genes g ON b.chrom = g.chrom AND b.st < g.en AND g.st < b.en GROUP BY 1, 2, 3""",
)
def _(g):
    low = F.col("st") - F.col("st") % 10000
    bins = g.frags.select("chrom", low.alias("st"), (low + 10000).alias("en")).distinct()
    return iv.names_per_interval(bins, g.genes.select("chrom", "st", "en", F.col("symbol").alias("name")))


@query(
    "w11_covered_share",
    """WITH k AS (SELECT *, max(en) OVER (PARTITION BY chrom ORDER BY st, en ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (SELECT chrom, st * 9 AS st, en * 9 AS en FROM fx_genes)),
    m AS (SELECT chrom, min(st) AS st, max(en) AS en FROM (SELECT *, sum(CASE WHEN st <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY chrom ORDER BY st, en RANGE UNBOUNDED PRECEDING) AS c FROM k) GROUP BY chrom, c),
    o AS (SELECT s.seg_id, sum(least(s.en, m.en) - greatest(s.st, m.st)) AS covered FROM fx_segments s JOIN m ON s.chrom = m.chrom AND s.st < m.en AND m.st < s.en GROUP BY 1),
    r AS (SELECT s.*, CAST(coalesce(o.covered, 0) AS DOUBLE) / (s.en - s.st) AS share FROM fx_segments s LEFT JOIN o USING (seg_id))
    SELECT seg_id, share, CASE WHEN share < 0.5 THEN filter WHEN filter = 'PASS' THEN 'Mask' ELSE filter || ';Mask' END AS filter FROM r""",
)
def _(g):
    masks = g.genes.select("chrom", (F.col("st") * 9).alias("st"), (F.col("en") * 9).alias("en"))
    return iv.covered_share(g.segments, masks, "seg_id").select("seg_id", "share", "filter")


@query("w12_expand_positions", "SELECT chrom, symbol, unnest(generate_series(st, en - 1)) AS pos FROM fx_genes")
def _(g):
    return iv.expand_positions(g.genes).select("chrom", "symbol", "pos")


@query("d15_duplicate_keys", "SELECT read_name, count(*) AS n FROM fx_reads GROUP BY 1 HAVING count(*) > 1")
def _(g):
    return iv.duplicate_keys(g.reads, "read_name")


@query(
    "j17_as_of_join",
    """WITH b AS (SELECT o_custkey, o_orderdate + INTERVAL 90 DAY AS d, max(o_orderkey) AS prev FROM orders GROUP BY 1, 2),
    x AS (SELECT a.o_orderkey, b.prev, row_number() OVER (PARTITION BY a.o_orderkey ORDER BY b.d DESC) AS k FROM orders a JOIN b ON a.o_custkey = b.o_custkey AND b.d <= a.o_orderdate)
    SELECT o.o_orderkey, o.o_custkey, x.prev FROM orders o LEFT JOIN x ON o.o_orderkey = x.o_orderkey AND k = 1""",
)
def _(g):
    orders = g.table("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    earlier = orders.select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("prev"))
    return iv.as_of_join(orders, earlier, "o_custkey", "o_orderdate", "o_orderdate", 90, "prev").select("o_orderkey", "o_custkey", "prev")
