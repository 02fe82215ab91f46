"""Queries of capture Hi-C tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusweave.operators import hic
from locusweave.operators.intervals import distance_band_join
from locusweave.queries import query

_HIT = """h1 AS (SELECT p.pair_id, f.chrom, f.frag_id AS frag, f.is_bait, (f.st + f.en) / 2.0 AS mid, f.en - f.st AS length FROM fx_pairs p JOIN fx_frags f ON p.chr1 = f.chrom AND p.st1 < f.en AND f.st < p.en1
      AND CAST(least(p.en1, f.en) - greatest(p.st1, f.st) AS DOUBLE) / (p.en1 - p.st1) >= 0.6),
    h2 AS (SELECT p.pair_id, f.chrom, f.frag_id AS frag, f.is_bait, (f.st + f.en) / 2.0 AS mid, f.en - f.st AS length FROM fx_pairs p JOIN fx_frags f ON p.chr2 = f.chrom AND p.st2 < f.en AND f.st < p.en2
      AND CAST(least(p.en2, f.en) - greatest(p.st2, f.st) AS DOUBLE) / (p.en2 - p.st2) >= 0.6),
    both_ends AS (SELECT a.frag AS bait_id, b.frag AS other_id, b.length, CASE WHEN a.chrom = b.chrom THEN CAST(floor(b.mid - a.mid + 0.5) AS BIGINT) END AS dist_sign FROM h1 a JOIN h2 b USING (pair_id) WHERE a.is_bait = 1
      UNION ALL SELECT a.frag, b.frag, b.length, CASE WHEN a.chrom = b.chrom THEN CAST(floor(b.mid - a.mid + 0.5) AS BIGINT) END FROM h2 a JOIN h1 b USING (pair_id) WHERE a.is_bait = 1),
    pair_counts AS (SELECT bait_id, other_id, count(*) AS n, min(length) AS other_length, min(dist_sign) AS dist_sign FROM both_ends WHERE dist_sign IS NULL OR dist_sign <> 0 GROUP BY 1, 2)"""


def _counts(g):
    return hic.count_fragment_pairs(g.pairs, g.frags)


@query("a01_count_fragment_pairs", f"WITH {_HIT} SELECT * FROM pair_counts")
def _(g):
    return _counts(g)


#: Pairs between baits, which the views lack: each bait with the one ten fragments on.
_PLANTED = """planted AS (SELECT -a.frag_id AS pair_id, a.chrom AS chr1, a.st AS st1, a.st + 150 AS en1, b.chrom AS chr2, b.st AS st2, b.st + 150 AS en2
      FROM fx_frags a JOIN fx_frags b ON a.is_bait = 1 AND b.frag_id = a.frag_id + 10), all_pairs AS (SELECT * FROM fx_pairs UNION ALL SELECT * FROM planted), """


@query("a02_bait_to_bait", f"WITH {_PLANTED}{_HIT.replace('fx_pairs', 'all_pairs')} SELECT bait_id, other_id, n FROM pair_counts WHERE other_id IN (SELECT frag_id FROM fx_frags WHERE is_bait = 1)")
def _(g):
    a = g.frags.where("is_bait = 1").select((-F.col("frag_id")).alias("pair_id"), F.col("chrom").alias("chr1"), F.col("st").alias("st1"), (F.col("st") + 150).alias("en1"), (F.col("frag_id") + 10).alias("next"))
    b = g.frags.select(F.col("frag_id").alias("next"), F.col("chrom").alias("chr2"), F.col("st").alias("st2"), (F.col("st") + 150).alias("en2"))
    counts = hic.count_fragment_pairs(g.pairs.unionByName(a.join(b, "next").drop("next")), g.frags)
    return hic.bait_to_bait(counts, g.frags).select("bait_id", "other_id", "n")


@query("s08_fragment_problems", "SELECT frag_id, 'bait is no fragment' AS problem FROM fx_frags WHERE is_bait = 1 AND frag_id % 7 = 0")
def _(g):
    baits = g.frags.where("is_bait = 1").withColumn("en", F.when(F.col("frag_id") % 7 == 0, F.col("en") + 1).otherwise(F.col("en")))
    return hic.fragment_problems(g.frags, baits)


_BAND = """f AS (SELECT chrom, frag_id, is_bait, en - st AS length, (st + en) / 2.0 AS mid, row_number() OVER (PARTITION BY chrom ORDER BY st, frag_id) AS k FROM fx_frags),
    band AS (SELECT b.frag_id AS bait_id, o.frag_id AS other_id, o.mid - b.mid AS distance, o.length FROM f b JOIN f o ON b.chrom = o.chrom AND b.is_bait = 1 AND o.is_bait = 0 AND abs(o.mid - b.mid) < 200000 AND abs(o.k - b.k) > 1)"""


@query("a03_bin_counts_per_bait", f"WITH {_BAND} SELECT bait_id, CAST(floor(abs(distance) / 20000) AS BIGINT) AS bin, count(*) AS n FROM band WHERE length BETWEEN 600 AND 1600 GROUP BY 1, 2")
def _(g):
    return hic.bin_counts_per_bait(g.frags, 20_000, 10, 600, 1600)


@query("a03_baits_per_bin", f"WITH {_BAND} SELECT other_id, CAST(floor(abs(distance) / 20000) AS BIGINT) AS bin, count(*) AS n FROM band GROUP BY 1, 2")
def _(g):
    return hic.baits_per_bin(g.frags, 20_000, 10)


@query("k07_export_design", f"WITH {_BAND} SELECT bait_id, " + ", ".join(f"count(*) FILTER (floor(abs(distance) / 20000) = {b}) AS bin{b}" for b in range(10)) + " FROM band WHERE length BETWEEN 600 AND 1600 GROUP BY 1")
def _(g):
    return hic.export_design(hic.bin_counts_per_bait(g.frags, 20_000, 10, 600, 1600), "bait_id", 10)


@query("j14_complete_grid", f"WITH {_HIT}, {_BAND} SELECT b.bait_id, b.other_id, coalesce(c.n, 0) AS n FROM band b LEFT JOIN pair_counts c ON b.bait_id = c.bait_id AND b.other_id = c.other_id")
def _(g):
    grid = distance_band_join(g.frags, 200_000)
    return hic.complete_grid(_counts(g), grid, ("bait_id", "other_id")).select("bait_id", "other_id", "n")


@query(
    "a04_bait_sparsity",
    f"""WITH {_HIT}, {_BAND}, x AS (SELECT b.bait_id, CAST(floor(abs(b.distance) / 20000) AS BIGINT) AS bin, count(*) AS total, count(c.n) AS seen FROM band b LEFT JOIN pair_counts c ON b.bait_id = c.bait_id AND b.other_id = c.other_id GROUP BY 1, 2)
    SELECT *, total - seen AS missing, (total - seen) / CAST(total AS DOUBLE) AS missing_share FROM x""",
)
def _(g):
    return hic.bait_sparsity(_counts(g), distance_band_join(g.frags, 200_000), 20_000)


@query("j12_exclude_keys", "SELECT bait_id, other_id, sample, n FROM fx_interactions WHERE bait_id NOT IN (SELECT bait_id FROM fx_interactions GROUP BY 1 HAVING sum(n) < 750)")
def _(g):
    low = g.interactions.groupBy("bait_id").agg(F.sum("n").alias("t")).where("t < 750")
    return hic.exclude_keys(g.interactions, low.select("bait_id"), "bait_id").select("bait_id", "other_id", "sample", "n")


@query("j13_restrict_to_keys", "SELECT k.bait_id, k.other_id, i.n FROM (SELECT DISTINCT o_custkey % 25 AS bait_id, o_orderkey % 45 AS other_id FROM orders WHERE o_orderkey % 50 = 0) k LEFT JOIN fx_interactions i ON k.bait_id = i.bait_id AND k.other_id = i.other_id AND i.sample = 's0'")
def _(g):
    keys = g.table("orders").where("o_orderkey % 50 = 0").select((F.col("o_custkey") % 25).alias("bait_id"), (F.col("o_orderkey") % 45).alias("other_id"))
    return hic.restrict_to_keys(g.interactions.where("sample = 's0'"), keys, "bait_id", "other_id").select("bait_id", "other_id", "n")


@query(
    "a05_max_log_p",
    """WITH s AS (SELECT count(DISTINCT sample) AS k FROM fx_interactions), p AS (SELECT bait_id, other_id, max(log_p) AS m, count(DISTINCT sample) AS c FROM fx_interactions GROUP BY 1, 2)
    SELECT bait_id, other_id, round(CASE WHEN c < k THEN greatest(m, 0.0) ELSE m END, 2) AS log_p FROM p, s WHERE CASE WHEN c < k THEN greatest(m, 0.0) ELSE m END < 0""",
)
def _(g):
    return hic.max_log_p(g.interactions).withColumn("log_p", F.round("log_p", 2))


_BINS = " + ".join(f"CASE WHEN abs(dist_sign) >= {b} THEN 1 ELSE 0 END" for b in hic.BREAKS)


@query(
    "a06_observed_per_distance_bin",
    f"""WITH {_HIT}, e AS (SELECT min(bait_id) AS lo, max(bait_id) AS hi FROM pair_counts)
    SELECT CAST(least(floor((bait_id - lo) * 5 / (hi - lo + 1)), 4) + 1 AS BIGINT) AS subset, CASE WHEN dist_sign IS NOT NULL THEN {_BINS} END AS bin, count(*) AS pairs, CAST(sum(n) AS BIGINT) AS reads FROM pair_counts, e GROUP BY 1, 2""",
)
def _(g):
    return hic.observed_per_distance_bin(_counts(g))


_EDGES = [0, 20_000, 50_000, 100_000, 200_000, 400_000]


@query(
    "a07_expected_per_distance_bin",
    "WITH c AS (SELECT chrom, max(en) AS size, sum(is_bait) AS baits FROM fx_frags GROUP BY 1), m AS (SELECT avg(en - st) AS mean FROM fx_frags), e(bin, lo, hi) AS (VALUES "
    + ", ".join(f"({k + 1}, {a}, {b})" for k, (a, b) in enumerate(zip(_EDGES, _EDGES[1:])))
    + """), r AS (SELECT *, least(CAST(hi AS DOUBLE), size) AS h, least(CAST(lo AS DOUBLE), size) AS l FROM c, m, e)
    SELECT bin, sum(baits * ((2 * h - h * h / size) - (2 * l - l * l / size)) / mean) AS expected FROM r GROUP BY 1""",
)
def _(g):
    return hic.expected_per_distance_bin(g.frags, _EDGES)


@query("a08_contact_marginals", "SELECT chrom, i, CAST(sum(n) AS BIGINT) AS total FROM (SELECT chrom, i, n FROM fx_contacts UNION ALL SELECT chrom, j, n FROM fx_contacts WHERE i <> j) GROUP BY 1, 2")
def _(g):
    return hic.contact_marginals(g.contacts)


@query("u04_union_of_peaks", "SELECT bait_id, other_id, max(score) AS best FROM fx_interactions GROUP BY 1, 2 HAVING max(score) >= 5")
def _(g):
    return hic.union_of_peaks(g.interactions, 5.0)


_SAMPLES = ["s0", "s1", "s2", "s3"]


@query("j15_merge_samples", "SELECT bait_id, other_id, " + ", ".join(f"coalesce(max(score) FILTER (sample = '{s}'), 0.0) AS {s}" for s in _SAMPLES) + " FROM fx_interactions GROUP BY 1, 2")
def _(g):
    return hic.merge_samples(g.interactions, _SAMPLES)


@query(
    "j22_annotate_interactions",
    f"""WITH {_HIT} SELECT c.bait_id, c.other_id, b.chrom AS bait_chrom, b.annotation AS bait_name, o.chrom AS other_chrom, CASE WHEN o.is_bait = 1 THEN o.annotation ELSE '.' END AS other_name,
    CASE WHEN b.chrom = o.chrom THEN CAST(ceil((o.st + o.en) / 2.0 - (b.st + b.en) / 2.0) AS BIGINT) END AS distance FROM pair_counts c JOIN fx_frags b ON c.bait_id = b.frag_id JOIN fx_frags o ON c.other_id = o.frag_id""",
)
def _(g):
    return hic.annotate_interactions(_counts(g).select("bait_id", "other_id"), g.frags).select("bait_id", "other_id", "bait_chrom", "bait_name", "other_chrom", "other_name", "distance")


@query(
    "l14_sample_distances",
    """WITH k AS (SELECT DISTINCT bait_id, other_id FROM fx_interactions), s AS (SELECT DISTINCT sample FROM fx_interactions),
    f AS (SELECT s.sample, k.bait_id, k.other_id, coalesce(i.score, 0.0) AS score FROM k CROSS JOIN s LEFT JOIN fx_interactions i ON i.bait_id = k.bait_id AND i.other_id = k.other_id AND i.sample = s.sample)
    SELECT a.sample, b.sample AS sample_b, round(sqrt(sum((a.score - b.score) * (a.score - b.score))), 4) AS distance FROM f a JOIN f b ON a.bait_id = b.bait_id AND a.other_id = b.other_id AND a.sample < b.sample GROUP BY 1, 2""",
)
def _(g):
    return hic.sample_distances(g.interactions).withColumn("distance", F.round("distance", 4))


@query(
    "l15_weight_by_distance",
    f"WITH {_HIT} SELECT bait_id, other_id, round((1 / (1 + exp(0.5)) - 1 / (1 + exp(3.0))) / (1 + exp(-(8.0 - 0.8 * ln(CAST(abs(dist_sign) AS DOUBLE))))) + 1 / (1 + exp(3.0)), 9) AS weight FROM pair_counts WHERE dist_sign IS NOT NULL",
)
def _(g):
    return _counts(g).where("dist_sign is not null").select("bait_id", "other_id", F.round(hic.weight_by_distance(F.col("dist_sign"), 8.0, -0.8, -3.0, -0.5), 9).alias("weight"))
