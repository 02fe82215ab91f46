"""Capture Hi-C tables: fragment-pair counts, design tables, sparsity, distance bins, peak matrices.

Fragments: chrom, st, en, frag_id, is_bait, annotation. Pairs: pair_id, chr1, st1, en1, chr2, st2, en2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.operators.intervals import distance_band_join, overlap_fraction_join
from locusweave.operators.ranks import numbered
from locusweave.plans.size import broadcast_if_small


def _side(pairs: DataFrame, k: int) -> DataFrame:
    return pairs.select("pair_id", F.col(f"chr{k}").alias("chrom"), F.col(f"st{k}").alias("st"), F.col(f"en{k}").alias("en"))


def _hits(ends: DataFrame, frags: DataFrame, share: float) -> DataFrame:
    """The fragments of pair ends, with their midpoints."""
    found = overlap_fraction_join(ends, frags.select("chrom", "st", "en", "frag_id"), share)
    mid = (F.col("st_b") + F.col("en_b")) / 2
    return found.select("pair_id", "chrom", F.col("frag_id_b").alias("frag"), mid.alias("mid"), (F.col("en_b") - F.col("st_b")).alias("length"))


def count_fragment_pairs(pairs: DataFrame, frags: DataFrame, share: float = 0.6) -> DataFrame:
    """Read pairs by (bait_id, other_id): n, other_length, dist_sign (null between chromosomes).

    A pair with a bait at either end counts with that bait first; with baits at both ends, once for each. Distance 0 is
    dropped.
    """
    baits = frags.where("is_bait = 1")
    parts = []
    for bait_end, other_end in ((1, 2), (2, 1)):
        left = _hits(_side(pairs, bait_end), baits, share).select("pair_id", F.col("chrom").alias("bait_chrom"), F.col("frag").alias("bait_id"), F.col("mid").alias("bait_mid"))
        parts.append(left.join(_hits(_side(pairs, other_end), frags, share), "pair_id"))
    both = parts[0].unionByName(parts[1])
    away = F.col("mid") - F.col("bait_mid")
    signed = F.when(F.col("bait_chrom") == F.col("chrom"), F.floor(away + 0.5).cast("long"))
    both = both.withColumn("dist_sign", signed).where(F.col("dist_sign").isNull() | (F.col("dist_sign") != 0))
    return both.groupBy("bait_id", F.col("frag").alias("other_id")).agg(F.count(F.lit(1)).alias("n"), F.min("length").alias("other_length"), F.min("dist_sign").alias("dist_sign"))


def bait_to_bait(counts: DataFrame, frags: DataFrame) -> DataFrame:
    """Fragment-pair counts whose other end is a bait too."""
    return counts.join(frags.where("is_bait = 1").select(F.col("frag_id").alias("other_id")), "other_id", "left_semi")


def fragment_problems(frags: DataFrame, baits: DataFrame) -> DataFrame:
    """Ids that occur twice, and baits that are no row of the fragments."""
    twice = frags.groupBy("frag_id").count().where("count > 1").select("frag_id", F.lit("duplicate id").alias("problem"))
    keys = ["chrom", "st", "en", "frag_id"]
    lost = baits.join(frags, keys, "left_anti").select("frag_id", F.lit("bait is no fragment").alias("problem"))
    return twice.unionByName(lost)


def bin_counts_per_bait(frags: DataFrame, binsize: int, bins: int, shortest: int | None = None, longest: int | None = None) -> DataFrame:
    """Other ends per bait and distance bin, bins without any left out."""
    band = distance_band_join(frags, binsize * bins, shortest, longest)
    return band.groupBy("bait_id", F.floor(F.abs("distance") / binsize).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def baits_per_bin(frags: DataFrame, binsize: int, bins: int) -> DataFrame:
    """Baits per other end and distance bin."""
    band = distance_band_join(frags, binsize * bins)
    return band.groupBy("other_id", F.floor(F.abs("distance") / binsize).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def export_design(counts: DataFrame, key: str, bins: int) -> DataFrame:
    """One row per key with a column for each bin, 0 where it has none."""
    wide = counts.groupBy(key).pivot("bin", list(range(bins))).agg(F.first("n"))
    return wide.select(key, *[F.coalesce(F.col(f"`{b}`"), F.lit(0)).alias(f"bin{b}") for b in range(bins)])


def complete_grid(observed: DataFrame, grid: DataFrame, keys: tuple[str, ...], value: str = "n") -> DataFrame:
    """All rows of grid with the observed value, 0 where there is none."""
    return grid.join(observed.select(*keys, value), list(keys), "left").withColumn(value, F.coalesce(value, F.lit(0)))


def bait_sparsity(observed: DataFrame, grid: DataFrame, binsize: int) -> DataFrame:
    """Per bait and distance bin of the grid: other ends in all, seen, missing, and the missing share."""
    full = complete_grid(observed, grid, ("bait_id", "other_id"))
    out = full.groupBy("bait_id", F.floor(F.abs("distance") / binsize).alias("bin")).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("n") > 0).alias("seen"))
    missing = F.col("total") - F.col("seen")
    return out.withColumn("missing", missing).withColumn("missing_share", missing / F.col("total"))


def exclude_keys(df: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    return df.join(keys, list(on), "left_anti")


def restrict_to_keys(df: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    """The listed keys with what df has for them; keys that df lacks stay, with nulls."""
    return keys.select(*on).distinct().join(df, list(on), "left")


def max_log_p(scores: DataFrame) -> DataFrame:
    """Per pair the greatest log p over all samples, a sample without the pair counting as 0; negative ones only."""
    n = scores.agg(F.count_distinct("sample").alias("samples"))
    per = scores.groupBy("bait_id", "other_id").agg(F.max("log_p").alias("m"), F.count_distinct("sample").alias("k"))
    value = F.when(F.col("k") < F.col("samples"), F.greatest("m", F.lit(0.0))).otherwise(F.col("m"))
    return per.crossJoin(F.broadcast(n)).select("bait_id", "other_id", value.alias("log_p")).where("log_p < 0")


#: Upper ends of distance bins, geometric up to 1 Mb, then linear.
BREAKS = [0, 31_250, 62_500, 125_000, 250_000, 500_000, 1_000_000, *range(2_000_000, 17_000_000, 1_000_000)]


def distance_bin(distance: Column, breaks: list[int] | None = None) -> Column:
    """Number of the bin (from 1) of an absolute distance; null between chromosomes."""
    out = F.lit(0)
    for b in breaks or BREAKS:
        out = out + F.when(F.abs(distance) >= b, 1).otherwise(0)
    return F.when(distance.isNotNull(), out)


def observed_per_distance_bin(counts: DataFrame, subsets: int = 5) -> DataFrame:
    """Pairs and reads by bait subset (equal widths of the id range) and distance bin."""
    ends = counts.agg(F.min("bait_id").alias("lo"), F.max("bait_id").alias("hi"))
    part = F.least(F.floor((F.col("bait_id") - F.col("lo")) * subsets / (F.col("hi") - F.col("lo") + 1)), F.lit(subsets - 1)) + 1
    rows = counts.crossJoin(F.broadcast(ends)).select(part.alias("subset"), distance_bin(F.col("dist_sign")).alias("bin"), "n")
    return rows.groupBy("subset", "bin").agg(F.count(F.lit(1)).alias("pairs"), F.sum("n").alias("reads"))


def expected_per_distance_bin(frags: DataFrame, breaks: list[int]) -> DataFrame:
    """Pairs that lie in each distance bin by chromosome lengths, number of baits and mean fragment length."""
    chroms = frags.groupBy("chrom").agg(F.max("en").alias("size"), F.sum("is_bait").alias("baits"))
    mean = frags.agg(F.avg(F.col("en") - F.col("st")).alias("mean"))
    edges = F.explode(F.array(*[F.struct(F.lit(k + 1).alias("bin"), F.lit(a).alias("lo"), F.lit(b).alias("hi")) for k, (a, b) in enumerate(zip(breaks, breaks[1:]))])).alias("e")
    rows = chroms.crossJoin(F.broadcast(mean)).select("*", edges)
    reach = lambda d: F.least(d.cast("double"), F.col("size").cast("double"))
    area = lambda d: 2 * reach(d) - reach(d) * reach(d) / F.col("size")
    pairs = F.col("baits") * (area(F.col("e.hi")) - area(F.col("e.lo"))) / F.col("mean")
    return rows.groupBy(F.col("e.bin").alias("bin")).agg(F.sum(pairs).alias("expected"))


def contact_marginals(contacts: DataFrame) -> DataFrame:
    """Row and column sums of a symmetric matrix given by its entries (chrom, i, j, n); the diagonal counts once."""
    one = contacts.select("chrom", "i", "n")
    two = contacts.where("i <> j").select("chrom", F.col("j").alias("i"), "n")
    return one.unionByName(two).groupBy("chrom", "i").agg(F.sum("n").alias("total"))


def union_of_peaks(scores: DataFrame, cutoff: float) -> DataFrame:
    """Pairs that reach the cutoff in any sample."""
    return scores.groupBy("bait_id", "other_id").agg(F.max("score").alias("best")).where(F.col("best") >= cutoff)


def merge_samples(scores: DataFrame, samples: list[str], missing: float | None = 0.0) -> DataFrame:
    """One row per pair and a score column for each sample; `missing` where it has none."""
    wide = scores.groupBy("bait_id", "other_id").pivot("sample", samples).agg(F.first("score"))
    return wide if missing is None else wide.na.fill(missing, samples)


def annotate_interactions(df: DataFrame, frags: DataFrame) -> DataFrame:
    """Coordinates of both ends, the other end's name or a dot, and midpoint distance on one chromosome, rounded up."""
    side = lambda p: frags.select(F.col("frag_id").alias(f"{p}_id"), F.col("chrom").alias(f"{p}_chrom"), F.col("st").alias(f"{p}_st"), F.col("en").alias(f"{p}_en"), F.col("annotation").alias(f"{p}_name"), F.col("is_bait").alias(f"{p}_bait"))
    out = df.join(side("bait"), "bait_id").join(side("other"), "other_id")
    mid = lambda p: (F.col(f"{p}_st") + F.col(f"{p}_en")) / 2
    away = F.when(F.col("bait_chrom") == F.col("other_chrom"), F.ceil(mid("other") - mid("bait")))
    return out.withColumn("other_name", F.when(F.col("other_bait") == 1, F.col("other_name")).otherwise(".")).withColumn("distance", away).drop("other_bait", "bait_bait")


def sample_distances(scores: DataFrame) -> DataFrame:
    """Euclidean distance between samples over all pairs, an absent pair counting as 0.

    From inner products of shared pairs and squared norms, so pairs of one sample alone meet nothing.
    """
    cells = scores.select("bait_id", "other_id", "sample", "score")
    norms = cells.groupBy("sample").agg(F.sum(F.col("score") * F.col("score")).alias("norm"))
    other = cells.select("bait_id", "other_id", F.col("sample").alias("sample_b"), F.col("score").alias("score_b"))
    dots = cells.join(other, ["bait_id", "other_id"]).where("sample < sample_b").groupBy("sample", "sample_b").agg(F.sum(F.col("score") * F.col("score_b")).alias("dot"))
    two = norms.crossJoin(broadcast_if_small(norms.select(F.col("sample").alias("sample_b"), F.col("norm").alias("norm_b")))).where("sample < sample_b")
    square = F.col("norm") + F.col("norm_b") - 2 * F.coalesce("dot", F.lit(0.0))
    return two.join(dots, ["sample", "sample_b"], "left").select("sample", "sample_b", F.sqrt(F.greatest(square, F.lit(0.0))).alias("distance"))


def weight_by_distance(distance: Column, alpha: float, beta: float, gamma: float, delta: float) -> Column:
    """p(d) = (expit(delta) - expit(gamma)) expit(alpha + beta ln d) + expit(gamma)."""
    expit = lambda x: 1 / (1 + F.exp(-x))
    low, high = expit(F.lit(gamma)), expit(F.lit(delta))
    return (high - low) * expit(F.lit(alpha) + F.lit(beta) * F.log(F.abs(distance).cast("double"))) + low


def vaf_windows(values: DataFrame, size: int = 500_000, least: int = 20) -> DataFrame:
    """Tumbling windows of positions with more than `least` values: count, mean, quartiles."""
    out = values.groupBy("chrom", F.floor(F.col("pos") / size).alias("window"))
    return out.agg(F.count(F.lit(1)).alias("n"), F.avg("vaf").alias("mean"), F.percentile("vaf", F.lit(0.5)).alias("median")).where(F.col("n") > least)


def genome_order(df: DataFrame, contigs: DataFrame, *more: str) -> DataFrame:
    """df with `place`, its number in the order of the contigs (chrom, ord), then of more; unknown contigs are dropped."""
    known = df.join(broadcast_if_small(contigs.select("chrom", F.col("ord").alias("_ord"))), "chrom")
    return numbered(known, [F.col("_ord"), *map(F.col, more)]).select(*df.columns, "place")
