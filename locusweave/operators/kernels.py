"""Operators whose logic is a numeric or ordered loop over one bounded group.

Groups are windows of values, runs of fragments or bins of a curve; each is what one task holds.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locusweave.operators.intervals import placed_in_order
from locusweave.plans.scratch import saved
from locusweave.plans.size import broadcast_if_small

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _next_mark(rows: DataFrame, x: str, marks: DataFrame, chunk: int, name: str) -> DataFrame:
    """rows with the value of the first mark (chrom, x, value) at or behind their x on the chromosome, or null.

    Chunk by chunk, with the first mark of later chunks from a table of one row a chunk.
    """
    of = F.floor(F.col(x) / chunk).alias("_chunk")
    ends = marks.groupBy("chrom", F.floor(F.col("x") / chunk).alias("_chunk")).agg(F.min_by("value", "x").alias("_first"))
    used = rows.select("chrom", of).union(ends.select("chrom", "_chunk")).distinct().join(ends, ["chrom", "_chunk"], "left")
    later = W.partitionBy("chrom").orderBy(F.desc("_chunk")).rowsBetween(W.unboundedPreceding, -1)
    later = used.select("chrom", "_chunk", F.last("_first", True).over(later).alias("_later"))
    both = rows.withColumn("_x", F.col(x)).withColumn("_mark", F.lit(None).cast("long")).unionByName(
        marks.select("chrom", F.col("x").alias("_x"), F.col("value").alias("_mark")), allowMissingColumns=True
    ).withColumn("_chunk", F.floor(F.col("_x") / chunk))
    # Backwards, so that the next mark is the last one seen; of equal places marks come first.
    back = W.partitionBy("chrom", "_chunk").orderBy(F.desc("_x"), F.col("_mark").desc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)
    both = both.withColumn("_next", F.last("_mark", True).over(back)).where(F.col("_mark").isNull())
    return both.join(later, ["chrom", "_chunk"], "left").select(*rows.columns, F.coalesce("_next", "_later").alias(name))


#: Fragments that one task folds.
FOLDED = 4_096


def greedy_bins(frags: DataFrame, size: int, solitary: bool = True, folded: int = FOLDED) -> DataFrame:
    """Adjacent fragments gathered until their span reaches `size`; baited ones stay alone unless told otherwise.

    Fragments of a chromosome do not overlap. Where a bin that starts at a fragment ends follows from an as-of search
    for the first fragment that ends far enough away, and for the next bait. Runs of `folded` fragments turn these
    pointers into jumps to where a run is left, and jumps are doubled until the chain of each chromosome is known, so no
    task holds a chromosome. Bins are numbered over all chromosomes in name order. Gives chrom, frag_id, bin.
    """
    ranked = placed_in_order(frags.select("chrom", F.col("st").cast("long").alias("st"), F.col("en").cast("long").alias("en"), "frag_id", (F.col("is_bait") == 1).alias("bait")), "frag_id")
    ranked = saved(ranked.withColumn("bait", F.coalesce("bait", F.lit(False)) & F.lit(solitary)).withColumn("rank", F.col("rank").cast("long")), "bins-ranked")
    far = ranked.withColumn("_far", F.col("st") + size).withColumn("_behind", F.col("rank") + 1)
    far = _next_mark(far, "_far", ranked.select("chrom", F.col("en").alias("x"), F.col("rank").alias("value")), 64 * size, "_enough")
    far = _next_mark(far, "_behind", ranked.where("bait").select("chrom", F.col("rank").alias("x"), F.col("rank").alias("value")), folded, "_bait")
    end = F.lit(1 << 62)
    onward = F.when(F.col("bait"), F.col("_behind")).otherwise(F.least(F.coalesce(F.col("_enough") + 1, end), F.coalesce("_bait", end)))
    run = F.floor((F.col("rank") - 1) / folded).alias("run")
    steps = saved(far.select("chrom", "frag_id", "rank", run, onward.alias("onward")), "bins-steps")

    def leave(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        first, onward = int(pdf["rank"].iloc[0]), pdf["onward"].tolist()
        leaves, n = onward.copy(), [1] * len(onward)
        for i in range(len(onward) - 1, -1, -1):
            k = onward[i] - first
            if k < len(onward):
                leaves[i], n[i] = leaves[k], n[k] + 1
        return pdf[["chrom", "rank", "run"]].assign(leaves=leaves, n=n)

    jumps = saved(steps.groupBy("chrom", "run").applyInPandas(leave, "chrom string, rank long, run long, leaves long, n long"), "bins-jumps")
    own = jumps
    reached = saved(jumps.where("rank = 1").select("chrom", "rank", F.lit(0).cast("long").alias("bins")), "bins-reached")
    runs = (steps.agg(F.max("run")).first()[0] or 0) + 1
    for _ in range(int(runs - 1).bit_length()):
        more = reached.join(jumps, ["chrom", "rank"]).select("chrom", F.col("leaves").alias("rank"), (F.col("bins") + F.col("n")).alias("bins"))
        reached = saved(reached.unionByName(more.where(F.col("rank") < end)), "bins-reached")
        next_ = jumps.select("chrom", F.col("rank").alias("leaves"), F.col("leaves").alias("_leaves"), F.col("n").alias("_n"))
        both = jumps.join(next_, ["chrom", "leaves"], "left")
        jumps = saved(both.select("chrom", "rank", F.coalesce("_leaves", "leaves").alias("leaves"), (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n")), "bins-jumps")
    entered = reached.join(own, ["chrom", "rank"]).select("chrom", "run", F.col("rank").alias("enters"), "bins", (F.col("bins") + F.col("n")).alias("_upto"))
    # One row a run; a run inside one long bin is never entered.
    held = W.partitionBy("chrom").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    table = steps.select("chrom", "run").distinct().join(entered, ["chrom", "run"], "left")
    table = table.select("chrom", "run", "enters", F.coalesce("bins", F.last("_upto", True).over(held)).alias("bins"))

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        first, onward, enters = int(pdf["rank"].iloc[0]), pdf["onward"].tolist(), pdf["enters"].iloc[0]
        starts = np.zeros(len(onward), np.int64)
        i = len(onward) if pd.isna(enters) else int(enters) - first
        while i < len(onward):
            starts[i] = 1
            i = onward[i] - first
        return pdf[["chrom", "frag_id"]].assign(bin=int(pdf["bins"].iloc[0]) + np.cumsum(starts))

    bins = steps.join(broadcast_if_small(table), ["chrom", "run"])
    bins = saved(bins.groupBy("chrom", "run").applyInPandas(count, "chrom string, frag_id long, bin long"), "bins")
    counts = bins.groupBy("chrom").agg(F.max("bin").alias("k"))
    offset = counts.withColumn("before", F.coalesce(F.sum("k").over(W.orderBy("chrom").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return bins.join(broadcast_if_small(offset.select("chrom", "before")), "chrom").select("chrom", "frag_id", (F.col("bin") + F.col("before")).alias("bin"))


def vaf_peaks(values: DataFrame, size: int = 500_000, least: int = 20, width: float = 0.05, grid: int = 101) -> DataFrame:
    """Local maxima of a Gaussian density of vaf in each tumbling window with more than `least` values.

    Values are first counted on the grid, so a window's task holds the grid and not its values.
    """
    cell = F.round(F.greatest(F.least("vaf", F.lit(1.0)), F.lit(0.0)) * (grid - 1)).cast("int")
    cells = values.groupBy("chrom", F.floor(F.col("pos") / size).alias("window"), cell.alias("cell")).agg(F.count(F.lit(1)).alias("k"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.linspace(0, 1, grid)
        weights = np.bincount(pdf["cell"], pdf["k"], grid)
        density = np.exp(-0.5 * ((x[:, None] - x[None, :]) / width) ** 2) @ weights / (weights.sum() * width * np.sqrt(2 * np.pi))
        padded = np.concatenate([[-1.0], density, [-1.0]])
        top = np.flatnonzero((padded[1:-1] > padded[:-2]) & (padded[1:-1] >= padded[2:])) if weights.sum() > least else np.zeros(0, int)
        return pd.DataFrame({"chrom": pdf["chrom"].iloc[0], "window": pdf["window"].iloc[0], "vaf": x[top], "density": density[top]})

    return cells.groupBy("chrom", "window").applyInPandas(run, "chrom string, window long, vaf double, density double")


def repeat_context(seq: pd.Series, at: pd.Series) -> pd.DataFrame:
    """Homopolymer of five or more at a place, and the distance to the nearest tandem repeat (999 if none)."""
    import re

    runs, repeats = re.compile(r"([ACGT])\1{4,}"), [re.compile(rf"([ACGT]{{{k}}})\1{{3,}}") for k in range(1, 7)]
    homo, near = [], []
    for s, i in zip(seq.fillna(""), at):
        homo.append(any(m.start() <= i < m.end() for m in runs.finditer(s)))
        gaps = [0 if m.start() <= i < m.end() else min(abs(m.start() - i), abs(m.end() - 1 - i)) for r in repeats for m in r.finditer(s)]
        near.append(min(gaps, default=999))
    return pd.DataFrame({"homopolymer": homo, "repeat_distance": near})


def repeat_contexts(sites: DataFrame) -> DataFrame:
    """sites(chrom, pos, seq, at) with homopolymer and repeat_distance; one call per distinct window."""
    call = F.pandas_udf(repeat_context, "homopolymer boolean, repeat_distance int")
    one = sites.select("seq", "at").distinct().withColumn("_r", call("seq", "at"))
    out = sites.join(one, ["seq", "at"])
    return out.select(*sites.columns, "_r.homopolymer", "_r.repeat_distance")


def _simplex(loss, x0: np.ndarray, steps: int = 400) -> np.ndarray:
    """Nelder and Mead."""
    points = [x0] + [x0 + d for d in np.eye(len(x0)) * 0.5]
    values = [loss(p) for p in points]
    for _ in range(steps):
        order = np.argsort(values)
        points, values = [points[i] for i in order], [values[i] for i in order]
        middle = np.mean(points[:-1], 0)
        tried = middle + (middle - points[-1])
        value = loss(tried)
        if value < values[0]:
            far = middle + 2 * (middle - points[-1])
            v = loss(far)
            points[-1], values[-1] = (far, v) if v < value else (tried, value)
        elif value < values[-2]:
            points[-1], values[-1] = tried, value
        else:
            inner = middle + 0.5 * (points[-1] - middle)
            v = loss(inner)
            if v < values[-1]:
                points[-1], values[-1] = inner, v
            else:
                points = [points[0]] + [points[0] + 0.5 * (p - points[0]) for p in points[1:]]
                values = [values[0]] + [loss(p) for p in points[1:]]
    return points[int(np.argmin(values))]


def fit_distance_curve(bins: DataFrame) -> DataFrame:
    """bins(subset, distance, seen, total) -> the four parameters of a bounded logistic in log distance, per subset.

    Binomial likelihood, the simplex run twice; a subset holds one row per distance bin.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        d, k, n = np.log(pdf["distance"].to_numpy(float)), pdf["seen"].to_numpy(float), pdf["total"].to_numpy(float)
        expit = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))

        def loss(t):
            p = np.clip((expit(t[3]) - expit(t[2])) * expit(t[0] + t[1] * d) + expit(t[2]), 1e-9, 1 - 1e-9)
            return -float((k * np.log(p) + (n - k) * np.log(1 - p)).sum())

        x = np.array([5.0, -0.5, -4.0, 0.0])
        for _ in range(2):
            x = _simplex(loss, x)
        return pd.DataFrame({"subset": [pdf["subset"].iloc[0]], "alpha": x[0], "beta": x[1], "gamma": x[2], "delta": x[3], "loss": loss(x)})

    return bins.groupBy("subset").applyInPandas(run, "subset long, alpha double, beta double, gamma double, delta double, loss double")


def infix_distance(pattern: str, text: str) -> int:
    """Least edit distance of the pattern to any part of the text."""
    row = np.arange(len(pattern) + 1)
    least = row[-1]
    letters = np.frombuffer(pattern.encode(), np.uint8)
    for c in text.encode():
        diagonal = row[:-1] + (letters != c)
        new = np.empty_like(row)
        new[0] = 0
        new[1:] = np.minimum(diagonal, row[1:] + 1)
        steps = np.arange(len(row))
        row = np.minimum.accumulate(new - steps) + steps  # insertions along the pattern
        least = min(least, row[-1])
    return int(least)


def control_support(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Control reads that fit an event's alternate contig better than the reference.

    reads(event, read_name, seq), contigs(event, alt_contig, ref_contig). An exact part of one contig alone decides in
    SQL; only reads that are a part of neither are aligned, once per distinct pair. Gives event, support, reads.
    """
    met = reads.join(contigs, "event")
    in_alt, in_ref = F.contains("alt_contig", "seq"), F.contains("ref_contig", "seq")
    sure = met.where(in_alt | in_ref).select("event", (in_alt & ~in_ref).cast("int").alias("fits"))

    @F.pandas_udf("int")
    def nearer(seq: pd.Series, alt: pd.Series, ref: pd.Series) -> pd.Series:
        return pd.Series([int(infix_distance(s, a) < infix_distance(s, r)) for s, a, r in zip(seq, alt, ref)], dtype="int32")

    open_ = met.where(~(in_alt | in_ref))
    pairs = open_.groupBy("event", "seq", "alt_contig", "ref_contig").agg(F.count(F.lit(1)).alias("k"))
    aligned = pairs.select("event", "k", nearer("seq", "alt_contig", "ref_contig").alias("fits"))
    both = sure.select("event", "fits", F.lit(1).cast("long").alias("k")).unionByName(aligned)
    return both.groupBy("event").agg(F.sum(F.col("fits") * F.col("k")).alias("support"), F.sum("k").alias("reads"))
