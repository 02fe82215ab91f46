"""Queries of sampling, models and kernels."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusweave.operators import balance, hic, kernels, models
from locusweave.operators.intervals import distance_band_join
from locusweave.queries import query


def _labelled(g):
    e = g.table("embeddings").join(g.table("labels").withColumnRenamed("doc_id", "vec_id"), "vec_id")
    return e.select("vec_id", "embedding", "label", "quality")


_LAB = "lab AS (SELECT e.vec_id, e.label, l.quality FROM embeddings e JOIN labels l ON e.vec_id = l.doc_id)"
_U = "CAST(('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 8)) AS UBIGINT) / 4294967296.0"


@query(
    "l02_balance_negatives",
    f"""WITH x AS (SELECT read_name, ref_start, mapq, cigar, sample, concat(read_name, ref_start, mapq, cigar) AS k, CAST(arm = 'control' AND mapq < 5 AS INT) AS y FROM fx_reads),
    c AS (SELECT sample, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM x GROUP BY 1), q AS (SELECT sample, floor(least(1.0, 2.0 * (SELECT sum(p) FROM c) / (SELECT sum(n) FROM c)) * n) AS quota FROM c),
    r AS (SELECT x.*, row_number() OVER (PARTITION BY sample ORDER BY {_U.format('k')}, k) AS i FROM x WHERE y = 0)
    SELECT sample, y, count(*) AS n FROM (SELECT sample, y FROM x WHERE y = 1 UNION ALL SELECT r.sample, y FROM r JOIN q ON r.sample = q.sample WHERE i <= quota) GROUP BY 1, 2""",
)
def _(g):
    rows = g.reads.withColumn("k", F.concat("read_name", "ref_start", "mapq", "cigar")).withColumn("y", ((F.col("arm") == "control") & (F.col("mapq") < 5)).cast("int"))
    return models.balance_negatives(rows, "k", "y", "sample", 2).groupBy("sample", "y").agg(F.count(F.lit(1)).alias("n"))


@query("l03_holdout_split", f"WITH {_LAB} SELECT vec_id, percent_rank() OVER (PARTITION BY quality ORDER BY {_U.format('vec_id')}, vec_id) > 0.8 AS held_out FROM lab")
def _(g):
    return models.holdout_split(_labelled(g), "vec_id", "quality").select("vec_id", "held_out")


_METRICS = """x AS (SELECT sample, mapq / 60.0 AS s, CAST(arm = 'edited' AS INT) AS y FROM fx_reads),
    r AS (SELECT *, rank() OVER (PARTITION BY sample ORDER BY s) + (count(*) OVER (PARTITION BY sample, s) - 1) / 2.0 AS mid FROM x)"""


@query(
    "l06_binary_metrics",
    f"""WITH {_METRICS} SELECT sample AS part, count(*) FILTER (y = 1) AS positives, count(*) FILTER (y = 0) AS negatives,
    round((sum(mid) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0) / (CAST(count(*) FILTER (y = 1) AS DOUBLE) * count(*) FILTER (y = 0)), 9) AS auc,
    count(*) FILTER (y = 1 AND s >= 0.7) AS tp, count(*) FILTER (y = 0 AND s >= 0.7) AS fp, round(count(*) FILTER (y = 1 AND s >= 0.7) / CAST(count(*) FILTER (s >= 0.7) AS DOUBLE), 9) AS precision,
    round(count(*) FILTER (y = 1 AND s >= 0.7) / CAST(count(*) FILTER (y = 1) AS DOUBLE), 9) AS recall,
    round(sum(up / CAST(seen AS DOUBLE)) FILTER (y = 1) / count(*) FILTER (y = 1), 9) AS average_precision,
    round(2.0 * count(*) FILTER (y = 1 AND s >= 0.7) / (count(*) FILTER (s >= 0.7) + count(*) FILTER (y = 1)), 9) AS f1
    FROM (SELECT *, sum(y) OVER w AS up, count(*) OVER w AS seen FROM r WINDOW w AS (PARTITION BY sample ORDER BY s DESC RANGE UNBOUNDED PRECEDING)) GROUP BY 1""",
)
def _(g):
    rows = g.reads.select("sample", (F.col("mapq") / 60.0).alias("s"), (F.col("arm") == "edited").cast("int").alias("y"))
    out = models.binary_metrics(rows, "s", "y", "sample")
    return out.select("part", "positives", "negatives", F.round("auc", 9).alias("auc"), "tp", "fp", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"), F.round("average_precision", 9).alias("average_precision"), F.round("f1", 9).alias("f1"))


@query("l04_train_classifier")
def _(g):
    rows = models.as_features(_labelled(g), "embedding")
    split = models.holdout_split(rows, "vec_id", "quality")
    model = models.train_classifier(split.where("not held_out"), ["features"], "quality", rounds=5, depth=3)
    return models.score_rows(model, split.where("held_out")).select("vec_id", "quality", F.round("score", 6).alias("score"))


@query("l05_leave_one_group_out")
def _(g):
    rows = models.as_features(_labelled(g), "embedding").withColumn("part", F.col("vec_id") % 2)
    out = models.leave_one_group_out(rows, "vec_id", "quality", "part", rounds=3, depth=2)
    return models.binary_metrics(out, "score", "quality", "part")


@query("l08_feature_importance")
def _(g):
    rows = models.as_features(_labelled(g), "embedding")
    return models.feature_importance(models.train_classifier(rows, ["features"], "quality", rounds=3, depth=3), g.spark)


@query("l12_matrix_balance")
def _(g):
    return balance.matrix_balance(g.contacts)


@query("l12_genome_balance")
def _(g):
    contacts = g.table("orders").groupBy(
        F.concat(F.lit("c"), F.col("o_custkey") % 3).alias("chr1"), (F.col("o_custkey") % 40).alias("mid1"), F.concat(F.lit("c"), F.col("o_orderkey") % 3).alias("chr2"), (F.col("o_orderkey") % 40).alias("mid2")
    )
    return balance.genome_balance(contacts.agg(F.count(F.lit(1)).alias("n")))


@query("w04_greedy_bins")
def _(g):
    return kernels.greedy_bins(g.frags, 10_000)


@query("a31_vaf_peaks")
def _(g):
    total = F.col("alt_reads") + F.col("ref_reads")
    return kernels.vaf_peaks(g.variants.where(total > 0).select("chrom", (F.col("pos") * 1000).alias("pos"), (F.col("alt_reads") / total).alias("vaf")))


@query("t24_repeat_context")
def _(g):
    seq = F.translate(F.upper("p_name"), "BDEFHIJKLMNOPQRSUVWXYZ ", "ACGTACGTACGTACGTACGTACG")
    return kernels.repeat_contexts(g.table("part").select("p_partkey", seq.alias("seq"), (F.col("p_partkey") % 8).cast("int").alias("at")))


@query("l13_fit_distance_curve")
def _(g):
    seen = hic.bait_sparsity(hic.count_fragment_pairs(g.pairs, g.frags), distance_band_join(g.frags, 200_000), 20_000)
    bins = seen.groupBy((F.col("bait_id") % 3).alias("subset"), ((F.col("bin") + 1) * 20_000).alias("distance")).agg(F.sum("seen").alias("seen"), F.sum("total").alias("total"))
    return kernels.fit_distance_curve(bins)
