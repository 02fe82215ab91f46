"""Sampling, training and evaluation of read classifiers.

Randomness comes from md5 of keys, so reruns and other engines agree.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.operators.ranks import first_rows, running_sums
from locusweave.plans.scratch import saved
from locusweave.plans.size import broadcast_if_small


def uniform(key: Column) -> Column:
    """A number in [0, 1) from the md5 of a key."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)


def balance_negatives(df: DataFrame, key: str, label: str, by: str, ratio: int, most: int | None = None) -> DataFrame:
    """All positives, and ratio times as many negatives, shared among groups in proportion to their negatives.

    Within a group the negatives with the least hashes stay, `most` of them at most; quotas round down.
    """
    counts = df.groupBy(by).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    totals = counts.agg(F.sum("p").alias("tp"), F.sum("n").alias("tn"))
    quota = counts.crossJoin(F.broadcast(totals)).select(by, F.floor(F.least(F.lit(1.0), F.col("tp") * ratio / F.col("tn")) * F.col("n")).alias("quota"), "n")
    quota = quota if most is None else quota.withColumn("quota", F.least("quota", F.lit(most)))
    negatives = df.where(F.col(label) == 0)
    kept = first_rows(negatives, by, uniform(F.col(key)), key, saved(quota, "quotas"), "_first").where("_first").select(*df.columns)
    return df.where(F.col(label) == 1).unionByName(kept)


def sample_negatives(df: DataFrame, key: str, label: str, fraction: float) -> DataFrame:
    """All positives, and each negative with the chance `fraction` by the hash of its key; a plain filter."""
    return df.where((F.col(label) == 1) | ((F.col(label) == 0) & (uniform(F.col(key)) < fraction)))


def holdout_split(df: DataFrame, key: str, label: str, share: float = 0.2) -> DataFrame:
    """df with `held_out`: the rows of each label whose hash ranks in the last `share`."""
    last = F.col("n") - 1
    place = F.floor(last * (1 - share))
    place = F.when((place + 1) / F.nullif(last, F.lit(0)) <= 1 - share, place + 1).otherwise(place)
    quotas = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).select(label, (place + 1).alias("quota"), "n")
    out = first_rows(df, label, uniform(F.col(key)), key, saved(quotas, "quotas"), "_first")
    return out.select(*df.columns, (~F.col("_first")).alias("held_out"))


def holdout_groups(df: DataFrame, individuals: list | None = None, gene_parts: list[str] | None = None, individual: str = "individual_id", gene: str = "gene") -> DataFrame:
    """df with `held_out`: rows of the listed individuals, and rows whose gene holds one of the listed strings."""
    mine = F.col(individual).isin(*individuals) if individuals else F.lit(False)
    for part in gene_parts or []:
        mine = mine | F.coalesce(F.col(gene).contains(part), F.lit(False))
    return df.withColumn("held_out", F.coalesce(mine, F.lit(False)))


def binary_metrics(df: DataFrame, score: str, label: str, by: str | None = None, threshold: float = 0.7) -> DataFrame:
    """ROC-AUC by mid-ranks, average precision, precision, recall, F1 and counts, overall or by group.

    Equal scores are first made one row each with their counts; running sums over them go piece by piece, so that no task
    holds a group's scores.
    """
    groups = [F.lit("all").alias("part")] if by is None else [F.col(by).alias("part")]
    cells = df.groupBy(*groups, F.col(score).alias("s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    cells = running_sums(cells, ["part"], [F.col("s").asc_nulls_last()], {"_p": F.col("p"), "_n": F.col("n")})
    totals = cells.groupBy("part").agg(F.sum("p").alias("_tp"), F.sum("n").alias("_tn"))
    cells = cells.join(broadcast_if_small(totals.withColumnRenamed("part", "_part")), F.col("part").eqNullSafe(F.col("_part")))
    cells = cells.withColumn("below", F.col("_n") - F.col("n")).withColumn("cp", F.col("_tp") - F.col("_p") + F.col("p"))
    cells = cells.withColumn("ct", F.col("cp") + F.col("_tn") - F.col("_n") + F.col("n"))
    hit = F.col("s") >= threshold
    out = cells.groupBy("part").agg(
        F.sum("p").alias("positives"), F.sum("n").alias("negatives"), F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)).alias("_u"), F.sum(F.col("p") * F.col("cp") / F.col("ct")).alias("_ap"),
        F.sum(F.when(hit, F.col("p")).otherwise(0)).alias("tp"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("fp"),
    )
    safe = lambda a, b: F.when(b > 0, a / b)
    precision, recall = safe(F.col("tp"), F.col("tp") + F.col("fp")), safe(F.col("tp"), F.col("positives"))
    return out.select(
        "part", "positives", "negatives", safe(F.col("_u"), F.col("positives") * F.col("negatives")).alias("auc"), safe(F.col("_ap"), F.col("positives")).alias("average_precision"),
        "tp", "fp", precision.alias("precision"), recall.alias("recall"), safe(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("positives") - F.col("tp")).alias("f1"),
    )


def train_classifier(df: DataFrame, features: list[str], label: str, rounds: int = 20, depth: int = 4, rate: float = 0.1, subsample: float = 0.8, seed: int = 1) -> PipelineModel:
    """Boosted trees with positives weighted by negatives over positives; an array column may stand for the features."""
    n = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    weight = F.when(F.col(label) == 1, n["n"] / max(1, n["p"])).otherwise(1.0)
    trees = GBTClassifier(featuresCol="features", labelCol=label, weightCol="_w", maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=subsample, seed=seed)
    stages = [trees] if features == ["features"] else [VectorAssembler(inputCols=features, outputCol="features"), trees]
    return Pipeline(stages=stages).fit(df.withColumn("_w", weight))


def score_rows(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("score", vector_to_array("probability")[1]).drop("probability", "rawPrediction", "prediction")


def score_reads(model: PipelineModel, reads: DataFrame, features: list[str]) -> DataFrame:
    """Reads with `score`, their probability by the model; features that are null, or that reads lack, count as 0."""
    filled = reads.select("*", *[F.lit(0.0).alias(f) for f in features if f not in reads.columns]).na.fill(0, features)
    return score_rows(model, filled).drop("features")


def as_features(df: DataFrame, array: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(array).cast("array<double>")))


def leave_one_group_out(df: DataFrame, key: str, label: str, by: str, **how) -> DataFrame:
    """Scores of each group by a model of the others; groups of one class, or that leave one, are skipped."""
    groups = [r[0] for r in df.groupBy(by).agg(F.count_distinct(label).alias("k")).where("k > 1").select(by).orderBy(by).collect()]
    out = None
    for g in groups:
        model = train_classifier(df.where(F.col(by) != F.lit(g)), ["features"], label, **how)
        part = score_rows(model, df.where(F.col(by) == F.lit(g))).select(key, by, label, "score")
        out = part if out is None else out.unionByName(part)
    return out


def feature_importance(model: PipelineModel, spark) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "feature int, importance double")
