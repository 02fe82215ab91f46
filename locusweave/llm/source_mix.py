"""Mixing sources to target weights with hash-threshold histograms (DataFrame operations only).

Every document has a fixed hash of nine hexadecimal digits. For each source the sizes are summed by the first three
digits; a running sum finds the bucket in which the budget ends, only that bucket is summed again by six and then by
nine digits, and the documents under the resulting threshold are kept by a plain filter. Nothing sorts documents.

A source whose target exceeds its size is taken whole once; the threshold then chooses what is taken a second time,
so thresholds are nested: a larger budget keeps all that a smaller one keeps.

Defined cases: null text has size 0; null sources form one source, last in order; rows that repeat a doc_id share a
hash and are kept or left together; a null doc_id hashes like an empty one; an empty table gives an empty result;
when all sizes are 0, all targets are 0. Extra columns of the input are ignored by `mix_table` and kept by `mix`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locusweave.llm.common import saved, unused, word_count

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_REPEATS = 2
DIGITS = (3, 6, 9)
#: With more sources than this, thresholds are joined by a shuffle and not broadcast.
BROADCAST_SOURCES = 10_000


def targets(sources: DataFrame, weights=WEIGHTS, share_percent=SHARE_PERCENT, repeats=MOST_REPEATS) -> DataFrame:
    """sources(source, source_size) -> with weight and target; one row per source.

    The budget is share_percent of all sizes. A source stops at `repeats` times its size and its excess goes to the
    others by weight. In the order of cap / weight, a source is capped exactly if its cap is at most what its weight
    earns of the budget that the sources before it leave; all comparisons are on whole numbers.
    """
    base = 1
    for w in set(weights):
        base *= w
    order = W.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (place + 1).cast("int"))
    filled = (
        sources.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * repeats)
        .withColumn("_o", F.expr(f"cap * {base} div weight"))
    )
    by_level = W.orderBy("_o", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, W.unboundedFollowing)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    filled = (
        filled.withColumn("_c", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("_w", F.sum("weight").over(after))
        .withColumn("_s", F.sum("source_size").over(everything))
        .withColumn("_left", F.col("_s") * share_percent - F.col("_c") * 100)
        .withColumn("_capped", F.col("cap") * 100 * F.col("_w") <= F.col("weight") * F.col("_left"))
    )
    first = F.min(F.when(~F.col("_capped"), F.struct("_o", F.col("source").isNull(), "source", "_left", "_w")))
    filled = filled.withColumn("_first", first.over(everything))
    level = F.col("weight") * F.col("_first._left") / (F.col("_first._w") * 100)
    target = F.when(F.col("_capped"), F.col("cap").cast("double")).otherwise(level)
    return filled.select("source", "source_size", "weight", target.alias("target"))


def _thresholds(sizes: DataFrame, aims: DataFrame) -> DataFrame:
    """One row per source: `whole`, how often all of it is taken, and `cut`: hashes below it are taken once more."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    edge = saved(
        aims.withColumn("whole", whole.cast("long"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("prefix", F.lit(""))
        .withColumn("below", F.lit(0).cast("long"))
        .withColumn("upto", F.col("source_size")),
        "mix-edge",
    )
    for digits, shorter in zip(DIGITS, (0, *DIGITS)):
        e = edge.select(F.col("source").alias("_s"), F.col("prefix").alias("_p"), F.col("below"), F.col("rest"))
        inside = F.substring("hash", 1, shorter) == F.col("_p") if shorter else F.lit(True)
        near = _join_sources(sizes, e, F.col("source").eqNullSafe(F.col("_s")) & inside)
        sums = near.groupBy("source", F.substring("hash", 1, digits).alias("prefix")).agg(
            F.sum("size").alias("n"), F.first("below").alias("below"), F.first("rest").alias("rest")
        )
        run = W.partitionBy("source").orderBy("prefix").rowsBetween(W.unboundedPreceding, 0)
        sums = sums.withColumn("upto", F.col("below") + F.sum("n").over(run)).withColumn("below", F.col("upto") - F.col("n"))
        found = sums.where((F.col("below") <= F.col("rest")) & (F.col("rest") < F.col("upto")))
        found = found.select(F.col("source").alias("_s"), "prefix", "below", "upto")
        kept = edge.select("source", "source_size", "target", "whole", "rest")
        edge = saved(
            kept.join(found, kept["source"].eqNullSafe(found["_s"]), "left").drop("_s"), f"mix-edge{digits}"
        )
    closer = F.col("upto") - F.col("rest") < F.col("rest") - F.col("below")
    cut = F.when(F.col("prefix").isNull(), F.lit("")).when(closer, F.concat("prefix", F.lit("g"))).otherwise(F.col("prefix"))
    return edge.select("source", "source_size", "target", "whole", cut.alias("cut"))


def _join_sources(rows: DataFrame, small: DataFrame, on) -> DataFrame:
    """Join with a table that has one row per source: broadcast while that is a few rows, else by a shuffle."""
    few = small.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(small) if few else small, on)


def _hash(doc_id):
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, max(DIGITS))


def _cuts(docs: DataFrame, weights: tuple, share_percent: int, repeats: int) -> tuple[DataFrame, DataFrame]:
    """sizes(doc_id, source, size, hash), a row per document, and the thresholds by source, here named _s."""
    sizes = saved(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _hash(F.col("doc_id")).alias("hash")),
        "mix-sizes",
    )
    sources = saved(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    cuts = _thresholds(sizes, targets(sources, weights, share_percent, repeats))
    return sizes, saved(cuts.withColumnRenamed("source", "_s"), "mix-cuts")


def mix_table(docs: DataFrame, weights=WEIGHTS, share_percent=SHARE_PERCENT, repeats=MOST_REPEATS) -> DataFrame:
    """docs(doc_id, text, source) -> doc_id, size, source_size, target, copies, taken; a row per document."""
    sizes, cuts = _cuts(docs, weights, share_percent, repeats)
    out = _join_sources(sizes, cuts, F.col("source").eqNullSafe(F.col("_s")))
    copies = F.col("whole") + (F.col("hash") < F.col("cut")).cast("long")
    return out.select(
        "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, weights=WEIGHTS, share_percent=SHARE_PERCENT, repeats=MOST_REPEATS) -> DataFrame:
    """The mixed documents: each row of docs as often as its own id and source say, with all its columns."""
    _, cuts = _cuts(docs, weights, share_percent, repeats)
    of, all_of_it, upto, copy = unused(docs, "of", "all_of_it", "upto", "copy")
    cuts = cuts.select(F.col("_s").alias(of), F.col("whole").alias(all_of_it), F.col("cut").alias(upto))
    both = _join_sources(docs, cuts, docs["source"].eqNullSafe(F.col(of)))
    copies = F.col(all_of_it) + (_hash(docs["doc_id"]) < F.col(upto)).cast("long")
    again = F.explode(F.array_repeat(F.lit(1), copies.cast("int")))
    return both.select(*[docs[c] for c in docs.columns], again.alias(copy)).drop(copy)
