"""Places, quotas, quantiles and running sums over groups of any size, without a window over a whole group.

Tables are dealt by ranges of the order into pieces; sums over pieces, one row each, are added to those inside pieces.
For order statistics values are counted in cells, and only the cell that holds the place is looked into, by finer cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locusweave.plans.scratch import saved
from locusweave.plans.size import broadcast_if_small

#: Cells into which a group, or a cell of it, is cut.
CELLS = 1024


def _pieces(df: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """df with `_piece`, written: rows of earlier pieces come before those of later ones in the order of by and order."""
    dealt = df.repartitionByRange(*[F.col(c) for c in by], *order)
    return saved(dealt.withColumn("_piece", F.spark_partition_id()), name)


def running_sums(df: DataFrame, by: list[str], order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """df with, for each name in sums, the sum of its column over the rows of the same `by` up to the row itself."""
    rows = _pieces(df.select("*", *[c.alias(f"_s_{n}") for n, c in sums.items()]), by, order, "running")
    pieces = rows.groupBy(*by, "_piece").agg(*[F.sum(f"_s_{n}").alias(f"_t_{n}") for n in sums])
    # One row for each group and piece that has rows of it.
    over = W.partitionBy(*by).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select(*[F.col(c).alias(f"_k_{c}") for c in [*by, "_piece"]], *[F.coalesce(F.sum(f"_t_{n}").over(over), F.lit(0)).alias(f"_b_{n}") for n in sums])
    same = F.col("_piece") == F.col("_k__piece")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    inside = W.partitionBy(*by, "_piece").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.select("*", *[F.sum(f"_s_{n}").over(inside).alias(f"_o_{n}") for n in sums])
    out = rows.join(broadcast_if_small(pieces), same)
    return out.select(*df.columns, *[(F.col(f"_o_{n}") + F.col(f"_b_{n}")).alias(n) for n in sums])


def numbered(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """df with its place from 1 in the order, over the whole table; the order must tell rows apart for stable places."""
    rows = _pieces(df, [], order, "numbered")
    sizes = rows.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    # One row for each piece.
    before = F.sum("_n").over(W.orderBy("_piece").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")
    sizes = sizes.select(F.col("_piece").alias("_p"), before.alias("_before"))
    own = F.row_number().over(W.partitionBy("_piece").orderBy(*order))
    out = rows.withColumn("_own", own).join(broadcast_if_small(sizes), F.col("_piece") == F.col("_p"))
    return out.select(*df.columns, (F.col("_before") + F.col("_own")).alias(name))


def order_statistic(df: DataFrame, by: str, value: Column, places: DataFrame, cells: int = CELLS) -> DataFrame:
    """places(by, at) -> by, value, tie: the value at place `at` (from 0) of each group's sorted values, and its place among equal ones.

    Values are numbers without nulls; a group's place must be less than its size. Each round cuts the range that holds
    the place into `cells` pieces and keeps one of them, until the range is a single value.
    """
    rows = df.select(F.col(by).alias("_by"), value.cast("double").alias("_v"))
    ranges = rows.groupBy("_by").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    wanted = places.select(F.col(by).alias("_of"), F.col("at").cast("long").alias("_at"))
    ranges = saved(ranges.join(wanted, F.col("_by").eqNullSafe(F.col("_of"))).drop("_of"), "rank-range")
    done = None
    while True:
        ended = ranges.where("_lo = _hi").select("_by", F.col("_lo").alias("value"), F.col("_at").alias("tie"))
        done = ended if done is None else done.unionByName(ended)
        ranges = ranges.where("_lo < _hi")
        if ranges.isEmpty():
            return done.withColumnRenamed("_by", by)
        own = broadcast_if_small(ranges.withColumnRenamed("_by", "_of"))
        inside = rows.join(own, F.col("_by").eqNullSafe(F.col("_of"))).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        piece = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * cells), F.lit(cells - 1))
        counts = inside.groupBy("_by", "_at", piece.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        upto = F.sum("_n").over(W.partitionBy("_by").orderBy("_cell"))
        counts = counts.withColumn("_upto", upto).where((F.col("_upto") > F.col("_at")) & (F.col("_upto") - F.col("_n") <= F.col("_at")))
        ranges = saved(counts.select("_by", (F.col("_at") - F.col("_upto") + F.col("_n")).alias("_at"), "_lo", "_hi"), "rank-range")


def first_rows(df: DataFrame, by: str, value: Column, tie: str, quotas: DataFrame, name: str = "first") -> DataFrame:
    """df with a column that is true for the first `quota` rows of each group by value, then by the column tie.

    quotas(by, quota, n), saved: n is the group's size. All other groups have none. Only rows that share the value at
    the quota's end are put in order.
    """
    quotas = quotas.select(F.col(by).alias("_q_by"), F.col("quota").cast("long").alias("_quota"), F.col("n").alias("_n"))
    cut = quotas.where("_quota > 0 and _quota < _n").select(F.col("_q_by").alias(by), (F.col("_quota") - 1).alias("at"))
    edges = order_statistic(df, by, value, cut).select(F.col(by).alias("_e_by"), F.col("value").alias("_edge"), F.col("tie").alias("_tie"))
    limits = saved(quotas.join(edges, F.col("_q_by").eqNullSafe(F.col("_e_by")), "left").drop("_e_by"), "rank-edges")
    rows = df.withColumn("_v", value.cast("double")).join(broadcast_if_small(limits), F.col(by).eqNullSafe(F.col("_q_by")), "left")
    at_edge = F.coalesce(F.col("_v") == F.col("_edge"), F.lit(False))
    clear = F.coalesce(F.when(F.col("_edge").isNull(), F.col("_quota") >= F.col("_n")).otherwise(F.col("_v") < F.col("_edge")), F.lit(False))
    tied = F.row_number().over(W.partitionBy(by).orderBy(tie)) <= F.col("_tie") + 1
    out = rows.where(~at_edge).withColumn(name, clear).unionByName(rows.where(at_edge).withColumn(name, tied))
    return out.select(*df.columns, name)
