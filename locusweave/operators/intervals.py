"""Interval algebra: overlap, nearest and distance joins, clusters and coverage.

Intervals are half-open [st, en) on chrom. Joins go through bins of several widths: an interval is dealt to the one or
two bins that it touches at the narrowest width that is as long as itself, so a segment of a whole chromosome makes no
more rows than a read. Two intervals meet at the wider one's width, in the first bin that both touch, so a pair appears
once without a distinct. Chromosomes alone never key a join or a window, since a few of them hold most rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locusweave.plans.size import broadcast_if_small

#: The narrowest bins, how many times wider the next ones are (a power of two), and how many widths there are.
BIN, WIDER, WIDTHS = 1024, 32, 5
#: Positions of a chunk, when intervals are chained or put in order chunk by chunk.
CHUNK = 1 << 20


def _level(st: str, en: str, width: int) -> str:
    """SQL: number of the narrowest bin width that is as long as the interval."""
    longer = [f"WHEN {en} - {st} > {width * WIDER ** (k - 1)} THEN {k}" for k in range(WIDTHS - 1, 0, -1)]
    return f"CASE {' '.join(longer)} ELSE 0 END"


def _dealt(df: DataFrame, st: str, en: str, width: int, slots: str) -> DataFrame:
    """df with a row for each bin that its interval touches at the widths of its slots: `_bin`, and `_first`, is it the first of them?

    slots is SQL for an array of slots, twice the number of a width plus a tag that tells apart what keys are for. A key
    holds bin and slot. Only at the widest width can an interval touch more than two bins.
    """
    out = df.withColumn("_slot", F.explode(F.expr(slots)))
    out = out.withColumn("_wide", F.expr(f"{width}L * shiftleft(1L, {WIDER.bit_length() - 1} * cast(_slot div 2 as int))"))
    out = out.withColumns({"_from": F.expr(f"floor({st} / _wide)"), "_to": F.expr(f"floor(({en} - 1) / _wide)")})
    bins = "if(_to <= _from, array(_from), if(_to = _from + 1, array(_from, _to), sequence(_from, _to)))"
    out = out.withColumn("_own", F.explode(F.expr(bins)))
    return out.withColumns({"_bin": F.expr(f"_own * {2 * WIDTHS} + _slot"), "_first": F.expr("_own = _from")}).drop("_slot", "_wide", "_from", "_to", "_own")


def _renamed(b: DataFrame, keep: tuple[str, ...] = ("chrom",)) -> DataFrame:
    return b.select(*[F.col(c).alias(c if c in keep else f"{c}_b") for c in b.columns])


def overlap_join(a: DataFrame, b: DataFrame, slack: int = 0, width: int = BIN, how: str = "inner", few: bool = False) -> DataFrame:
    """Rows of a(chrom, st, en, ...) with rows of b that overlap, or lie within slack; b's columns end in _b.

    Rows with a null chrom, st or en meet nothing; how="left" keeps them, and others without a partner, with nulls.
    few: b is expected to be small beside a; its binned rows go to all tasks if their size allows, so that a stays put.

    Keys have a tag: 0 where b's row is at its own width, so a is there at its own and at wider ones; 1 where a's row is
    at its own width and b's own is narrower. Which widths the other side has is one row of numbers that goes to all
    tasks; with `few` b is dealt to all wider ones, so that a's lengths need not be read first.
    """
    wide = b.withColumns({"_lo": F.col("st") - slack, "_hi": F.col("en") + slack}).withColumn("_of", F.expr(_level("_lo", "_hi", width)))
    mine = a.withColumn("_level", F.expr(_level("st", "en", width)))
    left = mine.crossJoin(F.broadcast(wide.agg(F.collect_set("_of").alias("_widths"))))
    wider = "if(array_max(_widths) > _level, transform(filter(_widths, w -> w > _level), w -> 2 * w), cast(array() as array<int>))"
    narrower = "if(array_min(_widths) < _level, array(2 * _level + 1), cast(array() as array<int>))"
    left = _dealt(left, "st", "en", width, f"concat(array(2 * _level), {wider}, {narrower})").select(*a.columns, "_bin", "_first")
    right = wide.withColumn("_theirs", F.lit(list(range(WIDTHS)))) if few else wide.crossJoin(F.broadcast(mine.agg(F.collect_set("_level").alias("_theirs"))))
    right = _dealt(right, "_lo", "_hi", width, "concat(array(2 * _of), transform(filter(_theirs, w -> w > _of), w -> 2 * w + 1))").drop("_theirs", "_of")
    right = _renamed(right, ("chrom", "_bin"))
    right = broadcast_if_small(right) if few else right
    # Of the bins that both touch the first one is where one of the two begins.
    meet = (F.col("st") < F.col("_hi_b")) & (F.col("_lo_b") < F.col("en")) & (F.col("_first") | F.col("_first_b"))
    pairs = left.join(right, ["chrom", "_bin"]).where(meet).drop("_bin", "_first", "_first_b", "_lo_b", "_hi_b")
    if how == "inner":
        return pairs.select(*a.columns, *[c for c in pairs.columns if c not in a.columns])
    alone = a.join(pairs.select(*[F.col(c).alias(f"_{c}") for c in a.columns]).distinct(), _same_row(a.columns), "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True)


def _same_row(columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return out


def overlap_length() -> Column:
    return F.least("en", "en_b") - F.greatest("st", "st_b")


def overlap_fraction_join(a: DataFrame, b: DataFrame, share: float = 0.6, width: int = BIN, how: str = "inner") -> DataFrame:
    """Overlaps that cover at least `share` of the row of a; how="left" keeps rows of a without one."""
    pairs = overlap_join(a, b, 0, width).where(overlap_length() / (F.col("en") - F.col("st")) >= share)
    if how == "inner":
        return pairs
    alone = a.join(pairs.select(*[F.col(c).alias(f"_{c}") for c in a.columns]).distinct(), _same_row(a.columns), "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True)


def nearest_within(a: DataFrame, sites: DataFrame, pad: int, key: str, width: int = BIN) -> DataFrame:
    """For each row of a(chrom, pos, ...) the closest of sites(chrom, pos) within pad: site_pos and distance, or nulls.

    Of equally close sites the lowest position is taken. key names a unique column of a.
    """
    points = a.select(key, "chrom", "pos", F.col("pos").alias("st"), (F.col("pos") + 1).alias("en"))
    marks = sites.select("chrom", F.col("pos").alias("st"), (F.col("pos") + 1).alias("en")).distinct()
    near = overlap_join(points, marks, pad, width).withColumn("distance", F.abs(F.col("pos") - F.col("st_b")))
    best = near.groupBy(key).agg(F.min(F.struct("distance", F.col("st_b").alias("site_pos"))).alias("best"))
    return a.join(best.select(key, "best.site_pos", "best.distance"), key, "left")


def min_distance(a: DataFrame, sites: DataFrame, chunk: int = 100_000) -> DataFrame:
    """a(chrom, pos, ...) with `distance` to the closest site of the chromosome, null if it has none.

    An as-of join both ways by union and windows over chunks of positions; sites beyond a chunk come from a table with
    one row per chunk, so no task holds a chromosome.
    """
    part = F.floor(F.col("pos") / chunk).alias("_chunk")
    marks = sites.select("chrom", "pos").distinct()
    ends = marks.groupBy("chrom", part).agg(F.min("pos").alias("_lo"), F.max("pos").alias("_hi"))
    used = ends.select("chrom", "_chunk").unionByName(a.select("chrom", part)).distinct()
    order = W.partitionBy("chrom").orderBy("_chunk")
    around = used.join(ends, ["chrom", "_chunk"], "left")
    around = around.withColumn("_before", F.last("_hi", True).over(order.rowsBetween(W.unboundedPreceding, -1)))
    # The next of a column is its last in the opposite order, which needs one pass.
    back = W.partitionBy("chrom").orderBy(F.desc("_chunk"))
    around = around.withColumn("_after", F.last("_lo", True).over(back.rowsBetween(W.unboundedPreceding, -1)))
    rows = a.withColumn("_site", F.lit(None).cast("long")).unionByName(marks.withColumn("_site", F.col("pos")), allowMissingColumns=True)
    rows = rows.withColumn("_chunk", F.floor(F.col("pos") / chunk)).withColumn("_is", F.col("_site").isNotNull())
    inside = W.partitionBy("chrom", "_chunk").orderBy("pos")
    rows = rows.withColumn("_l", F.last("_site", True).over(inside.rangeBetween(W.unboundedPreceding, 0)))
    outside = W.partitionBy("chrom", "_chunk").orderBy(F.desc("pos"))
    rows = rows.withColumn("_r", F.last("_site", True).over(outside.rangeBetween(W.unboundedPreceding, 0)))
    rows = rows.where(~F.col("_is")).join(around.select("chrom", "_chunk", "_before", "_after"), ["chrom", "_chunk"], "left")
    left, right = F.coalesce("_l", "_before"), F.coalesce("_r", "_after")
    return rows.select(*a.columns, F.least(F.col("pos") - left, right - F.col("pos")).alias("distance"))


def placed_in_order(df: DataFrame, key: str, chunk: int = CHUNK) -> DataFrame:
    """df with `rank`, its place from 1 on the chromosome in the order of st and key, found chunk by chunk."""
    rows = df.withColumn("_chunk", F.floor(F.col("st") / chunk))
    over = W.partitionBy("chrom").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    before = rows.groupBy("chrom", "_chunk").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(over), F.lit(0))).drop("_n")
    rows = rows.withColumn("_own", F.row_number().over(W.partitionBy("chrom", "_chunk").orderBy("st", key)))
    return _joined_null_safe(rows, before, ["chrom", "_chunk"]).select(*df.columns, (F.col("_before") + F.col("_own")).alias("rank"))


def distance_band_join(frags: DataFrame, most: int, shortest: int | None = None, longest: int | None = None) -> DataFrame:
    """Baits with other ends of the same chromosome whose midpoints are less than `most` apart.

    frags(chrom, st, en, frag_id, is_bait); baits never meet baits or their neighbours in order; other ends may be
    bounded in length. Gives bait_id, other_id, distance (signed).
    """
    mids = placed_in_order(frags, "frag_id").select("chrom", "frag_id", "is_bait", (F.col("en") - F.col("st")).alias("length"), ((F.col("st") + F.col("en")) / 2).alias("mid"), "rank")
    baits = mids.where("is_bait = 1").select("chrom", F.col("frag_id").alias("bait_id"), F.col("mid").alias("bait_mid"), F.col("rank").alias("bait_rank"))
    baits = baits.withColumn("_k", F.floor(F.col("bait_mid") / most)).withColumn("_k", F.explode(F.array(F.col("_k") - 1, F.col("_k"), F.col("_k") + 1)))
    others = mids.where("is_bait = 0").withColumn("_k", F.floor(F.col("mid") / most))
    if shortest is not None:
        others = others.where(F.col("length") >= shortest)
    if longest is not None:
        others = others.where(F.col("length") <= longest)
    near = (F.abs(F.col("mid") - F.col("bait_mid")) < most) & (F.abs(F.col("rank") - F.col("bait_rank")) > 1)
    pairs = baits.join(others, ["chrom", "_k"]).where(near)
    return pairs.select("bait_id", F.col("frag_id").alias("other_id"), (F.col("mid") - F.col("bait_mid")).alias("distance"))


def chained(df: DataFrame, slack: int, by: tuple[str, ...] = ("chrom",), chunk: int = CHUNK) -> DataFrame:
    """df with `_new`, true where an interval begins a cluster, and `_chunk`; see cluster_intervals.

    A running maximum of ends on two levels: over the chunks' greatest ends, one row a chunk, then inside chunks, so no
    task holds a chromosome. Intervals belong to the chunk in which they start.
    """
    rows = df.withColumn("_chunk", F.floor(F.col("st") / chunk))
    over = W.partitionBy(*by).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    chunks = rows.groupBy(*by, "_chunk").agg(F.max("en").alias("_en")).withColumn("_before", F.max("_en").over(over)).drop("_en")
    inside = W.partitionBy(*by, "_chunk").orderBy("st", "en").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_reach", F.max("en").over(inside))
    rows = _joined_null_safe(rows, chunks, [*by, "_chunk"])
    reach = F.greatest("_reach", "_before")
    return rows.withColumn("_new", F.coalesce(F.col("st") - reach > slack, F.lit(True))).drop("_reach", "_before")


def _joined_null_safe(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the columns of a table that has one row for each of their keys; null keys are keys."""
    named = table.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in table.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(named, on).drop(*[f"_k_{k}" for k in keys])


def cluster_intervals(df: DataFrame, slack: int, by: tuple[str, ...] = ("chrom",), chunk: int = CHUNK) -> DataFrame:
    """df with `cluster`, numbered from 1 within `by`: intervals are chained while the gap is at most slack.

    Rows with a null start or end are in no chunk and get a null cluster.
    """
    placed = F.col("st").isNotNull() & F.col("en").isNotNull()
    rows = chained(df.where(placed), slack, by, chunk)
    keys = [*by, "_chunk"]
    over = W.partitionBy(*by).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    counts = rows.groupBy(*keys).agg(F.sum(F.col("_new").cast("long")).alias("_n"))
    counts = counts.withColumn("_earlier", F.coalesce(F.sum("_n").over(over), F.lit(0))).drop("_n")
    inside = W.partitionBy(*keys).orderBy("st", "en").rangeBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_own", F.sum(F.col("_new").cast("long")).over(inside))
    rows = _joined_null_safe(rows, counts, keys).select(*df.columns, (F.col("_earlier") + F.col("_own")).alias("cluster"))
    return rows.unionByName(df.where(~placed).withColumn("cluster", F.lit(None).cast("long")))


def merge_intervals(df: DataFrame, slack: int, by: tuple[str, ...] = ("chrom",), *more: Column) -> DataFrame:
    """One row per cluster with its least start, greatest end and number of intervals, and further aggregates."""
    out = cluster_intervals(df, slack, by).groupBy(*by, "cluster")
    return out.agg(F.min("st").alias("st"), F.max("en").alias("en"), F.count(F.lit(1)).alias("n"), *more)


def with_bridges(df: DataFrame, masks: DataFrame, kind: str) -> DataFrame:
    """df with `bridge` false, and each mask once for every kind of df as a row with `bridge` true and no other column.

    Events of one kind on both sides of a mask (a centromere) are then chained through it. Kinds are few words, masks one
    or two a chromosome.
    """
    kinds = broadcast_if_small(df.select(kind).where(F.col(kind).isNotNull()).distinct())
    bridges = masks.select("chrom", "st", "en").crossJoin(kinds).withColumn("bridge", F.lit(True))
    return df.withColumn("bridge", F.lit(False)).unionByName(bridges, allowMissingColumns=True)


def point_in_fragment(probes: DataFrame, frags: DataFrame, width: int = BIN, strict: bool = False) -> DataFrame:
    """The fragment that holds each probe's midpoint, with the feature of the last probe in it.

    probes(chrom, st, en, feature, ord); a leading chr is ignored on both sides. Gives frag_id, n_probes, feature. A probe
    outside all fragments is left out, or with `strict` an error that names it.
    """
    bare = F.regexp_replace("chrom", "^chr", "")
    mid = F.floor((F.col("st") + F.col("en")) / 2)
    points = probes.select(bare.alias("chrom"), mid.alias("st"), (mid + 1).alias("en"), "feature", "ord")
    inside = overlap_join(points, frags.select(bare.alias("chrom"), "st", (F.col("en") + 1).alias("en"), "frag_id"), 0, width, "left" if strict else "inner")
    if strict:
        lost = F.raise_error(F.concat(F.lit("no fragment holds the probe "), F.coalesce(F.col("feature").cast("string"), F.lit("")))).cast("long")
        inside = inside.withColumn("frag_id_b", F.coalesce("frag_id_b", lost))
    return inside.groupBy(F.col("frag_id_b").alias("frag_id")).agg(F.count(F.lit(1)).alias("n_probes"), F.max_by("feature", "ord").alias("feature"))


def names_per_interval(bins: DataFrame, named: DataFrame, width: int = BIN) -> DataFrame:
    """Each bin with the names of what overlaps it, sorted and joined with commas."""
    pairs = overlap_join(bins, named, 0, width)
    return pairs.groupBy(*bins.columns).agg(F.array_join(F.array_sort(F.collect_set("name_b")), ",").alias("names"))


def covered_share(segments: DataFrame, masks: DataFrame, key: str, width: int = BIN, least: float = 0.5) -> DataFrame:
    """segments with `share` covered by the merged masks and the filter `Mask` where it is at least `least`.

    The filter replaces PASS and is added to others.
    """
    merged = merge_intervals(masks, 0).select("chrom", "st", "en")
    parts = overlap_join(segments, merged, 0, width).groupBy(key).agg(F.sum(overlap_length()).alias("_covered"))
    out = segments.join(parts, key, "left").withColumn("share", F.coalesce("_covered", F.lit(0)) / (F.col("en") - F.col("st")))
    masked = F.when(F.col("filter") == "PASS", F.lit("Mask")).otherwise(F.concat_ws(";", "filter", F.lit("Mask")))
    return out.withColumn("filter", F.when(F.col("share") >= least, masked).otherwise(F.col("filter"))).drop("_covered")


def expand_positions(intervals: DataFrame, bases: str | None = None) -> DataFrame:
    """One row per base of each interval: its columns, pos, and base if `bases` names a sequence column."""
    if bases is None:
        return intervals.withColumn("pos", F.explode(F.sequence("st", F.col("en") - 1)))
    out = intervals.select(*[c for c in intervals.columns if c != bases], F.posexplode(F.split(bases, "")).alias("_i", "base"))
    return out.where(F.col("base") != "").withColumn("pos", F.col("st") + F.col("_i")).drop("_i")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def as_of_join(a: DataFrame, b: DataFrame, by: str, a_date: str, b_date: str, lag_days: int, value: str) -> DataFrame:
    """a with `value` of the latest row of b of the same `by` whose date is lag_days before a's or earlier.

    By union and `last` over dates. The nonnull columns of a must tell its rows apart.
    """
    left = a.withColumn("_d", F.col(a_date)).withColumn("_v", F.lit(None)).withColumn("_b", F.lit(1))
    right = b.select(by, F.date_add(F.col(b_date), lag_days).alias("_d"), F.col(value).alias("_v")).withColumn("_b", F.lit(0))
    right = right.groupBy(by, "_d", "_b").agg(F.max("_v").alias("_v"))
    order = W.partitionBy(by).orderBy("_d", "_b").rowsBetween(W.unboundedPreceding, 0)
    rows = left.withColumn("_v", F.lit(None).cast(right.schema["_v"].dataType)).unionByName(right, allowMissingColumns=True)
    return rows.withColumn(value, F.last("_v", True).over(order)).where("_b = 1").select(*a.columns, value)
