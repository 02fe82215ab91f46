"""Interval joins, chains and orders against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from locusweave.operators import intervals as iv

SPAN = "chrom string, st long, en long, k long"


def spans(n, seed, longest, chroms=2):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        st = rng.randrange(-2_000, 3_000_000)
        out.append((f"c{rng.randrange(chroms)}", st, st + max(0, int(longest ** rng.random()) - 1), k))
    return out


def overlaps(a, b, slack=0):
    return sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] + slack and y[1] - slack < x[2])


@pytest.mark.parametrize("few", [False, True])
@pytest.mark.parametrize("longest", [(200, 200), (200, 300_000_000), (300_000_000, 200), (300_000_000, 300_000_000), (40_000, 4_000)])
def test_overlap_join_is_the_plain_predicate(spark, longest, few):
    a, b = spans(150, 1, longest[0]), spans(60, 2, longest[1])
    for slack in (0, 5_000):
        got = iv.overlap_join(spark.createDataFrame(a, SPAN), spark.createDataFrame(b, SPAN), slack, few=few)
        assert sorted((r.k, r.k_b) for r in got.collect()) == overlaps(a, b, slack)


def test_intervals_make_few_rows(spark):
    one = spark.createDataFrame([("c", 0, 250_000_000, 1), ("c", 7, 157, 2), ("c", 1_000, 1_100, 3), ("c", 5_000, 45_000, 4)], SPAN)
    dealt = iv._dealt(one.withColumn("_level", F.expr(iv._level("st", "en", iv.BIN))), "st", "en", iv.BIN, "array(2 * _level)")
    assert max(r["count"] for r in dealt.groupBy("k").count().collect()) <= 2


def test_left_join_keeps_rows_and_nulls(spark):
    a = spark.createDataFrame([("c", 0, 10, 1), ("c", 50, 60, 2), (None, 0, 10, 3), ("c", None, 10, 4)], SPAN)
    b = spark.createDataFrame([("c", 5, 9_000_000, 7), ("c", 5, None, 8)], SPAN)
    assert sorted((r.k, r.k_b) for r in iv.overlap_join(a, b, how="left").collect() if r.k_b) == [(1, 7), (2, 7)]
    assert sorted(r.k for r in iv.overlap_join(a, b.limit(0), how="left").collect()) == [1, 2, 3, 4]


def chain(rows, slack):
    out, reach, n, was = {}, {}, {}, {}
    for c, st, en, k in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if c not in reach or st - reach[c] > slack:
            n[c] = n.get(c, 0) + 1
        reach[c] = max(reach.get(c, en), en)
        out[k] = n[c]
    return out


@pytest.mark.parametrize("chunk", [100, 5_000, 10**9])
def test_clusters_do_not_depend_on_chunks(spark, chunk):
    rows = spans(300, 3, 40_000)
    got = iv.cluster_intervals(spark.createDataFrame(rows, SPAN), 700, chunk=chunk)
    assert {r.k: r.cluster for r in got.collect()} == chain(rows, 700)


def test_rows_without_a_place_have_no_cluster(spark):
    rows = [("c", 1, 5, 1), ("c", None, 9, 2), (None, 3, 4, 3), (None, 5, 9, 4)]
    got = iv.cluster_intervals(spark.createDataFrame(rows, SPAN), 2)
    assert {r.k: r.cluster for r in got.collect()} == {1: 1, 2: None, 3: 1, 4: 1}


@pytest.mark.parametrize("chunk", [50, 10**9])
def test_order_does_not_depend_on_chunks(spark, chunk):
    rows = spans(200, 4, 10)
    got = iv.placed_in_order(spark.createDataFrame(rows, SPAN), "k", chunk)
    want = {}
    for c in ("c0", "c1"):
        for i, r in enumerate(sorted((r for r in rows if r[0] == c), key=lambda r: (r[1], r[3]))):
            want[r[3]] = i + 1
    assert {r.k: r["rank"] for r in got.collect()} == want


def test_bridges_chain_events_of_one_kind(spark):
    rows = [("c", 0, 100, "DEL"), ("c", 300, 400, "DEL"), ("c", 310, 390, "DUP"), ("d", 0, 10, "DEL")]
    events = spark.createDataFrame(rows, "chrom string, st long, en long, alt string")
    masks = spark.createDataFrame([("c", 90, 310)], "chrom string, st long, en long")
    got = iv.cluster_intervals(iv.with_bridges(events, masks, "alt"), 0, ("chrom", "alt")).where("not bridge")
    assert sorted((r.chrom, r.alt, r.cluster) for r in got.collect()) == [("c", "DEL", 1), ("c", "DEL", 1), ("c", "DUP", 1), ("d", "DEL", 1)]
