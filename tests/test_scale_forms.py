"""Forms without a group in one task give what the plain loops give."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusweave.operators import balance, kernels, models, ranks


def test_running_sums_and_places(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(40), k) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, s int, k int").repartition(7)
    got = {r.k: (r.a, r.b) for r in ranks.running_sums(df, ["g"], [F.col("s"), F.col("k")], {"a": F.col("s"), "b": F.lit(1)}).collect()}
    for g in ("a", "b", None):
        total = 0
        for n, (_, s, k) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: r[1:])):
            total += s
            assert got[k] == (total, n + 1)
    assert {r.k: r.place for r in ranks.numbered(df, [F.desc("s"), F.col("k")]).collect()} == {r[2]: n + 1 for n, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[2])))}


@pytest.mark.parametrize("cells", [2, 3, 1024])
def test_order_statistic(spark, cells):
    rng = random.Random(3)
    rows = [(g, rng.choice([0.0, 1.5, rng.gauss(0, 1e6), 7.25])) for g in ("a", "b") for _ in range(200)] + [("c", 5.0), (None, 1.0), (None, -1.0)]
    at = {"a": 17, "b": 199, "c": 0, None: 1}
    got = ranks.order_statistic(spark.createDataFrame(rows, "g string, v double"), "g", F.col("v"), spark.createDataFrame(list(at.items()), "g string, at long"), cells)
    for r in got.collect():
        values = sorted(v for g, v in rows if g == r.g)
        assert r.value == values[at[r.g]] and r.tie == at[r.g] - values.index(r.value)


def test_first_rows_with_ties(spark):
    rng = random.Random(4)
    rows = [(g, rng.randrange(4), k) for k, g in enumerate("abcd" * 60)]
    quotas = {"a": 0, "b": 37, "c": 60}
    table = spark.createDataFrame([(g, q, 60) for g, q in quotas.items()], "g string, quota long, n long")
    got = ranks.first_rows(spark.createDataFrame(rows, "g string, v int, k int"), "g", F.col("v"), "k", table).collect()
    for g in "abcd":
        order = sorted((r[1], r[2]) for r in rows if r[0] == g)[: quotas.get(g, 0)]
        assert sorted((r.v, r.k) for r in got if r.g == g and r["first"]) == order


def folded(rows, size, solitary=True):
    out, number = {}, 0
    for chrom in sorted({r[0] for r in rows}):
        first = None
        for _, st, en, k, bait in sorted((r for r in rows if r[0] == chrom), key=lambda r: r[1]):
            alone = bait == 1 and solitary
            if first is None or alone:
                number, first = number + 1, st
            out[k] = number
            if alone or en - first >= size:
                first = None
    return out


@pytest.mark.parametrize("run", [3, 7, 50, 10_000])
@pytest.mark.parametrize("solitary", [True, False])
def test_greedy_bins_equal_the_fold(spark, run, solitary):
    rng, rows = random.Random(run), []
    for chrom in ("c1", "c2", "c3"):
        at = 0
        for _ in range({"c1": 90, "c2": 40, "c3": 1}[chrom]):
            length = rng.choice([10, 40, 200, 900])
            rows.append((chrom, at, at + length, len(rows), int(rng.random() < 0.1)))
            at += length + rng.choice([0, 5])
    df = spark.createDataFrame(rows, "chrom string, st long, en long, frag_id long, is_bait int")
    for size in (1, 500, 10**7):
        assert {r.frag_id: r.bin for r in kernels.greedy_bins(df, size, solitary, run).collect()} == folded(rows, size, solitary)


def contacts(n=30, seed=1):
    rng = np.random.default_rng(seed)
    rows = [("c1", i, j, int(rng.integers(1, 60))) for i in range(n) for j in range(i, n) if rng.random() < 0.6]
    return rows + [("c2", i, i + 1, 1 + i) for i in range(6)] + [("c2", i, i, 3) for i in range(7)]


@pytest.mark.parametrize("sparsest", [0.0, 0.1])
def test_balancing_over_spark_equals_one_task(spark, sparsest):
    df = spark.createDataFrame(contacts(), "chrom string, i long, j long, n long")
    near = {(r.chrom, r.i): r for r in balance.matrix_balance(df, sparsest).collect()}
    far = {(r.chrom, r.i): r for r in balance.matrix_balance(df, sparsest, one_task=0).collect()}
    assert near.keys() == far.keys()
    for key, r in near.items():
        assert math.isclose(r.bias, far[key].bias, rel_tol=1e-6) and r.odd == far[key].odd
        assert r.bias == -1 or math.isclose(r.scaled, 1, abs_tol=1e-3) and math.isclose(far[key].scaled, 1, abs_tol=1e-3)


def test_genome_is_one_matrix(spark):
    rows = contacts(12)
    whole = spark.createDataFrame([("g", (c, i), (c, j), n) for c, i, j, n in rows] + [("g", ("c1", 0), ("c2", 3), 9)], "chrom string, a struct<c:string,i:long>, b struct<c:string,i:long>, n long")
    df = whole.select(F.col("a.c").alias("chr1"), F.col("a.i").alias("mid1"), F.col("b.c").alias("chr2"), F.col("b.i").alias("mid2"), "n")
    got = {(r.chrom, r.mid): r for r in balance.genome_balance(df, 0.0).collect()}
    names = {k: n for n, k in enumerate(sorted(got))}
    flat = spark.createDataFrame([("g", names[(r.chr1, r.mid1)], names[(r.chr2, r.mid2)], r.n) for r in df.collect()], "chrom string, i long, j long, n long")
    for r in balance.matrix_balance(flat, 0.0).collect():
        key = next(k for k, n in names.items() if n == r.i)
        assert math.isclose(r.bias, got[key].bias, rel_tol=1e-6)


def test_metrics_of_one_group_equal_a_loop(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(20) / 20, int(rng.random() < 0.4)) for _ in range(400)]
    r = models.binary_metrics(spark.createDataFrame(rows, "s double, y int"), "s", "y").first()
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    ap = sum(sum(y for s, y in rows if s >= p) / sum(s >= p for s, _ in rows) for p in pos) / len(pos)
    assert math.isclose(r.auc, auc) and math.isclose(r.average_precision, ap)


def test_pieces_of_a_reference_are_not_broadcast(spark, tmp_path):
    from locusweave.sources import text

    spark.createDataFrame([("c", "ACGT")], "chrom string, base string").write.parquet(str(tmp_path / "c"))
    contigs = spark.read.parquet(str(tmp_path / "c")).select("chrom", F.repeat("base", F.lit(50_000)).alias("seq"))
    out = text.bases_at(spark.createDataFrame([("c", 9)], "chrom string, pos long"), text.reference_chunks(contigs, 64), 2, 2, 64)
    assert out.first().bases == "TACGT"
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_shares_at_the_threshold_do_not_hang_on_the_order_of_rows(spark, tmp_path):
    import itertools

    from locusweave.queries import QUERIES, registered

    registered()
    rows = []
    for pos, order in enumerate(itertools.chain(itertools.permutations((9, 7, 3, 1)), itertools.permutations((9, 2, 8, 1)))):
        # Keys at one place of one sample, with these alternate reads: 0.005 on average.
        rows += [next(k for k in range(pos + 8000, pos + 8000 * 14, 8000) if k % 13 == alt) for alt in order]
    orders = spark.createDataFrame([(k, 1, "P", 1.0) for k in rows], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    assert QUERIES["l10_cross_sample_negatives"](spark, str(tmp_path)).collect() == []


def test_background_reads_are_narrowed_before_they_are_written(spark):
    from unittest import mock

    from locusweave.operators import annotation

    kinds = "read_name string, chrom string, ref_start long, mapq int, cigar string, is_dup int, arm string"
    df = spark.createDataFrame([(f"r{k}", "c", k % 50, 60, "100M", 0, "edited") for k in range(3000)], kinds)
    windows = spark.createDataFrame([("c", 0, 100)], "chrom string, st long, en long")
    written, real = {}, annotation.saved

    def spy(table, name):
        written[name] = out = real(table, name)
        return out

    with mock.patch.object(annotation, "saved", spy):
        got = sorted((r.read_name, r.ref_start) for r in annotation.background_reads(df, windows, 20).collect())
    key = F.concat_ws(":", "chrom", F.lit("50"), "read_name", "ref_start", "cigar")
    assert got == sorted((r.read_name, r.ref_start) for r in df.orderBy(F.substring(F.md5(key), 1, 12)).limit(20).collect())
    assert 20 <= written["background-reads"].count() < 60


def test_cigars_are_parsed_once_for_all_evidence(spark):
    from locusweave.functions import cigar as cg

    df = spark.createDataFrame([("5S3D2M",)], "cigar string").select(cg.indel_evidence(F.col("cigar"), F.lit(0), F.lit(None).cast("string"), F.lit(None).cast("string")).alias("x"))
    plan = df.select("x.*")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 2  # the clips of supplementary alignments are the other
    assert cg.parse_cigar(F.lit("10M2I")) is not None and spark.range(1).select(cg.parse_cigar(F.lit("10M2I*")).alias("p")).first().p == [("M", 10), ("I", 2)]
