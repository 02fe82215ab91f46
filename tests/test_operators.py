"""Small tables worked out by hand, and invariants."""

import numpy as np
from pyspark.sql import functions as F

from locusweave.functions import cigar as cg
from locusweave.functions import variants as fn_variants
from locusweave.operators import intervals as iv
from locusweave.operators import annotation, cohort, kernels, models, reads, variants
from locusweave.sources import sinks, text


def test_cigar_of_null_star_and_skip(spark):
    df = spark.createDataFrame([(None, 0), ("*", 0), ("10M5N10M2D3M", 100), ("4S6M", 7)], "c string, s int")
    rows = df.select(F.size(cg.parse_cigar(F.col("c"))), cg.reference_span(F.col("c"), F.col("s"))["ref_end"], cg.events(F.col("c"), F.col("s"))).collect()
    assert [r[0] for r in rows] == [0, 0, 5, 2]
    assert [r[1] for r in rows] == [0, 0, 130, 13]
    assert [(e.pos, e.op, e.len) for e in rows[2][2]] == [(125, "D", 2)]


def test_aligned_overlap_leaves_out_gaps(spark):
    df = spark.createDataFrame([("5M5D5M", 0, "15M", 0)], "a string, s int, b string, t int")
    assert df.select(cg.aligned_overlap(F.col("a"), F.col("s"), F.col("b"), F.col("t"))).first()[0] == 10


def test_overlap_join_equals_plain_predicate_and_keeps_unmatched(spark):
    rng = np.random.default_rng(1)
    a = [(f"c{k % 2}", int(s), int(s + w), k) for k, (s, w) in enumerate(zip(rng.integers(0, 5000, 60), rng.integers(1, 3000, 60)))]
    b = [(f"c{k % 2}", int(s), int(s + w), k) for k, (s, w) in enumerate(zip(rng.integers(0, 5000, 60), rng.integers(1, 50, 60)))]
    da, db = (spark.createDataFrame(x, "chrom string, st long, en long, k long") for x in (a, b))
    got = {(r.k, r.k_b) for r in iv.overlap_join(da, db, 0, 64).collect()}
    assert got == {(x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2]}
    assert {r.k for r in iv.overlap_join(da, db, 0, 64, "left").collect()} == {x[3] for x in a}


def test_clusters_are_disjoint(spark):
    df = spark.createDataFrame([("c", 0, 10), ("c", 10, 12), ("c", 14, 20), ("c", 100, 101), ("d", 0, 1)], "chrom string, st long, en long")
    rows = iv.merge_intervals(df, 2).orderBy("chrom", "st").collect()
    assert [(r.chrom, r.st, r.en, r.n) for r in rows] == [("c", 0, 20, 3), ("c", 100, 101, 1), ("d", 0, 1, 1)]


def test_min_distance_across_chunks_and_without_sites(spark):
    a = spark.createDataFrame([("c", 5), ("c", 250), ("e", 1)], "chrom string, pos long")
    sites = spark.createDataFrame([("c", 100), ("c", 400)], "chrom string, pos long")
    assert {(r.chrom, r.pos): r.distance for r in iv.min_distance(a, sites, 50).collect()} == {("c", 5): 95, ("c", 250): 150, ("e", 1): None}


def test_greedy_bins_overshoot_and_lonely_baits(spark):
    df = spark.createDataFrame([("c", 0, 4, 1, 0), ("c", 4, 11, 2, 0), ("c", 11, 13, 3, 1), ("c", 13, 15, 4, 0), ("d", 0, 2, 5, 0)], "chrom string, st long, en long, frag_id long, is_bait int")
    assert {r.frag_id: r.bin for r in kernels.greedy_bins(df, 10).collect()} == {1: 1, 2: 1, 3: 2, 4: 3, 5: 4}


def test_repeat_context(spark):
    df = spark.createDataFrame([("c", 1, "GGAAAAAGCT", 4), ("c", 2, "ACACACACGT", 9), ("c", 3, "ACGTTGCA", 2)], "chrom string, pos int, seq string, at int")
    assert {r.pos: (r.homopolymer, r.repeat_distance) for r in kernels.repeat_contexts(df).collect()} == {1: (True, 0), 2: (False, 2), 3: (False, 999)}


def test_metrics_with_ties_and_one_class(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 1), (0.5, 0), (0.1, 0)], "s double, y int")
    r = models.binary_metrics(df, "s", "y").first()
    assert (r.auc, r.tp, r.fp, r.recall) == (0.875, 1, 0, 0.5)
    assert models.binary_metrics(df.where("y = 1"), "s", "y").first().auc is None


def test_planted_edit_survives_and_germline_is_demoted(spark):
    def rows(sample, arm, cigar, n):
        return [(f"{sample}{arm}{cigar}{k}", sample, "c", 1000 - 60, 60, cigar, 0, arm) for k in range(n)]

    kinds = "read_name string, sample string, chrom string, ref_start long, mapq int, cigar string, is_dup int, arm string"
    df = spark.createDataFrame(rows("a", "edited", "60M3D60M", 40) + rows("a", "edited", "120M", 10) + rows("b", "control", "120M", 30) + rows("a", "control", "120M", 30), kinds)
    loci = spark.createDataFrame([("c", 1000)], "chrom string, pos long")
    shape = reads.pileup_shape(df.where("arm = 'edited'"), loci)
    control = reads.pileup_shape(df.where("arm = 'control'"), loci)

    def said(score, **more):
        changed = shape.withColumns({k: F.lit(v) for k, v in more.items()})
        return reads.verdicts(changed, control, loci.withColumn("score", F.lit(score))).first().verdict

    assert said(0.60) == "LIKELY EDIT" and said(0.59) == said(0.25) == "POSSIBLE - review" and said(0.24) == "ARTIFACT (shape)"
    assert said(0.9, spanning=7) == "INSUFFICIENT COVERAGE" and said(0.9, median_mapq=19.0) == "ARTIFACT (low-MAPQ repeat)" and said(0.9, concentration=0.49) == "POSSIBLE - review"
    germline = control.withColumn("indel_share", F.lit(0.03))
    assert reads.verdicts(shape, germline, loci.withColumn("score", F.lit(0.9))).first().verdict == "GERMLINE/ARTIFACT (in normal)"
    marked = df.unionByName(df.where("arm = 'edited'").withColumn("is_dup", F.lit(1))).unionByName(df.where("arm = 'edited'").withColumn("mapq", F.lit(0)))
    assert reads.site_labels(marked, loci).first().edited == 0.8
    far = spark.createDataFrame([("c", 1003), ("c", 1004)], "chrom string, pos long").withColumn("sample", F.lit("z"))
    share = {r.pos: r.worst_share for r in reads.panel_of_normals(df.where("arm = 'edited'").withColumn("arm", F.lit("control")), far).collect()}
    assert share == {1003: 0.8, 1004: 0.0}
    cand = loci.withColumn("sample", F.lit("a"))
    assert not reads.panel_of_normals(df, cand).first().demote
    dirty = df.unionByName(spark.createDataFrame(rows("b", "control", "60M3D60M", 10), kinds))
    assert reads.panel_of_normals(dirty, cand).first().demote
    own = df.unionByName(spark.createDataFrame(rows("a", "control", "60M3D60M", 10), kinds))
    assert not reads.panel_of_normals(own, cand).first().demote


def test_variants_round_trip(spark, tmp_path):
    kinds = "chrom string, pos long, ref string, alt string, filter string, svtype string, info map<string,string>"
    df = spark.createDataFrame([("chr1", 5, "N", "<DEL>", "PASS", "DEL", {"END": "9", "PRECISE": None}), ("chr1", 5, "N", "<DUP>", "a;b", "DUP", {"END": "7"})], kinds)
    sinks.write_variants(df, str(tmp_path / "v"))
    back = text.read_variants(spark, str(tmp_path / "v")).orderBy("alts").collect()
    assert [(r.chrom, r.pos, r.alts, r.filters, r.info.get("END")) for r in back] == [("chr1", 5, ["<DEL>"], ["PASS"], "9"), ("chr1", 5, ["<DUP>"], ["a", "b"], "7")]
    assert "PRECISE" in back[0].info and back[0].info["PRECISE"] is None
    head = {r.value for r in spark.read.text(str(tmp_path / "v_header")).collect()}
    assert any("ID=END" in h for h in head) and any("FILTER=<ID=b" in h for h in head)


def test_table_and_chunks(spark, tmp_path):
    df = spark.createDataFrame([("s1", 1.0, None), ("s2", None, "x")], "sample_id string, v double, w string")
    sinks.write_table(df, str(tmp_path / "t"), ["w", "sample_id"])
    rows = spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "t"))
    assert rows.columns == ["w", "sample_id"] and {r.w for r in rows.collect()} == {"NA", "x"}
    sinks.write_training_chunks(df.drop("w"), str(tmp_path / "c"), ["sample_id", "v"])
    assert {(r.sample_id, r.v) for r in spark.read.parquet(str(tmp_path / "c")).collect()} == {("s1", 1.0), ("s2", 0.0)}


def test_sheets(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Content_Desc, Sex\nx1,m\nx2,f\n")
    assert {r.id for r in text.read_sample_sheet(spark, str(tmp_path / "a.csv")).collect()} == {"x1", "x2"}
    (tmp_path / "c.tsv").write_text("#chrom\tst\ten\tgene\tmean\nchr1\t1\t2\tg\t\n")
    assert text.read_coverage_report(spark, str(tmp_path / "c.tsv")).first()["mean"] == 0.0
    (tmp_path / "t.csv").write_text("chrom,Start,On_target\nchr1,10,1\n")
    assert tuple(text.read_target_csv(spark, str(tmp_path / "t.csv")).first()) == ("chr1", 9, 1)
    (tmp_path / "j.json").write_text('{"stack": [{"IMAGE": "r", "ENV": {"R_VERSION": "4"}, "tags": ["a", "b"]}, {"IMAGE": "q", "ENV": {}}]}')
    assert {(r.image, r.version, r.tag) for r in text.read_nested_catalog(spark, str(tmp_path / "j.json")).collect()} == {("r", "4", "a"), ("r", "4", "b"), ("q", None, None)}


def test_bases_beyond_the_ends_are_n(spark):
    chunks = text.reference_chunks(spark.createDataFrame([("c", "ACGTACGTAC")], "chrom string, seq string"), 4)
    sites = spark.createDataFrame([("c", 0), ("c", 4), ("c", 9), ("x", 1)], "chrom string, pos long")
    got = {(r.chrom, r.pos): r.bases for r in text.bases_at(sites, chunks, 2, 2, 4).collect()}
    assert got[("c", 4)] == "GTACG" and got[("c", 9)].startswith("TAC") and got[("x", 1)].strip("N") == ""


def test_infix_distance():
    assert [kernels.infix_distance(p, t) for p, t in (("abc", "xxabcxx"), ("abc", "xxacxx"), ("abc", ""), ("", "x"), ("abcd", "abxcd"))] == [0, 1, 3, 0, 1]


def test_frameshift_peptide(spark):
    from locusweave.operators import annotation as an

    transcripts = spark.createDataFrame([("t", "ATGGCAGCAGCATAA", "GCATAG")], "trx string, cds string, utr string")
    variants = spark.createDataFrame([(1, "t", 4, "G", "GC"), (2, "t", 4, "G", "A")], "id int, trx string, cds_pos int, ref string, alt string")
    rows = an.frameshift_peptide(variants, transcripts).collect()
    # ATG GCC AGC AGC ATA AGC ATA G: no stop before the end
    assert [(r.id, r.peptide, r.length_change) for r in rows] == [(1, "ASSISI", 3)]
    assert an.reference_peptide(variants, transcripts).first().peptide == "MAAA"


def test_indel_evidence(spark):
    """Each pattern of clips: own length, at an end, inside, beside a deletion, around one, one around; and both mismatch rules."""
    cases = {
        "10M": 0, "2S10M": 0, "5S10M": 5 + 5, "5S5M": 5, "10M5S": 10, "5S10M4S": 18, "5S3D2M": 3 + 5 + 3, "5S60D2M": 60 + 5, "2M3D5S": 3 + 5 + 3, "5S3D5S": 3 + 10 + 3 * 3, "2M3D5S4D2M": 7 + 5 + 7 + 7,
        "3M5S3M": 5 + 5, "2M5S9M": 5, "6S": 6, "5H10M": 0,
    }
    df = spark.createDataFrame(list(cases), "string").withColumn("x", cg.indel_evidence(F.col("value"), F.lit(0), F.lit(None).cast("string"), F.lit(None).cast("string")))
    assert {r.value: r.x.deleted for r in df.collect()} == cases
    one = lambda *v: spark.range(1).select(cg.indel_evidence(*[F.lit(x).cast(k) for x, k in zip(v, ("string", "int", "string", "string"))]).alias("x")).first().x
    assert tuple(one("4M2I3D4M", 7, "2A2^ACG4", "c,1,+,3S9M2S4S,6,0;c,1,+;d,2,-,8S1M,1,1;")) == (2, 3 + 3 + 4 + 8, 0, 2, 4)
    assert tuple(one("4M2I3D4M", 3, None, None)) == (2, 3, 0, 0, 0) and tuple(one(None, None, None, "c,1,+,9S,1,1;")) == (0, 0, 0, 0, 0)


def test_shape_takes_reads_near_the_locus_and_the_cut_s_own_mapq(spark):
    kinds = "read_name string, sample string, chrom string, ref_start long, mapq int, cigar string, is_dup int, arm string"
    rows = [(f"p{k}", "a", "c", 900, 60, "200M", 0, "edited") for k in range(30)] + [(f"d{k}", "a", "c", 940, 5, "60M3D60M", 0, "edited") for k in range(10)]
    rows += [(f"e{k}", "a", "c", 900, 7, "90M10D", 0, "edited") for k in range(2)] + [("f", "a", "c", 1205, 60, "50M", 0, "edited"), ("s", "a", "c", 950, 60, "50M40S", 0, "edited"), ("t", "a", "c", 1000, 60, "40S50M", 0, "edited")]
    r = reads.pileup_shape(spark.createDataFrame(rows, kinds), spark.createDataFrame([("c", 1000)], "chrom string, pos long")).first()
    # Reads that end at the locus still span it; those that end before it count with their indels only.
    assert (r.spanning, r.indels, r.modal_pos, r.modal_len, r.median_mapq, r.clip_share) == (44, 12, 1000, 3, 5.0, 2 / 44)
    assert (r.indel_share, r.concentration, r.cut_share, r.spread) == (12 / 44, 10 / 12, 10 / 44, 0.0)
    before = [(f"b{k}", "n", "c", 900, 60, "88M10D1M", 0, "control") for k in range(4)] + [(f"w{k}", "n", "c", 900, 60, "200M", 0, "control") for k in range(4)]
    cand = spark.createDataFrame([("c", 1001, "a")], "chrom string, pos long, sample string")
    near = spark.createDataFrame([("c", 990, "a")], "chrom string, pos long, sample string")
    table = spark.createDataFrame(before, kinds)
    assert reads.panel_of_normals(table, cand).first().hits == 0 and reads.panel_of_normals(table, near).first().worst_share == 4 / 8
    ended = spark.createDataFrame([(f"x{k}", "n", "c", 900, 60, "88M1D1M", 0, "control") for k in range(4)] + before[4:], kinds)
    assert reads.panel_of_normals(ended, spark.createDataFrame([("c", 991, "a")], "chrom string, pos long, sample string")).first().worst_share == 4 / 4


def test_read_features(spark):
    kinds = "read_name string, chrom string, ref_start long, mapq int, cigar string, is_dup int, arm string, flag int, tlen long, md string, sa string"
    rows = [
        ("a", "c", 950, 60, "40M5D60M", 0, "edited", 3, -321, "100", None), ("b", "c", 1100, 60, "10S50M", 0, "edited", 1, 50, "9A40", "c,1,+,7S9M,1,1;"),
        ("c", "c", 950, 60, "100M", 0, "control", 3, 1, "50A49", None), ("d", "c", 960, 0, "45M2D50M", 0, "control", 256, 1, "95", None), ("e", "c", 960, 60, "45M2D50M", 0, "control", 1024, 1, "95", None),
        ("g", "c", 1060, 60, "9M1I50M", 0, "control", 0, 1, "59", None),
    ]
    loci = spark.createDataFrame([("c", 1000, [1003], 1)], "chrom string, pos long, pams array<long>, on_target int")
    got = {r.read_name: r for r in reads.read_features(spark.createDataFrame(rows, kinds), loci).collect()}
    a, b = got["a"], got["b"]
    assert (a.pair_gap, a.del_vs_control, a.ins_vs_control, a.mismatch_vs_control, a.deletion_exclusive) == (321, 0.5, 0.0, -0.5, 0)
    assert (b.pair_gap, b.softclip, b.indel_size, b.size_class, b.mismatch_vs_control, b.at_target) == (-1, 10, 10 + 10 + 7, 3, 0.5, 0)
    assert (a.complexity, b.complexity, a.at_target, a.pam_distance, a.clip_distance, b.clip_distance, a.on_target) == (1.5, 2.7, 1, 3, 999, 97, 1)
    alone = spark.createDataFrame([r for r in rows if r[0] in "abc"], kinds)
    assert {r.read_name: r.deletion_exclusive for r in reads.read_features(alone, loci).collect()} == {"a": 1, "b": 0}


def test_segments_merge_by_their_filters(spark):
    rows = [
        ("c", 0, 6000, "<DEL>", "PASS", 1, 0.2), ("c", 6100, 9000, "<DEL>", "LowQ", 3, 0.4), ("c", 9100, 9500, "<DEL>", "PASS", 2, 0.6), ("c", 9200, 9300, "<DEL>", "PASS", 2, 0.1),
        ("d", 0, 9000, "<DUP>", "segmentMean", 3, 0.1), ("e", 0, 9000, "<DUP>", "LowQ", 3, 0.1), ("f", 0, 900, "<DUP>", "PASS", 3, 0.1), ("g", 0, 100, "<LOH>", "PASS", 2, 0.1), ("g", 9000, 9100, "<LOH>", "PASS", 2, 0.3),
    ]
    df = spark.createDataFrame(rows, "chrom string, st long, en long, alt string, filter string, cn int, sm double")
    masks = spark.createDataFrame([("g", 300, 8900), ("f", 0, 99_000), ("e", 0, 10)], "chrom string, st long, en long")
    got = sorted((r.chrom, r.st, r.en, r["filter"], r.cn, r.n, r.svlen) for r in variants.merge_segments(df, 500, 5000, masks).collect())
    # A cluster's merged row ends where its last PASS row does; a mask lengthens a cluster and joins rows across it.
    assert got == [
        ("c", 0, 9300, "PASS", 1, 3, -9301), ("c", 6100, 9000, "LowQ", 3, 1, -2901), ("d", 0, 9000, "segmentMean", 3, 1, 9001), ("f", 0, 900, "PASS", 3, 1, 901), ("g", 0, 9100, "PASS", 2, 2, 9101)
    ]
    assert [r.chrom for r in variants.merge_segments(df.where("chrom in ('f', 'g')"), 500, 5000).collect()] == []


def test_event_categories(spark):
    kinds = "id int, svtype string, filter string, recurrent string, gene_a string, gene_b string, impact boolean, reportable boolean, genes array<string>, cnloh boolean"
    rows = [
        (1, "BND", "LowQ", "exact", "A", "B", None, True, None, None, "OTHERSV"), (2, "BND", "PASS", "exact", "A", "B", None, True, None, None, "RECURRENTSV"), (3, "BND", "PASS", "exact", "A", "INTERGENIC", None, True, None, None, "OTHERSV"),
        (4, "DEL", "PASS", "exact", "A", "B", True, None, None, None, "CNV"), (5, "DEL", "LowQ", None, "A", "B", True, None, None, None, None), (6, "DEL", "PASS", None, "A", "B", True, None, None, None, "OTHERSV"),
        (7, "DUP", "MaxDepth;MinSomaticScore", "exact", "A", "B", True, None, None, None, "CNV"), (8, "DUP", "MaxDepth", None, "A", "B", True, None, None, None, None), (9, "DEL", "PASS", None, "A", "B", False, None, None, None, None),
        (10, "SEG", "PASS", None, None, None, None, None, None, None, "CNV"), (11, "SEG", "LowQ", None, None, None, None, None, None, None, None), (12, "SEG", "LowQ", None, None, None, None, None, ["A"], None, "OTHERSV"),
        (13, "SEG", "PASS", None, None, None, None, None, ["A"], False, "OTHERSV"), (14, "SEG", "segmentMean", None, None, None, None, None, None, None, "OTHERSV"), (15, "BND", "PASS", None, "A", "B", None, False, None, None, None),
    ]
    got = variants.event_category(spark.createDataFrame([r[:-1] for r in rows], kinds)).collect()
    assert {r.id: r.category for r in got} == {r[0]: r[-1] for r in rows}
    assert {r.id: r["filter"] for r in got}[7] == "PASS" and {r.id: r["filter"] for r in got}[8] == "MaxDepth"


def test_labelled_reads_keep_long_and_many_tags(spark):
    record = ["TP", "chr1", "100", "r1", "0", "chr1", "90", "60", "10M", "*", "0", "0", "ACGT", "IIII"]
    tags = [f"{a}{b}:Z:v" for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"][:1200]
    rows = spark.createDataFrame([("\t".join([*record, *tags, "9Z:Z:" + "m" * 50_000]),), ("\t".join(record),)], "value string")
    got = sorted((r.tags for r in text.labelled_reads_of(rows).collect()), key=len)
    assert got[0] == {} and len(got[1]) == 1201 and got[1]["9Z"] == "m" * 50_000


def test_recurrent_rules_with_wildcards_on_either_side(spark):
    listed = spark.createDataFrame([("KMT2A", "*", 0, None), ("A", "B", 0, "*"), ("C", "D", 1, None)], "gene1 string, gene2 string, require_strand int, type string")
    given = [(1, "Y", "KMT2A", "BND", 1), (2, "KMT2A", "Y", "BND", -1), (3, "B", "A", "DEL", 1), (4, "A", "B", "DUP", 1), (5, "C", "D", "BND", 0), (6, "D", "C", "BND", 1), (7, "C", "D", "BND", None), (8, "Y", "KMT2A", "DEL", 1)]
    pairs = spark.createDataFrame(given, "id long, gene_a string, gene_b string, svtype string, orientation int")
    got = {r.id: r.recurrent for r in variants.recurrent_lookup(pairs, listed).collect()}
    assert got == {1: "wildcard", 2: "wildcard", 3: "exact", 4: "exact", 5: None, 6: "exact", 7: None, 8: None}


def test_event_gate_at_its_thresholds(spark):
    rows = [
        (1, "BND", 900, 800, 60, 60), (2, "BND", 10, 900, 60, 5), (3, "BND", 900, 800, 60, 39), (4, "BND", 10, 10, 39, 60), (5, "DEL", 25, 900, 1, 1), (6, "DEL", 26, None, 60, 60), (7, "INS", None, 3, 60, 60),
    ]
    df = spark.createDataFrame([(*r, 100, 200, 50, 60, 300, False) for r in rows], "id long, svtype string, d1 long, d2 long, mapq int, mate_mapq int, pos long, pos2 long, read_start long, mate_start long, template long, proper boolean")
    assert {r.id for r in annotation.event_gate(df).collect()} == {1, 2, 5, 7}
    paired = df.withColumn("proper", F.lit(True))
    assert {r.id for r in annotation.event_gate(paired).collect()} == {1, 2, 5, 7}
    assert {r.id for r in annotation.event_gate(paired.withColumn("pos2", F.lit(351))).collect()} == {1, 2}


def test_false_positive_sites_have_no_predicted_reads(spark):
    df = spark.createDataFrame([(1, 0, 3, 0), (2, 0, 3, 1), (3, 1, 3, 0), (4, 0, 0, 0)], "id long, is_target int, indel int, predicted int")
    kept, logged = variants.false_positive_sites(df)
    assert [r.id for r in logged.collect()] == [1] and {r.id for r in kept.collect()} == {2, 3, 4}


def test_genotypes_of_nine_digit_sites_and_chromosome_numbers(spark):
    loci = spark.createDataFrame([("s", "chr10", 123456781, 123456789, 100, "AC:50;GC:45;TT:5;"), ("s", "chr2", 5, 9, 10, "AA:10;bad;")], "sample string, chrom string, snp1 long, snp2 long, total_reads long, haplotype_counts string")
    assert cohort.genotype_string(loci).first().genotype == "chr2,5,AA|chr2,9,AA|chr10,123456781,AG|chr10,123456789,CC"
    qc = spark.createDataFrame([("a", "p", 2.05), ("a", "c", 30.0), ("a", "n", 100.0), ("b", "p", 1.9)], "sample string, metric string, value double")
    got = {r.sample: (r.chromosome_number, r.consensus_pct, r.duplicate_pct, r.on_target_pct) for r in cohort.derived_qc(qc, "sample", {"ploidy": "p", "consensus_pairs": "c", "reads": "n", "on_target": "t", "mapped": "m"}).collect()}
    assert got == {"a": (47, 60.0, 40.0, None), "b": (46, None, None, None)}


def test_ranks_without_gathering(spark):
    rng = np.random.default_rng(3)
    rows = [(int(t), None if s < 0.1 else float(round(s, 2)), k) for k, (t, s) in enumerate(zip(rng.integers(0, 3, 400), rng.random(400)))]
    df = spark.createDataFrame(rows, "tier int, score double, id int")
    want = sorted(rows, key=lambda r: (r[0], r[1] is None, -(r[1] or 0), r[2]))
    got = sorted(variants.rank_candidates(df, "tier", "score", "id", parts=7).collect(), key=lambda r: r.rank)
    assert [r.id for r in got] == [r[2] for r in want] and [r.rank for r in got] == list(range(1, 401))


def test_split_json_has_no_nan(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", 1.5), ("a", float("inf"))], "k string, v double")
    assert sinks.split_json(df, "k", ["v"]).first().document.count("null") == 2 or "NaN" not in sinks.split_json(df, "k", ["v"]).first().document


def test_samples_and_holdouts(spark):
    df = spark.createDataFrame([(k, f"g{k % 2}", f"i{k % 3}", ("AAVS1", "TRAC", None)[k % 3], int(k < 20)) for k in range(400)], "k int, g string, individual_id string, gene string, y int")
    assert models.balance_negatives(df, "k", "y", "g", 2, most=7).groupBy("y").count().collect() != [] and models.balance_negatives(df, "k", "y", "g", 2, most=7).where("y = 0").count() == 14
    some = models.sample_negatives(df, "k", "y", 0.25)
    assert some.where("y = 1").count() == 20 and 60 < some.where("y = 0").count() < 130
    held = models.holdout_groups(df, ["i2"], ["AAV"])
    assert {(r.individual_id, r.held_out) for r in held.collect()} == {("i0", True), ("i1", False), ("i2", True)}


def test_fragment_lines_need_their_columns(spark):
    import pytest

    df = spark.createDataFrame([("c\t1\t5\t7",), ("c\t6\t9\t8",)], "value string")
    assert [tuple(r) for r in text.fragments_of(df).collect()] == [("c", 1, 5, 7), ("c", 6, 9, 8)]
    with pytest.raises(Exception, match="without 5 columns"):
        text.fragments_of(df, baits=True).collect()


def test_mates_must_agree(spark):
    probes = spark.createDataFrame([("a1", "F", "1", "AC"), ("a2", "F", "1", "AC"), ("b1", "F", "1", "AC"), ("b2", "F", "2", "AC"), ("c1", "F", "1", None)], "file string, flowcell string, lane string, index string")
    mates = spark.createDataFrame([("a1", "a2"), ("b1", "b2"), ("c1", "c2")], "one string, two string")
    assert {r.one for r in text.mates_that_differ(probes, mates).collect()} == {"b1", "c1"}


def test_scores_of_reads_with_missing_features(spark):
    df = spark.createDataFrame([(float(k % 7), float(k % 3), int(k % 7 > 3)) for k in range(200)], "a double, b double, y int")
    model = models.train_classifier(df, ["a", "b"], "y", rounds=2, depth=2)
    rows = spark.createDataFrame([(6.0,), (None,)], "a double")
    high, low = (r.score for r in models.score_reads(model, rows, ["a", "b"]).collect())
    assert high > 0.5 > low


def test_codons_across_an_intron_on_both_strands(spark):
    exons = spark.createDataFrame([("p", 100, 110, 1), ("p", 200, 220, 1), ("m", 100, 110, -1), ("m", 200, 220, -1)], "trx string, st long, en long, strand int")
    asked = spark.createDataFrame([(1, "p", 4, 4), (2, "m", 7, 7), (3, "p", 1, 2), (4, "m", 1, 1), (5, "p", 9, 11)], "id int, trx string, first_codon int, last_codon int")
    got = {}
    for r in an_pieces(asked, exons):
        got.setdefault(r.id, []).append((r.st, r.en))
    assert {k: sorted(v) for k, v in got.items()} == {1: [(109, 110), (200, 202)], 2: [(109, 110), (200, 202)], 3: [(100, 106)], 4: [(217, 220)], 5: [(214, 220)]}
    back = cohort.codon_range(spark.createDataFrame([("p", 109, 110), ("p", 200, 202), ("m", 200, 202)], "trx string, st long, en long"), exons)
    assert sorted((r.trx, r.st, r.first_codon, r.last_codon) for r in back.collect()) == [("m", 200, 7, 7), ("p", 109, 4, 4), ("p", 200, 4, 4)]


def an_pieces(asked, exons):
    return annotation.codon_pieces(asked, exons).collect()


def test_target_rows(spark):
    trx = spark.createDataFrame([("G", "g1", "T1", False, 105, 190, 1), ("G", "g1", "T2", True, 105, 190, 1), ("H", "g2", "T3", None, 105, 190, -1), ("H", "g2", "T4", None, 105, 195, -1)], "gene string, gene_id string, trx string, canonical boolean, cds_st long, cds_en long, strand int")
    rows = [(t, "c", st, en, k + 1) for t in ("T1", "T2", "T3", "T4") for k, (st, en) in enumerate([(90, 95), (100, 120), (180, 200), (300, 310)])]
    exons = spark.createDataFrame(rows, "trx string, chrom string, st long, en long, number int")
    kinds = "kind string, gene string, trx string, region_chrom string, region_st long, region_en long, numbers array<int>"
    ask = [("exon", "G", None, None, None, None, None), ("exon", "H", None, None, None, None, [1, 2, 4]), ("hotspot", "G", "T1", "c", 118, 182, None), ("hotspot", "G", "T1", "c", 130, 140, None), ("probe", "x", None, "d", 1, 2, None), ("exon_region", "H", "T3", "c", 1, 9, None)]
    got = sorted((r.chrom, r.st, r.en, r.info) for r in annotation.target_intervals(spark.createDataFrame(ask, kinds), trx, exons).collect())
    assert got == sorted([
        ("c", 88, 97, "gene|exon_1|G|g1|T2|106|190|1"), ("c", 98, 122, "gene|exon_2|G|g1|T2|106|190|1"), ("c", 178, 191, "gene|exon_3|G|g1|T2|106|190|1"),
        ("c", 105, 122, "gene|exon_2|H|g2|T4|106|195|-1"), ("c", 298, 312, "gene|exon_4|H|g2|T4|106|195|-1"),
        ("c", 118, 182, "hotspot|codons5-6|G|g1|T1|106|190|1"), ("d", 1, 2, "probe|x|.|.|.|.|.|."), ("c", 1, 9, "gene|exon_region|H|g2|T3|106|190|-1"),
    ])


def test_band_notation(spark):
    bands = spark.createDataFrame([("chr13", 0, 10, "p11"), ("chr13", 10, 20, "acen_q11"), ("chr13", 20, 30, "q21"), ("chr13", 30, 40, "qter"), ("chr1", 0, 10, "p11"), ("chr1", 10, 20, "q11"), ("chr1", 20, 40, "qter")], "chrom string, st long, en long, name string")
    rows = [(1, "chr13", 12, 39, "DEL"), (2, "chr1", 12, 39, "DEL"), (3, "chr1", 5, 15, "DUP"), (4, "chr13", 12, 39, "LOH"), (5, "chr13", 21, 25, "LOH"), (6, "chr9", 1, 2, "INS"), (7, "chr1", 1, 2, "INS")]
    df = variants.with_bands(spark.createDataFrame(rows, "id int, chrom string, st long, en long, svtype string"), bands)
    x = fn_variants.event_syntax(F.col("chrom"), F.col("st"), F.col("en"), F.col("svtype"), F.col("bands"))
    assert {r.id: (r.x.psyntax, r.x.bandstring) for r in df.select("id", x.alias("x")).collect()} == {
        1: ("seq[GRCh38] -13", "q11qter"), 2: ("seq[GRCh38] del(1)(q11qter)", "q11qter"), 3: ("seq[GRCh38] +1", "p11q11"), 4: ("seq[GRCh38] cnLOH(13)", "cnLOH(13)"), 5: ("seq[GRCh38] cnLOH(13)(q21q21)", "q21"),
        6: ("", "None"), 7: ("seq[GRCh38] ins(1)(p11p11)", "p11"),
    }
    end = "struct<chrom:string,pos:long,band:string,alt:string>"
    pairs = [
        (1, ("chr9", 5, "q34", "N[chr22:7["), ("chr22", 7, "q11", "]chr9:5]N"), "BND"), (2, ("chr22", 7, "q11", "]chr9:5]N"), ("chr9", 5, "q34", "N[chr22:7["), "BND"), (3, ("chr5", 5, "q34", "N]chrX:7]"), ("chrX", 7, None, "N]chr5:5]"), "BND"),
        (4, ("chr2", 50, "p12", "N]chr2:7]"), ("chr2", 7, "p21", "N]chr2:50]"), "INV"), (5, ("chr2", 5, "p12", "[chr2:70[N"), ("chr2", 70, "q21", "[chr2:5[N"), "INV"),
    ]
    y = fn_variants.breakend_syntax(F.col("a"), F.col("b"), F.col("t"))
    assert {r.id: tuple(r.y) for r in spark.createDataFrame(pairs, f"id int, a {end}, b {end}, t string").select("id", y.alias("y")).collect()} == {
        1: ("chr9:g.5(+)::chr22:g.7(+)", "seq[GRCh38] t(9;22)(q34;q11)", "q34;q11"), 2: ("chr9:g.5(+)::chr22:g.7(+)", "seq[GRCh38] t(9;22)(q34;q11)", "q34;q11"),
        3: ("chrX:g.7(+)::chr5:g.5(-)", "seq[GRCh38] t(X;5)(N/A;q34)", "N/A;q34"), 4: ("chr2:g.7(+)::chr2:g.50(-)", "seq[GRCh38] inv(2)(p12p21)", "p12p21"), 5: ("chr2:g.5(+)::chr2:g.70(-)", "seq[GRCh38] inv(2)(p12q21)", "p12q21"),
    }


def test_background_reads_are_capped_exactly(spark):
    kinds = "read_name string, chrom string, ref_start long, mapq int, cigar string, is_dup int, arm string"
    rows = [(f"r{k}", "c", 40 * k, 60, "100M", int(k % 9 == 0), "edited") for k in range(400)] + [("r1", "c", 40, 60, "100M", 0, "edited")]
    df = spark.createDataFrame(rows, kinds)
    sizes = spark.createDataFrame([("c", 16_000)], "chrom string, size long")
    targets = spark.createDataFrame([("c", 8_000)], "chrom string, pos long")
    windows = annotation.background_windows(targets, sizes, 6, far=2_000, width=1_000)
    mids = [r.st + 500 for r in windows.collect()]
    assert mids and all(abs(m - 8_000) >= 1_500 for m in mids)
    want = sorted((r[0], m) for r in rows for m in set(mids) if not r[5] and r[2] < m + 500 and m - 500 < r[2] + 100)
    every = sorted((r.read_name, r.pos) for r in annotation.background_reads(df, windows, 10**6).collect())
    assert every == want
    one, two = (sorted((r.read_name, r.pos) for r in annotation.background_reads(df.repartition(k), windows, 17).collect()) for k in (1, 5))
    assert one == two and len(one) == 17 and not set(one) - set(want)
