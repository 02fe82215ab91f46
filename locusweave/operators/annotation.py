"""Transcript annotation as joins: reading frames, coding peptides, target intervals, alternate contigs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locusweave.functions.cigar import cigar_total, clipped_overlap_share, parse_cigar
from locusweave.functions.variants import reverse_complement
from locusweave.operators.cohort import codon_range
from locusweave.operators.intervals import overlap_join
from locusweave.operators.ranks import first_rows
from locusweave.operators.reads import primary_reads, reads_at_loci
from locusweave.plans.scratch import saved
from locusweave.plans.size import broadcast_if_small

_BASES = "TCAG"
_AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"  # fixed values: the standard code in TCAG order


def codon_map() -> Column:
    """The standard genetic code as a map from codons to one-letter codes."""
    codons = [a + b + c for a in _BASES for b in _BASES for c in _BASES]
    return F.create_map(*[F.lit(x) for pair in zip(codons, _AMINO) for x in pair])


def translate(cds: Column) -> Column:
    """One-letter protein of a coding sequence; X for unknown codons, a last incomplete codon is left out."""
    n = F.floor(F.length(cds) / 3).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    table = codon_map()
    return F.array_join(F.transform(starts, lambda k: F.coalesce(F.element_at(table, F.substring(F.upper(cds), k * 3 + 1, F.lit(3))), F.lit("X"))), "")


def transcript_bounds(annotations: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Annotations with start, end and strand of their transcript, nulls if it is unknown."""
    known = transcripts.select("trx", F.col("st").alias("trx_st"), F.col("en").alias("trx_en"), F.col("strand").alias("trx_strand"))
    return annotations.join(known, "trx", "left")


def reading_frame(variants: DataFrame, exons: DataFrame) -> DataFrame:
    """Phase at each variant end (id, trx, pos): of the exon it lies in, or of the intron behind it.

    exons(trx, st, en, phase, end_phase). Both ends of an event are joined with & in the order of their positions; an
    event within one feature, or without a feature, gives null.
    """
    order = W.partitionBy("trx").orderBy("st")
    introns = exons.withColumn("_next", F.lead("st").over(order)).where(F.col("_next") > F.col("en"))
    parts = exons.select("trx", "st", "en", F.concat_ws("/", F.col("phase").cast("string"), F.col("end_phase").cast("string")).alias("frame"), F.concat(F.lit("e"), "st").alias("feature"))
    parts = parts.unionByName(introns.select("trx", F.col("en").alias("st"), F.col("_next").alias("en"), F.col("end_phase").cast("string").alias("frame"), F.concat(F.lit("i"), "en").alias("feature")))
    met = variants.join(parts, "trx").where((F.col("pos") >= F.col("st")) & (F.col("pos") < F.col("en")))
    ends = met.groupBy("id", "trx").agg(F.array_sort(F.collect_set(F.struct("pos", "frame", "feature"))).alias("x"))
    same = F.size(F.array_distinct(F.transform("x", lambda e: e["feature"]))) < F.size("x")
    return ends.select("id", "trx", F.when(~same, F.array_join(F.transform("x", lambda e: e["frame"]), "&")).alias("frame"))


def frameshift_peptide(variants: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Peptide downstream of a frameshift: variants(id, trx, cds_pos from 1, ref, alt), transcripts(trx, cds, utr).

    The changed sequence is read from the last whole codon through the 3' UTR to the first stop. Gives the peptide and
    the change of the protein's length; variants that keep the frame are left out.
    """
    rows = variants.where((F.length("alt") - F.length("ref")) % 3 != 0).join(transcripts, "trx")
    whole = F.concat("cds", F.coalesce("utr", F.lit("")))
    at = F.col("cds_pos").cast("int")
    changed = F.concat(F.substring(whole, F.lit(1), at - 1), "alt", F.substring(whole, at + F.length("ref"), F.length(whole)))
    first = F.floor((at - 1) / 3).cast("int")
    tail = F.substring_index(translate(F.substring(changed, first * 3 + 1, F.length(changed))), "*", 1)
    before = F.length(F.substring_index(translate(F.col("cds")), "*", 1))
    return rows.select("id", "trx", tail.alias("peptide"), (first + F.length(tail) - before).alias("length_change"))


def reference_peptide(annotations: DataFrame, transcripts: DataFrame) -> DataFrame:
    return annotations.join(transcripts.select("trx", F.substring_index(translate(F.col("cds")), "*", 1).alias("peptide")), "trx")


def canonical_transcripts(transcripts: DataFrame) -> DataFrame:
    """transcripts(gene, trx, canonical, cds_st, cds_en, ...), one of each gene: the marked one, else the longest coding span, then the name."""
    order = [F.coalesce(F.col("canonical").cast("boolean"), F.lit(False)).desc(), (F.col("cds_en") - F.col("cds_st")).desc_nulls_last(), F.col("trx").asc()]
    return transcripts.withColumn("_k", F.row_number().over(W.partitionBy("gene").orderBy(*order))).where("_k = 1").drop("_k")


def target_intervals(targets: DataFrame, transcripts: DataFrame, exons: DataFrame) -> DataFrame:
    """Rows of a panel: chrom, st, en, gene, info (fields joined by bars, as in a BED of targets).

    targets(kind, gene, trx, region_chrom, region_st, region_en, numbers): trx is null where the gene's canonical
    transcript is meant; positions count from 0, half-open, places in info from 1. transcripts(gene, gene_id, trx,
    canonical, cds_st, cds_en, strand); exons(trx, chrom, st, en, number). Kinds:

    exon: the exons (or those in the array numbers) with 3 bases before and 2 behind, but for those beyond the coding part
    on the 3' side, and clamped there. exon_region: the region. hotspot: the region with the codons that it touches;
    none if it touches no coding base. Any other kind: the region with its kind, of no transcript.
    """
    plain = ["kind", "gene", "trx", "region_chrom", "region_st", "region_en", "numbers"]
    own = transcripts.select(F.col("trx").alias("_trx"), "gene_id", "cds_st", "cds_en", "strand")
    best = canonical_transcripts(transcripts).select(F.col("gene").alias("_gene"), F.col("trx").alias("_best"))
    named = targets.select(*plain).where(F.col("kind").isin("exon", "exon_region", "hotspot"))
    named = named.join(broadcast_if_small(best), F.col("gene") == F.col("_gene"), "left").withColumn("trx", F.coalesce("trx", "_best")).drop("_gene", "_best")
    named = named.join(own, F.col("trx") == F.col("_trx")).drop("_trx")
    tail = ["gene", "gene_id", "trx", F.col("cds_st") + 1, "cds_en", "strand"]
    info = lambda *first: F.concat_ws("|", *[c.cast("string") if not isinstance(c, str) else F.col(c).cast("string") for c in (*first, *tail)]).alias("info")
    ex = exons.select(F.col("trx").alias("_trx"), "chrom", F.col("st").alias("ex_st"), F.col("en").alias("ex_en"), "number")
    each = named.where("kind = 'exon'").join(ex, F.col("trx") == F.col("_trx")).where(F.col("numbers").isNull() | F.array_contains("numbers", F.col("number")))
    st, en, up = F.col("ex_st") - 2, F.col("ex_en") + 2, F.col("strand") > 0
    each = each.where(~((up & (st > F.col("cds_en"))) | (~up & (en < F.col("cds_st") + 1))))
    low, high = F.when(~up & (st < F.col("cds_st") + 1), F.col("cds_st")).otherwise(st), F.when(up & (en > F.col("cds_en")), F.col("cds_en") + 1).otherwise(en)
    out = each.select("chrom", low.alias("st"), high.alias("en"), "gene", info(F.lit("gene"), F.concat(F.lit("exon_"), F.col("number").cast("string"))))
    region = [F.col("region_chrom").alias("chrom"), F.col("region_st").alias("st"), F.col("region_en").alias("en"), "gene"]
    out = out.unionByName(named.where("kind = 'exon_region'").select(*region, info(F.lit("gene"), F.lit("exon_region"))))
    hot = named.where("kind = 'hotspot'").select(*[c for c in named.columns if c != "numbers"])
    coding = exons.select("trx", "st", "en").join(own.select("_trx", "cds_st", "cds_en", "strand"), F.col("trx") == F.col("_trx"))
    coding = coding.select("trx", F.greatest("st", "cds_st").alias("st"), F.least("en", "cds_en").alias("en"), "strand").where("st < en")
    regions = hot.select("trx", F.col("region_st").alias("st"), F.col("region_en").alias("en")).distinct()
    codons = codon_range(regions, coding).select(F.col("trx").alias("_trx"), F.col("st").alias("_st"), F.col("en").alias("_en"), "first_codon", "last_codon")
    hot = hot.join(codons, (F.col("trx") == F.col("_trx")) & (F.col("region_st") == F.col("_st")) & (F.col("region_en") == F.col("_en")))
    first, last = F.col("first_codon").cast("string"), F.col("last_codon").cast("string")
    out = out.unionByName(hot.select(*region, info(F.lit("hotspot"), F.when(first == last, F.concat(F.lit("codon"), first)).otherwise(F.concat(F.lit("codons"), first, F.lit("-"), last)))))
    other = targets.where(~F.col("kind").isin("exon", "exon_region", "hotspot"))
    return out.unionByName(other.select(*region, F.concat(F.col("kind"), F.lit("|"), F.col("gene"), F.lit("|.|.|.|.|.|.")).alias("info")))


def codon_pieces(codons: DataFrame, exons: DataFrame) -> DataFrame:
    """codons(id, trx, first_codon, last_codon) -> id, trx, st, en: the genome pieces of the codons, one for each exon that they touch.

    exons(trx, st, en, strand) hold coding bases only; the inverse of codon_range.
    """
    order = W.partitionBy("trx").orderBy(F.col("st") * F.col("strand")).rowsBetween(W.unboundedPreceding, -1)
    placed = exons.withColumn("_from", F.coalesce(F.sum(F.col("en") - F.col("st")).over(order), F.lit(0))).withColumn("_to", F.col("_from") + F.col("en") - F.col("st"))
    met = codons.withColumn("_a", (F.col("first_codon") - 1) * 3).withColumn("_b", F.col("last_codon") * 3).join(placed, "trx").where("_a < _to and _from < _b")
    skip, keep = F.greatest("_a", "_from") - F.col("_from"), F.least("_b", "_to") - F.col("_from")
    up = F.col("strand") > 0
    return met.select("id", "trx", F.when(up, F.col("st") + skip).otherwise(F.col("en") - keep).alias("st"), F.when(up, F.col("st") + keep).otherwise(F.col("en") - skip).alias("en"))


def alternate_contig(left: Column, alt: Column, right: Column, turn_right: Column) -> Column:
    """Flank, allele, flank; the right flank of a breakend is reverse-complemented where its bracket says so."""
    return F.concat(left, alt, F.when(turn_right, reverse_complement(right)).otherwise(right))


def resolve_symbolic(svtype: Column, bases: Column) -> Column:
    """(ref, alt) of a deletion or duplication from the reference bases of its span, the anchor first."""
    anchor = F.substring(bases, 1, 1)
    return F.when(svtype == "DEL", F.struct(bases.alias("ref"), anchor.alias("alt"))).when(svtype == "DUP", F.struct(anchor.alias("ref"), bases.alias("alt")))


def event_gate(df: DataFrame, near: int = 25, mapq: int = 40) -> DataFrame:
    """Evidence of split reads that stays.

    df(svtype, d1, d2, mapq, mate_mapq, pos, pos2, read_start, mate_start, template, proper): d1 and d2 are the distances
    of the ends to the closest target, a null is far. A deletion, duplication or insertion needs a near end and, in a
    proper pair, both ends inside the pair. A breakend needs a read of mapq or more, and a supplementary alignment of
    mapq or more or a near end.
    """
    close = lambda c: F.coalesce(F.col(c) <= near, F.lit(False))
    any_near = close("d1") | close("d2")
    first = F.least("read_start", "mate_start")
    outside = F.col("proper") & ((F.least("pos", "pos2") < first) | (F.greatest("pos", "pos2") > first + F.col("template")))
    collinear = any_near & ~F.coalesce(outside, F.lit(False))
    breakend = (F.col("mapq") >= mapq) & ((F.col("mate_mapq") >= mapq) | any_near)
    return df.where(F.when(F.col("svtype") == "BND", breakend).otherwise(collinear))


def edit_event_filters(df: DataFrame, least: int = 1, control: int = 0, near: int = 25) -> DataFrame:
    """Events with reads, no control support, close to a target and without N in the allele; REF rows all pass."""
    good = (F.col("n") >= least) & (F.col("control") <= control) & (F.col("distance") <= near) & ~F.col("alt").contains("N")
    return df.where((F.col("alt") == "REF") | good)


def chimeric_junctions(reads: DataFrame, contig: str, clip: int = 20, mapq: int = 1, most_mismatches: int = 1, share: float = 0.2, mate_length: int = 151) -> DataFrame:
    """Places on other contigs to which reads of an insert contig lead: read_name, kind, chrom, st, en, strand.

    reads(read_name, flag, chrom, mapq, cigar, sa, mate_chrom, mate_pos from 0): primary reads of mapq above 0 count. A
    pair that is not proper, with its mate on another contig, leads to the mate, `mate_length` on where that is forward
    (kind pair). A proper read that is clipped by `clip` at its outer end leads to each supplementary alignment (sa:
    chrom,pos,strand,cigar,mapq,nm; joined by semicolons) on another contig of `mapq` or more and few mismatches, if that
    matches less than `share` of the places which the read matches (kind split); on the forward strand the junction is
    behind its matched bases.
    """
    bit = lambda b: F.col("flag").bitwiseAND(b) > 0
    own = reads.where((F.col("chrom") == contig) & (F.col("mapq") > 0) & (F.col("flag").bitwiseAND(0x4 | 0x100 | 0x400 | 0x800) == 0))
    apart = ~bit(0x2) & ~bit(0x8) & bit(0x1) & (F.col("mate_chrom") != F.col("chrom"))
    forward = ~bit(0x20)
    pairs = own.where(apart).select(
        "read_name", F.lit("pair").alias("kind"), F.col("mate_chrom").alias("chrom"), (F.col("mate_pos") + F.when(forward, mate_length).otherwise(0)).cast("long").alias("en"), F.when(forward, "+").otherwise("-").alias("strand")
    )
    ops = parse_cigar(F.col("cigar"))
    outer = F.when(bit(0x10), F.element_at(ops, -1)).otherwise(F.get(ops, F.lit(0)))
    clipped = own.where(~F.coalesce(apart, F.lit(False)) & bit(0x2)).withColumn("outer", outer).where((F.col("outer.op") == "S") & (F.col("outer.len") >= clip))
    parts = clipped.select("read_name", "cigar", F.explode(F.split("sa", ";")).alias("x")).withColumn("p", F.split("x", ",")).where(F.size("p") >= 6)
    at = lambda k: F.get("p", F.lit(k))
    parts = parts.where((at(0) != contig) & (at(4).try_cast("int") >= mapq) & (at(5).try_cast("int") <= most_mismatches))
    parts = parts.where(clipped_overlap_share(F.col("cigar"), at(3)) < share)
    matched_bases = F.when(at(2) == "+", cigar_total(at(3), "M=X")).otherwise(F.lit(0))
    splits = parts.select("read_name", F.lit("split").alias("kind"), at(0).alias("chrom"), (at(1).try_cast("long") + matched_bases).alias("en"), at(2).alias("strand"))
    return pairs.unionByName(splits).select("read_name", "kind", "chrom", (F.col("en") - 1).alias("st"), "en", "strand")


def background_windows(targets: DataFrame, sizes: DataFrame, n: int, far: int = 500_000, width: int = 1000) -> DataFrame:
    """Up to n windows per chromosome (chrom, size) at hashed places at least `far` from each target."""
    place = F.conv(F.substring(F.md5(F.concat_ws(":", "chrom", F.col("k").cast("string"))), 1, 12), 16, 10).cast("long") % F.col("size")
    windows = sizes.select("chrom", "size", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("k")).select("chrom", "k", place.alias("st")).withColumn("en", F.col("st") + width)
    marks = targets.select("chrom", F.col("pos").alias("st"), (F.col("pos") + 1).alias("en")).distinct()
    hit = overlap_join(windows, marks, far, far).select("chrom", "k").distinct()
    return windows.join(hit, ["chrom", "k"], "left_anti")


def background_reads(reads: DataFrame, windows: DataFrame, n: int) -> DataFrame:
    """Primary reads in the windows (chrom, st, en) of background_windows, n of them exactly where there are so many.

    A read is there once for each window that it meets, with `pos`, the window's middle. Those with the least hashes of
    name, start and window stay. A first pass counts the hashes by their first four digits, which tells the digits up to
    which rows are needed; only those rows are written and looked into for the exact edge, so nothing is sorted and
    reruns agree.
    """
    half = F.floor((F.col("en") - F.col("st")) / 2).cast("long")
    loci = saved(windows.select("chrom", (F.col("st") + half).alias("pos"), half.alias("_half")).distinct(), "background-loci")
    pad = loci.agg(F.max("_half")).first()[0] or 0  # windows are of one width
    met = reads_at_loci(primary_reads(reads), loci.select("chrom", "pos"), int(pad), 0).select(*reads.columns, "pos")
    met = met.withColumn("_key", F.concat_ws(":", "chrom", "pos", "read_name", "ref_start", "cigar"))
    cells = saved(met.groupBy(F.substring(F.md5("_key"), 1, 4).alias("_cell")).agg(F.count(F.lit(1)).alias("_n")), "background-cells")
    # One row for each cell, 65,536 at most.
    upto = cells.select("_cell", (F.sum("_n").over(W.orderBy("_cell")) - F.col("_n")).alias("_before"))
    edge = upto.where(F.col("_before") < n).agg(F.max("_cell")).first()[0] or ""
    near = met.where(F.substring(F.md5("_key"), 1, 4) <= edge)
    near = saved(near.withColumn("_hash", F.conv(F.substring(F.md5("_key"), 1, 12), 16, 10).cast("double")).withColumn("_all", F.lit("all")), "background-reads")
    quotas = saved(near.groupBy("_all").agg(F.count(F.lit(1)).alias("n")).withColumn("quota", F.lit(n)), "background-quota")
    return first_rows(near, "_all", F.col("_hash"), "_key", quotas, "_first").where("_first").select(*reads.columns, "pos")


def cross_sample_negatives(labels: DataFrame, owners: DataFrame, least: int = 5, low: float = 0.01, most: int | None = None) -> DataFrame:
    """Sites (sample, chrom, pos, share, reads) of other samples with hardly an indel and enough reads.

    With `most`, each sample gives so many sites, the least hashes first.
    """
    rows = labels.where((F.col("share") < low) & (F.col("reads") >= least)).join(owners, ["sample", "chrom", "pos"], "left_anti")
    if most is None:
        return rows
    order = F.md5(F.concat_ws(":", "sample", "chrom", F.col("pos").cast("string")))
    return rows.withColumn("_k", F.row_number().over(W.partitionBy("sample").orderBy(order))).where(F.col("_k") <= most).drop("_k")


def score_loci(scores: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Reads at or above the threshold and mean score in percent, per locus."""
    return scores.groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("reads"), F.count_if(F.col("score") >= threshold).alias("predicted"), F.round(F.avg("score") * 100, 2).alias("mean_pct"))
