"""Column functions on variant records, annotations and event syntax."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Three-letter codes of amino acids and stop.
AMINO = {
    "Ala": "A", "Arg": "R", "Asn": "N", "Asp": "D", "Cys": "C", "Gln": "Q", "Glu": "E", "Gly": "G", "His": "H", "Ile": "I", "Leu": "L",
    "Lys": "K", "Met": "M", "Phe": "F", "Pro": "P", "Ser": "S", "Thr": "T", "Trp": "W", "Tyr": "Y", "Val": "V", "Ter": "*",
}


def header_fields(description: Column) -> Column:
    """Names after the colon of a header description, split on the pipe; empty without a colon."""
    bare = F.replace(description, F.lit('"'), F.lit(""))
    return F.when(F.contains(bare, F.lit(":")), F.split(F.trim(F.substring_index(bare, ":", -1)), r"[|]")).otherwise(F.array().cast("array<string>"))


def one_letter_protein(s: Column) -> Column:
    """Protein change with one-letter codes; %3D becomes =."""
    out = F.replace(s, F.lit("%3D"), F.lit("="))
    for three, one in AMINO.items():
        out = F.replace(out, F.lit(three), F.lit(one))
    return out


def reverse_complement(s: Column) -> Column:
    return F.reverse(F.translate(s, "ACGTUNacgtun", "TGCAANtgcaan"))


def parse_region(s: Column) -> Column:
    """(chrom, st, en, problem) of chrom:start-end with or without commas; start and end are null in a bad region."""
    bare = F.replace(s, F.lit(","), F.lit(""))
    pattern = r"^(.+):(\d+)-(\d+)$"
    st, en = (F.try_to_number(F.nullif(F.regexp_extract(bare, pattern, k), F.lit("")), F.lit("9" * 18)).cast("long") for k in (2, 3))
    problem = F.when(st.isNull() | en.isNull(), "bad format").when(st > en, "start after end")
    return F.struct(F.nullif(F.regexp_extract(bare, pattern, 1), F.lit("")).alias("chrom"), st.alias("st"), en.alias("en"), problem.alias("problem"))


def parse_breakend(alt: Column) -> Column:
    """(chrom, pos, bracket, before, inserted) of a breakend allele, nulls for others.

    bracket is [ or ]; before tells that the mate stands before the inserted bases.
    """
    pattern = r"^([A-Za-z.]*)([\[\]])([^\[\]:]+):(\d+)[\[\]]([A-Za-z.]*)$"
    part = lambda k: F.nullif(F.regexp_extract(alt, pattern, k), F.lit(""))
    return F.struct(part(3).alias("chrom"), part(4).cast("long").alias("pos"), part(2).alias("bracket"), (part(1).isNull() & part(2).isNotNull()).alias("before"), F.coalesce(part(1), part(5)).alias("inserted"))


def format_breakend(chrom: Column, pos: Column, bracket: Column, before: Column, inserted: Column) -> Column:
    mate = F.concat(bracket, chrom, F.lit(":"), pos.cast("string"), bracket)
    return F.when(before, F.concat(mate, inserted)).otherwise(F.concat(inserted, mate))


def abundance_pct(ref: Column, alt: Column) -> Column:
    """Share of supporting reads in percent to one place, 0 without reads."""
    total = ref + alt
    return F.when(total > 0, F.round(100.0 * alt / total, 1)).otherwise(F.lit(0.0))


def segment_fraction(cn: Column, normal: Column | int, ratio: Column, log2: bool = False) -> Column:
    """Share of cells with copy number cn that gives a segment's linear (or log2) ratio to `normal` copies."""
    ratio = F.pow(F.lit(2.0), ratio) if log2 else ratio
    return normal * (ratio - 1) / F.nullif(cn - normal, F.lit(0))


def cell_fraction(cn: Column, sm: Column, maf: Column, single: Column, loh: Column) -> Column:
    """Percent of cells with a copy-number event from the segment mean and from the allele fraction, to two places.

    By MAF, if above 0: 200 maf. By mean, except for events without a change of copies (loh): against one normal copy
    where `single` says so (X and Y of a male) and cn is not 1, else against two where cn is not 2. Negative values do
    not count. Where both count and differ by more than 0.25 the mean decides, else the smaller; above 100 gives 99.
    """
    by_maf = F.when(maf > 0, F.round(maf * 200, 2))
    normal = F.when(single & (cn != 1), 1).when(cn != 2, 2)
    by_mean = F.when(~loh, F.round(segment_fraction(cn, normal, sm) * 100, 2))
    by_maf, by_mean = (F.when(x >= 0, x) for x in (by_maf, by_mean))
    value = F.when(F.abs(by_mean - by_maf) > 0.25, by_mean).otherwise(F.least(by_mean, by_maf))
    return F.when(value > 100, F.lit(99.0)).otherwise(value)


def truncate_allele(s: Column, word: str, most: int = 20) -> Column:
    """Long alleles as word and length."""
    return F.when(F.length(s) > most, F.concat(F.lit(word), F.length(s).cast("string"))).otherwise(s)


def range_flag(value: Column, low: Column | None = None, high: Column | None = None) -> Column:
    """The value as text, marked (!) if it is outside the bounds."""
    out = F.lit(False)
    if low is not None:
        out = out | (value < low)
    if high is not None:
        out = out | (value > high)
    return F.concat(value.cast("string"), F.when(out, F.lit(" (!)")).otherwise(F.lit("")))


def parse_target_info(s: Column) -> Column:
    """(min_mismatches, tools, pam) from MISMATCHES=..,SRC=..,PAM=.. fields; 99 mismatches if none are given."""
    field = lambda k: F.nullif(F.regexp_extract(s, rf"(?:^|;){k}=([^;]*)", 1), F.lit(""))
    least = F.array_min(F.transform(F.split(field("MISMATCHES"), "[,|]"), lambda x: F.try_to_number(x, F.lit("999999")).cast("int")))
    return F.struct(F.coalesce(least, F.lit(99)).alias("min_mismatches"), F.coalesce(F.size(F.split(field("SRC"), "[,|]")), F.lit(0)).alias("tools"), field("PAM").alias("pam"))


def effect_label(exon: Column, intron: Column, distance: Column, upstream: Column) -> Column:
    """exonN, intronN, Dbp upstream or downstream, else intragenic."""
    side = F.when(upstream, F.lit("bp upstream")).otherwise(F.lit("bp downstream"))
    return (
        F.when(exon != "", F.concat(F.lit("exon"), F.substring_index(exon, "/", 1)))
        .when(intron != "", F.concat(F.lit("intron"), F.substring_index(intron, "/", 1)))
        .when(distance > 0, F.concat(distance.cast("string"), side))
        .otherwise("intragenic")
    )


def known_gene_effect(st: Column, en: Column, gene_st: Column, gene_en: Column, strand: Column, svtype: Column) -> Column:
    """(distance, consequence) of an event and a known gene: 0 on overlap, else the least of four endpoint gaps.

    An event over the whole gene is an ablation (DEL) or an amplification; one that overlaps it, its type in words; one
    beside it lies upstream or downstream by strand.
    """
    meets = (st <= gene_en) & (gene_st <= en)
    gap = F.least(F.abs(st - gene_st), F.abs(st - gene_en), F.abs(en - gene_st), F.abs(en - gene_en))
    whole = (st <= gene_st) & (en >= gene_en)
    before = (en < gene_st) == (strand > 0)
    what = (
        F.when(whole & (svtype == "DEL"), "transcript_ablation").when(whole & (svtype == "DUP"), "transcript_amplification")
        .when(meets & (svtype == "DEL"), "feature_truncation").when(meets, "feature_elongation")
        .when(before, "upstream_gene_variant").otherwise("downstream_gene_variant")
    )
    return F.struct(F.when(meets, F.lit(0)).otherwise(gap).cast("long").alias("distance"), what.alias("consequence"))


def chromosome_rank(chrom: Column) -> Column:
    """Number of a chromosome; X, Y and M are 23 to 25, others null."""
    bare = F.regexp_replace(chrom, "^chr", "")
    return F.when(bare == "X", 23).when(bare == "Y", 24).when(bare.isin("M", "MT"), 25).otherwise(bare.try_cast("int"))


def chromosome_key(chrom: Column) -> Column:
    """A number to sort chromosomes by: their rank, infinity for all others."""
    return F.coalesce(chromosome_rank(chrom).cast("double"), F.lit(float("inf")))


#: Chromosomes whose short arm has no genes to speak of, so that their long arm stands for the whole.
ACROCENTRICS = ("chr13", "chr14", "chr15", "chr21", "chr22")
#: Fixed value: the build that names are given for.
BUILD = "seq[GRCh38] "


def bare(chrom: Column) -> Column:
    return F.regexp_replace(chrom, "^chr", "")


def event_syntax(chrom: Column, st: Column, en: Column, svtype: Column, bands: Column) -> Column:
    """(csyntax, psyntax, bandstring) of a deletion, duplication, insertion or copy-neutral loss (LOH).

    bands: (first, last, n, q11, qter), the first and last cytoband on the event, their number, and whether a band q11
    and the end of the long arm are among them. An event over both arms, or over the long arm of an acrocentric
    chromosome, is one of the whole chromosome. Without bands psyntax is empty and bandstring None.
    """
    number, first, last = bare(chrom), bands["first"], bands["last"]
    has = F.coalesce(bands["n"], F.lit(0)) > 0
    whole = (F.contains(first, F.lit("p")) & F.contains(last, F.lit("q"))) | (bands["q11"] & bands["qter"] & chrom.isin(*ACROCENTRICS))
    loss_of = svtype == "LOH"
    kind = F.when(loss_of, "cnLOH").otherwise(F.lower(svtype))
    part = F.concat(F.lit(BUILD), kind, F.lit("("), number, F.lit(")("), first, last, F.lit(")"))
    all_of_it = F.when(loss_of, F.concat(F.lit("cnLOH("), number, F.lit(")"))).otherwise(F.concat(F.when(svtype == "DEL", "-").otherwise("+"), number))
    told = F.when(bands["n"] > 1, F.concat(first, last)).otherwise(first)
    return F.struct(
        F.format_string("%s:g.%d_%d%s", chrom, st, en, kind).alias("csyntax"),
        F.when(~has, F.lit("")).when(whole, F.concat(F.lit(BUILD), all_of_it)).otherwise(part).alias("psyntax"),
        F.when(~has, F.lit("None")).when(whole & loss_of, all_of_it).otherwise(told).alias("bandstring"),
    )


def bracket_orientation(alt: Column) -> Column:
    """-1 where the bracket of a breakend's allele says that the partner is turned, else 1."""
    return F.when(alt.startswith("[") | (F.instr(alt, "]") > 1), -1).otherwise(1)


def breakend_syntax(left: Column, right: Column, svtype: Column) -> Column:
    """(csyntax, psyntax, bandstring) of a breakend or inversion; left and right are (chrom, pos, band, alt).

    A left side whose allele begins with a bracket is the downstream one: the sides change places, and the orientation
    is that of the allele then on the left. Breakends name the lower chromosome first; X, Y and M come before numbers.
    Inversions name the lower place first, on the short arm the band of the higher one first.
    """
    turn = left["alt"].startswith("[") | left["alt"].startswith("]")
    pick = lambda test, x, y, f: F.when(test, y[f]).otherwise(x[f])
    side = lambda x, y: F.struct(*[pick(turn, x, y, f).alias(f) for f in ("chrom", "pos", "band", "alt")])
    one, two = side(left, right), side(right, left)
    sign = F.when(bracket_orientation(one["alt"]) == 1, "+").otherwise("-")
    rank = lambda c: F.when(c == "chrX", -1).when(c == "chrY", -2).when(c == "chrM", -3).otherwise(bare(c).try_cast("int"))
    inversion = svtype == "INV"
    kept = F.when(inversion, one["pos"] <= two["pos"]).otherwise(one["chrom"].isin("chrX", "chrY", "chrM") | F.coalesce(rank(one["chrom"]) < rank(two["chrom"]), F.lit(False)))
    f = lambda name: F.when(kept, one[name]).otherwise(two[name])
    g = lambda name: F.when(kept, two[name]).otherwise(one[name])
    low, high = F.coalesce(f("band"), F.lit("N/A")), F.coalesce(g("band"), F.lit("N/A"))
    short = low.startswith("p") & high.startswith("p")
    bands = F.when(inversion, F.when(short, F.concat(high, low)).otherwise(F.concat(low, high))).otherwise(F.concat(low, F.lit(";"), high))
    names = F.when(inversion, F.concat(F.lit("inv("), bare(f("chrom")))).otherwise(F.concat(F.lit("t("), bare(f("chrom")), F.lit(";"), bare(g("chrom"))))
    return F.struct(
        F.format_string("%s:g.%d(+)::%s:g.%d(%s)", f("chrom"), f("pos"), g("chrom"), g("pos"), sign).alias("csyntax"),
        F.concat(F.lit(BUILD), names, F.lit(")("), bands, F.lit(")")).alias("psyntax"), bands.alias("bandstring"),
    )


def natural_key(s: Column) -> Column:
    """A key that sorts digit runs by value."""
    return F.array_join(F.transform(F.regexp_extract_all(s, F.lit(r"(\d+|\D+)"), F.lit(1)), lambda x: F.when(x.rlike(r"^\d"), F.lpad(x, 20, "0")).otherwise(x)), "")


def filters_of(filter_: Column) -> Column:
    """Filter names as an array, empty for PASS."""
    return F.array_remove(F.split(filter_, ";"), "PASS")


def fusion_syntax(gene_a: Column, strand_a: Column, chrom_a: Column, gene_b: Column, strand_b: Column, chrom_b: Column, orientation: Column) -> Column:
    """gene::gene for pairs that can fuse (orientation 0 or more), gene//gene for others, strands in brackets.

    The partner of the lower chromosome comes first.
    """
    side = lambda g, s: F.concat(g, F.when(s > 0, "(+)").otherwise("(-)"))
    link = F.when(F.coalesce(orientation, F.lit(-1)) >= 0, "::").otherwise("//")
    swap = F.coalesce(chromosome_rank(chrom_a) > chromosome_rank(chrom_b), F.lit(False))
    one, two = side(gene_a, strand_a), side(gene_b, strand_b)
    return F.when(swap, F.concat(two, link, one)).otherwise(F.concat(one, link, two))


def coding_change(hgvsc: Column, hgvsp: Column, distance: Column, upstream: Column, first: Column, last: Column) -> Column:
    """(coding, protein) of an annotation: what follows the colon of its HGVS names.

    Without a coding name: the distance to the gene, else c.? for an event that an exon boundary cuts. Without a protein
    name: p.(a_b)del from the first and last coding base, p.? if one is unknown.
    """
    after = lambda x: F.nullif(F.substring_index(x, ":", -1), F.lit(""))
    side = F.concat(distance.cast("string"), F.when(upstream, "bp upstream").otherwise("bp downstream"))
    coding = F.coalesce(after(hgvsc), F.when(distance > 0, side), F.lit("c.?"))
    span = F.format_string("p.(%d_%d)del", F.ceil(first / 3), F.ceil(last / 3))
    protein = F.coalesce(one_letter_protein(after(hgvsp)), F.when(first.isNotNull() & last.isNotNull(), span), F.lit("p.?"))
    return F.struct(coding.alias("coding"), protein.alias("protein"))
