"""Variant tables: annotation rows, filters, breakend mates, gene pairs, recurrence and event summaries.

Variants: id, mate_id, sample, chrom, pos, filter, ref_reads, alt_reads, svtype, svlen, csq.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locusweave.functions import variants as fn
from locusweave.operators.intervals import cluster_intervals, overlap_join, with_bridges
from locusweave.plans.scratch import saved
from locusweave.plans.size import broadcast_if_small

FIELDS = ("allele", "symbol", "trx", "consequence", "pick")


#: Annotation fields that are numbers: whole ones that are 0 where missing, and places.
COUNTED, PLACES = ("strand", "distance", "pick"), ("ann_st", "ann_en")


def explode_annotations(df: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row per annotation of csq with its number and fields.

    Empty fields are null. Dots are taken off an allele, an empty symbol is the gene's id where there is a field gene,
    strand, distance and pick are whole numbers (0 where missing), ann_st and ann_en are places.
    """
    rows = df.select(*[c for c in df.columns if c != "csq"], F.posexplode(F.split("csq", ",")).alias("ann", "_x"))
    parts = F.split("_x", r"[|]")
    value = {f: F.nullif(F.get(parts, F.lit(k)), F.lit("")) for k, f in enumerate(fields)}
    if "allele" in value:
        value["allele"] = F.nullif(F.btrim(value["allele"], F.lit(".")), F.lit(""))
    if "gene" in value and "symbol" in value:
        value["symbol"] = F.coalesce(value["symbol"], value["gene"])
    value |= {f: F.coalesce(value[f].try_cast("int"), F.lit(0)) for f in COUNTED if f in value}
    value |= {f: value[f].try_cast("long") for f in PLACES if f in value}
    return rows.select(*[c for c in rows.columns if c != "_x"], *[v.alias(f) for f, v in value.items()])


def annotation_values(csq: Column, index: int, allele: Column | None = None, allele_index: int = 0) -> Column:
    """Distinct non-empty values of one field over all annotations, in order; with an allele, over that allele's.

    An annotation too short to have the field raises an error.
    """
    parts = F.transform(F.split(csq, ","), lambda x: F.split(x, r"[|]"))
    if allele is not None:
        parts = F.filter(parts, lambda p: F.get(p, F.lit(allele_index)) == allele)
    short = F.raise_error(F.concat(F.lit("an annotation without field "), F.lit(str(index)))).cast("string")
    values = F.transform(parts, lambda p: F.when(F.size(p) <= index, short).otherwise(F.get(p, F.lit(index))))
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))


def _joined(names: Column) -> Column:
    return F.when(F.size(names) == 0, "PASS").otherwise(F.array_join(names, ";"))


def soft_filters(df: DataFrame, min_pr: int = 2, min_sr: int = 2, min_pct: float = 5.0) -> DataFrame:
    """Filters with Imprecise, MinSvReads, SvInsertion and MinSvAbundance added; no filter left is PASS.

    df(filter, pr_ref, pr_alt, sr_ref, sr_alt, imprecise, insertion_hits): paired and split reads, a mark, and what the
    insertion hits, or null. The abundance counts only where there are reference reads.
    """
    ref, alt = F.col("pr_ref") + F.col("sr_ref"), F.col("pr_alt") + F.col("sr_alt")
    marks = F.array(
        F.when(F.col("imprecise"), F.lit("Imprecise")), F.when((F.col("pr_alt") < min_pr) | (F.col("sr_alt") < min_sr), F.lit("MinSvReads")),
        F.when(F.col("insertion_hits").isNotNull(), F.lit("SvInsertion")), F.when((ref > 0) & (100.0 * alt / (ref + alt) < min_pct), F.lit("MinSvAbundance")),
    )
    return df.withColumn("filter", _joined(F.array_union(fn.filters_of(F.col("filter")), F.array_compact(marks))))


def hard_filters(df: DataFrame, least: int = 1000, most: int = 20_000_000, min_pr: int = 0, min_sr: int = 0) -> DataFrame:
    """Structural variants that are kept for themselves; see keep_with_mate for the mates of breakends.

    df(filter, svtype, svlen, pr_alt, sr_alt, bands, genes, known_genes, effects, contig): arrays of the cytobands, the
    genes, the listed genes among them and the protein-changing consequences. All need support and the least reads of
    both kinds. Deletions and duplications need both kinds and lie on one arm. These and insertions need a length in
    [least, most], a gene and a protein-changing consequence. Breakends need a listed gene, or a contig and either PASS
    or a gene. Null arrays are empty.
    """
    any_of = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    arm = lambda letter: F.coalesce(F.exists("bands", lambda b: b.contains(letter)), F.lit(False))
    supported = ((F.col("pr_alt") > 0) | (F.col("sr_alt") > 0)) & (F.col("pr_alt") >= min_pr) & (F.col("sr_alt") >= min_sr)
    copies = ~F.col("svtype").isin("DEL", "DUP") | ((F.col("pr_alt") > 0) & (F.col("sr_alt") > 0) & ~(arm("p") & arm("q")))
    passing = F.array_contains(F.split("filter", ";"), "PASS")
    breakend = any_of("known_genes") | (F.col("contig").isNotNull() & (passing | any_of("genes")))
    sized = F.coalesce(F.col("svlen").between(least, most), F.lit(False)) & any_of("genes") & any_of("effects")
    kind = F.when(F.col("svtype") == "BND", breakend).when(F.col("svtype").isin("INS", "DEL", "DUP"), sized).otherwise(F.lit(True))
    return df.where(supported & copies & kind)


def keep_with_mate(df: DataFrame, passed: DataFrame) -> DataFrame:
    """Rows that passed, and rows whose mate did."""
    ids = passed.select("id").union(passed.select(F.col("mate_id").alias("id"))).distinct()
    return df.join(ids, "id", "left_semi")


def mate_join(df: DataFrame) -> DataFrame:
    """Each breakend pair once: columns of the lower id, and id, chrom, pos of its mate."""
    mates = df.select(F.col("id").alias("mate_id"), F.col("chrom").alias("mate_chrom"), F.col("pos").alias("mate_pos"))
    return df.join(mates, "mate_id").where("id < mate_id")


def small_variant_filter(df: DataFrame, least: int = 3, hard: float = 1.0, soft: float = 2.0, allowed: tuple[str, ...] = ()) -> DataFrame:
    """Enough reads and abundance, and PASS or more abundance; LowReads and MinVAF mark what is under the limits.

    A row with one of the allowed tags (column tags, an array) stays whatever its reads. A lone multiallelic counts as PASS.
    """
    vaf = fn.abundance_pct(F.col("ref_reads"), F.col("alt_reads"))
    df = df.withColumn("filter", F.when(F.col("filter") == "multiallelic", "PASS").otherwise(F.col("filter")))
    good = (F.col("alt_reads") >= least) & (vaf >= hard) & ((F.col("filter") == "PASS") | (vaf >= soft))
    kept = df.where(F.coalesce(F.arrays_overlap("tags", F.array(*map(F.lit, allowed))), F.lit(False)) | good) if allowed else df.where(good)
    marks = F.array_compact(F.array(F.when(F.col("alt_reads") < least, F.lit("LowReads")), F.when(vaf < soft, F.lit("MinVAF"))))
    return kept.withColumn("vaf", vaf).withColumn("filter", _joined(F.array_union(fn.filters_of(F.col("filter")), marks)))


def size_gate(df: DataFrame, most: int = 1000) -> DataFrame:
    """No breakends, no event longer than `most`, no row without support; af to four places."""
    total = F.col("ref_reads") + F.col("alt_reads")
    return df.where((F.col("svtype") != "BND") & (F.col("svlen") <= most) & (F.col("alt_reads") > 0)).withColumn("af", F.round(F.col("alt_reads") / total, 4))


def reportable_variants(df: DataFrame, transcripts: DataFrame, consequences: list[str], noncoding: DataFrame | None = None, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """The last reportable annotation of each variant: id, symbol, trx, consequence (the one that is listed).

    It is on a listed transcript, with a consequence that noncoding(symbol, effects array) lists for its gene, or, failing
    that, with a coding one. Annotations whose field `blacklist` says anything are skipped, if there is such a field.
    """
    rows = explode_annotations(df, fields)
    rows = rows.where("blacklist is null") if "blacklist" in fields else rows
    rows = rows.join(broadcast_if_small(transcripts.select("trx").distinct()), "trx")
    mine = F.split("consequence", "&")
    listed = F.array(*map(F.lit, consequences))
    if noncoding is not None:
        rows = rows.join(broadcast_if_small(noncoding.select("symbol", "effects")), "symbol", "left")
        own = F.get(F.filter(mine, lambda c: F.array_contains("effects", c)), F.lit(0))
    else:
        own = F.lit(None).cast("string")
    told = F.coalesce(own, F.get(F.filter(mine, lambda c: F.array_contains(listed, c)), F.lit(0)))
    last = F.max(F.struct("ann", "symbol", "trx", told.alias("consequence"))).alias("x")
    return rows.where(told.isNotNull()).groupBy("id").agg(last).select("id", "x.symbol", "x.trx", "x.consequence")


def with_bands(df: DataFrame, cytobands: DataFrame, key: str = "id") -> DataFrame:
    """df(key, chrom, st, en, ...) with `bands`: (first, last, n, q11, qter) of the cytobands (chrom, st, en, name) on each row.

    The mark acen_ of a centromere's band is taken off. Bands are reduced to first and last, not gathered.
    """
    met = overlap_join(df.select(F.col(key).alias("_id"), "chrom", "st", "en"), cytobands.select("chrom", "st", "en", F.regexp_replace("name", "acen_", "").alias("name")), few=True)
    has = lambda part: F.bool_or(F.contains(F.col("name_b"), F.lit(part)))
    told = met.groupBy("_id").agg(
        F.struct(F.min_by("name_b", "st_b").alias("first"), F.max_by("name_b", "st_b").alias("last"), F.count(F.lit(1)).alias("n"), has("q11").alias("q11"), has("qter").alias("qter")).alias("bands")
    )
    return df.join(told, F.col(key) == F.col("_id"), "left").drop("_id")


def keep_best(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")


def candidate_gene_pairs(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Genes on either side of an event: all pairs of an event, INTERGENIC where a side has none, and orientation."""
    a = left.select(key, F.col("symbol").alias("gene_a"), F.col("strand").alias("strand_a"))
    b = right.select(key, F.col("symbol").alias("gene_b"), F.col("strand").alias("strand_b"))
    both = a.join(b, key, "full_outer")
    return both.select(key, F.coalesce("gene_a", F.lit("INTERGENIC")).alias("gene_a"), F.coalesce("gene_b", F.lit("INTERGENIC")).alias("gene_b"), (F.col("strand_a") * F.col("strand_b")).alias("orientation"))


def symmetric_pairs(listed: DataFrame) -> DataFrame:
    """Listed gene pairs in both orders; a missing type is BND."""
    kind = F.coalesce("type", F.lit("BND")).alias("type")
    one = listed.select("gene1", "gene2", "require_strand", kind, F.lit(True).alias("direct"))
    two = listed.select(F.col("gene2").alias("gene1"), F.col("gene1").alias("gene2"), "require_strand", kind, F.lit(False).alias("direct"))
    return one.unionByName(two)


def recurrent_lookup(pairs: DataFrame, listed: DataFrame) -> DataFrame:
    """pairs(id, gene_a, gene_b, svtype, orientation) with `recurrent`: exact, wildcard or null.

    A rule of the listed pairs, taken in both orders, fits if its first gene is either gene of the event and its second
    is the other or *. A type * fits any type where the rule's first gene stands on the left. A strand requirement needs
    orientation 1. The joins are on the rule's first gene, so wildcards need no cross join.
    """
    rules = symmetric_pairs(listed).where("gene1 <> '*'").select("gene1", F.col("gene2").alias("partner"), "require_strand", "type").distinct()
    rules = broadcast_if_small(rules)
    strand = (F.col("require_strand") == 0) | ((F.col("require_strand") == 1) & F.coalesce(F.col("orientation") == 1, F.lit(False)))

    def fit(near: str, far: str, any_type: bool) -> DataFrame:
        typed = (F.col("type") == F.col("svtype")) | (F.lit(any_type) & (F.col("type") == "*"))
        met = pairs.join(rules, F.col(near) == F.col("gene1")).where(F.col("partner").isin(F.col(far), F.lit("*")) & typed & strand)
        return met.select("id", "gene_a", "gene_b", (F.col("partner") == "*").cast("int").alias("_w"))

    best = fit("gene_a", "gene_b", True).unionByName(fit("gene_b", "gene_a", False)).groupBy("id", "gene_a", "gene_b").agg(F.min("_w").alias("_w"))
    out = pairs.join(best, ["id", "gene_a", "gene_b"], "left")
    return out.withColumn("recurrent", F.when(F.col("_w") == 0, "exact").when(F.col("_w") == 1, "wildcard")).drop("_w")


#: How the number columns of merged segments are taken together: means, and sums of counts.
MEANS, SUMS = ("cn", "mcn", "cnq", "mcnq", "cnf", "mcnf", "sm", "maf"), ("as_", "bc", "sd", "pe1", "pe2")


def merge_segments(df: DataFrame, slack: int, shortest: int, masks: DataFrame | None = None) -> DataFrame:
    """Segments of one kind (alt) chained by gaps of at most slack, also through masks (centromeres), by cluster.

    A cluster counts if it spans `shortest` (masks included) and has a row with the filter PASS or segmentMean. One that
    has one row alone leaves that row as it is. Of others the PASS rows become one row: the first one's start, the last
    one's end (in the order of start and end), means of MEANS (cn rounded down), sums of SUMS, the largest qual, lengths
    with signs, n rows; all other rows are passed through as they are, with n = 1. Mask rows never come out.
    Columns that df lacks are left out.
    """
    rows = with_bridges(df, masks, "alt") if masks is not None else df.withColumn("bridge", F.lit(False))
    rows = saved(cluster_intervals(rows, slack, ("chrom", "alt")), "segments")
    keys = ["chrom", "alt", "cluster"]
    told = F.coalesce(F.col("filter").isin("PASS", "segmentMean"), F.lit(False))
    passing = F.coalesce(F.contains(F.col("filter"), F.lit("PASS")), F.lit(False)) & ~F.col("bridge")
    means, sums = ([c for c in group if c in df.columns] for group in (MEANS, SUMS))
    mine = lambda c: F.when(passing, c)
    more = [F.max(mine(F.col("qual"))).alias("qual")] if "qual" in df.columns else []
    groups = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), (F.max("en") - F.min("st")).alias("_span"), F.bool_or(told).alias("_told"), F.count_if(passing).alias("_passing"),
        F.min(mine(F.col("st"))).alias("st"), F.max(mine(F.struct("st", "en")))["en"].alias("en"), F.bool_or(F.col("filter") == "PASS").alias("_pass"),
        F.array_join(F.array_sort(F.collect_set(mine(F.col("filter")))), ";").alias("_filters"),
        *[(F.floor(F.avg(mine(F.col(c)))) if c == "cn" else F.avg(mine(F.col(c)))).alias(c) for c in means], *[F.sum(mine(F.col(c))).alias(c) for c in sums], *more,
    ).where(F.coalesce(F.col("_told") & (F.col("_span") >= shortest), F.lit(False)))
    merged = groups.where((F.col("_rows") > 1) & (F.col("_passing") > 0))
    merged = merged.withColumn("filter", F.when(F.col("_pass"), "PASS").otherwise(F.col("_filters"))).withColumn("n", F.col("_passing"))
    numbers = [*means, *sums, *([] if "qual" not in df.columns else ["qual"])]
    merged = merged.select("chrom", "alt", "st", "en", "filter", *numbers, "n")
    alone = groups.select(*[F.col(k).alias(f"_{k}") for k in keys], "_rows")
    same = (F.col("chrom") == F.col("_chrom")) & F.col("alt").eqNullSafe(F.col("_alt")) & (F.col("cluster") == F.col("_cluster"))
    rest = rows.where("not bridge and filter is not null").join(alone, same).where((F.col("_rows") == 1) | ~passing)
    rest = rest.select("chrom", "alt", "st", "en", "filter", *[F.col(c).cast(merged.schema[c].dataType).alias(c) for c in numbers], F.lit(1).cast("long").alias("n"))
    length = F.col("en") - F.col("st") + 1
    loss = F.coalesce(F.col("alt") == "<DEL>", F.lit(False))
    plain = F.coalesce(F.col("alt").isin("<DEL>", "<DEL>,<DUP>", "<DUP>,<DEL>", "<LOH>"), F.lit(False))
    return merged.unionByName(rest).withColumn("svlen", F.when(loss, -length).otherwise(length)).withColumn("reflen", F.when(plain, length).otherwise(-length))


def event_gene_summary(df: DataFrame, most: int = 15) -> DataFrame:
    """Distinct genes of each event: their number and their names, or `N genes` above `most`."""
    genes = explode_annotations(df).groupBy("id").agg(F.array_sort(F.collect_set("symbol")).alias("g"))
    names = F.when(F.size("g") > most, F.concat(F.size("g").cast("string"), F.lit(" genes"))).otherwise(F.array_join("g", ","))
    return genes.select("id", F.size("g").alias("n_genes"), names.alias("genes"))


#: Filters that a recurrent deletion or duplication is not held to.
FORGIVEN = ("MaxDepth", "MinSomaticScore")


def event_category(df: DataFrame) -> DataFrame:
    """df with `category`, CNV, RECURRENTSV, OTHERSV or null, and `filter` as it is then reported.

    df(svtype, filter, recurrent, gene_a, gene_b, impact, reportable): recurrent is null unless the event is listed;
    impact: does a deletion, duplication or insertion change a listed gene? reportable: see reportable_events, for
    breakends; gene_a and gene_b are theirs. svtype SEG is a copy-number segment (columns genes, cnloh; cnloh is null
    where it does not apply, and false where no gene of a copy-neutral loss is listed).

    Breakends: recurrent and PASS with a named gene on both sides is RECURRENTSV, other recurrent ones OTHERSV, and so
    are passing reportable ones. Deletions, duplications and insertions: recurrent ones lose the forgiven filters and are
    CNV with PASS, else OTHERSV; other passing ones with an impact OTHERSV. Segments: PASS is CNV, other filters OTHERSV,
    without genes only if the filter is MinCNVAbundance or segmentMean; a copy-neutral loss without a listed gene OTHERSV.
    """
    listed = F.col("recurrent").isNotNull()
    small = F.col("svtype").isin("DEL", "DUP", "INS")
    strict = F.filter(F.split("filter", ";"), lambda f: ~f.isin(*FORGIVEN))
    forgiven = F.when(small & listed, F.when(F.size(strict) == 0, "PASS").otherwise(F.array_join(strict, ";"))).otherwise(F.col("filter"))
    passing = forgiven == "PASS"
    unnamed = lambda c: F.coalesce((F.col(c) == "INTERGENIC") | F.col(c).contains("ENS"), F.lit(True))
    named = ~unnamed("gene_a") & ~unnamed("gene_b")
    breakend = F.when(listed & passing & named, "RECURRENTSV").when(listed, "OTHERSV").when(passing & F.col("reportable"), "OTHERSV")
    copies = F.when(listed & passing, "CNV").when(listed, "OTHERSV").when(passing & F.col("impact"), "OTHERSV")
    weak = F.coalesce(F.col("filter").isin("MinCNVAbundance", "segmentMean"), F.lit(False))
    segment = F.when(passing & F.coalesce("cnloh", F.lit(True)), "CNV").when(passing | weak | (F.coalesce(F.size("genes"), F.lit(0)) > 0), "OTHERSV") if "cnloh" in df.columns else F.lit(None)
    kind = F.when(F.col("svtype") == "SEG", segment).when(small, copies).otherwise(breakend)
    return df.withColumn("category", kind).withColumn("filter", forgiven)


def reportable_events(df: DataFrame) -> DataFrame:
    """df with `reportable`, for breakends and inversions that are in no list.

    df(svtype, gene_a, gene_b, region_a, region_b, distance_a, distance_b, known, band_a, band_b): region is the effect on
    a gene, distance that to it, known: is one of the genes listed? Inversions inside one intron or the like of a gene,
    beside one gene, or without a listed gene are not reported, nor are events that touch no gene by name and no listed
    one, or join two telomeres.
    """
    true = lambda c: F.coalesce(c, F.lit(False))
    inversion, one_gene = F.lower("svtype") == "inv", F.col("gene_a").eqNullSafe(F.col("gene_b"))
    same = F.col("region_a").eqNullSafe(F.col("region_b")) & (true(F.col("region_a").contains("intron")) | true(F.col("region_a").contains("intragenic")))
    beside = true(F.col("distance_a") > 0) & true(F.col("distance_b") > 0)
    unnamed = lambda c: true((F.col(c) == "INTERGENIC") | F.col(c).contains("ENS"))
    ends = true(F.col("band_a").isin("pter", "qter") & F.col("band_b").isin("pter", "qter"))
    out = (inversion & ((one_gene & (same | beside)) | ~F.col("known"))) | ((unnamed("gene_a") | unnamed("gene_b")) & ~F.col("known")) | ends
    return df.withColumn("reportable", ~out)


def gene_status(df: DataFrame, genes: DataFrame) -> DataFrame:
    """For each listed gene its distinct consequences, sorted and joined, or a sentence that it has none."""
    rows = explode_annotations(df).where("filter = 'PASS'").select("symbol", F.explode(F.split("consequence", "&")).alias("effect"))
    per = rows.groupBy("symbol").agg(F.array_join(F.array_sort(F.collect_set("effect")), "; ").alias("status"))
    return genes.join(per, "symbol", "left").withColumn("status", F.coalesce("status", F.lit("no mutations identified")))


def merge_info_maps(df: DataFrame, by: str, info: str) -> DataFrame:
    """Union of the keys of all info strings of a group: all values, repeats too, sorted and joined by commas, keys sorted, flags bare."""
    pairs = df.select(by, F.explode(F.split(info, ";")).alias("_p"))
    key, value = F.substring_index("_p", "=", 1), F.when(F.col("_p").contains("="), F.regexp_replace("_p", "^[^=]*=", ""))
    each = pairs.groupBy(by, key.alias("_k")).agg(F.array_join(F.array_sort(F.collect_list(value)), ",").alias("_v"))
    item = F.when(F.col("_v") == "", F.col("_k")).otherwise(F.concat("_k", F.lit("="), "_v"))
    return each.groupBy(by).agg(F.array_join(F.array_sort(F.collect_list(item)), ";").alias(info))


def candidate_gate(df: DataFrame, low: float = 0.05, control: float = 0.02, most_mismatches: int | None = None, off_target: bool = False) -> DataFrame:
    """Indel share in (low, 1], control share below `control`; on request few mismatches of the best guide, off-target sites only."""
    out = df.where((F.col("fraction") > low) & (F.col("fraction") <= 1) & (F.col("control_fraction") < control))
    if most_mismatches is not None:
        out = out.where(F.col("min_mismatches") <= most_mismatches)
    return out.where("is_target = 0") if off_target else out


def mnv_component_filter(df: DataFrame, tag: str, alt: str) -> DataFrame:
    """Of rows with a tag ref>alt those whose alt is the tag's; rows without a tag stay."""
    return df.where(F.coalesce(F.element_at(F.split(tag, ">"), -1) == F.col(alt), F.lit(True)))


def somatic_indel_gate(df: DataFrame, least: float = 5.0, weak: bool = False) -> DataFrame:
    """Passing insertions, deletions and duplications with enough abundance on numbered chromosomes, X or Y."""
    passing = (F.col("filter") == "PASS") | (F.lit(weak) & F.array_contains(F.split("filter", ";"), "weak_evidence"))
    return df.where(passing & F.col("svtype").isin("DEL", "INS", "DUP") & (fn.abundance_pct(F.col("ref_reads"), F.col("alt_reads")) >= least) & F.col("chrom").rlike("^chr([0-9]+|X|Y)$"))


def false_positive_sites(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sites to keep, and, for a log, off-target sites with indel reads of which the model predicts none (predicted = 0)."""
    odd = F.coalesce((F.col("is_target") == 0) & (F.col("indel") > 0) & (F.col("predicted") == 0), F.lit(False))
    return df.where(~odd), df.where(odd)


def case_strings(df: DataFrame) -> DataFrame:
    """Per sample its passing variants as gene[abundance%], sorted and joined with commas."""
    rows = explode_annotations(df).where("filter = 'PASS' and pick = 1")
    item = F.concat("symbol", F.lit("["), fn.abundance_pct(F.col("ref_reads"), F.col("alt_reads")).cast("string"), F.lit("%]"))
    return rows.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list(item)), ",").alias("variants"))


def truth_panel(df: DataFrame, least: float) -> DataFrame:
    """Strongest evidence of each (guide, locus) over replicates, null keys kept, and whether it is an edit."""
    out = df.groupBy("guide", "chrom", "pos").agg(F.max("value").alias("best"), F.count(F.lit(1)).alias("replicates"))
    return out.withColumn("is_edit", F.coalesce(F.col("best") >= least, F.lit(False)))


def rank_candidates(df: DataFrame, tier: str, score: str, tie: str, most: int | None = None, parts: int = 64) -> DataFrame:
    """Rows by tier, score (a number) from high to low with nulls last, and tie, with their rank from 1; with `most`, only so many.

    All rows are ranked without being gathered: tiers are cut at quantiles of the score, each piece is numbered on its
    own, and the rank adds the rows of the pieces before it.
    """
    order = [F.col(tier).asc(), F.col(score).desc_nulls_last(), F.col(tie).asc()]
    if most is not None:
        return df.orderBy(*order).limit(most).withColumn("rank", F.row_number().over(W.orderBy(*order)))
    bounds = df.agg(F.percentile_approx(score, [k / parts for k in range(1, parts)])).first()[0] or []
    higher = F.filter(F.array(*map(F.lit, sorted(set(bounds)))), lambda b: b >= F.col(score)) if bounds else F.array()
    piece = F.when(F.col(score).isNull(), F.lit(parts)).otherwise(F.size(higher))
    cut = df.withColumn("_piece", piece)
    sizes = cut.groupBy(F.col(tier).alias("_tier"), "_piece").agg(F.count(F.lit(1)).alias("_n"))
    # One row for each piece.
    before = sizes.withColumn("_before", F.sum("_n").over(W.orderBy("_tier", "_piece").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n"))
    same = F.col(tier).eqNullSafe(F.col("_tier")) & (F.col("_piece") == F.col("_p"))
    out = cut.join(F.broadcast(before.select("_tier", F.col("_piece").alias("_p"), "_before")), same)
    place = F.row_number().over(W.partitionBy(tier, "_piece").orderBy(*order[1:]))
    return out.withColumn("rank", F.col("_before") + place).drop("_piece", "_tier", "_p", "_before")
