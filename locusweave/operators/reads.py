"""Per-locus evidence from aligned reads: edit shares, pileup shape, controls, panels of normals, verdicts.

Reads have read_name, sample, chrom, ref_start, mapq, cigar, is_dup, arm; loci have chrom and pos. Reads meet loci by
the binned overlap join; everything after is keyed by locus and partially aggregated before it is dealt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locusweave.functions import cigar as cg
from locusweave.operators.intervals import overlap_join
from locusweave.plans.scratch import saved
from locusweave.plans.size import few_rows

LOCUS = ("chrom", "pos")


def primary_reads(reads: DataFrame) -> DataFrame:
    """Mapped primary reads that are no duplicates, by flag bits where there is a `flag`, and by is_dup."""
    out = reads.where("is_dup = 0")
    return out.where(proper_flags(F.col("flag"))) if "flag" in reads.columns else out


def usable_reads(reads: DataFrame, least_mapq: int = 20, most_mismatches: int = 4) -> DataFrame:
    """Primary reads that map well enough; with a column nm (edit distance), of few mismatches besides their indels."""
    out = primary_reads(reads).where(F.col("mapq") >= least_mapq)
    if "nm" not in reads.columns:
        return out
    return out.where(F.coalesce("nm", F.lit(0)) - cg.cigar_total(F.col("cigar"), "ID") <= most_mismatches)


def proper_flags(flag: Column) -> Column:
    """Mapped, primary, no duplicate, not failed: SAM flag bits 0x4, 0x100, 0x200, 0x400, 0x800 are clear."""
    return flag.bitwiseAND(0x4 | 0x100 | 0x200 | 0x400 | 0x800) == 0


def facing_pairs(flag: Column, start: Column, mate_start: Column) -> Column:
    """Is a paired read on the other strand than its mate, and do the two face one another?"""
    back, mate_back = (flag.bitwiseAND(b) > 0 for b in (0x10, 0x20))
    return (flag.bitwiseAND(0x1) > 0) & (back != mate_back) & F.when(back, start >= mate_start).otherwise(start <= mate_start)


def reads_at_loci(reads: DataFrame, loci: DataFrame, pad: int, length: int = 1, **own: Column) -> DataFrame:
    """Reads whose reference span comes within pad of a locus of `length` bases: all columns of reads, ops, found, en and pos.

    ops is the parsed CIGAR and found its events. These, and further columns in `own` made of them, are worked out once
    for each read, before it meets loci. Loci go to the reads where their size allows, so that reads are not dealt out.
    """
    spans = reads.withColumn("ops", cg.parse_cigar(F.col("cigar"))).withColumn("found", cg.parsed_events(F.col("ops"), F.col("ref_start")))
    spans = spans.withColumns({"st": F.col("ref_start"), "en": F.col("ref_start") + cg.bases(F.col("ops"), "MDN=X"), **own})
    marks = loci.select("chrom", F.col("pos").alias("st"), (F.col("pos") + length).alias("en")).distinct()
    return overlap_join(spans, marks, pad, few=True).withColumnRenamed("st_b", "pos").drop("st", "en_b")


def _indel() -> Column:
    return F.exists("found", lambda x: x["op"].isin("I", "D"))


def _has(op: str) -> Column:
    return F.exists("found", lambda x: x["op"] == op)


def _largest(window: int) -> Column:
    return cg.largest_of(F.col("found"), F.col("pos"), window)


def site_labels(reads: DataFrame, loci: DataFrame, pad: int = 150, high: float = 0.05, low: float = 0.01, least_mapq: int = 1) -> DataFrame:
    """Indel share by arm of the primary reads of least_mapq or more at each locus, and a label: 1 edited, 0 clean, -1 unclear."""
    met = reads_at_loci(usable_reads(reads, least_mapq), loci, pad, 0, indel=_indel().cast("int")).groupBy(*LOCUS).agg(
        F.avg(F.when(F.col("arm") == "edited", F.col("indel"))).alias("edited"), F.avg(F.when(F.col("arm") == "control", F.col("indel"))).alias("control")
    )
    edited, control = F.coalesce("edited", F.lit(0.0)), F.coalesce("control", F.lit(0.0))
    label = F.when((edited >= high) & (control <= low), 1).when(edited <= low, 0).otherwise(-1)
    return met.select(*LOCUS, edited.alias("edited"), control.alias("control"), label.alias("label"))


def mapped_reads(reads: DataFrame) -> DataFrame:
    """Mapped reads that are no duplicates; secondary and supplementary ones stay."""
    out = reads.where("is_dup = 0")
    return out.where(F.col("flag").bitwiseAND(0x4 | 0x400) == 0) if "flag" in reads.columns else out


def control_fractions(reads: DataFrame, loci: DataFrame, pad: int = 50) -> DataFrame:
    """Share of mapped control reads near each locus with a deletion, an insertion, a clip, a mismatch.

    A read has a mismatch if its MD tag (column md, if there is one) has a letter.
    """
    own = {"del": _has("D"), "ins": _has("I"), "clip": _has("S"), "mismatch": cg.tag_letters(F.col("md")) > 0 if "md" in reads.columns else F.lit(False)}
    met = reads_at_loci(mapped_reads(reads.where("arm = 'control'")), loci, pad, 0, **{k: v.cast("int") for k, v in own.items()})
    return met.groupBy(*LOCUS).agg(F.count(F.lit(1)).alias("reads"), *[F.avg(k).alias(f"{k}_share") for k in own])


def control_overlap(reads: DataFrame, loci: DataFrame, pad: int = 50) -> DataFrame:
    """For each locus, does a primary control read near it carry an insertion, a deletion?"""
    met = reads_at_loci(primary_reads(reads.where("arm = 'control'")), loci, pad, ins=_has("I"), dele=_has("D"))
    return met.groupBy(*LOCUS).agg(F.bool_or("ins").alias("control_ins"), F.bool_or("dele").alias("control_del"))


def allele_counts(reads: DataFrame, loci: DataFrame, pad: int = 25) -> DataFrame:
    """Usable reads per locus and allele (op:len@pos, or REF), with one event for each read name.

    A read name that occurs more than once counts by its indel before its plain alignment, then by the lowest start.
    """
    met = reads_at_loci(usable_reads(reads), loci, pad).withColumn("e", _largest(pad))
    allele = F.when(F.col("e").isNull(), F.lit("REF")).otherwise(F.concat("e.op", F.lit(":"), F.col("e.len").cast("string"), F.lit("@"), F.col("e.pos").cast("string")))
    met = met.select(*LOCUS, "read_name", "ref_start", allele.alias("allele"))
    first = F.min(F.struct((F.col("allele") == "REF").alias("plain"), "ref_start", "allele"))
    one = met.groupBy(*LOCUS, "read_name").agg(first.alias("f"))
    return one.groupBy(*LOCUS, F.col("f.allele").alias("allele")).agg(F.count(F.lit(1)).alias("n"))


def locus_edit_summary(reads: DataFrame, loci: DataFrame, pad: int = 50) -> DataFrame:
    """Total and indel usable reads by arm with shares to four places, and the distinct indels joined by semicolons."""
    kind = F.when(_indel() & (F.col("arm") == "edited"), F.regexp_replace("cigar", r"\d+M", ""))
    met = reads_at_loci(usable_reads(reads), loci, pad, has_indel=_indel(), kind=kind)
    edited, has = F.col("arm") == "edited", F.col("has_indel")
    out = met.groupBy(*LOCUS).agg(
        F.count_if(edited).alias("total"), F.count_if(edited & has).alias("indel"), F.count_if(~edited).alias("control_total"), F.count_if(~edited & has).alias("control_indel"),
        F.concat_ws(";", F.array_sort(F.collect_set("kind"))).alias("events"),
    )
    share = lambda a, b: F.round(F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0)), 4)
    return out.withColumn("fraction", share("indel", "total")).withColumn("control_fraction", share("control_indel", "control_total"))


def _around(reads: DataFrame, loci: DataFrame, window: int) -> DataFrame:
    """Primary reads with `e`, their largest indel within `window` of a locus, and `spans`: do they reach over it?

    A read's indels and clips lie between its ends, so one that ends farther away has nothing to say.
    """
    met = reads_at_loci(primary_reads(reads), loci, window + 1, 0).withColumn("e", _largest(window))
    return met.withColumn("spans", ((F.col("ref_start") <= F.col("pos")) & (F.col("pos") <= F.col("en"))).cast("long"))


def pileup_shape(reads: DataFrame, loci: DataFrame, window: int = 25, near: int = 2, least: int = 8) -> DataFrame:
    """How the indels of a locus are spread: shares, the modal cut, its length and MAPQ, the modal clip.

    Every primary read gives its largest indel within `window` of the locus and its clips there, whether it spans the
    locus or not; shares are of the spanning reads, and loci with fewer than `least` of them are left out.
    Modal length and median MAPQ are those of the indels within `near` of the modal cut; of equally common values the
    lowest is the mode. Loci without indels have 0 for all and no modal cut.

    Reads meet loci once and are counted by (locus, cut, length, MAPQ); everything else is taken from these counts.
    """
    met = _around(reads, loci, window)
    clips = F.filter("found", lambda x: (x["op"] == "S") & (F.abs(x["pos"] - F.col("pos")) <= window))
    none = F.lit(None).cast("long")
    own = F.array(F.struct(F.lit(False).alias("clip"), F.col("e.pos").alias("at"), F.col("e.len").alias("len"), F.when(F.col("e").isNotNull(), F.col("mapq")).alias("mapq"), F.col("spans").alias("spans")))
    theirs = F.transform(clips, lambda x: F.struct(F.lit(True).alias("clip"), x["pos"].alias("at"), none.alias("len"), F.lit(None).cast("int").alias("mapq"), F.lit(0).cast("long").alias("spans")))
    cells = met.select(*LOCUS, F.explode(F.concat(own, theirs)).alias("x")).groupBy(*LOCUS, "x.clip", "x.at", "x.len", "x.mapq")
    cells = saved(cells.agg(F.count(F.lit(1)).alias("n"), F.sum("x.spans").alias("spans")), "pileup-cells")
    cuts = cells.groupBy(*LOCUS, "clip", "at").agg(F.sum("n").alias("n"), F.sum("spans").alias("spans"))
    cut = ~F.col("clip") & F.col("at").isNotNull()
    whole = cuts.groupBy(*LOCUS).agg(
        F.sum("spans").alias("spanning"), F.coalesce(F.sum(F.when(cut, F.col("n"))), F.lit(0)).alias("indels"),
        F.max(F.when(cut, F.struct("n", (-F.col("at")).alias("neg")))).alias("modal"), F.max(F.when(F.col("clip"), F.col("n"))).alias("clips"),
    ).where(F.col("spanning") >= least)
    whole = whole.withColumn("modal_pos", -F.col("modal.neg"))
    spread = cells.where(cut).join(whole.select(*LOCUS, "modal_pos"), list(LOCUS)).withColumn("off", F.abs(F.col("at") - F.col("modal_pos")))
    close = F.col("off") <= near
    lengths = spread.where(close).groupBy(*LOCUS, "len").agg(F.sum("n").alias("n")).groupBy(*LOCUS).agg((-F.max(F.struct("n", (-F.col("len")).alias("neg")))["neg"]).alias("modal_len"))
    spread = spread.groupBy(*LOCUS).agg(
        F.sum(F.when(close, F.col("n"))).alias("close"), F.percentile("off", 0.5, F.col("n")).alias("spread"), F.percentile(F.when(close, F.col("mapq")), 0.5, F.col("n")).alias("median_mapq")
    )
    out = whole.join(spread, list(LOCUS), "left").join(lengths, list(LOCUS), "left")
    zero = lambda c, kind="double": F.coalesce(c, F.lit(0)).cast(kind)
    return out.select(
        *LOCUS, "spanning", "indels", (F.col("indels") / F.col("spanning")).alias("indel_share"), "modal_pos", zero(F.col("modal_len"), "long").alias("modal_len"),
        zero(F.col("close") / F.nullif("indels", F.lit(0))).alias("concentration"), zero(F.col("close") / F.col("spanning")).alias("cut_share"), zero(F.col("spread")).alias("spread"),
        zero(F.col("median_mapq")).alias("median_mapq"), zero(F.col("clips") / F.col("spanning")).alias("clip_share"),
    )


def panel_of_normals(reads: DataFrame, candidates: DataFrame, least: int = 4, reach: int = 26, near: int = 3, hit: float = 0.03, pooled: float = 0.02) -> DataFrame:
    """Indels near each candidate (chrom, pos, sample) in the primary control reads of other samples.

    A read supports the candidate if its largest indel within `reach` lies within `near` of it, also where the read
    itself ends before the candidate or starts behind it. Gives normals with `least` spanning reads or more, hits, pooled
    and worst share, and demote: any hit, or a pooled share of `pooled` or more.
    """
    normals = _around(reads.where("arm = 'control'"), candidates, reach).withColumnRenamed("sample", "normal")
    seen = F.coalesce((F.abs(F.col("e.pos") - F.col("pos")) <= near).cast("int"), F.lit(0))
    normals = normals.groupBy(*LOCUS, "normal").agg(F.sum("spans").alias("n"), F.sum(seen).alias("k")).where(F.col("n") >= least)
    met = candidates.select(*LOCUS, "sample").distinct().join(normals, list(LOCUS)).where(F.col("normal") != F.col("sample"))
    share = F.col("k") / F.col("n")
    out = met.groupBy(*LOCUS, "sample").agg(
        F.count(F.lit(1)).alias("normals"), F.count_if(share >= hit).alias("hits"), (F.sum("k") / F.sum("n")).alias("pooled_share"), F.max(share).alias("worst_share")
    )
    return out.withColumn("demote", (F.col("hits") > 0) | (F.col("pooled_share") >= pooled))


def verdicts(shape: DataFrame, control: DataFrame, scores: DataFrame, least: int = 8, ratio: float = 3.0, most_control: float = 0.03) -> DataFrame:
    """A verdict for each locus from its pileup shape, its matched control's indel share and the model's score.

    shape(..., indel_share, concentration, median_mapq, spanning), control(..., indel_share), scores(..., score), keyed by
    locus. The first rule that holds decides: few reads; low MAPQ with indels; an indel share in the control of
    `most_control` or more, or of which the edited share is less than `ratio` times; a score of 0.60 with half of the
    indels in one place; a score of 0.25; else an artifact by its shape. A locus without a control is not held against it.
    """
    own, other, score = F.col("indel_share"), F.col("control_share"), F.coalesce("score", F.lit(0.0))
    ladder = (
        F.when(F.col("spanning") < least, "INSUFFICIENT COVERAGE").when((F.col("median_mapq") < 20) & (own > 0), "ARTIFACT (low-MAPQ repeat)")
        .when((other >= most_control) | (own < ratio * other), "GERMLINE/ARTIFACT (in normal)")
        .when((score >= 0.60) & (F.coalesce("concentration", F.lit(0.0)) >= 0.5), "LIKELY EDIT").when(score >= 0.25, "POSSIBLE - review").otherwise("ARTIFACT (shape)")
    )
    met = shape.join(control.select(*LOCUS, F.col("indel_share").alias("control_share")), list(LOCUS), "left").join(scores.select(*LOCUS, "score"), list(LOCUS), "left")
    return met.withColumn("verdict", ladder)


def recurrence_tiers(sites: DataFrame, artifact: int = 3) -> DataFrame:
    """Distinct samples and guides at each locus; a locus with `artifact` guides or more is an artifact.

    A replicate suffix _1 or _2 of a sample is ignored.
    """
    sample = F.regexp_replace("sample", "_[12]$", "")
    out = sites.groupBy(*LOCUS).agg(F.count_distinct(sample).alias("samples"), F.count_distinct("guide").alias("guides"))
    return out.withColumn("tier", F.when(F.col("guides") >= artifact, "artifact").when(F.col("samples") > 1, "recurrent").otherwise("private"))


#: Bytes of a locus's control marks in memory, about: the distinct starts of its reads, each with an end.
MARK_BYTES = 8_192


def read_features(reads: DataFrame, loci: DataFrame, pad: int = 150) -> DataFrame:
    """The features of each primary edited read at each locus within pad, for a classifier of reads.

    reads may have flag and tlen (pair gap), nm, md (mismatches) and sa (clips of supplementary alignments); loci may have
    pams (positions; the locus itself if there is no such column), on_target, homopolymer and repeat_distance.
    pair_gap is -1 unless properly paired; del_, ins_ and mismatch_vs_control are the read's own marks less the shares
    of the control reads within 50; deletion_exclusive: a deletion, and no control read within 100 that has one and
    overlaps; at_target: within 25 of a PAM; pam_distance is -1 without PAMs; clip_distance and repeat_distance are 999
    where nothing is there; deletions also count what clips hint at.

    Both arms are read once, each by its own join; what controls say is one row a locus. It goes to all tasks if the
    number of loci allows, so that edited reads stay where they are.
    """
    small = few_rows(loci.select(*LOCUS).distinct(), MARK_BYTES)
    optional = lambda df, c, kind: F.col(c) if c in df.columns else F.lit(None).cast(kind)
    marks = {"d": _has("D"), "i": _has("I"), "m": cg.tag_letters(optional(reads, "md", "string")) > 0, "all": F.lit(True)}
    control = reads_at_loci(mapped_reads(reads.where("arm = 'control'")), loci, 100, 0, **{k: v.cast("long") for k, v in marks.items()})
    near = (F.col("ref_start") < F.col("pos") + 50) & (F.col("pos") - 50 < F.col("en"))
    # Of the control's reads with a deletion only starts and their greatest ends are needed.
    starts = control.groupBy(*LOCUS, "ref_start").agg(F.max(F.when(F.col("d") > 0, F.col("en"))).alias("en"), *[F.sum(F.when(near, F.col(c))).alias(c) for c in marks])
    part = lambda c: F.coalesce(F.sum(c) / F.nullif(F.sum("all"), F.lit(0)), F.lit(0.0))
    deleted = F.collect_list(F.when(F.col("en").isNotNull(), F.struct(F.col("ref_start").cast("long").alias("st"), "en")))
    marks = starts.groupBy(*LOCUS).agg(deleted.alias("_deleted"), part("d").alias("_d"), part("i").alias("_i"), part("m").alias("_m"))
    told = {"pams": F.array(F.col("pos").cast("long")), "on_target": F.lit(0), "homopolymer": F.lit(False), "repeat_distance": F.lit(999)}
    sites = loci.select(*LOCUS, *[(F.col(c) if c in loci.columns else v).alias(f"_{c}") for c, v in told.items()]).dropDuplicates(list(LOCUS))
    hint = F.broadcast if small else (lambda df: df)
    evidence = cg.evidence_of(F.col("ops"), optional(reads, "nm", "int"), optional(reads, "md", "string"), optional(reads, "sa", "string"))
    own = {"_e": evidence, "_del": _has("D"), "_ops": F.size(F.filter("found", lambda x: x["op"].isin("I", "D"))), "_clips": F.filter("found", lambda x: x["op"] == "S")}
    met = reads_at_loci(primary_reads(reads.where("arm = 'edited'")), loci, pad, 0, **own)
    met = met.join(hint(sites), list(LOCUS)).join(hint(marks), list(LOCUS), "left").withColumn("_size", F.col("_e.inserted") + F.col("_e.deleted"))
    paired = optional(reads, "flag", "int").bitwiseAND(0x3) == 0x3
    met_by = F.exists(F.coalesce("_deleted", F.array().cast("array<struct<st:bigint,en:bigint>>")), lambda c: (F.col("en") >= c["st"]) & (c["en"] >= F.col("ref_start")))
    less = lambda mark, c: mark.cast("int") - F.coalesce(F.col(c), F.lit(0.0))
    gaps = F.transform("_pams", lambda p: F.abs(p - F.col("pos")))
    return met.select(
        *LOCUS, "read_name", "ref_start", "cigar", F.coalesce(F.when(paired, F.abs(optional(reads, "tlen", "long"))), F.lit(-1)).cast("long").alias("pair_gap"),
        F.col("_e.clipped").alias("softclip"), less(F.col("_e.deleted") > 0, "_d").alias("del_vs_control"), less(F.col("_e.inserted") > 0, "_i").alias("ins_vs_control"),
        less(F.col("_e.md_mismatches" if "md" in reads.columns else "_e.mismatches") > 0, "_m").alias("mismatch_vs_control"), (F.col("_del") & ~met_by).cast("int").alias("deletion_exclusive"),
        F.col("_on_target").cast("int").alias("on_target"), F.exists("_pams", lambda p: (F.col("ref_start") <= p + 25) & (F.col("en") >= p - 25)).cast("int").alias("at_target"),
        F.coalesce(F.array_min(gaps), F.lit(-1)).cast("long").alias("pam_distance"), F.col("_size").alias("indel_size"), cg.size_class(F.col("_size")).alias("size_class"),
        cg.complexity(F.col("_ops"), F.col("_size")).alias("complexity"), cg.clip_distance_of(F.col("_clips"), F.col("_pams")).alias("clip_distance"),
        F.col("_homopolymer").cast("int").alias("homopolymer"), F.col("_repeat_distance").cast("int").alias("repeat_distance"),
    )


def downsample_depth(reads: DataFrame, loci: DataFrame, target: int) -> DataFrame:
    """Reads of each locus, each kept with the chance target / depth by a hash of its name, so reruns agree.

    Reads meet loci once; what they meet is written, counted and filtered.
    """
    met = saved(reads_at_loci(reads, loci, 0).select(*reads.columns, "pos"), "depth-reads")
    depth = met.groupBy(*LOCUS).agg(F.count(F.lit(1)).alias("depth"))
    depth = F.broadcast(depth) if few_rows(loci.select(*LOCUS).distinct(), 128) else depth
    uniform = F.conv(F.substring(F.md5(F.col("read_name")), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    return met.join(depth, list(LOCUS)).where(uniform < F.lit(float(target)) / F.col("depth"))


def indel_spectrum(reads: DataFrame, keep: float = 0.9) -> DataFrame:
    """Frequencies of wild type and indel alleles among reads at least `keep` of the modal aligned length."""
    aligned = reads.withColumn("aligned", cg.cigar_total(F.col("cigar"), "MI=X"))
    modal = aligned.agg(F.expr("mode() WITHIN GROUP (ORDER BY aligned)").alias("modal"))
    first = F.get(F.filter(cg.events(F.col("cigar"), F.lit(0)), lambda e: e["op"].isin("I", "D")), F.lit(0))
    allele = F.when(first.isNull(), F.lit("wt")).otherwise(F.concat(first["pos"].cast("string"), F.lit(":"), first["len"].cast("string"), first["op"]))
    kept = aligned.crossJoin(F.broadcast(modal)).where(F.col("aligned") >= keep * F.col("modal"))
    counts = kept.groupBy(allele.alias("allele")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(W.partitionBy()), 4))
