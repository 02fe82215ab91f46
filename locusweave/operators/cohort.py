"""QC and cohort tables: metric labels, coverage roll-ups, genotype strings, recall, sample sheets, catalogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locusweave.functions.variants import natural_key


def normalize_metric_labels(df: DataFrame) -> DataFrame:
    """df(category, metric, value, percent) -> metric `category: metric`, value; percent adds a row with (%).

    `[Nx: inf)` becomes >Nx, PCT of becomes Percent of; values above 5e9 add a (G) row, above 5e6 an (M) row.
    """
    label = F.regexp_replace(F.regexp_replace("metric", r"\[\s*(\d+)x:\s*inf\)", ">$1x"), "PCT of", "Percent of")
    base = df.select(F.concat_ws(": ", "category", label).alias("metric"), "value", "percent")
    share = F.struct(F.concat(F.regexp_replace("metric", "Number of", "Percent"), F.lit(" (%)")).alias("metric"), F.col("percent").cast("double").alias("value"))
    big = F.struct(
        F.concat("metric", F.when(F.col("value") > 5e9, " (G)").otherwise(" (M)")).alias("metric"),
        F.round(F.col("value") / F.when(F.col("value") > 5e9, 1e9).otherwise(1e6), 2).alias("value"),
    )
    own = F.struct("metric", F.col("value").cast("double").alias("value"))
    rows = F.array_compact(F.array(own, F.when(F.col("percent").isNotNull(), share), F.when(F.col("value") > 5e6, big)))
    return base.select(F.explode(rows).alias("r")).select("r.*")


def gene_coverage_rollup(df: DataFrame) -> DataFrame:
    """Regions (gene, region, st, en, total, mean, low, high, pct) with a row for each gene and one for the assay.

    Percentages are weighted by length; one pass over grouping sets makes all levels.
    """
    length = F.col("en") - F.col("st") + 1
    rows = df.withColumn("length", length).withColumn("_w", F.col("pct") * length)
    out = rows.groupingSets([["gene", "region"], ["gene"], []], "gene", "region").agg(
        F.grouping_id().alias("level"), F.sum("total").alias("total"), F.sum("length").alias("length"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.round(F.sum("_w") / F.sum("length"), 1).alias("pct"),
    )
    kind = F.when(F.col("level") == 0, "region").when(F.col("level") == 1, "gene").otherwise("assay")
    return out.withColumn("level", kind).withColumn("mean", F.floor(F.col("total") / F.col("length")))


def coverage_curve(df: DataFrame, depths: list[int]) -> DataFrame:
    """df(depth, n) -> share of bases deeper than each listed depth, in percent; the last row, which is open-ended, gives none."""
    order = W.orderBy("depth")
    share = 100 - 100 * F.sum("n").over(order) / F.sum("n").over(W.partitionBy())
    out = df.withColumn("share", share).withColumn("last", F.max("depth").over(W.partitionBy()) == F.col("depth")).where("not last").withColumn("depth", F.col("depth") + 1)
    return out.where(F.col("depth").isin(depths)).select("depth", "share", F.concat(F.lit(">="), F.col("depth").cast("string"), F.lit("x")).alias("label"))


def derived_qc(df: DataFrame, by: str, names: dict[str, str], normal: int = 46) -> DataFrame:
    """df(by, metric, value) -> by, chromosome_number, consensus_pct, duplicate_pct, on_target_pct; a row per case.

    names gives the metric of each of ploidy, consensus_pairs, reads, on_target and mapped. The chromosome number is
    23 times the ploidy, rounded; within 2 of `normal` it counts as `normal` at least. Two reads of a consensus pair
    count against all reads, on-target reads against mapped ones. Missing metrics and counts of 0 give nulls.
    """
    wide = df.groupBy(by).pivot("metric", list(names.values())).agg(F.max("value"))
    value = lambda k: F.col(f"`{names[k]}`")
    pct = lambda part, whole: F.round(part / F.nullif(whole, F.lit(0.0)) * 100, 1)
    number = F.round(value("ploidy") * 23, 0).cast("int")
    consensus = pct(value("consensus_pairs") * 2, value("reads"))
    return wide.select(
        by, F.when(F.abs(number - normal) > 2, number).otherwise(F.greatest(F.lit(normal), number)).alias("chromosome_number"),
        consensus.alias("consensus_pct"), F.round(100 - consensus, 1).alias("duplicate_pct"), pct(value("on_target"), value("mapped")).alias("on_target_pct"),
    )


def genotype_string(loci: DataFrame, share: float = 0.4) -> DataFrame:
    """loci(sample, chrom, snp1, snp2, total_reads, haplotype_counts) -> per sample `chrom,pos,gt` joined with pipes.

    haplotype_counts reads AC:10;GT:3; with one letter for each of the two sites. Haplotypes above `share` of the reads
    give each site its distinct alleles, sorted; a single one is doubled. Sites stand in natural order; haplotypes
    without a count are left out.
    """
    parts = loci.withColumn("x", F.explode(F.split(F.btrim("haplotype_counts", F.lit(";")), ";")))
    hap = parts.withColumn("hap", F.substring_index("x", ":", 1)).withColumn("n", F.get(F.split("x", ":"), F.lit(1)).try_cast("long"))
    hap = hap.where(F.col("n") / F.col("total_reads") > share)
    site = lambda pos, k: hap.select("sample", "chrom", F.col(pos).cast("long").alias("pos"), F.substring("hap", k, 1).alias("allele"))
    sites = site("snp1", 1).unionByName(site("snp2", 2)).groupBy("sample", "chrom", "pos").agg(F.array_sort(F.collect_set("allele")).alias("a"))
    gt = F.array_join(F.when(F.size("a") == 2, F.col("a")).otherwise(F.concat("a", "a")), "")
    item = F.struct(natural_key(F.col("chrom")).alias("k"), "pos", F.concat_ws(",", "chrom", F.col("pos").cast("string"), gt).alias("t"))
    return sites.groupBy("sample").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["t"]), "|").alias("genotype"))


def recall_by_bin(df: DataFrame, edges: list[float]) -> DataFrame:
    """df(vaf, detected) -> per left-closed bin: n, found, recall, and whether it is the first with recall 0.8."""
    k = sum((F.when(F.col("vaf") >= e, 1).otherwise(0) for e in edges), F.lit(0))
    out = df.withColumn("bin", k).where((F.col("bin") > 0) & (F.col("bin") < len(edges))).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("detected").alias("found"))
    out = out.withColumn("recall", F.col("found") / F.col("n"))
    first = F.min(F.when(F.col("recall") >= 0.8, F.col("bin"))).over(W.partitionBy())
    return out.withColumn("first_good", F.coalesce(F.col("bin") == first, F.lit(False)))


def metric_table(df: DataFrame, by: str, metrics: list[str]) -> DataFrame:
    """One row per case and a column for each metric, its mean."""
    return df.groupBy(by).pivot("metric", metrics).agg(F.round(F.avg("value"), 6))


def unpivot_metrics(df: DataFrame, by: str, metrics: list[str]) -> DataFrame:
    return df.unpivot(by, metrics, "metric", "value").where(F.col("value").isNotNull())


def label_crosstab(df: DataFrame, by: str, label: str, values: list) -> DataFrame:
    wide = df.groupBy(by).pivot(label, values).count()
    return wide.na.fill(0).select(by, *[F.col(f"`{v}`").alias(f"label_{v}") for v in values])


def feature_histogram(df: DataFrame, value: str, label: str, bins: int = 60, share: float = 0.99) -> DataFrame:
    """Counts, density and mean by label and bin of equal width between the least value and the percentile `share`.

    Larger values count in the last bin; the density of a label's bins has area 1. One pass finds the bounds.
    """
    bounds = df.agg(F.min(value).cast("double").alias("lo"), F.percentile(value, F.lit(share)).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    k = F.least(F.floor((F.col(value) - F.col("lo")) / width), F.lit(bins - 1))
    rows = df.where(F.col(value).isNotNull()).crossJoin(F.broadcast(bounds)).withColumn("bin", F.coalesce(k, F.lit(0))).withColumn("_w", width)
    cells = rows.groupBy(label, "bin").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(value), 6).alias("mean"), F.first("_w").alias("_w"))
    density = F.col("n") / (F.sum("n").over(W.partitionBy(label)) * F.col("_w"))
    return cells.withColumn("density", density).drop("_w")


def number_replicates(df: DataFrame, by: str, order: str) -> DataFrame:
    """`by` with _T1, _T2, ... in order of appearance."""
    n = F.row_number().over(W.partitionBy(by).orderBy(order))
    return df.withColumn("replicate", F.concat(F.col(by), F.lit("_T"), n.cast("string")))


def spans_to_next(df: DataFrame, by: str, date: str) -> DataFrame:
    """Last day before the next date of the group, null for the latest, and a mark for the latest."""
    order = W.partitionBy(by).orderBy(date)
    nxt = F.lead(date).over(order)
    return df.withColumn("until", F.date_sub(nxt, 1)).withColumn("latest", nxt.isNull())


def fill_upward(df: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """Nulls take the next value below them in the group's order."""
    # Last in the opposite order, which needs one pass.
    w = W.partitionBy(by).orderBy(F.desc(order)).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, True).over(w))


def slice_with_ties(df: DataFrame, by: str, order: str, tag: str) -> DataFrame:
    """All rows at the group's greatest `order`, as one row with their tags joined."""
    top = df.withColumn("_r", F.rank().over(W.partitionBy(by).orderBy(F.desc(order)))).where("_r = 1")
    return top.groupBy(by).agg(F.first(order).alias(order), F.array_join(F.array_sort(F.collect_set(tag)), ",").alias("tags"))


def pair_rows(df: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """Rows 1 and 2, 3 and 4, ... of a group as one row with `name` and `content`."""
    n = F.row_number().over(W.partitionBy(by).orderBy(order)) - 1
    out = df.withColumn("pair", F.floor(n / 2)).withColumn("_odd", n % 2)
    return out.groupBy(by, "pair").agg(F.max(F.when(F.col("_odd") == 0, F.col(value))).alias("name"), F.max(F.when(F.col("_odd") == 1, F.col(value))).alias("content"))


def supported_versions(df: DataFrame, by: str = "minor", patch: str = "patch", newest: int = 2) -> DataFrame:
    """The last patch of each minor version, and all patches of the newest minors."""
    last = F.max(patch).over(W.partitionBy(by))
    rank = F.dense_rank().over(W.orderBy(F.desc(by)))
    return df.withColumn("_l", last).withColumn("_r", rank).where((F.col(patch) == F.col("_l")) | (F.col("_r") <= newest)).drop("_l", "_r")


def validate_sheet(df: DataFrame, name: str, first: str, second: str, suffixes: tuple[str, ...]) -> DataFrame:
    """The sheet with errors (an array) and single_end: a name and a first file are needed, suffixes must be known and agree."""
    ending = lambda c: F.regexp_extract(c, r"(\.[a-z]+(?:\.gz)?)$", 1)
    rules = [
        F.when(F.col(name).isNull() | (F.trim(name) == ""), "no name"),
        F.when(F.col(first).isNull(), "no first file"),
        F.when(F.col(first).isNotNull() & ~ending(F.col(first)).isin(*suffixes), "unknown suffix"),
        F.when(F.col(second).isNotNull() & (ending(F.col(first)) != ending(F.col(second))), "suffixes differ"),
    ]
    return df.withColumn("errors", F.array_compact(F.array(*rules))).withColumn("single_end", F.col(second).isNull())


def read_group_ids(df: DataFrame, *fields: str) -> DataFrame:
    """Read-group ids of run fields joined by dots; nulls are skipped. `repeated` marks ids of several rows."""
    out = df.withColumn("rgid", F.concat_ws(".", *fields))
    return out.withColumn("repeated", F.count(F.lit(1)).over(W.partitionBy("rgid")) > 1)


#: Short names of specimens, replaced one after the other (fixed values).
SPECIMENS = {"Bone Marrow-WML": "BM", "Bone Marrow": "BM", "Whole Blood": "PB", "Peripheral Blood": "PB", "Blood": "PB"}
ACCESSION = r"^W\d+-\d+"


def normalize_samples(df: DataFrame, code: str, sex: str, specimen: str, mrn: str | None = None) -> DataFrame:
    """Trimmed codes with _, the accession that a code starts with, sex as m, f or null, specimens by short names, and an id.

    The id joins the code without its accession, the accession, the mrn if there is one, and the specimen; parts that
    are missing are left out.
    """
    plain = lambda c: F.regexp_replace(F.trim(c), r"\s+", "_")
    short = F.trim(F.col(specimen))
    for name, abbreviation in SPECIMENS.items():
        short = F.regexp_replace(short, f"(?i)^{name}", abbreviation)
    letter = F.lower(F.substring(F.trim(sex), 1, 1))
    out = df.withColumn("accession", F.nullif(F.regexp_extract(F.trim(code), ACCESSION, 0), F.lit(""))).withColumn(code, plain(code))
    out = out.withColumn(sex, F.when(letter.isin("m", "f"), letter)).withColumn(specimen, F.regexp_replace(short, r"\s+", "_"))
    rest = F.nullif(F.regexp_replace(code, ACCESSION + "[-_]?", ""), F.lit(""))
    return out.withColumn("id", F.concat_ws("-", rest, "accession", *([F.trim(F.col(mrn).cast("string"))] if mrn else []), specimen))


def coalesce_columns(df: DataFrame, source: str, dest: str) -> DataFrame:
    return df.withColumn(dest, F.coalesce(source, dest)).drop(source)


def wide_to_long_pairs(df: DataFrame, key: str, kinds: tuple[str, ...], fields: tuple[str, ...]) -> DataFrame:
    """Columns kind_field to one row per kind, with sample_type."""
    rows = [F.struct(F.lit(k).alias("sample_type"), *[F.col(f"{k}_{f}").alias(f) for f in fields]) for k in kinds]
    return df.select(key, F.explode(F.array(*rows)).alias("r")).select(key, "r.*")


def min_non_null(df: DataFrame, columns: list[str], least: int) -> DataFrame:
    return df.dropna(thresh=least, subset=columns)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without the columns that are null or empty in all rows; one pass counts them all."""
    seen = df.agg(*[F.count(F.nullif(F.col(c).cast("string"), F.lit(""))).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if seen[c]])


def mate_files(df: DataFrame, keys: list[str], number: str, path: str) -> DataFrame:
    """R1 and R2 rows to one row; of several files of a key the least."""
    return df.groupBy(*keys).pivot(number, ["R1", "R2"]).agg(F.min(path))


def case_summary(cases: DataFrame, parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Left joins of per-case tables on the case name; the tables have one row per case."""
    for part in parts.values():
        cases = cases.join(part, key, "left")
    return cases


def union_loose(*frames: DataFrame) -> DataFrame:
    """Rows of frames with differing columns; what one lacks is null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def codon_range(df: DataFrame, exons: DataFrame) -> DataFrame:
    """First and last codon of a transcript that each region (trx, st, en) touches.

    Coding bases are counted in strand order: exons (trx, st, en, strand) give offsets by a running sum, so no base is
    made a row.
    """
    order = W.partitionBy("trx").orderBy(F.col("st") * F.col("strand")).rowsBetween(W.unboundedPreceding, -1)
    placed = exons.withColumn("before", F.coalesce(F.sum(F.col("en") - F.col("st")).over(order), F.lit(0)))
    placed = placed.select("trx", F.col("st").alias("ex_st"), F.col("en").alias("ex_en"), "strand", "before")
    met = df.join(placed, "trx").where((F.col("st") < F.col("ex_en")) & (F.col("ex_st") < F.col("en")))
    lo, hi = F.greatest("st", "ex_st"), F.least("en", "ex_en")
    first = F.col("before") + F.when(F.col("strand") > 0, lo - F.col("ex_st")).otherwise(F.col("ex_en") - hi)
    last = F.col("before") + F.when(F.col("strand") > 0, hi - F.col("ex_st")).otherwise(F.col("ex_en") - lo)
    return met.groupBy(*df.columns).agg(F.min(F.floor(first / 3) + 1).alias("first_codon"), F.max(F.ceil(last / 3)).alias("last_codon"))


def label_join(df: DataFrame, labels: DataFrame, key: str, label_key: str) -> DataFrame:
    """df with the columns of labels, by keys without blanks around them and in lower case where they are strings."""
    plain = lambda d, c: F.lower(F.trim(F.col(c))) if dict(d.dtypes)[c] == "string" else F.col(c)
    other = labels.withColumn("_key", plain(labels, label_key)).drop(label_key)
    return df.withColumn("_key", plain(df, key)).join(other, "_key").drop("_key")


def attach_metadata(df: DataFrame, info: DataFrame, key: str, name: str) -> DataFrame:
    """df with what info says of its key, nulls where it says nothing; info's key column is `name`."""
    return df.join(info, F.col(key) == F.col(name), "left")


def panel_by_sample(sites: DataFrame, sheet: DataFrame, by: str = "guide") -> DataFrame:
    """Every site of a guide with every sample that has the guide."""
    return sites.join(sheet.distinct(), by)


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first k rows in the given order."""
    return df.orderBy(*order).limit(k)


def tail_k(df: DataFrame, k: int, column: str, *ties: str) -> DataFrame:
    """The last k rows by ascending column and ties, found from the other end."""
    return df.orderBy(F.desc(column), *map(F.desc, ties)).limit(k)


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of the columns, of all if none are named."""
    return (df.select(*columns) if columns else df).dropDuplicates()


def names_in(names: Column, listed: list[str]) -> Column:
    """Which of the names are listed."""
    return F.array_intersect(names, F.array(*map(F.lit, listed)))


def names_besides(names: Column, listed: list[str]) -> Column:
    """Which of the names are not listed."""
    return F.array_except(names, F.array(*map(F.lit, listed)))
