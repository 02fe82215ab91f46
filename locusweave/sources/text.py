"""Readers of genomic text formats.

Each format has a function from lines (a DataFrame with `value`) to a table, and a reader that applies it to files. Bad
rows are dropped or get nulls as stated; nothing is inferred from the data but a header's names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumn("file", F.col("_metadata.file_path"))


def _parts(sep: str = "\t") -> Column:
    return F.split("value", sep, -1)


def variants_of(rows: DataFrame) -> DataFrame:
    """VCF lines: chrom, pos, id, ref, alts, qual, filters, info (a map; flags have null values), format, calls.

    Header lines and rows with fewer than eight columns are dropped; a dot is null.
    """
    p = _parts()
    rows = rows.where(~F.col("value").startswith("#") & (F.size(p) >= 8))
    at = lambda k: F.nullif(F.get(p, F.lit(k)), F.lit("."))
    return rows.select(
        at(0).alias("chrom"), at(1).try_cast("long").alias("pos"), at(2).alias("id"), at(3).alias("ref"), F.split(at(4), ",").alias("alts"), at(5).try_cast("double").alias("qual"),
        F.split(at(6), ";").alias("filters"), F.str_to_map(at(7), F.lit(";"), F.lit("=")).alias("info"), F.split(at(8), ":").alias("format"),
        F.transform(F.slice(p, F.lit(10), F.greatest(F.size(p) - 9, F.lit(0))), lambda c: F.split(c, ":")).alias("calls"),
    )


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    return variants_of(lines(spark, path))


def sample_names(rows: DataFrame) -> list[str]:
    """The samples that the #CHROM line of VCF lines names, in order; read on the driver, from that line alone."""
    head = rows.where(F.col("value").startswith("#CHROM\t")).select("value").first()
    return head[0].split("\t")[9:] if head else []


def calls_by_sample(variants: DataFrame, samples: list[str]) -> DataFrame:
    """A row per variant and sample: the variant's columns with sample and call, a map of its format."""
    names = F.array(*map(F.lit, samples)) if samples else F.array().cast("array<string>")
    each = F.explode(F.arrays_zip(names.alias("sample"), F.slice("calls", F.lit(1), F.size(names)).alias("values")))
    out = variants.withColumn("_x", each).withColumn("sample", F.col("_x.sample")).withColumn("call", call_map(F.col("format"), F.col("_x.values")))
    return out.drop("_x", "calls", "format")


def call_map(format_: Column, call: Column) -> Column:
    """Format names and one call's values as a map; trailing values that are left out are absent."""
    n = F.least(F.size(format_), F.size(call))
    return F.map_from_arrays(F.slice(format_, F.lit(1), n), F.slice(call, F.lit(1), n))


def target_variants_of(rows: DataFrame) -> DataFrame:
    """Target sites of VCF lines: chrom, start0, pos, on_target (1 if INFO has TARGET)."""
    v = variants_of(rows)
    return v.select("chrom", (F.col("pos") - 1).alias("start0"), "pos", F.coalesce(F.map_contains_key("info", F.lit("TARGET")).cast("int"), F.lit(0)).alias("on_target"))


def read_target_csv(spark: SparkSession, path: str) -> DataFrame:
    """Target sites of a CSV with 1-based Start and On_target or on_target, 0 if it has neither."""
    df = spark.read.option("header", True).csv(path)
    names = {c.lower(): c for c in df.columns}
    chrom, start = names.get("chrom") or names["chromosome"], names["start"]
    on = F.col(names["on_target"]).cast("int") if "on_target" in names else F.lit(0)
    return df.select(F.col(chrom).alias("chrom"), (F.col(start).cast("long") - 1).alias("start0"), F.coalesce(on, F.lit(0)).alias("on_target"))


def labelled_reads_of(rows: DataFrame) -> DataFrame:
    """Label, chrom, pos, then a SAM record. TP and 1 are 1, TN and 0 are 0; short rows and bad positions are dropped."""
    p = _parts()
    label = F.when(F.get(p, F.lit(0)).isin("TP", "1"), 1).when(F.get(p, F.lit(0)).isin("TN", "0"), 0)
    at = lambda k: F.get(p, F.lit(k))
    tags = F.map_from_entries(F.transform(F.filter(F.slice(p, F.lit(15), F.greatest(F.size(p) - 14, F.lit(0))), lambda t: t.rlike("^..:.:")), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, F.lit(6), F.length(t)))))
    out = rows.where((F.size(p) >= 14) & at(2).try_cast("long").isNotNull() & label.isNotNull())
    return out.select(
        label.alias("label"), at(1).alias("chrom"), at(2).cast("long").alias("pos"), at(3).alias("read_name"), at(4).try_cast("int").alias("flag"), (at(6).try_cast("long") - 1).alias("ref_start"),
        at(7).try_cast("int").alias("mapq"), at(8).alias("cigar"), at(12).alias("seq"), tags.alias("tags"),
    )


def targets_of(rows: DataFrame) -> DataFrame:
    """BED lines whose fifth column packs type|region|gene|gene_id|transcript|cds_start|cds_end|strand; genes and SVs, distinct."""
    p = _parts()
    info = F.split(F.get(p, F.lit(4)), r"[|]")
    at = lambda k: F.nullif(F.get(info, F.lit(k)), F.lit(""))
    out = rows.where(F.size(p) >= 5).select(
        F.get(p, F.lit(0)).alias("chrom"), F.get(p, F.lit(1)).try_cast("long").alias("st"), F.get(p, F.lit(2)).try_cast("long").alias("en"), F.get(p, F.lit(3)).alias("gene"),
        at(0).alias("type"), at(1).alias("region"), at(4).alias("trx"), at(5).try_cast("long").alias("cds_st"), at(6).try_cast("long").alias("cds_en"), at(7).alias("strand"),
    )
    return out.where(F.lower("type").isin("gene", "sv")).dropDuplicates()


def bedgraph_of(rows: DataFrame) -> DataFrame:
    """Lines of exactly four columns: chrom, st, en, value."""
    p = F.split("value", r"\s+")
    at = lambda k: F.get(p, F.lit(k))
    return rows.where(F.size(p) == 4).select(at(0).alias("chrom"), at(1).try_cast("long").alias("st"), at(2).try_cast("long").alias("en"), at(3).try_cast("double").alias("v"))


def fragments_of(rows: DataFrame, baits: bool = False) -> DataFrame:
    """Lines of a fragment map (chrom, st, en, frag_id) or, with baits, of a bait map (and annotation), tab separated.

    A line with another number of columns raises an error when it is read.
    """
    p, n = _parts(), 5 if baits else 4
    checked = F.when(F.size(p) == n, p).otherwise(F.raise_error(F.concat(F.lit(f"a line without {n} columns: "), F.substring("value", 1, 60))).cast("array<string>"))
    names = {"chrom": "string", "st": "long", "en": "long", "frag_id": "long", "annotation": "string"}
    cells = rows.where(F.trim("value") != "").select(checked.alias("p"))
    return cells.select(*[F.get("p", F.lit(k)).try_cast(t).alias(c) for k, (c, t) in enumerate(list(names.items())[:n])])


def contacts_of(rows: DataFrame) -> DataFrame:
    """White-space separated chr1, mid1, chr2, mid2, count."""
    p = F.split(F.trim("value"), r"\s+")
    at = lambda k: F.get(p, F.lit(k))
    return rows.where(F.size(p) >= 5).select(at(0).alias("chr1"), at(1).try_cast("long").alias("mid1"), at(2).alias("chr2"), at(3).try_cast("long").alias("mid2"), at(4).try_cast("double").alias("n"))


def contact_fragments_of(rows: DataFrame) -> DataFrame:
    p = F.split(F.trim("value"), r"\s+")
    return rows.where(F.size(p) >= 4).select(F.get(p, F.lit(0)).alias("chrom"), F.get(p, F.lit(2)).try_cast("long").alias("mid"), F.get(p, F.lit(3)).try_cast("double").alias("total"))


def read_caller_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("category string, readgroup string, metric string, value string, percent double").csv(path)


def read_coverage_report(spark: SparkSession, path: str) -> DataFrame:
    """A table whose header starts with #; numbers from the fifth column on, 0 where empty."""
    df = spark.read.option("header", True).option("sep", "\t").csv(path)
    df = df.toDF(*[c.lstrip("#").strip() for c in df.columns])
    return df.select(*df.columns[:4], *[F.coalesce(F.col(f"`{c}`").try_cast("double"), F.lit(0.0)).alias(c) for c in df.columns[4:]])


def split_json_of(rows: DataFrame, section: str) -> DataFrame:
    """Documents (name, value) with a section {columns, data} -> name, row, column, cell."""
    kind = "columns array<string>, data array<array<string>>"
    part = F.from_json(F.get_json_object("value", f"$.{section}"), kind).alias("s")
    out = rows.select("name", part).select("name", "s.columns", F.posexplode("s.data").alias("row", "cells"))
    return out.select("name", "row", F.explode(F.arrays_zip(F.col("columns").alias("column"), F.col("cells").alias("cell"))).alias("x")).select("name", "row", "x.column", "x.cell")


def read_nested_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Images of catalog files: file, image, version, and one row per tag."""
    schema = "stack array<struct<IMAGE: string, ENV: map<string, string>, tags: array<string>, platforms: array<string>>>"
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    rows = df.select(F.col("_metadata.file_name").alias("file"), F.explode("stack").alias("s"))
    return rows.select("file", F.col("s.IMAGE").alias("image"), F.col("s.ENV")["R_VERSION"].alias("version"), F.explode_outer("s.tags").alias("tag"))


def sections_of(rows: DataFrame) -> DataFrame:
    """Whole reports (name, value) -> name, section, line, text; sections start at *** TITLE *** lines.

    Lines of a section that says None Detected are left out.
    """
    blocks = rows.select("name", F.posexplode(F.split("value", r"(?m)^\*\*\*\s*")).alias("part", "block")).where("part > 0")
    title = F.trim(F.regexp_extract("block", r"^([^*\n]*)\*\*\*", 1))
    body = F.regexp_replace("block", r"^[^\n]*\n?", "")
    out = blocks.select("name", title.alias("section"), F.posexplode(F.split(body, "\n")).alias("line", "text"))
    empty = blocks.where(F.col("block").contains("None Detected")).select("name", title.alias("section"))
    return out.where(F.trim("text") != "").join(empty, ["name", "section"], "left_anti")


ALIASES = {"content_desc": "id", "exceptions": "exception"}


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A .tsv or .csv sheet with lower-case trimmed headers and aliases resolved; a null id raises when it is read."""
    df = spark.read.option("header", True).option("sep", "\t" if path.endswith(".tsv") else ",").csv(path)
    out: dict[str, Column] = {}
    for c in df.columns:
        name = c.strip().lower().replace(" ", "_")
        name = ALIASES.get(name, name)
        out[name] = F.coalesce(out[name], F.col(f"`{c}`")) if name in out else F.col(f"`{c}`")
    out["id"] = F.coalesce(out["id"], F.raise_error(F.lit("a sample without an id")).cast("string"))
    return df.select(*[v.alias(k) for k, v in out.items()])


def manifest_of(rows: DataFrame) -> DataFrame:
    """name<TAB>path, or a path alone whose name is its base name without extension."""
    p = _parts()
    two = F.size(p) >= 2
    path = F.when(two, F.get(p, F.lit(1))).otherwise(F.col("value"))
    name = F.when(two, F.get(p, F.lit(0))).otherwise(F.regexp_replace(F.substring_index("value", "/", -1), r"\.[^.]*$", ""))
    return rows.where(F.trim("value") != "").select(name.alias("name"), path.alias("path"))


def candidates_of(df: DataFrame, file: Column | None = None) -> DataFrame:
    """Candidate tables with truth from manual_review or pass, numbers coerced, a target flag and the least mismatches.

    target is 1 where is_target or the target's info says so; min_mismatches is the least of MISMATCHES in target_info, 99
    without one. file, a path, gives the sample: its base name up to the first dot.
    """
    have = set(df.columns)
    truth = F.coalesce(*[F.lower(F.col(c).cast("string")) for c in ("manual_review", "pass") if c in have], F.lit(""))
    out = df.withColumn("truth", truth.isin("1", "true", "yes", "pass", "edit").cast("int"))
    for c in ("indel_fraction", "control_indel_fraction", "total_reads"):
        if c in have:
            out = out.withColumn(c, F.col(c).cast("string").try_cast("double"))
    flag = F.lower(F.col("is_target").cast("string")).isin("1", "true", "yes") if "is_target" in have else F.lit(False)
    told = F.coalesce(F.col("target_info"), F.lit("")) if "target_info" in have else F.lit("")
    least = F.array_min(F.transform(F.split(F.regexp_extract(told, r"(?:^|;)MISMATCHES=([0-9,]+)", 1), ","), lambda x: x.try_cast("int")))
    out = out.withColumn("target", (F.coalesce(flag, F.lit(False)) | told.rlike("(?:^|;)TARGET(?:[=;]|$)")).cast("int")).withColumn("min_mismatches", F.coalesce(least, F.lit(99)))
    return out if file is None else out.withColumn("sample", F.substring_index(F.substring_index(file, "/", -1), ".", 1))


def read_group_probe_of(rows: DataFrame, reads: int = 100) -> DataFrame:
    """FASTQ lines (file, n from 0, value) -> per file: flow cell, lane, most common index without N, modal length."""
    rows = rows.where(F.col("n") < 4 * reads)
    heads = rows.where("n % 4 = 0").select("file", F.split(F.regexp_replace("value", "^@", ""), "[: ]").alias("p"))
    last = F.element_at("p", -1)
    index = F.when(~last.contains("N"), last)
    head = heads.groupBy("file").agg(F.min(F.get("p", F.lit(2))).alias("flowcell"), F.min(F.get("p", F.lit(3))).alias("lane"), F.mode(index, True).alias("index"))
    length = rows.where("n % 4 = 1").groupBy("file").agg(F.mode(F.length("value"), True).alias("length"))
    return head.join(length, "file")


def mates_that_differ(probes: DataFrame, mates: DataFrame) -> DataFrame:
    """Pairs of files (one, two) whose probes differ in flow cell, lane or index, or of which one has none."""
    fields = ("flowcell", "lane", "index")
    side = lambda name, k: probes.select(F.col("file").alias(name), F.struct(*fields).alias(k))
    both = mates.join(side("one", "a"), "one", "left").join(side("two", "b"), "two", "left")
    return both.where(F.col("a").isNull() | F.col("b").isNull() | ~F.col("a").eqNullSafe(F.col("b"))).select("one", "two")


def read_features(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    return spark.read.parquet(*paths).select(*columns).dropna()


def reference_chunks(sequences: DataFrame, chunk: int = 1000) -> DataFrame:
    """sequences(chrom, seq) -> chrom, chunk, bases: pieces for lookups by an equi-join."""
    n = F.greatest(F.ceil(F.length("seq") / chunk), F.lit(1))
    parts = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda k: F.substring(F.col("seq"), (k * chunk + 1).cast("int"), F.lit(chunk)))
    return sequences.select("chrom", F.posexplode(parts).alias("chunk", "bases"))


def bases_at(df: DataFrame, chunks: DataFrame, before: int, after: int, chunk: int = 1000) -> DataFrame:
    """df(chrom, pos, ...) with `bases` from pos - before to pos + after; N beyond the ends or on unknown contigs.

    Every window meets at most the pieces it touches. Both sides are shuffled: the planner takes the pieces' size from the
    file before sequences are cut, or repeated, and would send a whole genome through the driver.
    """
    keyed = df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_lo", F.col("pos") - before).withColumn("_hi", F.col("pos") + after)
    keyed = keyed.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("_lo") / chunk), F.floor(F.col("_hi") / chunk))))
    met = keyed.join(chunks.hint("merge"), ["chrom", "chunk"], "left")
    begin = F.greatest(F.col("_lo"), F.col("chunk") * chunk)
    end = F.least(F.col("_hi"), F.col("chunk") * chunk + chunk - 1)
    size = (end - begin + 1).cast("int")
    piece = F.substring(F.coalesce("bases", F.lit("")), (begin - F.col("chunk") * chunk + 1).cast("int"), size)
    met = met.withColumn("_p", F.struct("chunk", F.rpad(piece, size, "N").alias("b")))
    keys = [*df.columns, "_row"]
    return met.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("_p")), lambda x: x["b"]), "").alias("bases")).drop("_row")
