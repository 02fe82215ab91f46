"""Writers of genomic text formats: functions to lines or columns, and thin writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, columns: list[str], sep: str = "\t") -> None:
    """Delimited text with a header, nulls as NA, columns in the given order."""
    df.select(*columns).write.mode("overwrite").option("header", True).option("sep", sep).option("nullValue", "NA").csv(path)


def variant_lines(df: DataFrame) -> DataFrame:
    """df(chrom, pos, ref, alt, filter, info map) -> value: VCF records with ids numbered per place and type."""
    k = F.row_number().over(W.partitionBy("chrom", "pos", "svtype").orderBy("ref", "alt"))
    name = F.concat_ws("_", "chrom", F.col("pos").cast("string"), "svtype", k.cast("string"))
    items = F.transform(F.array_sort(F.map_entries("info")), lambda e: F.when(e["value"].isNull() | (e["value"] == ""), e["key"]).otherwise(F.concat(e["key"], F.lit("="), e["value"])))
    return df.select(F.concat_ws("\t", "chrom", F.col("pos").cast("string"), name, "ref", "alt", F.lit("."), "filter", F.array_join(items, ";")).alias("value"))


def variant_header(df: DataFrame) -> DataFrame:
    """Header lines for the INFO keys and filters that occur, one aggregation each."""
    keys = df.select(F.explode(F.map_keys("info")).alias("k")).distinct()
    filters = df.select(F.explode(F.split("filter", ";")).alias("k")).distinct()
    info = keys.select(F.concat(F.lit("##INFO=<ID="), "k", F.lit(',Number=.,Type=String,Description="">')).alias("value"))
    return info.unionByName(filters.select(F.concat(F.lit("##FILTER=<ID="), "k", F.lit(',Description="">')).alias("value")))


def write_variants(df: DataFrame, path: str) -> None:
    """Header and records as text, sorted by place, in part files of a folder and its _header sibling."""
    variant_header(df).coalesce(1).write.mode("overwrite").text(f"{path}_header")
    variant_lines(df.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos")).write.mode("overwrite").text(path)


def clean_number(x: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~(F.isnan(x) | (F.abs(x) == float("inf"))), x)


def split_json(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """One JSON document {columns, data} per group; rows in the order of all their cells. NaN and infinities are null."""
    number = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    cells = F.array(*[(clean_number(F.col(c)) if c in number else F.col(c)).cast("string") for c in columns])
    rows = df.groupBy(by).agg(F.array_sort(F.collect_list(cells)).alias("data"))
    return rows.select(by, F.to_json(F.struct(F.array(*map(F.lit, columns)).alias("columns"), "data")).alias("document"))


def write_training_chunks(df: DataFrame, path: str, columns: list[str]) -> None:
    """Parquet by sample_id, columns in order, missing features as 0."""
    features = [c for c in columns if c != "sample_id"]
    df.select("sample_id", *features).na.fill(0, features).write.mode("overwrite").partitionBy("sample_id").parquet(path)


def circos_lines(df: DataFrame) -> DataFrame:
    """chrom, st, en, annotation -> hs1 st en annotation=..."""
    note = F.concat(F.lit("annotation="), "annotation")
    return df.select(F.concat_ws("\t", F.regexp_replace("chrom", "^chr", "hs"), F.col("st").cast("string"), F.col("en").cast("string"), note).alias("value"))


def interaction_track(df: DataFrame) -> DataFrame:
    """Both ends of an interaction as a track row: chrom, st, en, chrom:st-en,score, id, strand."""
    other = F.format_string("%s:%d-%d,%s", "other_chrom", "other_st", "other_en", F.col("score").cast("string"))
    return df.select(F.col("bait_chrom").alias("chrom"), F.col("bait_st").alias("st"), F.col("bait_en").alias("en"), other.alias("target"), F.lit(".").alias("strand"))


def sites_as_variants(df: DataFrame) -> DataFrame:
    """Sites (chrom, pos, svtype) as minimal records for variant_lines: N and the type in angle brackets.

    Breakends (svtype BND) with mate_chrom and mate_pos get the mate in brackets: N]chrom:pos] where `forward` says that
    the mate is on the forward strand, else N[chrom:pos[.
    """
    info = F.create_map(F.lit("SVTYPE"), F.col("svtype"))
    alt = F.concat(F.lit("<"), "svtype", F.lit(">"))
    if "mate_chrom" in df.columns:
        mark = F.when(F.col("forward"), "]").otherwise("[")
        alt = F.when(F.col("svtype") == "BND", F.concat(F.lit("N"), mark, "mate_chrom", F.lit(":"), F.col("mate_pos").cast("string"), mark)).otherwise(alt)
    return df.select("chrom", "pos", F.lit("N").alias("ref"), alt.alias("alt"), F.lit("PASS").alias("filter"), "svtype", info.alias("info"))


def write_case_tables(path: str, **tables: DataFrame) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(f"{path}/{name}")


def write_sample_lists(sheet: DataFrame, path: str, lists: dict[str, list[str]]) -> None:
    """Parts of a sheet by columns: rows that have them all, without columns that are empty."""
    from locusweave.operators.cohort import drop_empty_columns

    for name, columns in lists.items():
        drop_empty_columns(sheet.dropna(subset=columns)).write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
