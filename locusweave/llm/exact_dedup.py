"""Exact duplicates by deterministic block naming (DataFrame operations only).

A text is cut into blocks of a fixed number of characters. The distinct blocks are sorted into integer names: equal
blocks get one name, different blocks different names. Adjacent names of a text are then paired, the distinct pairs
are sorted into new names, and so on, so that after log2(blocks) rounds each text has one integer; with the number of its
rounds in the low bits it is the text's identity. A text leaves the rounds when it has one name, so each round works on
the longer half only. Two rows share an identity exactly if their texts are equal.

Texts move once, as distinct blocks; after that only integers do. Blocks travel by their 64-bit hash, and the distinct
blocks of each hash are gathered with it (one, but for collisions). A hash that two different blocks share is settled
by comparing the blocks themselves, so no identity rests on a hash.

Blocks and pairs of names that many texts share are joined by a broadcast (`join_hot`), so none of them fills a task.

Defined cases: a text may be of any length, as it moves in blocks; null text counts as empty; empty texts are equal to one another; of equal texts the row with the
largest doc_id stays (null ids come last); of rows that repeat doc_id and text, one stays; an empty table gives an
empty result. Other columns are ignored by `classes` and kept by `dedup`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusweave.llm.common import join_hot, rows_of_pairs, saved

BLOCK_CHARS = 4096
#: More than the number of rounds.
ROUNDS = 64


def _blocks(text, chars: int):
    """The blocks of a text as an array; the empty text has one empty block."""
    found = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chars}}}"), F.lit(0))
    return F.when(F.length(text) <= chars, F.array(text)).otherwise(found)


def _named(distinct: DataFrame, *order: str) -> DataFrame:
    """Sort distinct keys and number them in that order, as whole numbers that grow with the order."""
    return distinct.orderBy(*order).withColumn("name", F.monotonically_increasing_id())


def _block_names(docs: DataFrame, heads: DataFrame, cells: DataFrame, chars: int, block_hash) -> DataFrame:
    """cells(row, at, hash) -> row, at, name."""
    text = F.coalesce(F.col("text"), F.lit(""))
    pieces = docs.select(F.explode(_blocks(text, chars)).alias("block")).select(block_hash(F.col("block")).alias("hash"), "block")
    sets = pieces.groupBy("hash").agg(F.sort_array(F.collect_set("block")).alias("blocks"), F.count(F.lit(1)).alias("times"))
    # A block is carried on only where its hash does not tell it from another.
    clear = F.size("blocks") == 1
    keys = sets.select("hash", F.explode(F.when(clear, F.array(F.lit(""))).otherwise(F.col("blocks"))).alias("block"), (~clear).alias("mixed"), "times")
    names = saved(_named(keys, "hash", "block"), "dedup-blocks")
    plain = names.where(~F.col("mixed")).select("hash", "name", "times")
    out = join_hot(cells, plain, "hash", "times").select("row", "at", "name")
    mixed = names.where("mixed")
    if mixed.isEmpty():
        return out
    texts = docs.select(F.col("doc_id").alias("_id"), text.alias("_text")).distinct()
    mine = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_sha256") == F.sha2("_text", 256))
    rows = heads.join(texts, mine).select("row", F.posexplode(_blocks(F.col("_text"), chars)).alias("at", "block"))
    rows = rows.withColumn("hash", block_hash(F.col("block")))
    return out.unionByName(rows.join(mixed.select("hash", "block", "name"), ["hash", "block"]).select("row", "at", "name"))


def _hash(block):
    return F.xxhash64(block)


def classes(docs: DataFrame, block_chars: int = BLOCK_CHARS, block_hash=_hash) -> DataFrame:
    """docs(doc_id, text) -> doc_id, keep_id, group_size, kept, text_sha256, text_id; a row per document.

    block_hash gives the long by which blocks travel; the result is the same for any such function.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    heads = saved(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.sha2(text, 256).alias("text_sha256"),
            F.transform(_blocks(text, block_chars), block_hash).alias("hashes"),
        ),
        "dedup-heads",
    )
    cells = heads.select("row", F.posexplode("hashes").alias("at", "hash"))
    lengths = heads.where(F.size("hashes") > 1).select("row", F.size("hashes").alias("left_over"))
    most = lengths.agg(F.max("left_over")).first()[0] or 1
    names = saved(_block_names(docs, heads, cells, block_chars, block_hash), "dedup-names0")
    if most == 1:
        ended, live = [names.select("row", (F.col("name") * ROUNDS).alias("text_id"))], None
    else:
        names = saved(names.join(lengths, "row", "left"), "dedup-lengths")
        ended = [names.where("left_over is null").select("row", (F.col("name") * ROUNDS).alias("text_id"))]
        live = names.where("left_over is not null")
    rounds = 0
    while most > 1:
        rounds += 1
        slot = F.col("at") % 2 == 0
        fewer = F.floor((F.col("left_over") + 1) / 2).cast("int").alias("left_over")
        pairs = live.groupBy("row", F.floor(F.col("at") / 2).cast("int").alias("at"), fewer).agg(
            F.max(F.when(slot, F.col("name"))).alias("left"), F.coalesce(F.max(F.when(~slot, F.col("name"))), F.lit(-1)).alias("right")
        )
        made = saved(_named(pairs.groupBy("left", "right").agg(F.count(F.lit(1)).alias("times")), "left", "right"), f"dedup-pairs{rounds}")
        names = saved(join_hot(pairs, made, ["left", "right"], "times").select("row", "at", "left_over", "name"), f"dedup-names{rounds}")
        ended.append(names.where("left_over = 1").select("row", (F.col("name") * ROUNDS + rounds).alias("text_id")))
        live = names.where("left_over > 1")
        most = (most + 1) // 2
    ids = ended[0]
    for more in ended[1:]:
        ids = ids.unionByName(more)
    rows = saved(heads.select("row", "doc_id", "text_sha256").join(ids, "row"), "dedup-ids")
    best = F.max(F.struct("doc_id", -F.col("row")))
    groups = saved(rows.groupBy("text_id").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")), "dedup-groups")
    out = join_hot(rows, groups, "text_id", "group_size")
    kept = F.col("row") == -F.col("best.col2")
    return out.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256", "text_id")


def dedup(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    found = saved(classes(docs, block_chars), "dedup-classes")
    pairs = found.groupBy("doc_id", "text_sha256").agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    return rows_of_pairs(docs, saved(pairs.where("not kept or n > 1"), "dedup-pairs"))
