"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A document's set holds its distinct word shingles. Two permutations of the ring of 2**32 numbers give the signature:
the first scatters the shingles, the second, shifted circularly by k places, gives coordinate k as the least image of
the set. Bands of coordinates are hashed into buckets; documents that share a bucket are candidates, and a link needs
the Jaccard similarity of the two full sets.

Documents with equal sets are one node. Pairs of a bucket are not all made. Buckets of up to three nodes are compared
pair by pair. In the others, nodes that can have no link are taken out exactly: those with so many shingles
that no other node in question has that no partner can be similar. Then the most central node of each bucket is
compared with the others; whoever is then outside the largest component of its
family is compared with all of the family. So each pair that shares a bucket is compared, excluded or connected. With
32 bands of 4, a pair of similarity 0.8 shares no bucket with a chance of 5e-8. Sets are told apart by 128 bits of a digest of
their sorted hashes; nodes are numbers given to the distinct digests.

Defined cases: null, empty and blank texts have empty sets and are linked with nothing, not even one another; a text
with fewer words than a shingle is one shingle; component_id is the least doc_id of the component, null ids last;
rows that repeat a doc_id are nodes of their own by their sets. Other columns are ignored by `classes`, kept by `dedup`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.llm.common import broadcast_if_small, give_back_memory, join_hot, runs_on_executors, rows_of_pairs, saved, small_batches, text_digest
from locusweave.llm.graph import components
from locusweave.llm.words import mix64, shingle_sets

runs_on_executors(__name__)
SHINGLE_WORDS = 4
PERCENT = 80
BANDS, ROWS = 32, 4
#: Buckets of up to so many nodes are compared first.
SMALL = 3
#: Times that nodes without possible links are taken out.
PEELS = 1
#: Shingles of the stragglers in one row, members of a family that meet them in one task, and rows of stragglers there.
PACK, MEMBERS, PACKS = 1 << 15, 512, 16
SLICE = 1 << 16
ROWS_AT_ONCE = 256


def _scatter(x: np.ndarray) -> np.ndarray:
    """The first permutation of the ring of 2**32 numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def _second(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The second permutation, in place; t is room for as many numbers."""
    np.right_shift(x, np.uint32(16), out=t)
    x ^= t
    x *= np.uint32(0x7FEB352D)
    np.right_shift(x, np.uint32(15), out=t)
    x ^= t
    x *= np.uint32(0x846CA68B)
    np.right_shift(x, np.uint32(16), out=t)
    x ^= t
    return x


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Circulant MinHash signatures of non-empty sets, a row each."""
    out = np.full((len(sets), size), np.iinfo(np.uint32).max, np.uint32)
    parts, held = [], 0
    for i, s in enumerate(sets):
        for a in range(0, len(s), SLICE):
            parts.append((i, s[a : a + SLICE]))
            held += len(parts[-1][1])
        if held >= SLICE or i == len(sets) - 1:
            ring = _scatter(np.concatenate([p for _, p in parts]).astype(np.uint32))
            at = np.cumsum([0] + [len(p) for _, p in parts[:-1]])
            rows = np.array([r for r, _ in parts])
            x, t = np.empty_like(ring), np.empty_like(ring)
            for k in range(size):
                np.add(ring, np.uint32(k), out=x)
                np.minimum.at(out[:, k], rows, np.minimum.reduceat(_second(x, t), at))
            parts, held = [], 0
    return out


def _buckets(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    cells = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(1), cells.shape[:2]).copy()
    for r in range(rows):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, r])
    return out.view(np.int64)


def _digest(s: np.ndarray) -> bytes | None:
    """128 bits for a set, from a digest of all of it; null for the empty set."""
    return hashlib.sha256(s.tobytes()).digest()[:16] if len(s) else None


def _sketches(words: int, bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), ROWS_AT_ONCE):
                batch = whole.slice(a, ROWS_AT_ONCE)
                sets = list(shingle_sets(batch.column(1), words))
                full = [s for s in sets if len(s)]
                made = _buckets(signatures(full, bands * rows), bands, rows) if full else np.zeros((0, bands), np.int64)
                lengths = np.array([bands if len(s) else 0 for s in sets])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(made.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *batch.columns[2:], pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary()), lists],
                    ["doc_id", *batch.schema.names[2:], "n_shingles", "digest", "buckets"],
                )
        give_back_memory()

    return sketch


def _full_sets(words: int):
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), ROWS_AT_ONCE):
                sets = list(shingle_sets(whole.slice(a, ROWS_AT_ONCE).column(1), words))
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                flat = np.concatenate(sets).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for s in sets], pa.binary()), lists], ["digest", "shingles"])
        give_back_memory()

    return full


def _sets_of(ids: DataFrame, nodes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """ids(node) -> node, n, shingles: full sets, made again from the texts."""
    known = saved(nodes.join(ids, "node").select("node", "digest", F.col("first_id").alias("_id")), "near-wanted")
    wanted = broadcast_if_small(known.select("_id").distinct())
    rows = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    sets = small_batches(rows).mapInArrow(_full_sets(words), "digest binary, shingles array<long>").join(broadcast_if_small(known.select("node", "digest")), "digest")
    return sets.dropDuplicates(["node"]).select("node", F.size("shingles").cast("long").alias("n"), "shingles")


def _similar(shared, n, m, percent: int):
    return shared * 100 >= (n + m - shared) * percent


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets are similar."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    first = broadcast_if_small(saved(pairs.select("a").distinct(), "near-first"))
    both = two.join(broadcast_if_small(pairs), "b").join(one.join(first, "a", "left_semi"), "a")
    shared = F.size(F.array_intersect("s_a", "s_b")).cast("long")
    return both.where(_similar(shared, F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def _open(cells: DataFrame, stars: DataFrame) -> DataFrame:
    """cells with the component of each node, without buckets whose members are all in one."""
    of = stars.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    cells = cells.join(of, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    groups = cells.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return saved(cells.join(groups.where("lo < hi").select("bucket"), "bucket"), "near-cells")


def _compare_small(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of buckets with up to SMALL nodes, from all their pairs."""
    few = cells.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("node", "n"))).alias("x"))
    one = few.select(F.explode(F.flatten(F.transform("x", lambda p: F.transform(F.filter("x", lambda q: q["node"] > p["node"]), lambda q: F.struct(p.alias("p"), q.alias("q")))))).alias("z"))
    near = _similar(F.least("z.p.n", "z.q.n"), F.col("z.p.n"), F.col("z.q.n"), percent)
    pairs = one.where(near).select(F.col("z.p.node").alias("a"), F.col("z.q.node").alias("b")).distinct()
    return _linked(saved(pairs, "near-pairs"), sets, percent)


def _compare_hubs(cells: DataFrame, hubs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between each bucket's hub and its other members. hubs(bucket, hub, hub_n)."""
    near = _similar(F.least("n", "hub_n"), F.col("n"), F.col("hub_n"), percent)
    pairs = cells.join(broadcast_if_small(hubs), "bucket").where((F.col("node") != F.col("hub")) & near)
    pairs = pairs.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    return _linked(saved(pairs, "near-pairs"), sets, percent)


def _without(cells: DataFrame, hubs: DataFrame) -> DataFrame:
    return cells.join(hubs.select("bucket", F.col("hub").alias("node")), ["bucket", "node"], "left_anti")


def _peel(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """cells with `alone`, without nodes that can have no link.

    alone counts the shingles that no other node in question has. What a node shares with a partner is at most the
    rest of its set, and the partner is no smaller than the least set of its buckets.
    """
    live = broadcast_if_small(saved(cells.select("node").distinct(), "near-live"))
    seen = sets.join(live, "node", "left_semi").select("node", F.explode("shingles").alias("shingle"))
    once = seen.groupBy("shingle").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).where("c = 1")
    alone = once.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    least = cells.groupBy("bucket").agg(F.min("n").alias("least"))
    able = cells.join(least, "bucket").groupBy("node").agg(F.max("n").alias("n"), F.min("least").alias("least"))
    able = able.join(alone, "node", "left").withColumn("alone", F.coalesce("alone", F.lit(0)))
    rest = F.col("n") - F.col("alone")
    able = able.where(_similar(rest, F.col("n"), F.greatest("least", rest), percent)).select("node", "alone")
    return cells.drop("alone").join(able, "node")


def _compare_stragglers(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All links of open buckets: whoever is outside the largest component of a family against all of the family.

    A family is a set of nodes that buckets connect. Its stragglers are packed into rows of a few, which its members
    meet by a join on the family, so pairs are compared inside a row and only links become rows.
    """
    least = saved(cells.groupBy("bucket").agg(F.min("node").alias("b")), "near-least")
    families = components(cells.join(broadcast_if_small(least), "bucket").select(F.col("node").alias("a"), "b"))
    members = cells.groupBy("node").agg(F.first("comp").alias("comp"), F.first("n").alias("n"))
    members = members.join(families.select(F.col("a").alias("node"), F.col("b").alias("family")), "node", "left")
    members = saved(members.withColumn("family", F.coalesce("family", "node")), "near-members")
    sizes = members.groupBy("family", "comp").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy("family").agg(F.max(F.struct("c", "comp")).alias("m")).select("family", F.col("m.comp").alias("main"))
    few = members.join(main, "family").where("comp <> main").drop("main")
    part = lambda n: F.pmod(F.xxhash64("node"), n)
    dealt = few.groupBy("family").agg(F.ceil(F.sum("n") / PACK).alias("packs"))
    dealt = dealt.join(sizes.groupBy("family").agg(F.ceil(F.sum("c") / MEMBERS).alias("slots")), "family").withColumn("turns", F.ceil(F.col("packs") / PACKS))
    dealt = broadcast_if_small(saved(dealt, "near-dealt"))
    few = few.join(dealt, "family").withColumn("pack", part(F.col("packs"))).join(sets.select("node", "shingles"), "node")
    packs = few.groupBy("family", "pack").agg(F.collect_list(F.struct("node", "comp", "n", "shingles")).alias("others"), F.first("slots").alias("slots"), F.first("turns").alias("turns"))
    packs = packs.withColumn("turn", F.pmod("pack", "turns")).withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1))).drop("slots", "turns", "pack")
    # Each pack meets each part of the members once, in the turn to which the pack belongs.
    met = members.join(dealt, "family").withColumn("slot", part(F.col("slots"))).withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)))
    met = met.select("family", "slot", "turn", "node", "comp", "n").join(sets.select("node", "shingles"), "node")
    met = met.join(packs, ["family", "slot", "turn"])

    def shared(x):
        able = (x["comp"] != F.col("comp")) & _similar(F.least(x["n"], F.col("n")), x["n"], F.col("n"), percent)
        return F.when(able, F.size(F.array_intersect("shingles", x["shingles"])).cast("long")).otherwise(F.lit(-1))

    links = F.filter("others", lambda x: _similar(shared(x), x["n"], F.col("n"), percent))
    return met.select("node", F.explode(F.transform(links, lambda x: x["node"])).alias("b")).select(F.col("node").alias("a"), "b")


def _links_of(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stars (a, b) of the components of all similar pairs that share a bucket. cells(bucket, node, n, size)."""
    links = _compare_small(cells.where(F.col("size") <= SMALL), sets, percent)
    cells = cells.where(F.col("size") > SMALL).drop("size")
    if cells.isEmpty():
        return components(links)
    for _ in range(PEELS):
        cells = saved(_peel(cells, sets, percent), "near-cells")
    central = F.min(F.struct((F.col("alone") / F.col("n")).alias("o"), F.col("node").alias("hub"), F.col("n").alias("hub_n")))
    hubs = saved(cells.groupBy("bucket").agg(central.alias("h")).select("bucket", "h.hub", "h.hub_n"), "near-hubs")
    stars = components(links.unionByName(_compare_hubs(cells, hubs, sets, percent)))
    cells = _open(_without(cells, hubs), stars)
    return stars if cells.isEmpty() else components(stars.unionByName(_compare_stragglers(cells, sets, percent)))


def _labelled(docs: DataFrame, *more: Column, words: int = SHINGLE_WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """Two tables: doc_id, more, n_shingles, digest of each row, and digest, rows, comp, component_id of each set that is not empty."""
    given = docs.select("doc_id", "text", *more)
    carried = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields if f.name != "text")
    kinds = f"{carried}, n_shingles long, digest binary, buckets array<long>"
    sketches = saved(small_batches(given).mapInArrow(_sketches(words, bands, rows), kinds), "near-sketches")
    full = sketches.where("n_shingles > 0")
    # Equal sets have equal buckets.
    nodes = full.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"), F.first("buckets").alias("buckets"), F.count(F.lit(1)).alias("rows"))
    nodes = saved(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    cells = nodes.select("node", "n", F.explode("buckets").alias("bucket"))
    members = F.sum(F.xxhash64("node").cast("decimal(38,0)"))
    groups = cells.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("first"), members.alias("print"))
    # Of buckets with the same members one is enough.
    groups = groups.where("size > 1").groupBy("size", "first", "print").agg(F.min("bucket").alias("bucket"))
    groups = saved(groups.select("bucket", "size"), "near-groups")
    cells = saved(cells.join(broadcast_if_small(groups), "bucket"), "near-cells")
    stars = None
    if not cells.isEmpty():
        sets = saved(_sets_of(cells.select("node").distinct(), nodes, docs, words), "near-sets")
        stars = _links_of(cells, sets, percent)
    of = nodes.select("node", "digest", "rows", "first_id")
    if stars is None:
        labels = of.select("digest", "rows", F.col("node").alias("comp"), F.col("first_id").alias("component_id"))
    else:
        of = of.join(stars.select(F.col("a").alias("node"), F.col("b").alias("comp")), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        labels = of.join(of.groupBy("comp").agg(F.min("first_id").alias("component_id")), "comp").select("digest", "rows", "comp", "component_id")
    return sketches.drop("buckets"), saved(labels, "near-labels")


def classes(docs: DataFrame, **how) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_shingles, component_id, kept; a row per document."""
    sketches, labels = _labelled(docs, **how)
    found = join_hot(sketches.where("n_shingles > 0"), labels, "digest", "rows").select("doc_id", "n_shingles", "component_id")
    out = found.unionByName(sketches.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def dedup(docs: DataFrame, **how) -> DataFrame:
    """One row of each component, with all its columns, and all rows without shingles.

    It is a row of the least doc_id (null ids last), among its texts of the least digest.
    """
    sketches, labels = _labelled(docs, text_digest(F.col("text")).alias("text_sha256"), **how)
    pairs = sketches.where("n_shingles > 0").groupBy("doc_id", "text_sha256").agg(F.first("digest").alias("digest"), F.count(F.lit(1)).alias("n"))
    pairs = saved(join_hot(pairs, labels.select("digest", "rows", "comp"), "digest", "rows").drop("rows"), "near-rows")
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_sha256")
    best = pairs.groupBy("comp").agg(F.min(least).alias("best"), F.sum("n").alias("rows")).where("rows > 1")
    best = saved(best.select("comp", F.col("best.doc_id").alias("_id"), F.col("best.text_sha256").alias("_sha")), "near-best")
    kept = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_sha256") == F.col("_sha"))
    pairs = pairs.join(broadcast_if_small(best), "comp").select("doc_id", "text_sha256", kept.alias("kept"), "n")
    return rows_of_pairs(docs, saved(pairs.where("not kept or n > 1"), "near-pairs-gone"))
