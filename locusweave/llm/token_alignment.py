"""Alignment of two tokenizers' tokens by coalescing byte intervals.

A and B tokens of a text are intervals of the same bytes. All of them are sorted by start, the running maximum of their
ends is accumulated, and a group breaks where a start reaches that maximum: there both tokenizers have a border. Within a
group the tokens that end together are linked, which are its last A and its last B token. Whole Arrow batches are
aligned at once, as a text's first start reaches the maximum of the text before it.

Links are counted by id pairs: in a batch's rows, then by a shuffle over the corpus; what comes back to a text are sums
over its own distinct pairs. The table of pairs goes to all tasks if its bytes allow, else pairs with many texts go
to all and the others are shuffled.

A is a byte-level vocabulary (a JSON file of the tokenizers library) and encodes a space and the text; tiktoken encodes
with the vocabulary's own entries as ranks, and a whole text of each slice of a batch is compared with the tokenizers
library, or the task fails. B is a SentencePiece model, which adds the space itself.

Defined cases: texts that are null or empty, or that the bytes of A's or B's tokens do not give back with a space before
them (such as a text with B's space mark), have no tokens: all numbers 0, groups ''. Rows are independent but for the
counts, in which repeated rows count each; empty tables give empty results; other columns are ignored. A text is encoded
whole, whatever its length.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusweave.llm.common import broadcast_if_small, give_back_memory, join_hot, kept_by_worker, runs_on_executors, saved, small_batches

runs_on_executors(__name__)
MARK = "▁"
#: A pair's number is A's id, moved by so many bits, and B's id.
ID_BITS = 24
#: Texts of a slice of a batch take about so many bytes.
SLICE_BYTES = 1 << 20
#: How the byte-level vocabulary cuts texts before it merges. Fixed value of that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes each byte: itself if it is visible, else one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Pair:
    """Both tokenizers, and the bytes of their entries."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a_library = Tokenizer.from_str(a_file.decode())
        self.a_library.encode_special_tokens = True
        vocabulary, of = json.loads(a_file)["model"]["vocab"], byte_characters()
        special = {t["content"] for t in json.loads(a_file).get("added_tokens", [])}
        entries = {bytes(of[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=entries, special_tokens={})
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in entries.items():
            self.a_bytes[i] = token
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        # An id with what follows it: 0 a comma, 1 the other tokenizer's tokens, 2 the next group, 3 nothing.
        self.said = [f"{i}{end}" for i in range(max(len(self.a_bytes), len(pieces))) for end in (",", "|", ";", "")]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The tokens of each text; none where they do not give it back."""
        spaced = [" " + t for t in texts]
        a = self.a.encode_ordinary_batch(spaced, num_threads=1)
        b = self.b.encode(texts, num_threads=1)
        if texts and self.a_library.encode(spaced[0], add_special_tokens=False).ids != a[0]:
            raise ValueError(f"ids differ from the library's for the text that starts with {texts[0][:60]!r}")
        for i, text in enumerate(spaced):
            whole = text.encode()
            if not texts[i] or b"".join(map(self.a_bytes.__getitem__, a[i])) != whole or b"".join(map(self.b_bytes.__getitem__, b[i])) != whole:
                a[i], b[i] = [], []
        return a, b


def coalesced(starts: np.ndarray, ends: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals -> their order by start, and for each in that order the number of its group of overlapping intervals."""
    order = np.lexsort((side, starts))
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = starts[order[1:]] >= np.maximum.accumulate(ends[order])[:-1]
    return order, np.cumsum(breaks)


def aligned(pair: Pair, texts: list[str]) -> dict[str, list]:
    """Groups and links of each text: n_a, n_b, n_groups, groups (as text), pairs and how often each is linked."""
    a, b = pair.encode(texts)
    n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
    ids = np.fromiter((i for side in (a, b) for text in side for i in text), np.int64, int(n_a.sum() + n_b.sum()))
    cut = int(n_a.sum())
    sizes = np.concatenate([pair.a_sizes[ids[:cut]], pair.b_sizes[ids[cut:]]])
    ends = np.concatenate([np.cumsum(sizes[:cut]), np.cumsum(sizes[cut:])])
    side = (np.arange(len(ids)) >= cut).astype(np.int64)
    text = np.concatenate([np.repeat(np.arange(len(texts)), n) for n in (n_a, n_b)])
    order, group = coalesced(ends - sizes, ends, side)
    # A's tokens of a group, then B's; both are in order of place.
    order = order[np.argsort(group * 2 + side[order], kind="stable")]
    group, ids, side, text = np.sort(group), ids[order], side[order], text[order]
    last = np.ones(len(ids), bool)  # of its group
    last[:-1] = group[1:] != group[:-1]
    turn = np.zeros(len(ids), bool)  # the last of A in a group
    turn[:-1] = (side[1:] == 1) & (side[:-1] == 0)
    ended = np.ones(len(ids), bool)  # the last of a text
    ended[:-1] = text[1:] != text[:-1]
    said = ids * 4 + np.where(ended, 3, np.where(last, 2, turn.astype(np.int64)))
    bounds = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
    codes = said.tolist()
    groups = ["".join(map(pair.said.__getitem__, codes[i:j])) for i, j in zip(bounds[:-1], bounds[1:])]
    linked, of = ids[turn] << ID_BITS | ids[last], text[last]
    n_groups = np.bincount(of, minlength=len(texts))
    again = np.lexsort((linked, of))
    linked, of = linked[again], of[again]
    new = np.ones(len(linked), bool)
    new[1:] = (linked[1:] != linked[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(linked)))
    edges = np.searchsorted(of[at], np.arange(len(texts) + 1)).astype(np.int32)
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "groups": groups, "edges": edges, "pairs": linked[at], "times": times}


def links(docs: DataFrame, a_file: bytes, b_file: bytes, digest: bool = True) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_a, n_b, n_groups, n_links, groups (or groups_sha256), pairs, times; a row per document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((a_file, b_file))
    key = hashlib.sha256(a_file).hexdigest() + hashlib.sha256(b_file).hexdigest()
    id_type, name = docs.schema["doc_id"].dataType.simpleString(), "groups_sha256" if digest else "groups"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept_by_worker("token_pair", key, lambda: Pair(*shared.value))
        for whole in batches:
            texts = whole.column(1).to_pylist()
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size < SLICE_BYTES):
                    size += len(texts[to])
                    to += 1
                found = aligned(own, texts[at:to])
                said = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found["groups"]] if digest else found["groups"]
                edges = pa.array(found["edges"], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [whole.column(0).slice(at, to - at), *(pa.array(found[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_groups")), pa.array(said, pa.string()),
                     pa.ListArray.from_arrays(edges, pa.array(found["pairs"], pa.int64())), pa.ListArray.from_arrays(edges, pa.array(found["times"], pa.int32()))],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", name, "pairs", "times"],
                )
                at = to
        give_back_memory()

    chosen = small_batches(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return chosen.mapInArrow(run, f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, {name} string, pairs array<long>, times array<int>")


def pair_counts(found: DataFrame) -> DataFrame:
    """links -> pair, count (links of the corpus that have it), texts (how many have it), best: no pair with its B id has more; saved."""
    each = found.select(F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    counts = saved(each.groupBy("pair").agg(F.sum("times").alias("count"), F.count(F.lit(1)).alias("texts")), "alignment-counts")
    b = F.col("pair").bitwiseAND((1 << ID_BITS) - 1).alias("b")
    most = saved(counts.groupBy(b).agg(F.max("count").alias("most")), "alignment-most")
    judged = counts.select("*", b).join(broadcast_if_small(most), "b")
    return saved(judged.select("pair", "count", "texts", (F.col("count") == F.col("most")).alias("best")), "alignment-pairs")


def align(docs: DataFrame, a_file: bytes, b_file: bytes) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; a row per document."""
    found = saved(links(docs, a_file, b_file).withColumn("row", F.monotonically_increasing_id()), "alignment-links")
    counts = pair_counts(found)
    each = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    small = broadcast_if_small(counts)
    with_counts = each.join(small, "pair") if small is not counts else join_hot(each, counts, "pair", "texts")
    sums = with_counts.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    none = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return found.drop("pairs", "times").join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *none, "groups_sha256")
