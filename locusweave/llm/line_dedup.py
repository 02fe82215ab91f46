"""Repeated lines by range-partitioned hashes: a stream over sorted occurrences gives keep bitmaps, not texts.

Every line whose key is long enough becomes an occurrence (128-bit hash, doc_id, text hash, position). Occurrences are
range-partitioned and sorted by hash, then by document from the largest down, then by position, so a hash that a third
of all lines share is cut over many tasks. A task streams its occurrences once. The first document of a hash is the one
whose lines stay, and the rest go as soon as the least number of documents is reached; until then at most that many
documents' occurrences wait. The hashes with which a task begins or ends may go on in its neighbours: for these the task
returns a few document numbers each, which together decide the occurrences that the task had to leave open.

What goes back to a document is a bitmap of its lines (1 stays), packed and deflated; only documents that lose lines
have one.

Defined cases: null and empty texts have one empty line; lines are cut at line feeds alone; a document is a doc_id:
rows that repeat one count once, and a line stays in all rows of the largest doc_id that holds it; a null doc_id is one
document, smaller than all others; empty tables give empty results; other columns are ignored, whatever they are called,
by `keep_bitmaps` and `digests`, and kept by `dedup`. A text is held whole by one task, however long.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusweave.llm.common import WHITE, broadcast_if_small, runs_on_executors, saved, small_batches, unused

runs_on_executors(__name__)
LEAST_CHARACTERS = 40
LEAST_DOCUMENTS = 5
_BLANKS = WHITE.encode()
#: What a task says of an occurrence: it goes, or neighbours decide; or it names a document of a hash at its border.
GOES, OPEN, BORDER = 0, 1, 2


def keys(text: bytes, least: int) -> list[tuple[int, bytes]]:
    """Position and key of the lines whose key has at least so many code points."""
    found = ((i, line.strip(_BLANKS).lower()) for i, line in enumerate(text.split(b"\n")) if len(line) >= least)
    return [(i, k) for i, k in found if len(k) >= least and (k.isascii() or len(k.decode()) >= least)]


def _occurrences(docs: DataFrame, least: int) -> DataFrame:
    """docs -> h1, h2, doc_id, text_hash, pos; one row per line with a long enough key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, digests = [], [], []
            for r, text in enumerate(batch.column(2).cast(pa.binary())):
                for i, key in keys(text.as_py(), least):
                    rows.append(r)
                    places.append(i)
                    digests.append(hashlib.blake2b(key, digest_size=16).digest())
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), batch.column(0).take(taken), batch.column(1).take(taken), pa.array(places, pa.int32())],
                ["h1", "h2", "doc_id", "text_hash", "pos"],
            )

    text = F.coalesce("text", F.lit(""))
    chosen = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return chosen.mapInArrow(run, "h1 long, h2 long, doc_id long, text_hash long, pos int")


class Stream:
    """Sorted occurrences of one task, batch by batch; `push` and `end` return those on which something can be said.

    An occurrence is a row of whole numbers: h1, h2, has an id, id, text_hash, pos.
    """

    def __init__(self, least: int):
        self.least = least
        self.hash: np.ndarray | None = None  # of the last occurrence
        self.begins = True  # is that the hash with which the task began?
        self.documents = np.zeros((0, 6), np.int64)  # one occurrence of each of its first `least` documents
        self.wait = self.documents  # its occurrences, while nothing can be said of them

    def push(self, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
        if not len(rows):
            return []
        out = []
        if self.hash is None:
            self.hash = rows[0, :2].copy()
        n = self._same(rows)
        if n:
            out += self._go_on(rows[:n])
            rows = rows[n:]
        if not len(rows):
            return out
        if self.begins:
            out.append((BORDER, self.documents))
        new_hash = np.ones(len(rows), bool)
        new_hash[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
        begins = np.flatnonzero(new_hash)
        last = int(begins[-1])
        done, begins = rows[:last], begins[:-1]
        if last:  # hashes that are whole in this batch
            new_doc = new_hash[:last].copy()
            new_doc[1:] |= (done[1:, 2:4] != done[:-1, 2:4]).any(1)
            many = np.add.reduceat(new_doc.astype(np.int64), begins) >= self.least
            of = np.cumsum(new_hash[:last]) - 1
            out.append((GOES, done[many[of] & (done[:, 2:4] != done[begins][of, 2:4]).any(1)]))
        self.hash, self.begins = rows[last, :2].copy(), False
        self.documents = self.wait = np.zeros((0, 6), np.int64)
        return out + self._go_on(rows[last:])

    def _same(self, rows: np.ndarray) -> int:
        """How many of the first rows have the last hash."""
        other = np.flatnonzero((rows[:, :2] != self.hash).any(1))
        return int(other[0]) if len(other) else len(rows)

    def _go_on(self, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """More occurrences of the last hash."""
        if len(self.documents) < self.least:
            ids = np.concatenate([self.documents[-1:], rows])[:, 2:4]
            new = (ids[1:] != ids[:-1]).any(1) if len(self.documents) else np.append(True, (ids[1:] != ids[:-1]).any(1))
            self.documents = np.concatenate([self.documents, rows[new][: self.least - len(self.documents)]])
        if self.begins:
            return [(OPEN, rows)]
        rows = np.concatenate([self.wait, rows])
        if len(self.documents) < self.least:
            self.wait = rows
            return []
        self.wait = rows[:0]
        return [(GOES, rows[(rows[:, 2:4] != self.documents[0, 2:4]).any(1)])]

    def end(self) -> list[tuple[int, np.ndarray]]:
        return [] if self.hash is None else [(OPEN, self.wait), (BORDER, self.documents)]


def _said(sorted_occurrences: DataFrame, least: int) -> DataFrame:
    """-> said, h1, h2, doc_id, text_hash, pos."""

    def batch_of(said: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for kind, rows in said:
            if len(rows):
                ids = pa.array(rows[:, 3], mask=rows[:, 2] == 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), kind, np.int32)), pa.array(rows[:, 0]), pa.array(rows[:, 1]), ids, pa.array(rows[:, 4]), pa.array(rows[:, 5].astype(np.int32))],
                    ["said", "h1", "h2", "doc_id", "text_hash", "pos"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = Stream(least)
        for batch in batches:
            ids = batch.column(2)
            known = np.asarray(ids.is_valid()).astype(np.int64)
            columns = [batch.column(0), batch.column(1), known, ids.fill_null(0), batch.column(3), batch.column(4)]
            yield from batch_of(stream.push(np.stack([np.asarray(c).astype(np.int64) for c in columns], 1)))
        yield from batch_of(stream.end())

    return sorted_occurrences.mapInArrow(run, "said int, h1 long, h2 long, doc_id long, text_hash long, pos int")


def dropped_lines(docs: DataFrame, least_characters: int = LEAST_CHARACTERS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, text_hash, pos; the lines that go. text_hash is xxhash64 of the text."""
    lines = saved(_occurrences(docs, least_characters), "lines")
    order = ["h1", "h2", F.desc_nulls_last("doc_id"), "text_hash", "pos"]
    dealt = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    said = saved(_said(dealt, least_documents), "lines-said")
    # Each task names up to `least_documents` documents of the hashes at its borders: two hashes a task.
    border = said.where(F.col("said") == BORDER).groupBy("h1", "h2").agg(F.count_distinct(F.struct("doc_id")).alias("n"), F.max("doc_id").alias("keeps"))
    common = saved(border.where(F.col("n") >= least_documents).drop("n"), "lines-border")
    opened = said.where(F.col("said") == OPEN).join(broadcast_if_small(common), ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("keeps")))
    line = ["doc_id", "text_hash", "pos"]
    return said.where(F.col("said") == GOES).select(*line).unionByName(opened.select(*line))


def pack(places: np.ndarray) -> bytes:
    """A deflated bitmap with 0 for the lines that go; lines behind its end stay."""
    bits = np.ones(int(places.max()) // 8 * 8 + 8, np.uint8)
    bits[places] = 0
    return zlib.compress(np.packbits(bits).tobytes(), 1)


def unpack(bitmap: bytes, lines: int) -> np.ndarray:
    """Which of so many lines stay."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:lines].astype(bool)
    return np.append(bits, np.ones(lines - len(bits), bool))


def keep_bitmaps(docs: DataFrame, least_characters: int = LEAST_CHARACTERS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, text_hash, n_dropped, bitmap; a row per different document that loses lines."""

    @F.pandas_udf("binary")
    def packed(places: pd.Series) -> pd.Series:
        return places.map(pack)

    dropped = dropped_lines(docs, least_characters, least_documents)
    found = dropped.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("places"))
    return found.select("doc_id", "text_hash", F.size("places").cast("long").alias("n_dropped"), packed("places").alias("bitmap"))


def _with_kept(docs: DataFrame, bitmaps: DataFrame) -> tuple[DataFrame, str, str]:
    """docs with two more columns, n_dropped and the text that stays; also the names these have."""

    @F.pandas_udf("string")
    def kept(texts: pd.Series, maps: pd.Series) -> pd.Series:
        def one(text, bitmap):
            if bitmap is None:
                return None
            lines = text.split("\n")
            return "\n".join([line for line, stays in zip(lines, unpack(bitmap, len(lines)).tolist()) if stays])

        return pd.Series([one(t, m) for t, m in zip(texts, maps)], dtype=object)

    of, hashed, n, bitmap, stays = unused(docs, "of", "hashed", "n_dropped", "bitmap", "stays")
    found = bitmaps.select(F.col("doc_id").alias(of), F.col("text_hash").alias(hashed), F.col("n_dropped").alias(n), F.col("bitmap").alias(bitmap))
    text = F.coalesce(docs["text"], F.lit(""))
    both = docs.join(broadcast_if_small(found), docs["doc_id"].cast("long").eqNullSafe(F.col(of)) & (F.xxhash64(text) == F.col(hashed)), "left")
    # Only texts that lose lines go to Python.
    less = kept(F.when(F.col(bitmap).isNotNull(), docs["text"]), F.col(bitmap))
    return small_batches(both).select(*[docs[c] for c in docs.columns], F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n), F.coalesce(less, docs["text"]).alias(stays)), n, stays


def digests(docs: DataFrame, least_characters: int = LEAST_CHARACTERS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_lines, n_dropped, kept_sha256; a row per document."""
    docs = docs.select("doc_id", "text")
    bitmaps = saved(keep_bitmaps(docs, least_characters, least_documents), "lines-bitmaps")
    out, n, stays = _with_kept(docs, bitmaps)
    text = F.coalesce("text", F.lit(""))
    lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return out.select("doc_id", lines.cast("long").alias("n_lines"), F.col(n).alias("n_dropped"), F.sha2(F.coalesce(F.col(stays), F.lit("")), 256).alias("kept_sha256"))


def dedup(docs: DataFrame, least_characters: int = LEAST_CHARACTERS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """docs with the lines that stay as their text, all other columns as they are."""
    bitmaps = saved(keep_bitmaps(docs.select("doc_id", "text"), least_characters, least_documents), "lines-bitmaps")
    out, _, stays = _with_kept(docs, bitmaps)
    return out.select(*[F.col(stays).alias(c) if c == "text" else F.col(c) for c in docs.columns])
