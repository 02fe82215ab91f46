"""Toxicity scores from a convolutional text classifier trained in numpy.

Each word has the sum of three hashed embeddings: of itself and of its first four and five bytes, so that inflected
forms share weights. Filters of several widths run over the words, max pooling keeps the best window of each filter
in the whole text, and a logistic layer gives a logit. The embeddings start from smoothed log odds of the buckets in
the training texts. Thresholds are calibrated by language, which is told from common words of the text itself; a score
is the logistic of the logit moved so that the language's threshold scores exactly THRESHOLD.

Training takes every labelled text. Texts are dealt by their hash into shards of about SHARD_CHARS characters, and a
shard is packed once into numbers of words. A round runs one epoch over each shard, from common weights, in one task;
what the shards moved is averaged by a sum over Spark, in whole numbers, so that the model is the same for any layout of
files and tasks. A fifth of each shard is kept back; its logits are counted in cells for the thresholds. The driver holds
the weights, whose size is fixed, and never a text.

Defined cases: null and blank texts have no windows and get the score of the bias alone; labels that are null or other
than 0 and 1 are ignored; rows that repeat a doc_id are scored by their own texts; without labelled rows of both kinds
every score is 0. Input columns other than doc_id and text are never read by a score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.llm import words as words_module
from locusweave.llm.common import broadcast_if_small, give_back_memory, runs_on_executors, saved, small_batches, text_digest, unused
from locusweave.llm.words import mix64, pieces

runs_on_executors(__name__)
#: Characters of the labelled texts of a shard, about.
SHARD_CHARS = 32_000_000
THRESHOLD = 0.7
BUCKETS = 1 << 19
WIDTH = 8
FILTERS = 8
SPANS = (1, 2, 3)
PREFIXES = (4, 5)
EPOCHS = 6
SLICE = 1 << 16
ROWS_AT_ONCE = 512
#: Weights are averaged as whole numbers of this part of one, whose sums do not hang on the order of tasks.
UNIT = float(1 << 40)
#: Cells of one in which the logits of texts kept back are counted, up to so many from 0.
CELLS, FARTHEST = 1024, 64
#: Common words by which a text's language is told.
COMMON = {
    "en": "the of and to in is that it was for on with as be by this are from or",
    "de": "der die und den das von zu ist nicht mit sich auf für dem ein eine als auch",
    "fr": "le les et des un une que est pour dans qui sur pas par au avec elle du",
    "es": "el los las y que del se por con para una no como su al lo es más",
}


def _bucket(h: np.ndarray, role: int) -> np.ndarray:
    return (mix64(h + np.uint64(role)) & np.uint64(BUCKETS - 1)).astype(np.int32)


def word_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word (itself and its prefixes) for a batch of texts, and the offsets of the texts."""
    rows, texts = [np.zeros((0, 1 + len(PREFIXES)), np.int32)], [np.zeros(0, np.int64)]
    for p in pieces(column):
        cols = [_bucket(p.hashes(), 0)]
        for k in PREFIXES:
            cols.append(_bucket(p.hashes(p.start, np.minimum(p.start + k, p.end)), k))
        rows.append(np.stack(cols, 1))
        texts.append(p.text)
    return np.concatenate(rows), np.searchsorted(np.concatenate(texts), np.arange(len(column) + 1))


def _language_table() -> tuple[list[str], np.ndarray]:
    """Number of the language (from 1) of each bucket that belongs to a common word, else 0."""
    table = np.zeros(BUCKETS, np.int8)
    names = list(COMMON)
    for k, name in enumerate(names):
        ids, _ = word_ids(pa.array([COMMON[name]]))
        table[ids[:, 0]] = k + 1
    return names, table


def languages(ids: np.ndarray, ends: np.ndarray, table: np.ndarray, n: int) -> np.ndarray:
    """Language of each text: the one with most common words, 0 (the first) on a tie at nothing."""
    found = table[ids[:, 0]] if len(ids) else np.zeros(0, np.int8)
    texts = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    counts = np.bincount(texts * (n + 1) + found, minlength=(len(ends) - 1) * (n + 1)).reshape(len(ends) - 1, n + 1)
    return counts[:, 1:].argmax(1)


@dataclass
class Model:
    embed: np.ndarray
    kernels: list[np.ndarray]  # by span: span x width x filters
    biases: list[np.ndarray]
    dense: np.ndarray
    bias: float
    table: np.ndarray
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(COMMON)))

    def windows(self, ids: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each span the filters' outputs at each word; left: words up to the end of the text, itself included."""
        x = self.embed[ids[:, 0]]
        for k in range(1, ids.shape[1]):
            x = x + self.embed[ids[:, k]]
        self.x = x
        for span, kernel, bias in zip(SPANS, self.kernels, self.biases):
            z = x @ kernel[0]
            for j in range(1, span):
                z[:-j] += x[j:] @ kernel[j]
            z += bias
            z[left < span] = 0
            yield span, z

    def logits(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        pooled = np.zeros((len(ends) - 1, len(SPANS) * FILTERS), np.float32)
        texts = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        left = np.repeat(ends[1:], np.diff(ends)) - np.arange(len(ids))
        reach = max(SPANS) - 1
        for a in range(0, len(ids), SLICE):
            b = min(a + SLICE, len(ids))
            first = np.flatnonzero(np.diff(texts[a:b], prepend=-1))
            for span, z in self.windows(ids[a : b + reach], left[a : b + reach]):
                best = np.maximum.reduceat(z[: b - a], first)
                at = slice(SPANS.index(span) * FILTERS, (SPANS.index(span) + 1) * FILTERS)
                rows = texts[a:b][first]
                pooled[rows, at] = np.maximum(pooled[rows, at], best)
        return pooled @ self.dense + self.bias

    def scores(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        moved = self.logits(ids, ends) - self.thresholds[languages(ids, ends, self.table, len(COMMON))]
        return 1 / (1 + np.exp(-np.clip(moved + np.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))


_BITS = BUCKETS.bit_length() - 1
PACKED = "table binary, words binary, ends binary, toxic binary"


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every distinct labelled text whose crc32(doc_id) mod 3 is not 1, with `toxic`.

    An id with several labels counts as toxic if one of them is 1, and so does a text with several ids.
    """
    key = F.crc32(F.col("doc_id").cast("string"))
    marks = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("_toxic")).where("_toxic in (0, 1)")
    marks = saved(marks.where(key % 3 != 1).groupBy("doc_id").agg(F.max("_toxic").alias("_toxic")), "toxic-marks")
    known = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (key % 3 != 1)).join(broadcast_if_small(marks), "doc_id")
    return known.groupBy("text").agg(F.max("_toxic").alias("toxic"))


def pack(table: pa.Table) -> pa.Table:
    """The texts of a shard as one row: its distinct words, the number of each word in the order of texts, and the labels.

    The order of texts follows from the texts alone.
    """
    rows = sorted((zlib.crc32(t.encode()), t, m) for t, m in zip(table.column("text").to_pylist(), table.column("toxic").to_pylist()))
    rows = [rows[i] for i in np.random.default_rng(1).permutation(len(rows))]
    ids, ends = word_ids(pa.array([r[1] for r in rows], pa.string()))
    words_module._powers.clear()
    keys = np.zeros(len(ids), np.int64)
    for k in range(ids.shape[1]):
        keys = keys << _BITS | ids[:, k]
    keys, words, counts = np.unique(keys, return_inverse=True, return_counts=True)
    # Common words get small numbers, which pack well.
    order = np.argsort(-counts, kind="stable")
    place = np.zeros(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    toxic = np.array([r[2] for r in rows], np.int8)
    out = [keys[order].tobytes(), zlib.compress(place[words].tobytes(), 1), ends.astype(np.int64).tobytes(), toxic.tobytes()]
    return pa.table([pa.array([v], pa.binary()) for v in out], names=["table", "words", "ends", "toxic"])


class Shard:
    """A row of PACKED, unpacked. Every fifth text is kept back, or none."""

    def __init__(self, row: dict, keep: bool = True):
        keys = np.frombuffer(row["table"], np.int64)
        self.table = np.stack([keys >> _BITS * k & (BUCKETS - 1) for k in range(len(PREFIXES), -1, -1)], 1).astype(np.int32)
        self.words = np.frombuffer(zlib.decompress(row["words"]), np.int32)
        self.ends = np.frombuffer(row["ends"], np.int64)
        self.y = np.frombuffer(row["toxic"], np.int8).astype(np.int64)
        back = (np.arange(len(self.y)) % 5 == 4) & keep
        self.fit, self.back = np.flatnonzero(~back), np.flatnonzero(back)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the words of some texts, and the offsets of the texts."""
        words = np.concatenate([self.words[self.ends[i] : self.ends[i + 1]] for i in rows] or [self.words[:0]])
        return self.table[words], np.concatenate([[0], np.cumsum(self.ends[rows + 1] - self.ends[rows])]).astype(int)


def _unpacked(batches: Iterator[pa.RecordBatch], keep: bool) -> Iterator[Shard]:
    for batch in batches:
        for k in range(len(batch)):
            yield Shard(batch.slice(k, 1).to_pylist()[0], keep)


def _counts(packed: DataFrame, keep: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the clean and of the toxic texts: how many hold each bucket, how many train, how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS + 2), np.int64)
        for shard in _unpacked(batches, keep):
            for k in shard.fit:
                seen[shard.y[k], np.unique(shard.table[np.unique(shard.words[shard.ends[k] : shard.ends[k + 1]])])] += 1
            seen[:, BUCKETS] += np.bincount(shard.y[shard.fit], minlength=2)
            seen[:, BUCKETS + 1] += np.bincount(shard.y, minlength=2)
        at = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[0, at]), pa.array(seen[1, at])], ["key", "clean", "toxic"])
        give_back_memory()

    sums = small_batches(packed).mapInArrow(run, "key int, clean long, toxic long").groupBy("key").agg(F.sum("clean"), F.sum("toxic")).toArrow()
    out = np.zeros((2, BUCKETS + 2), np.float64)
    for k in range(2):
        out[k, sums.column(0).to_numpy()] = sums.column(1 + k).to_numpy()
    return out[:, :BUCKETS], out[:, BUCKETS], out[:, BUCKETS + 1]


def _fresh(seen: np.ndarray, fit: np.ndarray, seed: int) -> Model:
    """A model before its first round; the first weight of a bucket is the smoothed log odds of the texts that hold it."""
    rng = np.random.default_rng(seed)
    share = fit / fit.sum()
    rate = (seen + 2 * share[:, None]) / (fit[:, None] + 2 * share[:, None])
    embed = rng.normal(0, 0.02, (BUCKETS, WIDTH)).astype(np.float32)
    embed[:, 0] = np.where(seen.sum(0) > 0, np.log(rate[1] / rate[0]), 0).astype(np.float32) / 4
    kernels = [rng.normal(0, 0.1, (s, WIDTH, FILTERS)).astype(np.float32) for s in SPANS]
    for k in kernels:
        k[:, 0, :] = np.abs(k[:, 0, :]) + 0.5 / len(k)
    return Model(embed, kernels, [np.full(FILTERS, -0.5, np.float32) for _ in SPANS], np.full(len(SPANS) * FILTERS, 0.15, np.float32), -2.0, _language_table()[1])


def _flat(model: Model, moments: list) -> np.ndarray:
    """All weights but the embeddings, and their moments, in one row."""
    params = [*model.kernels, *model.biases, model.dense]
    return np.concatenate([x.ravel() for x in [*params, *(m for pair in moments for m in pair)]] + [np.array([model.bias])])


def _set_flat(model: Model, moments: list, row: np.ndarray) -> None:
    at = 0
    for x in [*model.kernels, *model.biases, model.dense, *(m for pair in moments for m in pair)]:
        x[...] = row[at : at + x.size].reshape(x.shape)
        at += x.size
    model.bias = float(row[at])


def _epoch(model: Model, squares: np.ndarray, moments: list, step: int, shard: Shard, share: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One pass over the texts of a shard that train; changes what it is given and returns which buckets it moved."""
    params = [*model.kernels, *model.biases, model.dense]
    y, fit, touched = shard.y, shard.fit, np.zeros(BUCKETS, bool)
    weight = np.where(y == 1, 0.5 / max(1, share[1] * 2), 0.5 / max(1e-9, share[0]))
    for rows in np.array_split(rng.permutation(fit), max(1, len(fit) // 32)):
        bid, bend = shard.take(rows)
        if not len(bid):
            continue
        left = np.repeat(bend[1:], np.diff(bend)) - np.arange(len(bid))
        found, pooled = [], np.zeros((len(rows), len(SPANS) * FILTERS), np.float32)
        for s, (span, z) in enumerate(model.windows(bid, left)):
            at = np.zeros((len(rows), FILTERS), np.int64)
            for r in range(len(rows)):
                if bend[r + 1] > bend[r]:
                    at[r] = bend[r] + z[bend[r] : bend[r + 1]].argmax(0)
                    pooled[r, s * FILTERS : (s + 1) * FILTERS] = np.maximum(0, z[at[r], np.arange(FILTERS)])
            found.append(at)
        logit = pooled @ model.dense + model.bias
        d = ((1 / (1 + np.exp(-logit)) - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
        grads = [np.zeros_like(p) for p in params]
        grads[-1] += pooled.T @ d
        moved_ids, moved = [], []
        for s, span in enumerate(SPANS):
            g = np.where(pooled[:, s * FILTERS : (s + 1) * FILTERS] > 0, d[:, None] * model.dense[s * FILTERS : (s + 1) * FILTERS], 0)
            grads[len(SPANS) + s] += g.sum(0)
            r, f = np.nonzero(g)
            for j in range(span):
                t = found[s][r, f] + j
                np.add.at(grads[s][j].T, f, model.x[t] * g[r, f][:, None])
                moved_ids.append(t)
                moved.append(model.kernels[s][j].T[f] * g[r, f][:, None])
        step += 1
        for p, g, (m, v) in zip(params, grads, moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-6)
        model.bias -= 0.3 * float(d.sum())
        if moved_ids:
            t, g = np.concatenate(moved_ids), np.concatenate(moved)
            rows_of = bid[t].ravel()
            g = np.repeat(g, bid.shape[1], 0)
            keys, back_to = np.unique(rows_of, return_inverse=True)
            total = np.zeros((len(keys), WIDTH), np.float32)
            np.add.at(total, back_to, g)
            touched[keys] = True
            squares[keys] += (total * total).mean(1)
            model.embed[keys] -= 0.02 * total / (np.sqrt(squares[keys])[:, None] + 1e-4)
    model.x = None
    return touched


def _round(packed: DataFrame, model: Model, squares: np.ndarray, moments: list, step: int, share: np.ndarray, keep: bool, seed: int) -> None:
    """One epoch over each shard from the same weights, and the mean of what they moved; a bucket's over shards that moved it."""
    sent = packed.sparkSession.sparkContext.broadcast(({k: v for k, v in vars(model).items() if k != "x"}, squares, _flat(model, moments), step, share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, begun_squares, row, step, share = sent.value
        sums, small, n, shards = np.zeros((BUCKETS, WIDTH + 1), np.int64), np.zeros(len(row), np.int64), np.zeros(BUCKETS, np.int64), 0
        for shard in _unpacked(batches, keep):
            own = Model(**{**begun, "embed": begun["embed"].copy(), "kernels": [k.copy() for k in begun["kernels"]], "biases": [b.copy() for b in begun["biases"]], "dense": begun["dense"].copy()})
            own_squares, moments = begun_squares.copy(), [(np.zeros_like(p), np.zeros_like(p)) for p in [*own.kernels, *own.biases, own.dense]]
            _set_flat(own, moments, row)
            at = np.flatnonzero(_epoch(own, own_squares, moments, step, shard, share, np.random.default_rng([seed, step, len(shard.words)])))
            n[at] += 1
            sums[at, :WIDTH] += np.rint((own.embed[at].astype(np.float64) - begun["embed"][at]) * UNIT).astype(np.int64)
            sums[at, WIDTH] += np.rint((own_squares[at].astype(np.float64) - begun_squares[at]) * UNIT).astype(np.int64)
            small += np.rint((_flat(own, moments).astype(np.float64) - row) * UNIT).astype(np.int64)
            shards += 1
        at = np.flatnonzero(n)
        keys, counts = np.concatenate([at, BUCKETS + np.arange(len(row))]).astype(np.int32), np.concatenate([n[at], np.full(len(row), shards)])
        columns = [np.concatenate([sums[at, k], small if k == 0 else np.zeros(len(row), np.int64)]) for k in range(WIDTH + 1)]
        for a in range(0, len(keys) if shards else 0, SLICE):
            yield pa.RecordBatch.from_arrays([pa.array(c[a : a + SLICE]) for c in [keys, counts, *columns]], names)
        give_back_memory()

    names = ["key", "n", *(f"v{k}" for k in range(WIDTH + 1))]
    moved = small_batches(packed).mapInArrow(run, ", ".join(f"{c} {'int' if c == 'key' else 'long'}" for c in names))
    mean = [(F.sum(c) / F.sum("n") / UNIT).cast("float").alias(c) for c in names[2:]]
    found = moved.groupBy("key").agg(*mean).toArrow()
    sent.destroy()
    keys, values = found.column(0).to_numpy(), np.stack([found.column(1 + k).to_numpy() for k in range(WIDTH + 1)], 1)
    words = keys < BUCKETS
    model.embed[keys[words]] += values[words, :WIDTH]
    squares[keys[words]] += values[words, WIDTH]
    row = _flat(model, moments)
    row[keys[~words] - BUCKETS] += values[~words, 0]
    _set_flat(model, moments, row)


def train(rows: DataFrame, epochs: int = EPOCHS, seed: int = 7, shard_chars: int = SHARD_CHARS) -> Model | None:
    """Fit the classifier to all of rows(text, toxic), which are distinct; None without both kinds."""
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-chars // shard_chars))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)))
    packed = saved(small_batches(dealt).groupBy("shard").applyInArrow(pack, PACKED), "toxic-shards")
    keep = True
    seen, fit, whole = _counts(packed, keep)
    if not whole.all():
        return None
    if not fit.all():  # too few to keep some back
        keep = False
        seen, fit, whole = _counts(packed, keep)
    model, squares = _fresh(seen, fit, seed), np.zeros(BUCKETS, np.float32)
    del seen
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in [*model.kernels, *model.biases, model.dense]]
    # Steps are those of a shard of the mean size.
    steps = max(1, int(fit.sum()) // shards // 32)
    for k in range(epochs):
        _round(packed, model, squares, moments, k * steps, fit / fit.sum(), keep, seed)
    model.x = None
    _calibrate(packed, model, keep)
    return model


def _calibrate(packed: DataFrame, model: Model, keep: bool) -> None:
    """For each language the threshold in the middle of the widest gap among those of least weighted error.

    Logits of all texts kept back are counted in cells, which keep their least and greatest one; thresholds lie between cells.
    """
    sent = packed.sparkSession.sparkContext.broadcast({k: v for k, v in vars(model).items() if k != "x"})
    names = ["lang", "cell", "lo", "hi", "toxic", "clean"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**sent.value)
        for shard in _unpacked(batches, keep):
            for rows in np.array_split(shard.back, max(1, len(shard.back) // ROWS_AT_ONCE)):
                ids, ends = shard.take(rows)
                z, lang, y = known.logits(ids, ends).astype(np.float64), languages(ids, ends, known.table, len(COMMON)), shard.y[rows]
                cell = np.floor(np.clip(z, -FARTHEST, FARTHEST) * CELLS).astype(np.int32)
                for k in (lang, np.full(len(rows), -1)):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (k.astype(np.int32), cell, z, z, y, 1 - y)], names)
        give_back_memory()

    rows = small_batches(packed).mapInArrow(run, "lang int, cell int, lo double, hi double, toxic long, clean long").groupBy("lang", "cell")
    cells = rows.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow()
    sent.destroy()
    lang, _, lo, hi, toxic, clean = (cells.column(c).to_numpy() for c in names)

    def best(of: int, fallback: float) -> float:
        at = np.flatnonzero(lang == of)
        at = at[np.argsort(lo[at])]
        if toxic[at].sum() < 5 or clean[at].sum() < 5:
            return fallback
        cuts = np.concatenate([[lo[at[0]] - 1], (lo[at[1:]] + hi[at[:-1]]) / 2])
        misses = np.concatenate([[0], np.cumsum(toxic[at])[:-1]])
        alarms = clean[at].sum() - np.concatenate([[0], np.cumsum(clean[at])[:-1]])
        gaps = np.concatenate([[0], lo[at[1:]] - hi[at[:-1]]])
        return cuts[np.lexsort((-gaps, misses + alarms))[0]]

    overall = best(-1, 0.0)
    model.thresholds = np.array([best(k, overall) for k in range(len(COMMON))])


def _scored(docs: DataFrame, labels: DataFrame, *more: Column) -> tuple[DataFrame, Broadcast]:
    """docs(doc_id, text) -> doc_id, more, score; a row per document. Also the broadcast that it reads."""
    model = train(training_rows(docs, labels))
    give_back_memory()
    # Plain arrays, so that a broadcast needs no class of this package.
    shared = docs.sparkSession.sparkContext.broadcast(model and {k: v for k, v in vars(model).items() if k != "x"})
    given = docs.select("doc_id", "text", *more)
    carried = [f for f in given.schema.fields if f.name != "text"]
    names = [*(f.name for f in carried), "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value and Model(**shared.value)
        for whole in batches:
            for a in range(0, len(whole), ROWS_AT_ONCE):
                batch = whole.slice(a, ROWS_AT_ONCE)
                if known is None:
                    found = np.zeros(len(batch))
                else:
                    found = known.scores(*word_ids(batch.column(1))).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(found)], names)
        give_back_memory()

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in carried)
    return small_batches(given).mapInArrow(run, f"{kinds}, score double"), shared


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, held_out, score, predicted; a row per document."""
    scored, shared = _scored(docs, labels)
    scored = saved(scored, "toxic-scores")
    shared.destroy()
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs whose own text is not predicted toxic, with all their columns."""
    (sha,) = unused(docs, "sha")
    scored, shared = _scored(docs, labels, text_digest(F.col("text")).alias("text_sha256"))
    # A score is a function of the text, so the digest tells which rows go, whatever their ids.
    bad = saved(scored.where(F.col("score") >= THRESHOLD).select(F.col("text_sha256").alias(sha)).distinct(), "toxic")
    shared.destroy()
    return docs.join(broadcast_if_small(bad), text_digest(docs["text"]) == F.col(sha), "left_anti")
