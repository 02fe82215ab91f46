"""Language-model scores: a log-bilinear model trained in numpy with noise-contrastive estimation.

Symbols are the most frequent words of the training texts and, for all other words, classes by their last two bytes.
Two preceding symbols predict the next: each place has its own vectors, their sum is multiplied with the output vectors,
and a bias is added. Training contrasts each symbol with noise drawn from symbol frequencies, so it needs no normaliser;
the normalisers of all contexts are then made once by batched matrix products, and every score is a normalised
log-probability. A word of a class has the class's probability times its smoothed share of the class.

All training texts, whole, teach the model. Texts are dealt into shards of about SHARD_TOKENS tokens by a hash of their
id and text, and each shard is boiled down to the triples of symbols in it with their counts; so what a shard teaches
depends on texts and ids alone, not on how files are split or which task reads what. In each round every shard starts
from the same parameters, goes once through its triples, weighted by their counts, and returns its parameters; these are
averaged by tokens, in SLOTS tasks and then on the driver, which sees SLOTS rows whatever the corpus. Rounds go on until
the contrastive likelihood of the training texts rises by less than LEAST_GAIN of itself, MOST_ROUNDS at most.

Counts cover all training texts: word hashes are counted per batch, summed by a shuffle and kept as a table. The
words with the highest counts (at most DICTIONARY) go to all tasks; the hashes of other words are joined to the
table, once for each text and word. Words are known by 64-bit hashes.

Defined cases: null and blank texts are one end token; a null doc_id is held out; rows that repeat are scored each;
with no training text every word is unknown and scores follow from the smoothing alone. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusweave.llm import words as words_module
from locusweave.llm.common import give_back_memory, runs_on_executors, saved, small_batches
from locusweave.llm.words import mix64, pieces

runs_on_executors(__name__)
FREQUENT, CLASSES = 768, 256
DICTIONARY = 1 << 17
WIDTH = 32
NOISE, BATCH, RATE = 128, 1024, 0.15
SHARD_TOKENS, SLOTS = 4_000_000, 32
MOST_ROUNDS, LEAST_GAIN = 4, 0.01
#: A triple that is more frequent than this is learnt in several steps of a round, each with a part of its count.
HEAVY = 8
#: How triples and their counts are packed; there are (symbols + 1)^2 * symbols triples.
TRIPLE = np.int32
#: The likelihood is taken of each so many-th batch, and no term of it is less than this below 0.
GAUGED, LEAST_LOG = 8, 30.0
SMOOTHING = 0.1
ROWS_AT_ONCE = 256
END = np.uint64(0x51ED270B0A1F39C5)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and classes of the words of a batch with an end token after each text, and offsets by text."""
    hashes, classes, texts = [], [], []
    for p in pieces(column):
        last = p.low[p.end - 1].astype(np.uint64)
        before = np.where(p.end - p.start > 1, p.low[np.maximum(p.end - 2, 0)], 0).astype(np.uint64)
        hashes.append(p.hashes())
        classes.append((mix64(last * np.uint64(256) + before) & np.uint64(CLASSES - 1)).astype(np.int64))
        texts.append(p.text)
    n = len(column)
    hashes.append(np.full(n, END))
    classes.append(np.zeros(n, np.int64))
    texts.append(np.arange(n))
    texts = np.concatenate(texts)
    order = np.argsort(texts, kind="stable")
    return np.concatenate(hashes)[order], np.concatenate(classes)[order], np.searchsorted(texts[order], np.arange(n + 1))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, classes, _ = tokens(batch.column(0))
        found, first, counts = np.unique(hashes, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(classes[first]), pa.array(counts)], ["word", "class", "n"])


@dataclass
class Network:
    before: list[np.ndarray]  # (symbols + 1) x width, for the last and the last but one symbol; the last row stands for places before the text
    outputs: np.ndarray  # symbols x width
    bias: np.ndarray

    def normalisers(self, rows: int = 4096) -> np.ndarray:
        """Log of the sum over all symbols, for each pair of context symbols."""
        n = len(self.before[0])
        out = np.zeros(n * n, np.float32)
        for a in range(0, n * n, rows):
            pair = np.arange(a, min(a + rows, n * n))
            scores = (self.before[0][pair // n] + self.before[1][pair % n]) @ self.outputs.T + self.bias
            top = scores.max(1)
            out[pair] = top + np.log(np.exp(scores - top[:, None]).sum(1))
        return out


def contexts(symbols: np.ndarray, ends: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray]:
    """The last and the last but one symbol before each place; `blank` before the text."""
    place = np.arange(len(symbols)) - np.repeat(ends[:-1], np.diff(ends))
    one, two = np.roll(symbols, 1), np.roll(symbols, 2)
    one[place < 1] = blank
    two[place < 2] = blank
    return one, two


def triples(symbols: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Each place's two preceding symbols and its own as one number; n symbols, and n itself before a text."""
    one, two = contexts(symbols, ends, n)
    return (one * (n + 1) + two) * n + symbols


def untriple(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pairs, own = np.divmod(keys, n)
    one, two = np.divmod(pairs, n + 1)
    return one, two, own


def counted(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their counts together."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    sums = np.diff(np.append(at, len(keys))) if times is None else np.add.reduceat(times[order].astype(np.int64), at) if len(keys) else times
    return keys[at], sums.astype(np.int64)


def _summed(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of value rows by row number, n x width."""
    cells = (rows[:, None] * WIDTH + np.arange(WIDTH)).ravel()
    return np.bincount(cells, values.ravel(), n * WIDTH).reshape(n, WIDTH).astype(np.float32)


class Trainer:
    """Parameters, with the sums of their squared gradients, and the noise distribution over n symbols."""

    def __init__(self, noise: np.ndarray, state: np.ndarray | None = None, seed: int = 3):
        n = len(noise)
        self.n, self.log_noise, self.sums = n, np.log(noise).astype(np.float32), np.cumsum(noise)
        shapes = [(n + 1, WIDTH), (n + 1, WIDTH), (n, WIDTH), (n,)]
        if state is None:
            rng = np.random.default_rng(seed)
            parts = [rng.normal(0, 0.1, shapes[0]), rng.normal(0, 0.05, shapes[1]), rng.normal(0, 0.1, shapes[2]), self.log_noise, *[np.full(s, 1e-6) for s in shapes]]
            state = np.concatenate([x.ravel() for x in parts]).astype(np.float32)
        self.state, at = state.copy(), 0
        parts = []
        for shape in shapes * 2:
            parts.append(self.state[at : at + int(np.prod(shape))].reshape(shape))  # views
            at += int(np.prod(shape))
        self.params, self.squares = parts[: len(shapes)], parts[len(shapes) :]
        self.room = [np.empty_like(p) for p in self.params]

    def network(self) -> Network:
        one, two, outputs, bias = self.params
        return Network([one, two], outputs, bias)

    def learn(self, keys: np.ndarray, times: np.ndarray, rate: float, rng: np.random.Generator) -> float:
        """Go once through triples by noise-contrastive estimation; those of a batch share their noise. Their mean log-likelihood, as of every GAUGED-th batch."""
        with np.errstate(over="ignore"):  # an infinite exponential is a share of 0
            return self._learn(keys, times, rate, rng)

    def _learn(self, keys: np.ndarray, times: np.ndarray, rate: float, rng: np.random.Generator) -> float:
        n, (first, second, outputs, bias) = self.n, self.params
        shift = np.float32(np.log(NOISE)) + self.log_noise
        steps = -(-times // HEAVY)
        of = np.repeat(np.arange(len(keys)), steps)
        told, weighed, weights = 0.0, 0.0, (times / steps).astype(np.float32)
        for at, rows in enumerate(np.array_split(of[rng.permutation(len(of))], max(1, round(len(of) / BATCH)))):
            (a, b, w), drawn = untriple(keys[rows], n), np.searchsorted(self.sums, rng.random(NOISE)).clip(0, n - 1)
            mine = weights[rows]
            share = mine / mine.sum()
            q, right, wrong, off = first[a], outputs[w], outputs[drawn], bias - shift
            q += second[b]
            d_true = np.einsum("ij,ij->i", q, right)
            d_true += off[w]
            np.exp(d_true, out=d_true)
            d_true += 1
            gauge = at % GAUGED == 0
            if gauge:
                likely = np.maximum(np.log1p(-1 / d_true), -LEAST_LOG)
            np.divide(-share, d_true, out=d_true)
            # Negated here, so that no pass over the batch's noise is spent on it.
            d_fake = q @ -wrong.T
            d_fake -= off[drawn]
            np.exp(d_fake, out=d_fake)
            d_fake += 1
            if gauge:
                likely += np.maximum(np.log1p(-1 / d_fake), -LEAST_LOG).sum(1)
                told, weighed = told + float(likely @ mine), weighed + float(mine.sum())
            np.divide(share[:, None], d_fake, out=d_fake)
            dq = d_fake @ wrong
            g_bias = np.bincount(w, d_true, n).astype(np.float32)
            np.add.at(g_bias, drawn, d_fake.sum(0))
            g_drawn = d_fake.T @ q
            q *= d_true[:, None]
            right *= d_true[:, None]
            dq += right
            g_out = _summed(w, q, n)
            np.add.at(g_out, drawn, g_drawn)
            grads = [_summed(a, dq, n + 1), _summed(b, dq, n + 1), g_out, g_bias]
            for p, g, s, t in zip(self.params, grads, self.squares, self.room):
                np.multiply(g, g, out=t)
                s += t
                np.sqrt(s, out=t)
                g *= np.float32(rate)
                g /= t
                p -= g
        return told / weighed if weighed else 0.0


@dataclass
class Scorer:
    words: np.ndarray  # sorted hashes of the dictionary
    counts: np.ndarray
    symbol: np.ndarray  # of each word of the dictionary, -1 if it belongs to a class
    class_log: np.ndarray  # log10 of the smoothed size of each class
    total_log: float  # log10 of the smoothed number of training tokens
    network: Network | None = None
    norm: np.ndarray | None = None

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.words, hashes).clip(0, len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)

    def symbols(self, at: np.ndarray, classes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return FREQUENT + classes
        own = np.where(at >= 0, self.symbol[at], -1)
        return np.where(own >= 0, own, FREQUENT + classes)

    def score(self, column: pa.Array):
        """By text: tokens, known ones, base and model sums without the words outside the dictionary, and those words."""
        hashes, classes, ends = tokens(column)
        at = self.lookup(hashes)
        symbols = self.symbols(at, classes)
        one, two = contexts(symbols, ends, FREQUENT + CLASSES)
        net = self.network
        logp = np.einsum("ij,ij->i", net.before[0][one] + net.before[1][two], net.outputs[symbols]) + net.bias[symbols]
        logp = (logp - self.norm[one * len(net.before[0]) + two]).astype(np.float64) / np.log(10)
        listed = at >= 0
        share = np.zeros(len(hashes))
        share[listed] = np.log10(self.counts[at[listed]] + SMOOTHING)
        inside = symbols >= FREQUENT
        model = logp + np.where(inside, share - self.class_log[classes], 0)
        sums = lambda x: np.add.reduceat(x, ends[:-1]) if len(x) else np.zeros(0)  # noqa: E731  no text is without tokens
        texts = np.repeat(np.arange(len(column)), np.diff(ends))
        rare = np.flatnonzero(~listed)
        order = np.lexsort((hashes[rare], texts[rare]))
        r_text, r_hash = texts[rare][order], hashes[rare][order]
        new = np.ones(len(rare), bool)
        new[1:] = (r_text[1:] != r_text[:-1]) | (r_hash[1:] != r_hash[:-1])
        starts = np.flatnonzero(new)
        times = np.diff(np.append(starts, len(rare)))
        rare_ends = np.searchsorted(r_text[starts], np.arange(len(column) + 1))
        return np.diff(ends), sums(listed.astype(np.int64)), sums(share) - np.diff(ends) * self.total_log, sums(model), r_hash[starts], times, rare_ends


def _scorer(counts: DataFrame) -> tuple[Scorer, np.ndarray, int, int]:
    """The dictionary and the class sizes; also the noise, the number of training tokens and the least count of the dictionary."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8)
    steps = sorted(((r[0], r[1]) for r in counts.groupBy(step.alias("step")).count().collect()), reverse=True)
    room, least = DICTIONARY, None
    for s, n in steps:
        if n > room:
            break
        room, least = room - n, s
    listed = counts.where(step >= least).collect() if least is not None else []
    sizes = np.zeros((2, CLASSES))
    for r in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        sizes[:, r["class"]] = r["n"], r["v"]
    total, kinds = sizes.sum(1)
    words = np.array([r["word"] for r in listed], np.int64).view(np.uint64)
    order = np.argsort(words)
    words, n, of = words[order], np.array([r["n"] for r in listed], np.float64)[order], np.array([r["class"] for r in listed], np.int64)[order]
    symbol = np.full(len(words), -1)
    best = np.lexsort((words, -n, words != END))[:FREQUENT]
    symbol[best] = np.arange(len(best))
    np.subtract.at(sizes[0], of[best], n[best])
    np.subtract.at(sizes[1], of[best], 1)
    class_log = np.log10(sizes[0] + SMOOTHING * (sizes[1] + 1))
    noise = np.concatenate([np.bincount(np.arange(len(best)), n[best], FREQUENT), sizes[0]]) + 0.5
    return Scorer(words, n, symbol, class_log, float(np.log10(total + SMOOTHING * (kinds + 1)))), noise / noise.sum(), int(total), least


def _shards(docs: DataFrame, scorer: Scorer, shards: int) -> DataFrame:
    """docs(doc_id, text) -> shard, keys, times: the triples of each shard's texts, sorted, and their counts, as bytes; saved."""
    frequent = np.flatnonzero(scorer.symbol >= 0)
    shared = docs.sparkSession.sparkContext.broadcast(vars(scorer) | {"words": scorer.words[frequent], "symbol": scorer.symbol[frequent], "counts": scorer.counts[frequent]})
    packed = lambda shard, keys, times: pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int64()), pa.array([keys.astype(TRIPLE).tobytes()], pa.binary()), pa.array([times.astype(TRIPLE).tobytes()], pa.binary())], ["shard", "keys", "times"]
    )

    def boil(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Scorer(**shared.value)
        for batch in batches:
            found, of = [], np.asarray(batch.column(0))
            for a in range(0, len(batch), ROWS_AT_ONCE):
                hashes, classes, ends = tokens(batch.column(1).slice(a, ROWS_AT_ONCE))
                keys = triples(known.symbols(known.lookup(hashes), classes), ends, FREQUENT + CLASSES)
                found.append((np.repeat(of[a : a + ROWS_AT_ONCE], np.diff(ends)), keys))
            whose, keys = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
            order = np.argsort(whose, kind="stable")
            whose, keys = whose[order], keys[order]
            at = np.flatnonzero(np.append(True, whose[1:] != whose[:-1])) if len(whose) else np.zeros(0, np.int64)
            for i, j in zip(at.tolist(), np.append(at[1:], len(whose)).tolist()):
                yield packed(int(whose[i]), *counted(keys[i:j]))
        give_back_memory()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for batch in batches:
            for shard, keys, times in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                parts.setdefault(shard, []).append(tuple(np.frombuffer(x.as_buffer(), TRIPLE).copy() for x in (keys, times)))
        for shard in sorted(parts):
            yield packed(shard, *counted(*(np.concatenate(c) for c in zip(*parts.pop(shard)))))
        del parts
        give_back_memory()

    kinds = "shard long, keys binary, times binary"
    out = saved(docs.mapInArrow(boil, kinds).repartition(shards, "shard").mapInArrow(merge, kinds), "lm-triples")
    shared.destroy()
    return out


def _fit(docs: DataFrame, scorer: Scorer, noise: np.ndarray, total: int) -> Network:
    """The network, taught by all texts of docs(doc_id, text), which have `total` tokens, in rounds of averaged parameters."""
    context, shards = docs.sparkSession.sparkContext, max(1, -(-total // SHARD_TOKENS))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("long").alias("shard")
    # Read again in each round as it is written, a row a shard: whichever task reads a shard, it teaches the same.
    taught = _shards(docs.select(shard, "text"), scorer, shards)
    state, likely = Trainer(noise).state, None
    for turn in range(MOST_ROUNDS if total else 0):
        shared = context.broadcast((noise, state))

        def learn(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            noise, state = shared.value
            for batch in batches:
                for part, keys, times in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                    own, times = Trainer(noise, state), np.frombuffer(times.as_buffer(), TRIPLE)
                    told = own.learn(np.frombuffer(keys.as_buffer(), TRIPLE), times, RATE / (1 + turn), np.random.default_rng((turn, part)))
                    seen = int(times.sum())
                    yield pa.RecordBatch.from_arrays([pa.array([part % SLOTS]), pa.array([part]), pa.array([seen]), pa.array([told]), pa.array([own.state.tobytes()])], ["slot", "shard", "seen", "told", "state"])
            give_back_memory()

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, seen, told, whole = None, 0, 0.0, None

            def done() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([0]), pa.array([seen]), pa.array([told / seen]), pa.array([(whole / seen).astype(np.float32).tobytes()])], ["slot", "shard", "seen", "told", "state"])

            for batch in batches:
                for slot, n, t, state in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)), batch.column(4)):
                    if at is not None and slot != at:
                        yield done()
                        seen, told, whole = 0, 0.0, None
                    more = np.frombuffer(state.as_buffer(), np.float32) * np.float64(n)
                    at, seen, told, whole = slot, seen + n, told + t * n, more if whole is None else whole + more
            if at is not None:
                yield done()

        kinds = "slot long, shard long, seen long, told double, state binary"
        # A slot's shards are added in order, so that sums do not depend on which task ends first.
        learnt = taught.mapInArrow(learn, kinds).repartition(SLOTS, "slot").sortWithinPartitions("slot", "shard").mapInArrow(add_up, kinds).collect()
        shared.destroy()
        learnt = sorted(learnt, key=lambda r: r["slot"])
        state = sum(np.frombuffer(r["state"], np.float32) * np.float64(r["seen"] / total) for r in learnt).astype(np.float32)
        was, likely = likely, sum(r["told"] * (r["seen"] / total) for r in learnt)
        if was is not None and likely - was < LEAST_GAIN * abs(was):
            break
    return Trainer(noise, state).network()


def score(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; a row per document."""
    spark = docs.sparkSession
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0
    docs = small_batches(docs).select("doc_id", "text", held_out.alias("held_out"))
    texts = docs.where(~F.col("held_out")).select("doc_id", "text")
    seen = texts.select("text").mapInArrow(_count, "word long, class long, n long")
    counts = saved(seen.groupBy("word").agg(F.min("class").alias("class"), F.sum("n").alias("n")), "lm-counts")
    scorer, noise, total, least = _scorer(counts)
    scorer.network = _fit(texts, scorer, noise, total)
    scorer.norm = scorer.network.normalisers()
    words_module._powers.clear()
    give_back_memory()
    # Plain arrays, so that a broadcast needs no class of this package.
    net = scorer.network
    shared = spark.sparkContext.broadcast((vars(scorer) | {"network": None}, [net.before, net.outputs, net.bias]))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, net = shared.value
        known = Scorer(**parts | {"network": Network(*net)})
        for whole in batches:
            for a in range(0, len(whole), ROWS_AT_ONCE):
                batch = whole.slice(a, ROWS_AT_ONCE)
                n, listed, base, model, rare, times, rare_ends = known.score(batch.column(1))
                ends = pa.array(rare_ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(n.astype(np.int64)), pa.array(listed), pa.array(base), pa.array(model),
                     pa.ListArray.from_arrays(ends, pa.array(rare.view(np.int64))), pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int64)))],
                    ["doc_id", "held_out", "n_tokens", "listed", "base", "model", "rare", "times"],
                )

    kinds = f"doc_id {id_type}, held_out boolean, n_tokens long, listed long, base double, model double, rare array<long>, times array<long>"
    scored = docs.mapInArrow(run, kinds).withColumn("row", F.monotonically_increasing_id())
    scored = saved(scored, "lm-scored")
    shared.destroy()
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    step = F.floor(F.log2(F.col("n").cast("double")) * 8)
    tail = counts.where(step < least) if least is not None else counts
    found = rare.join(tail.select("word", "n"), "word", "left")
    added = found.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTHING)).alias("share"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more")
    )
    out = scored.join(added, "row", "left")
    share = F.coalesce("share", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("listed") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + share).alias("base_score"), (F.col("model") + share).alias("score"),
    )
