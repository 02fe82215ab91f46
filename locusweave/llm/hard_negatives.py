"""Hard negatives by threshold joins with partial inverted indexes.

Anchors and rows are dealt into blocks of bounded size, and each pair of blocks is one task's join. In it, dimensions
are ordered by their weight, and for a threshold t the index of a row holds its first dimensions only: the others are
omitted as soon as the norm of what is left of the row times the largest such norm of an anchor is below t, so a row
whose index is empty cannot reach t. Rows are sorted by the length of their index, so the list of a dimension is a
prefix of its column. Partial scores are accumulated list by list; an anchor and a row part when the partial score plus
the product of their remaining norms is below the anchor's threshold. Pairs that are left get their omitted dimensions.

Thresholds start high and are lowered, for the anchors whose windows are not full yet, until they are full or the
windows' lower ends are reached. A window of one anchor is the best k rows with scores between two bounds; windows that
are full in a block stay so in all blocks together, so the best k of all blocks' windows are the window of all rows. The
first join finds positives (rows of the anchor's label, no bounds), the second one negatives (rows of other labels; one
window for each positive, bounded by shares of its score).

Defined cases: rows with a null id, label or vector or with a component that is null or not finite take no part;
components become floor(256 * x); missing dimensions of a shorter vector count as 0; an anchor is never its own partner,
nor are rows that repeat its id; repeated rows each count, also as anchors; a negative positive score has an empty
window; products beyond the range of a long stop at its ends; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locusweave.llm.common import runs_on_executors, saved

runs_on_executors(__name__)
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score between which a negative's lies.
LEAST_PERCENT, MOST_PERCENT = 30, 90
#: Rows and anchors of a block at most, about; and rows of a block while there are few.
BLOCK_ROWS, BLOCK_ANCHORS, FEW_ROWS, FEW_BLOCKS = 65_536, 4_096, 1_024, 32
#: Anchors that are joined together, dimensions of a step, and the share of pairs below which they go on one by one.
TILE, STEP, FEW_PAIRS = 64, 8, 0.05
#: Scores stop here on both sides.
_MOST = (1 << 63) - 1


class Index:
    """Rows of a block, to be joined with anchors: both as whole numbers, a row each, of the same width."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        width = max(rows.shape[1], anchors.shape[1])
        rows, anchors = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (rows, anchors))
        weight = (rows.astype(float) ** 2).sum(0) * (anchors.astype(float) ** 2).sum(0)
        order = np.argsort(-weight, kind="stable")
        self.rows, self.anchors = rows[:, order], anchors[:, order]
        self.row_norms, self.anchor_norms = self._remaining(self.rows), self._remaining(self.anchors)

    @staticmethod
    def _remaining(m: np.ndarray) -> np.ndarray:
        """Norm of the dimensions from each one on, a little enlarged, so that rounding loses nothing."""
        squares = (m.astype(float) ** 2)[:, ::-1].cumsum(1)[:, ::-1]
        return np.pad(np.sqrt(squares), ((0, 0), (0, 1))) * (1 + 1e-9)

    def joined(self, who: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchors (numbers in `who`) and rows whose product is `least` of the anchor or more, and the product."""
        found = [self._tile(who[a : a + TILE], least[a : a + TILE]) for a in range(0, len(who), TILE)]
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3

    def _tile(self, who: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = self.rows.shape[1]
        # A row is indexed up to the dimension from which on no anchor can bring it to the threshold.
        reach = self.row_norms * self.anchor_norms[who].max(0) >= least.min()
        length = np.where(reach[:, 0], reach.sum(1), 0).clip(0, width)
        if least.min() <= 0:
            length[:] = width
        order = np.argsort(-length, kind="stable")
        in_list = np.append(np.searchsorted(-length[order], -np.arange(width), "left"), 0)  # rows of each dimension's list
        order = order[: in_list[0]] if least.min() > 0 else order
        partial = np.zeros((len(who), len(order)))
        x, norms, bound = self.anchors[who].astype(float), self.anchor_norms[who], least[:, None]
        slack = 0.5 + 1e-9 * norms[:, :1] * self.row_norms[:, 0].max(initial=0)
        alive = np.repeat(bound <= 0, len(order), 1)  # for vectors without dimensions
        for done in range(0, width, STEP):
            upto, n = min(done + STEP, width), in_list[done] if least.min() > 0 else len(order)
            y = self.rows[order[:n], done:upto].astype(float)
            y[np.arange(done, upto) >= length[order[:n], None]] = 0  # omitted dimensions are in no list
            partial[:, :n] += x[:, done:upto] @ y.T
            # What a row may still gain: its dimensions behind these, whether in a list or omitted.
            rest = norms[:, upto][:, None] * self.row_norms[order, upto]
            short = length[order] < upto
            if short.any():
                ends = length[order[short]]
                rest[:, short] = norms[:, ends] * self.row_norms[order[short], ends]
            alive = partial + rest >= bound - slack
            if not len(order) or alive.mean() < FEW_PAIRS:
                break
        a, r = np.nonzero(alive)
        return self._verified(who, least, a, order[r])

    def _verified(self, who, least, a, r):
        """Whole products of the pairs that are left."""
        keep_a, keep_r, keep_s = [], [], []
        for k in range(0, len(a), 1 << 16):
            i, j = a[k : k + (1 << 16)], r[k : k + (1 << 16)]
            score = products(self.anchors[who[i]], self.rows[j])
            good = score >= least[i]
            keep_a.append(who[i[good]])
            keep_r.append(j[good])
            keep_s.append(score[good])
        return tuple(np.concatenate(c) if c else np.zeros(0, np.int64) for c in (keep_a, keep_r, keep_s))


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of two lists of rows, as longs; exact, also where floating point is not."""
    if not x.size:
        return np.zeros(len(x), np.int64)
    most = float(np.abs(x).max()) * float(np.abs(y).max()) * x.shape[1]
    if most < 2.0**53:
        return np.einsum("ij,ij->i", x.astype(float), y.astype(float)).astype(np.int64)
    exact = (x.astype(object) * y.astype(object)).sum(1)
    return np.array([min(max(int(v), -_MOST), _MOST) for v in exact], np.int64)


def windows(rows, anchors, row_ids, row_labels, anchor_ids, anchor_labels, bounds, same: bool, k: int):
    """The windows of a block -> anchor, its window, row and score of each found partner.

    bounds: for each anchor the (lower, upper) ends of its windows; a window holds the best k partners within.
    same: are partners of the anchor's label or of all others?
    """
    index = Index(rows, anchors)
    out: list[tuple[np.ndarray, ...]] = []
    open_ = np.array([i for i in range(len(anchors)) if bounds[i]], np.int64)
    floor = np.array([min((low for low, _ in b), default=0) for b in bounds], dtype=float)
    lowest = -index.row_norms[:, 0].max(initial=0) * index.anchor_norms[:, 0]
    floor = np.maximum(floor, lowest)
    floor -= np.abs(floor) * 1e-9 + 1  # a number may be rounded; the ends themselves are compared below
    top = np.array([min((high for _, high in b), default=0) for b in bounds], dtype=float)
    # The first threshold: so many standard deviations of a product of random directions.
    spread = np.median(index.row_norms[:, 0]) * index.anchor_norms[:, 0] / np.sqrt(max(1, index.rows.shape[1])) if len(rows) else floor
    least = np.maximum(floor, np.minimum(top - 0.25 * spread, 3 * spread))
    step = np.maximum(spread, 1.0)
    while len(open_):
        a, r, score = index.joined(open_, np.ceil(least[open_]))
        fits = ((row_labels[r] == anchor_labels[a]) == same) & (row_ids[r] != anchor_ids[a])
        a, r, score = a[fits], r[fits], score[fits]
        order = np.lexsort((row_ids[r], -score, a))
        a, r, score = a[order], r[order], score[order]
        starts, ends = np.searchsorted(a, open_, "left"), np.searchsorted(a, open_, "right")
        left = []
        for i, s, e in zip(open_.tolist(), starts.tolist(), ends.tolist()):
            taken = []
            for w, (low, high) in enumerate(bounds[i]):
                # Scores fall, so those at or below the upper end come last.
                b = s + int(np.searchsorted(-score[s:e], -high, "left"))
                n = int((score[b : min(b + k, e)] >= low).sum())
                taken.append((w, b, n))
            if least[i] > floor[i] and any(n < k for _, _, n in taken):
                left.append(i)
            else:
                out += [(np.full(n, i), np.full(n, w), r[b : b + n], score[b : b + n]) for w, b, n in taken if n]
        open_ = np.array(left, np.int64)
        least[open_] = np.maximum(floor[open_], least[open_] - step[open_])
        step *= 2
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def _matrix(lists: pa.Array) -> np.ndarray:
    """Vectors of whole numbers as rows; shorter ones end in zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.asarray(lists.value_lengths()).astype(np.int64)
    flat = np.asarray(lists.flatten())
    if len(sizes) and (sizes == sizes[0]).all():
        return flat.reshape(len(sizes), -1)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), flat.dtype)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _numbers(column) -> np.ndarray:
    return np.asarray(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)


def _best(anchors: DataFrame, rows: DataFrame, same: bool, k: int, name: str) -> DataFrame:
    """anchors(row, id, label, q, lows, highs), rows(row, id, label, q) -> row, anchor_id, window, id, score, rank; saved."""
    n_rows, n_anchors = rows.count(), anchors.count()
    row_blocks = max(-(-n_rows // BLOCK_ROWS), min(FEW_BLOCKS, -(-n_rows // FEW_ROWS)), 1)
    anchor_blocks = max(-(-n_anchors // BLOCK_ANCHORS), 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        low, high, ids = left.column("lows").to_pylist(), left.column("highs").to_pylist(), _numbers(right.column("id"))
        mine, bounds = _numbers(left.column("id")), [list(zip(*ends)) for ends in zip(low, high)]
        a, w, r, score = windows(
            _matrix(right.column("q")), _matrix(left.column("q")), ids, _numbers(right.column("label")), mine, _numbers(left.column("label")), bounds, same, k
        )
        return pa.table({"row": _numbers(left.column("row"))[a], "anchor_id": mine[a], "window": w.astype(np.int32), "id": ids[r], "score": score})

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias(own)
        return df.select("*", mine, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)).groupBy("a_block", "r_block")

    cells = dealt(anchors, "a_block", anchor_blocks, "r_block", row_blocks)
    cells = cells.cogroup(dealt(rows, "r_block", row_blocks, "a_block", anchor_blocks))
    found = saved(cells.applyInArrow(run, "row long, anchor_id long, window int, id long, score long"), name)
    order = W.partitionBy("row", "window").orderBy(F.desc("score"), "id")
    return saved(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), name + "-best")


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least_percent: int = LEAST_PERCENT, most_percent: int = MOST_PERCENT) -> DataFrame:
    """rows(vec_id, vector, label) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    named = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
    chosen = saved(
        rows.where(named & ~bad).select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("long").alias("id"),
            F.col("label").cast("long").alias("label"),
            whole.alias("q"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        ),
        "negatives-rows",
    )
    partners, anchors = chosen.drop("is_anchor"), chosen.where("is_anchor").drop("is_anchor")
    everything = F.array(F.lit(-_MOST)).alias("lows"), F.array(F.lit(_MOST)).alias("highs")
    found = _best(anchors.select("*", *everything), partners, True, positives, "positives")
    # A window for each positive, in the order of their ranks; none for scores below 0, which come last.
    score = F.col("score").cast("decimal(38,0)")
    low, high = F.ceil(score * least_percent / 100), F.floor(score * most_percent / 100)
    ends = F.struct("rank", low.cast("long").alias("low"), high.cast("long").alias("high"))
    ends = found.where("score >= 0").groupBy("row").agg(F.sort_array(F.collect_list(ends)).alias("ends"))
    with_ends = anchors.join(ends.select("row", F.col("ends.low").alias("lows"), F.col("ends.high").alias("highs")), "row")
    hard = _best(saved(with_ends, "negatives-anchors"), partners, False, negatives, "negatives")
    firsts = found.select("row", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(firsts, ["row", "window"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
