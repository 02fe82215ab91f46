"""Token alignment, hard negatives and line dedup against brute force, and their edge cases."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusweave.llm import hard_negatives, line_dedup, token_alignment
from locusweave.llm.queries import tokenizer_path
from locusweave.llm.sentencepiece_codec import model_bytes

DOCS = "doc_id long, text string, source string, pairs string, h1 string, row string"
LINE = "This line is long enough to be a key of the operator, "


@pytest.fixture(scope="module")
def files():
    return model_bytes(tokenizer_path("byte_bpe_50k.json")), model_bytes(tokenizer_path())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# 11 alignment


def spans(tokens):
    end, out = 0, []
    for i, b in tokens:
        end += len(b)
        out.append((i, end))
    return out


def aligned_by_hand(rows, files):
    """Each text by the libraries alone, then sets of ends."""
    from tokenizers import Tokenizer

    pair = token_alignment.Pair(*files)
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    per, counts = [], Counter()
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        a = [(i, pair.a_bytes[i]) for i in library.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = [(i, pair.b_bytes[i]) for i in pair.b.encode(text or "")]
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            per.append((doc_id, 0, 0, [], ""))
            continue
        a, b = spans(a), spans(b)
        both = sorted({e for _, e in a} & {e for _, e in b})
        groups, low = [], 0
        for high in both:
            groups.append(tuple(",".join(str(i) for i, e in side if low < e <= high) for side in (a, b)))
            low = high
        links = [(i, j) for i, e in a for j, f in b if e == f]
        counts.update(links)
        per.append((doc_id, len(a), len(b), links, ";".join("|".join(g) for g in groups)))
    best = defaultdict(int)
    for (_, j), c in counts.items():
        best[j] = max(best[j], c)
    return sorted(
        (d, n, m, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), sha(g) if g else "") for d, n, m, links, g in per
    )


TEXTS = ["", None, " ", "one", "Hello, world!  Two  spaces\n\nand\tlines", "naïve café 日本語 🎉🎉 ß", "▁ mark", "<|endoftext|> and <s> </s> <unk> <0x41>", "don't we'll I'D", "x" * 3_000, "word " * 2_000, "\x00 nul \x7f", "Hello, world!", "Hello, world!", "123456 7,890.12", " leading and trailing ", "é́ combining ‍ zwj"]


def test_alignment_equals_brute_force(spark, files):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(4, TEXTS[4])]
    docs = spark.createDataFrame([(d, t, None, "x", "y", "z") for d, t in rows], DOCS).repartition(3)
    got = token_alignment.align(docs, *files)
    columns = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == aligned_by_hand(rows, files)


def test_alignment_without_a_broadcast(spark, files, monkeypatch):
    rows = [(k, f"{w} {v} and {w}") for k, (w, v) in enumerate([("alpha", "beta"), ("gamma", "alpha")] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(token_alignment, "broadcast_if_small", lambda t: t)
    columns = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert sorted(tuple(r[c] for c in columns) for r in token_alignment.align(docs, *files).collect()) == aligned_by_hand(rows, files)


def test_groups_break_where_a_start_reaches_the_running_end():
    #       A: 0-3 3-4 4-9        B: 0-2 2-4 4-6 6-9
    starts, ends = np.array([0, 3, 4, 0, 2, 4, 6]), np.array([3, 4, 9, 2, 4, 6, 9])
    order, group = token_alignment.coalesced(starts, ends, np.array([0, 0, 0, 1, 1, 1, 1]))
    assert [sorted(order[group == g].tolist()) for g in (0, 1)] == [[0, 1, 3, 4], [2, 5, 6]]


def test_alignment_returns_groups_and_empty_tables(spark, files):
    docs = spark.createDataFrame([(1, "Hello")], "doc_id long, text string")
    row = token_alignment.links(docs, *files, digest=False).first()
    assert row["groups"].count("|") == row["n_groups"] == row["n_links"] == sum(row["times"])
    assert token_alignment.align(spark.createDataFrame([], DOCS), *files).count() == 0


# 12 hard negatives


def mined_by_hand(rows, positives=5, negatives=10):
    good = [(i, [int(np.floor(256 * float(x))) for x in v], l) for i, v, l in rows if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda x, y: sum(a * b for a, b in zip(x, y))
    out = []
    for i, v, l in good:
        if i % 10:
            continue
        scored = sorted((-dot(v, w), j, m) for j, w, m in good if j != i)
        for s, j, _ in [x for x in scored if x[2] == l][:positives]:
            fit = [x for x in scored if x[2] != l and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fit)]
    return sorted(out)


def mined(df, **more):
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, **more)
    return sorted(tuple(r[c] for c in "anchor_id positive_id rank negative_id positive_score negative_score".split()) for r in got.collect())


VECTORS = "vec_id long, vector array<float>, label int, row string, window string, score int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, l, "a", "b", 1) for i, v, l in rows], VECTORS)


@pytest.mark.parametrize("kind", ["normal", "sparse", "ties"])
def test_hard_negatives_equal_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    n, d = 400, 12
    v = rng.normal(size=(n, d)) / 3
    if kind == "sparse":
        v[rng.random((n, d)) < 0.7] = 0
    if kind == "ties":
        v = np.round(v)
        v[100:250] = v[0]
    rows = [(k, v[k].astype(np.float32).tolist(), int(rng.integers(3))) for k in range(n)]
    assert mined(table(spark, rows)) == mined_by_hand(rows)


def test_hard_negatives_edge_cases(spark):
    one = [0.5, 0.5]
    rows = [(0, one, 1), (10, one, 1), (1, [0.25, 0.5], 1), (2, [0.25, 0.25], 2), (3, [0.5, 0.25], 2), (3, [0.5, 0.25], 2), (4, None, 1), (5, one, None), (6, [None, 0.5], 2), (7, [float("nan"), 1.0], 2)]
    rows += [(8, [float("inf"), 0.0], 1), (None, one, 1), (9, [], 2), (11, [0.5], 2), (12, [0.1, 0.2, 0.3], 2), (20, [-0.5, -0.5], 3), (21, [0.5, 0.5], 3)]
    assert mined(table(spark, rows)) == mined_by_hand(rows)
    assert mined(table(spark, rows), positives=1, negatives=1) == mined_by_hand(rows, 1, 1)
    assert mined(table(spark, [])) == [] == mined(table(spark, [(1, one, 1)])) == mined(table(spark, [(0, one, 1)]))
    huge = mined(table(spark, [(0, [3e38], 1), (1, [3e38], 1), (2, [3e37], 2)]))
    assert all(-(2**63) < r[4] < 2**63 for r in huge)


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=6).tolist(), int(rng.integers(2))) for k in range(300)]
    df = table(spark, rows)
    first = mined(df)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 37)
    assert mined(df) == first == mined_by_hand(rows)


def test_index_omits_dimensions():
    """With a high threshold a row's last dimensions are in no list, and the result is whole all the same."""
    rng = np.random.default_rng(7)
    rows = np.round(rng.normal(size=(500, 32)) * 100 / (1 + np.arange(32))).astype(np.int64)
    index = hard_negatives.Index(rows, rows[:20])
    whole = rows[:20] @ rows.T
    for t in (-(10**6), 0, 5_000, 20_000, 10**9):
        a, r, s = index.joined(np.arange(20), np.full(20, float(t)))
        assert sorted(zip(a.tolist(), r.tolist(), s.tolist())) == sorted((i, j, int(whole[i, j])) for i, j in zip(*np.nonzero(whole >= t)))


# 13 lines


def lines_by_hand(rows, least=40, documents=5):
    key = lambda line: line.strip(" \t\n\v\f\r").encode().lower().decode()
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        order = lambda x: (x is not None, x or 0)
        kept = [line for line in lines if not (len(holders[key(line)]) >= documents and d != max(holders[key(line)], key=order))]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


def deduped(docs, **more):
    return sorted((tuple(r[c] for c in "doc_id n_lines n_dropped kept_sha256".split()) for r in line_dedup.digests(docs, **more).collect()), key=repr)


def line_rows():
    rng = random.Random(1)
    pool = [LINE + str(k) for k in range(30)] + ["short", "", "  ", "É" * 39, "É" * 40, "x" * 40, "\t" + LINE + "0 ", LINE.upper() + "0", LINE + "0 "]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(12)))) for k in range(60)]
    rows += [(70, None), (71, ""), (72, "\n\n"), (3, rows[3][1]), (3, "\n".join([LINE + "1", LINE + "2"] * 3)), (None, LINE + "1\n" + LINE + "3"), (None, LINE + "1\n" + LINE + "3")]
    rows += [(80 + k, ("very common " * 5 + "\n") * 50 + f"own {k}") for k in range(40)] + [(130, "É" * 40), (131, "é" * 40 + "\n" + "z" * 200_000)]
    rows += [(140 + k, "four holders of this line are not enough to lose it") for k in range(4)] + [(150 + k, "five holders of this line are enough to lose it, but one") for k in range(5)]
    return rows


def test_lines_equal_brute_force(spark):
    rows = line_rows()
    docs = spark.createDataFrame([(d, t, None, "x", "y", "z") for d, t in rows], DOCS).repartition(5)
    assert deduped(docs) == lines_by_hand(rows)
    kept = line_dedup.dedup(docs)
    assert kept.columns == docs.columns and sorted(sha(t or "") for (t,) in kept.select("text").collect()) == sorted(r[3] for r in lines_by_hand(rows))
    assert deduped(docs, least_characters=10, least_documents=2) == lines_by_hand(rows, 10, 2)
    assert deduped(spark.createDataFrame([], DOCS)) == []


def test_a_common_line_is_cut_over_tasks(spark):
    """With many range partitions most tasks hold occurrences of one hash only, or begin or end inside a hash."""
    rows = [(k, "\n".join([LINE + "common"] * 3 + [LINE + str(k % 7)])) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "41")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert deduped(docs) == lines_by_hand(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_stream_says_the_same_in_any_batches_and_tasks(size):
    rng = np.random.default_rng(size)
    rows = np.zeros((400, 6), np.int64)
    rows[:, 0], rows[:, 3], rows[:, 2] = rng.choice([1, 1, 1, 1, 2, 3, 4, 5, 6], 400), rng.integers(-3, 9, 400), 1
    rows = rows[np.lexsort((-rows[:, 3], rows[:, 0]))]
    rows[:, 5] = np.arange(400)
    for cuts in ([400], [90, 91, 250, 400], list(range(3, 400, 3)) + [400]):
        goes, opened, named, a = set(), [], defaultdict(set), 0
        for b in cuts:
            stream, task = line_dedup.Stream(5), rows[a:b]
            said = [x for k in range(0, len(task), size) for x in stream.push(task[k : k + size])] + stream.end()
            for kind, found in said:
                if kind == line_dedup.GOES:
                    goes |= set(found[:, 5].tolist())
                elif kind == line_dedup.OPEN:
                    opened += found.tolist()
                else:
                    for r in found.tolist():
                        named[r[0]].add(r[3])
            a = b
        goes |= {r[5] for r in opened if len(named[r[0]]) >= 5 and r[3] != max(named[r[0]])}
        holders = defaultdict(set)
        for r in rows.tolist():
            holders[r[0]].add(r[3])
        assert goes == {r[5] for r in rows.tolist() if len(holders[r[0]]) >= 5 and r[3] != max(holders[r[0]])}


def test_bitmaps_round_trip():
    for places in ([0], [7], [8], [3, 64, 1000]):
        stays = line_dedup.unpack(line_dedup.pack(np.array(places)), 1200)
        assert np.flatnonzero(~stays).tolist() == places
