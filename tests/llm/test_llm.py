"""The text operators on small tables: edge cases, brute force, round trips and held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from locusweave.llm import exact_dedup, graph, html_extract, license_scan, lm_score, minhash_dedup, ogg_media, secret_scan, sentencepiece_codec, source_mix, toxicity
from locusweave.llm.queries import QUERIES, tokenizer_path
from locusweave.llm.words import word_hashes

DOCS = "doc_id long, text string, lang string, source string, node long, row string"
ODD = ["", None, " \t\n ", "one", "Same text here", "Same text here", "same TEXT here", "é ñ 日本 🎉 x", "a b c d e f", "a b c d e f", "word " * 30_000, "x" * 50_000, "line\nbreaks\n\n here", "▁ marks  and   runs"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, long texts, ties, repeated rows and columns with clashing names."""
    rows = [(k, t, "en", f"s{k % 3}", 1, "r") for k, t in enumerate(ODD)]
    rows += [(5, "Same text here", None, None, None, None), (None, "null id", None, None, None, None), (8, "a b c d e f", "en", "s2", 1, "r")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text):
    return (text or "").encode().lower().split()


def test_every_operator_takes_an_empty_table(spark, none, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = sentencepiece_codec.model_bytes(tokenizer_path())
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    made = [
        exact_dedup.classes(none), exact_dedup.dedup(none), minhash_dedup.classes(none), minhash_dedup.dedup(none), source_mix.mix_table(none), source_mix.mix(none), toxicity.score(none, labels),
        toxicity.reject(none, labels), lm_score.score(none), secret_scan.scan(none, F.col("source"), F.col("lang")), sentencepiece_codec.digests(none, model), ogg_media.digests(none), html_extract.extract(pages), license_scan.scan(none),
    ]
    assert [df.count() for df in made] == [0] * len(made)


def test_queries_are_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


# 1 html

PAGE = '<html><head><title>T</title><script>var a="<p>x</p>";</script></head><body><nav><a href=1>Home</a></nav><article><h1>A &amp; B</h1><p>One\n  two<br>three <b>b</b>old &lt;p&gt;.</p><p>Short</p></article><div class="comments"><p>I do not agree with this at all, it was not so.</p></div><footer>&copy; 2020 all of it</footer>'


def test_html_keeps_the_article():
    tree = html_extract.trained()
    assert html_extract.main_text(PAGE, tree) == "A & B\n\nOne two three bold <p>.\n\nShort"
    assert html_extract.main_text(PAGE[: PAGE.index("Short") + 3], tree).endswith("Sho")
    for bad in ("", None, "<", "<p", "<!-- x", "<script>a", "</p></div></article>", "<div class='a"):
        assert html_extract.main_text(bad, tree) == ""


AROUND = "<article><h1>T</h1><p>It ends at the sea, and nobody knows why it does so.</p>{}<p>She went home and told them all about it, and they did not believe her.</p></article>"


@pytest.mark.parametrize(
    "inner,kept",
    [
        ('<p class="ad">Buy our boots now.</p>', False), ('<span class="promo-box">Buy <span>our</span> boots now</span>', False), ("<p id=newsletter>Sign up.", False), ("<p>" + "<a href=1>" + "word " * 21 + "</a></p>", False),
        ('<div class="share-price-article">The share fell.</div>', True), ('<section class="no-sidebar">All of it.</section>', True), ('<p class="post__comments--open">Nonsense!</p>', False),
        ("<p><a href=1>The house</a></p>", True), ("<ul><li><a href=1>The first of the houses by the lake that we saw</a><li><a href=2>The second of the houses by the lake that we saw</a></ul>", True),
    ],
)
def test_html_marks_and_link_density(inner, kept):
    said = html_extract.main_text(AROUND.format(inner), html_extract.trained()).split("\n\n")
    assert (len(said) > 3) == kept and said[0] == "T" and said[-1].startswith("She went")


def test_html_without_marks():
    page = "<p><a href=1>Read the report of the council on bridges</a> <a href=2>What to do when a tree has fallen</a></p><p>The plain text of this page stands here for itself alone, with no mark.</p>"
    assert html_extract.main_text(page, html_extract.trained()).startswith("The plain text")


def test_html_tree_uses_what_the_method_names():
    tree = html_extract.trained()
    used = {html_extract.FEATURES[f] for f in tree.feature if f >= 0}
    assert {"words", "link_density"} <= used and used & {"words_before", "words_after"} and {"density_before", "density_after"} <= used
    rows = [(html_extract.features(html_extract.blocks(p.replace("+", ""))), p) for p in html_extract.LABELLED]
    x = np.concatenate([r for r, _ in rows])
    y = np.array([b.text.startswith("+") for _, p in rows for b in html_extract.blocks(p)], float)
    wrong = (np.array(tree.predict(x)) != y).sum()
    assert wrong <= 5
    for names in (("link_density",), ("words_before", "density_before", "words_after", "density_after")):
        less = x.copy()
        less[:, [html_extract.FEATURES.index(n) for n in names]] = 0
        assert (np.array(html_extract.grow(less, y).predict(less)) != y).sum() > wrong + 10


def test_html_against_a_plain_walker():
    """Articles of the given pages, cut at their block tags."""
    import html as entities

    tree, pages = html_extract.trained(), []
    import pyarrow.parquet as pq

    for page in pq.read_table("/root/testdata/sf0.001/pages.parquet").column("html").to_pylist():
        if page and "<article>" in page and "</article>" in page:
            inner = page[page.index("<article>") : page.index("</article>")]
            cut = re.split(r"</?(?:p|h1|article|ul|li)>", re.sub("</?b>", "", inner.replace("<br>", " ")))
            want = [t for t in (" ".join(entities.unescape(c).split()) for c in cut) if t]
            pages.append(page)
            assert html_extract.main_text(page, tree) == "\n\n".join(want)
    assert pages


def test_html_unclosed_tags_take_linear_time():
    import time

    took = []
    for n in (2_000, 16_000):
        began = time.process_time()
        html_extract.blocks("<div>" * n + "</nav>" * n + "<span class=ad><div>" + "<b class=ad>" * n + "</span>" * n)
        took.append(time.process_time() - began)
    assert took[1] < 30 * max(took[0], 0.01)


def test_html_table(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "y"), (2, None, None, "y"), (None, "v", "<p>" + "w " * 200_000, "z")], "page_id long, url string, html string, text string")
    rows = html_extract.extract(df).collect()
    assert len(rows) == 4 and all(r.n_chars == len(r.text) for r in rows) and max(r.n_chars for r in rows) == 399_999


# 2 ogg


def test_page_checksum_bit_by_bit():
    def slow(data):
        r = 0
        for x in data:
            r ^= x << 24
            for _ in range(8):
                r = (r << 1 ^ 0x04C11DB7 if r & 0x80000000 else r << 1) & 0xFFFFFFFF
        return r

    for data in (b"", b"\x00", b"OggS\x01\x02", bytes(range(256))):
        assert ogg_media.page_checksum(data) == slow(data)


@pytest.mark.parametrize("n", [0, 1, 254, 255, 575, 576, 577, 4608, 65_025, 65_601, 300_000])
def test_ogg_round_trip(n):
    text = random.Random(n).randbytes(n)
    sound = ogg_media.decode(ogg_media.write(text))
    assert sound.payload[:n] == text and sound.text_bytes == n
    assert set(sound.payload[n:]) <= {255} and len(sound.payload) % 576 == 0 and len(sound.payload) - n <= 576 and sound.payload
    assert sound.seconds == len(sound.payload) / 8000 and sound.marks == sorted(sound.marks)


def test_ogg_damage_is_found():
    data = ogg_media.write(b"abc" * 30_000)
    for at in (30, 1000, len(data) - 1):
        with pytest.raises(ValueError):
            ogg_media.read(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    with pytest.raises(ValueError):
        ogg_media.read(data[:-5])
    first = data.index(b"OggS", 4)
    with pytest.raises(ValueError):
        ogg_media.read(data[first:])


def test_ogg_table(odd):
    rows = ogg_media.digests(odd).collect()
    assert len(rows) == odd.count()
    for r, text in zip(rows, [x.text for x in odd.select("text").collect()]):
        raw = (text or "").encode()
        full = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-32:]))


# 3 sentencepiece


def test_encoder_equals_library():
    own = sentencepiece_codec.Encoder(sentencepiece_codec.model_bytes(tokenizer_path()), remembered=500)
    rng = random.Random(2)
    texts = [t or "" for t in ODD] + ["".join(rng.choice("abcdeth \t\n▁éßñ日🎉\x00AB.,  12") for _ in range(rng.randrange(60))) for _ in range(2000)]
    for a in range(0, len(texts), 100):
        part = texts[a : a + 100]
        assert [ids.tolist() for ids in own.encode_batch(part)] == own.library.encode(part)
        own.check(part[0])
        own.forget()


def test_sentencepiece_table(odd):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    rows = sentencepiece_codec.digests(odd, sentencepiece_codec.model_bytes(tokenizer_path())).collect()
    for r, x in zip(rows, odd.select("text").collect()):
        ids = lib.encode(x.text or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((lib.decode(ids) if ids else "").encode()).hexdigest()


# 4 licences


def test_licences(spark, odd):
    rows = [(1, "x\nReleased under the MIT License.\ny", ""), (1, "Licensed under the Eclipse Public License.", ""), (2, "Apache flew under the bridge", ""), (3, None, ""), (4, "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, line string")
    got = sorted((r.doc_id, r.families, r.lines, r.n_unknown) for r in license_scan.scan(df).collect())
    assert got == [(1, "", "0:unknown", 1), (1, "MIT", "1:MIT", 0), (2, "", "", 0), (3, "", "", 0), (4, "CC-BY-NC-4.0,GPL-3.0", "0:CC-BY-NC-4.0,1:GPL-3.0", 0)]
    mixed = df.unionByName(odd.select("doc_id", "text", F.lit("").alias("line")))
    same = lambda d: sorted(str(tuple(r)) for r in license_scan.scan(d).collect())
    assert same(mixed) == same(mixed.repartition(7, "text")) == same(mixed.repartition(3).where("doc_id is null or doc_id >= 0"))
    assert license_scan.scan(odd).count() == odd.count()


STATED = [
    ("CC BY-SA 4.0", "CC-BY-SA-4.0"), ("Licensed under AGPL v3", "AGPL-3.0"), ("GPL v2", "GPL-2.0"), ("GPLv3", "GPL-3.0"), ("Licensed under the BSD 2-Clause License", "BSD-2-Clause"), ("Released under the new BSD license", "BSD-3-Clause"),
    ("Apache License 1.1", "Apache-1.1"), ("Licensed under the Apache License 7.5", "unknown"), ("Licensed under the Eclipse Public License.", "unknown"), ("Released under the WTFPL license", "unknown"),
    ("I got my driving license yesterday.", ""), ("The show was released to the public in May.", ""), ("mit der Zeit", ""), ("The program is licensed for use in 3 schools.", ""),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "ISC"),
    ("This program is free software; you can redistribute it and/or\nmodify it under the terms of the GNU General Public License\nas published by the Free Software Foundation; either version 2\nof the License, or (at your option) any later version.", "GPL-2.0"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction", "MIT"),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:", "BSD"),
    ("Licensed under CC\nBY 4.0.", "CC-BY-4.0"), ("MIT License\nApache License 2.0\nGNU General Public\nLicense version 2\nlast", "MIT,Apache-2.0,GPL-2.0"), ("Licensed under the GNU Library General Public License", "unknown"),
]


def test_statements_by_name_version_and_wrap(spark):
    df = spark.createDataFrame([(k, f"He went home.\n\n{t}\n\nThe end.") for k, (t, _) in enumerate(STATED)], "doc_id long, text string")
    got = {r.doc_id: r.lines for r in license_scan.scan(df).collect()}
    assert [(t, ",".join(x.split(":")[1] for x in got[k].split(",") if x)) for k, (t, _) in enumerate(STATED)] == STATED


def test_licence_scores_by_brute_force(spark):
    """Which lines are statements, by the same weights in numpy over all lines: the gate loses none."""
    model = license_scan.model_of(spark)
    weights = {g: np.array(w) for g, *w in model.weights}

    def grams(line):
        text = re.sub(r"(gpl|mpl|apache)[-_]?v?(?=[0-9])", r"\1 ", line.lower())
        w = re.findall("[a-z0-9]+", re.sub(r"(?<![a-z0-9])v?[0-9]+(?:\.[0-9]+)*(?![a-z0-9])", "0", text))
        return set(w) | {f"{a} {b}" for a, b in zip(w, w[1:])}

    rng = random.Random(8)
    vocabulary = sorted({w for g in weights for w in g.split()})
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    docs += [(10_000 + k, "\n\n".join(" ".join(rng.choices(vocabulary, k=rng.randrange(1, 7))) for _ in range(20))) for k in range(60)]
    want = set()
    for i, text in docs:
        for n, line in enumerate(text.split("\n")):
            z = np.array(model.intercepts) + sum((weights[g] for g in grams(line) if g in weights), np.zeros(len(license_scan.CLASSES)))
            if z[1:].max() > z[0] + 1e-9:
                want.add((i, n))
    found = license_scan.statements(spark.createDataFrame(docs, "doc_id long, text string"), model).where("n = 1").select("doc_id", "line").collect()
    got = {(r.doc_id, r.line) for r in found}
    assert got <= want and len(want) > 20
    runs = license_scan.statements(spark.createDataFrame(docs, "doc_id long, text string"), model).where("n > 1").collect()
    assert {x for x in want - got} <= {(r.doc_id, r.line + k) for r in runs for k in range(r.n)}


# 5 exact


@pytest.mark.parametrize("chars,hashed", [(4096, None), (2, None), (3, lambda b: F.length(b).cast("long")), (1, lambda b: F.lit(7).cast("long"))])
def test_exact_classes(spark, odd, chars, hashed):
    small = odd.where(F.length(F.coalesce("text", F.lit(""))) < 1000) if chars < 4096 else odd
    rows = exact_dedup.classes(small, chars, hashed or exact_dedup._hash).collect()
    given = [(r.doc_id, r.text or "") for r in small.select("doc_id", "text").collect()]
    groups = defaultdict(list)
    for i, t in given:
        groups[hashlib.sha256(t.encode()).hexdigest()].append(i)
    assert len(rows) == len(given) and len({r.text_id for r in rows}) == len(groups)
    for r in rows:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
    for sha in groups:
        assert sum(r.kept for r in rows if r.text_sha256 == sha) == 1
    assert exact_dedup.dedup(small, chars).count() == len(groups)


def test_exact_dedup_keeps_other_texts_of_a_repeated_id(spark):
    given = [(5, "A"), (5, "A"), (5, "B"), (None, "C"), (None, "C"), (None, "D"), (None, "E"), (7, "E"), (None, "F"), (None, "F"), (8, "F"), (6, None), (6, "")]
    df = spark.createDataFrame([(i, t, "en", f"s{k}", k, "r") for k, (i, t) in enumerate(given)], DOCS)
    got = exact_dedup.dedup(df)
    assert got.columns == df.columns
    assert sorted((str(r.doc_id), r.text or "") for r in got.collect()) == [("5", "A"), ("5", "B"), ("6", ""), ("7", "E"), ("8", "F"), ("None", "C"), ("None", "D")]


# 6 language model


def test_lm_by_brute_force(spark, odd):
    more = [(100 + k, " ".join(random.Random(k).choices(["the", "of", "Lower", "rain,", "ñu", "x1"], k=40)), "en", "s", 0, "") for k in range(60)]
    df = odd.where(F.length(F.coalesce("text", F.lit(""))) < 1000).unionByName(spark.createDataFrame(more, DOCS))
    given = df.select("doc_id", "text").collect()
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10
    c = Counter(w for r in given if fold(r.doc_id) for w in [*words_of(r.text), b"\n"])
    n, v = sum(c.values()), len(c)
    want = sorted((str(r.doc_id), fold(r.doc_id) == 0, len(words_of(r.text)) + 1, sum(c[w] > 0 for w in [*words_of(r.text), b"\n"]), round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*words_of(r.text), b"\n"]), 6)) for r in given)
    rows = lm_score.score(df).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == want
    assert {r.train_tokens for r in rows} == {n} and all(r.score < 0 for r in rows)


def test_lm_is_normalised_and_learns():
    rng = np.random.default_rng(0)
    symbols = np.cumsum(rng.integers(1, 3, 30_000)) % 20  # each symbol is one or two more than the last
    ends = np.arange(0, 30_001, 30)
    own = lm_score.Trainer(np.full(20, 0.05))
    for turn in range(12):  # the triples of these texts fill four batches
        told = own.learn(*lm_score.counted(lm_score.triples(symbols, ends, 20)), 0.1, np.random.default_rng(turn))
    assert told < 0
    net = own.network()
    norm = net.normalisers()
    for a, b in ((0, 1), (20, 20), (5, 20)):
        p = np.exp((net.before[0][a] + net.before[1][b]) @ net.outputs.T + net.bias - norm[a * 21 + b])
        assert abs(p.sum() - 1) < 1e-4
    one, two = lm_score.contexts(symbols, ends, 20)
    logp = np.einsum("ij,ij->i", net.before[0][one] + net.before[1][two], net.outputs[symbols]) + net.bias[symbols] - norm[one * 21 + two]
    assert logp.mean() > math.log(0.3)


def test_lm_learns_from_every_text_and_agrees_with_itself(spark):
    docs = [(k, " ".join(random.Random(k).choices(["the", "of", "rain", "sea"], k=30)) + (" odd even" * 40 if k == 7 else "")) for k in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3, "doc_id")
    one, two = ({r.doc_id: r.score for r in lm_score.score(df).collect()} for _ in range(2))
    assert one == two
    longer = spark.createDataFrame([*docs, (1001, "sea rain " * 60_000)], "doc_id long, text string").repartition(3, "doc_id")
    after = {r.doc_id: (r.score, r.train_tokens) for r in lm_score.score(longer).collect()}
    assert after[7][1] == sum(len(t.split()) + 1 for i, t in [*docs, (1001, "sea rain " * 60_000)] if zlib.crc32(str(i).encode()) % 10)
    assert all(after[k][0] != one[k] for k in one)


def test_lm_does_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", 700)
    docs = [(k, " ".join(random.Random(k).choices(["the", "of", "rain", "sea", "ñu", "a b"], k=50))) for k in range(90)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    one, three, seven = ({r.doc_id: r.score for r in lm_score.score(df.repartition(n)).collect()} for n in (1, 3, 7))
    assert one == three == seven


def test_lm_score_recomputed_slowly(spark, monkeypatch):
    """A text's score from the parameters alone, word by word."""
    kept, fit = {}, lm_score._fit

    def keep(docs, scorer, noise, total):
        kept["scorer"], kept["total"] = scorer, total
        return fit(docs, scorer, noise, total)

    monkeypatch.setattr(lm_score, "_fit", keep)
    monkeypatch.setattr(lm_score, "FREQUENT", 4)
    docs = [(k, " ".join(random.Random(k).choices(["the", "of", "rain", "sea", "it", "was", "odd"], k=30))) for k in range(60)] + [(500, "the Unseen rain"), (501, None)]
    got = {r.doc_id: r.score for r in lm_score.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    known, counts = kept["scorer"], Counter()
    for k, text in docs:
        if zlib.crc32(str(k).encode()) % 10:
            counts.update([*words_of(text), None])
    net, n = known.network, len(known.network.outputs)
    for k, text in (docs[3], docs[-2], docs[-1]):
        hashes, classes, _ = lm_score.tokens(pa.array([text]))
        before, total = [n, n], 0.0
        for h, c, word in zip(hashes, classes.tolist(), [*words_of(text), None]):
            at = np.flatnonzero(known.words == h)
            own = int(known.symbol[at[0]]) if len(at) else -1
            symbol = own if own >= 0 else 4 + c
            scores = net.outputs @ (net.before[0][before[0]] + net.before[1][before[1]]) + net.bias
            total += float(scores[symbol] - np.log(np.exp(scores.astype(np.float64)).sum())) / math.log(10)
            if own < 0:
                total += math.log10(counts[word] + 0.1) - known.class_log[c]
            before = [symbol, before[0]]
        assert abs(total - got[k]) < 1e-3


# 7 near duplicates


def brute_components(docs, words, percent):
    sets, of = {}, {}
    for k, (i, text) in enumerate(docs):
        w = words_of(text)
        sets[k] = {tuple(w[j : j + words]) for j in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    for k in sets:
        of[k] = k

    def find(k):
        while of[k] != k:
            k = of[k]
        return k

    for a in sets:
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                of[find(a)] = find(b)
    least = defaultdict(list)
    for k in sets:
        least[find(k)].append(docs[k][0])
    return [(docs[k][0], len(sets[k]), min((i for i in least[find(k)] if i is not None), default=None)) for k in sets]


def test_near_duplicates_by_brute_force(spark, odd):
    rng = random.Random(5)
    base = [[rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 4) for _ in range(120)] for _ in range(3)]
    docs = []
    for k in range(150):  # families of copies with from none to many edits, some of copies of copies
        w = list(base[k % 3]) if k < 90 or not docs else list(docs[rng.randrange(len(docs))][1].split())
        for _ in range(rng.randrange(9)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        docs.append((1000 + k, " ".join(w)))
    passage = " ".join(f"p{j}" for j in range(60))
    docs += [(2000 + k, passage + " " + " ".join(f"u{k}x{j}" for j in range(70))) for k in range(40)]
    extra = spark.createDataFrame([(i, t, "", "", 0, "") for i, t in docs], DOCS)
    df = odd.unionByName(extra)
    given = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    rows = minhash_dedup.classes(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows) == sorted((str(i), n, str(c)) for i, n, c in brute_components(given, 4, 80))
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 2**63, 800, dtype=np.uint64)
    a, b = (np.concatenate([common, rng.integers(0, 2**63, 100, dtype=np.uint64)]) for _ in range(2))
    sig = minhash_dedup.signatures([a, b], 512)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.06


def test_components(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 200), (200, 300), (7, 7), (300, 100)]
    got = {(r.a, r.b) for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(k, 0) for k in range(1, 51)} | {(200, 100), (300, 100)}


def test_word_hashes_do_not_depend_on_neighbours():
    texts = ["Aa bb", None, "", "bb  aa", "cc" * 600_000 + " aa", "bb"]
    hashes, ends = word_hashes(pa.array(texts))
    assert np.diff(ends).tolist() == [2, 0, 0, 2, 2, 1]
    assert hashes[0] == hashes[3] == hashes[5] and hashes[1] == hashes[2] == hashes[6] and hashes[4] not in hashes[:2]


# 8 toxicity


def test_toxicity_on_held_out_rows(spark, odd):
    rng = random.Random(3)
    plain = ["the", "of", "river", "tower", "walk", "green", "under", "where", "lamp", "stone"]
    docs, marks = [], []
    for k in range(900):
        w = rng.choices(plain, k=60)
        toxic = k % 4 == 0
        for _ in range(2 * toxic):
            w.insert(rng.randrange(60), rng.choice(["grumpo", "vextil", "snarfen"]))
        docs.append((100 + k, " ".join(w), "en", "s", 0, ""))
        marks.append((100 + k, 1, int(toxic)))
    labels = spark.createDataFrame([*marks, (None, 1, 1), (5, None, None), (101, 1, None)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(docs, DOCS).unionByName(odd)
    rows = toxicity.score(df, labels).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    truth = {i: t for i, _, t in marks}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 200 and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert toxicity.reject(df, labels).columns == df.columns


def test_toxicity_learns_from_all_labelled_texts(spark):
    """A text stands for each of its words, so words that few texts hold are known only to a model that saw them all."""
    docs = [(k, f"plain{k % 50} word{k} " + ("grumpo" if k % 4 == 0 else "lamp"), "en", "s", 0, "") for k in range(14_000)]
    df = spark.createDataFrame(docs, DOCS)
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(14_000)], "doc_id long, quality int, toxic int")
    rows = toxicity.training_rows(df.unionByName(df), labels)
    kept = [k for k in range(14_000) if zlib.crc32(str(k).encode()) % 3 != 1]
    assert sorted(r.text for r in rows.collect()) == sorted(docs[k][1] for k in kept)
    one, two = (toxicity.train(rows.repartition(n), epochs=2, shard_chars=60_000) for n in (1, 5))
    assert (one.embed == two.embed).all() and (one.dense == two.dense).all() and one.bias == two.bias and (one.thresholds == two.thresholds).all()
    ids, ends = toxicity.word_ids(pa.array(["plain7 grumpo", "plain7 lamp", ""]))
    found = one.scores(ids, ends)
    assert found[0] >= toxicity.THRESHOLD > found[1] and found[2] < toxicity.THRESHOLD


# 9 secrets


def test_secret_spans(spark, odd):
    rows = [
        (1, 'é password = "abcdef1" x token:ab AKIA' + "A" * 16 + " z", "o1"), (2, "deadbeef" * 3 + " ghp_" + "z1" * 18, "o1"), (3, "SECRET='shared99'", "o1"), (4, "secret='shared99'", "o2"),
        (5, "API_KEY=shared99", "o3"), (6, None, None), (7, "token=token:abcdefgh", "o4"), (8, "ghp_" + "y2" * 18, "o1"), (9, "ghp_" + "y2" * 18, "o2"), (10, "ghp_" + "y2" * 18, None), (10, "ghp_" + "y2" * 18, None), (11, "token=q7Rk2LmX9z", "o1"), (12, "token=q7Rexample9z", "o1"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, owner string")
    got = {r.doc_id: r for r in secret_scan.scan(df, F.col("owner"), F.col("owner")).collect()}
    for i, text, _ in rows:
        spans = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, p, n) in enumerate(secret_scan.BASE) for m in re.finditer(p, text or "") if len(m[2] if k == 0 else m[0]) >= n]
        assert got[i].base_sha256 == hashlib.sha256(",".join(x for *_, x in sorted(spans)).encode()).hexdigest()
    assert got[4].holders == "3/3" and got[1].holders == "1/1,1/1" and got[1].n_live == 0
    assert got[1].spans == "assign:2:21,access:34:54" and (got[1].n_assign, got[1].n_access, got[1].n_hex) == (1, 1, 0)
    assert got[2].spans == "hex:0:24,other:25:65" and got[2].n_live == 1 and got[11].n_live == 1
    assert [got[k].n_example for k in (3, 4, 5)] == [1, 1, 1] and got[3].spans == "assign:0:16"
    assert got[6].spans == "" and got[6].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[7].n_assign == 0 and got[8].spans == "" and got[8].n_example == 1
    assert got[12].n_live == 0
    many = secret_scan.scan(df, F.lit("one"), F.col("doc_id").cast("string"), example_repositories=3)
    assert {r.doc_id: r.n_example for r in many.collect()}[4] == 1
    long = spark.createDataFrame([(1, "token=abcdef9 " * 20_000, "o")], "doc_id long, text string, owner string")
    assert secret_scan.scan(long, F.col("owner"), F.col("owner")).first().n_assign == 20_000
    assert secret_scan.scan(odd, F.col("source"), F.col("lang")).count() == odd.count()


# 10 mixing


def test_targets_fill_up(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), (None, 50), ("c", 0)], "source string, source_size long")
    got = {r.source: r.target for r in source_mix.targets(sizes).collect()}
    # weights: a 3, b 1, c 2, null 3; the budget 1725 caps a at 200, null at 100, c at 0 and leaves 1425 for b
    assert got == {"a": 200.0, "b": 1425.0, "c": 0.0, None: 100.0}


def test_mix_is_near_its_targets_and_agrees_with_itself(spark, odd):
    rng = random.Random(4)
    docs = spark.createDataFrame([(k, "w " * rng.randrange(60), "en", rng.choice("abcdefg"), 0, "") for k in range(3000)], DOCS)
    one, two = ({r.doc_id: r for r in source_mix.mix_table(docs).collect()} for _ in range(2))
    assert one == two
    source = {r.doc_id: r.source for r in docs.collect()}
    taken = defaultdict(int)
    for i, r in one.items():
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[source[i]] += r.taken
    for i, r in one.items():
        assert abs(taken[source[i]] - r.target) <= 30 + 1e-6
    assert source_mix.mix(docs).count() == sum(r.copies for r in one.values())
    assert source_mix.mix_table(odd).count() == odd.count()


def test_mix_takes_copies_by_row_where_ids_repeat(spark):
    given = [(k % 40 if k % 4 else None, "w " * (1 + k % 9) + f"t{k}", f"s{k % 3}") for k in range(240)]
    df = spark.createDataFrame([(i, t, "en", s, 0, "") for i, t, s in given], DOCS)
    table = source_mix.mix_table(df).collect()
    out = Counter(r.text for r in source_mix.mix(df).select("text").collect())
    assert sum(r.copies for r in table) == sum(out.values())
    assert sum(r.taken for r in table) == sum(len(t.split()) * n for t, n in out.items())
    by_pair = defaultdict(set)
    for i, t, s in given:
        by_pair[i, s].add(out[t])
    assert all(len(n) == 1 for n in by_pair.values()) and len({n for (i, _), v in by_pair.items() if i is None for n in v}) > 1


# pipeline


def test_stages_settle_rows_whose_ids_repeat(spark):
    from unittest import mock

    rng = random.Random(11)
    near = [f"n{j}" for j in range(60)]
    alone = [" ".join(f"a{k}x{j}" for j in range(30)) for k in range(4)]
    given = [(None, " ".join(near)), (None, " ".join([*near, "tail"])), (None, alone[0]), (None, alone[1]), (3, " ".join(["head", *near])), (3, " ".join(["head", *near]) + "\n"), (3, alone[2]), (3, ""), (None, None)]
    rng.shuffle(given)
    df = spark.createDataFrame([(i, t, "en", "s", k, "") for k, (i, t) in enumerate(given)], DOCS)
    out = [(r.doc_id, r.text) for r in minhash_dedup.dedup(df, words=5).collect()]
    linked = [x for x in out if "n5" in (x[1] or "")]
    assert len(linked) == 1 and linked[0][0] == 3
    assert sorted(str(x) for x in out if x not in linked) == sorted(map(str, [(None, alone[0]), (None, alone[1]), (3, alone[2]), (3, ""), (None, None)]))
    toxic = spark.createDataFrame([(None, "bad"), (None, "good"), (1, "fine"), (1, "bad"), (2, None)], "doc_id long, text string")
    scores = lambda docs, labels, *more: (docs.select("doc_id", *more, F.coalesce((F.col("text") == "bad").cast("double"), F.lit(0.0)).alias("score")), mock.Mock())
    with mock.patch.object(toxicity, "_scored", scores):
        assert sorted(str(r.text) for r in toxicity.reject(toxic, None).collect()) == ["None", "fine", "good"]


def test_stages_keep_columns_of_any_name(spark):
    names = ["doc_id", "text", "lang", "source", "_id", "_sha", "_copy", "_n", "key", "sha", "whole", "of", "upto", "copy", "Node", "kept", "text_sha256", "all_of_it"]
    rows = [(k % 7 if k % 5 else None, f"word{k % 11} " * 12 + "x y z w v", "en", f"s{k % 2}", *range(k, k + 14)) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} int" for n in names[4:]))
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(7)], "doc_id long, quality int, toxic int")
    given = {tuple(r) for r in df.collect()}
    for stage in (exact_dedup.dedup, minhash_dedup.dedup, source_mix.mix, lambda d: toxicity.reject(d, labels)):
        out = stage(df)
        assert out.columns == names and {tuple(r) for r in out.collect()} <= given
    assert exact_dedup.dedup(df).count() == 11


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf).cache()
        assert out.columns == docs.columns, name
        if name == "exact_dedup":
            assert out.count() == docs.select("text").distinct().count()
        if name == "near_dedup":
            given = [(r.doc_id, r.text) for r in docs.collect()]
            assert {r.doc_id for r in out.collect()} == {i for i, _, c in brute_components(given, 5, 80) if i == c} | {i for i, t in given if not words_of(t)}
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()
