"""The corpus pipeline from end to end on small tables, against plain versions of its stages."""

import hashlib
import random

import corpus_pipeline
from locusweave.llm import sentencepiece_codec
from locusweave.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def ran(spark, folder, docs, labels=()):
    spark.createDataFrame(list(docs), DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), LABELS).write.parquet(f"{folder}/labels.parquet")
    return corpus_pipeline.run(spark, str(folder))


def test_empty_table(spark, tmp_path):
    out = ran(spark, tmp_path, [])
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == 0


def test_nulls_ties_and_copies(spark, tmp_path):
    rng = random.Random(1)
    words = lambda k: " ".join(random.Random(k).choices("abcdefghijklmnop", k=60))
    docs = [(k, words(k), "en", "s1", 1) for k in range(20)] + [(100 + k, words(k), "en", "s2", 1) for k in range(5)]
    near = words(3).split()
    near[-1] = "zz"
    docs += [(50, " ".join(near), "en", "s1", 1), (None, words(30), None, None, None), (60, None, None, None, None), (61, "", "en", "s1", 0), (7, words(7), "en", "s1", 1)]
    rng.shuffle(docs)
    got = [r.asDict() for r in ran(spark, tmp_path, docs).collect()]
    # Of equal texts the largest id stays, then of near ones the least; texts without words are taken 0 times or more.
    stays = {k for k in range(5, 20)} | {100, 101, 102, 104, 50, None}
    assert {r["doc_id"] for r in got if r["n_tokens"]} <= stays
    library = sentencepiece_codec.Encoder(sentencepiece_codec.model_bytes(tokenizer_path())).library
    texts = {d[0]: d[1] for d in docs}
    for r in got:
        ids = library.encode(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    # The mix takes 150 percent of all words, no document more than twice.
    taken, whole = sum(len((texts[r["doc_id"]] or "").split()) for r in got), sum(len(texts[k].split()) for k in stays)
    assert abs(taken - 1.5 * whole) <= 60 * 3 and max(sum(r["doc_id"] == k for r in got) for k in stays) <= 2


def test_only_null_ids_and_texts(spark, tmp_path):
    out = ran(spark, tmp_path, [(None, None, None, None, None)] * 3)
    assert out.count() == 0
