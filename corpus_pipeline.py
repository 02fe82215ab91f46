"""A corpus pipeline of five stages: toxicity, exact dedup, near dedup, mixing and SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the
next stage. All but the last return the columns of documents.

Defined cases, for all stages: an empty table gives an empty one; null texts count as empty; rows with a null doc_id are
rows like others (they are not learnt from, and sort last); extra columns, whatever they are called, are carried on by
all stages but the last; a text is taken whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from locusweave.llm import exact_dedup, minhash_dedup, sentencepiece_codec, source_mix, toxicity
from locusweave.llm.common import drop_tables, read_table, saved, written
from locusweave.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from all labelled documents given to this stage.

    Without labels of both kinds nothing is rejected; rows of equal text stay or go together.
    """
    return toxicity.reject(docs, read_table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest doc_id; of rows that repeat id and text one. Empty texts are one group."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more on runs of five words: the least doc_id.

    Texts without words are linked with nothing; shorter texts are one run.
    """
    return minhash_dedup.dedup(docs, words=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, 0 to 2 times. Texts without words have size 0; if all have, none is taken. Null sources are one source."""
    return source_mix.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each text's ids and digest of what they decode to; the empty text has no ids."""
    return sentencepiece_codec.digests(docs, sentencepiece_codec.model_bytes(tokenizer_path()))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]

#: A trained classifier cannot be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    before = len(written)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_tables(spark, written[before:-1])  # what this stage needed, and what the one before returned
    return STAGES[-1][1](spark, docs, sf_dir)
