"""Helpers shared by the text operators: scratch tables, word splitting, counting.

Words are maximal runs of anything but space and the control characters 9 to 13; only A-Z are lower-cased.
"""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import tempfile
import types
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
WHITE_CLASS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs_on_executors(module: str) -> None:
    """Send the functions of a module with the tasks, so that executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def give_back_memory() -> None:
    """After a training or a task: return freed memory to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def kept_by_worker(kind: str, key, make):
    """make(), remembered by this Python process for later tasks with the same key; one value of each kind."""
    held = sys.modules.setdefault("_locusweave_kept", types.ModuleType("_locusweave_kept")).__dict__
    if kind not in held or held[kind][0] != key:
        held[kind] = (key, make())
    return held[kind][1]


#: Bytes of an Arrow batch on its way to a Python worker.
BATCH_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """df; its session sends Python workers batches of at most BATCH_BYTES from now on, so that memory follows bytes, not rows."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    told = str(conf.get(key)).rstrip("b")
    if not told.isdigit() or int(told) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it differ from all columns of df."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, or a fresh local folder when Spark is local."""
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if told:
        return told
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    told = "file://" + tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(told)
    return told


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again.

    This cuts the lineage: a lost executor costs only the tasks that read the table. The files go when the
    session's file system closes, or when drop_tables is called.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/locusweave/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    written.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Paths of the intermediate tables that `saved` has written and nobody has dropped.
written: list[str] = []


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate tables that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        written.remove(path)


#: A saved table goes to all tasks if its rows take at most so many bytes in memory, else it is joined by a shuffle.
BROADCAST_BYTES = 48 << 20
#: Bytes of a row in a broadcast besides its strings: the row's own, and of each column.
ROW_BYTES, COLUMN_BYTES = 32, 16


def broadcast_if_small(keys: DataFrame) -> DataFrame:
    """keys, a saved table, marked for a broadcast if its rows, strings included, take at most BROADCAST_BYTES."""
    strings = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in keys.schema.fields if f.dataType.typeName() in ("string", "binary")]
    each = sum(strings, F.lit(ROW_BYTES + COLUMN_BYTES * len(keys.columns))).cast("long")
    most = BROADCAST_BYTES // (ROW_BYTES + COLUMN_BYTES * len(keys.columns)) + 1
    taken = keys.select(each.alias("bytes")).limit(most).agg(F.sum("bytes")).first()[0] or 0
    return F.broadcast(keys) if taken <= BROADCAST_BYTES else keys


#: Most keys that go to all tasks because they have many rows, and the least number of rows for that.
HOT_KEYS, HOT_ROWS = 50_000, 1_000


def join_hot(rows: DataFrame, table: DataFrame, key: str | list[str], size: str) -> DataFrame:
    """rows joined with a saved table that has a row for each key and, in column `size`, about how many rows the key has.

    Keys with many rows are joined by a broadcast, so that none of them fills a task; they are so chosen that there are
    HOT_KEYS at most.
    """
    key = [key] if isinstance(key, str) else key
    total = table.agg(F.sum(size)).first()[0] or 0
    many = F.col(size) >= max(HOT_ROWS, total // HOT_KEYS)
    hot = table.where(many)
    if hot.isEmpty():
        return rows.join(table, key)
    rest = rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(table.where(~many), key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def text_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def rows_of_pairs(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """docs without the rows of pairs that are not kept, and with one row of each pair that is.

    pairs(doc_id, text_sha256, kept), saved: pairs that lose rows; the rows of all others stay. Of the rows of a pair
    the one with the least hash of all columns stays; tasks settle their own rows before any are moved. The columns of
    docs may have any names.
    """
    key, sha, whole = unused(docs, "key", "sha", "whole")
    keys = [F.col("doc_id").alias(key), F.col("text_sha256").alias(sha)]
    mine = docs["doc_id"].eqNullSafe(F.col(key)) & (text_digest(docs["text"]) == F.col(sha))
    again = pairs.where("kept").select(*keys)
    out = docs.join(broadcast_if_small(pairs.select(*keys)), mine, "left_anti")
    if again.isEmpty():
        return out
    twice = docs.join(broadcast_if_small(again), mine)
    row = [docs[c] for c in docs.columns]
    one = twice.groupBy(key, sha).agg(F.min_by(F.struct(*row), F.xxhash64(*row)).alias(whole))
    return out.unionByName(one.select(f"{whole}.*"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null, empty and blank texts."""
    core = F.btrim(text, F.lit(WHITE))
    return F.when(core.isNull() | (core == ""), F.lit(0)).otherwise(F.size(F.split(core, WHITE_CLASS, -1))).cast("long")


runs_on_executors(__name__)
