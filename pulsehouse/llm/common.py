"""Helpers shared by the training-data operators."""
from __future__ import annotations

import ctypes
import os
import shutil
import sys
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import conf_during, scratch_path

#: A word: a run of characters other than space and \t \n \v \f \r (Java and RE2 syntax).
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str, codec: str = "zstd", parts: int | None = None) -> DataFrame:
    """Write a frame once to the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can reach; a lost executor
    never forces the stages before this point to run again. ``parts``: the most
    files to write, for a frame whose last stage reads a shuffle (with a number
    that grows with the input, so that no task's share does).
    """
    if parts:
        df = df.coalesce(parts)
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


ARROW_ROWS = 512            # rows with texts that go to a Python worker at a time


def written_in_parts(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """:func:`written`, with few rows of texts at a time on the way to the Python workers."""
    with conf_during(df.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=str(ARROW_ROWS)):
        return written(df, name, parts=parts)


def forget(df: DataFrame) -> None:
    """Delete the folder of a frame that :func:`written` returned and nothing will read again."""
    sc = df.sparkSession.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(df.written_at)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the
    body (or a lambda in it) refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


SLICE_ROWS = 256
SLICE_BYTES = 1 << 20


def slices(batches, column: int):
    """Cut Arrow batches into parts of at most SLICE_ROWS rows and about SLICE_BYTES of the
    (string or binary) column, one row at least: what numpy holds at a time stays small."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy().astype(np.int64))
        at = 0
        while at < b.num_rows:
            before = size[at - 1] if at else 0
            end = int(np.searchsorted(size, before + SLICE_BYTES, "right"))
            end = min(max(end, at + 1), at + SLICE_ROWS, b.num_rows)
            yield b.slice(at, end - at)
            at = end


def drop_caches(but: str = "") -> None:
    """Empty the token and word caches that tasks of other operators left in this worker (a reused
    worker keeps them, up to some hundred megabytes) and give freed memory back to the system."""
    for module, clear in (("tokens", lambda m: m.encoder.cache_clear()), ("alignment", lambda m: m.pair.cache_clear()),
                          ("quality_classifier", lambda m: m._WORDS.clear())):
        loaded = sys.modules.get(f"{__package__}.{module}")
        if loaded and module != but:
            clear(loaded)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim:
        trim(0)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark application: tasks import
    their functions by name, so that a reused worker keeps its caches."""
    sc = spark.sparkContext
    if getattr(sc, "_pulsehouse_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="pulsehouse-code-")   # on the driver: Spark copies it to the executors
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "pulsehouse"), "zip", os.path.dirname(package), "pulsehouse"))
    sc._pulsehouse_shipped = True


BITMAP_BITS = 23


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size (2**17 words, one megabyte) over the low bits of 64-bit hashes."""
    low = F.col(column).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    bit = F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))")
    words = keys.groupBy(F.shiftright(low, 6).alias("w")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    table[words.column(0).to_numpy()] = words.column(1).to_numpy()
    return table


def in_bitmap(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    word = table[(keys & ((1 << BITMAP_BITS) - 1)) >> 6]
    return (word >> (keys & 63)) & 1 == 1


def bitmap_filter(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose first column (a hash) may be among the keys: spares a join most of the other
    rows while keys are few; with very many keys it lets all through, and the join decides."""
    have = rows.sparkSession.sparkContext.broadcast(bitmap(keys, keys.columns[0]))

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(in_bitmap(have.value, np.asarray(b.column(0), np.int64))))
    return rows.mapInArrow(run, rows.schema)
