"""Token ids written as binary files: frequency-ranked, byte-aligned variable-length codes.

File format (a folder):

* ``dictionary/`` (Parquet: rank, id, count): rank 0 is the most frequent id of
  the corpus, ties by id.
* ``blocks/`` (Parquet, one row per block of about ``BLOCK_IDS`` ids, documents
  whole and in ascending order of doc_id): ``part, block`` (order of blocks),
  ``part_start`` (ids before the block in its part), ``doc_ids`` (array),
  ``lengths`` (ids per document, end id included), ``control``, ``data``.

A rank is stored in 1 to 4 little-endian bytes of ``data``; its length minus
one is a 2-bit field of ``control``, four to a byte, lowest bits first. The
two streams are apart, so a control byte looks up the lengths of four codes in
a 256-row table and numpy gathers all codes at once.

Defined cases: NULL text is empty; every document ends with the end id, so an
empty one has one id; NULL doc_ids come first; equal doc_ids are ordered by
their ids. Documents of any length stay whole, a block then is longer.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import slices, written
from .tokens import encoder

END_ID = 2
BLOCK_IDS = 1 << 16


def word_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def encode_ids(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, ids (unsigned 32-bit little-endian if the vocabulary needs it, else 16-bit)."""
    def run(batches):
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        for s in slices(batches, 1):
            ids = [x + end for x in enc.encode(s.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([s.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, ids binary")


def id_counts(tokens: DataFrame, dtype: str, size: int) -> DataFrame:
    """id, count over all documents; each task counts before the shuffle."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), dtype), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], ["id", "count"])
    return tokens.select("ids").mapInArrow(run, "id bigint, count bigint").groupBy("id").agg(
        F.sum("count").alias("count"))


def encode_block(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit ranks."""
    n = len(ranks)
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-n // 4) * 4, np.uint8)
    codes[:n] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    raw = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), raw[np.arange(4) < size[:, None]].tobytes()


#: control byte -> lengths of its four codes
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def decode_block(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n ranks of a block, by table lookup and four gathers."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = size > k
        if longer.any():
            out[longer] |= raw[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


BLOCKS = ("part int, block int, part_start bigint, n_ids bigint, doc_ids array<bigint>, "
          "lengths array<bigint>, control binary, data binary")


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode all documents and write the folder described above."""
    tokenizer = tokenizer or word_tokenizer()
    enc = encoder(tokenizer)
    dtype, size = enc.dtype.str, max(enc.size, end_id + 1)
    tokens = written(encode_ids(docs, tokenizer, end_id), "token-ids")
    ranked = id_counts(tokens, dtype, size).withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("count").desc(), "id")) - 1)
    ranked.select("rank", "id", "count").write.parquet(f"{path}/dictionary")
    by_rank = dictionary(docs.sparkSession, path)
    rank_of = np.zeros(size, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)

    def run(batches):
        part = TaskContext.get().partitionId()
        state = {"block": 0, "start": 0}

        def block(keys, ids):
            lengths = [len(x) // np.dtype(dtype).itemsize for x in ids]
            control, data = encode_block(rank_of[np.frombuffer(b"".join(ids), dtype)])
            n = sum(lengths)
            row = [[part], [state["block"]], [state["start"]], [n], [keys], [lengths], [control], [data]]
            state["block"] += 1
            state["start"] += n
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (
                pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                pa.binary(), pa.binary()))], [x.split()[0] for x in BLOCKS.split(", ")])
        keys, ids, held = [], [], 0
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                keys.append(k)
                ids.append(x)
                held += len(x)
                if held >= BLOCK_IDS * np.dtype(dtype).itemsize:
                    yield block(keys, ids)
                    keys, ids, held = [], [], 0
        if keys:
            yield block(keys, ids)
    ordered = tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def dictionary(spark: SparkSession, path: str) -> np.ndarray:
    """The ids by rank; at most as many as the vocabulary has."""
    rows = spark.read.parquet(f"{path}/dictionary").select("rank", "id").collect()
    out = np.zeros(len(rows), np.uint32)
    for r in rows:
        out[r["rank"]] = r["id"]
    return out


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with the number of ids before them."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # one row per part (as many as the writing shuffle had partitions)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(parts), "part").select(
        (F.col("base") + F.col("part_start")).alias("start"), "doc_ids", "lengths", "control", "data")


def _decoder(by_rank: np.ndarray):
    def run(batches):
        for b in batches:
            for start, keys, lengths, control, data in zip(*[c.to_pylist() for c in b.columns]):
                ids = by_rank[decode_block(control, data, sum(lengths))].astype("<u4")
                ends = np.cumsum(lengths)
                raw = [ids[e - n:e].tobytes() for e, n in zip(ends.tolist(), lengths)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, pa.int64()), pa.array(start + ends - np.array(lengths), pa.int64()),
                    pa.array(raw, pa.binary())], ["doc_id", "start", "ids"])
    return run


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), ids (unsigned 32-bit little-endian)."""
    return _placed(spark, path).mapInArrow(_decoder(dictionary(spark, path)), "doc_id bigint, start bigint, ids binary")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what :func:`read` gives, worked out where it is decoded."""
    decode = _decoder(dictionary(spark, path))

    def run(batches):
        for b in decode(batches):
            ids = b.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([zlib.crc32(x) for x in ids], pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
    return _placed(spark, path).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def query(spark, docs: DataFrame) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write(docs, path)
    return read_digests(spark, path)
