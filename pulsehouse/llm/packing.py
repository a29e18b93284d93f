"""Packing token ids into sequences by Karmarkar-Karp multiway differencing.

Each document's ids (end id included) are cut into pieces of ``WINDOW`` ids,
sequences by themselves, and the remainder into pieces of at most ``PIECE``
ids, so that a window holds several and differencing can level it. These are
dealt by hash to groups of about ``GROUP_WINDOWS`` windows; each group is
partitioned into near-equal windows by differencing: a partial partition is a
vector of window sums, and the two partial partitions of the largest spread
are merged with opposing imbalances, the largest window of one onto the
smallest of the other. If a window then exceeds the capacity, the group is
partitioned anew with one window more.

Defined cases: NULL text is empty; an empty document is one piece holding the
end id; repeated rows are packed one by one. Every piece is in one sequence,
offsets in a sequence have no gaps.
"""
from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_caches, slices, written_in_parts
from .tokens import encoder

WINDOW = 1024
PIECE = 256
END_ID = 0
GROUP_WINDOWS = 256
CACHE_ENTRIES = 1_500_000      # texts between spaces kept per worker (about 300 MB)
PIECES = "piece bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary"
PACKED = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, piece bigint"


def byte_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, piece: int = PIECE,
           end_id: int = END_ID, with_ids: bool = True, cache_entries: int = CACHE_ENTRIES,
           keep_cache: bool = True) -> DataFrame:
    """All pieces with their ids (unsigned 32-bit little-endian; or without, where only the
    packing is wanted); ``piece`` numbers them. Without ``keep_cache`` a worker gives its
    tokenizer and word cache back at the end of each task."""
    tokenizer = tokenizer or byte_tokenizer()
    width = 7 if with_ids else 6

    def run(batches):
        drop_caches("tokens")
        enc = encoder(tokenizer, cache_entries)
        number = TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()
        for s in slices(batches, 1):
            rows: list[list] = [[] for _ in range(7)]
            for key, raw in zip(s.column(0).to_pylist(), enc.encode(s.column(1).to_pylist())):
                ids = np.frombuffer(raw, enc.dtype).astype("<u4").tobytes() + end
                whole = len(ids) - len(ids) % (4 * window)
                cuts = [*range(0, whole, 4 * window), *range(whole, len(ids), 4 * piece), len(ids)]
                for start, stop in zip(cuts, cuts[1:]):
                    cut = ids[start:stop]
                    for col, v in zip(rows, (number, key, start // 4, len(cut) // 4, zlib.crc32(cut),
                                             len(ids) // 4, cut)[:width]):
                        col.append(v)
                    number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if i == 6 else pa.int64()) for i, c in enumerate(rows[:width])],
                [x.split()[0] for x in columns])
        if not keep_cache:
            del enc
            drop_caches()
    columns = PIECES.split(", ")[:width]
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, ", ".join(columns))


def difference(lengths: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Window of each item among k, by multiway differencing; and the largest window.

    A partial partition holds the negated sums of its windows in use, largest window first,
    and the set of items in each; the other windows are empty."""
    n = len(lengths)
    left, right = [], []          # inner nodes n, n+1, ...: two sets of items put in one window
    order = np.argsort(-lengths, kind="stable")
    heap = [(-v if k > 1 else 0, at, np.array([-v]), np.array([i])) for at, (i, v) in enumerate(
        zip(order.tolist(), lengths[order].tolist()))]     # in the heap's order
    serial = len(heap)
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        shared = max(0, len(a) + len(b) - k)
        if shared:
            at = len(a) - shared
            b, y = b[::-1], y[::-1]
            left.append(x[at:])
            right.append(y[:shared])
            a, x = (np.concatenate([a[:at], a[at:] + b[:shared], b[shared:]]),
                    np.concatenate([x[:at], np.arange(n, n + shared), y[shared:]]))
            n += shared
            in_order = False
        else:
            in_order = len(b) == 1 and a[-1] <= b[0]
            a, x = np.concatenate([a, b[::-1]]), np.concatenate([x, y[::-1]])
        if not in_order:
            order = a.argsort(kind="stable")
            a, x = a[order], x[order]
        heapq.heappush(heap, (int(a[0] - a[-1]) if len(a) == k else int(a[0]), serial, a, x))
        serial += 1
    _, _, sums, sets = heap[0]
    owner = np.full(n, -1, np.int64)
    owner[sets] = np.arange(len(sets))
    base = n
    for lo, hi in zip(reversed(left), reversed(right)):   # parents come after their children
        base -= len(lo)
        up = owner[base:base + len(lo)]
        owner[lo], owner[hi] = up, up
    return owner[:len(lengths)], -int(sums[0])


def windows(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item: as few near-equal windows as differencing can keep within capacity."""
    k = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        owner, most = difference(lengths, k)
        if most <= capacity:
            return owner
        k += 1


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces (a written table) -> their columns without ids, + sequence_id, offset."""
    meta = cut.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece")
    full = meta.where(F.col("length") == window).withColumns(
        {"sequence_id": F.col("piece"), "offset": F.lit(0).cast("bigint")})
    rest = meta.where(F.col("length") < window)
    total = rest.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // (window * GROUP_WINDOWS)))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")
        n = np.asarray(table.column("length"), np.int64)
        owner = windows(n, window)
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(n[order])
        first = np.append(True, owner[order][1:] != owner[order][:-1])
        begin = ends - n[order]
        offset = np.empty_like(n)
        offset[order] = begin - np.maximum.accumulate(np.where(first, begin, 0))
        seq = (1 << 62) | (key[0].as_py() << 24) | owner
        return table.drop_columns(["grp"]).append_column("sequence_id", pa.array(seq, pa.int64())).append_column(
            "offset", pa.array(offset, pa.int64()))
    dealt = rest.withColumn("grp", F.pmod(F.xxhash64("piece"), F.lit(groups)))
    packed = dealt.groupBy("grp").applyInArrow(run, f"{PACKED}, sequence_id bigint, offset bigint")
    return full.unionByName(packed)


def sequences(cut: DataFrame, packed: DataFrame) -> DataFrame:
    """sequence_id, ids (unpadded): the packed ids themselves, at most WINDOW per row."""
    rows = packed.select("sequence_id", "offset", "piece").join(cut.select("piece", "ids"), "piece")
    return rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def query(spark, docs: DataFrame, cache_entries: int = CACHE_ENTRIES, keep_cache: bool = True) -> DataFrame:
    cut = pieces(docs, with_ids=False, cache_entries=cache_entries, keep_cache=keep_cache)
    return pack(written_in_parts(cut, "pieces")).drop("piece")
