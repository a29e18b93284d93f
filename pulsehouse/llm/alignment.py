"""Alignment of two tokenizers over a corpus, with pair counts by external spill counting.

Tokenizer A is byte-level, B a SentencePiece model that adds a leading space; both
read space + text. Byte offsets where tokens of both end cut a text into groups; an
A and a B token whose byte ranges overlap are linked. How often two ids are linked in
the whole corpus is counted without a table of all pairs in memory:

1. every task cuts its documents, and each *flush* of up to ``FLUSH_RECORDS`` records
   (pair, document, links) is dealt by the low digit of the B id (a radix) into
   ``BUCKETS`` sorted zstd runs; a run's head has its pairs and their sums, its body
   the documents below each pair;
2. the heads of a bucket are counted by a k-way heap merge, ``FAN`` runs at a time
   and in as many levels as the number of runs needs; pairs are in B-major order, so
   the highest count of a B id is known when its last pair has passed;
3. the bodies stream past the bucket's counts and give, for each document of their
   flush, the sum of counts and the links of highest count; these are added up per
   flush. No document is ever grouped with all others of a pair.

Defined cases: a NULL or empty text, or one whose joined token bytes (A or B) differ
from space + text, has no tokens: zeros, and '' for the groups. Repeated rows are
documents of their own; NULL doc_ids stay. Long texts are cut before a blank between
two other characters, where no token of either side can cross (a text without such
places is encoded whole); other columns are not read.
"""
from __future__ import annotations

import functools
import hashlib
import heapq
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, written

BUCKETS = 64              # by the low digit of the B id; a power of two
FLUSH_RECORDS = 2_000_000  # (pair, document) records that one flush sorts at a time
FLUSH_DOCS = 1 << 14
FAN = 64                  # runs that one merge reads
MERGE_BLOCK = 1 << 14     # entries of a run that a merge holds decoded
PART_CHARS = 1 << 16      # longer texts are encoded in parts
BLOCK_BYTES = 1 << 20     # text aligned in one numpy pass
ID_BITS = 24              # ids of both sides are below 2**24
DOC_BITS = 16             # documents of a flush

RUNS = ("flush bigint, bucket int, n bigint, keys binary, sums binary, body binary, doc_id array<bigint>, "
        "n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, groups_sha256 array<string>")
RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
          "groups_sha256 string")

#: Characters on which the fast and the plain encoder of A split words alike.
_COMMON = re.compile(r"[^\t\n\r\x20-\x7e\xc0-\xff]")
_BLANK = re.compile(r"(?<=\S) (?=\S)")


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def parts(text: str, size: int | None = None) -> list[str]:
    """Space + text, cut into strings that each start with a blank and that both sides
    encode one by one: before a blank with no white space beside it."""
    size = size or PART_CHARS
    text = " " + text
    out, start = [], 0
    while len(text) - start > size:
        cut = _BLANK.search(text, start + size)
        if not cut:
            break
        out.append(text[start:cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def _byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, others for characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, the bytes of their tokens, and the alignment of texts."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        vocab = self.a.get_vocab(with_added_tokens=False)
        alphabet = _byte_alphabet()
        a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in vocab.items():
            a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        with open(a_path, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        self.fast = None
        if made == sorted(set(made)):     # a merge's rank is its id's: the same encoder from ranks
            ranks = {a_bytes[i]: i for i in [*(vocab[c] for c in alphabet), *made]}
            self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                           else piece.replace("▁", " ").encode())
        self.bytes = pa.array(a_bytes, pa.binary()), pa.array(b_bytes, pa.binary())
        self.size = [np.array([len(x) for x in t], np.int64) for t in (a_bytes, b_bytes)]
        na, nb = len(a_bytes), len(b_bytes)
        # group text: "id," inside a side, "id|" ends the A side, "id;" the B side
        self.label = pa.array([f"{i}{e}".encode() for n, ends in ((na, ",|"), (nb, ",;")) for e in ends
                               for i in range(n)], pa.binary())
        self.offsets = (0, na, 2 * na, 2 * na + nb)

    def encode(self, texts: list[str]) -> tuple[list, list]:
        """Ids of both sides of strings that start with a blank."""
        a: list = [None] * len(texts)
        odd = []
        for i, t in enumerate(texts):
            if self.fast is None or _COMMON.search(t):
                odd.append(i)
            else:
                a[i] = self.fast.encode_ordinary(t)
        for i, e in zip(odd, self.a.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False)):
            a[i] = e.ids
        return a, self.b.encode([t[1:] for t in texts], num_threads=1)

    def _joined(self, side: int, ids: np.ndarray) -> memoryview:
        got = self.bytes[side].take(pa.array(ids))
        return memoryview(got.buffers()[2] or b"").cast("B")[:int(self.size[side][ids].sum())]

    def align(self, texts: list[str]):
        """(same, n_a, n_b, n_groups, n_links, groups): one entry per string; and per link
        its string and pair. ``same`` tells whether both sides spell the string; strings
        that differ have no tokens. ``groups`` are texts that end in ';'."""
        a, b = self.encode(texts)
        raw = [t.encode() for t in texts]
        length = np.array([len(r) for r in raw], np.int64)
        ids = [[np.array(x, np.int64) for x in side] for side in (a, b)]
        flat = [np.concatenate([*s, np.empty(0, np.int64)]) for s in ids]
        whole = b"".join(raw)
        same = np.ones(len(texts), bool)
        if any(self._joined(k, flat[k]) != whole for k in (0, 1)):
            same = np.array([all(self._joined(k, ids[k][i]) == raw[i] for k in (0, 1)) for i in range(len(texts))])
            flat = [np.concatenate([*(x for x, ok in zip(s, same) if ok), np.empty(0, np.int64)]) for s in ids]
            length = np.where(same, length, 0)
        ends = [np.cumsum(self.size[k][flat[k]]) for k in (0, 1)]
        last = np.cumsum(length)
        cut = np.concatenate(ends)
        cut.sort(kind="stable")
        cut = cut[np.append(True, cut[1:] != cut[:-1])] if len(cut) else cut   # each piece between cuts is one link
        at = [np.searchsorted(e, cut) for e in ends]
        both = (ends[0][at[0]] == cut) & (ends[1][at[1]] == cut)
        stop = cut[both]
        n = len(texts)

        def per_text(points):
            return np.bincount(np.searchsorted(last, points), minlength=n)
        # group text: the A tokens of a group, then its B tokens
        closes = [np.searchsorted(e, stop) for e in ends]        # last token of each group, per side
        group = [np.searchsorted(stop, e) for e in ends]
        labels = np.empty(len(flat[0]) + len(flat[1]), np.int64)
        b_before = np.append(0, closes[1] + 1)[group[0]]
        labels[np.arange(len(flat[0])) + b_before] = flat[0] + np.where(np.isin(ends[0], stop), self.offsets[1], 0)
        a_before = (closes[0] + 1)[group[1]]
        labels[np.arange(len(flat[1])) + a_before] = flat[1] + np.where(
            np.isin(ends[1], stop), self.offsets[3], self.offsets[2])
        text = self.label.take(pa.array(labels))
        counts = per_text(ends[0]), per_text(ends[1])
        where = np.append(0, np.cumsum(counts[0] + counts[1]))
        offsets = np.frombuffer(text.buffers()[1], np.int32)[where] if len(text) else np.zeros(n + 1, np.int32)
        data = memoryview(text.buffers()[2] or b"")
        groups = [data[i:j] for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        owner = np.searchsorted(last, cut)
        return (same, *counts, per_text(stop), np.bincount(owner, minlength=n), groups,
                owner, flat[0][at[0]], flat[1][at[1]])


@functools.lru_cache(maxsize=2)
def pair(a_path: str, b_path: str) -> Pair:
    """One pair of tokenizers per worker process."""
    return Pair(a_path, b_path)


def squeeze(values: np.ndarray) -> bytes:
    """zstd over the byte planes of an array of unsigned integers."""
    import zstandard
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(raw: bytes, dtype: str) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)


def _rise(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


def _first(sorted_values: np.ndarray) -> np.ndarray:
    """Positions where a new value begins."""
    return np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1])) if len(sorted_values) \
        else np.empty(0, np.int64)


class Flush:
    """Records and figures of some documents, written out as runs by bucket."""

    def __init__(self):
        self.records: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0
        self.docs: list[list] = []

    def links(self, doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Links of one pass (documents by their place in the flush), counted per pair and document."""
        digit = int(BUCKETS).bit_length() - 1
        major = ((b & (BUCKETS - 1)) << (ID_BITS - digit)) | (b >> digit)
        code = (major.astype(np.uint64) << np.uint64(ID_BITS + DOC_BITS)) | (
            a.astype(np.uint64) << np.uint64(DOC_BITS)) | doc.astype(np.uint64)
        code.sort()
        first = _first(code)
        self.records.append((code[first], np.diff(np.append(first, len(code)))))
        self.held += len(first)

    def rows(self, flush: int):
        """The run of every bucket, then the row of figures."""
        code = np.concatenate([np.empty(0, np.uint64), *(c for c, _ in self.records)])
        n = np.concatenate([np.empty(0, np.int64), *(k for _, k in self.records)])
        void = np.array([not d[-1] for d in self.docs])
        good = ~void[(code & np.uint64((1 << DOC_BITS) - 1)).astype(np.int64)] if len(code) else np.empty(0, bool)
        code, n = code[good], n[good]
        order = np.argsort(code, kind="stable")
        code, n = code[order], n[order]
        high = np.uint64(2 * ID_BITS + DOC_BITS - (int(BUCKETS).bit_length() - 1))
        bucket = (code >> high).astype(np.int64)
        begin = np.searchsorted(bucket, np.arange(BUCKETS + 1))
        none = [[]] * 6
        for k in range(BUCKETS):
            c, m = code[begin[k]:begin[k + 1]], n[begin[k]:begin[k + 1]]
            if not len(c):
                continue
            key = c >> np.uint64(DOC_BITS)
            first = _first(key)
            docs = (c & np.uint64((1 << DOC_BITS) - 1)).astype(np.uint16)
            below = np.diff(np.append(first, len(c))).astype(np.uint32)
            body = [squeeze(below), squeeze(docs), squeeze(m.astype(np.uint32))]
            head = np.array([len(x) for x in body], "<u4").tobytes()
            yield _row([flush, k, len(c), squeeze(_rise(key[first])), squeeze(np.add.reduceat(m, first).astype(np.uint64)),
                        head + b"".join(body), *none])
        columns = [list(c) for c in zip(*[d[:6] for d in self.docs])] or none
        yield _row([flush, -1, 0, None, None, None, *columns])


_ARROW = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(),
          *[pa.list_(pa.int64())] * 5, pa.list_(pa.string())]


def _row(values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _ARROW)],
                                      [x.split()[0] for x in RUNS.split(", ")])


def runs(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The runs and figures of all documents (``RUNS``; figures have bucket -1)."""
    records, size = FLUSH_RECORDS, PART_CHARS

    def run(batches):
        both = pair(a_path, b_path)
        flush, serial = Flush(), TaskContext.get().partitionId() << 24
        sha: dict[int, object] = {}

        def take(todo):
            """Align (document, string) pairs and add them up."""
            same, n_a, n_b, n_groups, n_links, groups, owner, a, b = both.align([t for _, t in todo])
            doc = np.array([d for d, _ in todo], np.int64)
            flush.links(doc[owner], a, b)
            for i, d in enumerate(doc.tolist()):
                row = flush.docs[d]
                row[6] = row[6] and bool(same[i])
                if not len(groups[i]):
                    continue
                if d in sha:
                    sha[d].update(b";")
                else:
                    sha[d] = hashlib.sha256()
                sha[d].update(groups[i][:-1])
                for k, v in zip((1, 2, 3, 4), (n_a, n_b, n_groups, n_links)):
                    row[k] += int(v[i])

        def close():
            for d, row in enumerate(flush.docs):
                if row[6] and d in sha:
                    row[5] = sha[d].hexdigest()
                if not row[6]:
                    row[1:5] = [0] * 4
            sha.clear()
        for s in slices(batches, 1):
            todo, held = [], 0
            for key, text in zip(s.column(0).to_pylist(), s.column(1).to_pylist()):
                d = len(flush.docs)
                flush.docs.append([key, 0, 0, 0, 0, "", True])
                for p in parts(text, size) if text else []:
                    todo.append((d, p))
                    held += len(p)
                    if held >= BLOCK_BYTES:
                        take(todo)
                        todo, held = [], 0
            if todo:
                take(todo)
            if flush.held >= records or len(flush.docs) >= FLUSH_DOCS:
                close()
                yield from flush.rows(serial)
                flush, serial = Flush(), serial + 1
        if flush.docs:
            close()
            yield from flush.rows(serial)
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, RUNS)


def merge(heads: list[tuple[np.ndarray, np.ndarray]], block: int | None = None):
    """K-way heap merge of sorted (keys, sums) runs: yields blocks of distinct keys, ascending,
    with their total sums. The heap orders runs by their next key; a step takes from each what is
    not above the least end of the blocks in hand, so no key is met again later."""
    block = block or MERGE_BLOCK
    heap = [(int(k[0]), i, 0) for i, (k, _) in enumerate(heads) if len(k)]
    heapq.heapify(heap)
    while heap:
        limit = min(int(heads[i][0][min(at + block, len(heads[i][0])) - 1]) for _, i, at in heap)
        keys, sums = [], []
        while heap and heap[0][0] <= limit:
            _, i, at = heapq.heappop(heap)
            k, s = heads[i]
            end = at + int(np.searchsorted(k[at:at + block], np.uint64(limit), "right"))
            keys.append(k[at:end])
            sums.append(s[at:end])
            if end < len(k):
                heapq.heappush(heap, (int(k[end]), i, end))
        key, total = np.concatenate(keys), np.concatenate(sums)
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = _first(key)
        yield key[first], np.add.reduceat(total[order], first)


def _counted(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    heads = [(np.cumsum(unsqueeze(k, "<u8"), dtype=np.uint64), unsqueeze(s, "<u8"))
             for k, s in zip(table.column("keys").to_pylist(), table.column("sums").to_pylist())]
    blocks = list(merge(heads))
    keys = np.concatenate([b[0] for b in blocks])
    sums = np.concatenate([b[1] for b in blocks])
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "run": pa.array([key[1].as_py()], pa.int64()),
                     "keys": pa.array([squeeze(_rise(keys))], pa.binary()), "sums": pa.array([squeeze(sums)], pa.binary())})


def counts(table: DataFrame, n_flushes: int) -> DataFrame:
    """bucket, run, keys, sums: one row per bucket with the counts of all its pairs."""
    heads = table.where("bucket >= 0").select("bucket", F.xxhash64("flush").alias("run"), "keys", "sums")
    n = n_flushes
    while True:
        n = -(-n // FAN)
        heads = heads.withColumn("run", F.pmod(F.xxhash64("run"), F.lit(max(1, n)).cast("bigint"))).groupBy(
            "bucket", "run").applyInArrow(_counted, "bucket int, run bigint, keys binary, sums binary")
        if n <= 1:
            return heads


def _best(keys: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Whether a pair has its B id's highest count (keys are B-major)."""
    first = _first(keys >> np.uint64(ID_BITS))
    most = np.maximum.reduceat(sums, first) if len(first) else sums
    return sums == np.repeat(most, np.diff(np.append(first, len(keys))))


def contributions(table: DataFrame, counted: DataFrame, n_flushes: int) -> DataFrame:
    """flush, sums, best: per run, the sum of counts and the best links of each document of its flush."""
    salts = max(1, -(-n_flushes // FAN))
    salt = F.pmod(F.xxhash64("flush"), F.lit(salts).cast("bigint"))
    bodies = table.where("bucket >= 0").select("bucket", salt.alias("salt"), "flush", "keys", "sums", "body")
    totals = counted.select("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))),
                            F.lit(None).cast("bigint"), "keys", "sums", F.lit(None).cast("binary"))
    rows = totals.union(bodies).toDF("bucket", "salt", "flush", "keys", "sums", "body")

    def run(batches):
        have = None
        for b in batches:
            for flush, keys, sums, body in zip(*[b.column(i).to_pylist() for i in range(2, 6)]):
                key = np.cumsum(unsqueeze(keys, "<u8"), dtype=np.uint64)
                if flush is None:
                    total = unsqueeze(sums, "<u8")
                    have = key, total, _best(key, total)
                    continue
                at = np.searchsorted(have[0], key)
                size = np.frombuffer(body[:12], "<u4")
                cuts = [12, *(12 + np.cumsum(size)).tolist()]
                below, docs, n = [unsqueeze(body[i:j], t) for i, j, t in zip(cuts, cuts[1:], ("<u4", "<u2", "<u4"))]
                at = np.repeat(at, below)
                n = n.astype(np.uint64)
                out = np.zeros((2, int(docs.max()) + 1), np.uint64)
                np.add.at(out[0], docs, have[1][at] * n)
                np.add.at(out[1], docs, np.where(have[2][at], n, np.uint64(0)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([flush], pa.int64()), *[pa.array([squeeze(x)], pa.binary()) for x in out]],
                    ["flush", "sums", "best"])
    placed = rows.repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", F.col("flush").asc_nulls_first())
    return placed.mapInArrow(run, "flush bigint, sums binary, best binary")


_FIGURES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _documents(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The documents of one flush: their figures, and all contributions added up."""
    figures = table.filter(pa.array([x is None for x in table.column("sums").to_pylist()])).to_pylist()[0]
    n = len(figures["doc_id"])
    total = np.zeros((2, n), np.uint64)
    for pair_ in zip(table.column("sums").to_pylist(), table.column("best").to_pylist()):
        for k, raw in enumerate(pair_):
            if raw is not None:
                part = unsqueeze(raw, "<u8")
                total[k, :len(part)] += part
    cols = {c: pa.array(figures[c], pa.string() if c == "groups_sha256" else pa.int64()) for c in _FIGURES}
    cols["n_best"] = pa.array(total[1].astype(np.int64))
    cols["count_sum"] = pa.array(total[0].astype(np.int64))
    return pa.table([cols[c.split()[0]] for c in RESULT.split(", ")], [c.split()[0] for c in RESULT.split(", ")])


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document (``RESULT``)."""
    table = written(runs(docs, a_path, b_path), "alignment-runs", "none")
    n_flushes = table.where("bucket < 0").count()
    gains = contributions(table, counts(table, n_flushes), n_flushes)
    figures = table.where("bucket < 0").select("flush", *_FIGURES)
    empty = [F.lit(None).cast("string" if c == "groups_sha256" else "bigint") for c in _FIGURES]
    gains = gains.select("flush", *[F.array(e).alias(c) for e, c in zip(empty, _FIGURES)], "sums", "best")
    figures = figures.withColumns({"sums": F.lit(None).cast("binary"), "best": F.lit(None).cast("binary")})
    return figures.union(gains).groupBy("flush").applyInArrow(_documents, RESULT)


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """a_id, b_id, n (links), best (has its B id's highest count) over all documents."""
    table = written(runs(docs, a_path, b_path), "alignment-runs", "none")

    def run(batches):
        digit = int(BUCKETS).bit_length() - 1
        for batch in batches:
            for bucket, keys, sums in zip(*[batch.column(c).to_pylist() for c in ("bucket", "keys", "sums")]):
                key, total = np.cumsum(unsqueeze(keys, "<u8"), dtype=np.uint64), unsqueeze(sums, "<u8")
                major = (key >> np.uint64(ID_BITS)).astype(np.int64) & ((1 << (ID_BITS - digit)) - 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array((key & np.uint64((1 << ID_BITS) - 1)).astype(np.int64)),
                    pa.array((major << digit) | bucket), pa.array(total.astype(np.int64)), pa.array(_best(key, total))],
                    ["a_id", "b_id", "n", "best"])
    return counts(table, table.where("bucket < 0").count()).mapInArrow(
        run, "a_id bigint, b_id bigint, n bigint, best boolean")


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return align(docs, *tokenizer_paths())
