"""Exact substring deduplication: every byte covered by a LENGTH-byte string that
starts at two or more places of the corpus goes.

1. Anchors. Each LENGTH-byte window has an anchor, its GRAM-byte string of least
   hash (the leftmost of equals): a matter of the window's content alone, so
   equal windows have equal anchors at the same offset. Windows of a document
   with the same anchor and the same block of offsets form a *region*; the
   bytes they all share are its *core*. Equal windows lie in regions of equal
   core, so regions are dealt by the core's hash: no other pairs need to meet.
2. Copies. Regions equal in all bytes are recognised by hash, first within a
   task and then in the core's bucket; all their windows recur. A core with
   EARLY or more kinds of regions in one task is known to be a shared one: its
   regions there go straight to step 3, and its bucket gets one mark in their
   place, so that no bucket grows with the documents that hold a passage.
3. Suffix arrays. Where a core has different regions, the regions' bytes are
   fetched and one suffix array over them is built by linear grouping
   (:mod:`suffix_array`); windows with an equal neighbour among the core's
   windows recur.
4. Removal. Each document's recurring starts come together, every start covers
   LENGTH bytes, and the rest is kept.

A core with more than GROUP different regions (a passage in very many texts,
seen at its edges) would outgrow a task. Its regions are split into blocks of
FINE offsets, which have longer cores of their own, and steps 2 and 3 run on
these. What still shares such a core in more than GROUP kinds is the one block
at the passage's very edge: its windows are dealt by their own content, and those
of equal content recur.

Defined cases: NULL text is empty; a text shorter than LENGTH loses nothing;
rows that repeat lose all windows, as each has a copy; bytes are those of the
UTF-8 text. Documents must come from a table (or any plan that gives the same
rows whenever it is run).
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap_filter, drop_caches, shuffle_partitions, slices, written
from .shingles import U, byte_sums, mix, string_hash
from .suffix_array import suffix_array

LENGTH = 200
GRAM = 32
BLOCK = 64
SPAN = LENGTH - GRAM + 1        # grams in a window
FLUSH = 1_500_000               # regions a task holds before it deals them out
EARLY = 32                      # kinds of regions in a task that tell a shared core
MARK = 2                        # ``several`` of an entry that only says so
GROUP = 1000                    # different regions of a core that one suffix array takes
FINE = 8                        # offsets in a block of a core beyond GROUP
ASKS = 1 << 14                  # regions in a row of early asks
FILE_BYTES = 4_000_000          # bytes of texts for each file of a written table (tiny files cost more than their rows)
_POSITION = 22                  # bits for the position in a slice, when anchors are compared

REGION = np.dtype([("core", "<u8"), ("same", "<u8"), ("x", "<u4"), ("n", "u1"), ("w", "<u2"), ("several", "u1")])
DEALT = "bucket bigint, base bigint, entries binary, row_key binary, starts binary"
FOUND = "id bigint, core bigint, x bigint, y bigint, several boolean, row_key binary, starts binary"


def least_positions(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` elements (by blocks: prefix and suffix minima)."""
    n = len(x)
    p = np.full(-(-n // width) * width, U(2**64 - 1))
    p[:n] = x
    b = p.reshape(-1, width)
    before = np.minimum.accumulate(b, 1).reshape(-1)
    after = np.minimum.accumulate(b[:, ::-1], 1)[:, ::-1].reshape(-1)
    return np.minimum(after[:n - width + 1], before[width - 1:n])


def regions(texts: list[bytes], width: int = BLOCK) -> tuple[np.ndarray, ...]:
    """(text number, core hash, region hash, first start x, number of further starts) of all
    regions, with blocks of ``width`` offsets."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    if len(raw) < LENGTH:
        return tuple(np.empty(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
    if len(raw) >> _POSITION:   # one very long text: parts of it that share LENGTH - 1 bytes
        cut = (1 << _POSITION) - LENGTH
        parts = [regions([texts[0][at:at + cut + LENGTH - 1]], width) + (at,) for at in range(0, len(raw) - LENGTH + 1, cut)]
        return tuple(np.concatenate([p[i] + (p[5] if i == 3 else 0) for p in parts]).astype(parts[0][i].dtype)
                     for i in range(5))
    sums = byte_sums(raw)
    grams = string_hash(sums, np.arange(len(raw) - GRAM + 1), np.arange(GRAM, len(raw) + 1))
    low = U((1 << _POSITION) - 1)
    anchor = (least_positions((grams & ~low) | np.arange(len(grams), dtype=np.uint64), SPAN) & low).astype(np.int64)
    begin = np.cumsum(size) - size
    windows = np.maximum(0, size - LENGTH + 1)
    text = np.repeat(np.arange(len(texts)), windows)
    s = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(begin, windows)
    anchor = anchor[s]
    block = (anchor - s) // width
    first = np.ones(len(s), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (block[1:] != block[:-1])
    f = np.flatnonzero(first)
    e = np.append(f[1:], len(s)) - 1
    text, x, y, anchor, block = text[f], s[f], s[e], anchor[f], block[f]
    lo = block * width
    hi = np.minimum(lo + width, SPAN) - 1
    core = mix(string_hash(sums, anchor - lo, anchor - hi + LENGTH) ^ mix(block.astype(np.uint64) + U(1)))
    same = mix(string_hash(sums, x, y + LENGTH) ^ mix((anchor - x).astype(np.uint64) << U(32) ^ (y - x).astype(np.uint64)))
    return text, core, same, x - begin[text], y - x


def _deal(buckets: int):
    """Rows of a task: per bucket its regions; and (bucket < 0) per document its key and the
    starts (x, y) of regions that the same task has seen more than once, and the regions of
    shared cores."""
    names = [c.split()[0] for c in DEALT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def batch(*cols):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    def run(batches):
        drop_caches()
        task = TaskContext.get().partitionId()
        base, keys, held, count = task << 40, [], [], 0

        def flush():
            e = np.concatenate(held)
            e = e[np.lexsort((e["same"], e["core"]))]
            new = np.ones(len(e), bool)
            new[1:] = (e["core"][1:] != e["core"][:-1]) | (e["same"][1:] != e["same"][:-1])
            f = np.flatnonzero(new)
            n = np.diff(np.append(f, len(e)))
            again = e[np.repeat(n > 1, n)]
            e = e[f]
            e["several"] = n > 1
            spans = np.empty((len(again), 2), "<u4")
            order = np.argsort(again["w"], kind="stable")
            spans[:, 0], spans[:, 1] = again["x"][order], again["x"][order] + again["n"][order]
            ends = np.searchsorted(again["w"][order], np.arange(len(keys) + 1))
            starts = [spans[a:z].tobytes() if z > a else None for a, z in zip(ends, ends[1:])]
            yield batch([-1 - (task * 31 + base) % buckets] * len(keys), [base + i for i in range(len(keys))],
                        [None] * len(keys), keys, starts)
            c = np.flatnonzero(np.append(True, e["core"][1:] != e["core"][:-1]))
            kinds = np.diff(np.append(c, len(e)))
            early = np.repeat(kinds >= EARLY, kinds)
            if early.any():
                asks = e[early]
                cut = range(0, len(asks), ASKS)
                yield batch([-1 - (task * 31 + base + a) % buckets for a in cut], [base] * len(cut),
                            [asks[a:a + ASKS].tobytes() for a in cut], [None] * len(cut), [None] * len(cut))
                marks = c[kinds >= EARLY]
                e["several"][marks] = MARK
                early[marks] = False
                e = e[~early]
            home = ((e["core"] >> U(32)) * U(buckets) >> U(32)).astype(np.int64)   # ascending, as the cores are
            cut = np.flatnonzero(np.append(True, home[1:] != home[:-1]))
            k = len(cut)
            yield batch(home[cut], [base] * k, [e[a:z].tobytes() for a, z in zip(cut, np.append(cut[1:], len(e)))],
                        [None] * k, [None] * k)
        for part in slices(batches, 1):
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in part.column(1).to_pylist()]
            text, core, same, x, n = regions(texts)
            if not len(text):
                continue
            used, w = np.unique(text, return_inverse=True)
            e = np.empty(len(text), REGION)
            e["core"], e["same"], e["x"], e["n"], e["w"], e["several"] = core, same, x, n, w + len(keys), 0
            keys += np.asarray(part.column(0))[used].tolist()
            held.append(e)
            count += len(e)
            if count > FLUSH or len(keys) > (1 << 16) - 512:
                yield from flush()
                base, keys, held, count = base + (1 << 16), [], [], 0
        if held:
            yield from flush()
    return run


def _match(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of a bucket: starts that recur as their region has a copy (core null); and of cores with
    different regions, here or by a mark, one region of each kind. Rows of documents and early
    asks pass through."""
    names = [c.split()[0] for c in FOUND.split(", ")]
    types = [pa.int64()] * 4 + [pa.bool_(), pa.binary(), pa.binary()]
    rows = table.filter(pc.is_null(table.column("entries")))
    table = table.filter(pc.is_valid(table.column("entries")))
    raw = table.column("entries").to_pylist()
    e = np.frombuffer(b"".join(raw), REGION)
    who = e["w"] + np.repeat(np.asarray(table.column("base"), np.int64), [len(x) // REGION.itemsize for x in raw])
    if key[0].as_py() < 0:
        n, x = rows.num_rows, e["x"].astype(np.int64)
        return pa.concat_tables([
            pa.table([rows.column("base"), *[pa.nulls(n, t) for t in types[1:5]], rows.column("row_key"),
                      rows.column("starts")], names),
            pa.table([pa.array(who), pa.array(e["core"].view(np.int64)), pa.array(x), pa.array(x + e["n"]),
                      pa.array(e["several"] > 0), pa.nulls(len(e), types[5]), pa.nulls(len(e), types[6])], names)])
    marked = np.unique(e["core"][e["several"] == MARK])
    e, who = e[e["several"] != MARK], who[e["several"] != MARK]
    if not len(e):
        return pa.table([pa.nulls(0, t) for t in types], names)
    order = np.lexsort((e["same"], e["core"]))
    e, who = e[order], who[order]
    new = np.ones(len(e), bool)
    new[1:] = (e["core"][1:] != e["core"][:-1]) | (e["same"][1:] != e["same"][:-1])
    kind = np.cumsum(new) - 1
    f = np.flatnonzero(new)
    copies = np.diff(np.append(f, len(e)))
    several = (copies > 1) | np.maximum.reduceat(e["several"], f).astype(bool)
    core = e["core"][f]
    c = np.flatnonzero(np.append(True, core[1:] != core[:-1]))
    kinds = np.diff(np.append(c, len(core)))
    open_ = (kinds > 1) & (np.add.reduceat(~several, c) > 0)     # a kind there is still undecided
    open_ |= np.isin(core[c], marked)
    ask = f[np.repeat(open_, kinds)]
    tell = (copies > 1)[kind]                                    # those of a task are told by the task
    at = np.concatenate([np.flatnonzero(tell), ask])
    x = e["x"][at].astype(np.int64)
    m = len(at) - len(ask)
    asked = np.arange(len(at)) >= m
    return pa.table([
        pa.array(who[at]), pa.array(e["core"][at].view(np.int64), mask=~asked), pa.array(x),
        pa.array(x + e["n"][at]), pa.array(several[kind[at]], mask=~asked),
        pa.nulls(len(at), types[5]), pa.nulls(len(at), types[6])], names)


CUT = "core bigint, row_key binary, x bigint, y bigint, several boolean, bytes binary"


def _cut(batches):
    """(row_key, text, asks) -> the asked regions' bytes, in rows of bounded size."""
    names = [c.split()[0] for c in CUT.split(", ")]
    for part in slices(batches, 1):
        cols: list[list] = [[] for _ in names]
        for key, text, asks in zip(*[c.to_pylist() for c in part.columns]):
            raw = text.encode("utf-8", "surrogatepass")
            for a in asks:
                for col, v in zip(cols, (a["core"], key, a["x"], a["y"], a["several"], raw[a["x"]:a["y"] + LENGTH])):
                    col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
            pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()))], names)


def recurring(texts: list[bytes], starts: list[int], several: list[bool]) -> list[list[int]]:
    """Per region the starts (0 .. starts[i]) of windows that recur among these regions, for
    regions that have no copy; ``several`` marks those that have."""
    joined, begin = [], []
    for t in texts:
        begin.append(len(joined))
        joined.extend(b + 2 for b in t)
        joined.append(1)
    joined.append(0)
    home = [-1] * len(joined)
    for i, (b, k) in enumerate(zip(begin, starts)):
        home[b:b + k + 1] = [i] * (k + 1)
    out: list[list[int]] = [[] for _ in texts]
    run: list[tuple[int, int]] = []
    last = b""

    def close():
        if len(run) > 1:
            for i, s in run:
                if not several[i]:
                    out[i].append(s)
    for p in suffix_array(joined):
        i = home[p]
        if i >= 0:
            s = p - begin[i]
            window = texts[i][s:s + LENGTH]
            if window != last:
                close()
                run, last = [], window
            run.append((i, s))
    close()
    return out


def _runs(row: bytes, x: int, found: list[int], out: list[list]) -> None:
    """Appends the starts as runs of neighbours."""
    found = sorted(found)
    at = 0
    while at < len(found):
        z = at
        while z + 1 < len(found) and found[z + 1] == found[z] + 1:
            z += 1
        for col, v in zip(out, (row, x + found[at], x + found[z])):
            col.append(v)
        at = z + 1


STARTS = "row_key binary, x bigint, y bigint"


def _arrays(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Suffix arrays of a bucket's cores, one after the other."""
    out: list[list] = [[], [], []]
    table = table.sort_by([("core", "ascending"), ("row_key", "ascending"), ("x", "ascending")])
    core, row, x, y, several, raw = (c.to_pylist() for c in table.select([c.split()[0] for c in CUT.split(", ")]).columns)
    at = 0
    while at < len(core):
        z = at
        while z < len(core) and core[z] == core[at]:
            z += 1
        kinds: dict[bytes, list[int]] = {}
        for i in range(at, z):
            kinds.setdefault(raw[i], []).append(i)
        one = [of[0] for of in kinds.values()]
        known = [len(of) > 1 or several[of[0]] for of in kinds.values()]
        for of in kinds.values():       # regions of early asks may have copies here
            if len(of) > 1:
                for i in of:
                    if not several[i]:
                        for col, v in zip(out, (row[i], x[i], y[i])):
                            col.append(v)
        if len(one) > 1 and not all(known):
            found = recurring([raw[i] for i in one], [y[i] - x[i] for i in one], known)
            for i, s in zip(one, found):
                _runs(row[i], x[i], s, out)
        at = z
    return pa.table([pa.array(c, t) for c, t in zip(out, (pa.binary(), pa.int64(), pa.int64()))],
                    [c.split()[0] for c in STARTS.split(", ")])


FINER = "core bigint, same bigint, row_key binary, x bigint, y bigint, several boolean, bytes binary"


def _finer(batches):
    """The regions of a region's windows in blocks of FINE offsets."""
    names = [c.split()[0] for c in FINER.split(", ")]
    column = [c.split()[0] for c in CUT.split(", ")]
    for part in slices((b.select(column) for b in batches), 5):
        raw = part.column(5).to_pylist()
        text, core, same, x, n = regions(raw, FINE)
        start = np.asarray(part.column(2), np.int64)[text] + x
        yield pa.RecordBatch.from_arrays([
            pa.array(core.view(np.int64)), pa.array(same.view(np.int64)), part.column(1).take(pa.array(text)),
            pa.array(start), pa.array(start + n), part.column(4).take(pa.array(text)),
            pa.array([raw[t][a:a + k + LENGTH] for t, a, k in zip(text.tolist(), x.tolist(), n.tolist())], pa.binary())], names)


WINDOW = "h1 bigint, h2 bigint, row_key binary, x bigint, several boolean"


def _windows(batches):
    """Every window of a region by the hash of its content."""
    names = [c.split()[0] for c in WINDOW.split(", ")]
    for b in batches:
        for key, x, y, several, raw in zip(*[c.to_pylist() for c in b.select(["row_key", "x", "y", "several", "bytes"]).columns]):
            h = [hashlib.blake2b(raw[i:i + LENGTH], digest_size=16).digest() for i in range(y - x + 1)]
            h = np.frombuffer(b"".join(h), "<i8").reshape(-1, 2)
            k = len(h)
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array([key] * k, pa.binary()), pa.array(
                range(x, x + k), pa.int64()), pa.array([several] * k, pa.bool_())], names)


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """row_key (128 bits of a hash of doc_id and text), text (NULL: empty), and further columns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\0"), text)
    return docs.select(F.unhex(F.md5(key.cast("binary"))).alias("row_key"), text.alias("text"), *more)


def _by_arrays(cut: DataFrame, buckets: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64("core"), F.lit(buckets))
    # a number of partitions of its own: by their bytes, Spark would merge what takes long to sort
    return cut.withColumn("bucket", bucket).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_arrays, STARTS)


def _by_finer_blocks(cut: DataFrame, buckets: int, parts: int) -> list[DataFrame]:
    """Recurring starts among regions whose cores have too many kinds for one suffix array."""
    finer = cut.mapInArrow(_finer, FINER)
    kinds = written(finer.groupBy("core", "same").agg(
        F.count("*").alias("k"), F.max("several").alias("several"),
        F.min(F.struct("row_key", "x")).alias("first")), "kinds", parts=parts)
    told = finer.where("not several").join(kinds.where("k > 1").select("core", "same"), ["core", "same"])
    cores = kinds.groupBy("core").agg(F.count("*").alias("kinds"), F.min(F.expr("several or k > 1")).alias("decided"))
    asked = kinds.join(cores.where("kinds > 1 and not decided"), "core").select(
        "core", "same", "first.*", "kinds", F.expr("several or k > 1").alias("known"))
    # an early ask of a repeated row may stand there twice
    rest = finer.drop("several").dropDuplicates(["core", "same", "row_key", "x"]).join(
        asked, ["core", "same", "row_key", "x"]).withColumnRenamed("known", "several")
    rest = written(rest, "finer", parts=parts)
    windows = rest.where(F.col("kinds") > GROUP).mapInArrow(_windows, WINDOW)
    often = windows.groupBy("h1", "h2").agg(F.count("*").alias("k")).where("k > 1").select("h1", "h2")
    split = windows.where("not several").join(often, ["h1", "h2"]).select("row_key", "x", F.col("x").alias("y"))
    return [told.select("row_key", "x", "y"), _by_arrays(rest.where(F.col("kinds") <= GROUP), buckets), split]


def repeats(docs: DataFrame) -> DataFrame:
    """row_key, starts: array of (x, y), the runs of starts whose LENGTH bytes recur."""
    spark = docs.sparkSession
    rows = keyed(docs)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * shuffle_partitions(spark), total // 32_000_000)
    parts = max(16, total // FILE_BYTES)
    dealt = rows.select("row_key", "text").mapInArrow(_deal(buckets), DEALT)
    found = written(dealt.groupBy("bucket").applyInArrow(_match, FOUND), "regions", parts=parts)
    where = found.where("row_key is not null").select("id", "row_key")

    asks = found.where("core is not null").groupBy("id").agg(
        F.collect_list(F.struct("core", "x", "y", "several")).alias("asks"))
    asks = written(asks.join(where, "id").groupBy("row_key").agg(F.flatten(F.collect_list("asks")).alias("asks")), "asks", parts=parts)
    low = F.xxhash64("row_key").alias("low")
    asked = bitmap_filter(rows.select(low, "row_key", "text"), asks.select(low))
    cut = asked.dropDuplicates(["row_key"]).join(asks, "row_key").select("row_key", "text", "asks").mapInArrow(_cut, CUT)
    cut = written(cut, "cut", parts=parts)
    # a core may be too large for one task: those are few, as each holds over GROUP regions
    large = cut.groupBy("core").agg(F.count("*").alias("k")).where(F.col("k") > GROUP).select("core")
    small = _by_arrays(cut.join(large, "core", "left_anti"), buckets)
    finer = _by_finer_blocks(cut.join(large, "core", "left_semi"), buckets, parts)

    def listed(df):
        return df.select("row_key", F.struct("x", "y").alias("s"))
    told = found.where("core is null and row_key is null").groupBy("id").agg(F.collect_list(F.struct("x", "y")).alias("s"))
    told = told.join(where, "id").select("row_key", F.explode("s").alias("s"))
    for found_in in (small, *finer):
        told = told.unionByName(listed(found_in))
    spans = told.groupBy("row_key").agg(F.collect_set("s").alias("starts"))
    local = found.where("starts is not null").groupBy("row_key").agg(F.collect_set("starts").alias("local"))
    return spans.join(local, "row_key", "full_outer")


def covered(starts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by LENGTH bytes from every start of the runs (x, y)."""
    out: list[list[int]] = []
    for x, y in sorted(starts):
        if out and x <= out[-1][1]:
            out[-1][1] = max(out[-1][1], y + LENGTH)
        else:
            out.append([x, y + LENGTH])
    return [(a, b) for a, b in out]


def removed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns as k0, k1, ... + ``spans`` (removed byte runs), ``n_bytes``, ``kept``
    (remaining bytes)."""
    k = [f"k{i}" for i in range(len(keep))]
    rows = keyed(docs, *[F.col(f"`{c}`").alias(a) for c, a in zip(keep, k)])
    schema = rows.select(*k).schema
    rows = rows.join(repeats(docs), "row_key", "left")

    def run(batches):
        for part in slices(batches, 0):
            spans, size, kept = [], [], []
            for text, starts, local in zip(*[c.to_pylist() for c in part.columns[:3]]):
                raw = (text or "").encode("utf-8", "surrogatepass")
                all_ = [(s["x"], s["y"]) for s in starts or ()]
                for x in local or ():
                    all_ += map(tuple, np.frombuffer(x, "<u4").reshape(-1, 2).tolist())
                runs, at, rest = covered(all_), 0, []
                for a, b in runs:
                    rest.append(raw[at:a])
                    at = b
                rest.append(raw[at:])
                spans.append([{"start": a, "end": b} for a, b in runs])
                size.append(len(raw))
                kept.append(b"".join(rest))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[3:], pa.array(spans, span), pa.array(size, pa.int64()), pa.array(kept, pa.binary())],
                [*k, "spans", "n_bytes", "kept"])
    ddl = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in schema]
                    + ["spans array<struct<start:bigint,end:bigint>>", "n_bytes bigint", "kept binary"])
    return rows.select("text", "starts", "local", *k).mapInArrow(run, ddl)


def query(spark, docs: DataFrame) -> DataFrame:
    out = removed(docs, ["doc_id"])
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return out.select(F.col("k0").alias("doc_id"), "n_bytes", gone.alias("n_removed"),
                      F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def strip(docs: DataFrame) -> DataFrame:
    """The documents with their repeated passages taken out of ``text`` (a character cut in
    half goes too; a NULL text becomes empty); ``n_chars``, if there, is counted anew, other
    columns stay as they are."""
    others = [c for c in docs.columns if c != "text"]
    k = [f"k{i}" for i in range(len(others))]
    out = removed(docs, others).select(*k, "kept")
    ddl = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in out.select(*k).schema] + ["text string"])

    def decode(batches):
        for b in batches:
            text = [x.decode("utf-8", "ignore") for x in b.column(len(k)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(k)], pa.array(text, pa.string())], [*k, "text"])
        drop_caches()
    out = out.mapInArrow(decode, ddl)
    back = {c: F.col(a) for c, a in zip(others, k)} | {"text": F.col("text")}
    if "n_chars" in back:
        back["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[back[c].alias(c) for c in docs.columns])
