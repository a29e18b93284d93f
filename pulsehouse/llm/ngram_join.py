"""N-gram Jaccard self-join by universe partitioning, its connected groups and all its links.

Two documents link when the Jaccard similarity of their word-shingle sets is at
least 3/4, that is when the sets differ in at most H = (|a| + |b|) // 7
shingles. The shingle universe is hashed into the m segments of a *size band*.
A pair that differs in at most H shingles has, among any segments whose
*coverage* adds up to H + 1, one in which it differs by less than that
segment's coverage:

* coverage 1: the pair agrees on the segment; its signature is the subset of
  the document's shingles that falls there;
* coverage 2: the pair differs by one shingle at most there; signatures are the
  subset and its one-deletion neighbourhood (all subsets with one shingle
  left out).

Allocation is by cost. Per band, the cheaper of two layouts is taken: few wide
segments of coverage 2 (small sets), or many of coverage 1 (:func:`layout`).
Within coverage 1, a document passes over segments that are expensive because
many documents share them (empty, or made of frequent shingles only) and uses
the next ones, as long as it has enough: this depends on the segment's content
only, so two documents that agree on a segment both use it or both pass over
it. A document that is short of good
segments (mostly frequent passages) uses those it has, and meets the others that
are short in a name space of their own, by the wide layout.

Candidates then pass an exact bound (the L1 distance of BINS shingle counts can't
exceed the sets' difference) and are verified on the sets themselves. Groups of
equal signatures are not expanded into all pairs: first every member is
compared with the group's least member; only groups whose members then still
belong to different components are compared across components. Groups of one family share
most of their members, so they are dealt to tasks by their least component (and split by
group where that has very many rows): a task looks at each of its pairs once, by size and
outline, and emits what these allow. A group of more than GROUP members is cut into tiles, and
each two tiles meet in one task.

Equal shingle sets are one class from the start: copies cost nothing later.

Those pairs connect the components, and every link lies inside a component. So all links
are found there: a component's sets are dealt to *tiles* by hash, each two tiles meet in
one task, and the sizes of all their intersections come from products of 0/1 matrices, so
each pair of sets is decided exactly and once. The query takes only each set's number of
links from a task; :meth:`Join.links` lists the pairs.

A row's links are the other rows whose sets link with its own, copies and repeated rows
included (also those with the same doc_id).

Defined cases: NULL or blank text has the empty set, no link, and is its own
component; fewer than five words are one shingle; repeated rows get one output
row each. Components are named by their least doc_id. Documents must come from
a table (or any plan that gives the same rows whenever it is run).
"""
from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SLICE_ROWS, bitmap, drop_caches, forget, in_bitmap, shuffle_partitions, slices, written, written_in_parts
from .shingles import U, mix, shingle_sets

SLICE = 256                 # pairs verified at a time
STARS = 3                   # buckets in which a member must meet a group's least member
GROUP = 2000                # members of a tile of a group, whose pairs one task compares by outline
BINS = 512                  # counts in a set's outline
COARSE = 128                # ... summed to so many for a first look
ACROSS_ROWS = 50_000        # members of one family's groups that a task compares
ACROSS_PAIRS = 1 << 17      # pairs it holds at a time
BUCKET_SHINGLES = 500_000   # shingles of the corpus for each bucket of signatures
TILE = 1024                 # sets of a component that a tile holds, about ...
TILE_SHINGLES = 1 << 19     # ... and their shingles
COLUMNS = 4096              # shingles of a tile in one matrix product
KNOWN_SHINGLES = 1 << 21    # shingles of sets that verification keeps at hand
FLUSH = 750_000             # signatures a task holds before it deals them out
SAMPLE_BITS = 4             # 1/16 of the classes (by their identity) tell which shingles are frequent
FREQUENT_SHARE = 8000       # frequent: in more than 1/8000 of the classes ...
FREQUENT_LEAST = 32         # ... and in more than 32; so at most 8000 sets' worth are frequent
OVERFLOW_COST = 2000        # signatures that a document short of good segments costs
PER_SEGMENT = 1.5           # shingles a narrow segment: documents that are up to half frequent
                            # passages still have enough good ones


# ---- size bands and their layout ------------------------------------------------------------

def differ(a: int, b: int) -> int:
    """The most shingles two linked sets of sizes a and b differ in."""
    return (a + b) // 7


@functools.lru_cache(maxsize=None)
def bands(upto: int = 1 << 31) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) size of each band; linked sets are in the same or in neighbouring bands."""
    lo, hi, at = [], [], 1
    while at <= upto:
        top = max(at, at * 4 // 3 if at < 24 else at * 8 // 5)
        lo.append(at)
        hi.append(top)
        at = top + 1
    return np.array(lo), np.array(hi)


def need(size, top):
    """Coverage a set of this size must offer to partners up to size ``top``."""
    return (size + np.minimum(top, size * 4 // 3)) // 7 + 1


@functools.lru_cache(maxsize=None)
def layout(band: int) -> tuple[int, int]:
    """(segments, coverage of each) of a band: the cheaper in expected signatures."""
    lo, hi = (int(x[band]) for x in bands())
    most = int(need(hi, hi))
    m = max(most, math.ceil(hi / PER_SEGMENT))
    cost = most
    for size in (lo, hi):       # chance that too few segments have a shingle
        x = size / m
        mean, var = m * (1 - math.exp(-x)), m * (math.exp(-x) - (1 + x) * math.exp(-2 * x))
        z = (int(need(size, hi)) - 0.5 - mean) / max(0.3, math.sqrt(max(0.0, var)))
        cost += OVERFLOW_COST * 0.5 * math.erfc(-z / math.sqrt(2))
    return min((wide(band) + hi, (wide(band), 2)), (cost, (m, 1)))[1]


def wide(band: int) -> int:
    """Segments of the layout whose coverage is 2 everywhere."""
    hi = bands()[1][band]
    return -(-int(need(hi, hi)) // 2)


# ---- signatures ------------------------------------------------------------------------------

class Frequent:
    """Membership in the sorted frequent shingles, most others told by a table of high bits."""

    def __init__(self, hashes: np.ndarray):
        self.all = hashes
        self.table = np.zeros(1 << 20, bool)
        self.table[(hashes >> U(44)).astype(np.int64)] = True

    def __call__(self, s: np.ndarray) -> np.ndarray:
        out = self.table[(s >> U(44)).astype(np.int64)]
        if out.any():
            maybe = s[out]
            at = np.minimum(np.searchsorted(self.all, maybe), len(self.all) - 1)
            out[out] = self.all[at] == maybe
        return out


def _segment(s: np.ndarray, m: int, band: int, space: int) -> np.ndarray:
    salt = U(0xA24BAED4963EE407 * (2 * band + space + 1) & (2**64 - 1))
    return ((mix(s ^ salt) >> U(32)) * U(m) >> U(32)).astype(np.int64)


def _names(m: int, band: int, space: int) -> np.ndarray:
    return mix((np.arange(m, dtype=np.uint64) + U(1)) * U(0x2545F4914F6CDD1D) ^ U(2 * band + space + 1))


def _wide(row: np.ndarray, s: np.ndarray, value: np.ndarray, rows: int, m: int, band: int,
          space: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of every segment's subset and of its one-deletion neighbourhood."""
    seg = _segment(s, m, band, space)
    cell = row * m + seg
    total = np.zeros(rows * m, np.uint64)
    np.add.at(total, cell, value)
    names = _names(m, band, space)
    return (np.concatenate([np.repeat(np.arange(rows), m), row]),
            np.concatenate([mix(total ^ np.tile(names, rows)), mix((total[cell] - value) ^ names[seg])]))


def signatures(sets: list[np.ndarray], frequent: Frequent) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(set number, signature) of all sets, and the same in the name space of sets short of good
    segments."""
    size = np.array([len(s) for s in sets])
    lo, hi = bands()
    own = np.searchsorted(hi, size)
    who, sig, bad_who, bad_sig = [], [], [], []
    for up in (0, 1):
        use = np.flatnonzero((size > 0) if not up else (size > 0) & (size * 4 // 3 > hi[own]))
        band = own[use] + up
        for b in np.unique(band).tolist():
            part = use[band == b]
            m, cover = layout(b)
            n = size[part]
            s = np.concatenate([sets[i] for i in part])
            row = np.repeat(np.arange(len(part)), n)
            value = mix(s ^ U(0x9FB21C651E98DF25))
            if cover == 2:
                r, x = _wide(row, s, value, len(part), m, b, 0)
                who.append(part[r])
                sig.append(x)
                continue
            cell = row * m + _segment(s, m, b, 0)
            total = np.zeros(len(part) * m, np.uint64)
            np.add.at(total, cell, value)
            good = np.bincount(cell, ~frequent(s), len(total)).reshape(len(part), m) > 0
            enough = need(n, hi[b])
            so_far = np.cumsum(good, 1)
            r, c = np.nonzero(good & (so_far <= enough[:, None]))
            who.append(part[r])
            sig.append(mix(total.reshape(len(part), m)[r, c] ^ _names(m, b, 0)[c]))
            short = so_far[:, -1] < enough
            if short.any():
                mine = short[row]
                r, x = _wide(row[mine], s[mine], value[mine], len(part), wide(b), b, 1)
                mine = short[r]
                bad_who.append(part[r[mine]])
                bad_sig.append(x[mine])

    def join(parts, kind):
        return np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
    return join(who, np.int64), join(sig, np.uint64), join(bad_who, np.int64), join(bad_sig, np.uint64)


def outline(s: np.ndarray) -> bytes:
    count = np.bincount((s >> U(55)).astype(np.int64), minlength=BINS)
    return np.minimum(count, 0xFF).astype("u1").tobytes()   # a clipped count only loosens the bound


def _opened(cells: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), "u1").reshape(-1, BINS)


def _coarse(x: np.ndarray) -> np.ndarray:
    return x.reshape(len(x), COARSE, -1).sum(2, dtype=np.int16)


def _within(x: np.ndarray, i: np.ndarray, j: np.ndarray, n: np.ndarray, coarse: np.ndarray | None = None) -> np.ndarray:
    """Which of the pairs (i, j) have outlines no further apart than ``n // 7``."""
    ok = np.zeros(len(i), bool)
    coarse = _coarse(x) if coarse is None else coarse
    for at in range(0, len(i), 4096):
        part = slice(at, at + 4096)
        hit = np.flatnonzero(np.abs(coarse[i[part]] - coarse[j[part]]).sum(1) <= n[part] // 7) + at
        ok[hit] = np.abs(x[i[hit]].astype(np.int16) - x[j[hit]]).sum(1) <= n[hit] // 7
    return ok


def identity(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    a = mix(s ^ U(0x8CB92BA72F3D8DD7)).sum(dtype=np.uint64)
    b = mix(s ^ U(0xABC98388FB8FAC03)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _sets_of(batches, column: int):
    """(rows, sets) of slices of the batches."""
    drop_caches()
    for part in slices(batches, column):
        yield part, shingle_sets(part.column(column).to_pylist())
    drop_caches()


# ---- pass 1: sets' identities, sizes, outlines; frequent shingles ----------------------------

MEMBERS = "doc_id bigint, n bigint, h1 bigint, h2 bigint, bins binary, codes binary"


def _describe(batches):
    """Of every document its set's identity, size and outline; of sampled sets also their shingles
    (once a task)."""
    looked_at = set()
    for part, sets in _sets_of(batches, 1):
        ids = [identity(s) for s in sets]
        codes = []
        for s, i in zip(sets, ids):
            fresh = len(s) > 0 and not i[0] & ((1 << SAMPLE_BITS) - 1) and i not in looked_at
            if fresh:
                looked_at.add(i)
            codes.append(s.tobytes() if fresh else None)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([a for a, _ in ids], pa.int64()),
             pa.array([b for _, b in ids], pa.int64()), pa.array([outline(s) for s in sets], pa.binary()),
             pa.array(codes, pa.binary())], [x.split()[0] for x in MEMBERS.split(", ")])


def _count_codes(batches):
    """(shingle, sets of this task that have it)."""
    def counted(held):
        codes, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(n)], ["h", "k"])
    held, count = [], 0
    for b in batches:
        for raw in b.column(0).to_pylist():
            held.append(np.frombuffer(raw, np.uint64))
            count += len(held[-1])
            if count > FLUSH:
                yield counted(held)
                held, count = [], 0
    if held:
        yield counted(held)


def frequent_shingles(described: DataFrame, least: int) -> DataFrame:
    """``h``: shingles of more than ``least`` sampled sets. A set counts once, however many copies or
    tasks it is in, so the result does not depend on how the documents are dealt."""
    sample = described.where("codes is not null").select("h1", "h2", "codes").dropDuplicates(["h1", "h2"])
    return sample.select("codes").mapInArrow(_count_codes, "h bigint, k bigint").groupBy("h").agg(
        F.sum("k").alias("k")).where(F.col("k") > least).select("h")


# ---- pass 2: signatures dealt to buckets ------------------------------------------------------

DEALT = "bucket bigint, base bigint, entries binary, h1 bigint, h2 bigint, bad array<bigint>"


def _deal(buckets: int, frequent):
    """Rows of a task: per bucket the signatures' (low 32 bits, local set number); and one row
    per set (bucket < 0) with its identity and its signatures among the short ones."""
    names = [x.split()[0] for x in DEALT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def batch(cols):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    def run(batches):
        task, seen = TaskContext.get().partitionId(), set()
        base, sets_here, who, sig, held = task << 40, 0, [], [], 0

        def flush():
            w, s = np.concatenate(who), np.concatenate(sig)
            home = ((s >> U(32)) * U(buckets) >> U(32)).astype(np.int64)
            order = np.argsort(home, kind="stable")
            home = home[order]
            out = np.empty(len(w), [("s", "<u4"), ("w", "<u2")])
            out["s"], out["w"] = s[order].astype(np.uint32), w[order]
            cut = np.flatnonzero(np.append(True, home[1:] != home[:-1]))
            ends = np.append(cut[1:], len(home))
            k = len(cut)
            return batch([home[cut], [base] * k, [out[a:z].tobytes() for a, z in zip(cut, ends)],
                          [None] * k, [None] * k, [None] * k])
        for _, sets in _sets_of(batches, 0):
            ids = [identity(s) for s in sets]
            fresh = []
            for i, s in zip(ids, sets):
                if len(s) and i not in seen:
                    seen.add(i)
                    fresh.append((i, s))
            if not fresh:
                continue
            w, s, bw, bs = signatures([x for _, x in fresh], frequent.value)
            bad = [[] for _ in fresh]
            for i, x in zip(bw.tolist(), bs.view(np.int64).tolist()):
                bad[i].append(x)
            k = len(fresh)
            yield batch([[-1 - (task * 31 + sets_here // SLICE_ROWS) % buckets] * k,
                         [base + sets_here + i for i in range(k)], [None] * k,
                         [i[0] for i, _ in fresh], [i[1] for i, _ in fresh], bad])
            who.append(w + sets_here)
            sig.append(s)
            sets_here += k
            held += len(w)
            if held > FLUSH or sets_here > (1 << 16) - SLICE_ROWS - 1:
                yield flush()
                base, sets_here, who, sig, held = base + (1 << 16), 0, [], [], 0
        if held:
            yield flush()
    return run


# ---- reduce: groups of equal signatures --------------------------------------------------------

GROUPED = "a bigint, b bigint, others array<bigint>, h1 bigint, h2 bigint, bad array<bigint>"


def _group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of a bucket: pairs (least member, member) of every group; groups of three and more also
    whole (``others``, once per distinct member list). ``h2`` is 1 for a pair that is a whole
    group. Rows of sets pass through with b null."""
    names = [x.split()[0] for x in GROUPED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def out(cols):
        return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names)
    n = table.num_rows
    if key[0].as_py() < 0:
        none = pa.nulls(n, pa.int64())
        return pa.table([table.column("base"), none, pa.nulls(n, types[2]), table.column("h1"), table.column("h2"),
                         table.column("bad")], names)
    raw = table.column("entries").to_pylist()
    e = np.frombuffer(b"".join(raw), [("s", "<u4"), ("w", "<u2")])
    who = e["w"] + np.repeat(np.asarray(table.column("base"), np.int64), [len(x) // 6 for x in raw])
    order = np.lexsort((who, e["s"]))
    s, who = e["s"][order], who[order]
    keep = np.append(True, (s[1:] != s[:-1]) | (who[1:] != who[:-1]))
    s, who = s[keep], who[keep]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    length = np.diff(np.append(first, len(s)))
    many = length > 1
    first, length = first[many], length[many]
    head = np.repeat(first, length - 1)
    alone = np.repeat(length == 2, length - 1)
    step = np.arange(len(head)) - np.repeat(np.cumsum(length - 1) - (length - 1), length - 1) + 1
    a, b = who[head], who[head + step]
    order = np.lexsort((~alone, b, a))
    a, b, alone = a[order], b[order], alone[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, alone = a[new], b[new], alone[new].astype(np.int64)
    lists = {who[f:f + k].tobytes(): who[f:f + k] for f, k in zip(first[length > 2], length[length > 2])}
    p, g = len(a), len(lists)
    return out([np.concatenate([a, np.full(g, -1)]), np.concatenate([b, np.full(g, -1)]),
                [None] * p + list(lists.values()), [None] * (p + g), alone.tolist() + [None] * g, [None] * (p + g)])


def _candidates(g: np.ndarray, label: np.ndarray, n: np.ndarray, side: np.ndarray, place: np.ndarray):
    """Codes (place of one set << 32 | place of the other) of pairs of one group but of two
    components whose sizes may link; rows are sorted by (g, n). Two tiles of a group (sides 1
    and 2) are only paired with each other. In blocks of distinct codes: all groups of some sets
    at a time, so that where places follow sizes a pair is in one block, however many groups it
    is in (a set with over ACROSS_PAIRS pairs is cut: its codes may come again)."""
    end = np.searchsorted(g, g, "right")
    top = n * 4 // 3
    upto = np.empty(len(g), np.int64)
    for f in np.flatnonzero(np.append(True, g[1:] != g[:-1])):
        upto[f:end[f]] = f + np.searchsorted(n[f:end[f]], top[f:end[f]], "right")
    count = upto - np.arange(len(g)) - 1
    rows = np.argsort(place, kind="stable")
    rows = rows[count[rows] > 0]
    own, total, at = place[rows], np.cumsum(count[rows]), 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + ACROSS_PAIRS, "right")))
        if to < len(rows) and own[to] != own[at]:
            to = int(np.searchsorted(own, own[to]))
        c = count[rows[at:to]]
        i = np.repeat(rows[at:to], c)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
        apart = (label[i] != label[j]) & ((side[i] == 0) | (side[i] != side[j]))
        p, q = place[i[apart]], place[j[apart]]
        yield np.unique(np.minimum(p, q) << 32 | np.maximum(p, q))
        at = to


def _across(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of a bucket of groups (members; and every set's outline once): pairs across components
    that sizes and outlines allow."""
    known = np.asarray(table.column("bins").is_valid())
    sets = table.filter(pa.array(known))
    members = table.filter(pa.array(~known)).sort_by([(c, "ascending") for c in ("g", "n", "node")])
    # a set's place follows its size, as its rows do in every group
    sets = sets.sort_by([("n", "ascending"), ("node", "ascending")])
    node, size = (np.asarray(sets.column(c), np.int64) for c in ("node", "n"))
    x = _opened(sets.column("bins").to_pylist())
    coarse = _coarse(x)
    order = np.argsort(node)
    place = order[np.searchsorted(node, np.asarray(members.column("node"), np.int64), sorter=order)]
    found = [np.empty((0, 2), np.int64)]
    for codes in _candidates(*(np.asarray(members.column(c), np.int64) for c in ("g", "label", "n", "side")), place):
        p, q = codes >> 32, codes & 0xFFFFFFFF
        ok = _within(x, p, q, size[p] + size[q], coarse)
        found.append(np.sort(np.stack([node[p[ok]], node[q[ok]]], 1), 1))
    pairs = np.concatenate(found)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


# ---- verification -------------------------------------------------------------------------------

def _outlines_allow(batches):
    for b in batches:
        for at in range(0, b.num_rows, 1024):
            part = b.slice(at, 1024)
            k = part.num_rows
            x = _opened(part.column(4).to_pylist() + part.column(5).to_pylist())
            n = np.asarray(part.column(2)) + np.asarray(part.column(3))
            yield part.filter(pa.array(_within(x, np.arange(k), np.arange(k, 2 * k), n))).select(["a", "b"])


def _verified(batches):
    known: dict[int, np.ndarray] = {}

    def load(nodes, texts):
        new = {k: t for k, t in zip(nodes, texts) if k not in known}
        known.update(zip(new, shingle_sets(list(new.values()))))
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            a, c, ta, tc = (x.to_pylist() for x in b.slice(at, SLICE).columns)
            if len(known) > 8 * SLICE or sum(map(len, known.values())) > KNOWN_SHINGLES:
                known.clear()
            load(a, ta)
            load(c, tc)
            ok = []
            for x, y in zip(a, c):
                p, q = known[x], known[y]
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * both >= 75 * (len(p) + len(q) - both))
            yield b.slice(at, SLICE).filter(pa.array(ok)).select(["a", "b"])


def linked(x: list[np.ndarray], y: list[np.ndarray] | None = None) -> np.ndarray:
    """Which sets of x link with which of y (or of x itself), from the sizes of all intersections."""
    sets = x + (y or [])
    size = np.array([len(s) for s in sets])
    col, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    shared = times > 1                                          # others are in no intersection
    keep = shared[col]
    row, col = np.repeat(np.arange(len(sets)), size)[keep], (np.cumsum(shared) - 1)[col[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    n = len(x)
    both = np.zeros((n, n if y is None else len(y)), np.int64)
    for at in range(0, int(shared.sum()), COLUMNS):
        a, z = np.searchsorted(col, [at, at + COLUMNS])
        m = np.zeros((len(sets), int(col[z - 1]) - at + 1), np.float32)
        m[row[a:z], col[a:z] - at] = 1
        both += (m[:n] @ (m if y is None else m[n:]).T).astype(np.int64)
    out = 100 * both >= 75 * (size[:n, None] + (size if y is None else size[n:]) - both)
    if y is None:
        np.fill_diagonal(out, False)
    return out


TILES = "bucket bigint, label bigint, i int, j int, tile int, node bigint, copies bigint, text string"


def _tiles(listed: bool):
    """Of a bucket of tile pairs: their links (a, b), a < b; or per set the rows its links lead to."""
    names = ["a", "b"] if listed else ["node", "links"]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("label", "i", "j", "tile")])
        label, i, j, tile, node, copies = (np.asarray(table.column(c), np.int64)
                                           for c in ("label", "i", "j", "tile", "node", "copies"))
        new = np.append(True, (label[1:] != label[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
        first = np.flatnonzero(new)
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for f, e in zip(first, np.append(first[1:], len(new))):
            cut = f + int(np.searchsorted(tile[f:e], i[f], "right"))
            x, y = (slice(f, e), slice(f, e)) if i[f] == j[f] else (slice(f, cut), slice(cut, e))
            if x.start == x.stop or y.start == y.stop:
                continue
            sets = shingle_sets(table.column("text").slice(f, e - f).to_pylist())
            ok = linked(sets) if x == y else linked(sets[:cut - f], sets[cut - f:])
            if listed:
                p, q = np.nonzero(np.triu(ok) if x == y else ok)
                left.append(np.minimum(node[x][p], node[y][q]))
                right.append(np.maximum(node[x][p], node[y][q]))
                continue
            left.append(node[x])
            right.append(ok @ copies[y])
            if x != y:
                left.append(node[y])
                right.append(copies[x] @ ok)
        return pa.table([pa.array(np.concatenate(c).astype(np.int64)) for c in (left, right)], names)
    return run


def components(edges: DataFrame, parts: int | None = None) -> DataFrame:
    """(node, label): the least node each node of the edges can reach. Labels spread to
    neighbours and jump to their labels' labels, so rounds grow with the logarithm of the
    longest path; each round is written (in ``parts`` files at most), and the one before it deleted."""
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges", parts=parts)
    held = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
                   .withColumnRenamed("a", "node"), "labels", parts=parts)
    while True:
        labels = held.select("node", "label")
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a")).select(
            "node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        new = step.join(jump, "next", "left").select(
            "node", F.least("next", "far").alias("label"), (F.least("next", "far") != F.col("label")).alias("moved"))
        new = written(new, "labels", parts=parts)
        forget(held)
        held = new
        if not new.where("moved").head(1):
            forget(both)
            return new.select("node", "label")


class Join:
    """One self-join over documents (doc_id, text)."""

    def __init__(self, docs: DataFrame):
        self.spark: SparkSession = docs.sparkSession
        self.docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
        described = written_in_parts(self.docs.mapInArrow(_describe, MEMBERS), "sets")
        self.members = described.select("doc_id", "n", "h1", "h2")
        # most files of a written table: one for so many shingles; a task that writes opens processes
        # on a local disk, and hundreds of tiny files cost more than their rows
        self.parts = max(16, (self.members.agg(F.sum("n")).first()[0] or 0) // BUCKET_SHINGLES)
        classes = described.where("n > 0").groupBy("h1", "h2", "n").agg(
            F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.first("bins").alias("bins"))
        self.classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes", parts=self.parts)
        size = self.classes.agg(F.count("*"), F.sum("n")).first()
        self.count, self.total = size[0], size[1] or 0
        least = max(FREQUENT_LEAST, self.count // FREQUENT_SHARE) >> SAMPLE_BITS
        # at most FREQUENT_SHARE sets' worth of shingles, eight bytes each
        hot = frequent_shingles(described, least).toArrow().column(0).to_numpy()
        self.frequent = np.sort(hot.astype(np.int64).view(np.uint64))

    def _node_pairs(self, pairs: DataFrame, ids: DataFrame) -> DataFrame:
        """(a, b, whole) of local ids -> distinct (a, b) of nodes, a < b, that size and outline
        allow: all whole groups, and of the others those that meet in STARS buckets or more
        (groups that a pair not taken here holds together are compared across components)."""
        for c in ("a", "b"):
            pairs = pairs.join(ids.select(F.col("id").alias(c), F.col("node").alias(f"n{c}")), c).drop(c)
        pairs = pairs.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"), "whole").where("a < b")
        pairs = pairs.groupBy("a", "b").agg(F.max("whole").alias("whole"), F.count("*").alias("k"))
        return self._allowed(pairs.where((F.col("whole") == 1) | (F.col("k") >= STARS)).select("a", "b"))

    def _allowed(self, pairs: DataFrame) -> DataFrame:
        pairs = pairs.where("a < b").distinct()
        for c in ("a", "b"):
            pairs = pairs.join(self.classes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}")), c)
        pairs = pairs.where("4 * least(na, nb) >= 3 * greatest(na, nb)")
        for c in ("a", "b"):
            pairs = pairs.join(self.classes.select(F.col("node").alias(c), F.col("bins").alias(f"x{c}")), c)
        return pairs.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(_outlines_allow, "a bigint, b bigint")

    def _verify(self, pairs: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(the pairs that link, all pairs, (node, text) of the pairs' sets). Texts of needed sets only are read again: a bitmap of fixed size
        over set hashes lets all needed ones (and at scale some others) through."""
        pairs = written(pairs, f"{name}-pairs", parts=self.parts)
        need_ = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = written(self.classes.select("node", "h1", "h2").join(need_, "node"), f"{name}-wanted", parts=self.parts)
        have = self.spark.sparkContext.broadcast(bitmap(wanted, "h1"))

        def reread(batches):
            seen = set()
            for part, sets in _sets_of(batches, 1):
                ids = [identity(s) if len(s) else None for s in sets]
                hit = in_bitmap(have.value, np.array([i[0] if i else 0 for i in ids], np.int64))
                ok = [i is not None and i not in seen and bool(k) for i, k in zip(ids, hit)]
                seen.update(i for i, k in zip(ids, ok) if k)
                got = [i for i, k in zip(ids, ok) if k]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in got], pa.int64()), pa.array(
                    [x[1] for x in got], pa.int64()), part.column(1).filter(pa.array(ok))], ["h1", "h2", "text"])
        texts = self.docs.mapInArrow(reread, "h1 bigint, h2 bigint, text string")
        texts = texts.join(wanted, ["h1", "h2"]).dropDuplicates(["h1", "h2"]).select("node", "text")
        texts = written_in_parts(texts, f"{name}-texts", parts=self.parts)
        rows = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
        rows = rows.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
        return written_in_parts(rows.select("a", "b", "ta", "tb").mapInArrow(_verified, "a bigint, b bigint"), f"{name}-links", parts=self.parts), pairs, texts

    @functools.cached_property
    def connected(self) -> tuple[DataFrame, DataFrame]:
        """((node, label) of linked classes, (node, text) of these and some others)."""
        buckets = max(16, self.total // BUCKET_SHINGLES)
        frequent = self.spark.sparkContext.broadcast(Frequent(self.frequent))
        dealt = self.docs.select("text").mapInArrow(_deal(buckets, frequent), DEALT)
        grouped = written_in_parts(dealt.groupBy("bucket").applyInArrow(_group, GROUPED), "groups", parts=self.parts)
        sets = grouped.where("h1 is not null")
        ids = written(sets.select(F.col("a").alias("id"), "h1", "h2").join(
            self.classes.select("node", "h1", "h2"), ["h1", "h2"]).select("id", "node"), "ids", parts=self.parts)
        bad = sets.select(F.col("a").alias("id"), F.explode("bad").alias("g")).join(ids, "id").select("g", "node").distinct()
        bad = written(bad, "short", parts=self.parts)
        star = bad.join(bad.groupBy("g").agg(F.min("node").alias("a"), F.count("*").alias("k")).where("k > 1"), "g")
        pairs = self._node_pairs(grouped.where("h1 is null and others is null").select("a", "b", F.col("h2").alias("whole")), ids)
        first = pairs.unionByName(self._allowed(star.select("a", F.col("node").alias("b")))).distinct()
        links, done, texts = self._verify(first, "star")
        labels = components(links, self.parts)

        lists = grouped.where("others is not null").select(F.xxhash64("others").alias("g"), "others").dropDuplicates(["g"])
        groups = lists.select("g", F.explode("others").alias("id")).join(ids, "id").select("g", "node").distinct()
        groups = groups.unionByName(bad).join(labels, "node", "left").select(
            "g", "node", F.coalesce("label", "node").alias("label"))
        groups = written(groups, "group-members", parts=self.parts)
        torn = groups.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("k")
                                       ).where("lo < hi").select("g", "k", "lo")
        torn = written(torn, "torn-groups", parts=self.parts)
        family = torn.groupBy("lo").agg(F.ceil(F.sum("k") / ACROSS_ROWS).alias("salts"))
        torn = torn.join(family, "lo").withColumn("salt", F.pmod(F.xxhash64("g"), F.col("salts"))).withColumn(
            "tiles", F.ceil(F.col("k") / GROUP).cast("int"))
        # members of a group: one tile for each GROUP of them, each two tiles in one place
        left = groups.join(torn, "g").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        i, j = F.least("tile", "other"), F.greatest("tile", "other")
        side = F.when(F.col("tile") == F.col("other"), 0).when(F.col("tile") < F.col("other"), 1).otherwise(2).cast("bigint")
        left = left.select(F.pmod(F.xxhash64("lo", "salt", i, j), F.lit(buckets)).alias("bucket"),
                           F.xxhash64("g", i, j).alias("g"), "node", "label", side.alias("side"))
        left = written(left.join(self.classes.select("node", "n"), "node"), "torn", parts=self.parts)
        dealt = left.select("bucket", "g", "node", "label", "n", "side")
        outlines = dealt.select("bucket", "node").distinct().join(self.classes.select("node", "n", "bins"), "node").select(
            "bucket", *[F.lit(None).cast("bigint") if c in ("g", "label", "side") else F.col(c)
                        for c in ("g", "node", "label", "n", "side", "bins")])
        cross = dealt.withColumn("bins", F.lit(None).cast("binary")).union(outlines).groupBy("bucket").applyInArrow(
            _across, "a bigint, b bigint").distinct()
        more, _, others = self._verify(cross.join(done, ["a", "b"], "left_anti"), "cross")
        texts = texts.unionByName(others.join(texts, "node", "left_anti"))
        return components(links.unionByName(more), self.parts) if more.head(1) else labels, texts

    def _paired_tiles(self) -> DataFrame:
        """Linked classes with their texts, once for each tile pair that their tile is in."""
        labels, texts = self.connected
        sets = labels.join(self.classes.select("node", "n", "copies"), "node")
        tiles = sets.groupBy("label").agg(F.greatest(
            F.ceil(F.count("*") / TILE), F.ceil(F.sum("n") / TILE_SHINGLES)).cast("int").alias("tiles"))
        sets = sets.join(tiles, "label").join(texts, "node").withColumn(
            "tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        sets = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        sets = sets.withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other"))
        buckets = max(4 * shuffle_partitions(self.spark), self.total // 2_000_000)
        return sets.withColumn("bucket", F.pmod(F.xxhash64("label", "i", "j"), F.lit(buckets))).select(
            *[c.split()[0] for c in TILES.split(", ")])

    def links(self) -> tuple[DataFrame, DataFrame]:
        """(every link (a, b) between distinct sets' nodes, a < b; (doc_id, node) of every row
        with a set). Rows of one node are links of each other."""
        links = self._paired_tiles().groupBy("bucket").applyInArrow(_tiles(True), "a bigint, b bigint")
        node = self.classes.select("h1", "h2", "n", "node")
        return links, self.members.join(node, ["h1", "h2", "n"]).select("doc_id", "node")

    def n_links(self) -> DataFrame:
        """(node, rows of other sets that a linked class links with)."""
        found = self._paired_tiles().groupBy("bucket").applyInArrow(_tiles(False), "node bigint, links bigint")
        return found.groupBy("node").agg(F.sum("links").alias("links"))

    def result(self, counted: bool = False) -> DataFrame:
        """doc_id, n_shingles, component_id (and n_links if ``counted``) of every row of the documents."""
        labels, _ = self.connected
        classes = self.classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        least = classes.groupBy("label").agg(F.min("least").alias("component_id"))
        classes = classes.join(least, "label")
        if counted:
            classes = classes.join(written(self.n_links(), "n-links", parts=self.parts), "node", "left").withColumn(
                "n_links", F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
        more = ["n_links"] if counted else []
        out = self.members.join(classes.select("h1", "h2", "n", "component_id", *more), ["h1", "h2", "n"], "left")
        return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in more])


def query(spark, docs: DataFrame) -> DataFrame:
    return Join(docs).result(counted=True)


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near duplicates: the one with the least doc_id. Rows
    that repeat an id and text go too; rows without an id stay."""
    groups = Join(docs).result()
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    rows = docs.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where(F.col("doc_id").isNull()))
