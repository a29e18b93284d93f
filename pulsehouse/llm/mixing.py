"""Mixing sources to target word counts (DataFrame functions only).

1. Targets: sources in code-point order (NULL last) get the weights in turn and
   share ``RATIO`` times all words; no source gives more than ``CAP`` times its
   own words, the excess goes to the others by weight.
2. Supply: a source's words are laid out copy after copy, each copy's documents
   in an order drawn for that copy. The mix takes the front of that line, up to
   the target: so no document gives more than ``CAP`` times its words, and only
   the last document taken of a source is cut.
3. Blocks: what is taken of a source is cut into blocks of about
   ``BLOCK_WORDS`` words; their number is the source's exact block quota.
4. Splitting tree: the root holds the quotas of all sources; each node halves
   its blocks between two children, drawing how many of each source go left
   from the multivariate hypergeometric distribution. After ``levels`` halvings
   every leaf is an output shard whose block counts differ by one at most, and
   each source's quota is used up exactly. The draw is made in two steps, first
   between groups of ``SOURCES_PER_GROUP`` sources, then inside every group with
   what its group drew, so that no row of the tree holds all sources.
5. Draw: shards take disjoint runs of the source's permuted blocks, and every
   shard orders its documents by its own hash.

Defined cases: NULL text has size 0 and is never taken; a source without words
has target 0; rows that repeat are separate supply, told apart by a number
(their order among equals does not matter, as they are equal). Rows are named by
128 bits. Any number of sources is mixed: the table of their targets (one row a
source, ordered in one task) is broadcast up to ``BROADCAST_SOURCES`` rows and
joined by a shuffle beyond.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GAP, let, shuffle_partitions, written

RATIO = 1.5
CAP = 2
WEIGHTS = (3.0, 1.0, 2.0)
BLOCK_WORDS = 20_000       # least block; with more words than that per place, blocks grow
BLOCKS_PER_SHARD = 256     # most blocks of an output shard
BROADCAST_SOURCES = 100_000
SOURCES_PER_GROUP = 1_000
SEED = 20_240_607
NAME = ["uid", "uid2"]     # the two halves of a row's name


def n_words(text: Column) -> Column:
    squeezed = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " "))
    return F.when(squeezed == "", F.lit(0).cast("bigint")).otherwise(
        (F.length(squeezed) - F.length(F.replace(squeezed, F.lit(" "), F.lit(""))) + 1).cast("bigint"))


def targets(sources: DataFrame, weights=WEIGHTS, ratio: float = RATIO, cap: float = CAP) -> DataFrame:
    """(source, source_size) -> + weight, target.

    Sources capped first are those of least size per weight. With them in that
    order, the level (words per unit of weight) left for source i and all after
    it is what remains over their weights. It rises as long as the sources
    before are rightly capped and falls afterwards, so the greatest one holds.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights)))
    s = sources.withColumn("weight", w).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = s.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(ratio)))
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
                     / F.sum("weight").over(after))
    level = F.max("level").over(everything)
    return s.withColumn("target", F.least(F.col("limit"), level * F.col("weight"))
                        ).select("source", "source_size", "weight", "target")


def _unit(*cols) -> Column:
    """A number in [0, 1) from a hash of its arguments and the seed."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *cols), 11) / F.lit(float(1 << 53))


def _descend(node: DataFrame, levels: int, given: bool) -> DataFrame:
    """(shard 0, q: array of source_no and blocks[, share: blocks of every leaf]) -> (source_no, shard, blocks).

    A node's blocks are passed over one after the other, source by source, and
    go left with probability (places left)/(blocks left): selection sampling,
    whose counts per source are multivariate hypergeometric. A node's places
    are half its blocks, or (``given``) those of the leaves below it.
    """
    zero = F.lit(0).cast("bigint")
    state = "struct<need:bigint,rest:bigint,left:array<bigint>>"
    for level in range(levels):
        half = 2 ** (levels - level - 1)
        total = F.aggregate("q", zero, lambda a, x: a + x["blocks"])
        places = (F.aggregate(F.slice("share", 1, half), zero, lambda a, x: a + x) if given
                  else F.ceil(total / 2).cast("bigint"))

        def pick(acc, x):  # noqa: B023 (called at once)
            start = F.struct(acc["need"].alias("need"), acc["rest"].alias("rest"), zero.alias("got"))

            def one(a, k):
                hit = _unit(F.lit(given), F.lit(level), F.col("shard"), x["source_no"], k) * a["rest"] < a["need"]
                step = F.when(hit, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
                return F.struct((a["need"] - step).alias("need"), (a["rest"] - 1).alias("rest"),
                                (a["got"] + step).alias("got"))
            end = F.aggregate(F.sequence(F.lit(1).cast("bigint"), x["blocks"]), start, one)
            return let(end, lambda e: F.struct(
                e["need"].alias("need"), e["rest"].alias("rest"),
                F.concat(acc["left"], F.array(e["got"])).alias("left")).cast(state))
        begin = F.struct(places.alias("need"), total.alias("rest"),
                         F.array().cast("array<bigint>").alias("left")).cast(state)
        node = node.withColumn("left", F.aggregate("q", begin, pick, lambda e: e["left"]))

        def side(blocks):
            rows = F.zip_with("q", "left", lambda x, n: F.struct(
                x["source_no"].alias("source_no"), blocks(x["blocks"], n).alias("blocks")))
            return F.filter(rows, lambda x: x["blocks"] > 0).alias("q")

        def child(number: int, q: Column) -> Column:
            below = [F.slice("share", 1 + number * half, half).alias("share")] if given else []  # noqa: B023
            return F.struct((F.col("shard") * 2 + number).alias("shard"), q, *below)
        node = node.select(F.explode(F.array(
            child(0, side(lambda all_, n: n)), child(1, side(lambda all_, n: all_ - n)))).alias("n")).select("n.*")
    return node.select("shard", F.explode("q").alias("x")).select("x.source_no", "shard", "x.blocks")


def split_tree(quotas: DataFrame, levels: int) -> DataFrame:
    """(source_no, blocks) -> (source_no, shard, blocks above 0): exact splits of all quotas,
    first between groups of sources, then in each group, given the group's blocks of every shard
    (together the same distribution as one draw between all sources)."""
    def listed(number: str) -> Column:
        return F.array_sort(F.collect_list(F.struct(F.col(number).alias("source_no"), "blocks"))).alias("q")
    groups = quotas.where("blocks > 0").groupBy(F.floor(F.col("source_no") / SOURCES_PER_GROUP).alias("grp")).agg(
        listed("source_no"), F.sum("blocks").alias("blocks"))
    groups = written(groups, "mix-groups")
    top = written(_descend(groups.agg(listed("grp")).select(F.lit(0).alias("shard"), "q"), levels, False), "mix-top")
    share = F.transform(F.sequence(F.lit(0), F.lit(2**levels - 1)),
                        lambda i: F.coalesce(F.try_element_at("of", i), F.lit(0).cast("bigint")))
    shares = top.groupBy(F.col("source_no").alias("grp")).agg(F.map_from_entries(F.collect_list(
        F.struct("shard", "blocks"))).alias("of")).select("grp", share.alias("share"))
    return _descend(groups.join(shares, "grp").select(F.lit(0).alias("shard"), "q", "share"), levels, True)


def row_name(docs: DataFrame) -> list[Column]:
    """Two 64-bit hashes of all columns of a row, NULLs told by their place."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    cols += [c.isNull() for c in cols]
    return [F.xxhash64(*cols).alias("uid"), F.xxhash64(F.lit(SEED), *cols).alias("uid2")]


def supply(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per document: uid, uid2 (hashes of all its columns), nth (tells equal rows
    apart), source, size. Written once, as two passes read it.

    Equal rows of a task are one row with their number until the numbers of the tasks before
    are known, so any number of them is spread over as many tasks as read them."""
    rows = docs.select(*row_name(docs), *[F.col(f"`{c}`") for c in keep],
                       F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"),
                       F.spark_partition_id().alias("part"))
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("m"))
    before = Window.partitionBy(*NAME).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0).cast("bigint")))
    rows = rows.repartition(*NAME, "part").withColumn(
        "nth", F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("m"))))
    return written(rows.drop("part", "m", "before"), "mix-supply")


def _with_targets(rows: DataFrame, goal: DataFrame, *cols: str) -> DataFrame:
    """Rows with their source's columns of ``goal`` (a written table)."""
    table = goal.select(F.col("source").alias("s"), *cols)
    table = F.broadcast(table) if goal.count() <= BROADCAST_SOURCES else table.hint("merge")
    return rows.join(table, F.col("source").eqNullSafe(F.col("s"))).drop("s")


def plan(sizes: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """(copies taken: uid, uid2, nth, copy, words, size, shard, shuffle_key; targets by source).

    ``sizes`` is :func:`supply`. Prefix sums run over slices of a source's line, each slice a bounded
    range of the permutation hash, so a source with a third of all rows is
    many window partitions.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    src = written(src, "mix-sources")
    goal = targets(src.select("source", "source_size")).join(src.select(
        F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    goal = goal.withColumn("source_no", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())).cast("bigint"))
    goal = goal.withColumn("take", F.round("target").cast("bigint"))
    block = F.greatest(F.lit(float(BLOCK_WORDS)), F.sum("take").over(Window.partitionBy())
                       / (BLOCKS_PER_SHARD * 2**levels))
    goal = goal.withColumn("blocks", F.ceil(F.col("take") / block).cast("bigint"))
    goal = written(goal, "mix-targets")

    rows = _with_targets(sizes.where(F.col("size") > 0), goal, "source_no", "source_size", "take", "blocks", "n")
    copies = F.explode(F.sequence(F.lit(0), F.ceil(F.lit(float(CAP))).cast("int") - 1)).alias("copy")
    rows = rows.select("*", copies).where(F.col("copy") * F.col("source_size") < F.col("take"))
    rows = rows.withColumn("place", _unit("copy", *NAME, "nth"))
    slices = F.greatest(F.lit(1), F.ceil(F.col("n") / 2000)).cast("int")
    rows = rows.withColumn("slice", F.floor(F.col("place") * slices).cast("int"))
    line = Window.partitionBy("source_no", "copy", "slice").orderBy("place", *NAME, "nth")
    within = line.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("in_slice", F.coalesce(F.sum("size").over(within), F.lit(0)))
    offs = rows.groupBy("source_no", "copy", "slice").agg(F.sum("size").alias("w"))
    so_far = Window.partitionBy("source_no", "copy").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offs = offs.select("source_no", "copy", "slice", F.coalesce(F.sum("w").over(so_far), F.lit(0)).alias("base"))
    rows = rows.join(offs, ["source_no", "copy", "slice"])
    rows = rows.withColumn("at", F.col("copy") * F.col("source_size") + F.col("base") + F.col("in_slice"))
    rows = rows.where(F.col("at") < F.col("take"))
    rows = rows.withColumn("words", F.least(F.col("size"), F.col("take") - F.col("at")))
    rows = rows.withColumn("block", F.floor(F.col("at") * F.col("blocks") / F.col("take")).cast("bigint"))

    tree = split_tree(goal.where("blocks > 0").select("source_no", "blocks"), levels)
    upto = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = tree.withColumn("first", F.coalesce(F.sum("blocks").over(upto), F.lit(0))).where("blocks > 0")
    # the draw: a run of positions in the source's permuted order of blocks
    drawn = runs.select("source_no", "shard", F.explode(F.sequence(
        F.col("first"), F.col("first") + F.col("blocks") - 1)).alias("block"))
    rows = rows.join(drawn, ["source_no", "block"])
    rows = rows.select(*NAME, "nth", "copy", "words", "size", "shard", F.xxhash64(
        F.lit(SEED + 1), "shard", "copy", *NAME, "nth").alias("shuffle_key"))
    return rows, goal


def levels_for(spark) -> int:
    """Enough leaves for one output shard per shuffle partition."""
    return max(1, (shuffle_partitions(spark) - 1).bit_length())


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    ends = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    return F.array_join(F.slice(ends, F.lit(1), n.cast("int")), "")


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: the documents' columns, copies as separate rows, one
    partition's shards in shuffled order; a source's last document is cut at a
    word end. Rows need the columns text and source."""
    chosen, _ = plan(supply(docs), levels_for(docs.sparkSession))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(*row_name(docs), F.struct(*cols).alias("row")).dropDuplicates(NAME)
    out = chosen.join(rows, NAME)
    cut = F.when(F.col("words") < F.col("size"), first_words(F.col("row.text"), F.col("words"))
                 ).otherwise(F.col("row.text"))
    out = out.repartition("shard").sortWithinPartitions("shard", "shuffle_key")

    def column(c: str) -> Column:
        if c == "text":
            return cut
        if c == "n_chars":     # follows a cut text
            return F.when(F.col("words") < F.col("size"), F.length(cut).cast(docs.schema[c].dataType)).otherwise(
                F.col("row.n_chars"))
        return F.col(f"row.`{c}`")
    return out.select(*[column(c).alias(c) for c in docs.columns])


def query(spark, docs: DataFrame) -> DataFrame:
    """The words taken per document; n_shards, first_shard: the output shards they went to (0 and NULL for none)."""
    sizes = supply(docs.select("doc_id", "text", "source"), "doc_id")
    chosen, goal = plan(sizes, levels_for(spark))
    taken = chosen.groupBy(*NAME, "nth").agg(       # at most CAP copies
        F.sum("words").alias("taken"), F.size(F.collect_set("shard")).alias("n_shards"), F.min("shard").alias("first_shard"))
    rows = _with_targets(sizes, goal, "source_size", "target").join(taken, [*NAME, "nth"], "left")
    return rows.select("doc_id", "size", F.col("source_size").cast("bigint").alias("source_size"), "target",
                       F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
                       F.coalesce("n_shards", F.lit(0)).alias("n_shards"), "first_shard")
