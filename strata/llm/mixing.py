"""Mixing sources to target weights, in DataFrame functions only.

Sources (by code point, null last) weigh 5, 2, 1, 5, 2, 1 ...; they share a
budget of words, a source's target stops at twice its size, and the excess is
shared again by weight. A source is taken whole as often as its target holds it;
the rest of the target is a draw of documents in the order of a hash of their
ids, so every rerun takes the same ones. Long documents are drawn before short
ones, each length class its share of the rest, and a shorter class makes up for
what the longer ones left open, so that a source ends near its target.

Output shards are filled by a splitting tree. A source's documents form equal
hash ranges (blocks), and each pass over the source offers every block once, the
last pass only those that the draw reaches. At each node of the tree the exact
block quotas of all sources are split between the two halves of its shards by
drawing half of the quota slots without replacement, which is multivariate
hypergeometric; a leaf's quota then takes the source's next blocks in a permuted
order, so shards are disjoint, and rows are shuffled within their shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import materialise, word_count

#: Length classes: documents of more words than the first, than the second, others.
LENGTHS = (1024, 128)
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2
#: Documents in a range over which running sums are taken at once.
RANGE_DOCS = 4096
#: Output shards hold so many words or more; blocks of a source for each shard.
SHARD_WORDS = 2_000_000
MOST_SHARDS = 4096
BLOCKS_PER_SHARD = 4
SEED = "mix"


def place(doc_id: Column) -> Column:
    """A document's place in the draw, 32 hex digits."""
    return F.md5(F.concat(F.lit(SEED + "|"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def _start(at: Column) -> Column:
    """The place's first 32 bits as a number."""
    return F.conv(F.substring(at, 1, 8), 16, 10).cast("long")


def _range(at: Column, number: int) -> Column:
    return F.floor(_start(at) * number / F.lit(float(1 << 32))).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``sizes`` (source, source_size) with each source's ``target``: the level at
    which min(2 x size, level x weight) sums up to the budget."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), ((rank - 1) % len(WEIGHTS) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("most", MOST * F.col("source_size"))
    by = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = F.coalesce(F.sum("most").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (BUDGET * F.sum("source_size").over(every) - before) / weights)
    reached = F.when(F.col("level") <= F.col("most") / F.col("weight"), F.struct(F.col("most") / F.col("weight"), "source", "level"))
    rows = rows.withColumn("at", F.min(reached).over(every)["level"])
    target = F.when(F.col("source_size") == 0, 0.0).otherwise(
        F.least(F.col("most").cast("double"), F.coalesce(F.col("at") * F.col("weight"), F.col("most").cast("double"))))
    return rows.select("source", "source_size", target.alias("target"))


def quotas(slots: DataFrame, shards: int) -> DataFrame:
    """(source, slot, shard) from (source, slot), slots numbered from 1: halves
    the nodes until each is one shard. ``shards`` is a power of two; a node's
    slots are split without replacement in the order of a hash."""
    tree = slots.withColumn("node", F.lit(0))
    for level in range(int(math.log2(shards))):
        drawn = F.row_number().over(Window.partitionBy("node").orderBy(
            F.xxhash64(F.lit(SEED), F.lit(level), "source", "slot"), "source", "slot"))
        half = F.floor((F.count("*").over(Window.partitionBy("node")) + F.pmod(F.xxhash64(F.lit(level), "node"), F.lit(2))) / 2)
        tree = (tree.withColumn("drawn", drawn).withColumn("half", half)
                .select("source", "slot", (2 * F.col("node") + F.when(F.col("drawn") <= F.col("half"), 0).otherwise(1)).alias("node")))
    return tree.withColumnRenamed("node", "shard")


def _drawn(quota: Column) -> Column:
    """Whether the middle of a document's words lies within its class's quota."""
    return (quota > 0) & (2 * F.col("before") + F.col("size") <= 2 * quota)


def draw(docs: DataFrame, carry: list[str]) -> DataFrame:
    """One row per row of ``docs``: struct ``row`` (the columns in ``carry``),
    ``source``, ``size``, ``source_size``, ``target``, ``place``, ``passes`` (times
    the source is taken whole) and ``more`` (whether the rest's draw takes it)."""
    number = max(1, -(-docs.count() // RANGE_DOCS))
    size = word_count(F.col("text"))
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col("source").alias("source"),
                        size.alias("size"), place(F.col("doc_id")).alias("place"))
    length = F.when(F.col("size") > LENGTHS[0], 0).when(F.col("size") > LENGTHS[1], 1).otherwise(2)
    sized = sized.withColumn("length", length).withColumn("range", _range(F.col("place"), number))
    ranges = materialise(sized.groupBy("source", "length", "range").agg(F.sum("size").alias("words")), "mix-ranges")
    goals = targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    goals = goals.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    goals = materialise(goals, "mix-targets")
    before = F.coalesce(F.sum("words").over(Window.partitionBy("source", "length").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    starts = ranges.select(F.col("source").alias("s1"), F.col("length").alias("l1"), F.col("range").alias("r1"), before.alias("ahead"))
    met = sized.join(starts, F.col("source").eqNullSafe(F.col("s1")) & (F.col("length") == F.col("l1")) & (F.col("range") == F.col("r1")))
    within = Window.partitionBy("source", "length", "range").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, 0)
    met = met.withColumn("before", F.col("ahead") + F.sum("size").over(within) - F.col("size"))
    met = materialise(met.select("row", "source", "size", "place", "length", "before"), "mix-sums")
    # class by class: its share of the rest, and what the longer classes left open
    share = (ranges.groupBy("source").pivot("length", [0, 1, 2]).agg(F.sum("words"))
             .select(F.col("source").alias("s2"), *[F.coalesce(F.col(f"`{k}`"), F.lit(0)).alias(f"w{k}") for k in range(3)]))
    plan = goals.join(share, F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    part = F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("q0", part * F.col("w0"))
    for k in range(1, 3):
        known = plan.select(F.col("source").alias("s3"), F.col(f"q{k - 1}").alias("quota"))
        took = (met.where(F.col("length") == k - 1).join(known, F.col("source").eqNullSafe(F.col("s3")))
                .where(_drawn(F.col("quota"))).groupBy(F.col("source").alias("s3")).agg(F.max(F.col("before") + F.col("size")).alias("took")))
        plan = plan.join(took, F.col("source").eqNullSafe(F.col("s3")), "left").drop("s3")
        plan = plan.withColumn(f"t{k - 1}", F.coalesce("took", F.lit(0))).drop("took")
        taken = F.col("t0") if k == 1 else F.col("t0") + F.col("t1")
        quota = part * (F.col("w0") + F.col("w1")) - taken if k == 1 else F.col("rest") - taken
        plan = materialise(plan.withColumn(f"q{k}", quota), "mix-quotas")
    plan = plan.select(F.col("source").alias("s4"), "source_size", "target", "passes", F.array("q0", "q1", "q2").alias("quotas"))
    met = met.join(plan, F.col("source").eqNullSafe(F.col("s4")))
    return met.select("row", "source", "size", "source_size", "target", "place", "passes",
                      _drawn(F.get("quotas", F.col("length"))).alias("more"))


def allocate(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: struct ``row`` (its columns, or those in
    ``carry``), ``size`` (words; null text: 0), ``source_size``, ``target``,
    ``copies`` (0 to 2), ``shards`` (the output shard of each copy) and ``place``.

    Equal ids share a place and are taken in order of size; null ids and null
    sources are values like any other, sources without words have target 0, and
    an empty table gives no rows.
    """
    drawn = draw(docs, docs.columns if carry is None else carry)
    sources = drawn.groupBy("source").agg(F.first("target").alias("target"), F.first("passes").alias("passes"))
    sources = materialise(sources, "mix-sources")
    words = sources.agg(F.sum("target")).first()[0] or 0
    shards = 1 << max(3, min(int(math.log2(MOST_SHARDS)), math.ceil(math.log2(max(1, words / SHARD_WORDS)))))
    blocks = BLOCKS_PER_SHARD * shards
    drawn = drawn.withColumn("block", _range(F.col("place"), blocks))
    # every block once a pass, and once more where the rest's draw reaches it
    whole = sources.select("source", F.explode(F.sequence(F.lit(0), F.col("passes"))).alias("pass"), "passes").where("pass < passes")
    whole = whole.select("source", "pass", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    rest = drawn.where("more").select("source", F.col("passes").alias("pass"), "block").distinct()
    slot = F.row_number().over(Window.partitionBy("source").orderBy(
        F.xxhash64(F.lit(SEED), "source", "pass", "block"), "pass", "block"))
    permuted = materialise(whole.union(rest).withColumn("slot", slot), "mix-slots")
    homes = quotas(permuted.select("source", "slot"), shards).select(F.col("source").alias("s5"), F.col("slot").alias("slot5"), "shard")
    dealt = permuted.join(homes, F.col("source").eqNullSafe(F.col("s5")) & (F.col("slot") == F.col("slot5")))
    dealt = materialise(dealt.groupBy(F.col("source").alias("s6"), F.col("block").alias("block6")).agg(
        F.map_from_entries(F.collect_list(F.struct("pass", "shard"))).alias("homes")), "mix-shards")
    met = drawn.join(dealt, F.col("source").eqNullSafe(F.col("s6")) & (F.col("block") == F.col("block6")), "left")
    copies = F.col("passes") + F.col("more").cast("int")
    found = F.when(copies > 0, F.transform(F.sequence(F.lit(0), copies - 1), lambda k: F.col("homes")[k]))
    return met.select("row", "size", "source_size", "target", copies.alias("copies"),
                      F.coalesce(found, F.array().cast("array<int>")).alias("shards"), "place")


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents with their ``shard``, each as often as it is taken, one
    partition holding whole shards, rows in a permuted order within the shard.
    Same columns otherwise; a column named ``shard`` gives way."""
    taken = allocate(docs).select("row", "place", F.posexplode("shards").alias("copy", "home"))
    order = F.xxhash64("place", "copy")
    spread = taken.withColumn("order", order).repartition("home").sortWithinPartitions("home", "order")
    return spread.select(*[F.col(f"row.`{c}`") for c in docs.columns if c.lower() != "shard"], F.col("home").alias("shard"))
