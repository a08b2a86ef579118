"""Operator 7: mix sources to target weights by a hypergeometric splitting tree.

Every source's documents are dealt by hash into blocks, as many as its words fill,
and its blocks into a pseudo-random order. Ranks and sums along that order come in
two steps, over stretches of it and inside each, so no task holds a source's blocks. A target in words becomes an exact quota of block draws:
whole passes over the source, then the first blocks of one more pass, the last
of them in part. A binary tree splits the quotas of all sources among the output
shards: at each node the draws of the left half are multivariate hypergeometric,
so a shard is what a full shuffle would give it, but the tree handles counts
only. The draws a leaf gets are disjoint ranges of the permuted blocks, and its
documents are ordered by hash. Built-in functions only; reruns agree.

`targets` looks at all sources in one task, and a node of the tree holds one number
for each of them: meant for up to some hundred thousand sources.

Sources sort by code point, NULL last; a NULL source is a source. NULL and empty
texts have size 0 and are never taken. Equal rows share a place in the order and
are taken alike or at the edge of a quota in either order. An empty table gives
an empty mix. Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldtally.llm.basics import cut, row_key, table, word_count


@dataclass(frozen=True)
class MixPlan:
    """Weights repeat over the ordered sources and share `share` of all words."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most_repeats: int = 2
    #: Blocks of a source at least.
    blocks_per_source: int = 16
    shard_words: int = 1_000_000
    #: Blocks whose words fill a shard.
    blocks_per_shard: int = 32
    #: Blocks of a stretch of a source's order, about.
    stretch: int = 4096
    seed: int = 7


PLAN = MixPlan()


def sized(docs: DataFrame, plan: MixPlan = PLAN) -> DataFrame:
    """Rows with their key, size and place in their block."""
    key = row_key("doc_id", "text", "source")
    return docs.select("doc_id", "text", "source").select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        key.alias("key"),
    ).withColumn("place", F.xxhash64("key", F.lit(plan.seed + 1)))


def in_blocks(rows: DataFrame, plan: MixPlan = PLAN) -> DataFrame:
    """`rows` with their block; a source has as many as its words fill."""
    filled = F.ceil(F.sum("size") * plan.blocks_per_shard / plan.shard_words)
    sources = cut(
        rows.groupBy(F.col("source").alias("of")).agg(
            F.greatest(filled, F.lit(plan.blocks_per_source)).cast("long").alias("dealt")
        )
    )
    joined = rows.join(sources, F.col("source").eqNullSafe(F.col("of")))
    block = F.pmod(F.xxhash64("key", F.lit(plan.seed)), F.col("dealt"))
    return joined.withColumn("block", block).drop("of", "dealt")


def targets(blocks: DataFrame, plan: MixPlan = PLAN) -> DataFrame:
    """One row per source with its size and target.

    Sharing an excess again until no target is above its bound ends at
    min(bound, level * weight) for one level, found from running sums over the
    sources in order of bound / weight.
    """
    sources = blocks.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    by_name = everything.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in plan.weights)),
        (F.row_number().over(by_name) - 1) % len(plan.weights) + 1,
    )
    bound = F.col("source_size") * float(plan.most_repeats)
    rows = sources.select(
        "source",
        "source_size",
        F.row_number().over(by_name).alias("rank"),
        weight.alias("w"),
        bound.alias("bound"),
        (F.sum("source_size").over(everything) * plan.share).alias("wanted"),
    )
    by_level = everything.orderBy(F.col("bound") / F.col("w"), "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("wanted") - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum(
        "w"
    ).over(after)
    rows = rows.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("w") <= F.col("bound"), F.col("level"))
    return rows.withColumn("level", F.max(fits).over(everything)).select(
        "source",
        "rank",
        "source_size",
        F.least("bound", F.coalesce(F.col("level") * F.col("w"), F.col("bound"))).alias("target"),
    )


def quotas(blocks: DataFrame, goals: DataFrame, plan: MixPlan = PLAN) -> DataFrame:
    """Per block: whole passes, words of one more pass, and its ranks among the draws.

    `passes` counts full passes that hold the block; `extra` is how many of its
    words the last pass takes (NULL for none). `draws` are its places in the
    source's order of draws.
    """
    rows = blocks.join(goals, blocks["source"].eqNullSafe(goals["source"])).drop(goals["source"])
    dealt = F.greatest(
        F.ceil(F.col("source_size") * plan.blocks_per_shard / plan.shard_words), F.lit(plan.blocks_per_source)
    )
    spot = F.pmod(F.xxhash64("block", F.lit(plan.seed + 2)), F.lit(1 << 31))
    # stretches divide the order evenly by the spot
    stretch = F.floor(F.col("spot") / float(1 << 31) * F.ceil(dealt / plan.stretch))
    rows = rows.withColumn("spot", spot).withColumn("stretch", stretch)
    whole = Window.partitionBy("rank")
    before = whole.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("rank", "stretch").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")
    ).select(
        "rank",
        "stretch",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("words").over(before), F.lit(0)).alias("words_before"),
        F.sum("n").over(whole).alias("blocks"),
    )
    order = Window.partitionBy("rank", "stretch").orderBy("spot", "block")
    rows = rows.join(sums, ["rank", "stretch"]).withColumns(
        {
            "at": F.col("n_before") + F.row_number().over(order) - 1,
            "start": F.col("words_before") + F.sum("size").over(order) - F.col("size"),
            "full": F.floor(
                F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)
            ),
        }
    )
    rest = F.col("target") - F.col("full") * F.col("source_size") - F.col("start")
    rows = rows.withColumn("extra", F.when(rest > 0, F.least(rest, F.col("size").cast("double"))))
    passes = F.transform(
        F.sequence(F.lit(0), F.col("full").cast("int")), lambda p: p * F.col("blocks") + F.col("at")
    )
    last = F.when(F.col("extra").isNotNull(), F.col("full") + 1).otherwise(F.col("full"))
    return rows.withColumn("draws", F.slice(passes, F.lit(1), last.cast("int")))


def _hypergeometric(n: Column, rest: Column, left: Column, u: Column) -> Column:
    """How many of `left` draws fall among `n` of `n + rest` items, from a uniform `u`.

    Inverse distribution function over twelve deviations around the mean, which
    the support bounds; the weights follow from the first by the ratio of
    neighbours.
    """
    n, rest, left = (x.cast("double") for x in (n, rest, left))
    all_ = n + rest
    mean = F.when(all_ > 0, left * n / all_).otherwise(0.0)
    spread = 12 * F.sqrt(
        F.when(all_ > 1, mean * (rest / all_) * ((all_ - left) / (all_ - 1))).otherwise(0.0)
    ) + 12
    lowest = F.greatest(F.lit(0.0), left - rest, F.floor(mean - spread).cast("double"))
    highest = F.least(n, left, F.ceil(mean + spread).cast("double"))
    steps = F.sequence(lowest.cast("long"), highest.cast("long"))

    def ratio(k: Column) -> Column:
        return ((n - k + 1) * (left - k + 1)) / (k * (rest - left + k))

    def next_weight(state: Column, k: Column) -> Column:
        return F.when(state["weight"] < 0, F.lit(1.0)).otherwise(state["weight"] * ratio(k.cast("double")))

    before = F.struct(F.lit(-1.0).alias("weight"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("below"))

    def walk(state: Column, k: Column, stop: Column) -> Column:
        weight = next_weight(state, k)
        return F.struct(
            weight.alias("weight"),
            (state["sum"] + weight).alias("sum"),
            (state["below"] + (state["sum"] + weight < stop).cast("long")).alias("below"),
        )

    # once for the sum of all weights, once for the place of `u` in it
    total = F.aggregate(steps, before, lambda s, k: walk(s, k, F.lit(0.0)), lambda s: s["sum"])
    below = F.aggregate(
        F.array(u * total),
        F.lit(0).cast("long"),
        lambda _, stop: F.aggregate(steps, before, lambda s, k: walk(s, k, stop), lambda s: s["below"]),
    )
    return lowest.cast("long") + below


#: The tree grows in one task for so many levels; then its nodes are dealt out.
SPREAD_LEVELS = 6


def split_tree(sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """(rank, shard, low, high): the draws [low, high) of a source that a shard gets.

    `sources` has `rank` and `draws`; shards differ by one draw at most.
    """
    listed = F.array_sort(F.collect_list(F.struct("rank", "draws")))
    nodes = sources.agg(listed.alias("s")).select(
        F.lit(0).alias("shard"),
        F.lit(shards).alias("width"),
        F.transform("s", lambda x: x["draws"]).alias("n"),
        F.transform("s", lambda x: F.lit(0).cast("long")).alias("low"),
        F.transform("s", lambda x: x["rank"]).alias("ranks"),
    )
    for level in range(max(0, math.ceil(math.log2(shards)))):
        if level and level % SPREAD_LEVELS == 0:  # the nodes are many by now
            nodes = nodes.repartition("shard")
        total = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
        half = F.floor((F.col("width") + 1) / 2).cast("int")
        nodes = nodes.withColumns({"total": total, "half": half})
        start = F.struct(
            F.array().cast("array<bigint>").alias("drawn"),
            F.col("total").alias("items"),
            F.round(F.col("total") * F.col("half") / F.col("width")).cast("long").alias("todo"),
        )

        nodes = nodes.withColumn("level", F.lit(level))

        def draw(state: Column, x: Column) -> Column:
            uniform = (
                F.pmod(
                    F.xxhash64(F.lit(seed), "level", "shard", F.size(state["drawn"])),
                    F.lit(1 << 52),
                )
                + 0.5
            ) / float(1 << 52)
            got = _hypergeometric(x, state["items"] - x, state["todo"], uniform)
            return F.aggregate(
                F.array(got),
                state,
                lambda s, k: F.struct(
                    F.concat(s["drawn"], F.array(k)).alias("drawn"),
                    (s["items"] - x).alias("items"),
                    (s["todo"] - k).alias("todo"),
                ),
            )

        left = F.aggregate("n", start, draw, lambda s: s["drawn"])
        nodes = nodes.withColumn("left", left)
        sides = F.array(
            F.struct(
                F.col("shard").alias("shard"),
                F.col("half").alias("width"),
                F.col("left").alias("n"),
                F.col("low").alias("low"),
            ),
            F.struct(
                (F.col("shard") + F.col("half")).alias("shard"),
                (F.col("width") - F.col("half")).alias("width"),
                F.zip_with("n", "left", lambda a, b: a - b).alias("n"),
                F.zip_with("low", "left", lambda a, b: a + b).alias("low"),
            ),
        )
        split = F.when(F.col("width") > 1, sides).otherwise(
            F.array(F.struct("shard", "width", "n", "low"))
        )
        nodes = nodes.select("ranks", F.explode(split).alias("x")).select("ranks", "x.*")
    leaves = F.explode(F.arrays_zip("ranks", "n", "low"))
    return nodes.select("shard", leaves.alias("x")).select(
        F.col("x.ranks").alias("rank"),
        "shard",
        F.col("x.low").alias("low"),
        (F.col("x.low") + F.col("x.n")).alias("high"),
    )


def mix(docs: DataFrame, plan: MixPlan = PLAN) -> DataFrame:
    """Every row's part in the mix: doc_id, key, size, source_size, target, taken, shards.

    `shards` lists the shard of each time the row is taken; `place` orders a shard.
    """
    rows = cut(in_blocks(cut(sized(docs, plan)), plan))
    blocks = rows.groupBy("source", "block").agg(F.sum("size").alias("size"))
    blocks = cut(blocks)
    goals = cut(targets(blocks, plan))
    draws = cut(quotas(blocks, goals, plan))
    words = draws.agg(F.sum(F.col("full") * F.col("size") + F.coalesce("extra", F.lit(0.0)))).first()
    shards = max(1, math.ceil((words[0] or 0) / plan.shard_words))
    counts = draws.groupBy("rank").agg(F.sum(F.size("draws")).alias("draws"))
    ranges = split_tree(counts, shards, plan.seed).where("high > low")
    # stored, so that its size is known where it is joined
    dealt = cut(
        ranges.select(
            "rank", "shard", F.explode(F.sequence("low", F.col("high") - 1)).alias("draw")
        )
    )
    placed = (
        draws.select("rank", "block", F.posexplode("draws").alias("turn", "draw"))
        .join(dealt, ["rank", "draw"])
        .groupBy("rank", "block")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "shard"))).alias("turns"))
    )
    quota = cut(
        draws.join(placed, ["rank", "block"], "left").select(
            F.col("source").alias("of"),
            F.col("block").alias("in_block"),
            "source_size",
            "target",
            F.col("full").cast("long").alias("full"),
            "extra",
            F.transform("turns", lambda t: t["shard"]).alias("shards"),
        )
    )
    joined = rows.join(
        quota, (F.col("block") == F.col("in_block")) & F.col("source").eqNullSafe(F.col("of"))
    )
    inside = Window.partitionBy("source", "block").orderBy("place", "key", "doc_id")
    middle = F.sum("size").over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ) - F.col("size") / 2
    once_more = F.coalesce(middle <= F.col("extra"), F.lit(False))
    times = F.when(F.col("size") == 0, 0).otherwise(F.col("full") + once_more.cast("long"))
    return joined.withColumn("times", times).select(
        "doc_id",
        "key",
        "size",
        "source_size",
        "target",
        (F.col("times") * F.col("size")).alias("taken"),
        F.slice(
            F.coalesce("shards", F.array().cast("array<int>")), F.lit(1), F.col("times").cast("int")
        ).alias("shards"),
        "place",
    )


def mixed_documents(docs: DataFrame, plan: MixPlan = PLAN) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is taken.

    A partition holds whole shards, and a shard's rows follow its order, so files
    written from the result are shards in turn.
    """
    # Rows that are equal in key are one group here, so that the join multiplies none.
    # They lie in one block, so the longest list of shards holds those of all.
    turns = mix(docs, plan).groupBy(F.col("key").alias("__of")).agg(
        F.sum(F.size("shards")).alias("__turns"),
        F.count(F.lit(1)).alias("__copies"),
        F.max(F.struct(F.size("shards").alias("n"), "shards"))["shards"].alias("__shards"),
        F.first("place").alias("__place"),
    ).where("__turns > 0")
    keyed = docs.withColumn("__key", row_key("doc_id", "text", "source"))
    joined = keyed.join(turns, F.col("__key") == F.col("__of"))
    # equal rows share their turns: the first ones in any order get one more
    least = F.floor(F.col("__turns") / F.col("__copies"))
    more = F.col("__turns") - least * F.col("__copies")
    number = F.when(more == 0, least).otherwise(
        least
        + (
            F.row_number().over(Window.partitionBy("__key").orderBy("__key")) <= more
        ).cast("long")
    )
    return (
        joined.withColumn("__n", number.cast("int"))
        .where("__n > 0")
        .select(*docs.columns, "__place", F.explode(F.slice("__shards", F.lit(1), F.col("__n"))).alias("__shard"))
        .repartition("__shard")
        .sortWithinPartitions("__shard", "__place")
        .select(*docs.columns)
    )


def op7_hypergeometric_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents, with the shards that hold each."""
    docs = table(spark, sf_dir, "documents")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "shards")
