"""Operator 12: shards by a hierarchical weighted hash tree.

A tree has regions, regions have racks, racks have shards, and every shard has a
weight; an inner node weighs what its shards weigh. A row descends from the root:
each child draws a uniform number from the hash of the row's key and the child's
name, and the smallest exponential waiting time -ln(u) / weight wins. So a child is
chosen in proportion to its weight, and whether a row goes from one child to another
depends on these two alone: where no weight below a node changes, no row moves
between its children, and rows move only towards what became heavier or away from
what became lighter. All draws are Spark expressions on one column.

`grown` adds a shard as a region of its own. The draws of the old regions stay as
they are, so the new shard takes rows only into itself. (A shard that joins an old
region would make that region heavier, and rows that enter it would also come to its
old shards.)

The number of a row in its shard (`slot`) needs no task that holds a shard: equal
rows are counted before any shuffle, counts are summed per hash block of the shard,
and running sums inside a block and over the blocks give each distinct row its first
slot. Rows equal in all columns are interchangeable; their slots are written in
chunks that spread over the tasks.

A NULL text has no bytes, so size 1 and CRC 0. Rows without an id share one key and
therefore one shard. Repeated rows get slots of their own, an empty table gives an
empty result, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldtally.llm.basics import cut, table

#: Region -> rack -> shard -> weight.
Tree = Mapping[str, Mapping[str, Mapping[int, int]]]

#: Two regions of two racks of four shards.
SIXTEEN: Tree = {
    f"region{g}": {
        f"rack{k}": {8 * g + 4 * k + s: 1 for s in range(4)} for k in range(2)
    }
    for g in range(2)
}
#: Blocks per shard in which slots are counted.
BLOCKS = 4096
#: Slots of equal rows that one task writes at a time.
CHUNK = 4096


def weight(node: Mapping | int) -> int:
    """Weight of a shard or of all shards below a node."""
    return node if isinstance(node, int) else sum(map(weight, node.values()))


def shards(tree: Tree) -> list[int]:
    return [s for racks in tree.values() for leaves in racks.values() for s in leaves]


def grown(tree: Tree, shard_weight: int = 1) -> Tree:
    """The tree with one more shard, in a region and a rack of its own."""
    new = max(shards(tree), default=-1) + 1
    return {**tree, f"region+{new}": {f"rack+{new}": {new: shard_weight}}}


def _wait(key: Column, path: str, node: Mapping | int) -> Column:
    """Exponential waiting time of a child, from 53 bits of its hash."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11)
    uniform = (bits + F.lit(0.5)) * F.lit(2.0**-53)
    return -F.ln(uniform) / F.lit(float(weight(node)))


def _winner(key: Column, path: str, children: Mapping) -> Column:
    """Position of the child that waits least; ties go to the first."""
    heavy = [(i, name, node) for i, (name, node) in enumerate(children.items()) if weight(node) > 0]
    if len(heavy) == 1:
        return F.lit(heavy[0][0])
    draws = [
        F.struct(_wait(key, f"{path}/{name}", node).alias("wait"), F.lit(i).alias("child"))
        for i, name, node in heavy
    ]
    return F.array_min(F.array(*draws))["child"]


def _descend(key: Column, path: str, node: Mapping, levels: int) -> Column:
    """Array of child positions from this node down; only the chosen branch is drawn."""
    chosen = _winner(key, path, node)
    if levels == 1:
        return F.array(chosen)
    rest = [
        F.when(chosen == i, F.concat(F.array(F.lit(i)), _descend(key, f"{path}/{name}", child, levels - 1)))
        for i, (name, child) in enumerate(node.items())
        if weight(child) > 0
    ]
    return F.coalesce(*rest)


def place(key: Column, tree: Tree) -> Column:
    """Struct (region, rack, shard) of the shard that `key` descends to."""
    if weight(tree) <= 0:
        raise ValueError("the tree has no shard of positive weight")
    leaves = [
        ((i, j, k), region, rack, shard)
        for i, (region, racks) in enumerate(tree.items())
        for j, (rack, members) in enumerate(racks.items())
        for k, shard in enumerate(members)
    ]
    names = F.create_map(
        *(
            x
            for at, region, rack, shard in leaves
            for x in (
                F.lit("/".join(map(str, at))),
                F.struct(
                    F.lit(region).alias("region"), F.lit(rack).alias("rack"), F.lit(shard).alias("shard")
                ),
            )
        )
    )
    way = F.array_join(_descend(key, "", tree, 3).cast("array<string>"), "/")
    return F.element_at(names, way)


def sharded(docs: DataFrame, tree: Tree = SIXTEEN, key: str = "doc_id") -> DataFrame:
    """`docs` with the place of each row in one more column, `__place`."""
    return docs.withColumn("__place", place(F.col(key), tree))


def write_shards(docs: DataFrame, path: str, tree: Tree = SIXTEEN, files: int = 8) -> None:
    """Whole documents as parquet, one folder per shard with `files` files each."""
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(files))
    rows = sharded(docs).withColumn("shard", F.col("__place")["shard"]).drop("__place")
    rows.repartition("shard", part).write.partitionBy("shard").parquet(path)


def with_slots(rows: DataFrame, shard: str = "shard") -> DataFrame:
    """`rows` with `slot`, gapless from 0 in each shard, in an order of hashes and values."""
    columns = rows.columns
    counted = cut(
        rows.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("__copies"))
        .withColumn("__block", F.pmod(F.xxhash64(*columns), F.lit(BLOCKS)))
    )
    sums = counted.groupBy(shard, "__block").agg(F.sum("__copies").alias("__rows"))
    over_blocks = Window.partitionBy(shard).orderBy("__block")
    begins = sums.withColumn("__begin", F.sum("__rows").over(over_blocks) - F.col("__rows"))
    inside = Window.partitionBy(shard, "__block").orderBy(*columns).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    first = cut(
        counted.join(begins.drop("__rows"), [shard, "__block"]).withColumn(
            "__first", F.col("__begin") + F.sum("__copies").over(inside) - F.col("__copies")
        )
    )
    last = F.col("__first") + F.col("__copies") - 1
    few = first.where(F.col("__copies") <= CHUNK).withColumn(
        "slot", F.explode(F.sequence("__first", last))
    )
    start = F.explode(F.sequence(F.col("__first"), last, F.lit(CHUNK).cast("long")))
    many = first.where(F.col("__copies") > CHUNK).withColumn("__start", start)
    many = many.repartition(shard, "__start").withColumn(
        "slot", F.explode(F.sequence("__start", F.least(last, F.col("__start") + CHUNK - 1)))
    )
    return reduce(DataFrame.unionByName, (part.select(*columns, "slot") for part in (few, many)))


def op12_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot and the shard of a tree with one more, for every document."""
    docs = table(spark, sf_dir, "documents")
    now, then = place(F.col("doc_id"), SIXTEEN), place(F.col("doc_id"), grown(SIXTEEN))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        now.alias("now"),
        then["shard"].alias("grown_shard"),
    ).select("doc_id", "size", "text_crc32", "grown_shard", "now.*")
    return with_slots(rows).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard",
        "region", "rack",
    )
