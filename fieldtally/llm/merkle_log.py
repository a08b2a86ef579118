"""Operator 13: a Merkle manifest of a dataset as a postorder append log.

The leaves of a tree lie in order; every two consecutive nodes of a level have a
parent, a lone last one as well, until one node is left. Nodes are appended to a log
in the order in which they complete: after leaf `e` (from 0) come the parents that it
completes, and when the leaves end, what is still open closes from below. So the
place of a node follows from the sizes of the subtrees in front of it:

    2e - popcount(e) + l                for a full node of level l whose last leaf is e
    2n - popcount(n) + l - tz(n) - 1    for an open one, n leaves in all, tz(n) trailing zeros

Aligned builders each take 2**BITS consecutive leaves. Their subtrees are runs of the
log without gaps, so a builder needs nothing from the others; the roots of all
builders are the leaves of the next tier, and so on until one builder is enough. A
builder addresses siblings by these places, and the siblings above its root come
down from the tier above, so a proof is put together without a lookup per level.

Order is global: rows are sorted by ranges, and a row's number is its place in its
partition plus the rows in front of that partition. Equal rows may lie in several
partitions, so a value or a tree that holds most rows is spread. Only digests and
ids are shuffled; texts are hashed where they are read.

Trees and rows without a value come first. Rows with the same id lie in the order of
their digests; equal rows are interchangeable. NULL fields hash as `-`; a row without
an id is never tampered with. An empty table gives an empty result, other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldtally.llm.basics import cut, table

#: An aligned builder takes 2**BITS leaves.
BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Every so many documents (by the checksum of the id) are tampered with.
TAMPERED = 7


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field with its length in bytes, `-` if NULL."""
    framed = [
        F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-"))
        for f in (field.cast("string") for field in fields)
    ]
    return F.sha2(F.concat(*framed), 256)


# Places in the log


def trailing_zeros(n: int) -> int:
    return (n & -n).bit_length() - 1


def place(level: int, index: int, n: int) -> int:
    """Place of node `index` of `level` in the log of a tree with `n` leaves."""
    last = ((index + 1) << level) - 1
    if last < n:
        return 2 * last - last.bit_count() + level
    return 2 * n - n.bit_count() + level - trailing_zeros(n) - 1


def width(level: int, n: int) -> int:
    """Number of nodes of a level."""
    return -(-n >> level)


def height(n: int, lifted: bool, bits: int = BITS) -> int:
    """Levels above the leaves; a builder among several always goes up to its full height."""
    return bits if lifted else (n - 1).bit_length()


def build(leaves: Sequence[str], lifted: bool, bits: int = BITS) -> list[str]:
    """The log of one builder."""
    n, top = len(leaves), height(len(leaves), lifted, bits)
    log: list[str] = []
    for e, leaf in enumerate(leaves):
        log.append(leaf)
        for level in range(1, min(top, trailing_zeros(e + 1)) + 1):
            left = place(level - 1, 2 * ((e + 1 >> level) - 1), n)
            log.append(digest(log[left], log[-1]))
    for level in range(trailing_zeros(n) + 1, top + 1):
        first = 2 * (n >> level)
        children = range(first, min(first + 2, width(level - 1, n)))
        log.append(digest(*(log[place(level - 1, c, n)] for c in children)))
    return log


def siblings(log: Sequence[str], index: int, n: int, lifted: bool, bits: int = BITS) -> list[str]:
    """Per level, the sibling on the way up from a leaf: `<` or `>` and its digest, `=` for none."""
    way = []
    for level in range(height(n, lifted, bits)):
        at = index >> level
        other = at ^ 1
        if other >= width(level, n):
            way.append("=")
        else:
            way.append(("<" if other < at else ">") + log[place(level, other, n)])
    return way


def fold(leaf: str, way: Sequence[str]) -> str:
    """The root that a leaf and its siblings give."""
    now = leaf
    for step in way:
        side, other = step[0], step[1:]
        now = digest(other, now) if side == "<" else digest(now, other)
    return now


def proof_digest(way: Sequence[str]) -> str:
    return digest(*(step[1:] for step in way))


# Spark


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """`rows` with `__rank` in their tree (missing values first) and its size `__n`."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [tree, *order, "__tie"]
    dealt = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys)
    stored = cut(dealt.sortWithinPartitions(*keys).drop("__tie"))
    at = F.monotonically_increasing_id()
    stored = stored.withColumn("__at", at).withColumns(
        {"__part": F.shiftright("__at", 33), "__at": F.col("__at").bitwiseAND((1 << 33) - 1)}
    )
    counts = cut(
        stored.groupBy(F.col(tree).alias("__tree"), F.col("__part").alias("__of")).agg(
            F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows")
        )
    )
    whole = Window.partitionBy("__tree")
    so_far = F.sum("__rows").over(whole.orderBy("__of"))
    counts = counts.select(
        "__tree",
        "__of",
        (so_far - F.col("__rows") - F.col("__first")).alias("__move"),
        F.sum("__rows").over(whole).alias("__n"),
    )
    same = (F.col("__part") == F.col("__of")) & F.col(tree).eqNullSafe(F.col("__tree"))
    return stored.join(counts, same).select(
        *rows.columns, (F.col("__at") + F.col("__move")).alias("__rank"), "__n"
    )


def _logs(bits: int) -> Callable[..., Column]:
    """The log of each builder, from its leaves and the size of its tree."""

    @F.pandas_udf("array<string>")
    def of(leaves: pd.Series, n: pd.Series) -> pd.Series:
        pairs = zip(leaves, n, strict=True)
        return pd.Series([build(list(x), k > 1 << bits, bits) for x, k in pairs], dtype=object)

    return of


def _ways(bits: int) -> Callable[..., Column]:
    """Siblings of all leaves of each builder, up to the root of all."""

    @F.pandas_udf("array<array<string>>")
    def of(logs: pd.Series, sizes: pd.Series, n: pd.Series, up: pd.Series) -> pd.Series:
        rows = [
            [siblings(log, i, m, k > 1 << bits, bits) + list(above) for i in range(m)]
            for log, m, k, above in zip(logs, sizes, n, up, strict=True)
        ]
        return pd.Series(rows, dtype=object)

    return of


def _proofs(bits: int) -> Callable[..., Column]:
    """Digest of each leaf's proof, and the root that its leaf, changed or not, folds to."""

    @F.pandas_udf("array<struct<proof_sha256:string,folded_root:string>>")
    def of(logs: pd.Series, changed: pd.Series, n: pd.Series, up: pd.Series) -> pd.Series:
        out = []
        for log, others, k, above in zip(logs, changed, n, up, strict=True):
            m, rows = len(others), []
            for i in range(m):
                way = siblings(log, i, m, k > 1 << bits, bits) + list(above)
                leaf = log[place(0, i, m)] if others[i] is None else others[i]
                rows.append({"proof_sha256": proof_digest(way), "folded_root": fold(leaf, way)})
            out.append(rows)
        return pd.Series(out, dtype=object)

    return of


def _builders(rows: DataFrame, items: Column, bits: int) -> DataFrame:
    """One row per builder: its leaves in order, the size of its tree, its log."""
    grouped = rows.groupBy("tree", F.shiftright("rank", bits).alias("block")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(items)).alias("items")
    )
    leaves = F.transform("items", lambda x: x["leaf"])
    return grouped.withColumn("log", _logs(bits)(leaves, F.col("n")))


def tiers(rows: DataFrame, bits: int = BITS) -> list[DataFrame]:
    """Builders of all tiers over leaves (tree, rank, n, leaf, own); `own` rides along."""
    found = [cut(_builders(rows, F.struct("rank", "leaf", "own"), bits))]
    largest = found[0].agg(F.max("n")).first()[0] or 0
    while largest > 1 << bits:
        roots = found[-1].select(
            "tree",
            F.col("block").alias("rank"),
            F.ceil(F.col("n") / (1 << bits)).alias("n"),
            F.element_at("log", -1).alias("leaf"),
        )
        found.append(cut(_builders(roots, F.struct("rank", "leaf"), bits)))
        largest = -(-largest >> bits)
    return found


def descend(found: list[DataFrame], ends: DataFrame, carried: Sequence[str], bits: int) -> DataFrame:
    """The lowest builders with `up`, the siblings above their roots, and what is carried down.

    `ends` are the topmost builders with these columns.
    """
    now = ends
    for lower in reversed(found[:-1]):
        ways = _ways(bits)("log", F.size("items"), "n", "up")
        steps = now.select("tree", "block", *carried, F.posexplode(ways).alias("at", "up"))
        steps = steps.select(
            F.col("tree").alias("__tree"),
            (F.col("block") * (1 << bits) + F.col("at")).alias("__block"),
            "up",
            *carried,
        )
        same = lower["tree"].eqNullSafe(F.col("__tree")) & (lower["block"] == F.col("__block"))
        now = lower.join(steps, same).drop("__tree", "__block")
    return now


def leaves_of(docs: DataFrame, tree: str = "lang") -> DataFrame:
    """Rows (tree, doc_id, leaf, changed): `changed` is the leaf of a tampered row, else NULL."""
    fields = [F.col(f) for f in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    more = [F.col(f) + 1 if f == "n_chars" else F.col(f) for f in FIELDS]
    changed = F.when(hit & F.col("n_chars").isNotNull(), leaf_digest(more))
    return docs.select(
        F.col(tree).alias("tree"), "doc_id", leaf_digest(fields).alias("leaf"), changed.alias("changed")
    )


def manifest(docs: DataFrame, bits: int = BITS) -> tuple[list[DataFrame], list[DataFrame]]:
    """Tiers of the trees per language, and of the tree over their roots."""
    # stored first: finding the ranges reads the rows once more
    rows = numbered(cut(leaves_of(docs)), "tree", ["doc_id", "leaf"])
    own = F.struct("doc_id", "changed").alias("own")
    trees = tiers(rows.select("tree", F.col("__rank").alias("rank"), F.col("__n").alias("n"), "leaf", own), bits)
    subroots = trees[-1].select(
        F.lit("all").alias("tree"), F.col("tree").alias("lang"), F.element_at("log", -1).alias("leaf")
    )
    ranked = numbered(subroots, "tree", ["lang"])
    top = tiers(
        ranked.select(
            "tree", F.col("__rank").alias("rank"), F.col("__n").alias("n"), "leaf", F.col("lang").alias("own")
        ),
        bits,
    )
    return trees, top


def proofs(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """Per row: leaf, roots, digest of the proof and the root it folds to after tampering."""
    trees, top = manifest(docs, bits)
    ends = top[-1].withColumns({"up": F.array().cast("array<string>"), "root": F.element_at("log", -1)})
    lowest = descend(top, ends, ["root"], bits)
    per_tree = lowest.select(
        "root", F.inline(F.arrays_zip("items", _ways(bits)("log", F.size("items"), "n", "up").alias("up")))
    ).select(F.col("items.own").alias("__lang"), "up", "root")
    last = trees[-1]
    ends = last.join(per_tree, last["tree"].eqNullSafe(F.col("__lang"))).drop("__lang")
    ends = ends.withColumn("subroot", F.element_at("log", -1))
    found = descend(trees, ends, ["subroot", "root"], bits)
    changed = F.transform("items", lambda x: x["own"]["changed"])
    checked = _proofs(bits)("log", changed, "n", "up").alias("proof")
    out = found.select("subroot", "root", F.inline(F.arrays_zip("items", checked)))
    return out.select(
        F.col("items.own.doc_id").alias("doc_id"),
        F.col("items.leaf").alias("leaf"),
        "subroot",
        "root",
        "proof.proof_sha256",
        "proof.folded_root",
        (F.col("proof.folded_root") == F.col("root")).alias("verified"),
    )


def log_rows(found: list[DataFrame], bits: int = BITS) -> DataFrame:
    """(tree, position, digest): the append log of all nodes, in the places of the whole tree."""

    @F.pandas_udf("array<struct<position:long,digest:string>>")
    def nodes(logs: pd.Series, sizes: pd.Series, blocks: pd.Series, n: pd.Series, tier: pd.Series) -> pd.Series:
        out = []
        for log, m, block, k, t in zip(logs, sizes, blocks, n, tier, strict=True):
            rows = []
            for level in range(1 if t else 0, height(m, lifted(k, t), bits) + 1):
                for i in range(width(level, m)):
                    at = place(t * bits + level, (block << bits - level) + i, k)
                    rows.append({"position": at, "digest": log[place(level, i, m)]})
            out.append(rows)
        return pd.Series(out, dtype=object)

    def lifted(k: int, t: int) -> bool:
        return -(-k >> t * bits) > 1 << bits

    base = found[0].groupBy(F.col("tree").alias("__tree")).agg(F.max("n").alias("whole"))
    parts = [
        tier.join(base, tier["tree"].eqNullSafe(F.col("__tree"))).select(
            "tree", F.inline(nodes("log", F.size("items"), "block", "whole", F.lit(t)))
        )
        for t, tier in enumerate(found)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op13_merkle_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and its check for every document."""
    return proofs(table(spark, sf_dir, "documents"))
