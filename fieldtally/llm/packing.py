"""Operator 5: best-fit packing of documents into sequences, with conflicts.

Texts are measured in words and cut into pieces of at most one sequence. Rows are
dealt by hash into shards of bounded size; inside a shard pieces go, those of
large clusters first and then the largest first, into the open sequence with the smallest residual that holds them. Open
sequences are ordered by residual and carry two bitmaps: the duplicate clusters
that they hold, and the sources that have reached their share of the sequence. A
sequence that shares a bit with the piece is skipped and the search goes on to
its successors until the tightest compatible one is found; if there is none, a
new sequence opens. So no sequence holds two members of a duplicate cluster, and
no source starts another document in one where it has its share.

Bits are numbered per shard, so they never stand for two sources or clusters. A
group of copies that holds a third of all rows is spread over all shards.

NULL and empty texts have no words: one row without a sequence. Equal rows are
packed each for itself, as members of one cluster. A NULL source is a source. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm.basics import cut, row_key, table, word_count


@dataclass(frozen=True)
class PackPlan:
    """Words to a sequence, words to a shard, and a source's share of a sequence."""

    capacity: int = 2048
    shard_words: int = 1 << 20
    source_share: float = 0.5
    seed: int = 5


PLAN = PackPlan()
PLACE = "shard int, sequence int, offset int"
OUTPUT = f"doc_id long, piece int, first_word long, words int, {PLACE}"


def best_fit(
    sizes: list[int], sources: list[int], clusters: list[int], capacity: int, share: float
) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece, in the order given.

    `sources` and `clusters` are bit numbers, -1 where a piece has no cluster to
    share with another. A piece that fills a sequence has it alone.
    """
    open_: list[tuple[int, int]] = []  # residual, sequence
    cluster_bits: list[int] = []
    source_bits: list[int] = []
    source_words: list[dict[int, int]] = []
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        bit = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(open_, (size, -1))
        while at < len(open_):
            sequence = open_[at][1]
            if not (cluster_bits[sequence] & bit or source_bits[sequence] >> source & 1):
                break
            at += 1
        if at < len(open_):
            residual, sequence = open_.pop(at)
        else:
            residual, sequence = capacity, len(cluster_bits)
            cluster_bits.append(0)
            source_bits.append(0)
            source_words.append({})
        placed.append((sequence, capacity - residual))
        cluster_bits[sequence] |= bit
        words = source_words[sequence]
        words[source] = words.get(source, 0) + size
        if words[source] >= share * capacity:
            source_bits[sequence] |= 1 << source
        if residual > size:
            insort(open_, (residual - size, sequence))
    return placed


def _pack_shard(plan: PackPlan) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # clusters of many members first, as each member needs a sequence of its own
        members = frame.groupby("cluster")["cluster"].transform("size")
        frame = frame.assign(members=members).sort_values(
            ["members", "words", "a", "b", "piece"],
            ascending=[False, False, True, True, True],
            kind="stable",
        )
        shared = frame["members"] > 1
        clusters = pd.factorize(frame["cluster"].where(shared))[0].tolist()
        sources = pd.factorize(frame["source"])[0].tolist()
        placed = best_fit(
            frame["words"].tolist(), sources, clusters, plan.capacity, plan.source_share
        )
        frame["sequence"] = [p[0] for p in placed]
        frame["offset"] = [p[1] for p in placed]
        return frame[[x.split()[0] for x in OUTPUT.split(", ")]]

    return run


def pack(docs: DataFrame, plan: PackPlan = PLAN) -> DataFrame:
    """One row per piece: its words [first_word, first_word + words) of the document,
    the shard, the sequence in it, and the offset in the sequence.

    `docs` needs doc_id, text and source; a `cluster` column of longs, if it has
    one, names duplicate clusters, else equal lower-cased texts are one.
    """
    cluster = (
        F.col("cluster").cast("long")
        if "cluster" in docs.columns
        else F.xxhash64(F.lower("text"))
    )
    key = row_key("doc_id", "text", "source")
    rows = cut(
        docs.select(
            "doc_id",
            word_count(F.col("text")).alias("all_words"),
            F.xxhash64("source").alias("source"),
            cluster.alias("cluster"),
            key.alias("key"),
        ).select("*", "key.a", "key.b")
    )
    total = rows.agg(F.sum("all_words")).first()[0] or 0
    shards = max(1, math.ceil(total / plan.shard_words))
    capacity = F.lit(plan.capacity)
    starts = F.sequence(
        F.lit(0).cast("long"), F.col("all_words") - 1, capacity.cast("long")
    )
    pieces = rows.where("all_words > 0").select(
        "doc_id", "source", "cluster", "a", "b", "all_words",
        F.posexplode(starts).alias("piece", "first_word"),
    ).select(
        "doc_id", "source", "cluster", "a", "b", "piece", "first_word",
        F.least(F.col("all_words") - F.col("first_word"), capacity).cast("int").alias("words"),
        # every piece is dealt for itself, so a very long text is no burden to one shard
        F.pmod(F.xxhash64("a", "b", "piece", F.lit(plan.seed)), F.lit(shards)).cast("int").alias("shard"),
    )
    packed = pieces.groupBy("shard").applyInPandas(_pack_shard(plan), OUTPUT)
    empty = rows.where("all_words = 0").select(
        "doc_id",
        F.lit(0).alias("piece"),
        F.lit(0).cast("long").alias("first_word"),
        F.lit(0).alias("words"),
        *(F.lit(None).cast("int").alias(x) for x in ("shard", "sequence", "offset")),
    )
    return packed.unionByName(empty)


def op5_conflict_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of the production length."""
    return pack(table(spark, sf_dir, "documents"))
