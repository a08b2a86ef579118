"""Operator 10: near-duplicates by SimHash with covering hash tables.

Every bit position belongs to one of the nonzero vectors over `radius + 1` bits,
and each such vector also names a table whose mask holds the positions with an odd
inner product. Two fingerprints that differ in at most `radius` positions leave
some vector orthogonal to all of those positions' vectors, so they agree under
that table's mask: every pair within the radius meets in some table. Candidates
are compared exactly.

Documents with one fingerprint are one node, so copies never meet. A bucket with
few fingerprints is compared pair by pair. In a larger one each fingerprint is
written under itself and under each flip of a single bit outside the mask: two
fingerprints agree in one of these exactly when they differ in at most two bits,
so linking all holders of a value to its smallest holder keeps the components with
a number of rows in proportion to the bucket. (For other radii than 2 the flips
are taken up to half the radius, and the same holds for even ones.)

NULL and empty texts have fingerprint zero and link like any other; repeated rows
keep their place; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm.basics import cut, row_key, table
from fieldtally.llm.components import components

BITS = 64
RADIUS = 2
WORDS = 3
SEED = 42
#: Buckets of more fingerprints are linked by flips instead of pairs.
PAIRED = 16


def text_fingerprint(text: str | None, words: int = WORDS) -> int:
    """SimHash of the lower-cased word shingles, as a signed 64-bit number."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: max(1, len(tokens) - words + 1)].tolist()
    stops = ends[min(words, len(tokens)) - 1 :].tolist()
    hash_ = xxhash.xxh64_intdigest
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 1 << 16):
        part = [
            hash_(line[a:b], SEED)
            for a, b in zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)], strict=True)
        ]
        rows = np.array(part, "<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(rows, axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * total > len(starts), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint(text: Column, words: int = WORDS) -> Column:
    """Column form of `text_fingerprint`."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([text_fingerprint(t, words) for t in texts], dtype="int64")

    return of(text)


def masks(radius: int = RADIUS) -> list[int]:
    """One mask of bit positions per table; 2 ** (radius + 1) - 1 of them."""
    vectors = range(1, 2 ** (radius + 1))
    owner = [bit % len(vectors) + 1 for bit in range(BITS)]
    return [
        sum(1 << bit for bit in range(BITS) if (owner[bit] & v).bit_count() % 2) for v in vectors
    ]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) over distinct fingerprints `fp` with the same components as all links."""
    tables = masks(radius)
    keys = F.explode(
        F.array(
            *(
                F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                for t, m in enumerate(tables)
            )
        )
    )
    rows = nodes.select("fp", keys.alias("k")).select("fp", "k.*")
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # only fingerprints that meet another one go on
    meeting = cut(rows.join(cut(sizes), ["t", "key"]))
    few = meeting.where(F.col("n") <= PAIRED).groupBy("t", "key").agg(
        F.sort_array(F.collect_list("fp")).alias("fps")
    )
    pairs = few.select(
        F.explode(
            F.flatten(
                F.transform(
                    "fps",
                    lambda x, i: F.transform(
                        F.filter("fps", lambda y, j: (j > i) & (F.bit_count(x.bitwiseXOR(y)) <= radius)),
                        lambda y: F.struct(x.alias("u"), y.alias("v")),
                    ),
                )
            )
        ).alias("e")
    ).select("e.*")
    flips = F.element_at(F.array(*(_flips(m, radius) for m in tables)), F.col("t") + 1)
    spread = meeting.where(F.col("n") > PAIRED).select(
        "fp", F.explode(flips).alias("flip")
    ).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value")).distinct()
    least = cut(
        spread.groupBy("value").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("value", "v")
    )
    stars = spread.join(least, "value").where("fp <> v").select(F.col("fp").alias("u"), "v")
    return pairs.unionByName(stars).distinct()


def _flips(mask: int, radius: int) -> Column:
    """XOR values of up to radius // 2 bits outside the mask."""
    free = [bit for bit in range(BITS) if not mask >> bit & 1]
    chosen = [c for k in range(radius // 2 + 1) for c in combinations(free, k)]
    return F.array(*(F.lit(_signed(sum(1 << b for b in c))).cast("long") for c in chosen))


def grouped(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key, fp) of `docs`, and (of, root) for every fingerprint `of`."""
    if radius % 2:
        raise ValueError("the radius must be even")
    rows = cut(
        docs.select(
            "doc_id", row_key("doc_id", "text").alias("key"), fingerprint(F.col("text"), words).alias("fp")
        )
    )
    nodes = cut(rows.select("fp").distinct())
    found = cut(components(links(nodes, radius)))
    rooted = nodes.join(found, F.col("fp") == F.col("node"), "left")
    return rows, cut(rooted.select(F.col("fp").alias("of"), F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id): the smallest id reachable through links."""
    rows, roots = grouped(docs, words, radius)
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = first.join(roots, F.col("fp") == F.col("of")).select("of", "root", "first")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = cut(named.join(least, "root").select("of", "component_id"))
    return rows.join(named, F.col("fp") == F.col("of")).select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """`docs` with one row of each component: the one of the smallest id, missing ids last."""
    rows, roots = grouped(docs, words, radius)
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "key")
    first = rows.groupBy("fp").agg(F.min(order).alias("first"))
    kept = first.join(roots, F.col("fp") == F.col("of")).groupBy("root").agg(F.min("first")["key"].alias("__kept"))
    kept = cut(kept.select("__kept"))
    joined = docs.withColumn("__key", row_key("doc_id", "text")).join(kept, F.col("__key") == F.col("__kept"))
    repeated = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.take(1):  # rows that are equal in id and text: one of them stays
        joined = joined.dropDuplicates(["__key"])
    return joined.select(*docs.columns)


def op10_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
