"""Operators 7 and 5, and the whole pipeline."""

import collections
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldtally.llm import mixing, packing
from fieldtally.llm.queries import CORPUS_QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_targets(sizes, weights=(3, 1, 2), share=1.5):
    """Shares of all words, the excess over twice the size given on until none is left."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + [None] * (None in sizes)
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[n] for n in open_)
        above = {n for n in open_ if level * w[n] > 2 * sizes[n]}
        if not above:
            return {**target, **{n: level * w[n] for n in open_}}
        for n in above:
            target[n] = 2.0 * sizes[n]
            left -= target[n]
        open_ -= above
    return target


def check_mix(docs, rows, near=0.03):
    sizes, taken, by_id = collections.Counter(), collections.Counter(), {}
    for r in docs.collect():
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
        by_id[r["doc_id"]] = r["source"]
    target = plain_targets(sizes)
    assert len(rows) == docs.count()
    for r in rows:
        source = by_id[r["doc_id"]]
        taken[source] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(target[source], abs=1e-6)
        assert len(r["shards"]) * r["size"] == r["taken"]
    longest = max((r["size"] for r in rows), default=0)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(near * target[s], longest), s


@pytest.mark.parametrize("table", ["corpus", "odd", "empty"])
def test_mix_of_documents(request, spark, at, table):
    docs = request.getfixturevalue(table)
    folder = at(docs)
    rows = CORPUS_QUERIES["op7_hypergeometric_mix"](spark, folder).collect()
    check_mix(docs, rows)
    again = CORPUS_QUERIES["op7_hypergeometric_mix"](spark, folder)
    assert sorted(map(str, rows)) == sorted(map(str, again.collect()))


def test_mix_with_a_hot_source_and_many_shards(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat('word ', int(1 + id % 40))").alias("text"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 101 = 0 THEN NULL ELSE concat('s', id % 7) END").alias("source"),
    )
    plan = mixing.MixPlan(blocks_per_source=64, shard_words=4000)
    rows = mixing.mix(docs, plan).collect()
    check_mix(docs, rows, near=0.01)
    words = collections.Counter()
    for r in rows:
        for s in r["shards"]:
            words[s] += r["size"]
    mean = sum(words.values()) / len(words)
    assert len(words) > 20 and max(words.values()) < 2 * mean and min(words.values()) > 0.4 * mean
    mixed = mixing.mixed_documents(docs, plan)
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {r["doc_id"]: len(r["shards"]) for r in rows if r["shards"]}


def test_blocks_follow_the_size(spark):
    """Thousands of shards, a source far larger than the others, stretches of few blocks."""
    docs = spark.range(60000).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat('w ', int(1 + id % 7))").alias("text"),
        F.expr("CASE WHEN id % 40 > 0 THEN 'large' ELSE concat('s', id % 3) END").alias("source"),
    )
    plan = mixing.MixPlan(shard_words=200, blocks_per_shard=20, blocks_per_source=1, stretch=50)
    rows = mixing.mix(docs, plan).collect()
    check_mix(docs, rows, near=0.001)
    words = collections.Counter()
    for r in rows:
        for s in r["shards"]:
            words[s] += r["size"]
    assert len(words) > 1500 and set(words) == set(range(len(words)))
    assert max(words.values()) < 2 * plan.shard_words and min(words.values()) > plan.shard_words / 2


def test_mix_keeps_shards_together_and_shares_the_turns_of_equal_rows(spark):
    docs = spark.range(400).select(
        F.expr("CASE WHEN id % 4 = 0 THEN 7 ELSE id END").alias("doc_id"),
        F.expr("CASE WHEN id % 4 = 0 THEN 'a b c' ELSE concat('w ', repeat('x ', int(id % 9))) END").alias("text"),
        F.expr("CASE WHEN id % 4 < 2 THEN 's' ELSE concat('t', id % 2) END").alias("source"),
    ).replace({"t0": "s", "t1": "t"}, subset="source")
    plan = mixing.MixPlan(share=0.4, shard_words=100)
    part = mixing.mix(docs, plan).collect()
    taken, places = collections.Counter(), collections.defaultdict(set)
    for r in part:
        taken[r["doc_id"]] += len(r["shards"])
        places[r["doc_id"]] |= set(r["shards"])
    mixed = mixing.mixed_documents(docs, plan).withColumn("at", F.spark_partition_id()).collect()
    assert collections.Counter(r["doc_id"] for r in mixed) == +taken
    parts = collections.defaultdict(set)
    for r in mixed:
        if len(places[r["doc_id"]]) == 1:
            parts[min(places[r["doc_id"]])].add(r["at"])
    assert len(parts) > 2 and all(len(p) == 1 for p in parts.values())


@pytest.mark.parametrize("shards", [1, 2, 5, 16])
def test_tree_splits_quotas_exactly(spark, shards):
    quota = {1: 700, 2: 30, 3: 0, 4: 101}
    rows = mixing.split_tree(spark.createDataFrame(sorted(quota.items()), "rank int, draws long"), shards, 3).collect()
    for rank, n in quota.items():
        ranges = sorted((r["low"], r["high"]) for r in rows if r["rank"] == rank and r["high"] > r["low"])
        assert [x for a, b in ranges for x in range(a, b)] == list(range(n))
    sizes = collections.Counter()
    for r in rows:
        sizes[r["shard"]] += r["high"] - r["low"]
    assert len(sizes) == shards and max(sizes.values()) - min(sizes.values()) <= shards.bit_length()


def test_draws_are_hypergeometric(spark):
    n, rest, left = 20, 30, 15
    u = (F.col("id") + 0.5) / 20000.0
    got = spark.range(20000).select(mixing._hypergeometric(F.lit(n), F.lit(rest), F.lit(left), u).alias("k"))
    counts = {r["k"]: r["count"] for r in got.groupBy("k").count().collect()}
    from math import comb

    for k in range(left + 1):
        wanted = comb(n, k) * comb(rest, left - k) / comb(n + rest, left)
        assert counts.get(k, 0) / 20000 == pytest.approx(wanted, abs=2e-4)


def test_best_fit_takes_the_tightest_compatible_sequence():
    # 7 opens 0, 6 opens 1, 3 fits 0 exactly, 4 fits 1 exactly
    assert packing.best_fit([7, 6, 4, 3], [0, 1, 2, 3], [-1] * 4, 10, 2) == [(0, 0), (1, 0), (1, 6), (0, 7)]
    # the tightest holds the same cluster, so the successor is taken
    assert packing.best_fit([7, 6, 3], [0, 1, 2], [5, -1, 5], 10, 2) == [(0, 0), (1, 0), (1, 6)]
    # a source that has its share opens another sequence
    assert packing.best_fit([6, 3], [0, 0], [-1, -1], 10, 0.5) == [(0, 0), (1, 0)]
    assert packing.best_fit([10, 10], [0, 0], [-1, -1], 10, 0.5) == [(0, 0), (1, 0)]


def check_packing(docs, rows, plan):
    texts = [(r["doc_id"], r["text"] or "", r["source"]) for r in docs.collect()]
    sizes = collections.Counter()
    for i, t, _ in texts:
        sizes[i] += len(WORD.findall(t))
    words, spans = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        words[r["doc_id"]] += r["words"]
        if r["words"]:
            spans[r["shard"], r["sequence"]].append((r["offset"], r["offset"] + r["words"], r["doc_id"]))
    assert +words == +sizes
    cluster = {i: t.lower() for i, t, _ in texts}
    for parts in spans.values():
        parts.sort()
        assert parts[0][0] == 0 and parts[-1][1] <= plan.capacity
        assert all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
        assert len({cluster[p[2]] for p in parts}) == len(parts)
    return spans


@pytest.mark.parametrize("table", ["corpus", "odd", "empty"])
def test_packing_of_documents(request, spark, at, table):
    docs = request.getfixturevalue(table)
    rows = CORPUS_QUERIES["op5_conflict_best_fit"](spark, at(docs)).collect()
    check_packing(docs, rows, packing.PLAN)
    assert {str(r["doc_id"]) for r in rows} == {str(r["doc_id"]) for r in docs.collect()}


def test_packing_with_a_third_of_copies(spark):
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'Same text in all of these' ELSE concat(repeat('w ', int(1 + id % 90)), id) END").alias("text"),
        F.expr("concat('s', id % 4)").alias("source"),
    )
    plan = packing.PackPlan(capacity=100, shard_words=5000)
    rows = packing.pack(docs, plan).collect()
    spans = check_packing(docs, rows, plan)
    assert len({s for s, _ in spans}) > 3
    full = sum(r["words"] for r in rows) / 100
    assert len(spans) < 1.25 * full


def test_pipeline_stages(spark, corpus, odd, empty):
    for docs in (corpus, odd, empty):
        now, counts = docs, [docs.count()]
        for name, stage in corpus_pipeline.STAGES:
            before = now
            now = stage(spark, before, "/root/testdata/sf0.001").persist()
            counts.append(now.count())
            if name != corpus_pipeline.STAGES[-1][0]:
                assert now.columns == docs.columns
                if name != "PII":
                    kept = {(r["doc_id"], r["text"]) for r in before.collect()}
                    assert all((r["doc_id"], r["text"]) in kept for r in now.collect())
        assert counts[2] <= counts[1] <= counts[0] and counts[3] == counts[2]
        if docs is corpus:
            assert counts[1] >= 0.98 * counts[0]


def test_pipeline_query(spark):
    rows = CORPUS_QUERIES.get("pipeline", corpus_pipeline.run)(spark, "/root/testdata/sf0.001")
    assert rows.count() and set(rows.columns) >= {"doc_id", "shard", "sequence", "offset"}
