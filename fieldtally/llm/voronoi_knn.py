"""Operator 3: exact top-k search by inner product as a Voronoi kNN join.

Pivots are a sample of the queries. Queries form groups and data form cells by the
pivot nearest to them. A cell is summed up by its count, its inner and outer radius
and its norms, a group likewise, and from these summaries follow the least and the
greatest inner product between any vector of a cell and any query of a group. The
least products of the best cells, by count, give a score that every query of a
group reaches; a cell goes to a group only if its greatest product reaches it too.

Small groups next to each other travel as one bundle and a large one as several, so
a cell is sent once to one task that loops over the groups of a bundle; there a
vector x meets a group with center p and radius r only if p.x + r |x| reaches the
score. Cells are dealt to parts of bounded size, so no task ever holds a whole cell
or all data. What is shuffled is the product of data and queries divided by the
size of a bundle, plus the same divided by the size of a part.

Equal vectors are one vector with its k + 1 smallest ids. The sample of pivots is
bounded; everything else covers all rows, and the result is exact.

Vectors that are NULL or hold NULL, NaN or an infinity take no part, nor do rows
without an id; components beyond a vector's length count as 0. Rows of the query's
own id are never its candidates, and repeated rows of an id and vector count once.
An id with several vectors asks with each of them, and its k best scores are those
over all of them; as a candidate it counts once per vector. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldtally.llm.basics import cut, table


@dataclass(frozen=True)
class KnnPlan:
    k: int = 5
    #: Queries to a pivot on average.
    group: int = 256
    #: Queries of a bundle at most, on average where a group is dealt to several.
    block: int = 16_384
    #: Vectors of a part of a cell on average.
    packed: int = 8192
    most_pivots: int = 1024


PLAN = KnnPlan()
#: Queries that are multiplied with a part at once.
AT_ONCE = 512


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and the components as floor(256 x), longs."""
    x = F.col("embedding")
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * 256))
    bad = F.exists(
        x,
        lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")),
    )
    return rows.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")
    )


def _distinct(rows: DataFrame, most: int) -> DataFrame:
    """Distinct vectors `v` with their `most` smallest ids."""
    order = Window.partitionBy("v").orderBy("vec_id")
    first = rows.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _matrix(vectors: list, width: int, dtype: type = np.int64) -> np.ndarray:
    if len(vectors) and all(len(v) == width for v in vectors):
        return np.array(list(vectors), dtype)
    out = np.zeros((len(vectors), width), dtype)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows; by floating point where that is exact."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2**52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


@dataclass(frozen=True)
class Groups:
    """Centers (m, d), radii and blocks of the query groups; bounded by `most_pivots`."""

    centers: np.ndarray
    radii: np.ndarray
    blocks: np.ndarray


def _nearest(vectors: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest center of each vector and the distance."""
    v, c = vectors.astype(np.float64), centers.astype(np.float64)
    squares = (v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)[None, :]
    nearest = squares.argmin(1)
    return nearest, np.sqrt(((v - c[nearest]) ** 2).sum(1))


def _bounds(vectors: np.ndarray, groups: Groups) -> tuple[np.ndarray, np.ndarray]:
    """p.x and r |x| for all pairs, (n, m)."""
    v = vectors.astype(np.float64)
    return v @ groups.centers.T.astype(np.float64), np.sqrt((v * v).sum(1))[:, None] * groups.radii


#: Rounding of the bounds; far above it, and far below a step of integer scores.
SLACK = 1e-6


@dataclass(frozen=True)
class Summaries:
    """Per pivot: rows, distances to it and norms of what is nearest to it."""

    count: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    least: np.ndarray
    most: np.ndarray

    @staticmethod
    def of(near: DataFrame, pivots: int, count: Column) -> Summaries:
        """From rows with near, distance and norm; one row a pivot comes to the driver."""
        rows = near.groupBy("near").agg(
            count.alias("n"), F.min("distance"), F.max("distance"), F.min("norm"), F.max("norm")
        )
        out = np.zeros((5, pivots))
        for r in rows.collect():
            out[:, r["near"]] = r[1:]
        return Summaries(*out)


def cell_bounds(centers: np.ndarray, cells: Summaries, groups: Summaries) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product between cell c and group g, (c, g).

    By the triangle inequality on both sides of q.x = p.s + p.(x - s) + (q - p).x,
    and on the distance in 2 q.x = |q|^2 + |x|^2 - |q - x|^2.
    """
    c = centers.astype(np.float64)
    norms = np.sqrt((c * c).sum(1))
    dot = c @ c.T
    apart = np.sqrt(np.maximum(norms[:, None] ** 2 + norms**2 - 2 * dot, 0.0))
    reach = norms * cells.outer[:, None] + groups.outer * cells.most[:, None]
    nearest = np.maximum(
        np.maximum(apart - groups.outer - cells.outer[:, None], cells.inner[:, None] - apart - groups.outer), 0.0
    )
    farthest = apart + groups.outer + cells.outer[:, None]
    high = (groups.most**2 + cells.most[:, None] ** 2 - nearest**2) / 2
    low = (groups.least**2 + cells.least[:, None] ** 2 - farthest**2) / 2
    slack = SLACK * (1 + reach + np.abs(dot) + farthest**2 + groups.most**2 + cells.most[:, None] ** 2)
    return np.maximum(dot - reach, low) - slack, np.minimum(dot + reach, high) + slack


def sure_scores(low: np.ndarray, cells: Summaries, needed: int) -> np.ndarray:
    """Per group the greatest score that at least `needed` candidates reach."""
    order = np.argsort(-low, axis=0, kind="stable")
    held = np.cumsum(cells.count[order], axis=0) >= needed
    at = held.argmax(0)
    groups = np.arange(low.shape[1])
    return np.where(held.any(0), low[order[at, groups], groups], -np.inf)


def bundles(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The bundle of every group, and the blocks that a bundle is dealt to."""
    bundle, blocks, held = np.zeros(len(counts), np.int64), [], 0
    for g, n in enumerate(counts):
        if not blocks or held + n > most:
            blocks.append(1)
            held = 0
        held += n
        bundle[g] = len(blocks) - 1
        blocks[-1] = max(1, math.ceil(held / most))
    return bundle, np.array(blocks, np.int64)


@dataclass(frozen=True)
class Shape:
    """Width and whole-number type of all vectors."""

    width: int
    dtype: type
    spark_type: str


def _shape(clean: DataFrame) -> Shape:
    width, low, high = clean.agg(
        F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))
    ).first()
    top = max(-(low or 0), high or 0)
    for bits, dtype, name in ((15, np.int16, "smallint"), (31, np.int32, "int")):
        if top < 2**bits:
            return Shape(max(width or 0, 1), dtype, name)
    return Shape(max(width or 0, 1), np.int64, "bigint")


def _assign(centers: np.ndarray, shape: Shape, ids: Callable[[pd.DataFrame], dict]) -> Callable:
    """The nearest pivot, the distance to it, the norm and the packed vector."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x = _matrix(f["v"].tolist(), shape.width, shape.dtype)
            near, distance = _nearest(x, centers)
            norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
            yield pd.DataFrame(
                {"near": near.astype(np.int32), "distance": distance, "norm": norm, "x": [r.tobytes() for r in x], **ids(f)}
            )

    return run


PACK = "bundle int, block int, cell int, part int, x binary, ids binary, more binary"
PACK_KEY = ("bundle", "block", "cell", "part")
#: Packs that are handed on together.
HANDED = 64


def _packs(targets: Callable, part_of: list[str], more: str, kind: type) -> Callable:
    """Rows of equal `part_of`, packed and sent to each of their `targets`."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for of, part in f.groupby(part_of):
                data = tuple(b"".join(part[c]) for c in ("x", "ids"))
                for target in targets(*(int(o) for o in of)):
                    rows.append((*target, *data, part[more].to_numpy(kind).tobytes()))
                    if len(rows) == HANDED:
                        yield pd.DataFrame(rows, columns=[*PACK_KEY, "x", "ids", "more"])
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=[*PACK_KEY, "x", "ids", "more"])

    return run


def _best(query: int, line: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The k best candidates of one query among vectors with scores `line`."""
    wanted = k + int((ids == query).any(1).sum())
    if len(line) > wanted:  # every vector that ties with the last stays
        some = np.flatnonzero(line >= np.partition(line, len(line) - wanted)[len(line) - wanted])
    else:
        some = np.arange(len(line))
    used = np.arange(ids.shape[1]) < known[some][:, None]
    names, found = ids[some][used], np.repeat(line[some], known[some])
    others = names != query
    names, found = names[others], found[others]
    order = np.lexsort((names, -found))[:k]
    return [(query, int(s), int(i)) for s, i in zip(found[order], names[order], strict=True)]


def _solve(groups: Groups, least: np.ndarray, shape: Shape, k: int) -> Callable:
    """The k best of one part of a cell for each query of one bundle."""

    def run(asking: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(asking) and len(data):
            q = np.frombuffer(b"".join(asking["x"]), shape.dtype).reshape(-1, shape.width)
            numbers = np.frombuffer(b"".join(asking["ids"]), np.int64)
            of = np.frombuffer(b"".join(asking["more"]), np.int32)
            x = np.frombuffer(b"".join(data["x"]), shape.dtype).reshape(-1, shape.width)
            ids = np.frombuffer(b"".join(data["ids"]), np.int64).reshape(-1, k + 1)
            known = np.frombuffer(b"".join(data["more"]), np.int32)
            for g in np.unique(of):
                mine = np.flatnonzero(of == g)
                one = Groups(groups.centers[[g]], groups.radii[[g]], groups.blocks)
                middle, reach = _bounds(x, one)
                slack = SLACK * (1 + np.abs(middle) + reach)
                some = np.flatnonzero((middle + reach + slack)[:, 0] >= least[g])
                for at in range(0, len(mine) if len(some) else 0, AT_ONCE):
                    block = mine[at : at + AT_ONCE]
                    for number, line in zip(numbers[block], _product(q[block], x[some]), strict=True):
                        out += _best(int(number), line, ids[some], known[some], k)
        return pd.DataFrame(out, columns=["query_id", "score", "vec_id"], dtype="int64")

    return run


def _pivots(asked: DataFrame, wanted: int, width: int) -> np.ndarray:
    """A sample of the distinct queries, neighbours along the widest direction in order."""
    vectors = asked.select("v").distinct()
    sample = vectors.orderBy(F.xxhash64("v"), "v").limit(wanted).collect()
    centers = _matrix([r["v"] for r in sample], width)
    spread = centers - centers.mean(0)
    direction = np.linalg.eigh(spread.T @ spread)[1][:, -1]
    return centers[np.argsort(spread @ direction, kind="stable")]


def top_k(rows: DataFrame, is_query: Column, plan: KnnPlan = PLAN) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of `rows` (vec_id, embedding) in `is_query`."""
    spark, k = rows.sparkSession, plan.k
    clean = usable(rows)
    shape = _shape(clean)
    clean = clean.withColumn("v", F.col("v").cast(f"array<{shape.spark_type}>"))
    asked = cut(clean.where(is_query).distinct())
    asking = asked.count()
    if not asking:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centers = _pivots(asked, min(plan.most_pivots, math.ceil(asking / plan.group)), shape.width)
    pivots = len(centers)

    def query_ids(f: pd.DataFrame) -> dict:
        return {"ids": [np.int64(i).tobytes() for i in f["vec_id"]], "deal": f["deal"]}

    def data_ids(f: pd.DataFrame) -> dict:
        padded = (np.array([*x, *[-1] * (k + 1 - len(x))], np.int64) for x in f["ids"])
        return {"ids": [p.tobytes() for p in padded], "known": [len(x) for x in f["ids"]], "deal": f["deal"]}

    placed = "near int, distance double, norm double, x binary, ids binary, "
    queries = cut(
        asked.withColumn("deal", F.xxhash64("v", "vec_id")).mapInPandas(
            _assign(centers, shape, query_ids), placed + "deal long"
        )
    )
    data = cut(
        _distinct(clean, k + 1).withColumn("deal", F.xxhash64("v")).mapInPandas(
            _assign(centers, shape, data_ids), placed + "known int, deal long"
        )
    )
    groups = Summaries.of(queries, pivots, F.count(F.lit(1)))
    cells = Summaries.of(data, pivots, F.sum("known"))
    parts_of = {
        r["near"]: math.ceil(r["count"] / plan.packed) for r in data.groupBy("near").count().collect()
    }
    parts = np.array([parts_of.get(c, 0) for c in range(pivots)])
    # an id may lose as many candidates as it has vectors itself
    own = asked.groupBy("vec_id").count().agg(F.max("count")).first()[0]
    low, high = cell_bounds(centers, cells, groups)
    low[cells.count == 0] = -np.inf
    least = sure_scores(low, cells, k + own)
    bundle, blocks = bundles(groups.count, plan.block)
    wanted = (high >= least) & (cells.count > 0)[:, None] & (groups.count > 0)
    meets = np.stack([wanted[:, bundle == b].any(1) for b in range(len(blocks))])  # (bundle, cell)

    def of_queries(b: int, block: int) -> Iterator[tuple]:
        return ((b, block, int(c), p) for c in np.flatnonzero(meets[b]) for p in range(parts[c]))

    def of_data(cell: int, part: int) -> Iterator[tuple]:
        return ((int(b), n, cell, part) for b in np.flatnonzero(meets[:, cell]) for n in range(blocks[b]))

    def looked_up(values: np.ndarray, at: str | Column) -> Column:
        at = F.col(at) if isinstance(at, str) else at
        return F.element_at(F.array(*(F.lit(int(max(v, 0))) for v in values)), at + 1)

    dealt = queries.withColumn("bundle", looked_up(bundle, "near")).withColumn(
        "block", F.pmod("deal", looked_up(blocks, "bundle"))
    )
    sent = dealt.select("bundle", "block", "x", "ids", "near").mapInPandas(
        _packs(of_queries, ["bundle", "block"], "near", np.int32), PACK
    )
    split = data.withColumn("part", F.pmod("deal", F.greatest(looked_up(parts, "near"), F.lit(1))))
    met = split.select("near", "part", "x", "ids", "known").mapInPandas(
        _packs(of_data, ["near", "part"], "known", np.int32), PACK
    )
    radii = Groups(centers, groups.outer * (1 + SLACK), blocks)
    partial = sent.groupBy(*PACK_KEY).cogroup(met.groupBy(*PACK_KEY)).applyInPandas(
        _solve(radii, least, shape, k), "query_id long, score long, vec_id long"
    )
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = partial.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def op3_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of every fiftieth vector among all others."""
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


OP3_SQL = """WITH e AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
