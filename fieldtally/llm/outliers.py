"""Operator 9: quality rules with robust multivariate outliers.

Statistics of every whole text first meet fixed base rules. The rest are judged
against the minimum-covariance-determinant estimate of their language and source:
each concentration step measures all rows, keeps the share with the smallest
Mahalanobis distances and takes the mean and covariance of those again. Two starts,
coordinate-wise medians and the plain mean and covariance, are carried through all
steps, and the one that ends with the smaller determinant counts. All rows of a group take part in each step as sums per
group, combined before the shuffle; no group is gathered anywhere. The share is
found in a histogram of the distances, so reruns agree.

A group with too few rows is judged with the small groups of its language, and
these with all other small groups; if they are too few still, base rules decide.
NULL texts have no words and fail the base rules; a NULL language or source is a
value like another; repeated rows count as often as they occur; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldtally.llm.basics import cut, table

WINDOW = 8
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_DROP = bytes(set(range(256)) - set(SYMBOLS))
_CONTINUATION = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class OutlierPlan:
    """Which share the estimate rests on, and how far a row may lie from it.

    `floors` are deviations below which no coordinate is told apart: most texts
    have no symbols or repeats at all, so their spread alone would be zero. They are
    what one event changes in a text of about 200 words: one symbol (0.07), one repeated
    line (0.13), nine words of two overlapping windows (0.21, half of it here, so that
    shares of repeats which the base rules pass can still reject), and 5 % of the word
    length. `tail` is the share of normal rows beyond the cutoff: small, as the
    statistics of short texts have heavy tails.
    """

    share: float = 0.75
    steps: int = 5
    least_rows: int = 50
    floors: tuple[float, ...] = (0.05, 0.07, 0.13, 0.1)
    tail: float = 5e-5

    @property
    def cutoff(self) -> float:
        """The squared distance beyond which a row is rejected."""
        return chi_square_quantile(1 - self.tail, DIM)

    @property
    def consistent(self) -> float:
        """What makes the covariance of the kept share that of all normal rows."""
        return self.share / chi_square(chi_square_quantile(self.share, DIM), DIM + 2)


DIM = 4


def chi_square(x: float, degrees: int) -> float:
    """Distribution function for an even number of degrees."""
    term, total = 1.0, 0.0
    for k in range(degrees // 2):
        total += term
        term *= x / 2 / (k + 1)
    return 1 - math.exp(-x / 2) * total


def chi_square_quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, degrees) < share else (low, mid)
    return high


PLAN = OutlierPlan()


def repeated_words(ids: np.ndarray) -> int:
    """Words inside windows of eight that occur twice or more."""
    n = len(ids)
    if n <= WINDOW:
        return 0
    codes = ids
    for step in (1, 2, 4):
        pair = codes[:-step].astype(np.int64) * (n + 1) + codes[step:]
        _, codes, counts = np.unique(pair, return_inverse=True, return_counts=True)
        if len(counts) == len(codes):  # no repeat at this length, so none at a greater one
            return 0
    again = (counts > 1)[codes]
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def text_statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = len(raw.translate(None, _CONTINUATION + b" \t\n\x0b\x0c\r"))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    places: dict[bytes, int] = {}
    ids = np.fromiter((places.setdefault(w, len(places)) for w in words), np.int64, len(words))
    return (
        len(words),
        chars,
        len(raw.translate(None, _DROP)),
        len(lines) - len(set(lines)),
        repeated_words(ids) if len(places) < len(words) else 0,
    )


def _statistics(text: Column) -> Column:
    @F.pandas_udf(", ".join(f"{name} long" for name in STATISTICS))
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [text_statistics(t) for t in texts]
            yield pd.DataFrame(rows, columns=list(STATISTICS), dtype="int64")

    return of(text)


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the statistics, base_failed and the transformed vector z."""
    rows = docs.select("doc_id", "lang", "source", _statistics(F.col("text")).alias("s")).select(
        "doc_id", "lang", "source", "s.*"
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    words = F.greatest("n_words", F.lit(1))
    z = F.array(
        F.log(F.greatest("word_chars", F.lit(1)) / words),
        F.sqrt(F.col("n_symbols") / words),
        F.log1p(F.col("n_dup_lines").cast("double")) / F.log1p(words),
        F.sqrt(F.col("n_repeat_words") / words),
    )
    return rows.withColumn("base_failed", failed).withColumn("z", z)


def _grouped(rows: DataFrame, plan: OutlierPlan) -> DataFrame:
    """`rows` with the group `g` whose estimate they are judged by; NULL for none."""
    pass_ = rows.where(~F.col("base_failed"))
    counts = pass_.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    own = F.to_json(F.array(F.lit("group"), "lang", "source"))
    language = F.to_json(F.array(F.lit("language"), "lang"))
    small = F.col("n") < plan.least_rows

    def pooled(g: Column, next_: Column) -> Column:
        return F.when(F.sum("n").over(Window.partitionBy(g)) < plan.least_rows, next_).otherwise(g)

    counts = counts.withColumn("g", F.when(small, language).otherwise(own))
    for next_ in (F.lit("rest"), F.lit(None).cast("string")):
        counts = counts.withColumn("g", pooled(F.col("g"), next_))
    names = cut(counts.select(F.col("lang").alias("l"), F.col("source").alias("s"), "g"))
    return rows.join(
        names, rows["lang"].eqNullSafe(names["l"]) & rows["source"].eqNullSafe(names["s"]), "left"
    ).drop("l", "s")


def _distance(z: Column, mean: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance; `inverse` is row-major."""
    gap = [z[i] - mean[i] for i in range(DIM)]
    terms = [gap[i] * gap[j] * inverse[i * DIM + j] for i in range(DIM) for j in range(DIM)]
    return sum(terms[1:], terms[0])


BINS = 64


def _bin(d: Column) -> Column:
    """Logarithmic bins, 64 to a doubling."""
    return F.floor(F.log2(d + 1e-6) * BINS)


ESTIMATE = "g string, mean array<double>, inverse array<double>, size double"


def _invert(plan: OutlierPlan, covered: float):
    """Turns moments into mean and inverse covariance, with the floors added."""
    ridge = np.diag(np.square(plan.floors))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            means, inverses, sizes = [], [], []
            for n, first, second in zip(frame["n"], frame["first"], frame["second"], strict=True):
                mean = np.asarray(first, float) / n
                square = np.asarray(second, float).reshape(DIM, DIM) / n
                spread = (square - np.outer(mean, mean)) * covered + ridge
                means.append(np.round(mean, 9))
                inverses.append(np.round(np.linalg.inv((spread + spread.T) / 2), 6).ravel())
                sizes.append(round(float(np.linalg.slogdet(spread)[1]), 6))
            yield pd.DataFrame({"g": frame["g"], "mean": means, "inverse": inverses, "size": sizes})

    return run


def _moments(rows: DataFrame) -> DataFrame:
    first = [F.sum(F.col("z")[i]) for i in range(DIM)]
    second = [F.sum(F.col("z")[i] * F.col("z")[j]) for i in range(DIM) for j in range(DIM)]
    return rows.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.array(*first).alias("first"), F.array(*second).alias("second")
    )


def _share_bins(counts: DataFrame, by: list[str], share: float, name: str) -> DataFrame:
    """The lowest bin at which the running count reaches `share` of the group."""
    order = Window.partitionBy(*by)
    running = F.sum("n").over(order.orderBy("bin"))
    reached = counts.withColumn("r", running >= F.ceil(F.sum("n").over(order) * share))
    return reached.where("r").groupBy(*by).agg(F.min("bin").alias(name))


def _start(rows: DataFrame, plan: OutlierPlan) -> DataFrame:
    """Medians, and spreads from the quartiles."""
    parts = F.posexplode(F.transform("z", lambda x: F.floor(x * 256))).alias("i", "bin")
    counts = cut(rows.select("g", parts).groupBy("g", "i", "bin").agg(F.count(F.lit(1)).alias("n")))
    by = ["g", "i"]
    found = _share_bins(counts, by, 0.5, "mid")
    for share, name in ((0.25, "low"), (0.75, "high")):
        found = found.join(_share_bins(counts, by, share, name), by)
    floors = F.element_at(F.array(*(F.lit(float(f)) for f in plan.floors)), F.col("i") + 1)
    deviation = (F.col("high") - F.col("low")) / 256 / 1.349
    listed = F.array_sort(
        F.collect_list(
            F.struct(
                "i",
                ((F.col("mid") + 0.5) / 256).alias("mean"),
                (1 / (deviation * deviation + floors * floors)).alias("weight"),
            )
        )
    )
    return found.groupBy("g").agg(listed.alias("c")).select(
        "g",
        F.transform("c", lambda x: x["mean"]).alias("mean"),
        F.flatten(
            F.transform(
                "c",
                lambda x: F.transform(
                    F.sequence(F.lit(0), F.lit(DIM - 1)),
                    lambda j: F.when(j == x["i"], x["weight"]).otherwise(0.0),
                ),
            )
        ).alias("inverse"),
    )


#: Parts that the rows of a group are dealt to when they meet its estimate.
SALTS = 64


def _spread(per_group: DataFrame) -> DataFrame:
    """A row per group and salt, with the group as `of`."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt")
    return per_group.withColumnRenamed("g", "of").select("*", salts)


def _on_group() -> Column:
    """Joins on it leave no group in one task, however many rows it has."""
    return (F.col("g") == F.col("of")) & (F.col("salt") == F.col("of_salt"))


def _measured(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    joined = rows.join(_spread(estimate), _on_group(), "left").drop("of", "of_salt")
    return joined.withColumn("d2", _distance(F.col("z"), F.col("mean"), F.col("inverse"))).drop(
        "mean", "inverse"
    )


#: Names of the starts, behind the name of the group.
STARTS = ("/medians", "/moments")


def estimates(rows: DataFrame, plan: OutlierPlan = PLAN) -> DataFrame:
    """(g, mean, inverse) of every group of `rows` (g, z, salt)."""
    named = F.explode(F.array(*(F.concat("g", F.lit(name)) for name in STARTS)))
    medians = _start(rows, plan).withColumn("g", F.concat("g", F.lit(STARTS[0])))
    moments = _moments(rows).mapInPandas(_invert(plan, 1.0), ESTIMATE).drop("size")
    moments = moments.withColumn("g", F.concat("g", F.lit(STARTS[1])))
    estimate = cut(medians.unionByName(moments))
    rows = rows.withColumn("g", named)
    for step in range(plan.steps):
        measured = _measured(rows, estimate).select("g", "salt", "z", _bin(F.col("d2")).alias("bin"))
        counts = measured.groupBy("g", "bin").agg(F.count(F.lit(1)).alias("n"))
        edges = cut(_share_bins(counts, ["g"], plan.share, "edge"))
        kept = measured.join(_spread(edges), _on_group()).where("bin <= edge")
        covered = plan.consistent if step == plan.steps - 1 else 1.0
        last = cut(_moments(kept).mapInPandas(_invert(plan, covered), ESTIMATE))
        estimate = last.drop("size")
    best = F.min_by(F.struct("mean", "inverse"), F.struct("size", "g")).alias("e")
    group = F.regexp_replace("g", "/[a-z]+$", "")
    return cut(last.groupBy(group.alias("g")).agg(best).select("g", "e.*"))


def salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def judge(docs: DataFrame, plan: OutlierPlan = PLAN) -> DataFrame:
    """Statistics, base_failed, squared distance d2 and kept for every row of `docs`."""
    rows = cut(_grouped(cut(with_statistics(docs)), plan))
    rows = rows.withColumn("salt", salt("doc_id", "word_chars", "n_words"))
    good = rows.where(~F.col("base_failed") & F.col("g").isNotNull())
    measured = _measured(rows, estimates(good.select("g", "z", "salt"), plan))
    near = F.coalesce(F.col("d2") <= plan.cutoff, F.lit(True))
    return measured.withColumn("kept", ~F.col("base_failed") & near).drop("z", "g", "salt")


def op9_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    return judge(table(spark, sf_dir, "documents")).drop("lang", "source")
