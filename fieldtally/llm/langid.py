"""Operator 1: language identification by a recurrent network over bytes.

A bounded sample of labelled texts, `SAMPLE` documents a language with `WINDOWS`
windows each, trains the network on the driver; every whole text is then scored
inside the tasks. The sample is drawn by a hash of the text, with a share that
follows the count of each language, over all training rows.

NULL texts and texts without a letter are `und` with score 0, and so is all if
nothing is labelled. Rows that repeat are scored alike; an empty table gives an
empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm.basics import table
from fieldtally.llm.bigru import Network, Training, score, train

SAMPLE, WINDOWS = 300, 4
#: More languages than this are refused, as the sample is held by the driver.
MOST_LANGUAGES = 500
UNKNOWN = "und"
#: Below this score the pipeline takes a text for no language at all.
REJECT = 0.3


def held_out(doc_id: Column) -> Column:
    """Rows that training may not see; a missing id is held out."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(True))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(docs: DataFrame, how: Training = Training()) -> Network | None:
    """A network for the labelled rows of `docs` that are not held out."""
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).take(MOST_LANGUAGES + 1)}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit(how.seed)), F.lit(1 << 30)) / float(1 << 30)
    shares = F.create_map(
        *(F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, 2 * SAMPLE / n)))
    )
    drawn = usable.where((draw < F.element_at(shares, F.col("lang"))) & has_letter(F.col("text")))
    length = F.length("text")
    starts = [
        1 + F.pmod(F.xxhash64("doc_id", F.lit(i)), F.greatest(length - how.window, F.lit(1))).cast("int")
        for i in range(WINDOWS)
    ]
    rows = drawn.select(
        "lang",
        draw.alias("draw"),
        F.array(*(F.substring("text", s, F.lit(how.window)) for s in starts)).alias("windows"),
    ).collect()
    windows, labels, taken = [], [], {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["draw"], r["windows"])):
        taken[row["lang"]] = taken.get(row["lang"], 0) + 1
        if taken[row["lang"]] <= SAMPLE:
            windows += [w.encode("utf-8", "surrogatepass") for w in row["windows"]]
            labels += [row["lang"]] * WINDOWS
    return train(windows, labels, how)


def predict(
    docs: DataFrame, net: Network | None, names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """`docs` with language and score, under the given names."""
    lang, share = names
    if net is None:
        return docs.withColumns({lang: F.lit(UNKNOWN), share: F.lit(0.0)})

    @F.pandas_udf("lang string, score double")
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            shares = score(net, (t.encode("utf-8", "surrogatepass") for t in texts))
            top = [(net.labels[int(s.argmax())], round(float(s.max()), 6)) for s in shares]
            yield pd.DataFrame(top, columns=["lang", "score"])

    known = has_letter(F.col("text"))
    found = best(F.when(known, F.col("text")).otherwise(""))
    return (
        docs.withColumn("__found", found)
        .withColumns(
            {
                lang: F.when(known, F.col("__found.lang")).otherwise(UNKNOWN),
                share: F.when(known, F.least(F.col("__found.score"), F.lit(1.0))).otherwise(0.0),
            }
        )
        .drop("__found")
    )


def op1_bigru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and score of every document."""
    docs = table(spark, sf_dir, "documents")
    net = fit(docs)
    rows = predict(docs.select("doc_id", "text"), net)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
