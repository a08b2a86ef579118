"""Operator 8: license scans by sparse TF-IDF cosine and inheritance by path.

Every line of every file is a sparse vector over the terms of the templates, with
inverse document frequencies counted over all files, and is compared with each
template that it shares a telling term with. A template's telling terms are the
heaviest ones, as many as it takes that a line without any of them stays below the
threshold, so no match is lost and ordinary lines meet no template.

A file's own license is the template of its best line. A file whose own license
takes up at least half of its words is a license file; so is one named like one.
It speaks for its directory. A file without an own license inherits that of the
nearest ancestor directory that has one, by joins of distinct directories.
Built-in functions only.

NULL and empty texts have no own license and inherit like others; a NULL path is
in no directory; repeated rows stay; ties go to the license that sorts first; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm.basics import WORD, cut, row_key, table, word_count

# Notices by which licenses are given, under their SPDX names.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
}
THRESHOLD = 0.7
#: A license file is mostly its license.
MOSTLY = 0.5
NAMES = r"(?i)^(?:licen[cs]e|copying|notice|unlicense)(?:[.-].*)?$"
TERM = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"


def terms(text: Column) -> Column:
    """Lower-cased terms in order; versions and hyphened names are one term."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _template_terms(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    rows = spark.createDataFrame(sorted(templates.items()), "license string, notice string")
    return rows.select("license", F.explode(terms(F.col("notice"))).alias("term")).groupBy(
        "license", "term"
    ).agg(F.count(F.lit(1)).cast("double").alias("tf"))


def _weights(files: DataFrame, templates: Mapping[str, str]) -> list[dict]:
    """license, term, weight (of a unit vector), idf, telling; bounded by the templates.

    Document frequencies count every file that holds the term.
    """
    spark = files.sparkSession
    wanted = sorted({t["term"] for t in _template_terms(spark, templates).select("term").distinct().collect()})
    held = F.array_intersect(terms(F.col("text")), F.array(*(F.lit(t) for t in wanted)))
    counted = files.select(F.explode(held).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = files.count()
    counts = {r["term"]: r["df"] for r in counted.collect()}
    idf = {t: _idf(counts.get(t, 0), total) for t in wanted}
    rows = []
    by_license: dict[str, list] = {}
    for r in _template_terms(spark, templates).collect():
        by_license.setdefault(r["license"], []).append((r["tf"] * idf[r["term"]], r["term"]))
    for license_, parts in sorted(by_license.items()):
        norm = sum(w * w for w, _ in parts) ** 0.5
        rest = 1.0
        for w, term in sorted(parts, key=lambda p: (-p[0], p[1])):
            # what is left of the template once its heavier terms are gone
            telling = rest >= THRESHOLD * THRESHOLD - 1e-12
            rows.append({"license": license_, "term": term, "weight": w / norm, "idf": idf[term], "telling": telling})
            rest -= (w / norm) ** 2
    return rows


def _idf(df: int, total: int) -> float:
    return math.log((1 + total) / (1 + df)) + 1


def own_licenses(files: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """`files` (path, text) with key, own (license), cosine and share of words it takes up."""
    weights = _weights(files, templates)
    idf = F.create_map(*(F.lit(x) for t, w in sorted({(r["term"], r["idf"]) for r in weights}) for x in (t, w)))
    telling = F.array(*(F.lit(t) for t in sorted({r["term"] for r in weights if r["telling"]})))
    unseen = F.lit(max(r["idf"] for r in weights))
    by_license: dict[str, list] = {}
    for r in weights:
        by_license.setdefault(r["license"], []).append(r)
    # any telling term, found in one pass over the text before lines are made
    marks = "|".join(sorted({r["term"].replace(".", r"\.") for r in weights if r["telling"]}))
    hint = F.col("text").rlike(rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{marks})")
    lines = F.when(hint, F.split("text", "\n")).otherwise(F.array().cast("array<string>"))

    def cosine(line: Column, license_: str) -> Column:
        weights = F.create_map(
            *(F.lit(x) for r in by_license[license_] for x in (r["term"], r["weight"] * r["idf"]))
        )
        dot = F.aggregate(
            line["terms"],
            F.lit(0.0),
            lambda a, t: a + F.coalesce(F.try_element_at(weights, t), F.lit(0.0)),
        )
        return F.when(line["norm"] > 0, dot / line["norm"]).otherwise(0.0)

    def norm(words: Column) -> Column:
        """Length of the line's vector; terms of no template weigh as the rarest one."""
        squares = F.transform(
            F.array_distinct(words),
            lambda t: F.pow(
                F.size(F.filter(words, lambda x: x == t)) * F.coalesce(F.try_element_at(idf, t), unseen), F.lit(2.0)
            ),
        )
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x))

    found = F.filter(
        F.transform(lines, lambda x: F.struct(terms(x).alias("terms"), word_count(x).alias("words"))),
        lambda x: F.arrays_overlap(x["terms"], telling),
    )
    measured = F.transform(
        found, lambda x: F.struct(x["terms"].alias("terms"), x["words"].alias("words"), norm(x["terms"]).alias("norm"))
    )
    scored = F.flatten(
        F.transform(
            measured,
            lambda x: F.array(
                *(
                    F.struct(
                        (-F.round(cosine(x, n), 9)).alias("minus"), F.lit(n).alias("license"), x["words"].alias("words")
                    )
                    for n in sorted(by_license)
                )
            ),
        )
    )
    good = F.filter(scored, lambda x: x["minus"] <= -THRESHOLD)
    best = F.array_min(good)
    rows = files.select("path", row_key("path", "text").alias("key"), word_count(F.col("text")).alias("n_words"), good.alias("good"))
    rows = rows.withColumn("best", F.array_min("good"))
    taken = F.aggregate(
        F.filter("good", lambda x: x["license"] == F.col("best.license")), F.lit(0).cast("long"), lambda a, x: a + x["words"]
    )
    return rows.select(
        "path",
        "key",
        F.col("best.license").alias("own"),
        (-F.col("best.minus")).alias("cosine"),
        F.when(F.col("n_words") > 0, F.coalesce(taken, F.lit(0)) / F.col("n_words")).otherwise(0.0).alias("share"),
    )


def directory(path: Column) -> Column:
    """All before the last slash; the root is the empty string."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(
        F.when(path.isNotNull(), F.lit(""))
    )


def inherit(own: DataFrame) -> DataFrame:
    """`own` with `license` and `from_dir`, the directory it comes from (NULL for its own)."""
    placed = cut(own.withColumn("dir", directory(F.col("path"))))
    name = F.regexp_extract("path", "([^/]*)$", 1)
    speaks = F.col("own").isNotNull() & ((F.col("share") >= MOSTLY) | name.rlike(NAMES))
    heads = placed.where(speaks & F.col("dir").isNotNull()).groupBy(F.col("dir").alias("of")).agg(
        # the surest license file of a directory, then the license that sorts first
        F.min(F.struct((-F.col("cosine")).alias("minus"), "own"))["own"].alias("license")
    )
    parts = F.split("dir", "/")
    ancestors = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")
    )
    chains = placed.where(F.col("dir").isNotNull()).select("dir").distinct().select(
        "dir", F.explode(ancestors).alias("above")
    )
    nearest = chains.join(cut(heads), F.col("above") == F.col("of")).groupBy("dir").agg(
        F.max_by(F.struct("license", "above"), F.length("above")).alias("found")
    )
    joined = placed.join(cut(nearest.withColumnRenamed("dir", "at")), F.col("dir") == F.col("at"), "left")
    return joined.select(
        *own.columns,
        F.coalesce("own", "found.license").alias("license"),
        F.when(F.col("own").isNull(), F.col("found.above")).alias("from_dir"),
    )


def document_path() -> Column:
    """Where the documents table would keep a document: /source/language/id."""
    part = lambda c: F.coalesce(c, F.lit("none"))
    return F.concat_ws(
        "/", F.lit(""), part(F.col("source")), part(F.col("lang")), part(F.col("doc_id").cast("string"))
    )


def op8_license_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document, its own or inherited."""
    docs = table(spark, sf_dir, "documents")
    files = docs.select("doc_id", document_path().alias("path"), "text")
    found = inherit(own_licenses(files.select("path", "text")))
    return found.select(
        F.substring_index("path", "/", -1).try_cast("long").alias("doc_id"),
        "path", "own", F.round("cosine", 6).alias("cosine"), "license", "from_dir",
    )


def _duck_sql() -> str:
    """The same in plain form: every line against every template."""
    notices = ", ".join(f"('{name}', '{text}')" for name, text in sorted(TEMPLATES.items()))

    def terms_of(x: str) -> str:
        return f"regexp_extract_all(lower({x}), '{TERM}')"

    def words_of(x: str) -> str:
        return f"len(regexp_extract_all({x}, '{WORD}'))"

    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    '/' || coalesce(source, 'none') || '/' || coalesce(lang, 'none') AS dir FROM documents),
  tt AS (SELECT license, term, CAST(count(*) AS DOUBLE) AS tf FROM
    (SELECT license, unnest({terms_of("notice")}) AS term FROM (VALUES {notices}) t(license, notice)) GROUP BY ALL),
  df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT rid, term FROM
    (SELECT rid, unnest(list_distinct({terms_of("text")})) AS term FROM d) JOIN (SELECT DISTINCT term FROM tt) USING (term)) GROUP BY term),
  idf AS (SELECT term, ln((1 + (SELECT count(*) FROM d)) / CAST(1 + coalesce(df, 0) AS DOUBLE)) + 1 AS idf
    FROM (SELECT DISTINCT term FROM tt) LEFT JOIN df USING (term)),
  w AS (SELECT license, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY license)) AS weight FROM tt JOIN idf USING (term)),
  l AS (SELECT row_number() OVER () AS line, rid, x, {words_of("x")} AS words FROM (SELECT rid, unnest(string_split(text, chr(10))) AS x FROM d)),
  lt AS (SELECT line, rid, words, term, count(*) AS tf FROM (SELECT line, rid, words, unnest({terms_of("x")}) AS term FROM l) GROUP BY ALL),
  n AS (SELECT line, sqrt(sum(pow(tf * coalesce(idf, (SELECT max(idf) FROM idf)), 2))) AS norm FROM lt LEFT JOIN idf USING (term) GROUP BY line),
  c AS (SELECT line, rid, words, license, round(sum(tf * idf * weight) / any_value(norm), 9) AS cosine
    FROM lt JOIN w USING (term) JOIN idf USING (term) JOIN n USING (line) GROUP BY ALL HAVING round(sum(tf * idf * weight) / any_value(norm), 9) >= {THRESHOLD}),
  b AS (SELECT * FROM (SELECT rid, license AS own, cosine, row_number() OVER (PARTITION BY rid ORDER BY cosine DESC, license) AS k FROM c) WHERE k = 1),
  o AS (SELECT d.rid, doc_id, dir, own, b.cosine, coalesce((SELECT sum(words) FROM c WHERE c.rid = d.rid AND c.license = b.own), 0)
      / CAST(greatest({words_of("text")}, 1) AS DOUBLE) AS share FROM d LEFT JOIN b ON d.rid = b.rid),
  h AS (SELECT dir AS above, own AS license FROM (SELECT dir, own, row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, own) AS k
    FROM o WHERE own IS NOT NULL AND share >= {MOSTLY}) WHERE k = 1),
  a AS (SELECT dir, license, above FROM (SELECT x.dir, license, above, row_number() OVER (PARTITION BY x.dir ORDER BY length(above) DESC) AS k
    FROM (SELECT DISTINCT dir FROM o) x JOIN h ON h.above = x.dir OR starts_with(x.dir, h.above || '/')) WHERE k = 1)
  SELECT doc_id, o.dir || '/' || coalesce(CAST(doc_id AS VARCHAR), 'none') AS path, own, round(cosine, 6) AS cosine,
    coalesce(own, a.license) AS license, CASE WHEN own IS NULL THEN above END AS from_dir
  FROM o LEFT JOIN a ON o.dir = a.dir"""


OP8_SQL = _duck_sql()
