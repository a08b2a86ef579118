"""Operators 9, 6 and 8 against plain computations."""

import collections
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import models

from fieldtally.llm import license_scan, outliers, viterbi_counts
from fieldtally.llm.queries import CORPUS_QUERIES, CORPUS_SQL

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), again, len(covered)


@pytest.mark.parametrize(
    "text",
    [None, "", " \n ", "a b c d e f g h a b c d e f g h", "a " * 9, "a " * 8, "x\ny\nx\n\n\nx\r\nx", "é😀 #* a|b",
     "a\x1cb c d e f", "one two three four five six seven eight nine one two three four five six seven eight"],
)
def test_statistics_of_a_text(text):
    assert outliers.text_statistics(text) == plain_statistics(text)


@pytest.mark.parametrize("table", ["corpus", "odd", "empty"])
def test_base_rules(request, spark, at, table):
    docs = request.getfixturevalue(table)
    got = CORPUS_QUERIES["op9_mcd_outliers"](spark, at(docs)).collect()
    names = [*outliers.STATISTICS, "base_failed"]

    def wanted(text):
        s = plain_statistics(text)
        return (*s, s[0] < 20 or 100 * s[4] > 30 * s[0])

    assert sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in got) == sorted((str(r["doc_id"]), *wanted(r["text"])) for r in docs.collect())
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_outliers_go_and_their_mass_does_not_mask_them(spark):
    """A fifth of a group is spoiled alike; the estimate rests on the rest."""
    r = np.random.default_rng(0)

    def text(bad):
        words = ["".join(r.choice(list("abcdefgh"), r.integers(2, 9))) for _ in range(120)]
        return " ".join(w + ("%%%" if bad else "") for w in words)

    rows = [(i, text(i % 5 == 0), "en", f"s{i % 2}") for i in range(400)]
    got = outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert all(x["kept"] == (x["doc_id"] % 5 != 0) for x in got)


def test_estimate_equals_plain_concentration(spark):
    r = np.random.default_rng(2)
    z = r.standard_normal((600, 4)) * [1, 0.5, 0.2, 0.1] + [1, 2, 3, 4]
    z[:90] += 9
    plan = outliers.PLAN
    rows = spark.createDataFrame([("g", x.tolist()) for x in z], "g string, z array<double>").withColumn("salt", outliers.salt("z"))
    found = outliers.estimates(rows, plan).first()
    mean = np.array(found["mean"])
    assert mean == pytest.approx(z[90:].mean(0), abs=0.15)
    # a step from the estimate stays where it is, up to the width of a bin
    inverse = np.array(found["inverse"]).reshape(4, 4)
    d2 = np.einsum("ij,jk,ik->i", z - mean, inverse, z - mean)
    inside = z[np.argsort(d2)[: int(0.75 * len(z))]]
    assert inside.mean(0) == pytest.approx(mean, abs=0.08)
    spread = np.linalg.inv(inverse) - np.diag(np.square(plan.floors))
    assert np.cov(inside.T) * plan.consistent == pytest.approx(spread, abs=0.12)


def plain_verdicts(z, plan):
    """Concentration steps over sorted distances, from both starts; True where a row is kept."""
    def estimate(some, factor=1.0):
        return some.mean(0), np.cov(some.T, bias=True) * factor + np.diag(np.square(plan.floors))

    def distances(mean, spread):
        gap = z - mean
        return np.einsum("ij,jk,ik->i", gap, np.linalg.inv(spread), gap)

    low, mid, high = np.quantile(z, [0.25, 0.5, 0.75], axis=0)
    ends = []
    for mean, spread in ((mid, np.diag(((high - low) / 1.349) ** 2 + np.square(plan.floors))), estimate(z)):
        for step in range(plan.steps):
            inside = z[np.argsort(distances(mean, spread), kind="stable")[: int(np.ceil(plan.share * len(z)))]]
            mean, spread = estimate(inside, plan.consistent if step == plan.steps - 1 else 1.0)
        ends.append((np.linalg.slogdet(spread)[1], distances(mean, spread)))
    return min(ends, key=lambda x: x[0])[1]


def made_documents():
    """Plain texts, and from number 400 on ten of each kind that lies apart in one coordinate."""
    r = np.random.default_rng(4)

    def words(n, low=2, high=9):
        return ["".join(r.choice(list("abcdefghijklmnop"), r.integers(low, high))) for _ in range(n)]

    def text(kind):
        n = int(r.integers(100, 200))
        some = words(n, 14, 22) if kind == "long" else words(n)
        if kind == "symbols":
            some = [w + "#%" for w in some]
        if kind == "repeats":  # about a quarter of the words, below the base rule's 30 %
            some[-n // 8 :] = some[: len(some[-n // 8 :])]
        lines = [" ".join(some[i : i + 10]) for i in range(0, n, 10)]
        if kind == "lines":
            lines += ["menu"] * 40
        return "\n".join(lines)

    kinds = ["plain"] * 400 + [k for k in ("long", "symbols", "repeats", "lines") for _ in range(10)]
    return [(i, text(kind), "en", "s") for i, kind in enumerate(kinds)]


def test_each_coordinate_can_reject(spark):
    docs = made_documents()
    got = {r["doc_id"]: r for r in outliers.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert [i for i, r in got.items() if r["kept"]] and {i for i, r in got.items() if not r["kept"]} == set(range(400, 440))


def test_verdicts_equal_a_plain_form(spark, corpus):
    """A whole table in one group; distances differ by no more than the bins of the share."""
    docs = corpus.withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    stats = {r["doc_id"]: r for r in outliers.with_statistics(docs).collect()}
    good = sorted(i for i, r in stats.items() if not r["base_failed"])
    wanted = dict(zip(good, plain_verdicts(np.array([stats[i]["z"] for i in good]), outliers.PLAN), strict=True))
    got = {r["doc_id"]: r for r in outliers.judge(docs).collect()}
    cutoff = outliers.PLAN.cutoff
    for i in good:
        near = abs(wanted[i] - cutoff) < 0.1 * cutoff
        assert near or got[i]["kept"] == (wanted[i] <= cutoff), (i, wanted[i], got[i]["d2"])
    assert all(not got[i]["kept"] for i in stats if i not in wanted)


def test_chi_square():
    assert outliers.chi_square(9.487729, 4) == pytest.approx(0.95, abs=1e-6)
    assert outliers.chi_square_quantile(0.975, 4) == pytest.approx(11.143287, abs=1e-5)
    assert outliers.PLAN.consistent == pytest.approx(1.4864, abs=1e-4)


def test_small_groups_are_pooled(spark):
    words = " ".join(f"word{i}" for i in range(40))
    rows = [(i, words, ["en", "de"][i % 2], f"s{i}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    stats = outliers.with_statistics(docs)
    groups = {r["g"] for r in outliers._grouped(stats, outliers.PLAN).collect()}
    assert groups == {'["language","en"]', '["language","de"]'}
    assert {r["g"] for r in outliers._grouped(stats.limit(30), outliers.PLAN).collect()} == {None}


@pytest.fixture(scope="module")
def vocabulary():
    return viterbi_counts.load_vocabulary()


def tokenizer(vocabulary):
    """The library's own unigram search over the same pieces."""
    parts = [("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256))]
    return models.Unigram([*parts, *zip(vocabulary.pieces, vocabulary.scores, strict=True)], 0, True)


def test_counts_equal_the_tokenizer(vocabulary, texts):
    wanted, counter = tokenizer(vocabulary), viterbi_counts.Counter(vocabulary)
    words = {w for t in texts.values() for w in (t or "").split()}
    words |= {"日本語", "a日b", "😀😀", "x" * 300, "▁▁", "é" * 9, "​", "…—"}
    for w in words:
        assert counter.word(w.encode()) == len(wanted.tokenize("▁" + w)), w


def test_scores_are_log_probabilities_near_the_ranked_model(vocabulary, texts):
    import math

    import sentencepiece

    assert math.fsum(math.exp(s) for s in vocabulary.scores) == pytest.approx(1)
    order = sorted(zip(vocabulary.scores, vocabulary.pieces, strict=True), reverse=True)
    assert [p for _, p in order[:2]] == ["▁t", "in"]
    model = sentencepiece.SentencePieceProcessor(model_file=viterbi_counts.TOKENIZER)
    counter = viterbi_counts.Counter(vocabulary)
    some = [t for t in texts.values() if t]
    ranked = sum(map(len, model.encode(some)))
    assert sum(counter.text(t)[1] for t in some) == pytest.approx(ranked, rel=0.04)


def test_ties_go_to_the_longest_last_piece():
    tied = viterbi_counts.Vocabulary(("a", "b", "ab", "ba", "aba", "▁"), (-1.0, -1.0, -2.0, -2.0, -3.0, -1.0))
    wanted, counter = tokenizer(tied), viterbi_counts.Counter(tied)
    for w in ("ab", "aba", "abab", "babba", "abcba", "c", ""):
        assert counter.pieces("▁" + w) == len(wanted.tokenize("▁" + w)), w


@pytest.mark.parametrize("table", ["corpus", "odd", "empty"])
def test_counts_of_documents(request, spark, at, table, vocabulary):
    docs = request.getfixturevalue(table)
    got = CORPUS_QUERIES["op6_viterbi_counts"](spark, at(docs)).collect()
    wanted = tokenizer(vocabulary)

    def counts(text):
        words = WORD.findall(text or "")
        return len(words), sum(len(wanted.tokenize("▁" + w)) for w in words)

    assert sorted((str(r["doc_id"]), r["n_words"], r["n_tokens"]) for r in got) == sorted((str(r["doc_id"]), *counts(r["text"])) for r in docs.collect())


FILES = [
    ("LICENSE", "Licensed under the Apache License, Version 2.0."),
    ("src/main.c", "int main;\nno notice here"),
    ("src/own.c", "Released under the MIT License.\n" + "code " * 50),
    ("lib/COPYING", "This work is licensed under the GNU General Public License, version 3.\n" + "text " * 100),
    ("lib/deep/er/x.c", "code"),
    ("lib/deep/notes.txt", "the license of this and the version under the work"),
    ("top.c", None),
    (None, "Released under the MIT License."),
    (None, ""),
    ("lib/deep/er/x.c", "code"),
]


def test_licenses_and_inheritance(spark):
    files = spark.createDataFrame(FILES, "path string, text string").withColumn("own", F.lit("x"))
    got = [(r["path"], r["own"], r["license"], r["from_dir"]) for r in license_scan.inherit(license_scan.own_licenses(files)).collect()]
    wanted = [
        ("LICENSE", "Apache-2.0", "Apache-2.0", None),
        ("src/main.c", None, None, None),
        ("src/own.c", "MIT", "MIT", None),
        ("lib/COPYING", "GPL-3.0", "GPL-3.0", None),
        ("lib/deep/er/x.c", None, "GPL-3.0", "lib"),
        ("lib/deep/er/x.c", None, "GPL-3.0", "lib"),
        ("lib/deep/notes.txt", None, "GPL-3.0", "lib"),
        ("top.c", None, "Apache-2.0", ""),
        (None, "MIT", "MIT", None),
        (None, None, None, None),
    ]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_cosines_equal_a_plain_computation(spark):
    lines = ["Licensed under the Apache License, Version 2.0", "Licensed under the MIT license", "apache version", "all rights reserved by me", "under the"]
    files = spark.createDataFrame([(str(i), t) for i, t in enumerate(lines)], "path string, text string")
    terms = lambda t: re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", t.lower())
    weights = {}
    for r in license_scan._weights(files, license_scan.TEMPLATES):
        weights[r["term"]] = r["idf"]
    rarest = max(weights.values())

    def vector(t):
        return {x: n * weights.get(x, rarest) for x, n in collections.Counter(terms(t)).items()}

    def cosine(a, b):
        dot = sum(v * b.get(k, 0) for k, v in a.items())
        return dot / (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5

    got = {r["path"]: (r["own"], r["cosine"]) for r in license_scan.own_licenses(files).collect()}
    for i, t in enumerate(lines):
        best = max((round(cosine(vector(t), vector(n)), 9), name) for name, n in license_scan.TEMPLATES.items())
        if best[0] >= license_scan.THRESHOLD:
            assert got[str(i)] == (best[1], pytest.approx(best[0], abs=1e-6))
        else:
            assert got[str(i)] == (None, None)


@pytest.mark.parametrize("table", ["corpus", "odd", "empty"])
def test_licenses_of_documents(request, spark, at, table):
    docs = request.getfixturevalue(table)
    folder = at(docs)
    got = CORPUS_QUERIES["op8_license_tfidf"](spark, folder).collect()
    if got:
        with duckdb.connect() as c:
            c.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
            rows = c.execute(f"SELECT {', '.join(got[0].asDict())} FROM ({CORPUS_SQL['op8_license_tfidf']})").fetchall()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, rows))
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in docs.collect())
    notices = {n: k for k, n in license_scan.TEMPLATES.items()}
    for r in docs.collect() if table == "corpus" else ():
        held = {notices[x] for x in r["text"].split("\n") if x in notices}
        own = next(g["own"] for g in got if g["doc_id"] == r["doc_id"])
        assert own in held if held else own is None
