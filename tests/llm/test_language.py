"""Operator 1: gradients, held-out accuracy, windows, and awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldtally.llm import bigru, langid
from fieldtally.llm.queries import CORPUS_QUERIES


def test_gradients_equal_differences():
    random = np.random.default_rng(3)
    net = bigru._new(["x", "y", "z"], 4, 5)
    for p in net.parameters():
        p += random.standard_normal(p.shape).astype(np.float32) * 0.1
    ids = random.integers(0, 6, (5, 9)).astype(np.uint8)
    lengths, wanted = np.array([9, 3, 7, 1, 9]), np.array([0, 1, 2, 0, 1])
    _, grads = bigru._gradients(net, ids, lengths, wanted)
    for p, g in zip(net.parameters(), grads, strict=True):
        flat = p.reshape(-1)
        for at in np.argsort(-np.abs(g).reshape(-1))[:4]:
            was, step = flat[at], np.float32(1e-2)
            flat[at] = was + step
            up, _ = bigru._gradients(net, ids, lengths, wanted)
            flat[at] = was - step
            down, _ = bigru._gradients(net, ids, lengths, wanted)
            flat[at] = was
            assert (up - down) / (2 * step) == pytest.approx(g.reshape(-1)[at], rel=0.1, abs=2e-3)


def plain(net, text):
    """Shares of a text that fits one window, place by place."""
    hidden = net.recur[0].shape[0]

    def run(text, d):
        h, states = np.zeros(hidden), []
        for byte in text:
            x, a = net.table[d][byte], h @ net.recur[d]
            gates = np.clip((x + a)[: 2 * hidden] / 4 + 0.5, 0, 1)
            n = np.clip(x[2 * hidden :] + gates[hidden:] * a[2 * hidden :], -1, 1)
            h = n + gates[:hidden] * (h - n)
            states.append(h)
        return np.array(states)

    logits = run(text, 0) @ net.out[0] + run(text[::-1], 1)[::-1] @ net.out[1] + net.bias
    shares = np.exp(logits)
    return (shares / shares.sum(1, keepdims=True)).mean(0)


def test_scores_equal_a_plain_loop_and_ignore_neighbours():
    net = bigru._new(["x", "y", "z"], 8, 5)
    texts = [b"hello world", b"a", b"some other text, rather longer than the first", b"", b"\xff\x00" * 100]
    got = list(bigru.score(net, iter(texts)))
    for text, share in zip(texts, got, strict=True):
        if text:
            assert share == pytest.approx(plain(net, text), abs=1e-5)
        alone = next(bigru.score(net, iter([text])))
        assert share == pytest.approx(alone, abs=1e-6)
    assert not got[3].any()


def test_a_long_text_is_read_to_its_end():
    net = bigru.train([b"aaaa aaaa", b"bbbb bbbb"] * 20, ["a", "b"] * 20, bigru.Training(window=9, steps=60, batch=16))
    share = next(bigru.score(net, iter([b"a" * 30_000 + b"b" * 90_000])))
    assert share[1] == pytest.approx(0.75, abs=0.02)


def test_held_out_accuracy(spark):
    got = CORPUS_QUERIES["op1_bigru_language"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_rows_are_not_read(spark, corpus):
    """Other labels on held-out rows change nothing."""
    changed = corpus.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    quick = bigru.Training(steps=20)
    one, two = langid.fit(corpus, quick), langid.fit(changed, quick)
    assert one.labels == two.labels
    assert all((a == b).all() for a, b in zip(one.parameters(), two.parameters(), strict=True))


@pytest.mark.parametrize("table", ["odd", "empty"])
def test_awkward_rows(request, at, table, spark):
    docs = request.getfixturevalue(table)
    got = CORPUS_QUERIES["op1_bigru_language"](spark, at(docs)).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    for i in (2, 3, 4, 5) if got else ():
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    if got:
        assert by_id[None]["held_out"] and by_id[6]["lang_pred"] in ("en", "fr")


def test_nothing_labelled(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.fit(docs) is None
    assert langid.predict(docs, None).first()["lang_pred"] == "und"
