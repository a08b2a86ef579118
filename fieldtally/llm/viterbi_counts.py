"""Operator 6: token counts by a count-only Viterbi search.

A unigram vocabulary gives every piece a score, and a word's tokens are its split
into pieces of the highest total score. An Aho-Corasick automaton names all pieces
that end at each place; dynamic programming keeps the best score and the number of
pieces up to it, so no token is ever built. Ties go as in the tokenizer: a later
candidate wins only if its score is greater, and candidates come by ascending
start, so the longest last piece stays. A character that is no piece by itself may
count as unknown, 10 below the lowest score, and then as many tokens as it has
bytes (byte fallback).

The vocabulary files at hand rank their pieces by merges and hold no probabilities,
and tokenizers are never trained here. So a piece of rank r gets the logarithm of
its Zipf-Mandelbrot probability, in proportion to 1 / (r + 2.7) and normalised over
all pieces: a unigram model by rule, whose counts on the test documents lie within
a few percent of the file's own.

Words are the runs between ASCII white space, each with the word mark in front;
pieces never cross them, so a worker remembers the counts of words that it has
met, in a table of bounded size.

NULL and empty texts have 0 tokens; repeated rows are counted alike; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm.basics import table

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
WORD_MARK = "▁"
#: Mandelbrot's shift of the rank.
RANK_SHIFT = 2.7
#: How far an unknown character lies below the lowest score of the vocabulary.
UNKNOWN_PENALTY = 10.0
#: Words that a worker remembers.
REMEMBERED = 1 << 20


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]


def load_vocabulary(path: str = TOKENIZER) -> Vocabulary:
    """The pieces of a ranked sentencepiece model, without control and byte pieces.

    The file's score is minus the rank; pieces below all ranks count as the last.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))
    ]
    ranks = [min(-model.get_score(i), float(len(ids))) for i in ids]
    return Vocabulary(tuple(model.id_to_piece(i) for i in ids), zipf_scores(ranks))


def zipf_scores(ranks: list[float]) -> tuple[float, ...]:
    """Log-probabilities of pieces by their ranks; the probabilities sum to 1."""
    weights = [1.0 / (r + RANK_SHIFT) for r in ranks]
    total = math.fsum(weights)
    return tuple(math.log(w / total) for w in weights)


class Counter:
    """Counts the tokens of words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.matches = ahocorasick.Automaton()
        for piece, score in zip(vocabulary.pieces, vocabulary.scores, strict=True):
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.single = {p for p in vocabulary.pieces if len(p) == 1}
        self.unknown = min(vocabulary.scores, default=0.0) - UNKNOWN_PENALTY
        self.known: dict[bytes, int] = {}

    def pieces(self, text: str) -> int:
        """Tokens of a text that is searched as a whole."""
        size = len(text)
        best: list[float | None] = [0.0] + [None] * size
        count = [0] * (size + 1)
        done = 0  # places up to here are final

        def finish(end: int) -> None:
            char = text[end - 1]
            if char not in self.single:
                score = best[end - 1] + self.unknown
                if best[end] is None or score > best[end]:
                    best[end] = score
                    count[end] = count[end - 1] + len(char.encode("utf-8", "surrogatepass"))

        for last, (length, score) in self.matches.iter(text) if len(self.matches) else ():
            while done < last:
                done += 1
                finish(done)
            end = last + 1
            # the longest piece comes first, so starts ascend
            start = end - length
            score += best[start]
            if best[end] is None or score > best[end]:
                best[end] = score
                count[end] = count[start] + 1
        while done < size:
            done += 1
            finish(done)
        return count[size]

    def word(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            found = self.pieces(WORD_MARK + word.decode("utf-8", "surrogatepass"))
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = found
        return found

    def text(self, text: str | None) -> tuple[int, int]:
        """Words and tokens of a text."""
        words = (text or "").encode("utf-8", "surrogatepass").split()
        return len(words), sum(map(self.word, words))


_COUNTERS: dict[int, Counter] = {}


def _counter(vocabulary: Vocabulary) -> Counter:
    """One counter per worker and vocabulary, kept between batches and tasks."""
    key = hash(vocabulary)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(vocabulary)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """`docs` with n_words and n_tokens of its `text`."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("n_words long, n_tokens long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = _counter(shipped.value)
        for texts in batches:
            rows = [counter.text(t) for t in texts]
            yield pd.DataFrame(rows, columns=["n_words", "n_tokens"], dtype="int64")

    return docs.withColumn("__n", count("text")).select("*", "__n.*").drop("__n")


def op6_viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, load_vocabulary()).select("doc_id", "n_words", "n_tokens")
