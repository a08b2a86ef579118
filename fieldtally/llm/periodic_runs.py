"""Operator 11: runs of repeated words, found by longest common extensions.

A run is a stretch of words that repeats itself with a period: words `q` apart are
equal, `q` is the smallest such number, and no neighbouring word continues it. Only
runs of at least `REPEATS` periods and `LEAST` words count.

Enumeration walks a harmonic grid. A run of period `p` holds at least `REPEATS - 1`
periods of places `i` whose word equals the one at `i + p`, so every
`(REPEATS - 1) * p`-th place is enough: n/p places per period, n log n in all. How
far the equality reaches from a grid place to the right and to the left gives the
run. A multiple of the smallest period gives the same stretch and is dropped.

How far it reaches is answered by a difference cover: of any two places, some shift
below the modulus brings both into the sampled residue classes. Up to that shift
words are compared one by one; from there on the answer is the minimum of the LCP
array between the two sampled suffixes, read from a sparse table. Only sampled
suffixes are sorted, by doubling their ranks, whose levels also give the LCP array.

All texts of an Arrow batch are handled as one sequence with a separator of its own
behind each text, so that numpy works on many short texts at once. Texts none of
whose comparisons reaches a sampled place are left out of the sorting.

NULL and empty texts have no words and no run. A document without an id is never
rewritten by the contract's rule. Repeated rows are handled row by row, an empty
table gives an empty result, other columns are ignored. A text is handled whole in
one task, with memory in proportion to its words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm.basics import table

#: Runs shorter than this many periods or words do not count.
REPEATS = 4
LEAST = 6
#: Words handled as one sequence, unless a single text has more.
SEQUENCE_WORDS = 1 << 18
#: Grid places compared at a time.
QUERIES = 1 << 20
MODULUS = 31

RUNS = (
    "struct<n_runs:long,start:long,length:long,period:long,exponent_milli:long,"
    "runs_sha256:string,collapsed_sha256:string,n_words:long,n_dropped:long>"
)


def difference_cover(modulus: int) -> list[int]:
    """Smallest set of residues whose differences are all residues, by depth-first search."""

    def grow(chosen: list[int], size: int) -> list[int] | None:
        missing = modulus - len({(a - b) % modulus for a in chosen for b in chosen})
        if not missing:
            return chosen
        left = size - len(chosen)
        # each further residue brings two differences with every one before it
        if sum(2 * (len(chosen) + k) for k in range(left)) < missing:
            return None
        for r in range(chosen[-1] + 1, modulus):
            if found := grow([*chosen, r], size):
                return found
        return None

    size = 1
    while True:
        if found := grow([0], size):
            return found
        size += 1


COVER = difference_cover(MODULUS)


def _shifts() -> np.ndarray:
    """For two residues, the smallest shift that brings both into the cover."""
    member = np.zeros(MODULUS, bool)
    member[COVER] = True
    shifts = np.zeros((MODULUS, MODULUS), np.int64)
    for a in range(MODULUS):
        for b in range(MODULUS):
            shifts[a, b] = next(
                t for t in range(MODULUS) if member[(a + t) % MODULUS] and member[(b + t) % MODULUS]
            )
    return shifts


SHIFT = _shifts()


def _dense(order: np.ndarray, differs: np.ndarray) -> np.ndarray:
    """Ranks from 0, equal for neighbours in `order` that do not differ."""
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.concatenate(([0], np.cumsum(differs)))
    return ranks


class SampledSuffixes:
    """LCE queries over a sequence of codes in which separators occur once each."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        n = len(codes)
        sampled = np.zeros(MODULUS, bool)
        sampled[COVER] = True
        places = np.flatnonzero(sampled[np.arange(n) % MODULUS])
        self.at = np.full(n + MODULUS, -1, np.int64)
        self.at[places] = np.arange(len(places))
        levels = self._ranks(places, n)
        order = np.argsort(levels[-1], kind="stable")
        self.rank = levels[-1]
        self.table = self._sparse(self._neighbours(places, order, levels).astype(np.int32))

    def _ranks(self, places: np.ndarray, n: int) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first MODULUS * 2**k words."""
        padded = np.concatenate((self.codes + 1, np.zeros(MODULUS, np.int64)))
        bits = int(padded.max()).bit_length()
        per = max(1, 62 // bits)
        keys = []
        for first in range(0, MODULUS, per):
            key = np.zeros(len(places), np.int64)
            for t in range(first, min(first + per, MODULUS)):
                key = (key << bits) | padded[places + t]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        differs = np.zeros(max(0, len(places) - 1), bool)
        for key in keys:
            differs |= key[order[1:]] != key[order[:-1]]
        levels = [_dense(order, differs)]
        step = MODULUS
        while levels[-1].max() < len(places) - 1:
            beyond = places + step
            next_ = np.where(beyond < n, levels[-1][self.at[np.minimum(beyond, n - 1)]], -1) + 1
            pair = levels[-1] * (len(places) + 1) + next_
            order = np.argsort(pair, kind="stable")
            levels.append(_dense(order, pair[order[1:]] != pair[order[:-1]]))
            step *= 2
        return levels

    def _neighbours(self, places: np.ndarray, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """LCP of each sampled suffix with the next one in order."""
        left, right = places[order[:-1]], places[order[1:]]
        same = np.zeros(len(left), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            a, b = self.at[left + same], self.at[right + same]
            same += np.where(levels[k][a] == levels[k][b], MODULUS << k, 0)
        return same + direct(self.codes, left + same, right + same, np.full(len(left), MODULUS))

    @staticmethod
    def _sparse(lcp: np.ndarray) -> list[np.ndarray]:
        """Minima over every stretch of 2**k neighbours."""
        rows = [lcp]
        while len(rows[-1]) > 1 << (len(rows) - 1):
            half = 1 << (len(rows) - 1)
            rows.append(np.minimum(rows[-1][:-half], rows[-1][half:]))
        return rows

    def between(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """LCE of two different sampled places, by the minimum over their stretch."""
        a, b = self.rank[self.at[i]], self.rank[self.at[j]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        least = np.empty(len(i), np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.table[k]
            least[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return least


def direct(codes: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Equal words from `i` and `j` on, compared one by one and up to `most`."""
    same = np.zeros(len(i), np.int64)
    alive = np.flatnonzero(most > 0)
    step = 0
    while len(alive):
        alive = alive[codes[i[alive] + step] == codes[j[alive] + step]]
        step += 1
        same[alive] = step
        alive = alive[most[alive] > step]
    return same


class Extensions:
    """LCE over `codes`, restricted to the texts that need the sorted samples."""

    def __init__(self, codes: np.ndarray, ends: np.ndarray) -> None:
        """`ends` holds the place of each text's separator."""
        self.codes, self.ends = codes, ends
        self.last: tuple[np.ndarray, np.ndarray, SampledSuffixes] | None = None

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        shift = SHIFT[i % MODULUS, j % MODULUS]
        same = direct(self.codes, i, j, shift)
        far = np.flatnonzero(same == shift)
        if len(far):
            same[far] += self._sampled(i[far] + shift[far], j[far] + shift[far])
        return same

    def _sampled(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        texts = np.searchsorted(self.ends, i)
        chosen = np.unique(texts)
        if self.last is None or not np.array_equal(self.last[0], chosen):
            self.last = (chosen, *self._sorted(chosen))
        _, moves, suffixes = self.last
        move = moves[np.searchsorted(chosen, texts)]
        return suffixes.between(i + move, j + move)

    def _sorted(self, chosen: np.ndarray) -> tuple[np.ndarray, SampledSuffixes]:
        """How far each chosen text moves, and the samples of all of them in one sequence."""
        starts = np.concatenate(([0], self.ends[:-1] + 1))[chosen]
        # each text keeps its residues: it starts at a place of the same class
        lengths = self.ends[chosen] + 1 - starts
        room = -(-(lengths + starts % MODULUS) // MODULUS) * MODULUS
        begin = np.concatenate(([0], np.cumsum(room)[:-1])) + starts % MODULUS
        filler = np.arange(int(room.sum()), dtype=np.int64) + int(self.codes.max()) + 1
        inside = np.repeat(begin - starts, lengths) + _ranges(starts, lengths)
        filler[inside] = self.codes[_ranges(starts, lengths)]
        return begin - starts, SampledSuffixes(_compact(filler))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all stretches, one after another."""
    before = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(starts - before, lengths)


def _compact(codes: np.ndarray) -> np.ndarray:
    return np.unique(codes, return_inverse=True)[1].astype(np.int64)


def _grid(lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of all grid places, in blocks of about QUERIES."""
    most = lengths // REPEATS
    text = np.repeat(np.arange(len(lengths)), most)
    period = _ranges(np.ones(len(lengths), np.int64), most)
    step = (REPEATS - 1) * period
    count = -(-(lengths[text] - period) // step)
    block = np.cumsum(count) // QUERIES
    for first, last in _pieces(block):
        n = count[first:last]
        row = np.repeat(np.arange(first, last), n)
        k = _ranges(np.zeros(last - first, np.int64), n)
        yield text[row], k * step[row], period[row]


def _pieces(block: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of equal numbers in an ascending array."""
    edges = np.flatnonzero(np.diff(block)) + 1
    bounds = [0, *edges.tolist(), len(block)]
    yield from ((a, b) for a, b in zip(bounds, bounds[1:], strict=False) if b > a)


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Per text (word codes), an array of rows (start, length, period) by start, then period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    if not len(texts):
        return []
    top = max((int(t.max()) for t in texts if len(t)), default=-1) + 1
    parts = []
    for k, t in enumerate(texts):
        parts += [t, np.array([top + k])]
    codes = _compact(np.concatenate(parts))
    ends = np.cumsum(lengths + 1) - 1
    n = len(codes)
    forward = Extensions(codes, ends)
    # in the mirrored sequence a separator comes first; one more closes it
    mirrored = np.concatenate((codes[::-1], [int(codes.max()) + 1]))
    mirror_ends = np.concatenate((n - 1 - ends[::-1], [n]))
    backward = Extensions(mirrored, mirror_ends)
    found = []
    for text, place, period in _grid(lengths):
        i = ends[text] - lengths[text] + place
        hit = codes[i] == codes[i + period]
        i, period, text = i[hit], period[hit], text[hit]
        right = forward.lce(i, i + period)
        left = np.zeros(len(i), np.int64)
        inner = i > ends[text] - lengths[text]
        # place x is n - 1 - x in the mirror; what ends before i starts there
        left[inner] = backward.lce(n - i[inner], n - i[inner] - period[inner])
        length = left + right + period
        kept = length >= np.maximum(LEAST, REPEATS * period)
        found.append(np.stack((text[kept], (i - left)[kept], length[kept], period[kept]), axis=1))
    rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1]))]
    # the same stretch with a multiple of its period, or met at several places
    first = np.ones(len(rows), bool)
    first[1:] = np.any(rows[1:, 1:3] != rows[:-1, 1:3], axis=1)
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1]))]
    rows[:, 1] -= (ends - lengths)[rows[:, 0]]
    cuts = np.searchsorted(rows[:, 0], np.arange(1, len(texts)))
    return [r[:, 1:] for r in np.split(rows, cuts)]


def dropped_words(runs: np.ndarray, n: int) -> np.ndarray:
    """Which words some run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def longest_exponent(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run of most periods; ties go to the smaller start, then period.

    The quotients are compared as doubles, which is exact as long as length times
    period stays below 2**52.
    """
    if not len(runs):
        return None
    order = np.lexsort((runs[:, 2], runs[:, 0], -(runs[:, 1] / runs[:, 2])))
    return tuple(int(x) for x in runs[order[0]])


def planted_order(doc_id: int | None, n: int) -> np.ndarray:
    """Numbers of the words that stand for words 0 to n - 1 under the contract's rule."""
    order = np.arange(n)
    if doc_id is None or not n:
        return order
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return order
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order[a:] = a + (order[a:] - a) % p
    return order


def _summary(words: list[bytes], runs: np.ndarray) -> tuple:
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs.tolist())
    gone = dropped_words(runs, len(words)) if len(runs) else np.zeros(len(words), bool)
    kept = words if not len(runs) else [words[k] for k in np.flatnonzero(~gone)]
    best = longest_exponent(runs)
    start, length, period = best or (None, None, None)
    return (
        len(runs), start, length, period, 1000 * length // period if best else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(),
        len(words), int(gone.sum()),
    )


_FIELDS = [part.split(":")[0] for part in RUNS[len("struct<") : -1].split(",")]


def summaries(doc_ids: list[int | None], texts: list[str | None], planted: bool) -> pd.DataFrame:
    """Rows of `RUNS` for some texts, in their order."""
    rows: list[tuple] = []
    waiting: list[tuple[list[bytes], np.ndarray]] = []
    size = 0

    def flush() -> None:
        nonlocal size
        found = find_runs([codes for _, codes in waiting])
        rows.extend(_summary(words, runs) for (words, _), runs in zip(waiting, found, strict=True))
        waiting.clear()
        size = 0

    for doc_id, text in zip(doc_ids, texts, strict=True):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if planted:
            words = [words[k] for k in planted_order(doc_id, len(words)).tolist()]
        numbers: dict[bytes, int] = {}
        codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        if waiting and size + len(words) > SEQUENCE_WORDS:
            flush()
        waiting.append((words, codes))
        size += len(words)
    flush()
    frame = pd.DataFrame(rows, columns=_FIELDS, dtype=object)
    whole = [c for c in _FIELDS if not c.endswith("sha256")]
    return frame.astype({c: "Int64" for c in whole})


def run_statistics(doc_id: Column, text: Column, planted: bool = False) -> Column:
    """Runs of each text as a struct; `planted` rewrites some texts by the contract's rule."""

    @F.pandas_udf(RUNS)
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:
            numbers = [None if pd.isna(x) else int(x) for x in ids]
            yield summaries(numbers, list(texts), planted)

    # as text, so that pandas does not turn ids into floats where one is missing
    return of(doc_id.cast("string"), text)


def collapsed(docs: DataFrame, column: str = "__runs") -> DataFrame:
    """`docs` with the statistics of their texts as they are in one more column."""
    return docs.withColumn(column, run_statistics(F.col("doc_id"), F.col("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, its best one, and digests of runs and kept words."""
    docs = table(spark, sf_dir, "documents")
    runs = run_statistics(F.col("doc_id"), F.col("text"), planted=True)
    return docs.select("doc_id", runs.alias("__runs")).select("doc_id", "__runs.*")
