"""Periodic runs of words in each text.

A run is a stretch of at least two periods that no neighbouring word extends.
Common extensions of two places are looked up with a difference cover: only
suffixes that begin at cover positions are sorted, a few words are compared
until both places reach them together, and a sparse table of minima over their
common prefixes gives the rest. The places that are asked about are the pairs
(kq, kq + q) of the harmonic grid: every run of period q holds one of them.
"""

import functools
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendlake.llm.common import WORD, parts_of, table

# A perfect difference cover; every difference modulo CYCLE is that of two of them.
CYCLE = 31
COVER = np.array([0, 1, 3, 8, 12, 18])
#: Shortest run that counts, in words.
SHORTEST = 12
#: Positions whose part of the grid is made at once.
BLOCK = 1 << 16


def _shifts():
    """The least d for residues (a, b) with a + d and b + d both in the cover."""
    there = np.zeros((CYCLE, CYCLE), bool)
    there[:, COVER] = True
    shifts = np.empty((CYCLE, CYCLE), np.int64)
    for a in range(CYCLE):
        for b in range(CYCLE):
            d = np.arange(CYCLE)
            shifts[a, b] = np.flatnonzero(there[0, (a + d) % CYCLE] & there[0, (b + d) % CYCLE])[0]
    return shifts


SHIFT = _shifts()
#: Place of a residue in the cover.
PLACE = np.searchsorted(COVER, np.arange(CYCLE))


def _dense(*keys):
    """Ranks from 1 of rows by their keys, the first key foremost; equal rows share one."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new) + 1
    return ranks


class Extensions:
    """Longest common extensions to the right in one sequence of numbers from 1 on."""

    def __init__(self, words):
        self.n = len(words)
        self.words = np.concatenate([words, np.zeros(2 * CYCLE, words.dtype)])
        self.rank = None

    def _sort(self):
        """Ranks of the sampled suffixes and minima over their neighbours' common prefixes."""
        n, w = self.n, self.words.astype(np.int64)
        sample = (np.arange(-(-n // CYCLE))[:, None] * CYCLE + COVER).ravel()
        sample = sample[sample < n]
        m, bits = len(sample), max(1, int(w.max()).bit_length())
        keys = []
        for first in range(0, CYCLE, 63 // bits):
            key = np.zeros(m, np.int64)
            for offset in range(first, min(CYCLE, first + 63 // bits)):
                key = (key << bits) | w[sample + offset]
            keys.append(key)
        levels, step = [_dense(*keys)], len(COVER)
        while levels[-1].max() < m:  # twice as many words each time
            after = np.zeros(m, np.int64)
            after[:max(0, m - step)] = levels[-1][step:]
            levels.append(_dense(levels[-1], after))
            step *= 2
        rank = levels.pop() - 1
        order = np.empty(m, np.int64)
        order[rank] = np.arange(m)
        a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(m - 1, np.int64)
        for k in reversed(range(len(levels))):
            padded = np.concatenate([levels[k], np.zeros(1, np.int64)])
            same = (padded[np.minimum(a, m)] == padded[np.minimum(b, m)]) & (a < m) & (b < m)
            common[same] += CYCLE << k
            a[same] += len(COVER) << k
            b[same] += len(COVER) << k
        p, q = sample[order[:-1]] + common, sample[order[1:]] + common
        left = np.arange(m - 1)
        while len(left):
            left = left[self.words[p[left]] == self.words[q[left]]]
            common[left] += 1
            p[left] += 1
            q[left] += 1
        self.minima = [common]
        while 2 << (len(self.minima) - 1) < m:
            half = 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(self.minima[-1][:-half], self.minima[-1][half:]))
        self.rank = rank

    def of(self, i, j):
        """How many words agree from each place in ``i`` and its partner in ``j``; i < j <= n."""
        shift, length = SHIFT[i % CYCLE, j % CYCLE], np.zeros(len(i), np.int64)
        agree, left, step = np.ones(len(i), bool), np.flatnonzero(shift > 0), 0
        while len(left):
            same = self.words[i[left] + step] == self.words[j[left] + step]
            length[left[~same]], agree[left[~same]] = step, False
            step += 1
            left = left[same]
            left = left[shift[left] > step]
        length[agree] = shift[agree]
        deep = np.flatnonzero(agree & (j + shift < self.n))
        if len(deep):
            if self.rank is None:
                self._sort()
            a, b = (p[deep] + shift[deep] for p in (i, j))
            a, b = (self.rank[p // CYCLE * len(COVER) + PLACE[p % CYCLE]] for p in (a, b))
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            for k in np.unique(level):
                at, minima = level == k, self.minima[k]
                length[deep[at]] += np.minimum(minima[low[at]], minima[high[at] - (1 << int(k))])
        return length


def _grid_part(first, last):
    """(j, q) for all j in [first, last) and the divisors q of j."""
    q = np.arange(1, last)
    before = (max(first, 1) - 1) // q
    counts = (last - 1) // q - before
    some = counts > 0
    q, before, counts = q[some], before[some], counts[some]
    turn = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    periods = np.repeat(q, counts)
    return (np.repeat(before, counts) + 1 + turn) * periods, periods


@functools.cache
def _small_grid(limit=4096):
    """The grid below ``limit`` by end, and where the pairs of each end stop."""
    j, q = _grid_part(0, limit)
    order = np.argsort(j, kind="stable")
    return j[order], q[order], np.searchsorted(j[order], np.arange(limit), "right")


def _grid(n):
    """Pairs (kq, kq + q) of places below ``n`` with 2q <= n, in blocks."""
    j, q, stops = _small_grid()
    stop = stops[min(n, len(stops)) - 1]
    yield j[:stop] - q[:stop], j[:stop]
    for first in range(len(stops), n, BLOCK):
        j, q = _grid_part(first, min(n, first + BLOCK))
        half = 2 * q <= n
        yield j[half] - q[half], j[half]


def runs(words, shortest=SHORTEST):
    """(starts, lengths, periods) of all runs of a sequence of numbers from 1 on, by start, then period."""
    n = len(words)
    found = [np.empty((0, 3), np.int64)]
    if n >= max(2, shortest):
        ahead, back = Extensions(words), Extensions(words[::-1])
        edge = np.zeros(3, words.dtype)
        w = np.concatenate([edge, words, edge])  # word i is w[i + 3]
        # A run agrees with itself a period on at so many places in a row; some side of a grid pair has half the rest.
        side = min(3, (-(-shortest // 2)) // 2)
        for i, j in _grid(n):
            hit = words[i] == words[j]
            i, j = i[hit], j[hit]
            right, left = np.ones(len(i), bool), np.ones(len(i), bool)
            for d in range(1, side + 1):
                right &= (w[i + 3 + d] == w[j + 3 + d]) & (j + d < n)
                left &= (w[i + 3 - d] == w[j + 3 - d]) & (i - d >= 0)
            i, j = i[right | left], j[right | left]
            if not len(i):
                continue
            q = j - i
            to_right, to_left = 1 + ahead.of(i + 1, j + 1), back.of(n - j, n - i)
            fit = to_right + to_left >= np.maximum(q, shortest - q)
            rows = np.stack([i - to_left, to_right + to_left + q, q], 1)[fit]
            found.append(_smallest_periods(rows))
    return _smallest_periods(np.concatenate(found)).T


def _smallest_periods(rows):
    """Of rows with one start and length, that of the smallest period; by start, then period."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def numbered(words):
    """Numbers from 1 on of words, the same for equal words."""
    numbers = defaultdict(count(1).__next__)
    return np.array([numbers[w] for w in words], np.int32)


def _text_runs(text, shortest):
    """Number of words, runs as (start, length, period) and the text without what repeats."""
    words = text.split()  # bytes split at ASCII white space alone
    found = runs(numbered(words), shortest)
    starts, lengths, periods = found
    if not len(starts):
        return len(words), found.T, b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, starts + periods, 1)
    np.add.at(depth, starts + lengths, -1)
    kept = np.cumsum(depth[:-1]) == 0
    return len(words), found.T, b" ".join([w for w, k in zip(words, kept) if k])


RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]), False)


def find_runs(docs, keys=("doc_id",), shortest=SHORTEST):
    """``docs(text, *keys)`` as the keys, ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` lists every run of at least ``shortest`` words with its smallest
    period, by start, then period. ``collapsed`` has the words that no run
    holds after its first period, joined by one space. Words are what ASCII
    white space separates. A null or empty text has no words and no runs; rows
    that repeat are answered as often, an empty table by an empty one, and
    other columns are left aside whatever their names. A text is one task's
    work: memory grows with its words, pairs of places are made in blocks.
    """
    source = docs.select(*keys, F.col("text").cast("binary").alias("text"))
    schema = T.StructType([
        *source.select(*keys).schema.fields, T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS),
        T.StructField("collapsed", T.StringType())])
    item = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def work(batches):
        for batch in batches:
            for part in parts_of(batch):
                answers = [_text_runs(t or b"", shortest) for t in part.column("text").to_pylist()]
                rows = np.concatenate([np.empty((0, 3), np.int64), *(a[1] for a in answers)])
                ends = np.cumsum([0, *(len(a[1]) for a in answers)])
                listed = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c) for c in rows.T.copy()], fields=list(item)))
                yield pa.RecordBatch.from_arrays([
                    *(part.column(k) for k in keys), pa.array([a[0] for a in answers], pa.int64()), listed,
                    pa.array([a[2].decode() for a in answers], pa.string())], names=schema.names)

    return source.mapInArrow(work, schema)


def with_planted_runs(docs):
    """Every tenth text, by checksum of its id, repeats a stretch of its words up to its end."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    n = F.nullif(F.size(words), F.lit(0))
    g = F.floor(crc / 10)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    turns = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    changed = F.concat(F.slice(words, F.lit(1), a), F.slice(F.flatten(turns), F.lit(1), n - a))
    text = F.when((crc % 10 == 0) & F.regexp_like("text", F.lit(WORD)), F.array_join(changed, " ")).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op13_word_runs(spark, sf_dir):
    """Runs of words of every document, its longest one, and digests of all of them and of what is left."""
    found = find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    found = found.withColumn("_best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.s").alias("start"),
        (-F.col("_best.l")).alias("length"), F.col("_best.p").alias("period"),
        F.floor(F.lit(-1000) * F.col("_best.l") / F.col("_best.p")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return found
