"""Periodic runs of words by online dyadic square catching.

A run is a stretch of words with smallest period q that no neighbour extends; it counts if it has ``POWER`` periods
and ``LEAST`` words. Words are appended to a text. For each power of two L, every completed block of L words at a
multiple of L is a catcher: the suffixes of L words that begin in the next block, at distances L to 2 L - 1, are
compared with it as the words arrive. A suffix that equals its catcher at distance p is a piece of a square of period p.
Hits of neighbouring catchers at one distance are one square that goes on; when the chain breaks, its ends are
compared word by word, by less than L words on either side, and it is reported as a run. Runs of POWER (4) or more periods
p in [L, 2 L) hold at least two neighbouring blocks, so single hits, which common words make, need no look.

Blocks and suffixes are known by names: the name of 2 L words is a hash of the names of its halves. A level works on
all words of one ``append`` at once. A square whose period is a multiple of a shorter one belongs to the run of that
one, which a lower level has reported, and is left out. For n words the work is n log n.

The texts of a batch are one text here, with a word of its own between two of them, so that no run crosses.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm import textnum
from forecourt.llm.common import fresh

POWER, LEAST = 4, 6

RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def _primes(n: int) -> list[int]:
    """The prime factors of n."""
    out, k = [], 2
    while k * k <= n:
        if n % k == 0:
            out.append(k)
            while n % k == 0:
                n //= k
        k += 1
    return [*out, n] if n > 1 else out


class _Level:
    """Catchers of ``size`` words: names of all windows, rows of suffixes compared, chains of hits that are still open."""

    def __init__(self, size: int):
        self.size, self.names = size, np.zeros(0, np.uint64)
        self.row = 1  # the next row: suffixes that begin in this block, compared with the block before
        self.hit = np.zeros(size, bool)
        self.first = np.zeros(size, np.int64)

    def advance(self, lower: np.ndarray, final: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chains of two or more hits that have ended: first row, last row and distance. ``lower``: names of windows half as long."""
        size, half = self.size, self.size // 2
        if half:
            done, n = len(self.names), max(0, len(lower) - half)
            new = textnum.mix(lower[done:n] * np.uint64(3)) + lower[done + half : n + half]
            self.names = np.concatenate((self.names, textnum.mix(new)))
        else:
            self.names = lower
        rows = len(self.names) // size - self.row
        names = self.names[self.row * size :]
        if final:  # the last row may lack suffixes; a further one ends all chains
            rows += 2
            spare = max(0, rows * size - len(names))
            known = np.concatenate((np.ones(len(names), bool), np.zeros(spare, bool)))[: rows * size]
            names = np.concatenate((names, np.zeros(spare, np.uint64)))
        none = np.zeros(0, np.int64)
        if rows <= 0:
            return none, none, none
        catchers = self.names[(self.row - 1) * size : (self.row - 1 + rows) * size : size]
        short = rows - len(catchers)
        if short:
            catchers = np.concatenate((catchers, np.zeros(short, np.uint64)))
        hits = names[: rows * size].reshape(rows, size) == catchers[:, None]
        if final:
            hits &= known.reshape(rows, size)
            hits[rows - short :] = False
        before = np.vstack((self.hit[None, :], hits[:-1]))
        begin = np.vstack((self.hit[None, :], hits & ~before))
        end = np.vstack((before & ~hits, hits[-1:]))
        d, k = np.nonzero(begin.T)
        stop = np.nonzero(end.T)[1]
        first = np.where(k == 0, self.first[d], self.row + k - 1)
        open_ = stop == rows
        self.first[d[open_]] = first[open_]
        self.hit = hits[-1]
        last = self.row + stop - 1
        self.row += rows
        ended = ~open_ & (last > first)
        return first[ended], last[ended], size + d[ended]


class Catchers:
    """The runs of a text whose words (64-bit hashes) are appended in parts; ``longest`` bounds the length of a run."""

    def __init__(self, longest: int):
        self.words = np.zeros(0, np.uint64)
        self.levels = []
        while POWER << len(self.levels) <= longest:
            self.levels.append(_Level(1 << len(self.levels)))
        self.runs: list[tuple[int, int, int]] = []
        self.cover = np.zeros(0, np.int32)
        self.ends, self.periods = [0], [1]

    def append(self, words: np.ndarray, final: bool = False) -> list[tuple[int, int, int]]:
        """The runs ``(start, length, period)`` that have ended; with ``final`` no word follows."""
        self.words = np.concatenate((self.words, words))
        self.cover = np.concatenate((self.cover, np.zeros(len(words), np.int32)))
        known, names = len(self.runs), self.words
        for level in self.levels:
            self._report(level.size, *level.advance(names, final))
            names = level.names
        return self.runs[known:]

    def _report(self, size: int, first: np.ndarray, last: np.ndarray, period: np.ndarray) -> None:
        """Extends ended chains and keeps those that are runs of their smallest period."""
        start, end = (first - 1) * size, last * size
        run = self.cover[start]
        inside = (run > 0) & (np.array(self.ends)[run] >= end + period) & (period % np.array(self.periods)[run] == 0)
        w = self.words
        for a, b, p in zip(start[~inside].tolist(), end[~inside].tolist(), period[~inside].tolist()):
            lo = max(0, a - size + 1)
            off = np.flatnonzero(w[lo:a] != w[lo + p : a + p])
            a = lo + int(off[-1]) + 1 if len(off) else lo
            hi = min(len(w) - p, b + size)
            off = np.flatnonzero(w[b:hi] != w[b + p : hi + p])
            b = b + int(off[0]) if len(off) else max(b, hi)
            if b + p - a < max(LEAST, POWER * p):
                continue
            if any(np.array_equal(w[a : a + p - p // r], w[a + p // r : a + p]) for r in _primes(p)):
                continue
            self.runs.append((a, b + p - a, p))
            self.ends.append(b + p)
            self.periods.append(p)
            part = self.cover[a : b + p]
            part[part == 0] = len(self.runs)


def runs_of(rows: np.ndarray, words: np.ndarray, n_rows: int) -> tuple[np.ndarray, ...]:
    """Row, start, length and period of all runs of many texts, from the row and hash of each word, by row, start, period."""
    counts = np.bincount(rows, minlength=n_rows)
    place = np.arange(len(words)) + rows  # one word of its own behind each text
    # What is left of the hash range by the few words between texts equals no word but by chance of 2**-64.
    line = textnum.mix(np.arange(len(words) + n_rows, dtype=np.uint64) ^ np.uint64(0xD1B54A32D192ED03))
    line[place] = words
    catchers = Catchers(int(counts.max(initial=0)))
    found = np.array(catchers.append(line, final=True), np.int64).reshape(-1, 3)
    begin = np.cumsum(counts + 1) - counts - 1
    row = np.searchsorted(begin, found[:, 0], "right") - 1
    found[:, 0] -= begin[row]
    order = np.lexsort((found[:, 2], found[:, 0], row))
    return row[order], *found[order].T


def _collapse(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(text)
        for at, to, data, bounds in textnum.row_slices(*textnum.texts(column)):
            rows, starts, ends = textnum.words(data, bounds)
            row, start, length, period = runs_of(rows, textnum.word_hashes(data, starts, ends, lower=False), to - at)
            base = np.searchsorted(rows, np.arange(to - at))
            marks = np.zeros(len(rows) + 1, np.int64)
            np.add.at(marks, base[row] + start + period, 1)
            np.add.at(marks, base[row] + start + length, -1)
            kept = np.cumsum(marks)[:-1] == 0
            with_runs, whole = set(row.tolist()), data.tobytes()
            collapsed = []
            for k in range(to - at):
                words = whole[bounds[k] : bounds[k + 1]].split()
                if k in with_runs:
                    words = [w for w, keep in zip(words, kept[base[k] : base[k] + len(words)].tolist()) if keep]
                collapsed.append(b" ".join(words))
            offsets = pa.array(np.searchsorted(row, np.arange(to - at + 1)).astype(np.int32))
            parts = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
            added = [
                pa.array(np.bincount(rows, minlength=to - at).astype(np.int64)),
                pa.ListArray.from_arrays(offsets, parts),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ]
            part = batch.slice(at, to - at).drop_columns([text])
            yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, "n_words", "runs", "collapsed"])


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_words``, ``runs`` and ``collapsed``, which replace columns of these names.

    Words are runs of non-white-space, compared as they are. ``runs`` holds ``start, length, period`` of every run in words, by
    start, then period. ``collapsed`` joins by one space the words that are in no run behind its first period. A null
    or empty text has no words, no runs and an empty ``collapsed``. Repeated rows are treated alike; other columns
    stay as they are; an empty table stays empty.
    """
    new = ["n_words", "runs", "collapsed"]
    own = fresh(docs, "_text")
    rows = docs.select(*[c for c in docs.columns if c not in (*new, text)], F.col(text).cast("string").alias(own))
    added = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    schema = T.StructType([*rows.drop(own).schema.fields, *added])
    return rows.mapInArrow(lambda batches: _collapse(batches, own), schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in one of ten documents, by crc32 of the id, the words from some place on are made periodic.

    With h the crc32 of the id's digits, g = h / 10 and n words: if h mod 10 is 0, words from a = g mod n on repeat with
    period 1 + (n - a) / (3 + g mod 8), all in whole numbers. A null id is left alone.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    rows = rows.withColumns({"g": F.expr("h div 10"), "n": F.size("w")})
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = F.array_join(F.expr("transform(w, (x, i) -> IF(i < a, x, w[CAST(a + (i - a) % p AS INT)]))"), " ")
    return rows.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(planted).alias("text"))


def digest(collapsed: DataFrame) -> DataFrame:
    """``doc_id``, number of runs, the longest one (ties: smallest start, then period) and hashes of all runs and of ``collapsed``."""
    first = "aggregate(runs, CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>), (a, r) -> IF(a IS NULL OR r.length > a.length, r, a))"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return collapsed.withColumn("longest", F.expr(first)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"longest.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.expr(lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
