"""Quality rules: rule statistics of whole texts, judged by an isolation forest.

Words are runs of non-white-space (``[^\\x20\\x09-\\x0D]+``). The forest is fitted on a bounded sample of
labelled rows; random splits isolate unusual rule statistics on short paths. The cut on the anomaly score
comes from all labelled rows. Documents that fail the fixed rules go in any case.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import textnum
from forecourt.sources import scratch

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
NEWLINE = np.arange(256) == 10
UPPER = np.isin(np.arange(256), np.arange(65, 91))
LETTER = UPPER | np.isin(np.arange(256), np.arange(97, 123)) | (np.arange(256) >= 0xC0)
POINT = (np.arange(256) & 0xC0) != 0x80

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_letters", "n_upper"]
BINS = 1000


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[bounds])


def _in_row(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One key for a hash in a row."""
    return textnum.mix(h ^ textnum.mix(row.astype(np.uint64)))


def rule_counts(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text: those of ``COUNTS`` and ``MORE``.

    word_chars: code points in words. n_dup_lines: lines with a word that equal an earlier line.
    n_repeat_words: words in 3-word windows that occur twice or more in the text, each word once.
    """
    n_rows = len(bounds) - 1
    row, start, end = textnum.words(data, bounds)
    hashes = textnum.word_hashes(data, start, end, lower=False)
    n_words = np.bincount(row, minlength=n_rows)
    out = {"n_words": n_words, "word_chars": _per_row(POINT[data] & ~textnum.WHITE[data], bounds)}
    out |= {name: _per_row(kind[data], bounds) for name, kind in (("n_symbols", SYMBOLS), ("n_letters", LETTER), ("n_upper", UPPER))}

    line_row, s, e = textnum.words(data, bounds, NEWLINE)
    filled = np.searchsorted(start, e) > np.searchsorted(start, s)
    line_row, s, e = line_row[filled], s[filled], e[filled]
    _, first = np.unique(_in_row(line_row, textnum.word_hashes(data, s, e, lower=False)), return_index=True)
    out["n_lines"] = np.bincount(line_row, minlength=n_rows)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(line_row[first], minlength=n_rows)

    repeats = np.zeros(len(row), bool)
    if len(row) > 2:
        window = np.flatnonzero(row[:-2] == row[2:])
        three = textnum.mix(textnum.mix(hashes[window]) + hashes[window + 1])
        three = _in_row(row[window], three * np.uint64(3) + hashes[window + 2])
        _, which, times = np.unique(three, return_inverse=True, return_counts=True)
        hit = window[times[which] > 1]
        for k in range(3):
            repeats[hit + k] = True
    out["n_repeat_words"] = np.bincount(row[repeats], minlength=n_rows)
    return out


def failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    """The fixed rules: under 50 words, or over half of them in repeated windows."""
    return (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Rates for the forest; none of them grows with the length of a text."""
    words = np.maximum(counts["n_words"], 1)
    chars = np.maximum(counts["word_chars"], 1)
    return np.column_stack(
        [
            np.log1p(counts["n_symbols"] / words),
            counts["word_chars"] / words,
            counts["n_letters"] / chars,
            counts["n_upper"] / chars,
            counts["n_repeat_words"] / words,
        ]
    )


def _counted(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    parts = [rule_counts(data, bounds) for _, _, data, bounds in textnum.row_slices(*textnum.texts(batch.column("text")))]
    return {name: np.concatenate([p[name] for p in parts]) if parts else np.zeros(0, np.int64) for name in COUNTS + MORE}


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every text of ``docs``; a null text has none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = _counted(batch)
            arrays = [batch.column("doc_id"), *(pa.array(counts[name].astype(np.int64)) for name in COUNTS + MORE)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *COUNTS, *MORE])

    schema = ", ".join(["doc_id long", *(f"{name} long" for name in COUNTS + MORE)])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, schema)


class Forest:
    """An isolation forest: trees of random splits over small samples, as arrays.

    ``score`` is 2 ** (-mean path length / expected path length): near 1 for rows that few splits isolate.
    """

    def __init__(self, rows: np.ndarray, trees: int, per_tree: int, seed: int):
        rng = np.random.default_rng(seed)
        self.size = min(per_tree, len(rows))
        self.depth = int(np.ceil(np.log2(max(self.size, 2))))
        self.trees = [self._grow(rows[rng.choice(len(rows), self.size, replace=False)], rng) for _ in range(trees)]

    @staticmethod
    def expected(n):
        n = np.asarray(n, float)
        harmonic = np.log(np.maximum(n - 1, 1)) + 0.5772156649
        return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))

    def _grow(self, rows, rng):
        nodes: list[list[float]] = []  # feature (-1: leaf), cut, left, right, path length

        def add(part, depth):
            at = len(nodes)
            nodes.append([-1, 0.0, 0, 0, depth + float(self.expected(len(part)))])
            low, high = part.min(axis=0), part.max(axis=0)
            open_ = np.flatnonzero(high > low)
            if depth < self.depth and len(part) > 1 and len(open_):
                f = int(rng.choice(open_))
                cut = rng.uniform(low[f], high[f])
                left = part[:, f] <= cut
                nodes[at][:4] = [f, cut, add(part[left], depth + 1), add(part[~left], depth + 1)]
            return at

        add(rows, 0)
        return np.array(nodes)

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for tree in self.trees:
            at = np.zeros(len(rows), int)
            for _ in range(self.depth):
                f = tree[at, 0].astype(int)
                down = np.where(rows[np.arange(len(rows)), np.maximum(f, 0)] <= tree[at, 1], tree[at, 2], tree[at, 3])
                at = np.where(f >= 0, down, at).astype(int)
            total += tree[at, 4]
        return 2 ** (-total / len(self.trees) / max(float(self.expected(self.size)), 1e-9))


def _scored(stats: DataFrame, forest) -> DataFrame:
    def score(batches):
        for batch in batches:
            counts = {name: batch.column(name).to_numpy() for name in COUNTS + MORE}
            value = forest.value.score(features(counts)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], [*batch.schema.names, "anomaly"])

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in stats.schema] + ["anomaly double"])
    return stats.mapInArrow(score, schema)


def fit(stats: DataFrame, labels: DataFrame, sample: int = 4096, trees: int = 100, per_tree: int = 256, reject_cost: float = 10.0, seed: int = 7):
    """A forest (broadcast) and the cut on its score, or None without labelled rows.

    The forest sees at most ``sample`` labelled rows that pass the fixed rules, those of the smallest id hashes.
    The cut catches the most low-quality rows less ``reject_cost`` times the share of good ones, over all
    labelled rows, counted in bins of the score. A doc labelled twice is good if one label says so.
    """
    labels = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    passed = "n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words"
    known = stats.where(passed).join(labels, "doc_id")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(sample).select(*COUNTS, *MORE).toArrow()
    if chosen.num_rows < 2:
        return None
    forest = stats.sparkSession.sparkContext.broadcast(
        Forest(features({name: chosen[name].to_numpy() for name in COUNTS + MORE}), trees, per_tree, seed)
    )
    binned = _scored(known, forest).groupBy("quality", F.floor(F.col("anomaly") * BINS).cast("int").alias("bin")).count()
    seen = np.zeros((2, BINS + 2))
    for r in binned.collect():
        seen[r["quality"], r["bin"]] = r["count"]
    above = seen[:, ::-1].cumsum(axis=1)[:, ::-1]
    share = above / np.maximum(above[:, :1], 1)
    gain = share[0] - reject_cost * share[1]
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return forest, float(best[len(best) // 2]) / BINS


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id``, the five counts, ``base_failed``, ``anomaly`` and ``kept`` of every row of ``docs``.

    A row is kept if it passes the fixed rules and its anomaly is below the cut (``fit``). A null or empty
    text has no words and fails. Repeated rows and null ids are judged row by row; other columns are ignored.
    Without labelled rows only the fixed rules hold, and ``anomaly`` is null.
    """
    stats = scratch.materialise(statistics(docs), "quality")
    model = fit(stats, labels, **options)
    failed_ = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    if model:
        rows, kept = _scored(stats, model[0]), F.col("anomaly") < model[1]
    else:
        rows, kept = stats.withColumn("anomaly", F.lit(None).cast("double")), F.lit(True)
    return rows.select("doc_id", *COUNTS, failed_.alias("base_failed"), "anomaly", (~failed_ & kept).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns; no row is moved."""
    model = fit(scratch.materialise(statistics(docs), "quality"), labels, **options)

    def keep(batches):
        for batch in batches:
            counts = _counted(batch)
            good = ~failed(counts)
            if model and batch.num_rows:
                good &= model[0].value.score(features(counts)) < model[1]
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
