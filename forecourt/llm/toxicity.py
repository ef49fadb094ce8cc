"""Toxicity by class-conditional Kneser-Ney models of words.

A class is the context of its words. Each class has the interpolated Kneser-Ney estimate

    p(w | c) = (max(n(c, w) - D_c, 0) + D_c * N1+(c, .) * p_shared(w)) / n(c)

with n(c, w) occurrences and N1+(c, .) distinct words of the class. The lower order is shared by both classes and
holds continuation counts, the number N1+(., w) of different contexts, that is classes, in which w occurs:

    p_shared(w) = (max(N1+(., w) - D, 0) + D * V / (V + 1)) / N1+(., .)

for V words and one unseen word. Discounts are n1 / (n1 + 2 * n2) from the counts of counts, so between 0 and 1. A rare
expression keeps little of its own count in either class and gets its mass from the shared counts. A text's raw score
is the log-likelihood under the toxic model less that under the ordinary one, by the number of words and ``STEADY``
more that say nothing, so that a few unseen words do not decide on a short text.

Models are fitted on at most about ``sample`` labelled rows, and on half of them as long as they hold more than
``most_words`` words; so what is sent to the tasks is bounded. Documents are counted and scored where they lie: no
text is shuffled. Words (ASCII punctuation separates, A-Z as a-z) are known by a 64-bit hash.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm import textnum
from forecourt.sources import scratch

BINS = 512

#: Of the five folds by crc32(doc_id), this one is never learned from.
HELD_OUT = 0
#: Words of no weight that are added to the length of a text.
STEADY = 50
#: One in so many of the other labelled rows, by a hash of the id, calibrates.
CALIBRATE = 5


class Model(NamedTuple):
    """Log ratio p(w | toxic) / p(w | ordinary) of the known words (sorted hashes) and of every other word."""

    words: np.ndarray
    ratios: np.ndarray
    rest: float


def fold(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5))


def _calibrates() -> Column:
    return F.pmod(F.xxhash64(F.col("doc_id"), F.lit("calibration")), F.lit(CALIBRATE)) == 0


def _known(batch: pa.RecordBatch, ids: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows of a batch whose ``doc_id`` is among the sorted ``ids``, and their places there."""
    own = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.minimum(np.searchsorted(ids, own), max(len(ids) - 1, 0))
    hit = np.zeros(len(own), bool) if not len(ids) else (ids[at] == own) & ~np.asarray(batch.column("doc_id").is_null())
    return batch.filter(pa.array(hit)), at[hit]


def _count(labels):
    """Distinct words of a few labelled rows: ``word, n0, n1``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, toxic = labels.value
        for batch in batches:
            rows, at = _known(batch, ids)
            for first, last, data, bounds in textnum.row_slices(*textnum.texts(rows.column("text"))):
                row, starts, ends = textnum.words(data, bounds, textnum.NONWORD)
                word, inverse = np.unique(textnum.word_hashes(data, starts, ends), return_inverse=True)
                n = np.bincount(inverse, minlength=len(word))
                n1 = np.bincount(inverse, toxic[at[first:last]][row], minlength=len(word)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (word.view(np.int64), n - n1, n1)], ["word", "n0", "n1"])

    return run


def word_counts(docs: DataFrame, ids: np.ndarray, toxic: np.ndarray) -> DataFrame:
    """``word, n0, n1`` of the rows of ``docs`` with one of the sorted ``ids``: hash and counts by class."""
    labels = docs.sparkSession.sparkContext.broadcast((ids, toxic))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = rows.mapInArrow(_count(labels), "word long, n0 long, n1 long")
    return parts.groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _discount(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once and twice else 0.5


def model_of(counts: DataFrame) -> Model | None:
    """The log ratios that follow from ``word_counts``; none if a class has no word."""
    counts = counts.withColumn("classes", (F.col("n0") > 0).cast("int") + (F.col("n1") > 0).cast("int"))
    sums = [F.count(F.lit(1)).alias("types")]
    for c in ("n0", "n1", "classes"):
        sums += [F.sum(c).alias(c), F.count_if(F.col(c) > 0).alias(f"{c}_types")]
        sums += [F.count_if(F.col(c) == k).alias(f"{c}_{k}") for k in (1, 2)]
    s = counts.agg(*sums).first()
    if not s["n0"] or not s["n1"]:
        return None
    d = {c: _discount(s[f"{c}_1"], s[f"{c}_2"]) for c in ("n0", "n1", "classes")}

    def kept(c: str) -> Column:
        return F.greatest(F.col(c) - F.lit(d[c]), F.lit(0.0))

    unseen = d["classes"] * s["types"] / (s["types"] + 1)
    shared = (kept("classes") + unseen) / s["classes"]
    left = {c: d[c] * s[f"{c}_types"] for c in ("n0", "n1")}
    p = {c: (kept(c) + left[c] * shared) / s[c] for c in ("n0", "n1")}
    rows = counts.select("word", (F.log(p["n1"]) - F.log(p["n0"])).alias("ratio")).toArrow()
    words = rows.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    rest = float(np.log(left["n1"] / s["n1"]) - np.log(left["n0"] / s["n0"]))
    return Model(words[order], rows.column("ratio").to_numpy()[order], rest)


def _means(column: pa.Array, model: Model) -> np.ndarray:
    """The sum of the log ratios of the words of each text by their number and ``STEADY`` more."""
    out = np.zeros(len(column))
    for at, to, data, bounds in textnum.row_slices(*textnum.texts(column)):
        row, starts, ends = textnum.words(data, bounds, textnum.NONWORD)
        word = textnum.word_hashes(data, starts, ends)
        place = np.minimum(np.searchsorted(model.words, word), len(model.words) - 1)
        value = np.where(model.words[place] == word, model.ratios[place], model.rest)
        out[at:to] = np.bincount(row, value, minlength=to - at) / (np.bincount(row, minlength=to - at) + STEADY)
    return out


def raw_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, raw`` for every row of ``docs`` (``doc_id, text``)."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for batch in batches:
            raw = pa.array(_means(batch.column("text"), model))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), raw], ["doc_id", "raw"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, raw double")


def _calibration_rows(docs: DataFrame, labels: DataFrame, model: Model, sample: int) -> DataFrame:
    """``toxic, raw`` of the labelled rows that calibrate; their texts are read where they lie."""
    known = labels.where(_calibrates())
    ids, toxic = _sampled(known, min(1.0, sample / max(1, known.count())))
    sent = docs.sparkSession.sparkContext.broadcast((ids, toxic, tuple(model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, toxic, model = sent.value
        for batch in batches:
            rows, at = _known(batch, ids)
            raw = pa.array(_means(rows.column("text"), Model(*model)))
            yield pa.RecordBatch.from_arrays([pa.array(toxic[at]), raw], ["toxic", "raw"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "toxic long, raw double")
    return scratch.materialise(rows, "calibration")


def _labels(labels: DataFrame) -> DataFrame:
    labels = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    return labels.groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic")).where(fold() != HELD_OUT)


def _sampled(labels: DataFrame, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids and classes of about a ``share`` of the labelled rows, the same ones in every run."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = labels.where(part).select("doc_id", "toxic").toArrow()
    ids, toxic = rows.column("doc_id").to_numpy(), rows.column("toxic").to_numpy()
    order = np.argsort(ids)
    return ids[order], toxic[order]


def fit(docs: DataFrame, labels: DataFrame, sample: int = 100_000, most_words: int = 1 << 23) -> Model | None:
    """The models of the labelled rows (``doc_id, toxic``, one per id) that are neither held out nor calibrate."""
    train = labels.where(~_calibrates())
    share = min(1.0, sample / max(1, train.count()))
    while True:
        counts = scratch.materialise(word_counts(docs, *_sampled(train, share)), "counts")
        if counts.count() <= most_words:
            return model_of(counts)
        share /= 2


def _calibrate(known: DataFrame, false_alarm_cost: float) -> tuple[float, float]:
    """Cut and scale of ``toxic, raw``: the largest share of toxic rows caught less that of false alarms times their cost.

    Rows are counted by class in bins of the raw score, so the driver sees ``BINS`` counts of each class.
    """
    span = known.agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"), F.stddev_pop("raw").alias("sd")).first()
    if span["lo"] is None:
        return 0.0, 1.0
    step = (span["hi"] - span["lo"]) / BINS or 1.0
    at = F.least(F.floor((F.col("raw") - span["lo"]) / step), F.lit(BINS - 1))
    seen = np.zeros((2, BINS))
    for r in known.groupBy("toxic", at.alias("bin")).count().collect():
        seen[r["toxic"], r["bin"]] = r["count"]
    above = seen[:, ::-1].cumsum(axis=1)[:, ::-1]
    share = above / np.maximum(above[:, :1], 1)
    return span["lo"] + int((share[1] - false_alarm_cost * share[0]).argmax()) * step, span["sd"] or 1.0


def score(docs: DataFrame, labels: DataFrame, false_alarm_cost: float = 3.0, sample: int = 100_000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (``doc_id, text``).

    ``score`` is 0 to 1, and 0.5 at the cut that catches the most toxic calibration rows less
    ``false_alarm_cost`` times the share of false alarms. Rows of fold 0 are held out: their labels are not
    read. About ``sample`` labelled rows at most are learned from, and as many calibrate. A doc labelled twice is
    toxic if one label says so. A null or empty text has the raw score 0. A null ``doc_id`` is in no fold
    (``held_out`` false). Repeated rows are scored alike. Without labels of both classes every score is 0. Other
    columns are ignored; an empty table gives an empty table.
    """
    docs = docs.select("doc_id", "text")
    labels = scratch.materialise(_labels(labels), "labels")
    model = fit(docs, labels, sample)
    held_out = F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out")
    if model is None:
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
        return rows.select("doc_id", held_out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    rows = raw_scores(docs, model)
    cut, scale = _calibrate(_calibration_rows(docs, labels, model, sample), false_alarm_cost)
    scored = rows.select("doc_id", held_out, (1 / (1 + F.exp(-(F.col("raw") - cut) / scale))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
