"""Secret scans: fixed patterns, and character Markov models that tell random strings from identifiers.

Two first-order models over the characters ``[A-Za-z0-9+/_-]`` are compared by log-likelihood ratio. The
random one is trained from samples labelled by the fixed patterns (every value they find) and seeded random
strings of common alphabets; the ordinary one from all other runs of these characters in all texts. A run of
``SHORTEST`` characters or more is reported if the ratio outweighs prior odds of 1 to ``PRIOR``.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import textnum

# Patterns and their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
STATES = len(ALPHABET) + 1  # state 0: outside a run
SHORTEST = 16
LEARN_FROM = 6
PRIOR = 10_000

_STATE = np.zeros(256, np.int64)
_STATE[np.frombuffer(ALPHABET, np.uint8)] = np.arange(1, STATES)
_OUTSIDE = _STATE == 0
_NOT_HEX = ~np.isin(np.arange(256), np.frombuffer(b"0123456789abcdef", np.uint8))


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """Start, kind, end and start of the value of each fixed match, in code points, sorted.

    Leftmost and non-overlapping per kind; matches that are too short are dropped.
    """
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return sorted(found)


def _suspects(data: np.ndarray, bounds: np.ndarray) -> list[int]:
    """Rows that can hold a fixed match: they have an assignment sign, AKIA or a long hex run."""
    sign = np.flatnonzero((data == ord("=")) | (data == ord(":")))
    key = np.flatnonzero((data[:-3] == 65) & (data[1:-2] == 75) & (data[2:-1] == 73) & (data[3:] == 65)) if len(data) > 3 else sign[:0]
    row, start, end = textnum.words(data, bounds, _NOT_HEX)
    places = np.searchsorted(bounds, np.concatenate((sign, key)), "right") - 1
    return np.unique(np.concatenate((places, row[end - start >= 32]))).tolist()


def _scan(column):
    """Slices of a text column with the fixed spans of their rows: first row, bytes, bounds, {row: (text, spans)}."""
    for at, _, data, bounds in textnum.row_slices(*textnum.texts(column)):
        hits = {}
        for i in _suspects(data, bounds):
            text = data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "replace")
            if spans := base_spans(text):
                hits[i] = text, spans
        yield at, data, bounds, hits


def _steps(states: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """From state and to state of every byte as one number; a row starts outside."""
    before = np.concatenate(([0], states[:-1]))
    before[bounds[:-1][bounds[:-1] < len(states)]] = 0
    return before * STATES + states


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, STATES * STATES), np.int64)
    for batch in batches:
        for _, data, bounds, hits in _scan(batch.column("text")):
            states = _STATE[data]
            row, start, end = textnum.words(data, bounds, _OUTSIDE)
            long = end - start >= LEARN_FROM
            marks = np.zeros(len(data) + 1, np.int64)
            np.add.at(marks, start[long], 1)
            np.add.at(marks, end[long], -1)
            use = np.cumsum(marks)[:-1] > 0
            for i, (text, spans) in hits.items():
                for _, _, to, value in spans:
                    a = bounds[i] + len(text[:value].encode())
                    b = a + len(text[value:to].encode())
                    use[a:b] = False
                    own = np.concatenate(([0], states[a:b]))
                    np.add.at(total[1], (own[:-1] * STATES + own[1:])[own[1:] > 0], 1)
            total[0] += np.bincount(_steps(states, bounds)[use], minlength=STATES * STATES)
    label, step = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(step), pa.array(total[label, step])], ["label", "step", "n"])


def _random_samples(seed: int = 11, strings: int = 2000, length: int = 32) -> np.ndarray:
    """Step counts of seeded random strings over hex, alphanumeric and base64 alphabets."""
    rng, total = np.random.default_rng(seed), np.zeros(STATES * STATES)
    for letters in (b"0123456789abcdef", ALPHABET[:62], ALPHABET[26:62], ALPHABET):
        drawn = _STATE[np.frombuffer(letters, np.uint8)[rng.integers(0, len(letters), (strings, length))]]
        own = np.concatenate((np.zeros((strings, 1), int), drawn), axis=1)
        total += np.bincount((own[:, :-1] * STATES + own[:, 1:]).ravel(), minlength=STATES * STATES)
    return total


def _joined_words(counts: np.ndarray, share: float = 0.05) -> np.ndarray:
    """Step counts of identifiers made of the corpus's own words, as in ``snake_case`` and ``camelCase``."""
    square, out = counts.reshape(STATES, STATES), np.zeros((STATES, STATES))
    upper, lower = _STATE[np.arange(65, 91)], _STATE[np.arange(97, 123)]
    starts = square[0, lower] + square[0, upper]
    joins = share * square[lower].sum(axis=1)
    starts = starts / max(starts.sum(), 1)
    follow = square[lower][:, lower]
    for mark in b"_-":
        out[lower, _STATE[mark]] += joins / 3
        out[_STATE[mark], lower] += joins.sum() / 3 * starts
    out[np.ix_(lower, upper)] += np.outer(joins / 3, starts)
    out[np.ix_(upper, lower)] += joins.sum() / 3 * starts[:, None] * follow / np.maximum(follow.sum(axis=1, keepdims=True), 1)
    return out.ravel()


def fit(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio (random over ordinary) of each step, from the runs of all texts of ``docs``.

    Spark sums the step counts; the driver gets one row per label and pair of characters at most.
    """
    counts = np.zeros((2, STATES * STATES))
    seen = docs.select("text").mapInArrow(_learn, "label long, step long, n long").groupBy("label", "step").agg(F.sum("n").alias("n")).toArrow()
    counts[seen["label"].to_numpy(), seen["step"].to_numpy()] = seen["n"].to_numpy()
    counts[0] += _joined_words(counts[0])
    samples = _random_samples()
    counts[1] = samples + counts[1] * samples.sum() / max(counts[1].sum(), samples.sum())
    square = counts.reshape(2, STATES, STATES) + 0.5
    square[:, :, 0] = 0
    with np.errstate(divide="ignore"):
        log = np.log(square / square.sum(axis=2, keepdims=True))
    ratio = log[1] - np.where(np.isfinite(log[0]), log[0], 0)
    ratio[:, 0] = 0
    return ratio.ravel()


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, kinds, starts, ends`` of the spans of every row of ``docs``, and the counts by kind.

    Fixed spans (``assign``, ``access``, ``hex``) always stay; ``random`` spans of the models are added where
    they overlap none of them. Offsets are code points, ends exclusive; spans are sorted by start, then kind.
    ``base_sha256`` and ``spans`` list the fixed and all spans as ``kind:start:end``. A null text is empty.
    Null and repeated ids are scanned row by row; other columns are ignored.
    """
    ratio = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def find(batches):
        for batch in batches:
            rows: list[list] = [[] for _ in range(batch.num_rows)]
            for at, data, bounds, hits in _scan(batch.column("text")):
                for i, (_, spans) in hits.items():
                    rows[at + i] = [(s, k, e) for s, k, e, _ in spans]
                row, start, end = textnum.words(data, bounds, _OUTSIDE)
                long = end - start >= SHORTEST
                if long.any():
                    gain = np.concatenate(([0.0], np.cumsum(ratio.value[_steps(_STATE[data], bounds)])))
                    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                    likely = long & (gain[end] - gain[start] > np.log(PRIOR))
                    for i, s, e in zip(row[likely], start[likely], end[likely]):
                        span = int(points[s] - points[bounds[i]]), 3, int(points[e] - points[bounds[i]])
                        if all(span[2] <= s0 or span[0] >= e0 for s0, k0, e0 in rows[at + i] if k0 < 3):
                            rows[at + i].append(span)
            for spans in rows:
                spans.sort()
            listed = [[f"{KINDS[k]}:{s}:{e}" for s, k, e in spans] for spans in rows]
            base = [",".join(x for x in one if not x.startswith("random")) for one in listed]
            ints = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array([sum(k == kind for _, k, _ in spans) for spans in rows], pa.int64()) for kind in range(4)),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base]),
                    pa.array([",".join(one) for one in listed]),
                    pa.array([[KINDS[k] for _, k, _ in spans] for spans in rows], pa.list_(pa.string())),
                    pa.array([[s for s, _, _ in spans] for spans in rows], ints),
                    pa.array([[e for _, _, e in spans] for spans in rows], ints),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans", "kinds", "starts", "ends"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        find,
        "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string, "
        "kinds array<string>, starts array<long>, ends array<long>",
    )


def redact(docs: DataFrame, spans: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``scan`` replaced in its text, joined on ``doc_id`` (unique ids)."""
    found = spans.select("doc_id", F.arrays_zip("starts", "ends").alias("_spans")).where("size(_spans) > 0")
    merged = F.aggregate(
        "_spans",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.struct(
            F.when(s.ends <= a["at"], a["out"])
            .otherwise(F.concat(a["out"], F.substr("text", a["at"].cast("int") + 1, F.greatest(s.starts - a["at"], F.lit(0)).cast("int")), F.lit(mark)))
            .alias("out"),
            F.greatest(a["at"], s.ends).alias("at"),
        ),
    )
    joined = docs.join(found, "doc_id", "left").withColumn("_m", merged)
    tail = F.concat(F.col("_m.out"), F.substr("text", F.col("_m.at").cast("int") + 1, F.length("text")))
    return joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(tail)).drop("_spans", "_m").select(docs.columns)
