"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are cut into blocks. With weights W_s of sum W, block i (from 0) of source s has the
release time floor(i * W / W_s) and the deadline ceil((i + 1) * W / W_s); slots of one block each go to the
released block of the earliest deadline. At every slot t of a phase, each source has then had more than
t * W_s / W - 1 and less than t * W_s / W + 1 blocks.

Weights are taken as they are: a float is a fraction, and all fractions are scaled to integers of one denominator.
When a source has no more blocks and its next one would be due for release, a new phase begins in which the others
share its weight in proportion, until every document has its place. Counts begin anew with each phase. The driver lays out the schedule, one row per block; Spark counts, ranks and joins.
"""

import heapq
from array import array
from collections.abc import Iterator, Mapping
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import fresh, ranked
from forecourt.sources import scratch

#: Largest release or deadline that is written down: those of weights below 1e-18 of the sum may lie beyond.
LAST = (1 << 63) - 1
#: The columns that a mixture adds.
MADE = ("block", "weight", "release", "deadline", "slot", "phase", "position")
#: Blocks that the driver holds as one piece.
_PIECE = 100_000


def source_key(source: Column) -> Column:
    """A non-null key of a source: ``=`` and its name, or empty for null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def tempered(counts: Mapping[str, int], alpha: float) -> dict[str, float]:
    """Weights in proportion to a power of the size: below 1 large sources lose share to small ones."""
    return {s: n**alpha for s, n in counts.items()}


def exact_parts(weights: Mapping[str, float]) -> dict[str, int]:
    """Weights as integers in exactly the same proportions."""
    if not all(0 <= w < float("inf") for w in weights.values()):
        raise ValueError("a weight is negative or not finite")
    whole = {s: Fraction(w) for s, w in weights.items()}
    scale = lcm(*(w.denominator for w in whole.values()))
    return {s: int(w * scale) for s, w in whole.items()}


def schedule(blocks: Mapping[str, int], parts: Mapping[str, int]) -> Iterator[tuple]:
    """``source, block, phase, slot, release, deadline, weight`` of every block, slot after slot.

    Earliest deadline first among released blocks. Ties: a block whose deadline window overlaps the next one's goes
    first, then the larger weight, then the name. Among the first blocks of a phase this is the order of weight and
    name, so a phase begins without a look at every source. A phase ends when a source that has got its last block would
    have its next one released: until then the others keep their weights. Sources of weight 0 come when the others are used up, at equal weights.
    """
    for some, weigh in ((lambda s: parts[s] > 0, parts.get), (lambda s: parts[s] == 0, lambda s: 1)):
        order = sorted((s for s, n in blocks.items() if n and some(s)), key=lambda s: (-weigh(s), s))
        if order:
            yield from _schedule({s: blocks[s] for s in order}, {s: weigh(s) for s in order}, order)


def _schedule(blocks: dict[str, int], parts: dict[str, int], order: list[str]) -> Iterator[tuple]:
    after, before = dict(zip([None, *order], [*order, None])), dict(zip([*order, None], [None, *order]))
    total, taken = sum(parts.values()), dict.fromkeys(order, 0)

    def wanted(s, done):
        done += 1
        return -(-done * total // parts[s]), (done * total) % parts[s] == 0, -parts[s], s

    phase = slot = 0
    while total:
        untouched, ready, waiting, done, t = after[None], [], [], {}, 0
        gone, end = [], None
        while end is None or t < end:
            while waiting and waiting[0][0] <= t:
                s = heapq.heappop(waiting)[1]
                heapq.heappush(ready, wanted(s, done[s]))
            first = wanted(untouched, 0) if untouched is not None else None
            if first and (not ready or first < ready[0]):
                untouched, key = after[untouched], first
            else:
                key = heapq.heappop(ready)
            s = key[-1]
            n = done.get(s, 0)
            yield s, taken[s], phase, slot, min(n * total // parts[s], LAST), min(key[0], LAST), parts[s] / total
            done[s], taken[s], slot, t = n + 1, taken[s] + 1, slot + 1, t + 1
            release = (n + 1) * total // parts[s]
            if taken[s] < blocks[s]:
                heapq.heappush(waiting, (release, s))
            else:
                gone.append(s)
                end = release if end is None else min(end, release)
        for s in gone:
            after[before[s]], before[after[s]] = after[s], before[s]
            total -= parts[s]
        phase += 1


def _pieces(counts: Mapping[str, int], parts: Mapping[str, int], block_rows: int) -> Iterator[pa.RecordBatch]:
    """The schedule as Arrow batches, with the position ``at`` of the first row of each block."""
    names = ["source", "block", "phase", "slot", "release", "deadline", "weight", "at"]
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    at = slots = phases = 0
    last, rows = (-1, -1), None

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), *[pa.array(memoryview(x)) for x in rows[1:]]], names)

    for s, block, phase, slot, release, deadline, weight in schedule(blocks, parts):
        if slot < last[0]:  # the sources of weight 0 begin
            slots, phases = slots + last[0] + 1, phases + last[1] + 1
        last = slot, phase
        rows = rows or [[], *[array(c) for c in "qqqqqdq"]]
        for column, value in zip(rows, (s, block, phase + phases, slot + slots, release, deadline, weight, at)):
            column.append(value)
        at += min(block_rows, counts[s] - block * block_rows)
        if len(rows[0]) == _PIECE:
            yield batch()
            rows = None
    if rows:
        yield batch()


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    alpha: float = 0.7,
    block_rows: int = 100,
    order: tuple[str, ...] = ("doc_id", "text"),
    source: str = "source",
) -> DataFrame:
    """``docs`` with ``block, weight, release, deadline, slot, phase, position``, which replace columns of these names.

    ``weights`` by source name; a source without one, like all sources without ``weights``, has its number of rows to
    the power ``alpha`` of all rows. A weight of 0 places a source behind all others. ``block`` is the number of the row's block in its source (``block_rows`` rows,
    the last one fewer), ``release`` and ``deadline`` are counted from the start of its phase with the ``weight`` (0
    to 1) it has there, ``slot`` and ``position`` from 0 over all; positions are unique and gapless. A source's rows
    are taken in the order of a hash of the ``order`` columns. Every row is placed once; repeated rows are rows. A null
    source is a source of its own. An empty table stays empty.
    """
    rows = docs.drop(*MADE)
    kept = rows.columns
    key, spread, rank = (fresh(rows, c) for c in ("_source", "_spread", "_rank"))
    rows = rows.withColumns({key: source_key(F.col(source)), spread: F.xxhash64(*order)})
    slim = scratch.materialise(rows.select(key, spread), "sources")
    counts = {r[key]: r["count"] for r in slim.groupBy(key).count().collect()}
    shares = tempered({s: n / max(1, sum(counts.values())) for s, n in counts.items()}, alpha)
    parts = exact_parts(shares | {f"={s}": w for s, w in (weights or {}).items() if f"={s}" in counts})
    schema = "source string, block long, phase long, slot long, release long, deadline long, weight double, at long"
    pieces = list(_pieces(counts, parts, block_rows))
    blocks = docs.sparkSession.createDataFrame(pa.Table.from_batches(pieces), schema) if pieces else docs.sparkSession.createDataFrame([], schema)
    names = {c: fresh(rows, f"_p_{c}") for c in blocks.columns}
    blocks = scratch.materialise(blocks.withColumnsRenamed(names), "blocks")
    placed = ranked(rows, [key], [spread], list(order), slim, out=rank).withColumn("block", F.floor(F.col(rank) / block_rows))
    joined = placed.join(blocks, (F.col(key) == F.col(names["source"])) & (F.col("block") == F.col(names["block"])))
    return joined.select(
        *kept,
        "block",
        *[F.col(names[c]).alias(c) for c in ("weight", "release", "deadline", "slot")],
        F.col(names["phase"]).cast("int").alias("phase"),
        (F.col(names["at"]) + F.col(rank) - F.col("block") * block_rows).cast("long").alias("position"),
    )


def in_order(docs: DataFrame, order: tuple[str, ...] = ("doc_id", "text"), source: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, with their columns, in the order of the mixture: written, its files hold consecutive positions.

    Every column keeps its values, whatever its name. Null sources, texts and ids, repeated rows and an empty table are
    treated as by ``mix``.
    """
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    mixed = mix(docs.toDF(*names.values()), order=tuple(names[c] for c in order), source=names[source], **options)
    placed = mixed.select(*names.values(), "position").repartitionByRange("position").sortWithinPartitions("position")
    return placed.select(*names.values()).toDF(*docs.columns)
