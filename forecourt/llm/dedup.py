"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, connected groups.

1. Texts with the same shingle set are one class; only classes are compared.
2. A class has a SuperMinHash signature: each shingle visits the slots in an order of its own (a random
   permutation), and its value in the j-th slot it visits lies in [j, j + 1). Once every slot holds a value
   below j, further visits cannot change a slot, so long sets stop after a few steps.
3. Classes that agree in a band of ``ROWS`` slots are candidates. In each bucket the most typical member, the one
   whose own buckets are the fullest, is compared with all others. That is linear, and settles buckets of copies.
4. Buckets that still hold several groups are refined by rare shingles: two linked sets share one of their first
   elements in a common order by rarity (``_prefixes``). Members that share such an element are compared with
   the most typical one there, then with 16, 256, 4096, ... of them, and groups are contracted after each round, until
   no element holds two groups that were not compared. No round makes more than its number of pivots times its rows.
5. Every pair first has to pass a parity sketch, a bound on the symmetric difference that no link can fail. What
   passes is verified on full shingle sets; links are grouped into components.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm import graph, textnum
from forecourt.llm.common import fresh, real_id, unit_key
from forecourt.sources import scratch

SIZE = 5
#: Bands and rows: a pair with a Jaccard similarity of 0.8 is missed with probability 3e-6, of 0.85 with 7e-9.
BANDS, ROWS = 32, 5
SLOTS = BANDS * ROWS
#: Longs of a parity sketch.
SKETCH = 8


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each text, sorted by row, then hash."""
    row, start, end = textnum.words(data, bounds)
    row, h = textnum.shingles(row, textnum.word_hashes(data, start, end), len(bounds) - 1, SIZE)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def signatures(row: np.ndarray, h: np.ndarray, n_rows: int) -> np.ndarray:
    """SuperMinHash signatures of the sets, one line of ``SLOTS`` values per row; rows without elements stay infinite."""
    out = np.full(n_rows * SLOTS, np.inf)
    live = np.arange(len(h))
    order = np.broadcast_to(np.arange(SLOTS, dtype=np.uint8), (len(h), SLOTS)).copy()
    for step in range(SLOTS):
        if not len(live):
            break
        each = np.arange(len(live))
        u = textnum.mix(h[live] + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64)))
        swap = step + ((u >> np.uint64(32)) % np.uint64(SLOTS - step)).astype(np.int64)
        slot = order[each, swap]
        order[each, swap] = order[:, step]
        value = step + (textnum.mix(u) >> np.uint64(11)) * 2.0**-53
        np.minimum.at(out, row[live] * SLOTS + slot, value)
        most = out.reshape(n_rows, SLOTS).max(axis=1)
        on = most[row[live]] > step + 1
        if not on.all():
            live, order = live[on], order[on]
    return out.reshape(n_rows, SLOTS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    bits = signature.view(np.uint64).reshape(len(signature), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bits.shape[:2])
    for k in range(ROWS):
        keys = textnum.mix(keys * np.uint64(3) + bits[:, :, k])
    return keys


def sketches(row: np.ndarray, h: np.ndarray, n_rows: int) -> np.ndarray:
    """One bit for each cell of the hash range: whether the cell holds an odd number of the set's elements.

    The sketches of two sets differ in the cells that hold an odd number of elements of their symmetric
    difference, so in no more bits than that difference has elements.
    """
    cells = 64 * SKETCH
    cell = (textnum.mix(h ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(cells)).astype(np.int64)
    odd = np.bincount(row * cells + cell, minlength=n_rows * cells).reshape(n_rows, cells) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column("key")
        for at, to, data, bounds in textnum.row_slices(*textnum.texts(batch.column("text")), most=1 << 20):
            n = to - at
            row, h = shingle_sets(data, bounds)
            sums = np.zeros((2, n), np.uint64)
            for k, values in enumerate((textnum.mix(h), textnum.mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)))):
                np.add.at(sums[k], row, values)
            bands = band_keys(signatures(row, h, n)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    keys.slice(at, n),
                    pa.array(np.bincount(row, minlength=n).astype(np.int64)),
                    pa.array(sums[0].view(np.int64)),
                    pa.array(sums[1].view(np.int64)),
                    pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), BANDS).cast(pa.list_(pa.int64())),
                    pa.FixedSizeListArray.from_arrays(pa.array(sketches(row, h, n).ravel()), SKETCH).cast(pa.list_(pa.int64())),
                ],
                ["key", "n_shingles", "d1", "d2", "bands", "sketch"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes = batch.column("node")
        for at, to, data, bounds in textnum.row_slices(*textnum.texts(batch.column("text"))):
            row, h = shingle_sets(data, bounds)
            offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=to - at)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))
            whole = np.zeros(to - at, np.uint64)
            np.add.at(whole, row, textnum.mix(h))
            yield pa.RecordBatch.from_arrays([nodes.slice(at, to - at), pa.array(whole.view(np.int64)), lists], ["node", "set", "elements"])


def _near(percent: int) -> Column:
    """Whether ``n, sketch`` and ``pivot_n, pivot_sketch`` allow a link: a bound that no linked pair fails.

    100 * intersection >= percent * union is (100 + percent) * difference <= (100 - percent) * (sum of sizes).
    """
    bits = " + ".join(f"bit_count(sketch[{k}] ^ pivot_sketch[{k}])" for k in range(SKETCH))
    return F.expr(f"{100 + percent} * greatest({bits}, abs(n - pivot_n)) <= {100 - percent} * (n + pivot_n)")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``node, pivot`` (the pivot has the larger share of rows) with 100 * intersection >= percent * union."""
    sets = sets.drop("set")
    left = pairs.join(sets, "node").withColumnRenamed("elements", "own")
    wanted = sets.withColumnRenamed("node", "pivot").join(pairs.select("pivot").distinct(), "pivot", "left_semi")
    both = left.join(wanted, "pivot")
    common = F.size(F.array_intersect("own", "elements"))
    union = F.size("own") + F.size("elements") - common
    return both.where(100 * common >= percent * union).drop("own", "elements")


def _prefixes(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node, e``: the rarest elements of each set, in one order for all, as many as a linked pair cannot both avoid.

    Linked sets share at least ``percent`` per cent of either one, so they share one of the first
    ``n - ceil(percent * n / 100) + 1`` elements. Elements that only one group (``root``) has are left out of a
    prefix, and sets whose prefix is then empty are left out of the table: they have no link to another group.
    """
    # The rows of one set, not of one node: an id may have several texts.
    held = sets.join(placed, "node").select("node", "root", "set", F.explode("elements").alias("e"))
    counts = held.groupBy("e").agg(F.count(F.lit(1)).alias("c"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    counts = counts.select("e", "c", (F.col("lo") != F.col("hi")).alias("across"))
    listed = held.join(counts, "e").groupBy("node", "set").agg(F.array_sort(F.collect_list(F.struct("c", "e", "across"))).alias("r"))
    length = (F.size("r") - F.ceil(F.size("r") * percent / 100) + 1).cast("int")
    first = F.filter(F.slice("r", F.lit(1), length), lambda x: x["across"])
    return listed.select("node", F.explode(first).alias("x")).select("node", F.col("x.e").alias("e")).distinct()


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the ``root`` of their ``node``: itself, if it has no link yet."""
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _mixed(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` still holds more than one root."""
    mixed = rows.groupBy(key).agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select(key)
    return rows.join(mixed, key, "left_semi")


def _contracted(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after links ``a, b`` between roots."""
    merged = scratch.materialise(graph.components(links), "components")
    moved = roots.join(merged.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return scratch.materialise(moved.unionByName(merged.join(roots, "node", "left_anti")), "roots")


def _links(members: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Component roots of the nodes of ``members`` (``band, node``) that are linked: ``node, root``.

    ``nodes`` holds ``node, n, sketch, weight``; a bucket's pivot has the largest weight.
    """
    near, pivot_of = _near(percent), F.max_by("node", "weight").alias("pivot")
    as_pivot = nodes.select(F.col("node").alias("pivot"), F.col("n").alias("pivot_n"), F.col("sketch").alias("pivot_sketch"))
    pivots = scratch.materialise(members.join(nodes.select("node", "weight"), "node").groupBy("band").agg(pivot_of), "pivots")
    pairs = members.join(pivots, "band").where("node != pivot").select("node", "pivot").distinct()
    pairs = pairs.join(nodes, "node").join(as_pivot, "pivot").where(near).select("node", "pivot")
    links = scratch.materialise(_verified(scratch.materialise(pairs, "pairs"), sets, percent), "verified")
    roots = scratch.materialise(graph.components(links.toDF("a", "b")), "roots")
    placed = _mixed(_rooted(members, roots), "band").select("node", "root").distinct()
    open_, turn = _prefixes(scratch.materialise(placed, "open"), sets, percent), 0
    while True:
        open_ = scratch.materialise(_mixed(_rooted(open_, roots), "e"), "open")
        if open_.isEmpty():
            return roots
        held = open_.join(nodes, "node")
        part = F.pmod(F.xxhash64("node"), F.lit(16**turn))
        pivots = scratch.materialise(held.groupBy("e", part.alias("part")).agg(pivot_of).select("e", "pivot"), "pivots")
        right = pivots.join(open_.select(F.col("node").alias("pivot"), F.col("root").alias("pivot_root")).distinct(), "pivot").join(as_pivot, "pivot")
        pairs = held.join(right, "e").where(near & (F.col("root") != F.col("pivot_root")))
        pairs = scratch.materialise(pairs.select("node", "pivot", "root", "pivot_root").distinct(), "pairs")
        links = _verified(pairs, sets, percent).select(F.least("root", "pivot_root").alias("a"), F.greatest("root", "pivot_root").alias("b"))
        links = scratch.materialise(links.distinct(), "verified")
        if not links.isEmpty():
            roots = _contracted(roots, links)
        open_ = open_.drop("root").join(pivots.withColumnRenamed("pivot", "node"), ["e", "node"], "left_anti")
        turn += 1


def _placed(docs: DataFrame, percent: int) -> DataFrame:
    """``key, n_shingles, component`` of every row of ``docs`` (``key, text``)."""
    schema = "key long, n_shingles long, d1 long, d2 long, bands array<long>, sketch array<long>"
    prints = scratch.materialise(docs.select("key", "text").mapInArrow(_fingerprint, schema), "prints")
    small = prints.select("key", "n_shingles", "d1", "d2")
    classes = small.where("n_shingles > 0").groupBy("n_shingles", "d1", "d2").agg(F.min("key").alias("node"))
    classes = scratch.materialise(classes, "classes")
    reps = prints.where("n_shingles > 0").join(classes.select(F.col("node").alias("key")), "key", "left_semi")
    banded = reps.select(F.col("key").alias("node"), F.explode("bands").alias("band")).distinct()
    banded = scratch.materialise(banded, "bands")
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    members = scratch.materialise(banded.join(shared, "band"), "members")
    spread = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / (1 << 30)
    weights = members.groupBy("node").agg(F.sum("c").alias("w")).select("node", (F.col("w") + spread).alias("weight"))
    nodes = reps.select(F.col("key").alias("node"), F.col("n_shingles").alias("n"), "sketch").join(weights, "node")
    nodes = scratch.materialise(nodes.distinct(), "nodes")
    texts = docs.join(weights.select(F.col("node").alias("key")), "key", "left_semi").select(F.col("key").alias("node"), "text")
    sets = scratch.materialise(texts.mapInArrow(_sets, "node long, set long, elements array<long>"), "sets")
    roots = _links(members.select("band", "node"), nodes, sets, percent)
    repeated = small.where("n_shingles > 0").join(classes, ["n_shingles", "d1", "d2"]).where("key != node")
    # An id with several texts ties their classes together.
    ties = repeated.select("key", "node").join(classes.select(F.col("node").alias("key")), "key", "left_semi")
    ties = scratch.materialise(ties.select(F.col("key").alias("a"), F.col("node").alias("b")).distinct(), "ties")
    if not ties.isEmpty():
        stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(ties)
        roots = scratch.materialise(graph.components(stars), "components")
    labelled = classes.join(roots, "node", "left").select("n_shingles", "d1", "d2", F.coalesce("root", "node").alias("component"))
    full = small.where("n_shingles > 0").join(labelled, ["n_shingles", "d1", "d2"]).select("key", "n_shingles", "component")
    empty = small.where("n_shingles = 0").select("key", "n_shingles", F.col("key").alias("component"))
    return full.unionByName(empty)


def groups(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id, text``).

    Words are runs of non-white-space, A-Z as a-z; a set holds the distinct runs of five words (all words, if
    fewer). Texts are linked if ``percent`` per cent of the union of their sets is common. ``component_id`` is
    the smallest doc_id reachable over links, ``kept`` marks the rows that bear it. A null or empty text has no
    shingles and is linked with nothing. Rows that repeat an id are one node with the links of all of them.
    Rows with a null id take part; they are kept only if their component has no id (``component_id`` null),
    one for each text. Other columns are ignored; an empty table gives an empty table.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(unit_key().alias("key"), "text")
    return _placed(keyed, percent).select(
        real_id("key").alias("doc_id"),
        "n_shingles",
        real_id("component").alias("component_id"),
        (F.col("key") == F.col("component")).alias("kept"),
    )


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each group, with all its columns: the smallest id's; of rows that repeat an id, one."""
    key = fresh(docs, "key")
    keyed = docs.withColumn(key, unit_key())
    placed = _placed(keyed.select(F.col(key).alias("key"), "text"), percent)
    kept = placed.where("key = component").select(F.col("key").alias(key)).distinct()
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).select(docs.columns)
