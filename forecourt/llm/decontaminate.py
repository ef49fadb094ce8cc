"""Benchmark decontamination by latent semantic retrieval.

1. Passages of 96 words are rows of a TF-IDF matrix over the benchmark's words; passage frequencies come from
   all documents. A randomised SVD finds the leading right singular vectors: Spark sums ``A^T (A M)`` for a narrow
   matrix M over all passages, and the driver orthonormalises a matrix of (words of the benchmark) x ``RANK``.
   The directions of the benchmark items join the basis, so truncation cannot lose a rare item.
2. In this latent space windows of 96 words, 32 apart, are compared with all items by cosine.
3. Candidates are confirmed by the longest common subsequence of words: a copy has nearly all words of the item in
   order within a stretch little longer than it; a paraphrase has most of them, and the item's answer too.

The benchmark is a stated set of queries, taken in blocks of ``ITEMS`` items, which bounds the vocabulary, the
basis and everything the driver holds. Words are runs of letters and digits; capital
letters of Latin-1 count as small ones.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import textnum

ITEMS = 500
RANK = 32
BLOCK = 32
WINDOW = 3  # blocks
PASSAGE = BLOCK * WINDOW
COSINE = 0.45
#: A window with less than this share of the weight of every item cannot confirm one and is not projected.
LEAST_WEIGHT = 0.25
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
STRETCH = 1.3
CHUNK = 256  # words of the vocabulary in one row of a partial sum


@dataclass
class Item:
    item_id: int
    words: np.ndarray  # places in the vocabulary
    answer: np.ndarray


@dataclass
class Index:
    vocabulary: np.ndarray  # sorted word hashes
    idf: np.ndarray
    basis: np.ndarray  # words x latent dimensions
    latent: np.ndarray  # items x latent dimensions, unit length
    items: list[Item]
    least: float


def _hashes(text: str) -> np.ndarray:
    data, bounds = textnum.texts(pa.array([text]))
    data = textnum.lower_latin(data)
    _, start, end = textnum.words(data, bounds, textnum.NONWORD)
    return textnum.word_hashes(data, start, end)


def _answer(text: str) -> str:
    """The last sentence or line of an item: what a solution would give."""
    parts = [p for p in text.replace("\n", ".").replace("?", ".").split(".") if p.strip()]
    return parts[-1] if parts else ""


def places(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted vocabulary, or -1."""
    # Most words are not in the vocabulary: a table over 20 bits sorts them out before the search.
    table = np.zeros(1 << 20, bool)
    table[vocabulary >> np.uint64(44)] = True
    out = np.full(len(hashes), -1, np.int32)
    maybe = np.flatnonzero(table[hashes >> np.uint64(44)])
    at = np.minimum(np.searchsorted(vocabulary, hashes[maybe]), len(vocabulary) - 1)
    hit = vocabulary[at] == hashes[maybe]
    out[maybe[hit]] = at[hit]
    return out


def _slices(column, vocabulary):
    """Slices of a text column: first row, end row, row of each word, its place in the row, its place in the vocabulary."""
    for at, to, data, bounds in textnum.row_slices(*textnum.texts(column)):
        data = textnum.lower_latin(data)
        row, start, end = textnum.words(data, bounds, textnum.NONWORD)
        begin = np.searchsorted(row, np.arange(to - at))
        yield at, to, row, np.arange(len(row)) - begin[row] if len(row) else row, places(vocabulary, textnum.word_hashes(data, start, end))


def run_sums(matrix: np.ndarray, which: np.ndarray, first: np.ndarray, factor: np.ndarray | None = None) -> np.ndarray:
    """Sum of the lines ``which`` of a matrix, times ``factor``, over every run that begins at ``first``.

    The k-th lines of many runs are added at once, the longest runs first, in parts that fit a processor's cache.
    """
    count = np.diff(np.append(first, len(which)))
    out = np.zeros((len(first), matrix.shape[1]), matrix.dtype)
    order = np.argsort(-count, kind="stable")
    for part in np.array_split(order, 1 + len(order) // 256):
        left, total = count[part], np.zeros((len(part), matrix.shape[1]), matrix.dtype)
        for k in range(left[0] if len(left) else 0):
            at = first[part[: np.searchsorted(-left, -k)]] + k
            lines = matrix[which[at]]
            total[: len(at)] += lines if factor is None else lines * factor[at, None]
        out[part] = total
    return out


def _products(docs: DataFrame, vocabulary: np.ndarray, weight: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """``A^T (A matrix)`` of the weighted term counts of all passages, passage frequencies and the number of passages."""
    given = docs.sparkSession.sparkContext.broadcast((vocabulary, weight, matrix))
    width = matrix.shape[1] + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, w, m = given.value
        total, passages = np.zeros((len(vocab), width)), 0
        for batch in batches:
            for _, _, row, place, word in _slices(batch.column("text"), vocab):
                if not len(row):
                    continue
                cut = (place % PASSAGE == 0).cumsum() - 1
                passages += int(cut[-1]) + 1
                hit = word >= 0
                pair, tf = np.unique(cut[hit].astype(np.int64) * len(vocab) + word[hit], return_counts=True)
                if not len(pair):
                    continue
                at, term = pair // len(vocab), pair % len(vocab)
                value = (tf * w[term]).astype(np.float32)
                first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
                y = run_sums(m, term, first, value)
                back = np.repeat(y, np.diff(np.concatenate((first, [len(at)]))), axis=0) * value[:, None]
                order = np.argsort(term, kind="stable")
                heads = np.flatnonzero(np.concatenate(([True], term[order][1:] != term[order][:-1])))
                which = term[order][heads]
                total[which, 1:] += np.add.reduceat(back[order], heads, axis=0)
                total[which, 0] += np.diff(np.concatenate((heads, [len(order)])))
        chunks = [(k, total[a : a + CHUNK].ravel()) for k, a in enumerate(range(0, len(vocab), CHUNK)) if passages]
        chunks.append((-1, np.array([float(passages)])))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in chunks], pa.int32()), pa.array([v for _, v in chunks], pa.list_(pa.float64()))], ["chunk", "sums"])

    def add(table: pa.Table) -> pa.Table:
        columns = table.column("sums").combine_chunks()
        lines = np.asarray(columns.flatten()).reshape(len(columns), -1)
        keep = table.drop_columns(["sums"]).slice(0, 1)
        return keep.append_column("sums", pa.array([lines.sum(axis=0)], pa.list_(pa.float64())))

    parts = docs.select("text").mapInArrow(partial, "chunk int, sums array<double>")
    # Two levels, so that no task gathers the parts of all others.
    parts = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(256)))
    parts = parts.groupBy("chunk", "salt").applyInArrow(add, "chunk int, salt int, sums array<double>").drop("salt")
    summed = {r["chunk"]: np.array(r["sums"]) for r in parts.groupBy("chunk").applyInArrow(add, "chunk int, sums array<double>").collect()}
    passages = int(summed.pop(-1, [0])[0])
    full = np.vstack([summed[k].reshape(-1, width) for k in sorted(summed)]) if summed else np.zeros((len(vocabulary), width))
    return full[:, 1:], full[:, 0], passages


def build(docs: DataFrame, items: list[tuple[int, str, str | None]], seed: int = 5) -> Index | None:
    """The latent index of a block of items, from the passages of all documents; None without words in the items."""
    hashed = [(i, _hashes(text), _hashes(answer if answer is not None else _answer(text))) for i, text, answer in items]
    hashed = [(i, words, answer) for i, words, answer in hashed if len(words)]
    if not hashed:
        return None
    vocabulary = np.unique(np.concatenate([words for _, words, _ in hashed]))
    found = [Item(i, places(vocabulary, words), places(vocabulary, answer)) for i, words, answer in hashed]
    rank = min(RANK, len(vocabulary))
    start = np.random.default_rng(seed).standard_normal((len(vocabulary), rank)).astype(np.float32)
    sketch, frequency, passages = _products(docs, vocabulary, np.ones(len(vocabulary)), start)
    idf = np.log((passages + 2) / (frequency + 1))
    # The random matrix absorbs one idf, so the first pass needs none: (A D)^T (A D) D^-1 X = D A^T A X.
    near, _ = np.linalg.qr(idf[:, None] * sketch)
    image, _, _ = _products(docs, vocabulary, idf, near.astype(np.float32))
    _, turn = np.linalg.eigh((near.T @ image + image.T @ near) / 2)
    leading = np.linalg.qr(image @ turn)[0]
    own = np.zeros((len(found), len(vocabulary)))
    for k, item in enumerate(found):
        np.add.at(own[k], item.words, idf[item.words])
    basis, scale, _ = np.linalg.svd(np.hstack([own.T / np.maximum(np.linalg.norm(own, axis=1), 1e-9), leading]), full_matrices=False)
    basis = basis[:, scale > 1e-6 * scale[0]]
    latent = own @ basis
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    weights = [float((idf[i.words] ** 2).sum()) * min(1, PASSAGE / len(i.words)) for i in found]
    return Index(vocabulary, idf, basis.astype(np.float32), latent.astype(np.float32), found, LEAST_WEIGHT * min(weights))


def letters(pattern: np.ndarray) -> dict[int, int]:
    """The places of each word of a pattern, as bits of an integer."""
    masks: dict[int, int] = {}
    for k, w in enumerate(pattern.tolist()):
        masks[w] = masks.get(w, 0) | 1 << k
    return masks


def common(pattern: np.ndarray, words: np.ndarray, masks: dict[int, int] | None = None) -> int:
    """Length of the longest common subsequence, one machine step per word (bits of an integer)."""
    masks = letters(pattern) if masks is None else masks
    full = (1 << len(pattern)) - 1
    state = full
    for w in words.tolist():
        if mask := masks.get(w):
            u = state & mask
            state = ((state + u) | (state - u)) & full
    return len(pattern) - state.bit_count()


def confirm(item: Item, words: np.ndarray) -> tuple[float, float]:
    """Share of the item's words, and of its answer's, in order in the best stretch of ``words``; (0, 0) if it is no leak."""
    n, masks = len(item.words), letters(item.words)
    if common(item.words, words, masks) < PARAPHRASE * n:
        return 0.0, 0.0
    span = int(np.ceil(STRETCH * n))
    starts = range(0, max(1, len(words) - n + 1), max(1, n // 8))
    share, at = max((common(item.words, words[s : s + span], masks) / n, -s) for s in starts)
    part = words[-at : -at + span]
    answer = common(item.answer, part) / len(item.answer) if len(item.answer) else 1.0
    return (share, answer) if share >= COPY or share >= PARAPHRASE and answer >= ANSWER else (0.0, 0.0)


def search(index: Index, column) -> Iterator[tuple[int, int, float, float]]:
    """Row, item id, word share and answer share of the leaks in a text column."""
    scaled = index.basis * index.idf[:, None].astype(np.float32)
    for at, to, row, place, word in _slices(column, index.vocabulary):
        if not len(row):
            continue
        counts = np.bincount(row, minlength=to - at)
        blocks = -(-counts // BLOCK)
        ends = np.cumsum(blocks)
        block = (ends - blocks)[row] + place // BLOCK
        owner = np.repeat(np.arange(to - at), blocks)
        hits = np.flatnonzero(word >= 0)
        weight = np.bincount(block[hits], weights=index.idf[word[hits]] ** 2, minlength=ends[-1])
        sums = np.concatenate(([0.0], np.cumsum(weight)))
        last = np.minimum(np.arange(ends[-1]) + WINDOW, ends[owner])
        # The last windows of a text are parts of the one before them, unless that begins the text.
        whole = (last - np.arange(ends[-1]) == WINDOW) | (np.arange(ends[-1]) == (ends - blocks)[owner])
        heavy = np.flatnonzero(whole & (sums[last] - sums[:-1] >= index.least - 1e-9))
        if not len(heavy):
            continue
        # Only blocks of a heavy window are projected.
        wanted = np.zeros(ends[-1], bool)
        for k in range(WINDOW):
            wanted[np.minimum(heavy + k, last[heavy] - 1)] = True
        hits = hits[wanted[block[hits]]]
        latent = np.zeros((ends[-1], index.basis.shape[1]), np.float32)
        first = np.flatnonzero(np.concatenate(([True], block[hits][1:] != block[hits][:-1])))
        latent[block[hits][first]] = run_sums(scaled, word[hits], first)
        seen: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for some in np.array_split(heavy, 1 + len(heavy) // 4096):
            y = latent[some].copy()
            for k in range(1, WINDOW):
                more = some + k < last[some]
                y[more] += latent[some[more] + k]
            cosine = y @ index.latent.T
            cosine /= np.maximum(np.sqrt(np.einsum("ij,ij->i", y, y)), 1e-9)[:, None]
            for w, k in zip(*np.nonzero(cosine >= COSINE)):
                seen.setdefault((int(owner[some[w]]), int(k)), []).append((int(some[w]), int(last[some[w]])))
        begin = np.searchsorted(row, np.arange(to - at))
        for (r, k), windows in seen.items():
            item, base = index.items[k], int(ends[r] - blocks[r])
            best, reached = (0.0, 0.0), -1
            for a, b in windows:
                lo = max(0, (a - base) * BLOCK - len(item.words))
                hi = min(int(counts[r]), (b - base) * BLOCK + len(item.words))
                if hi > reached:
                    best = max(best, confirm(item, word[begin[r] + lo : begin[r] + hi]))
                    reached = hi if best[0] else reached
            if best[0]:
                yield at + r, item.item_id, *best


def _blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of the benchmark, ``ITEMS`` items at a time."""
    text = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL")
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = text.select(F.col("item_id").cast("long").alias("item_id"), "text", answer.alias("answer")).orderBy("item_id", "text")
    block = []
    for r in rows.toLocalIterator():
        block.append((r["item_id"], r["text"], r["answer"]))
        if len(block) == ITEMS:
            if index := build(docs, block):
                yield index
            block = []
    if block and (index := build(docs, block)):
        yield index


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, leaked, item_ids, best_share`` for every row of ``docs`` (``doc_id, text``).

    ``benchmark`` holds ``item_id, text`` and may hold ``answer`` (else an item's last sentence is its answer).
    ``item_ids`` lists the items found in the row, sorted; ``best_share`` is the largest share of an item's words
    found in order, 0 without a leak. Items without words or id find nothing; a null or empty text leaks nothing.
    Null and repeated ids are searched row by row, whole texts always; other columns are ignored.
    """
    given = docs.sparkSession.sparkContext.broadcast(list(_blocks(docs, benchmark)))

    def find(batches):
        for batch in batches:
            found: list[dict[int, float]] = [{} for _ in range(batch.num_rows)]
            for index in given.value:
                for r, item_id, share, _ in search(index, batch.column("text")):
                    found[r][item_id] = max(share, found[r].get(item_id, 0.0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([bool(f) for f in found], pa.bool_()),
                    pa.array([sorted(f) for f in found], pa.list_(pa.int64())),
                    pa.array([max(f.values(), default=0.0) for f in found], pa.float64()),
                ],
                ["doc_id", "leaked", "item_ids", "best_share"],
            )

    schema = "doc_id long, leaked boolean, item_ids array<long>, best_share double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, schema)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a leak, with all their columns; no row is moved."""
    given = docs.sparkSession.sparkContext.broadcast(list(_blocks(docs, benchmark)))

    def keep(batches):
        for batch in batches:
            mask = np.ones(batch.num_rows, bool)
            for index in given.value:
                for r, *_ in search(index, batch.column("text")):
                    mask[r] = False
            yield batch.filter(pa.array(mask))

    return docs.mapInArrow(keep, docs.schema)
