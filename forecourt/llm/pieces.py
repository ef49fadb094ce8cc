"""SentencePiece encoding and decoding for merge-type vocabularies.

A normalised text is a chain of characters. An agenda holds the adjacent symbols whose join is a piece, the best
score first and of equal scores the leftmost; the first one is joined and the pairs with its new neighbours enter,
until none is left. Symbols that are no piece fall back to bytes.

No join crosses a place between two characters that stand beside each other in no piece: texts are cut there, and
parts that repeat are merged once per task. The library gives the vocabulary, normalises, and checks: every text is encoded and decoded by it as well, in
Arrow batches.
"""

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm import textnum
from forecourt.llm.common import fresh

#: The character that stands for a space in pieces, and what an unknown id is shown as.
MARK, UNKNOWN = "▁", " ⁇ "
#: Parts of texts that a task remembers.
REMEMBERED = 1 << 18
#: Bytes of text that are encoded together.
SLICE = 1 << 19
#: Rows that are decoded together.
ROWS = 1000
#: Longest part whose agenda is a row beside others, and so many rows at once; longer parts have a heap.
SHORT, TOGETHER, NEVER = 48, 20_000, 1 << 62


class Vocabulary:
    """Pieces, scores and ids of a merge-type model with byte fallback."""

    def __init__(self, model: bytes):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(lib.get_piece_size())
        self.pieces = [lib.id_to_piece(i) for i in ids]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in ids]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i] and not lib.is_unused(i)}
        self.cost = {p: -lib.get_score(i) for p, i in self.ids.items()}
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if lib.is_byte(i)}
        if len(self.byte) != 256:
            raise ValueError("the model has no byte fallback")
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        self.control = frozenset(i for i in ids if lib.is_control(i))
        beside = sorted({p[k : k + 2] for p in self.ids for k in range(len(p) - 1)})
        inside = sorted(set("".join(beside)))
        # The number of each character that is in a longer piece (0: in none), and whether two stand beside each other.
        self.number = np.zeros(0x110000, np.int32)
        self.number[[ord(c) for c in inside]] = np.arange(1, len(inside) + 1)
        self.beside = np.zeros((len(inside) + 1, len(inside) + 1), bool)
        self.beside[self.number[[ord(b[0]) for b in beside]], self.number[[ord(b[1]) for b in beside]]] = True
        self.bytes = {i: bytes([b]) for b, i in self.byte.items()}
        self.shown = [self._shown(i) for i in ids]
        self.known: dict[str, bytes] = {}
        self.size = len(self.pieces)
        costs = Counter(self.cost[p] for p in self.ids if len(p) > 1)
        #: Longer pieces of equal score: between them the place decides. Those that hold another one are left out.
        tied = [p for p in self.ids if len(p) > 1 and costs[self.cost[p]] > 1]
        self.tied = [p for p in tied if not any(t != p and t in p for t in tied)]
        rank = {c: k for k, c in enumerate(sorted(costs))}
        joins = {
            self.ids[p[:k]] << 21 | self.ids[p[k:]]: rank[self.cost[p]] << 21 | i
            for p, i in self.ids.items()
            for k in range(1, len(p))
            if p[:k] in self.ids and p[k:] in self.ids
        }
        #: Two pieces that make a longer one, in order, and rank and id of that.
        self.pairs = np.array(sorted(joins), np.int64)
        self.joined = np.array([joins[k] for k in self.pairs.tolist()], np.int64)
        self.symbol = np.arange(0x110000, dtype=np.int32) + self.size
        for p, i in self.ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i

    def _shown(self, i: int) -> bytes:
        if i in self.control:
            return b""
        if i in self.bytes:
            return self.bytes[i]
        return UNKNOWN.encode() if self.library.is_unknown(i) else self.pieces[i].replace(MARK, " ").encode()

    def _joins(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and id of the joins of symbols, ``NEVER`` where they make no piece."""
        key = left.astype(np.int64) << 21 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.joined[at], NEVER)

    def _merged_together(self, parts: list[str]) -> list[bytes]:
        """Ids of short parts. Each part is a row with an agenda of its own; all rows take their best join at once."""
        length = np.array([len(p) for p in parts])
        rows, width = np.arange(len(parts)), int(length.max())
        there = np.arange(width) < length[:, None]
        symbol = np.full((len(parts), width), -1, np.int64)
        symbol[there] = self.symbol[np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)]
        agenda = np.full((len(parts), width), NEVER)
        agenda[:, :-1] = np.where(there[:, 1:], self._joins(symbol[:, :-1], symbol[:, 1:]), NEVER)
        after = np.tile(np.arange(1, width + 1), (len(parts), 1))
        before = after - 2
        while True:
            k = agenda[rows].argmin(1)
            best = agenda[rows, k]
            on = best < NEVER
            rows, k, best = rows[on], k[on], best[on]
            if not len(rows):
                break
            new, right = best & 0x1FFFFF, after[rows, k]
            follower = after[rows, right]
            symbol[rows, k], symbol[rows, right] = new, -1
            agenda[rows, k], agenda[rows, right] = NEVER, NEVER
            after[rows, k] = follower
            more = follower < length[rows]
            r, at, f = rows[more], k[more], follower[more]
            before[r, f] = at
            agenda[r, at] = self._joins(new[more], symbol[r, f])
            less = before[rows, k]
            has = less >= 0
            r, at = rows[has], less[has]
            agenda[r, at] = self._joins(symbol[r, at], new[has])
        left = symbol >= 0
        flat = symbol[left].astype("<u4").tobytes()
        ends = np.cumsum(left.sum(1) * 4).tolist()
        odd = (symbol >= self.size).any(1).tolist()
        return [self._in_bytes(symbol[k][left[k]].tolist()) if odd[k] else flat[a:b] for k, (a, b) in enumerate(zip([0, *ends], ends))]

    def _in_bytes(self, symbols: list[int]) -> bytes:
        """Ids of symbols, where ``size`` and more is a character that is no piece."""
        out = [i for k in symbols for i in ([k] if k < self.size else [self.byte[b] for b in chr(k - self.size).encode()])]
        return np.array(out, "<u4").tobytes()

    def merged(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of texts, as little-endian unsigned 32-bit numbers, after all joins of their agendas."""
        out: list[bytes] = [b""] * len(parts)
        short = [k for k, p in enumerate(parts) if len(p) <= SHORT and not any(t in p for t in self.tied)]
        short.sort(key=lambda k: len(parts[k]))
        for at in range(0, len(short), TOGETHER):
            some = short[at : at + TOGETHER]
            for k, ids in zip(some, self._merged_together([parts[k] for k in some])):
                out[k] = ids
        for k, p in enumerate(parts):
            if not out[k]:
                out[k] = self._in_bytes([self.ids[x] if x in self.ids else self.size + ord(x) for x in self._merged_long(p)])
        return out

    def _merged_long(self, text: str) -> list[str]:
        """With a heap as agenda, so that the work is n log n."""
        cost, part, n = self.cost, list(text), len(text)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[float, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            joined = part[left] + part[right]
            if (c := cost.get(joined)) is not None:
                heapq.heappush(agenda, (c, left, right, len(joined)))

        for k in range(n - 1):
            offer(k, k + 1)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            # A symbol that was joined since has another length, or none.
            if not part[left] or not part[right] or len(part[left]) + len(part[right]) != size:
                continue
            part[left] += part[right]
            part[right] = ""
            nxt = after[left] = after[right]
            if nxt < n:
                before[nxt] = left
                offer(left, nxt)
            if before[left] >= 0:
                offer(before[left], left)
        return [p for p in part if p]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of normalised texts as little-endian unsigned 32-bit numbers, with begin and end.

        The parts of all texts are found together, and each different one is merged once.
        """
        whole = "".join(texts)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        numbers = self.number[codes]
        first = np.ones(len(codes), bool)
        first[1:] = ~self.beside[numbers[:-1], numbers[1:]]
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        first[bounds[:-1][bounds[:-1] < len(codes)]] = True
        start = np.flatnonzero(first)
        width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        place = np.concatenate(([0], np.cumsum(width)))
        end = np.append(start[1:], len(codes))[: len(start)]
        data = np.frombuffer(whole.encode(), np.uint8)
        _, one, inverse = np.unique(textnum.word_hashes(data, place[start], place[end], lower=False), return_index=True, return_inverse=True)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        parts = [whole[a:b] for a, b in zip(start[one].tolist(), end[one].tolist())]
        new = [p for p in parts if p not in self.known]
        self.known.update(zip(new, self.merged(new)))
        found = [self.known[p] for p in parts]
        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.array([len(x) for x in found], np.int64) // 4
        offsets = np.cumsum(sizes) - sizes
        n = sizes[inverse]
        upto = np.concatenate(([0], np.cumsum(n)))
        ids = flat[np.repeat(offsets[inverse] - upto[:-1], n) + np.arange(upto[-1])]
        cuts = upto[np.searchsorted(start, bounds)].tolist()
        begin, finish = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        return [begin + ids[a:b].tobytes() + finish for a, b in zip(cuts, cuts[1:])]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: marks as spaces, the one of the dummy prefix dropped, control ids silent, wrong bytes as U+FFFD."""
        first = next((i for i in ids if i not in self.control), None)
        drop = first is not None and first not in self.bytes and self.pieces[first].startswith(MARK)
        silent = sum(map(ids.count, self.control)) - sum(i in self.control for i in {0: ids[0], len(ids) - 1: ids[-1]}.values()) if ids else 0
        if not silent:  # a control id ends a run of bytes
            try:
                return b"".join([self.shown[i] for i in ids])[drop:].decode()
            except UnicodeDecodeError:
                pass
        return self._decode_runs(ids)[drop:]

    def _decode_runs(self, ids: list[int]) -> str:
        out, run = [], b""
        for i in [*ids, None]:
            if i in self.bytes:
                run += self.bytes[i]
                continue
            out.append(_repaired(run))
            run = b""
            if i is not None:
                out.append(self.shown[i].decode())
        return "".join(out)


def _repaired(run: bytes) -> str:
    """Bytes as UTF-8, each byte that begins no character as U+FFFD."""
    out, at = [], 0
    while at < len(run):
        for size in range(1, 5):
            try:
                out.append(run[at : at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            size = 1
            out.append("�")
        at += size
    return "".join(out)


_SHARED: dict[bytes, Vocabulary] = {}


def _vocabulary(model: bytes) -> Vocabulary:
    """One vocabulary per worker process."""
    if model not in _SHARED:
        _SHARED[model] = Vocabulary(model)
    return _SHARED[model]


def _model(spark, path: str):
    """The model file, which is read by the driver; its size bounds what is sent to tasks."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _with(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *new.values()], [*batch.schema.names, *new])


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about as many bytes of text each."""
    _, bounds = textnum.texts(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SLICE, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _encoded(words: Vocabulary, texts: list[str], check: bool) -> tuple[dict[str, pa.Array], list[bytes]]:
    ids = words.encode(words.library.normalize(texts))
    added = {"n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
    if check:
        told = words.library.encode(texts, add_bos=True, add_eos=True, num_threads=1)
        added["agrees"] = pa.array([np.array(a, "<u4").tobytes() == b for a, b in zip(told, ids)], pa.bool_())
    return added, ids


def _decoded(words: Vocabulary, ids: list[bytes | None], check: bool) -> dict[str, pa.Array]:
    numbers = [np.frombuffer(i or b"", "<u4").tolist() for i in ids]
    texts = [words.decode(n) for n in numbers]
    added = {"decoded": pa.array(texts, pa.string())}
    if check:
        told = words.library.decode(numbers, num_threads=1) if numbers else []
        added["decodes"] = pa.array([a == b for a, b in zip(told, texts)], pa.bool_())
    return added


_FIELDS = {"n_tokens": T.LongType(), "ids": T.BinaryType(), "agrees": T.BooleanType(), "decoded": T.StringType(), "decodes": T.BooleanType()}


def _schema(kept: DataFrame, new: list[str]) -> T.StructType:
    return T.StructType([*kept.schema.fields, *[T.StructField(c, _FIELDS[c]) for c in new]])


def encode(docs: DataFrame, path: str, text: str = "text", check: bool = True, back: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids`` (binary, little-endian unsigned 32-bit numbers, begin and end ids included) and ``n_tokens``.

    ``path`` names a merge-type model with byte fallback. With ``check`` a column ``agrees`` says whether the library
    gives the same ids. With ``back`` the ids are decoded in the same pass, as by ``decode``. ``keep`` names the columns of
    ``docs`` that stay (all of them). A null text is empty: begin and end. Columns of ``docs`` with the new names are
    replaced; all others stay as they are. Repeated rows are encoded alike; an empty table stays empty.
    """
    model = _model(docs.sparkSession, path)
    new = ["n_tokens", "ids", *["agrees"][: int(check)]] + (["decoded", *["decodes"][: int(check)]] if back else [])
    own = fresh(docs, "_text")
    rows = docs.select(*[c for c in keep or docs.columns if c not in new], F.col(text).cast("string").alias(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _vocabulary(model.value)
        for batch in batches:
            for part in _slices(batch, own):
                added, ids = _encoded(words, [t or "" for t in part.column(own).to_pylist()], check)
                yield _with(part.drop_columns([own]), added | (_decoded(words, ids, check) if back else {}))

    return rows.mapInArrow(run, _schema(rows.drop(own), new))


def decode(rows: DataFrame, path: str, check: bool = True) -> DataFrame:
    """``rows`` with ``decoded``, the text of ``ids`` (as ``encode`` gives them; null: none).

    With ``check`` a column ``decodes`` says whether the library gives the same text. Ids outside of the vocabulary raise
    an error. Columns of ``rows`` with these names are replaced; an empty table stays empty.
    """
    model = _model(rows.sparkSession, path)
    new = ["decoded", *["decodes"][: int(check)]]
    rows = rows.select([c for c in rows.columns if c not in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _vocabulary(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield _with(part, _decoded(words, part.column("ids").to_pylist(), check))

    return rows.mapInArrow(run, _schema(rows, new))
