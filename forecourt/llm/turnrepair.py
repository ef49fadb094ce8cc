"""Repair of conversation structure by a generalised LR parse of the roles.

The grammar of the roles is

    C -> (empty) | T | s T        T -> P | T P        P -> u a

A table of LR(1) actions (SLR look-ahead) drives a graph-structured stack: all stacks that some choice of edits
leads to are kept at once, tops of equal state are one node, and each of its links to the stack below keeps the
minimum of (cost, audit). Edits of a row are Keep, Rerole and Delete; Insert adds a turn anywhere. The audit is the
initials of the edits in order, and decides between equal costs.

Audits are compared without being written out. All stacks after a row have consumed the same rows, and their audits
end with the edit of that row, so none is the beginning of another: they are ordered by the rank of the stack they
come from and by what was added since.

A conversation may be split at any row. A piece maps each stack that may lie below it to the best way to each stack
it may end with; pieces are chained by these small tables, and only then is the way through each piece written out.
So one long conversation is repaired by many tasks.
"""

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.sources import scratch

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
NAMES = {"s": "system", "u": "user", "a": "assistant"}

#: Rules by number: left side and number of symbols on the right.
RULES = [("C", 0), ("C", 1), ("C", 2), ("T", 1), ("T", 2), ("P", 2)]
#: LR states: 0 start, 1 after s, 2 after u, 3 C -> T . (and T -> T . P), 4 C -> s T . (and T -> T . P), 5 a complete P,
#: 6 T -> P ., 7 T -> T P .; next state by state and symbol, and rule to reduce by state and look-ahead ($ is the end).
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (4, "u"): 2, (2, "a"): 5, (0, "T"): 3, (1, "T"): 4,
        (0, "P"): 6, (1, "P"): 6, (3, "P"): 7, (4, "P"): 7}
REDUCE = {(0, "$"): 0, (3, "$"): 1, (4, "$"): 2} | {
    (state, ahead): rule for state, rule in ((5, 5), (6, 3), (7, 4)) for ahead in "u$"}

#: A stack: its top state and the stack below, shared between all that stand on it.
Stack = tuple
START: Stack = (0, None)


def _settled(stack: Stack, ahead: str) -> Stack:
    """The stack after all reductions that the look-ahead allows."""
    while (rule := REDUCE.get((stack[0], ahead))) is not None and RULES[rule][0] != "C":
        left, size = RULES[rule]
        for _ in range(size):
            stack = stack[1]
        stack = (NEXT[stack[0], left], stack)
    return stack


def shifted(stack: Stack, symbol: str) -> Stack | None:
    """The stack after a symbol, complete parts reduced; none if the grammar has no such continuation."""
    stack = _settled(stack, symbol)
    state = NEXT.get((stack[0], symbol)) if symbol in NAMES else None
    return None if state is None else _settled((state, stack), "u")


def accepts(stack: Stack) -> bool:
    return (_settled(stack, "$")[0], "$") in REDUCE


def _all_stacks() -> tuple[Stack, ...]:
    """The stacks between rows, in the order they are found; the grammar is left-recursive, so they are few."""
    found = [START]
    for stack in found:
        found += [new for x in NAMES if (new := shifted(stack, x)) is not None and new not in found]
    return tuple(found)


STACKS = _all_stacks()
_NUMBER = {stack: k for k, stack in enumerate(STACKS)}


def _inserted(stack: Stack) -> list[tuple[int, Stack]]:
    """The stacks that inserted user and assistant turns lead to, each by the fewest: ``(number, stack)``."""
    found = [(0, stack)]
    for n, at in found:
        for x in "ua":
            new = shifted(at, x)
            if new is not None and new not in (s for _, s in found):
                found.append((n + 1, new))
    return found


def _moves(stack: Stack, initial: str) -> list[tuple[int, str, int]]:
    """``(cost, added audit, stack number)`` of every way over a row with this initial role, insertions before it included."""
    out = []
    for n, at in _inserted(stack):
        ways = [(DELETE, at), (KEEP, shifted(at, initial))] + [(REROLE, shifted(at, x)) for x in "ua"]
        out += [(n * COST[INSERT] + COST[e], INSERT * n + e, _NUMBER[new]) for e, new in ways if new is not None]
    return out


#: By initial (other roles: empty) and stack number.
MOVES = {initial: [_moves(stack, initial) for stack in STACKS] for initial in ("s", "u", "a", "")}
#: By stack number: the fewest insertions to an accepted end, or none.
ENDS = [min((n for n, at in _inserted(stack) if accepts(at)), default=None) for stack in STACKS]

Row = tuple[str, bool, bool]


def advance(top: dict[int, tuple[int, int]], row: Row) -> tuple[dict[int, tuple[int, int]], dict[int, tuple[int, str]]]:
    """The graph-structured stack after a row: ``{stack: (cost, rank of its audit)}`` and ``{stack: (stack before, added audit)}``.

    ``row`` is the initial of its role, whether it must go (blank or duplicate) and whether it is truncated.
    """
    initial, goes, truncated = row
    best: dict[int, tuple] = {}
    for before, (cost, rank) in top.items():
        for extra, added, new in MOVES[initial if initial in NAMES else ""][before]:
            if added[-1] == DELETE:
                whole = cost + extra
            elif goes:
                continue
            else:
                whole = cost + extra + truncated * TRUNCATED
            way = (whole, rank, added, before)
            if new not in best or way < best[new]:
                best[new] = way
    order = {way: k for k, way in enumerate(sorted(way[1:] for way in best.values()))}
    return {s: (way[0], order[way[1:]]) for s, way in best.items()}, {s: (way[3], way[2]) for s, way in best.items()}


def table(rows: Iterable[Row]) -> list[list]:
    """``[entry, exit, cost, rank]``: the best way of a piece from each stack to each stack, ranked by audit for each entry."""
    tops = {k: {k: (0, 0)} for k in range(len(STACKS))}
    for row in rows:
        tops = {k: advance(top, row)[0] for k, top in tops.items()}
    return [[k, s, *way] for k, top in tops.items() for s, way in sorted(top.items())]


def chain(tables: list[list[list]]) -> tuple[list[tuple[int, int]], int, int]:
    """Entry and exit of each piece on the best way through all, insertions at the end, and the cost."""
    top, steps = {0: (0, 0)}, []
    for ways in tables:
        best: dict[int, tuple] = {}
        for entry, out, cost, rank in ways:
            if entry in top:
                way = (top[entry][0] + cost, top[entry][1], rank, entry)
                if out not in best or way < best[out]:
                    best[out] = way
        order = {way: k for k, way in enumerate(sorted({way[1:3] for way in best.values()}))}
        top = {s: (way[0], order[way[1:3]]) for s, way in best.items()}
        steps.append({s: way[3] for s, way in best.items()})
    cost, _, last = min((c + ENDS[s] * COST[INSERT], r, s) for s, (c, r) in top.items() if ENDS[s] is not None)
    ends, at = [], last
    for step in reversed(steps):
        ends.append((step[at], at))
        at = step[at]
    return ends[::-1], ENDS[last], cost


def edits(rows: Iterable[Row], entry: int = 0, leave: int | None = None, inserts: int = 0) -> Iterator[tuple[str, str]]:
    """The edits of a piece from stack ``entry`` to stack ``leave``: ``(edit, role initial after it)``, ``D`` with none.

    Without ``leave`` the rows are a whole conversation. ``inserts`` turns are added behind the last row.
    """
    top, steps = {entry: (0, 0)}, []
    for row in rows:
        top, back = advance(top, row)
        steps.append((row[0], back))
    if leave is None:
        _, _, leave = min((c + ENDS[s] * COST[INSERT], r, s) for s, (c, r) in top.items() if ENDS[s] is not None)
        inserts = ENDS[leave]
    at, path = leave, []
    for initial, back in reversed(steps):
        before, added = back[at]
        path.append((initial, added))
        at = before
    stack = STACKS[entry]
    for initial, added in [*reversed(path), *([("", INSERT * inserts)] if inserts else [])]:
        for e in added:
            if e == DELETE:
                yield e, ""
                continue
            x = initial if e == KEEP else next(x for x in "ua" if shifted(stack, x) is not None)
            stack = shifted(stack, x)
            yield e, x


_OUT = "conv_id long, piece long, at long, turn long, old_role string, fault string, edit string, role string, text string, ways string"


def _initial(role: str | None) -> str:
    return (role or "")[:1]


class _Writer:
    """Collects repaired rows into Arrow batches."""

    names = [part.strip().split()[0] for part in _OUT.split(",")]
    types = [pa.string() if part.endswith("string") else pa.int64() for part in _OUT.split(",")]

    def __init__(self):
        self.rows, self.weight = [], 0

    def add(self, *row):
        self.rows.append(row)
        self.weight += 100 + len(row[8] or "")

    def flush(self, least: int = 1 << 22) -> Iterator[pa.RecordBatch]:
        if self.rows and self.weight >= least:
            columns = [pa.array(c, t) for c, t in zip(zip(*self.rows), self.types)]
            self.rows, self.weight = [], 0
            yield pa.RecordBatch.from_arrays(columns, self.names)


def _flags(fault: str | None) -> tuple[bool, bool]:
    return fault in ("blank", "duplicate"), fault == "truncated"


def _write(out: _Writer, conv, piece: int, first: int, rows: list, way: Iterator[tuple[str, str]]) -> None:
    """Repaired rows of a piece; ``rows`` holds ``turn, role, text, fault``."""
    at, given = first, iter(rows)
    for e, x in way:
        if e == INSERT:
            out.add(conv, piece, at, None, None, None, e, NAMES[x], "", None)
        else:
            turn, role, text, fault = next(given)
            out.add(conv, piece, at, turn, role, fault, e, {DELETE: None, KEEP: role, REROLE: NAMES.get(x)}[e], text, None)
        at += 1


def _groups(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """Rows as tuples of the columns ``names``, batch by batch."""
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names])


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repairs conversations that lie inside a sorted partition; the first and the last may go on in others.

    Of those, rows are passed on as they are, followed by the table of the piece.
    """
    piece, out = TaskContext.get().partitionId(), _Writer()
    held, conv, first, done = [], None, True, 0

    def emit(last: bool):
        nonlocal done
        roles = [(_initial(r[1]), *_flags(r[3])) for r in held]
        if first or last:
            for k, (turn, role, text, fault) in enumerate(held):
                out.add(conv, piece, done + k, turn, role, fault, None, None, text, None)
            ways = ";".join(",".join(map(str, way)) for way in table(roles))
            out.add(conv, piece, -1, None, None, None, None, None, None, ways)
        else:
            _write(out, conv, piece, done, held, edits(roles))
        done += 3 * len(held) + 3

    for row_conv, turn, role, text, fault in _groups(batches, ["conv_id", "turn", "role", "text", "fault"]):
        if held and row_conv != conv:
            emit(False)
            yield from out.flush()
            held, first = [], False
        conv = row_conv
        held.append((turn, role, text, fault))
    if held:
        emit(True)
    yield from out.flush(0)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entry, exit and insertions of every piece, from rows ``conv_id, piece, ways`` sorted by conversation and piece."""

    def emit(conv, pieces):
        ends, inserts, _ = chain([[list(map(int, way.split(","))) for way in ways.split(";")] for _, ways in pieces])
        last = len(pieces) - 1
        rows = [(conv, p, a, b, inserts if k == last else 0) for k, ((p, _), (a, b)) in enumerate(zip(pieces, ends))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["conv_id", "piece", "entry", "leave", "inserts"])

    held, conv = [], None
    for row_conv, piece, ways in _groups(batches, ["conv_id", "piece", "ways"]):
        if held and row_conv != conv:
            yield emit(conv, held)
            held = []
        conv = row_conv
        held.append((piece, ways))
    if held:
        yield emit(conv, held)


def _second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repairs pieces whose entry and exit are known."""
    out, held, now = _Writer(), [], None

    def emit():
        conv, piece, entry, leave, inserts = now
        roles = [(_initial(r[1]), *_flags(r[3])) for r in held]
        _write(out, conv, piece, first, held, edits(roles, entry, leave, inserts))

    first = 0
    names = ["conv_id", "piece", "entry", "leave", "inserts", "at", "turn", "old_role", "text", "fault"]
    for *key, at, turn, role, text, fault in _groups(batches, names):
        if held and key != now:
            emit()
            yield from out.flush()
            held = []
        if not held:
            first = at
        now = key
        held.append((turn, role, text, fault))
    if held:
        emit()
    yield from out.flush(0)


def faulty(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies, fault``: equal rows as one with their number; ``fault`` of the first of them.

    ``blank`` (no character but white space), else ``duplicate`` (role and text are those of an earlier row), else
    ``truncated`` (the last such character is none of ``.!?``), else null.
    """
    packed = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    packed = packed.withColumns({"_said": F.xxhash64("role", "text"), "_text": F.md5("text"), "_rank": F.coalesce(F.col("turn"), F.lit(-(1 << 63)))})
    packed = scratch.materialise(packed, "turns")
    earliest = packed.groupBy("conv_id", "_said", "_text").agg(F.min("_rank").alias("_first"))
    p, e = packed.alias("p"), earliest.alias("e")
    same = [F.col(f"p.{c}") == F.col(f"e.{c}") for c in ("_said", "_text")]
    first = p.join(e, [F.col("p.conv_id").eqNullSafe(F.col("e.conv_id")), *same, F.col("p._rank") == F.col("e._first")], "left")
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = (
        F.when(last == "", "blank").when(F.col("_first").isNull(), "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    )
    return first.select("p.conv_id", "turn", "role", "text", "copies", "p._text", fault.alias("fault"))


def repair(turns: DataFrame) -> DataFrame:
    """The cheapest repair of every conversation of ``turns`` (``conv_id, turn, role, text``), one row per edit.

    ``conv_id, piece, at`` (their order), ``edit`` (K, R, D or I), ``turn, old_role, text`` of the row (an inserted one has the text
    ""), ``role`` after the edit (null if deleted) and ``fault``. Rows are taken by turn, nulls first, then role and
    MD5 of the text; a null role or text is one space, a null ``conv_id`` is a conversation of its own. A column
    ``copies`` stands for so many equal rows. Blank rows and repeats of a role and text are always deleted. Equal
    repairs do not occur: an audit fixes the roles. Other columns are ignored; an empty table gives an empty table.
    """
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    blank = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = faulty(turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *blank, copies.cast("long").alias("copies")))
    again = F.when(F.col("fault") == "blank", F.col("fault")).otherwise("duplicate")
    every = F.transform(F.sequence(F.lit(1).cast("long"), "copies"), lambda k: F.when(k == 1, F.col("fault")).otherwise(again))
    order = ["conv_id", "turn", "role", "_text"]
    rows = scratch.materialise(rows.withColumn("_text", F.substring("_text", 1, 16)), "faults")
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("fault", F.explode(every))
    done = sorted_.select("conv_id", "turn", "role", "text", "fault").mapInArrow(_first_pass, _OUT)
    done = scratch.materialise(done, "repaired")
    ways = done.where("ways IS NOT NULL").select("conv_id", "piece", "ways")
    ways = ways.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    ends = scratch.materialise(ways.mapInArrow(_chained, "conv_id long, piece long, entry long, leave long, inserts long"), "ends")
    open_, ends = done.where("ways IS NULL AND edit IS NULL").alias("o"), ends.alias("e")
    split = open_.join(ends, (F.col("o.piece") == F.col("e.piece")) & F.col("o.conv_id").eqNullSafe(F.col("e.conv_id")))
    split = split.select("o.conv_id", "o.piece", "entry", "leave", "inserts", "at", "turn", "old_role", "text", "fault")
    split = split.repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "at").mapInArrow(_second_pass, _OUT)
    return done.where("edit IS NOT NULL").unionByName(split).drop("ways")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with planted faults, by crc32 of ``conv_id:turn`` modulo 20 (nulls as one space).

    0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 makes it two (column ``copies``), 4 sets the
    role user.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return turns.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


_DIGEST = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, n_turns long, n_repaired long"
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its edits in order; a conversation begins with a row of its own without edit."""
    names = [part.strip().split()[0] for part in _DIGEST.split(",")]
    types = [pa.string() if part.endswith("string") else pa.int64() for part in _DIGEST.split(",")]
    out, now = [], None

    def emit():
        gaps = now["high"] - now["low"] + 1 - now["turns"] if now["turns"] else 0
        n = now["n"]
        out.append((now["conv"], gaps, n["blank"], n["duplicate"], n["truncated"], now["illegal"], now["cost"], "".join(now["audit"]),
                    now["hash"].hexdigest(), now["rows"], now["left"]))

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    for conv, piece, turn, old, fault, e, role, text in _groups(batches, ["conv_id", "piece", "turn", "old_role", "fault", "edit", "role", "text"]):
        if e is None:
            if now:
                emit()
                if len(out) == 10_000:
                    yield batch()
                    out = []
            now = dict(conv=conv, low=0, high=0, turns=0, last=None, seen=None, illegal=0, cost=0, audit=[], rows=0, left=0,
                       hash=hashlib.sha256(), n=dict(blank=0, duplicate=0, truncated=0))
            continue
        now["audit"].append(e)
        now["cost"] += COST[e] + (TRUNCATED if fault == "truncated" and e != DELETE else 0)
        if e != INSERT:
            now["rows"] += 1
            if fault:
                now["n"][fault] += 1
            if now["seen"] is not None and now["seen"] + _initial(old) not in ("su", "ua", "au"):
                now["illegal"] += 1
            now["seen"] = _initial(old)
            if turn is not None and turn != now["last"]:
                now["low"] = turn if not now["turns"] else now["low"]
                now["high"], now["last"] = turn, turn
                now["turns"] += 1
        if e != DELETE:
            now["hash"].update((("\n" if now["left"] else "") + f"{role}:{text}").encode())
            now["left"] += 1
    if now:
        emit()
    if out:
        yield batch()


def digest(repaired: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``conversations``: gaps, faults, illegal neighbours, cost, audit and a hash of the repair.

    ``gaps`` counts missing turn numbers, ``illegal`` neighbouring rows whose role initials are not su, ua or au.
    A conversation without rows in ``repaired`` has zeros, an empty audit and the hash of an empty text.
    """
    begin = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    columns = ["conv_id", "piece", "at", "turn", "old_role", "fault", "edit", "role", "text"]
    begin = begin.withColumns({"piece": F.lit(-1).cast("long"), "at": F.lit(0).cast("long")})
    rows = repaired.select(*columns).unionByName(begin, allowMissingColumns=True)
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "piece", "at")
    return rows.mapInArrow(_digest, _DIGEST)
