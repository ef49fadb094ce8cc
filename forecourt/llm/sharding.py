"""Resharding by minimum-cost flow: equal row counts while the fewest bytes change their shard.

Old shards supply rows, new shards take equal counts (at most one apart). Rows that stay cost nothing; a row
that leaves costs its bytes. Which shards get the extra rows, and how many rows each old shard gives to each
new one, is a minimum-cost flow over shards; each shard gives its smallest rows. Spark counts, ranks and moves
rows; the driver sees a few numbers per shard.
"""

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import fresh, ranked
from forecourt.sources import scratch

Edge = tuple[object, object, int, int]


def size_of(text: str = "text") -> Column:
    """UTF-8 bytes of a text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8).cast("long")


def min_cost_flow(edges: list[Edge], source: object, sink: object, amount: int) -> tuple[dict[int, int], int]:
    """Units on each edge (from, to, capacity, cost per unit; by its index) and their cost.

    Successive shortest paths (Bellman-Ford on the residual graph) for ``amount`` units.
    """
    graph = defaultdict(list)
    ends, room, price = [], [], []
    for u, v, capacity, cost in edges:
        for a, b, c, p in ((u, v, capacity, cost), (v, u, 0, -cost)):
            graph[a].append(len(ends))
            ends.append((a, b)), room.append(c), price.append(p)
    total = 0
    while amount:
        best, via, changed = {source: 0}, {}, [source]
        while changed:
            nodes, changed = changed, []
            for a in nodes:
                for e in graph[a]:
                    b = ends[e][1]
                    if room[e] and best[a] + price[e] < best.get(b, float("inf")):
                        best[b], via[b] = best[a] + price[e], e
                        changed.append(b)
        if sink not in best:
            raise ValueError("the shards cannot take all rows")
        path, node = [], sink
        while node != source:
            path.append(via[node])
            node = ends[via[node]][0]
        units = min(amount, *(room[e] for e in path))
        for e in path:
            room[e] -= units
            room[e ^ 1] += units
        amount -= units
        total += units * best[sink]
    return {k: room[2 * k + 1] for k in range(len(edges)) if room[2 * k + 1]}, total


def plan(counts: dict[int, int], shards: int, marginal: dict[int, int]) -> dict[tuple[int, int], int]:
    """Rows from old to new shard: ``{(old, new): rows}``.

    ``marginal``: bytes of the row that shard ``old`` keeps only if it gets one of the extra rows (the largest of
    those it gives otherwise). The rows below that are given in any case, at a cost that no choice changes.
    """
    rows = sum(counts.values())
    base, extra = divmod(rows, shards)
    edges: list[Edge] = []
    for old, n in counts.items():
        edges.append(("source", ("old", old), n, 0))
        if old < shards:
            edges.append((("old", old), ("new", old), min(n, base + 1), 0))
        edges.append((("old", old), "pool", n, marginal.get(old, 0)))
    for new in range(shards):
        edges.append(("pool", ("new", new), rows, 0))
        edges.append((("new", new), "sink", base, 0))
        edges.append((("new", new), "extra", 1, 0))
    edges.append(("extra", "sink", extra, 0))
    flow, _ = min_cost_flow(edges, "source", "sink", rows)
    keeps, gives, takes = defaultdict(int), defaultdict(int), defaultdict(int)
    for k, units in flow.items():
        u, v = edges[k][:2]
        if u[0] == "old" and v == "pool":
            gives[u[1]] += units
        elif u[0] == "old":
            keeps[u[1]] += units
        elif u == "pool":
            takes[v[1]] += units
    moves = {(shard, shard): n for shard, n in keeps.items()}
    for old in sorted(gives):
        for new in sorted(takes):
            if units := min(gives[old], takes[new]):
                moves[old, new] = moves.get((old, new), 0) + units
                gives[old] -= units
                takes[new] -= units
    return moves


def _cuts(rows: DataFrame, counts: dict[int, int], shards: int) -> dict[int, list[tuple[int, int, int]]]:
    """For each old shard, ranges (below, up to, size) of the sorted sizes around the ranks where its surplus may end.

    Equal sizes are counted first; sums run over distinct sizes, not over rows.
    """
    base = sum(counts.values()) // shards
    hist = rows.groupBy("old_shard", "size").count()
    upto = F.sum("count").over(Window.partitionBy("old_shard").orderBy("size"))
    hist = hist.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("count"))
    found = defaultdict(list)
    wanted = None
    for old, n in counts.items():
        surplus = n - base if old < shards else n
        if surplus > 0:
            here = (F.col("old_shard") == old) & (F.col("below") < surplus) & (F.col("upto") >= surplus - 1)
            wanted = here if wanted is None else wanted | here
    if wanted is not None:
        for r in hist.where(wanted).collect():
            found[r["old_shard"]].append((r["below"], r["upto"], r["size"]))
    return found


def _lookup(values: dict, key: Column, missing) -> Column:
    """A value per shard; the map has one entry per shard."""
    pairs = [F.lit(x) for k, v in values.items() for x in (k, v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(missing)) if pairs else F.lit(missing)


def reshard(
    docs: DataFrame,
    shards: int,
    old_shard: Column | None = None,
    old_shards: int = 16,
    size: Column | None = None,
    order: tuple[str, ...] = ("doc_id", "text"),
) -> DataFrame:
    """``docs`` with ``size, old_shard, shard, slot``, which replace columns of these names.

    Counts of new shards are at most one apart, slots are gapless from 0, and of all such layouts the one moves
    the fewest bytes. ``old_shard`` (0 and up) is the present shard of a row; without it rows lie by the crc32 of
    their id in ``old_shards`` shards (a null id: by the empty text). ``size`` is the bytes of a row (``size_of``).
    Of equal sizes, rows leave by a hash of the ``order`` columns. Null and empty texts count 8 bytes; repeated
    rows and ids count one by one. An empty table stays empty. Only the final ranking moves whole rows, once.
    """
    if old_shard is None:
        id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
        old_shard = F.pmod(F.crc32(id_text.cast("binary")), F.lit(old_shards))
    size = size_of() if size is None else size
    rows = docs.withColumns({"old_shard": old_shard.cast("int"), "size": size}).drop("shard", "slot")
    kept = docs.drop("old_shard", "size", "shard", "slot").columns
    kind, spread, rank, out, to_, hit_ = (fresh(rows, c) for c in ("_class", "_h", "_rank", "_out", "_to", "_hit"))
    slim = scratch.materialise(rows.select("old_shard", "size", F.xxhash64(*order).alias(spread)), "sizes")
    counts = {r["old_shard"]: r["count"] for r in slim.groupBy("old_shard").count().collect()}
    cuts = _cuts(slim, counts, shards)
    base = sum(counts.values()) // shards

    def size_at(old: int, rank: int) -> int:
        return next((size for below, upto, size in cuts.get(old, []) if below < rank <= upto), 0)

    surplus = {old: n - base if old < shards else n for old, n in counts.items()}
    moves = plan(counts, shards, {old: size_at(old, n) for old, n in surplus.items() if n > 0})
    leaving = {old: n - moves.get((old, old), 0) for old, n in counts.items()}
    edge = {old: size_at(old, n) for old, n in leaving.items() if n > 0}
    last = _lookup(edge, F.col("old_shard"), -1)
    order_class = F.when(F.col("size") < last, 0).when(F.col("size") == last, 1).otherwise(2)
    slim, rows = (df.withColumn(kind, order_class) for df in (slim, rows.withColumn(spread, F.xxhash64(*order))))
    sizes = {(r["old_shard"], r[kind]): r["count"] for r in slim.groupBy("old_shard", kind).count().collect()}
    before = {f"{o}/{c}": sum(n for (o2, c2), n in sizes.items() if o2 == o and c2 < c) for o, c in sizes}
    placed = ranked(rows, ["old_shard", kind], [spread], [*order, "size"], slim, out=rank)
    key = F.concat_ws("/", F.col("old_shard").cast("string"), F.col(kind).cast("string"))
    filled = {new: moves.get((new, new), 0) for new in range(shards)}
    begin, target = defaultdict(int), defaultdict(list)
    for (old, new), units in sorted(moves.items()):
        if old != new:
            begin[old] += units
            target[old].append(f"named_struct('upto', {begin[old]}L, 'shard', {new}, 'shift', {filled[new] - begin[old] + units}L)")
            filled[new] += units
    cases = " ".join(f"WHEN {old} THEN array({', '.join(parts)})" for old, parts in target.items())
    to = F.expr(f"CASE old_shard {cases} END") if cases else F.lit(None).cast("array<struct<upto:bigint,shard:int,shift:bigint>>")
    placed = placed.withColumns({rank: F.col(rank) + _lookup(before, key, 0), out: _lookup(leaving, F.col("old_shard"), 0), to_: to})
    hit = F.when(F.col(rank) < F.col(out), F.filter(to_, lambda t: F.col(rank) < t["upto"])[0])
    placed = placed.withColumn(hit_, hit)
    return placed.select(
        *kept,
        "size",
        "old_shard",
        F.coalesce(F.col(hit_)["shard"], "old_shard").cast("int").alias("shard"),
        F.coalesce(F.col(rank) + F.col(hit_)["shift"], F.col(rank) - F.col(out)).cast("long").alias("slot"),
    )


#: Rows of a file that are numbered together.
RUN = 50_000


def _as_stored(docs: DataFrame, file: str, row: str) -> DataFrame:
    """``docs`` with the name of each row's file and its place there. What is no table of files is written first."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = scratch.materialise(docs, "stored")
    return docs.withColumns({file: F.col("_metadata.file_name"), row: F.col("_metadata.row_index")})


def reshard_in_order(docs: DataFrame, shards: int, **options) -> DataFrame:
    """``reshard``, but the slots of a shard follow the order of ``docs``: file after file by name, row after row.

    Rows are numbered inside runs of ``RUN`` rows of a file, and the counts of the runs are summed. ``shard, slot, size`` and
    ``old_shard`` replace columns of these names; all others keep their values. Null and empty texts, repeated rows and
    an empty table are treated as by ``reshard``.
    """
    file, row, run, before, inside, n = (fresh(docs, c) for c in ("_file", "_row", "_run", "_before", "_inside", "_n"))
    placed = reshard(_as_stored(docs, file, row), shards, **options)
    placed = scratch.materialise(placed.withColumn(run, F.floor(F.col(row) / RUN)), "placed")
    counts = placed.groupBy("shard", file, run).agg(F.count(F.lit(1)).alias(n))
    part = F.length(F.regexp_extract(file, r"part-([0-9]+)", 1))  # longer numbers follow shorter ones
    earlier = F.sum(n).over(Window.partitionBy("shard").orderBy(part, file, run)) - F.col(n)
    counts = scratch.materialise(counts.withColumn(before, earlier).drop(n), "runs")
    numbered = placed.withColumn(inside, F.row_number().over(Window.partitionBy("shard", file, run).orderBy(row)))
    joined = numbered.join(counts, ["shard", file, run]).withColumn("slot", F.col(before) + F.col(inside) - 1)
    return joined.select(*[c for c in placed.columns if c not in (file, row, run)])


def rewrite(placed: DataFrame, path: str) -> list[int]:
    """Write the files of the shards that rows left or entered, as ``shard=N`` below ``path``; the other shards' files stay.

    Returns the shards written. Old shards that no longer hold rows keep their files for the caller to drop.
    """
    moved = placed.where("shard != old_shard").select(F.explode(F.array("shard", "old_shard")).alias("shard")).distinct()
    touched = sorted(r["shard"] for r in moved.collect())
    rows = placed.where(F.col("shard").isin(touched)).drop("old_shard")
    rows = rows.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    return touched
