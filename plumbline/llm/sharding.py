"""Resharding that moves the fewest bytes: a minimum-cost flow from old shards to new capacities, then block transfers.

The flow's network has a node for each old and each new shard, so it is solved on the driver whatever the number of rows. An
arc from an old shard to the new one of the same number is free; any other way leads through a hub and costs its bytes, so
there are as many arcs as shards. What flows from one shard to another is a block: a range of the old shard's hash order,
found by running sums over slices of that order, so that no task holds a shard. The shards that neither lose nor receive a
block are not written again.

Rows are told apart by a digest of id and text and, where that repeats, by a number among equals; which of several equal rows
gets which slot does not matter.

Defined cases: text NULL has no bytes, size 1 and CRC 0. Ids may be NULL or repeated: every row gets a place of its own. Rows
whose old shard is NULL count as one old shard, -1, which is emptied. Where the table has columns named `shard` or `slot`, the
files' own are named with an underscore before. Rows with the same id and text are numbered by one task for each such
group, with spill. Without rows there are no blocks. A row belongs where the middle of its bytes falls, so a shard misses its
capacity by less than one row for each block it receives.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from plumbline.llm.common import _shuffles_removed, free_name, running_total, settle
from plumbline.session import shared_dir

SEED = "shard-1"


def cheapest(nodes: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int, need: int) -> list[int]:
    """What flows along each arc (from, to, capacity, cost) when `need` goes from source to sink at the least cost, by
    successive shortest paths with potentials."""
    graph: list[list[int]] = [[] for _ in range(nodes)]
    to, left, price = [], [], []
    for a, b, amount, each in arcs:
        for x, y, q, c in ((a, b, amount, each), (b, a, 0, -each)):
            graph[x].append(len(to))
            to.append(y)
            left.append(q)
            price.append(c)
    potential = [0] * nodes
    while need:
        best, came = {source: 0}, {}
        heap = [(0, source)]
        while heap:
            d, v = heapq.heappop(heap)
            if d > best[v]:
                continue
            for e in graph[v]:
                if left[e] and (w := d + price[e] + potential[v] - potential[to[e]]) < best.get(to[e], w + 1):
                    best[to[e]], came[to[e]] = w, e
                    heapq.heappush(heap, (w, to[e]))
        if sink not in best:
            raise ValueError("the new shards cannot hold all rows")
        far = max(best.values())
        potential = [p + best.get(v, far) for v, p in enumerate(potential)]
        path, v = [], sink
        while v != source:
            path.append(came[v])
            v = to[came[v] ^ 1]
        amount = min([need, *(left[e] for e in path)])
        for e in path:
            left[e] -= amount
            left[e ^ 1] += amount
        need -= amount
    return left[1::2]


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Flow from i to j, cheapest in all, for any costs. All supply must fit."""
    n, m = len(supply), len(capacity)
    arcs = [(n + m, i, s, 0) for i, s in enumerate(supply)] + [(n + j, n + m + 1, c, 0) for j, c in enumerate(capacity)]
    arcs += [(i, n + j, sum(supply), cost[i][j]) for i in range(n) for j in range(m)]
    flow = cheapest(n + m + 2, arcs, n + m, n + m + 1, sum(supply))[n + m :]
    return [flow[i * m : (i + 1) * m] for i in range(n)]


def fewest_moves(supply: dict[int, int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """Flow from old to new shards of which the least changes its number, as (old, new): amount."""
    old, m, total = sorted(supply), len(capacity), sum(supply.values())
    n = len(old)
    hub, source, sink = n + m, n + m + 1, n + m + 2
    arcs = [(source, i, supply[s], 0) for i, s in enumerate(old)] + [(n + j, sink, c, 0) for j, c in enumerate(capacity)]
    arcs += [(i, hub, supply[s], 1) for i, s in enumerate(old)] + [(hub, n + j, total, 0) for j in range(m)]
    free = [(i, s) for i, s in enumerate(old) if 0 <= s < m]
    flow = cheapest(n + m + 3, arcs + [(i, n + s, supply[s], 0) for i, s in free], source, sink, total)
    out = {(s, s): x for (_, s), x in zip(free, flow[len(arcs) :], strict=True) if x}
    leaving, arriving = flow[n + m : 2 * n + m], flow[2 * n + m : 2 * n + 2 * m]
    j = 0
    for i, s in enumerate(old):  # the hub's way in and out, matched in order
        while leaving[i]:
            while not arriving[j]:
                j += 1
            amount = min(leaving[i], arriving[j])
            out[s, j] = out.get((s, j), 0) + amount
            leaving[i] -= amount
            arriving[j] -= amount
    return out


def even(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def transfers(sizes: dict[int, int], shards: int, capacity: list[int] | None = None) -> list[tuple[int, int, int, int]]:
    """(old shard, new shard, first byte in the old shard's order, end): what stays comes first, then what moves."""
    flow = fewest_moves(sizes, capacity or even(sum(sizes.values()), shards))
    out, at = [], dict.fromkeys(sizes, 0)
    for i, j in sorted(flow, key=lambda x: (x[0], x[1] != x[0], x[1])):
        out.append((i, j, at[i], at[i] + flow[i, j]))
        at[i] += flow[i, j]
    return out


def row_key() -> Column:
    """A digest of a row's id and text."""
    ident = F.col("doc_id").cast("string")
    text = F.coalesce(F.concat(F.lit("1"), F.col("text")), F.lit("0"))
    return F.md5(F.concat(F.coalesce(F.length(ident), F.lit(-1)).cast("string"), F.lit(":"), F.coalesce(ident, F.lit("")), F.lit(":"), text))


def _measured(old_shard: Column) -> list[Column]:
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "utf-8")
    return [
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(data).cast("long").alias("text_crc32"),
        F.coalesce(old_shard.cast("int"), F.lit(-1)).alias("old_shard"),
    ]


def reshard(docs: DataFrame, old_shard: Column, shards: int, capacity: list[int] | None = None, seed: str = SEED) -> DataFrame:
    """Per row of (doc_id, text): doc_id, size, text_crc32, old_shard, key (its digest), shard, slot (from 0 within the shard)."""
    rows = settle(docs.select(*_measured(old_shard), row_key().alias("key")))
    sizes = {r[0]: r[1] for r in rows.groupBy("old_shard").agg(F.sum("size")).collect()}  # a row for each old shard
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.col("key")))
    placed = running_total(rows, ["old_shard"], [F.col("key")], place, F.col("size"), "before")
    middle = F.col("before") * 2 + F.col("size")
    cuts = docs.sparkSession.createDataFrame(transfers(sizes, shards, capacity) if sizes else [], "of int, shard int, begin long, end long")
    inside = (F.col("old_shard") == F.col("of")) & (middle >= 2 * F.col("begin")) & (middle < 2 * F.col("end"))
    placed = placed.join(F.broadcast(cuts), inside, "left").drop("of", "begin", "end", "before")  # about as many cuts as shards
    return running_total(settle(placed), ["shard"], [F.col("key")], place, F.lit(1), "slot")


def names(docs: DataFrame) -> tuple[str, str]:
    """What the files call the shard and the slot."""
    return free_name(docs, "shard"), free_name(docs, "slot")


def rewrite(docs: DataFrame, placed: DataFrame, path: str) -> list[int]:
    """Writes the shards that lose or receive rows, whole, as folders shard=N under `path`, and returns their numbers; the
    others' files remain valid. The tasks that join `docs` and `placed` write, so texts are shuffled once and a hot shard is
    spread over all tasks; each file is in the order of slots."""
    moved = placed.filter(F.col("old_shard") != F.col("shard")).select(F.explode(F.array("old_shard", "shard")).alias("shard"))
    affected = sorted(r[0] for r in moved.distinct().collect())
    shard, slot = names(docs)
    key, copy, content = (free_name(docs, c) for c in ("key", "copy", "content"))
    rows = placed.select("key", F.col("shard").alias(shard), F.col("slot").alias(slot), F.lit(1).alias("copy"))
    work = docs.withColumn(key, row_key()).withColumn(copy, F.lit(1))
    repeated = settle(placed.groupBy("key").count().filter("count > 1").select("key"), light=True)
    if not repeated.isEmpty():
        # equal rows are numbered on both sides; all others have no equal
        again = F.row_number().over(Window.partitionBy("key").orderBy(shard, slot))
        rows = rows.join(repeated, "key", "left_anti").union(rows.join(repeated, "key", "left_semi").withColumn("copy", again))
        of = repeated.select(F.col("key").alias("of"))
        own = docs.schema.names
        whole = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in own])
        equals = work.join(of, F.col(key) == F.col("of"), "left_semi").withColumn(content, whole)
        equals = equals.withColumn(copy, F.row_number().over(Window.partitionBy(key).orderBy(content))).drop(content)
        work = work.join(of, F.col(key) == F.col("of"), "left_anti").union(equals)
    rows = rows.filter(F.col(shard).isin(affected)).select(F.col("key").alias("_placed_key"), F.col("copy").alias("_placed_copy"), shard, slot)
    dealt = work.join(rows, (F.col(key) == F.col("_placed_key")) & (F.col(copy) == F.col("_placed_copy")))
    dealt = dealt.select(*[F.col(f"`{c}`") for c in docs.columns], slot, shard).sortWithinPartitions(shard, slot)
    with _shuffles_removed(docs.sparkSession):
        dealt.write.partitionBy(shard).parquet(path)
    return affected


def rewritten(docs: DataFrame, old_shard: Column, shards: int) -> DataFrame:
    """As `reshard`, after the affected shards were written to the shared folder: their rows are those read back from there,
    each column from what was read; the rows of the others are as placed."""
    placed = settle(reshard(docs, old_shard, shards))
    path = f"{shared_dir(docs.sparkSession)}/shards-{uuid.uuid4().hex}"
    affected = rewrite(docs, placed, path)
    shard, slot = names(docs)
    schema = T.StructType([*docs.schema.fields, T.StructField(slot, T.LongType()), T.StructField(shard, T.IntegerType())])
    back = docs.sparkSession.read.schema(schema).parquet(path)
    back = back.select(*_measured(old_shard), F.col(shard).alias("shard"), F.col(slot).alias("slot"))
    return back.unionByName(placed.filter(~F.col("shard").isin(affected)).select(*back.columns))
