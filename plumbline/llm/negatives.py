"""Hard negatives of every anchor by exact search in an STR-packed R-tree.

Sort-tile-recursive packing: Spark sorts the rows by label and first coordinate into slabs of equal size (equal rows are cut
by a hash of their id, so a vector that a third of the rows share fills several slabs). Tasks tile their slabs further, by the
coordinates that vary most, into leaves of `LEAF` rows; `FAN_OUT` leaves are a page. Every leaf and page has a minimum bounding
box; the label is one more coordinate of it. A row's inner product with an anchor lies between the sums of each coordinate's
least and greatest product over the box.

Searching: every group of slabs (`GROUP_BYTES`) is one task's tree, and all anchors stream by it in blocks. An anchor visits
pages from the highest upper bound on, one at first, then twice as many at a time; what has been found sets its kth score.
Pages and leaves are left out if they hold no row of the labels asked for, if their interval misses the score windows, or if
their upper bound is strictly below the kth score. Bounds and scores of the anchors that visit a page are matrix products.
Each task gives at most k rows per question; Spark ranks those of all tasks.

A component is floor(256 * x). Scores are whole numbers below 2**53 and therefore exact in floating point.

Defined cases: rows take no part if the label, the vector or any component is NULL or a component is not finite or, times 256,
beyond 2**20 (scores would leave the range of exact numbers); empty vectors neither. A vec_id is one row: of rows with the
same id the one with the smallest label, then vector, counts. A NULL id is no anchor, comes last among ties, and equal rows
without id are one. Vectors meet vectors of their own length. Anchors without positives, and positives without negatives in
their window (always so for negative scores), give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import few_rows, settle
from plumbline.llm.vectors import matrices

SCALE, LARGEST = 256, 2.0**20
LEAF, FAN_OUT = 64, 16
#: Rows of one stored slab, and bytes of the slabs that one task holds at once.
SLAB = 4096
GROUP_BYTES = 16 << 20
#: Anchors of a block, and candidates that a task gathers before it ranks them.
ANCHORS = 256
GATHERED = 1 << 20
POSITIVES, NEGATIVES = 5, 10
#: A negative's score, as hundredths of the positive's.
LOW, HIGH = 30, 90
NO_ID = np.iinfo(np.int64).max

WHOLE = "vec_id long, label int, dim int, axis int, packed binary"
SLABS = "dim int, part int, n int, ids binary, labels binary, packed binary"
BLOCKS = "dim int, n int, ids binary, labels binary, packed binary, of binary, low binary, high binary, tags binary"
HITS = "anchor_id long, tag long, id long, score long"


# --- rows


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, vectors in matrices(batch.column(2)):
            whole = np.floor(vectors * SCALE)
            good = (np.abs(whole) <= LARGEST).all(axis=1)
            rows, whole = pa.array(rows[good]), whole[good].astype(np.int32)
            packed = pa.array([x.tobytes() for x in whole], pa.binary())
            dim = pa.array(np.full(len(whole), whole.shape[1], np.int32))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in (0, 1)), dim, pa.array(whole[:, 0].copy()), packed], names=["vec_id", "label", "dim", "axis", "packed"])


def whole_rows(rows: DataFrame, vector: str) -> DataFrame:
    """One row per vec_id with its label and whole components."""
    own = rows.filter("label IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )
    found = own.mapInArrow(_whole, WHOLE)
    alone = F.when(F.col("vec_id").isNull(), F.xxhash64("label", "packed"))
    found = found.groupBy("vec_id", alone.alias("alone")).agg(F.min(F.struct("label", "dim", "axis", "packed")).alias("row"))
    return settle(found.select("vec_id", "row.*"))


# --- the tree


def tiles(q: np.ndarray, rows: np.ndarray, axes: list[int]) -> Iterator[np.ndarray]:
    """Sort-tile-recursive: rows sorted by the first axis, cut into slabs, each of them tiled by the other axes."""
    leaves = -(-len(rows) // LEAF)
    if leaves <= 1 or not axes:
        yield rows
        return
    slabs = max(2, round(leaves ** (1 / len(axes))))
    size = -(-leaves // slabs) * LEAF
    ordered = rows[np.argsort(q[rows, axes[0]], kind="stable")]
    for at in range(0, len(ordered), size):
        yield from tiles(q, ordered[at : at + size], axes[1:])


def packing(q: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """An order of rows in which every LEAF rows in turn make a leaf: by label, within a label tiled by the coordinates that
    vary most, each cut in two or three."""
    order = []
    for label in np.unique(labels):
        rows = np.flatnonzero(labels == label)
        depth = int(np.log2(max(1, len(rows) // LEAF)))
        axes = np.argsort(-q[rows].var(axis=0), kind="stable")[:depth].tolist()
        order.extend(tiles(q, rows, axes))
    return np.concatenate(order) if order else np.zeros(0, np.int64)


def _slabs(parts: int):
    """Packs sorted rows into slabs, dealt to the groups in turn."""

    def packed(rows: list[tuple], number: int) -> pa.RecordBatch:
        ids, labels, dims, _, raw = zip(*rows, strict=True)
        q = np.frombuffer(b"".join(raw), np.int32).reshape(len(rows), -1)
        labels = np.array(labels, np.int32)
        order = packing(q, labels)
        ids = np.array([NO_ID if i is None else i for i in ids], np.int64)
        columns = [[dims[0]], [number % parts], [len(rows)], *([x[order].tobytes()] for x in (ids, labels, q))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k < 3 else pa.binary()) for k, c in enumerate(columns)], names=["dim", "part", "n", "ids", "labels", "packed"])

    def run(batches):
        held: list[tuple] = []
        number = TaskContext.get().partitionId()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (len(held) == SLAB or held[-1][2] != row[2]):
                    yield packed(held, number)
                    held, number = [], number + 1
                held.append(row)
        if held:
            yield packed(held, number)

    return run


def packed_tree(rows: DataFrame, parts: int) -> DataFrame:
    """The rows as slabs in leaf order, each with the number of its group of slabs (from 0 to parts - 1)."""
    keys = ["dim", "label", "axis", F.xxhash64("vec_id")]
    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return settle(ordered.select("vec_id", "label", "dim", "axis", "packed").mapInArrow(_slabs(parts), SLABS))


def boxes(low: np.ndarray, high: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Boxes around every `size` boxes in turn."""
    starts = np.arange(0, len(low), size)
    return np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with a point of each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


@dataclass
class Questions:
    """What anchors of one block ask: question `j` is of anchor `of[j]` (ascending), for scores from `low` to `high`."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    of: np.ndarray
    low: np.ndarray
    high: np.ndarray
    tags: np.ndarray


class Tree:
    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray):
        self.ids, self.labels, self.q = ids, labels, q.astype(np.float64)
        both = np.concatenate([labels[:, None].astype(np.float64), self.q], axis=1)
        self.leaves = boxes(both, both, LEAF)
        self.pages = boxes(*self.leaves, FAN_OUT)
        self.scored = 0

    @staticmethod
    def _open(nodes: tuple[np.ndarray, np.ndarray], labels: np.ndarray, same: bool) -> np.ndarray:
        """Whether boxes may hold rows of the anchors' label, or of another."""
        first, last = nodes[0][:, 0], nodes[1][:, 0]
        if same:
            return (first <= labels[:, None]) & (labels[:, None] <= last)
        return (first != labels[:, None]) | (last != labels[:, None])

    def search(self, x: Questions, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best rows of each question, by score, then id: (question, id, score)."""
        count = len(x.ids)
        first = np.searchsorted(x.of, np.arange(count))
        many = np.searchsorted(x.of, np.arange(count), "right") - first
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        need = x.low.astype(np.float64)  # a score below this cannot be among the k best
        low, high = intervals(x.vectors, self.pages[0][:, 1:], self.pages[1][:, 1:])
        wide = int(many.max(initial=0))
        slot = np.where(np.arange(wide) < many[:, None], first[:, None] + np.arange(wide), -1)
        own, inside = np.maximum(slot, 0), slot >= 0
        top = np.where(inside, x.high[own], -np.inf).max(axis=1, initial=-np.inf)
        reach = np.where(self._open(self.pages, x.labels, same) & (low <= top[:, None]), high, -np.inf)
        order = np.argsort(-reach, axis=1, kind="stable")
        sorted_reach = np.take_along_axis(reach, order, axis=1)
        at, step = 0, 1
        alive = np.arange(count)
        while len(alive) and at < order.shape[1]:
            least = np.where(inside[alive], need[own[alive]], np.inf).min(axis=1, initial=np.inf)
            go = (sorted_reach[alive, at : at + step] >= least[:, None]) & np.isfinite(sorted_reach[alive, at : at + step])
            alive_rows, nth = np.nonzero(go)
            page = order[alive[alive_rows], at + nth]
            by_page = np.argsort(page, kind="stable")
            cuts = np.flatnonzero(np.diff(page[by_page])) + 1
            found, size = [], 0
            for visit in np.split(by_page, cuts) if len(page) else ():
                found.append(self._page(int(page[visit[0]]), alive[alive_rows[visit]], x, slot, need, same))
                size += len(found[-1][0])
                if size > GATHERED:
                    best, need = self._ranked([best, *found], x, need, k)
                    found, size = [], 0
            best, need = self._ranked([best, *found], x, need, k)
            alive = alive[go.any(axis=1)]  # bounds only fall from here on, so who has nothing to visit is done
            at, step = at + step, 2 * step
        return best

    def _page(self, page: int, anchors: np.ndarray, x: Questions, slot: np.ndarray, need: np.ndarray, same: bool):
        leaf = np.arange(page * FAN_OUT, min((page + 1) * FAN_OUT, len(self.leaves[0])))
        own = (self.leaves[0][leaf], self.leaves[1][leaf])
        low, high = intervals(x.vectors[anchors], own[0][:, 1:], own[1][:, 1:])
        label_open = self._open(own, x.labels[anchors], same)
        some = np.zeros(len(leaf), bool)
        for j in range(slot.shape[1]):
            there = slot[anchors, j] >= 0
            s = np.maximum(slot[anchors, j], 0)
            some |= (there[:, None] & label_open & (high >= need[s][:, None]) & (low <= x.high[s][:, None])).any(axis=0)
        rows = (leaf[some][:, None] * LEAF + np.arange(LEAF)).ravel()
        rows = rows[rows < len(self.ids)]
        self.scored += len(rows) * len(anchors)
        scores = x.vectors[anchors] @ self.q[rows].T
        fits = (self.labels[rows] == x.labels[anchors][:, None]) == same
        fits &= self.ids[rows] != x.ids[anchors][:, None]
        out = []
        for j in range(slot.shape[1]):
            s = slot[anchors, j]
            good = fits & (scores >= need[np.maximum(s, 0)][:, None]) & (scores <= x.high[np.maximum(s, 0)][:, None]) & (s >= 0)[:, None]
            a, r = np.nonzero(good)
            out.append((s[a], self.ids[rows[r]], scores[a, r]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

    @staticmethod
    def _ranked(parts: list[tuple], x: Questions, need: np.ndarray, k: int):
        question, ids, scores = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((ids, -scores, question))
        question, ids, scores = question[order], ids[order], scores[order]
        rank = np.arange(len(question)) - np.searchsorted(question, question)
        kept = rank < k
        need = need.copy()
        need[question[rank == k - 1]] = scores[rank == k - 1]
        return (question[kept], ids[kept], scores[kept]), need


# --- asking


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors (vec_id, label, dim, packed, asked: array of (tag, low, high)) in blocks."""
    for batch in batches:
        dims = batch.column(2).to_numpy()
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            for i in range(0, len(own), ANCHORS):
                part = batch.take(pa.array(own[i : i + ANCHORS]))
                asked = part.column(4)
                flat = asked.flatten()
                of = np.repeat(np.arange(len(part), dtype=np.int64), np.diff(asked.offsets.to_numpy()))
                numbers = [part.column(0).to_numpy(), part.column(1).to_numpy()]
                questions = [of, *(flat.field(c).to_numpy() for c in ("low", "high", "tag"))]
                raw = [numbers[0].tobytes(), numbers[1].tobytes(), b"".join(part.column(3).to_pylist()), *(np.ascontiguousarray(c).tobytes() for c in questions)]
                names = [c.split()[0] for c in BLOCKS.split(", ")]
                columns = [pa.array([int(dim)], pa.int32()), pa.array([len(part)], pa.int32()), *(pa.array([x], pa.binary()) for x in raw)]
                yield pa.RecordBatch.from_arrays(columns, names=names)


def _search(k: int, same: bool):
    """Of rows sorted by group and kind: a group's slabs make a tree, then blocks of anchors are answered from it."""

    def numbers(batch, name, row, kind):
        return np.frombuffer(batch.column(name)[row].as_buffer(), kind)

    def run(batches):
        group, slabs, tree = None, [], None
        for batch in batches:
            for row in range(batch.num_rows):
                dim, part, n = (batch.column(c)[row].as_py() for c in ("dim", "part", "n"))
                if (dim, part) != group:
                    group, slabs, tree = (dim, part), [], None
                ids, labels = numbers(batch, "ids", row, np.int64), numbers(batch, "labels", row, np.int32)
                vectors = numbers(batch, "packed", row, np.int32).reshape(n, dim)
                if not batch.column("kind")[row].as_py():
                    slabs.append((ids, labels, vectors))
                    continue
                if tree is None:
                    tree = Tree(*(np.concatenate(c) for c in zip(*slabs, strict=True)))
                    slabs = []
                more = [numbers(batch, c, row, np.int64) for c in ("of", "low", "high", "tags")]
                x = Questions(ids, labels, vectors.astype(np.float64), *more)
                question, found, scores = tree.search(x, k, same)
                columns = [x.ids[x.of[question]], x.tags[question], found, scores.astype(np.int64)]
                names = ["anchor_id", "tag", "id", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def searched(slabs: DataFrame, parts: int, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """The k best rows for each question of `anchors` (vec_id, label, dim, packed, asked), ranked from 1."""
    blocks = settle(anchors.select("vec_id", "label", "dim", "packed", "asked").mapInArrow(_blocks, BLOCKS))
    every = blocks.withColumns({"part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), "kind": F.lit(1)})
    held = slabs.withColumn("kind", F.lit(0)).unionByName(every, allowMissingColumns=True)
    own = slabs.select("dim", "part").distinct()  # groups that have slabs, at most `parts` per length of vectors
    held = held.join(F.broadcast(own), ["dim", "part"], "left_semi")
    dealt = held.repartition("dim", "part").sortWithinPartitions("dim", "part", "kind")
    with few_rows(slabs.sparkSession, 8):
        hits = settle(dealt.mapInArrow(_search(k, same), HITS))
    best = Window.partitionBy("anchor_id", "tag").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _asked(*questions: Column) -> Column:
    return F.array(*questions).cast("array<struct<tag:bigint,low:bigint,high:bigint>>").alias("asked")


def mined(embeddings: DataFrame, is_anchor: Column, label: Column | None = None, vector: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """Per anchor (rows of whom the condition over vec_id and label holds) and positive the first negatives: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score. `label` may replace the column."""
    own = embeddings.select("vec_id", (F.col("label") if label is None else label).alias("label"), F.col(vector).alias(vector))
    rows = whole_rows(own, vector)
    size = rows.agg(F.sum(F.col("dim").cast("long") * 4)).first()[0] or 0
    parts = max(-(-size // GROUP_BYTES), rows.sparkSession.sparkContext.defaultParallelism)
    slabs = packed_tree(rows, parts)
    anchors = rows.filter(F.col("vec_id").isNotNull() & is_anchor)
    far = 1 << 53
    everything = F.struct(F.lit(0).cast("long"), F.lit(-far).cast("long"), F.lit(far).cast("long"))
    near = settle(searched(slabs, parts, anchors.withColumn("asked", _asked(everything)), positives, same=True))
    # positives by their rank as tag: a question for each
    low, high = F.expr(f"(score * {LOW} + 99) div 100"), F.expr(f"score * {HIGH} div 100")
    question = F.struct(F.col("rank").cast("long").alias("tag"), low.alias("low"), high.alias("high"))
    asks = near.filter("score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(F.array_sort(F.collect_list(question)).alias("asked"))
    far_rows = searched(slabs, parts, anchors.join(asks, "vec_id"), negatives, same=False)
    names = near.select("anchor_id", F.col("rank").cast("long").alias("tag"), _id("positive_id"), F.col("score").alias("positive_score"))
    found = far_rows.select("anchor_id", "tag", F.col("rank"), _id("negative_id"), F.col("score").alias("negative_score"))
    return found.join(names, ["anchor_id", "tag"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _id(name: str) -> Column:
    return F.when(F.col("id") < int(NO_ID), F.col("id")).alias(name)


def mined_sql(vector: str = "embedding") -> str:
    """The query over `embeddings`, in SQL."""
    return rf"""
WITH rows AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform({vector}, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND {vector} IS NOT NULL AND len(list_filter({vector}, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN pairs USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= {NEGATIVES}"""
