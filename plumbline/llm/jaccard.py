"""Near duplicates: a Jaccard join of word n-grams by vertical partitioning.

A document's set is its distinct word n-grams, ordered by their hashes, the same for all documents. The order is cut into
fragments, one for each task; a task has the parts of all sets that fall into its fragment, counts for each pair what they
share there, and the partial overlaps are summed per pair. Only the beginning of each set is dealt out: similar sets share
so much that some of it lies there (see `emitted`). A pair whose summed overlap can no longer reach the threshold is
dropped; what remains is counted exactly on whole sets.

Documents with the same set are one; only sets are compared. An n-gram that more than `COMMON` sets share is common. Pairs
that share n-grams which are not common are all counted. For common ones every set is paired with one pivot only, which
joins the copies of a large group to one component without naming their pairs. What that may miss, two sets of different
components that share many common n-grams and too few others, is found in `_by_common` by blocks. A task of the scan does the
same among its own documents first, so that an n-gram of a third of all documents arrives a few times per task.

No link between different sets is lost; links inside a component that is found already are not needed for its label.

Defined cases: text NULL or without words has the empty set, linked with nothing, its own component. With fewer words than
n, the whole sequence is the only element. An id of NULL is the largest; a component of such rows only has label NULL.
Sets are told apart by 64-bit hashes and their size, n-grams by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import settle
from plumbline.llm.components import components
from plumbline.llm.words import Words, mix, windows, words

N = 5
#: Sets that share an n-gram before it is common.
COMMON = 32
#: n-grams that a task of the scan gathers before it looks for common ones.
BLOCK = 1_000_000
EXTRA = 80

MEMBERS = "doc_id long, key long, sid long, n long"
DEALT = "part long, gram long, sid long, n int, weight int, pivot long"
COUNTED = "a long, b long, na int, nb int, rare int, starred int, gram long"
SETS = "sid long, grams array<long>"
LINKS = "a long, b long"
#: Elements of the sets in a block, sets in a block, and n-grams that are multiplied at a time: tens of megabytes for a task.
BLOCK_GRAMS, BLOCK_SETS, FRAGMENT = 100_000, 500, 2048

# A pair is similar when 100 * |x & y| >= 75 * |x | y|, that is 7 * |x & y| >= 3 * (|x| + |y|). Then at most a fourth of
# either set is not shared, and neither is smaller than 3/4 of the other.


def emitted(n, extra: int):
    """Of a set of n, so many first elements are dealt out. At least `spare(n)` of them are in any similar set."""
    return np.minimum(n, n // 4 + 1 + np.maximum(extra, n // 20))


def emitted_column(n: Column) -> Column:
    return F.least(n, F.floor(n / 4) + 1 + F.greatest(F.lit(EXTRA), F.floor(n / 20))).cast("long")


def spare_column(n: Column) -> Column:
    """So many elements at least that two similar sets share among those that both deal out, n being the size of the one whose
    last dealt element comes first in the order."""
    return emitted_column(n) - F.floor(n / 4)


def sets(w: Words, n: int = N) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and elements, in order of both, of the words' sets; and the sets' sizes."""
    hashes, count = w.hashes(), w.counts()
    grams, at = windows(hashes, w.doc, n)
    doc = w.doc[at]
    begin = np.cumsum(count) - count
    for size in range(1, n):
        short = np.flatnonzero(count == size)
        if len(short):
            whole = np.full(len(short), size, np.uint64)
            for i in range(size):
                whole = mix(whole * np.uint64(0x9FB21C651E98DF25) + hashes[begin[short] + i])
            grams, doc = np.concatenate([grams, whole]), np.concatenate([doc, short])
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    once = np.concatenate([[True], (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])])[: len(doc)]
    grams, doc = grams[once], doc[once]
    return doc, grams, np.bincount(doc, minlength=w.rows)


def _sids(doc: np.ndarray, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams + np.uint64(1)), dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return mix((total[ends] - total[ends - sizes]) ^ (sizes.astype(np.uint64) << np.uint64(32))).view(np.int64)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in words(batch.column(2), lower=True):
            doc, grams, sizes = sets(w)
            sid = _sids(doc, grams, sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(w.first, w.rows), batch.column(1).slice(w.first, w.rows), pa.array(sid, mask=sizes == 0), pa.array(sizes)],
                names=["doc_id", "key", "sid", "n"],
            )


def _rows_of(w: Words, limit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every distinct set of the words' documents: the first `limit(n)` elements, with sid and n."""
    doc, grams, sizes = sets(w)
    sid = _sids(doc, grams, sizes)
    _, own = np.unique(sid, return_index=True)
    chosen = np.zeros(w.rows, bool)
    chosen[own] = True
    begin = np.cumsum(sizes) - sizes
    good = chosen[doc] & (np.arange(len(doc)) - begin[doc] < limit(sizes)[doc])
    return grams[good], sid[doc[good]], sizes[doc[good]]


def _deal(extra: int, common: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for w in words(batch.column(0), lower=True):
                parts.append(_rows_of(w, lambda n: emitted(n, extra)))
                size += len(parts[-1][0])
                if size >= block:
                    yield from _block(parts, common)
                    parts, size = [], 0
        if size:
            yield from _block(parts, common)

    return run


def _ordered(gram: np.ndarray, sid: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """In order of gram and sid, each pair once (the one with the largest weight, if the first of `more` is a weight)."""
    order = np.lexsort((-more[0].astype(np.int64), sid, gram)) if more else np.lexsort((sid, gram))
    gram, sid = gram[order], sid[order]
    once = np.concatenate([[True], (gram[1:] != gram[:-1]) | (sid[1:] != sid[:-1])])[: len(gram)]
    return gram[once], sid[once], *(x[order][once] for x in more)


def _groups(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each group's first row, and each row's group, of an ordered column."""
    first = np.concatenate([[True], gram[1:] != gram[:-1]])[: len(gram)]
    return np.flatnonzero(first), np.cumsum(first) - 1


def _block(parts: list, most: int) -> Iterator[pa.RecordBatch]:
    """Rows to deal: those of common n-grams only name their pivot, and one row with the group's weight goes to its fragment."""
    gram, sid, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    n = n.astype(np.int32)
    gram, sid, n = _ordered(gram, sid, n)
    starts, group = _groups(gram)
    sizes = np.diff(np.concatenate([starts, [len(gram)]]))
    common = (sizes > most)[group]
    pivot = sid[starts][group]
    part = np.where(common, mix(sid.view(np.uint64)), gram).view(np.int64)
    weight = np.where(common, 0, 1)
    tell = starts[sizes > most]
    columns = [
        np.concatenate([part, gram[tell].view(np.int64)]),
        np.concatenate([gram, gram[tell]]).view(np.int64),
        np.concatenate([sid, sid[tell]]),
        np.concatenate([n, n[tell]]),
        np.concatenate([weight, sizes[sizes > most]]).astype(np.int32),
        np.concatenate([pivot, sid[tell]]),
    ]
    for i in range(0, len(columns[0]), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 100_000]) for c in columns], names=["part", "gram", "sid", "n", "weight", "pivot"])


class _Pairs:
    """Counts pairs, added up now and then."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, a, b, na, nb, starred: bool) -> None:
        swap = a > b
        a, b, na, nb = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)
        good = (a != b) & (4 * na >= 3 * nb) & (4 * nb >= 3 * na)
        a, b, na, nb = a[good], b[good], na[good], nb[good]
        one = np.ones(len(a), np.int32)
        self.parts.append((a, b, na, nb, one * (not starred), one * starred))
        self.size += len(a)
        if self.size > 2_000_000:
            self.sum()

    def sum(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int32, np.int32, np.int32, np.int32))
        a, b, na, nb, rare, starred = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((b, a))
        a, b, na, nb, rare, starred = (x[order] for x in (a, b, na, nb, rare, starred))
        starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(a)])
        add = lambda x: np.add.reduceat(x, starts).astype(np.int32) if len(starts) else x
        self.parts = [(a[starts], b[starts], na[starts], nb[starts], add(rare), add(starred))]
        self.size = len(starts)
        return self.parts[0]


def _count(most: int):
    """Partial overlaps of all pairs in a fragment, and which sets have which common n-grams."""
    return lambda batches: _counted(batches, most)


def _counted(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    got = [[c.to_numpy(zero_copy_only=False) for c in b.columns[1:]] for b in batches]
    if not got:
        return
    gram, sid, n, weight, pivot = (np.concatenate(x) for x in zip(*got, strict=True))
    del got
    pairs = _Pairs()
    passing = weight == 0
    marks = [(sid[passing], n[passing], gram[passing], pivot[passing])]
    gram, sid, weight, n = _ordered(gram[~passing], sid[~passing], weight[~passing], n[~passing])
    starts, group = _groups(gram)
    total = np.add.reduceat(weight, starts) if len(starts) else np.zeros(0, np.int64)
    common = total > most
    first = starts[group] if len(starts) else group
    is_common = common[group] if len(starts) else np.zeros(0, bool)
    pairs.add(sid[is_common], sid[first[is_common]], n[is_common], n[first[is_common]], True)
    own = is_common & (weight == 1)
    marks.append((sid[own], n[own], gram[own], sid[own]))
    rare_gram, rare_sid, rare_n = gram[~is_common], sid[~is_common], n[~is_common]
    for d in range(1, most):
        at = np.flatnonzero(rare_gram[d:] == rare_gram[:-d]) if len(rare_gram) > d else np.zeros(0, np.int64)
        if not len(at):
            break
        pairs.add(rare_sid[at], rare_sid[at + d], rare_n[at], rare_n[at + d], False)
    columns = pairs.sum()
    none = lambda k, t: pa.nulls(k, t)
    names = ["a", "b", "na", "nb", "rare", "starred", "gram"]
    for i in range(0, len(columns[0]), 100_000):
        part = [pa.array(c[i : i + 100_000]) for c in columns]
        yield pa.RecordBatch.from_arrays([*part, none(len(part[0]), pa.int64())], names=names)
    # a mark: a set that has a common n-gram, and the pivot of its task's scan, whose size is not known here
    a, na, g, p = (np.concatenate(x) for x in zip(*marks, strict=True))
    for i in range(0, len(a), 100_000):
        s = slice(i, i + 100_000)
        k = len(a[s])
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[s]), pa.array(p[s]), pa.array(na[s]), *(none(k, pa.int32()) for _ in range(3)), pa.array(g[s])], names=names
        )


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in words(batch.column(0), lower=True):
            doc, grams, sizes = sets(w)
            sid = _sids(doc, grams, sizes)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(sid), pa.ListArray.from_arrays(ends, pa.array(grams.view(np.int64)))], names=["sid", "grams"])


def _block_links(rows: pa.Table) -> pa.Table:
    """Of the sets of two blocks (or of one, twice): links that join all sets which similar pairs of two labels connect."""
    i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
    block, sid, label = (rows[c].to_numpy() for c in ("block", "sid", "label"))
    lists = rows["grams"].combine_chunks()
    n = np.diff(lists.offsets.to_numpy())
    size = len(n)
    grams, owner = lists.flatten().to_numpy(), np.repeat(np.arange(size), n)
    _, gram, often = np.unique(grams, return_inverse=True, return_counts=True)
    order = np.argsort(gram, kind="stable")
    order = order[often[gram[order]] > 1]
    gram, owner = gram[order], owner[order]
    edge = np.concatenate([[True], gram[1:] != gram[:-1]])[: len(gram)]
    column = np.cumsum(edge) - 1
    shared = np.zeros((size, size), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, FRAGMENT):
        a, b = np.searchsorted(column, [first, first + FRAGMENT])
        part = np.zeros((size, FRAGMENT), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        shared += part @ part.T
    least = (3 * n).astype(np.float32)
    near = 7 * shared >= least[:, None] + least[None, :]
    near &= label[:, None] != label[None, :]
    if i != j:
        near &= block[:, None] != block[None, :]
    links = []
    left = near.any(1)
    while left.any():
        front = np.flatnonzero(left)[:1]
        left[front] = False
        while len(front):
            reach = near[front] & left
            found = np.flatnonzero(reach.any(0))
            links.append((sid[front[reach[:, found].argmax(0)]], sid[found]))
            left[found] = False
            front = found
    a, b = (np.concatenate(x) for x in zip(*links, strict=True)) if links else (np.zeros(0, np.int64),) * 2
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _similar(shared: Column) -> Column:
    return 7 * shared >= 3 * (F.col("na") + F.col("nb"))


class NearDuplicates:
    """The join, and its results: `members` (doc_id, key, sid, n) and `labels` (node, label) of sets that are linked."""

    def __init__(self, docs: DataFrame):
        self.rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
        self.members = settle(self.rows.mapInArrow(_members, MEMBERS))
        dealt = docs.select("text").mapInArrow(_deal(EXTRA, COMMON, BLOCK), DEALT).repartition("part")
        counted = settle(dealt.mapInArrow(_count(COMMON), COUNTED))
        marks = counted.filter("gram is not null").select(F.col("a").alias("sid"), F.col("na").alias("n"), "gram", F.col("b").alias("pivot"))
        commons = marks.groupBy("sid", "gram").agg(F.first("n").alias("n"), F.min("pivot").alias("pivot"))
        self.marks = settle(commons, light=True)
        links = self._checked(self._candidates(counted))
        labels = components(links)
        more = self._by_common(labels)
        if more is not None:
            links = links.union(more)
            labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more))
        self.links, self.labels = links, labels

    def _candidates(self, counted: DataFrame) -> DataFrame:
        """Pairs whose overlap may reach the threshold."""
        stars = self.marks.filter("sid <> pivot").groupBy(F.least("sid", "pivot").alias("a"), F.greatest("sid", "pivot").alias("b"))
        stars = stars.agg(F.lit(0).alias("rare"), F.count(F.lit(1)).alias("starred"))
        pairs = counted.filter("gram is null").select("a", "b", "rare", "starred")
        pairs = pairs.union(stars).groupBy("a", "b").agg(F.sum("rare").alias("rare"), F.sum("starred").alias("starred"))
        info = self.members.filter("sid is not null").groupBy("sid").agg(F.first("n").alias("n"))
        common = self.marks.groupBy("sid").agg(F.count(F.lit(1)).alias("common"))
        info = info.join(common, "sid", "left").na.fill(0, ["common"])
        # elements that were not counted: not dealt out, or common
        info = info.select("sid", "n", (F.col("n") - emitted_column(F.col("n")) + F.col("common")).alias("unseen"))
        info = settle(info, light=True)
        for side in ("a", "b"):
            own = info.select(F.col("sid").alias("of"), F.col("n").alias(f"n{side}"), F.col("unseen").alias(f"unseen_{side}"))
            pairs = pairs.join(own, F.col(side) == F.col("of")).drop("of")
        sized = (4 * F.col("na") >= 3 * F.col("nb")) & (4 * F.col("nb") >= 3 * F.col("na"))
        possible = (F.col("rare") > 0) & _similar(F.col("rare") + F.greatest("unseen_a", "unseen_b"))
        # pairs with a pivot are worth a look if they share half of what the smaller one deals out
        worth = (F.col("starred") > 0) & (2 * (F.col("rare") + F.col("starred")) >= F.least(emitted_column(F.col("na")), emitted_column(F.col("nb"))))
        return settle(pairs.filter(sized & (possible | worth)).select("a", "b", "na", "nb"), light=True)

    def _whole(self, sids: DataFrame) -> DataFrame:
        """The whole sets of some (sid), from one document of each."""
        keys = self.members.groupBy("sid").agg(F.min("key").alias("of")).join(sids, "sid", "left_semi").select("of")
        rows = self.rows.join(settle(keys, light=True), F.col("key") == F.col("of"), "left_semi").dropDuplicates(["key"])
        return settle(rows.select("text").mapInArrow(_whole_sets, SETS))

    def _checked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b, na, nb) that are similar, by whole sets."""
        whole = self._whole(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct())
        left = whole.select(F.col("sid").alias("a_of"), F.col("grams").alias("a_grams"))
        right = whole.select(F.col("sid").alias("b_of"), F.col("grams").alias("b_grams"))
        both = pairs.join(left, F.col("a") == F.col("a_of")).join(right, F.col("b") == F.col("b_of"))
        similar = both.filter(_similar(F.size(F.array_intersect("a_grams", "b_grams")))).select("a", "b")
        return settle(similar.repartition("a", "b"), light=True)  # the sets are compared by as many tasks as ever

    def _by_common(self, labels: DataFrame) -> DataFrame | None:
        """Links between components whose sets share common n-grams only, among those dealt out; None if no two sets share
        that many.

        An n-gram's pivot is the smallest set that has it, so sets that share many n-grams share a pivot. A set joins the
        groups of its pivots, smallest first, but for those that together have fewer of its n-grams than it must share. A
        group is cut into blocks by size, and each pair of blocks is one task that multiplies their sets, fragment by
        fragment, and names the links of a spanning forest only."""
        least = spare_column(F.ceil(F.col("n") * 3 / 4).cast("long"))
        heavy = self.marks.groupBy("sid").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("common"), F.first(least).alias("need"))
        heavy = heavy.filter("common >= need").join(labels.withColumnRenamed("node", "sid"), "sid", "left")
        heavy = heavy.select("sid", "n", "need", F.coalesce("label", "sid").alias("label"))
        rows = settle(self.marks.select("sid", "gram").join(heavy, "sid"), light=True)
        pivots = settle(rows.groupBy("gram").agg(F.min("sid").alias("pivot")), light=True)  # so that AQE can split the join
        own = rows.join(pivots, "gram").groupBy("pivot", "sid", "n", "need", "label").agg(F.count(F.lit(1)).alias("grams"))
        own = settle(own, light=True)
        groups = settle(own.groupBy("pivot").agg(F.count(F.lit(1)).alias("sets"), F.min("label").alias("lo"), F.max("label").alias("hi")), light=True)
        onward = Window.partitionBy("sid").orderBy("sets", "pivot").rowsBetween(0, Window.unboundedFollowing)
        own = own.join(groups, "pivot").withColumn("onward", F.sum("grams").over(onward)).filter("onward >= need and lo < hi")
        own = settle(own.select("pivot", "sid", "n", "label"), light=True)
        if own.isEmpty():
            return None
        enough = F.greatest(F.ceil(F.sum("n") / BLOCK_GRAMS), F.ceil(F.count(F.lit(1)) / BLOCK_SETS))
        blocks = own.groupBy("pivot").agg(enough.cast("int").alias("blocks"))
        dealt = own.join(blocks, "pivot").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("pivot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "sid", "label")
        dealt = dealt.join(self._whole(own.select("sid").distinct()), "sid")
        return settle(dealt.groupBy("pivot", "i", "j").applyInArrow(_block_links, LINKS))

    def documents(self) -> DataFrame:
        """Per row: doc_id, n_shingles, component_id, and its place in its component (0: the smallest doc_id)."""
        rows = self.members.join(self.labels, F.col("sid") == F.col("node"), "left").withColumn("label", F.coalesce("label", "sid"))
        rows = settle(rows.select("doc_id", "key", "sid", "n", "label"), light=True)
        least = rows.filter("sid is not null").groupBy(F.col("label").alias("of")).agg(F.min("doc_id").alias("least"))
        least = settle(least, light=True)
        rows = rows.join(least, F.col("label") == F.col("of"), "left")
        component = F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("least"))
        return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "key", "label")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_shingles, component_id."""
    return NearDuplicates(docs).documents().select("doc_id", "n_shingles", "component_id")


def near_duplicates_sql(n: int = N) -> str:
    """The same over `documents` in SQL, with all pairs and all paths."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x20\x09-\x0D]+') AS list FROM documents),
each AS (SELECT doc_id, len(list) AS words, unnest(list) AS word, generate_subscripts(list, 1) AS pos FROM listed),
grams AS (
  SELECT doc_id, words, string_agg(word, ' ') OVER w AS gram, count(*) OVER w AS n FROM each
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)),
sets AS MATERIALIZED (SELECT DISTINCT doc_id, gram FROM grams WHERE n = {n} OR n = words),
sizes AS (SELECT doc_id, count(*) AS size FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM sets a JOIN sets b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT x, y FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * shared >= 75 * (s.size + t.size - shared)),
steps AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sizes UNION SELECT r.x, s.y FROM reach r JOIN steps s ON r.y = s.x)
SELECT d.doc_id, coalesce(s.size, 0) AS n_shingles, coalesce(min(r.y), d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id, s.size"""


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of every component the row with the smallest doc_id, and of equal ones any, with all columns; rows with the empty set
    all stay."""
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = NearDuplicates(docs.select("doc_id", "text")).documents()
    last = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    first = rows.filter("label is not null").groupBy("label").agg(F.min(F.struct(last, "key")).alias("least")).select("least.key")
    stay = first.withColumn("bare", F.lit(False)).union(rows.filter("label is null").select("key", F.lit(True)).distinct())
    stay = settle(stay.withColumnRenamed("key", "of"), light=True)
    kept = work.withColumn("key", F.xxhash64("doc.doc_id", "doc.text")).join(stay, F.col("key") == F.col("of"))
    turn = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    kept = kept.withColumn("turn", turn).filter("bare or turn = 1")
    return kept.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
