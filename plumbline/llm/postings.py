"""A distributed positional inverted index of a corpus, and the passages of a benchmark found in it.

The index is sharded by document: a segment holds about two megabytes of texts, their words' postings (term, ascending
positions) and how many words each document has. Segments are written once to the shared folder and can be asked about any
benchmark. No row is shuffled, so neither a word that every document has nor a passage that a third of them share makes a
task larger than another.

Asking: of a window's terms the one with the shortest posting list in the segment names candidates, its positions less the
term's place in the window. Then the next rarest list is intersected with them, adjusted by its own place, and so on; what
is left are exact phrases. A proximity match has all distinct words of a window, in any order, within a run of `span` words
of one document; there too the rarest list names the candidates. Windows are asked for in blocks of `BLOCK` rows, the only
thing that goes to every task; answers of several blocks are united per document.

A word: a run of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] after lower-casing A-Z. A window: `n` consecutive words of an item; an
item of fewer, but not none, is one window. Words are told apart by two 64-bit hashes of their bytes.

Defined cases: text NULL has no words, in documents and in items. Rows of one document id are documents of their own. Items
with one id are one item with the windows of all; an id of NULL is named by the empty text. Equal windows of several items
hit for each of them. Without items nothing is hit. Columns other than the two that are read do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import few_rows, settle
from plumbline.llm.words import windows, words

#: Words of a window, and of the run within which all its words make a proximity match.
WINDOW = 10
SPAN = 12
#: Rows (window, item) that go to every task at once, about 200 bytes each.
BLOCK = 200_000
#: Candidates that a task holds at once.
CANDIDATES = 1 << 20

INDEX = "segment long, doc_ids array<long>, lengths array<int>, terms binary, checks binary, counts binary, positions binary"
ASKED = "item string, words int, terms binary, checks binary"
FOUND = "segment long, at int, doc_id long, n_words long, runs array<struct<from:int,to:int>>, items array<string>, near array<string>"
RUNS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


@dataclass
class Segment:
    """Postings of some documents. Position: a word's number in the segment; terms are ordered by hash, lists by position."""

    terms: np.ndarray
    checks: np.ndarray
    counts: np.ndarray
    positions: np.ndarray
    lengths: np.ndarray

    def __post_init__(self):
        self.begin = np.concatenate([[0], np.cumsum(self.counts, dtype=np.int64)])
        self.ends = np.cumsum(self.lengths, dtype=np.int64)
        self.size = int(self.ends[-1]) if len(self.ends) else 0
        #: all lists in one ascending array, to be searched at once
        self.keys = np.repeat(np.arange(len(self.terms), dtype=np.int64), self.counts) * (self.size + 1) + self.positions

    def places(self, terms: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Each term's number here, -1 if no document has it."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.searchsorted(self.terms, terms)
        out = np.full(len(terms), -1)
        for _ in range(2):  # two words of one first hash may stand side by side
            inside = np.minimum(at, len(self.terms) - 1)
            out = np.where((at < len(self.terms)) & (self.terms[inside] == terms) & (self.checks[inside] == checks), inside, out)
            at = at + 1
        return out

    def following(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """The first position of a term at or after another, or a number beyond all."""
        at = np.searchsorted(self.keys, term * (self.size + 1) + position)
        inside = np.minimum(at, len(self.keys) - 1)
        own = (at < len(self.keys)) & (at < self.begin[term + 1])
        return np.where(own, self.positions[inside], 2 * self.size + 1)


def segment(hashes: np.ndarray, checks: np.ndarray, lengths: np.ndarray) -> Segment:
    order = np.argsort(hashes, kind="stable")
    a, b = hashes[order], checks[order]
    first = np.concatenate([[True], a[1:] != a[:-1]])[: len(a)]
    if (~first[1:] & (b[1:] != b[:-1])).any():  # two words of one hash
        order = np.lexsort((checks, hashes))
        a, b = hashes[order], checks[order]
        first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    starts = np.flatnonzero(first)
    counts = np.diff(np.concatenate([starts, [len(a)]])).astype(np.int32)
    return Segment(a[starts], b[starts], counts, order.astype(np.int32), lengths.astype(np.int32))


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for w in words(batch.column(1), alphanumeric=True):
            s = segment(w.hashes(0), w.hashes(1), w.counts())
            ids = batch.column(0).slice(w.first, w.rows)
            offsets = pa.array([0, w.rows], pa.int32())
            packed = [pa.array([x.tobytes()], pa.binary()) for x in (s.terms, s.checks, s.counts, s.positions)]
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (ids, pa.array(s.lengths))]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists, *packed], names=["segment", "doc_ids", "lengths", "terms", "checks", "counts", "positions"])
            number += 1


def build(docs: DataFrame) -> DataFrame:
    """The index of (doc_id, text): one row per segment."""
    return settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_index, INDEX))


# --- what is asked


def _windows_of(n: int):
    def run(batches):
        for batch in batches:
            for w in words(batch.column(1), alphanumeric=True):
                lanes = [w.hashes(0), w.hashes(1)]
                begin = np.concatenate([[0], np.cumsum(w.counts())])
                for row in range(w.rows):
                    own = [x[begin[row] : begin[row + 1]] for x in lanes]
                    length = min(n, len(own[0]))
                    many = len(own[0]) - length + 1 if length else 0
                    for i in range(0, many, 10_000):
                        part = range(i, min(many, i + 10_000))
                        item = batch.column(0)[w.first + row].as_py() or ""
                        packed = [pa.array([x[j : j + length].tobytes() for j in part], pa.binary()) for x in own]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([item] * len(part)), pa.array([length] * len(part), pa.int32()), *packed], names=["item", "words", "terms", "checks"]
                        )

    return run


@dataclass
class Query:
    """Distinct windows of some items. `place`: numbers of a window's words in `terms`, -1 behind a short window's last."""

    terms: np.ndarray
    checks: np.ndarray
    place: np.ndarray
    length: np.ndarray
    first_item: np.ndarray
    items: np.ndarray
    names: list[str]


def _query(asked: pa.Table, n: int) -> Query:
    length = asked["words"].to_numpy()
    raw = [np.frombuffer(b"".join(x.ljust(8 * n, b"\0") for x in asked[c].to_pylist()), np.uint64).reshape(-1, n) for c in ("terms", "checks")]
    both = np.concatenate([length.astype(np.uint64)[:, None], *raw], axis=1)
    distinct, which = np.unique(both, axis=0, return_inverse=True)
    order = np.argsort(which.ravel(), kind="stable")
    names, number = np.unique(np.array(asked["item"].to_pylist(), dtype=object), return_inverse=True)
    length = distinct[:, 0].astype(np.int64)
    inside = np.arange(n) < length[:, None]
    pairs = np.stack([distinct[:, 1 : n + 1][inside], distinct[:, n + 1 :][inside]], axis=1)
    terms, place_of = np.unique(pairs, axis=0, return_inverse=True)
    place = np.full((len(distinct), n), -1)
    place[inside] = place_of.ravel()
    first_item = np.concatenate([[0], np.cumsum(np.bincount(which.ravel(), minlength=len(distinct)))])
    return Query(terms[:, 0].copy(), terms[:, 1].copy(), place, length, first_item, number.ravel()[order], names.tolist())


def _rarest_first(s: Segment, place: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of windows all of whose terms occur: their numbers, terms and the terms' places in the window, by ascending list."""
    there = place >= 0
    known = np.where(there, s.counts[place] if len(s.counts) else 0, np.iinfo(np.int32).max)
    alive = np.flatnonzero((length > 0) & (~(np.arange(place.shape[1]) < length[:, None]) | there).all(axis=1))
    order = np.argsort(known[alive], axis=1, kind="stable")
    return alive, np.take_along_axis(place[alive], order, axis=1), order


def _candidates(s: Segment, alive: np.ndarray, terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of `alive` with the positions of their rarest term, some at a time."""
    many = s.counts[terms[:, 0]].astype(np.int64)
    total = np.cumsum(many)
    i = 0
    while i < len(alive):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + CANDIDATES, "right")))
        rows = np.repeat(np.arange(i, j), many[i:j])
        within = np.arange(len(rows)) - np.repeat(np.cumsum(many[i:j]) - many[i:j], many[i:j])
        yield rows, s.positions[s.begin[terms[rows, 0]] + within].astype(np.int64)
        i = j


def phrases(s: Segment, q: Query, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows and the positions at which they stand, word for word."""
    alive, terms, places = _rarest_first(s, place, q.length)
    found = []
    for rows, position in _candidates(s, alive, terms) if len(alive) else ():
        start = position - places[rows, 0]
        end = start + q.length[alive[rows]] - 1
        doc = np.searchsorted(s.ends, np.maximum(start, 0), "right")
        good = (start >= 0) & (end < s.ends[np.minimum(doc, len(s.ends) - 1)])
        rows, start = rows[good], start[good]
        for j in range(1, terms.shape[1]):
            open_ = q.length[alive[rows]] > j
            term, at = terms[rows, j], start + places[rows, j]
            good = ~open_
            good[open_] = s.following(term[open_], at[open_]) == at[open_]
            rows, start = rows[good], start[good]
        found.append((alive[rows], start))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def proximity(s: Segment, q: Query, place: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows and documents of which some run of `span` words has all the window's words."""
    alive, terms, _ = _rarest_first(s, place, q.length)
    found = []
    for rows, position in _candidates(s, alive, terms) if len(alive) else ():
        doc = np.searchsorted(s.ends, position, "right")
        end = s.ends[doc]
        begin = end - s.lengths[doc]
        low = np.maximum(begin, position - span + 1)
        for j in range(1, terms.shape[1]):  # each word near enough by itself
            open_ = q.length[alive[rows]] > j
            good = ~open_
            good[open_] = s.following(terms[rows[open_], j], low[open_]) < np.minimum(end, position + span)[open_]
            rows, position, doc, end, low = (x[good] for x in (rows, position, doc, end, low))
        for shift in range(span):  # all of them in one run that begins here
            if not len(rows):
                break
            at = low + shift
            within = at <= position
            for j in range(1, terms.shape[1]):
                open_ = within & (q.length[alive[rows]] > j)
                within[open_] = s.following(terms[rows[open_], j], at[open_]) < np.minimum(end, at + span)[open_]
            found.append((alive[rows[within]], doc[within]))
            rows, position, doc, end, low = (x[~within] for x in (rows, position, doc, end, low))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def _named(window: np.ndarray, doc: np.ndarray, q: Query, docs: int) -> pa.ListArray:
    """The items of the windows found, per document."""
    pairs = np.unique(doc.astype(np.int64) * len(q.length) + window)
    window, doc = pairs % max(1, len(q.length)), pairs // max(1, len(q.length))
    many = (q.first_item[window + 1] - q.first_item[window]).astype(np.int64)
    within = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    item = q.items[np.repeat(q.first_item[window], many) + within]
    pairs = np.unique(np.repeat(doc, many) * max(1, len(q.names)) + item)
    item, doc = pairs % max(1, len(q.names)), pairs // max(1, len(q.names))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=docs))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(q.names, pa.string()).take(pa.array(item)))


def _runs(window: np.ndarray, start: np.ndarray, q: Query, s: Segment) -> pa.ListArray:
    """Runs of words that are hit, per document, counted from its first word."""
    cover = np.zeros(s.size + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + q.length[window], -1)
    hit = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
    edge = np.concatenate([[0], s.ends[:-1]])[s.lengths > 0] if len(s.ends) else np.zeros(0, np.int64)
    opens = np.flatnonzero(hit[1:-1] & (~hit[:-2] | np.isin(np.arange(s.size), edge)))  # a run ends where its document does
    closes = np.flatnonzero(hit[1:-1] & (~hit[2:] | np.isin(np.arange(s.size) + 1, edge))) + 1
    doc = np.searchsorted(s.ends, opens, "right")
    first = (s.ends - s.lengths)[doc]
    runs = pa.StructArray.from_arrays([pa.array((x - first).astype(np.int32)) for x in (opens, closes)], fields=list(RUNS.value_type))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(s.lengths)))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), runs)


def _ask(q: Query, span: int | None):
    def run(batches):
        for batch in batches:
            number, ids, lengths, *packed = batch.columns
            for row in range(batch.num_rows):
                types = (np.uint64, np.uint64, np.int32, np.int32)
                arrays = [np.frombuffer(x[row].as_buffer(), t) for x, t in zip(packed, types, strict=True)]
                s = Segment(*arrays, lengths[row].values.to_numpy())
                where = s.places(q.terms, q.checks)
                place = np.where(q.place >= 0, where[q.place] if len(where) else -1, -1)
                window, start = phrases(s, q, place)
                docs = len(s.lengths)
                items = _named(window, np.searchsorted(s.ends, start, "right"), q, docs)
                near = items if span is None else _named(*proximity(s, q, place, span), q, docs)
                columns = [pa.array(np.full(docs, number[row].as_py())), pa.array(np.arange(docs, dtype=np.int32)), ids[row].values, pa.array(s.lengths.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*columns, _runs(window, start, q, s), items, near], names=["segment", "at", "doc_id", "n_words", "runs", "items", "near"])

    return run


def ask(index: DataFrame, items: DataFrame, n: int = WINDOW, span: int | None = SPAN) -> DataFrame:
    """Per document of the index: n_words, the runs of its words that stand in an occurrence of a window (`runs`, in ascending
    order, may touch), the ids of items with a window that occurs (`items`) and of items with a proximity match (`near`,
    equal to `items` without `span`)."""
    asked = items.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(_windows_of(n), ASKED)
    asked = settle(asked.distinct())
    blocks = max(1, -(-asked.count() // BLOCK))
    found = None
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("item", "terms", "checks"), F.lit(blocks)) == block)
        with few_rows(index.sparkSession, 8):  # segments
            part = settle(index.mapInArrow(_ask(_query(own.toArrow(), n), span), FOUND))
        found = part if found is None else found.union(part)
    if blocks > 1:
        one = {c: F.first(c).alias(c) for c in ("doc_id", "n_words")}
        many = {c: F.flatten(F.collect_list(c)) for c in ("runs", "items", "near")}
        found = found.groupBy("segment", "at").agg(*one.values(), F.array_sort(many["runs"]).alias("runs"), *(F.array_distinct(many[c]).alias(c) for c in ("items", "near")))
    return found.drop("segment", "at")


def decontaminated(docs: DataFrame, items: DataFrame, n: int = WINDOW, span: int | None = SPAN) -> DataFrame:
    """Per row of (doc_id, text): n_words, n_hit, n_items, items_sha256 (of the ids in the order of texts, joined by commas),
    contaminated, n_near_items (items with a proximity match, those with an exact one included)."""
    found = ask(build(docs), items, n, span)
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))

    def more(acc, run):
        end = F.greatest(acc["end"], run["to"])
        return F.struct(end.alias("end"), (acc["total"] + F.greatest(F.lit(0), run["to"] - F.greatest(run["from"], acc["end"]))).alias("total"))

    hit = F.aggregate("runs", begin, more, lambda acc: acc["total"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near_items"),
    )


def decontaminated_sql(n: int = WINDOW, span: int = SPAN) -> str:
    """`decontaminated` over `documents` and `benchmark`, in SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    listed = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {listed} AS list FROM documents),
tokens AS MATERIALIZED (SELECT row, unnest(list) AS word, generate_subscripts(list, 1) AS pos FROM docs),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {listed} AS list FROM benchmark),
cut AS (SELECT item, list, least({n}, len(list)) AS size, unnest(range(1, len(list) - least({n}, len(list)) + 2)) AS i FROM items WHERE len(list) > 0),
asked AS MATERIALIZED (SELECT DISTINCT item, list_slice(list, i, i + size - 1) AS own, size FROM cut),
distinct_windows AS MATERIALIZED (SELECT row_number() OVER () AS w, own, size FROM (SELECT DISTINCT own, size FROM asked)),
found AS MATERIALIZED (
  SELECT t.row, t.pos, w.w, w.own, w.size FROM tokens t JOIN distinct_windows w ON t.word = w.own[1] JOIN docs d USING (row)
  WHERE list_slice(d.list, t.pos, t.pos + w.size - 1) = w.own),
hit AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(pos, pos + size)) AS p FROM found) GROUP BY row),
named AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT f.row, a.item FROM found f JOIN asked a ON a.own = f.own) GROUP BY row),
terms AS (SELECT DISTINCT w, unnest(own) AS word FROM distinct_windows),
needs AS (SELECT w, count(*) AS n FROM terms GROUP BY w),
whole AS (
  SELECT row, w FROM (SELECT DISTINCT row, word FROM tokens) JOIN terms USING (word) JOIN needs USING (w) GROUP BY row, w, n HAVING count(*) = n),
runs AS (
  SELECT t.row, m.w, count(DISTINCT t.word) OVER (PARTITION BY t.row, m.w ORDER BY t.pos RANGE BETWEEN CURRENT ROW AND {span - 1} FOLLOWING) AS n
  FROM whole JOIN terms m USING (w) JOIN tokens t USING (row, word)),
near AS (
  SELECT row, count(DISTINCT item) AS n FROM (SELECT DISTINCT r.row, r.w FROM runs r JOIN needs USING (w, n)) JOIN distinct_windows USING (w)
  JOIN asked a USING (own) GROUP BY row)
SELECT doc_id, CAST(len(list) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(near.n, 0) AS n_near_items
FROM docs LEFT JOIN hit USING (row) LEFT JOIN named USING (row) LEFT JOIN near USING (row)"""
