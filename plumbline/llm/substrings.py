"""Substring deduplication by level-wise doubling.

A window of words that repeats has halves that repeat. So windows are looked for at half the length first, and only where
they repeat are they extended to twice that; then again, until no candidate survives or the longest length asked for is
reached.

At the first level it is enough to look at anchors: of the short windows inside every window of the least length, the one
with the smallest hash. Equal windows have equal anchors, so none is lost, and about a quarter of all positions are asked
for. From then on a level asks for the windows at which the level before found repeats. From four times the least length on,
positions come back with their windows' hashes, and a window of twice a length is named by those of its halves: the
texts are read for four levels, however many there are.

Asking means: hashes go to the bucket that their value names and come back if another document has them. Tasks answer among
their own documents first: of a window that many of them share only the smallest document asks, so a passage that a
third of all documents hold arrives once per task and block of windows. What is asked and answered travels as arrays, a row
for each block and bucket, and is sorted by numpy.

A window is removed from a document if it also starts in one with a smaller id. What is longer than the least length removes
no further word; the levels tell how long a passage is shared. Defined cases: text NULL has no words. An id of NULL is the
largest. Rows with the same id do not remove each other's words; those with the same id and text are treated alike. Windows
are told apart by 96 bits, a hash of 64 and a check of 32 that follows from other hashes of their words. Anchors, which only
say where to look, are asked for by 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import forget, settle
from plumbline.llm.words import Words, mix, windows, words

MIN_WORDS = 13
#: Windows that a task gathers before it answers among its own documents.
BLOCK = 1_000_000
#: Windows for a bucket, as long as there are no more buckets than shuffle partitions; and how many times the least length a
#: window has from which on it is named by its halves.
PER_BUCKET, NAMED_FROM = 32_000, 4
ASK, MANY, KNOWN = 0, 1, 2
#: Arrays of hashes, keys, ids (k), positions times four and one of the kinds above (what), and checks.
ASKED = "bucket int, hashes binary, keys binary, ks binary, whats binary, checks binary"
KINDS = (np.uint64, np.int64, np.int64, np.int32, np.int32)
ANSWERED = "bucket int, keys array<long>, ks array<long>, counts array<int>, found array<long>, hashes array<long>, checks array<int>"
MERGED = "key long, k long, found array<long>, hashes array<long>, checks array<int>"


def anchors(hashes: np.ndarray, doc: np.ndarray, length: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window of `least` words: its first word's index, and the index and hash of its anchor of `length` words."""
    short, at = windows(hashes, doc, length)
    full = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
    full[at] = short
    n = len(hashes) - least + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    whole = np.flatnonzero(doc[:n] == doc[least - 1 :])
    best, place = full[:n].copy(), np.arange(n)
    for i in range(1, least - length + 1):
        lower = full[i : n + i] < best
        best[lower] = full[i : n + i][lower]
        place[lower] = np.flatnonzero(lower) + i
    return whole, place[whole], best[whole]


def _bucket(x: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """The number of each value's bucket."""
    return (mix(x.view(np.uint64)) % np.uint64(len(buckets))).astype(np.int16 if len(buckets) < 1 << 15 else np.int64)


def bucket_labels(spark: SparkSession, asked: int | None = None) -> np.ndarray:
    """Labels of as many buckets as there are shuffle partitions, or fewer for few windows; Spark's hash deals each of them to
    a partition of its own."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = parts if asked is None else min(parts, max(1, -(-asked // PER_BUCKET)))
    label = F.col("id").cast("int")
    tried = spark.range(24 * parts).select(label.alias("label"), F.pmod(F.hash(label), F.lit(parts)).alias("part"))
    found = tried.groupBy("part").agg(F.min("label").alias("label")).collect()  # a row for each partition
    return np.sort(np.array([r["label"] for r in found], np.int32))[:wanted]


class _Asker:
    """Gathers what a task asks for, answers what its own documents can, and passes the rest on."""

    def __init__(self, by_position: bool, block: int, buckets: np.ndarray):
        self.by_position, self.block, self.buckets = by_position, block, buckets
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, key: np.ndarray, k: np.ndarray, pos: np.ndarray, hashes: np.ndarray, check: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        self.parts.append((key, k, pos.astype(np.int32), hashes, np.zeros(len(key), np.int32) if check is None else check))
        self.size += len(key)
        if self.size >= self.block:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        key, k, pos, hashes, check = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        order, starts, group = _groups(hashes, check)
        own = k[order]
        least = np.minimum.reduceat(own, starts)
        many = least != np.maximum.reduceat(own, starts)  # held by two documents here
        kind = np.empty(len(key), np.int32)
        if self.by_position:  # the smallest document must still learn of a smaller one, but knows that its window repeats
            kind[order] = np.where(many[group], np.where(own == least[group], MANY, KNOWN), ASK)
            rows = np.arange(len(key))
        else:  # one row tells the others that the window repeats
            kind[order] = np.where(many[group], KNOWN, ASK)
            rows = np.concatenate([np.arange(len(key)), order[starts[many]]])
            kind = np.concatenate([kind, np.full(int(many.sum()), MANY, np.int32)])
        # what is known goes back to its document's bucket; rows stay in the order of documents, which makes them small
        bucket = _bucket(np.where(kind == KNOWN, key[rows].view(np.uint64), hashes[rows]), self.buckets)
        by_bucket = np.argsort(bucket, kind="stable")
        rows, bucket = rows[by_bucket], bucket[by_bucket]
        what = pos[rows] * 4 + kind[by_bucket]
        columns = (hashes[rows], key[rows], k[rows], what.astype(np.int32), check[rows] if self.by_position else np.zeros(0, np.int32))
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        for i, j in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
            raw = [pa.array([c[i:j].tobytes()], pa.binary()) for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array([int(self.buckets[bucket[i]])], pa.int32()), *raw], names=["bucket", "hashes", "keys", "ks", "whats", "checks"])


def _groups(hashes: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by hash and check, where in it each group of equal ones begins, and each row's group."""
    order = np.argsort(hashes)
    ordered, checks = hashes[order], check[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)]
    if (~first[1:] & (checks[1:] != checks[:-1])).any():  # two windows of one hash
        order = np.lexsort((check, hashes))
        ordered, checks = hashes[order], check[order]
        first = np.concatenate([[True], (ordered[1:] != ordered[:-1]) | (checks[1:] != checks[:-1])])
    return order, np.flatnonzero(first), np.cumsum(first) - 1


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Index of each run's first row of a column in which equal values stand together."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])


def _answer(by_position: bool, named: bool, buckets: np.ndarray):
    """For mapInArrow over what is asked for with one hash. Answers are packed in one row for each bucket of keys: hashes of
    anchors that repeat, or positions of windows that repeat, with their sign turned (-1 - position) where a smaller
    document has them; if `named`, with the windows' hashes and checks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [[np.frombuffer(c[i].as_buffer(), t) for c, t in zip(b.columns[1:], KINDS, strict=True)] for b in batches for i in range(b.num_rows)]
        if not got:
            return
        hashes, key, k, what, check = (np.concatenate(x) for x in zip(*got, strict=True))
        del got
        kind, pos = what & 3, what >> 2
        if not by_position:
            check = np.zeros(len(hashes), np.int32)
        repeated, removed = kind != ASK, kind == KNOWN
        asked = np.flatnonzero(kind != KNOWN)
        if len(asked):
            order, starts, group = _groups(hashes[asked], check[asked])
            order = asked[order]
            own = k[order]
            least = np.minimum.reduceat(own, starts)
            twice = (least != np.maximum.reduceat(own, starts)) | np.logical_or.reduceat(kind[order] == MANY, starts)
            repeated[order] |= twice[group]
            removed[order] = own > least[group]
        if by_position:
            found = np.where(removed, -1 - pos, pos).astype(np.int64)
        else:
            repeated &= kind != MANY
            found = hashes.view(np.int64)
        good = np.flatnonzero(repeated)
        bucket = _bucket(key[good], buckets)
        good = good[np.argsort(bucket, kind="stable")]  # a document's rows stand together already, block by block
        none = np.zeros(0, np.int64)
        names = (hashes[good].view(np.int64), check[good]) if named else (none, none)
        yield from _packed(key[good], k[good], found[good], *names, buckets)

    return run


def _packed(key: np.ndarray, k: np.ndarray, found: np.ndarray, hashes: np.ndarray, check: np.ndarray, buckets: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of ordered keys, one for each bucket that has any."""
    bucket = _bucket(key, buckets)
    for number in np.unique(bucket):
        part = slice(*np.searchsorted(bucket, [number, number + 1]))
        starts = _runs(key[part])
        counts = np.diff(np.concatenate([starts, [part.stop - part.start]])).astype(np.int32)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
        values = [key[part][starts], k[part][starts], counts, found[part], *(x[part] if len(x) else x for x in (hashes, check))]
        lists = [pa.array([x], pa.list_(t)) for x, t in zip(values, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([int(buckets[number])], pa.int32()), *lists], names=["bucket", "keys", "ks", "counts", "found", "hashes", "checks"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What was found, in one row for each key."""
    parts = []
    for b in batches:
        if b.num_rows:
            keys, ks, counts, *values = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in range(1, 7))
            parts.append((np.repeat(keys, counts), np.repeat(ks, counts), *values))
    if not parts:
        return
    key, k, found, hashes, checks = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    key, k, found = key[order], k[order], found[order]
    named = len(hashes) > 0
    if named:
        hashes, checks = hashes[order], checks[order]
    starts = _runs(key)
    ends = np.concatenate([starts[1:], [len(key)]])
    for i in range(0, len(starts), 2000):
        s, e = starts[i : i + 2000], ends[i : i + 2000]
        offsets = np.concatenate([s - s[0], [e[-1] - s[0]]]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(found[s[0] : e[-1]]))]
        own = pa.array(offsets if named else np.zeros(len(offsets), np.int32))
        lists += [pa.ListArray.from_arrays(own, pa.array(x[s[0] : e[-1]] if named else x)) for x in (hashes, checks)]
        yield pa.RecordBatch.from_arrays([pa.array(key[s]), pa.array(k[s]), *lists], names=["key", "k", "found", "hashes", "checks"])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[Words, np.ndarray, np.ndarray, pa.Array | None]]:
    key, k = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
    for w in words(batch.column(2)):
        more = batch.column(3).slice(w.first, w.rows) if batch.num_columns > 3 else None
        yield w, key[w.first : w.first + w.rows], k[w.first : w.first + w.rows], more


def _ask_anchors(length: int, least: int, block: int, buckets: np.ndarray):
    def run(batches):
        asker = _Asker(by_position=False, block=block, buckets=buckets)
        for batch in batches:
            for w, key, k, _ in _rows(batch):
                _, place, hashes = anchors(w.hashes(), w.doc, length, least)
                once = np.concatenate([[True], place[1:] != place[:-1]])[: len(place)]
                place, hashes = place[once], hashes[once]
                doc = w.doc[place]
                _, once = np.unique(mix(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
                doc = doc[once]
                # the key serves as the document: at worst an anchor repeats in two texts under one id
                yield from asker.add(key[doc], key[doc], np.zeros(len(doc)), hashes[once])
        yield from asker.flush()

    return run


def _ask_windows(length: int, least: int, before: int | None, block: int, buckets: np.ndarray):
    """Asks for windows of `least` words whose anchors of `length` words repeat, or, with `before`, for windows of `least`
    words whose two halves of `before` words repeat."""

    def run(batches):
        asker = _Asker(by_position=True, block=block, buckets=buckets)
        for batch in batches:
            for w, key, k, known in _rows(batch):
                begin = np.searchsorted(w.doc, np.arange(w.rows))  # each row's first word
                flat, rows = known.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(w.rows), np.diff(known.offsets.to_numpy()))
                word_hashes = w.hashes()
                if before is None:
                    at, place, hashes = anchors(word_hashes, w.doc, length, least)
                    tag = lambda h, d: mix(h + d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    at = at[np.isin(tag(hashes, w.doc[place]), tag(flat.view(np.uint64), rows))]
                else:
                    there = np.zeros(len(w.doc) + least, bool)
                    there[begin[rows] + np.where(flat < 0, -1 - flat, flat)] = True
                    at = np.flatnonzero(there[: len(w.doc)] & there[before : before + len(w.doc)])
                longer, starts = windows(word_hashes, w.doc, least)
                check = (windows(w.hashes(1), w.doc, least)[0] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                mine = np.zeros(len(w.doc), bool)
                mine[at] = True
                good = mine[starts]
                at, doc = starts[good], w.doc[starts[good]]
                yield from asker.add(key[doc], k[doc], at - begin[doc], longer[good], check[good])
        yield from asker.flush()

    return run


def _ask_doubled(before: int, block: int, buckets: np.ndarray):
    """Asks for windows of twice `before` words, by the names of their halves, over rows of a level's answers."""

    def run(batches):
        asker = _Asker(by_position=True, block=block, buckets=buckets)
        for batch in batches:
            if not batch.num_rows:
                continue
            key, k = (batch.column(c).to_numpy() for c in range(2))
            flat, hashes, checks = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in range(2, 5))
            rows = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(2).offsets.to_numpy()))
            code = (rows.astype(np.int64) << 32) + np.where(flat < 0, -1 - flat, flat)
            order = np.argsort(code, kind="stable")
            code = code[order]
            at = np.searchsorted(code, code + before)
            whole = np.flatnonzero((at < len(code)) & (code[np.minimum(at, len(code) - 1)] == code + before))
            first, second = order[whole], order[at[whole]]
            a, b = hashes[first].view(np.uint64), hashes[second].view(np.uint64)
            c, d = (checks[x].view(np.uint32).astype(np.uint64) for x in (first, second))
            name = mix(a * np.uint64(0x9FB21C651E98DF25) + b)
            check = (mix((c << np.uint64(32) | d) * np.uint64(0xD6E8FEB86659FD93) + (a ^ (b >> np.uint64(1)))) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            doc = rows[first]
            yield from asker.add(key[doc], k[doc], code[whole] & 0xFFFFFFFF, name, check)
        yield from asker.flush()

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    k = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    return docs.select(F.xxhash64("doc_id", "text").alias("key"), k.alias("k"), "text")


def _level(asked: DataFrame, by_position: bool, buckets: np.ndarray, named: bool = False) -> DataFrame:
    """(key, k, found, hashes, checks) for every document that has a window which repeats."""
    answered = asked.repartition("bucket").mapInArrow(_answer(by_position, named, buckets), ANSWERED)
    return settle(answered.repartition("bucket").mapInArrow(_merge, MERGED))


def levels(docs: DataFrame, min_words: int = MIN_WORDS, longest: int | None = None) -> Iterator[tuple[int, DataFrame]]:
    """Per length: a table (key, positions) of the windows that repeat, those that a smaller document holds with their sign
    turned (-1 - position). Lengths are the least one, twice that and so on, until none is found or beyond `longest`. A
    table is there until the next one is asked for."""
    rows = _keyed(docs)
    half = (min_words + 1) // 2
    spark = docs.sparkSession
    buckets = bucket_labels(spark)
    found = _level(rows.mapInArrow(_ask_anchors(half, min_words, BLOCK, buckets), ASKED), False, buckets)
    length, before = min_words, None
    while True:
        many = found.agg(F.sum(F.size("found"))).first()[0] or 0
        # about four windows for an anchor, and no more of a length than of its half
        buckets = bucket_labels(spark, many * (4 if before is None else 1))
        if length <= NAMED_FROM * min_words:
            known = found.select(F.col("key").alias("of"), F.col("found").alias("known"))
            asking = rows.join(known, F.col("key") == F.col("of")).select("key", "k", "text", "known")
            asked = asking.mapInArrow(_ask_windows(half, length, before, BLOCK, buckets), ASKED)
        else:
            asked = found.mapInArrow(_ask_doubled(before, BLOCK, buckets), ASKED)
        last, found = found, _level(asked, True, buckets, named=length >= NAMED_FROM * min_words)
        forget(last)
        yield length, found.select("key", F.col("found").alias("positions"))
        before, length = length, 2 * length
        if (longest is not None and length > longest) or found.isEmpty():
            return


KEPT = "doc_id long, n_words long, n_removed long, longest long, kept_text string, kept_sha256 string"


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, longest: int | None = None) -> DataFrame:
    """Per row of (doc_id, text): n_words, n_removed, the longest length at which a window of it was removed, the words that
    are kept, joined by one space, and their digest."""
    lost, reached = None, None
    for n, found in levels(docs, min_words, longest):
        own = found.select("key", F.filter("positions", lambda p: p < 0).alias("lost")).filter(F.size("lost") > 0)
        if lost is None:
            lost = settle(own)
        keys = settle(own.select("key", F.lit(n).cast("long").alias("length")), light=True)  # of documents, not of windows
        reached = keys if reached is None else reached.union(keys)
    reached = settle(reached.groupBy(F.col("key").alias("of")).agg(F.max("length").alias("longest")), light=True)
    lost = lost.join(reached, F.col("key") == F.col("of")).drop("of")
    rows = _keyed(docs).withColumn("doc_id", F.when(F.col("k") < (1 << 63) - 1, F.col("k")))
    rows = rows.join(lost.withColumnRenamed("key", "of"), F.col("key") == F.col("of"), "left")

    def cut(batches):
        for batch in batches:
            ids, texts, lost, longest = batch.columns
            out = []
            for text, gone in zip(texts.cast(pa.large_binary()).to_pylist(), lost, strict=True):
                own = (text or b"").split()
                kept = own
                if gone.is_valid:
                    at = -1 - gone.values.to_numpy()
                    cover = np.zeros(len(own) + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + min_words, -1)
                    kept = list(compress(own, (np.cumsum(cover)[:-1] == 0).tolist()))
                joined = b" ".join(kept)
                out.append((len(own), len(own) - len(kept), joined.decode(), hashlib.sha256(joined).hexdigest()))
            n, removed, kept, digest = zip(*out, strict=True) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), longest, pa.array(kept, pa.string()), pa.array(digest, pa.string())],
                names=["doc_id", "n_words", "n_removed", "longest", "kept_text", "kept_sha256"],
            )

    return rows.select("doc_id", "text", "lost", "longest").mapInArrow(cut, KEPT)


def repeats_sql(min_words: int = MIN_WORDS, doublings: int = 16) -> str:
    """What the least length removes from `documents`, and the longest length that reaches, in SQL. Windows of twice a length
    are told apart by the numbers of their halves."""
    levels = []
    for i in range(doublings):
        n = min_words << i
        if i:
            pairs = f"SELECT a.doc_id, a.pos, dense_rank() OVER (ORDER BY a.id, b.id) AS id FROM w{i - 1} a JOIN w{i - 1} b ON b.doc_id = a.doc_id AND b.pos = a.pos + {n // 2}"
        else:
            pairs = f"SELECT doc_id, pos, dense_rank() OVER (ORDER BY content) AS id FROM windows WHERE n = {n}"
        ids = f"SELECT *, min(doc_id) OVER (PARTITION BY id) AS least, max(doc_id) OVER (PARTITION BY id) AS most FROM ({pairs})"
        levels.append(f"w{i} AS MATERIALIZED (SELECT * FROM ({ids}) WHERE least < most)")
    found = " UNION ALL ".join(f"SELECT doc_id, CAST({min_words << i} AS BIGINT) AS length FROM w{i} WHERE least < doc_id" for i in range(doublings))
    return rf"""
WITH listed AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS list FROM documents),
each AS (SELECT doc_id, unnest(list) AS word, generate_subscripts(list, 1) AS pos FROM listed),
windows AS (
  SELECT doc_id, pos, string_agg(word, ' ') OVER w AS content, count(*) OVER w AS n FROM each
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {min_words - 1} FOLLOWING)),
{", ".join(levels)},
lost AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + {min_words})) AS pos FROM w0 WHERE least < doc_id),
reached AS (SELECT doc_id, max(length) AS longest FROM ({found}) GROUP BY doc_id),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(l.pos) AS n_removed, string_agg(word, ' ' ORDER BY e.pos) FILTER (l.pos IS NULL) AS text
  FROM each e LEFT JOIN lost l USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256, longest
FROM documents LEFT JOIN kept k USING (doc_id) LEFT JOIN reached USING (doc_id)"""
