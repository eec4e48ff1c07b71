"""Exact deduplication as a Grace hash aggregation over complete contents.

Records are dealt to buckets by a hash of their content without white space. A task reads its bucket as a stream into an
open-addressing table that compares whole contents. When the table has used its budget, records of contents that it lacks
go to spill files by further bits of the hash; each file is then a bucket of its own, and so on until all fit. Spill files
are anonymous files of the task, gone with it; a task that is run again starts from its shuffle input.

Before the shuffle each task aggregates its own records in the same table, so a content that a third of all rows share
arrives once per task. Members meet their group's row by digest, a join of small rows that AQE can split.

Equal: identical after deleting every character of [\\x20\\x09-\\x0D]. Of a group, the row with the most code points in the
original text stays, then the one with the smallest doc_id, NULL being the largest; of rows equal in both, one.
Defined cases: text NULL counts as empty, and all empty texts are one group. Two contents with one SHA-256 raise an error.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from plumbline.llm.common import settle
from plumbline.llm.words import SPACES

#: Bytes of contents in one table, and spill files per level.
TABLE_BYTES = 48 << 20
FAN_OUT = 16

GROUP = "bucket long, digest binary, content binary, keep_length long, keep_id long, n long, n_keep long"
ARROW = pa.schema(
    [
        ("bucket", pa.int64()),
        ("digest", pa.binary()),
        ("content", pa.binary()),
        ("keep_length", pa.int64()),
        ("keep_id", pa.int64()),
        ("n", pa.int64()),
        ("n_keep", pa.int64()),
    ]
)


@dataclass(slots=True)
class Group:
    """A content, and of its records the one that stays: `n` records in all, `n_keep` of them equal to the one that stays."""

    digest: bytes
    content: bytes
    keep_length: int
    keep_id: int | None
    n: int
    n_keep: int

    def rank(self) -> tuple:
        return -self.keep_length, self.keep_id is None, self.keep_id or 0

    def add(self, other: Group) -> None:
        mine, theirs = self.rank(), other.rank()
        if theirs == mine:
            self.n_keep += other.n_keep
        elif theirs < mine:
            self.keep_length, self.keep_id, self.n_keep = other.keep_length, other.keep_id, other.n_keep
        self.n += other.n


class Table:
    """Open addressing with linear probing; places hold indices of groups. Contents are compared whole."""

    def __init__(self, budget: int):
        self.budget, self.used = budget, 0
        self.groups: list[Group] = []
        self.hashes: list[int] = []
        self.places = [-1] * 1024

    def _grow(self) -> None:
        self.places = [-1] * (2 * len(self.places))
        mask = len(self.places) - 1
        for i, h in enumerate(self.hashes):
            at = h & mask
            while self.places[at] >= 0:
                at = (at + 1) & mask
            self.places[at] = i

    def put(self, record: Group) -> bool:
        """Adds a record to its group, or as a new one; False if it is new and does not fit. An empty table takes any record."""
        h, mask = int.from_bytes(record.digest[8:16]), len(self.places) - 1
        at = h & mask
        while (i := self.places[at]) >= 0:
            if self.hashes[i] == h:
                group = self.groups[i]
                if group.content == record.content:
                    group.add(record)
                    return True
                if group.digest == record.digest:
                    raise ValueError("two different contents have the same SHA-256")
            at = (at + 1) & mask
        cost = len(record.content) + 200
        if self.groups and self.used + cost > self.budget:
            return False
        self.places[at] = len(self.groups)
        self.groups.append(record)
        self.hashes.append(h)
        self.used += cost
        if 2 * len(self.groups) > len(self.places):
            self._grow()
        return True


def aggregate(records: Iterator[Group], budget: int = TABLE_BYTES, level: int = 0) -> Iterator[Group]:
    """All groups of a stream of records, in memory of about `budget` and in spill files."""
    table, files = Table(budget), []
    for record in records:
        if not table.put(record):
            if not files:
                files = [tempfile.TemporaryFile() for _ in range(FAN_OUT)]
            # each level deals by another hash of the digest
            part = hashlib.blake2b(record.digest, digest_size=2, salt=level.to_bytes(4)).digest()[0] % FAN_OUT
            pickle.dump(record, files[part], pickle.HIGHEST_PROTOCOL)
    yield from table.groups
    del table
    for file in files:
        with file:
            file.seek(0)
            yield from aggregate(_read(file), budget, level + 1)


def _read(file) -> Iterator[Group]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[Group]:
    for batch in batches:
        ids, texts, lengths = (batch.column(i) for i in range(3))
        for i, text in enumerate(texts.cast(pa.large_binary())):
            content = (text.as_py() or b"").translate(None, SPACES)
            yield Group(hashlib.sha256(content).digest(), content, lengths[i].as_py(), ids[i].as_py(), 1, 1)


def _batches(groups: Iterator[Group], contents: bool) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for g in groups:
        bucket = int.from_bytes(g.digest[:8], signed=True)
        rows.append((bucket, g.digest, g.content if contents else None, g.keep_length, g.keep_id, g.n, g.n_keep))
        size += len(g.content)
        if len(rows) >= 1000 or size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ARROW.types, strict=True)], schema=ARROW)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ARROW.types, strict=True)], schema=ARROW)


def _flushed(records: Iterator[Group], budget: int) -> Iterator[Group]:
    """Groups of a task's own records; when the table is full it is passed on and begun anew."""
    table = Table(budget)
    for record in records:
        if not table.put(record):
            yield from table.groups
            table = Table(budget)
            table.put(record)
    yield from table.groups


def groups(docs: DataFrame, budget: int = TABLE_BYTES) -> DataFrame:
    """One row per content of (doc_id, text): digest, keep_id, keep_length, n (records), n_keep."""

    def combine(batches):
        yield from _batches(_flushed(_records(batches), budget), contents=True)

    def bucket(batches):
        own = (Group(*row) for b in batches for row in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True))
        yield from _batches(aggregate(own, budget), contents=False)

    rows = docs.select("doc_id", "text", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("length"))
    dealt = rows.mapInArrow(combine, GROUP).repartition("bucket")
    return settle(dealt.mapInArrow(bucket, GROUP).drop("bucket", "content"))


def _digests(texts: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256((t.as_py() or b"").translate(None, SPACES)).digest() for t in texts.cast(pa.large_binary())], pa.binary())


def content_digest(text: Column) -> Column:
    """SHA-256 of each text without white space."""
    return F.arrow_udf(_digests, T.BinaryType())(text)


def exact_groups(docs: DataFrame, budget: int = TABLE_BYTES) -> DataFrame:
    """Per row of (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    found = groups(docs, budget).select(F.col("digest").alias("of"), "keep_id", "keep_length", "n")
    length = F.coalesce(F.char_length("text"), F.lit(0)).cast("long")
    rows = docs.select("doc_id", length.alias("length"), content_digest(F.col("text")).alias("digest"))
    # equal rows are numbered first, so that the join by digest comes last and AQE can split a large group
    same = Window.partitionBy("digest", "doc_id", "length").orderBy("length")
    rows = rows.withColumn("turn", F.row_number().over(same)).join(found, F.col("digest") == F.col("of"), "left")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("length") == F.col("keep_length"))
    return rows.select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        (stays & (F.col("turn") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, budget: int = TABLE_BYTES) -> DataFrame:
    """The rows that stay, with all their columns."""
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    length = F.coalesce(F.char_length("doc.text"), F.lit(0)).cast("string")

    def key(digest, length, ident):
        return F.concat_ws(":", F.hex(digest), length, F.coalesce(ident.cast("string"), F.lit("")))

    found = groups(docs, budget).select(key(F.col("digest"), F.col("keep_length").cast("string"), F.col("keep_id")).alias("of"))
    rows = work.select("doc", key(content_digest(F.col("doc.text")), length, F.col("doc.doc_id")).alias("key"))
    rows = rows.join(found, F.col("key") == F.col("of"))
    first = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    rows = rows.withColumn("turn", first).filter("turn = 1")
    return rows.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


EXACT_SQL = r"""
WITH normal AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content FROM documents),
ranked AS (
  SELECT *, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY content) AS group_size, row_number() OVER best AS place
  FROM normal WINDOW best AS (PARTITION BY content ORDER BY points DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM ranked"""
