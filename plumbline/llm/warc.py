"""WARC archives: written as plain text files of records, and read back by verifying the chain of record boundaries.

Writing: of records with equal payloads the one with the largest id is a response, the others are revisits that name it.
A record is one row of Spark's text writer, whose line separator is the two line ends that close a record.

Reading: the text reader cuts the files at every magic `WARC/1.1` and may split a file over many tasks. A piece begins at
a magic, and its offset is the sum of the lengths before it: per split first, then within a split. Each piece claims a
successor, where its record would end by its own Content-Length. A magic inside a payload makes such claims too, so they
are only candidates: from each file's start, pointer jumping keeps the pieces that are reached. It doubles the
distance each round, so a file of n records takes log2(n) joins, however many tasks read it. Pieces that are not reached
are part of the payload before them.

Defined cases: payload NULL is empty. Rows with the same id and payload are alike; if theirs is the largest id, all of
them are responses. An id of NULL is the smallest. A file whose chain breaks off keeps the records before the break.
Without rows there are no files, and no records are read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import settle
from plumbline.session import shared_dir

MAGIC = "WARC/1.1\r\n"
CLOSE = "\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"
#: Payloads of fewer bytes are all responses.
LEAST_BYTES = 0
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(digest: Column) -> Column:
    """A SHA-1 in hexadecimal digits in base 32: its 160 bits are 32 digits of five bits, cut from eight numbers of 20 bits."""
    digits = []
    for i in range(8):
        part = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            digits.append(F.substring(F.lit(BASE32), F.shiftright(part, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*digits)


def plan_records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The rows of (page_id, payload) that are revisits: page_id, its content's hash, refers_to."""
    rows = settle(pages.select("page_id", F.sha2("payload", 256).alias("hash"), F.octet_length("payload").alias("bytes")))
    rows = rows.filter(F.col("bytes") >= least_bytes)
    best = rows.groupBy(F.col("hash").alias("of")).agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # the join comes last and both its sides are at rest or dealt for it alone, so AQE can split a hot hash
    both = rows.select("page_id", "hash").distinct().join(settle(best.drop("n")), F.col("hash") == F.col("of"))
    revisits = both.filter(~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull())
    return settle(revisits.select(F.col("page_id").alias("revisit_id"), "of", "refers_to"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Writes a record for each row of (page_id, url, payload), payloads being bytes of UTF-8."""
    revisits = plan_records(pages, least_bytes)
    rows = pages.withColumns({"hash": F.sha2("payload", 256), "sha1": F.sha1("payload")})
    # small tables of revisits are broadcast, by the size of their files; large ones meet the rows in a shuffle by id
    rows = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("revisit_id")) & (F.col("hash") == F.col("of")), "left")
    again = F.col("of").isNotNull()
    ident = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    size = F.octet_length("payload")
    stored = F.when(again, F.lit("")).otherwise(F.decode("payload", "utf-8"))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20]", "")  # a header's line must not end early
    header = F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"),
        ident,
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        base32(F.col("sha1")),
        F.lit("\r\nX-Payload-Length: "),
        size.cast("string"),
        F.when(again, F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Length: "),
        F.when(again, F.lit(0)).otherwise(size).cast("string"),
        F.lit(CLOSE),
    )
    rows.select(F.concat(header, stored).alias("value")).write.text(path, lineSep=CLOSE)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between two magics, with its file, split and place. Two scans of the same files place rows alike, as ids come
    from a partition's number and the row's in it."""
    raw = spark.read.schema("value string").option("lineSep", MAGIC).text(path)
    raw = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return raw.withColumn("place", F.monotonically_increasing_id())


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"(?m)^{name}: ?([^\r\n]*)", 1)


def _parsed(rows: DataFrame) -> DataFrame:
    """Adds to rows with `value` the header's fields, and length and digest of the payload that the value holds."""
    cut = F.instr("value", CLOSE)
    rows = rows.withColumn("header", F.when(cut > 0, F.substring(F.col("value"), F.lit(1), cut - 1)))
    rows = rows.withColumn("size", _field("Content-Length").try_cast("long"))
    body = F.substring(F.col("value"), cut + len(CLOSE), F.length("value"))
    rows = rows.withColumn("stored", F.substring(F.encode(body, "utf-8"), F.lit(1), F.col("size").cast("int")))
    return rows.withColumns(
        {
            "bytes": F.octet_length("value"),
            "head": F.octet_length("header"),
            "page_id": F.regexp_extract("header", r"(?m)^WARC-Record-ID: <urn:page:(-?\d*)>", 1).try_cast("long"),
            "refers_to": F.regexp_extract("header", r"(?m)^WARC-Refers-To: <urn:page:(-?\d+)>", 1).try_cast("long"),
            "record_type": _field("WARC-Type"),
            "told_bytes": _field("X-Payload-Length").try_cast("long"),
            "told_digest": _field("WARC-Payload-Digest"),
            "stored_bytes": F.octet_length("stored").cast("long"),
            "stored_digest": F.sha1("stored"),
        }
    ).drop("header")


def located(parsed: DataFrame) -> DataFrame:
    """Adds to pieces the offset of the byte after their magic, and `succ`, the offset of the piece after their record, NULL
    where no length is given. A piece is followed by a magic, but for the last of a file."""
    length = F.col("bytes") + len(MAGIC)
    blocks = parsed.groupBy("file", "block").agg(F.sum(length).alias("n"))
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("file").alias("f"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("begin"))
    inner = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    light = parsed.withColumn("within", F.coalesce(F.sum(length).over(inner), F.lit(0)))
    light = light.join(blocks, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    light = light.withColumn("offset", F.col("begin") + F.col("within"))
    succ = F.col("offset") + F.col("head") + F.col("size") + 2 * len(CLOSE) + len(MAGIC)
    return light.withColumn("succ", F.when(F.col("offset") == 0, F.lit(len(MAGIC))).otherwise(succ)).drop("f", "b", "begin", "within")


def reachable(edges: DataFrame) -> DataFrame:
    """The (file, offset) that a chain from offset 0 reaches, by pointer jumping: what is marked marks its pointer's end, and
    every pointer becomes its end's pointer, so each round doubles the marked part of a chain."""
    marked = edges.select("file", "offset", "succ", (F.col("offset") == 0).alias("on"))
    while True:
        hit = marked.filter("on and succ is not null").select(F.col("file").alias("f"), F.col("succ").alias("o")).distinct()
        onto = marked.select(F.col("file").alias("g"), F.col("offset").alias("p"), F.col("succ").alias("jump"))
        after = marked.join(onto, (F.col("file") == F.col("g")) & (F.col("succ") == F.col("p")), "left")
        after = after.select("file", "offset", F.col("jump").alias("succ"), "on")
        after = after.join(hit, (F.col("file") == F.col("f")) & (F.col("offset") == F.col("o")), "left")
        marked = settle(after.select("file", "offset", "succ", (F.col("on") | F.col("o").isNotNull()).alias("on")))
        if marked.filter("on and succ is not null").isEmpty():
            return marked.filter("on").select("file", "offset")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Per record: page_id, record_type, refers_to, and payload_bytes and payload_digest: of what a response stores, as it was
    read, and of what a revisit's header tells of its full payload."""
    light = settle(located(settle(_parsed(_pieces(spark, path)).drop("stored", "value"))))
    kept = settle(reachable(light).filter("offset > 0"))
    # a piece that is not reached belongs to the record before it
    marked = light.select("file", "offset", "place").join(kept.withColumn("own", F.col("offset")), ["file", "offset"], "left")
    before = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owner = marked.select("file", "offset", "place", "own", F.last("own", ignorenulls=True).over(before).alias("owner"))
    stray = settle(owner.filter("own is null and owner is not null").select("file", "owner", "place"))
    rows = light.join(kept, ["file", "offset"])
    if not stray.isEmpty():
        torn = stray.select("file", F.col("owner").alias("offset")).distinct()
        rest = rows.join(torn, ["file", "offset"], "left_anti")
        parts = rows.join(torn, ["file", "offset"], "left_semi").select("place", F.col("file").alias("of"), F.col("offset").alias("owner"))
        parts = settle(parts.union(stray.select("place", F.col("file").alias("of"), "owner")))
        again = _pieces(spark, path).join(parts.withColumnRenamed("place", "at"), F.col("place") == F.col("at"))
        whole = again.groupBy("of", "owner").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("parts"))
        whole = _parsed(whole.select(F.array_join(F.transform("parts", lambda x: x["value"]), MAGIC).alias("value")))
        columns = ["page_id", "record_type", "refers_to", "told_bytes", "told_digest", "stored_bytes", "stored_digest"]
        rows = rest.select(*columns).union(whole.select(*columns))
    stored = F.col("record_type") == "response"
    return rows.select(
        "page_id",
        F.when(stored, F.col("stored_bytes")).otherwise(F.col("told_bytes")).alias("payload_bytes"),
        F.when(stored, base32(F.col("stored_digest"))).otherwise(F.regexp_replace("told_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes (page_id, url, html) to archives in the shared folder and reads them back."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload")), path, least_bytes)
    return read_archives(spark, path)


def round_trip_sql() -> str:
    """The records of `pages` in SQL."""
    digits = " || ".join(
        f"substr('{BASE32}', CAST((CAST('0x' || substr(digest, {5 * i + 1}, 5) AS BIGINT) >> {shift}) & 31 AS INT) + 1, 1)"
        for i in range(8)
        for shift in (15, 10, 5, 0)
    )
    return f"""
WITH data AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages),
best AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS best FROM data)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, {digits} AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> best THEN best END AS refers_to
FROM best"""
