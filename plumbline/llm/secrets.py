"""Secret scan with ownership: who else holds a candidate tells an example that everyone copies from a live credential.

Candidates are the matches of the base patterns and bare tokens that look like keys. Every candidate's value is hashed, and
the hash is counted over the corpus by distinct repositories and owners, and by documents. A value that many owners hold, or
that stands in many repositories or documents of a few owners, is `copied`; one that few hold in few places and that looks
random is `owned`, and its span is added to the base spans, which always stay.

Only DataFrame functions. Offsets are running sums of the lengths of matches and of the text between them, one row for each
match, so a text takes time in proportion to its length and its matches. Counts are combined before the shuffle, first by
(hash, owner, repository, document); texts are never shuffled. Facts about values are written before they meet the matches, so
AQE can split the matches of a value that a third of all documents hold.

Defined cases: text NULL or empty has no spans, and its digest is that of the empty string. Offsets are code points, the
end exclusive. Owner or repository NULL counts as one of its own. Rows with the same id stay apart. Letters of the key
words may be in either case, but are of ASCII only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import settle


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


KEYS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: kind, pattern, group with the value, least length of the value; in the order in which kinds are listed
BASE = (
    ("assign", rf"""({KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "(AKIA[A-Z0-9]+)", 1, 16),
    ("hex", "([0-9a-f]+)", 1, 32),
)
#: Bare tokens: of these characters, so long at least, with letters and digits and so many different characters.
TOKEN = ("bare", "([A-Za-z0-9+/_-]{20,})", 1, 20)
LEAST_DISTINCT = 8
PLACEHOLDER = "(?i)example|sample|dummy|placeholder|changeme|xxxx"
#: A value with more owners than this, or in more repositories or documents, is copied, not owned.
MOST_OWNERS, MOST_REPOS, MOST_DOCUMENTS = 2, 4, 50
#: Runs of so many code points can hold a match of the pattern for `hex`; the scan keeps only these, so that short words cost nothing.
HEX_RUN = "([0-9a-f]{32,})"


def looks_live(value: Column) -> Column:
    """Letters, digits and enough different characters; no word that marks a placeholder."""
    varied = F.size(F.array_distinct(F.regexp_extract_all(value, F.lit("."), F.lit(0)))) >= LEAST_DISTINCT
    return value.rlike("[A-Za-z]") & value.rlike("[0-9]") & varied & ~value.rlike(PLACEHOLDER)


def _found(text: Column, rank: int, pattern: str, group: int) -> Column:
    """Array of (rank, number, gap before the match, width, value) for all matches, failing ones too, for offsets to add up."""
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )

    def sized(x: Column, i: Column) -> Column:
        return F.struct(
            F.lit(rank).alias("rank"),
            i.alias("number"),
            F.length(x["gap"]).cast("long").alias("gap"),
            F.length(x["match"]).cast("long").alias("width"),
            x["value"].alias("value"),
        )

    # what follows the last match is a gap without a match
    empty = F.array().cast("array<struct<rank:int,number:int,gap:bigint,width:bigint,value:string>>")
    return F.when(text.rlike(pattern), F.filter(F.transform(parts, sized), lambda x: x["width"].isNotNull())).otherwise(empty)


SCANS = tuple((k, HEX_RUN if k == "hex" else p, g, n) for k, p, g, n in (*BASE, TOKEN))


def matches(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text, owner, repo): doc_id, owner, repo, row (its number), and what the patterns match, unfiltered."""
    found = F.concat(*[_found(F.col("text"), i, p, g) for i, (_, p, g, _) in enumerate(SCANS)])
    return settle(docs.select("doc_id", "owner", "repo", found.alias("matches")).withColumn("row", F.monotonically_increasing_id()))


def candidates(found: DataFrame) -> DataFrame:
    """The matches that are long enough: row, owner, repo, rank (of the kind), start, end, value_start, value, hash."""
    each = found.select("row", "owner", "repo", F.inline("matches"))
    so_far = Window.partitionBy("row", "rank").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("width")).over(so_far))
    least = F.element_at(F.array(*[F.lit(n) for *_, n in SCANS]), F.col("rank") + 1)
    each = each.filter(F.length("value") >= least)
    return each.select(
        "row",
        "owner",
        "repo",
        "rank",
        (F.col("end") - F.col("width")).alias("start"),
        "end",
        (F.col("end") - F.length("value")).alias("value_start"),  # a value ends where its match ends
        "value",
        F.sha2("value", 256).alias("hash"),
    )


def ownership(each: DataFrame, most_owners: int = MOST_OWNERS, most_repos: int = MOST_REPOS, most_documents: int = MOST_DOCUMENTS) -> DataFrame:
    """Per value hash: distinct owners, repositories (of an owner) and documents, uses, and the verdict."""
    docs = each.groupBy("hash", "owner", "repo", "row").agg(F.count(F.lit(1)).alias("uses"), F.max(looks_live(F.col("value"))).alias("live"))
    sums = [F.sum("uses").alias("uses"), F.max("live").alias("live")]
    by_repo = docs.groupBy("hash", "owner", "repo").agg(*sums, F.count(F.lit(1)).alias("documents"))
    by_owner = by_repo.groupBy("hash", "owner").agg(*sums, F.sum("documents").alias("documents"), F.count(F.lit(1)).alias("repos"))
    out = by_owner.groupBy("hash").agg(*sums, F.sum("documents").alias("documents"), F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners"))
    many = (F.col("owners") > most_owners) | (F.col("repos") > most_repos) | (F.col("documents") > most_documents)
    return out.withColumn("verdict", F.when(many, "copied").when(F.col("live"), "owned").otherwise("plain"))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def scan(docs: DataFrame, most_owners: int = MOST_OWNERS, most_repos: int = MOST_REPOS, most_documents: int = MOST_DOCUMENTS) -> DataFrame:
    """Per row of (doc_id, text, owner, repo): doc_id, spans (base ones and `owned` ones, with the value's hash and its
    numbers of owners, repositories and documents) in order of start and kind; NULL where there are none."""
    found = matches(docs)
    each = settle(candidates(found))
    facts = settle(ownership(each, most_owners, most_repos, most_documents), light=True)
    each = each.drop("owner", "repo", "value").join(facts.drop("uses", "live"), "hash")
    kinds = F.array(*[F.lit(k) for k, *_ in SCANS])
    base = each.filter(F.col("rank") < len(BASE)).withColumn("kind", F.element_at(kinds, F.col("rank") + 1))
    # an owned value that is found in several ways is one span
    owned = each.filter("verdict = 'owned'").withColumns({"start": F.col("value_start"), "rank": F.lit(len(BASE)), "kind": F.lit("owned")})
    spans = base.unionByName(owned.dropDuplicates(["row", "start", "end", "hash"])).withColumn(
        "span", F.struct("start", "rank", "end", "kind", "hash", "owners", "repos", "documents", "verdict")
    )
    rows = spans.groupBy(F.col("row").alias("of")).agg(F.array_sort(F.collect_list("span")).alias("spans"))
    return found.select("doc_id", "row").join(rows, F.col("row") == F.col("of"), "left").select("doc_id", "spans")


def digest(found: DataFrame) -> DataFrame:
    """Per document: numbers of base spans, the digest of their list, and the list of all spans."""
    base = F.filter(F.col("spans"), lambda x: x["rank"] < len(BASE))
    empty = F.lit("")

    def count(kind: str) -> Column:
        return F.when(F.col("spans").isNull(), 0).otherwise(F.size(F.filter("spans", lambda x: x["kind"] == kind))).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k, *_ in BASE],
        F.sha2(F.encode(F.coalesce(_written(base), empty), "utf-8"), 256).alias("base_sha256"),
        F.coalesce(_written(F.col("spans")), empty).alias("spans"),
    )


def scan_sql(most_owners: int = MOST_OWNERS, most_repos: int = MOST_REPOS, most_documents: int = MOST_DOCUMENTS) -> str:
    """The digest over `documents` in SQL, a document's source being its owner and the source in one language a repository."""
    scans = []
    for rank, (kind, pattern, group, least) in enumerate((*BASE, TOKEN)):
        p = "'" + (HEX_RUN if kind == "hex" else pattern).replace("'", "''") + "'"
        scans.append(
            f"SELECT doc_id, owner, repo, '{kind}' AS kind, {rank} AS rank, {least} AS least, regexp_extract_all(text, {p}, 0) AS matches, "
            f"regexp_extract_all(text, {p}, {group}) AS vals, string_split_regex(text, {p}) AS gaps FROM docs WHERE regexp_matches(text, {p})"
        )
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner, coalesce(source, '') || '/' || coalesce(lang, '') AS repo FROM documents),
found AS ({" UNION ALL ".join(scans)}),
places AS (SELECT *, unnest(range(1, len(matches) + 1)) AS i FROM found),
spans AS (
  SELECT doc_id, owner, repo, kind, rank, vals[i] AS val, length(matches[i]) AS width, least,
         list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: length(x))), 0) AS start
  FROM places),
good AS (SELECT *, start + width AS stop FROM spans WHERE length(val) >= least),
facts AS (
  SELECT val, count(DISTINCT owner) AS owners, count(DISTINCT repo) AS repos, count(DISTINCT doc_id) AS documents,
         regexp_matches(val, '[A-Za-z]') AND regexp_matches(val, '[0-9]') AND len(list_distinct(regexp_extract_all(val, '.'))) >= {LEAST_DISTINCT}
         AND NOT regexp_matches(val, '{PLACEHOLDER}') AS live FROM good GROUP BY val),
listed AS (
  SELECT doc_id, kind, rank, start, stop FROM good WHERE rank < {len(BASE)}
  UNION SELECT doc_id, 'owned', {len(BASE)}, stop - length(val), stop FROM good JOIN facts USING (val) 
  WHERE owners <= {most_owners} AND repos <= {most_repos} AND documents <= {most_documents} AND live),
texts AS (
  SELECT doc_id, sum((kind = 'assign')::INT) AS n_assign, sum((kind = 'access')::INT) AS n_access, sum((kind = 'hex')::INT) AS n_hex,
         string_agg(concat_ws(':', kind, CAST(start AS BIGINT), CAST(stop AS BIGINT)), ',' ORDER BY start, rank, stop) FILTER (rank < {len(BASE)}) AS base,
         string_agg(concat_ws(':', kind, CAST(start AS BIGINT), CAST(stop AS BIGINT)), ',' ORDER BY start, rank, stop) AS spans
  FROM listed GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN texts t ON d.doc_id = t.doc_id"""
