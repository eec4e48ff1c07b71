"""The operators bound to the test tables: one query for each, over whole tables and texts, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import fertility, grace, jaccard, mixing, negatives, postings, ranker, secrets, sharding, substrings, viterbi, warc, whitening
from plumbline.llm.common import prepared, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepared(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_ngram_jaccard(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op1_ngram_jaccard"] = jaccard.near_duplicates_sql()


@query
def op2_secret_ownership(spark, sf_dir):
    """A document's source is its owner, and the source in one language a repository."""
    docs = table(spark, sf_dir, "documents")
    repo = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    return secrets.digest(secrets.scan(docs.select("doc_id", "text", F.col("source").alias("owner"), repo.alias("repo"))))


ORACLE["op2_secret_ownership"] = secrets.scan_sql()


@query
def op3_fertility_rules(spark, sf_dir):
    return fertility.quality_rules(table(spark, sf_dir, "documents"))


@query
def op4_grace_hash(spark, sf_dir):
    return grace.exact_groups(table(spark, sf_dir, "documents"))


ORACLE["op4_grace_hash"] = grace.EXACT_SQL


@query
def op5_level_doubling(spark, sf_dir):
    """All levels, until no window repeats; `longest` is the length of the longest one that a smaller document has too."""
    return substrings.without_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


ORACLE["op5_level_doubling"] = substrings.repeats_sql()


@query
def op6_water_filling(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


ORACLE["op6_water_filling"] = mixing.mix_sql()


@query
def op7_pairwise_ranking(spark, sf_dir):
    return ranker.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_min_cost_resharding(spark, sf_dir):
    """From ten shards by source, of uneven sizes, to eight of even sizes, the affected ones written and read back."""
    docs = table(spark, sf_dir, "documents")
    old = F.pmod(F.crc32(F.encode(F.coalesce("source", F.lit("")), "utf-8")), F.lit(10))
    out = sharding.rewritten(docs, old, 8)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard"
    )


@query
def op9_streaming_viterbi(spark, sf_dir):
    return viterbi.encoded(table(spark, sf_dir, "documents"), fertility.vocabulary_path())


@query
def op10_boundary_chain(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


ORACLE["op10_boundary_chain"] = warc.round_trip_sql()


@query
def op11_str_rtree(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLE["op11_str_rtree"] = negatives.mined_sql()


@query
def op12_exact_whitening(spark, sf_dir):
    """`deviation` is NULL where it does not fit a long (many rows); `deviation_exact` has it then too."""
    out = whitening.whitened(table(spark, sf_dir, "embeddings"))
    exact = F.col("deviation").alias("deviation_exact")
    return out.select("vec_id", "component", "n", F.expr("try_cast(deviation AS long)").alias("deviation"), "whitened", "explained", "identity_error", exact)


@query
def op13_positional_index(spark, sf_dir):
    return postings.decontaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op13_positional_index"] = postings.decontaminated_sql()
