"""Queries through files: tables written to the shared folder, read back, and used."""

from __future__ import annotations

import contextlib
import json
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import contract as contracts
from plumbline.operators import bands as ranges
from plumbline.operators import explore, governance, marks, profile, scorecards, statistics
from plumbline.operators.checks import Unique
from plumbline.operators.lookup import attach
from plumbline.operators.remediate import remediate
from plumbline.operators.rule import Scope
from plumbline.operators.run import Run
from plumbline.plans import governance_data as gov
from plumbline.plans import housing as pack
from plumbline.plans import packs
from plumbline.plans.fixture import housing, table
from plumbline.plans.housing_contract import contract
from plumbline.plans.queries import AS_OF, DATASET, KEY, RUN_DATE, full_housing, housing_run, query, rounded
from plumbline.session import shared_dir
from plumbline.sources import commits, outputs, tables
from plumbline.streaming import keys, monitor


#: Rows of a file that a query writes for itself; larger tables make more files, as a file is written by one task.
FILE_ROWS = 500_000


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _files(rows: DataFrame, least: int = 1) -> int:
    """So many files for a table, in multiples of `least`."""
    return least * max(1, -(-rows.count() // (least * FILE_ROWS)))


@query
def csv_round_trip(spark, sf_dir):
    """customer as several delimited files, and back."""
    customers = table(spark, sf_dir, "customer")
    path = _folder(spark, "customer-csv")
    outputs.export_csv(customers.repartition(3, "c_custkey"), path)
    return tables.read_csv(spark, path, customers.schema)


@query
def column_gate(spark, sf_dir):
    """Rows per status of a table that has all required columns."""
    orders = table(spark, sf_dir, "orders")
    tables.require_columns(orders, ["o_orderkey", "o_custkey", "o_orderstatus"])
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query
def column_gate_missing(spark, sf_dir):
    """Which columns customer lacks of those that a hand-in must have."""
    return tables.column_gate(table(spark, sf_dir, "customer"), ["c_custkey", "c_country", "c_acctbal", "c_email"])


@query
def sigma_range_inner(spark, sf_dir):
    """The statistical listing of rows that have group statistics only."""
    return rounded(housing_run(spark, sf_dir).violations("DQ-014", KEY, inner=True))


@query
def template_filled(spark, sf_dir):
    """The fixture handed in by the columns of the empty template."""
    blank = tables.empty_template(spark, pack.REQUIRED_COLUMNS)
    filled = blank.unionByName(housing(spark, sf_dir).select(*pack.REQUIRED_COLUMNS))
    return filled.groupBy("DWELLING_TYPE").agg(F.count(F.lit(1)).alias("records"), F.sum("HOUSING_STARTS").alias("starts"))


@query
def record_ids_folder(spark, sf_dir):
    """orders as several files of uneven size, numbered over all of them."""
    path = _folder(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    for part, rows in enumerate((orders.filter("o_orderkey < 100"), orders.filter("o_orderkey >= 100"))):
        # files are named by their place in the order
        rows.repartitionByRange(_files(rows), "o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(f"{path}/part={part}")
    return tables.with_record_id(spark.read.parquet(path).drop("part"))


@query
def contract_from_file(spark, sf_dir):
    """The contract read from a JSON file."""
    path = f"{_folder(spark, 'contract')}.json"
    spark.createDataFrame([(json.dumps(contract()),)], "value string").coalesce(1).write.text(path)
    return contracts.validate(full_housing(spark, sf_dir), tables.read_contract(spark, path), housing_run(spark, sf_dir).scorecard())


@query
def steward_load_from_file(spark, sf_dir):
    """Assignments read from a delimited governance table."""
    path = _folder(spark, "assignments")
    outputs.export_csv(spark.createDataFrame(gov.ASSIGNMENTS, gov.ASSIGNMENT_SCHEMA).coalesce(1), path)
    return governance.steward_load(housing_run(spark, sf_dir).scorecard(), tables.read_reference(spark, path))


TABLES = (outputs.REMEDIATED, outputs.EXCEPTIONS, outputs.SCORECARD, outputs.SUMMARY, outputs.BY_DIMENSION)


def _summary(scorecard: DataFrame) -> DataFrame:
    return scorecards.summary(scorecard, DATASET, RUN_DATE)


def _run_outputs(df: DataFrame, run: Run, path: str, summary=_summary) -> None:
    fixed = remediate(df, pack.rules(), pack.REMEDIATION, RUN_DATE, as_of=AS_OF)
    outputs.write_outputs(path, fixed, run.exceptions(), run.scorecard(), summary, scorecards.by_dimension)


def _written(name: str) -> None:
    def fn(spark, sf_dir):
        path = _folder(spark, "outputs")
        _run_outputs(housing(spark, sf_dir), housing_run(spark, sf_dir), path)
        return tables.read_optional(spark, f"{path}/{name}")

    fn.__name__ = f"outputs_{name}"
    fn.__doc__ = f"A run's outputs are written; {name} read back."
    query(fn)


for _name in TABLES:
    _written(_name)


@query
def outputs_rerun(spark, sf_dir):
    """A run with exceptions, then one without into the same folder: what is left of the exceptions beside each rule."""
    path = _folder(spark, "rerun")
    df = housing(spark, sf_dir)
    rules = [r for r in pack.rules() if r.rule_id in ("DQ-001", "DQ-002")]
    for rows in (df, df.filter("HOUSING_STARTS >= 0")):
        _run_outputs(rows, Run(rows, rules, as_of=AS_OF, run_ts="t"), path)
    left = tables.read_optional(spark, f"{path}/{outputs.EXCEPTIONS}")
    n = 0 if left is None else left.count()
    score = tables.read_optional(spark, f"{path}/{outputs.SCORECARD}")
    return score.select("Rule_ID", "Total_Records", "Records_Failed", F.lit(n).cast("long").alias("Exceptions_Left"))


@query
def outputs_committed(spark, sf_dir):
    """A run that is committed, then one over fewer rows that breaks off after its second table: what readers see."""
    path = _folder(spark, "committed")
    df = housing(spark, sf_dir)

    def broken(scorecard: DataFrame) -> DataFrame:
        raise InterruptedError("the run breaks off")

    commits.commit_tables(spark, path, lambda folder: _run_outputs(df, housing_run(spark, sf_dir), folder), TABLES, "whole")
    fewer = df.filter("HOUSING_STARTS >= 0")
    run = Run(fewer, pack.rules(), as_of=AS_OF, run_ts="t")
    with contextlib.suppress(InterruptedError):
        commits.commit_tables(spark, path, lambda folder: _run_outputs(fewer, run, folder, broken), TABLES, "broken")
    seen = commits.committed(spark, path)
    listed = commits.read_committed(spark, path, outputs.EXCEPTIONS, seen).groupBy("_rule_id").agg(F.count(F.lit(1)).alias("Listed"))
    score = commits.read_committed(spark, path, outputs.SCORECARD, seen).select("Rule_ID", "Total_Records", "Records_Failed")
    rows = commits.read_committed(spark, path, outputs.REMEDIATED, seen).count()
    score = score.join(listed, F.col("Rule_ID") == F.col("_rule_id"), "left").drop("_rule_id")
    return score.select("*", F.lit(rows).cast("long").alias("Remediated"), F.lit(seen["note"]).alias("Run")).fillna(0, ["Listed"])


@query
def score_history(spark, sf_dir):
    """The pass rate of the order rules for every year of orders, from one scan, and its change."""
    path = _folder(spark, "history")
    years = table(spark, sf_dir, "orders").withColumn("run_date", F.concat(F.year("o_orderdate").cast("string"), F.lit("-12-31")))
    monitor.append_histories(Run(years, packs.order_rules()).scorecard_by("run_date"), path)
    history = spark.read.option("basePath", path).parquet(path).withColumn("run_date", F.col("run_date").cast("string"))
    return monitor.rate_changes(history)


def _in_batches(spark: SparkSession, rows: DataFrame, name: str, *spread: str, files: int = 6, per_batch: int = 2) -> DataFrame:
    """The rows as a stream of files, several batches of them. A larger table makes more files, and as many batches; `spread` are
    columns with many more values than there are files."""
    path = _folder(spark, name)
    many = _files(rows, files)
    rows.repartition(many, *spread).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", per_batch * many // files).parquet(path)


@query
def stream_uniqueness(spark, sf_dir):
    """lineitem streamed in three batches and scored by its whole pack: the keys of the grain rule are counted over all
    batches, references are looked up in each."""
    path = _folder(spark, "stream-keys")
    lines = packs.lineitem(spark, sf_dir)
    rules = packs.lineitem_rules(spark, sf_dir)
    stream = _in_batches(spark, lines, "lineitem-files", "l_partkey")  # lines of one order lie in several files
    counting = keys.count_keys(stream, rules, path, availableNow=True)
    others = [r for r in rules if not isinstance(r.check, Unique)]
    stats = monitor.snapshot(lines, rules)
    scoring = monitor.score_stream(stream, others, path, as_of="2001-06", stats=stats, with_exceptions=False, availableNow=True)
    for started in [*counting, scoring]:
        started.awaitTermination()
    return monitor.scorecard_so_far(spark, path, rules)


@query
def stream_copies(spark, sf_dir):
    """The lines that repeat an order and line number, listed from the keys that a stream has counted."""
    path = _folder(spark, "stream-copies")
    lines = packs.lineitem(spark, sf_dir)
    rule = next(r for r in packs.lineitem_rules(spark, sf_dir) if r.rule_id == "LI-007")
    for started in keys.count_keys(_in_batches(spark, lines, "lineitem-files", "l_suppkey", "l_partkey"), [rule], path, availableNow=True):
        started.awaitTermination()
    found = attach(lines, keys.facts(spark, path, rule, Scope(lines.schema))).filter(rule.check.fails(Scope(lines.schema)))
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col(rule.check.flag).alias("duplicate_count"))


@query
def stream_statistics(spark, sf_dir):
    """events streamed in three batches; the statistics that the stream has learned, which its last batch was scored by."""
    path = _folder(spark, "stream-statistics")
    stream = _in_batches(spark, table(spark, sf_dir, "events"), "event-files", "event_id")
    monitor.score_stream(stream, packs.event_rules(), path, with_exceptions=False, learn=True, availableNow=True).awaitTermination()
    found = monitor.statistics_so_far(spark, path, "event_type")
    rounded = [F.round(c, 4).alias(c) for c in ("mean", "stddev")]
    return found.select("event_type", F.col("column").alias("measure"), "records", "missing", *rounded, "low", "high")


@query
def statistics_by_month(spark, sf_dir):
    """The statistics of orders, kept month by month and merged by priority; whether the estimates hold what they promise."""
    path = _folder(spark, "order-statistics")
    orders = table(spark, sf_dir, "orders").withColumns({"part": F.date_format("o_orderdate", "yyyy-MM"), "customer": F.col("o_custkey").cast("double")})
    by, measured = ["o_orderpriority"], ["o_totalprice", "customer"]
    states = statistics.state(orders, ["part", *by], measured)
    states.repartition("part").write.partitionBy("part").parquet(path)
    found = statistics.describe(statistics.stored(spark, path), by)
    exact = orders.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("of"), F.col(c).cast("double").alias("value")) for c in measured])))
    truth = found.select(F.col("o_orderpriority").alias("p"), F.col("column").alias("of"), "q25", "q50", "q75")
    on = [F.col("o_orderpriority").eqNullSafe(F.col("p")), exact["of"] == truth["of"]]
    ranks = exact.join(F.broadcast(truth), on).groupBy("o_orderpriority", exact["of"]).agg(
        F.count_distinct("value").alias("distinct_values"), F.count("value").alias("n"), *[F.count_if(F.col("value") <= F.col(q)).alias(f"r{q}") for q in ("q25", "q50", "q75")]
    )  # as many groups as there are priorities and measures
    ranks = ranks.withColumnsRenamed({"o_orderpriority": "p", "of": "c"})
    joined = found.join(ranks, [F.col("o_orderpriority").eqNullSafe(F.col("p")), F.col("column") == F.col("c")])
    within = F.lit(True)
    for q, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        within = within & (F.abs(F.col(f"r{q}") / F.col("n") - share) <= F.lit(0.03) + F.lit(1) / F.col("n"))
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_values")) <= F.ceil(F.col("distinct_values") * 0.05)
    numbers = [F.round("mean", 2).alias("mean"), F.round("stddev", 2).alias("stddev")]
    return joined.select(*by, F.col("column").alias("measure"), "records", "missing", *numbers, "low", "high", within.alias("quartiles_hold"), near.alias("distinct_holds"))


@query
def scorecard_by_slice(spark, sf_dir):
    """The lineitem pack by return flag and line status, with totals by flag and over all lines."""
    run = Run(packs.lineitem(spark, sf_dir), packs.lineitem_rules(spark, sf_dir), as_of="2001-06")
    return run.scorecard_by("l_returnflag", "l_linestatus", totals=True)


@query
def scorecard_by_area(spark, sf_dir):
    """The housing pack by area code, a missing code being a slice of its own."""
    return housing_run(spark, sf_dir).scorecard_by("GEO_CODE")


@query
def csv_good_rows(spark, sf_dir):
    """orders as delimited files in which some cells are no numbers and some lines have a cell too many: the rows that can
    be read."""
    return _damaged(spark, sf_dir)[0]


@query
def csv_rejects(spark, sf_dir):
    """The same files' rejects, by reason and column."""
    rejects = _damaged(spark, sf_dir)[1]
    listed = rejects.select("reason", F.explode_outer("columns").alias("column"))
    return listed.groupBy("reason", "column").agg(F.count(F.lit(1)).alias("rows"))


def _damaged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = _folder(spark, "orders-csv")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    key = F.col("o_orderkey")
    text = {c: F.col(c).cast("string") for c in columns}
    text["o_custkey"] = F.when(key % 11 == 0, F.concat(F.lit("c"), text["o_custkey"])).otherwise(text["o_custkey"])
    text["o_totalprice"] = F.when(key % 7 == 0, F.lit("much")).otherwise(text["o_totalprice"])
    line = F.concat_ws(",", *[text[c] for c in columns], F.when(key % 13 == 0, F.lit("surplus")))
    # each file begins with a header
    files = _files(orders, 3)
    lines = orders.select(line.alias("value"), F.pmod(key, F.lit(files)).alias("file"))
    head = spark.range(files).select(F.lit(",".join(columns)).alias("value"), F.col("id").alias("file"))
    both = head.withColumn("at", F.lit(0)).unionByName(lines.withColumn("at", F.lit(1)))
    # by ranges, as hashes would put several files into one task
    both.repartitionByRange(files, "file").sortWithinPartitions("file", "at").select("value", "file").write.partitionBy("file").text(path)
    return tables.read_csv_lenient(spark, f"{path}/file=*", orders.schema)


@query
def exception_page_far(spark, sf_dir):
    """The eighth page of the exceptions, from a stored order in ranges of 200 rows, of which one or two are read."""
    path = _folder(spark, "pages")
    order = ["record_key", "_rule_id"]
    rows = explore.project_existing(housing_run(spark, sf_dir).exceptions(), ["record_key", *explore.EXCEPTION_COLUMNS])
    explore.store_pages(rows, order, path, range_rows=200)
    return explore.stored_page(spark, path, order, 8)


@query
def escalation_from_file(spark, sf_dir):
    """Severity bands read from a delimited file."""
    path = _folder(spark, "bands")
    outputs.export_csv(spark.createDataFrame(gov.BANDS, gov.BAND_SCHEMA).coalesce(1), path)
    checked = governance.escalation_bands(tables.read_reference(spark, path))
    return governance.escalation(housing_run(spark, sf_dir).scorecard(), checked)


@query
def orders_by_price_band(spark, sf_dir):
    """orders in bands between one hundredth of each supplier's key and the next, as many bands as there are suppliers."""
    keys_ = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 3000).cast("string").alias("begin"))
    nearest = keys_.select(F.col("begin").cast("long").alias("at"))
    step = keys_.withColumn("end", (F.col("begin").cast("long") + 3000).cast("string"))
    last = nearest.agg(F.max("at").alias("at")).select(F.col("at").cast("string").alias("top"))
    named = step.join(F.broadcast(last), F.col("begin") == F.col("top"), "left").withColumn("end", F.when(F.col("top").isNull(), F.col("end"))).drop("top")
    checked = ranges.bands(named, "begin", "end")
    found = ranges.in_band(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), checked, F.col("o_totalprice"))
    return found.groupBy("begin").agg(F.count(F.lit(1)).alias("orders"), F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most"))


@query
def lineage_long_chain(spark, sf_dir):
    """Customers in a chain by key, walked from the last one to the first: a hop for each, in a number of steps that grows
    with the logarithm of the chain."""
    customers = table(spark, sf_dir, "customer").filter("c_custkey > 1")
    key = F.col("c_custkey")
    edges = customers.select(
        F.lit("C").alias("cde"), (key - 1).cast("string").alias("src_system"), F.lit("k").alias("src_field"), key.cast("string").alias("dst_system"), F.lit("k").alias("dst_field")
    )
    roots = customers.agg(F.max("c_custkey").cast("string").alias("system")).select(F.lit("C").alias("cde"), "system", F.lit("k").alias("field"))
    return governance.trace(edges, roots).select("hop", "src_system", "dst_system")


@query
def lineage_systems(spark, sf_dir):
    """Every upstream hop between systems, by layer, with the failures found in the data that flow through it."""
    hops = governance.trace(spark.createDataFrame(gov.SYSTEM_EDGES, gov.EDGE_SCHEMA), spark.createDataFrame(gov.SYSTEM_ROOTS, gov.ROOT_SCHEMA))
    found = housing_run(spark, sf_dir).scorecard().agg(F.sum("Records_Failed").alias("Failures"))
    return hops.join(F.broadcast(found))  # one row


def _marked(spark: SparkSession, sf_dir: str) -> tuple[Run, DataFrame]:
    lines = packs.with_month(tables.with_record_id(table(spark, sf_dir, "lineitem")))
    run = Run(lines, packs.lineitem_rules(spark, sf_dir), as_of="2001-06")
    return run, marks.marks(run)


@query
def lineitem_unique_failed(spark, sf_dir):
    """Lines that fail any rule of a pack with two rules over many rows, from bitmaps of line numbers."""
    return marks.unique_failed(*_marked(spark, sf_dir))


@query
def rules_failing_together(spark, sf_dir):
    """Pairs of rules with the lines that fail both."""
    return marks.failing_together(_marked(spark, sf_dir)[1])


@query
def turn_texts_unique(spark, sf_dir):
    """The conversation pack with its wide keys counted by hash first: only texts whose hash repeats are grouped."""
    rules = [r.with_(check=replace(r.check, candidates=True, digest=False)) if isinstance(r.check, Unique) else r for r in packs.turn_rules()]
    return Run(table(spark, sf_dir, "conversations"), rules).scorecard()


@query
def profile_sketch_error(spark, sf_dir):
    """The approximate profile of lineitem's numbers: whether its quartiles and distinct values are as near as promised."""
    off = profile.sketch_error(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount"])
    near = (F.col("Rank_Error") <= profile.RANK_ERROR).alias("Quartiles_Hold"), (F.col("Distinct_Error") <= profile.DISTINCT_ERROR).alias("Distinct_Holds")
    return off.select("Column", "Not_Null_Count", "Unique_Values", *near)


@query
def contract_many_invalid(spark, sf_dir):
    """A domain that nearly all values miss: the check counts them, however many there are."""
    spec = {"schema": {"fields": [{"name": "p_name", "validValues": ["cold widget"]}, {"name": "p_brand", "validValues": ["Brand#1"]}]}}
    return contracts.value_details(table(spark, sf_dir, "part").withColumn("p_name", F.concat_ws("-", "p_name", "p_partkey")), spec)


@query
def lineage_chain(spark, sf_dir):
    """A chain of as many hops as there are nations, less one."""
    nations = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey").cast("string")
    after = (F.col("n_nationkey") + 1).cast("string")
    edges = nations.select(
        F.lit("N").alias("cde"), key.alias("src_system"), F.lit("k").alias("src_field"), after.alias("dst_system"), F.lit("k").alias("dst_field")
    )
    roots = nations.agg(F.max("n_nationkey").cast("string").alias("system")).select(F.lit("N").alias("cde"), "system", F.lit("k").alias("field"))
    return governance.trace(edges, roots).select("hop", "src_system", "dst_system")
