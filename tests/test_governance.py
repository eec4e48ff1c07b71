import random

from helpers import by, housing_rows

from plumbline.operators import governance as g
from plumbline.operators.rule import rule_table
from plumbline.operators.run import Run
from plumbline.plans import governance_data as gov
from plumbline.plans import housing as pack


def test_routes_split_elements(spark):
    assign = spark.createDataFrame(gov.ASSIGNMENTS, gov.ASSIGNMENT_SCHEMA)
    routes = g.routes(rule_table(spark, pack.rules()), assign).collect()
    reached = {}
    for r in routes:
        reached.setdefault(r["Rule_ID"], set()).add(r["CDE"])
    assert reached["DQ-006"] == reached["DQ-015"] == {"GEO / GEO_CODE"}
    assert reached["DQ-010"] == {"REF_DATE", "GEO / GEO_CODE", "DWELLING_TYPE", "INTENDED_MARKET"}
    assert "DQ-012" not in reached
    assert len(routes) == len({(r["Rule_ID"], r["CDE"]) for r in routes})


def test_routing_and_load(spark):
    df = housing_rows(spark, {"HOUSING_STARTS": -1.0}, {"GEO_CODE": "XX"}, {"STATUS": "?"}, {})
    run = Run(df, pack.rules(), as_of="2026-12")
    assign = spark.createDataFrame(gov.ASSIGNMENTS, gov.ASSIGNMENT_SCHEMA)
    load = {(r["Rule_ID"], r["CDE"]): r["Failures"] for r in g.steward_load(run.scorecard(), assign).collect()}
    assert load == {("DQ-002", "HOUSING_STARTS"): 1, ("DQ-006", "GEO / GEO_CODE"): 1, ("DQ-015", "GEO / GEO_CODE"): 1}
    assert g.route_exceptions(run.exceptions(), run.rule_table, assign).count() == 3


def test_thresholds(spark):
    rows = [{}] * 99 + [{"HOUSING_STARTS": None}]
    status = lambda df: {(r["CDE"], r["Threshold"]): (r["Within_Limit"], r["CDE_Status"]) for r in g.threshold_compliance(df, gov.LIMITS).collect()}
    one_percent = status(housing_rows(spark, *rows))
    assert one_percent[("HOUSING_STARTS", "< 1% null")] == (False, "Requires remediation")
    assert one_percent[("HOUSING_STARTS", "0% negative")] == (True, "Requires remediation")
    assert one_percent[("AVERAGE_PRICE_CAD", "< 2% null")] == (True, "Compliant")
    below = status(housing_rows(spark, {}, *rows))
    assert below[("HOUSING_STARTS", "< 1% null")] == (True, "Compliant")


def test_conformance(spark):
    df = spark.createDataFrame([("a", 1.0, 3), (None, 2.0, 4)], "REF_DATE string, AVERAGE_PRICE_CAD double, x int")
    dictionary = [("REF_DATE", "text", False), ("AVERAGE_PRICE_CAD", "decimal", True), ("GEO", "text", False)]
    rows = by(g.conformance(df, dictionary), "Column")
    assert {k: (r["Actual_Type"], r["Null_Count"], r["Conforms"]) for k, r in rows.items()} == {
        "REF_DATE": ("text", 1, False), "AVERAGE_PRICE_CAD": ("decimal", 0, True), "GEO": (None, None, False), "x": ("integer", 0, False),
    }


def test_trace_follows_hops_and_ends_on_cycles(spark):
    edges = [("c", "s0", "a", "s1", "b"), ("c", "s1", "b", "s2", "d"), ("c", "s2", "d", "s1", "b"), ("other", "s9", "z", "s2", "d")]
    df = spark.createDataFrame(edges, gov.EDGE_SCHEMA)
    roots = spark.createDataFrame([("c", "s2", "d")], gov.ROOT_SCHEMA)
    hops = sorted((r["hop"], r["src_system"], r["dst_system"]) for r in g.trace(df, roots).collect())
    assert hops == [(1, "s1", "s2"), (2, "s0", "s1"), (2, "s2", "s1")]
    assert g.trace(df, roots, max_depth=1).count() == 1


def test_coverage(spark):
    run = Run(housing_rows(spark, {"HOUSING_STARTS": None}, {}), pack.rules(), as_of="2026-12")
    cdes = spark.createDataFrame([(c,) for c in [*pack.CRITICAL_DATA_ELEMENTS, "UOM"]], "CDE string")
    rows = by(g.cde_coverage(run.scorecard(), cdes), "CDE")
    assert (rows["HOUSING_STARTS"]["Rules"], rows["HOUSING_STARTS"]["Failures"], rows["UOM"]["Rules"]) == (3, 1, 0)
    free = g.uncovered_columns(["GEO", "UOM", "DECIMALS"], run.rule_table)
    assert sorted(r["column"] for r in free.collect()) == ["DECIMALS", "UOM"]


def walked(edges, roots):
    """Hop by hop, per element."""
    found = {}
    for cde in {c for c, *_ in roots}:
        front, seen, hop = {(s, f) for c, s, f in roots if c == cde}, set(), 0
        while front:
            hop += 1
            step = {e for e in edges if e[0] == cde and (e[3], e[4]) in front and e not in found}
            found |= {e: hop for e in step}
            seen |= front
            front = {(e[1], e[2]) for e in step} - seen
    return found


def test_trace_equals_a_walk_hop_by_hop(spark):
    draw = random.Random(11)
    for nodes, many in ((12, 10), (12, 18), (30, 30), (40, 60)):
        edges = {(draw.choice("cd"), f"s{draw.randrange(nodes)}", "f", f"s{draw.randrange(nodes)}", "f") for _ in range(many)}
        roots = {("c", "s0", "f"), ("c", "s1", "f"), ("d", "s2", "f")}
        got = g.trace(spark.createDataFrame(sorted(edges), gov.EDGE_SCHEMA), spark.createDataFrame(sorted(roots), gov.ROOT_SCHEMA))
        assert {(r["cde"], *[r[c] for c in ("src_system", "src_field", "dst_system", "dst_field")]): r["hop"] for r in got.collect()} == walked(edges, roots)


def test_a_long_chain_takes_few_tables(spark, monkeypatch):
    made = []
    monkeypatch.setattr(g, "materialize", lambda df, keep=g.materialize: made.append(1) or keep(df))
    edges = [("c", f"s{i}", "f", f"s{i + 1}", "f") for i in range(1000)]
    got = g.trace(spark.createDataFrame(edges, gov.EDGE_SCHEMA), spark.createDataFrame([("c", "s1000", "f")], gov.ROOT_SCHEMA))
    assert {r["src_system"]: r["hop"] for r in got.collect()} == {f"s{i}": 1000 - i for i in range(1000)}
    assert len(made) < 35
