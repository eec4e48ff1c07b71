"""The same queries in plain SQL, written from the rules' definitions, to check the Spark results against."""

from __future__ import annotations

from plumbline.plans import governance_data as gov
from plumbline.plans import io_queries  # noqa: F401  registers its queries
from plumbline.plans import housing as pack
from plumbline.plans import packs
from plumbline.plans.fixture import housing_sql
from plumbline.plans.housing_contract import DOMAIN_CHECKS, FIELDS, SERVICE_LEVELS
from plumbline.plans.queries import AS_OF, DATASET, RUN_DATE, RUN_TS


def q(text: object) -> str:
    return "NULL" if text is None else "'" + str(text).replace("'", "''") + "'"


def listed(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def half_up(num: str, den: str) -> str:
    return f"((({num}) * 2 + ({den})) // (2 * ({den})))"


def pct(part: str, total: str) -> str:
    """100 * part / total with two places."""
    return f"CASE WHEN {total} > 0 THEN {half_up(f'{part} * 10000', total)} ELSE 0 END / CAST(100 AS DOUBLE)"


def tenths(part: str, total: str) -> str:
    return f"{half_up(f'({part}) * 1000', total)} / CAST(10 AS DOUBLE)"


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


HS = f"hs AS ({housing_sql()})"
WIDE = f"hw AS ({housing_sql(wide=True)})"

# Failing rows of the fifteen rules; hm, hd, pm, pd are mean and deviation of starts and price in the row's code.
FAILS = {
    "DQ-001": "HOUSING_STARTS IS NULL",
    "DQ-002": "HOUSING_STARTS < 0",
    "DQ-003": "AVERAGE_PRICE_CAD IS NULL AND coalesce(STATUS, '') <> 'F'",
    "DQ-004": "AVERAGE_PRICE_CAD < 0",
    "DQ-005": "AVERAGE_PRICE_CAD > 2000000",
    "DQ-006": f"GEO_CODE IS NULL OR GEO_CODE NOT IN {listed(pack.GEO_CODES.values())}",
    "DQ-007": f"DWELLING_TYPE IS NULL OR DWELLING_TYPE NOT IN {listed(pack.DWELLING_TYPES)}",
    "DQ-008": f"INTENDED_MARKET IS NULL OR INTENDED_MARKET NOT IN {listed(pack.MARKETS)}",
    "DQ-009": "REF_DATE IS NULL OR NOT regexp_matches(REF_DATE, '^[0-9]{4}-[0-9]{2}$')",
    "DQ-010": "copies > 1",
    "DQ-011": f"REF_DATE IS NULL OR REF_DATE > {q(AS_OF)}",
    "DQ-012": "coalesce(STATUS, '') NOT IN ('', 'E', 'F', 'r')",
    "DQ-013": "HOUSING_STARTS > 20000 OR HOUSING_STARTS > hm + 3 * hd",
    "DQ-014": "AVERAGE_PRICE_CAD < 100000 OR AVERAGE_PRICE_CAD > 3000000 OR AVERAGE_PRICE_CAD > pm + 3 * pd",
    "DQ-015": "("
    + " OR ".join(f"(GEO = {q(n)} AND coalesce(GEO_CODE, '?') <> {q(c)})" for n, c in pack.GEO_CODES.items())
    + ")",
}


def flag(rule_id: str) -> str:
    return "f" + rule_id[-3:]


def flagged(source: str = "hs", fails: dict[str, str] = FAILS, name: str = "flags") -> str:
    """CTEs that add one boolean per rule to every row of the source."""
    return f"""stats_{name} AS (
      SELECT GEO_CODE AS code, avg(HOUSING_STARTS) AS hm, stddev_samp(HOUSING_STARTS) AS hd,
        avg(AVERAGE_PRICE_CAD) AS pm, stddev_samp(AVERAGE_PRICE_CAD) AS pd
      FROM {source} GROUP BY GEO_CODE),
    seen_{name} AS (
      SELECT s.*, hm, hd, pm, pd, count(*) OVER (PARTITION BY {", ".join(pack.GRAIN)}) AS copies
      FROM {source} s LEFT JOIN stats_{name} ON s.GEO_CODE = code),
    {name} AS (SELECT *, {", ".join(f"coalesce({sql}, false) AS {flag(r)}" for r, sql in fails.items())} FROM seen_{name})"""


def scored(rules, source: str = "flags", name: str = "sc", flags=None) -> str:
    """CTE with the twelve scorecard columns and the rate in basis points (bp)."""
    flags = flags or {r.rule_id: flag(r.rule_id) for r in rules}
    counts = union(
        f"SELECT {q(r.rule_id)} AS Rule_ID, {q(r.name)} AS Rule_Name, {q(r.dimension)} AS DQ_Dimension, "
        f"{q(r.cde)} AS CDE_Affected, {q(r.description)} AS Description, {q(r.severity)} AS Severity, "
        f"count(*) AS t, count(*) FILTER (WHERE {flags[r.rule_id]}) AS f, {q(r.remediation)} AS Remediation_Action "
        f"FROM {source}"
        for r in rules
    )
    return f"""{name} AS (
      SELECT Rule_ID, Rule_Name, DQ_Dimension, CDE_Affected, Description, Severity, t AS Total_Records,
        t - f AS Records_Passed, f AS Records_Failed, {half_up("(t - f) * 10000", "t")} AS bp,
        {pct("(t - f)", "t")} AS Pass_Rate_Pct,
        CASE WHEN {pct("(t - f)", "t")} = 100 THEN 'PASS' WHEN {pct("(t - f)", "t")} >= 95 THEN 'WARN' ELSE 'FAIL' END
          AS Status, Remediation_Action
      FROM ({counts}))"""


RULES = pack.rules()
FLAGS = f"{HS}, {flagged()}"
SCORE = f"{FLAGS}, {scored(RULES)}"
SCORECARD = "SELECT * EXCLUDE (bp) FROM {}"

EXCEPTIONS = "ex AS (" + union(
    f"SELECT hs.*, {q(r.rule_id)} AS _rule_id, {q(r.name)} AS _rule_name, {q(r.dimension)} AS _dimension, "
    f"{q(r.cde)} AS _cde, {q(r.severity)} AS _severity, {q(r.description)} AS _failure_reason, "
    f"{q(r.remediation)} AS _remediation, {q(RUN_TS)} AS _flagged_at "
    f"FROM flags JOIN hs USING (record_key) WHERE {flag(r.rule_id)}"
    for r in RULES
) + ")"

UNIQUE = f"""uf AS (SELECT count(*) AS total_records, count(*) FILTER (WHERE {" OR ".join(flag(r) for r in FAILS)})
  AS failed_records FROM flags)"""

DIMENSIONS = ("Completeness", "Validity", "Uniqueness", "Accuracy", "Consistency")


def grade(score: str, steps=(("A", 99), ("B", 95)), last: str = "C") -> str:
    return "CASE " + " ".join(f"WHEN {score} >= {x} THEN '{g}'" for g, x in steps) + f" ELSE '{last}' END"


def mean(where: str = "true") -> str:
    n = f"count(*) FILTER (WHERE {where})"
    return f"CASE WHEN {n} > 0 THEN {half_up(f'sum(bp) FILTER (WHERE {where})', n)} / CAST(100 AS DOUBLE) END"


def mean1(where: str = "true") -> str:
    n = f"count(*) FILTER (WHERE {where})"
    return f"CASE WHEN {n} > 0 THEN {half_up(f'sum(bp) FILTER (WHERE {where})', f'{n} * 10')} / CAST(10 AS DOUBLE) END"


TALLY = ", ".join(f"count(*) FILTER (WHERE Status = '{s}') AS {{{i}}}" for i, s in enumerate(("PASS", "WARN", "FAIL")))

SUMMARY = f"""summ AS (SELECT {q(DATASET)} AS Dataset, {q(RUN_DATE)} AS Scorecard_Date, max(Total_Records) AS Total_Records,
  count(*) AS Total_DQ_Rules, {TALLY.format("Rules_PASS", "Rules_WARN", "Rules_FAIL")},
  CAST(sum(Records_Failed) AS BIGINT) AS Total_Rule_Failures, {mean()} AS Overall_DQ_Score_Pct,
  {grade(mean())} AS Overall_Grade, {", ".join(f"{mean(f'DQ_Dimension = {q(d)}')} AS {d}_Score" for d in DIMENSIONS)},
  coalesce('Escalate ' || string_agg(Rule_ID, ', ' ORDER BY Rule_ID) FILTER (WHERE Status <> 'PASS')
    || ' to Data Steward.', 'No action required.') AS Recommended_Action FROM sc)"""


def run_summary(score: str) -> str:
    steps = (("A", 99), ("B", 95), ("C", 90))
    return f"""SELECT max(Total_Records) AS total_records, count(*) AS total_rules,
      {TALLY.format("n_pass", "n_warn", "n_fail")}, CAST(sum(Records_Failed) AS BIGINT) AS total_failed,
      {mean1()} AS overall_score, {grade(mean1(), steps, "D")} AS overall_grade,
      (SELECT {tenths("total_records - failed_records", "total_records")} FROM uf) AS clean_pct,
      {", ".join(f"coalesce({mean1(f'DQ_Dimension = {q(d)}')}, 100.0) AS {d.lower()}" for d in DIMENSIONS)}
      FROM {score}"""


def violations(rule, source: str, where: str, keys, value: str, reason: str | None = None, extra: str = "") -> str:
    return (
        f"SELECT {q(rule.rule_id)} AS rule_id, {q(rule.name)} AS rule_name, {q(rule.dimension)} AS dq_dimension, "
        f"{', '.join(keys)}, {value}, {extra}{reason or q(rule.reason or rule.description)} AS failure_reason "
        f"FROM {source} WHERE {where}"
    )


def housing_violations(rule_id: str, value: str, reason: str | None = None, extra: str = "") -> str:
    rule = next(r for r in RULES if r.rule_id == rule_id)
    return f"WITH {FLAGS} {violations(rule, 'flags', flag(rule_id), ['record_key'], value, reason, extra)}"


def sigma_columns(value: str, m: str, d: str, k: float = 3, places: int = 2) -> str:
    return (
        f"{value} AS failed_value, round({m}, 4) AS group_mean, round({d}, 4) AS group_std, "
        f"round({m} + {k} * {d}, {places}) AS upper_threshold"
    )


# The packs over the other tables. Rules that need a session only for their reference table are listed by their texts.

LINE = "li AS (SELECT *, substr(cast(l_shipdate AS string), 1, 7) AS ship_month FROM lineitem)"
LINE_RULES = [
    packs.rule(i, n, d, c, None)
    for i, n, d, c in (
        ("LI-001", "Quantity present", "Completeness", "l_quantity"),
        ("LI-002", "Discount range", "Validity", "l_discount"),
        ("LI-003", "Price ceiling", "Validity", "l_extendedprice"),
        ("LI-004", "Return flag domain", "Validity", "l_returnflag"),
        ("LI-005", "Ship month format", "Validity", "ship_month"),
        ("LI-006", "Ship month not future", "Validity", "ship_month"),
        ("LI-007", "Line grain", "Uniqueness", "l_orderkey+l_linenumber"),
        ("LI-008", "Price range", "Accuracy", "l_extendedprice"),
        ("LI-009", "Flag and status agree", "Consistency", "l_returnflag + l_linestatus"),
        ("LI-010", "Customer order known", "Consistency", "l_orderkey"),
        ("LI-011", "Tax below discount", "Consistency", "l_tax + l_discount"),
        ("LI-012", "Small bulk lines", "Accuracy", "l_quantity"),
    )
]
LINE_FAILS = {
    "LI-001": "l_quantity IS NULL",
    "LI-002": "l_discount < 0.01::DOUBLE OR l_discount > 0.09::DOUBLE",
    "LI-003": "l_extendedprice > 90000",
    "LI-004": "l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'N')",
    "LI-005": "ship_month IS NULL OR NOT regexp_matches(ship_month, '^[0-9]{4}-[0-9]{2}$')",
    "LI-006": "ship_month IS NULL OR ship_month > '2001-06'",
    "LI-007": "copies > 1",
    "LI-008": "l_extendedprice > m + 2 * d",
    "LI-009": "l_returnflag IN ('A', 'R') AND l_linestatus IS DISTINCT FROM 'F'",
    "LI-010": "o_orderkey IS NULL",
    "LI-011": "l_tax > l_discount",
    "LI-012": "l_quantity > 45 AND l_extendedprice < 20000",
}
LINE_FLAGS = f"""{LINE}, ls AS (SELECT l_linenumber AS num, avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS d
    FROM li GROUP BY l_linenumber),
  lx AS (SELECT li.*, m, d, o_orderkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies
    FROM li LEFT JOIN ls ON l_linenumber = num
    LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey),
  lf AS (SELECT *, {", ".join(f"coalesce({sql}, false) AS f{i[-3:]}" for i, sql in LINE_FAILS.items())} FROM lx)"""
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ID = [*LINE_KEYS, "l_partkey", "l_suppkey"]


def line_rule(rule_id: str):
    return next(r for r in LINE_RULES if r.rule_id == rule_id)


def strict() -> str:
    rules = [line_rule(i) for i in ("LI-001", "LI-007", "LI-011", "LI-012")]
    status = "CASE WHEN Records_Failed = 0 THEN 'PASS' WHEN Pass_Rate_Pct >= 95 THEN 'WARN' ELSE 'FAIL' END"
    return f"WITH {LINE_FLAGS}, {scored(rules, 'lf')} SELECT * EXCLUDE (bp) REPLACE ({status} AS Status) FROM sc"


def upload() -> str:
    fails = {**FAILS, "DQ-003": "AVERAGE_PRICE_CAD IS NULL", "DQ-012": "false", "DQ-015": "false"}
    up = "up AS (SELECT * EXCLUDE (STATUS, GEO) FROM hs)"
    return f"{HS}, {up}, {flagged('up', fails)}, {scored(pack.upload_rules())}"


EV = """ev AS (SELECT e.*, m, d FROM events e LEFT JOIN (SELECT event_type AS k, avg(value) AS m, stddev_samp(value) AS d
  FROM events GROUP BY event_type) ON event_type = k)"""
EVENT_RULES = packs.event_rules()
TURN_RULES = packs.turn_rules()
BUSINESS = {
    "BR-001": "substr(LAST_UPDATED, 1, 7) < REF_DATE",
    "BR-002": "LAST_UPDATED IS NULL OR LAST_UPDATED > '2026-12-31'",
    "BR-003": "NOT (AVERAGE_PRICE_CAD > HOUSING_STARTS)",
    "BR-004": "(UOM = 'Units' AND SCALAR_FACTOR IS DISTINCT FROM 'units') OR "
    "(UOM = 'Thousands of Units' AND SCALAR_FACTOR IS DISTINCT FROM 'thousands')",
    "BR-005": "HOUSING_STARTS > 99999",
    "BR-006": "GEO IS NOT NULL AND GEO_CODE IS NULL",
    "BR-007": f"SURVEY_METHOD NOT IN {listed(pack.SURVEY_METHODS)}",
}

CAUSES = "causes AS (" + union(
    f"SELECT {q(name)} AS breakdown, {q(rule)} AS rule_id, "
    f"{'substr(REF_DATE, 1, 4)' if key == 'year' else key} AS key, count(*) AS failures "
    f"FROM flags WHERE {flag(rule)} AND {'REF_DATE' if key == 'year' else key} IS NOT NULL GROUP BY 3"
    for name, rule, key in pack.ROOT_CAUSES
) + ")"

# Remediation: values first, then flags on the corrected values.
FIXED = f"""fixed AS (SELECT * REPLACE (abs(HOUSING_STARTS) AS HOUSING_STARTS, abs(AVERAGE_PRICE_CAD) AS AVERAGE_PRICE_CAD),
    coalesce(HOUSING_STARTS < 0, false) AS was002, coalesce(AVERAGE_PRICE_CAD < 0, false) AS was004 FROM hs),
  {flagged("fixed", name="after")}"""
STEP_FLAGS = {"DQ-002": "was002", "DQ-004": "was004", "DQ-001": "f001", "DQ-003": "f003", "DQ-013": "f013", "DQ-014": "f014"}


def _remediation_flag() -> str:
    parts = []
    for step in pack.REMEDIATION:
        lead = "" if step.rule_id == "DQ-002" else " | "
        parts.append(f"CASE WHEN {STEP_FLAGS[step.rule_id]} THEN {q(lead + step.text)} ELSE '' END")
    return f"coalesce(nullif({' || '.join(parts)}, ''), 'CLEAN')"


REMEDIATED = f"""rem AS (SELECT record_key, REF_DATE, GEO, GEO_CODE, DWELLING_TYPE, INTENDED_MARKET, HOUSING_STARTS,
    AVERAGE_PRICE_CAD, STATUS, {_remediation_flag()} AS _dq_flag, {q(RUN_DATE)} AS _remediation_date FROM after)"""


def contract_sql(source: str, have: set[str], extra: list[str], sla: str) -> str:
    fields = [f for f in FIELDS if f["name"] in have]
    absent = [f["name"] for f in FIELDS if f["name"] not in have]
    out = []
    for label, names, word, level in (
        ("All contract fields present in dataset", absent, "Missing", "FAIL"),
        ("No undocumented columns in dataset", extra, "Undocumented", "WARN"),
    ):
        status, detail = (level, f"{word}: {names}") if names else ("PASS", "")
        out.append(f"SELECT 'schema' AS section, {q(label)} AS \"check\", {q(status)} AS status, {q(detail)} AS detail, {len(names)} AS violations")

    def line(section, label, bad, detail):
        return (
            f"SELECT {q(section)}, {q(label)}, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, CASE WHEN n > 0 THEN {detail} "
            f"ELSE '' END, n FROM (SELECT count(*) FILTER (WHERE {bad}) AS n FROM {source})"
        )

    for f in fields:
        name = f["name"]
        if f["required"]:
            out.append(line("required", f"{name} has no nulls (required: true)", f"{name} IS NULL", "n || ' null(s) found'"))
        if f.get("validValues"):
            bad = f"{name} NOT IN {listed(f['validValues'])}"
            values = (
                f"(SELECT 'Invalid values found: ' || count(DISTINCT {name}) || ' distinct in ' || count(*) || ' record(s)' "
                f"FROM {source} WHERE {bad})"
            )
            out.append(line("valid_values", f"{name} values within defined domain", bad, values))
        if "minimum" in f:
            out.append(line("range", f"{name} >= {f['minimum']:,}", f"{name} < {f['minimum']}", "n || ' record(s) below minimum'"))
        if "maximum" in f:
            out.append(line("range", f"{name} <= {f['maximum']:,}", f"{name} > {f['maximum']}", "n || ' record(s) above maximum'"))
        if f.get("format") == "YYYY-MM":
            bad = f"NOT regexp_matches({name}, '^[0-9]{{4}}-[0-9]{{2}}$')"
            out.append(line("format", f"{name} follows YYYY-MM format", bad, "n || ' record(s) with invalid format'"))
    for rule, field, tier, warn, critical in SERVICE_LEVELS:
        head = f"{rule} ({field}) — Tier {tier} SLA "
        out.append(
            f"SELECT 'sla', CASE WHEN r IS NULL THEN {q(rule + ' — result found in scorecard')} WHEN r >= {warn} THEN {q(head + 'met')} "
            f"WHEN r >= {critical} THEN {q(head + 'warn')} ELSE {q(head + 'CRITICAL breach')} END, "
            f"CASE WHEN r >= {warn} THEN 'PASS' WHEN r >= {critical} THEN 'WARN' ELSE 'FAIL' END, "
            f"CASE WHEN r IS NULL THEN 'Rule not found in scorecard' "
            f"WHEN r >= {warn} THEN 'Pass rate ' || printf('%.2f', r) || '% >= {warn}% warn threshold' "
            f"WHEN r >= {critical} THEN 'Pass rate ' || printf('%.2f', r) || '% below {warn}% warn threshold (above {critical}% critical)' "
            f"ELSE 'Pass rate ' || printf('%.2f', r) || '% below {critical}% critical threshold' END, n "
            f"FROM (SELECT max(Pass_Rate_Pct) AS r, coalesce(max(Records_Failed), 0) AS n FROM sc WHERE Rule_ID = {q(rule)} AND {sla})"
        )
    return union(out)


def level(rate: str, warn: int, critical: int) -> str:
    return f"CASE WHEN {rate} >= {warn} THEN 'PASS' WHEN {rate} >= {critical} THEN 'WARN' ELSE 'FAIL' END"


TIER_OF = "tiers AS (SELECT * FROM (VALUES " + ", ".join(f"({q(r)}, {t})" for r, _, t, *_ in SERVICE_LEVELS) + ") AS v(Rule_ID, tier))"
ALL_FIELDS = {f["name"] for f in FIELDS}
HS_FIELDS = ALL_FIELDS & {
    "REF_DATE", "GEO", "GEO_CODE", "DWELLING_TYPE", "INTENDED_MARKET", "HOUSING_STARTS", "AVERAGE_PRICE_CAD", "STATUS",
}
CHECKS = f"checks AS ({contract_sql('hw', ALL_FIELDS, [], 'true')})"


def profile(source: str, columns: dict[str, str], cdes=()) -> str:
    """`columns` maps each column to its Spark type."""
    out = []
    for c, kind in columns.items():
        number = kind in ("int", "bigint", "double")
        d = f"CAST({c} AS DOUBLE)"
        stat = (lambda sql: f"round({sql}, 4)") if number else (lambda sql: "CAST(NULL AS DOUBLE)")
        count = (lambda cond: f"count(*) FILTER (WHERE {cond})") if number else (lambda cond: "0")
        spread = f"(SELECT quantile_cont({d}, 0.25) AS q1, quantile_cont({d}, 0.75) AS q3 FROM {source})" if number else "(SELECT 0 AS q1, 0 AS q3)"
        outside = f"{c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)"
        mode = f"FROM (SELECT {c} AS v, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1)"
        out.append(
            f"""SELECT {q(c)} AS "Column", {q("Yes" if c in cdes else "No")} AS Is_CDE, {q(kind)} AS Data_Type, t AS Total_Records,
            t - n AS Null_Count, {pct("(t - n)", "t")} AS Null_Pct, n AS Not_Null_Count, {pct("n", "t")} AS Completeness_Pct,
            u AS Unique_Values, {pct("u", "t")} AS Unique_Pct, (SELECT CAST(v AS VARCHAR) {mode}) AS Top_Value,
            (SELECT n {mode}) AS Top_Value_Freq, lo AS Min, hi AS Max, me AS Mean, md AS Median, sd AS Std_Dev,
            neg AS Negative_Count, zero AS Zero_Count, pos AS Positive_Count, CASE WHEN {str(number).lower()} THEN round(q1, 4) END AS Q1,
            CASE WHEN {str(number).lower()} THEN round(q3, 4) END AS Q3, outl AS Outlier_Count_IQR, {pct("outl", "t")} AS Outlier_Pct_IQR
            FROM (SELECT count(*) AS t, count({c}) AS n, count(DISTINCT {c}) AS u, {stat(f"min({d})")} AS lo, {stat(f"max({d})")} AS hi,
              {stat(f"avg({d})")} AS me, {stat(f"quantile_cont({d}, 0.5)")} AS md, {stat(f"stddev_samp({d})")} AS sd,
              {count(f"{c} < 0")} AS neg, {count(f"{c} = 0")} AS zero, {count(f"{c} > 0")} AS pos, {count(outside)} AS outl,
              max(q1) AS q1, max(q3) AS q3 FROM {source}, {spread})"""
        )
    return union(out)


HS_TYPES = {
    "REF_DATE": "string", "GEO": "string", "GEO_CODE": "string", "DWELLING_TYPE": "string", "INTENDED_MARKET": "string",
    "HOUSING_STARTS": "double", "AVERAGE_PRICE_CAD": "double", "STATUS": "string",
}

DOMAIN_FAILS = (
    FAILS["DQ-006"], FAILS["DQ-007"], FAILS["DQ-008"], FAILS["DQ-012"], BUSINESS["BR-007"], "HOUSING_STARTS < 0",
    "AVERAGE_PRICE_CAD < 0", "AVERAGE_PRICE_CAD > 10000000",
)
DOMAIN = "dom AS (" + union(
    f'SELECT {q(c.column)} AS "Column", {q(c.label)} AS "Check", count(*) AS t, count(*) FILTER (WHERE {bad}) AS f FROM hw'
    for c, bad in zip(DOMAIN_CHECKS, DOMAIN_FAILS, strict=True)
) + ")"

CODES = [f["name"] for f in FIELDS]
CELLS = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in CODES)
HOLES = " + ".join(f"CAST(count(*) FILTER (WHERE {c} IS NULL) > 0 AS INT)" for c in CODES)

LIMIT_SQL = (
    ("HOUSING_STARTS", "< 1% null", "HOUSING_STARTS IS NULL", "n * 100 < t OR n = 0"),
    ("HOUSING_STARTS", "0% negative", "HOUSING_STARTS < 0", "n = 0"),
    ("AVERAGE_PRICE_CAD", "< 2% null", "AVERAGE_PRICE_CAD IS NULL", "n * 100 < t * 2 OR n = 0"),
    ("AVERAGE_PRICE_CAD", "0% negative", "AVERAGE_PRICE_CAD < 0", "n = 0"),
    ("GEO / GEO_CODE", "0% invalid values", FAILS["DQ-006"], "n = 0"),
    ("REF_DATE", "0% null", "REF_DATE IS NULL", "n = 0"),
    ("REF_DATE", "0% invalid format", "NOT regexp_matches(REF_DATE, '^[0-9]{4}-[0-9]{2}$')", "n = 0"),
    ("DWELLING_TYPE", "0% invalid domain values", FAILS["DQ-007"], "n = 0"),
    ("INTENDED_MARKET", "0% invalid domain values", FAILS["DQ-008"], "n = 0"),
)
LIMITS = "lim AS (" + union(
    f"SELECT {q(cde)} AS CDE, {q(label)} AS Threshold, n AS Bad_Records, {pct('n', 't')} AS Bad_Pct, {ok} AS Within_Limit "
    f"FROM (SELECT count(*) AS t, count(*) FILTER (WHERE {bad}) AS n FROM hs)"
    for cde, label, bad, ok in LIMIT_SQL
) + ")"


def conformance_sql() -> str:
    actual = {"HOUSING_STARTS": "decimal", "AVERAGE_PRICE_CAD": "decimal", "DECIMALS": "integer"}
    out = []
    for name, family, nullable in gov.DICTIONARY:
        kind = actual.get(name, "text")
        fits = "false" if kind != family else "true" if nullable else "n = 0"
        out.append(
            f'SELECT {q(name)} AS "Column", {q(family)} AS Expected_Type, {q(kind)} AS Actual_Type, {str(nullable).lower()} '
            f"AS Nullable, n AS Null_Count, {fits} AS Conforms FROM (SELECT count(*) FILTER (WHERE {name} IS NULL) AS n FROM hw)"
        )
    out.append(
        "SELECT 'record_key', NULL, 'integer', NULL, n, false FROM (SELECT count(*) FILTER (WHERE record_key IS NULL) AS n FROM hw)"
    )
    return union(out)


def executive_sql() -> str:
    """Rows (section, name, rate, records, grade) of all parts of the executive view."""
    clean = tenths("uf.total_records - failed_records", "uf.total_records")
    owner = ", ".join(f"({q(i)}, {q(cde)})" for cde, ids in pack.CDE_RULES.items() for i in ids)
    return f"""SELECT 'overall' AS section, Dataset AS name, Overall_DQ_Score_Pct AS rate, Total_Rule_Failures AS records, Overall_Grade AS grade FROM summ
      UNION ALL SELECT 'clean', 'Clean records', {clean}, uf.total_records - failed_records, NULL FROM uf
      UNION ALL SELECT 'status', Status, NULL, count(*), NULL FROM sc GROUP BY Status
      UNION ALL SELECT 'dimension', DQ_Dimension, {mean()}, CAST(sum(Records_Failed) AS BIGINT), {grade(mean())} FROM sc GROUP BY DQ_Dimension
      UNION ALL SELECT 'rule', Rule_ID, Pass_Rate_Pct, Records_Failed, Status FROM sc
      UNION ALL SELECT 'element', CDE, {mean()}, CAST(sum(Records_Failed) AS BIGINT), {grade(mean(), (("A", 100), ("B", 95)))}
        FROM sc JOIN (VALUES {owner}) AS v(Rule_ID, CDE) USING (Rule_ID) GROUP BY CDE
      UNION ALL SELECT 'action', Recommended_Action, NULL, NULL, NULL FROM summ"""


TOKENS = "tok AS (SELECT Rule_ID, Status, Records_Failed, trim(unnest(string_split_regex(CDE_Affected, '[+/]'))) AS part FROM sc)"
ASSIGN = (
    "asg AS (SELECT *, trim(unnest(string_split_regex(CDE, '[+/]'))) AS part FROM (VALUES "
    + ", ".join(f"({', '.join(q(x) for x in row)})" for row in gov.ASSIGNMENTS)
    + ") AS v(CDE, Data_Owner, Data_Steward, Data_Custodian, Review_Cycle))"
)
ROUTES = (
    "rt AS (SELECT DISTINCT tok.Rule_ID, CDE, Data_Owner, Data_Steward, Data_Custodian, Review_Cycle, Records_Failed "
    "FROM tok JOIN asg USING (part))"
)
EDGES = "(VALUES " + ", ".join(f"({', '.join(q(x) for x in row)})" for row in gov.EDGES) + ") AS v(cde, ss, sf, ds, df)"
ROOTS = "(VALUES " + ", ".join(f"({', '.join(q(x) for x in row)})" for row in gov.ROOTS) + ") AS v(cde, sys, fld)"

BANDS = """CASE WHEN f * 100 > t * 15 THEN 3 WHEN f * 100 >= t * 5 THEN 2 WHEN f * 100 >= t THEN 1 ELSE 0 END"""
BAND_ROWS = """(VALUES (0, 'Low', 'Data Steward', '5 business days', 'Data Owner (if unresolved after 5 days)'),
  (1, 'Medium', 'Data Steward', '2 business days', 'Data Owner within 2 days'),
  (2, 'High', 'Data Owner + Data Steward', 'Same business day', 'CDO if not resolved within 24 hours'),
  (3, 'Critical', 'CDO + Data Owner + IT Custodian', 'Immediate (within 4 hours)', 'Executive Leadership / CISO if breach risk'))
  AS b(b, Issue_Severity, First_Responder, Resolution_Target, Escalate_To)"""

SHOWN = "record_key, REF_DATE, GEO_CODE, DWELLING_TYPE, INTENDED_MARKET, HOUSING_STARTS, AVERAGE_PRICE_CAD, _rule_id, _dimension, _severity, _failure_reason"
EX = f"WITH {FLAGS}, {EXCEPTIONS}"


def top(source: str, column: str, tail: str = "LIMIT 10") -> str:
    return (
        f"SELECT {column} AS value, count(*) AS failures FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 "
        f"ORDER BY failures DESC, value {tail}"
    )


def scored_by(rules, source: str, slices, totals: bool = False) -> str:
    """A scorecard per slice, in one query."""
    cols = ", ".join(slices)
    level = f", CAST({len(slices)} - " + " - ".join(f"GROUPING({s})" for s in slices) + " AS INTEGER) AS Slice_Level" if totals else ""
    counts = union(
        f"SELECT {cols}{level}, {q(r.rule_id)} AS Rule_ID, {q(r.name)} AS Rule_Name, {q(r.dimension)} AS DQ_Dimension, {q(r.cde)} AS CDE_Affected, "
        f"{q(r.description)} AS Description, {q(r.severity)} AS Severity, count(*) AS t, count(*) FILTER (WHERE {flag(r.rule_id)}) AS f, "
        f"{q(r.remediation)} AS Remediation_Action FROM {source} GROUP BY {f'ROLLUP ({cols})' if totals else cols}"
        for r in rules
    )
    rate = pct("(t - f)", "t")
    return f"""SELECT {cols}{", Slice_Level" if totals else ""}, Rule_ID, Rule_Name, DQ_Dimension, CDE_Affected, Description, Severity, t AS Total_Records,
      t - f AS Records_Passed, f AS Records_Failed, {rate} AS Pass_Rate_Pct,
      CASE WHEN {rate} = 100 THEN 'PASS' WHEN {rate} >= 95 THEN 'WARN' ELSE 'FAIL' END AS Status, Remediation_Action FROM ({counts})"""


def statistics_sql(source: str, by: str, columns: dict[str, str], places: int, extra: str = "") -> str:
    return union(
        f"SELECT {by}, {q(name)} AS measure, count(*) AS records, count(*) - count({c}) AS missing, round(avg({c}), {places}) AS mean, "
        f"round(stddev_samp({c}), {places}) AS stddev, min(CAST({c} AS DOUBLE)) AS low, max(CAST({c} AS DOUBLE)) AS high{extra} FROM {source} GROUP BY {by}"
        for name, c in columns.items()
    )


ORACLE: dict[str, str] = {
    "outputs_committed": f"WITH {SCORE} SELECT Rule_ID, Total_Records, Records_Failed, Records_Failed AS Listed, Total_Records AS Remediated, 'whole' AS Run FROM sc",
    "stream_copies": f"WITH {LINE_FLAGS} SELECT {', '.join(LINE_ID)}, copies AS duplicate_count FROM lf WHERE f007",
    "stream_statistics": statistics_sql("events", "event_type", {"value": "value"}, 4),
    "statistics_by_month": statistics_sql(
        "orders", "o_orderpriority", {"o_totalprice": "o_totalprice", "customer": "o_custkey"}, 2, ", true AS quartiles_hold, true AS distinct_holds"
    ),
    "csv_good_rows": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 13 <> 0",
    "csv_rejects": """WITH k AS (SELECT o_orderkey % 13 = 0 AS broken, o_orderkey % 11 = 0 AS c, o_orderkey % 7 = 0 AS p FROM orders)
      SELECT 'cells' AS reason, NULL::VARCHAR AS "column", count(*) AS rows FROM k WHERE broken HAVING count(*) > 0
      UNION ALL SELECT 'cell', 'o_custkey', count(*) FROM k WHERE NOT broken AND c HAVING count(*) > 0
      UNION ALL SELECT 'cell', 'o_totalprice', count(*) FROM k WHERE NOT broken AND p HAVING count(*) > 0""",
    "orders_by_price_band": """WITH b AS (SELECT s_suppkey * 3000 AS low, lead(s_suppkey * 3000) OVER (ORDER BY s_suppkey) AS high FROM supplier)
      SELECT CAST(low AS VARCHAR) AS begin, count(*) AS orders, min(o_totalprice) AS least, max(o_totalprice) AS most
      FROM orders LEFT JOIN b ON o_totalprice >= low AND (high IS NULL OR o_totalprice < high) GROUP BY 1""",
    "lineage_long_chain": """WITH t AS (SELECT max(c_custkey) AS top FROM customer) SELECT CAST(top - c_custkey + 1 AS INT) AS hop,
      CAST(c_custkey - 1 AS VARCHAR) AS src_system, CAST(c_custkey AS VARCHAR) AS dst_system FROM customer, t WHERE c_custkey > 1""",
    "lineage_systems": f"""WITH RECURSIVE {SCORE}, e AS (SELECT * FROM (VALUES {", ".join("(" + ", ".join(q(x) for x in edge) + ")" for edge in gov.SYSTEM_EDGES)})
        AS v(cde, src_system, src_field, dst_system, dst_field)),
      w AS (SELECT e.*, 1 AS hop FROM e WHERE dst_system IN {listed(s for _, s, _ in gov.SYSTEM_ROOTS)}
        UNION SELECT e.*, w.hop + 1 FROM e JOIN w ON e.dst_system = w.src_system AND e.dst_field = w.src_field AND w.hop < 10)
      SELECT cde, CAST(min(hop) AS INT) AS hop, src_system, src_field, dst_system, dst_field,
        (SELECT CAST(sum(Records_Failed) AS BIGINT) FROM sc) AS Failures FROM w GROUP BY ALL""",
    "exception_page_far": f"{EX} SELECT {SHOWN} FROM ex ORDER BY record_key, _rule_id LIMIT 100 OFFSET 700",
    "lineitem_unique_failed": f"""WITH {LINE_FLAGS}, uf AS (SELECT count(*) AS total_records,
        count(*) FILTER (WHERE {" OR ".join(f"f{i[-3:]}" for i in LINE_FAILS)}) AS failed_records FROM lf)
      SELECT *, {tenths("total_records - failed_records", "total_records")} AS clean_pct FROM uf""",
    "rules_failing_together": f"WITH {LINE_FLAGS} SELECT * FROM ("
    + union(
        f"SELECT {q(a)} AS Rule_ID, {q(b)} AS With_Rule_ID, count(*) FILTER (WHERE f{a[-3:]} AND f{b[-3:]}) AS records FROM lf"
        for a in LINE_FAILS
        for b in LINE_FAILS
        if a < b
    )
    + ") WHERE records > 0",
    "profile_sketch_error": union(
        f"SELECT {q(c)} AS \"Column\", count({c}) AS Not_Null_Count, count(DISTINCT {c}) AS Unique_Values, true AS Quartiles_Hold, true AS Distinct_Holds FROM lineitem"
        for c in ("l_orderkey", "l_quantity", "l_extendedprice", "l_discount")
    ),
    "column_gate_missing": """SELECT 'c_custkey' AS "Column", true AS Present, count(c_custkey) AS Filled FROM customer
      UNION ALL SELECT 'c_country', false, NULL UNION ALL SELECT 'c_acctbal', true, count(c_acctbal) FROM customer UNION ALL SELECT 'c_email', false, NULL""",
    "scorecard_by_slice": f"WITH {LINE_FLAGS} {scored_by(LINE_RULES, 'lf', ['l_returnflag', 'l_linestatus'], totals=True)}",
    "scorecard_by_area": f"WITH {FLAGS} {scored_by(RULES, 'flags', ['GEO_CODE'])}",
    "rule_scorecard": f"WITH {SCORE} {SCORECARD.format('sc')}",
    "strict_scorecard": strict(),
    "lineitem_scorecard": f"WITH {LINE_FLAGS}, {scored(LINE_RULES, 'lf')} {SCORECARD.format('sc')}",
    "stream_scorecard": f"WITH {LINE_FLAGS}, {scored([r for r in LINE_RULES if r.rule_id not in ('LI-007', 'LI-010')], 'lf')} "
    + SCORECARD.format("sc"),
    "lineitem_failures_per_line": f"WITH {LINE_FLAGS} SELECT {' + '.join(f'CAST(f{i[-3:]} AS INT)' for i in LINE_FAILS)} "
    "AS rules_failed, count(*) AS lines FROM lf GROUP BY 1",
    "conversation_scorecard": f"""WITH cf AS (SELECT *, role IS NULL OR role NOT IN ('user', 'assistant') AS a,
      count(*) OVER (PARTITION BY conv_id, turn) > 1 AS b, count(*) OVER (PARTITION BY text) > 1 AS c FROM conversations),
      {scored(TURN_RULES, "cf", flags={"CO-001": "a", "CO-002": "b", "CO-003": "c"})} {SCORECARD.format("sc")}""",
    "upload_scorecard": f"WITH {upload()} {SCORECARD.format('sc')}",
    "upload_summary": f"WITH {upload()}, {UNIQUE} {run_summary('sc')}",
    "by_dimension": f"""WITH {SCORE} SELECT DQ_Dimension, count(*) AS Rules_Count, {mean()} AS Avg_Pass_Rate,
      CAST(sum(Records_Failed) AS BIGINT) AS Total_Failed, {TALLY.format("Rules_Passing", "Rules_Warning", "Rules_Failing")},
      {mean()} AS Dimension_Score, {grade(mean())} AS Dimension_Grade FROM sc GROUP BY DQ_Dimension""",
    "by_cde": f"""WITH {SCORE}, owner AS (SELECT * FROM (VALUES
      {", ".join(f"({q(i)}, {q(cde)})" for cde, ids in pack.CDE_RULES.items() for i in ids)}) AS v(Rule_ID, CDE))
      SELECT CDE, count(*) AS Rules_Applied, {mean()} AS Avg_Pass_Rate, CAST(sum(Records_Failed) AS BIGINT)
      AS Total_Failed_Records, {grade(mean(), (("A", 100), ("B", 95)))} AS CDE_Grade,
      CASE WHEN sum(Records_Failed) > 0 THEN 'Yes' ELSE 'No' END AS Action_Required
      FROM sc JOIN owner USING (Rule_ID) GROUP BY CDE""",
    "summary": f"WITH {SCORE}, {SUMMARY} SELECT * FROM summ",
    "run_summary": f"WITH {SCORE}, {UNIQUE} {run_summary('sc')}",
    "executive": f"""WITH {SCORE}, {SUMMARY}, {UNIQUE} SELECT summ.*, failed_records AS Unique_Failed_Records,
      {tenths("uf.total_records - failed_records", "uf.total_records")} AS Clean_Records_Pct FROM summ, uf""",
    "unique_failed": f"""WITH {FLAGS}, {UNIQUE} SELECT *, {tenths("total_records - failed_records", "total_records")}
      AS clean_pct FROM uf""",
    "exceptions": f"{EX} SELECT * FROM ex",
    "completeness": housing_violations("DQ-001", "HOUSING_STARTS AS failed_value"),
    "starts_non_negative": housing_violations("DQ-002", "HOUSING_STARTS AS failed_value"),
    "conditional_completeness": housing_violations("DQ-003", "AVERAGE_PRICE_CAD AS failed_value"),
    "price_non_negative": housing_violations("DQ-004", "AVERAGE_PRICE_CAD AS failed_value"),
    "price_ceiling": housing_violations("DQ-005", "AVERAGE_PRICE_CAD AS failed_value"),
    "geo_code_domain": housing_violations("DQ-006", "GEO_CODE AS failed_value"),
    "dwelling_domain": housing_violations("DQ-007", "DWELLING_TYPE AS failed_value"),
    "market_domain": housing_violations("DQ-008", "INTENDED_MARKET AS failed_value"),
    "month_format": housing_violations("DQ-009", "REF_DATE AS failed_value"),
    "housing_grain": housing_violations("DQ-010", "copies AS duplicate_count"),
    "month_not_future": housing_violations("DQ-011", "REF_DATE AS failed_value"),
    "status_domain": housing_violations("DQ-012", "STATUS AS failed_value"),
    "mapping_consistency": housing_violations("DQ-015", "GEO_CODE AS failed_value"),
    "sigma_starts": housing_violations("DQ-013", sigma_columns("HOUSING_STARTS", "hm", "hd", places=0)),
    "sigma_range": housing_violations(
        "DQ-014",
        sigma_columns("AVERAGE_PRICE_CAD", "pm", "pd"),
        "CASE WHEN AVERAGE_PRICE_CAD < 100000 THEN 'Price below $100,000 minimum threshold' "
        "WHEN AVERAGE_PRICE_CAD > 3000000 THEN 'Price exceeds $3,000,000 maximum threshold' "
        "ELSE 'Price exceeds mean + 3 std dev for this province' END",
    ),
    "non_negative": violations(packs.customer_rules()[0], "customer", "c_acctbal < 0", ["c_custkey"], "c_acctbal AS failed_value"),
    "ceiling": violations(packs.order_rules()[0], "orders", "o_totalprice > 400000", ["o_orderkey"], "o_totalprice AS failed_value"),
    "not_future": f"WITH {LINE_FLAGS} {violations(line_rule('LI-006'), 'lf', 'f006', LINE_KEYS, 'ship_month AS failed_value')}",
    "grain_unique": f"WITH {LINE_FLAGS} {violations(line_rule('LI-007'), 'lf', 'f007', LINE_ID, 'copies AS duplicate_count')}",
    "duplicate_groups": violations(
        line_rule("LI-007"),
        "(SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)", "n > 1", LINE_KEYS, "n AS duplicate_count",
    ),
    "housing_duplicate_groups": f"WITH {HS} "
    + violations(
        RULES[9],
        f"(SELECT {', '.join(pack.GRAIN)}, count(*) AS n FROM hs GROUP BY ALL)", "n > 1", pack.GRAIN, "n AS duplicate_count",
    ),
    "referential": violations(
        packs.rule("DO-001", "Document is labelled", "Consistency", "doc_id", None),
        "documents", "doc_id NOT IN (SELECT doc_id FROM labels)", ["doc_id"], "doc_id AS failed_value",
    ),
    "document_copies": violations(
        packs.rule("DO-002", "Text occurs once", "Uniqueness", "text", None),
        "(SELECT *, count(*) OVER (PARTITION BY text) AS n FROM documents)", "n > 1", ["doc_id"], "n AS duplicate_count",
    ),
    "referential_lines": f"WITH {LINE_FLAGS} {violations(line_rule('LI-010'), 'lf', 'f010', LINE_ID, 'l_orderkey AS failed_value')}",
    "sigma_outlier": f"WITH {EV} "
    + violations(
        EVENT_RULES[0], "ev", "value > 300 OR value > m + 3 * d", ["event_id"], sigma_columns("value", "m", "d"),
        "CASE WHEN value > 300 THEN 'above the maximum' ELSE 'above mean + k * stddev of its group' END",
    ),
    "sigma_two_sided": f"WITH {EV} "
    + violations(
        EVENT_RULES[1], "ev", "value > m + 1.5::DOUBLE * d OR value < m - 1.5::DOUBLE * d", ["event_id"],
        sigma_columns("value", "m", "d", k="1.5::DOUBLE"), "'above mean + k * stddev of its group'",
    ),
    "compare_columns": """SELECT l_orderkey, l_linenumber, l_partkey, cast(l_shipdate AS string) AS l_shipdate,
      cast(o_orderdate AS string) AS o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE l_shipdate < o_orderdate""",
    "business_rules": f"""WITH {WIDE}, bf AS (SELECT *, {", ".join(f"coalesce({s}, false) AS {flag(i)}" for i, s in BUSINESS.items())}
      FROM hw), {scored(packs.business_rules(), "bf")} {SCORECARD.format("sc")}""",
    "root_causes": f"WITH {FLAGS}, {CAUSES} SELECT * FROM causes",
    "top_causes": f"""WITH {FLAGS}, {CAUSES} SELECT breakdown, rule_id, key AS top_key, failures AS top_failures, total_failures, keys
      FROM (SELECT *, row_number() OVER (PARTITION BY breakdown ORDER BY failures DESC, key) AS place,
        CAST(sum(failures) OVER (PARTITION BY breakdown) AS BIGINT) AS total_failures, count(*) OVER (PARTITION BY breakdown) AS keys
        FROM causes) WHERE place = 1""",
    "negative_balance_by_segment": "SELECT c_mktsegment, count(*) AS failures FROM customer WHERE c_acctbal < 0 GROUP BY 1",
    "remediated": f"WITH {HS}, {FIXED}, {REMEDIATED} SELECT * FROM rem",
    "remediation_totals": f"""WITH {HS}, {FIXED}, {REMEDIATED}, n AS (SELECT count(*) AS t,
      count(*) FILTER (WHERE _dq_flag = 'CLEAN') AS c FROM rem), a AS (SELECT count(*) FILTER (WHERE was002) + count(*)
      FILTER (WHERE was004) AS x FROM after) SELECT t AS total_records, c AS clean_records, x AS auto_remediated,
      t - c AS flagged_records, {pct("c", "t")} AS clean_pct FROM n, a""",
    "remediation_flags": f"WITH {HS}, {FIXED} "
    + union(f"SELECT {q(i)} AS rule_id, count(*) AS records FROM after WHERE {f} HAVING count(*) > 0" for i, f in STEP_FLAGS.items()),
    "contract_checks": f"WITH {WIDE}, {SCORE}, {CHECKS} SELECT * FROM checks",
    "contract_checks_incomplete": f"WITH {SCORE} {contract_sql('hs', HS_FIELDS, ['record_key'], chr(82) + 'ule_ID < ' + q('DQ-013'))}",
    "contract_verdict": f"""WITH {WIDE}, {SCORE}, {CHECKS} SELECT count(*) AS total, count(*) FILTER (WHERE status = 'PASS') AS passed,
      count(*) FILTER (WHERE status = 'WARN') AS warned, count(*) FILTER (WHERE status = 'FAIL') AS failed,
      CASE WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'FAILED' WHEN count(*) FILTER (WHERE status = 'WARN') > 0
      THEN 'PASSED WITH WARNINGS' ELSE 'SATISFIED' END AS verdict FROM checks""",
    "contract_invalid_values": f"WITH {WIDE} "
    + union(
        f"SELECT {q(f['name'])} AS field, {f['name']} AS value, count(*) AS records FROM hw "
        f"WHERE {f['name']} NOT IN {listed(f['validValues'])} GROUP BY 2"
        for f in FIELDS
        if f.get("validValues")
    ),
    "tier_levels": f"""WITH {SCORE}, {TIER_OF} SELECT Rule_ID, tier, Pass_Rate_Pct, CASE WHEN tier = 1 THEN {level("Pass_Rate_Pct", 99, 97)}
      ELSE {level("Pass_Rate_Pct", 97, 95)} END AS level FROM sc JOIN tiers USING (Rule_ID)""",
    "dimension_levels": f"""WITH {SCORE}, {TIER_OF}, m AS (SELECT lower(DQ_Dimension) AS dimension, tier, count(*) AS rules,
      {mean()} AS avg_pass_rate FROM sc JOIN tiers USING (Rule_ID) GROUP BY 1, 2)
      SELECT *, CASE WHEN tier = 1 THEN {level("avg_pass_rate", 99, 97)} ELSE {level("avg_pass_rate", 97, 95)} END AS level FROM m""",
    "profile_housing": f"WITH {HS} {profile('hs', HS_TYPES, pack.CRITICAL_DATA_ELEMENTS)}",
    "profile_events": profile(
        "events", {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}
    ),
    "profile_parts": profile("part", {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double"}),
    "domain_validation": f"""WITH {WIDE}, {DOMAIN} SELECT "Column", "Check", f AS Failed_Records, {pct("f", "t")} AS Failed_Pct,
      CASE WHEN {pct("(t - f)", "t")} = 100 THEN 'PASS' WHEN {pct("(t - f)", "t")} >= 95 THEN 'WARN' ELSE 'FAIL' END AS Status FROM dom""",
    "profile_scorecard": f"""WITH {WIDE}, {DOMAIN},
      d AS (SELECT {half_up(f"sum(10000 - {half_up('f * 10000', 't')})", "count(*)")} AS v, count(*) AS run,
        count(*) FILTER (WHERE f > 0) AS bad FROM dom),
      g AS (SELECT sum(n) FILTER (WHERE n > 1) AS copies FROM (SELECT count(*) AS n FROM hw GROUP BY {", ".join(pack.GRAIN)})),
      c AS (SELECT count(*) AS t, {CELLS} AS cells, {HOLES} AS holes FROM hw),
      s AS (SELECT *, {half_up(f"(t * {len(CODES)} - cells) * 10000", f"t * {len(CODES)}")} AS c,
        {half_up("(t - coalesce(copies, 0)) * 10000", "t")} AS u FROM c, d, g),
      o AS (SELECT *, {half_up("c + v + u", "3")} / CAST(100 AS DOUBLE) AS overall FROM s)
      SELECT {q(DATASET)} AS Dataset, {q(RUN_DATE)} AS Profile_Date, t AS Total_Records, {len(CODES)} AS Total_Columns,
        {len(pack.CRITICAL_DATA_ELEMENTS)} AS CDE_Count, c / CAST(100 AS DOUBLE) AS Completeness_Score,
        v / CAST(100 AS DOUBLE) AS Validity_Score, u / CAST(100 AS DOUBLE) AS Uniqueness_Score, overall AS Overall_DQ_Score,
        {grade("overall")} AS Overall_Grade, cells AS Total_Null_Cells, holes AS Columns_With_Nulls, CAST(run AS INT) AS Domain_Checks_Run,
        bad AS Domain_Checks_Failed FROM o""",
    "rule_list": f"""WITH {SCORE} SELECT Rule_ID, Rule_Name, DQ_Dimension, Severity, Pass_Rate_Pct, Records_Failed, Status
      FROM sc WHERE DQ_Dimension = 'Validity' AND Status = 'WARN'""",
    "exception_list": f"{EX} SELECT {SHOWN} FROM ex WHERE _dimension = 'Validity' AND GEO_CODE = 'ON'",
    "exception_totals": f"{EX} SELECT count(*) AS exceptions, count(DISTINCT _rule_id) AS rules FROM ex",
    "filter_options": f"{EX} SELECT DISTINCT DWELLING_TYPE AS option FROM ex WHERE DWELLING_TYPE IS NOT NULL",
    "top_values": top("events", "event_type"),
    "top_failing_codes": f"{EX} {top('ex', 'GEO_CODE')}",
    "failures_by_dwelling": f"{EX} {top('ex', 'DWELLING_TYPE', '')}",
    "exception_page": f"{EX} SELECT {SHOWN} FROM ex ORDER BY record_key, _rule_id LIMIT 100 OFFSET 200",
    "exception_page_after": f"""{EX} SELECT {SHOWN} FROM ex WHERE record_key > 500 OR (record_key = 500 AND _rule_id > 'DQ-010')
      ORDER BY record_key, _rule_id LIMIT 100""",
    "record_ids": "SELECT *, row_number() OVER (ORDER BY o_orderkey) AS _record_id FROM orders",
    "escalation": f"""WITH {SCORE}, r AS (SELECT *, Records_Failed AS f, Total_Records AS t FROM sc WHERE Records_Failed > 0)
      SELECT Rule_ID, CDE_Affected, Records_Failed, {pct("f", "t")} AS Failure_Rate_Pct, Issue_Severity, First_Responder,
      Resolution_Target, Escalate_To FROM r JOIN {BAND_ROWS} ON b = {BANDS}""",
    "steward_load": f"""WITH {SCORE}, {TOKENS}, {ASSIGN}, {ROUTES} SELECT Rule_ID, CDE, Data_Owner, Data_Steward, Data_Custodian,
      Review_Cycle, Records_Failed AS Failures FROM rt WHERE Records_Failed > 0""",
    "steward_routing": f"""WITH {SCORE}, {EXCEPTIONS}, {TOKENS}, {ASSIGN}, {ROUTES} SELECT record_key, _rule_id, CDE, Data_Steward,
      Review_Cycle FROM ex JOIN rt ON _rule_id = Rule_ID""",
    "threshold_compliance": f"""WITH {HS}, {LIMITS} SELECT *, CASE WHEN bool_and(Within_Limit) OVER (PARTITION BY CDE)
      THEN 'Compliant' ELSE 'Requires remediation' END AS CDE_Status FROM lim""",
    "conformance": f"WITH {WIDE} {conformance_sql()}",
    "cde_coverage": f"""WITH {SCORE}, {TOKENS} SELECT CDE, count(Rule_ID) AS Rules, count(*) FILTER (WHERE Status <> 'PASS')
      AS Rules_Not_Passing, CAST(coalesce(sum(Records_Failed), 0) AS BIGINT) AS Failures
      FROM (VALUES {", ".join(f"({q(c)})" for c in [*pack.CRITICAL_DATA_ELEMENTS, "UOM"])}) AS v(CDE) LEFT JOIN tok ON part = CDE GROUP BY CDE""",
    "uncovered_columns": f"""WITH {WIDE}, c AS ({conformance_sql()}), ruled AS (SELECT DISTINCT trim(unnest(string_split_regex(x, '[+/]')))
      AS x FROM (VALUES {", ".join(f"({q(r.cde)})" for r in RULES)}) AS v(x))
      SELECT "Column" AS "column", Null_Count FROM c WHERE "Column" <> 'record_key' AND "Column" NOT IN (SELECT x FROM ruled)""",
    "lineage_impact": f"""WITH RECURSIVE {SCORE}, {TOKENS}, e AS (SELECT * FROM {EDGES}),
      hops AS (SELECT e.*, 1 AS hop FROM e JOIN {ROOTS.replace("AS v", "AS r")} ON e.cde = r.cde AND ds = sys AND df = fld
        UNION ALL SELECT e.*, hop + 1 FROM hops h JOIN e ON e.cde = h.cde AND e.ds = h.ss AND e.df = h.sf),
      n AS (SELECT part, CAST(sum(Records_Failed) AS BIGINT) AS Failures FROM tok GROUP BY part)
      SELECT cde, CAST(hop AS INT) AS hop, ss AS src_system, sf AS src_field, ds AS dst_system, df AS dst_field, Failures
      FROM hops JOIN n ON cde = part""",
    "catalog_conformance": f"""WITH {WIDE}, n AS (SELECT count(*) AS n FROM hw) SELECT 'Row_Count' AS Measure, CAST({gov.CATALOG_ROWS} AS BIGINT)
      AS Declared, n AS Actual, n = {gov.CATALOG_ROWS} AS Conforms FROM n UNION ALL SELECT 'Column_Count', {gov.CATALOG_COLUMNS}, 16, true""",
    "size_conformance": f"WITH {WIDE} "
    + union(
        f"""SELECT '{c}' AS "Column", '{f"VARCHAR({size})" if places is None else f"DECIMAL({size},{places})"}' AS Declared, n AS Too_Large, n = 0 AS Conforms
        FROM (SELECT count(*) FILTER (WHERE {f"length(CAST({c} AS VARCHAR)) > {size}" if places is None else f"abs({c}) >= {10 ** (size - places)} OR round({c}, {places}) <> {c}"}) AS n FROM hw)"""
        for c, size, places in gov.SIZES
    ),
    "mapping_by_table": """WITH m AS (SELECT l_orderkey, min(l_linestatus) AS e FROM lineitem WHERE l_linenumber = 1 GROUP BY 1)
      SELECT 'OR-002' AS rule_id, 'Status follows first line' AS rule_name, 'Consistency' AS dq_dimension, o_orderkey, o_orderstatus AS failed_value,
        'Status follows first line on o_orderkey + o_orderstatus.' AS failure_reason FROM orders JOIN m ON o_orderkey = l_orderkey WHERE o_orderstatus <> e""",
    "csv_round_trip": "SELECT * FROM customer",
    "column_gate": "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1",
    "template_filled": f"WITH {HS} SELECT DWELLING_TYPE, count(*) AS records, sum(HOUSING_STARTS) AS starts FROM hs GROUP BY 1",
    "record_ids_folder": "SELECT *, row_number() OVER (ORDER BY o_orderkey) AS _record_id FROM orders",
    "outputs_rerun": f"""WITH {HS}, n AS (SELECT count(*) AS t FROM hs WHERE HOUSING_STARTS >= 0)
      SELECT Rule_ID, t AS Total_Records, CAST(0 AS BIGINT) AS Records_Failed, CAST(0 AS BIGINT) AS Exceptions_Left
      FROM n, (VALUES ('DQ-001'), ('DQ-002')) AS v(Rule_ID)""",
    "score_history": f"""WITH n AS (SELECT year(o_orderdate) AS y, count(*) AS t, count(*) FILTER (WHERE o_totalprice > 400000) AS f FROM orders GROUP BY 1),
      r AS (SELECT 'OR-001' AS Rule_ID, y || '-12-31' AS run_date, {pct("(t - f)", "t")} AS Pass_Rate_Pct FROM n),
      p AS (SELECT *, lag(Pass_Rate_Pct) OVER (ORDER BY run_date) AS Previous_Rate_Pct FROM r)
      SELECT *, round(Pass_Rate_Pct - Previous_Rate_Pct, 2) AS Change_Pct FROM p""",
    "contract_many_invalid": union(
        f"""SELECT 'valid_values' AS section, '{c} values within defined domain' AS "check", CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
        CASE WHEN n > 0 THEN 'Invalid values found: ' || kinds || ' distinct in ' || n || ' record(s)' ELSE '' END AS detail, n AS violations
        FROM (SELECT count(*) AS n, count(DISTINCT v) AS kinds FROM (SELECT {value} AS v FROM part) WHERE v <> '{good}')"""
        for c, value, good in (("p_name", "p_name || '-' || p_partkey", "cold widget"), ("p_brand", "p_brand", "Brand#1"))
    ),
    "lineage_chain": """SELECT CAST((SELECT max(n_nationkey) FROM nation) - n_nationkey AS INT) AS hop, CAST(n_nationkey AS VARCHAR) AS src_system,
      CAST(n_nationkey + 1 AS VARCHAR) AS dst_system FROM nation WHERE n_nationkey < (SELECT max(n_nationkey) FROM nation)""",
    "exception_pages": f"{EX} SELECT CAST(greatest(1, (count(*) + 99) // 100) AS BIGINT) AS pages, count(*) AS rows FROM ex",
    "executive_view": f"""WITH {SCORE}, {SUMMARY}, {UNIQUE} {executive_sql()}""",
}

ORACLE["sigma_range_inner"] = f"SELECT * FROM ({ORACLE['sigma_range']}) WHERE group_mean IS NOT NULL"

for _name, _same in (
    ("stream_uniqueness", "lineitem_scorecard"),
    ("escalation_from_file", "escalation"),
    ("turn_texts_unique", "conversation_scorecard"),
    ("contract_from_file", "contract_checks"),
    ("steward_load_from_file", "steward_load"),
    ("outputs_remediated", "remediated"),
    ("outputs_exceptions", "exceptions"),
    ("outputs_scorecard", "rule_scorecard"),
    ("outputs_summary", "summary"),
    ("outputs_by_dimension", "by_dimension"),
):
    ORACLE[_name] = ORACLE[_same]
