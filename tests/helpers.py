from plumbline.operators.rule import Rule

HOUSING = (
    "record_key long, REF_DATE string, GEO string, GEO_CODE string, DWELLING_TYPE string, INTENDED_MARKET string, "
    "HOUSING_STARTS double, AVERAGE_PRICE_CAD double, STATUS string"
)
GOOD = {
    "REF_DATE": "2020-01", "GEO": "Ontario", "GEO_CODE": "ON", "DWELLING_TYPE": "Row House", "INTENDED_MARKET": "Rental",
    "HOUSING_STARTS": 100.0, "AVERAGE_PRICE_CAD": 300000.0, "STATUS": None,
}


def housing_rows(spark, *changes):
    """One good row per change, with the change applied; months differ so that the grain is unique."""
    rows = []
    for i, change in enumerate(changes):
        row = {**GOOD, "REF_DATE": f"{1990 + i}-01", **change}
        rows.append((i + 1, *[row[c] for c in GOOD]))
    return spark.createDataFrame(rows, HOUSING)


def one(check, rule_id="X-001"):
    return Rule(rule_id, "name", "Validity", "cde", "description", "High", "action", check)


def failing(spark, check, values, kind, as_of="2026-12"):
    """The values that fail a check on one column."""
    from plumbline.operators.run import Run

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {kind}")
    ids = [r["i"] for r in Run(df, [one(check)], as_of=as_of).failing_rows("X-001").collect()]
    return [values[i] for i in sorted(ids)]


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}
