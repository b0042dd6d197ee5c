"""One clock, line breaks in fields, odd paths, vanished days, keys that cut every input."""

from pyspark.sql import functions as F

from tidemark.functions.scalars import session_now
from tidemark.plans import gold, quality
from tidemark.sinks.export import export_by_date, export_csv, read_export
from tidemark.sources.landing import read_landing
from tidemark.specs import ENTITIES, EXPORT_COLUMNS, FACT_SCHEMA


def fact(spark, **change):
    row = dict.fromkeys(FACT_SCHEMA.names) | {"BOOKING_ID": "B1", "ROUTE": 'A,"B"\nC', "CHANNEL": ""} | change
    return spark.createDataFrame([tuple(row[c] for c in FACT_SCHEMA.names)], FACT_SCHEMA)


def test_lag_follows_the_clock_that_stamps_rows(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            stamped = spark.range(1).select(F.localtimestamp().alias("t"))
            line = quality.freshness({"X": (stamped, "t")}, session_now(spark)).first()
            assert line["LAG_MIN"] in (0, -1) and line["STATUS"] == "PASS"
            old = spark.range(1).select((F.localtimestamp() - F.expr("INTERVAL 5 HOURS")).alias("t"))
            assert quality.freshness({"X": (old, "t")}, session_now(spark)).first()["STATUS"] == "WARN"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_line_breaks_quotes_and_empty_text_come_back(spark, tmp_path):
    path = export_csv(fact(spark).unionByName(fact(spark, BOOKING_ID="B2", ROUTE=None)), str(tmp_path / "x"))
    schema = FACT_SCHEMA.__class__([FACT_SCHEMA[c] for c in EXPORT_COLUMNS])
    back = {r["BOOKING_ID"]: r for r in read_export(spark, path, schema).collect()}
    assert back["B1"]["ROUTE"] == 'A,"B"\nC' and back["B2"]["ROUTE"] is None and back["B1"]["CHANNEL"] == ""


def test_a_day_that_left_the_fact_leaves_a_whole_export(spark, tmp_path):
    import datetime

    one, two = (fact(spark, BOOKING_DATE=datetime.date(2026, 8, d)) for d in (1, 2))
    path = export_by_date(one.unionByName(two), str(tmp_path / "d"), whole=True)
    export_by_date(two, path, whole=True)
    assert [r["dt"] for r in spark.read.parquet(path).select(F.col("dt").cast("string")).collect()] == ["2026-08-02"]


def test_a_landing_path_with_spaces_and_plus(spark, tmp_path):
    claim = next(e for e in ENTITIES if e.name == "claim")
    folder = tmp_path / "land ing+1" / "cdc"
    folder.mkdir(parents=True)
    names = claim.file_columns
    (folder / "claim_1.csv").write_text(",".join(names) + "\n" + ",".join("x" for _ in names) + "\n")
    assert [r["SRC_FILE"] for r in read_landing(spark, str(folder.parent), claim).collect()] == ["cdc/claim_1.csv"]


def test_a_foreign_key_of_a_table_without_soft_deletes(spark):
    parents = spark.createDataFrame([("B1",)], "BOOKING_ID string")
    rule = quality.foreign_key("fk", "CHILD", "BOOKING_ID", "PARENT", "BOOKING_ID", live_only=False)
    children = fact(spark).unionByName(fact(spark, BOOKING_ID="B9"))
    assert quality.run_rules({"CHILD": children, "PARENT": parents}, [rule], session_now(spark)).first()["FAIL_COUNT"] == 1


def test_many_keys_cut_every_input(spark):
    states = {e.name: spark.createDataFrame([], e.state_schema) for e in ENTITIES}
    keys = spark.createDataFrame([("B1",)], "BOOKING_ID string")
    df = gold.booking_fact(states["booking"], states["reservation"], states["claim"], keys, small_keys=False)
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("LeftSemi") == 3
