"""Landing files and outbound files."""

import gzip
from datetime import date
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import sample_feed
from tests.build import same_rows
from tidemark.sinks.export import export_by_date, export_csv, export_parquet, publish_run, published_runs, read_export, rows_per_file
from tidemark.sources.landing import list_files, read_landing, stream_landing
from tidemark.specs import BOOKING, CLAIM, EXPORT_COLUMNS, FACT_SCHEMA, RESERVATION


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_csv_dialect(spark, tmp_path):
    header = "any,names,at,all,here,a,b,c,d,e,HEADER__CHANGE_OPER,HEADER__CHANGE_SEQ,HEADER__TIMESTAMP\n"
    line = '  BK1 ,"Doe, ""J""",NULL,,""," x ",CONFIRMED,1.00,USD,WEB,I,1,2026-08-01 00:00:00\n'
    write(tmp_path / "in" / "cdc" / "booking_1.csv", header + line)
    row = read_landing(spark, str(tmp_path / "in"), BOOKING).first()
    assert row.BOOKING_ID == "BK1" and row.PASSENGER_ID == 'Doe, "J"'
    assert row.FLIGHT_NUMBER is None and row.ORIGIN is None and row.DESTINATION is None
    assert row.CHANGE_OPER == "I" and row.SRC_FILE == "cdc/booking_1.csv" and row.LOAD_TS is not None


def test_entity_prefix_and_pattern(spark, tmp_path, run_ts):
    landing = tmp_path / "landing"
    sample_feed.land(landing, "fullload", sample_feed.FULL)
    sample_feed.land(landing, "cdc", sample_feed.CDC)
    write(landing / "cdc" / "booking_notes.txt", "not a feed file\n")
    root = str(landing)
    assert read_landing(spark, root, BOOKING).count() == 17
    assert read_landing(spark, root, CLAIM, "cdc").count() == 4
    assert read_landing(spark, root, RESERVATION, "fullload/").count() == 10
    assert read_landing(spark, root, BOOKING, path_pattern=r"^cdc/.*booking.*[.]csv$").count() == 7
    assert {r.CHANGE_OPER for r in read_landing(spark, root, BOOKING, "fullload").collect()} == {"L"}
    assert {r.LOAD_TS for r in read_landing(spark, root, BOOKING, load_ts=run_ts).collect()} == {run_ts}
    assert list_files(spark, root).count() == 7


def test_one_directory_per_entity(spark, tmp_path):
    for part, text in enumerate((sample_feed.FULL_BOOKING, sample_feed.CDC_BOOKING)):
        write(tmp_path / "in" / "fullload" / "booking" / f"part-{part}.csv", text)
    rows = read_landing(spark, str(tmp_path / "in"), BOOKING)
    assert rows.count() == 17
    assert "fullload/booking/part-0.csv" in {r.SRC_FILE for r in rows.collect()}


def test_parquet_landing(spark, tmp_path):
    landing = tmp_path / "in"
    sample_feed.land(tmp_path / "csv", "fullload", sample_feed.FULL)
    csv = read_landing(spark, str(tmp_path / "csv"), BOOKING)
    csv.select(*BOOKING.file_columns).write.parquet(str(landing / "fullload" / "booking"))
    parquet = read_landing(spark, str(landing), BOOKING, fmt="parquet")
    columns = BOOKING.file_columns
    assert same_rows(csv.select(*columns), parquet.select(*columns))
    stream = stream_landing(spark, str(landing), BOOKING, fmt="parquet")
    query = stream.writeStream.format("memory").queryName("landed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("landed").count() == 10


def fact(spark):
    rows = [
        ("B1", "P,1", 'say "hi"', "A-B", date(2026, 8, 1), "CONFIRMED", "WEB", None, False, 1.5, 0, 0.0, 1.5, "LOW", True, None),
        ("B2", "", None, "A-C", date(2026, 8, 2), "PENDING", "APP", "FIRST", True, None, 2, 3.25, None, "LOW", False, None),
        ("B3", " pad ", "F", None, None, "CONFIRMED", None, "X", True, 1300.0, 0, 0.0, 1300.0, "HIGH", False, None),
    ]
    names = FACT_SCHEMA.names
    loose = T.StructType(
        [T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.DecimalType) else f.dataType) for f in FACT_SCHEMA]
    )
    return spark.createDataFrame(rows, loose).select(*[F.col(n).cast(FACT_SCHEMA[n].dataType).alias(n) for n in names])


def test_csv_export_round_trip(spark, tmp_path):
    out = export_csv(fact(spark), str(tmp_path / "out"))
    schema = T.StructType([FACT_SCHEMA[c] for c in EXPORT_COLUMNS])
    back = read_export(spark, out, schema)
    exported = fact(spark).select(*EXPORT_COLUMNS)
    assert same_rows(back, exported)  # empty text and NULL stay apart
    texts = [gzip.open(p, "rt").read() for p in Path(out).glob("*.csv.gz")]
    assert all(t.startswith(",".join(EXPORT_COLUMNS)) for t in texts)
    body = "".join(texts)
    assert 'B2,"",,A-C' in body and '"P,1"' in body and '"say ""hi"""' in body


def test_csv_export_splits_and_replaces(spark, tmp_path):
    many = fact(spark).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("n").coalesce(1)
    path = str(tmp_path / "out")
    export_csv(many, path, max_records=25)
    assert len(list(Path(path).glob("*.csv.gz"))) == 3
    export_csv(fact(spark), path)
    schema = T.StructType([FACT_SCHEMA[c] for c in EXPORT_COLUMNS])
    assert read_export(spark, path, schema).count() == 3
    assert read_export(spark, path, schema).select("BOOKING_ID", "NET_REVENUE").limit(2).count() == 2
    one, two = (export_csv(fact(spark), path + "-runs", run_id=r) for r in ("1", "2"))
    assert one != two and Path(one).exists() and Path(two).exists()
    assert rows_per_file(6400, 64) == 100


def test_parquet_exports(spark, tmp_path):
    dated = export_parquet(fact(spark), str(tmp_path / "p"), dt="2026-08-30")
    assert dated.endswith("dt=2026-08-30") and same_rows(spark.read.parquet(dated), fact(spark))

    path = export_by_date(fact(spark), str(tmp_path / "d"))
    assert {p.name for p in Path(path).glob("dt=*")} == {
        "dt=2026-08-01", "dt=2026-08-02", "dt=__HIVE_DEFAULT_PARTITION__",
    }
    export_by_date(fact(spark).filter("BOOKING_ID = 'B1'").withColumn("CHANNEL", F.lit("NEW")), path)
    back = {r.BOOKING_ID: r.CHANNEL for r in spark.read.parquet(path).collect()}
    assert back == {"B1": "NEW", "B2": "APP", "B3": None}  # only the day written again was replaced
    pruned = spark.read.parquet(path).filter("dt = '2026-08-02'")
    assert [r.BOOKING_ID for r in pruned.collect()] == ["B2"]


def test_files_of_wide_rows_stay_below_the_limit(spark, tmp_path):
    wide = fact(spark).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(400))))
    wide = wide.withColumn("ROUTE", F.concat_ws("", *[F.sha2(F.concat(F.col("n").cast("string"), F.lit(str(i))), 512) for i in range(4)]))
    out = export_csv(wide.drop("n").coalesce(1), str(tmp_path / "wide"), file_bytes=20_000)
    sizes = [f.stat().st_size for f in (tmp_path / "wide").glob("*.csv.gz")]
    assert out == str(tmp_path / "wide") and len(sizes) > 1 and max(sizes) <= 20_000


def test_a_heavy_day_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("BOOKING_ID"), F.expr("CASE WHEN id < 1500 THEN DATE'2026-08-01' WHEN id < 1900 THEN NULL ELSE date_add(DATE'2026-09-01', int(id - 1900)) END").alias("BOOKING_DATE"))
    path = export_by_date(rows, str(tmp_path / "heavy"), whole=True, task_rows=300)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in Path(path).glob("dt=*")}
    assert files["dt=2026-08-01"] > 1 and files["dt=__HIVE_DEFAULT_PARTITION__"] > 1 and files["dt=2026-09-01"] == 1 and len(files) == 102
    assert same_rows(spark.read.parquet(path).drop("dt"), rows)


def test_export_of_a_plan_runs_it_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        seen.add(1)
        return value

    plan = fact(spark).withColumn("ROUTE", counted("ROUTE"))
    for file_bytes in (16_000_000, 150):
        before = seen.value
        out = export_csv(plan, str(tmp_path / f"once-{file_bytes}"), file_bytes=file_bytes)
        assert seen.value - before == 3
        sizes = [p.stat().st_size for p in Path(out).glob("*.csv.gz")]
        assert sizes and (max(sizes) <= file_bytes or len(sizes) == 3)  # a file holds one row at least


def test_runs_are_published_last(spark, tmp_path):
    path, schema = str(tmp_path / "out"), T.StructType([FACT_SCHEMA[c] for c in EXPORT_COLUMNS])
    for run, rows in (("a", fact(spark)), ("b-1", fact(spark).limit(1)), ("c", fact(spark).limit(0))):
        export_csv(rows, path, run_id=run)
        if run != "c":  # the last run broke off before it was published
            publish_run(spark, path, run)
    assert published_runs(spark, path) == ["a", "b-1"]
    assert read_export(spark, path, schema).count() == 1 and read_export(spark, path, schema, "a").count() == 3


def test_patterns_choose_files_when_they_are_listed(spark, tmp_path):
    landing = tmp_path / "landing"
    sample_feed.land(landing, "fullload", sample_feed.FULL)
    sample_feed.land(landing, "cdc", sample_feed.CDC)
    rows = read_landing(spark, str(landing), BOOKING, path_pattern="^cdc/")
    rows.collect()
    plan, files = [rows._jdf.queryExecution().executedPlan()], None
    while plan:
        node = plan.pop()
        if "Scan csv" in node.nodeName():
            files = node.metrics().apply("numFiles").value()
        plan.extend(node.children().apply(i) for i in range(node.children().size()))
    assert files == 1


def test_read_files_are_retired_and_old_names_forgotten(spark, tmp_path):
    import os
    import time

    landing, archive = tmp_path / "landing", tmp_path / "archive"
    now = time.time() - 100_000

    def land(name, text, moment):
        write(landing / "cdc" / name, text)
        os.utime(landing / "cdc" / name, (moment, moment))

    def run():
        rows = stream_landing(spark, str(landing), BOOKING, archive=str(archive), max_file_age="1h")
        out = tmp_path / "out"
        query = rows.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
        return spark.read.parquet(str(out)).count()

    land("booking_a.csv", sample_feed.CDC_BOOKING, now)
    assert run() == 7
    land("booking_b.csv", sample_feed.CDC_BOOKING, now + 7200)
    assert run() == 14
    assert not (landing / "cdc" / "booking_a.csv").exists() and list(archive.rglob("booking_a.csv"))
    land("booking_a.csv", sample_feed.CDC_BOOKING, now + 10_000)  # its name is forgotten by now
    assert run() == 21
    land("booking_old.csv", sample_feed.CDC_BOOKING, now - 7200)  # too old beside the newest
    assert run() == 21
