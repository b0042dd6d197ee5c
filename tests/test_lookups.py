"""Looking up a batch in a stored table, and the daily aggregate kept up by images."""

import pytest

from tests.build import same_rows
from tests.test_plans import base_chains, plan_of
from tidemark import constants as K
from tidemark.operators import changes as C
from tidemark.plans import gold
from tidemark.specs import BOOKING, FACT_KEY, FACT_SCHEMA
from tidemark.state.table import VersionedTable
from tidemark.streaming.flow import Flow
from tidemark.workload import feeds

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module", autouse=True)
def long_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    t = VersionedTable(spark, str(tmp_path_factory.mktemp("lookup") / "t"), BOOKING.key, BOOKING.state_schema, buckets=8)
    t.commit(C.change_set(None, feeds.newest(spark, SF, BOOKING, feeds.FULL), BOOKING), clustered=True)
    return t


def scanned(df) -> tuple[int, int]:
    """Files and rows that the scans of an executed plan have read."""
    df.collect()
    plan, files, rows = [df._jdf.queryExecution().executedPlan()], 0, 0
    while plan:
        node = plan.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            plan.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            plan.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            files += node.metrics().apply("numFiles").value()
            rows += node.metrics().apply("numOutputRows").value()
        plan.extend(node.children().apply(i) for i in range(node.children().size()))
    return files, rows


def test_listed_keys_choose_buckets(spark, table):
    every, some = table.read(), ["BK1", "BK2", "BK3"]
    few = table.read_keys(some)
    plan = plan_of(few)
    assert "PushedFilters: [In(BOOKING_ID, [BK1,BK2,BK3])]" in plan
    assert scanned(few)[1] < scanned(every)[1] / 2  # at most three of eight buckets
    assert same_rows(few, every.filter(every.BOOKING_ID.isin(some)))


def test_looked_up_columns_have_bloom_filters(spark, tmp_path):
    def size(looked_up):
        t = VersionedTable(spark, str(tmp_path / f"b{len(looked_up)}"), BOOKING.key, BOOKING.state_schema, buckets=1, looked_up=looked_up)
        t.commit(C.change_set(None, feeds.newest(spark, SF, BOOKING, feeds.FULL), BOOKING), clustered=True)
        path = next((tmp_path / f"b{len(looked_up)}").rglob("*.parquet"))
        return path, path.stat().st_size

    spark.conf.set("parquet.enable.dictionary", "false")  # as in large files, whose dictionaries overflow
    try:
        (_, small), (path, large) = size(()), size(("PASSENGER_ID",))
    finally:
        spark.conf.unset("parquet.enable.dictionary")
    assert large > small + 1000  # a filter of the second column
    absent = spark.read.parquet(str(path)).filter("PASSENGER_ID = 'PX12x'")  # between the least and the greatest
    assert scanned(absent) == (1, 0)


def test_batches_bring_their_range_and_a_runtime_filter(spark, table, monkeypatch):
    """A shuffled look-up: the range of the batch reaches the files of the base, and so does a filter built from it."""
    rows = feeds.newest(spark, SF, BOOKING, feeds.DELTA)
    staged, n = table.stage(rows)
    assert n == rows.count() == staged.count()
    low, high = rows.agg({"BOOKING_ID": "min"}).first()[0], rows.agg({"BOOKING_ID": "max"}).first()[0]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = C.change_set(table.read(), staged, BOOKING, lookup="pick")
        plan = plan_of(df)
        assert f"GreaterThanOrEqual(BOOKING_ID,{low})" in plan and f"LessThanOrEqual(BOOKING_ID,{high})" in plan
        assert "might_contain" in plan
        assert not any("Exchange" in op for chain in base_chains(table, df) for op in chain)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_all_lookups_find_the_same_rows(spark, tmp_path, monkeypatch):
    states = []
    for listed, broadcast in ((10**9, 10**9), (0, 10**9), (0, 0)):
        monkeypatch.setattr(K, "LISTED_KEYS", listed)
        monkeypatch.setattr(K, "BROADCAST_ROWS", broadcast)
        flow = Flow(spark, str(tmp_path / f"{listed}-{broadcast}"), "", run_ts=feeds.try_timestamp(feeds.F.col(K.CHANGE_TS)))
        for batch in (feeds.FULL, feeds.DELTA):
            flow.merge_batch(BOOKING, feeds.raw_batches(spark, "/root/testdata/sf0.001", batch)[BOOKING])
        states.append(flow.silver["booking"].read())
    assert same_rows(states[0], states[1]) and same_rows(states[0], states[2])


def test_empty_batches_change_nothing(spark, table):
    version = table.version()
    staged, n = table.stage(feeds.newest(spark, SF, BOOKING, feeds.DELTA).filter("false"))
    assert n == 0 and staged.count() == 0
    assert table.commit(C.change_set(table.read_keys([]), staged, BOOKING))["version"] == version


def fact_rows(spark, rows):
    names = ["BOOKING_ID", "BOOKING_DATE", "ROUTE", "CHANNEL", "FARE_AMOUNT", "NET_REVENUE", "CLAIM_AMOUNT", "IS_AT_RISK"]
    loose = spark.createDataFrame(rows, "a string, b date, c string, d string, e double, f double, g double, h boolean").toDF(*names)
    f = gold.F
    return loose.select(*[(f.col(c.name) if c.name in names else f.lit(None)).cast(c.dataType).alias(c.name) for c in FACT_SCHEMA])


def test_images_keep_totals_as_a_rebuild_has_them(spark):
    import datetime

    day = datetime.date(2026, 8, 1)
    before = fact_rows(spark, [("a", day, "X-Y", "WEB", 1.5, 1.0, 0.0, True), ("b", day, "X-Y", "WEB", None, None, 0.0, False),
                               ("c", None, None, "APP", None, None, 2.0, None), ("d", day, "gone", "WEB", 3.0, 3.0, 0.0, True)])
    after = fact_rows(spark, [("a", day, "Z-Y", "WEB", 2.5, 2.0, 0.0, False), ("b", day, "X-Y", "WEB", None, None, 0.0, True),
                              ("c", None, None, "APP", 7.0, 6.0, 2.0, True), ("e", day, "new", None, 1.0, -1.0, None, False)])
    changes = gold._paired(before, after)
    kinds = {r[0] for r in changes.select(C.CHANGE_TYPE).collect()}
    assert kinds == {"insert", "update", "delete"}
    kept = gold.totals_shown(gold.maintained_totals(gold.daily_totals(before), C.change_rows(changes)))
    want = gold.daily_route(after)
    assert same_rows(kept, want.select(*[gold.F.col(c).cast(kept.schema[c].dataType) for c in kept.columns]))


def test_a_rebuilt_fact_gives_new_totals(spark, tmp_path):
    flow = Flow(spark, str(tmp_path / "flow"), "", run_ts=None)
    assert flow.refresh_daily_route().count() == 0
    for step in (feeds.FULL, feeds.DELTA, None):
        if step is None:
            flow.rebuild_gold()
        else:
            flow.merge_all(feeds.raw_batches(spark, "/root/testdata/sf0.001", step))
            flow.refresh_gold()
        kept = flow.refresh_daily_route()
        want = gold.daily_route_summary(flow.fact.read())
        assert same_rows(kept, want.select(*[gold.F.col(c).cast(kept.schema[c].dataType) for c in kept.columns]))
    assert FACT_KEY == "BOOKING_ID"
