import time

import pytest
from pyspark.sql import functions as F

from tests import sample_feed
from tests.build import same_rows
from tidemark.specs import AS_DELIVERED, BOOKING, CLAIM, SAFE
from tidemark.streaming.flow import Flow


@pytest.fixture
def landing(tmp_path):
    return tmp_path / "landing"


def flow_on(spark, tmp_path, landing, **kw):
    return Flow(spark, str(tmp_path / "root"), str(landing), **kw)


def net(flow):
    return flow.fact.read().agg(F.sum("NET_REVENUE")).first()[0]


def test_only_new_files_are_read(spark, tmp_path, landing):
    sample_feed.land(landing, "fullload", sample_feed.FULL)
    flow = flow_on(spark, tmp_path, landing)
    flow.run_available()
    assert flow.silver["booking"].record()["rows"] == 10 and str(net(flow)) == "9597.50"

    assert flow.run_available() is None  # nothing new: no version, no refresh
    assert [t.version() for t in flow.silver.values()] == [1, 1, 1] and not flow.has_changes()

    sample_feed.land(landing, "cdc", sample_feed.CDC)
    flow.run_available()
    assert flow.silver["booking"].record()["counts"] == {"insert": 2, "update": 4, "delete": 0}
    assert str(net(flow)) == "9778.49"
    audit = {r.SRC_FILE: r.ROWS_READ for r in flow.load_audit().collect()}
    assert audit == {
        "fullload/booking_0001.csv": 10, "fullload/reservation_0001.csv": 10, "fullload/claim_0001.csv": 5,
        "cdc/booking_0001.csv": 7, "cdc/reservation_0001.csv": 7, "cdc/claim_0001.csv": 4,
    }

    # the old full load under a new name: read again, but no row is older than what is stored
    sample_feed.land(landing, "fullload", sample_feed.FULL, tag="0002")
    assert flow.run_available() is None
    assert flow.silver["booking"].version() == 2


def test_one_file_per_batch_gives_the_same_state(spark, tmp_path, landing):
    sample_feed.land(landing, "fullload", sample_feed.FULL)
    sample_feed.land(landing, "cdc", sample_feed.CDC)
    together = Flow(spark, str(tmp_path / "a"), str(landing))
    apart = Flow(spark, str(tmp_path / "b"), str(landing), max_files=1)
    for flow in (together, apart):
        flow.ingest_available(BOOKING)
    assert (together.silver["booking"].version(), apart.silver["booking"].version()) == (1, 2)
    drop = "UPDATED_AT"
    assert same_rows(together.silver["booking"].read().drop(drop), apart.silver["booking"].read().drop(drop))


def test_delivered_again_after_a_crash(spark, tmp_path, landing, monkeypatch):
    """The batch was committed but Spark never heard: its second delivery is skipped."""
    sample_feed.land(landing, "fullload", sample_feed.FULL)
    flow = flow_on(spark, tmp_path, landing, policy=AS_DELIVERED)
    with monkeypatch.context() as broken:
        def crash(spec):
            raise OSError("lost the driver")

        broken.setattr(flow, "_clear_raw", crash)
        with pytest.raises(Exception, match="lost the driver"):
            flow.ingest_available(CLAIM)
    assert flow.silver["claim"].version() == 1 and flow.raw(CLAIM).count() == 5
    flow.ingest_available(CLAIM)
    assert flow.silver["claim"].version() == 1 and flow.raw(CLAIM).count() == 0


def test_rejected_rows_are_kept(spark, tmp_path, landing):
    lines = sample_feed.FULL_BOOKING.splitlines()
    broken = [lines[1].replace("BK1001", ""), lines[2].replace("1000000002", "later"), lines[3].replace("ATL", "ATLA")]
    text = "\n".join([lines[0], *broken, *lines[4:]]) + "\n"
    sample_feed.land(landing, "fullload", {"booking": text})
    flow = flow_on(spark, tmp_path, landing)
    flow.ingest_available(BOOKING)
    assert flow.silver["booking"].record()["rows"] == 7
    reasons = sorted(r.REJECT_REASON for r in flow.quarantine(BOOKING).collect())
    assert reasons == ["ORIGIN too long", "missing key", "unusable sequence"]
    assert flow.load_audit().first().ROWS_REJECTED == 3


def test_forced_reload_and_older_batch(spark, tmp_path, landing):
    sample_feed.land(landing, "fullload", sample_feed.FULL)
    sample_feed.land(landing, "cdc", sample_feed.CDC)
    fares = {}
    for name, policy in (("safe", SAFE), ("plain", AS_DELIVERED)):
        flow = Flow(spark, str(tmp_path / name), str(landing), policy)
        for prefix in ("fullload", "cdc", "fullload"):
            flow.load(prefix)
        row = flow.silver["booking"].read().filter("BOOKING_ID = 'BK1004'").first()
        fares[name] = row.BOOKING_STATUS
    assert fares == {"safe": "CONFIRMED", "plain": "PENDING"}  # without the guard the state regresses


def test_replay_twice(spark, tmp_path, landing, run_ts):
    sample_feed.land(landing, "fullload", sample_feed.FULL)
    sample_feed.land(landing, "cdc", sample_feed.CDC)
    flow = flow_on(spark, tmp_path, landing, run_ts=run_ts)
    results = flow.replay()
    assert {r.STATUS for r in results.collect()} == {"PASS"}
    first = sorted(map(tuple, flow.fact.read().collect()))
    flow.replay()
    assert sorted(map(tuple, flow.fact.read().collect())) == first and len(first) == 9
    assert flow.quality_history().count() == 12  # results outlive a reset
    assert {r.STEP for r in flow.run_log().collect()} == {"RAW->SILVER", "SILVER->GOLD", "GOLD->OUTBOUND"}
    assert flow.run_log().filter("STEP = 'GOLD->OUTBOUND'").first().ROWS_AFFECTED == 9
    # streams start anew after a reset, too
    flow.reset()
    flow.run_available()
    assert sorted(map(tuple, flow.fact.read().collect())) == first


def test_log_notes_count_rows_and_keys(spark, tmp_path, landing):
    sample_feed.land(landing, "fullload", sample_feed.FULL)
    sample_feed.land(landing, "cdc", sample_feed.CDC)
    flow = flow_on(spark, tmp_path, landing, policy=AS_DELIVERED)
    flow.load("fullload")
    flow.refresh_gold()
    flow.load("cdc")
    flow.refresh_gold()
    notes = [r.NOTE for r in flow.run_log().filter("STEP = 'SILVER->GOLD'").collect()]
    assert any(n.startswith("change rows: 10,") for n in notes)


def test_rebuild_writes_fact_and_summary(spark, tmp_path, landing, run_ts):
    sample_feed.land(landing, "fullload", sample_feed.FULL)
    sample_feed.land(landing, "cdc", sample_feed.CDC)
    flow = flow_on(spark, tmp_path, landing, run_ts=run_ts)
    flow.load("fullload")
    flow.refresh_gold()
    flow.load("cdc")
    flow.refresh_gold()
    incremental = sorted(map(tuple, flow.fact.read().collect()))
    flow.rebuild_gold()
    assert sorted(map(tuple, flow.fact.read().collect())) == incremental
    assert flow.daily_route_summary().count() == 9
    assert flow.refresh_gold() is None  # the rebuild took all changes in
    flow.register_views()
    assert spark.sql("SELECT sum(BOOKINGS) n FROM v_daily_route").first().n == 9
    assert spark.sql("SELECT * FROM gold_booking_fact WHERE BOOKING_ID IN ('BK1002','BK1005','BK1007')").isEmpty()


def test_continuous_run(spark, tmp_path, landing):
    sample_feed.land(landing, "fullload", sample_feed.FULL)
    flow = flow_on(spark, tmp_path, landing)
    queries = flow.start_continuous("1 second")
    try:
        for prefix, files, expected in (("fullload", None, "9597.50"), ("cdc", sample_feed.CDC, "9778.49")):
            if files:
                sample_feed.land(landing, prefix, files)
            deadline = time.time() + 90
            while time.time() < deadline and (flow.fact.is_empty() or str(net(flow)) != expected):
                assert all(q.exception() is None for q in queries)
                time.sleep(0.5)
            assert str(net(flow)) == expected
    finally:
        for q in queries:
            q.stop()


def test_feeds_without_files(spark, tmp_path, landing):
    sample_feed.land(landing, "fullload", {"booking": sample_feed.FULL_BOOKING})
    flow = flow_on(spark, tmp_path, landing)
    flow.run_available()
    assert flow.fact.record()["rows"] == 9 and flow.silver["claim"].is_empty()
    again = Flow(spark, str(tmp_path / "other"), str(landing))
    again.load("fullload")
    again.refresh_gold()
    assert again.fact.record()["rows"] == 9


def test_broken_off_before_the_export(spark, tmp_path, landing, monkeypatch):
    sample_feed.land(landing, "fullload", sample_feed.FULL)
    flow = flow_on(spark, tmp_path, landing)
    with monkeypatch.context() as broken:
        def crash():
            raise OSError("lost the driver")

        broken.setattr(flow, "export", crash)
        with pytest.raises(OSError):
            flow.run_available()
    assert flow.needs_export()
    assert flow.run_available() is None  # no new data, but the export is made up for
    assert not flow.needs_export() and list((tmp_path / "root/outbound/booking_fact").glob("run=*/*.csv.gz"))
