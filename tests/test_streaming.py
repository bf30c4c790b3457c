"""Streams against their batch counterparts, with restarts and replays."""

import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from clickloom.operators import parsing
from clickloom.schemas import EVENT_V2
from clickloom.session import run_dir, shared_dir
from clickloom.sinks.snapshots import compact_snapshot, drop_compacted, upsert_counts
from clickloom.sinks.tables import export_csv, write_events, write_watermark
from clickloom.sources.snapshots import ordered_snapshot, read_changes, read_snapshot
from clickloom.sources.streams import event_stream
from clickloom.sources.tables import batch_watermark, event_lines, event_table, landed_messages
from clickloom.streaming import counts, landing


def line(i, name="click", product="A", time="2024-01-01T00:00:00Z"):
    return json.dumps(dict(
        event_id=str(i), event_time=time, event_name=name, user_id="U", session_id="S", device="mobile",
        currency="USD", product_id=product, price=1.0, cart_id="C", page_url="/", referrer="/"))


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def run(spark, folder, out, checkpoint):
    stream = event_stream(spark, "files", path=str(folder), files_per_trigger=1)
    query = counts.start_counts(stream, str(out), str(checkpoint), available_now=True)
    query.awaitTermination()
    return query


def table(df):
    return {(r.product_id, r.event_name): r["count"] for r in df.collect()}


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "in"
    put(folder, "1.json", line(1), line(2, "purchase"), line(3, product="B"), "{broken")
    put(folder, "2.json", line(4), line(5, None), line(6, product=None), line(7, time="x"))
    put(folder, "3.json", line(8), line(9, product="B"))
    return folder


def test_counts_restart_and_replay(spark, inbox, tmp_path):
    out, checkpoint = tmp_path / "out", tmp_path / "cp"
    run(spark, inbox, out, checkpoint)
    batch = counts.product_event_counts(parsing.speed_events(event_lines(spark, str(inbox))))
    expected = {("A", "click"): 3, ("A", "purchase"): 1, ("B", "click"): 2}
    assert table(read_snapshot(spark, str(out))) == expected
    assert table(batch.filter("event_name IS NOT NULL")) == expected

    put(inbox, "4.json", line(10, "purchase", "B"), line(11))
    run(spark, inbox, out, checkpoint)
    expected.update({("A", "click"): 4, ("B", "purchase"): 1})
    assert table(read_snapshot(spark, str(out))) == expected
    assert table(read_snapshot(spark, str(out), "B")) == {("B", "click"): 2, ("B", "purchase"): 1}
    assert ordered_snapshot(read_snapshot(spark, str(out))).first()["count"] == 4

    # Writing a batch twice changes nothing, and only changed keys are written.
    newest = read_changes(spark, str(out)).agg(F.max("batch_id")).first()[0]
    again = spark.createDataFrame([("A", "click", 4), ("B", "purchase", 1)],
                                  "product_id string, event_name string, count long")
    upsert_counts(str(out), epoch=0)(again, newest)
    assert table(read_snapshot(spark, str(out))) == expected
    assert read_changes(spark, str(out)).filter(F.col("batch_id") == newest).count() == 2

    assert compact_snapshot(spark, str(out)) == newest
    assert table(read_snapshot(spark, str(out))) == expected
    drop_compacted(spark, str(out))
    assert table(read_snapshot(spark, str(out))) == expected
    put(inbox, "5.json", line(12))
    run(spark, inbox, out, checkpoint)
    expected[("A", "click")] = 5
    assert table(read_snapshot(spark, str(out))) == expected
    assert compact_snapshot(spark, str(out)) > newest
    assert table(read_snapshot(spark, str(out))) == expected


def test_unfinished_batch_is_not_compacted(spark, tmp_path):
    write = upsert_counts(str(tmp_path), epoch=0)
    schema = "product_id string, event_name string, count long"
    write(spark.createDataFrame([("A", "click", 1), ("B", "click", 1)], schema), 0)
    write(spark.createDataFrame([("A", "click", 2)], schema), 1)
    (tmp_path / "changes" / "batch_id=1" / "_SUCCESS").unlink()
    assert compact_snapshot(spark, str(tmp_path)) == 0
    write(spark.createDataFrame([("A", "click", 2), ("B", "click", 3)], schema), 1)
    drop_compacted(spark, str(tmp_path))
    assert table(read_snapshot(spark, str(tmp_path))) == {("A", "click"): 2, ("B", "click"): 3}


def test_no_snapshot_yet(spark, tmp_path):
    assert read_snapshot(spark, str(tmp_path / "none")).count() == 0
    assert compact_snapshot(spark, str(tmp_path / "none")) is None


def test_landing_keeps_everything(spark, inbox, tmp_path):
    stream = event_stream(spark, "files", path=str(inbox), files_per_trigger=1)
    landing.start_landing(stream, str(tmp_path / "raw"), str(tmp_path / "cp"), records_per_file=3,
                          available_now=True).awaitTermination()
    landed = landed_messages(spark, str(tmp_path / "raw"))
    assert landed.count() == 10
    assert sorted(r.value for r in landed.collect()) == sorted(
        r.value for r in event_lines(spark, str(inbox)).collect())
    assert len(list((tmp_path / "raw").glob("part-*"))) > 3


def test_event_table_and_quarantine(spark, inbox, tmp_path):
    for start, name in ((landing.start_event_table, "events"), (landing.start_quarantine, "bad")):
        stream = event_stream(spark, "files", path=str(inbox))
        start(stream, str(tmp_path / name), str(tmp_path / f"cp-{name}"), available_now=True).awaitTermination()
    events = event_table(spark, str(tmp_path / "events"))
    assert set(events.columns) == set(EVENT_V2.names)
    assert {r.event_id for r in events.collect()} == {"1", "3", "4", "8", "9"}
    assert event_table(spark, str(tmp_path / "bad")).count() == 5


def test_windows_drop_late_rows(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "1.json", line(1, time="2024-01-01T00:00:30Z"), line(2, time="2024-01-01T01:00:00Z"))
    put(folder, "2.json", line(3, time="2024-01-01T02:00:00Z"))
    # A batch is held against the watermark of the batch before it, by now past midnight.
    put(folder, "3.json", line(4, time="2024-01-01T00:00:40Z"), line(5, time="2024-01-01T05:00:00Z"))
    put(folder, "4.json", line(6, time="2024-01-01T09:00:00Z"))
    for n in range(1, 5):
        os.utime(folder / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    stream = event_stream(spark, "files", path=str(folder), files_per_trigger=1)
    query = counts.start_windowed_counts(stream, str(tmp_path / "w"), str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    found = {(r.window_start.hour, r["count"]) for r in spark.read.parquet(str(tmp_path / "w")).collect()}
    assert {(0, 1), (1, 1), (2, 1)} <= found and (0, 2) not in found


def test_exact_counts_cover_both_sides_once(spark):
    times = [datetime(2024, 1, 1, h, 15, tzinfo=timezone.utc) for h in range(6)]
    events = spark.createDataFrame([(t, "click", "A") for t in times], "event_time timestamp, event_name string, product_id string")
    windows = counts.windowed_counts(events.withColumn("event_time_ts", F.col("event_time")), "1 hour")
    for upto in (datetime(2024, 1, 1, 3, tzinfo=timezone.utc), times[2], times[5], None):
        watermark = spark.createDataFrame([(upto,)], "watermark timestamp")
        early = events.filter(F.col("event_time") <= F.lit(upto)) if upto else events.filter("false")
        found = counts.exact_counts(early, windows, watermark, "1 hour")
        assert [tuple(r) for r in found.collect()] == [("click", 6)]


def test_watermark_table_and_export(spark, tmp_path):
    rows = spark.createDataFrame([(datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc), "click")],
                                 "event_time timestamp, event_name string")
    write_watermark(rows, str(tmp_path / "mark"))
    assert batch_watermark(spark, str(tmp_path / "mark")).first().watermark.hour == 3
    write_events(rows, str(tmp_path / "events"))
    assert event_table(spark, str(tmp_path / "events")).first().event_name == "click"
    export_csv(rows.select("event_name"), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()[0].event_name == "click"


def test_stream_kinds(spark):
    with pytest.raises(ValueError):
        event_stream(spark, "carrier pigeon")


def test_working_folder_is_the_shared_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_fresh_checkpoint_on_an_old_folder(spark, tmp_path):
    schema = "product_id string, event_name string, count long"
    old = upsert_counts(str(tmp_path))
    for batch, n in enumerate((10, 20, 30)):
        old(spark.createDataFrame([("A", "click", n)], schema), batch)
    compact_snapshot(spark, str(tmp_path))
    new = upsert_counts(str(tmp_path), compact_every=2)
    new(spark.createDataFrame([("A", "click", 1)], schema), 0)
    assert table(read_snapshot(spark, str(tmp_path))) == {("A", "click"): 1}
    new(spark.createDataFrame([("A", "click", 2)], schema), 1)
    assert table(read_snapshot(spark, str(tmp_path))) == {("A", "click"): 2}


def test_landing_keeps_line_breaks(spark, tmp_path):
    rows = spark.createDataFrame([("a\nb",), (None,), ("",)], "value string")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("value string").parquet(str(tmp_path / "in"))
    landing.start_landing(stream, str(tmp_path / "raw"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    landed = [r.value for r in landed_messages(spark, str(tmp_path / "raw")).collect()]
    assert sorted(landed, key=str) == ["", None, "a\nb"]
