"""Late rows, streamed sessions, and an event table that is put in order while a stream writes to it."""

import os
from datetime import datetime, timedelta, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clickloom.schemas import FUNNEL_STAGES
from clickloom.sinks import upkeep
from clickloom.sources.streams import event_stream
from clickloom.streaming import counts, late, sessions
from test_streaming import line, put

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def stamp(minute):
    return (START + timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%SZ")


@pytest.fixture
def inbox(tmp_path):
    """Ten minutes in order, a row 20 minutes late, one a minute late, one without a product."""
    folder = tmp_path / "in"
    put(folder, "1.json", *[line(i, time=stamp(i)) for i in range(10)], line(90, time=stamp(45)), "{broken")
    put(folder, "2.json", line(91, time=stamp(5)), line(92, time=stamp(44)), line(93, time=stamp(60), product=None))
    put(folder, "3.json", line(94, "purchase", time=stamp(6)), line(95, time=stamp(70)))
    for n in (1, 2, 3):  # files are read by age
        os.utime(folder / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    return folder


def counted(spark, folder, path, checkpoint):
    query = late.start_counted_windows(
        event_stream(spark, "files", path=str(folder), files_per_trigger=1), path, checkpoint, available_now=True, compact_every=2)
    query.awaitTermination()
    return query


def test_late_rows_are_counted_apart(spark, inbox, tmp_path):
    path = str(tmp_path / "out")
    query = counted(spark, inbox, path, str(tmp_path / "cp"))
    seen = [p["observedMetrics"]["arrivals"]["rows"] for p in query.recentProgress if "arrivals" in p["observedMetrics"]]
    assert sum(seen) == 16
    found = {(r.window_start, r.event_name): (r["count"], r.behind) for r in late.read_late(spark, path).collect()}
    assert sorted((r[1], n, b) for r, (n, b) in found.items()) == [("click", 1, 30 * 60), ("purchase", 1, 29 * 60)]
    windows = late.read_windows(spark, path)
    assert windows.agg(F.sum("count")).first()[0] == 13

    # Spark's own windows have the same rows but for those they drop.
    plain = counts.start_windowed_counts(event_stream(spark, "files", path=str(inbox), files_per_trigger=1),
                                         str(tmp_path / "w"), str(tmp_path / "wcp"), available_now=True)
    plain.awaitTermination()
    closed = late.read_windows(spark, path, closed_after="10 minutes").agg(F.sum("count")).first()[0]
    kept = spark.read.parquet(str(tmp_path / "w")).agg(F.sum("count")).first()[0]
    assert late.dropped_rows(plain) == 1 and kept + 1 == closed + 2

    # A restart goes on from there; nothing is lost in all.
    put(inbox, "4.json", line(96, time=stamp(1)), line(97, time=stamp(71)))
    counted(spark, inbox, path, str(tmp_path / "cp"))
    assert late.read_late(spark, path).agg(F.sum("count")).first()[0] == 3
    events = spark.createDataFrame([(stamp(m), n) for m, n in [(0, "click")] * 13 + [(0, "purchase")]], "at string, event_name string")
    events = events.select(F.to_timestamp("at").alias("event_time"), "event_name", F.lit("A").alias("product_id"))
    none = spark.createDataFrame([(None,)], "watermark timestamp")
    exact = counts.exact_counts(events, late.read_windows(spark, path), none, late=late.read_late(spark, path))
    assert {r.event_name: r["count"] for r in exact.collect()} == {"click": 16, "purchase": 1}

    with pytest.raises(ValueError):
        late.counted_batches(path)(spark.createDataFrame([], "product_id string, event_name string, event_time_ts timestamp"), 0)


def visits(spark, *rows):
    return spark.createDataFrame([(s, START + timedelta(minutes=m) if m is not None else None, n) for s, m, n in rows],
                                 "session_id string, event_time timestamp, event_name string")


def test_streamed_sessions_are_those_of_the_batch(spark, tmp_path):
    rows = [("S", 0, "click"), ("S", 20, "add_to_cart"), ("S", 50, "click"), ("S", 81, "click"), (None, 5, "click"),
            ("T", 3, "purchase"), ("T", None, "click"), ("T", 4, "wishlist"), ("U", 10, "click")]
    batch = sessions.session_runs(visits(spark, *rows))
    found = {(r.session_id, r.session_start.replace(tzinfo=timezone.utc)): r for r in batch.collect()}
    assert sorted((s, int((t - START).total_seconds() // 60), r.events) for (s, t), r in found.items()) == [
        ("S", 0, 3), ("S", 81, 1), ("T", 3, 1), ("U", 10, 1)]
    first = found["S", START].stages
    assert [(s.event_name, s.events) for s in first] == [("click", 2), ("add_to_cart", 1)]

    # In two arrivals, the second with an event that joins two runs; a far event closes all before it.
    source = str(tmp_path / "in")
    for part in ([rows[0], rows[2], *rows[4:]], [rows[1], rows[3], ("Z", 1000, "click")]):
        visits(spark, *part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("session_id string, event_time timestamp, event_name string").parquet(source)
        sessions.start_sessions(stream, str(tmp_path / "out"), str(tmp_path / "cp"), late="60 minutes", available_now=True).awaitTermination()
    closed = sessions.run_stages(spark.read.parquet(str(tmp_path / "out")))
    assert sorted(map(tuple, closed.collect())) == sorted(map(tuple, sessions.run_stages(batch).collect()))


SCHEMA = "id BIGINT, event_time TIMESTAMP, event_name STRING, product_id STRING, event_date DATE"


def clicks(spark, n, seed, days=2):
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(days * 86_400)))
    name = F.get(F.array(*[F.lit(s) for s in FUNNEL_STAGES]), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(8)).cast("int"))
    return spark.range(n).select("id", at.alias("event_time"), name.alias("event_name"), F.format_string(
        "SKU%05d", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(500))).alias("product_id"))


def data_files(folder):
    return [os.path.join(d, f) for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet")]


def test_days_are_put_in_order_under_readers(spark, tmp_path):
    path, write = str(tmp_path), upkeep.arriving(str(tmp_path))
    assert upkeep.compact_days(spark, path, SCHEMA) is None
    total = 0
    for n in range(3):
        write(clicks(spark, 20_000, n).repartition(4), n)
        total += 20_000
    reader = upkeep.kept_events(spark, path, SCHEMA)
    assert upkeep.compact_days(spark, path, SCHEMA) == 2 and upkeep.compact_days(spark, path, SCHEMA) == 2
    # A reader from before the swap, one after it, and one with arrivals since then see each row once.
    assert reader.count() == upkeep.kept_events(spark, path, SCHEMA).count() == total
    write(clicks(spark, 1000, 9, days=1), 3)
    write(spark.createDataFrame([(1, None, None, None, None)], SCHEMA), 4)
    now = upkeep.kept_events(spark, path, SCHEMA)
    assert now.count() == total + 1001
    assert upkeep.compact_days(spark, path, SCHEMA) == 4
    assert now.count() == total + 1001 == upkeep.kept_events(spark, path, SCHEMA).count()
    # Only the day touched was written again.
    assert sorted(os.listdir(f"{path}/days/event_date=2024-01-01")) == ["version=2", "version=4"]
    assert os.listdir(f"{path}/days/event_date=2024-01-02") == ["version=2"]
    upkeep.drop_replaced(spark, path)
    assert upkeep.kept_events(spark, path, SCHEMA).count() == total + 1001
    assert len(data_files(f"{path}/days")) <= 4 and not data_files(f"{path}/arrivals")
    assert upkeep.kept_events(spark, path, SCHEMA).filter("event_date is null").count() == 1


def test_a_product_reads_few_row_groups(spark, tmp_path):
    path = str(tmp_path)
    upkeep.arriving(path)(clicks(spark, 200_000, 0, days=1).repartition(8), 0)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.setInt("parquet.block.size", 64 << 10)
    conf.setInt("parquet.block.size.row.check.min", 10)
    try:
        upkeep.compact_days(spark, path, SCHEMA)
    finally:
        conf.unset("parquet.block.size")
        conf.unset("parquet.block.size.row.check.min")
    files = data_files(f"{path}/days")
    groups = [pq.ParquetFile(f).metadata.row_group(i) for f in files for i in range(pq.ParquetFile(f).num_row_groups)]
    names = [groups[0].column(i).path_in_schema for i in range(groups[0].num_columns)]
    assert len(files) == 1 and len(groups) >= 20
    wanted = {"product_id": "SKU00250", "event_time": START + timedelta(hours=12)}
    for name, value in wanted.items():
        found = [g.column(names.index(name)).statistics for g in groups]
        hit = sum(s.min <= value <= s.max for s in found)
        assert 0 < hit <= 0.35 * len(groups), (name, hit, len(groups))
    bounds = upkeep.product_bounds(clicks(spark, 1000, 0))
    assert bounds == sorted(bounds) and len(bounds) == 63
    assert upkeep.product_bounds(clicks(spark, 0, 0)) == []
