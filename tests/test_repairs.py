"""Cart totals on a stream whose events arrive out of order."""

import os
import random
from datetime import timedelta

from pyspark.sql import functions as F

from clickloom.operators import carts, scans
from clickloom.plans import queries
from clickloom.session import shared_dir
from clickloom.streaming import carts as streaming_carts
from clickloom.streaming import repairs
from clickloom.streaming.buckets import BUCKETS, bucket_of, buckets_in, write_buckets
from test_carts import SCHEMA, START, fold, history, price_of


def totals(rows):
    return {r.event_id: (r.replayed_qty, r.replayed_value) for r in rows}


def in_order(rows):
    return fold(sorted(rows, key=lambda e: (e[2], e[3])))[0]


def test_shuffled_arrivals_end_as_the_batch(spark, tmp_path):
    rows = history(240, seed=11)
    random.Random(5).shuffle(rows)
    path, before = str(tmp_path / "out"), set(os.listdir(shared_dir(spark)))
    write = repairs.repaired_batches(path, late=timedelta(days=30), compact_every=2, buckets=4)
    for n in range(4):
        write(spark.createDataFrame(rows[n * 60:(n + 1) * 60], SCHEMA), n)
        if n == 2:
            assert totals(repairs.read_repaired(spark, path).collect()) == in_order(rows[:(n + 1) * 60])
    found = repairs.read_repaired(spark, path)
    assert found.count() == len(in_order(rows)) and totals(found.collect()) == in_order(rows)
    assert repairs.read_too_late(spark, path).count() == 0
    assert set(os.listdir(shared_dir(spark))) == before
    assert sorted(os.listdir(f"{path}/base")) == ["batch_id=1", "batch_id=3"]
    assert sorted(os.listdir(f"{path}/log")) == ["batch_id=2", "batch_id=3"]

    # Every retraction takes back the total issued before, and the changelog adds up to what stands.
    changes = repairs.read_corrections(spark, path)
    sign = F.when(F.col("change") == "issued", 1).otherwise(-1)
    left = changes.groupBy("arrived", "row", "replayed_qty", "replayed_value").agg(F.sum(sign).alias("n")).filter("n != 0")
    assert left.filter("n != 1").count() == 0 and left.count() == found.count()
    assert changes.filter("change = 'retracted'").count() > 30

    # The last batch once more changes nothing, although it wrote a base.
    write(spark.createDataFrame(rows[180:], SCHEMA), 3)
    assert totals(repairs.read_repaired(spark, path).collect()) == in_order(rows)


def test_only_what_changes_is_issued_again(spark, tmp_path):
    def at(i, name, product=None, quantity=None, cart="C"):
        return (cart, "S", START + timedelta(minutes=i), f"{i:02d}", name, product, quantity, price_of(product) if product else None, None, None)

    path, write = str(tmp_path), repairs.repaired_batches(str(tmp_path), compact_every=50)
    write(spark.createDataFrame([at(1, "add_to_cart", "P1", 1), at(5, "purchase"), at(7, "add_to_cart", "P2", 2),
                                 at(2, "add_to_cart", "P1", 1, "D")], SCHEMA), 0)
    write(spark.createDataFrame([at(9, "begin_checkout")], SCHEMA), 1)
    write(spark.createDataFrame([at(3, "add_to_cart", "P0", 4)], SCHEMA), 2)
    changed = repairs.read_corrections(spark, path).filter("batch_id = 2").collect()
    # The purchase empties the cart, so what follows it stays.
    assert sorted((r.event_id, r.change, r.replayed_qty) for r in changed) == [
        ("03", "issued", 5), ("05", "issued", 5), ("05", "retracted", 1)]
    write(spark.createDataFrame([], SCHEMA), 3)
    assert repairs.read_repaired(spark, path).count() == 6


def test_events_behind_the_horizon_are_set_aside(spark, tmp_path):
    def at(hour, i, name="add_to_cart", product="P1", cart="C"):
        return (cart, "S", START + timedelta(hours=hour), f"{i:02d}", name, product, 1, 1.0, None, None)

    path, write = str(tmp_path), repairs.repaired_batches(str(tmp_path), late=timedelta(hours=5), compact_every=2)
    write(spark.createDataFrame([at(0, 0), at(1, 1, cart="D"), at(2, 2, "purchase", None, "D")], SCHEMA), 0)
    write(spark.createDataFrame([at(10, 3), at(10, 4, cart="D")], SCHEMA), 1)
    # The emptied cart D keeps no version from before the horizon.
    base = repairs.read_versions(spark, path, 2).groupBy("cart_id").agg(F.sort_array(F.collect_set("version")).alias("v"))
    assert {r.cart_id: r.v for r in base.collect()} == {"C": [0, 1], "D": [1]}
    write(spark.createDataFrame([at(4, 5), at(6, 6), at(6, 7, cart="D"), at(3, 8, cart="E"), at(9, 9, cart="E")], SCHEMA), 2)
    assert sorted(r.event_id for r in repairs.read_too_late(spark, path).collect()) == ["05", "08"]
    assert {i: q for i, (q, _) in totals(repairs.read_repaired(spark, path).collect()).items()} == {
        "00": 1, "01": 1, "02": 1, "06": 2, "03": 3, "07": 1, "04": 2, "09": 1}


def test_repaired_stream(spark, tmp_path):
    rows = history(200, seed=21)
    random.Random(7).shuffle(rows)
    for part in range(2):
        spark.createDataFrame(rows[part * 100:(part + 1) * 100], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        repairs.start_repaired_replay(stream, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert totals(repairs.read_repaired(spark, str(tmp_path / "out")).collect()) == in_order(rows)


def scanned(plan, metric="numOutputRows"):
    """Records given out by each scan of an executed plan, or another of their metrics."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return scanned(plan.executedPlan(), metric)
    if "QueryStage" in plan.nodeName():
        return scanned(plan.plan(), metric)
    own = [plan.metrics().apply(metric).value()] if plan.nodeName().startswith("Scan parquet") else []
    for i in range(plan.children().size()):
        own += scanned(plan.children().apply(i), metric)
    return own


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    path = str(tmp_path)
    held = spark.range(100_000).select(
        F.concat(F.lit("C"), "id").alias("cart_id"), F.lit("P1").alias("product_id"), F.lit(1).cast("bigint").alias("quantity"),
        F.lit(1).cast("decimal(38,6)").alias("worth"))
    write_buckets(held, "cart_id", f"{path}/base/batch_id=0")
    batch = spark.createDataFrame([(f"C{i}", "S", START, f"{i}", "add_to_cart", "P2", 1, 1.0, None, None) for i in range(10)], SCHEMA)
    read = buckets_in(batch, "cart_id")
    assert 1 < len(read) <= 10 < BUCKETS
    rows = streaming_carts.contents_before(spark, path, 1, read)
    found = rows.collect()
    assert len(found) == held.filter(bucket_of("cart_id").isin(read)).count() < 100_000 * 0.2
    # Records that the scans gave out.
    scans = scanned(rows._jdf.queryExecution().executedPlan())
    assert max(scans) == len(found)

    streaming_carts.replay_batches(path)(batch, 1)
    got = streaming_carts.read_totals(spark, path).collect()
    assert len(got) == 10 and {r.replayed_qty for r in got} == {2}


def test_replay_is_the_batch_operator(spark):
    rows = history(50, seed=2)
    assert totals(carts.cart_replay(spark.createDataFrame(rows, SCHEMA)).collect()) == in_order(rows)


def test_busy_carts_end_as_the_others(spark, monkeypatch):
    rows, order = sorted(history(600, seed=31), key=lambda e: (e[2], e[3])), ["event_time", "event_id"]
    early, late = (spark.createDataFrame(part, SCHEMA) for part in (rows[:200], rows[200:]))
    held = carts.carried_replay(early, spark.createDataFrame([], streaming_carts.CONTENTS), order)[1]
    monkeypatch.setattr(carts, "BUSY", 70)
    monkeypatch.setattr(carts, "laid_out", lambda df, key, by, ranges: scans.laid_out(df, key, by, 7))
    found, after = carts.carried_replay(late, held, order)
    # The contents as aggregated from the rows.
    plain = carts.carried_replay(late, held)[1]
    contents = sorted(map(tuple, after.collect()), key=str)
    assert contents == sorted(map(tuple, plain.collect()), key=str) and len(contents) > 3
    got, expected = found.collect(), in_order(rows)
    assert totals(got) == {r[3]: expected[r[3]] for r in rows[200:] if r[3] in expected}
    per_cart = {c: sorted((r for r in got if r.cart_id == c), key=lambda r: (r.event_time, r.event_id)) for c in {r.cart_id for r in got}}
    assert all(mine[-1]["__tail"] for mine in per_cart.values())
    cut = {sum(r["__tail"] for r in mine) for mine in per_cart.values()}
    assert min(cut) == 1 < max(cut)


def nodes(df):
    return [line.strip(" :+-*()0123456789").split("(")[0].split(" ")[0]
            for line in df._jdf.queryExecution().executedPlan().toString().splitlines()]


def test_a_replay_sorts_three_times_and_contents_are_read_off(spark):
    events = spark.createDataFrame(history(50, seed=3), SCHEMA)
    held = spark.createDataFrame([], streaming_carts.CONTENTS)
    lazy, _ = carts.carried_replay(events, held)
    assert nodes(lazy).count("Sort") == 3 and nodes(lazy).count("Exchange") == 1
    found, _ = carts.carried_replay(events, held, ["event_time", "event_id"])
    assert not {"Sort", "Window", "Exchange"} & set(nodes(found))


def test_one_log_folder_is_read_as_it_is(spark, tmp_path):
    rows, path = history(90, seed=4), str(tmp_path)
    write = repairs.repaired_batches(path, late=timedelta(days=30), compact_every=2, buckets=4)
    for n in range(3):
        write(spark.createDataFrame(rows[n::3], SCHEMA), n)
    for before, grouped in (1, False), (2, False), (3, True):
        assert ("Exchange" in nodes(repairs.read_log(spark, path, before))) == grouped
    assert totals(repairs.read_log(spark, path, 3).collect()) == totals(repairs.read_repaired(spark, path).collect()) == in_order(rows)


def test_arrivals_are_read_from_the_table_once(spark, tmp_path):
    made, rows = spark.sparkContext.accumulator(0), spark.range(90)

    @F.udf("long")
    def seen(value):
        made.add(1)
        return value

    counted = rows.select(seen("id").alias("id"))
    queries._in_parts(spark, counted, F.col("id") % 2 * 2, lambda s: s.writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out")), 3)
    assert made.value == 90 and spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect() == rows.orderBy("id").collect()
