"""Sessions as they end: runs of a visitor's events without a long gap, with the stages they went through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.schemas import FUNNEL_STAGES


def session_runs(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes", key: str = "session_id") -> DataFrame:
    """``key, session_start, session_end, events, stages`` per run of events at most ``gap`` apart.

    ``stages`` has a (event_name, first_time, last_time, events) for each funnel stage that occurs, in funnel order; other events
    are not looked at, nor rows without a key or time. ``session_end`` is ``gap`` after the last event. On a stream the
    state is one row per open run (Spark merges runs as late events join them), and a run is given out once the
    watermark, ``late`` behind the newest event, passes its end.
    """
    rows = events.filter(F.col(key).isNotNull() & F.col("event_time").isNotNull() & F.col("event_name").isin(*FUNNEL_STAGES)).select(
        key, "event_time", "event_name")
    if rows.isStreaming:
        rows = rows.withWatermark("event_time", late)
    per_stage = []
    for i, stage in enumerate(FUNNEL_STAGES):
        at = F.when(F.col("event_name") == stage, F.col("event_time"))
        per_stage += [F.min(at).alias(f"_first{i}"), F.max(at).alias(f"_last{i}"), F.count(at).alias(f"_n{i}")]
    runs = rows.groupBy(key, F.session_window("event_time", gap)).agg(F.count(F.lit(1)).alias("events"), *per_stage)
    stages = F.array(*[F.struct(F.lit(s).alias("event_name"), F.col(f"_first{i}").alias("first_time"),
                                F.col(f"_last{i}").alias("last_time"), F.col(f"_n{i}").alias("events"))
                       for i, s in enumerate(FUNNEL_STAGES)])
    return runs.select(
        key, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "events",
        F.filter(stages, lambda s: s["events"] > 0).alias("stages"))


def run_stages(runs: DataFrame, key: str = "session_id") -> DataFrame:
    """One row per run and stage."""
    return runs.select(key, "session_start", F.inline("stages"))


def start_sessions(events: DataFrame, path: str, checkpoint: str, gap: str = "30 minutes", late: str = "10 minutes",
                   available_now: bool = False, trigger: str | None = None) -> StreamingQuery:
    """Closed runs as Parquet files, each once."""
    writer = (session_runs(events, gap, late).writeStream.outputMode("append").format("parquet")
              .option("checkpointLocation", checkpoint).option("path", path))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()
