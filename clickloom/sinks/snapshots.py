"""Writing the running counts; the folder layout is described in ``sources.snapshots``."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.files import delete, numbered_folders
from clickloom.sources.snapshots import latest_counts, newest_base, newest_finished, read_changes


#: Batches a start may number; a folder's number is the start's second times this, plus the batch id.
BATCHES = 1_000_000_000


def upsert_counts(path: str, epoch: int | None = None,
                  compact_every: int | None = None) -> Callable[[DataFrame, int], None]:
    """Micro-batch callback: record the absolute counts of the keys that changed.

    A batch owns its folder, so writing it again after a failure changes nothing. Folders of a later start come
    after those of earlier ones, also if a new checkpoint counts its batches from 0 again. Events without
    a name have no field in a product's hash and are left to the quarantine. ``compact_every`` batches a base is written.
    """
    started = epoch

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal started
        if started is None:
            known = numbered_folders(batch.sparkSession, f"{path}/changes", "batch_id")
            known |= numbered_folders(batch.sparkSession, f"{path}/base", "batch_id")
            started = max([int(time.time()), *[n // BATCHES + 1 for n in known]])
        number = started * BATCHES + batch_id
        (
            batch.filter(F.col("event_name").isNotNull())
            .select("product_id", "event_name", "count")
            .write.mode("overwrite").parquet(f"{path}/changes/batch_id={number}")
        )
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_snapshot(batch.sparkSession, path)

    return write


def compact_snapshot(spark: SparkSession, path: str) -> int | None:
    """Write every key as of the newest finished batch into a base; readers then skip what it covers.

    A batch that is still being written stays out, or the rest of it would be skipped too. Returns
    the batch id. ``drop_compacted`` deletes the covered folders once no reader that started
    earlier is still running.
    """
    base = newest_base(spark, path)
    upto = newest_finished(spark, f"{path}/changes")
    if upto is None or (base is not None and upto <= base):
        return base
    covered = latest_counts(read_changes(spark, path).filter(F.col("batch_id") <= upto))
    covered.write.mode("overwrite").parquet(f"{path}/base/batch_id={upto}")
    return upto


def drop_compacted(spark: SparkSession, path: str) -> None:
    """Delete the changes and older bases that the newest base covers."""
    base = newest_base(spark, path)
    if base is None:
        return
    bases = numbered_folders(spark, f"{path}/base", "batch_id")
    changes = numbered_folders(spark, f"{path}/changes", "batch_id")
    for folder in [f for b, f in bases.items() if b < base] + [f for b, f in changes.items() if b <= base]:
        delete(spark, folder)
