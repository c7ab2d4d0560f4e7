"""Scheduled micro-batch ingestion on Structured Streaming (P-family).

The warehouse loads a 3-hour window every 3 hours. Here the same cadence is
a streaming query over the landing folder: ``trigger(availableNow=True)``
processes every new file once and stops (a scheduler restarts it), the
checkpoint records which files are done (so a lost executor or a re-run
never loads a file twice), and ``foreachBatch`` applies the keyed upsert of
the L-family to the versioned target and logs per-batch row counts.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import VersionedTable, keep_latest, upsert
from ..sources.schemas import schema

c = F.col


# P01 ----------------------------------------------------------------------
def batch_window(end: _dt.datetime, hours: int = 3) -> tuple[_dt.datetime, _dt.datetime, str]:
    """[end - h, end) with end floored to the hour, and the YYYYMMDDHH tag."""
    e = end.replace(minute=0, second=0, microsecond=0)
    return e - _dt.timedelta(hours=hours), e, e.strftime("%Y%m%d%H")


def windowed_counts(df: DataFrame, ts: str, hours: int = 3, by: tuple[str, ...] = ()) -> DataFrame:
    """Tumbling ``hours``-wide windows (the batch cadence) with counts; works
    on a batch or a streaming DataFrame."""
    w = F.window(c(ts), f"{hours} hours")
    return (df.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("rows"))
            .select(c("w.start").cast("timestamp_ntz").alias("window_start"),
                    c("w.end").cast("timestamp_ntz").alias("window_end"), *by, "rows"))


# P02 ----------------------------------------------------------------------
def incremental_file_ingest(spark: SparkSession, landing: str, table: str, target: VersionedTable, key: list[str],
                            checkpoint: str, log: list | None = None, file_format: str = "parquet",
                            loaded_at_col: str = "_loaded_at", mode: str = "upsert"):
    """Start an availableNow streaming load of new files into ``target``.

    The number of the last batch of this query (known by its checkpoint) is
    kept with the table in the commit that holds the batch's rows. A batch that
    is run again, because the driver died between that commit and the stream's
    own, is skipped: each file counts once, also with ``mode="append"``, which
    adds all rows.

    Each micro-batch: stamp ``_loaded_at`` / ``_source_file`` if missing,
    upsert by ``key`` (latest ``_loaded_at`` wins, also over earlier batches;
    a target with key buckets rewrites only those touched) and record the row count. Returns the StreamingQuery (call
    ``awaitTermination()``)."""
    st = schema(table)
    stream = spark.readStream.schema(st).format(file_format).load(landing)

    def apply(batch: DataFrame, batch_id: int) -> None:
        b = batch
        if loaded_at_col in b.columns:
            b = b.withColumn(loaded_at_col, F.coalesce(c(loaded_at_col), F.current_timestamp().cast("timestamp_ntz")))
        if "_source_file" in b.columns:
            b = b.withColumn("_source_file", F.coalesce(c("_source_file"), F.lit(f"batch_{batch_id}")))
        n = b.count()
        if n == 0:
            return
        before, tag = target.current_version(), (f"stream:{checkpoint}", batch_id)
        if mode == "append":
            target.append(b, tag)
        else:
            target.merge(keep_latest(b, key, [loaded_at_col]), lambda t, n: upsert(t, n, key, [loaded_at_col]), tag)
        if log is not None and target.current_version() > before:
            log.append({"batch_id": batch_id, "table": table, "rows": n, "version": target.current_version()})

    return (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


# P03 ----------------------------------------------------------------------
def streaming_freshness(spark: SparkSession, landing: str, table: str, watermark: str = "6 hours",
                        file_format: str = "parquet") -> DataFrame:
    """Freshness per tenant as a streaming aggregate: lag between the source
    update time and the load time, per 3-hour load window, with a watermark on
    ``_loaded_at`` so state for closed windows is dropped."""
    st = schema(table)
    s = spark.readStream.schema(st).format(file_format).load(landing)
    s = s.withColumn("_lt", c("_loaded_at").cast("timestamp")).withWatermark("_lt", watermark)
    lag = (F.unix_timestamp(c("_loaded_at").cast("timestamp")) - F.unix_timestamp(c("_source_updated_at").cast("timestamp"))) / 60
    return (s.groupBy(F.window("_lt", "3 hours").alias("w"), "hospital_id")
            .agg(F.max("_loaded_at").alias("last_load_timestamp"),
                 F.max("_source_updated_at").alias("last_source_update_timestamp"),
                 F.max(lag).alias("max_freshness_lag_minutes")))


def run_streaming_freshness(spark: SparkSession, landing: str, table: str, out: str, checkpoint: str, watermark: str = "6 hours") -> None:
    """One scheduled run of ``streaming_freshness``: files that arrived since the
    last run are read, load windows that the watermark has passed are added to
    ``out`` once (file sink), and the run ends."""
    fresh = streaming_freshness(spark, landing, table, watermark)
    (fresh.select(c("w.start").cast("timestamp_ntz").alias("window_start"), "hospital_id", "last_load_timestamp",
                  "last_source_update_timestamp", c("max_freshness_lag_minutes").cast("bigint").alias("max_freshness_lag_minutes"))
     .writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def freshness_per_tenant(df: DataFrame) -> DataFrame:
    """Batch form of P03 (same columns as the SLA mart's freshness rows)."""
    from ..functions.core import boundary_diff
    return (df.groupBy("hospital_id").agg(F.max("_loaded_at").alias("last_load_timestamp"),
                                          F.max("_source_updated_at").alias("last_source_update_timestamp"))
            .withColumn("freshness_lag_minutes",
                        boundary_diff("minute", "last_source_update_timestamp", "last_load_timestamp")))
