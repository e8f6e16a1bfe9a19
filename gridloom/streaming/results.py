"""Result rows that arrive over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.functions.text import candidate_issue


def deduplicated(rows: DataFrame, key: str = "row_id", at: str = "loaded_at", delay: str = "2 hours") -> DataFrame:
    """Each key once within the delay; state older than the watermark is dropped."""
    return rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def gate_counts(rows: DataFrame, text: str = "ground_truth", at: str = "loaded_at", window: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Rows and failed gates by window of arrival; null times are left out by the watermark."""
    timed = rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
    failed = F.count_if(candidate_issue(text).isNotNull())
    return timed.groupBy(F.window(at, window)).agg(F.count("*").alias("n_rows"), failed.alias("n_failed")).select("window.start", "window.end", "n_rows", "n_failed")


def resume_into(rows: DataFrame, table_path: str, checkpoint: str, key: str = "row_id") -> StreamingQuery:
    """Append rows whose key the table does not hold yet, batch by batch; a repeated batch adds nothing."""
    spark = rows.sparkSession

    def append(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates([key])
        try:
            held = spark.read.parquet(table_path).select(key)
        except Exception:  # noqa: BLE001 - no table yet
            held = None
        if held is not None:
            fresh = fresh.join(held, key, "left_anti")
        fresh.write.mode("append").parquet(table_path)

    return rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
