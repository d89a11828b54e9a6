"""Alert history, notifications and outbox tables fed by a stream of anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from signwatch.lineage import cut
from signwatch.operators import alerts


def start(
    anomalies: DataFrame, path: str, checkpoint: str, available_now: bool = False, minutes: int = 60
) -> StreamingQuery:
    """Write each micro-batch to ``history``, ``log``, ``notifications`` and one ``outbox`` table per channel.

    Thresholds count the batch's alerts together with ``pending`` ones, which wait since earlier batches, along the alerts'
    own times: batches in time order fire what one replay of all alerts fires. Output folders carry the batch number, so
    a batch repeated after a failure replaces its own files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        part = f"batch={batch_id}"
        spark = batch.sparkSession
        # written once; everything else reads it from there
        alerts.from_anomalies(batch, alerts.finding_id("event_id", "anomaly_type")).write.mode("overwrite").parquet(
            f"{path}/history/{part}"
        )
        rows = spark.read.parquet(f"{path}/history/{part}")
        rows.select(alerts.log_line().alias("value")).write.mode("overwrite").text(f"{path}/log/{part}")
        if batch_id:
            rows = rows.unionByName(spark.read.parquet(f"{path}/pending/batch={batch_id - 1}"))
        told = cut(alerts.moving_notifications(rows, minutes))
        told.where("n IS NOT NULL").select(*rows.columns).write.mode("overwrite").parquet(f"{path}/notifications/{part}")
        fired = spark.read.parquet(f"{path}/notifications/{part}")
        for channel in alerts.CHANNELS:
            alerts.outbox(fired, [channel]).write.mode("overwrite").parquet(f"{path}/outbox/{channel}/{part}")
        told.where("n IS NULL").select(*rows.columns).write.mode("overwrite").parquet(f"{path}/pending/{part}")

    writer = anomalies.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
