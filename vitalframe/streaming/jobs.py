"""Structured Streaming jobs over incoming conversation files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitalframe.operators.conversation import extract_metrics, grade_metric, searchable, triage_message
from vitalframe.sources.tables import append_new

KEYS = ("conversation_id", "user_id", "message_timestamp")
# What makes two readings the same one, however late the second arrives.
READING = ("conversation_id", "message_timestamp", "metric_type", "metric_value")


def file_stream(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet", files: int = 100) -> DataFrame:
    """New parquet files of a folder, a bounded number per trigger."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files)
        .parquet(folder)
    )


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def stream_searchable(source: DataFrame, out: str, checkpoint: str, every: str | None = "1 minute") -> StreamingQuery:
    """Keep the searchable conversation table fresh.  ``every=None`` drains what is there and stops."""
    writer = searchable(source).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return _trigger(writer.outputMode("append"), every).start(out)


def triaged(source: DataFrame) -> DataFrame:
    """Stateless triage per message."""
    return triage_message(source, "user_message").select(
        "conversation_id", "user_id", "message_timestamp", "is_emergency", "local_urgency", "detected_symptoms"
    )


def stream_triage(source: DataFrame, out: str, checkpoint: str, every: str | None = "1 minute") -> StreamingQuery:
    writer = triaged(source).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return _trigger(writer.outputMode("append"), every).start(out)


def readings(source: DataFrame) -> DataFrame:
    """Graded readings of each message, however late it is."""
    timed = source.withColumn("message_timestamp", F.col("message_timestamp").cast("timestamp"))
    found = extract_metrics(timed, ["user_message", "assistant_response"], list(KEYS), "routed_to_domain")
    return grade_metric(found)


def stream_metrics(source: DataFrame, out: str, checkpoint: str, every: str | None = "1 minute") -> StreamingQuery:
    """Append the readings that the table at ``out`` lacks, partitioned by date and key bucket.

    A batch reads only the dates and buckets of its own readings, so its cost does not grow with the
    table. A file that is delivered twice, and a batch that is retried, add nothing.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        append_new(batch.withColumn("measurement_date", F.to_date("message_timestamp")), out, READING, "measurement_date")

    writer = readings(source).writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()
