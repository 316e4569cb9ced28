"""Stream sources and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

# --- fixed values: topics and checkpointing -----------------------------------
RAW_GPS_TOPIC = "raw.gps"
RAW_TRIPS_TOPIC = "raw.trips"
PROCESSED_GPS_TOPIC = "processed.gps"
TRIGGER_INTERVAL = "60 seconds"
KAFKA_PRODUCER = {
    "kafka.linger.ms": "10", "kafka.batch.size": "16384", "kafka.compression.type": "gzip"}


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a topic as text: key, value, topic, source partition, arrival (offset)."""
    stream = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", "latest").options(**options).load())
    return stream.select(
        F.col("key").cast("string"), F.col("value").cast("string"), "topic",
        F.col("partition").alias("source"), F.col("offset").alias("arrival"),
        F.col("timestamp").alias("received_at"))


def read_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    """Files that arrive in a folder, as a stream."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def as_messages(df: DataFrame, key: Column) -> DataFrame:
    """Rows as keyed JSON messages; the key keeps the order per vehicle or zone."""
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def to_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str, **options: str) -> DataStreamWriter:
    return (
        messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("topic", topic).options(**{**KAFKA_PRODUCER, **options})
        .option("checkpointLocation", checkpoint))


def to_console(df: DataFrame) -> DataStreamWriter:
    return df.writeStream.format("console").option("truncate", False)


def archive(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Raw messages (topic, received_at, value, ...) to Parquet by topic and day."""
    dated = messages.withColumn("date", F.to_date("received_at"))
    return (
        dated.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).partitionBy("topic", "date").outputMode("append"))


def to_files(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return (
        df.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).outputMode("append"))


def each_batch(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    """A batch that fails is run again with the same id, so ``handle`` must be safe to repeat."""
    return df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)


def start(writer: DataStreamWriter, interval: str = TRIGGER_INTERVAL):
    """Run continuously."""
    return writer.trigger(processingTime=interval).start()


def replay(events: DataFrame, time: str, slices: int, path: str, writer: Callable[[DataFrame], DataStreamWriter],
           *after: DataFrame) -> None:
    """Feed a table to a stream in ``slices`` equal spans of time, then ``after``; each arrives once the one before is done.

    ``writer`` makes the query from the stream of files in ``path``. Its checkpoint carries the state on. A slice is dealt
    out evenly to a file per core, since the file a table comes in may be one task's work, and the query would inherit that.
    """
    spark = events.sparkSession
    first, last = events.agg(F.min(time), F.max(time)).first()
    if first is None:
        return
    step = (last - first) / slices
    parts = [events.filter((F.col(time) >= F.lit(first + k * step)) & (
        F.col(time) < F.lit(first + (k + 1) * step) if k + 1 < slices else F.lit(True))) for k in range(slices)]
    spread = [part.repartition(spark.sparkContext.defaultParallelism) for part in parts]
    for part in [*spread, *after]:
        part.write.mode("append").parquet(path)
        drain(writer(read_files(spark, path, events.schema)))


def drain(writer: DataStreamWriter) -> None:
    """Process everything there is and stop; the way to replay history through the stream path."""
    writer.trigger(availableNow=True).start().awaitTermination()
