"""Resuming work as a stream: every key is handled once, however often it arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import rows
from ..session import Scratch


def stream_parquet(spark: SparkSession, folder: str, glob: str, schema: T.StructType, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


#: Parts of the output by key hash; a micro-batch reads those that its keys fall into.
PARTS = 256


def append_new_keys(stream: DataFrame, key: str, order: list[str], out: str, checkpoint: str) -> None:
    """Append the first row by ``order`` of each key of a micro-batch that the output lacks; run until the input is used up.

    A repeated batch after a failure writes nothing twice, because its keys are done.  The
    output is partitioned by the key's hash, so what a batch reads of it does not grow
    faster than its own keys' parts do.
    """
    columns = stream.columns
    schema = T.StructType([*stream.schema.fields, T.StructField("__part", T.IntegerType())])

    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        first = rows.first_rows(df, key, order, [c for c in columns if c != key]).select(*columns)
        first = first.withColumn("__part", F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int"))
        touched = [r[0] for r in first.select("__part").distinct().collect()]
        done = spark.read.schema(schema).parquet(out).where(F.col("__part").isin(touched)).select(key)
        first.join(done, key, "left_anti").select(*columns, "__part").write.mode("append").partitionBy("__part").parquet(out)

    stream.sparkSession.createDataFrame([], schema).write.mode("append").partitionBy("__part").parquet(out)
    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def stream_resume(spark: SparkSession, d: str) -> DataFrame:
    """Events through the resuming stream: one row per event."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    place = Scratch(spark, "stream").root
    append_new_keys(stream_parquet(spark, d, "events.parquet", schema), "event_id", ["ts"], f"{place}/out", f"{place}/state")
    return spark.read.schema(schema).parquet(f"{place}/out").select("event_id", "user_id", "event_type", F.round("value", 6).alias("value"))


def windowed_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events counted in hours of event time; the watermark lets the state of closed hours go.

    Every micro-batch appends the hours that it changed; the last count of an hour stands.
    """
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    place = Scratch(spark, "windows").root
    events = stream_parquet(spark, d, "events.parquet", schema).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = events.withWatermark("ts", "1 hour").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))

    def batch(df: DataFrame, number: int) -> None:
        df.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "event_type", "n", F.lit(number).alias("batch")).write.mode("append").parquet(f"{place}/out")

    q = counts.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{place}/out").groupBy("hour", "event_type").agg(F.max_by("n", "batch").alias("n"))


QUERIES = {"stream_resume": stream_resume, "stream_windows": windowed_counts}
ORACLES = {
    "stream_resume": "select event_id, user_id, event_type, round(value, 6) \"value\" from (select *, row_number() over (partition by event_id order by ts) rn from events) where rn = 1",
    "stream_windows": "select date_trunc('hour', ts) \"hour\", event_type, count(*) n from events group by all",
}
