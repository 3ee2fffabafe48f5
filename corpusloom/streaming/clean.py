"""The cleaning stage on a stream: it keeps no state, so the same projection runs on every micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators.comments import Config, kept, tag


def clean(stream: DataFrame, bots: DataFrame | None = None, config: Config = Config()) -> DataFrame:  # noqa: B008
    """Kept comments of a stream of comments."""
    return kept(tag(stream, bots, config))


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append all there is to the Parquet folder ``out``; run again, it goes on where it stopped."""
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def read_stream(spark: SparkSession, path: str, schema, form: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format(form).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
