"""Scoring a stream of loads with a fitted model (Structured Streaming).

Every preprocessing stage and the regressor are stateless per row (static
lookups, ``PipelineModel.transform``), so the batch ``predict`` applies
unchanged to a streaming DataFrame. The sink is an append-only parquet folder
with its own checkpoint; ``availableNow`` processes what has arrived and stops,
and a restart resumes from the checkpoint (exactly-once file sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loadlab.operators.models import FittedModel
from loadlab.sources.files import LOADS_SCHEMA


def read_load_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet file stream of loads with the fixed schema (no inference on a stream)."""
    reader = spark.readStream.schema(LOADS_SCHEMA).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def score_stream(model: FittedModel, stream: DataFrame, sink_dir: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """Start the scoring query: ``(load_id, predicted)`` appended to ``sink_dir``."""
    scored = model.predict(stream).select("load_id", model_output_column())
    writer = (scored.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def model_output_column() -> str:
    return "predicted"
