"""Score texts as they arrive (Structured Streaming).

Scoring is one projection over the stream: cleaning, the lemma lookup in the
model's broadcast lexicon, and the model's stages. There is no state, so no
watermark, and the file sink commits each micro-batch once. A model whose
lexicon no worker should hold, or whose terms are a table, needs joins and a regroup by row; its batches go
through the batch plan and are written as ``batch_id=<n>`` with overwrite, so
that a retried batch replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_texts(spark: SparkSession, source: str, schema: T.StructType, fmt: str = "parquet",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """The stream of files landing in ``source``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source)


def score_stream(spark: SparkSession, model, source: str, schema: T.StructType, out: str,
                 checkpoint: str, fmt: str = "parquet", available_now: bool = True,
                 processing_time: str = "10 seconds", max_files_per_trigger: int | None = None
                 ) -> StreamingQuery:
    """Start scoring files landing in ``source`` with a fitted ``TextModel`` or ``ShardedModel``."""
    stream = read_texts(spark, source, schema, fmt, max_files_per_trigger)

    def score(batch: DataFrame, batch_id: int) -> None:
        (model.score_rows(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}"))

    if model.streams:
        w = model.score_rows(stream).writeStream.format("parquet").option("path", out)
    else:
        w = stream.writeStream.foreachBatch(score)
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def scored(spark: SparkSession, out: str) -> DataFrame:
    """All rows scored so far."""
    return spark.read.parquet(out)
