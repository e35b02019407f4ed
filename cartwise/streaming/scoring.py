"""Scoring requests as they arrive (the REST scorer re-aimed to a stream).

Request files (Parquet or JSON, 19 feature columns plus an optional
``request_id``) land in a folder; a Structured Streaming query validates every
micro-batch with the serving rules and writes scored and rejected rows to two
sink folders. The query's checkpoint makes it restartable, and each micro-batch
overwrites its own output folder, so a replayed batch leaves no duplicates; the scorer itself is the batch code of :mod:`cartwise.operators.scoring`.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartwise.operators import scoring as SC
from cartwise.sources.schemas import MODEL_FEATURES

REQUEST_SCHEMA = T.StructType(
    [T.StructField("request_id", T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in MODEL_FEATURES])


def request_stream(spark: SparkSession, folder: str, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(REQUEST_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder)


def start_scoring(spark: SparkSession, model: PipelineModel, source: str, scored_sink: str,
                  rejected_sink: str, checkpoint: str, fmt: str = "parquet",
                  available_now: bool = False, processing_time: str | None = None,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; each micro-batch is validated, scored and appended.
    ``max_files_per_trigger`` bounds a micro-batch when a backlog has built up."""

    def score_batch(batch: DataFrame, epoch_id: int) -> None:
        # the batch feeds two sinks: read the request files once
        batch = batch.persist()
        try:
            # one folder per micro-batch, overwritten on replay: a batch re-run
            # after a failure replaces its own output instead of duplicating it
            ok, bad = SC.split_requests(batch)
            SC.score(model, ok).write.mode("overwrite").parquet(f"{scored_sink}/batch_id={epoch_id}")
            bad.write.mode("overwrite").parquet(f"{rejected_sink}/batch_id={epoch_id}")
        finally:
            batch.unpersist()

    w = (request_stream(spark, source, fmt, max_files_per_trigger).writeStream
         .foreachBatch(score_batch).option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
