"""Score issues arriving as Parquet files with a fitted feature pipeline and models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import encode
from ..operators.linear import assemble
from ..sources.issues import ISSUE_SCHEMA


def scored_stream(spark: SparkSession, source_dir: str, features_model: PipelineModel, models: Mapping[str, object],
                  max_files: int = 100) -> DataFrame:
    """Streaming DataFrame: open issues from ``source_dir`` (declared schema, bounded
    files per micro-batch) with one prediction column per model plus minutes."""
    raw = spark.readStream.schema(ISSUE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(source_dir)
    open_rows = raw.where(F.col("resolutiondate").isNull() | F.col("created").isNull())
    enc = encode.encode(features_model, open_rows)
    df = assemble(enc, encode.encoded_feature_names(features_model))
    cols = ["key"]
    for name, m in models.items():
        df = m.copy({m.predictionCol: f"pred_{name}"}).transform(df)
        cols.append(f"pred_{name}")
    out = df.select(*cols)
    return out.withColumns({f"minutes_{n}": F.exp(f"pred_{n}") for n in models})


def score_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                 features_model: PipelineModel, models: Mapping[str, object], available_now: bool = False,
                 trigger_seconds: int = 60) -> StreamingQuery:
    """Start the scoring query writing Parquet to ``sink_dir``; the checkpoint (offsets,
    commits) lives in ``checkpoint_dir`` on shared storage so a restarted driver resumes
    where it stopped. Stateless, so no watermark is needed."""
    w = (scored_stream(spark, source_dir, features_model, models).writeStream.format("parquet")
         .option("path", sink_dir).option("checkpointLocation", checkpoint_dir).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()


def feature_names(features_model: PipelineModel) -> Sequence[str]:
    return encode.encoded_feature_names(features_model)
