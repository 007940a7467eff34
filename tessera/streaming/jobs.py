"""Structured Streaming jobs.

The jobs read a file source with ``trigger(availableNow=True)`` (no port is
opened), keep their progress in a checkpoint location under the cluster's
shared checkpoint folder, and write to a parquet sink there, so a restarted
driver or a lost executor resumes from the committed offsets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.hashing import np_round
from tessera.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _run_to_parquet(stream_df: DataFrame, out: str, mode: str = "append") -> None:
    q = (stream_df.writeStream.format("parquet").option("path", f"{out}/data")
         .option("checkpointLocation", f"{out}/_checkpoint").outputMode(mode)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def daily_rollup_stream(spark: SparkSession, source: str, schema, ts: str = "ts", col: str = "value",
                        lateness: str = "1 day", glob: str | None = None) -> DataFrame:
    """ST2: daily mean (half-even rounded, as A1) and count of arriving
    readings; rows later than the watermark are dropped, a day is emitted once
    the watermark passes its end (append mode)."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    s = r.parquet(source)
    s = s.withColumn(ts, F.col(ts).cast("timestamp"))  # a watermark needs TIMESTAMP (not NTZ)
    agg = (s.withWatermark(ts, lateness).groupBy(F.window(ts, "1 day"))
           .agg(F.avg(col).alias("__m"), F.count(F.lit(1)).alias("n")))
    out_stream = agg.select(F.to_date(F.col("window.start")).alias("day"), np_round("__m", 0).alias(col), "n")
    out = scratch(spark, "rollup")
    _run_to_parquet(out_stream, out)
    return spark.read.parquet(f"{out}/data")


def score_stream(spark: SparkSession, source: str, schema, model, out_cols=("row_id",)) -> DataFrame:
    """ST1: score records as they arrive with a fitted pipeline / model
    (same transform as batch scoring T7)."""
    from pyspark.ml.functions import vector_to_array
    return transform_stream(spark, source, schema, lambda s: model.transform(s).select(
        *out_cols, vector_to_array("probability")[1].alias("score")), "scores")


def transform_stream(spark: SparkSession, source: str, schema, change, name: str) -> DataFrame:
    """The rows that ``change`` makes of files as they arrive in ``source``, row by row."""
    out = scratch(spark, name)
    _run_to_parquet(change(spark.readStream.schema(schema).parquet(source)), out)
    return spark.read.parquet(f"{out}/data")
