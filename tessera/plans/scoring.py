"""Scoring of raw campaign records (T7, ST1): the feature steps are stages of the persisted pipeline.

The pipeline takes the records as they arrive.  Its stages rebuild the engineered columns (P10-P12), divide
the numeric ones by the training rows' population deviation (M4), index and encode the categories (M3), assemble
the vector (M6) and score it.  Every stage is one that Spark ML saves and loads itself, so a batch and a
streaming job load the same folder and need nothing but the records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.hashing import np_round
from tessera.operators import features as fe
from tessera.operators import ml
from tessera.session import checkpoint
from tessera.sources import fixtures as fx
from tessera.sources import io
from tessera.streaming import jobs


def engineer_stage() -> SQLTransformer:
    """P10-P12 as SQL: the bucket of pdays, the contact flag and the campaign intensity."""
    cases = " ".join(f"WHEN pdays > {lo!r}D AND pdays <= {hi!r}D THEN '{name}'"
                     for lo, hi, name in zip(map(float, fe.PDAYS_BINS), map(float, fe.PDAYS_BINS[1:]), fe.PDAYS_LABELS))
    return SQLTransformer(statement=f"SELECT *, CASE {cases} END AS pdays_bucket, CAST(previous > 0 AS INT) AS contact_last, "
                                    "try_divide(CAST(campaign AS DOUBLE), CAST(1 + previous AS DOUBLE)) AS campaign_intensity FROM __THIS__")


def scale_stage(train: DataFrame, nums: Sequence[str]) -> SQLTransformer:
    """M4 with the deviations of ``train`` (one row) written into the stage."""
    stats = fe.scale_std_fit(train.withColumns({c: F.col(c).cast("double") for c in nums}), nums).first()
    scaled = ", ".join(f"CAST({c} AS DOUBLE) / {float(stats[f'{c}__scale'] or 1.0)!r}D AS {c}__scaled" for c in nums)
    return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


def raw_pipeline(train: DataFrame, last: Estimator | Transformer, cats: Sequence[str] = ml.CAT_COLS, nums: Sequence[str] = ml.NUM_COLS) -> PipelineModel:
    """The pipeline fitted on raw training records, with ``last`` as its scoring stage."""
    first = engineer_stage()
    stages = [first, scale_stage(first.transform(train), nums), *ml.feature_pipeline(cats, [f"{c}__scaled" for c in nums]).getStages(), last]
    return Pipeline(stages=stages).fit(train)


def fixed_linear(weights: dict[str, float], steps: dict[str, float], sizes: dict[str, int], intercept: float) -> SQLTransformer:
    """A linear scorer with given coefficients: ``weights`` of the scaled columns; the j-th known category of a
    column (from 1) weighs j times its step, an unseen one nothing."""
    parts = [f"{w!r}D * {c}__scaled" for c, w in weights.items()]
    parts += [f"CASE WHEN {c}__idx < {sizes[c]} THEN {s!r}D * ({c}__idx + 1) ELSE 0D END" for c, s in steps.items()]
    return SQLTransformer(statement=f"SELECT *, 1D / (1D + exp(-({intercept!r}D + {' + '.join(parts)}))) AS score FROM __THIS__")


def scored(df: DataFrame, model: Model) -> DataFrame:
    """row_id and score, of a batch or a stream."""
    out = model.transform(df)
    score = F.col("score") if "score" in out.columns else vector_to_array("probability")[1]
    return out.select("row_id", np_round(score, 6).alias("score"))


def score_batch(spark: SparkSession, records: str, model: str) -> DataFrame:
    """A folder of raw records through a saved pipeline."""
    return scored(spark.read.parquet(records), io.load_model(model))


def score_arriving(spark: SparkSession, records: str, schema, model: str) -> DataFrame:
    """ST1: the same records as a stream, through the same saved pipeline."""
    return jobs.transform_stream(spark, records, schema, lambda s: scored(s, io.load_model(model)), "raw-scores")


# The fixed coefficients of the registered queries (not the reference's).
WEIGHTS = {c: round(0.1 * (i + 1) * (-1) ** i, 1) for i, c in enumerate(ml.NUM_COLS)}
STEPS = {c: round(0.05 * (i + 1) * (-1) ** i, 2) for i, c in enumerate(ml.CAT_COLS)}
INTERCEPT = -0.25


def raw_records(spark: SparkSession, d: str) -> DataFrame:
    """The campaign records without the target's leak (P2), split into train, val and test."""
    c = fx.campaign(spark, d).drop("duration")
    return checkpoint(fe.split_stratified(c, "y", "row_id", 0.2, 0.2, 42))


def saved_fixed_pipeline(spark: SparkSession, d: str) -> tuple[str, str, object]:
    """(folder of raw records to score, folder of the saved pipeline, schema of the records)."""
    c = raw_records(spark, d)
    train = c.where("split = 'train'")
    engineered = engineer_stage().transform(train)
    counts = engineered.agg(*[F.count_distinct(x).alias(x) for x in ml.CAT_COLS]).first()  # one row
    model = raw_pipeline(train, fixed_linear(WEIGHTS, STEPS, counts.asDict(), INTERCEPT))
    landing, folder = jobs.scratch(spark, "raw-records"), jobs.scratch(spark, "raw-model")
    records = c.where("split <> 'train'").drop("split", "y")
    records.write.parquet(landing)
    io.save_model(model, folder)
    return landing, folder, records.schema


def batch_scores(spark: SparkSession, d: str) -> DataFrame:
    landing, folder, _ = saved_fixed_pipeline(spark, d)
    return score_batch(spark, landing, folder)


def stream_scores(spark: SparkSession, d: str) -> DataFrame:
    landing, folder, schema = saved_fixed_pipeline(spark, d)
    return score_arriving(spark, landing, schema, folder)
