"""Registered streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import np_round_sql
from tessera.plans.registry import register
from tessera.streaming import jobs


@register("st02_daily_rollup_stream", f"""SELECT CAST(ts AS DATE) AS day, {np_round_sql('avg(value)', 0)} AS value, count(*) AS n
FROM events GROUP BY 1
HAVING CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def st02(spark, d):
    schema = spark.read.parquet(f"{d.rstrip('/')}/events.parquet").schema
    return jobs.daily_rollup_stream(spark, d, schema, "ts", "value", "1 day", glob="events.parquet")


def st01(spark, d):
    """Fit on the training rows, land the other rows as files, score them as a stream."""
    from tessera.operators import ml
    from tessera.plans import classify
    x = classify.model_data(spark, d)
    model = ml.train(x.filter(F.col("split") == "train"), "logreg")
    landing = jobs.scratch(spark, "landing")
    x.filter(F.col("split") != "train").select("row_id", "features").write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    return jobs.score_stream(spark, landing, schema, model)


register("st01_score_stream")(st01)
