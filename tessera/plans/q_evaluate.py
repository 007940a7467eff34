"""Registered evaluation queries (scores F6, predictions F7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import np_round, np_round_sql
from tessera.operators import evaluate as ev
from tessera.operators import timeseries as ts
from tessera.plans import daily
from tessera.plans.q_timeseries import qq_sql
from tessera.plans.registry import register
from tessera.sources import fixtures as fx


def _round(df, digits=6):
    cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: np_round(c, digits) for c in cols})


R = np_round_sql
WS = "WITH " + fx.SCORES_SQL + ",\n"
ST = WS + """st AS (SELECT score AS threshold, CAST(sum(CAST(label = 1 AS BIGINT)) AS BIGINT) AS pos,
                  CAST(sum(CAST(label <> 1 AS BIGINT)) AS BIGINT) AS neg FROM scores GROUP BY score),
c AS (SELECT *, CAST(sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp,
             CAST(sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp,
             CAST(sum(pos) OVER () AS BIGINT) AS n_pos, CAST(sum(neg) OVER () AS BIGINT) AS n_neg, count(*) OVER () AS n_scores,
             CAST(count(*) OVER (ORDER BY threshold ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS point
      FROM st),
pp AS (SELECT *, tp / (tp + fp) AS prec, tp / n_pos AS rec,
              CASE WHEN (tp - pos) + (fp - neg) = 0 THEN 1.0::DOUBLE ELSE (tp - pos) / ((tp - pos) + (fp - neg)) END AS p_next,
              (tp - pos) / n_pos AS r_next FROM c)
"""

register("f06_scores", WS.rstrip(",\n") + "\nSELECT * FROM scores")(lambda s, d: fx.scores(s, d))


@register("e01_predict_at", WS + "x AS (SELECT 1) SELECT row_id, label, score, CAST(score >= 0.5 AS INT) AS pred FROM scores")
def e01(spark, d):
    return ev.predict_at(fx.scores(spark, d), 0.5)


@register("e02_classification_metrics", WS + f"""m AS (SELECT
  count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp, count(*) FILTER (WHERE score >= 0.5 AND label <> 1) AS fp,
  count(*) FILTER (WHERE score < 0.5 AND label <> 1) AS tn, count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn FROM scores)
SELECT tp, fp, tn, fn, {R('COALESCE(tp / NULLIF(tp + fp, 0), 0)', 6)} AS precision,
  {R('COALESCE(tp / NULLIF(tp + fn, 0), 0)', 6)} AS recall, {R('COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0)', 6)} AS f1,
  {R('COALESCE((tp + tn) / NULLIF(tp + fp + tn + fn, 0), 0)', 6)} AS accuracy FROM m""")
def e02(spark, d):
    return _round(ev.classification_metrics(fx.scores(spark, d), 0.5))


@register("e03_pr_curve", ST + f"""SELECT point, threshold, tp, fp, {R('prec', 6)} AS precision, {R('rec', 6)} AS recall FROM pp
UNION ALL SELECT CAST(max(n_scores) AS BIGINT), NULL, 0, 0, 1.0, 0.0 FROM c""")
def e03(spark, d):
    return _round(ev.pr_curve(fx.scores(spark, d)))


@register("e04_roc_curve", ST + f"""SELECT point, threshold, {R('fp / n_neg', 6)} AS fpr, {R('tp / n_pos', 6)} AS tpr FROM c
UNION ALL SELECT CAST(max(n_scores) AS BIGINT), NULL, 0.0, 0.0 FROM c""")
def e04(spark, d):
    return _round(ev.roc_curve(fx.scores(spark, d)))


@register("e05_roc_auc", ST + f"SELECT {R('sum(pos * ((n_neg - fp) + neg * 0.5)) / (any_value(n_pos) * any_value(n_neg))', 8)} AS auc FROM c")
def e05(spark, d):
    return _round(ev.roc_auc(fx.scores(spark, d)), 8)


@register("e06_pr_auc", ST + f"SELECT {R('sum(abs(rec - r_next) * (prec + p_next) / 2)', 8)} AS pr_auc FROM pp")
def e06(spark, d):
    return _round(ev.pr_auc(fx.scores(spark, d)), 8)


@register("e07_best_f1_threshold", ST + f""", f AS (SELECT threshold, point, 2 * prec * rec / (prec + rec + 1e-9::DOUBLE) AS f1 FROM pp),
b AS (SELECT threshold AS s, f1 FROM f ORDER BY f1 DESC, point ASC LIMIT 1)
SELECT {R('greatest(0.0, least(1.0, COALESCE((SELECT max(threshold) FROM f, b WHERE threshold < b.s), 0.5)))', 8)} AS threshold,
       {R('greatest((SELECT f1 FROM b), 0.0)', 8)} AS best_f1,
       {R('(SELECT sum(abs(rec - r_next) * (prec + p_next) / 2) FROM pp)', 8)} AS pr_auc""")
def e07(spark, d):
    return _round(ev.best_f1_threshold(fx.scores(spark, d)), 8)


# ------------------------------------------------------------- forecasts F7
def predictions(spark, d):
    """actual daily load and four simple predictors as a long table."""
    e = ts.as_series(daily.energy_daily(spark, d), "time", daily.TARGET, "ds", "actual")
    x = ts.add_lags(e, "actual", [1, 7], "ds")
    x = ts.add_rolling(x, "actual", [30], "ds", std=False)
    g = e.agg(F.avg("actual").alias("global"))
    x = x.crossJoin(F.broadcast(g))  # one row
    x = x.select("ds", "actual", F.col("actual_lag_1").alias("lag1"), F.col("actual_lag_7").alias("lag7"),
                 F.col("actual_rolling_mean_30").alias("mean30"), "global")
    return x.unpivot(["ds", "actual"], ["lag1", "lag7", "mean30", "global"], "model", "pred").dropna(subset=["pred"])


PRED_SQL = "WITH " + daily.ENERGY_SQL + """,
e AS (SELECT "time" AS ds, total_load_actual AS actual FROM energy),
w AS (SELECT ds, actual, lag(actual, 1) OVER (ORDER BY ds) AS lag1, lag(actual, 7) OVER (ORDER BY ds) AS lag7,
  CASE WHEN count(actual) OVER (ORDER BY ds ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) = 30
       THEN avg(actual) OVER (ORDER BY ds ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) END AS mean30,
  (SELECT avg(actual) FROM e) AS global FROM e),
preds AS (SELECT * FROM (UNPIVOT w ON lag1, lag7, mean30, global INTO NAME model VALUE pred) WHERE pred IS NOT NULL),
"""

MET_SQL = PRED_SQL + """met AS (SELECT model, avg(abs(actual - pred)) AS MAE, sqrt(avg((actual - pred) * (actual - pred))) AS RMSE,
  avg(abs((actual - pred) / CASE WHEN actual <> 0 THEN actual ELSE 1.0::DOUBLE END)) * 100 AS MAPE,
  1.0::DOUBLE - sum((actual - pred) * (actual - pred)) / (var_pop(actual) * count(*)) AS R2, count(*) AS n
  FROM preds WHERE NOT isnan(actual) AND NOT isnan(pred) AND abs(actual) < 'inf'::DOUBLE AND abs(pred) < 'inf'::DOUBLE
  GROUP BY model)
"""


@register("j08_align_predictions", PRED_SQL + f"x AS (SELECT 1) SELECT ds, {R('actual', 4)} AS actual, model, {R('pred', 4)} AS pred FROM preds")
def j08(spark, d):
    p = predictions(spark, d)
    return _round(ev.align(p.select("ds", "actual").distinct(), p.drop("actual"), "ds"), 4)


@register("e08_forecast_metrics", MET_SQL + f"SELECT model, {R('MAE', 4)} AS MAE, {R('RMSE', 4)} AS RMSE, {R('MAPE', 4)} AS MAPE, {R('R2', 6)} AS R2, n FROM met")
def e08(spark, d):
    m = ev.forecast_metrics(predictions(spark, d))
    return m.withColumns({"MAE": np_round("MAE", 4), "RMSE": np_round("RMSE", 4), "MAPE": np_round("MAPE", 4),
                          "R2": np_round("R2", 6)})


def _rank_sql(c, desc=False):
    o = "DESC" if desc else "ASC"
    return (f"CAST(rank() OVER (ORDER BY {c} {o}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS DOUBLE) AS {c}_Rank")


RANK_SQL = MET_SQL + f""", r AS (SELECT model, {R('MAE', 2)} AS MAE, {R('RMSE', 2)} AS RMSE, {R('MAPE', 2)} AS MAPE,
  {R('R2', 2)} AS R2, n FROM met),
rk AS (SELECT *, {_rank_sql('MAE')}, {_rank_sql('RMSE')}, {_rank_sql('MAPE')}, {_rank_sql('R2', True)} FROM r)
"""


@register("e09_rank_models", RANK_SQL + "SELECT *, (MAE_Rank + RMSE_Rank + MAPE_Rank + R2_Rank) / 4 AS Avg_Rank FROM rk")
def e09(spark, d):
    return ev.rank_models(ev.forecast_metrics(predictions(spark, d)))


@register("e10_residuals", PRED_SQL + f"x AS (SELECT 1) SELECT ds, model, {R('actual - pred', 4)} AS residual FROM preds")
def e10(spark, d):
    r = ev.residuals(predictions(spark, d))
    return r.select("ds", "model", np_round("residual", 4).alias("residual"))


@register("e11_metrics_long", MET_SQL + f"""SELECT * FROM (UNPIVOT (SELECT model, {R('MAE', 4)} AS MAE, {R('RMSE', 4)} AS RMSE,
  {R('MAPE', 4)} AS MAPE, {R('R2', 4)} AS R2 FROM met) ON MAE, RMSE, MAPE, R2 INTO NAME metric VALUE value)""")
def e11(spark, d):
    m = ev.forecast_metrics(predictions(spark, d)).drop("n")
    m = m.withColumns({c: np_round(c, 4) for c in ("MAE", "RMSE", "MAPE", "R2")})
    return ev.metrics_long(m)


@register("e10_residual_histogram", PRED_SQL + f"""r AS (SELECT model, actual - pred AS res FROM preds),
st AS (SELECT model, min(res) AS mn, max(res) AS mx FROM r GROUP BY 1),
c AS (SELECT r.model, CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((res - mn) / (mx - mn) * 20), 19) END AS INT) AS bin, count(*) AS n
  FROM r JOIN st ON r.model = st.model GROUP BY 1, 2),
sp AS (SELECT model, CAST(range AS INT) AS bin, mn, mx FROM st, range(0, 20))
SELECT sp.model, sp.bin, {R('mn + (mx - mn) * sp.bin / 20', 4)} AS lo, {R('mn + (mx - mn) * (sp.bin + 1) / 20', 4)} AS hi,
  CAST(COALESCE(n, 0) AS BIGINT) AS n FROM sp LEFT JOIN c ON sp.model = c.model AND sp.bin = c.bin""")
def e10h(spark, d):
    from tessera.operators import profile as pr
    r = ev.residuals(predictions(spark, d))
    return _round(pr.histogram(r, "residual", 20, by=["model"]), 4)


@register("e10_ranges", PRED_SQL + f"""x AS (SELECT 1) SELECT model, {R('min(actual)', 4)} AS actual_min, {R('max(actual)', 4)} AS actual_max,
  {R('min(pred)', 4)} AS pred_min, {R('max(pred)', 4)} AS pred_max, count(*) AS n FROM preds GROUP BY model""")
def e10r(spark, d):
    return _round(ev.ranges(predictions(spark, d)), 4)


@register("e10_residual_qq", PRED_SQL + f"""s AS (SELECT model, ds, actual - pred AS sample, row_number() OVER (PARTITION BY model ORDER BY actual - pred, ds) AS i,
  count(*) OVER (PARTITION BY model) AS n FROM preds),
{qq_sql('s')} SELECT model, CAST(i AS BIGINT) AS i, {R('sample', 4)} AS residual, theoretical FROM points""")
def e10q(spark, d):
    """Residuals of every model against normal quantiles."""
    from tessera.operators import profile as pr
    q = pr.qq_points(ev.residuals(predictions(spark, d)), "residual", "ds", by=["model"])
    return q.select("model", "i", np_round("sample", 4).alias("residual"), np_round("theoretical", 6).alias("theoretical"))


@register("e10_residual_qq_line", PRED_SQL + f"""s AS (SELECT model, ds, actual - pred AS sample, row_number() OVER (PARTITION BY model ORDER BY actual - pred, ds) AS i,
  count(*) OVER (PARTITION BY model) AS n FROM preds),
{qq_sql('s')} SELECT model, {R('regr_slope(sample, theoretical)', 2)} AS slope, {R('regr_intercept(sample, theoretical)', 2)} AS intercept,
  {R('corr(sample, theoretical)', 5)} AS r, count(*) AS n FROM points GROUP BY model""")
def e10l(spark, d):
    from tessera.operators import profile as pr
    q = pr.qq_points(ev.residuals(predictions(spark, d)), "residual", "ds", by=["model"]).withColumn("theoretical", np_round("theoretical", 6))
    x = pr.qq_line(q, ["model"])
    return x.select("model", np_round("slope", 2).alias("slope"), np_round("intercept", 2).alias("intercept"), np_round("r", 5).alias("r"), "n")
