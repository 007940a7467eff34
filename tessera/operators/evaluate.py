"""Classifier and forecaster evaluation.

Curves are computed on the table of *distinct scores* with per-score positive
and negative counts (one aggregate, map-side combined).  Running counts over
that table use the two-level prefix sum (``ordering.prefix_sums``), so even a
table with one distinct score per row is scanned by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import np_round
from tessera.operators.ordering import prefix_sums

SCORE_BUCKETS = 1024


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def predict_at(df: DataFrame, t: float, score: str = "score", out: str = "pred") -> DataFrame:
    """P >= t."""
    return df.withColumn(out, (F.col(score) >= F.lit(t)).cast("int"))


def _safe(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def classification_metrics(df: DataFrame, t: float, label: str = "label", score: str = "score",
                           by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and precision / recall / F1 / accuracy at threshold
    ``t`` (0 when undefined)."""
    pred = F.col(score) >= F.lit(t)
    pos = F.col(label) == 1
    m = df.groupBy(*by).agg(
        F.sum((pred & pos).cast("long")).alias("tp"), F.sum((pred & ~pos).cast("long")).alias("fp"),
        F.sum((~pred & ~pos).cast("long")).alias("tn"), F.sum((~pred & pos).cast("long")).alias("fn"))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return m.select(*by, "tp", "fp", "tn", "fn",
                    _safe(tp, tp + fp).alias("precision"), _safe(tp, tp + fn).alias("recall"),
                    _safe(2 * tp, 2 * tp + fp + fn).alias("f1"),
                    _safe(tp + tn, tp + fp + tn + fn).alias("accuracy"))


def score_counts(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Distinct scores with positive/negative counts, plus running counts of
    rows scoring >= s (``tp``, ``fp``), the distinct-score position in
    ascending order (``point``) and the class totals ``n_pos``, ``n_neg`` and ``n_scores``."""
    by = list(by)
    st = df.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"),
        F.sum((F.col(label) != 1).cast("long")).alias("neg")).withColumn("one", F.lit(1).cast("long"))
    # descending order, bucket non-decreasing along it
    bucket = -F.least(F.greatest(F.floor(F.col("threshold") * SCORE_BUCKETS), F.lit(-1)), F.lit(SCORE_BUCKETS))
    x = prefix_sums(st, [F.col("threshold").desc()], ["pos", "neg", "one"], bucket, by=by)
    x = x.withColumnsRenamed({"pos_cum": "tp", "neg_cum": "fp"})
    tot = st.groupBy(*by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.count(F.lit(1)).alias("n_scores"))
    x = x.join(tot, on=by, how="inner") if by else x.crossJoin(F.broadcast(tot))
    return x.withColumn("point", (F.col("n_scores") - F.col("one_cum")).cast("bigint")).drop("one", "one_cum")


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score (ascending ``point``) plus the final (recall 0, precision 1)."""
    x = score_counts(df, label, score)
    pts = x.select("point", "threshold", "tp", "fp",
                   (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                   (F.col("tp") / F.col("n_pos")).alias("recall"))
    final = x.groupBy().agg(F.max("n_scores").alias("point")).select(
        F.col("point").cast("bigint"), F.lit(None).cast("double").alias("threshold"),
        F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(final)


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(fpr, tpr) per distinct score plus the (0, 0) start at +inf."""
    x = score_counts(df, label, score)
    pts = x.select("point", "threshold", (F.col("fp") / F.col("n_neg")).alias("fpr"), (F.col("tp") / F.col("n_pos")).alias("tpr"))
    start = x.groupBy().agg(F.max("n_scores").alias("point")).select(
        F.col("point").cast("bigint"), F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """E5: ROC-AUC with ties (Mann-Whitney): sum over distinct scores of
    pos_s * (negatives below s + neg_s / 2) / (P * N)."""
    by = list(by)
    x = score_counts(df, label, score, by)
    term = F.col("pos") * ((F.col("n_neg") - F.col("fp")) + F.col("neg") * 0.5)
    return x.groupBy(*by).agg((F.sum(term) / (F.first("n_pos") * F.first("n_neg"))).alias("auc"))


def _pr_points(x: DataFrame) -> DataFrame:
    """precision/recall at each distinct score and at the next higher one."""
    tp_n = F.col("tp") - F.col("pos")
    fp_n = F.col("fp") - F.col("neg")
    return x.select(
        "*",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("prec"),
        (F.col("tp") / F.col("n_pos")).alias("rec"),
        F.when(tp_n + fp_n == 0, F.lit(1.0)).otherwise(tp_n / (tp_n + fp_n)).alias("p_next"),
        (tp_n / F.col("n_pos")).alias("r_next"))


def pr_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area under the PR curve (all distinct scores + final point)."""
    by = list(by)
    x = _pr_points(score_counts(df, label, score, by))
    seg = F.abs(F.col("rec") - F.col("r_next")) * (F.col("prec") + F.col("p_next")) / 2
    return x.groupBy(*by).agg(F.sum(seg).alias("pr_auc"))


def best_f1_threshold(df: DataFrame, label: str = "label", score: str = "score", offset: int = -1) -> DataFrame:
    """F1 = 2pr/(p+r+1e-9) over the PR points in ascending score order;
    first (smallest-score) maximum.  ``offset=-1`` returns the next lower
    distinct score (0.5 when there is none), as the reference does; ``offset=0``
    the maximizing score.  Also returns the best F1 and the PR-AUC."""
    x = _pr_points(score_counts(df, label, score))
    f1 = 2 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec") + F.lit(1e-9))
    best = x.select(F.struct(f1.alias("f1"), (-F.col("point")).alias("neg_point"), F.col("threshold").alias("s"))
                    .alias("k")).agg(F.max("k").alias("b"))
    seg = F.abs(F.col("rec") - F.col("r_next")) * (F.col("prec") + F.col("p_next")) / 2
    area = x.agg(F.sum(seg).alias("pr_auc"))
    j = x.select("threshold").crossJoin(F.broadcast(best))  # one row
    lower = j.agg(F.max(F.when(F.col("threshold") < F.col("b.s"), F.col("threshold"))).alias("lower"),
                  F.first("b").alias("b"))
    chosen = F.col("b.s") if offset == 0 else F.coalesce(F.col("lower"), F.lit(0.5))
    return lower.crossJoin(area).select(  # one-row side
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), chosen)).alias("threshold"),
        F.greatest(F.col("b.f1"), F.lit(0.0)).alias("best_f1"), "pr_auc")


# ---------------------------------------------------------------- regression
def finite_pairs(df: DataFrame, y: str = "actual", yhat: str = "pred") -> DataFrame:
    """Drop rows where either value is NULL, NaN or infinite."""
    ok = None
    for c in (y, yhat):
        v = F.col(c)
        cond = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
        ok = cond if ok is None else ok & cond
    return df.filter(ok)


def forecast_metrics(df: DataFrame, y: str = "actual", yhat: str = "pred", by: Sequence[str] = ("model",)) -> DataFrame:
    """MAE, RMSE, MAPE (zero actual -> denominator 1), R² per model."""
    by = list(by)
    x = finite_pairs(df, y, yhat)
    e = F.col(y) - F.col(yhat)
    den = F.when(F.col(y) != 0, F.col(y)).otherwise(F.lit(1.0))
    m = x.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("MAE"), F.sqrt(F.avg(e * e)).alias("RMSE"),
        (F.avg(F.abs(e / den)) * 100).alias("MAPE"),
        F.sum(e * e).alias("__sse"), (F.var_pop(y) * F.count(F.lit(1))).alias("__sst"),
        F.count(F.lit(1)).alias("n"))
    return m.withColumn("R2", F.lit(1.0) - F.col("__sse") / F.col("__sst")).drop("__sse", "__sst")


def avg_rank(df: DataFrame, col: str, desc: bool = False, by: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Average rank with ties (pandas ``rank()``), ascending or descending."""
    by = list(by)
    o = F.col(col).desc() if desc else F.col(col).asc()
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(o)
    tie = Window.partitionBy(*by, col)
    out = out or f"{col}_Rank"
    return df.withColumn(out, (F.rank().over(w) + (F.count(F.lit(1)).over(tie) - 1) / 2).cast("double"))


def rank_models(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Round metrics to 2 decimals, average-rank each (R² descending), mean rank."""
    x = metrics.withColumns({c: np_round(c, 2) for c in ("MAE", "RMSE", "MAPE", "R2")})
    for c, desc in (("MAE", False), ("RMSE", False), ("MAPE", False), ("R2", True)):
        x = avg_rank(x, c, desc, by)
    return x.withColumn("Avg_Rank", (F.col("MAE_Rank") + F.col("RMSE_Rank") + F.col("MAPE_Rank") + F.col("R2_Rank")) / 4)


def residuals(df: DataFrame, y: str = "actual", yhat: str = "pred") -> DataFrame:
    """residual = actual - predicted."""
    return finite_pairs(df, y, yhat).withColumn("residual", F.col(y) - F.col(yhat))


def ranges(df: DataFrame, y: str = "actual", yhat: str = "pred", by: Sequence[str] = ("model",)) -> DataFrame:
    """Least and greatest actual and predicted value, and the rows, of every model."""
    return finite_pairs(df, y, yhat).groupBy(*by).agg(F.min(y).alias("actual_min"), F.max(y).alias("actual_max"), F.min(yhat).alias("pred_min"),
                                                      F.max(yhat).alias("pred_max"), F.count(F.lit(1)).alias("n"))


def metrics_long(metrics: DataFrame, ids: Sequence[str] = ("model",),
                 cols: Sequence[str] = ("MAE", "RMSE", "MAPE", "R2")) -> DataFrame:
    """Model x metric long table."""
    return metrics.unpivot(list(ids), list(cols), "metric", "value")


def align(actual: DataFrame, pred: DataFrame, on: str = "ds") -> DataFrame:
    """Predictions joined to actuals by date (a shorter prediction simply has fewer rows)."""
    return actual.join(pred, on=on, how="inner")
