"""Forecasting jobs over the daily feature table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import arima
from tessera.operators import evaluate as ev
from tessera.operators import forecast as fc
from tessera.operators import gram
from tessera.operators import profile as pr
from tessera.operators import timeseries as ts
from tessera.plans import daily
from tessera.session import checkpoint

REGRESSORS = ["temp", "temp_min", "temp_max", "humidity", "wind_speed", "clouds_all", "is_weekend"]
WEATHER = ["temp", "temp_min", "temp_max", "humidity", "wind_speed", "rain_1h", "rain_3h", "snow_3h", "clouds_all"]


def series(spark: SparkSession, d: str) -> DataFrame:
    x = daily.daily_features(spark, d)
    x = x.withColumnsRenamed({"time": "ds", daily.TARGET: "y"}).withColumn("is_weekend", F.col("is_weekend").cast("double"))
    return checkpoint(x)  # reused by every model fit below


def seasonal_test(x: DataFrame, model=None) -> DataFrame:
    train, test = x.filter(F.col("split") == "train"), x.filter(F.col("split") == "test")
    m = model(train) if model else fc.fit_seasonal(train, "ds", "y", REGRESSORS)
    return fc.forecast_seasonal(m, test, "ds", REGRESSORS).select("ds", "y", "yhat", "yhat_lower", "yhat_upper")


def fixed_model(train: DataFrame) -> DataFrame:
    """Coefficients that are given, not fitted (for the registered checks): a level, a slope, small waves and
    regressors of the training rows' scale."""
    n = 2 + 2 * sum(o for _, _, o in fc.SEASONS) + len(REGRESSORS)
    return fc.regressor_stats(train, REGRESSORS, []).withColumn("beta", F.array(*[F.lit(fixed_beta(k)) for k in range(n)])).withColumn("sigma", F.lit(1000.0))


def fixed_beta(k: int) -> float:
    return 250000.0 if k == 0 else 5000.0 if k == 1 else round(100.0 * (-1) ** k * (k % 5 + 1), 1)


def forecast_horizon(spark: SparkSession, d: str, horizon: int = 30, model=None) -> DataFrame:
    """C6 spine + C7 covariates + C1-C4 calendar + G1, renamed output; ``model`` makes the coefficients of
    the training rows (default: fitted)."""
    x = series(spark, d)
    train = x.filter(F.col("split") == "train")
    spine = ts.future_spine(train, horizon, "ds")
    fut = ts.trailing_mean_covariates(train, WEATHER, 30, spine, "ds")
    fut = ts.calendar_features(fut, "ds", season="month").withColumn("is_weekend", F.col("is_weekend").cast("double"))
    m = model(train) if model else fc.fit_seasonal(train, "ds", "y", REGRESSORS)
    p = fc.forecast_seasonal(m, fut, "ds", REGRESSORS)
    return p.select(F.col("ds").alias("Date"), F.col("yhat").alias("Predicted_Load_MW"),
                    F.col("yhat_lower").alias("Lower_Bound_MW"), F.col("yhat_upper").alias("Upper_Bound_MW"))


def numeric_features(x: DataFrame) -> list[str]:
    """Every numeric column of the daily table but the target."""
    return [f.name for f in x.schema.fields if f.dataType.simpleString() in ("double", "int", "bigint") and f.name != "y"]


def window_test(x: DataFrame) -> DataFrame:
    """G6 on the test period: windows of the target and of all numeric columns."""
    train, test = x.filter(F.col("split") == "train"), x.filter(F.col("split") == "test")
    cols = numeric_features(x)
    rows = [t.select("ds", F.col("y").cast("double").alias("y"), *[F.col(c).cast("double").alias(c) for c in cols]) for t in (train, test)]
    m, st = fc.fit_window_regressor(rows[0], "ds", "y", 30, features=cols)
    return fc.predict_window_regressor(m, st, rows[1], "ds", "y", 30, features=cols)


def run_all(spark: SparkSession, d: str) -> DataFrame:
    """Each model forecasts the test period; predictions are aligned with
    the actuals by date (J8), scored (E8) and ranked (E9).  Each forecast is
    written to the checkpoint folder on its own, so a model that fails, also
    while it runs, leaves a row with its error instead of ending the run."""
    x = series(spark, d)
    train, test = x.filter(F.col("split") == "train"), x.filter(F.col("split") == "test")
    actual = test.select("ds", F.col("y").alias("actual"))
    jobs = {}
    add = jobs.__setitem__

    add("seasonal_regression", lambda: seasonal_test(x))

    add("window_regressor", lambda: window_test(x))

    def boot():
        h = test.count()
        b = fc.forecast_bootstrap(train.select("ds", "y"), h, "ds", "y")
        # map forecast steps onto the test dates in order
        w = test.select("ds").withColumn("step", F.row_number().over(Window.orderBy("ds")))
        return b.drop("ds").join(w, "step")
    add("bootstrap_paths", boot)
    add("differenced_arx", lambda: arx_test(x))
    return score_models(actual, jobs)


def score_models(actual: DataFrame, jobs: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """Metrics and ranks of every model's forecast (ds, yhat) against (ds, actual), with a ``status``:
    ``ok`` or the error that stopped the model."""
    preds, failed = None, []
    for name, fn in jobs.items():
        try:
            p = checkpoint(fn().select("ds", F.col("yhat").alias("pred")).withColumn("model", F.lit(name)))
        except Exception as e:  # noqa: BLE001 - one model's failure must not stop the others
            failed.append((name, f"{type(e).__name__}: {str(e)[:300]}"))
            continue
        preds = p if preds is None else preds.unionByName(p)
    spark = actual.sparkSession
    errors = spark.createDataFrame(failed, "model string, status string")
    if preds is None:
        return errors
    ranked = ev.rank_models(ev.forecast_metrics(ev.align(actual, preds, "ds"))).withColumn("status", F.lit("ok"))
    return ranked.unionByName(errors, allowMissingColumns=True)


def overlay(spark: SparkSession, d: str, last: int = 60, model=None) -> DataFrame:
    """The last ``last`` days of the training rows, where the forecast begins, and the 30-day forecast, tagged."""
    x = series(spark, d)
    tail = pr.tail(x.filter(F.col("split") == "train"), last, ["ds"]).select("ds", F.col("y").alias("value"), F.lit("actual").alias("kind"))
    f = forecast_horizon(spark, d, model=model).select(F.col("Date").alias("ds"), F.col("Predicted_Load_MW").alias("value"),
                                          F.lit("forecast").alias("kind"))
    return tail.unionByName(f)


EXOG = ["temp", "humidity", "is_weekend"]


def arx_test(x: DataFrame) -> DataFrame:
    """G5 on the test period (recursive, exogenous weather known); ``form`` says whether the seasonal model held."""
    train, test = x.filter(F.col("split") == "train"), x.filter(F.col("split") == "test")
    p = arima.forecast(arima.fit(train, "ds", "y", EXOG), test, "ds", EXOG)
    return p.join(test.select("ds", "y"), "ds").select("ds", "y", "yhat", "yhat_lower", "yhat_upper", "step", "form")


FORM = gram.Form(tuple(REGRESSORS))


def cutoff_errors(spark: SparkSession, d: str) -> DataFrame:
    """Every cutoff and point of the grid; test rows stay unseen."""
    return gram.cutoff_errors(series(spark, d).filter(F.col("split") == "train"), "ds", "y", FORM)


def rolling_origin(spark: SparkSession, d: str) -> DataFrame:
    """Mean error of each of the 72 points over the cutoffs."""
    return gram.mean_errors(cutoff_errors(spark, d))


def refit_best(spark: SparkSession, d: str) -> DataFrame:
    """Pick the grid point with the lowest mean CV RMSE (first on ties),
    refit on all training rows and forecast the test rows."""
    x = series(spark, d)
    train, test = x.filter(F.col("split") == "train"), x.filter(F.col("split") == "test")
    mean = gram.mean_errors(gram.cutoff_errors(train, "ds", "y", FORM))
    best = checkpoint(mean.orderBy("mean_rmse", "grid_index").limit(1))
    m = gram.fit(train, best, "ds", "y", FORM)
    return (gram.forecast(m, test, "ds", FORM).select("ds", "y", "yhat", "yhat_lower", "yhat_upper")
            .crossJoin(F.broadcast(best.select("grid_index", "params"))))  # one row
