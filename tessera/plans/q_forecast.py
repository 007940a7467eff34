"""Registered forecasting queries."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.functions.hashing import np_round, np_round_sql
from tessera.operators import forecast as fc
from tessera.operators import gram
from tessera.operators import timeseries as ts
from tessera.plans import daily, forecasting
from tessera.plans.registry import register

R = np_round_sql
DF = "WITH dfe AS (" + daily.DAILY_FEATURES_SQL + "),\ntrain AS (SELECT * FROM dfe WHERE split = 'train')\n"


def _train(spark, d):
    x = daily.daily_features(spark, d)
    return x.filter(F.col("split") == "train").withColumnRenamed("time", "ds")


@register("c06_future_spine", DF + "SELECT CAST(unnest(generate_series(max(\"time\") + 1, max(\"time\") + 30, INTERVAL 1 DAY)) AS DATE) AS ds FROM train")
def c06(spark, d):
    return ts.future_spine(_train(spark, d), 30, "ds")


@register("c07_trailing_mean_covariates", DF + """, t30 AS (SELECT * FROM train ORDER BY "time" DESC LIMIT 30),
sp AS (SELECT CAST(unnest(generate_series(max("time") + 1, max("time") + 30, INTERVAL 1 DAY)) AS DATE) AS ds FROM train)
SELECT ds, """ + ", ".join(f"{R(f'(SELECT avg({c}) FROM t30)', 4)} AS {c}" for c in forecasting.WEATHER) + " FROM sp")
def c07(spark, d):
    tr = _train(spark, d)
    out = ts.trailing_mean_covariates(tr, forecasting.WEATHER, 30, ts.future_spine(tr, 30, "ds"), "ds")
    return out.withColumns({c: np_round(c, 4) for c in forecasting.WEATHER})


@register("c04_season_by_month", DF + """SELECT "time" AS ds, CASE WHEN month("time") IN (3, 4, 5) THEN 'spring'
  WHEN month("time") IN (6, 7, 8) THEN 'summer' WHEN month("time") IN (9, 10, 11) THEN 'autumn' ELSE 'winter' END AS season FROM dfe""")
def c04(spark, d):
    x = daily.daily_features(spark, d).select(F.col("time").alias("ds"))
    return x.withColumn("season", ts.season_by_month("ds"))


@register("g03_cutoffs", DF + """, mm AS (SELECT min("time") AS mn, max("time") AS mx FROM train),
k AS (SELECT unnest(range(CAST(floor(date_diff('day', mn + 730, mx - 90) / 180) AS BIGINT) + 1)) AS k, mx FROM mm
      WHERE floor(date_diff('day', mn + 730, mx - 90) / 180) >= 0)
SELECT CAST(mx - 90 - CAST(k * 180 AS INT) AS DATE) AS cutoff FROM k""")
def g03c(spark, d):
    return fc.cutoffs(_train(spark, d), "ds", 730, 180, 90)


def _coef(spark, d):
    x = forecasting.series(spark, d)
    m = fc.fit_seasonal(x.filter(F.col("split") == "train"), "ds", "y", forecasting.REGRESSORS)
    return m.select(F.transform("beta", lambda b: np_round(b, 6)).alias("beta"), np_round("sigma", 4).alias("sigma"), "n")


register("g01_fit_seasonal")(_coef)
register("g02_forecast_seasonal_test")(lambda s, d: forecasting.seasonal_test(forecasting.series(s, d)))


register("g03_rolling_origin_cv")(forecasting.rolling_origin)
register("g03_cutoff_errors")(forecasting.cutoff_errors)


register("g06_window_regressor")(lambda s, d: forecasting.window_test(forecasting.series(s, d)))


def g07(spark, d):
    x = forecasting.series(spark, d)
    return fc.forecast_bootstrap(x.filter(F.col("split") == "train").select("ds", "y"), 30, "ds", "y")


from tessera.functions.hashing import hash_uniform_sql  # noqa: E402

G07_SQL = DF + f""", ctx AS (SELECT "time" AS ds, total_load_actual AS y FROM (
    SELECT *, row_number() OVER (ORDER BY "time" DESC) AS back FROM train) WHERE back <= 512),
r0 AS (SELECT ds, y, y - lag(y, 7) OVER (ORDER BY ds) AS res, row_number() OVER (ORDER BY ds DESC) AS back FROM ctx),
res AS (SELECT res, row_number() OVER (ORDER BY ds) - 1 AS ri FROM r0 WHERE res IS NOT NULL),
nres AS (SELECT count(*) AS n FROM res),
lastv AS (SELECT back AS src_back, y AS level FROM r0 WHERE back <= 7),
steps AS (SELECT s.range AS step, 7 - ((s.range - 1) % 7) AS src_back FROM range(1, 31) s),
paths AS (SELECT st.step, l.level, p.range AS path,
    CAST(floor({hash_uniform_sql(3, "p.range", "st.step")} * (SELECT n FROM nres)) AS BIGINT) AS ri
  FROM steps st JOIN lastv l ON st.src_back = l.src_back, range(0, 100) p)
SELECT CAST(p.step AS INT) AS step, CAST((SELECT max(ds) FROM ctx) + CAST(p.step AS INT) AS DATE) AS ds,
  {R('quantile_cont(level + res, 0.5)', 4)} AS yhat, {R('quantile_cont(level + res, 0.05)', 4)} AS yhat_lower,
  {R('quantile_cont(level + res, 0.95)', 4)} AS yhat_upper
FROM paths p JOIN res ON p.ri = res.ri GROUP BY p.step"""


def g07r(spark, d):
    out = g07(spark, d)
    return out.select(F.col("step").cast("int").alias("step"), "ds", *[np_round(c, 4).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")])


register("g07_forecast_bootstrap", G07_SQL)(g07r)
register("g08_forecast_horizon")(lambda s, d: forecasting.forecast_horizon(s, d, 30))
register("g09_run_all")(lambda s, d: forecasting.run_all(s, d))
register("g10_overlay")(lambda s, d: forecasting.overlay(s, d))
register("g10_overlay_actual", DF + f"""SELECT "time" AS ds, {R('total_load_actual', 4)} AS value, 'actual' AS kind
FROM (SELECT * FROM train ORDER BY "time" DESC LIMIT 60)""")(
    lambda s, d: forecasting.overlay(s, d).filter(F.col("kind") == "actual").withColumn("value", np_round("value", 4)))
register("g04_refit_best")(lambda s, d: forecasting.refit_best(s, d))
register("g05_arx_test")(lambda s, d: forecasting.arx_test(forecasting.series(s, d)))


def x05(spark, d):
    x = forecasting.series(spark, d)
    m = fc.fit_seasonal(x.filter(F.col("split") == "train"), "ds", "y", forecasting.REGRESSORS)
    return fc.regressor_importance(m, forecasting.REGRESSORS)


register("x05_regressor_importance")(x05)


# ------------------------------------------------------------- Gram sums (D*)
def _design_sql_terms():
    import math as _m
    t = "CAST(date_diff('day', DATE '1970-01-01', ds) AS DOUBLE)"
    terms = ["1.0::DOUBLE", f"{t} / {365.25 * 30!r}::DOUBLE"]
    for _n, period, order in fc.SEASONS:
        for k in range(1, order + 1):
            c = repr(2.0 * _m.pi * k / period)
            terms += [f"sin({c}::DOUBLE * {t})", f"cos({c}::DOUBLE * {t})"]
    return terms


def _gram_sql():
    terms = _design_sql_terms()
    p = len(terms)
    sel = ", ".join(f"{t} AS f{i}" for i, t in enumerate(terms))
    sums = ", ".join(f"sum(f{i} * f{j}) AS g_{i}_{j}" for i in range(p) for j in range(i, p))
    cols = ", ".join(f"g_{i}_{j}" for i in range(p) for j in range(i, p))
    return PRI + f""", x AS (SELECT series, {sel} FROM pd),
s AS (SELECT series, {sums} FROM x GROUP BY series),
u AS (SELECT * FROM (UNPIVOT s ON {cols} INTO NAME k VALUE v))
SELECT series, CAST(split_part(k, '_', 2) AS INT) AS i, CAST(split_part(k, '_', 3) AS INT) AS j, {R('v', 6)} AS value FROM u"""


PRI = """WITH pd AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS ds,
  avg(o_totalprice) AS o_totalprice FROM orders GROUP BY 1, 2 HAVING avg(o_totalprice) IS NOT NULL)"""


@register("g01_gram_sums", _gram_sql())
def g01g(spark, d):
    """X'X of the seasonal design per series, from the distributed Gram sums."""
    from tessera.plans.q_timeseries import _priority_daily
    x = fc.design(_priority_daily(spark, d), "ds", [], None, ["series"])
    g = fc.gram_sums(x, "o_totalprice", ["series"])
    p = len(_design_sql_terms())
    out = g.select(F.get_json_object("__series", "$.series").alias("series"), F.posexplode("g").alias("pos", "v"))
    out = out.select("series", (F.col("pos") / p).cast("int").alias("i"), F.pmod("pos", F.lit(p)).cast("int").alias("j"), "v")
    return out.filter(F.col("i") <= F.col("j")).select("series", "i", "j", np_round("v", 6).alias("value"))


# ------------------------------------------------ fits that SQL can state (D)
MEANS = f"""WITH pd AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS ds,
  {R('avg(o_totalprice)', 0)} AS o_totalprice FROM orders GROUP BY 1, 2 HAVING avg(o_totalprice) IS NOT NULL)"""
TREND = gram.Form((), (), 0)
UNIT = "(date_diff('day', mn, ds) / CAST(greatest(date_diff('day', mn, mx), 1) AS DOUBLE))"


@register("g01_trend_fit", MEANS + f""", sp AS (SELECT series, min(ds) AS mn, max(ds) AS mx FROM pd GROUP BY series),
x AS (SELECT series, {UNIT} AS t, o_totalprice AS y FROM pd JOIN sp USING (series))
SELECT series, count(*) AS n, {R('regr_intercept(y, t)', 4)} AS level, {R('regr_slope(y, t)', 4)} AS slope,
  {R('sqrt((regr_syy(y, t) - regr_sxy(y, t) ** 2 / regr_sxx(y, t)) / (count(*) - 3))', 4)} AS sigma FROM x GROUP BY series""")
def g01t(spark, d):
    """Level and slope per series from the Gram sums alone."""
    from tessera.plans.q_timeseries import _priority_daily
    m = gram.fit(_priority_daily(spark, d), None, "ds", "o_totalprice", TREND, ["series"])
    return m.select("series", "n", np_round(F.col("gamma")[0], 4).alias("level"), np_round(F.col("gamma")[1], 4).alias("slope"), np_round("sigma", 4).alias("sigma"))


WEEK = gram.Form((), (("weekly", 7.0, 3),), 2)


def _product_sql() -> str:
    day = "CAST(date_diff('day', DATE '1970-01-01', ds) AS DOUBLE)"
    trend = ["1.0::DOUBLE", "t", *[f"greatest(t - {float(k)!r}::DOUBLE, 0)" for k in WEEK.knot_places()]]
    waves = ["1.0::DOUBLE", *[f"{f}({2 * math.pi * k / p!r}::DOUBLE * {day})" for _, p, o in WEEK.seasons for k in range(1, o + 1) for f in ("sin", "cos")]]
    terms = [f"({a}) * ({b})" for a in trend for b in waves]
    sums = ", ".join(f"sum(({x}) * o_totalprice) AS b_{i}" for i, x in enumerate(terms))
    return MEANS + f""", sp AS (SELECT series, min(ds) AS mn, max(ds) AS mx FROM pd GROUP BY series),
x AS (SELECT pd.*, {UNIT} AS t FROM pd JOIN sp USING (series)),
s AS (SELECT series, {sums} FROM x GROUP BY series),
u AS (SELECT * FROM (UNPIVOT s ON {", ".join(f"b_{i}" for i in range(len(terms)))} INTO NAME k VALUE v))
SELECT series, CAST(split_part(k, '_', 2) AS INT) AS i, {R('v / 1e6', 4)} AS value FROM u"""


@register("g01_product_sums", _product_sql())
def g01p(spark, d):
    """X'y (in millions) of the trend and season products per series."""
    from tessera.plans.q_timeseries import _priority_daily
    x = _priority_daily(spark, d)
    sums = gram.gram_table(x, WEEK, "ds", "o_totalprice", F.lit(0), gram.spans(x, "ds", ["series"]), ["series"])

    def listed(batches):
        for b in batches:
            for series, raw in zip(b.column("series").to_pylist(), b.column("b").to_pylist()):
                v = np.frombuffer(raw)
                yield pa.RecordBatch.from_arrays([pa.array([series] * len(v)), pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)], names=["series", "i", "v"])
    out = sums.select("series", "b").mapInArrow(listed, "series string, i int, v double")
    return out.select(F.get_json_object("series", "$.series").alias("series"), "i", np_round(F.col("v") / 1e6, 4).alias("value"))


# ------------------------------------------ G2, G8 and G10 with fixed coefficients
def _fixed_sql(rows: str) -> str:
    """yhat of ``rows`` (ds and the regressors) under the fixed coefficients and the training rows' scales."""
    terms = _design_sql_terms() + [f"({r} - mu_{r}) / sd_{r}" for r in forecasting.REGRESSORS]
    yhat = " + ".join(f"{forecasting.fixed_beta(k)!r}::DOUBLE * ({t})" for k, t in enumerate(terms))
    scales = ", ".join(f"avg({r}) AS mu_{r}, CASE WHEN stddev_samp({r}) IS NULL OR stddev_samp({r}) = 0 THEN 1.0 ELSE stddev_samp({r}) END AS sd_{r}"
                       for r in forecasting.REGRESSORS)
    return f"""sc AS (SELECT {scales} FROM train),
fc AS (SELECT f.*, {yhat} AS yhat FROM {rows} f, sc)
"""


_FUTURE = """t30 AS (SELECT * FROM train ORDER BY "time" DESC LIMIT 30),
spine AS (SELECT CAST(unnest(generate_series(max("time") + 1, max("time") + 30, INTERVAL 1 DAY)) AS DATE) AS ds FROM train),
future AS (SELECT ds, CAST(isodow(ds) - 1 >= 5 AS INT) AS is_weekend, """ + ", ".join(
    f"(SELECT avg({c}) FROM t30) AS {c}" for c in forecasting.WEATHER) + " FROM spine),\n"
_BAND = f"{fc.Z95!r}::DOUBLE * 1000"


@register("g02_fixed_forecast", DF + ", test AS (SELECT *, \"time\" AS ds, total_load_actual AS y FROM dfe WHERE split = 'test'),\n" + _fixed_sql("test")
          + f"SELECT ds, y, {R('yhat', 4)} AS yhat, {R(f'yhat - {_BAND}', 4)} AS yhat_lower, {R(f'yhat + {_BAND}', 4)} AS yhat_upper FROM fc")
def g02f(spark, d):
    out = forecasting.seasonal_test(forecasting.series(spark, d), forecasting.fixed_model)
    return out.withColumns({c: np_round(c, 4) for c in ("yhat", "yhat_lower", "yhat_upper")})


@register("g08_fixed_horizon", DF + "," + _FUTURE + _fixed_sql("future") + f"""SELECT ds AS "Date", {R('yhat', 4)} AS "Predicted_Load_MW",
  {R(f'yhat - {_BAND}', 4)} AS "Lower_Bound_MW", {R(f'yhat + {_BAND}', 4)} AS "Upper_Bound_MW" FROM fc""")
def g08f(spark, d):
    out = forecasting.forecast_horizon(spark, d, 30, forecasting.fixed_model)
    return out.withColumns({c: np_round(c, 4) for c in ("Predicted_Load_MW", "Lower_Bound_MW", "Upper_Bound_MW")})


@register("g10_fixed_overlay", DF + "," + _FUTURE + _fixed_sql("future") + f"""SELECT "time" AS ds, {R('total_load_actual', 4)} AS value, 'actual' AS kind
FROM (SELECT * FROM train ORDER BY "time" DESC LIMIT 60) UNION ALL SELECT ds, {R('yhat', 4)}, 'forecast' FROM fc""")
def g10f(spark, d):
    return forecasting.overlay(spark, d, model=forecasting.fixed_model).withColumn("value", np_round("value", 4))
