"""Daily feature job: load + weather → daily table with calendar, capped
target, lags, rolling statistics and a chronological split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.hashing import np_round, np_round_sql
from tessera.operators import features as fe
from tessera.operators import timeseries as ts
from tessera.session import checkpoint
from tessera.sources import fixtures as fx

TARGET = "total_load_actual"
WEATHER_SPEC = {"temp": "mean", "temp_min": "min", "temp_max": "max", "humidity": "mean",
                "wind_speed": "mean", "rain_1h": "sum", "rain_3h": "sum", "snow_3h": "sum",
                "clouds_all": "mean"}
LAGS = [1, 7, 30]
ROLL = [7, 30]


def energy_daily(spark: SparkSession, d: str) -> DataFrame:
    load = ts.snake_columns(fx.load_raw(spark, d))
    return ts.resample_daily_mean(load, ts.date_part_strict("time"), TARGET, out_day="time")


def weather_daily(spark: SparkSession, d: str) -> DataFrame:
    w = fx.weather_raw(spark, d)
    w = w.withColumn("dt_iso", ts.date_part_lenient("dt_iso")).dropna(subset=["dt_iso"])
    w = ts.to_numeric(w, fx.WEATHER_COLS)
    w = ts.kelvin_to_celsius(w, ["temp", "temp_min", "temp_max"])
    wd = ts.daily_agg(w, "dt_iso", WEATHER_SPEC, out_day="time", digits=2)
    return ts.fill_both(wd, fx.WEATHER_COLS, "time")


def merged_calendar(spark: SparkSession, d: str) -> DataFrame:
    e = energy_daily(spark, d)
    x = ts.merge_daily(e, weather_daily(spark, d), "time")
    # The merged table has one row per day (bounded by the calendar, not by the
    # raw volume).  Materialize it once so the statistics, holiday span and
    # windows below do not rescan the raw tables.
    x = checkpoint(x)
    x = ts.holiday_flag(x, fx.holidays(spark, x, "time"), "time")
    return ts.calendar_features(x, "time", season="date")


def feature_rows(spark: SparkSession, d: str) -> DataFrame:
    """All days with their features, also those whose lags or windows are not full yet."""
    x = merged_calendar(spark, d)
    x = fe.cap_outliers(x, TARGET, "iqr")
    x = ts.add_lags(x, TARGET, LAGS, "time")
    return ts.add_rolling(x, TARGET, ROLL, "time")


def daily_features(spark: SparkSession, d: str) -> DataFrame:
    x = ts.drop_incomplete(feature_rows(spark, d))
    x = ts.split_time(x, "time", 0.2)
    dbl = [f.name for f in x.schema.fields if f.dataType.simpleString() == "double"]
    return x.withColumns({c: np_round(c, 4) for c in dbl})


# ----------------------------------------------------------------- SQL twins
def _fill(c: str) -> str:
    return (f"COALESCE(last_value({c} IGNORE NULLS) OVER (ORDER BY \"time\" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER (ORDER BY \"time\" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}")


def _wagg(c: str, fn: str) -> str:
    e = {"mean": f"avg({c})", "min": f"min({c})", "max": f"max({c})", "sum": f"COALESCE(sum({c}), 0.0)"}[fn]
    return f"{np_round_sql(e, 2)} AS {c}"


ENERGY_SQL = fx.LOAD_RAW_SQL + f""",
energy AS (
  SELECT CAST(split_part("time", ' ', 1) AS DATE) AS "time",
         {np_round_sql('avg("total load actual")', 0)} AS total_load_actual
  FROM load_raw GROUP BY 1 HAVING avg("total load actual") IS NOT NULL
)"""

WEATHER_SQL = fx.WEATHER_RAW_SQL + """,
weather_num AS (
  SELECT CAST(try_strptime(split_part(dt_iso, ' ', 1), '%Y-%m-%d') AS DATE) AS d,
         TRY_CAST(temp AS DOUBLE) - 273.15::DOUBLE AS temp,
         TRY_CAST(temp_min AS DOUBLE) - 273.15::DOUBLE AS temp_min,
         TRY_CAST(temp_max AS DOUBLE) - 273.15::DOUBLE AS temp_max,
         TRY_CAST(humidity AS DOUBLE) AS humidity, TRY_CAST(wind_speed AS DOUBLE) AS wind_speed,
         TRY_CAST(rain_1h AS DOUBLE) AS rain_1h, TRY_CAST(rain_3h AS DOUBLE) AS rain_3h,
         TRY_CAST(snow_3h AS DOUBLE) AS snow_3h, TRY_CAST(clouds_all AS DOUBLE) AS clouds_all
  FROM weather_raw
),
weather_day AS (
  SELECT d AS "time", """ + ", ".join(_wagg(c, f) for c, f in WEATHER_SPEC.items()) + """
  FROM weather_num WHERE d IS NOT NULL GROUP BY d
),
weather AS (
  SELECT "time", """ + ", ".join(_fill(c) for c in fx.WEATHER_COLS) + """ FROM weather_day
)"""

CALENDAR_SQL = ENERGY_SQL + ",\n" + WEATHER_SQL + f""",
merged AS (
  SELECT e."time", e.total_load_actual, w.* EXCLUDE ("time")
  FROM energy e JOIN weather w ON e."time" = w."time"
),
cal AS (
  SELECT *, CAST({fx.HOLIDAY_PREDICATE_SQL.format(d='"time"')} AS INT) AS is_holiday,
         CAST(isodow("time") - 1 >= 5 AS INT) AS is_weekend,
         CAST(isodow("time") - 1 AS INT) AS day_of_week,
         CAST(month("time") AS INT) AS month,
         CAST(dayofyear("time") AS INT) AS day_of_year,
         CASE WHEN month("time") * 100 + day("time") BETWEEN 321 AND 620 THEN 'spring'
              WHEN month("time") * 100 + day("time") BETWEEN 621 AND 922 THEN 'summer'
              WHEN month("time") * 100 + day("time") BETWEEN 923 AND 1220 THEN 'autumn'
              ELSE 'winter' END AS season
  FROM merged
)"""


def _roll(k: int, fn: str) -> str:
    fr = f"OVER (ORDER BY \"time\" ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    return (f"CASE WHEN count(total_load_actual) {fr} = {k} THEN {fn}(total_load_actual) {fr} END "
            f"AS total_load_actual_rolling_{'mean' if fn == 'avg' else 'std'}_{k}")


DAILY_FEATURES_SQL = "WITH " + CALENDAR_SQL + """,
q AS (
  SELECT quantile_cont(total_load_actual, 0.25) AS q1, quantile_cont(total_load_actual, 0.5) AS med,
         quantile_cont(total_load_actual, 0.75) AS q3, quantile_cont(total_load_actual, 0.01) AS p01,
         quantile_cont(total_load_actual, 0.99) AS p99
  FROM cal
),
capped AS (
  SELECT cal.* REPLACE (
    CASE WHEN (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AND x > med THEN p99
         WHEN (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AND x < med THEN p01
         ELSE x END AS total_load_actual)
  FROM (SELECT *, total_load_actual AS x FROM cal) cal, q
),
feat AS (
  SELECT * EXCLUDE (x),
    lag(total_load_actual, 1) OVER (ORDER BY "time") AS total_load_actual_lag_1,
    lag(total_load_actual, 7) OVER (ORDER BY "time") AS total_load_actual_lag_7,
    lag(total_load_actual, 30) OVER (ORDER BY "time") AS total_load_actual_lag_30,
    """ + ",\n    ".join(_roll(k, fn) for k in ROLL for fn in ("avg", "stddev_samp")) + """
  FROM capped
),
complete AS (SELECT * FROM feat WHERE COLUMNS(*) IS NOT NULL),
split AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY "time") <= floor(count(*) OVER () * 0.8::DOUBLE)
                 THEN 'train' ELSE 'test' END AS split
  FROM complete
)
SELECT * REPLACE (""" + ", ".join(
    f"{np_round_sql(c, 4)} AS {c}" for c in
    [TARGET] + fx.WEATHER_COLS + [f"{TARGET}_lag_{k}" for k in LAGS]
    + [f"{TARGET}_rolling_{s}_{k}" for k in ROLL for s in ("mean", "std")]) + ") FROM split"
