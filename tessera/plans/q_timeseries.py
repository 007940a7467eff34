"""Registered time-series queries."""

from __future__ import annotations

from tessera.plans import daily
from tessera.plans.registry import register

register("daily_features", daily.DAILY_FEATURES_SQL)(daily.daily_features)

# ------------------------------------------------------- single operators
from pyspark.sql import functions as F  # noqa: E402

from tessera.functions.hashing import np_round, np_round_sql  # noqa: E402
from tessera.operators import profile as pr  # noqa: E402
from tessera.operators import timeseries as ts  # noqa: E402
from tessera.sources import fixtures as fx  # noqa: E402

R = np_round_sql
E = "WITH " + daily.ENERGY_SQL + ",\n"
Y = daily.TARGET


def _energy(spark, d):
    return daily.energy_daily(spark, d)


register("a01_resample_daily_mean", E.rstrip(",\n") + "\nSELECT * FROM energy")(_energy)
register("a02_daily_agg", "WITH " + daily.WEATHER_SQL + "\nSELECT * FROM weather_day")(
    lambda s, d: ts.daily_agg(ts.kelvin_to_celsius(ts.to_numeric(
        fx.weather_raw(s, d).withColumn("dt_iso", ts.date_part_lenient("dt_iso")).dropna(subset=["dt_iso"]),
        fx.WEATHER_COLS), ["temp", "temp_min", "temp_max"]), "dt_iso", daily.WEATHER_SPEC, out_day="time"))
register("w04_fill_both", "WITH " + daily.WEATHER_SQL + "\nSELECT * FROM weather")(daily.weather_daily)
register("j01_merge_daily", "WITH " + daily.CALENDAR_SQL + "\nSELECT * FROM merged")(
    lambda s, d: ts.merge_daily(daily.energy_daily(s, d), daily.weather_daily(s, d), "time"))
register("c01_calendar_features", "WITH " + daily.CALENDAR_SQL + "\nSELECT * FROM cal")(daily.merged_calendar)


@register("w01_add_lags", E + f"""x AS (SELECT 1)
SELECT "time", {Y}, lag({Y}, 1) OVER w AS {Y}_lag_1, lag({Y}, 7) OVER w AS {Y}_lag_7, lag({Y}, 30) OVER w AS {Y}_lag_30
FROM energy WINDOW w AS (ORDER BY "time")""")
def w01(spark, d):
    return ts.add_lags(_energy(spark, d), Y, [1, 7, 30], "time")


def _roll_sql(k, fn, name):
    fr = f"OVER (ORDER BY \"time\" ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    return f"{R(f'CASE WHEN count({Y}) {fr} = {k} THEN {fn}({Y}) {fr} END', 4)} AS {Y}_rolling_{name}_{k}"


@register("w02_add_rolling", E + "x AS (SELECT 1)\nSELECT \"time\", " + Y + ", " + ", ".join(
    _roll_sql(k, fn, nm) for k in (7, 30) for fn, nm in (("avg", "mean"), ("stddev_samp", "std"))) + " FROM energy")
def w02(spark, d):
    x = ts.add_rolling(_energy(spark, d), Y, [7, 30], "time")
    return x.withColumns({c: np_round(c, 4) for c in x.columns if "rolling" in c})


@register("w05_sequence_windows", E + f"""x AS (SELECT "time", {Y} AS label,
  list({Y}) OVER (ORDER BY "time" ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS win FROM energy)
SELECT "time", win AS "window", label FROM x WHERE len(win) = 30""")
def w05(spark, d):
    x = ts.sequence_windows(_energy(spark, d), [Y], 30, Y, "time")
    return x.select("time", F.flatten("window").alias("window"), "label")


@register("w07_running_best", E + f"""x AS (SELECT 1) SELECT "time", {Y}, max({Y}) OVER (ORDER BY "time" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far FROM energy""")
def w07(spark, d):
    return ts.running_best(_energy(spark, d), "time", Y)


@register("w10_ordinal", """SELECT p_type AS problem, p_partkey AS item,
  CAST(row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) - 1 AS BIGINT) AS position FROM part""")
def w10(spark, d):
    from tessera.operators.ordering import ordinal
    p = fx.alloc_items(spark, d, many=True).select("problem", "item")
    return ordinal(p, ["problem"], ["item"], F.floor(F.col("item") / 4096), name="position")


@register("o06_split_time", E + f"""x AS (SELECT 1) SELECT "time", {Y}, CASE WHEN row_number() OVER (ORDER BY "time")
  <= floor(count(*) OVER () * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM energy""")
def o06(spark, d):
    return ts.split_time(_energy(spark, d), "time", 0.2)


W9_SQL = E + f"""b AS (SELECT "time", {Y}, row_number() OVER (ORDER BY "time") - 1 AS i,
  CASE WHEN count({Y}) OVER (ORDER BY "time" ROWS BETWEEN 182 PRECEDING AND 182 FOLLOWING) = 365
       THEN avg({Y}) OVER (ORDER BY "time" ROWS BETWEEN 182 PRECEDING AND 182 FOLLOWING) END AS ma FROM energy),
fb AS (SELECT min(i) FILTER (WHERE ma IS NOT NULL) AS front, max(i) FILTER (WHERE ma IS NOT NULL) AS back FROM b),
fit AS (SELECT regr_slope(ma, i) FILTER (WHERE i >= front AND i < least(front + 365, back)) AS kf,
  regr_intercept(ma, i) FILTER (WHERE i >= front AND i < least(front + 365, back)) AS nf,
  regr_slope(ma, i) FILTER (WHERE i >= greatest(front, back - 365) AND i < back) AS kb,
  regr_intercept(ma, i) FILTER (WHERE i >= greatest(front, back - 365) AND i < back) AS nb FROM b, fb),
t AS (SELECT b.*, CASE WHEN i < front THEN kf * i + nf WHEN i > back THEN kb * i + nb ELSE ma END AS trend FROM b, fb, fit),
ph AS (SELECT i % 365 AS p, avg({Y} - trend) AS pa FROM t GROUP BY 1),
se AS (SELECT p, pa - avg(pa) OVER () AS seasonal FROM ph)
SELECT "time", {Y}, {R('trend', 4)} AS trend, {R('seasonal', 4)} AS seasonal, {R(f'{Y} - trend - seasonal', 4)} AS resid
FROM t JOIN se ON t.i % 365 = se.p"""


@register("w09_decompose", W9_SQL)
def w09(spark, d):
    x = ts.decompose(_energy(spark, d), Y, 365, "time")
    return x.select("time", Y, *[np_round(c, 4).alias(c) for c in ("trend", "seasonal", "resid")])


def qq_sql(source: str) -> str:
    """Filliben positions and normal quantiles of s(by, row_id, sample, i, n), the SELECT's head given by the caller."""
    def horner(coefs, x):
        acc = repr(coefs[0])
        for c in coefs[1:]:
            acc = f"({acc}) * {x} + {c!r}"
        return acc
    lower = f"({horner(pr._C, 'ql')}) / (({horner(pr._D, 'ql')}) * ql + 1)"
    central = f"({horner(pr._A, 'r')}) * q / (({horner(pr._B, 'r')}) * r + 1)"
    upper = f"-(({horner(pr._C, 'qu')}) / (({horner(pr._D, 'qu')}) * qu + 1))"
    return f"""m AS (SELECT *, CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n) ELSE (i - 0.3175) / (n + 0.365) END AS position FROM {source}),
v AS (SELECT *, sqrt(-2 * ln(position)) AS ql, position - 0.5 AS q, (position - 0.5) * (position - 0.5) AS r,
  sqrt(-2 * ln(1 - position)) AS qu FROM m),
points AS (SELECT *, {R(f'CASE WHEN position < {pr.P_LOW} THEN {lower} WHEN position > 1 - {pr.P_LOW} THEN {upper} ELSE {central} END', 6)} AS theoretical FROM v)
"""


QQ_SQL = f"""WITH {fx.CAMPAIGN_SQL},
s AS (SELECT row_id, CAST(total AS DOUBLE) AS sample, row_number() OVER (ORDER BY total, row_id) AS i, count(*) OVER () AS n FROM campaign),
{qq_sql('s')}"""


@register("a20_qq_line", QQ_SQL + f"""SELECT {R('regr_slope(sample, theoretical)', 3)} AS slope, {R('regr_intercept(sample, theoretical)', 3)} AS intercept,
  {R('corr(sample, theoretical)', 6)} AS r, count(*) AS n FROM points""")
def a20_line(spark, d):
    x = pr.qq_line(a20(spark, d))
    return x.select(np_round("slope", 3).alias("slope"), np_round("intercept", 3).alias("intercept"), np_round("r", 6).alias("r"), "n")


@register("a20_qq_points", QQ_SQL + f"SELECT CAST(i AS BIGINT) AS i, row_id, sample, {R('position', 8)} AS position, theoretical FROM points")
def a20(spark, d):
    q = pr.qq_points(fx.campaign(spark, d), "total", "row_id", bucket=F.floor(F.col("sample") / 10000))
    return q.select("i", "row_id", "sample", np_round("position", 8).alias("position"),
                    np_round("theoretical", 6).alias("theoretical"))


# ------------------------------------------------- many series at once (by=)
def _priority_daily(spark, d):
    from tessera.sources.tables import table
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("series"), "o_orderdate", "o_totalprice")
    return ts.resample_daily_mean(o, F.to_date("o_orderdate"), "o_totalprice", out_day="ds", by=["series"])


PRI_SQL = f"""WITH pd AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS ds,
  {R('avg(o_totalprice)', 0)} AS o_totalprice FROM orders GROUP BY 1, 2 HAVING avg(o_totalprice) IS NOT NULL)
"""

register("a01_resample_by_series", PRI_SQL + "SELECT * FROM pd")(_priority_daily)


@register("w02_rolling_by_series", PRI_SQL + "SELECT series, ds, o_totalprice, " + ", ".join(
    f"{R(f'CASE WHEN count(o_totalprice) OVER w = 7 THEN {fn}(o_totalprice) OVER w END', 4)} AS o_totalprice_rolling_{nm}_7"
    for fn, nm in (("avg", "mean"), ("stddev_samp", "std")))
    + " FROM pd WINDOW w AS (PARTITION BY series ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")
def w02s(spark, d):
    x = ts.add_rolling(_priority_daily(spark, d), "o_totalprice", [7], "ds", by=["series"])
    return x.withColumns({c: np_round(c, 4) for c in x.columns if "rolling" in c})


def g01s(spark, d):
    """G1 for every series in one set of jobs (Gram sums keyed by series)."""
    from tessera.operators import forecast as fc
    m = fc.fit_seasonal(_priority_daily(spark, d), "ds", "o_totalprice", by=["series"])
    return m.select("series", "n", np_round("sigma", 4).alias("sigma"))


register("g01_fit_seasonal_by_series")(g01s)


@register("p13_removed_rows", daily.DAILY_FEATURES_SQL.split("complete AS (")[0].rstrip().rstrip(",") + f"""
SELECT count(*) AS rows, count(*) FILTER (WHERE {Y}_lag_30 IS NULL OR {Y}_rolling_mean_30 IS NULL OR {Y}_rolling_std_30 IS NULL) AS removed,
  count(*) FILTER (WHERE {Y}_lag_30 IS NULL) AS null_lag_30, count(*) FILTER (WHERE {Y}_rolling_std_30 IS NULL) AS null_rolling_std_30 FROM feat""")
def p13(spark, d):
    """Rows that the lags and rolling windows of the daily job cost."""
    x = daily.feature_rows(spark, d)
    out = ts.removed_rows(x)
    return out.select("rows", "removed", F.col(f"null_{Y}_lag_30").alias("null_lag_30"), F.col(f"null_{Y}_rolling_std_30").alias("null_rolling_std_30"))
