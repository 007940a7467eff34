"""Registered profiling queries (campaign stand-in, FIXTURES F1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import hash_uniform_sql, np_round, np_round_sql
from tessera.operators import profile as pr
from tessera.operators import timeseries as ts
from tessera.plans.registry import register
from tessera.sources import fixtures as fx

W = "WITH " + fx.CAMPAIGN_SQL + ",\n"
NUM = ["acctbal", "total", "campaign", "duration", "previous", "pdays"]
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def _round(df, digits=6, cols=None):
    cols = cols or [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: np_round(c, digits) for c in cols})


def _cam(spark, d):
    return fx.campaign(spark, d)


register("f01_campaign", "WITH " + fx.CAMPAIGN_SQL + " SELECT * FROM campaign")(
    lambda s, d: fx.campaign(s, d))


@register("a03_value_counts", W + f"""x AS (SELECT segment, count(*) AS n FROM campaign GROUP BY segment)
SELECT segment, n, {np_round_sql('n / sum(n) OVER ()', 6)} AS share FROM x""")
def a03(spark, d):
    return _round(pr.value_counts(_cam(spark, d), "segment"))


_SCHEMA_ROWS = [(0, "row_id", "bigint"), (1, "acctbal", "double"), (2, "total", "double"),
                (3, "campaign", "bigint"), (4, "duration", "bigint"), (5, "previous", "bigint"),
                (6, "pdays", "int"), (7, "segment", "string"), (8, "status", "string"),
                (9, "priority", "string"), (10, "month", "string"), (11, "day_of_week", "int"),
                (12, "poutcome", "string"), (13, "y", "string")]


@register("a04_schema_profile", W + "meta(position, column_name, data_type) AS (VALUES "
          + ", ".join(f"({i}, '{n}', '{t}')" for i, n, t in _SCHEMA_ROWS)
          + ") SELECT CAST(position AS INT) AS position, column_name, data_type, n_rows "
            "FROM meta, (SELECT count(*) AS n_rows FROM campaign)")
def a04(spark, d):
    return pr.schema_profile(_cam(spark, d))


def _weather_parsed(spark, d):
    w = fx.weather_raw(spark, d)
    w = w.withColumn("dt_iso", ts.date_part_lenient("dt_iso"))
    return ts.to_numeric(w, fx.WEATHER_COLS)


_WEATHER_PARSED_SQL = "WITH " + fx.WEATHER_RAW_SQL + """,
wp AS (SELECT CAST(try_strptime(split_part(dt_iso, ' ', 1), '%Y-%m-%d') AS DATE) AS dt_iso, """ + ", ".join(
    f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in fx.WEATHER_COLS) + " FROM weather_raw)\n"


@register("a05_null_counts", _WEATHER_PARSED_SQL + "SELECT * FROM (UNPIVOT (SELECT "
          + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in ["dt_iso"] + fx.WEATHER_COLS)
          + " FROM wp) ON " + ", ".join(["dt_iso"] + fx.WEATHER_COLS) + " INTO NAME column_name VALUE n_null)")
def a05(spark, d):
    return pr.null_counts(_weather_parsed(spark, d), ["dt_iso"] + fx.WEATHER_COLS)


@register("p07_to_numeric", _WEATHER_PARSED_SQL + "SELECT * REPLACE ("
          + ", ".join(f"{np_round_sql(c, 6)} AS {c}" for c in fx.WEATHER_COLS) + ") FROM wp")
def p07(spark, d):
    return _round(_weather_parsed(spark, d))


_CAT = ["segment", "status", "priority", "month", "poutcome", "y", "pdays"]


@register("a06_distinct_counts", W + "SELECT * FROM (UNPIVOT (SELECT "
          + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in _CAT)
          + " FROM campaign) ON " + ", ".join(_CAT) + " INTO NAME column_name VALUE n_distinct)")
def a06(spark, d):
    return pr.distinct_counts(_cam(spark, d), _CAT)


_SENT = {"pdays": 999, "priority": "unknown", "poutcome": "nonexistent", "previous": 0}


def _lit(v):
    return f"'{v}'" if isinstance(v, str) else str(v)


@register("a07_sentinel_counts", W + "s AS (SELECT * FROM (UNPIVOT (SELECT "
          + ", ".join(f"count(*) FILTER (WHERE {c} = {_lit(v)}) AS {c}" for c, v in _SENT.items())
          + " FROM campaign) ON " + ", ".join(_SENT) + " INTO NAME column_name VALUE n_sentinel)) "
          + "SELECT column_name, n_sentinel, CASE column_name "
          + " ".join(f"WHEN '{c}' THEN '{v}'" for c, v in _SENT.items()) + " END AS sentinel FROM s WHERE n_sentinel > 0")
def a07(spark, d):
    return pr.sentinel_counts(_cam(spark, d), _SENT)


def _summary_sql(col: str) -> str:
    x = f"CAST({col} AS DOUBLE)"
    r4 = lambda e: np_round_sql(e, 4)
    return f"""SELECT '{col}' AS column_name, count({x}) AS count, count(*) FILTER (WHERE {col} IS NULL) AS missing,
  {r4(f'avg({x})')} AS mean, {r4(f'stddev_samp({x})')} AS std, {r4(f'min({x})')} AS min,
  {r4(f'quantile_cont({x}, 0.25)')} AS q1, {r4(f'quantile_cont({x}, 0.5)')} AS median,
  {r4(f'quantile_cont({x}, 0.75)')} AS q3, {r4(f'max({x})')} AS max, {r4(f'max({x}) - min({x})')} AS range,
  {r4(f'stddev_samp({x}) / avg({x}) * 100')} AS cv_pct,
  {r4(f'(SELECT avg(power({x} - m.mu, 3)) / power(avg(power({x} - m.mu, 2)), 1.5) FROM campaign, (SELECT avg({x}) AS mu FROM campaign) m)')} AS skewness
FROM campaign"""


@register("a08_summary", W.rstrip(",\n") + "\n" + " UNION ALL ".join(_summary_sql(c) for c in NUM))
def a08(spark, d):
    return _round(pr.summary(_cam(spark, d), NUM), 4)


@register("a11_iqr_outliers", W + "q AS (SELECT " + ", ".join(
    f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS {c}_q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS {c}_q3"
    for c in NUM) + " FROM campaign) SELECT * FROM (UNPIVOT (SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) OR {c} > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1)) AS {c}"
    for c in NUM) + " FROM campaign, q) ON " + ", ".join(NUM) + " INTO NAME column_name VALUE n_outliers)")
def a11(spark, d):
    return pr.iqr_outliers(_cam(spark, d), NUM)


_CORR = ["total", "campaign", "duration", "previous", "pdays"]


@register("a12_corr_matrix", W.rstrip(",\n") + "\n" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {np_round_sql(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))', 6)} AS corr FROM campaign"
    for a in _CORR for b in _CORR))
def a12(spark, d):
    return _round(pr.corr_matrix(_cam(spark, d), _CORR))


@register("a13_corr_with", W.rstrip(",\n") + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {np_round_sql(f'corr(CAST({c} AS DOUBLE), CAST(duration AS DOUBLE))', 6)} AS corr FROM campaign"
    for c in ["total", "campaign", "previous", "pdays", "acctbal"]))
def a13(spark, d):
    return _round(pr.corr_with(_cam(spark, d), "duration", ["total", "campaign", "previous", "pdays", "acctbal"]))


@register("a14_histogram", W + f"""st AS (SELECT min(total) AS mn, max(total) AS mx FROM campaign),
c AS (SELECT CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((total - mn) / (mx - mn) * 30), 29) END AS INT) AS bin,
             count(*) AS n FROM campaign, st WHERE total IS NOT NULL GROUP BY 1),
sp AS (SELECT CAST(range AS INT) AS bin, mn, mx FROM st, range(0, 30))
SELECT sp.bin, {np_round_sql('mn + (mx - mn) * sp.bin / 30', 6)} AS lo,
       {np_round_sql('mn + (mx - mn) * (sp.bin + 1) / 30', 6)} AS hi, CAST(COALESCE(n, 0) AS BIGINT) AS n
FROM sp LEFT JOIN c ON sp.bin = c.bin""")
def a14(spark, d):
    return _round(pr.histogram(_cam(spark, d), "total", 30))


@register("a15_box_stats", W + f"""q AS (SELECT segment, quantile_cont(total, 0.25) AS q1, quantile_cont(total, 0.5) AS med,
  quantile_cont(total, 0.75) AS q3 FROM campaign GROUP BY segment)
SELECT c.segment, {np_round_sql('any_value(q1)', 4)} AS q1, {np_round_sql('any_value(med)', 4)} AS median,
  {np_round_sql('any_value(q3)', 4)} AS q3,
  {np_round_sql('min(total) FILTER (WHERE total >= q1 - 1.5 * (q3 - q1))', 4)} AS whisker_low,
  {np_round_sql('max(total) FILTER (WHERE total <= q3 + 1.5 * (q3 - q1))', 4)} AS whisker_high,
  count(*) FILTER (WHERE total < q1 - 1.5 * (q3 - q1) OR total > q3 + 1.5 * (q3 - q1)) AS n_outliers,
  count(total) AS n
FROM campaign c JOIN q ON c.segment = q.segment GROUP BY c.segment""")
def a15(spark, d):
    return _round(pr.box_stats(_cam(spark, d), "total", ["segment"]), 4)


@register("a16_crosstab", W + "SELECT segment, y, count(*) AS n FROM campaign GROUP BY segment, y")
def a16(spark, d):
    return pr.crosstab(_cam(spark, d), "segment", "y")


@register("a17_rate_by", W + f"""SELECT poutcome, {np_round_sql("avg(CAST(y = 'yes' AS INT))", 6)} AS rate, count(*) AS n
FROM campaign GROUP BY poutcome""")
def a17(spark, d):
    c = _cam(spark, d).withColumn("yi", (F.col("y") == "yes").cast("int"))
    return _round(pr.rate_by(c, "poutcome", "yi"))


@register("a18_mean_by", W + f"SELECT day_of_week, {np_round_sql('avg(total)', 4)} AS mean_total FROM campaign GROUP BY day_of_week")
def a18(spark, d):
    return _round(pr.mean_by(_cam(spark, d), "day_of_week", "total"), 4)


@register("c08_reindex", W + "dom(position, month) AS (VALUES " + ", ".join(
    f"({i}, '{m}')" for i, m in enumerate([*MONTHS, "undated"])) + f"""),
r AS (SELECT month, avg(CAST(y = 'yes' AS INT)) AS rate, count(*) AS n FROM campaign GROUP BY month)
SELECT dom.month, CAST(position AS INT) AS position, {np_round_sql('rate', 6)} AS rate, n
FROM dom LEFT JOIN r ON dom.month = r.month""")
def c08(spark, d):
    """The domain names a value that no row has, which becomes the gap."""
    c = _cam(spark, d).withColumn("yi", (F.col("y") == "yes").cast("int"))
    return _round(pr.reindex(pr.rate_by(c, "month", "yi"), "month", [*MONTHS, "undated"]))


_KDE_SQL = W + f"""base AS (SELECT CAST(campaign AS DOUBLE) AS x FROM campaign WHERE campaign IS NOT NULL),
st AS (SELECT min(x) AS mn, max(x) AS mx, count(*) AS n, stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h FROM base),
vc AS (SELECT x, count(*) AS c FROM base GROUP BY x),
e AS (SELECT CAST(range AS INT) AS g, (mn - (mx - mn) / 2) + ((mx - mn) * 2) * range / 999 AS gx, x, c, n, h
      FROM vc, st, range(0, 1000))
SELECT g AS grid_index, {np_round_sql('any_value(gx)', 6)} AS x,
       {np_round_sql('sum(c * exp(-0.5 * ((gx - x) / h) * ((gx - x) / h))) / (any_value(n) * any_value(h) * 2.5066282746310002)', 12)} AS density
FROM e GROUP BY g"""


@register("a19_kde", _KDE_SQL)
def a19(spark, d):
    k = pr.kde(_cam(spark, d), "campaign", grid=1000)
    return k.select("grid_index", np_round("x", 6).alias("x"), np_round("density", 12).alias("density"))


@register("o02_head", W + "SELECT row_id, total, segment FROM campaign ORDER BY row_id LIMIT 5")
def o02(spark, d):
    return pr.head(_cam(spark, d).select("row_id", "total", "segment"), 5, ["row_id"])


@register("o02_tail", W + "SELECT row_id, total, segment FROM campaign ORDER BY row_id DESC LIMIT 5")
def o02_tail(spark, d):
    return pr.tail(_cam(spark, d).select("row_id", "total", "segment"), 5, ["row_id"])


@register("p15_columns_by_kind", W.rstrip(",\n") + "\n" + " UNION ALL ".join(
    f"SELECT '{n}' AS column_name, '{'string' if t == 'string' else 'numeric'}' AS kind, count({n}) AS n FROM campaign"
    for _, n, t in _SCHEMA_ROWS))
def p15(spark, d):
    """Non-null count of every column, by the kind that P15 sorts it into."""
    c = _cam(spark, d)
    kinds = {n: "numeric" for n in pr.numeric_cols(c)} | {n: "string" for n in pr.string_cols(c)}
    counts = c.agg(*[F.count(n).alias(n) for n in kinds])
    long = counts.unpivot([], list(kinds), "column_name", "n")
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("column_name")]
    return long.select("column_name", kind.alias("kind"), "n")


@register("o03_top_k", W + "SELECT row_id, total, CAST(row_number() OVER (ORDER BY total DESC, row_id) AS INT) AS rank "
          "FROM campaign ORDER BY total DESC, row_id LIMIT 10")
def o03(spark, d):
    return pr.top_k(_cam(spark, d).select("row_id", "total"), "total", 10, "row_id") \
        .withColumn("rank", F.col("rank").cast("int"))


@register("o03_top_k_by", W + """SELECT segment, row_id, total, CAST(rank AS INT) AS rank FROM (
  SELECT segment, row_id, total, row_number() OVER (PARTITION BY segment ORDER BY total DESC, row_id) AS rank
  FROM campaign) WHERE rank <= 3""")
def o03b(spark, d):
    return pr.top_k(_cam(spark, d).select("segment", "row_id", "total"), "total", 3, "row_id", by=["segment"]) \
        .withColumn("rank", F.col("rank").cast("int"))


@register("o04_arg_best", W + """SELECT segment, row_id, total FROM (
  SELECT segment, row_id, total, row_number() OVER (PARTITION BY segment ORDER BY total DESC, row_id) AS r
  FROM campaign) WHERE r = 1""")
def o04(spark, d):
    return pr.arg_best(_cam(spark, d).select("segment", "row_id", "total"), "total", "row_id", by=["segment"])


@register("o05_sample_n", W + f"SELECT row_id, total, y FROM campaign ORDER BY {hash_uniform_sql(42, 'row_id')}, row_id LIMIT 200")
def o05(spark, d):
    return pr.sample_n(_cam(spark, d).select("row_id", "total", "y"), 200, 42, "row_id")


@register("a22_pair_sample", W + f"""SELECT row_id, y, campaign, pdays, total FROM (
  SELECT *, row_number() OVER (PARTITION BY y ORDER BY {hash_uniform_sql(42, 'row_id')}, row_id) AS r FROM campaign)
WHERE r <= 100""")
def a22(spark, d):
    return pr.sample_n(_cam(spark, d).select("row_id", "y", "campaign", "pdays", "total"), 100, 42, "row_id", by=["y"])
