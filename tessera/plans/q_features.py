"""Registered feature-preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import hash_uniform_sql, np_round, np_round_sql
from tessera.operators import features as fe
from tessera.operators import neighbors as nb
from tessera.plans import daily
from tessera.plans.registry import register
from tessera.sources import fixtures as fx

R = np_round_sql
W = "WITH " + fx.CAMPAIGN_SQL + ",\n"


def _round(df, digits=6):
    cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: np_round(c, digits) for c in cols})


def engineered(spark, d):
    return fe.engineer(fx.campaign(spark, d))


ENG_SQL = """eng AS (SELECT *, CASE WHEN pdays > -1 AND pdays <= 0 THEN '0' WHEN pdays > 0 AND pdays <= 3 THEN '1-3'
  WHEN pdays > 3 AND pdays <= 10 THEN '4-10' WHEN pdays > 10 AND pdays <= 999 THEN '11-999'
  WHEN pdays > 999 AND pdays <= 1e9 THEN '999+' END AS pdays_bucket,
  CAST(previous > 0 AS INT) AS contact_last, CAST(campaign AS DOUBLE) / CAST(1 + previous AS DOUBLE) AS campaign_intensity
  FROM campaign)
"""


@register("p10_engineer", W + ENG_SQL + f"SELECT row_id, pdays, pdays_bucket, contact_last, {R('campaign_intensity', 6)} AS campaign_intensity FROM eng")
def p10(spark, d):
    e = engineered(spark, d)
    return _round(e.select("row_id", "pdays", "pdays_bucket", "contact_last", "campaign_intensity"))


@register("p09_binary_target", W.rstrip(",\n") + " SELECT row_id, CAST(y = 'yes' AS INT) AS target FROM campaign")
def p09(spark, d):
    return fx.campaign(spark, d).select("row_id", fe.binary_target("y", "yes").alias("target"))


@register("p02_drop_leakage", W.rstrip(",\n") + " SELECT * EXCLUDE (duration) FROM campaign")
def p02(spark, d):
    return fe.drop_leakage(fx.campaign(spark, d))


U = hash_uniform_sql(42, "row_id")
SPLIT_SQL = f"""rk AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {U}, row_id) - 1 AS rnk,
  count(*) OVER (PARTITION BY y) AS ncls FROM campaign),
sp AS (SELECT *, CASE WHEN rnk < ceil(ncls * 0.2::DOUBLE) THEN 'test'
  WHEN rnk < ceil(ncls * 0.2::DOUBLE) + ceil((ncls - ceil(ncls * 0.2::DOUBLE)) * 0.2::DOUBLE) THEN 'val' ELSE 'train' END AS split FROM rk)
"""


@register("o07_split_stratified", W + SPLIT_SQL + "SELECT row_id, y, split FROM sp")
def o07(spark, d):
    return fe.split_stratified(fx.campaign(spark, d).select("row_id", "y"), "y", "row_id", 0.2, 0.2, 42)


@register("o08_stratified_folds", W + SPLIT_SQL + "SELECT row_id, y, CAST(rnk % 5 AS INT) AS fold FROM sp")
def o08(spark, d):
    return fe.stratified_folds(fx.campaign(spark, d).select("row_id", "y"), "y", "row_id", 5, 42)


@register("m09_balanced_weights", W + f"""SELECT row_id, y, {R('(SELECT count(*) FROM campaign) / (2 * count(*) OVER (PARTITION BY y))', 8)} AS weight FROM campaign""")
def m09(spark, d):
    c = fx.campaign(spark, d).select("row_id", "y")
    return _round(fe.balanced_weights(c, "y"), 8)


_SC = ["total", "campaign", "pdays", "previous", "acctbal"]


@register("m04_scale_std", W + SPLIT_SQL + ", st AS (SELECT " + ", ".join(
    f"CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1.0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS s_{c}" for c in _SC)
    + " FROM sp WHERE split = 'train')\nSELECT row_id, split, " + ", ".join(
    f"{R(f'CAST({c} AS DOUBLE) / s_{c}', 6)} AS {c}" for c in _SC) + " FROM sp, st")
def m04(spark, d):
    c = fe.split_stratified(fx.campaign(spark, d), "y", "row_id", 0.2, 0.2, 42)
    c = c.select("row_id", "split", *[F.col(x).cast("double").alias(x) for x in _SC])
    stats = fe.scale_std_fit(c.filter(F.col("split") == "train"), _SC)
    return _round(fe.scale_std_apply(c, stats, _SC))


@register("m05_scale_minmax", W + SPLIT_SQL + ", st AS (SELECT " + ", ".join(
    f"min(CAST({c} AS DOUBLE)) AS lo_{c}, max(CAST({c} AS DOUBLE)) AS hi_{c}" for c in _SC)
    + " FROM sp WHERE split = 'train')\nSELECT row_id, split, " + ", ".join(
    f"{R(f'CASE WHEN hi_{c} - lo_{c} = 0 THEN 0.0 ELSE (CAST({c} AS DOUBLE) - lo_{c}) / (hi_{c} - lo_{c}) END', 6)} AS {c}" for c in _SC)
    + " FROM sp, st")
def m05(spark, d):
    c = fe.split_stratified(fx.campaign(spark, d), "y", "row_id", 0.2, 0.2, 42)
    c = c.select("row_id", "split", *[F.col(x).cast("double").alias(x) for x in _SC])
    stats = fe.scale_minmax_fit(c.filter(F.col("split") == "train"), _SC)
    return _round(fe.scale_minmax_apply(c, stats, _SC))


_CATS = ["segment", "status", "priority", "month", "poutcome"]


@register("m03_one_hot", W + SPLIT_SQL + ", dom AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, v, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS idx FROM (SELECT DISTINCT {c} AS v FROM sp WHERE split = 'train')"
    for c in _CATS) + "),\nlong AS (" + " UNION ALL ".join(
    f"SELECT row_id, '{c}' AS column_name, {c} AS v FROM sp" for c in _CATS)
    + ")\nSELECT row_id, long.column_name, dom.idx AS active_index FROM long LEFT JOIN dom ON long.column_name = dom.column_name AND long.v = dom.v")
def m03(spark, d):
    from tessera.operators.ml import one_hot_stages
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    from tessera.session import checkpoint
    # fitting on the train rows and encoding all rows reads the input twice:
    # materialize the split table once
    c = checkpoint(fe.split_stratified(fx.campaign(spark, d), "y", "row_id", 0.2, 0.2, 42)
                   .select("row_id", "split", *_CATS))
    model = Pipeline(stages=one_hot_stages(_CATS)).fit(c.filter(F.col("split") == "train"))
    x = model.transform(c)
    # active slot of each one-hot vector (NULL when the category is unseen -> all zeros)
    cols = []
    for k in _CATS:
        arr = vector_to_array(F.col(f"{k}__oh"))
        pos = F.array_position(arr, 1.0)
        cols.append(F.struct(F.lit(k).alias("column_name"),
                             F.when(pos > 0, (pos - 1).cast("int")).alias("active_index")))
    return x.select("row_id", F.explode(F.array(*cols)).alias("e")).select("row_id", "e.column_name", "e.active_index")


@register("m01_cap_outliers_iqr", "WITH " + daily.ENERGY_SQL + f""",
q AS (SELECT quantile_cont(total_load_actual, 0.25) AS q1, quantile_cont(total_load_actual, 0.5) AS med,
  quantile_cont(total_load_actual, 0.75) AS q3, quantile_cont(total_load_actual, 0.01) AS p01,
  quantile_cont(total_load_actual, 0.99) AS p99 FROM energy)
SELECT "time", {R('''CASE WHEN (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AND x > med THEN p99
  WHEN (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AND x < med THEN p01 ELSE x END''', 4)} AS total_load_actual
FROM (SELECT "time", total_load_actual AS x FROM energy), q""")
def m01(spark, d):
    e = daily.energy_daily(spark, d)
    return _round(fe.cap_outliers(e, daily.TARGET, "iqr"), 4)


@register("m02_cap_outliers_zscore", "WITH " + daily.ENERGY_SQL + f""",
q AS (SELECT avg(total_load_actual) AS mu, stddev_samp(total_load_actual) AS sd, quantile_cont(total_load_actual, 0.5) AS med,
  quantile_cont(total_load_actual, 0.01) AS p01, quantile_cont(total_load_actual, 0.99) AS p99 FROM energy)
SELECT "time", {R('''CASE WHEN abs((x - mu) / sd) > 3 AND x > med THEN p99
  WHEN abs((x - mu) / sd) > 3 AND x < med THEN p01 ELSE x END''', 4)} AS total_load_actual
FROM (SELECT "time", total_load_actual AS x FROM energy), q""")
def m02(spark, d):
    e = daily.energy_daily(spark, d)
    return _round(fe.cap_outliers(e, daily.TARGET, "zscore"), 4)


MINORITY = 5
_D2 = "list_sum(list_transform(range(1, len(a.v) + 1), lambda t: (a.v[t] - b.v[t]) * (a.v[t] - b.v[t])))"
KNN_SQL = f"""m AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label = {MINORITY}),
p AS (SELECT a.id AS i, b.id AS j, {_D2} AS d2 FROM m a JOIN m b ON a.id <> b.id),
nn AS (SELECT i, j, CAST(rank AS INT) AS rank, d2 FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY d2, j) AS rank FROM p) WHERE rank <= 5)
"""


def _minority(spark, d):
    from tessera.sources.tables import table
    return table(spark, d, "embeddings").filter(F.col("label") == MINORITY)


@register("j09_knn_join", "WITH " + KNN_SQL + f"SELECT i, j, rank, {R('d2', 6)} AS d2 FROM nn")
def j09(spark, d):
    k = nb.knn_join(_minority(spark, d), "vec_id", "embedding", 5)
    return _round(k.withColumn("rank", F.col("rank").cast("int")))


def _h(seed, s, k):
    return hash_uniform_sql(seed, s, f"'{k}'").replace(f"CAST('{k}' AS VARCHAR)", f"'{k}'")


@register("m08_smote", "WITH " + KNN_SQL + f""", mp AS (SELECT id, v, row_number() OVER (ORDER BY id) - 1 AS pos FROM m),
cnt AS (SELECT count(*) FILTER (WHERE label = {MINORITY}) AS n_min, count(*) FILTER (WHERE label <> {MINORITY}) AS n_maj FROM embeddings),
s AS (SELECT unnest(range(n_maj - n_min)) AS s, n_min FROM cnt),
dr AS (SELECT s, CAST(floor({_h(42, 's', 1)} * n_min) AS BIGINT) AS pos, CAST(floor({_h(42, 's', 2)} * 5) + 1 AS INT) AS rank,
  {_h(42, 's', 3)} AS gap FROM s)
SELECT dr.s, {MINORITY} AS label, list_transform(range(1, len(b.v) + 1), lambda t: {R('b.v[t] + dr.gap * (n.v[t] - b.v[t])', 6)}) AS embedding,
  b.id AS i, nn.j, {R('dr.gap', 8)} AS gap
FROM dr JOIN mp b ON dr.pos = b.pos JOIN nn ON nn.i = b.id AND nn.rank = dr.rank JOIN m n ON n.id = nn.j""")
def m08(spark, d):
    from tessera.sources.tables import table
    emb = table(spark, d, "embeddings")
    s = nb.smote(emb, "vec_id", "embedding", "label", MINORITY, k=5, seed=42)
    return s.select("s", F.col("label").cast("int").alias("label"),
                    F.transform("embedding", lambda v: np_round(v, 6)).alias("embedding"), "i", "j",
                    np_round("gap", 8).alias("gap"))
