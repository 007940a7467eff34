"""Registered source/sink round trips: data is written by Spark to the shared
checkpoint folder and read back by the scan under test."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import np_round, np_round_sql
from tessera.operators import allocation as al
from tessera.operators import evaluate as ev
from tessera.plans import q_evaluate
from tessera.plans.q_allocation import DENSE_SQL, SEL_EVAL_SQL, WA, WAR, _alloc
from tessera.plans.registry import register
from tessera.sources import fixtures as fx
from tessera.sources import io
from tessera.streaming.jobs import scratch

R = np_round_sql
CAMPAIGN_SCHEMA = ("row_id BIGINT, acctbal DOUBLE, total DOUBLE, campaign BIGINT, duration BIGINT, previous BIGINT, "
                   "pdays INT, segment STRING, status STRING, priority STRING, month STRING, day_of_week INT, "
                   "poutcome STRING, y STRING")


@register("s01_scan_csv", "WITH " + fx.CAMPAIGN_SQL + " SELECT * FROM campaign")
def s01(spark, d):
    path = scratch(spark, "campaign-csv")
    io.write_table(fx.campaign(spark, d), path, "csv", sep=";")
    return io.scan_csv(spark, path, CAMPAIGN_SCHEMA, sep=";")


@register("s03_scan_csv_dates", "WITH " + fx.LOAD_RAW_SQL + """ SELECT CAST(split_part("time", ' ', 1) AS DATE) AS ds,
  "total load actual" AS total_load_actual FROM load_raw""")
def s03(spark, d):
    path = scratch(spark, "load-csv")
    raw = fx.load_raw(spark, d).select(F.split_part("time", F.lit(" "), F.lit(1)).alias("ds"),
                                       F.col("total load actual").alias("total.load.actual"))
    io.write_table(raw, path, "csv")
    return io.scan_csv(spark, path, "ds STRING, `total.load.actual` DOUBLE", date_cols=["ds"]) \
        .withColumnRenamed("total_load_actual", "total_load_actual")


@register("s04_scan_instances", WA + DENSE_SQL + """SELECT 'consumption' AS part, problem, resource, item, amount FROM dense
UNION ALL SELECT 'profit', problem, -1, item, profit * 1000 FROM items
UNION ALL SELECT 'capacity', problem, resource, -1, capacity FROM resources""")
def s04(spark, d):
    items, cons, res = _alloc(spark, d)
    path = scratch(spark, "instances-txt")
    io.write_instances_text(items, res, cons, path)
    _probs, it, rs, cs = io.scan_instances(spark, path)
    return (cs.select(F.lit("consumption").alias("part"), "problem", "resource", "item", "amount")
            .unionByName(it.select(F.lit("profit").alias("part"), "problem", F.lit(-1).alias("resource"), "item",
                                   F.col("profit").alias("amount")))
            .unionByName(rs.select(F.lit("capacity").alias("part"), "problem", "resource", F.lit(-1).cast("long").alias("item"),
                                   F.col("capacity").alias("amount")))
            .withColumn("problem", F.col("problem").cast("int")))


@register("s06_instance_parquet", WA.rstrip(",\n") + """
SELECT 'item' AS part, problem, item, -1 AS resource, category AS name, profit AS value FROM items
UNION ALL SELECT 'resource', problem, -1, resource, name, capacity FROM resources
UNION ALL SELECT 'consumption', problem, item, resource, NULL, amount FROM consumption""")
def s06(spark, d):
    items, cons, res = _alloc(spark, d)
    path = scratch(spark, "instance-parquet")
    io.save_instance(items, res, cons, path)
    it, rs, cs = io.load_instance(spark, path, problems=[1])
    none = F.lit(-1)
    return (it.select(F.lit("item").alias("part"), "problem", "item", none.alias("resource"), F.col("category").alias("name"), F.col("profit").alias("value"))
            .unionByName(rs.select(F.lit("resource").alias("part"), "problem", none.cast("long").alias("item"), "resource", "name", F.col("capacity").alias("value")))
            .unionByName(cs.select(F.lit("consumption").alias("part"), "problem", "item", "resource", F.lit(None).cast("string").alias("name"),
                                   F.col("amount").alias("value"))))


@register("s07_instance_json", WA + """req AS (SELECT c.problem, c.item, map_from_entries(list(struct_pack(k := r.name, v := c.amount) ORDER BY r.name)) AS rr
  FROM consumption c JOIN resources r ON c.problem = r.problem AND c.resource = r.resource GROUP BY 1, 2)
SELECT i.problem, i.item, i.category, i.profit AS profit_usd, req.rr AS resource_requirements
FROM items i LEFT JOIN req ON i.problem = req.problem AND i.item = req.item""")
def s07(spark, d):
    items, cons, res = _alloc(spark, d)
    path = scratch(spark, "instance-json")
    io.write_json(io.instance_products(items, res, cons), path)
    schema = "problem INT, item BIGINT, category STRING, profit_usd BIGINT, resource_requirements MAP<STRING, BIGINT>"
    return spark.read.schema(schema).json(path)


@register("s08_solution_document", WAR + SEL_EVAL_SQL + f"""SELECT 'product' AS part, i.problem, i.item, i.category AS name, CAST(i.profit AS DOUBLE) AS value
FROM sel s JOIN items i ON s.problem = i.problem AND s.item = i.item
UNION ALL SELECT 'usage', c.problem, c.item, r.name, CAST(c.amount AS DOUBLE) FROM sel s
  JOIN consumption c ON s.problem = c.problem AND s.item = c.item JOIN resources r ON c.problem = r.problem AND c.resource = r.resource
UNION ALL SELECT 'capacity', problem, -1, name, CAST(capacity AS DOUBLE) FROM ev
UNION ALL SELECT 'used', problem, -1, name, CAST(used AS DOUBLE) FROM ev
UNION ALL SELECT 'utilization', problem, -1, name, {R('CASE WHEN capacity > 0 THEN used / capacity * 100 ELSE 0.0 END', 6)} FROM ev""")
def s08(spark, d):
    """Written as solution documents and read back by the scan, usage map exploded."""
    items, cons, res = _alloc(spark, d)
    path = scratch(spark, "solution")
    io.write_json(io.solution_document(al.greedy_select(items, cons, res), items, cons, res, "greedy"), path)
    products, usage, found = io.scan_solutions(spark, path)
    parts = [products.select(F.lit("product").alias("part"), "problem", "item", F.col("category").alias("name"), F.col("profit_usd").alias("value")),
             usage.select(F.lit("usage").alias("part"), "problem", "item", "name", F.col("amount").alias("value"))]
    for part, column in (("capacity", F.col("capacity")), ("used", F.col("used")), ("utilization", np_round("utilization_percent", 6))):
        parts.append(found.select(F.lit(part).alias("part"), "problem", F.lit(-1).cast("long").alias("item"), "name", column.alias("value")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@register("s09_write_split", "WITH df AS (" + __import__("tessera.plans.daily", fromlist=["x"]).DAILY_FEATURES_SQL
          + ") SELECT split, count(*) AS n FROM df GROUP BY split")
def s09(spark, d):
    from tessera.plans import daily
    path = scratch(spark, "split")
    io.write_split(daily.daily_features(spark, d), path)
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("s10_result_table", q_evaluate.MET_SQL + f"SELECT model, {R('MAE', 4)} AS MAE, {R('RMSE', 4)} AS RMSE, {R('R2', 4)} AS R2, n FROM met")
def s10(spark, d):
    m = ev.forecast_metrics(q_evaluate.predictions(spark, d))
    path = scratch(spark, "result-table")
    io.write_table(m.select("model", *[np_round(c, 4).alias(c) for c in ("MAE", "RMSE", "R2")], "n"), path, "csv")
    return io.scan_csv(spark, path, "model STRING, MAE DOUBLE, RMSE DOUBLE, R2 DOUBLE, n BIGINT")


@register("s12_log_metrics", q_evaluate.MET_SQL + f"""SELECT * FROM (UNPIVOT (SELECT model, {R('MAE', 4)} AS MAE, {R('RMSE', 4)} AS RMSE,
  {R('MAPE', 4)} AS MAPE, CAST(n AS DOUBLE) AS n, {R('R2', 4)} AS R2 FROM met) ON MAE, RMSE, MAPE, n, R2 INTO NAME "key" VALUE value)""")
def s12(spark, d):
    m = ev.forecast_metrics(q_evaluate.predictions(spark, d))
    m = m.withColumns({c: np_round(c, 4) for c in ("MAE", "RMSE", "MAPE", "R2")})
    path = scratch(spark, "metrics-log")
    io.log_metrics(m, "run-1", path)
    return spark.read.parquet(path).filter(F.col("run_id") == "run-1").select("model", "key", "value")


@register("p19_problem_summary_declared", WA + f"""SELECT i.problem, n_items, {R('avg_profit', 6)} AS avg_profit, max_profit, n_resources,
  CAST(total_capacity AS BIGINT) AS total_capacity, 'Unknown' AS optimal_value
FROM (SELECT problem, count(*) AS n_items, avg(profit * 1000) AS avg_profit, max(profit * 1000) AS max_profit FROM items GROUP BY 1) i
JOIN (SELECT problem, count(*) AS n_resources, sum(capacity) AS total_capacity FROM resources GROUP BY 1) r ON i.problem = r.problem""")
def p19(spark, d):
    """A21 + P19 on instances scanned back from the text format (optimum 0 -> 'Unknown')."""
    items, cons, res = _alloc(spark, d)
    path = scratch(spark, "instances-p19")
    io.write_instances_text(items, res, cons, path)
    probs, it, rs, _cs = io.scan_instances(spark, path)
    from tessera.operators.allocation import problem_summary
    s = problem_summary(it.withColumn("problem", F.col("problem").cast("int")),
                        rs.withColumn("problem", F.col("problem").cast("int")),
                        probs.withColumn("problem", F.col("problem").cast("int")))
    return s.withColumn("avg_profit", np_round("avg_profit", 6)).withColumn("total_capacity", F.col("total_capacity").cast("bigint"))


@register("s09_write_split_rows", "WITH df AS (" + __import__("tessera.plans.daily", fromlist=["x"]).DAILY_FEATURES_SQL
          + ') SELECT * FROM df')
def s09_rows(spark, d):
    """Every row and column of the written split, read back."""
    from tessera.plans import daily
    path = scratch(spark, "split")
    x = daily.daily_features(spark, d)
    io.write_split(x, path)
    return spark.read.parquet(path).select(*x.columns)


@register("s05_summaries_with_defaults", WA + """t AS (SELECT problem, count(*) AS n, sum(profit) AS p FROM items GROUP BY problem)
SELECT CAST(problem AS INT) AS problem, 'N/A' AS company, 'greedy' AS method, CAST(CASE WHEN problem % 2 = 0 THEN p ELSE 0 END AS DOUBLE) AS profit,
  CAST(CASE WHEN problem % 2 = 0 THEN 0 ELSE n END AS INT) AS selected, CASE WHEN problem % 2 = 0 THEN 'Optimal' ELSE 'Unknown' END AS status FROM t""")
def s05_defaults(spark, d):
    """Heads of documents of which every second one lacks other keys: missing ones read as their defaults."""
    items, _, _ = _alloc(spark, d)
    path = scratch(spark, "summaries")
    even = F.col("problem") % 2 == 0
    heads = items.groupBy("problem").agg(F.count("*").alias("n"), F.sum("profit").alias("p")).select(
        F.col("problem").alias("problem_number"), F.lit("greedy").alias("optimization_method"),
        F.when(even, F.col("p").cast("double")).alias("best_profit_usd"), F.when(~even, F.col("n")).alias("number_of_selected_products"),
        F.when(even, "Optimal").alias("solver_status"))
    io.write_json(heads, path)
    return io.scan_summaries(spark, path)
