"""Registered allocation queries (FIXTURES F4/F5 on part, lineitem, supplier)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import np_round, np_round_sql
from tessera.operators import allocation as al
from tessera.operators import profile as pr
from tessera.plans.registry import register
from tessera.sources import fixtures as fx

R = np_round_sql
WA = "WITH " + fx.ALLOC_SQL + ",\n"
WAR = "WITH RECURSIVE " + fx.ALLOC_SQL + ",\n"


def _round(df, digits=6):
    cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: np_round(c, digits) for c in cols})


def _alloc(spark, d):
    cons = fx.alloc_consumption(spark, d)
    return fx.alloc_items(spark, d), cons, fx.alloc_resources(spark, d, cons)


register("f04_items", WA.rstrip(",\n") + "\nSELECT * FROM items")(lambda s, d: fx.alloc_items(s, d))
register("f04_consumption", WA.rstrip(",\n") + "\nSELECT * FROM consumption")(lambda s, d: fx.alloc_consumption(s, d))
register("f04_resources", WA.rstrip(",\n") + "\nSELECT * FROM resources")(lambda s, d: fx.alloc_resources(s, d))

_SKU = ("(['Widget', 'Gadget', 'Component', 'Module', 'Assembly'])[(pos % 5) + 1] || '-' || "
        "(['A', 'B', 'C', 'D', 'E'])[((pos // 20) % 5) + 1] || lpad(CAST((pos % 20) + 1 AS VARCHAR), 2, '0')")


@register("p16_synthesize_items", WA + f"""x AS (SELECT *, row_number() OVER (PARTITION BY problem ORDER BY item) - 1 AS pos FROM items)
SELECT problem, item, category, profit, {_SKU} AS sku, split_part({_SKU}, '-', 1) AS sku_category FROM x""")
def p16(spark, d):
    return al.synthesize_items(fx.alloc_items(spark, d))


@register("p17_resource_dim", WA + """x AS (SELECT problem, resource, capacity FROM resources)
SELECT problem, resource, capacity, CASE WHEN count(*) OVER (PARTITION BY problem) = 5
  THEN (['CNC_Machine_Hours', 'Assembly_Line_Hours', 'Skilled_Labor_Hours', 'Raw_Material_Budget_USD', 'Energy_Consumption_kWh'])[resource + 1]
  ELSE 'Resource_' || CAST(resource + 1 AS VARCHAR) END AS name,
  CASE WHEN count(*) OVER (PARTITION BY problem) = 5 THEN (['hours', 'hours', 'hours', 'USD', 'kWh'])[resource + 1] ELSE 'units' END AS unit
FROM x""")
def p17(spark, d):
    _, _, r = _alloc(spark, d)
    return al.resource_dim(r.select("problem", "resource", "capacity"))


_NAMES = sorted(fx.RESOURCE_NAMES_5)


@register("p22_wide_items", WA + "w AS (SELECT c.problem, c.item, " + ", ".join(
    f"sum(amount) FILTER (WHERE name = '{n}') AS \"{n}\"" for n in _NAMES)
    + " FROM consumption c JOIN resources r ON c.problem = r.problem AND c.resource = r.resource GROUP BY 1, 2)\n"
    + "SELECT i.*, " + ", ".join(f"CAST(COALESCE(\"{n}\", 0) AS BIGINT) AS \"Consumes_{n}\"" for n in _NAMES)
    + ", CAST(" + " + ".join(f"COALESCE(\"{n}\", 0)" for n in _NAMES) + " AS BIGINT) AS Total_Resource_Consumption"
    + " FROM items i LEFT JOIN w ON i.problem = w.problem AND i.item = w.item")
def p22(spark, d):
    i, c, r = _alloc(spark, d)
    return al.wide_items(i, c, r)


DENSE_SQL = """dense AS (SELECT i.problem, i.item, i.profit, r.resource, r.name, r.capacity,
  CAST(COALESCE(c.amount, 0) AS BIGINT) AS amount
  FROM items i JOIN resources r ON i.problem = r.problem
  LEFT JOIN consumption c ON c.problem = i.problem AND c.item = i.item AND c.resource = r.resource)
"""


@register("j04_densify", WA + DENSE_SQL + "SELECT * FROM dense")
def j04(spark, d):
    i, c, r = _alloc(spark, d)
    return al.densify(i, r, c)


@register("k01_check_missing", WA + """a AS (SELECT problem, count(*) FILTER (WHERE profit IS NULL) AS null_profit FROM items GROUP BY 1),
b AS (SELECT problem, count(*) FILTER (WHERE capacity IS NULL) AS null_capacity FROM resources GROUP BY 1)
SELECT a.problem, null_profit, null_capacity FROM a JOIN b ON a.problem = b.problem""")
def k01(spark, d):
    i, _, r = _alloc(spark, d)
    return al.check_missing(i, r)


@register("k02_check_negative", WA + """a AS (SELECT problem, count(*) FILTER (WHERE profit < 0) AS neg_profit FROM items GROUP BY 1),
b AS (SELECT problem, count(*) FILTER (WHERE capacity < 0) AS neg_capacity FROM resources GROUP BY 1)
SELECT a.problem, neg_profit, neg_capacity FROM a JOIN b ON a.problem = b.problem""")
def k02(spark, d):
    i, _, r = _alloc(spark, d)
    return al.check_negative(i, r)


def _declared(spark, d):
    from tessera.sources.tables import table
    return table(spark, d, "part").agg(F.count(F.lit(1)).alias("n_items")).select(F.lit(1).alias("problem"), "n_items")


@register("k03_check_dimensions", WA + """dec AS (SELECT 1 AS problem, count(*) AS n_items FROM part),
n AS (SELECT problem, count(*) AS n_found FROM items GROUP BY 1)
SELECT dec.problem, n_items, COALESCE(n_found, 0) AS n_found, COALESCE(n_found, 0) = n_items AS ok
FROM dec LEFT JOIN n ON dec.problem = n.problem""")
def k03(spark, d):
    return al.check_dimensions(fx.alloc_items(spark, d), _declared(spark, d))


INFEAS_SQL = """inf AS (SELECT c.problem, c.item, list(r.name ORDER BY r.resource) AS violations, count(*) AS n_violations
  FROM consumption c JOIN resources r ON c.problem = r.problem AND c.resource = r.resource
  WHERE c.amount > r.capacity_small GROUP BY 1, 2)
"""


@register("k04_infeasible_items", WA + INFEAS_SQL + "SELECT problem, item, violations, CAST(n_violations AS INT) AS n_violations FROM inf")
def k04(spark, d):
    _, c, r = _alloc(spark, d)
    return al.infeasible_items(c, r, "capacity_small")


DOM_SQL = DENSE_SQL + """, vec AS (SELECT problem, item, any_value(profit) AS profit, list(amount ORDER BY resource) AS a FROM dense GROUP BY 1, 2),
dom AS (SELECT x.problem, count(*) AS dominated_pairs FROM vec x JOIN vec y ON x.problem = y.problem AND x.item < y.item
  AND x.profit > y.profit AND x.a[1] <= y.a[1] AND x.a[2] <= y.a[2] AND x.a[3] <= y.a[3] AND x.a[4] <= y.a[4] AND x.a[5] <= y.a[5]
  GROUP BY 1)
"""


@register("j03_dominated_pairs", WA + DOM_SQL + """SELECT p.problem, COALESCE(dominated_pairs, 0) AS dominated_pairs
FROM (SELECT DISTINCT problem FROM items) p LEFT JOIN dom ON p.problem = dom.problem""")
def j03(spark, d):
    i, c, r = _alloc(spark, d)
    return al.dominated_pairs(i, c, r)


@register("k06_validate", WA + DOM_SQL + "," + INFEAS_SQL + """, dec AS (SELECT 1 AS problem, count(*) AS n_items FROM part),
rows AS (
  SELECT problem, 'missing_values' AS "check", count(*) FILTER (WHERE profit IS NULL) + (SELECT count(*) FILTER (WHERE capacity IS NULL) FROM resources) AS "count", false AS warn_only FROM items GROUP BY 1
  UNION ALL SELECT problem, 'negative_values', count(*) FILTER (WHERE profit < 0) + (SELECT count(*) FILTER (WHERE capacity < 0) FROM resources), false FROM items GROUP BY 1
  UNION ALL SELECT dec.problem, 'dimensions', (SELECT count(*) FROM items) - n_items, false FROM dec
  UNION ALL SELECT dec.problem, 'infeasible_items', (SELECT count(*) FROM inf), true FROM dec
  UNION ALL SELECT dec.problem, 'dominated_pairs', COALESCE((SELECT dominated_pairs FROM dom), 0), true FROM dec),
r2 AS (SELECT problem, "check", CAST("count" AS BIGINT) AS "count", CASE WHEN "check" = 'dominated_pairs' THEN true ELSE "count" = 0 END AS passed, warn_only FROM rows)
SELECT *, bool_and(passed OR warn_only) OVER (PARTITION BY problem) AS all_passed FROM r2""")
def k06(spark, d):
    i, c, r = _alloc(spark, d)
    r = r.withColumn("capacity", F.col("capacity_small"))
    return al.validate(i, r, c, _declared(spark, d))


CAP_SQL = """n AS (SELECT problem, count(*) AS n FROM items GROUP BY 1),
dem AS (SELECT problem, resource, sum(amount) AS total_demand FROM consumption GROUP BY 1, 2),
cap AS (SELECT r.problem, r.resource, r.name, r.capacity, CAST(COALESCE(total_demand, 0) AS BIGINT) AS total_demand,
  COALESCE(total_demand, 0) / n AS mean_demand,
  CASE WHEN r.capacity = 0 THEN NULL ELSE CAST(COALESCE(total_demand, 0) AS DOUBLE) / r.capacity * 100 END AS utilization_pct
  FROM resources r LEFT JOIN dem ON r.problem = dem.problem AND r.resource = dem.resource JOIN n ON r.problem = n.problem)
"""


@register("k07_capacity_analysis", WA + CAP_SQL + f"""SELECT problem, resource, name, capacity, total_demand,
  {R('mean_demand', 6)} AS mean_demand, {R('utilization_pct', 6)} AS utilization_pct,
  CASE WHEN utilization_pct > 100 THEN 'red' WHEN utilization_pct > 80 THEN 'orange' ELSE 'green' END AS band,
  COALESCE(utilization_pct > 100, false) AS oversubscribed FROM cap""")
def k07(spark, d):
    i, c, r = _alloc(spark, d)
    return _round(al.capacity_analysis(i, c, r))


@register("k14_bottleneck", WA + CAP_SQL + f"""SELECT problem, resource, name, {R('utilization_pct', 6)} AS utilization_pct FROM (
  SELECT *, row_number() OVER (PARTITION BY problem ORDER BY utilization_pct DESC, resource) AS rn FROM cap) WHERE rn = 1""")
def k14(spark, d):
    i, c, r = _alloc(spark, d)
    return _round(al.bottleneck(al.capacity_analysis(i, c, r)))


EFF_SQL = DENSE_SQL + ", eff AS (SELECT *, profit / amount AS efficiency FROM dense WHERE amount > 0)\n"


@register("k08_efficiency_by_resource", WA + EFF_SQL + f"SELECT problem, resource, name, {R('avg(efficiency)', 6)} AS mean_efficiency FROM eff GROUP BY 1, 2, 3")
def k08(spark, d):
    i, c, r = _alloc(spark, d)
    return _round(al.efficiency_by_resource(al.efficiency(i, r, c)))


@register("k09_top_efficient", WA + EFF_SQL + f""", m AS (SELECT problem, item, avg(efficiency) AS me FROM eff GROUP BY 1, 2),
t AS (SELECT *, row_number() OVER (PARTITION BY problem ORDER BY me DESC, item) AS rank FROM m)
SELECT t.problem, t.item, {R('me', 6)} AS mean_efficiency, CAST(rank AS INT) AS rank, i.profit
FROM t JOIN items i ON t.problem = i.problem AND t.item = i.item WHERE rank <= 5""")
def k09(spark, d):
    i, c, r = _alloc(spark, d)
    return _round(al.top_efficient(al.efficiency(i, r, c), i, 5)).withColumn("rank", F.col("rank").cast("int"))


@register("k10_efficiency_hist", WA + DENSE_SQL + f""", e AS (SELECT problem, resource, profit / (amount + 1e-6::DOUBLE) AS efficiency FROM dense),
st AS (SELECT resource, min(efficiency) AS mn, max(efficiency) AS mx FROM e GROUP BY 1),
c AS (SELECT e.resource, CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((efficiency - mn) / (mx - mn) * 30), 29) END AS INT) AS bin,
  count(*) AS n FROM e JOIN st ON e.resource = st.resource GROUP BY 1, 2),
sp AS (SELECT resource, CAST(range AS INT) AS bin, mn, mx FROM st, range(0, 30))
SELECT sp.resource, sp.bin, {R('mn + (mx - mn) * sp.bin / 30', 4)} AS lo, {R('mn + (mx - mn) * (sp.bin + 1) / 30', 4)} AS hi,
  CAST(COALESCE(n, 0) AS BIGINT) AS n FROM sp LEFT JOIN c ON sp.resource = c.resource AND sp.bin = c.bin""")
def k10(spark, d):
    i, c, r = _alloc(spark, d)
    e = al.efficiency_eps(i, r, c)
    return _round(pr.histogram(e, "efficiency", 30, by=["resource"]), 4)


def _greedy_sql(order, s=""):
    """The sequential greedy as a recursive query, taking items in ``order``."""
    return f"""ord{s} AS (SELECT problem, item, profit, row_number() OVER (PARTITION BY problem ORDER BY {order}) AS rk FROM items),
vec{s} AS (SELECT o.problem, o.item, o.rk, list(d.amount ORDER BY d.resource) AS a FROM ord{s} o JOIN dense d ON o.problem = d.problem AND o.item = d.item GROUP BY 1, 2, 3),
capv{s} AS (SELECT problem, list(capacity ORDER BY resource) AS cap FROM resources GROUP BY 1),
g{s} AS (SELECT problem, 0 AS rk, cap AS rem, NULL::BIGINT AS item, false AS took FROM capv{s}
  UNION ALL
  SELECT g{s}.problem, v.rk, CASE WHEN list_bool_and(list_transform(range(1, len(g{s}.rem) + 1), lambda k: v.a[k] <= g{s}.rem[k]))
      THEN list_transform(range(1, len(g{s}.rem) + 1), lambda k: g{s}.rem[k] - v.a[k]) ELSE g{s}.rem END,
    v.item, list_bool_and(list_transform(range(1, len(g{s}.rem) + 1), lambda k: v.a[k] <= g{s}.rem[k]))
  FROM g{s} JOIN vec{s} v ON v.problem = g{s}.problem AND v.rk = g{s}.rk + 1)
"""


GREEDY_SQL = DENSE_SQL + ", " + _greedy_sql("profit DESC, item")


@register("k11_greedy_select", WAR + GREEDY_SQL + "SELECT problem, item FROM g WHERE took")
def k11(spark, d):
    i, c, r = _alloc(spark, d)
    return al.greedy_select(i, c, r)


SEL_EVAL_SQL = GREEDY_SQL + """, sel AS (SELECT problem, item FROM g WHERE took),
prof AS (SELECT s.problem, sum(i.profit) AS total_profit, count(*) AS n_selected FROM sel s JOIN items i ON s.problem = i.problem AND s.item = i.item GROUP BY 1),
used AS (SELECT s.problem, c.resource, sum(c.amount) AS used FROM sel s JOIN consumption c ON s.problem = c.problem AND s.item = c.item GROUP BY 1, 2),
ev AS (SELECT r.problem, r.resource, r.name, r.capacity, CAST(COALESCE(used, 0) AS BIGINT) AS used
  FROM resources r LEFT JOIN used u ON r.problem = u.problem AND r.resource = u.resource)
"""


@register("k12_evaluate_selection", WAR + SEL_EVAL_SQL + f"""SELECT ev.*, {R('CASE WHEN capacity > 0 THEN used / capacity * 100 ELSE 0.0 END', 6)} AS utilization_pct,
  used <= capacity AS satisfied, CAST(p.total_profit AS BIGINT) AS total_profit, p.n_selected,
  bool_and(used <= capacity) OVER (PARTITION BY ev.problem) AS feasible
FROM ev LEFT JOIN prof p ON ev.problem = p.problem""")
def k12(spark, d):
    i, c, r = _alloc(spark, d)
    sel = al.greedy_select(i, c, r)
    return _round(al.evaluate_selection(sel, i, c, r))


@register("k13_selected_items", WAR + SEL_EVAL_SQL + """SELECT i.problem, i.item, i.category, i.profit,
  map_from_entries(list(struct_pack(k := r.name, v := c.amount) ORDER BY r.name)) AS resource_usage
FROM sel s JOIN items i ON s.problem = i.problem AND s.item = i.item
LEFT JOIN consumption c ON c.problem = s.problem AND c.item = s.item
LEFT JOIN resources r ON r.problem = c.problem AND r.resource = c.resource
GROUP BY i.problem, i.item, i.category, i.profit""")
def k13(spark, d):
    i, c, r = _alloc(spark, d)
    return al.selected_items(al.greedy_select(i, c, r), i, c, r)


@register("a21_problem_summary", WA + f"""SELECT i.problem, n_items, {R('avg_profit', 6)} AS avg_profit, max_profit, n_resources, CAST(total_capacity AS BIGINT) AS total_capacity
FROM (SELECT problem, count(*) AS n_items, avg(profit) AS avg_profit, max(profit) AS max_profit FROM items GROUP BY 1) i
JOIN (SELECT problem, count(*) AS n_resources, sum(capacity) AS total_capacity FROM resources GROUP BY 1) r ON i.problem = r.problem""")
def a21(spark, d):
    i, _, r = _alloc(spark, d)
    return _round(al.problem_summary(i, r))


@register("k25_allocation_summary", WA + CAP_SQL + f"""SELECT i.problem, n_items, n_categories, {R('profit_mean', 6)} AS profit_mean,
  {R('profit_std', 6)} AS profit_std, profit_min, profit_max, {R('profit_std / profit_mean * 100', 6)} AS profit_cv_pct,
  {R('n_items * 0.3010299956639812::DOUBLE', 6)} AS log10_search_space, n_resources, b.name AS bottleneck,
  {R('b.utilization_pct', 6)} AS bottleneck_utilization_pct
FROM (SELECT problem, count(*) AS n_items, count(DISTINCT category) AS n_categories, avg(profit) AS profit_mean,
  stddev_samp(profit) AS profit_std, min(profit) AS profit_min, max(profit) AS profit_max FROM items GROUP BY 1) i
JOIN (SELECT problem, count(*) AS n_resources FROM resources GROUP BY 1) nr ON i.problem = nr.problem
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY problem ORDER BY utilization_pct DESC, resource) AS rn FROM cap) WHERE rn = 1) b
  ON i.problem = b.problem""")
def k25(spark, d):
    i, c, r = _alloc(spark, d)
    return _round(al.allocation_summary(i, c, r))


@register("k24_compare_solutions", WAR + GREEDY_SQL + ", " + _greedy_sql("item", "2") + """,
sa AS (SELECT s.problem, sum(i.profit) AS profit, count(*) AS n_selected FROM g2 s JOIN items i ON s.problem = i.problem AND s.item = i.item WHERE took GROUP BY 1),
sb AS (SELECT s.problem, sum(i.profit) AS profit, count(*) AS n_selected FROM g s JOIN items i ON s.problem = i.problem AND s.item = i.item WHERE took GROUP BY 1)
SELECT sa.problem, CAST(sa.profit AS BIGINT) AS profit_a, CAST(sb.profit AS BIGINT) AS profit_b, sa.n_selected AS n_selected_a,
  sb.n_selected AS n_selected_b, CAST(sb.profit - sa.profit AS DOUBLE) AS profit_difference,
  """ + R("CASE WHEN sb.profit > 0 THEN (sb.profit - sa.profit) / sb.profit * 100 ELSE 0.0 END", 6) + """ AS gap_pct,
  0.0::DOUBLE AS time_difference,
  CASE WHEN (CASE WHEN sb.profit > 0 THEN (sb.profit - sa.profit) / sb.profit * 100 ELSE 0.0 END) < 1 THEN 'EXCELLENT'
       WHEN (CASE WHEN sb.profit > 0 THEN (sb.profit - sa.profit) / sb.profit * 100 ELSE 0.0 END) < 5 THEN 'GOOD' ELSE 'FAIR' END AS quality
FROM sa JOIN sb ON sa.problem = sb.problem""")
def k24(spark, d):
    """Two whole solutions: the greedy in item order against the greedy in profit order."""
    i, c, r = _alloc(spark, d)

    def summ(sel):
        return sel.join(i, ["problem", "item"]).groupBy("problem").agg(
            F.sum("profit").alias("profit"), F.count(F.lit(1)).alias("n_selected"), F.lit(0.0).alias("seconds"))
    out = al.compare_solutions(summ(al.greedy_select(i.withColumn("profit", -F.col("item")), c, r)),
                               summ(al.greedy_select(i, c, r)))
    return _round(out)


@register("p24_short_label", WA + "x AS (SELECT 1) SELECT problem, resource, substring(name, 1, 15) AS short_name FROM resources")
def p24(spark, d):
    _, _, r = _alloc(spark, d)
    return r.select("problem", "resource", pr.short_label("name", 15).alias("short_name"))
