"""Stand-in inputs built from the given tables (FIXTURES.md part 2).

Each fixture is a lazy DataFrame derived from the parquet tables, so its size
grows with them, plus a DuckDB SQL twin (a CTE body) used by the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_uniform, hash_uniform_sql, np_round, np_round_sql
from tessera.operators.ordering import ordinal
from tessera.sources.tables import table

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (resource names and units for
# a five-resource instance, SKU generation alphabet).
RESOURCE_NAMES_5 = ["CNC_Machine_Hours", "Assembly_Line_Hours", "Skilled_Labor_Hours",
                    "Raw_Material_Budget_USD", "Energy_Consumption_kWh"]
RESOURCE_UNITS_5 = ["hours", "hours", "hours", "USD", "kWh"]
RESOURCE_NAMES_10 = RESOURCE_NAMES_5 + ["Warehouse_Space_SqFt", "Quality_Inspection_Hours",
                                        "Setup_Changeover_Hours", "Shipping_Capacity_Pallets",
                                        "Compliance_Hours"]
RESOURCE_UNITS_10 = RESOURCE_UNITS_5 + ["sq_ft", "hours", "hours", "pallets", "hours"]
SKU_CATEGORIES = ["Widget", "Gadget", "Component", "Module", "Assembly"]
SKU_SERIES = ["A", "B", "C", "D", "E"]
# Holiday stand-in (month, day), every year of the data span.
HOLIDAYS_MD = [(1, 1), (1, 6), (5, 1), (8, 15), (10, 12), (11, 1), (12, 6), (12, 8), (12, 25)]
# ---------------------------------------------------------------------------


def _sql_list(xs) -> str:
    return ", ".join(f"'{x}'" for x in xs)


# ---------------------------------------------------------------- F1 campaign
def campaign(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                         "o_orderdate", "o_orderpriority")
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    li = (table(spark, d, "lineitem").groupBy("l_orderkey")
          .agg(F.count(F.lit(1)).alias("campaign"), F.sum("l_quantity").cast("bigint").alias("duration")))
    o = o.withColumn("o_day", F.to_date("o_orderdate"))
    # previous order of the same customer, skew-safe (bucket = order day)
    o = ordinal(o, by=["o_custkey"], order=["o_orderdate", "o_orderkey"], bucket=F.col("o_day"),
                name="previous", prev=["o_day", "o_orderstatus"])
    x = (o.join(c, o.o_custkey == c.c_custkey, "inner")
         .join(li, o.o_orderkey == li.l_orderkey, "left"))
    x = x.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("o_totalprice").alias("total"),
        F.coalesce("campaign", F.lit(0)).cast("bigint").alias("campaign"),
        F.coalesce("duration", F.lit(0)).cast("bigint").alias("duration"),
        F.col("previous"),
        F.coalesce(F.datediff("o_day", "prev_o_day"), F.lit(999)).cast("int").alias("pdays"),
        F.col("c_mktsegment").alias("segment"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("unknown"))
         .otherwise(F.col("o_orderpriority")).alias("priority"),
        F.lower(F.date_format("o_day", "MMM")).alias("month"),
        F.weekday("o_day").cast("int").alias("day_of_week"),
        F.coalesce("prev_o_orderstatus", F.lit("nonexistent")).alias("poutcome"),
    )
    # y: duration above its 0.88 linear quantile.  Spark's exact percentile keeps a
    # value->count map per partial aggregate, so an integer column stays small.
    # The duration column only depends on orders x lineitem, so the quantile is
    # taken there instead of re-running the previous-order windows.
    dur = (table(spark, d, "orders").select("o_orderkey", "o_custkey")
           .join(c.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
           .join(li, F.col("o_orderkey") == li.l_orderkey, "left")
           .select(F.coalesce("duration", F.lit(0)).cast("bigint").alias("duration")))
    q = dur.agg(F.percentile("duration", 0.88).alias("__q88"))
    x = x.crossJoin(F.broadcast(q))  # one row: proven size bound
    return x.withColumn("y", F.when(F.col("duration") > F.col("__q88"), "yes").otherwise("no")).drop("__q88")


CAMPAIGN_SQL = """campaign_base AS (
  SELECT o.o_orderkey AS row_id, c.c_acctbal AS acctbal, o.o_totalprice AS total,
         CAST(COALESCE(li.campaign, 0) AS BIGINT) AS campaign,
         CAST(COALESCE(li.duration, 0) AS BIGINT) AS duration,
         CAST(row_number() OVER w - 1 AS BIGINT) AS previous,
         CAST(COALESCE(date_diff('day', CAST(lag(o.o_orderdate) OVER w AS DATE), CAST(o.o_orderdate AS DATE)), 999) AS INT) AS pdays,
         c.c_mktsegment AS segment, o.o_orderstatus AS status,
         CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown' ELSE o.o_orderpriority END AS priority,
         lower(strftime(o.o_orderdate, '%b')) AS month,
         CAST(isodow(o.o_orderdate) - 1 AS INT) AS day_of_week,
         COALESCE(lag(o.o_orderstatus) OVER w, 'nonexistent') AS poutcome
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS campaign, CAST(sum(l_quantity) AS BIGINT) AS duration
             FROM lineitem GROUP BY l_orderkey) li ON o.o_orderkey = li.l_orderkey
  WINDOW w AS (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey)
),
campaign AS (
  SELECT b.*, CASE WHEN b.duration > q.q88 THEN 'yes' ELSE 'no' END AS y
  FROM campaign_base b, (SELECT quantile_cont(duration, 0.88) AS q88 FROM campaign_base) q
)"""


# ------------------------------------------------------------------ F2 load
def load_raw(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return o.select(
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 00:00:00+01:00")).alias("time"),
        F.when(F.pmod("o_orderkey", F.lit(97)) == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("total load actual"),
    )


LOAD_RAW_SQL = """load_raw AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00+01:00' AS "time",
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS "total load actual"
  FROM orders
)"""


# --------------------------------------------------------------- F3 weather
WEATHER_COLS = ["temp", "temp_min", "temp_max", "humidity", "wind_speed",
                "rain_1h", "rain_3h", "snow_3h", "clouds_all"]


def weather_raw(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                                            "l_tax", "l_returnflag", "l_shipdate")
    dom = F.dayofmonth("l_shipdate")
    kelvin = (F.col("l_quantity") + F.lit(273.15)).cast("string")
    return li.select(
        F.when(F.pmod("l_orderkey", F.lit(997)) == 0, F.lit("bad"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("dt_iso"),
        F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(kelvin).alias("temp"),
        kelvin.alias("temp_min"),
        kelvin.alias("temp_max"),
        F.when(dom == 13, F.lit(None).cast("string"))
         .otherwise((F.col("l_discount") * 1000).cast("string")).alias("humidity"),
        (F.col("l_tax") * 100).cast("string").alias("wind_speed"),
        F.when(dom == 17, F.lit(None).cast("string"))
         .otherwise(F.col("l_linenumber").cast("string")).alias("rain_1h"),
        (F.col("l_returnflag") == "R").cast("int").cast("string").alias("rain_3h"),
        (F.col("l_returnflag") == "A").cast("int").cast("string").alias("snow_3h"),
        F.col("l_linenumber").cast("string").alias("clouds_all"),
    )


WEATHER_RAW_SQL = """weather_raw AS (
  SELECT CASE WHEN l_orderkey % 997 = 0 THEN 'bad' ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS dt_iso,
         CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_quantity + 273.15 AS VARCHAR) END AS temp,
         CAST(l_quantity + 273.15 AS VARCHAR) AS temp_min,
         CAST(l_quantity + 273.15 AS VARCHAR) AS temp_max,
         CASE WHEN day(l_shipdate) = 13 THEN NULL ELSE CAST(l_discount * 1000 AS VARCHAR) END AS humidity,
         CAST(l_tax * 100 AS VARCHAR) AS wind_speed,
         CASE WHEN day(l_shipdate) = 17 THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END AS rain_1h,
         CAST(CAST(l_returnflag = 'R' AS INT) AS VARCHAR) AS rain_3h,
         CAST(CAST(l_returnflag = 'A' AS INT) AS VARCHAR) AS snow_3h,
         CAST(l_linenumber AS VARCHAR) AS clouds_all
  FROM lineitem
)"""


# ----------------------------------------------------------- F4 allocation
def alloc_items(spark: SparkSession, d: str, many: bool = False) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    return p.select(
        (F.col("p_type") if many else F.lit(1)).alias("problem"),
        F.col("p_partkey").alias("item"),
        F.col("p_brand").alias("category"),
        (F.round(F.col("p_retailprice") * 10).cast("bigint") + F.lit(200) * F.col("p_size")).alias("profit"),
    )


ITEMS_SQL = """items AS (
  SELECT 1 AS problem, p_partkey AS item, p_brand AS category,
         CAST(round(p_retailprice * 10) AS BIGINT) + 200 * p_size AS profit
  FROM part
)"""


def alloc_consumption(spark: SparkSession, d: str, many: bool = False) -> DataFrame:
    """sum(l_quantity) by part and supplier region; pre-aggregated by (part,
    supplier) before the supplier join so the join sees far fewer rows."""
    li = (table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey")
          .agg(F.sum("l_quantity").alias("q")))
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    n = F.broadcast(table(spark, d, "nation").select("n_nationkey", "n_regionkey"))  # 25 rows
    x = (li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == n.n_nationkey)
         .groupBy("l_partkey", "n_regionkey").agg(F.sum("q").cast("bigint").alias("amount")))
    x = x.select(F.col("l_partkey").alias("item"), F.col("n_regionkey").cast("int").alias("resource"), "amount")
    if many:
        p = table(spark, d, "part").select(F.col("p_partkey").alias("item"), F.col("p_type").alias("problem"))
        return x.join(p, "item").select("problem", "item", "resource", "amount")
    return x.select(F.lit(1).alias("problem"), "item", "resource", "amount")


CONSUMPTION_SQL = """consumption AS (
  SELECT 1 AS problem, l_partkey AS item, CAST(n_regionkey AS INT) AS resource,
         CAST(sum(l_quantity) AS BIGINT) AS amount
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY l_partkey, n_regionkey
)"""


def alloc_resources(spark: SparkSession, d: str, consumption: DataFrame | None = None,
                    many: bool = False) -> DataFrame:
    cons = consumption if consumption is not None else alloc_consumption(spark, d, many)
    r = F.broadcast(table(spark, d, "region").select("r_regionkey"))  # 5 rows
    names = F.array(*[F.lit(x) for x in RESOURCE_NAMES_5])
    units = F.array(*[F.lit(x) for x in RESOURCE_UNITS_5])
    tot = cons.groupBy("problem", "resource").agg(F.sum("amount").alias("demand"),
                                                   F.max("amount").alias("max_amount"))
    return (tot.join(r, tot.resource == r.r_regionkey)
            .select("problem", "resource",
                    F.element_at(names, F.col("resource") + 1).alias("name"),
                    F.element_at(units, F.col("resource") + 1).alias("unit"),
                    F.floor(F.col("demand") / 2).cast("bigint").alias("capacity"),
                    F.floor(F.col("max_amount") * 9 / 10).cast("bigint").alias("capacity_small")))


RESOURCES_SQL = f"""resources AS (
  SELECT problem, resource,
         ([{_sql_list(RESOURCE_NAMES_5)}])[resource + 1] AS name,
         ([{_sql_list(RESOURCE_UNITS_5)}])[resource + 1] AS unit,
         CAST(sum(amount) // 2 AS BIGINT) AS capacity,
         CAST(max(amount) * 9 // 10 AS BIGINT) AS capacity_small
  FROM consumption JOIN region ON resource = r_regionkey
  GROUP BY problem, resource
)"""

ALLOC_SQL = ",\n".join([ITEMS_SQL, CONSUMPTION_SQL, RESOURCES_SQL])


# ---------------------------------------------------------------- F6 scores
def scores(spark: SparkSession, d: str) -> DataFrame:
    c = campaign(spark, d)
    return c.select(
        "row_id",
        (F.col("y") == "yes").cast("int").alias("label"),
        np_round(F.lit(0.6) * hash_uniform(1, "row_id") + F.lit(0.4) * F.col("campaign") / F.lit(13.0), 2)
        .alias("score"),
    )


SCORES_SQL = CAMPAIGN_SQL + f""",
scores AS (
  SELECT row_id, CAST(y = 'yes' AS INT) AS label,
         {np_round_sql("0.6::DOUBLE * " + hash_uniform_sql(1, "row_id") + " + 0.4::DOUBLE * campaign / 13.0::DOUBLE", 2)} AS score
  FROM campaign
)"""


# ------------------------------------------------------------ F10 holidays
def holidays(spark: SparkSession, dates: DataFrame, ds: str = "ds") -> DataFrame:
    """Holiday table for every year spanned by ``dates`` (9 rows per year)."""
    md = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(dd).alias("d")) for m, dd in HOLIDAYS_MD])
    years = dates.agg(F.min(F.year(ds)).alias("y0"), F.max(F.year(ds)).alias("y1")) \
        .select(F.explode(F.sequence("y0", "y1")).alias("hy"))
    return (years.select("hy", F.explode(md).alias("md"))
            .select(F.make_date("hy", F.col("md.m"), F.col("md.d")).alias("holiday")))


HOLIDAY_PREDICATE_SQL = "(month({d}) * 100 + day({d})) IN (" + ", ".join(str(m * 100 + dd) for m, dd in HOLIDAYS_MD) + ")"
