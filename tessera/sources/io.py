"""Sources and sinks: delimited text, instance text format, parquet and JSON
documents, result tables, models and a run-metrics log.

Paths are shared-storage locations (never machine-local folders on a cluster).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ----------------------------------------------------------- delimited text
def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
             header: bool = True, date_cols: Sequence[str] = (), date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Delimited scan with an explicit schema (no inference), custom
    separator, optional date columns parsed from text.  Dotted names become
    underscores."""
    r = spark.read.schema(schema).option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    df = r.csv(path)
    df = df.toDF(*[c.replace(".", "_") for c in df.columns])
    for c in date_cols:
        df = df.withColumn(c, F.to_date(F.col(c), date_format))
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), **options) -> None:
    """Result table sink (parquet, csv with header, json)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    for k, v in options.items():
        w = w.option(k, v)
    w.format(fmt).save(path)


def write_split(df: DataFrame, path: str, split: str = "split", fmt: str = "parquet") -> None:
    """train/test rows as one table partitioned by split."""
    write_table(df, path, fmt, partition_by=[split])


# ----------------------------------------------------- allocation instances
def write_instances_text(items: DataFrame, resources: DataFrame, consumption: DataFrame, path: str,
                         optimum: DataFrame | None = None, per_line: int = 10) -> None:
    """Instance text format (count; per problem `n m optimum`, n profits, m x n
    amounts, m capacities), wrapped ``per_line`` numbers per line, one file
    per problem (partitioned by problem).  Lines are built as small groups of
    tokens; each problem file is written in line order by one writer."""
    from tessera.operators.search import item_positions
    loci = item_positions(items)
    n = loci.select("problem", "n_items").distinct()
    m = resources.groupBy("problem").agg(F.count(F.lit(1)).alias("m"))
    opt = optimum if optimum is not None else n.select("problem", F.lit(0).cast("bigint").alias("optimum"))
    hdr = n.join(m, "problem").join(opt, "problem")
    toks = [
        hdr.select("problem", F.lit(0).alias("sec"), F.lit(0).alias("row"), F.lit(0).cast("long").alias("idx"), F.lit("1").alias("tok")),
        hdr.select("problem", F.lit(1).alias("sec"), F.lit(0).alias("row"), F.lit(0).cast("long").alias("idx"),
                   F.concat_ws(" ", F.col("n_items").cast("string"), F.col("m").cast("string"),
                               F.col("optimum").cast("string")).alias("tok")),
        loci.select("problem", F.lit(2).alias("sec"), F.lit(0).alias("row"), F.col("pos").alias("idx"), F.col("profit").cast("string").alias("tok")),
    ]
    dense = loci.join(resources.select("problem", "resource"), "problem") \
        .join(consumption.select("problem", "item", "resource", "amount"), ["problem", "item", "resource"], "left")
    toks.append(dense.select("problem", F.lit(3).alias("sec"), F.col("resource").alias("row"), F.col("pos").alias("idx"),
                             F.coalesce("amount", F.lit(0)).cast("string").alias("tok")))
    toks.append(resources.select("problem", F.lit(4).alias("sec"), F.lit(0).alias("row"), F.col("resource").cast("long").alias("idx"),
                                 F.col("capacity").cast("string").alias("tok")))
    t = toks[0]
    for x in toks[1:]:
        t = t.unionByName(x)
    lines = t.groupBy("problem", "sec", "row", F.floor(F.col("idx") / per_line).alias("line")).agg(
        F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("idx", "tok"))), lambda s: s["tok"])).alias("value"))
    (lines.repartition("problem").sortWithinPartitions("problem", "sec", "row", "line")
     .select("problem", "value").write.mode("overwrite").partitionBy("problem").text(path))


def scan_instances(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Parse instance text files (whitespace tokens, sections located from
    the headers) into long tables.  Each file is one task (the format is
    sequential); a batch of files is parsed in parallel.  Returns
    (problems, items, resources, consumption); ``item`` is the 0-based position.
    ``problem`` is the folder's partition value, or ``<file name>#<position in
    the file>``, so that files of a batch never share an id."""
    raw = spark.read.text(path, wholetext=True)  # one row per file
    has_part = "problem" in raw.columns
    raw = raw.withColumn("file", F.input_file_name())
    words = F.filter(F.split(F.trim("value"), r"\s+"), lambda s: s != "")
    tok = raw.withColumn("t", F.transform(words, lambda s: s.cast("long"))).filter(F.size("t") > 0)
    # fold over the problems of a file to find where each one starts
    start = F.aggregate(
        F.sequence(F.lit(1), F.col("t")[0].cast("int")),
        F.struct(F.lit(1).alias("pos"), F.array().cast("array<int>").alias("starts")),
        lambda acc, k: F.struct(
            (acc["pos"] + 3 + F.col("t")[acc["pos"]] + F.col("t")[acc["pos"] + 1] * F.col("t")[acc["pos"]]
             + F.col("t")[acc["pos"] + 1]).cast("int").alias("pos"),
            F.concat(acc["starts"], F.array(acc["pos"])).alias("starts")))
    probs = tok.select("file", *(["problem"] if has_part else []), "t",
                       F.posexplode(start["starts"]).alias("k", "s"))
    if not has_part:
        probs = probs.withColumn("problem", F.concat(F.element_at(F.split("file", "/"), -1), F.lit("#"), (F.col("k") + 1).cast("string")))
    probs = probs.select("file", "problem", "t", "s",
                         F.col("t")[F.col("s")].cast("int").alias("n"), F.col("t")[F.col("s") + 1].cast("int").alias("m"),
                         F.col("t")[F.col("s") + 2].alias("optimum"))
    problems = probs.select("problem", F.col("n").alias("n_items"), F.col("m").alias("n_resources"), "optimum")
    items = probs.select("problem", F.posexplode(F.slice("t", F.col("s") + 4, F.col("n"))).alias("item", "profit_raw")) \
        .select("problem", F.col("item").cast("long"), (F.col("profit_raw") * 1000).alias("profit"))
    cons = probs.select("problem", "n", F.posexplode(F.slice("t", F.col("s") + 4 + F.col("n"), F.col("m") * F.col("n")))
                        .alias("o", "amount")) \
        .select("problem", F.floor(F.col("o") / F.col("n")).cast("int").alias("resource"),
                F.pmod(F.col("o"), F.col("n")).cast("long").alias("item"), "amount")
    res = probs.select("problem", F.posexplode(F.slice("t", F.col("s") + 4 + F.col("n") + F.col("m") * F.col("n"), F.col("m")))
                       .alias("resource", "capacity")).withColumn("resource", F.col("resource").cast("int"))
    return problems, items, res, cons


def save_instance(items: DataFrame, resources: DataFrame, consumption: DataFrame, path: str) -> None:
    """Columnar save, partitioned by problem."""
    for name, df in (("items", items), ("resources", resources), ("consumption", consumption)):
        df.write.mode("overwrite").partitionBy("problem").parquet(f"{path}/{name}")


def load_instance(spark: SparkSession, path: str, problems: Sequence | None = None):
    """Load (partition pruning when ``problems`` is given)."""
    out = []
    for name in ("items", "resources", "consumption"):
        df = spark.read.parquet(f"{path}/{name}")
        if problems is not None:
            df = df.filter(F.col("problem").isin(list(problems)))
        out.append(df)
    return tuple(out)


def instance_products(items: DataFrame, resources: DataFrame, consumption: DataFrame) -> DataFrame:
    """One nested record per product: sku/category/profit and a map
    resource name -> amount (m entries).  Written as JSON Lines, so no single
    document has to hold a whole problem."""
    c = consumption.join(resources.select("problem", "resource", "name"), ["problem", "resource"])
    req = c.groupBy("problem", "item").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "amount")))).alias("resource_requirements"))
    return items.join(req, ["problem", "item"], "left").select(
        "problem", "item", "category", F.col("profit").alias("profit_usd"), "resource_requirements")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


SOLUTION_SCHEMA = """problem_number INT, optimization_method STRING,
selected_products ARRAY<STRUCT<item: BIGINT, sku: STRING, category: STRING, profit_usd: DOUBLE, resource_usage: MAP<STRING, DOUBLE>>>,
resources ARRAY<STRUCT<name: STRING, unit: STRING, capacity: DOUBLE, used: DOUBLE, utilization_percent: DOUBLE>>"""


def solution_document(selection: DataFrame, items: DataFrame, consumption: DataFrame, resources: DataFrame,
                      method: str, per_line: int = 1000) -> DataFrame:
    """Solution documents with the selected products and their usage per resource, and capacity,
    used and utilization of every resource.  A problem is several JSON lines of the same layout: its
    resources in one, its products in lines of at most ``per_line`` item numbers, so no record grows with
    the selection."""
    from tessera.operators.allocation import evaluate_selection, selected_items
    prods = selected_items(selection, items, consumption, resources)
    sku = F.col("sku") if "sku" in prods.columns else F.lit(None).cast("string")
    product = F.struct("item", sku.alias("sku"), "category", F.col("profit").cast("double").alias("profit_usd"),
                       F.col("resource_usage").cast("map<string,double>").alias("resource_usage"))
    lines = prods.groupBy("problem", F.floor(F.col("item") / per_line).alias("__line")).agg(
        F.collect_list(product).alias("selected_products")).drop("__line")
    res = evaluate_selection(selection, items, consumption, resources)
    unit = F.col("unit") if "unit" in res.columns else F.lit(None).cast("string")
    resource = F.struct("name", unit.alias("unit"), F.col("capacity").cast("double").alias("capacity"), F.col("used").cast("double").alias("used"),
                        F.col("utilization_pct").alias("utilization_percent"))
    heads = res.groupBy("problem").agg(F.collect_list(resource).alias("resources"))
    return (heads.unionByName(lines, allowMissingColumns=True)
            .select(F.col("problem").alias("problem_number"), F.lit(method).alias("optimization_method"), "selected_products", "resources"))


def scan_solutions(spark: SparkSession, path: str, multiline: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read solution documents (JSON lines, or one document per file with ``multiline``) into
    products(problem, item, sku, category, profit_usd), usage(problem, item, sku, name, amount), one row
    per entry of the usage map, and resources(problem, name, unit, capacity, used, utilization_percent)."""
    raw = spark.read.schema(SOLUTION_SCHEMA).option("multiLine", multiline).json(path)
    one = raw.select(F.col("problem_number").alias("problem"), F.explode("selected_products").alias("p")).select("problem", "p.*")
    usage = one.select("problem", "item", "sku", F.explode("resource_usage").alias("name", "amount"))
    res = raw.select(F.col("problem_number").alias("problem"), F.explode("resources").alias("r")).select("problem", "r.*")
    return one.drop("resource_usage"), usage, res


def field_or(column: str, path: str, default, kind: str = "string"):
    """A field of a JSON text by path, or ``default`` if the key is missing or null."""
    return F.coalesce(F.get_json_object(column, path).try_cast(kind), F.lit(default).cast(kind))


def scan_summaries(spark: SparkSession, path: str) -> DataFrame:
    """The heads of solution documents of any method, one JSON text a line, with the defaults that a
    comparison uses for keys that a method leaves out."""
    raw = spark.read.text(path)
    return raw.select(field_or("value", "$.problem_number", -1, "int").alias("problem"), field_or("value", "$.company_name", "N/A").alias("company"),
                      field_or("value", "$.optimization_method", "Unknown").alias("method"), field_or("value", "$.best_profit_usd", 0.0, "double").alias("profit"),
                      field_or("value", "$.number_of_selected_products", 0, "int").alias("selected"),
                      field_or("value", "$.solver_status", "Unknown").alias("status"))


def log_metrics(metrics: DataFrame, run_id: str, path: str, ids: Sequence[str] = ("model",)) -> DataFrame:
    """Unpivot a metrics table to (run_id, ids..., key, value) and append."""
    value_cols = [c for c, t in metrics.dtypes if c not in ids and t in ("double", "float", "int", "bigint")]
    long = metrics.select(*ids, *[F.col(c).cast("double") for c in value_cols]) \
        .unpivot(list(ids), value_cols, "key", "value").withColumn("run_id", F.lit(run_id))
    long.write.mode("append").parquet(path)
    return long


def save_model(model, path: str) -> None:
    """S11."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load a saved PipelineModel."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
