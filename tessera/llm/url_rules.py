"""URL rules by a sort-merge range join.

A rule is a host, a path prefix and a verdict; it fits its host and all subdomains if the url's path
starts with the rule's.  The canonical key of a rule is its host's labels in reverse order, a slash
(which no host holds) and its path, so a rule is the interval of all keys that begin with its own, and
such intervals are nested or disjoint.  A url has one key per host depth that occurs among the rules:
the last d labels of its host and its path.

Rules and url keys are dealt into ranges of equal size and sorted; the rows of one very common key differ
in a hash, so they fill several ranges.  A sweep over each range keeps the stack of rules that are open at
the key, the innermost on top.  Rules open at the beginning of a range are those whose key is a
proper beginning of its first key; they are found by an equality join on the lengths that rule keys have
and sent to the range too, at most one for each such length.  Of the rules that fit a url the longest
(host and path together, then the host) wins.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no rule; rules
without a host are left out; of repeated rules the verdict that sorts last holds, so ``block`` beats
``allow``; hosts are lower-cased from A to Z only; repeated rows and repeated or null ids give a row each;
urls and hosts of any length are whole; without rules every url gets the default; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPY_BLOCK = 4096


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
    there up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.substring_index(F.substring_index(F.substring_index(rest, "/", 1), "?", 1), "#", 1)
    behind = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.substring_index(F.substring_index(behind, "?", 1), "#", 1)
    return F.translate(host, UPPER, LOWER), path


def _labels(host: Column) -> Column:
    return F.split(host, r"\.", -1)


def _key(labels: Column, depth: Column, path: Column) -> Column:
    return F.concat(F.concat_ws(".", F.slice(F.reverse(labels), F.lit(1), depth)), F.lit("/"), path)


def rule_table(rules: DataFrame) -> DataFrame:
    """host, path, verdict, depth and key of every rule, repeated ones once."""
    clean = (rules.select(F.translate(F.col("host"), UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
             .where(F.col("host") != "").groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    labels = _labels(F.col("host"))
    return clean.select("host", "path", "verdict", F.size(labels).alias("depth"), _key(labels, F.size(labels), F.col("path")).alias("key"))


def _sweep(batches):
    """The innermost open rule of every url row; rows come sorted by range, key and kind (rules first)."""
    part, stack = None, []
    for b in batches:
        ranges, keys, kinds = (b.column(i).to_pylist() for i in range(3))
        rows, hits = [], []
        rule = b.column(4).to_pylist()
        for i, (p, key, kind) in enumerate(zip(ranges, keys, kinds)):
            if p != part:
                part, stack = p, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                stack.append((key, rule[i]))
            elif stack:
                rows.append(i)
                hits.append(stack[-1][1])
        if rows:
            yield pa.RecordBatch.from_arrays([b.column(3).take(pa.array(rows, pa.int64())), pa.array(hits, b.schema.field(4).type)], names=["url", "rule"])


def open_at(ranges: DataFrame, lengths: list[int]) -> DataFrame:
    """(part, rule) for the rules that are open at the first key of a range but stand in an earlier one."""
    first = ranges.groupBy("part").agg(F.min("key").alias("first"))
    starts = (first.select("part", "first", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("n"))
              .where(F.col("n") <= F.length("first"))
              .select("part", F.expr("substring(first, 1, n)").alias("key")))
    own = ranges.where("kind = 0").select("key", "rule", F.col("part").alias("own"))
    return starts.join(own, "key").where("own < part").select("part", "key", "rule")


def judge_urls(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """The id, host, path, rule (host and path of the rule that holds, else null) and verdict (the rule's,
    else ``default``) of every row of ``urls``; ``rules`` has host, path and verdict.

    One driver number per different host depth and key length of the rules is collected."""
    host, path = host_and_path(F.coalesce(F.col(url_col).cast("string"), F.lit("")))
    parsed = urls.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rules = staged(rule_table(rules), "url-rules")
    seen = rules.agg(F.sort_array(F.collect_set("depth")).alias("depths"), F.sort_array(F.collect_set(F.length("key"))).alias("lengths")).first()
    url = F.struct("id", "host", "path").alias("url")
    base = parsed.select(url, F.lit(None).cast("struct<host:string,path:string,verdict:string>").alias("rule"), F.lit(1).alias("n"))
    found = base
    if seen.depths:
        labels = _labels(F.col("host"))
        depth = F.explode(F.filter(F.array(*[F.lit(d) for d in seen.depths]), lambda d: d <= F.size(labels)))
        keyed = (parsed.where("host <> ''").select("*", depth.alias("depth"))
                 .select(_key(labels, F.col("depth"), F.col("path")).alias("key"), F.lit(1).alias("kind"),
                         F.xxhash64("id", "host", "path").alias("spread"), url,
                         F.lit(None).cast("struct<host:string,path:string,verdict:string>").alias("rule")))
        marks = rules.select("key", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("spread"),
                             F.lit(None).cast(keyed.schema["url"].dataType).alias("url"), F.struct("host", "path", "verdict").alias("rule"))
        ranges = staged(keyed.unionByName(marks).repartitionByRange("key", "kind", "spread")
                        .withColumn("part", F.spark_partition_id()), "url-ranges")
        carried = open_at(ranges, seen.lengths).select(
            "part", "key", F.lit(0).alias("kind"), F.lit(None).cast(keyed.schema["url"].dataType).alias("url"), "rule")
        swept = (ranges.select("part", "key", "kind", "url", "rule").unionByName(carried)
                 .repartition("part").sortWithinPartitions("part", "key", "kind"))
        out = T.StructType([T.StructField("url", keyed.schema["url"].dataType), T.StructField("rule", keyed.schema["rule"].dataType)])
        found = base.unionByName(swept.mapInArrow(_sweep, out).withColumn("n", F.lit(0)))
    size = F.length("rule.host") + F.length("rule.path")
    ranked = F.when(F.col("rule").isNotNull(), F.struct(size.alias("size"), F.length("rule.host").alias("own"), F.col("rule")))
    judged = found.groupBy("url").agg(F.max(ranked).alias("best"), F.sum("n").alias("n"))
    # a row for every copy, in blocks so that no array grows with the copies
    each = (judged.select("*", F.explode(F.expr(f"sequence(0, (n - 1) div {COPY_BLOCK})")).alias("block"))
            .select("*", F.explode(F.expr(f"sequence(1, least({COPY_BLOCK}, n - block * {COPY_BLOCK}))"))))
    rule = F.col("best.rule")
    return each.select(F.col("url.id").alias(id_col), F.col("url.host").alias("host"), F.col("url.path").alias("path"),
                       F.concat(rule["host"], rule["path"]).alias("rule"), F.coalesce(rule["verdict"], F.lit(default)).alias("verdict"))
