"""Helpers that several operators share: the folder all executors see, tables staged there,
folds of labelled rows and connected components."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import is_local, ship_package

_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A folder of this session below ``spark.checkpoint.dir``, which driver and executors share.

    Only a local master may run without that setting: its executors are threads of the driver, so
    a temporary folder is shared by definition.  On a cluster an unset folder is an error."""
    sc = spark.sparkContext
    if sc.applicationId in _FOLDERS:
        return _FOLDERS[sc.applicationId]
    ship_package(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = sc.getCheckpointDir() or tempfile.mkdtemp(prefix="tessera-llm-")
    folder = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    _FOLDERS[sc.applicationId] = fs.makeQualified(path).toString()
    return _FOLDERS[sc.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: lineage ends here, and
    a lost executor costs no upstream work."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batch_bytes(spark: SparkSession, size: int):
    """Arrow batches of at most about ``size`` bytes for the jobs that run inside; the session's own setting is
    put back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null id: null)."""
    return F.crc32(id_col.cast("string").cast("binary")) % n


def drawn_share(share, *keys) -> Column:
    """Rows whose hash of ``keys`` falls into the first ``share`` (a number or column) of its range; as fine as 62 bits, so
    that a small share of very many rows is not nothing."""
    at = F.pmod(F.xxhash64(*keys), F.lit(1 << 62))
    if isinstance(share, Column):
        return at < share * F.lit(float(1 << 62))
    return at < F.lit(int(share * (1 << 62)))


def label_shares(labels: DataFrame, value: str) -> DataFrame:
    """One row per doc_id with the number of 0 and 1 marks in column ``value``; a repeated doc_id
    therefore never multiplies the documents it is joined to."""
    v = F.col(value)
    return (labels.where(F.col("doc_id").isNotNull() & v.isin(0, 1))
            .groupBy(F.col("doc_id").alias("label_id"))
            .agg(F.sum(F.when(v == 1, 1).otherwise(0)).alias("ones"),
                 F.sum(F.when(v == 0, 1).otherwise(0)).alias("zeros")))


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest reachable id for every id that occurs in ``edges`` (a long, b long).

    Alternating large-star and small-star steps: every node hands its neighbours the smallest id it
    knows, until no edge changes.  A node's minimum comes from a map-side combined aggregate and is
    joined back, so a centre with very many neighbours is split by the skew-join rule instead of
    meeting in one window.  Each step is written to the shared folder."""
    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
               "cc-edges")
    last = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = staged(large, "cc-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a")
                 .select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
                 .select("x.*").where("a <> b").distinct())
        e = staged(small, "cc-small")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())

