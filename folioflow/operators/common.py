"""Helpers shared by the operators: reading tables, cutting lineage, hot keys."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key that holds more than one row in HOT_SHARE is treated as hot; so there can be at most HOT_SHARE hot keys.
HOT_SHARE = 1024
#: Tables up to this many bytes on disk may be broadcast, everything larger is joined by shuffle.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One Parquet table of a data directory, pruned to the columns named."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir where it is set.

    Where it is unset, a local session gets a temporary folder and a cluster a
    folder below the warehouse, never a folder of one machine.
    """
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        where = getattr(shared_dir, "own", None)
        if where is None or not os.path.isdir(where):
            where = shared_dir.own = tempfile.mkdtemp(prefix="folioflow-")
            atexit.register(__import__("shutil").rmtree, where, True)
        return where
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_folioflow"


def written(df: DataFrame, what: str = "t") -> DataFrame:
    """Write df as a table in the shared folder and read it back.

    It cuts the lineage as checkpoint() does, but compressed and by column, and
    it survives the loss of executors. The folder is removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Remove what written() wrote for df, once nothing reads it any more."""
    for f in {os.path.dirname(f) for f in df.inputFiles()}:
        _remove(df.sparkSession, f)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended
        pass


def hot_keys(df: DataFrame, key: str, total: int, n: Column | None = None) -> DataFrame:
    """The keys of df that hold more than one row in HOT_SHARE of total rows.

    By counting there are fewer than HOT_SHARE of them, which bounds the broadcast.
    """
    least = max(1000, total // HOT_SHARE)
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(n if n is not None else F.lit(1)).alias("_n")).where(F.col("_n") > least).select(key)


def spread_join(rows: DataFrame, facts: DataFrame, key: str, hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """rows joined with facts, which has each key once: the rows of the hot keys by broadcast, the others by shuffle.

    hot has the keys that hold more than one row in HOT_SHARE, so it is small by counting; None stands for none.
    """
    if hot is None or hot.isEmpty():
        return rows.join(facts.hint("shuffle_hash"), key, how)
    hot = F.broadcast(hot)
    by_broadcast = rows.join(hot, key, "left_semi").join(F.broadcast(facts.join(hot, key, "left_semi")), key, how)
    return by_broadcast.unionByName(rows.join(hot, key, "left_anti").join(facts, key, how))


def disk_bytes(df: DataFrame) -> int:
    """Bytes of the files that df is read from; the proof for a broadcast."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for f in df.inputFiles():
        p = jvm.org.apache.hadoop.fs.Path(f)
        total += p.getFileSystem(conf).getFileStatus(p).getLen()
    return total


def join_small(left: DataFrame, right: DataFrame, on, how: str = "inner", source: DataFrame | None = None) -> DataFrame:
    """Join, broadcasting right only if the files of source (or right) are within BROADCAST_BYTES."""
    if disk_bytes(source if source is not None else right) <= BROADCAST_BYTES:
        right = F.broadcast(right)
    return left.join(right, on, how)
