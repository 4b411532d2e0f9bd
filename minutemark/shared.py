"""The folder that all executors share, and tables written there to cut lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so that their Python workers can import it."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="spark-minutemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        package = os.path.basename(os.path.dirname(os.path.abspath(__file__)))
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, package), "zip", root, package))
        _shipped.add(app)


def shared_dir(spark: SparkSession, tag: str) -> str:
    """A new folder's URI under ``spark.checkpoint.dir``; where that is unset, a local master gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        app = spark.sparkContext
        if not (app.master == "local" or app.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        if app.applicationId not in _own:
            _own[app.applicationId] = folder = tempfile.mkdtemp(prefix="spark-minutemark-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        base = "file://" + _own[app.applicationId]
    return f"{base.rstrip('/')}/minutemark/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as read from there: a lost executor costs a re-read."""
    path = shared_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_all(*tables: tuple[DataFrame, str]) -> list[DataFrame]:
    """``cut`` of several tables, written at the same time."""
    with ThreadPoolExecutor(len(tables)) as pool:
        return list(pool.map(lambda table: cut(*table), tables))


def clear(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder; whatever reads from there must be done."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/minutemark/{spark.sparkContext.applicationId}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ranked(rows: DataFrame, group: list[str], order: list[Column], tag: str) -> DataFrame:
    """Add ``pos``, each row's place from 0 within its group, and ``n``, the group's number of rows; group columns aren't null.

    Rows are dealt out by ranges of group and order and written once with their place in the range. A group of any
    size spreads over many ranges; of the rest only the counts by group and range are moved.
    """
    keys = [*[F.col(c) for c in group], *order]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id()), tag)
    ranged = ranged.withColumns({"_range": F.shiftright("_id", 33), "_low": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id")
    every = Window.partitionBy(*group)
    counts = ranged.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_low").alias("_first"))
    counts = counts.select(
        *group, "_range", F.sum("_n").over(every).alias("n"), (F.sum("_n").over(every.orderBy("_range")) - F.col("_n") - F.col("_first")).alias("_shift")
    )
    out = ranged.join(cut(counts, f"{tag}-counts"), [*group, "_range"])
    return out.withColumn("pos", F.col("_low") + F.col("_shift")).drop("_range", "_low", "_shift")
