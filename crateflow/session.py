"""Session helpers: tables, the shared scratch folder and written cut points."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "crateflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the engine expects: UTC, adaptive execution, Arrow."""
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in (defaults | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def plain_unions(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.unionOutputPartitioning", "false") == "true":
        spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder.

    Spark 4.1 may plan a union as if its branches kept one partitioning although adaptive execution gave them different
    numbers of partitions, and then fails ("Can't zip RDDs"); that planning is switched off.
    """
    plain_unions(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir); a local one is set only where it is unset, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="crateflow-scratch-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return root


_PATHS: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _PATHS.append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Remove all that this session wrote to the shared folder so far; to be called once results are stored."""
    while _PATHS:
        p = spark._jvm.org.apache.hadoop.fs.Path(_PATHS.pop())
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there and a lost executor costs nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
