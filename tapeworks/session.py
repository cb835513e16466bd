"""Session helpers: settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Epoch arithmetic assumes UTC sessions; rendering picks its own zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: str = "8", app: str = "tapeworks", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.extraJavaOptions", "-Dderby.system.home=/tmp")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the cluster.

    Only a local session without that setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tapeworks-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_settled: list[str] = []


def settled(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read from there from now on.

    For results that several later steps read: each would otherwise compute them anew, and
    a lost executor would too. Readers prune columns and know sizes; ``sweep`` deletes.
    """
    path = work_folder(df.sparkSession, "settled")
    df.write.parquet(path)
    _settled.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store(spark: SparkSession, path: str):
    """The Hadoop file system behind a path, and the path for it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def sweep(spark: SparkSession) -> None:
    """Delete the tables settled so far; for use once all results built on them are written."""
    while _settled:
        files, where = store(spark, _settled.pop())
        files.delete(where, True)
