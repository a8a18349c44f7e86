"""A local session for tests, tools and the bench (library code never makes
one), and the package for sessions whose workers do not have it installed."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "bucketlens") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BUCKETLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """How many tasks the session shuffles into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_LOCAL_DIRS: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share
    (``spark.checkpoint.dir``); a session in one local process may go without and
    gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="bucketlens-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Remove a query's shuffle files as soon as it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_parquet(df: DataFrame, path: str) -> None:
    """``df`` as Parquet; the shuffle files behind it go with the write."""
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the scratch folder, and read from there."""
    path = scratch_path(df.sparkSession, name)
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package (``addPyFile``, once per
    application), so that functions which run in them can import it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="bucketlens-")) / "bucketlens_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(Path(root.name) / path.relative_to(root)))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
